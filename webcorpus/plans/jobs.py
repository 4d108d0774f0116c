"""User-level jobs, composed of the operators and run against
one store folder of tables that grow by runs (``sources/runs.py``):

    {store}/raw          raw pages of each crawl run
    {store}/raw_index    raw key → run, so that a read opens only the runs it needs
    {store}/state        url state; a key's newest row counts
    {store}/chunks       staging vectors of each processing run, one row per page and chunk
    {store}/pages        page → processing run; makes that run's chunks of the page count
    {store}/production   promoted vectors; a dataset's newest promotion counts
    {store}/answers      precomputed answers, and in answer_hits what they rest on

Each job is a Spark plan end to end; the driver only sequences jobs.  Jobs
add files and rewrite none, so a job that dies half-way is re-run from its inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.operators import answers as AN
from webcorpus.operators import evaluate as EV
from webcorpus.operators import search as Q
from webcorpus.operators import state as S
from webcorpus.operators.chunking import chunk_documents
from webcorpus.operators.cleaning import clean_pages
from webcorpus.operators.embed import hashed_embedder
from webcorpus.operators.promote import promoted_rows, promotion_result
from webcorpus.operators.vectors import chunk_vectors, live_vectors
from webcorpus.sources import raw_store as R
from webcorpus.sources.robots import robots_allowed
from webcorpus.sources.runs import RunTable
from webcorpus.sources.seeds import crawl_frontier
from webcorpus.sources.tables import written
from webcorpus.streaming.pages_stream import STATE_SCHEMA, VECTOR_SCHEMA


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

        def table(name: str, schema: T.StructType, *key: str) -> RunTable:
            return RunTable(spark, f"{self.root}/{name}", schema, key, ("dataset",))

        self.raw = table("raw", _strings("dataset", "url", "raw_key", "raw_hash", "html"), "raw_key")
        self.raw_index = table("raw_index", _strings("dataset", "raw_key"), "raw_key")
        self.state = table("state", STATE_SCHEMA, "key")
        self.chunks = table("chunks", VECTOR_SCHEMA, "dataset", "url")
        self.pages = table("pages", _strings("dataset", "url"), "dataset", "url")
        self.production = table("production", VECTOR_SCHEMA, "dataset")
        self.answers = table("answers", _strings("dataset", "query_hash", "query", "json"), "dataset", "query_hash")
        self.answer_hits = table("answer_hits", T.StructType([*_strings("dataset", "query_hash", "id").fields, T.StructField("score", T.DoubleType())]),
                                 "dataset", "query_hash")

    def current_state(self, datasets: DataFrame | None = None) -> DataFrame:
        """The state rows (of ``datasets`` only, when given)."""
        s = self.state.newest().select(*STATE_SCHEMA.fieldNames())
        return s.join(datasets, "dataset", "left_semi") if datasets is not None else s

    def current_vectors(self, namespace: str | None = None) -> DataFrame:
        """The vectors that count, of both namespaces or one."""
        cols = VECTOR_SCHEMA.fieldNames()
        staging = live_vectors(self.chunks.rows(), self.pages.newest()).select(*cols)
        production = self.production.newest().select(*cols)
        return {"staging": staging, "production": production}.get(namespace) if namespace else staging.unionByName(production)

    def datasets(self) -> DataFrame:
        """``dataset`` of every live vector row, as many times."""
        staging = self.chunks.rows().select("dataset", "url", "run").join(self.pages.newest(), ["dataset", "url", "run"], "left_semi")
        return staging.select("dataset").unionByName(self.production.newest().select("dataset"))

    def raw_pages(self, keys: DataFrame) -> DataFrame:
        """The newest page of each raw key of ``keys(dataset, raw_key)``.  The index names the runs that
        hold them (the driver sees run numbers), and only those runs' files are read."""
        at = self.raw_index.newest().join(keys.select("raw_key").distinct(), "raw_key", "left_semi").select("raw_key", "run")
        runs = [r.run for r in at.select("run").distinct().collect()]
        return self.raw.rows().where(F.col("run").isin(runs)).join(at, ["raw_key", "run"], "left_semi")


def harvest(store: Store, seeds: DataFrame, sitemaps: DataFrame, base_urls: DataFrame,
            fetched: DataFrame, rules: DataFrame, agent: str, run: int, as_of: str) -> DataFrame:
    """Seeds → frontier → robots + HTML admission → skip unchanged (raw
    hash against state) → raw pages of this run + state rows → counts."""
    frontier = written(crawl_frontier(seeds, sitemaps, base_urls))
    got = fetched.join(frontier, ["dataset", "url"], "left_semi")
    # the robots file read is that of the dataset's base URL, also for URLs of other hosts
    bases = base_urls.groupBy("dataset").agg(F.min("base_url").alias("_base"))
    got = got.join(bases, "dataset", "left").withColumn("_base", F.coalesce("_base", "url"))
    got = robots_allowed(got, rules, agent, base_col="_base").drop("_base")
    ok = F.col("allowed") & F.lower(F.coalesce("content_type", F.lit(""))).contains("text/html")
    got = got.withColumn("raw_hash", F.sha2("html", 256)).withColumn("ok", ok)
    state = store.current_state(frontier.select("dataset").distinct())
    outcomes = written(S.crawl_outcomes(frontier, got, state))
    changed = (R.with_raw_keys(got.where("ok"))
               .join(outcomes.where(F.col("outcome") == "processed").select("dataset", "url"),
                     ["dataset", "url"], "left_semi"))
    store.raw.append(changed, run)
    mine = store.raw.rows().where(F.col("run") == run)      # what the run wrote: nothing is worked out again
    store.raw_index.append(mine, run)
    stamp = F.to_timestamp(F.lit(as_of))
    store.state.append(S.new_state_rows(S.keep_text_hash(mine.drop("html", "run"), state), "scraped", stamp))
    return S.outcome_counts(outcomes)


def process(store: Store, keys: DataFrame | None, as_of: str, embed=None) -> DataFrame:
    """Raw keys (default: every key of the newest run) → pages → clean →
    skip unchanged text → chunks → vectors (staging) → state; returns counts
    ``processed, skipped, failed, total, total_chunks`` per dataset.

    The run's chunks count once ``pages`` has its pages: until then, and if the job dies, those of
    the run before do.  A page that lost chunks, or all its text, loses their vectors (F12).
    ``total_chunks`` counts chunks before equal ones of two pages become one
    vector.  A page whose text is unchanged keeps its vectors and only has its
    state row marked as processed again."""
    if keys is None:
        index = store.raw_index.rows()
        last = index.agg(F.max("run")).first()[0]
        keys = index.where(F.col("run") == F.lit(last)).select("dataset", "raw_key")
    state = store.current_state(keys.select("dataset").distinct())
    pages = store.raw_pages(keys).select(
        "dataset", "url", "raw_key", "raw_hash", "html",
        (F.length(F.coalesce("html", F.lit(""))) > 0).alias("has_html"))
    done = written(S.page_outcomes(keys, clean_pages(pages), state))
    stamp = F.to_timestamp(F.lit(as_of))
    todo = done.where(F.col("outcome") == "processed")
    # keyed by the URL itself: a hash of it would let two pages' lines meet
    chunks = chunk_documents(todo, ["dataset", "url"], carry=["title"])
    run = store.pages.next_run()
    store.chunks.append(chunk_vectors(chunks, "staging", stamp, embed), run)            # vectors first
    # a page whose HTML is empty now has failed, and has no text left either
    store.pages.append(done.where("outcome = 'processed' or (not has_html and url is not null)"), run)
    fresh = done.where(F.col("outcome") != "failed")
    store.state.append(S.new_state_rows(fresh, "processed", stamp))
    n_chunks = store.chunks.rows().where(F.col("run") == run).groupBy("dataset").agg(F.count(F.lit(1)).alias("total_chunks"))
    return (S.outcome_counts(done).join(n_chunks, "dataset", "left")
            .withColumn("total_chunks", F.coalesce("total_chunks", F.lit(0).cast("bigint"))))


def with_query_embedding(df: DataFrame, embed=None) -> DataFrame:
    """Questions / golden queries without an ``embedding`` get one from the
    provider (the hashed embedding by default)."""
    if "embedding" in df.columns:
        return df
    return (embed or hashed_embedder())(df, "query", "embedding")


def evaluate(store: Store, golden: DataFrame, namespace: str = "staging", k: int = 5,
             embed=None, search=None) -> tuple[DataFrame, DataFrame]:
    """Golden queries (``qid, dataset, query, expected_citations,
    min_score``) → top-k in ``namespace`` → checks and per-dataset report.

    ``search(golden, vectors)`` replaces the retrieval: it gets the golden
    queries and the namespace's vectors and returns ``qid, rank, score, url``."""
    here = store.current_vectors(namespace)
    if search is not None:
        hits = search(golden, here)
    else:
        g = with_query_embedding(golden, embed)
        hits = Q.topk_search(g.select("qid", "dataset", F.lit(namespace).alias("namespace"),
                                      F.lit(k).alias("top_k"), "embedding"), here, k=k, payload=("url",))
    checks = EV.golden_checks(golden.drop("embedding"), hits)
    return checks, EV.eval_report(checks, store.datasets())


def validate_citations(store: Store, namespace: str = "staging") -> tuple[DataFrame, DataFrame]:
    """W3, second action: whether every chunk of a dataset has its URL, and a
    row with the issue for each chunk that has none."""
    chunks = store.current_vectors(namespace).select("dataset", "id", "url")
    return EV.citation_report(chunks), EV.uncited_chunks(chunks)


def promote_job(store: Store, report: DataFrame) -> DataFrame:
    """Copy the passed datasets' staging vectors into production, whole rows; a dataset's newest
    promotion is what production serves, so vectors that left staging leave it too."""
    run = store.production.append(promoted_rows(store.current_vectors("staging"), report))
    return promotion_result(store.production.rows().where(F.col("run") == run), report)


def retrieve(store: Store, questions: DataFrame, k: int = 5, embed=None) -> DataFrame:
    """Questions (``qid, dataset, query`` [, ``top_k``, ``namespace``]) →
    one row per question with ``results`` (rank, id, score, text, citation)
    and ``count``.  Defaults: top 5, namespace ``production``."""
    q = with_query_embedding(questions, embed)
    if "top_k" not in q.columns:
        q = q.withColumn("top_k", F.lit(k))
    vectors = store.current_vectors(None if "namespace" in q.columns else "production")
    if "namespace" not in q.columns:
        q = q.withColumn("namespace", F.lit("production"))
    hits = Q.with_citation(Q.topk_search(q, vectors, k=k, payload=("url", "title", "text")))
    per_q = hits.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct(
        "rank", "id", "score", "text", "url", "title", "citation"))).alias("results"))
    out = q.select("qid", "dataset", "query").join(per_q, "qid", "left")
    out = out.withColumn("results", F.coalesce("results", F.array().cast(per_q.schema["results"].dataType)))
    return out.withColumn("count", F.size("results").cast("bigint"))


def answer(store: Store, questions: DataFrame, use_precomputed: bool = True, embed=None,
           fact_extractor=None) -> DataFrame:
    """Stored answers where present (when ``use_precomputed``), generated
    ones for the rest; ``fact_extractor`` as in ``answers``."""
    def generate(missing: DataFrame) -> DataFrame:
        res = retrieve(store, missing, embed=embed)
        hits = res.select("qid", F.explode("results").alias("h")).select("qid", "h.*")
        return AN.answers(missing, hits, fact_extractor)

    if not use_precomputed:
        return generate(questions).withColumn("source", F.lit("generated"))
    return AN.cached_or_generated(questions, store.answers.newest(), generate)


def precompute_answers(store: Store, questions: DataFrame, embed=None, fact_extractor=None) -> int:
    """the missing caller of the answer store — generate and store, with the hits that each answer rests on;
    returns the run."""
    res = written(retrieve(store, questions, embed=embed))
    hits = res.select("qid", F.explode("results").alias("h")).select("qid", "h.*")
    ans = AN.answers(questions, hits, fact_extractor)
    run = store.answers.next_run()
    based = questions.select("qid", "dataset", AN.query_hash(F.col("query")).alias("query_hash")).join(hits.select("qid", "id", "score"), "qid")
    store.answer_hits.append(based.dropDuplicates(["dataset", "query_hash", "id"]), run)
    new = AN.answer_records(ans).join(ans.select("dataset", "query_hash", "query").distinct(), ["dataset", "query_hash"])
    # questions asked twice have one answer
    one = new.groupBy("dataset", "query_hash").agg(F.min(F.struct("json", "query")).alias("a")).select("dataset", "query_hash", "a.*")
    return store.answers.append(one, run)


#: Scores of one pair may differ by so much between runs, as sums of products are added in another order.
SAME_SCORE = 1e-9


def stale_answers(store: Store, k: int = 5, embed=None) -> DataFrame:
    """``dataset, query_hash, query`` of the stored answers that production no longer bears out: one of their
    hits is gone, or a vector that came with a later promotion belongs among them.  Only such new
    vectors are searched: of a question's best ``k + 1`` at most ``k`` are hits already, so if any other beats
    the last hit (by score, then id) or fills a free place, one is seen."""
    answers = store.answers.newest()
    hits = store.answer_hits.rows().join(answers.select("dataset", "query_hash", "run"), ["dataset", "query_hash", "run"], "left_semi")
    live = store.current_vectors("production")
    gone = hits.join(live.select("dataset", "id"), ["dataset", "id"], "left_anti").select("dataset", "query_hash")
    every = store.production.rows().select("dataset", "id", "run")
    first = every.groupBy("dataset", "id").agg(F.min("run").alias("since")).join(every.groupBy("dataset").agg(F.min("run").alias("oldest")), "dataset")
    new = live.join(first.where("since > oldest").select("dataset", "id"), ["dataset", "id"], "left_semi")
    asked = with_query_embedding(answers.select("dataset", "query_hash", "query"), embed).withColumns(
        {"qid": F.xxhash64("dataset", "query_hash"), "namespace": F.lit("production"), "top_k": F.lit(k + 1)})
    best = Q.topk_search(asked, new, k=k + 1, payload=()).select("qid", "id", "score")
    worst = F.max(F.struct((-F.col("score")).alias("score"), "id"))
    held = hits.groupBy("dataset", "query_hash").agg(F.count(F.lit(1)).alias("n"), worst.alias("last"))
    others = (asked.select("qid", "dataset", "query_hash").join(best, "qid")
              .join(hits.select("dataset", "query_hash", "id"), ["dataset", "query_hash", "id"], "left_anti")
              .join(held, ["dataset", "query_hash"], "left"))
    ahead = F.col("score") + F.col("last.score")
    enters = F.col("n").isNull() | (F.col("n") < k) | (ahead > SAME_SCORE) | ((F.abs(ahead) <= SAME_SCORE) & (F.col("id") < F.col("last.id")))
    touched = gone.unionByName(others.where(enters).select("dataset", "query_hash")).distinct()
    return answers.select("dataset", "query_hash", "query").join(touched, ["dataset", "query_hash"], "left_semi")


def refresh_answers(store: Store, embed=None, fact_extractor=None) -> DataFrame:
    """Make the stale answers anew and leave the others; returns ``dataset, query_hash`` of those made."""
    stale = written(stale_answers(store, embed=embed))
    precompute_answers(store, stale.select(F.xxhash64("dataset", "query_hash").alias("qid"), "dataset", "query"), embed, fact_extractor)
    return stale.select("dataset", "query_hash")
