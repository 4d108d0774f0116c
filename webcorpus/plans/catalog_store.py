"""Registered queries over what jobs store and change: re-crawled pages, arriving files, stored golden queries,
whole-row promotion, robots files, failing sitemaps, approximate search, pages in segments."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.operators import ann as A
from webcorpus.operators import evaluate as EV
from webcorpus.operators import promote as PR
from webcorpus.operators import search as Q
from webcorpus.operators import vectors as V
from webcorpus.operators.chunking import chunk_documents
from webcorpus.operators.segments import chunk_segments
from webcorpus.plans import oracle as O
from webcorpus.plans.catalog import CHUNK_VECTORS_SQL, PAGE_CHUNKS_SQL, _report, _staged_chunks, register
from webcorpus.session import ensure_checkpoint_dir
from webcorpus.sources import fixtures as X
from webcorpus.sources.robots import robots_allowed, robots_rules
from webcorpus.sources.sitemaps import walk_sitemaps
from webcorpus.sources.tables import written
from webcorpus.streaming.pages_stream import latest, start_page_stream


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------ robots files, failing sitemaps
@register("robots_text", O.with_ctes(
    f"SELECT dataset, url, allowed FROM {O.robots_allowed_sql('(SELECT dataset, url FROM web_pages)')}",
    "web_pages", "robots_rules"))
def q_robots_text(spark, base):
    """A4 from the robots files themselves; they say what the rules of ``robots_filter`` say."""
    rules = robots_rules(X.robots_files(spark, base), X.AGENT)
    return robots_allowed(X.web_pages(spark, base).select("dataset", "url"), rules, X.AGENT)


@register("sitemap_outcomes", O.with_ctes(f"""
SELECT dataset, 'https://' || host || '/' || name || '.xml' AS sitemap_url, outcome,
       CASE WHEN name = 'sitemap-0' THEN n ELSE 0 END AS n_urls, CASE WHEN name = 'extra_index' THEN listed ELSE 0 END AS n_children
FROM (SELECT h.dataset, h.host, h.k, p.n, 1 + CAST(h.k IN (0, 1) AS BIGINT) + CAST(h.k IN (0, 2) AS BIGINT) AS listed
      FROM (SELECT DISTINCT dataset, host, {O.hex_bucket('host', 4)} AS k FROM placed) h
      JOIN (SELECT host, count(DISTINCT url) AS n FROM placed WHERE part = 0 GROUP BY host) p USING (host)) x
JOIN (VALUES ('extra_index', 'ok', [0, 1, 2, 3]), ('sitemap-0', 'ok', [0, 1, 2, 3]), ('gone', 'missing', [0, 1]), ('broken', 'malformed', [0, 2]),
             ('none', 'missing', [3])) AS v(name, outcome, buckets) ON list_contains(v.buckets, x.k)""", "placed"))
def q_sitemap_outcomes(spark, base):
    """A2: what became of every sitemap the walk was sent to."""
    return walk_sitemaps(*X.broken_sitemaps(spark, base))[1]


# ------------------------------------------------------------ re-crawled pages
def _chunk_rows(pages: DataFrame, run: int, as_of: str) -> DataFrame:
    chunks = chunk_documents(pages, ["page_id"], carry=["dataset", "url", "title"])
    return V.chunk_vectors(chunks, "staging", F.to_timestamp(F.lit(as_of))).withColumn("run", F.lit(run).cast("long"))


RECRAWLED = "(SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '' ELSE left(text, length(text) // 2) END AS text FROM clean_pages WHERE page_id % 4 < 2)"
LIVE_CHUNKS = f"""
SELECT p.dataset, p.url, p.title, c.page_id, c.chunk_index, c.text, c.seen FROM (
  SELECT *, TIMESTAMP '{O.PREVIOUS_AS_OF}' AS seen FROM {PAGE_CHUNKS_SQL} WHERE page_id % 4 >= 2
  UNION ALL
  SELECT *, TIMESTAMP '{O.AS_OF}' AS seen FROM {O.chunks_sql(O.sections_sql(RECRAWLED, 'page_id'), 'page_id')}) c JOIN clean_pages p USING (page_id)"""


@register("vector_retire", O.with_ctes(f"""
SELECT 'staging' AS namespace, id, dataset, url, title, CAST(chunk_index AS INTEGER) AS chunk_index, sha256(text) AS text_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen DESC, url DESC, chunk_index DESC) AS rn
  FROM (SELECT *, {O.vector_id('dataset', 'text')} AS id FROM ({LIVE_CHUNKS}))) WHERE rn = 1""", "clean_pages"))
def q_vector_retire(spark, base):
    """F12 with deletes: pages are crawled again, half of them with half their text or none; the
    vectors that are left are those of each page's last text."""
    first = written(X.cleaned_pages(spark, base).select("page_id", "dataset", "url", "title", "text"))
    half = F.when(F.col("page_id") % 4 == 0, "").otherwise(F.left("text", F.floor(F.char_length("text") / 2).cast("int")))
    second = first.where("page_id % 4 < 2").withColumn("text", half)
    chunks = _chunk_rows(first, 1, X.PREVIOUS_AS_OF).unionByName(_chunk_rows(second, 2, X.AS_OF))
    pages = first.select("dataset", "url", F.lit(1).cast("long").alias("run")).unionByName(
        second.select("dataset", "url", F.lit(2).cast("long").alias("run")))
    live = V.live_vectors(chunks, pages.groupBy("dataset", "url").agg(F.max("run").alias("run")))
    return live.select("namespace", "id", "dataset", "url", "title", "chunk_index", F.sha2("text", 256).alias("text_hash"))


ARRIVED = """
(SELECT page_id, CASE WHEN page_id % 15 = 0 THEN '' WHEN page_id % 5 = 0 THEN html || '<p>Another paragraph, later still.</p>'
        WHEN page_id % 4 = 0 THEN html || '<p>A paragraph that came later.</p>' ELSE html END AS html FROM pages)"""


@register("stream_changes", O.with_ctes(f"""
SELECT 'staging' AS namespace, id, dataset, url, CAST(chunk_index AS INTEGER) AS chunk_index, sha256(text) AS text_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY url DESC, chunk_index DESC) AS rn FROM (
    SELECT c.*, p.dataset, p.url, {O.vector_id('p.dataset', 'c.text')} AS id
    FROM {O.chunks_sql(O.sections_sql(f"(SELECT page_id, {O.T.clean_html_sql('html')} AS text FROM {ARRIVED})", 'page_id'), 'page_id')} c
    JOIN web_pages p USING (page_id))) WHERE rn = 1""", "web_pages"))
def q_stream_changes(spark, base):
    """§2.9: three files arrive, an epoch each, with pages again, changed, emptied and late; what is
    stored equals one batch over each page's last state."""
    root = _folder(spark, "arrivals")
    for part in range(3):
        X.page_arrivals(spark, base).where(F.col("file") == part).drop("file").coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema = "seq long, dataset string, url string, html string"
    start_page_stream(spark, f"{root}/in", f"{root}/store", f"{root}/checkpoint", X.AS_OF, schema=schema, order_col="seq").awaitTermination()
    live = latest(spark, f"{root}/store", "vectors")
    return live.select("namespace", "id", "dataset", "url", "chunk_index", F.sha2("text", 256).alias("text_hash"))


# ------------------------------------------------------------ stored golden queries, promotion
@register("golden_store", O.with_ctes("""
SELECT dataset, query, array_to_string(expected_citations, ' ') AS expected,
       CASE WHEN dataset = 'd1' THEN 0.5 ELSE min_score END AS min_score, CAST(NULL AS VARCHAR) AS bad_line
FROM golden WHERE dataset <> 'd1' OR qid % 2 = 0
UNION ALL
SELECT dataset, NULL, NULL, NULL, '{"query": "cut off ' || CAST(qid AS VARCHAR) FROM golden WHERE dataset = 'd2' AND qid % 10 = 0""", "golden"))
def q_golden_store(spark, base):
    """A13 then A12: all datasets are stored, one is replaced, another has bad lines; then all is read back."""
    path = _folder(spark, "golden")
    golden = X.golden_queries(spark, base)
    EV.write_golden(golden, path)
    EV.write_golden(golden.where("dataset = 'd1' and qid % 2 = 0").withColumn("min_score", F.lit(0.5)), path)
    cut = F.concat(F.lit('{"query": "cut off '), F.col("qid").cast("string"))
    golden.where("dataset = 'd2' and qid % 10 = 0").select("dataset", cut.alias("line")).write.mode("append").partitionBy("dataset").text(path)
    good, bad = EV.read_golden(spark, path)
    none = F.lit(None).cast("string")
    return good.select("dataset", "query", F.array_join("expected_citations", " ").alias("expected"), "min_score", none.alias("bad_line")).unionByName(
        bad.select("dataset", none.alias("query"), none.alias("expected"), F.lit(None).cast("double").alias("min_score"), F.col("line").alias("bad_line")))


@register("promote_vectors", O.with_ctes(f"""
SELECT id, dataset, url, title, CAST(chunk_index AS INTEGER) AS chunk_index, sha256(text) AS text_hash, n_set FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, url DESC, chunk_index DESC) AS rn FROM (
    SELECT id, dataset, url, title, chunk_index, updated_at, text, {O.n_set('embedding')} AS n_set FROM vectors
    WHERE namespace = 'production' OR dataset IN (SELECT dataset FROM report WHERE passed)
    UNION ALL
    SELECT id, dataset, url, title, chunk_index, updated_at, text, {O.n_buckets('text')} FROM {CHUNK_VECTORS_SQL}
    WHERE dataset IN (SELECT dataset FROM report WHERE passed))) WHERE rn = 1""", "vectors", "clean_pages", "report"))
def q_promote_vectors(spark, base):
    """Production after the promotion, whole rows; text and embedding by hash and entries that are not 0."""
    vectors = V.upsert_vectors(X.vectors(spark, base), _staged_chunks(spark, base))
    snapshot, _ = PR.promote(vectors, _report(spark, base))
    return snapshot.where("namespace = 'production'").select(
        "id", "dataset", "url", "title", "chunk_index", F.sha2("text", 256).alias("text_hash"),
        F.size(F.filter("embedding", lambda x: x != 0)).cast("bigint").alias("n_set"))


# ------------------------------------------------------------ search
@register("topk_single", O.with_ctes(f"""
SELECT rank, id, round(score, 6) AS score, url FROM {O.topk_sql(
    "(SELECT qid, dataset, 'staging' AS namespace, 10 AS top_k, embedding FROM golden WHERE qid = (SELECT min(qid) FROM golden))",
    "(SELECT * FROM vectors WHERE lang = 'en')", 10, 'v.url')}""", "golden", "vectors"))
def q_topk_single(spark, base):
    """K2: one query vector (that of the first golden query) against its dataset, filtered."""
    one = X.golden_queries(spark, base).select("qid", "dataset", "embedding").orderBy("qid").first()
    hits = Q.topk_one(X.vectors(spark, base), one.embedding, one.dataset, "staging", 10, {"lang": "en"}, ("url",))
    return hits.select("rank", "id", F.round("score", 6).alias("score"), "url")


@register("approx_topk")
def q_approx_topk(spark, base):
    """J4/K3 through the index (operators/ann.py): every golden query, top 5 in staging.  No SQL: tests measure its
    recall against ``topk_per_query``."""
    vectors = written(X.vectors(spark, base).select("namespace", "dataset", "id", "embedding", "url"))
    queries = X.golden_queries(spark, base).select("qid", "dataset", F.lit("staging").alias("namespace"), F.lit(5).alias("top_k"), "embedding")
    model = A.fit(vectors)
    index = written(A.build_index(vectors, model))
    probes = A.calibrate(queries, vectors, index, model)
    hits = A.approx_search(queries, vectors, index, model, probes, k=5, payload=("url",))
    return hits.select("qid", "rank", "id", F.round("score", 6).alias("score"), "url")


# ------------------------------------------------------------ pages in segments
@register("chunks_segmented", O.with_ctes(f"""
SELECT doc_id, chunk_index, text, n_tokens, n_items, n_tokens > {O.MAX_TOKENS} AS oversize
FROM {O.chunks_sql(O.sections_sql('sdocs', 'doc_id'), 'doc_id')}""", "sdocs"))
def q_chunks_segmented(spark, base):
    """S1 + S2 with every document in segments of 16 lines, so that states pass from segment to segment."""
    return chunk_segments(X.structured_documents(spark, base), ["doc_id"], segment=16)
