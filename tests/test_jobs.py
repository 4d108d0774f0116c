"""W1–W6 end to end on sf0.001, then an unchanged re-run."""

import re
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF001
from webcorpus.plans import jobs as J
from webcorpus.sources import fixtures as X


def test_jobs_end_to_end(spark):
    store = J.Store(spark, tempfile.mkdtemp(prefix="wc-jobs-"))
    args = dict(seeds=X.url_seeds(spark, SF001).unionByName(X.sitemap_seeds(spark, SF001)),
                sitemaps=X.sitemap_documents(spark, SF001), base_urls=X.dataset_base_urls(spark, SF001),
                fetched=X.fetched_pages(spark, SF001), rules=X.robots_rules(spark, SF001),
                agent=X.AGENT)
    c1 = {r["dataset"]: r for r in J.harvest(store, run=1, as_of="2024-01-01 00:00:00", **args).collect()}
    assert sum(r["processed"] for r in c1.values()) > 0
    assert all(r["processed"] + r["skipped"] + r["failed"] == r["total"] for r in c1.values())

    p1 = {r["dataset"]: r for r in J.process(store, None, "2024-01-01 00:00:01").collect()}
    processed = sum(r["processed"] for r in p1.values())
    assert processed == sum(r["processed"] for r in c1.values())
    assert sum(r["total_chunks"] for r in p1.values()) == store.current_vectors().count()

    # golden queries: chunk texts must find their own page
    staged = store.current_vectors("staging")
    golden = (staged.groupBy("dataset").agg(F.min_by(F.struct("text", "url"), "id").alias("g"))
              .select(F.xxhash64("dataset").alias("qid"), "dataset", F.col("g.text").alias("query"),
                      F.array("g.url").alias("expected_citations"), F.lit(None).cast("double").alias("min_score")))
    checks, report = J.evaluate(store, golden)
    assert all(r["passed"] for r in checks.collect()), checks.collect()
    result = {r["dataset"]: r for r in J.promote_job(store, report).collect()}
    assert all(r["success"] and r["n_copied"] > 0 for r in result.values())
    # whole rows are copied: text, embedding and all
    copied = store.current_vectors("production").drop("namespace")
    assert copied.count() == staged.count() and copied.exceptAll(staged.drop("namespace")).isEmpty()

    questions = golden.select("qid", "dataset", "query")
    res = J.retrieve(store, questions).collect()
    own = {r["qid"]: r for r in golden.collect()}
    for r in res:
        assert r["count"] >= 1 and r["results"][0]["citation"]["url"] == own[r["qid"]]["expected_citations"][0]

    J.precompute_answers(store, questions)
    ans = J.answer(store, questions).collect()
    assert {r["source"] for r in ans} == {"cache"} and all(r["summary"] is not None for r in ans)

    # the same crawl again: nothing changed, nothing processed
    c2 = J.harvest(store, run=2, as_of="2024-01-02 00:00:00", **args).collect()
    assert sum(r["processed"] for r in c2) == 0
    assert sum(r["skipped"] for r in c2) == sum(r["processed"] for r in c1.values())


PAGE = "<title>{t}</title><body><h1>Head</h1><p>{p}</p></body>"
SAME = "The very same paragraph stands on two pages of this site, word for word."


def crawl(spark, store, pages, run):
    """One harvest of ``pages`` (url → html) of dataset ``a:b``, and its processing."""
    fetched = spark.createDataFrame([("a:b", u, h, "text/html") for u, h in pages.items()],
                                    "dataset string, url string, html string, content_type string")
    seeds = fetched.select("dataset", F.lit("url").alias("source_type"), F.col("url").alias("source"))
    rules = spark.createDataFrame([("h.org", "*", 0, None, None, "missing")], "host string, agent string, seq int, allow boolean, path_prefix string, outcome string")
    maps = spark.createDataFrame([], "sitemap_url string, xml string")
    bases = spark.createDataFrame([("a:b", "https://h.org/")], "dataset string, base_url string")
    c = J.harvest(store, seeds, maps, bases, fetched, rules, agent="bot", run=run, as_of=f"2024-01-0{run} 00:00:00")
    p = J.process(store, None, f"2024-01-0{run} 01:00:00")
    return c.collect()[0].asDict(), p.collect()[0].asDict()


def test_recrawl_skips_equal_text(spark):
    store = J.Store(spark, tempfile.mkdtemp(prefix="wc-jobs-"))
    u = [f"https://h.org/{i}" for i in range(4)]
    first = {u[0]: PAGE.format(t="x", p=SAME), u[1]: PAGE.format(t="x", p=SAME),
             u[2]: PAGE.format(t="x", p="Another text that will change with the next crawl of it."), u[3]: ""}
    c, p = crawl(spark, store, first, 1)
    assert (c["processed"], c["failed"]) == (4, 0)
    # an empty page fails; two equal chunks count as two and are one vector
    assert p == {"dataset": "a:b", "processed": 3, "skipped": 0, "failed": 1, "total": 4, "total_chunks": 3}
    assert store.current_vectors().count() == 2
    # other HTML with the same text is fetched but not processed; a changed text is
    second = {**first, u[0]: PAGE.format(t="x", p=SAME).replace("<p>", "<p class='new'>"),
              u[2]: PAGE.format(t="x", p="A different text, as promised, at the same address.")}
    c, p = crawl(spark, store, second, 2)
    assert (c["processed"], c["skipped"]) == (2, 2)
    assert (p["processed"], p["skipped"], p["failed"], p["total_chunks"]) == (1, 1, 0, 1)
    state = {r["url"]: r for r in store.current_state().collect()}
    assert len(state) == 4 and {state[x]["status"] for x in u[:3]} == {"processed"}
    assert state[u[0]]["text_hash"] == state[u[1]]["text_hash"] and state[u[0]]["raw_hash"] != state[u[1]]["raw_hash"]
    # once more the same: nothing fetched anew, the newest run has no page left to process
    assert crawl_counts_only(store, spark, second)["skipped"] == 3


def crawl_counts_only(store, spark, pages):
    """Processing every raw key again skips all pages that have text."""
    keys = store.raw.rows().select("dataset", "raw_key").distinct()
    return J.process(store, keys, "2024-01-03 01:00:00").collect()[0].asDict()


def test_hooks_and_citations(spark):
    store = J.Store(spark, tempfile.mkdtemp(prefix="wc-jobs-"))
    crawl(spark, store, {"https://h.org/1": PAGE.format(t="One", p=SAME)}, 1)
    golden = spark.createDataFrame([(1, "a:b", "q", ["https://h.org/1"], None)],
                                   "qid long, dataset string, query string, expected_citations array<string>, min_score double")

    def search(g, vectors):
        return g.join(vectors, "dataset").select("qid", F.lit(1).alias("rank"), F.lit(0.9).alias("score"), "url")

    checks, report = J.evaluate(store, golden, search=search)
    assert checks.first()["top_score"] == 0.9 and report.first()["passed"]
    J.promote_job(store, report).collect()
    ans = J.answer(store, golden.select("qid", "dataset", "query"), fact_extractor=lambda t: F.array(F.upper(F.substring(t, 1, 3)))).first()
    assert [c["fact"] for c in ans["fact_cards"]] == ["ONE"]
    good, issues = J.validate_citations(store)
    assert good.first()["passed"] and issues.count() == 0


def test_changed_pages_lose_their_old_vectors(spark):
    """chunks that left a page, pages that lost all text, and a chunk that another page still holds."""
    store = J.Store(spark, tempfile.mkdtemp(prefix="wc-jobs-"))
    u = [f"https://h.org/{i}" for i in range(4)]
    first = {u[0]: PAGE.format(t="x", p=SAME), u[1]: PAGE.format(t="x", p=SAME), u[2]: PAGE.format(t="x", p="A text that will go."),
             u[3]: PAGE.format(t="x", p="A text that will be replaced.")}
    crawl(spark, store, first, 1)
    held = {r["url"] for r in store.current_vectors("staging").collect()}
    assert held == {u[1], u[2], u[3]}      # of two holders of one chunk the greater URL is cited
    second = {**first, u[1]: PAGE.format(t="x", p="The greater URL now holds another text."), u[2]: "",
              u[3]: PAGE.format(t="x", p="The text that replaced it.")}
    crawl(spark, store, second, 2)
    now = {r["url"]: r["text"] for r in store.current_vectors("staging").collect()}
    assert set(now) == {u[0], u[1], u[3]} and SAME in now[u[0]] and "replaced it" in now[u[3]]
    # a processing run that died before its pages were written is not seen
    run = store.pages.next_run()
    store.chunks.append(store.chunks.rows().withColumn("text", F.lit("half done")), run)
    assert {r["text"] for r in store.current_vectors("staging").collect()} == set(now.values())


def test_answers_are_made_anew_only_where_touched(spark):
    store = J.Store(spark, tempfile.mkdtemp(prefix="wc-jobs-"))
    u = [f"https://h.org/{i}" for i in range(8)]
    page = {x: PAGE.format(t="x", p=f"{w} " * 30 + "ends here.") for x, w in zip(u, "apple bear cedar dune eagle flint grape heron".split())}
    report = spark.createDataFrame([("a:b", True)], "dataset string, passed boolean")
    crawl(spark, store, page, 1)
    J.promote_job(store, report).collect()
    asked = spark.createDataFrame([(i, "a:b", f"{w} {w}") for i, w in enumerate(("apple", "heron", "dune"))], "qid long, dataset string, query string")
    J.precompute_answers(store, asked)
    assert J.stale_answers(store).count() == 0
    crawl(spark, store, {**page, u[7]: PAGE.format(t="x", p="heron heron stays by the water and is seen at dawn.")}, 2)
    J.promote_job(store, report).collect()
    live = store.current_vectors("production")
    fresh = {r["qid"]: {h["id"] for h in r["results"]} for r in J.retrieve(store, asked).collect()}
    stored = {}
    for r in store.answer_hits.rows().collect():
        stored.setdefault(r["query_hash"], set()).add(r["id"])
    hashes = {r["qid"]: r["h"] for r in asked.select("qid", F.substring(F.sha2("query", 256), 1, 16).alias("h")).collect()}
    changed = {hashes[q] for q in fresh if fresh[q] != stored[hashes[q]]}
    assert changed and {r["query_hash"] for r in J.refresh_answers(store).collect()} == changed
    assert J.stale_answers(store).count() == 0 and live.count() == 8
    runs = {r["query_hash"]: r["run"] for r in store.answers.newest().collect()}
    assert {h for h, run in runs.items() if run == 2} == changed


def test_raw_reads_open_only_the_runs_they_need(spark):
    store = J.Store(spark, tempfile.mkdtemp(prefix="wc-jobs-"))
    for run, names in ((1, "abc"), (2, "b"), (3, "c")):      # pages b and c change later
        pages = spark.createDataFrame([("d", x, f"d/{x}", "h", f"{x} of {run}") for x in names], "dataset string, url string, raw_key string, raw_hash string, html string")
        store.raw.append(pages, run)
        store.raw_index.append(pages, run)
    read = store.raw_pages(store.raw_index.rows().where("raw_key = 'd/c'").select("dataset", "raw_key"))
    assert [r["html"] for r in read.collect()] == ["c of 3"]
    assert re.search(r"PartitionFilters: \[[^\]]*\(run#\d+L = 3\)", read._jdf.queryExecution().executedPlan().toString())
    every = store.raw_pages(store.raw_index.rows().select("dataset", "raw_key"))
    assert sorted(r["html"] for r in every.collect()) == ["a of 1", "b of 2", "c of 3"]


def test_runs_replace_by_key(spark, tmp_path):
    """A key's newest run counts; a replayed run replaces itself; names are escaped; torn writes are not seen."""
    from webcorpus.sources.runs import RunTable
    t = RunTable(spark, str(tmp_path / "t"), T.StructType.fromDDL("dataset string, x int"), ("dataset",), ("dataset",))

    def rows(*pairs):
        return spark.createDataFrame(pairs, "dataset string, x int")

    def content():
        return sorted(map(tuple, t.newest().select("dataset", "x").collect()))

    assert content() == [] and t.next_run() == 1
    assert t.append(rows(("a:b", 1), ("a:b", 5), ("c", 1))) == 1
    assert t.append(rows(("a:b", 2))) == 2
    assert content() == [("a:b", 2), ("c", 1)]
    t.append(rows(("a:b", 3)), run=2)
    assert content() == [("a:b", 3), ("c", 1)] and t.next_run() == 3
    t.append(rows(), run=3)
    assert content() == [("a:b", 3), ("c", 1)]
    (tmp_path / "t" / ".spark-staging-dead" / "run=9" / "dataset=c").mkdir(parents=True)
    rows(("c", 9)).select("x").write.parquet(str(tmp_path / "t" / "_temporary" / "run=9" / "dataset=c"))
    assert content() == [("a:b", 3), ("c", 1)]
