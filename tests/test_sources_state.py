"""A1–A4 sources, P1, J1–J3, A10, A11, G1/G2 properties."""

from pyspark.sql import functions as F

from tests.conftest import SF01
from webcorpus.operators import state as S
from webcorpus.sources import fixtures as X
from webcorpus.sources.robots import robots_allowed
from webcorpus.sources.seeds import same_domain, seed_urls
from webcorpus.sources.sitemaps import expand_sitemaps, sitemap_urls

NS = "http://www.sitemaps.org/schemas/sitemap/0.9"


def test_sitemap_scan_and_cyclic_index(spark):
    docs = spark.createDataFrame([
        ("i", f'<sitemapindex xmlns="{NS}"><sitemap><loc>s1</loc></sitemap>'
              f'<sitemap><loc>i</loc></sitemap><sitemap><loc>j</loc></sitemap></sitemapindex>'),
        ("j", f'<sitemapindex xmlns="{NS}"><sitemap><loc>i</loc></sitemap><sitemap><loc>s2</loc></sitemap></sitemapindex>'),
        ("s1", f'<urlset xmlns="{NS}"><url><loc>https://a/x?p=1&amp;q=2</loc></url><url><loc>https://a/y</loc></url></urlset>'),
        ("s2", f'<urlset xmlns="{NS}"><url><loc>https://a/y</loc></url><url><loc>https://b/z</loc></url></urlset>'),
    ], "sitemap_url string, xml string")
    assert sorted(r["url"] for r in sitemap_urls(docs.where("sitemap_url = 's1'")).collect()) == [
        "https://a/x?p=1&q=2", "https://a/y"]
    seeds = spark.createDataFrame([("d", "i")], "dataset string, sitemap_url string")
    got = sorted(r["url"] for r in expand_sitemaps(seeds, docs).collect())
    assert got == ["https://a/x?p=1&q=2", "https://a/y", "https://b/z"]


def test_seed_dedup_and_same_domain(spark):
    seeds = spark.createDataFrame([("d", "urls", "https://a/1"), ("d", "url", "https://a/1"),
                                   ("e", "urls", "https://a/1"), ("d", "sitemap", "https://a/s.xml")],
                                  "dataset string, source_type string, source string")
    assert seed_urls(seeds).count() == 2
    urls = spark.createDataFrame([("d", "https://a/1"), ("d", "https://a:81/2"), ("d", "https://A/3")],
                                 "dataset string, url string")
    base = spark.createDataFrame([("d", "https://a/")], "dataset string, base_url string")
    assert [r["url"] for r in same_domain(urls, base).collect()] == ["https://a/1"]


def test_robots_outcomes_and_agent_groups(spark):
    rules = spark.createDataFrame([
        ("h1", "*", 0, True, "/fr/1", "ok"), ("h1", "*", 1, False, "/fr", "ok"),
        ("h2", "*", 0, False, "/", "ok"), ("h2", "WebCorpusBot", 0, False, "/private", "ok"),
        ("h3", None, None, None, None, "unreachable"), ("h4", None, None, None, None, "missing"),
        ("h5", None, None, None, None, "denied"), ("h6", None, None, None, None, "ok"),
        ("h7", "otherbot", 0, False, "/", "ok"),
    ], "host string, agent string, seq int, allow boolean, path_prefix string, outcome string")
    urls = [("https://h1/fr/12", True), ("https://h1/fr/2", False), ("https://h1/en", True),
            ("https://h2/x", True), ("https://h2/private/a", False), ("https://h3/a", False),
            ("https://h4/a", True), ("https://h5/a", False), ("https://h6/a", True),
            ("https://h7/a", True), ("https://h8/a", False)]
    df = spark.createDataFrame(urls, "url string, want boolean")
    got = robots_allowed(df, rules, "webcorpusbot").collect()
    assert {r["url"]: r["allowed"] for r in got} == {u: w for u, w in urls}


def test_rerun_of_processing_is_a_no_op(spark):
    from webcorpus.streaming.pages_stream import STATE_SCHEMA, VECTOR_SCHEMA, process_pages
    pages = X.web_pages(spark, SF01).limit(30)
    empty_state = spark.createDataFrame([], STATE_SCHEMA)
    empty_vec = spark.createDataFrame([], VECTOR_SCHEMA)
    vec1, state1 = process_pages(pages, empty_state, empty_vec, X.AS_OF)
    state1 = state1.cache()
    vec1 = vec1.cache()
    from webcorpus.operators.cleaning import clean_pages
    assert S.process_delta(clean_pages(pages), state1).count() == 0
    vec2, state2 = process_pages(pages, state1, vec1, X.AS_OF)
    assert vec2.count() == vec1.count() and state2.count() == state1.count() == 30


def test_counts_add_up(spark):
    import __spark_entry__ as E
    for key in ("crawl_counts", "process_counts"):
        for r in E.queries()[key](spark, SF01).collect():
            assert r["processed"] + r["skipped"] + r["failed"] == r["total"]


def test_upsert_latest_wins(spark):
    old = spark.createDataFrame([("k", "d", "u", None, None, "t1", None, "scraped", "2024-01-01")],
                                "key string, dataset string, url string, url_hash string, raw_hash string, "
                                "text_hash string, raw_key string, status string, updated_at string") \
        .withColumn("updated_at", F.to_timestamp("updated_at"))
    new = old.withColumn("status", F.lit("processed")).withColumn("text_hash", F.lit("t2"))
    got = S.upsert_state(old, new).collect()
    assert len(got) == 1 and got[0]["status"] == "processed" and got[0]["text_hash"] == "t2"
