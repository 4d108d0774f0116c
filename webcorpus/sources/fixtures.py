"""Engine inputs derived from the driver tables (seeds, sitemaps, robots
rules, fetched pages, previous state, vectors, golden queries, questions).

Every recipe is a plain DataFrame expression over the given tables, so the
work grows with them; the DuckDB oracle rebuilds each one in SQL
(``webcorpus.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.keys import hex_bucket, url_hash
from webcorpus.functions.text import authority
from webcorpus.sources.tables import read_table, spread

# Fixed values used by the recipes.
AGENT = "webcorpusbot"
AS_OF = "2024-01-01 00:00:00"
PREVIOUS_AS_OF = "2023-12-01 00:00:00"
SITEMAP_NS = "http://www.sitemaps.org/schemas/sitemap/0.9"
SITEMAP_MAX_URLS = 50000          # sitemap protocol limit per file
ZERO_HASH = "0" * 64


def page_dataset(page_id: Column) -> Column:
    return F.concat(F.lit("site"), (page_id % 2).cast("string"))


def web_pages(spark: SparkSession, base: str) -> DataFrame:
    """``pages`` with a dataset name: ``page_id, dataset, url, html``."""
    pages = spread(read_table(spark, base, "pages", ["page_id", "url", "html"]), "page_id")
    return pages.select("page_id", page_dataset(F.col("page_id")).alias("dataset"), "url", "html")


def fetched_pages(spark: SparkSession, base: str) -> DataFrame:
    """Fetch results as a table: the page plus the response content type."""
    pid = F.col("page_id")
    ctype = (F.when(pid % 10 == 0, F.lit("application/pdf"))
             .when(pid % 10 == 1, F.lit("Text/HTML; charset=utf-8"))
             .otherwise(F.lit("text/html")))
    return web_pages(spark, base).withColumn("content_type", ctype)


def structured_documents(spark: SparkSession, base: str) -> DataFrame:
    """``documents`` with line prefixes by position: 1 ``# ``, 2 ``- ``,
    3 ``1. ``, 4 ``a) ``, 5 `` | `` appended, 6 a blank line before, 0 as is."""
    docs = spread(read_table(spark, base, "documents", ["doc_id", "text"]), "doc_id")

    def mark(line, i):
        m = i % 7
        return (F.when(m == 1, F.concat(F.lit("# "), line))
                .when(m == 2, F.concat(F.lit("- "), line))
                .when(m == 3, F.concat(F.lit("1. "), line))
                .when(m == 4, F.concat(F.lit("a) "), line))
                .when(m == 5, F.concat(line, F.lit(" | ")))
                .when(m == 6, F.concat(F.lit("\n"), line))
                .otherwise(line))

    text = F.array_join(F.transform(F.split("text", "\n"), mark), "\n")
    return docs.select("doc_id", text.alias("text"))


def url_seeds(spark: SparkSession, base: str) -> DataFrame:
    """``url``/``urls`` seeds: every page URL, and a repeat of every fifth."""
    pages = web_pages(spark, base)
    once = pages.select("dataset", F.lit("urls").alias("source_type"), F.col("url").alias("source"))
    again = (pages.where(F.col("page_id") % 5 == 0)
             .select("dataset", F.lit("url").alias("source_type"), F.col("url").alias("source")))
    return once.unionByName(again)


def _xml_escape(col: Column) -> Column:
    return F.replace(F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")),
                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def sitemap_documents(spark: SparkSession, base: str) -> DataFrame:
    """``sitemap_url, xml``: per host, ``urlset`` files of at most 50,000 URLs
    (hash-split), and one ``sitemapindex`` listing them — and itself, so
    expansion must guard against cycles."""
    pages = web_pages(spark, base).select("url", authority(F.col("url")).alias("host"))
    per_host = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    files = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(SITEMAP_MAX_URLS)))
    placed = (pages.join(per_host, "host")
              .withColumn("part", F.pmod(F.conv(F.substring(F.sha2("url", 256), 1, 8), 16, 10)
                                         .cast("bigint"), files.cast("bigint"))))
    chunk_url = F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap-"),
                         F.col("part").cast("string"), F.lit(".xml"))
    urlsets = (placed.groupBy("host", "part")
               .agg(F.array_join(F.array_sort(F.collect_list(
                   F.concat(F.lit("<url><loc>"), _xml_escape(F.col("url")), F.lit("</loc></url>")))),
                   "").alias("body"))
               .select(chunk_url.alias("sitemap_url"),
                       F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="{SITEMAP_NS}">'),
                                F.col("body"), F.lit("</urlset>")).alias("xml")))
    index_url = F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap_index.xml"))
    parts = per_host.select("host", F.explode(F.sequence(F.lit(0), files.cast("int") - 1)).alias("part"))
    entries = F.concat(F.lit("<sitemap><loc>"), chunk_url, F.lit("</loc></sitemap>"))
    indexes = (parts.groupBy("host")
               .agg(F.array_join(F.array_sort(F.collect_list(entries)), "").alias("body"))
               .select(index_url.alias("sitemap_url"),
                       F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><sitemapindex xmlns="{SITEMAP_NS}">'),
                                F.col("body"),
                                F.lit("<sitemap><loc>"), index_url, F.lit("</loc></sitemap>"),
                                F.lit("</sitemapindex>")).alias("xml")))
    return urlsets.unionByName(indexes)


def sitemap_seeds(spark: SparkSession, base: str) -> DataFrame:
    """One ``sitemap`` seed per dataset and host: the host's index."""
    pages = web_pages(spark, base)
    return (pages.select("dataset", authority(F.col("url")).alias("host")).distinct()
            .select("dataset", F.lit("sitemap").alias("source_type"),
                    F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap_index.xml")).alias("source")))


def dataset_base_urls(spark: SparkSession, base: str) -> DataFrame:
    """``dataset, base_url``: the URL with the smallest ``page_id`` per dataset."""
    pages = web_pages(spark, base)
    return pages.groupBy("dataset").agg(F.min_by("url", "page_id").alias("base_url"))


# Robots rule templates by host bucket (hash mod 8):
# (bucket, agent, seq, allow, path_prefix, outcome).
ROBOTS_TEMPLATES = [
    (0, None, None, None, None, "unreachable"),
    (1, "*", 0, True, "/fr/1", "ok"),
    (1, "*", 1, False, "/fr", "ok"),
    (2, None, None, None, None, "ok"),
    (3, "*", 0, False, "/", "ok"),
    (4, None, None, None, None, "unreachable"),
    (5, "*", 0, True, "/fr/1", "ok"),
    (5, "*", 1, False, "/fr", "ok"),
    (6, None, None, None, None, "ok"),
    (7, "*", 0, False, "/", "ok"),
    (7, AGENT, 0, False, "/fr", "ok"),
]
ROBOTS_SCHEMA = ("bucket int, agent string, seq int, allow boolean, path_prefix string, "
                 "outcome string")


def robots_rules(spark: SparkSession, base: str) -> DataFrame:
    """``host, agent, seq, allow, path_prefix, outcome``: every page host gets
    the templates of its bucket — robots unreadable (0, 4), allow ``/fr/1``
    then disallow ``/fr`` (1, 5), readable without rules (2, 6), disallow
    everything (3), disallow everything for ``*`` but an own-agent group that
    only disallows ``/fr`` (7)."""
    hosts = web_pages(spark, base).select(authority(F.col("url")).alias("host")).distinct()
    templates = spark.createDataFrame(ROBOTS_TEMPLATES, ROBOTS_SCHEMA)
    return (hosts.withColumn("bucket", hex_bucket(F.col("host"), 8).cast("int"))
            .join(F.broadcast(templates), "bucket")
            .select("host", "agent", "seq", "allow", "path_prefix", "outcome"))


#: Robots files by host bucket (hash mod 8), saying what the rule templates say.
ROBOTS_FILES = {
    1: "# every robot\nUser-Agent: *   # all\nAllow: /fr/1\nDisallow: /fr\n",
    2: "Disallow: /outside-a-group\n\nUser-agent: *\n\nDisallow: /after-an-empty-line\nSitemap: /sitemap.xml\n",
    3: "user-agent: otherbot\ndisallow: /other\n\nUSER-AGENT : *\nno field here\ndisallow : /\n",
    5: "User-agent: thirdbot\nUser-agent: *\nCrawl-delay: 5\n# a comment isn't an empty line\nAllow: /fr/1\nDisallow: /fr\nUser-agent: *\nDisallow: /\n",
    6: "",
    7: "User-agent: *\nDisallow: /\n\nUser-agent: lastbot\nUser-agent: WebCorpus\nDisallow: /fr\nRequest-rate: 1/5\n\nUser-agent: webcorpusbot\nDisallow: /\n",
}


def robots_files(spark: SparkSession, base: str) -> DataFrame:
    """``host, text, outcome``: every page host with the robots file of its bucket; none was read in buckets 0 and 4."""
    hosts = web_pages(spark, base).select(authority(F.col("url")).alias("host")).distinct()
    bucket = hex_bucket(F.col("host"), 8)
    text = F.lit(None).cast("string")
    for b, body in ROBOTS_FILES.items():
        text = F.when(bucket == b, F.lit(body)).otherwise(text)
    return hosts.select("host", text.alias("text"), F.when(text.isNull(), "unreachable").otherwise("ok").alias("outcome"))


def broken_sitemaps(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """``(seeds, sitemaps)`` with failures: every host has an extra index that lists the host's first
    ``urlset``, and by host bucket (mod 4) a sitemap that isn't there (0, 1) or is cut off (0, 2); in bucket 3 a seed
    that isn't there."""
    hosts = web_pages(spark, base).select("dataset", authority(F.col("url")).alias("host")).distinct()
    k = hex_bucket(F.col("host"), 4)

    def at(name: str) -> Column:
        return F.concat(F.lit("https://"), F.col("host"), F.lit(f"/{name}.xml"))

    def entry(name: str) -> Column:
        return F.concat(F.lit("<sitemap><loc> "), at(name), F.lit(" </loc></sitemap>"))

    body = F.concat(F.lit(f'<sitemapindex xmlns="{SITEMAP_NS}">'), entry("sitemap-0"), F.when(k.isin(0, 1), entry("gone")).otherwise(""),
                    F.when(k.isin(0, 2), entry("broken")).otherwise(""), F.lit("</sitemapindex>"))
    one = hosts.select("host").distinct()
    cut = F.concat(F.lit("<urlset><url><loc>"), at("never"), F.lit("</loc>"))
    docs = one.select(at("extra_index").alias("sitemap_url"), body.alias("xml")).unionByName(
        one.where(k.isin(0, 2)).select(at("broken").alias("sitemap_url"), cut.alias("xml")))
    seeds = hosts.select("dataset", at("extra_index").alias("sitemap_url")).unionByName(
        hosts.where(k == 3).select("dataset", at("none").alias("sitemap_url")))
    return seeds, docs.unionByName(sitemap_documents(spark, base))


def page_arrivals(spark: SparkSession, base: str) -> DataFrame:
    """Pages as they arrive, ``seq, dataset, url, html, file``: all in file 0; every second once more in file 1, its
    HTML unchanged (page_id % 4 = 2) or with a paragraph more (0); every fifth in file 2, emptied (page_id % 15 = 0) or with
    another paragraph; and every seventh page's first state again in file 2, late (its number is that of file 0)."""
    p = web_pages(spark, base)
    n = 10_000_000_000
    more = F.concat("html", F.lit("<p>A paragraph that came later.</p>"))
    other = F.when(F.col("page_id") % 15 == 0, "").otherwise(F.concat("html", F.lit("<p>Another paragraph, later still.</p>")))
    first = p.select(F.col("page_id").alias("seq"), "dataset", "url", "html", F.lit(0).alias("file"))
    again = p.where("page_id % 2 = 0").select((F.col("page_id") + n).alias("seq"), "dataset", "url",
                                              F.when(F.col("page_id") % 4 == 0, more).otherwise(F.col("html")).alias("html"), F.lit(1).alias("file"))
    third = p.where("page_id % 5 = 0").select((F.col("page_id") + 2 * n).alias("seq"), "dataset", "url", other.alias("html"), F.lit(2).alias("file"))
    late = first.where("seq % 7 = 0").withColumn("file", F.lit(2))
    return first.unionByName(again).unionByName(third).unionByName(late)


def previous_crawl_state(spark: SparkSession, base: str) -> DataFrame:
    """State left by an earlier crawl: page_id % 3 = 0 same raw hash,
    1 another hash, 2 no row."""
    pages = web_pages(spark, base).where(F.col("page_id") % 3 != 2)
    raw_hash = F.when(F.col("page_id") % 3 == 0, F.sha2("html", 256)).otherwise(F.lit(ZERO_HASH))
    return _state_rows(pages, raw_hash, F.lit(None).cast("string"), F.lit("scraped"))


def _state_rows(pages: DataFrame, raw_hash: Column, text_hash: Column, status: Column) -> DataFrame:
    from webcorpus.functions.keys import raw_key, state_key
    return pages.select(
        state_key(F.col("dataset"), F.col("url")).alias("key"), "dataset", "url",
        url_hash(F.col("url")).alias("url_hash"), raw_hash.alias("raw_hash"),
        text_hash.alias("text_hash"),
        raw_key(F.col("dataset"), F.col("url")).alias("raw_key"), status.alias("status"),
        F.to_timestamp(F.lit(PREVIOUS_AS_OF)).alias("updated_at"))


def vectors(spark: SparkSession, base: str) -> DataFrame:
    """The ``vectors`` table from ``embeddings``: even ids in production, odd in
    staging; dataset ``d<label % 3>``; text from the document of the same id;
    every 17th URL empty."""
    emb = spread(read_table(spark, base, "embeddings", ["vec_id", "embedding", "label"]), "vec_id")
    docs = read_table(spark, base, "documents", ["doc_id", "text", "lang"])
    vid = F.col("vec_id")
    joined = emb.join(docs, emb.vec_id == docs.doc_id, "left")
    dataset = F.concat(F.lit("d"), (F.col("label") % 3).cast("string"))
    return joined.select(
        F.when(vid % 2 == 0, F.lit("production")).otherwise(F.lit("staging")).alias("namespace"),
        F.substring(F.sha2(F.concat_ws(":", dataset, vid.cast("string")), 256), 1, 32).alias("id"),
        "vec_id", "embedding",
        F.coalesce(F.col("text"), F.lit("")).alias("text"), dataset.alias("dataset"),
        F.when(vid % 17 == 0, F.lit("")).otherwise(
            F.concat(F.lit("https://example.org/"), vid.cast("string"))).alias("url"),
        F.concat(F.lit("Doc "), vid.cast("string")).alias("title"),
        F.lit(0).alias("chunk_index"), "lang",
        F.to_timestamp(F.lit(PREVIOUS_AS_OF)).alias("updated_at"))


def golden_queries(spark: SparkSession, base: str) -> DataFrame:
    """Every embedding is a golden query of its dataset: the expected citation
    is its own URL, plus a URL that does not exist for every third; min_score
    is null (0.7 applies) except 1.01 for every fourth."""
    emb = read_table(spark, base, "embeddings", ["vec_id", "embedding", "label"])
    vid = F.col("vec_id")
    own = F.when(vid % 17 == 0, F.lit("")).otherwise(
        F.concat(F.lit("https://example.org/"), vid.cast("string")))
    expected = F.when(vid % 3 == 0, F.array(own, F.concat(F.lit("https://example.org/missing/"),
                                                          vid.cast("string")))).otherwise(F.array(own))
    return emb.select(
        vid.alias("qid"),
        F.concat(F.lit("d"), (F.col("label") % 3).cast("string")).alias("dataset"),
        F.concat(F.lit("golden "), vid.cast("string")).alias("query"),
        expected.alias("expected_citations"),
        F.when(vid % 4 == 0, F.lit(1.01)).otherwise(F.lit(None).cast("double")).alias("min_score"),
        "embedding")


def questions(spark: SparkSession, base: str) -> DataFrame:
    """Every embedding is also a question: ``qid, dataset, query, top_k,
    namespace, embedding`` (top 5 in production, as the API defaults)."""
    emb = read_table(spark, base, "embeddings", ["vec_id", "embedding", "label"])
    vid = F.col("vec_id")
    return emb.select(
        vid.alias("qid"),
        F.concat(F.lit("d"), (F.col("label") % 3).cast("string")).alias("dataset"),
        F.concat(F.lit("what about item "), vid.cast("string"), F.lit(" & more?")).alias("query"),
        F.lit(5).alias("top_k"), F.lit("production").alias("namespace"), "embedding")


def process_state(spark: SparkSession, base: str) -> DataFrame:
    """State when processing starts: every page scraped; page_id % 3 = 0 also
    processed with the current text hash, 1 scraped with the current text
    hash recorded, 2 scraped without a text hash."""
    return process_state_from(cleaned_pages(spark, base))


def cleaned_pages(spark: SparkSession, base: str) -> DataFrame:
    """``web_pages`` cleaned once: ``page_id, dataset, url, raw_key, raw_hash,
    text, text_hash, title, description``."""
    from webcorpus.functions.keys import raw_key
    from webcorpus.operators.cleaning import clean_pages
    pages = (web_pages(spark, base).withColumn("raw_hash", F.sha2("html", 256))
             .withColumn("raw_key", raw_key(F.col("dataset"), F.col("url"))))
    return clean_pages(pages)


def process_state_from(clean: DataFrame) -> DataFrame:
    from webcorpus.functions.keys import state_key
    pid = F.col("page_id")
    return clean.select(
        state_key(F.col("dataset"), F.col("url")).alias("key"), "dataset", "url",
        url_hash(F.col("url")).alias("url_hash"), "raw_hash",
        F.when(pid % 3 != 2, F.col("text_hash")).alias("text_hash"), "raw_key",
        F.when(pid % 3 == 0, F.lit("processed")).otherwise(F.lit("scraped")).alias("status"),
        F.to_timestamp(F.lit(PREVIOUS_AS_OF)).alias("updated_at"))
