"""A1 sitemap scan and A2 sitemap-index expansion.

Sitemap documents arrive as a table ``sitemap_url, xml`` (fetching is not
this engine's job).  ``sitemap_urls`` parses with Spark's own ``xpath`` (a malformed document
raises, as an XML parser would).  The walk parses with ``from_xml``, whose corrupt-record
column keeps a malformed document as a row, and reports what became of every
sitemap it was sent to: a child that is missing or malformed fails by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.sources.tables import cut_lineage, written

PAGE_LOCS = "/urlset/url/loc/text()"
#: Both kinds of document; what can't be parsed is kept in the last column.
SITEMAP = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>, _corrupt_record string"


def sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """``sitemap_url, url``: the page URLs of every ``urlset`` document, as a set
    (narrow parse, then one distinct)."""
    locs = F.xpath(F.col("xml"), F.lit(PAGE_LOCS))
    return (sitemaps.select("sitemap_url", F.explode(locs).alias("url"))
            .select("sitemap_url", F.trim("url").alias("url"))
            .where(F.col("url") != "")
            .distinct())


def parse_sitemaps(sitemaps: DataFrame) -> DataFrame:
    """``sitemap_url, urls, children, reason``: the locations of each document, trimmed, without empty ones;
    ``reason`` is null, or why there are none: ``missing`` (null) or ``malformed``."""
    def locations(field: str):
        locs = F.transform(F.coalesce(F.col(f"p.{field}"), F.array()), lambda x: F.trim(x["loc"]))
        return F.array_distinct(F.filter(locs, lambda x: x != ""))

    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreNamespace": "true"}
    p = sitemaps.select("sitemap_url", "xml", F.from_xml("xml", SITEMAP, options).alias("p"))
    reason = F.when(F.col("xml").isNull(), "missing").when(F.col("p._corrupt_record").isNotNull(), "malformed")
    return p.select("sitemap_url", locations("url").alias("urls"), locations("sitemap").alias("children"), reason.alias("reason"))


def walk_sitemaps(seeds: DataFrame, sitemaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Follow ``sitemapindex`` entries from each seed's sitemap: ``(dataset, url)`` of every ``urlset``
    reached, and ``(dataset, sitemap_url, outcome, n_urls, n_children)`` of every sitemap the walk was sent to, ``outcome``
    being ``ok``, ``missing`` or ``malformed``.

    A breadth-first loop on the driver, one join per level: the frontier of
    not-yet-seen ``(dataset, sitemap_url)`` pairs is joined to the sitemap
    table; children already seen are dropped by an anti join (the cycle
    guard: every sitemap is visited once per dataset, so the walk ends), and
    the walk stops when the frontier is empty.  Each level's visited set is checkpointed to
    the shared checkpoint folder so lineage stays flat.
    """
    docs = written(parse_sitemaps(sitemaps))
    frontier = seeds.select("dataset", "sitemap_url").distinct()
    seen = frontier
    while True:
        children = (frontier.join(docs.select("sitemap_url", "children"), "sitemap_url")
                    .select("dataset", F.explode("children").alias("sitemap_url")).distinct())
        frontier = cut_lineage(children.join(seen, ["dataset", "sitemap_url"], "left_anti"))
        if frontier.isEmpty():
            break
        seen = cut_lineage(seen.unionByName(frontier))
    found = seen.join(docs, "sitemap_url", "left")
    # a sitemap stored twice is read twice; one good copy will do
    outcome = F.when(F.col("_ok"), "ok").otherwise(F.coalesce("_why", F.lit("missing")))
    outcomes = found.groupBy("dataset", "sitemap_url").agg(
        F.coalesce(F.bool_or(F.col("urls").isNotNull() & F.col("reason").isNull()), F.lit(False)).alias("_ok"), F.min("reason").alias("_why"),
        F.coalesce(F.max(F.size("urls")), F.lit(0)).cast("bigint").alias("n_urls"),
        F.coalesce(F.max(F.size("children")), F.lit(0)).cast("bigint").alias("n_children"))
    pages = found.select("dataset", F.explode("urls").alias("url")).distinct()
    return pages, outcomes.select("dataset", "sitemap_url", outcome.alias("outcome"), "n_urls", "n_children")


def expand_sitemaps(seeds: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """``dataset, url``: the pages of ``walk_sitemaps``."""
    return walk_sitemaps(seeds, sitemaps)[0]
