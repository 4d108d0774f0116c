"""A3 seed lists and P1 same-domain admission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import authority
from webcorpus.sources.sitemaps import expand_sitemaps


def seed_urls(seeds: DataFrame) -> DataFrame:
    """``dataset, url`` from ``url`` / ``urls`` seeds, de-duplicated per dataset."""
    return (seeds.where(F.col("source_type").isin("url", "urls"))
            .select("dataset", F.col("source").alias("url"))
            .dropDuplicates(["dataset", "url"]))


def same_domain(urls: DataFrame, base_urls: DataFrame) -> DataFrame:
    """Keep the URLs whose authority (host, port, user-info; case-sensitive)
    equals that of their dataset's ``base_url``."""
    bases = base_urls.select("dataset", authority(F.col("base_url")).alias("_base"))
    return (urls.join(bases, "dataset")
            .where(authority(F.col("url")) == F.col("_base"))
            .drop("_base"))


def crawl_frontier(seeds: DataFrame, sitemaps: DataFrame, base_urls: DataFrame) -> DataFrame:
    """``dataset, url`` to fetch: sitemap seeds are expanded and kept to the
    base domain; ``url``/``urls`` seeds are taken as given (no domain test)."""
    site = expand_sitemaps(
        seeds.where(F.col("source_type") == "sitemap")
        .select("dataset", F.col("source").alias("sitemap_url")), sitemaps)
    return same_domain(site, base_urls).unionByName(seed_urls(seeds)).distinct()
