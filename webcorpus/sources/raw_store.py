"""A5 page admission and A6–A8 the raw page store (Parquet, partitioned by
dataset, keyed by ``{dataset}/raw/{sha256(url)[:16]}.html``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.keys import raw_key


def html_only(fetched: DataFrame) -> DataFrame:
    """Keep fetch results whose content type mentions ``text/html``
    (case-insensitive); the rest count as failed fetches."""
    return fetched.where(F.lower(F.coalesce(F.col("content_type"), F.lit(""))).contains("text/html"))


def with_raw_keys(pages: DataFrame) -> DataFrame:
    """Adds ``raw_key`` and ``raw_hash`` (sha256 of the HTML)."""
    return (pages.withColumn("raw_key", raw_key(F.col("dataset"), F.col("url")))
            .withColumn("raw_hash", F.sha2("html", 256)))


def lookup_raw(keys: DataFrame, store: DataFrame) -> DataFrame:
    """The HTML of each key, null when the key is missing."""
    return keys.join(store.select("raw_key", "html"), "raw_key", "left")


def raw_exists(keys: DataFrame, store: DataFrame) -> DataFrame:
    """``raw_key, exists`` — a semi join and an anti join on the key."""
    k = store.select("raw_key")
    found = keys.join(k, "raw_key", "left_semi").withColumn("exists", F.lit(True))
    missing = keys.join(k, "raw_key", "left_anti").withColumn("exists", F.lit(False))
    return found.unionByName(missing)
