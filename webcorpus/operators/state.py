"""Incremental state: change detection (J1–J3), state lookups and upsert
(A9–A11) and the run counters (G1, G2).

The state table ``url_state`` is keyed by ``{dataset}#{sha256(url)}`` and
carries two hashes (raw HTML and cleaned text) instead of one overloaded
field, so both stages' skip tests hold across stages.  Every check is a join
on the key — anti joins where only the changed rows are wanted, a left join
plus an ``outcome`` column where counts are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions.keys import raw_key, state_key, url_hash

STATE_COLUMNS = ("key", "dataset", "url", "url_hash", "raw_hash", "text_hash", "raw_key",
                 "status", "updated_at")


def with_state_key(df: DataFrame) -> DataFrame:
    return df.withColumn("key", state_key(F.col("dataset"), F.col("url")))


def crawl_delta(pages: DataFrame, state: DataFrame) -> DataFrame:
    """Fetched pages whose raw hash differs from (or is absent in) the
    state — an anti join on ``(key, raw_hash)``."""
    s = state.select("key", "raw_hash").where(F.col("raw_hash").isNotNull())
    return with_state_key(pages).join(s, ["key", "raw_hash"], "left_anti")


def crawl_outcomes(frontier: DataFrame, fetched: DataFrame, state: DataFrame) -> DataFrame:
    """W1 outcome per frontier URL: ``failed`` (not fetched, robots-denied or
    not HTML), ``skipped`` (same raw hash in state) or ``processed``.

    ``fetched`` holds ``dataset, url, html, raw_hash, ok`` (``ok`` = robots
    allowed and HTML); the state side is reduced to ``key, raw_hash``."""
    f = with_state_key(fetched.select("dataset", "url", "raw_hash", "ok"))
    s = state.select("key", F.col("raw_hash").alias("_prev_hash"))
    joined = with_state_key(frontier.select("dataset", "url")).join(
        f.drop("dataset", "url"), "key", "left").join(s, "key", "left")
    outcome = (F.when(~F.coalesce(F.col("ok"), F.lit(False)), F.lit("failed"))
               .when(F.col("_prev_hash") == F.col("raw_hash"), F.lit("skipped"))
               .otherwise(F.lit("processed")))
    return joined.select("key", "dataset", "url", outcome.alias("outcome"))


def outcome_counts(outcomes: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Per dataset, how many rows had each outcome (partial
    aggregation before the shuffle on dataset)."""
    o = F.col("outcome")
    aggs = [F.count_if(o == "processed").alias("processed"),
            F.count_if(o == "skipped").alias("skipped"),
            F.count_if(o == "failed").alias("failed"),
            F.count(F.lit(1)).alias("total")]
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    return outcomes.groupBy("dataset").agg(*aggs)


def process_delta(clean: DataFrame, state: DataFrame) -> DataFrame:
    """Cleaned pages to (re)process — unless state holds the same text
    hash with status ``processed``."""
    s = (state.where(F.col("status") == "processed")
         .select("key", "text_hash").where(F.col("text_hash").isNotNull()))
    return with_state_key(clean).join(s, ["key", "text_hash"], "left_anti")


def keep_text_hash(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Fetched pages with the text hash that processing last left in their state
    row (null when none): a crawl replaces the state row, and without the hash
    a page whose HTML changed but not its text would be processed again."""
    old = state.select("key", "text_hash")
    return with_state_key(rows.drop("text_hash")).join(old, "key", "left").drop("key")


def page_outcomes(keys: DataFrame, pages: DataFrame, state: DataFrame) -> DataFrame:
    """W2 outcome per requested ``(dataset, raw_key)``, with the page's columns:
    ``failed`` (no page, no HTML in it, or no state row), ``skipped`` (the
    state's text hash, which only processing writes, equals the page's) or
    ``processed``.  ``pages``: ``raw_key, html, text_hash, …`` of clean pages, with ``html``
    reduced to whether there is any (``has_html``)."""
    known = state_by_raw_key(keys.select("dataset", "raw_key").distinct(), state).select(
        "dataset", "raw_key", F.col("url").alias("_url"), F.col("raw_hash").alias("_raw_hash"),
        F.col("text_hash").alias("_known"))
    rows = known.join(pages.drop("url"), ["dataset", "raw_key"], "left").withColumnRenamed("_url", "url")
    outcome = (F.when(~F.coalesce("has_html", F.lit(False)) | F.col("url").isNull(), F.lit("failed"))
               .when(F.col("_known") == F.col("text_hash"), F.lit("skipped"))
               .otherwise(F.lit("processed")))
    return rows.withColumn("outcome", outcome).drop("_raw_hash", "_known")


def state_by_raw_key(keys: DataFrame, state: DataFrame) -> DataFrame:
    """A10: the state row of each ``(dataset, raw_key)``, null when none.  When
    several rows share a raw key the smallest state key wins (deterministic)."""
    one = (state.groupBy("dataset", "raw_key")
           .agg(F.min_by(F.struct(*[c for c in STATE_COLUMNS if c not in ("dataset", "raw_key")]),
                         F.col("key")).alias("_s"))
           .select("dataset", "raw_key", "_s.*"))
    return keys.join(one, ["dataset", "raw_key"], "left")


def process_outcomes(keys: DataFrame, store: DataFrame, state: DataFrame,
                     text_hash: Column) -> DataFrame:
    """J3 + J2 per requested raw key: ``failed`` when the raw page or its
    state row is missing, ``skipped`` when the state already holds the same
    text hash as processed, else ``processed``.  ``text_hash`` is computed on
    the store's ``html`` column — on the store side, before the join, so the
    cleaning chain runs where the pages are spread rather than behind a
    shuffle of small keys (which adaptive execution may pack into one task)."""
    k = keys.select("dataset", "raw_key").dropDuplicates(["dataset", "raw_key"])
    hashed = store.select("raw_key", F.lit(True).alias("_found"), text_hash.alias("_new_hash"))
    with_html = k.join(hashed, "raw_key", "left")
    with_state = state_by_raw_key(with_html, state.select(*STATE_COLUMNS))
    out = with_state
    outcome = (F.when(F.col("_found").isNull() | F.col("key").isNull(), F.lit("failed"))
               .when((F.col("status") == "processed") & (F.col("text_hash") == F.col("_new_hash")),
                     F.lit("skipped"))
               .otherwise(F.lit("processed")))
    return out.select("dataset", "raw_key", "url", outcome.alias("outcome"),
                      F.col("_new_hash").alias("text_hash"))


def new_state_rows(pages: DataFrame, status: str, as_of: Column) -> DataFrame:
    """State rows for pages written by a run (``dataset, url, raw_hash,
    text_hash``)."""
    return pages.select(
        state_key(F.col("dataset"), F.col("url")).alias("key"), "dataset", "url",
        url_hash(F.col("url")).alias("url_hash"), "raw_hash",
        F.col("text_hash").cast("string").alias("text_hash"),
        raw_key(F.col("dataset"), F.col("url")).alias("raw_key"),
        F.lit(status).alias("status"), as_of.cast("timestamp").alias("updated_at"))


def upsert_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Replace whole rows by key — the latest ``updated_at`` wins, a new
    row wins a tie.  One shuffle on ``key``; the result is a new snapshot
    (never written over the path it was read from)."""
    tagged = (old.select(*STATE_COLUMNS).withColumn("_src", F.lit(0))
              .unionByName(new.select(*STATE_COLUMNS).withColumn("_src", F.lit(1))))
    w = Window.partitionBy("key").orderBy(F.col("updated_at").desc(), F.col("_src").desc())
    return (tagged.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn", "_src"))
