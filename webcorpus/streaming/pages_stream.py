"""Incremental processing of arriving pages with Structured Streaming.

``readStream`` over a folder of page files → clean (narrow) → keyed state →
changed pages → chunks, vectors, state rows.  Which pages changed is decided by
Spark's own state store (``applyInPandasWithState``, keyed by dataset and URL): it
holds per page the hash of its text and the arrival number that text came with, so no
epoch reads what earlier ones wrote, and the state is checkpointed and restored with
the stream.  Of a page that arrives several times the row with the greatest
arrival number counts, within a batch and across batches; a row older than
the page's state is late and is dropped.

Each epoch appends the chunks of its changed pages, and then the pages
themselves, as run ``epoch + 1`` (``sources/runs.py``); a replayed epoch writes the same
run again.  Reading takes each page's last run, so what a changed page no longer
holds is gone, and the tables equal one batch over every page's last arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from webcorpus.operators.chunking import chunk_documents
from webcorpus.operators.cleaning import clean_pages
from webcorpus.operators.state import new_state_rows, process_delta, upsert_state
from webcorpus.operators.vectors import chunk_vectors, live_vectors, upsert_vectors
from webcorpus.sources.runs import RunTable
from webcorpus.sources.tables import written

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("dataset", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])

STATE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("url_hash", T.StringType()),
    T.StructField("raw_hash", T.StringType()), T.StructField("text_hash", T.StringType()),
    T.StructField("raw_key", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("updated_at", T.TimestampType())])

VECTOR_SCHEMA = T.StructType([
    T.StructField("namespace", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("text", T.StringType()),
    T.StructField("dataset", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("chunk_index", T.IntegerType()),
    T.StructField("updated_at", T.TimestampType())])


def process_pages(pages: DataFrame, state: DataFrame, vectors: DataFrame,
                  as_of: str, embed=None) -> tuple[DataFrame, DataFrame]:
    """W2 over a batch of pages: returns the next (vectors, state) snapshots;
    ``embed`` is the embedding provider (default: hashed tokens)."""
    stamp = F.to_timestamp(F.lit(as_of))
    clean = clean_pages(pages.withColumn("raw_hash", F.sha2("html", 256)))
    todo = process_delta(clean, state)
    chunks = chunk_documents(todo, ["dataset", "url", "page_id"], carry=["title"])
    staged = chunk_vectors(chunks, "staging", stamp, embed)
    next_vectors = upsert_vectors(vectors, staged)
    next_state = upsert_state(state, new_state_rows(todo, "processed", stamp))
    return next_vectors, next_state


def _tables(spark: SparkSession, store: str) -> dict[str, RunTable]:
    page = T.StructType([T.StructField("dataset", T.StringType()), T.StructField("url", T.StringType())])
    shapes = {"chunks": (VECTOR_SCHEMA, ("dataset", "url")), "pages": (page, ("dataset", "url")), "state": (STATE_SCHEMA, ("key",))}
    return {name: RunTable(spark, f"{store}/{name}", schema, key, ("dataset",)) for name, (schema, key) in shapes.items()}


def changed_pages(pages: DataFrame, order_col: str = "page_id") -> DataFrame:
    """A stream of ``dataset, url, html, {order_col}`` → a stream of the cleaned pages whose text is not the one in
    the page's state: ``dataset, url, title, raw_hash, text_hash, text, seq``."""
    clean = clean_pages(pages.withColumn("raw_hash", F.sha2("html", 256)).withColumn("seq", F.col(order_col).cast("long")))
    clean = clean.select("dataset", "url", "title", "raw_hash", "text_hash", "text", "seq")

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = None
        for part in parts:      # equal arrival numbers: the greatest hash
            top = part.sort_values(["seq", "raw_hash"]).iloc[-1:]
            if last is None or tuple(top[["seq", "raw_hash"]].iloc[0]) > tuple(last[["seq", "raw_hash"]].iloc[0]):
                last = top
        known, seen = state.get if state.exists else (None, None)
        if last is None or (seen is not None and int(last["seq"].iloc[0]) < seen):
            return
        state.update((last["text_hash"].iloc[0], int(last["seq"].iloc[0])))
        if last["text_hash"].iloc[0] != known:
            yield last

    return clean.groupBy("dataset", "url").applyInPandasWithState(
        step, clean.schema, "text_hash string, seq long", "update", GroupStateTimeout.NoTimeout)


def run_batch(spark: SparkSession, changed: DataFrame, store: str, run: int, as_of: str, embed=None) -> None:
    """One epoch: the changed pages' chunks, state rows and, last, the pages as run ``run``."""
    t = _tables(spark, store)
    stamp = F.to_timestamp(F.lit(as_of))
    changed = written(changed)      # several writes read it, and the state must be stepped once
    chunks = chunk_documents(changed, ["dataset", "url"], carry=["title"])
    t["chunks"].append(chunk_vectors(chunks, "staging", stamp, embed), run)
    t["state"].append(new_state_rows(changed, "processed", stamp), run)
    t["pages"].append(changed, run)


def start_page_stream(spark: SparkSession, source_dir: str, store: str, checkpoint: str,
                      as_of: str, files_per_trigger: int = 1, available_now: bool = True,
                      schema: T.StructType = PAGE_SCHEMA, prepare=None, order_col: str = "page_id", embed=None):
    """Start the stream; returns the ``StreamingQuery``.  ``prepare`` maps the
    files' rows to ``dataset, url, html`` and ``order_col``, the arrival number, when they differ."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(source_dir)
    pages = prepare(stream) if prepare else stream

    def each(batch: DataFrame, epoch_id: int) -> None:
        run_batch(batch.sparkSession, batch, store, epoch_id + 1, as_of, embed)

    writer = (changed_pages(pages.select("dataset", "url", "html", order_col), order_col)
              .writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def latest(spark: SparkSession, store: str, table: str) -> DataFrame:
    """The stream's ``vectors`` (of each page's last run) or ``state`` as they stand."""
    t = _tables(spark, store)
    if table == "vectors":
        return live_vectors(t["chunks"].rows(), t["pages"].newest())
    return t["state"].newest().drop("run")
