"""A14 vector upsert and K6 dedup by content-derived id, plus K1 cosine as a
column expression for explicit pairs.

The vector table is partitioned by ``namespace`` and ``dataset``; an upsert
is ``existing ∪ new`` reduced to one row per ``(namespace, id)`` — the row
with the greatest ``(updated_at, url, chunk_index)`` wins, so identical chunk
texts on two URLs collapse to one deterministic row.  The reduction is a
``max_by`` aggregate: partial aggregation before the shuffle on the key, and
ids are content hashes, so no key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.keys import vector_id
from webcorpus.operators.embed import hashed_embedder

VECTOR_COLUMNS = ("namespace", "id", "embedding", "text", "dataset", "url", "title",
                  "chunk_index", "updated_at")


def chunk_vectors(chunks: DataFrame, namespace: str, as_of: Column,
                  embed=None) -> DataFrame:
    """Chunks (``dataset, url, title, chunk_index, text``) → vector rows; the
    embedding comes from ``embed`` (default: the hashed provider)."""
    embedded = (embed or hashed_embedder())(chunks, "text", "_emb")
    return embedded.select(
        F.lit(namespace).alias("namespace"),
        vector_id(F.col("dataset"), F.col("text")).alias("id"),
        F.col("_emb").cast("array<float>").alias("embedding"),
        "text", "dataset", F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("chunk_index"), F.lit(0)).cast("int").alias("chunk_index"),
        as_of.cast("timestamp").alias("updated_at"))


def dedup_vectors(rows: DataFrame) -> DataFrame:
    """One row per ``(namespace, id)``: greatest ``(updated_at, url, chunk_index)``."""
    cols = [c for c in rows.columns if c not in ("namespace", "id")]
    order = F.struct(F.col("updated_at"), F.col("url"), F.col("chunk_index"))
    return (rows.groupBy("namespace", "id")
            .agg(F.max_by(F.struct(*cols), order).alias("_r"))
            .select("namespace", "id", "_r.*"))


def upsert_vectors(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by id; returns the next snapshot of the vector table."""
    return dedup_vectors(existing.select(*VECTOR_COLUMNS).unionByName(new.select(*VECTOR_COLUMNS)))


def live_vectors(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """F12 with deletes: vector rows after pages were processed again.

    ``chunks``: vector rows with the ``run`` that made them, one per page and chunk; ``pages``
    (``dataset, url, run``): the run that last processed each page, also one that found no text.  Only chunks of their page's last
    run count, so those that left a changed page are gone; a chunk that
    another page still holds stays, cited from that page."""
    here = chunks.join(pages.select("dataset", "url", "run"), ["dataset", "url", "run"], "left_semi")
    return dedup_vectors(here.select(*VECTOR_COLUMNS))


def write_vectors(snapshot: DataFrame, path: str) -> None:
    """Write a snapshot partitioned for pruning by namespace and dataset."""
    (snapshot.sortWithinPartitions("namespace", "dataset")
     .write.mode("overwrite").partitionBy("namespace", "dataset").parquet(path))


def cosine(a: Column, b: Column) -> Column:
    """K1 cosine similarity of two equal-length arrays, in double (0 where either
    has no length)."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                      F.lit(0.0), lambda acc, v: acc + v)
    na = F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    nb = F.aggregate(b, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    return F.when(na * nb == 0, F.lit(0.0)).otherwise(dot / F.sqrt(na * nb))
