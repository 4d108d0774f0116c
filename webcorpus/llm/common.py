"""Helpers shared by the operators: words of a text, lineage cuts, spare
column names, checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.session import ensure_checkpoint_dir

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Between words: space and the five ASCII control spaces.
SPACES = "\t\n\x0b\x0c\r "
#: Rows turned into Python objects at a time inside a task.
SLICE = 512


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table of its own in the shared folder of the session
    (``spark.checkpoint.dir``) and read it back: later stages start from the
    files, whatever executors are lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (names are
    compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words (null: 0), as long."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows (reads no more than one beyond)."""
    return df.limit(rows + 1).count() <= rows


def hinted(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` of narrow rows, marked for broadcast only if it has at most
    ``rows`` of them; else it is left to a shuffled join."""
    return F.broadcast(df) if small_enough(df, rows) else df


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``SLICE`` rows, so that few texts are
    Python objects at once."""
    for b in batches:
        for i in range(0, b.num_rows, SLICE):
            yield b.slice(i, SLICE)


def as_bytes(col: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes (null: empty)."""
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [x or b"" for x in col.cast(kind).to_pylist()]


def lower_words(text: bytes) -> list[bytes]:
    """Words of a text with A-Z lower-cased (``bytes`` methods know ASCII only,
    and split at exactly the six ASCII spaces)."""
    return text.lower().split()


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """A seeded remix of 64-bit hashes (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))
