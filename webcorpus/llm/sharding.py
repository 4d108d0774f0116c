"""Shards under a byte limit by extendible hashing.

A document's bucket is a prefix of its hash bits.  The directory of prefixes
starts as one bucket; only a bucket over the limit splits on its next bit.
Byte sums per prefix are taken from one aggregate at a fine prefix, and only
what is still too large there is looked at again with more bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from webcorpus.llm.common import cut, hinted, spare

#: Hash bits a directory can use: the first 15 hex digits of an MD5.
BITS = 60
#: Rows of one hash that are numbered together.
PART = 100_000
#: More bits looked at in each pass over buckets that are still too large.
STEP = 8


def hash_bits(id_col: Column) -> Column:
    key = F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def prefix(h: Column, depth: Column | int) -> Column:
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def directory_pass(rows: DataFrame, lo: int, hi: int, limit: int) -> DataFrame:
    """``rows(h, bytes, n, least, most)`` → per ``hi``-bit cell: the first depth
    of ``lo..hi`` at which its bucket need not split (null: none)."""
    sums = [F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
            F.max("biggest").alias("biggest")]
    cells = cut(rows.groupBy(prefix(F.col("h"), hi).alias("cell")).agg(*sums))
    depths = F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("depth")
    at = cells.select("*", depths).withColumn("bucket", F.expr("shiftright(cell, cast(%d - depth as int))" % hi))
    # a bucket is done when it fits, or when all its documents share one hash
    done = (at.groupBy("depth", "bucket").agg(*sums)
            .where((F.col("bytes") <= limit) | (F.col("least") == F.col("most"))))
    done = cut(done)
    # only depths at which some bucket is done are looked up: above them all cells share a few buckets
    used = [r["depth"] for r in done.select("depth").distinct().collect()]
    at = at.where(F.col("depth").isin(used))
    first = (at.select("cell", "depth", "bucket").join(done, ["depth", "bucket"])
             .groupBy("cell").agg(F.min_by(F.struct("depth", "bucket", "bytes", "n", "biggest"), "depth").alias("b")))
    return cut(cells.select("cell").join(first, "cell", "left").select("cell", "b.*"))


def assign_shards(docs: DataFrame, limit: int = 128 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (hash bits, then ``+page`` for an overflow page),
    ``depth``, ``bytes`` (UTF-8 bytes of the text, null: 0), ``shard_bytes``
    and ``oversize``.

    Every shard holds at most ``limit`` bytes, except that of a single
    document longer than that (``oversize``; documents are never cut).  Rows
    that repeat an id (or have none) share all hash bits; if they exceed the
    limit together they go to numbered overflow pages.  Columns of ``docs``
    with one of the new names are replaced.  An empty table gives no rows.
    """
    keep = [c for c in docs.columns if c.lower() not in {"shard", "depth", "bytes", "shard_bytes", "oversize"}]
    docs = docs.select(*dict.fromkeys([*keep, id_col, text_col]))
    h, size = spare(docs, "h"), spare(docs, "n_bytes")
    rows = docs.withColumn(h, hash_bits(F.col(id_col))).withColumn(
        size, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
    narrow = rows.groupBy(F.col(h).alias("h")).agg(
        F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n"), F.max(size).alias("biggest"))
    narrow = cut(narrow.withColumn("least", F.col("h")).withColumn("most", F.col("h")))
    total = narrow.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    lo, hi = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + 4)
    found, active = None, narrow
    while True:
        cells = directory_pass(active, lo, hi, limit)
        key, b = spare(docs, f"cell{hi}"), spare(docs, "found")
        here = cells.where("depth is not null")
        part = here.select(F.col("cell").alias(key), F.struct("depth", "bucket", "bytes", "n", "biggest").alias(f"{b}{hi}"))
        rows = rows.withColumn(key, prefix(F.col(h), hi)).join(hinted(part), key, "left").drop(key)
        rows = rows.withColumn(b, F.coalesce(b, f"{b}{hi}") if found else F.col(f"{b}{hi}")).drop(f"{b}{hi}")
        found = b
        left = cells.where("depth is null").select("cell")
        if hi == BITS or left.isEmpty():
            break
        active = cut(active.withColumn("cell", prefix(F.col("h"), hi)).join(left, "cell", "left_semi").drop("cell"))
        lo, hi = hi + 1, min(BITS, hi + STEP)
    b = F.col(found)
    bits = F.when(b["depth"] == 0, F.lit("")).otherwise(
        F.lpad(F.conv(b["bucket"].cast("string"), 10, 2), b["depth"], F.lit("0")))
    # pages: as many documents as fit even if all were as long as the longest
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(b["biggest"], F.lit(1))))
    over = (b["bytes"] > limit) & (b["n"] > 1)
    page = spare(rows, "page")
    whole = rows.where(~over).withColumn(page, F.lit(None).cast("long"))
    own = spare(rows, "page_bytes")
    if not narrow.where((F.col("bytes") > limit) & (F.col("n") > 1)).isEmpty():
        # rows of one hash (a repeated id, or none) are spread over parts of about PART rows, each with pages of its own
        part, ph, pp = (spare(rows, c) for c in ("part", "of_hash", "of_page"))
        parts = F.greatest(F.lit(1), F.ceil(b["n"] / PART)).cast("long")
        text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.spark_partition_id())
        paged = rows.where(over).withColumn(part, F.pmod(text, parts))
        w = Window.partitionBy(h, part).orderBy(F.col(size), text)
        nth = F.floor((F.row_number().over(w) - 1) / per_page).cast("long")
        paged = paged.withColumn(page, nth * parts + F.col(part)).drop(part)
        paged = cut(paged)
        held = paged.groupBy(F.col(h).alias(ph), F.col(page).alias(pp)).agg(F.sum(size).alias(own))
        paged = paged.join(held, (F.col(h) == F.col(ph)) & (F.col(page) == F.col(pp))).drop(ph, pp)
        whole = whole.withColumn(own, F.lit(None).cast("long")).unionByName(paged)
    else:
        whole = whole.withColumn(own, F.lit(None).cast("long"))
    p, n_bytes = F.col(page), F.coalesce(F.col(own), b["bytes"])
    return whole.select(*keep, F.concat(bits, F.when(p.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), p.cast("string")))).alias("shard"),
                        b["depth"].cast("long").alias("depth"), F.col(size).alias("bytes"), n_bytes.alias("shard_bytes"),
                        (n_bytes > limit).alias("oversize"))
