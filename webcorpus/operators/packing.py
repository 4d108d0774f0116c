"""S2 — greedy packing of sections into token-bounded chunks.

Items, in section order: a section of at most ``max_tokens`` is one *section
item*; a larger one is replaced by its paragraphs (*para items*).  The state
``(c, tok, open)`` starts at ``(0, 0, false)``; for an item of ``n`` tokens:

* ``open`` and ``tok + n > max``: close chunk ``c``, the item opens ``c + 1``
  with ``tok = n`` — no target test on this item;
* otherwise the item joins chunk ``c``: ``tok += n``, ``open``; a *section*
  item that brings ``tok`` to ``target`` or more closes the chunk.

Para items never close a chunk.  Chunk text = item texts joined by a blank
line.  The fold is a true sequential scan per document, so it runs as one
``aggregate`` over the document's ordered items — grouped on the same key as
the section windows, so it adds no shuffle.  Only the small ``(n, is_para)``
fields are read by the fold, which runs in blocks so very long documents stay
near-linear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.functions.text import paragraphs, token_count

# Chunk target and maximum size in tokens.
TARGET_TOKENS = 500
MAX_TOKENS = 800
FOLD_BLOCK = 256

ITEM = T.StructType([
    T.StructField("sec", T.LongType()),
    T.StructField("para", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("is_para", T.BooleanType()),
    T.StructField("text", T.StringType()),
])


def section_items(sections: DataFrame, keys: Sequence[str], max_tokens: int = MAX_TOKENS,
                  count_tokens=token_count) -> DataFrame:
    """One ``item`` struct per row: a whole section, or one of its paragraphs
    when the section has more than ``max_tokens`` tokens.  Token counting
    runs on plain columns (never inside a lambda), so ``count_tokens`` may
    also be a Pandas UDF."""
    s = (sections.withColumn("_n", count_tokens(F.col("text")))
         .withColumn("_is_para", F.col("_n") > max_tokens))
    parts = F.when(F.col("_is_para"), paragraphs("text")).otherwise(F.array(F.col("text")))
    ex = s.select(*keys, "section_no", "_n", "_is_para", F.posexplode(parts).alias("_j", "_t"))
    n = F.when(F.col("_is_para"), count_tokens(F.col("_t"))).otherwise(F.col("_n"))
    return ex.select(*keys, F.struct(
        F.col("section_no").cast("bigint").alias("sec"), F.col("_j").cast("int").alias("para"),
        n.cast("bigint").alias("n"), F.col("_is_para").alias("is_para"),
        F.col("_t").alias("text")).alias("item"))


def _step(target: int, max_tokens: int):
    def step(acc, it):
        joined = acc["tok"] + it["n"]
        overflow = acc["open"] & (joined > max_tokens)
        closes = ~it["is_para"] & (joined >= target)
        no = F.when(overflow, acc["c"] + 1).otherwise(acc["c"])
        return F.struct(
            F.when(overflow | closes, acc["c"] + 1).otherwise(acc["c"]).alias("c"),
            F.when(overflow, it["n"]).when(closes, F.lit(0).cast("bigint"))
             .otherwise(joined).alias("tok"),
            F.when(overflow, F.lit(True)).when(closes, F.lit(False))
             .otherwise(F.lit(True)).alias("open"),
            F.concat(acc["nos"], F.array(no)).alias("nos"),
            acc["done"].alias("done"))
    return step


def _fold(items: Column, target: int, max_tokens: int, block: int = FOLD_BLOCK) -> Column:
    """Chunk number of every item (same order as ``items``).

    The fold runs over blocks of ``block`` items: the inner fold appends to a
    block-sized array, the outer one to an array of blocks, so array copying
    stays O(n·block + (n/block)²) instead of O(n²) on very long documents.
    Each block is folded once: the finished block array is appended by the
    inner fold's ``finish`` function.
    """
    n_blocks = F.ceil(F.size(items) / F.lit(block)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1),
                         lambda b: F.slice(items, b * block + 1, block))
    blocks = F.when(n_blocks > 0, blocks).otherwise(F.array().cast(
        T.ArrayType(T.ArrayType(ITEM))))
    zero = F.struct(F.lit(0).alias("c"), F.lit(0).cast("bigint").alias("tok"),
                    F.lit(False).alias("open"), F.array().cast("array<int>").alias("nos"),
                    F.array().cast("array<array<int>>").alias("done"))
    step = _step(target, max_tokens)

    def finish(acc):
        return F.struct(acc["c"].alias("c"), acc["tok"].alias("tok"), acc["open"].alias("open"),
                        F.array().cast("array<int>").alias("nos"),
                        F.concat(acc["done"], F.array(acc["nos"])).alias("done"))

    def outer(acc, blk):
        return F.aggregate(blk, acc, step, finish)

    return F.flatten(F.aggregate(blocks, zero, outer)["done"])


def pack_rows(rows: list[tuple[int, int, bool]], target: int, max_tokens: int) -> list[int]:
    """The same rule over ``(order, n, is_para)`` tuples in order — a plain
    sequential reading used by the tests as an independent check."""
    c, tok, is_open, out = 0, 0, False, []
    for _, n, is_para in rows:
        if is_open and tok + n > max_tokens:
            c, tok, is_open = c + 1, n, True
            out.append(c)
            continue
        out.append(c)
        tok, is_open = tok + n, True
        if not is_para and tok >= target:
            c, tok, is_open = c + 1, 0, False
    return out


def pack(items: DataFrame, keys: Sequence[str], target: int = TARGET_TOKENS,
         max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``keys…, item`` rows → ``keys…, chunk_index, text, n_tokens, n_items``."""
    per_doc = (items.groupBy(*keys)
               .agg(F.array_sort(F.collect_list("item")).alias("items")))
    every = per_doc.select(
        *keys,
        F.inline(F.arrays_zip(F.col("items").alias("item"),
                              _fold(F.col("items"), target, max_tokens).alias("chunk_no"))))
    every = every.select(*keys, "item.*", "chunk_no")
    ordered = F.array_sort(F.collect_list(F.struct("sec", "para", "text")))
    return (every.groupBy(*keys, "chunk_no")
            .agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n\n").alias("text"),
                 F.sum("n").alias("n_tokens"),
                 F.count(F.lit(1)).alias("n_items"))
            .withColumnRenamed("chunk_no", "chunk_index"))
