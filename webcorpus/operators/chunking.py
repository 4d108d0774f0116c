"""S1 + S2 together: documents → sections → token-bounded chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.operators.packing import MAX_TOKENS, TARGET_TOKENS, pack, section_items
from webcorpus.operators.sections import sections


def chunk_documents(docs: DataFrame, keys: Sequence[str], text_col: str = "text",
                    target: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS,
                    carry: Sequence[str] = (), count_tokens=None) -> DataFrame:
    """``keys…, carry…, chunk_index, text, n_tokens, n_items, oversize``.

    One shuffle for the whole chain: the document rows are hash-partitioned
    on ``keys`` once, and the section windows, the section concat, the fold
    and the chunk concat all run inside that partitioning.  ``carry`` columns
    (per-document metadata such as url or title) ride along in the grouping
    keys after the shuffle, so no join brings them back.  Documents with no
    non-blank section yield no rows.  ``count_tokens`` swaps the default
    regex counter for another column function (e.g. ``model_token_counter``).
    """
    keys, carry = list(keys), list(carry)
    docs = docs.select(*keys, *carry, text_col).repartition(*keys)
    secs = sections(docs, keys, text_col, carry)
    items = (section_items(secs, keys + carry, max_tokens) if count_tokens is None
             else section_items(secs, keys + carry, max_tokens, count_tokens))
    chunks = pack(items, keys + carry, target, max_tokens)
    return chunks.select(*keys, *carry, F.col("chunk_index").cast("bigint").alias("chunk_index"), "text",
                         "n_tokens", "n_items", (F.col("n_tokens") > max_tokens).alias("oversize"))
