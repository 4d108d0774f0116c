"""S1 + S2 for pages of any length: a page is cut into segments of lines that
many tasks share.

The splitter's and the packer's rules carry a small state from line to line.
Both are written as scans of summaries: a segment is summed up by what it does
to the state, the summaries of a page are composed in order (a window or a
stream over segments, not lines), and each segment then runs with the state it
starts in.  Three scans settle the sections, one the chunks:

1. the last list or plain line of a segment → whether the next starts in a list;
2. boundaries other than tables, and the section of the last line with a pipe
   → whether a table line opens a section;
3. section starts and empty lines → section and paragraph numbers;
4. chunks: the packer's state is the open chunk's tokens, 0 (none open) to
   ``max_tokens`` (more doesn't matter, any item overflows); a segment's summary is where each of
   these states leads and how many chunks it closes.

Tokens never span lines, so sections and paragraphs are counted by summing lines.
The scans move numbers only; the text is moved twice, to its number and to its chunk.
No group holds a page's lines: the largest are a segment, and the text of one
chunk.  Results equal ``chunk_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions.text import strip, token_count
from webcorpus.operators.packing import MAX_TOKENS, TARGET_TOKENS
from webcorpus.operators.sections import explode_lines, line_kind
from webcorpus.sources.tables import written

SEGMENT_LINES = 4096


def _equal(left: str, right: str, cols: Sequence[str]):
    """Null-safe equality of ``cols`` of two aliased tables."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _with(rows: DataFrame, other: DataFrame, on: Sequence[str], *cols: str) -> DataFrame:
    """``rows`` with ``cols`` of the one matching row of ``other``."""
    return rows.alias("l").join(other.alias("r"), _equal("l", "r", on)).select("l.*", *(f"r.{c}" for c in cols))


def split_lines(docs: DataFrame, keys: Sequence[str], text_col: str = "text", segment: int = SEGMENT_LINES) -> DataFrame:
    """``keys…, seg, pos, line, line_id, n, kind, pipe, empty``: every line, with a number of its own, its tokens and what the
    scans need to know of it."""
    raw = explode_lines(docs, keys, text_col)
    return written(raw.select(*keys, F.floor(F.col("pos") / segment).cast("int").alias("seg"), "pos", "line", F.monotonically_increasing_id().alias("line_id"), token_count("line").alias("n"),
                              line_kind(F.col("line"), F.col("next_line"), F.col("pos")).alias("kind"),
                              F.col("line").contains("|").alias("pipe"), (F.col("line") == "").alias("empty")))


def numbered_lines(docs: DataFrame, keys: Sequence[str], text_col: str = "text", segment: int = SEGMENT_LINES, lines: DataFrame | None = None) -> DataFrame:
    """``keys…, seg, pos, line_id, n, section_no, para``: every line's tokens, its section
    and its paragraph (empty lines so far), by scans 1 to 3.  The text of ``lines`` (``split_lines`` of the
    documents, made here if not given) stays behind."""
    keys = list(keys)
    lines = split_lines(docs, keys, text_col, segment) if lines is None else lines
    at = [*keys, "seg"]
    order = Window.partitionBy(*at).orderBy("pos")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    kind, listed = F.col("kind"), F.when(F.col("kind").isin("L", "N"), F.col("kind") == "L")

    last = lines.groupBy(*at).agg(F.max_by(listed, F.when(listed.isNotNull(), F.col("pos"))).alias("last"))
    first = last.withColumn("in0", F.coalesce(F.last("last", ignorenulls=True).over(earlier), F.lit(False)))

    def other_boundaries(df: DataFrame) -> DataFrame:
        inside = F.coalesce(F.last(listed, ignorenulls=True).over(before), F.col("in0"))
        starts = (F.col("pos") > 0) & ((kind == "H") | ((kind == "L") & ~inside) | ((kind == "N") & inside))
        return _with(df, first, at, "in0").withColumn("nb", starts.cast("long")).withColumn("c", F.sum("nb").over(upto)).drop("in0")

    narrow = other_boundaries(lines.select(*at, "pos", "kind", "pipe"))
    sums = narrow.groupBy(*at).agg(F.sum("nb").alias("nbs"), F.max(F.when(F.col("pipe"), F.col("c"))).alias("piped"))
    sums = sums.withColumn("c0", F.coalesce(F.sum("nbs").over(earlier), F.lit(0)))
    second = sums.withColumn("cp0", F.max(F.col("c0") + F.col("piped")).over(earlier))  # c only grows: the last is the greatest

    def starts(df: DataFrame) -> DataFrame:
        df = _with(other_boundaries(df), second, at, "c0", "cp0").withColumn("c", F.col("c0") + F.col("c"))
        piped = F.coalesce(F.last(F.when(F.col("pipe"), F.col("c")), ignorenulls=True).over(before), F.col("cp0"))
        table = (F.col("pos") > 0) & (kind == "T") & (piped.isNull() | (F.col("c") - F.col("nb") > piped))
        return df.withColumn("starts", ((F.col("nb") == 1) | table).cast("long")).drop("nb", "c", "c0", "cp0")

    counts = starts(lines.select(*at, "pos", "kind", "pipe", "empty")).groupBy(*at).agg(
        F.sum("starts").alias("s"), F.sum(F.col("empty").cast("long")).alias("e"))
    third = counts.select(*at, F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s0"), F.coalesce(F.sum("e").over(earlier), F.lit(0)).alias("e0"))
    out = _with(starts(lines.select(*at, "pos", "line_id", "n", "kind", "pipe", "empty")), third, at, "s0", "e0")
    return out.select(*at, "pos", "line_id", "n", (F.col("s0") + F.sum("starts").over(upto)).alias("section_no"),
                      (F.col("e0") + F.sum(F.col("empty").cast("long")).over(upto)).alias("para"))


def pack_state(state, n: int, is_para: bool, target: int, max_tokens: int):
    """One item from every state (tokens of the open chunk, 0 if none): (its chunk is a new one, chunks
    closed, next state)."""
    joined = state + n
    overflow = (state > 0) & (joined > max_tokens)
    closes = ~overflow & (joined >= target) & (not is_para)
    return overflow, overflow | closes, np.where(overflow, min(n, max_tokens), np.where(closes, 0, np.minimum(joined, max_tokens)))


def _chunk_numbers(items: DataFrame, keys: Sequence[str], target: int, max_tokens: int) -> DataFrame:
    """``items(keys…, seg, section_no, para, n, is_para)`` → the same with ``chunk_no``, by scan 4."""
    keys = list(keys)
    cols = ["section_no", "para", "n", "is_para"]
    segs = written(items.groupBy(*keys, "seg").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("items")))
    key_ddl = ", ".join(f"`{k}` {dict(items.dtypes)[k]}" for k in keys)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends, closed = [], []
            for row in b.column("items"):
                inner = row.values
                state, count = np.arange(max_tokens + 1), np.zeros(max_tokens + 1, np.int64)
                for n, is_para in zip(inner.field("n").to_pylist(), inner.field("is_para").to_pylist()):
                    _, done, state = pack_state(state, n, is_para, target, max_tokens)
                    count += done
                ends.append(state.astype(np.int32).tobytes())
                closed.append(count.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), b.column("seg"), pa.array(ends, pa.binary()), pa.array(closed, pa.binary())],
                                             names=[*keys, "seg", "ends", "closed"])

    summed = segs.mapInArrow(summaries, f"{key_ddl}, seg int, ends binary, closed binary")
    dealt = summed.repartition(*keys).sortWithinPartitions(*keys, "seg")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, state, chunk = None, 0, 0
        for b in batches:
            starts, firsts = [], []
            for *key, ends, closed in zip(*(b.column(k).to_pylist() for k in (*keys, "ends", "closed"))):
                if key != doc:
                    doc, state, chunk = key, 0, 0
                starts.append(state)
                firsts.append(chunk)
                chunk += int(np.frombuffer(closed, np.int32)[state])
                state = int(np.frombuffer(ends, np.int32)[state])
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), b.column("seg"), pa.array(starts, pa.int32()), pa.array(firsts, pa.int64())],
                                             names=[*keys, "seg", "state0", "chunk0"])

    begun = dealt.mapInArrow(compose, f"{key_ddl}, seg int, state0 int, chunk0 long")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers = []
            for row, state, chunk in zip(b.column("items"), b.column("state0").to_pylist(), b.column("chunk0").to_pylist()):
                inner, out = row.values, []
                for n, is_para in zip(inner.field("n").to_pylist(), inner.field("is_para").to_pylist()):
                    new, done, state = pack_state(np.int64(state), n, is_para, target, max_tokens)
                    out.append(chunk + int(new))
                    chunk += int(done)
                numbers.append(out)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), b.column("items"), pa.array(numbers, pa.list_(pa.int64()))],
                                             names=[*keys, "items", "chunks"])

    item_type = segs.schema["items"].dataType.simpleString()
    numbered = _with(segs, begun, [*keys, "seg"], "state0", "chunk0").mapInArrow(settle, f"{key_ddl}, items {item_type}, chunks array<long>")
    flat = numbered.select(*keys, F.inline(F.arrays_zip(F.col("items").alias("item"), F.col("chunks").alias("chunk_no"))))
    return flat.select(*keys, "item.*", "chunk_no")


def chunk_segments(docs: DataFrame, keys: Sequence[str], text_col: str = "text", target: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS,
                   segment: int = SEGMENT_LINES) -> DataFrame:
    """``keys…, chunk_index, text, n_tokens, n_items, oversize``, as ``chunk_documents`` gives them with its default
    token counter (another counter may not add up over lines).  ``keys`` tell documents apart and may hold nulls; documents
    without a non-blank section (null, empty, spaces) give no rows."""
    keys = list(keys)
    split = split_lines(docs, keys, text_col, segment)
    lines = written(numbered_lines(docs, keys, text_col, segment, split).drop("seg"))
    paras = lines.groupBy(*keys, "section_no", "para").agg(F.sum("n").alias("n"), F.min("pos").alias("pos"))
    totals = paras.groupBy(*keys, "section_no").agg(F.sum("n").alias("total"), F.min("pos").alias("start"))
    seg = lambda c: F.floor(F.col(c) / segment).cast("int").alias("seg")
    whole = totals.where(F.col("total").between(1, max_tokens)).select(
        *keys, seg("start"), "section_no", F.lit(-1).cast("long").alias("para"), F.col("total").alias("n"), F.lit(False).alias("is_para"))
    large = totals.where(F.col("total") > max_tokens)
    parts = _with(paras.where("n > 0"), large, [*keys, "section_no"]).select(*keys, seg("pos"), "section_no", "para", "n", F.lit(True).alias("is_para"))
    items = written(_chunk_numbers(whole.unionByName(parts), keys, target, max_tokens))
    # a section's lines, or a paragraph's, in their chunk
    own = [*keys, "section_no"]
    by_section = _with(lines, items.where("not is_para"), own, "chunk_no").withColumn("para", F.lit(-1).cast("long"))
    by_para = _with(lines, items.where("is_para"), [*own, "para"], "chunk_no")
    # the text joins last, and moves once more, by chunk; an item's lines and a chunk's items are put together there
    placed = by_section.unionByName(by_para).join(split.select("line_id", "line"), "line_id").repartition(*keys, "chunk_no")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    body = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    texts = placed.groupBy(*own, "para", "chunk_no").agg(body.alias("text"), F.sum("n").alias("n"))
    texts = texts.withColumn("text", F.when(F.col("para") >= 0, strip("text")).otherwise(F.col("text")))
    pieces = F.array_sort(F.collect_list(F.struct("section_no", "para", "text")))
    return (texts.groupBy(*keys, F.col("chunk_no").alias("chunk_index"))
            .agg(F.array_join(F.transform(pieces, lambda x: x["text"]), "\n\n").alias("text"), F.sum("n").alias("n_tokens"),
                 F.count(F.lit(1)).alias("n_items"))
            .withColumn("oversize", F.col("n_tokens") > max_tokens))
