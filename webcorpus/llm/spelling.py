"""Spelling variants: words one inserted, deleted or replaced code point apart,
found by dense prefix-suffix tiling.

Words are counted in the JVM (one row per distinct word).  A pair whose longer
word has ``L`` code points is near exactly if common prefix plus common suffix
reach ``L - 1``: the words agree left and right of one position.  That position
lies in one of ``WINDOWS`` windows of the longer word, and all code points
outside the window are shared, so each word is dealt, as longer word (class
``L``) and as shorter one (class ``L + 1``), under one key per window: class,
window and hash of what lies outside.  A task writes the words of a key into
padded code-point matrices, aligned left and right, and compares blocks of
pairs of rows: first mismatch from the left, first mismatch from the right.
A pair counts only in the window that holds its first mismatch, so once.

A key with over ``BLOCK`` words (a prefix and suffix that a large share of all
words have) is cut into blocks by word hash, and each pair of blocks is a group
of its own.  A task returns per word the number of near words it found and the
best of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import ASCII_LOWER, ASCII_UPPER, cut

#: Maximal runs of these code points are words.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
WINDOWS = 3
#: Words of one key that meet in one group; a key with more is cut into blocks.
BLOCK = 2048
#: Cells (pairs x code points) of a comparison, and rows of a task taken together.
CELLS, ROWS = 1 << 22, 1 << 16


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7,
                min_count: int = 2, noise: int = 31) -> DataFrame:
    """``(word, n)``: words of at least ``min_length`` code points seen at least
    ``min_count`` times in all whole texts, A-Z lower-cased.  Of an occurrence
    whose crc32 of ``<id>:<word>`` is divisible by ``noise`` the code point
    ``crc32 % length`` is left out first (0: none).

    Null or empty text: no word; a null id counts as empty text; repeated rows
    count each time; an empty table gives no rows.
    """
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    runs = src.select("id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    low = runs.select("id", F.translate("run", ASCII_UPPER, ASCII_LOWER).alias("run"))
    word = F.col("run")
    if noise:
        low = low.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut_out = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
        word = F.when(F.col("h") % noise == 0, cut_out).otherwise(F.col("run"))
    counted = low.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.char_length("word") >= min_length))


def code_points(words: list[str], length: int, right: bool) -> np.ndarray:
    """Padded matrix, a word per row: code points from the left, or from the
    right end backwards; zero behind the last."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.zeros((len(words), length), np.uint32)
    row = np.repeat(np.arange(len(words)), sizes)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, np.repeat(sizes, sizes) - 1 - col if right else col] = flat
    return out.astype(np.uint8) if not len(flat) or flat.max() < 256 else out


def window_bounds(length: int, j: np.ndarray | int, windows: int = WINDOWS):
    """First position of window ``j`` of a word of ``length`` code points."""
    return j * length // windows


def pair_rows(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges whose partner ranges ``start..end`` hold at most about ``ROWS`` pairs."""
    total = np.cumsum(end - start)
    i = 0
    while i < len(start):
        base = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, base + ROWS, "right")))
        yield i, j
        i = j


def near_in_groups(words: list[str], n: np.ndarray, group: np.ndarray, side: np.ndarray, window: np.ndarray,
                   length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of near pairs of one class ``length``: pairs of one group whose
    longer word has ``length`` code points, whose first mismatch lies in the
    group's window and, in a group of two blocks (``side`` 0 and 1), that cross them.
    Rows come sorted by group."""
    rows = len(words)
    sizes = np.fromiter(map(len, words), np.int64, rows)
    left, right = code_points(words, length, False), code_points(words, length, True)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], rows]
    end_of = np.repeat(ends, ends - starts)
    first, last = np.arange(rows) + 1, end_of
    found_a, found_b = [], []
    step = max(1, CELLS // max(length, 1))
    for i, j in pair_rows(first, last):
        count = last[i:j] - first[i:j]
        a_all = np.repeat(np.arange(i, j), count)
        b_all = np.arange(len(a_all)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[i:j], count)
        # the longer word has the class's length; a pair of blocks is crossed; a block with itself has side 2
        ok = (np.maximum(sizes[a_all], sizes[b_all]) == length) & ((side[a_all] == 2) | (side[a_all] != side[b_all]))
        a_all, b_all = a_all[ok], b_all[ok]
        for k in range(0, len(a_all), step):
            a, b = a_all[k:k + step], b_all[k:k + step]
            prefix = (left[a] != left[b]).argmax(axis=1)
            lo, hi = window_bounds(length, window[a]), window_bounds(length, window[a] + 1)
            here = (prefix >= lo) & (prefix < hi)
            a, b, prefix = a[here], b[here], prefix[here]
            suffix = (right[a] != right[b]).argmax(axis=1)
            near = prefix + suffix >= length - 1
            found_a.append(a[near])
            found_b.append(b[near])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def best_by_row(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row with a partner: (row, partners, the partner of greatest n, ties to the first row)."""
    row, other = np.r_[a, b], np.r_[b, a]
    order = np.lexsort((other, -n[other], row))
    row, other = row[order], other[order]
    head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
    return row[head], np.diff(np.r_[head, len(row)]), other[head]


def dealt(words: DataFrame, windows: int = WINDOWS, block: int = BLOCK) -> DataFrame:
    """``(word, n, length, key, side)``: each word under each key of its two
    classes; a key with over ``block`` words in pairs of blocks."""
    size = F.char_length("word")
    cls = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("length"))
    keyed = cls.select("*", F.explode(F.array(*(F.lit(j) for j in range(windows)))).alias("win"))
    lo = F.floor(F.col("win") * F.col("length") / windows).cast("int")
    tail = F.col("length") - F.floor((F.col("win") + 1) * F.col("length") / windows).cast("int")
    outside = F.xxhash64("win", "length", F.substring(F.col("word"), F.lit(1), lo), F.substring(F.col("word"), size - tail + 1, tail))
    keyed = keyed.select("word", "n", "length", "win", outside.alias("key"))
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > block)
    parts = keyed.join(large, "key", "left").withColumn("parts", F.ceil(F.coalesce("held", F.lit(1)) / block).cast("int"))
    own = F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int")
    parts = parts.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    a, b = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(a == b, 2).when(F.col("own") == a, 0).otherwise(1)
    return parts.select("word", "n", "length", "win", F.xxhash64("key", a, b).alias("key"), side.alias("side"))


def near_words(words: DataFrame, windows: int = WINDOWS, block: int = BLOCK) -> DataFrame:
    """``words(word, n)``, each word once → ``(word, n_near, best_n, best)`` per word
    that has a near word: how many, and the one of greatest n (ties: smallest
    in code-point order)."""
    rows = dealt(words, windows, block).repartition("length", "key").sortWithinPartitions("length", "key", "word")

    def compare(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        length = b.column("length").to_numpy()
        edges = np.r_[0, np.flatnonzero(length[1:] != length[:-1]) + 1, len(length)]
        for s, e in zip(edges[:-1], edges[1:]):
            part = b.slice(s, e - s)
            text, n = part.column("word").to_pylist(), part.column("n").to_numpy()
            x, y = near_in_groups(text, n, part.column("key").to_numpy(), part.column("side").to_numpy(),
                                  part.column("win").to_numpy().astype(np.int64), int(length[s]))
            row, count, other = best_by_row(x, y, n)
            if len(row):
                word = part.column("word")
                yield pa.RecordBatch.from_arrays(
                    [word.take(pa.array(row)), pa.array(count.astype(np.int64)), pa.array(n[other]), word.take(pa.array(other))],
                    names=["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < ROWS:
                continue
            both = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key, length = both.column("key").to_numpy(), both.column("length").to_numpy()
            open_from = np.flatnonzero((key != key[-1]) | (length != length[-1]))
            end = int(open_from[-1]) + 1 if len(open_from) else 0  # the last group may go on
            yield from compare(both.slice(0, end)) if end else ()
            held = [both.slice(end)]
        if held and (rest := pa.Table.from_batches(held).combine_chunks().to_batches()):
            yield from compare(rest[0])

    found = rows.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``forms(word, form)`` → ``(word, root)``: the last word reached by following
    forms.  A form is ``ratio`` times as frequent as its word, so paths are short
    and end; each round doubles the part of the path that is done."""
    ahead = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        after = cut(ahead.alias("a").join(ahead.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
                    .select("a.word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ahead = after.select("word", "root")
        if after.where("moved").isEmpty():
            return ahead


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
             ratio: int = 10, noise: int = 31) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per word of ``count_words``.
    ``form``: the near word of greatest n, if that is at least ``ratio`` times the
    word's; ``root``: the word at the end of the path of forms (the word itself
    without form); ``n_near``: near words, 0 if none.  Columns of ``docs`` beside id
    and text are not read; nulls, empty texts and tables as in ``count_words``;
    equal counts are settled by code-point order."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or paths of forms may not end")
    words = cut(count_words(docs, id_col, text_col, min_length, min_count, noise))
    ok = F.col("best_n") >= ratio * F.col("n")
    found = cut(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ok, F.col("best")).alias("form"),
        F.when(ok, F.col("best_n")).alias("form_n")))
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
