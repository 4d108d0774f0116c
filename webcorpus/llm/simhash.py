"""Near-duplicate documents by 64-bit SimHash and a binary trie self-join.

Fingerprints are computed in tasks (one narrow row per document).  Their
distinct values are dealt by each of four 16-bit blocks in turn: two values
at most three bits apart agree on at least one block, so a task that holds
all values with that block can find the pair.  There the sorted values are a
binary trie (a node is a range of rows), and the trie is joined with itself:
pairs of nodes go down together bit by bit, the number of differing bits is
carried along, and a pair of nodes is dropped as soon as it exceeds the
budget.  Each task returns a spanning forest of the links it found, not the
links, so a dense group of n values costs n rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import as_bytes, cut, lower_words, slices, spare
from webcorpus.llm.components import connected_components

SEED = 42
#: Node pairs held at a time while two tries go down together.
FRONT = 1 << 20
#: Fingerprints joined at a time in a task (whole blocks; a larger block is taken alone).
TASK_ROWS = 1 << 20


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """XXH64 (seed 42) of each ``k``-word shingle; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64)


def fold_bits(h: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += (np.ones(len(bits), np.float32) @ bits.astype(np.float32)).astype(np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, text_hash, fp)`` per row of ``docs``: the id as it is, XXH64 of the
    text (null: empty) and the signed 64-bit fingerprint."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fold_bits(shingle_hashes(lower_words(t), shingle)) for t in as_bytes(b.column("text"))],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_hash"), pa.array(fp)],
                                             names=["id", "text_hash", "fp"])

    kind = dict(src.dtypes)["id"]
    return src.mapInArrow(run, f"id {kind}, text_hash long, fp long")


def hook(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the pairs (a, b) into ``labels`` (each row's smallest known row)."""
    while len(a):
        la, lb = labels[a], labels[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(labels, high, low)
        while True:
            nxt = labels[labels]
            if np.array_equal(nxt, labels):
                break
            labels = nxt
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]
    return labels


def trie_links(values: np.ndarray, group: np.ndarray, distance: int) -> np.ndarray:
    """Labels of rows linked by at most ``distance`` differing bits within their
    group.  ``values``: sorted by (group, value), distinct within a group."""
    n = len(values)
    labels = np.arange(n)
    if n < 2:
        return labels
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], n]
    keep = ends - starts > 1
    lo, hi = starts[keep], ends[keep]
    #: bit level → rows before a given one whose bit is zero
    zeros: dict[int, np.ndarray] = {}

    def split(lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        if bit not in zeros:
            zeros[bit] = np.r_[0, np.cumsum((values >> np.uint64(bit)) & np.uint64(1) == 0)]
        z = zeros[bit]
        return lo + (z[hi] - z[lo])

    # (level, low a, high a, low b, high b, bits that differ): nodes a <= b of one group
    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, al, ah, bl, bh, err = stack.pop()
        if not len(al):
            continue
        if len(al) > FRONT:
            half = len(al) // 2
            stack += [(bit, *(x[:half] for x in (al, ah, bl, bh, err))), (bit, *(x[half:] for x in (al, ah, bl, bh, err)))]
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():
            x, y = al[single], bl[single]
            far = np.bitwise_count(values[x] ^ values[y])
            near = (far <= distance) & (x != y)
            labels = hook(labels, x[near], y[near])
            al, ah, bl, bh, err = (v[~single] for v in (al, ah, bl, bh, err))
        if bit < 0 or not len(al):  # at bit -1 nodes are single values
            continue
        am, bm, own = split(al, ah, bit), split(bl, bh, bit), al == bl
        sides = [(al, am, bl, bm, err, None), (am, ah, bm, bh, err, None), (al, am, bm, bh, err + 1, None),
                 (am, ah, bl, bm, err + 1, ~own)]  # a node with itself has its two halves once
        parts = []
        for p, q, r, s, e, also in sides:
            ok = (q > p) & (s > r) & (e <= distance) & ~((p == r) & (q - p == 1))
            ok = ok if also is None else ok & also
            parts.append(tuple(v[ok] for v in (p, q, r, s, e)))
        stack.append((bit - 1, *(np.concatenate(c) for c in zip(*parts))))
    return labels


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Distinct fingerprints ``(fp)`` → links ``(a, b)`` that join exactly the
    values connected by at most ``distance`` differing bits."""
    blocks = distance + 1
    width = 64 // blocks
    mask = (1 << width) - 1
    # value turned so that the shared block comes first; the block's number and value deal it out
    turned = fps.select("fp", F.explode(F.array(*(F.lit(i) for i in range(blocks)))).alias("block"))
    turned = turned.withColumn("part", F.call_function("shiftrightunsigned", F.col("fp"), F.col("block") * width).bitwiseAND(F.lit(mask)))
    dealt = turned.repartition(F.col("block"), F.col("part")).sortWithinPartitions("block", "part")

    def join(block: list[np.ndarray], fp: list[np.ndarray]) -> pa.RecordBatch | None:
        group, value = np.concatenate(block), np.concatenate(fp).view(np.uint64)
        order = np.lexsort((value, group))
        group, value = group[order], value[order]
        labels = trie_links(value, group, distance)
        other = np.flatnonzero(labels != np.arange(len(labels)))
        if not len(other):
            return None
        v = value.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(v[other]), pa.array(v[labels[other]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[np.ndarray] = []
        values: list[np.ndarray] = []
        held = 0
        for b in batches:
            g = b.column("block").to_numpy(zero_copy_only=False).astype(np.int64) * (mask + 1) + b.column("part").to_numpy()
            v = b.column("fp").to_numpy()
            groups.append(g)
            values.append(v)
            held += len(g)
            if held >= TASK_ROWS and g[-1] != groups[0][0]:
                # all but the last block, which may go on in the next batch
                g, v = np.concatenate(groups), np.concatenate(values)
                end = int(np.flatnonzero(g != g[-1])[-1]) + 1
                if (out := join([g[:end]], [v[:end]])) is not None:
                    yield out
                groups, values, held = [g[end:]], [v[end:]], len(g) - end
        if held and (out := join(groups, values)) is not None:
            yield out

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """``(id, text_hash, fp, component_id)`` per row of ``docs``; documents whose
    fingerprints differ in at most ``distance`` bits are linked, and
    ``component_id`` is the smallest id reachable.

    Null or blank text: fingerprint zero, linked like any other.  Repeated
    rows and ids: every row is returned.  A null id takes part in links but
    is never the smallest; a component without any id has a null
    ``component_id``.  An empty table gives no rows.
    """
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    per_fp = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    nodes = connected_components(links(per_fp.select("fp"), distance)).withColumnRenamed("node", "fp")
    labelled = per_fp.join(nodes, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(least, "label").select("fp", "label", "component_id")
    return rows.join(by_fp, "fp").select("id", "text_hash", "fp", "component_id", F.col("label").alias("component_fp"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             distance: int = 3) -> DataFrame:
    """The rows of ``docs`` with one row left of each group of near-duplicates:
    that of the smallest id, ties (and groups without ids) by text hash; of
    fully repeated rows one stays.  Columns as in ``docs``."""
    found = near_duplicates(docs, id_col, text_col, shingle, distance)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash"))
    kept = found.groupBy("component_fp").agg(first.alias("k"))
    key, own, got = (spare(docs, c) for c in ("row_key", "kept_id", "kept_hash"))
    text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    kept = kept.select(F.xxhash64("k.id", "k.text_hash").alias(key), F.col("k.id").alias(own),
                       F.col("k.text_hash").alias(got))
    rows = docs.withColumn(key, F.xxhash64(F.col(id_col), text)).alias("d")
    one = rows.join(kept.alias("k"), key).where(F.col(id_col).eqNullSafe(F.col(own)) & (text == F.col(got)))
    return one.dropDuplicates([key, own, got]).select(*docs.columns)
