"""J4/K3 approximate search: a partitioned index of cells and binary codes.

``fit`` finds cells by spherical k-means over all vectors of a dimension: each
round assigns every vector to its nearest centre in tasks, tasks send one
partial sum per cell, and the driver sees one row per cell (at most
``MAX_CELLS``).  ``build_index`` gives every vector its cell and a code: the signs
of its products with seeded random directions, so the share of differing bits
of two codes estimates their angle.  The index holds codes, not vectors: 64
bytes a vector whatever its dimension.

A search probes the cells nearest to a query, compares codes there
(``bitwise_count`` of xor, blocks against blocks; a block holds rows of up to 64
cells, so a query goes to a block of cells once, with a bit per probed cell), keeps per query the
``shortlist`` nearest codes overall, fetches those vectors alone and scores them
exactly.  Exactly scored pairs are thus at most ``shortlist`` a query, however many
vectors there are.  ``calibrate`` measures, on a bounded sample of queries against
exact search, in how many probes the true neighbours are found, and returns the
fewest that reach a target; where vectors have no clusters, that is most cells.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.operators.search import TOP_K, topk_search
from webcorpus.operators.vectors import cosine
from webcorpus.sources.tables import written

MAX_CELLS = 4096            # centres on the driver and in each task: at most 4,096 x dimension floats
ROUNDS = 4
BITS = 512
SHORTLIST = 6               # codes kept per result wanted
#: Rows of a block of codes or queries, cells of a block (bits of a long), queries of a calibration.
BLOCK_ROWS, BLOCK_CELLS, SAMPLE = 2048, 64, 256
SEED = 7


@dataclass(frozen=True)
class Cells:
    """Centres per dimension; the directions of codes follow from the seed."""
    centres: dict[int, np.ndarray]
    bits: int = BITS

    def directions(self, dim: int) -> np.ndarray:
        return np.random.default_rng([SEED, dim]).standard_normal((dim, self.bits)).astype(np.float32)

    def codes(self, m: np.ndarray) -> np.ndarray:
        return np.packbits(m.astype(np.float32) @ self.directions(m.shape[1]) > 0, axis=1)

    def nearest(self, m: np.ndarray, probes: int = 1) -> np.ndarray:
        """The ``probes`` nearest cells of each row, nearest first (ties: smaller cell)."""
        if probes == 1:
            return (m.astype(np.float32) @ self.centres[m.shape[1]].T).argmax(axis=1)[:, None]
        return np.argsort(-(m.astype(np.float32) @ self.centres[m.shape[1]].T), axis=1, kind="stable")[:, :probes]


def _whole() -> Column:
    vec = F.col("embedding")
    return (F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def _matrices(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of unit vectors) per dimension of a batch with ``embedding``."""
    col = b.column("embedding")
    sizes = np.diff(col.offsets.to_numpy())
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        m = col.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
        norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
        yield rows, m / np.where(norm > 0, norm, 1.0)


def fit(vectors: DataFrame, cells: int | None = None, rounds: int = ROUNDS, bits: int = BITS) -> Cells:
    """Cells of ``vectors(id, embedding)``, per dimension: about the square root of its
    number of vectors unless given, at most ``MAX_CELLS``.  First centres are the vectors of the smallest id
    hashes, so a rerun gives the same cells up to the order of float sums.
    An empty cell keeps its centre."""
    v = vectors.where(_whole()).select("id", "embedding")
    sizes = {r.dim: r.n for r in v.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {d: max(1, min(n, cells or round(n ** 0.5), MAX_CELLS)) for d, n in sizes.items()}
    centres: dict[int, np.ndarray] = {}
    for d, k in want.items():
        first = v.where(F.size("embedding") == d).orderBy(F.xxhash64("id"), "id").limit(k).collect()
        m = np.array([r.embedding for r in first], np.float64)
        norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
        centres[d] = m / np.where(norm > 0, norm, 1.0)
    for _ in range(rounds):
        model = Cells(dict(centres), bits)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                for _, m in _matrices(b):
                    d = m.shape[1]
                    cell = model.nearest(m)[:, 0]
                    part = total.setdefault(d, np.zeros((len(model.centres[d]), d)))
                    np.add.at(part, cell, m)
            for d, part in total.items():
                used = np.flatnonzero(part.any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), d, np.int32)), pa.array(used.astype(np.int32)), pa.array(part[used].tolist(), pa.list_(pa.float64()))],
                    names=["dim", "cell", "total"])

        parts = v.select("embedding").mapInArrow(sums, "dim int, cell int, total array<double>")
        at = parts.select("dim", "cell", F.posexplode("total").alias("pos", "x")).groupBy("dim", "cell", "pos").agg(F.sum("x").alias("x"))
        moved = at.groupBy("dim", "cell").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("c"))
        for r in moved.toLocalIterator():  # one row per cell
            c = np.array(r.c)
            norm = np.sqrt((c * c).sum())
            if norm > 0:
                centres[r.dim][r.cell] = c / norm
    return Cells(centres, bits)


def build_index(vectors: DataFrame, model: Cells) -> DataFrame:
    """``namespace, dataset, id, dim, cell, code`` of every vector with a whole embedding; write it
    partitioned by namespace and dataset, or by cell too, and searches prune it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, m in _matrices(b):
                if m.shape[1] not in model.centres:
                    raise ValueError(f"no cells were fitted for dimension {m.shape[1]}")
                picked = b.select(["namespace", "dataset", "id"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(np.full(len(rows), m.shape[1], np.int32)), pa.array(model.nearest(m)[:, 0].astype(np.int32)),
                     pa.array([c.tobytes() for c in model.codes(m)], pa.binary())],
                    names=["namespace", "dataset", "id", "dim", "cell", "code"])

    rows = vectors.where(_whole()).select("namespace", "dataset", "id", "embedding")
    return rows.mapInArrow(run, "namespace string, dataset string, id string, dim int, cell int, code binary")


def probed(queries: DataFrame, model: Cells, probes: int) -> DataFrame:
    """``namespace, dataset, qid, keep, dim, cell, place, code``: each query once per probed cell, nearest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, m in _matrices(b):
                if m.shape[1] not in model.centres:  # no vector of this dimension: no result
                    continue
                near = model.nearest(m, probes)
                n, p = near.shape
                picked = b.select(["namespace", "dataset", "qid", "keep"]).take(pa.array(np.repeat(rows, p)))
                codes = [c.tobytes() for c in model.codes(m)]
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(np.full(n * p, m.shape[1], np.int32)), pa.array(near.ravel().astype(np.int32)),
                     pa.array(np.tile(np.arange(p, dtype=np.int32), n)), pa.array([c for c in codes for _ in range(p)], pa.binary())],
                    names=["namespace", "dataset", "qid", "keep", "dim", "cell", "place", "code"])

    return queries.select("namespace", "dataset", "qid", "keep", "embedding").mapInArrow(
        run, "namespace string, dataset string, qid bigint, keep int, dim int, cell int, place int, code binary")


def asked_cells(queries: DataFrame, model: Cells, probes: int) -> DataFrame:
    """``namespace, dataset, qid, keep, dim, band, cells, code``: each query once per band of
    ``BLOCK_CELLS`` cells in which it probes any, with a bit per probed cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, m in _matrices(b):
                if m.shape[1] not in model.centres:  # no vector of this dimension: no result
                    continue
                near = model.nearest(m, probes)
                bits = np.zeros((len(m), -(-len(model.centres[m.shape[1]]) // BLOCK_CELLS)), np.uint64)
                for at in near.T:  # a query's probed cells differ
                    bits[np.arange(len(m)), at // BLOCK_CELLS] |= np.uint64(1) << (at % BLOCK_CELLS).astype(np.uint64)
                row, band = np.nonzero(bits)
                picked = b.select(["namespace", "dataset", "qid", "keep"]).take(pa.array(rows[row]))
                codes = pa.array([c.tobytes() for c in model.codes(m)], pa.binary()).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(np.full(len(row), m.shape[1], np.int32)), pa.array(band.astype(np.int32)), pa.array(bits[row, band].view(np.int64)), codes],
                    names=["namespace", "dataset", "qid", "keep", "dim", "band", "cells", "code"])

    return queries.select("namespace", "dataset", "qid", "keep", "embedding").mapInArrow(
        run, "namespace string, dataset string, qid bigint, keep int, dim int, band int, cells bigint, code binary")


BAND = ("namespace", "dataset", "dim", "band")


def _parts(rows: DataFrame) -> DataFrame:
    """``BAND, parts``: blocks of about ``BLOCK_ROWS`` rows that each band is dealt to."""
    return rows.groupBy(*BAND).agg(F.greatest(F.lit(1), F.round(F.count(F.lit(1)) / BLOCK_ROWS)).cast("int").alias("parts"))


def _blocks(rows: DataFrame, parts: DataFrame, ident: str, *cols: str) -> DataFrame:
    """Rows of a band in lists, dealt by the hash of ``ident`` (no band is gathered whole): ``BAND, part`` and the lists."""
    part = F.pmod(F.xxhash64(ident), F.col("parts")).cast("int")
    rows = rows.join(parts, [*BAND]).withColumn("part", part)
    return rows.groupBy(*BAND, "part").agg(F.collect_list(F.struct(ident, *cols)).alias("rows")).select(
        *BAND, "part", *(F.col(f"rows.{c}").alias(c) for c in (ident, *cols)))


def _near_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks → each query's nearest codes of the block in its cells, as many as it keeps
    (ties by id, so the result doesn't hang on how blocks were filled)."""
    for b in batches:
        for i in range(b.num_rows):
            ids = b.column("id")[i].values
            by_id = np.argsort(np.array(ids.to_pylist(), object), kind="stable")
            ids = ids.take(pa.array(by_id))
            q, v = (np.frombuffer(b"".join(b.column(c)[i].as_py()), np.uint8).reshape(len(b.column(c)[i].values), -1).view(np.uint64)
                    for c in ("q_code", "code"))
            v, cell = v[by_id], b.column("cell")[i].values.to_numpy()[by_id] % BLOCK_CELLS
            cells = b.column("cells")[i].values.to_numpy().view(np.uint64)
            none = (q.shape[1] * 64 + 1) * len(v)
            far = np.full((len(q), len(v)), none, np.int32)
            for c in np.unique(cell):
                row, col = np.flatnonzero(cells >> np.uint64(c) & np.uint64(1)), np.flatnonzero(cell == c)
                differ = np.zeros((len(row), len(col)), np.int32)
                for w in range(q.shape[1]):
                    differ += np.bitwise_count(q[row, w, None] ^ v[None, col, w])
                far[row[:, None], col] = differ * len(v) + col
            qids, keep = b.column("qid")[i].values, b.column("keep")[i].values.to_numpy()
            most = min(len(v), int(keep.max()))
            col = np.argpartition(far, most - 1, axis=1)[:, :most] if most < len(v) else np.tile(np.arange(len(v)), (len(q), 1))
            row = np.repeat(np.arange(len(q)), most)
            col = col.ravel()
            met = far[row, col] < none
            row, col = row[met], col[met]
            yield pa.RecordBatch.from_arrays(
                [qids.take(pa.array(row)), pa.array(keep[row]), ids.take(pa.array(col)), pa.array((far[row, col] // len(v)).astype(np.int32))],
                names=["qid", "keep", "id", "far"])


def candidates(queries: DataFrame, index: DataFrame, model: Cells, probes: int) -> DataFrame:
    """``qid, id``: each query's (``keep``) nearest codes among its probed cells."""
    here = index.join(queries.select("namespace", "dataset").distinct(), ["namespace", "dataset"], "left_semi")
    here = here.withColumn("band", F.floor(F.col("cell") / BLOCK_CELLS).cast("int"))
    asked = written(asked_cells(queries, model, probes))
    parts = _parts(here)
    # each block of queries meets each block of codes of its band
    q = _blocks(asked, _parts(asked), "qid", "keep", "cells", "code").withColumnRenamed("code", "q_code").drop("part")
    q = q.join(parts.select(*BAND, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), [*BAND])
    v = _blocks(here, parts, "id", "cell", "code")
    near = q.join(v, [*BAND, "part"]).select("qid", "keep", "cells", "q_code", "id", "cell", "code").mapInArrow(
        _near_codes, "qid bigint, keep int, id string, far int")
    w = Window.partitionBy("qid").orderBy("far", "id")
    return near.withColumn("place", F.row_number().over(w)).where(F.col("place") <= F.col("keep")).select("qid", "id")


def approx_search(queries: DataFrame, vectors: DataFrame, index: DataFrame, model: Cells, probes: int, k: int = TOP_K,
                  shortlist: int = SHORTLIST, payload: Sequence[str] = ("url", "title", "text", "chunk_index")) -> DataFrame:
    """``qid, rank, id, score, payload…`` as ``topk_search`` gives them, for nearly all of its
    rows; scores are exact.  ``queries`` and ``vectors`` as there; ``index`` of ``build_index`` over ``vectors``."""
    asked = queries.withColumn("top_k", F.coalesce("top_k", F.lit(k)).cast("int")).where(_whole() & F.col("qid").isNotNull() & (F.col("top_k") > 0))
    short = candidates(asked.withColumn("keep", (F.col("top_k") * shortlist).cast("int")), index, model, probes)
    pairs = short.join(asked.select("qid", "namespace", "dataset", "top_k", F.col("embedding").alias("q_emb")), "qid")
    found = pairs.join(vectors.select("namespace", "dataset", "id", "embedding", *payload), ["namespace", "dataset", "id"])
    scored = found.select("qid", "top_k", "id", cosine(F.col("q_emb"), F.col("embedding")).alias("score"), *payload)
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.col("top_k"))
    return ranked.select("qid", "rank", "id", "score", *payload)


def calibrate(queries: DataFrame, vectors: DataFrame, index: DataFrame, model: Cells, k: int = TOP_K, target: float = 0.97,
              sample: int = SAMPLE) -> int:
    """The fewest probes after which ``target`` of the exact top ``k`` of ``sample`` queries (those of the
    smallest id hashes) lie in probed cells.  The driver sees one count per place."""
    some = queries.where(_whole() & F.col("qid").isNotNull()).orderBy(F.xxhash64("qid"), "qid").limit(sample)
    truth = topk_search(some.withColumn("top_k", F.lit(k)), vectors, k, payload=()).select("qid", "id")
    most = max((len(c) for c in model.centres.values()), default=1)
    order = probed(some.withColumn("keep", F.lit(k)), model, most).select("namespace", "dataset", "qid", "dim", "cell", "place")
    at = truth.join(order.select("qid", "namespace", "dataset", "dim", "cell", "place"), "qid").join(
        index.select("namespace", "dataset", "id", "dim", "cell"), ["namespace", "dataset", "id", "dim", "cell"])
    counts = {r.place: r.n for r in at.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, seen = sum(counts.values()), 0
    for place in sorted(counts):
        seen += counts[place]
        if seen >= target * total:
            return place + 1
    return most
