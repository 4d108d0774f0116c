"""Exact top-k search by distributed histogram selection.

Vectors are turned into integers once and written, each row with a number of
its own.  Every query meets every vector in blocks: vector blocks are dealt to
salts, query blocks go to each salt, and a pair of blocks is one matrix product
(exact: single precision as long as scores stay under 2^24, double under 2^53,
else 64-bit integers).  Scores are never stored.  Each round scores everything
and counts scores in ``BINS`` equal bins per query: the first round over the
range that the greatest norms allow, the next ones inside the bin that holds
the query's kth score, until a bin is one score wide.  A task sends only its
topmost bins up to the number wanted (lower ones can't hold the kth score of all
rows), at most k rows a query however large its block is.  A last round keeps
what is above the kth score, and of the scores equal to it the smallest ids.

Equal scores by the million (one vector repeated) cost nothing more: a task
sends at most k of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.common import cut

#: Bins of a round (a power of two), rows of a block, bytes of a block and of the blocks that a packing task holds.
BINS, QUERY_ROWS, VECTOR_ROWS, BLOCK_BYTES, HELD_BYTES = 256, 512, 4096, 4 << 20, 64 << 20
#: No id sorts behind every id.
LAST = (1 << 63) - 1


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``(row, id, dim, vec)``: each row's number, id (as long) and
    ``floor(scale * x)`` of its components, as a written table.  Rows whose vector is null or holds null
    or non-finite components are left out; so are components beyond 2^62
    (an error: their scores fit no long)."""
    vec = F.col(vector_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    scaled = F.transform(vec, lambda x: F.floor(scale * x.cast("double")))
    safe = F.forall(vec, lambda x: F.abs(scale * x.cast("double")) < 2.0 ** 62)
    checked = F.when(safe, scaled).otherwise(F.raise_error(F.lit("a component is beyond 2^62: scores would not fit a long")))
    kept = rows.where(vec.isNotNull() & F.coalesce(finite, F.lit(False)))
    return cut(kept.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                           F.size(vector_col).alias("dim"), checked.alias("vec")))


def packed(df: DataFrame, limit: int) -> DataFrame:
    """``df(row, id, dim, vec, low, width, need)`` → blocks of one dimension: ``(dim, rows, ids, vecs,
    low, width, need)``, lists of at most ``limit`` entries and a binary of 64-bit components.  Narrow."""
    names = ["row", "id", "low", "width", "need"]

    def block(dim: int, parts: list) -> Iterator[pa.RecordBatch]:
        cols, m = [np.concatenate([p[0][c] for p in parts]) for c in range(len(names))], np.concatenate([p[1] for p in parts])
        step = max(1, min(limit, BLOCK_BYTES // (8 * max(dim, 1))))
        for i in range(0, len(m), step):
            lists = [pa.array([c[i:i + step]], pa.list_(pa.int64())) for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *lists, pa.array([m[i:i + step].tobytes()], pa.binary())],
                                             names=["dim", *(f"{n}s" for n in names), "vecs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = b.take(pa.array(np.flatnonzero(dims == dim)))
                cols = [at.column(n).fill_null(LAST).to_numpy(zero_copy_only=False) for n in names]
                m = at.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(at.num_rows, dim)
                held.setdefault(int(dim), []).append((cols, m))
                size += m.nbytes
                if sum(len(p[1]) for p in held[int(dim)]) >= limit:
                    full = held.pop(int(dim))
                    size -= sum(p[1].nbytes for p in full)
                    yield from block(int(dim), full)
            if size > HELD_BYTES:
                for dim, parts in held.items():
                    yield from block(dim, parts)
                held, size = {}, 0
        for dim, parts in held.items():
            yield from block(dim, parts)

    kept = df.select("row", "id", "dim", "vec", *(F.col(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in names[2:]))
    return kept.mapInArrow(run, "dim int, " + ", ".join(f"{n}s array<long>" for n in names) + ", vecs binary")


def product(q: np.ndarray, v: np.ndarray, reach: int) -> np.ndarray:
    """Inner products, exact as long as none is over ``reach`` in size."""
    kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
    return q.astype(kind) @ v.astype(kind).T


def scored(queries: DataFrame, vectors: DataFrame, reach: int, salts: int, each: Callable, schema: str) -> DataFrame:
    """All pairs of blocks of one dimension, through ``each(query block, rows of the vectors, ids, scores)``."""
    v = packed(vectors, VECTOR_ROWS).select("dim", F.col("rows").alias("vrows"), F.col("ids").alias("vids"), F.col("vecs").alias("vvecs"),
                                            F.pmod(F.xxhash64("rows"), F.lit(salts)).cast("int").alias("salt"))
    q = packed(queries, QUERY_ROWS).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column("dim")[i].as_py()
                own = {c: b.column(c)[i].values.to_numpy() for c in ("rows", "ids", "lows", "widths", "needs", "vrows", "vids")}
                m = [np.frombuffer(b.column(c)[i].as_buffer(), np.int64).reshape(-1, dim) if dim else np.zeros((len(own[n]), 0), np.int64)
                     for c, n in (("vecs", "rows"), ("vvecs", "vrows"))]
                s = product(*m, reach)
                s = s if s.dtype != np.int64 else s.astype(np.int64)
                # the query's own row takes no part: it sorts below every score
                where = {r: j for j, r in enumerate(own["vrows"])}
                mask = np.ones(s.shape, bool)
                for j, r in enumerate(own["rows"]):
                    if (k := where.get(r)) is not None:
                        mask[j, k] = False
                if (out := each(own, s, mask)) is not None:
                    yield out

    return q.join(v, ["dim", "salt"]).mapInArrow(run, schema)


def count_bins(own: dict, s: np.ndarray, mask: np.ndarray) -> pa.RecordBatch | None:
    """Per query its topmost bins, until they hold as many scores as it still needs."""
    low, width, need = own["lows"][:, None], own["widths"][:, None], own["needs"]
    inside = mask & (s >= low) & (s < low + BINS * width)
    row, col = np.nonzero(inside)
    if not len(row):
        return None
    bins = (s[row, col].astype(np.int64) - own["lows"][row]) // own["widths"][row]
    cell, held = np.unique(row * BINS + bins, return_counts=True)
    row, bins = cell // BINS, cell % BINS
    # counts of the bins above, within a query
    total = np.cumsum(held)
    end = np.searchsorted(row, row, "right") - 1
    above = total[end] - total
    keep = above < need[row]
    return pa.RecordBatch.from_arrays([pa.array(own["rows"][row[keep]]), pa.array(bins[keep]), pa.array(held[keep])],
                                      names=["row", "bin", "held"])


def keep_best(own: dict, s: np.ndarray, mask: np.ndarray) -> pa.RecordBatch | None:
    """Scores above a query's kth score (``low``), and the smallest ids of those equal to it."""
    row, col = np.nonzero(mask & (s >= own["lows"][:, None]))
    if not len(row):
        return None
    score = s[row, col].astype(np.int64)
    order = np.lexsort((own["vrows"][col], own["vids"][col], -score, row))
    row, col, score = row[order], col[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < own["needs"][row]
    row, col, score = row[keep], col[keep], score[keep]
    return pa.RecordBatch.from_arrays([pa.array(own["rows"][row]), pa.array(own["vrows"][col]), pa.array(own["vids"][col]), pa.array(score)],
                                      names=["row", "vrow", "vec", "score"])


def search(queries: DataFrame, vectors: DataFrame, k: int = 20, salts: int | None = None) -> DataFrame:
    """``queries`` and ``vectors(row, id, dim, vec)`` (of ``integer_vectors``) → ``(row, query_id, rank, vec_id,
    score)``: each query's ``k`` greatest inner products with vectors of its dimension
    other than its own row (all, if fewer), ties to the smaller id, then to the earlier row; null ids come last.

    Two rows of one id are two queries, each a candidate of the other.  An
    empty table gives no rows.
    """
    if k < 1:
        return queries.select("row", F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    spark = queries.sparkSession
    salts = salts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    norm = F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    q_norm, v_norm = (d.agg(F.sqrt(norm)).first()[0] or 0.0 for d in (queries, vectors))  # two numbers
    reach = int(q_norm * v_norm * (1 + 1e-9)) + 1
    if reach >= 1 << 62:
        raise ValueError("scores would not fit a long")
    width = 1
    while BINS * width < 2 * reach + 1:
        width *= BINS
    state = queries.select("row", F.lit(-reach).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    while True:
        asked = queries.join(state, "row").withColumn("width", F.lit(width).cast("long"))
        counts = scored(asked, vectors, reach, salts, count_bins, "row long, bin long, held long").groupBy("row", "bin").agg(F.sum("held").alias("held"))
        down = Window.partitionBy("row").orderBy(F.col("bin").desc())
        ranked = counts.withColumn("upto", F.sum("held").over(down)).join(state, "row")
        kth = ranked.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("held") < F.col("need")))
        found = kth.select("row", (F.col("low") + F.col("bin") * width).alias("at"), (F.col("need") - F.col("upto") + F.col("held")).alias("left"))
        # a query with fewer candidates than wanted keeps its lower end, and so all of them
        state = cut(state.join(found, "row", "left").select("row", F.coalesce("at", "low").alias("low"), F.coalesce("left", "need").alias("need")))
        if width == 1:
            break
        width = max(1, width // BINS)
    asked = queries.join(state.select("row", "low"), "row").withColumns({"width": F.lit(1).cast("long"), "need": F.lit(k).cast("long")})
    best = scored(asked, vectors, reach, salts, keep_best, "row long, vrow long, vec long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec", "vrow")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(queries.select("row", F.col("id").alias("query_id")), "row").select(
        "row", "query_id", "rank", F.when(F.col("vec") != LAST, F.col("vec")).alias("vec_id"), "score")


def top_k(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64,
          salts: int | None = None) -> DataFrame:
    """The rows of ``rows`` whose id meets ``is_query`` (over a column ``id``) against all
    rows; see ``integer_vectors`` and ``search``.  Other columns are not read."""
    vectors = integer_vectors(rows, id_col, vector_col, scale)
    return search(vectors.where(is_query), vectors, k, salts)
