"""K1–K3 exact top-k similarity search, P3/P4 filters, C13 citations.

Many queries against many vectors, in blocks: both sides are packed into
blocks of unit vectors, each of one namespace, dataset and dimension, of
bounded rows and bytes.  Blocks of the same key meet in a join (vector blocks
are spread over ``salts``, query blocks go to every salt, so that one large
dataset is scored by many tasks), and each pair of blocks is one matrix
product that keeps the ``top_k`` best per query, ties cut by id.  Only ids
and scores leave it.  ``row_number() <= top_k`` per query (partial and final
``WindowGroupLimit``) picks the global top k, and the winners alone fetch
their payload (URL, title, text) from the vector table.

Filters on vector metadata and the namespace are plain ``where`` clauses on
the vector scan, so Parquet pushdown / partition pruning applies before any
scoring.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20       # of vectors in a block, at most
QUERY_BLOCK_ROWS = 1024     # a tile of scores is ≤ 1,024 × 2,048 doubles
VECTOR_BLOCK_ROWS = 2048
HELD_BYTES = 64 << 20       # of vectors that a packing task holds in unfinished blocks
SALTS = 16                  # tasks a dataset's vector blocks are dealt to before AQE splits further
TOP_K = 5
KEY = ("namespace", "dataset", "dim")


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.where(norms > 0, m / np.where(norms > 0, norms, 1.0), 0.0)
    return out


def _packed(df: DataFrame, key: Sequence[str], ident: str, kind: str, rows: int) -> DataFrame:
    """``(*key, ids array<kind>, vectors binary)``: the rows of ``df`` (``*key, ident,
    embedding``; ``dim`` in the key) in blocks of at most ``rows`` rows and
    ``BLOCK_BYTES``, sorted by ``ident``.  Narrow: blocks are filled within a task."""
    key = list(key)
    df = df.select(*key, ident, "embedding")
    at = key.index("dim")
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in key) + f", ids array<{kind}>, vectors binary"
    arrow_kind = pa.int64() if kind == "bigint" else pa.string()
    kinds = [pa.int32() if c in ("dim", "top_k") else pa.string() for c in key]

    def block(k: tuple, parts: list) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([p[0] for p in parts])
        order = np.argsort(ids, kind="stable")
        ids, m = ids[order], np.concatenate([p[1] for p in parts])[order]
        step = max(1, min(rows, BLOCK_BYTES // (8 * k[at])))
        for i in range(0, len(ids), step):
            cols = [pa.array([v], t) for v, t in zip(k, kinds)]
            cols += [pa.array([ids[i:i + step].tolist()], pa.list_(arrow_kind)), pa.array([m[i:i + step].tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[*key, "ids", "vectors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        for b in batches:
            groups: dict[tuple, list[int]] = {}
            for i, k in enumerate(zip(*(b.column(c).to_pylist() for c in key))):
                groups.setdefault(k, []).append(i)
            for k, pos in groups.items():
                picked = b.take(pa.array(pos, pa.int64()))
                flat = picked.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                ids = np.array(picked.column(ident).to_pylist(), dtype=np.int64 if kind == "bigint" else object)
                held.setdefault(k, []).append((ids, _unit(flat.reshape(len(pos), k[at]))))
                size += flat.nbytes
                if sum(len(p[0]) for p in held[k]) >= rows:
                    full = held.pop(k)
                    size -= sum(p[1].nbytes for p in full)
                    yield from block(k, full)
            if size > HELD_BYTES:
                for k, parts in held.items():
                    yield from block(k, parts)
                held, size = {}, 0
        for k, parts in held.items():
            yield from block(k, parts)

    return df.mapInArrow(run, schema)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` greatest scores; of equal scores at
    the cut the leftmost stay."""
    width = scores.shape[1]
    if width <= k:
        return np.nonzero(np.ones_like(scores, dtype=bool))
    cut = np.partition(scores, width - k, axis=1)[:, width - k, None]
    keep = scores >= cut
    for r in np.flatnonzero(keep.sum(axis=1) > k):
        ties = np.flatnonzero(scores[r] == cut[r])
        keep[r, ties[k - int((scores[r] > cut[r]).sum()):]] = False
    return np.nonzero(keep)


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks → each query's best within the vector block."""
    for b in batches:
        for i in range(b.num_rows):
            k, dim = b.column("top_k")[i].as_py(), b.column("dim")[i].as_py()
            q, v = (np.frombuffer(b.column(c)[i].as_buffer()).reshape(-1, dim) for c in ("q_vectors", "vectors"))
            if k <= 0:
                continue
            scores = q @ v.T
            row, col = _best(scores, k)
            yield pa.RecordBatch.from_arrays(
                [b.column("qids")[i].values.take(pa.array(row)), b.column("ids")[i].values.take(pa.array(col)),
                 pa.array(scores[row, col]), pa.array(np.full(len(row), k, dtype=np.int32)),
                 pa.array([b.column("namespace")[i].as_py()] * len(row), pa.string()),
                 pa.array([b.column("dataset")[i].as_py()] * len(row), pa.string())],
                names=["qid", "id", "score", "top_k", "namespace", "dataset"])


def topk_search(queries: DataFrame, vectors: DataFrame, k: int = TOP_K,
                payload: Sequence[str] = ("url", "title", "text", "chunk_index"),
                query_rows: int = QUERY_BLOCK_ROWS, vector_rows: int = VECTOR_BLOCK_ROWS,
                salts: int = SALTS) -> DataFrame:
    """``qid, rank, id, score, payload…`` — the ``top_k`` vectors (null:
    ``k``) of each query within the query's namespace and dataset, by score
    descending, then id.  A query and a vector meet only if their embeddings
    have the same dimension; null and empty embeddings, and those with a null
    in them, match nothing.

    ``queries``: ``qid bigint, namespace, dataset, top_k, embedding``;
    ``vectors``: ``namespace, dataset, id, embedding, payload…``, an id once in
    a namespace and dataset (as an upsert leaves them).
    """
    whole = (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull())
    dim = F.size("embedding").alias("dim")
    asked = queries.withColumn("top_k", F.coalesce("top_k", F.lit(k)).cast("int"))
    # one row: the greatest top_k and the few namespaces (staging, production) to be scanned
    most, names = asked.agg(F.max("top_k"), F.collect_set("namespace")).first()
    here = vectors.where(F.col("namespace").isin(names or [""]))
    q = asked.where(whole & F.col("qid").isNotNull()).select("namespace", "dataset", dim, "top_k", "qid", "embedding")
    v = here.where(whole & F.col("id").isNotNull()).select("namespace", "dataset", dim, "id", "embedding")
    v = v.join(queries.select("namespace", "dataset").distinct(), ["namespace", "dataset"], "left_semi")
    salt = F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int")
    v_blocks = _packed(v, KEY, "id", "string", vector_rows).withColumn("salt", salt)
    q_blocks = (_packed(q, (*KEY, "top_k"), "qid", "bigint", query_rows)
                .withColumnsRenamed({"ids": "qids", "vectors": "q_vectors"})
                .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    cand = q_blocks.join(v_blocks, [*KEY, "salt"]).mapInArrow(
        _score, "qid bigint, id string, score double, top_k int, namespace string, dataset string")
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    ranked = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= int(most or k))
    won = ranked.where(F.col("rank") <= F.col("top_k")).drop("top_k")
    if payload:
        won = won.join(here.select("namespace", "dataset", "id", *payload), ["namespace", "dataset", "id"])
    return won.select("qid", "rank", "id", "score", *payload)


def with_citation(hits: DataFrame) -> DataFrame:
    """``citation`` struct of ``url`` and ``title`` (empty when absent)."""
    return hits.withColumn("citation", F.struct(F.coalesce(F.col("url"), F.lit("")).alias("url"),
                                                F.coalesce(F.col("title"), F.lit("")).alias("title")))


def metadata_filter(vectors: DataFrame, **equals) -> DataFrame:
    """Equality predicates on vector metadata (and namespace)."""
    out = vectors
    for name, value in equals.items():
        out = out.where(F.col(name) == F.lit(value))
    return out


def topk_one(vectors: DataFrame, query_embedding: Sequence[float], dataset: str,
             namespace: str = "staging", k: int = TOP_K, filters: dict | None = None,
             payload: Sequence[str] = ("url", "title", "text", "chunk_index")) -> DataFrame:
    """K2: top ``k`` of one query — the API's ``query(embedding, dataset,
    top_k, namespace, filter)``.  The dataset is always forced into the
    filter; the score is a column expression against the literal query
    vector, and ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``
    (a per-partition top-k, then a k-row merge)."""
    from webcorpus.operators.vectors import cosine
    conds = dict(filters or {})
    conds["dataset"] = dataset
    v = metadata_filter(vectors.where(F.col("namespace") == namespace), **conds)
    q = F.array(*[F.lit(float(x)) for x in query_embedding])
    scored = v.select("id", cosine(q, F.col("embedding")).alias("score"), *payload)
    return (scored.orderBy(F.col("score").desc(), F.col("id").asc()).limit(k)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), F.col("id")))))
