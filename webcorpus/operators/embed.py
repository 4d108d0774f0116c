"""C16 embedding providers.

* ``hashed_embedding`` — the default, native provider: the text's tokens
  (lower-cased, same token rule as the counter) are hashed into ``dim``
  buckets by ``sha256``, counted, and scaled to unit length.  Pure column
  expressions, so it stays in the JVM and DuckDB can restate it exactly.
* ``model_embedding`` — a user-supplied model behind an iterator Pandas UDF:
  the model is built once per Python worker and fed Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.functions import patterns as P

DIM = 64


def token_buckets(text: Column, dim: int = DIM) -> Column:
    """Bucket number of every token of ``text``."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(P.TOKEN), 0)
    return F.transform(toks, lambda t: F.pmod(
        F.conv(F.substring(F.sha2(t, 256), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int"))


def hashed_embedding(text: Column, dim: int = DIM) -> Column:
    """Unit-length bag-of-hashed-tokens vector (``array<double>``; all zeros
    for a text without tokens).

    The buckets are sorted once; the places where they change end the runs
    of equal ones, whose lengths are the counts."""
    def counted(s: Column) -> Column:
        last = F.zip_with(s, F.concat(F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), F.array(F.lit(-1))),
                          lambda a, b: F.when(a != b, a))
        ends = F.filter(F.transform(last, lambda b, i: F.struct(b.alias("b"), (i + 1).alias("e"))),
                        lambda x: x["b"].isNotNull())
        return _let(ends, by_bucket)

    def by_bucket(ends: Column) -> Column:
        runs = F.transform(ends, lambda x, i: x["e"] - F.when(i > 0, F.get(ends, i - 1)["e"]).otherwise(F.lit(0)))
        norm = F.sqrt(F.aggregate(runs, F.lit(0.0), lambda acc, c: acc + c.cast("double") * c))
        values = F.zip_with(runs, F.array_repeat(norm, dim), lambda c, n: c / n)
        return _let(F.map_from_arrays(F.transform(ends, lambda x: x["b"]), F.filter(values, lambda v: v.isNotNull())),
                    lambda m: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                                          lambda d: F.coalesce(F.try_element_at(m, d), F.lit(0.0))))

    return _let(F.array_sort(token_buckets(text, dim)), counted)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda's variable, which the
    optimizer does not inline."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def with_hashed_embedding(df: DataFrame, text_col: str = "text", out_col: str = "embedding",
                          dim: int = DIM) -> DataFrame:
    return df.withColumn(out_col, hashed_embedding(F.col(text_col), dim))


def hashed_embedder(dim: int = DIM):
    """The default provider: ``(df, text_col, out_col) -> df``."""
    def embed(df: DataFrame, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
        return with_hashed_embedding(df, text_col, out_col, dim)
    return embed


def model_embedder(make_model: Callable[[], Callable[[list[str]], np.ndarray]], dim: int):
    """Provider for a user model: ``make_model()`` runs once per Python
    worker and returns ``texts -> (n, dim) array``; batches come as Arrow."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            out = np.asarray(model(texts.fillna("").tolist()), dtype=np.float32).reshape(len(texts), dim)
            yield pd.Series(list(out))

    def provider(df: DataFrame, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
        return df.withColumn(out_col, embed(F.col(text_col)))

    return provider
