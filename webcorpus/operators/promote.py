"""W4 promotion: the evaluation gate (J6) and a real copy of the passed
datasets' staging vectors into production (an upsert, so re-promoting is
idempotent)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.operators.vectors import VECTOR_COLUMNS, upsert_vectors


def promoted_rows(vectors: DataFrame, report: DataFrame) -> DataFrame:
    """The production copies of the staging rows of every dataset that passed
    (``left_semi`` on the passed datasets — a small, size-checked side)."""
    passed = report.where("passed").select("dataset")
    staged = vectors.where(F.col("namespace") == "staging").join(passed, "dataset", "left_semi")
    return staged.withColumn("namespace", F.lit("production"))


def promotion_result(copies: DataFrame, report: DataFrame) -> DataFrame:
    """Per dataset: ``success``, ``reason`` (``evaluation_failed``) and
    ``n_copied``."""
    copied = copies.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_copied"))
    return (report.select("dataset", "passed").join(copied, "dataset", "left")
            .select("dataset", F.col("passed").alias("success"),
                    F.when(~F.col("passed"), F.lit("evaluation_failed")).alias("reason"),
                    F.coalesce("n_copied", F.lit(0)).cast("bigint").alias("n_copied")))


def promote(vectors: DataFrame, report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Returns ``(next vector snapshot, result per dataset)``."""
    copies = promoted_rows(vectors, report)
    snapshot = upsert_vectors(vectors.select(*VECTOR_COLUMNS), copies.select(*VECTOR_COLUMNS))
    return snapshot, promotion_result(copies, report)
