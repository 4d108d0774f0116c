"""Tables that grow by numbered runs: plain Parquet, partitioned by run, read
as the newest run of every key.

A run only adds files (``{root}/run=7/dataset=a/…``), so no job rewrites what
earlier runs left, however large a dataset is, and Spark's own partition
discovery and job commit do the work: a run that died leaves nothing that is read
or is written again under the same number (dynamic partition overwrite).  What
counts is decided at read time by a narrow aggregate, the greatest run of each
key, joined back to the rows; earlier rows of the key, and rows that a later
run no longer has, drop out by themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = T.StructField("run", T.LongType())


def newest_rows(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of each key's greatest ``run``."""
    last = rows.groupBy(*key).agg(F.max("run").alias("run")).select(*(F.col(k).alias(f"_{k}") for k in key), F.col("run").alias("_run"))
    same = F.col("run") == F.col("_run")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(last, same, "left_semi")


class RunTable:
    """Rows of ``schema`` under ``root``, partitioned by run and ``parts`` (strings); ``key`` names what a later run
    replaces.  One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: Sequence[str], parts: Sequence[str] = ()):
        self.spark, self.root, self.key, self.parts = spark, root.rstrip("/"), tuple(key), tuple(parts)
        self.schema = T.StructType([*schema.fields, RUN])

    def rows(self) -> DataFrame:
        """All rows of all runs, with their ``run`` (none before the first run)."""
        try:
            # partition values keep the types of the schema: no inference, no session setting
            return self.spark.read.schema(self.schema).parquet(self.root).select(*self.schema.fieldNames())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def newest(self) -> DataFrame:
        """The rows of each key's newest run, with ``run``."""
        return newest_rows(self.rows(), self.key)

    def next_run(self) -> int:
        return int(self.rows().agg(F.max("run")).first()[0] or 0) + 1

    def append(self, df: DataFrame, run: int | None = None) -> int:
        """Write ``df`` as run ``run`` (default: the next); the same run again replaces its partitions."""
        run = self.next_run() if run is None else int(run)
        cols = [c for c in self.schema.fieldNames() if c != "run"]
        out = df.select(*cols, F.lit(run).cast("long").alias("run"))
        out = out.hint("rebalance", *self.parts) if self.parts else out
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", *self.parts).parquet(self.root))
        return run
