"""Scans of the input tables (Parquet), with explicit column projection so the
scan's ``ReadSchema`` carries only what the operator reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = ("pages", "documents", "embeddings", "benchmark", "labels", "conversations", "events")


def read_table(spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan ``{base}/{name}.parquet`` (a file or a folder)."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


SCAN_CONF = "webcorpus.scan.partitions"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The scan as it is, or, in a session that sets ``webcorpus.scan.partitions``,
    hash-partitioned on ``keys`` to that many partitions.  That is for inputs
    whose files cannot be split (a table in one row group, as in local tests); large
    inputs have splits enough, and there the setting stays unset."""
    n = df.sparkSession.conf.get(SCAN_CONF, None)
    return df.repartition(int(n), *keys) if n else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint into the folder named by ``spark.checkpoint.dir``
    (set to a local folder only when the session has none, as in tests)."""
    from webcorpus.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of its own in the folder named by ``spark.checkpoint.dir``, read back: a lineage
    cut whose later scans read only the columns they need."""
    import uuid

    from webcorpus.session import ensure_checkpoint_dir
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
