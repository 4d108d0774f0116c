"""Session helpers: sane defaults for local runs, and the shared checkpoint
folder taken from the cluster's ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app: str = "webcorpus", cores: int | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benches (on a cluster, use the
    cluster's own session; nothing here is required there)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # small local inputs, CPU-heavy tasks (regex, windows, folds): let AQE
               # coalesce small shuffles, but not below ~256 KB per task
               .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               # test tables are single row groups, which no scan can split
               .config("webcorpus.scan.partitions", str(cores))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the session's
    ``spark.checkpoint.dir`` if set (as on a cluster); otherwise — only in
    local runs and tests — a fresh local folder is set."""
    try:
        sc = spark.sparkContext
    except Exception:       # Spark Connect: the server owns the checkpoint folder
        sc = None
    current = (sc.getConf().get(CHECKPOINT_CONF, None) if sc is not None else None) or \
        spark.conf.get(CHECKPOINT_CONF, None) or \
        (sc.getCheckpointDir() if sc is not None else None)
    if not current and sc is not None and not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="webcorpus-ckpt-")
        try:
            spark.conf.set(CHECKPOINT_CONF, current)
        except Exception:  # some deployments refuse runtime changes of core confs
            pass
    if sc is not None:
        sc.setCheckpointDir(current)
    return current
