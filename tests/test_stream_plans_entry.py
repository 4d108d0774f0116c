"""Stream = batch, plan shape checks, and the driver contract."""

import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF01
from webcorpus.sources import fixtures as X


def test_stream_equals_one_batch(spark):
    from webcorpus.streaming.pages_stream import (STATE_SCHEMA, VECTOR_SCHEMA, latest, process_pages,
                                                  start_page_stream)
    root = tempfile.mkdtemp(prefix="wc-stream-")
    pages = X.web_pages(spark, SF01).limit(60)
    for part in range(3):      # three arriving files
        pages.where(F.col("page_id") % 3 == part).coalesce(1).write.parquet(f"{root}/in/part{part}")
    src = spark.read.parquet(*[f"{root}/in/part{p}" for p in range(3)])
    # move the three files into one folder so the stream sees them arrive one by one
    os.makedirs(f"{root}/src")
    n = 0
    for p in range(3):
        for f in sorted(os.listdir(f"{root}/in/part{p}")):
            if f.endswith(".parquet"):
                os.link(f"{root}/in/part{p}/{f}", f"{root}/src/{n:03d}.parquet")
                n += 1
    q = start_page_stream(spark, f"{root}/src", f"{root}/store", f"{root}/ckpt", X.AS_OF)
    q.awaitTermination()
    streamed = latest(spark, f"{root}/store", "vectors")
    batch_vec, _ = process_pages(src, spark.createDataFrame([], STATE_SCHEMA),
                                 spark.createDataFrame([], VECTOR_SCHEMA), X.AS_OF)
    cols = ["namespace", "id", "dataset", "url", "chunk_index", "text"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch_vec.select(cols).collect()))
    assert latest(spark, f"{root}/store", "state").count() == 60


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunk_pipeline_has_one_shuffle_and_no_python(spark):
    import __spark_entry__ as E
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(E.queries()["chunk_pipeline"](spark, SF01))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1
    assert "Python" not in plan and "ArrowEval" not in plan
    assert plan.count("FileScan parquet") == 1


def test_scan_prunes_columns(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["content_hash"](spark, SF01))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan


def test_topk_uses_window_group_limit(spark):
    import __spark_entry__ as E
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(E.queries()["topk_per_query"](spark, SF01))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan and "MapInArrow" in plan


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {"chunk_pipeline", "retrieval", "answers", "promote"} <= set(E.queries())


def test_stream_query_reads_a_folder_of_files(spark, tmp_path):
    """The pages table as a folder of part files: several epochs, same result as from one file."""
    import __spark_entry__ as E
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    pages.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    want, got = (E.queries()["stream_process"](spark, d).collect() for d in (SF01, str(tmp_path)))
    assert want and sorted(map(tuple, want)) == sorted(map(tuple, got))
