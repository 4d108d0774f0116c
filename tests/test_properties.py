"""SURVEY §5 properties on the driver's pages (sf0.01)."""

import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF01
from webcorpus.operators.chunking import chunk_documents
from webcorpus.operators.cleaning import clean_pages
from webcorpus.operators.packing import MAX_TOKENS
from webcorpus.operators.sections import sections
from webcorpus.sources import fixtures as X


def test_sections_rejoin_to_clean_text(spark):
    pages = clean_pages(X.web_pages(spark, SF01)).select("page_id", "text")
    secs = sections(pages, ["page_id"])
    joined = (secs.groupBy("page_id")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_no", "text"))),
                                            lambda x: x["text"]), "\n").alias("rejoined")))
    bad = pages.join(joined, "page_id", "left").where(~F.col("rejoined").eqNullSafe(F.col("text")))
    assert bad.count() == 0


def test_multi_item_chunks_respect_max(spark):
    pages = clean_pages(X.web_pages(spark, SF01)).select("page_id", "text")
    chunks = chunk_documents(pages, ["page_id"])
    assert chunks.where((F.col("n_items") > 1) & (F.col("n_tokens") > MAX_TOKENS)).count() == 0
    # chunk numbers are dense per page
    gaps = chunks.groupBy("page_id").agg((F.max("chunk_index") + 1 - F.count(F.lit(1))).alias("g"))
    assert gaps.where("g <> 0").count() == 0


def test_replayed_epoch_is_idempotent(spark):
    from webcorpus.streaming.pages_stream import latest, run_batch
    store = tempfile.mkdtemp(prefix="wc-replay-")
    pages = X.web_pages(spark, SF01).where("page_id < 20").withColumn("raw_hash", F.sha2("html", 256))
    changed = clean_pages(pages)
    run_batch(spark, changed, store, 1, X.AS_OF)
    first = sorted(map(tuple, latest(spark, store, "vectors").select("id", "url").collect()))
    run_batch(spark, changed, store, 1, X.AS_OF)          # the same epoch again
    again = sorted(map(tuple, latest(spark, store, "vectors").select("id", "url").collect()))
    assert first == again and len(first) > 0
