"""Evaluation before promotion: golden-query checks (G4, P5, K8), the
per-dataset report (G3), citation validation (P6), chunk integrity (C18),
and golden-query storage as JSON lines (A12, A13).

Checks join the top-k hits of each golden query (at most k rows per query,
so the per-query ``collect_list`` is bounded) back to the query.  The
per-dataset report keeps counts only: a dataset may hold a third of all
queries, so its checks stay a table of their own instead of an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.functions import patterns as P

# Default minimum top score and the report / issue texts.
DEFAULT_MIN_SCORE = 0.7
NO_QUERIES_WARNING = "No golden queries defined for dataset"
NO_RESULTS = "No results found for query"
LOW_SCORE = "Top result score %.3f below minimum %s"
MISSING_CITATIONS = "Missing expected citations: "

GOLDEN_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("expected_citations", T.ArrayType(T.StringType())),
    T.StructField("min_score", T.DoubleType()),
])


def _quoted_list(arr: Column) -> Column:
    """Python-style list text: ``['a', 'b']``."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))),
                                             ", "), F.lit("]"))


def golden_checks(golden: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per golden query: ``passed, issues, citations_found,
    top_score`` (``hits``: ``qid, rank, score, url``)."""
    per_q = hits.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.coalesce("url", F.lit("")).alias("url"))))
        .alias("_hits"),
        F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("_top"))
    g = golden.join(per_q, "qid", "left")
    found = F.filter(F.transform(F.coalesce(F.col("_hits"), F.array()), lambda h: h["url"]),
                     lambda u: u != "")
    n_hits = F.coalesce(F.size("_hits"), F.lit(0))
    min_score = F.coalesce(F.col("min_score"), F.lit(DEFAULT_MIN_SCORE))
    top = F.coalesce(F.col("_top"), F.lit(0.0))
    missing = F.array_sort(F.array_except(F.coalesce(F.col("expected_citations"), F.array()), found))
    issues = F.filter(F.array(
        F.when(n_hits == 0, F.lit(NO_RESULTS))
         .when(top < min_score, F.format_string(LOW_SCORE,
                                                top, min_score.cast("string"))),
        F.when((F.size(F.coalesce(F.col("expected_citations"), F.array())) > 0) & (F.size(missing) > 0),
               F.concat(F.lit(MISSING_CITATIONS), _quoted_list(missing)))),
        lambda x: x.isNotNull())
    out = g.select("qid", "dataset", "query", issues.alias("issues"), found.alias("citations_found"),
                   top.alias("top_score"))
    return out.withColumn("passed", F.size("issues") == 0)


def eval_report(checks: DataFrame, datasets: DataFrame) -> DataFrame:
    """Per dataset: ``passed, warning, total_queries, passed_queries``; a
    dataset without golden queries passes with a warning."""
    per = checks.groupBy("dataset").agg(
        F.bool_and("passed").alias("_all"), F.count(F.lit(1)).alias("total_queries"),
        F.count_if("passed").alias("passed_queries"))
    every = datasets.select("dataset").unionByName(checks.select("dataset")).distinct()
    r = every.join(per, "dataset", "left")
    return r.select(
        "dataset", F.coalesce("_all", F.lit(True)).alias("passed"),
        F.when(F.col("_all").isNull(), F.lit(NO_QUERIES_WARNING)).alias("warning"),
        F.coalesce("total_queries", F.lit(0)).cast("bigint").alias("total_queries"),
        F.coalesce("passed_queries", F.lit(0)).cast("bigint").alias("passed_queries"))


def citation_report(chunks: DataFrame) -> DataFrame:
    """P6 per dataset: ``passed, n_chunks, n_missing`` (a chunk without a URL
    has no citation)."""
    missing = F.coalesce(F.col("url"), F.lit("")) == ""
    return chunks.groupBy("dataset").agg(
        (F.count_if(missing) == 0).alias("passed"), F.count(F.lit(1)).alias("n_chunks"),
        F.count_if(missing).alias("n_missing"))


def uncited_chunks(chunks: DataFrame) -> DataFrame:
    """The failing rows behind ``citation_report`` with their issue text."""
    return (chunks.where(F.coalesce(F.col("url"), F.lit("")) == "")
            .withColumn("issue", F.concat(F.lit("Chunk "), F.col("id"), F.lit(" missing URL citation"))))


def ends_mid_sentence(text: Column) -> Column:
    """The right-stripped text does not end with ``.``, ``!`` or ``?``."""
    tail = F.regexp_replace(text, P.WS + r"+\z", "")
    return ~tail.rlike(P.SENTENCE_END)


def chunk_integrity(chunks: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``ends_mid_sentence`` and ``passed`` (only ``strict`` fails)."""
    out = chunks.withColumn("ends_mid_sentence", ends_mid_sentence(F.col("text")))
    return out.withColumn("passed", F.lit(True) if not strict else ~F.col("ends_mid_sentence"))


def golden_to_json(golden: DataFrame) -> DataFrame:
    """One JSON line per golden query, kept with its dataset."""
    return golden.select("dataset", F.to_json(F.struct("query", "expected_citations", "min_score"))
                         .alias("json"))


def write_golden(golden: DataFrame, path: str) -> None:
    """Replace the stored golden queries of the datasets present (JSON lines, a folder per dataset)."""
    (golden.select("dataset", *GOLDEN_SCHEMA.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dataset").json(path))


def read_golden(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The stored golden queries (no expected citations: an empty list), and ``dataset, line`` of
    the lines that aren't golden queries."""
    lines = spark.read.schema("value string, dataset string").text(path).where(F.trim("value") != "")
    schema = T.StructType([*GOLDEN_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    rows = lines.select("dataset", "value", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"}).alias("g"))
    good = rows.where("g._bad is null").select(
        "dataset", "g.query", F.coalesce("g.expected_citations", F.array().cast("array<string>")).alias("expected_citations"), "g.min_score")
    return good, rows.where("g._bad is not null").select("dataset", F.col("value").alias("line"))


def golden_from_json(lines: DataFrame) -> DataFrame:
    """Parse JSON lines; a dataset without lines simply has no rows."""
    parsed = lines.select("dataset", F.from_json("json", GOLDEN_SCHEMA).alias("g"))
    return parsed.select("dataset", "g.query",
                         F.coalesce("g.expected_citations", F.array().cast("array<string>"))
                         .alias("expected_citations"),
                         F.col("g.min_score").alias("min_score"))
