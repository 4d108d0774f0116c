"""W6 answers: per question, fact cards from its top hits (3 facts per hit,
10 cards), a summary of the first three facts, first-seen citations, the
handoff / QR link; plus the precomputed-answer store (A15, A16) and the
cached-or-generated merge (J5).

Every group is one question with at most ``top_k`` hits, so the per-question
``collect_list`` is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.functions.facts import fact_card, facts, handoff_url, summary
from webcorpus.functions.keys import query_hash

# Facts taken per hit, cards per answer.
FACTS_PER_HIT = 3
MAX_CARDS = 10

CARD = T.StructType([T.StructField(n, T.StringType()) for n in ("fact", "source", "title", "type")])
CITATION = T.StructType([T.StructField("url", T.StringType()), T.StructField("title", T.StringType())])
ANSWER = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("summary", T.StringType()),
    T.StructField("fact_cards", T.ArrayType(CARD)), T.StructField("citations", T.ArrayType(CITATION)),
    T.StructField("handoff_url", T.StringType()), T.StructField("qr_url", T.StringType())])


def hit_cards(hits: DataFrame, fact_extractor=None) -> DataFrame:
    """C10 + C11 per hit: ``qid, rank, cards`` (the hit's first three facts).
    ``fact_extractor`` maps the text column to an array of strings (default:
    the fact sentences)."""
    found = facts(F.col("text"), FACTS_PER_HIT) if fact_extractor is None else F.slice(
        F.coalesce(fact_extractor(F.col("text")), F.array().cast("array<string>")), 1, FACTS_PER_HIT)
    return hits.select("qid", "rank", F.transform(
        found, lambda f: fact_card(f, F.col("url"), F.col("title")))
        .alias("cards"), "url", "title")


def answers(questions: DataFrame, hits: DataFrame, fact_extractor=None) -> DataFrame:
    """``qid, dataset, query, query_hash, summary, fact_cards, citations,
    handoff_url, qr_url`` for every question (no hits → empty answer)."""
    per = hit_cards(hits, fact_extractor).groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "cards", "url", "title"))).alias("_h"))
    all_cards = F.flatten(F.transform("_h", lambda h: h["cards"]))
    urls = F.array_distinct(F.filter(F.transform("_h", lambda h: F.coalesce(h["url"], F.lit(""))),
                                     lambda u: u != ""))
    cites = F.transform(urls, lambda u: F.struct(
        u.alias("url"),
        F.coalesce(F.element_at(F.filter("_h", lambda h: h["url"] == u), 1)["title"], F.lit(""))
        .alias("title")))
    q = questions.select("qid", "dataset", "query").join(per, "qid", "left")
    q = q.withColumn("_h", F.coalesce("_h", F.array().cast(per.schema["_h"].dataType)))
    link = handoff_url(F.col("dataset"), F.col("query"))
    return q.select(
        "qid", "dataset", "query", query_hash(F.col("query")).alias("query_hash"),
        summary(F.transform(all_cards, lambda c: c["fact"])).alias("summary"),
        F.slice(all_cards, 1, MAX_CARDS).alias("fact_cards"), cites.alias("citations"),
        link.alias("handoff_url"), link.alias("qr_url"))


def answer_records(ans: DataFrame) -> DataFrame:
    """``dataset, query_hash, json`` — what the precompute job stores
    (partitioned by dataset, keyed by the query hash)."""
    return ans.select("dataset", "query_hash", F.to_json(F.struct(
        "query", "summary", "fact_cards", "citations", "handoff_url", "qr_url")).alias("json"))


def lookup_answers(questions: DataFrame, store: DataFrame) -> DataFrame:
    """The stored answer of each question, null on a miss."""
    q = questions.withColumn("query_hash", query_hash(F.col("query")))
    one = store.groupBy("dataset", "query_hash").agg(F.min("json").alias("json"))     # one answer per key
    s = one.select("dataset", "query_hash", F.from_json("json", ANSWER).alias("cached"))
    return q.join(s, ["dataset", "query_hash"], "left")


def cached_or_generated(questions: DataFrame, store: DataFrame, generate) -> DataFrame:
    """Stored answers where present; ``generate(missing_questions)`` runs
    only for the anti-join side."""
    looked = lookup_answers(questions, store)
    hit = looked.where(F.col("cached").isNotNull()).select(
        "qid", "dataset", "query", "query_hash", F.lit("cache").alias("source"),
        *[F.col(f"cached.{n}").alias(n) for n in
          ("summary", "fact_cards", "citations", "handoff_url", "qr_url")])
    missing = questions.join(looked.where(F.col("cached").isNotNull()).select("qid"), "qid", "left_anti")
    fresh = generate(missing).select(
        "qid", "dataset", "query", "query_hash", F.lit("generated").alias("source"),
        "summary", "fact_cards", "citations", "handoff_url", "qr_url")
    return hit.select(fresh.columns).unionByName(fresh)
