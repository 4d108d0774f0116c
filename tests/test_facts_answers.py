"""C10, C14, C15, G7, K5 and the answer cache on hand-made rows."""

from pyspark.sql import functions as F

from webcorpus.functions.facts import facts, summary
from webcorpus.operators.answers import answer_records, answers, cached_or_generated, lookup_answers


def test_fact_rules(spark):
    df = spark.createDataFrame(
        [("However this is a long sentence. Pi is 3.14159 and that is enough for this case",)], "t string")
    got = df.select(facts(F.col("t")).alias("f")).first()["f"]
    # "However…" dropped by the question-word prefix test ("how"); the decimal
    # splits at the dot: "Pi is 3" is too short, the rest is kept.
    assert got == ["14159 and that is enough for this case"]


def test_summary_cut(spark):
    long = ["x" * 150, "y" * 100, "z" * 10, "never"]
    df = spark.createDataFrame([(long,)], "f array<string>")
    s = df.select(summary(F.col("f")).alias("s")).first()["s"]
    assert len(s) == 203 and s.endswith("...") and s.startswith("x" * 150 + ". ")


def _qa(spark):
    qs = spark.createDataFrame([(1, "d0", "what & why"), (2, "d0", "nothing found")],
                               "qid bigint, dataset string, query string")
    hits = spark.createDataFrame([
        (1, 1, "First fact sentence is here. Second fact sentence is here. Third fact sentence here. Fourth one is long enough.",
         "https://a", "A"),
        (1, 2, "Another page says something long. ", "https://b", "B"),
        (1, 3, "Repeated page text is long enough.", "https://a", "A2"),
        (1, 4, "No url on this hit but long enough.", "", "C"),
    ], "qid bigint, rank int, text string, url string, title string")
    return qs, hits


def test_answer_assembly(spark):
    qs, hits = _qa(spark)
    a = {r["qid"]: r for r in answers(qs, hits).collect()}
    one = a[1]
    assert [c["fact"] for c in one["fact_cards"]][:4] == [
        "First fact sentence is here", "Second fact sentence is here", "Third fact sentence here",
        "Another page says something long"]
    assert [(c["url"], c["title"]) for c in one["citations"]] == [("https://a", "A"), ("https://b", "B")]
    assert one["handoff_url"] == "/dataset/d0/query?q=what & why" == one["qr_url"]
    assert one["summary"].startswith("First fact sentence is here. Second")
    empty = a[2]
    assert empty["summary"] == "" and empty["fact_cards"] == [] and empty["citations"] == []


def test_cache_roundtrip_and_merge(spark):
    qs, hits = _qa(spark)
    ans = answers(qs, hits)
    store = answer_records(ans.where("qid = 1"))
    looked = {r["qid"]: r["cached"] for r in lookup_answers(qs, store).collect()}
    assert looked[2] is None and looked[1]["summary"].startswith("First fact")
    calls = []

    def generate(missing):
        calls.append(sorted(r["qid"] for r in missing.collect()))
        return answers(missing, hits)

    merged = {r["qid"]: r["source"] for r in cached_or_generated(qs, store, generate).collect()}
    assert merged == {1: "cache", 2: "generated"} and calls == [[2]]
