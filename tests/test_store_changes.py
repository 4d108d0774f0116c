"""Approximate search, pages in segments, robots files, failing sitemaps, stored golden queries, and the entry without
its optional parts."""

import os
import random
import shutil
import subprocess
import sys
from urllib.robotparser import RobotFileParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from webcorpus.operators import ann as A
from webcorpus.operators import embed as E
from webcorpus.operators import evaluate as EV
from webcorpus.operators import search as Q
from webcorpus.operators import segments as G
from webcorpus.operators.chunking import chunk_documents
from webcorpus.sources import fixtures as X
from webcorpus.sources.robots import robots_allowed, robots_rules
from webcorpus.sources.sitemaps import walk_sitemaps
from webcorpus.sources.tables import written

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


# ------------------------------------------------------------ approximate search
def test_approx_search_recall_and_pairs(spark):
    """sf0.1's vectors: recall at 5 against exact search, with under a tenth of all pairs scored."""
    base = "/root/testdata/sf0.1"
    vectors = written(X.vectors(spark, base).select("namespace", "dataset", "id", "embedding", "url"))
    queries = X.golden_queries(spark, base).select("qid", "dataset", F.lit("staging").alias("namespace"), F.lit(5).alias("top_k"), "embedding")
    model = A.fit(vectors)
    index = written(A.build_index(vectors, model))
    assert index.count() == vectors.count()
    probes = A.calibrate(queries, vectors, index, model)
    exact = {(r.qid, r.id): r for r in Q.topk_search(queries, vectors, k=5, payload=("url",)).collect()}
    found = {(r.qid, r.id): r for r in A.approx_search(queries, vectors, index, model, probes, k=5, payload=("url",)).collect()}
    assert len(exact.keys() & found.keys()) >= 0.9 * len(exact)
    assert all(abs(found[x].score - exact[x].score) < 1e-9 and found[x].url == exact[x].url for x in exact.keys() & found.keys())
    scored = A.candidates(queries.withColumn("keep", F.lit(5 * A.SHORTLIST)), index, model, probes).count()
    pairs = queries.join(vectors, ["namespace", "dataset"]).count()
    assert scored < 0.1 * pairs


def test_approx_search_prunes_clusters_and_odd_vectors(spark):
    """Clustered vectors need few probes; dimensions, nulls and empty tables don't mix or crash."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    rows = [("n", "d", f"v{i:04d}", [float(x) for x in centres[i % 20] + 0.1 * rng.normal(size=16)]) for i in range(1200)]
    rows += [("n", "d", "null", None), ("n", "d", "part", [1.0, None]), ("n", "d", "two", [1.0, 0.0]), ("n", "d", "zero", [0.0] * 16), ("n", "other", "o", [1.0] * 16)]
    vectors = spark.createDataFrame(rows, "namespace string, dataset string, id string, embedding array<double>")
    model = A.fit(vectors, cells=24)
    index = written(A.build_index(vectors, model))
    asked = [(i, "n", "d", None, rows[i][3]) for i in range(0, 1200, 40)] + [(5000, "n", "d", 3, [1.0, 0.0]), (5001, "n", "d", None, None), (5002, "n", "x", 5, [1.0] * 16),
                                                                         (5003, "n", "d", 5, [1.0] * 7)]
    queries = spark.createDataFrame(asked, "qid long, namespace string, dataset string, top_k int, embedding array<double>")
    probes = A.calibrate(queries, vectors, index, model)
    assert probes <= 6      # of 24
    got = A.approx_search(queries, vectors, index, model, probes, payload=()).collect()
    want = Q.topk_search(queries, vectors, payload=()).collect()
    assert {(r.qid, r.id) for r in got if r.qid >= 5000} == {(5000, "two")} == {(r.qid, r.id) for r in want if r.qid >= 5000}
    assert len({(r.qid, r.id) for r in got} & {(r.qid, r.id) for r in want}) >= 0.95 * len(want)
    none = vectors.limit(0)
    empty = A.fit(none)
    assert A.approx_search(queries, none, A.build_index(none, empty), empty, 1, payload=()).collect() == []


def test_codes_are_compared_in_bands_of_cells(spark, monkeypatch):
    """A query goes to a band of cells once, however many of them it probes; blocks of a band are few; the
    nearest codes are those of comparing all codes of the probed cells, ties by id."""
    monkeypatch.setattr(A, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(5)
    rows = [("n", f"d{i % 2}", f"v{i % 350:04d}" if i < 700 else f"v{i:04d}", [float(x) for x in rng.integers(-2, 3, 6)]) for i in range(900)]
    vectors = spark.createDataFrame(rows, "namespace string, dataset string, id string, embedding array<double>")
    model = A.fit(vectors, cells=150, rounds=1)
    index = written(A.build_index(vectors, model))
    queries = spark.createDataFrame([(i, "n", "d0", 4, rows[i][3]) for i in range(0, 300, 5)] + [(1000, "n", "none", 4, rows[0][3])],
                                    "qid long, namespace string, dataset string, keep int, embedding array<double>")
    near = A.probed(queries, model, 60).collect()
    asked = A.asked_cells(queries, model, 60).collect()
    assert len(asked) <= 61 * 3 < len(near)
    codes = {}
    for r in index.collect():
        codes.setdefault((r.dataset, r.cell), []).append((r.id, bytes(r.code)))
    want = {}
    for r in near:
        for id, code in codes.get((r.dataset, r.cell), []):
            far = (int.from_bytes(code) ^ int.from_bytes(bytes(r.code))).bit_count()
            want.setdefault(r.qid, []).append((far, id))
    got = sorted((r.qid, r.id) for r in A.candidates(queries, index, model, 60).collect())
    assert got == sorted((q, id) for q, c in want.items() for _, id in sorted(c)[:4])


def test_workers_need_no_repository_on_their_path(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {REPO!r})
from webcorpus.session import get_session
from webcorpus.sources import fixtures as X
from webcorpus.operators.search import topk_search
s = get_session(cores=2)
assert topk_search(X.questions(s, {SF001!r}), X.vectors(s, {SF001!r}), payload=()).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_model_embedder_runs_the_model_in_batches(spark):
    texts = spark.createDataFrame([("ab",), ("",), (None,)], "text string")
    provider = E.model_embedder(lambda: lambda batch: np.array([[len(t), 1.0] for t in batch]), 2)
    got = [r.e for r in provider(texts, "text", "e").collect()]
    assert sorted(got) == [[0.0, 1.0], [0.0, 1.0], [2.0, 1.0]]


# ------------------------------------------------------------ pages in segments
def lines_of(rng, n):
    kinds = ["# head", "- item", "a) item", "1. item", "cell | cell", "", "  ", "plain words of a line", "more words, here.", "===", "---", "a | b", "é" * 30]
    return [rng.choice(kinds) if rng.random() < 0.5 else "word " * rng.randint(1, 60) for _ in range(n)]


COLS = ["k", "j", "chunk_index", "text", "n_tokens", "n_items", "oversize"]


def test_segments_equal_the_window_rule(spark):
    rng = random.Random(4)
    docs = [(i, "x", "\n".join(lines_of(rng, rng.randint(0, 90)))) for i in range(40)]
    docs += [(100, None, "one | table\n" * 50), (100, "x", "- list\n" * 300), (None, "x", "\n\n\nword\n\n" * 90), (102, "x", None), (103, "x", ""),
             (104, "x", " \n\t\n"), (105, "x", "no end " * 900), (106, "x", "\n".join(["long line " * 300] * 8)), (107, "x", "\n" * 200), (108, "x", "para one\n\n" + "word " * 900 + "\n\n\n" + "w " * 30)]
    frame = spark.createDataFrame(docs, "k long, j string, text string")
    keyed = frame.withColumn("j", F.coalesce("j", F.lit("none")))
    want = sorted(map(repr, chunk_documents(keyed, ["k", "j"]).select(*COLS).collect()))
    for segment in (1, 5, 4096):
        got = G.chunk_segments(keyed, ["k", "j"], segment=segment).select(*COLS).collect()
        assert sorted(map(repr, got)) == want
    assert G.chunk_segments(frame.limit(0), ["k"]).collect() == []


def test_a_giant_page_is_shared_by_tasks(spark):
    """A page of 40,000 lines in segments of 500: the same chunks, and no task or group holds all its lines."""
    rng = random.Random(9)
    page = spark.createDataFrame([(1, "\n".join(lines_of(rng, 40000)))], "k long, text string")
    cols = [c for c in COLS if c != "j"]
    want = sorted(map(tuple, chunk_documents(page, ["k"]).select(*cols).collect()))
    got = G.chunk_segments(page, ["k"], segment=500)
    assert sorted(map(tuple, got.select(*cols).collect())) == want and len(want) > 500
    lines = G.numbered_lines(page, ["k"], segment=500)
    assert lines.groupBy("seg").count().agg(F.max("count")).first()[0] == 500
    plan = lines._jdf.queryExecution().executedPlan().toString()
    # windows over lines are partitioned by segment; those over a page's segments read summaries, one row each
    assert "windowspecdefinition(k" in plan and plan.count("windowspecdefinition(k#") >= 3


def test_scans_of_segments_move_no_text(spark):
    """Lines' text is not in the scans; it joins at the end, by a number of the line, and keys that repeat stay apart."""
    docs = spark.createDataFrame([(1, "# a\nb\n\nc"), (1, "# a\nb\n\nc"), (2, "x")], "k long, text string").coalesce(1)
    numbered = G.numbered_lines(docs, ["k"], segment=2)
    assert "line" not in numbered.columns and numbered.count() == numbered.select("line_id").distinct().count() == 9
    got = {r.k: r.text for r in G.chunk_segments(docs, ["k"], segment=2).collect()}
    assert got[2] == "x" and sorted(got[1].split()) == sorted("# a b c # a b c".split())


# ------------------------------------------------------------ robots files
def test_robots_files_against_the_standard_library(spark):
    rng = random.Random(8)
    agents = ["*", "webcorpusbot", "WebCorpus", "otherbot", "corpus", "webcorpusbot/2.0", "zebra"]
    paths = ["/", "/a", "/a/b", "/b", "", "*", "/c?x=1"]

    def line():
        r = rng.random()
        if r < 0.3:
            return rng.choice(["User-agent: ", "user-agent:", "USER-AGENT : "]) + rng.choice(agents)
        if r < 0.75:
            return rng.choice(["Disallow: ", "disallow:", "Allow: ", "ALLOW :"]) + rng.choice(paths) + rng.choice(["", "", "  # note"])
        return rng.choice(["", "", "# only a comment", "Crawl-delay: 3", "Sitemap: https://x/s.xml", "no field", "Request-rate: 1/2", "  "])

    files = {f"h{i}.org": rng.choice(["\n", "\r\n"]).join(line() for _ in range(rng.randint(0, 14))) for i in range(300)}
    urls = [(h, f"https://{h}{p}") for h in files for p in ("/", "/a", "/a/b/c", "/b.html", "/c?x=12", "/d")]
    table = spark.createDataFrame([(h, t, "ok") for h, t in files.items()], "host string, text string, outcome string")
    got = {r.url: r.allowed for r in robots_allowed(spark.createDataFrame(urls, "h string, url string"),
                                                    robots_rules(table, "webcorpusbot/1.0"), "webcorpusbot/1.0").collect()}
    wrong = []
    for host, text in files.items():
        parser = RobotFileParser()
        parser.parse(text.splitlines())
        wrong += [(u, text) for h, u in urls if h == host and got[u] != parser.can_fetch("webcorpusbot/1.0", u)]
    assert not wrong, wrong[:2]


# ------------------------------------------------------------ sitemaps, golden queries
def test_walk_reports_failures_and_goes_on(spark):
    docs = [("a", "<sitemapindex><sitemap><loc>b</loc></sitemap><sitemap><loc> gone </loc></sitemap><sitemap><loc>bad</loc></sitemap><sitemap><loc>a</loc></sitemap></sitemapindex>"),
            ("b", '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>u1&amp;x</loc></url><url><loc>u1&amp;x</loc></url><url><loc/></url></urlset>'),
            ("bad", "<urlset><url><loc>never</loc>"), ("null", None), ("empty", ""), ("unreached", "<urlset><url><loc>no</loc></url></urlset>")]
    seeds = spark.createDataFrame([("d", "a"), ("d", "a"), ("d", "null"), ("d", "empty"), ("e", "gone")], "dataset string, sitemap_url string")
    pages, outcomes = walk_sitemaps(seeds, spark.createDataFrame(docs, "sitemap_url string, xml string"))
    assert [tuple(r) for r in pages.collect()] == [("d", "u1&x")]
    assert {tuple(r) for r in outcomes.collect()} == {
        ("d", "a", "ok", 0, 4), ("d", "b", "ok", 1, 0), ("d", "gone", "missing", 0, 0), ("d", "bad", "malformed", 0, 0),
        ("d", "null", "missing", 0, 0), ("d", "empty", "malformed", 0, 0), ("e", "gone", "missing", 0, 0)}


def test_golden_queries_are_stored_by_dataset(spark, tmp_path):
    rows = [("a:b", "q1", ["u"], 0.5), ("a:b", "q2 \"quoted\"\n", [], None), ("c", "q3", None, None)]
    schema = "dataset string, query string, expected_citations array<string>, min_score double"
    path = str(tmp_path / "g")
    EV.write_golden(spark.createDataFrame(rows, schema), path)
    EV.write_golden(spark.createDataFrame([("c", "q4", ["x", "y"], 1.0)], schema), path)
    good, bad = EV.read_golden(spark, path)
    assert sorted(map(tuple, good.collect())) == [("a:b", "q1", ["u"], 0.5), ("a:b", "q2 \"quoted\"\n", [], None), ("c", "q4", ["x", "y"], 1.0)]
    assert bad.count() == 0


# ------------------------------------------------------------ the entry without its optional parts
@pytest.mark.parametrize("left", ["neither", "pipeline"])
def test_entry_without_the_optional_package(tmp_path, left):
    shutil.copytree(f"{REPO}/webcorpus", tmp_path / "webcorpus", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    if left == "pipeline" and os.path.exists(f"{REPO}/corpus_pipeline.py"):
        shutil.copy(f"{REPO}/corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'chunk_pipeline' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
