"""P3/P4 reach the Parquet scan; the C1 chain means the same in both engines
on generated HTML, not just on the driver's pages."""

import random
import tempfile

import duckdb
from pyspark.sql import functions as F

from tests.conftest import SF01
from webcorpus.functions import text as T
from webcorpus.operators.vectors import write_vectors
from webcorpus.sources import fixtures as X


def test_namespace_and_metadata_filters_reach_the_scan(spark):
    path = tempfile.mkdtemp(prefix="wc-vec-") + "/vectors"
    write_vectors(X.vectors(spark, SF01), path)
    df = (spark.read.parquet(path).where((F.col("namespace") == "production") & (F.col("dataset") == "d1"))
          .where(F.col("lang") == "en").select("id", "url"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(namespace" in plan and "(namespace#" in plan
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan
    assert "ReadSchema: struct<id:string,url:string,lang:string>" in plan   # no embedding read
    assert df.count() == X.vectors(spark, SF01).where(
        "namespace = 'production' AND dataset = 'd1' AND lang = 'en'").count()


PIECES = ["<p>", "</p>", "<div class=x>", "</div>", "<br>", "<h1>", "</h1>", "<h3 id=a>", "</h3>",
          "<ul>", "<li>", "</li>", "</ul>", "<table><tr><td>", "</td><td>", "</td></tr></table>",
          '<a href="/x?a=1&amp;b=2">', "</a>", "<b>", "</b>", "<!-- c -->", "<script>var x='</p>';</script>",
          "<style>p{}</style>", "<img src=y>", "&amp;", "&lt;", "&gt;", "&nbsp;", "&copy;", "&middot;",
          "&quot;", "&#39;", " ", "  ", "\n", "\t", " ", "　", "word", "Wörter", "x|y", "# not",
          "- dash", "12.5", "?", "!", ".", "<meta name=description content=\"d\">", "<title>t</title>"]


def test_clean_chain_parity_on_generated_html(spark):
    rnd = random.Random(11)
    docs = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(docs)), "i bigint, html string")
    got = {r["i"]: (r["t"], r["n"]) for r in
           df.select("i", T.clean_html("html").alias("t"), T.token_count(T.clean_html("html")).alias("n")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE h(i BIGINT, html VARCHAR)")
    con.executemany("INSERT INTO h VALUES (?, ?)", list(enumerate(docs)))
    want = {i: (t, n) for i, t, n in con.execute(
        f"SELECT i, {T.clean_html_sql('html')}, {T.token_count_sql(T.clean_html_sql('html'))} FROM h").fetchall()}
    assert got == want
