"""C1, C2, C7, C9 and the strip rule on hand-made rows."""

from pyspark.sql import functions as F

from webcorpus.functions import text as T

HTML = (
    "<html><head><title> My  Page </title><meta name=\"description\" content=\" About it \">"
    "<style>p{}</style></head><body><!-- note --><nav><ul><li><a href=\"/a\">A</a></li>"
    "<li>B</li></ul></nav><h2>Head</h2><p>One &amp; two &lt;x&gt; &copy;</p>"
    "<script>var t=\"</p>\";</script><table><tr><td>c1</td><td>c2</td></tr></table>"
    "<p>  spaced  out  </p><img src=x><b>bold</b> tail</body></html>"
)


def one(spark, col):
    return spark.createDataFrame([(HTML,)], "html string").select(col.alias("v")).first()["v"]


def test_clean_html_contract(spark):
    text = one(spark, T.clean_html("html"))
    assert text.split("\n") == [
        "* [A](/a)", "* B", "## Head", "One & two <x> ©", "c1 | c2", "spaced out", "bold tail"]


def test_metadata(spark):
    assert one(spark, T.html_title("html")) == "My  Page"
    assert one(spark, T.html_description("html")) == "About it"


ENTITY_CASES = [    # worked out by hand: text, decoded
    ("a &amp; b", "a & b"), ("&amp;lt;", "&lt;"), ("it&#8217;s", "it’s"), ("x &mdash; y", "x — y"), ("&#x1F600;!", "😀!"),
    ("&#X41;&#65;", "AA"), ("&bogus; & &", "&bogus; & &"), ("&#0; &#55296; &#1114112;", "&#0; &#55296; &#1114112;"),
    ("&eacute;&Eacute;", "éÉ"), ("a&nbsp;b&#160;c", "a b c"), ("&lt", "&lt"), ("", ""), ("&&copy;", "&©"), ("&apos;", "'")]


def test_entities(spark):
    df = spark.createDataFrame([(t,) for t, _ in ENTITY_CASES], "t string")
    got = [r["v"] for r in df.select(T.decode_entities("t").alias("v")).collect()]
    assert got == [want for _, want in ENTITY_CASES]
    import duckdb
    for t, want in ENTITY_CASES:
        assert duckdb.execute(f"SELECT {T.decode_entities_sql('t')} FROM (SELECT ? AS t)", [t]).fetchone()[0] == want


def test_quotes_and_entities_in_pages(spark):
    page = ("<title>A &amp; B &#8211; C</title><meta name='description' content='it&#39;s \"so\"'>"
            "<p><a href='/k'>k</a> <a class=x href=/u>u</a> <a href=\"/d?a=1&amp;b=2\">d</a></p>")
    row = spark.createDataFrame([(page,)], "h string").select(
        T.html_title("h").alias("t"), T.html_description("h").alias("d"), T.clean_html("h").alias("c")).first()
    assert (row["t"], row["d"]) == ("A & B – C", "it's \"so\"")
    assert "[k](/k) [u](/u) [d](/d?a=1&b=2)" in row["c"]


def test_description_missing_is_empty(spark):
    df = spark.createDataFrame([("<html><title>x</title></html>",)], "html string")
    assert df.select(T.html_description("html").alias("d")).first()["d"] == ""


def test_strip_is_unicode_aware(spark):
    df = spark.createDataFrame([("　  a b  \t",)], "s string")
    assert df.select(T.strip("s").alias("v")).first()["v"] == "a b"


def test_token_count(spark):
    df = spark.createDataFrame([("Hello, world!! 12345 éa", 7), ("", 0), ("   ", 0)], "t string, n int")
    got = [r["c"] for r in df.select(T.token_count("t").alias("c")).collect()]
    assert got == [7, 0, 0]   # Hello , world !! 123 45 éa


def test_paragraphs(spark):
    df = spark.createDataFrame([("a\n\n\nb \n\n  \n\nc",)], "t string")
    assert df.select(T.paragraphs("t").alias("p")).first()["p"] == ["a", "b", "c"]


def test_authority_and_path(spark):
    df = spark.createDataFrame([("https://u:p@Host.com:8080/x/y?q=1#f",), ("http://h",), ("nourl",)], "u string")
    rows = df.select(T.authority("u").alias("a"), T.robots_path("u").alias("p")).collect()
    assert [(r["a"], r["p"]) for r in rows] == [
        ("u:p@Host.com:8080", "/x/y?q=1#f"), ("h", "/"), ("", "/")]


def test_unclosed_tags_take_linear_time(spark):
    """Pages of megabytes of openers without closers; what is never closed stays text, as before."""
    import time
    pages = ["<a href='/x'>" * 100_000, "<!--" * 300_000 + "x", "<script>" * 150_000, "<li " * 300_000, "<p>a <b" * 100_000]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(5, "i")
    start = time.perf_counter()
    out = {r["i"]: r["text"] for r in df.select("i", T.clean_html("html").alias("text")).collect()}
    assert time.perf_counter() - start < 60
    assert out[0] == "" and out[1] == pages[1] and out[2] == "" and out[3] == pages[3].strip() and out[4].startswith("a")


def test_what_is_never_closed(spark):
    cases = {'<a href="/a">ok</a> <a href="/b">open': "[ok](/a) open", "a <!-- b --> c <!-- d": "a c <!-- d",
             "<p>x</p> 1 < 2  and\n3": "x\n1 < 2 and 3", "no tags,\n one   line": "no tags, one line", "": ""}
    df = spark.createDataFrame(list(cases.items()), "html string, want string")
    for r in df.select("want", T.clean_html("html").alias("text")).collect():
        assert r["text"] == r["want"]


def test_tokens_of_scripts_without_spaces(spark):
    cases = {"漢字かな": 4, "abc漢字 de": 4, "ไทย": 3, "héllo wörld": 2, "привет мир 1234": 4, "": 0}
    df = spark.createDataFrame(list(cases.items()), "t string, n long")
    for r in df.select("t", "n", T.token_count("t").alias("got")).collect():
        assert r["got"] == r["n"], r["t"]


def test_hashed_embedding_is_the_histogram_of_buckets(spark):
    from webcorpus.operators.embed import hashed_embedding, token_buckets
    df = spark.createDataFrame([("a b b c c c " * 40,), ("one",), ("",), (None,)], "t string")
    for r in df.select(token_buckets(F.col("t"), 64).alias("b"), hashed_embedding(F.col("t")).alias("e")).collect():
        n = [r["b"].count(i) for i in range(64)]
        size = sum(x * x for x in n) ** 0.5 or 1.0
        assert len(r["e"]) == 64 and all(abs(x / size - y) < 1e-12 for x, y in zip(n, r["e"]))
