"""S2 packing: the worked examples, the blocked fold against a plain
sequential reading, and paragraph splitting of oversize sections."""

import random

from pyspark.sql import functions as F

from webcorpus.operators.chunking import chunk_documents
from webcorpus.operators.packing import _fold, pack, pack_rows


def words(n, w="w"):
    return " ".join([w] * n)


def chunk_texts(spark, text, **kw):
    df = spark.createDataFrame([(0, text)], "doc bigint, text string")
    rows = chunk_documents(df, ["doc"], **kw).orderBy("chunk_index").collect()
    return rows


def test_300_300_100(spark):
    text = "\n".join(["# a " + words(298), "# b " + words(298), "# c " + words(98)])
    rows = chunk_texts(spark, text)
    assert [r["n_tokens"] for r in rows] == [600, 100]


def test_400_600_50(spark):
    text = "\n".join(["# a " + words(398), "# b " + words(598), "# c " + words(48)])
    rows = chunk_texts(spark, text)
    assert [r["n_tokens"] for r in rows] == [400, 650]


def test_oversize_section_without_blank_lines(spark):
    rows = chunk_texts(spark, "# a " + words(898))
    assert len(rows) == 1 and rows[0]["oversize"] and rows[0]["n_tokens"] == 900


def test_oversize_section_split_by_paragraphs(spark):
    text = "# a\n" + "\n\n".join(words(300, w) for w in ("pa", "pb", "pc", "pd"))
    rows = chunk_texts(spark, text)
    # paragraphs 1+2 (602 incl. heading) ≤ 800; the third overflows; para items never close
    assert [r["n_items"] for r in rows] == [2, 2]


def test_fold_matches_sequential(spark):
    rnd = random.Random(3)
    docs = []
    for d in range(300):
        items = [(k, rnd.choice([0, 1, 5, 120, 300, 499, 500, 700, 801, 2000]), rnd.random() < 0.4)
                 for k in range(rnd.randint(0, 700))]
        docs.append((d, [{"sec": k, "para": 0, "n": n, "is_para": p, "text": "x"} for k, n, p in items]))
    schema = "doc bigint, items array<struct<sec:bigint,para:int,n:bigint,is_para:boolean,text:string>>"
    df = spark.createDataFrame(docs, schema)
    for block in (7, 256):
        got = df.select("doc", _fold(F.col("items"), 500, 800, block).alias("nos")).collect()
        for r in got:
            items = docs[r["doc"]][1]
            want = pack_rows([(i["sec"], i["n"], i["is_para"]) for i in items], 500, 800)
            assert list(r["nos"]) == want


def test_pluggable_token_counter(spark):
    from webcorpus.functions.text import model_token_counter
    counter = model_token_counter(lambda: str.split)      # a whitespace "codec"
    text = "\n".join(["# a " + words(298), "# b " + words(298), "# c " + words(98)])
    df = spark.createDataFrame([(0, text)], "doc bigint, text string")
    rows = chunk_documents(df, ["doc"], count_tokens=counter).orderBy("chunk_index").collect()
    assert [r["n_tokens"] for r in rows] == [600, 100]
