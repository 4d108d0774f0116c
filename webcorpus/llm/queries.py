"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm import chat, decontam, lm, mixing, passages, quality, repair, sharding, simhash, spelling, topk, toxicity, warc
from webcorpus.llm.common import crc_mod
from webcorpus.sources.tables import read_table

#: Bytes of a shard: small enough that also the smallest tables split.
SHARD_BYTES = 1 << 20


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = simhash.near_duplicates(docs, shingle=3, distance=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return lm.score(docs).withColumnRenamed("id", "doc_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    index = warc.write_archives(pages, warc.archive_folder(spark))
    read = warc.read_records(index, with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return sharding.assign_shards(docs, SHARD_BYTES).drop("text")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mixing.taken_rows(mixing.mix(docs)).select("doc_id", "size", "source_size", "target", "taken")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return quality.judge(docs).select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = decontam.contaminated(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    return found.select(F.col("id").alias("doc_id"), "item_id", "pos", "covered", "exact", "n_slots")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    scored = toxicity.scores(docs, toxicity.fit(docs, labels))
    return scored.select(F.col("id").alias("doc_id"), (crc_mod(F.col("id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return passages.both_sides(passages.repeated_passages(docs)).withColumnRenamed("id", "doc_id").withColumnRenamed("other_id", "other_doc_id")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    hostile = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.read_back(chat.windows(rows.unionByName(hostile))))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return spelling.variants(docs, min_length=7, min_count=2, ratio=10, noise=31)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    found = repair.report(repair.damage(rows), rows.select(F.col("conv_id").alias("conv")))
    return found.withColumnRenamed("conv", "conv_id")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return topk.top_k(rows, F.col("id") % 20 == 0, k=20, scale=64).select("query_id", "rank", "vec_id", "score")


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h,
         coalesce(strlen(text), 0)::BIGINT AS bytes
  FROM documents),
lv AS (SELECT unnest(range(0, 61))::INTEGER AS depth),
b AS (
  SELECT depth, h >> (60 - depth) AS bucket, sum(bytes)::BIGINT AS shard_bytes
  FROM d, lv GROUP BY ALL
  HAVING sum(bytes) <= {SHARD_BYTES} OR min(h) = max(h)),
f AS (
  SELECT d.doc_id, d.bytes, min(b.depth) AS depth, arg_min(b.bucket, b.depth) AS bucket, arg_min(b.shard_bytes, b.depth) AS shard_bytes
  FROM d, b WHERE b.bucket = d.h >> (60 - b.depth) GROUP BY d.doc_id, d.bytes, d.h)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(bucket), 64, '0'), depth) END AS shard,
       depth::BIGINT AS depth, bytes, shard_bytes, shard_bytes > {SHARD_BYTES} AS oversize
FROM f
"""

OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hexed,
             min(page_id) OVER (PARTITION BY payload) AS first_id FROM p),
b AS (SELECT *, array_to_string(list_transform(string_split(hexed, ''), lambda c:
        right(lpad(bin(instr('0123456789abcdef', c) - 1), 64, '0'), 4)), '') AS bits FROM q)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (1 + list_sum(list_transform(range(0, 5), lambda j: substr(bits, (i * 5 + j + 1)::INTEGER, 1)::INTEGER * (16 >> j::INTEGER))))::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b
"""

#: ``tab.t``: the 256 steps of CRC-32, by its rule.
CRC_SQL = """
WITH tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS c
    FROM (SELECT unnest(range(0, 256)) AS i))),
"""

OP11_SQL = CRC_SQL + r"""runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)),
long_runs AS (
  SELECT run, count(*) AS k, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed
  FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
coded AS (
  SELECT run, k, flatten(list_transform(string_split(keyed, ''), lambda c:
    CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [(192 + ord(c) // 64)::BIGINT, (128 + ord(c) % 64)::BIGINT] END)) AS bytes
  FROM long_runs),
hashed AS (
  SELECT run, k, xor(list_reduce(bytes, lambda a, b: xor(a // 256, t[(1 + xor(a, b) % 256)::INTEGER]), 4294967295::BIGINT), 4294967295) AS h
  FROM coded, tab),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word
    FROM hashed)
  GROUP BY word HAVING length(word) >= 7 AND sum(k) >= 2),
shorter AS (
  SELECT word, length(word) AS size, n, i, left(word, i::INTEGER) || substr(word, i::INTEGER + 2) AS less
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.less = b.less AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.less = b.word),
best AS (
  SELECT word, count(*) AS n_near, min({'n': -other_n, 'word': other}) AS b FROM pairs GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN -b.n >= 10 * w.n THEN b.word END AS form, CASE WHEN -b.n >= 10 * w.n THEN -b.n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
ends AS (
  WITH RECURSIVE path AS (
    SELECT word, form AS at FROM found WHERE form IS NOT NULL
    UNION ALL SELECT p.word, f.form FROM path p JOIN found f ON f.word = p.at WHERE f.form IS NOT NULL)
  SELECT p.word, p.at AS root FROM path p JOIN found f ON f.word = p.at WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM found f LEFT JOIN ends e ON e.word = f.word
"""

OP12_SQL = CRC_SQL + """src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda c: ord(c)::BIGINT) AS bytes
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(bytes, lambda a, b: xor(a // 256, t[(1 + xor(a, b) % 256)::INTEGER]), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM src, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds),
placed AS (
  SELECT *, row_number() OVER w AS place, lag(role[1]) OVER w AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS inner_text
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
marked AS (
  SELECT *, CASE WHEN inner_text = '' THEN 'blank' WHEN seen THEN 'duplicate'
                 WHEN right(inner_text, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
grouped AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         (count(*) FILTER (fault = 'blank'))::BIGINT AS blank, (count(*) FILTER (fault = 'duplicate'))::BIGINT AS duplicate,
         (count(*) FILTER (fault = 'truncated'))::BIGINT AS truncated,
         (count(*) FILTER (before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au')))::BIGINT AS illegal,
         list({'go': fault IN ('blank', 'duplicate'), 'more': (fault = 'truncated')::BIGINT, 'r': role[1]} ORDER BY place) AS rows,
         list({'role': role, 'text': text} ORDER BY place) AS texts
  FROM marked GROUP BY conv_id),
-- cheapest (cost, audit) per end: n nothing, s, u, a; inserted rows first, then the row's own edit
step AS (
  SELECT * EXCLUDE (rows), list_reduce(list_concat([{'go': true, 'more': -1::BIGINT, 'r': ''}], rows, [{'go': true, 'more': -2::BIGINT, 'r': ''}]).list_transform(lambda x:
      {'go': x.go, 'more': x.more, 'r': x.r, 'n': {'c': 0::BIGINT, 'p': ''}, 's': {'c': 1000000000::BIGINT, 'p': ''},
       'u': {'c': 1000000000::BIGINT, 'p': ''}, 'a': {'c': 1000000000::BIGINT, 'p': ''}}),
    lambda acc, x: list_transform([{'u1': least(acc.u, {'c': least(acc.n, acc.s, acc.a).c + 2, 'p': least(acc.n, acc.s, acc.a).p || 'I'})}],
      lambda y: list_transform([{'u': y.u1, 'a': least(acc.a, {'c': y.u1.c + 2, 'p': y.u1.p || 'I'})}],
      lambda z: list_transform([{'u': least(z.u, {'c': z.a.c + 2, 'p': z.a.p || 'I'}), 'a': z.a}],
      lambda v: CASE WHEN x.more = -2 THEN {'go': x.go, 'more': x.more, 'r': x.r, 'n': acc.n, 's': acc.s, 'u': v.u, 'a': v.a} ELSE {
        'go': x.go, 'more': x.more, 'r': x.r,
        'n': {'c': acc.n.c + 3, 'p': acc.n.p || 'D'},
        's': CASE WHEN x.r = 's' AND NOT x.go THEN least({'c': acc.s.c + 3, 'p': acc.s.p || 'D'}, {'c': acc.n.c + x.more, 'p': acc.n.p || 'K'})
                  ELSE {'c': acc.s.c + 3, 'p': acc.s.p || 'D'} END,
        'u': CASE WHEN x.go THEN {'c': v.u.c + 3, 'p': v.u.p || 'D'}
                  ELSE least({'c': v.u.c + 3, 'p': v.u.p || 'D'},
                             {'c': least(acc.n, acc.s, v.a).c + x.more + CASE WHEN x.r = 'u' THEN 0 ELSE 2 END,
                              'p': least(acc.n, acc.s, v.a).p || CASE WHEN x.r = 'u' THEN 'K' ELSE 'R' END}) END,
        'a': CASE WHEN x.go THEN {'c': v.a.c + 3, 'p': v.a.p || 'D'}
                  ELSE least({'c': v.a.c + 3, 'p': v.a.p || 'D'},
                             {'c': v.u.c + x.more + CASE WHEN x.r = 'a' THEN 0 ELSE 2 END,
                              'p': v.u.p || CASE WHEN x.r = 'a' THEN 'K' ELSE 'R' END}) END} END)[1])[1])[1]) AS e
  FROM grouped),
ended AS (SELECT *, least(e.n, e.a).c AS cost, least(e.n, e.a).p AS audit FROM step),
edits AS (
  SELECT conv_id, i, substr(audit, i::INTEGER, 1) AS edit, texts[length(replace(left(audit, i::INTEGER), 'I', ''))] AS t
  FROM (SELECT conv_id, audit, texts, unnest(range(1, length(audit) + 1)) AS i FROM ended)),
outs AS (
  SELECT conv_id, i, edit, t, count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY i) AS nth,
         first_value(CASE WHEN edit = 'K' AND t.role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, edit = 'D' ORDER BY i) AS lead
  FROM edits),
lines AS (
  SELECT conv_id, i, CASE edit WHEN 'K' THEN t.role ELSE CASE WHEN (nth - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END END
         || ':' || CASE edit WHEN 'I' THEN '' ELSE t.text END AS line
  FROM outs WHERE edit <> 'D'),
repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS body FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(e.gaps, 0)::BIGINT AS gaps, coalesce(e.blank, 0)::BIGINT AS blank, coalesce(e.duplicate, 0)::BIGINT AS duplicate,
       coalesce(e.truncated, 0)::BIGINT AS truncated, coalesce(e.illegal, 0)::BIGINT AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(r.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP13_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""

QUERIES = {"op1_simhash": op1_simhash, "op2_lm": op2_lm, "op3_warc": op3_warc, "op4_sharding": op4_sharding, "op5_mixing": op5_mixing,
           "op6_quality": op6_quality, "op7_decontamination": op7_decontamination,
           "op8_toxicity": op8_toxicity, "op9_passages": op9_passages,
           "op10_chat": op10_chat, "op11_spelling": op11_spelling, "op12_repair": op12_repair, "op13_topk": op13_topk}
ORACLE = {"op3_warc": OP3_SQL, "op4_sharding": OP4_SQL, "op11_spelling": OP11_SQL, "op12_repair": OP12_SQL, "op13_topk": OP13_SQL}
