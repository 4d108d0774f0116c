"""The operators against brute force, exact round trips and held-out labels,
with nulls, empty texts, ties, repeated rows, empty tables and extra columns."""

import collections
import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from webcorpus.llm import chat, decontam, lm, mixing, passages, quality, queries, sharding, simhash, toxicity, warc

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose with copies, near-copies, nulls, blanks and a repeated row."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(60, 300)) for _ in range(60)]
    texts += [texts[0]] * 5 + [" ".join(texts[1].split()[:-1] + ["changed"]), texts[2].upper(), None, "", " \t\n", "one", "One"]
    rows = [(i, t, "en", ["a", "b", None, "c"][min(3, i % 7)], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], (None, texts[7], "en", "a", 1), (None, "no id at all here", None, None, None)]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(spark, corpus):
    got = simhash.near_duplicates(frame(spark, corpus)).collect()
    assert len(got) == len(corpus)
    prints = [(r[0], fingerprint(r[1])) for r in corpus]
    assert collections.Counter((r.id, r.fp % 2 ** 64) for r in got) == collections.Counter(prints)
    group = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints):
            if (a ^ b).bit_count() <= 3 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    least = {g: min((prints[k][0] for k in range(len(prints)) if group[k] == g and prints[k][0] is not None), default=None) for g in group}
    want = collections.Counter((prints[k][0], least[group[k]]) for k in range(len(prints)))
    assert collections.Counter((r.id, r.component_id) for r in got) == want
    assert sum(r.fp == 0 for r in got) == 3


def test_trie_links_on_random_values():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    near = np.concatenate([base ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in rng.integers(0, 64, (20, 2))])
    values = np.unique(np.concatenate([base, near]))
    labels = simhash.trie_links(values, np.zeros(len(values), np.int64), 3)
    want = np.arange(len(values))
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= 3]
    want = simhash.hook(want, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert (labels == want).all()


def test_simhash_keeps_one_row_of_each_group(spark, corpus):
    docs = frame(spark, corpus).withColumn("component_id", F.lit("own")).withColumn("fp", F.lit(1))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    n = simhash.near_duplicates(docs).select("component_fp").distinct().count()
    rows = kept.collect()
    assert len(rows) == n
    ids = [r.doc_id for r in rows]
    assert ids.count(5) == 1 and ids.count(0) == 1 and 60 not in ids and ids.count(None) == 1
    assert simhash.keep_one(frame(spark, [])).collect() == []


def test_lm_base_and_normalisation(spark, corpus):
    got = lm.score(frame(spark, corpus)).collect()
    assert len(got) == len(corpus)
    tokens = [((r[1] or "").encode().lower().split() + [b" "], zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2, r[0]) for r in corpus]
    counts = collections.Counter(t for w, out, _ in tokens if not out for t in w)
    n, v = sum(counts.values()), len(counts)
    want = sorted((-1 if i is None else i, out, len(w), sum(counts[t] > 0 for t in w), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in w), 6))
                  for w, out, i in tokens)
    assert sorted((-1 if r.id is None else r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_normalisers_sum_to_one(spark):
    p = lm.start_parameters(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS))
    z = lm.normalisers(spark, p)
    x = (p["context"][3] * p["scale"][0] + p["context"][9] * p["scale"][1]) @ p["target"].T + p["bias"]
    assert abs(np.exp(x - z[3, 9]).sum() - 1) < 1e-4


def test_lm_beats_the_unigram_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_warc_round_trip(spark):
    pages = [(3, "http://a/x y\n", "<p>same</p>"), (1, "http://b", "<p>same</p>"), (2, None, None), (4, "u", ""), (5, "é", "é\r\n\r\nWARC/1.1"),
             (None, "n", "<p>same</p>"), (1, "http://b", "<p>same</p>"), (None, "m", "alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("path", F.lit(0))
    index = warc.write_archives(df, warc.archive_folder(spark))
    got = warc.read_records(index).collect()
    assert len(got) == len(pages)
    text = {(r.page_id, r.payload_bytes): r for r in got}
    for page, _, html in pages:
        payload = (html or "").encode()
        r = text[page, len(payload)]
        assert r.payload_digest == warc.digest32(payload)
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == payload
    kinds = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in got)
    assert kinds == sorted([("3", "revisit", "1"), ("1", "response", "None"), ("1", "response", "None"), ("None", "revisit", "1"), ("2", "response", "None"),
                            ("4", "revisit", "2"), ("5", "response", "None"), ("None", "response", "None")])
    some = warc.read_records(index.where("page_id = 5")).collect()
    assert [r.page_id for r in some] == [5] and bytes(some[0].payload) == pages[4][2].encode()
    empty = warc.write_archives(df.limit(0), warc.archive_folder(spark))
    assert warc.read_records(empty).collect() == []


def test_merged_ranges():
    assert list(warc.merged([(0, 10), (10, 5), (15 + warc.GAP + 1, 4)])) == [(0, 15, 2), (15 + warc.GAP + 1, 4, 1)]
    assert list(warc.merged([])) == []


def test_shards_fit_and_match_sql(spark, corpus, monkeypatch):
    import duckdb
    limit = 20_000
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sharding.assign_shards(docs, limit).drop("text").toPandas()
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = con.execute(queries.OP4_SQL.replace(str(queries.SHARD_BYTES), str(limit))).df()
    columns = sorted(want.columns)
    assert got[columns].sort_values(columns).values.tolist() == want[columns].sort_values(columns).values.tolist()
    assert got["depth"].nunique() > 2


def test_shards_of_repeated_rows_and_extra_columns(spark):
    rows = [(7, "x" * 60)] * 10 + [(8, "y" * 500), (None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("old")).withColumn("h", F.lit(1))
    got = sharding.assign_shards(docs, 200).collect()
    assert len(got) == len(rows) and "h" in sharding.assign_shards(docs, 200).columns
    held = collections.Counter()
    for r in got:
        held[r.shard] += r.bytes
    assert all(held[r.shard] == r.shard_bytes and (r.shard_bytes <= 200 or r.oversize) for r in got)
    assert [r.doc_id for r in got if r.oversize] == [8]
    assert sharding.assign_shards(docs.limit(0), 200).collect() == []


def test_mix_meets_targets(spark, corpus):
    docs = frame(spark, corpus)
    got = mixing.taken_rows(mixing.mix(docs)).collect()
    assert len(got) == len(corpus)
    size = collections.Counter()
    for r in corpus:
        size[r[3]] += len((r[1] or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(size.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * size[s] + 1e-9}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in full}
        left -= sum(2.0 * size[s] for s in full)
        free -= full
    taken = collections.Counter()
    for r in got:
        assert r.size == 0 and r.taken == 0 or r.taken in (0, r.size, 2 * r.size)
        assert abs(r.target - target[r.source]) < 1e-6 and r.source_size == size[r.source]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 300 for s in order)
    again = mixing.taken_rows(mixing.mix(docs.repartition(5))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    rows = mixing.mixed_rows(docs.withColumn("size", F.lit(1)))
    assert rows.columns == [*docs.columns, "size"]
    assert sum(len((r.text or "").split()) for r in rows.collect()) == sum(taken.values())
    assert mixing.mix(docs.limit(0)).collect() == []


def test_quality_counts_and_verdicts(spark, corpus):
    docs = frame(spark, corpus)
    got = quality.judge(docs).collect()
    assert len(got) == len(corpus)
    for r in got:
        assert not (r.base_failed and r.kept)
    one = quality.counts_of("a b a b a é#\n x \nx\n x ".encode())
    words = "a b a b a é# x x x".split()
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) for k in range(3) if grams[tuple(words[i:i + 3])] > 1}
    assert one[:5] == (9, 10, 1, 1, len(inside))
    sf = quality.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = sf.where("not base_failed").join(labels, sf.id == labels.doc_id)
    assert seen.where((F.col("kept").cast("int") != F.col("quality"))).count() <= 0.05 * seen.count()
    assert quality.judge(docs.limit(0)).collect() == []


def test_decontamination_of_exchanged_values(spark):
    items = spark.createDataFrame([(1, "A train leaves Paris at 60 km per hour and meets Anna after 12 km when 60 birds fly over quietly today."), (2, None),
                                   (3, ""), (4, "12 13 14 15 16 17")], "item_id long, text string")
    rows = [(1, "so a train leaves London at 75 km per hour and meets Bob after 9 km when 75 birds fly over quietly today. more"),
            (2, "so a train leaves London at 75 km per hour and meets Bob after 9 km when 80 birds fly over quietly today. more"),
            (3, "so A TRAIN leaves Paris at 60 km per hour and meets Anna after 12 km when 60 birds fly over quietly today."),
            (None, "A train leaves Paris at 60 km per hour and meets Anna after 12 km when 60 birds fly over quietly today."), (4, None), (5, ""),
            (6, "12 13 14 15 16 17"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(1))
    found = {(r.id, r.item_id): r for r in decontam.contaminated(docs, items).collect()}
    assert set(found) == {(1, 1), (3, 1), (None, 1)}
    assert not found[1, 1].exact and found[3, 1].exact
    kept = decontam.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 5, 6]
    assert decontam.contaminated(docs, items.limit(0)).collect() == []
    assert decontam.contaminated(docs.limit(0), items).collect() == []


def test_decontamination_of_items_with_tokens_put_in_and_left_out(spark):
    rng = random.Random(6)
    item = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    one = f"{' '.join(item[:20])} Paris {' '.join(item[20:])}"
    items = spark.createDataFrame([(1, " ".join(item)), (2, one.replace("w", "v")), (3, "only three words"),
                                   (4, "Alice has 5 apples. Alice eats 2. Alice keeps 3."), (5, "Alice knows 5 pears")], "item_id long, text string")
    rows = [(1, " ".join([*item[:20], "added", *item[20:]])), (2, " ".join([*item[:20], *item[21:]])),
            (3, one.replace("w", "v").replace("Paris", "New York")), (4, " ".join([*item[:20], prose(rng, 12), *item[20:]])),
            (5, " ".join(item[20:] + item[:20])), (6, f"{prose(rng, 9)} only three words {prose(rng, 9)}"), (7, "only three other words"),
            (8, " ".join(item[:20])), (9, "on. Bob has 7 apples. Bob eats 4. Bob keeps 3. The"), (10, "on. alice has 5 apples. alice eats 2. alice keeps 3. The"),
            (11, "on. Bob has 7 apples. Bob eats 4. Carl keeps 3. The"), (12, "Bob knows 9 pears"), (13, "said Bob knows 9 pears and"),
            (14, "So Bob knows 9 pears")]
    docs = spark.createDataFrame([(i, f"so {t} end") for i, t in rows], "doc_id long, text string")
    found = {(r.id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    assert found == {(1, 1), (2, 1), (3, 2), (6, 3), (9, 4), (10, 4), (12, 5), (13, 5), (14, 5)}


def test_nearest_examples_are_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "COLUMNS", 7)     # some words are columns, the others posting lists
    rng = np.random.default_rng(5)
    examples = []
    for i in range(500):
        t = rng.choice(60, rng.integers(0, 7), replace=False, p=np.r_[np.full(10, 0.05), np.full(50, 0.01)])
        examples.append((i, int(rng.random() < 0.3), t.astype(np.int64), rng.integers(1, 4, len(t)).astype(float)))
    examples += [(500 + i, 1, *examples[i][2:]) for i in range(0, 100, 5)]      # equal examples: ties
    ix = toxicity.build_index({}, np.arange(60, dtype=np.uint64), rng.random(60) + 1, examples, (3500, 1500))
    by_id = {e[0]: toxicity.vector(e[2], e[3], ix.idf) for e in examples}
    dense = np.zeros((len(ix.ids), 60))
    for j, i in enumerate(ix.ids):
        dense[j, by_id[int(i)][0]] = by_id[int(i)][1]
    assert (ix.column >= 0).sum() == 7
    for i in range(0, 500, 5):
        t, v = by_id[i]
        if len(t):
            leave = int(np.flatnonzero(ix.ids == i)[0]) if i % 2 else -1
            got, score = toxicity.nearest(ix, t, v, 9, leave)
            full = np.round(dense[:, t] @ v, 10)
            full[leave] = full[leave] if leave < 0 else -1
            want = [j for j in np.lexsort((np.arange(len(full)), -full))[:9] if full[j] > 0]
            assert np.allclose(score, full[want]) and got.tolist() == want


def test_copies_of_toxic_examples_are_found(spark, corpus):
    """Copies of toxic examples, all of ordinary words, are scored as toxic, with the example as evidence."""
    rng = random.Random(21)
    texts = [prose(rng, 80) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[i]) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(60)], "doc_id long, toxic int")
    ix = toxicity.fit(docs, labels, fold=None)
    got = {r.id: r for r in toxicity.scores(docs, ix).collect()}
    for i in range(60):
        assert (got[100 + i].score >= 0.5) == (i % 6 == 0) and got[100 + i].evidence[0] == i


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op8_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = got.where(F.col("predicted") == F.col("toxic")).count()
    assert right >= 0.97 * got.count()


def test_mixing_comes_near_every_target(spark):
    got = mixing.taken_rows(mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 0.01 * r.target + 1 for r in got.collect())


def test_shards_keep_columns_and_split_repeated_ids(spark):
    rows = [(None if i % 3 else 7, "x" * (i % 50), i, -i, 2 * i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _pb int, _ph int, _pp int")
    got = sharding.assign_shards(docs, 500)
    assert sorted((r._pb, r._ph, r._pp) for r in got.collect()) == sorted(r[2:] for r in rows)
    assert got.groupBy("shard").agg(F.sum("bytes").alias("b")).where("b > 500").isEmpty() and got.where("oversize").isEmpty()
    assert got.groupBy("shard").agg(F.sum("bytes").alias("b"), F.max("shard_bytes").alias("s")).where("b <> s").isEmpty()


def test_toxicity_of_odd_rows(spark, corpus):
    docs = frame(spark, corpus).withColumn("score", F.lit("own"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    ix = toxicity.fit(docs, labels)
    got = toxicity.scores(docs, ix).collect()
    assert len(got) == len(corpus) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.scores(docs, none).collect()} == {0.5}
    assert toxicity.keep_clean(docs, ix).columns == docs.columns
    assert toxicity.scores(docs.limit(0), ix).collect() == []


def test_compact_windows_group_ranges_with_one_minimum():
    rank = np.random.default_rng(1).permutation(60).astype(np.uint64)
    windows = {c: (a, b) for a, c, b in passages.compact_windows(rank, 8)}
    for lo in range(60):
        for hi in range(lo + 7, 60):
            c = lo + int(rank[lo:hi + 1].argmin())
            assert windows[c][0] <= lo and hi <= windows[c][1]


def test_passages_shared_between_documents(spark):
    rng = random.Random(9)
    shared = prose(rng, 60)
    edited = shared.split()
    edited[30] = "other"
    docs = [(i, f"{prose(rng, 80)} {shared} {prose(rng, 50)}") for i in range(4)] + [(4, f"{prose(rng, 80)} {' '.join(edited)} {prose(rng, 50)}")]
    docs += [(5, f"{prose(rng, 90)} {' '.join(shared.split()[:30])} {prose(rng, 60)}"), (6, prose(rng, 200)), (7, None), (8, ""), (None, shared), (9, "w " * 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("at", F.lit(1))
    got = passages.repeated_passages(df).collect()
    assert {r.id for r in got} | {r.other_id for r in got} == {0, 1, 2, 3, 4}
    text = dict(docs)
    for r in got:
        assert r.stop - r.start >= 50 and r.similarity >= 0.8
        if r.similarity == 1:
            assert text[r.id].split()[r.start:r.stop] == text[r.other_id].split()[r.other_start:r.other_stop]
    assert passages.repeated_passages(df.limit(0)).collect() == []


def test_passages_whose_first_holder_fails(spark):
    """An earlier document holds only a 45-word run, a frequent line is in all:
    later documents that share the whole passage are linked all the same, as
    comparing all pairs finds them."""
    rng = random.Random(4)
    line, docs, want = prose(rng, 30), [], set()
    for k in range(40):
        words, at = prose(rng, (50, 55, 60)[k % 3]).split(), 10 * len(docs)
        part, whole = " ".join(words[3:48]), " ".join(words)
        if k % 2:
            whole = " ".join(words[:10]) + f" {line} " + " ".join(words[40:])
            part = " ".join(words[:8]) + f" {line} " + " ".join(words[45:])
        docs += [(at + i, f"{prose(rng, 70)} {x} {prose(rng, 70)}") for i, x in enumerate([part, whole, whole])]
        want.add((at + 2, at + 1))
    docs += [(10000 + i, f"{prose(rng, 70)} {line} {prose(rng, 70)}") for i in range(30)]
    shingles = {d: [tuple(t.split()[i:i + 50]) for i in range(len(t.split()) - 49)] for d, t in docs}
    holders = collections.defaultdict(set)
    for d, runs in shingles.items():
        for run in runs:
            holders[run].add(d)
    assert {(max(h), min(h)) for h in holders.values() if len(h) > 1} == want
    got = passages.repeated_passages(frame(spark, docs, "doc_id long, text string")).collect()
    assert want <= {(r.id, r.other_id) for r in got}
    for r in got:
        assert r.stop - r.start >= 50 and r.similarity >= 0.8


def test_edited_passages_recall(spark):
    """Lone pairs that share a passage with one to three words changed, dropped or
    added: at least 0.9 of those whose shingles agree to 0.8 are found, also where
    an earlier document holds a part of the passage; brute force on all pairs."""
    rng = random.Random(12)
    docs, near = [], set()

    def shingled(words):
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    for k in range(150):
        words, at = prose(rng, rng.choice([60, 80, 120, 200])).split(), 10 * k
        other = list(words)
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(8, len(other) - 8)
            other[i:i + 1] = rng.choice([["changed"], [], [other[i], "added"]])
        x, y = shingled(words), shingled(other)
        if len(x & y) >= 0.8 * len(x | y):
            near.add((at + 1, at))
        docs += [(at, f"{prose(rng, 70)} {' '.join(words)} {prose(rng, 40)}"), (at + 1, f"{prose(rng, 30)} {' '.join(other)} {prose(rng, 70)}")]
        if k % 3 == 0:
            docs.append((at + 2, f"{prose(rng, 60)} {' '.join(words[10:45])} {prose(rng, 60)}"))
    got = {(r.id, r.other_id) for r in passages.repeated_passages(frame(spark, docs, "doc_id long, text string")).collect()}
    assert len(near) > 80 and len(got & near) >= 0.9 * len(near)
    assert all(a // 10 == b // 10 for a, b in got)


def test_passages_of_named_repeated_and_very_long_rows(spark):
    """Ids that are strings, an id with two texts, copies, extra columns with the
    names used inside, and one very long text."""
    rng = random.Random(13)
    shared, tail = prose(rng, 60), prose(rng, 60)
    long_text = f"{prose(rng, 60000)} {shared} {prose(rng, 60000)}"
    rows = [("a", f"{prose(rng, 70)} {shared}"), ("b", f"{prose(rng, 70)} {tail}"), ("b", f"{shared} {prose(rng, 70)}"), ("c", f"{tail} {prose(rng, 70)}"),
            ("d", f"{tail} {tail}"), ("long", long_text), (None, shared), ("e", prose(rng, 80))]
    rows += [("f", rows[-1][1]), ("f", rows[-1][1]), ("g", " ".join(shared.split()[:49])), ("h", " ".join(shared.split()[:49]))]
    df = frame(spark, rows, "doc_id string, text string").selectExpr("*", "1 AS sig", "2 AS doc", "3 AS id", "4 AS rep", "5 AS key")
    got = passages.repeated_passages(df).collect()
    ids = {(r.id, r.other_id) for r in got}
    groups = [{"a", "b", "long"}, {"b", "c", "d"}, {"e", "f"}]
    assert all(any({x, y} <= g for g in groups) and x > y for x, y in ids)
    assert {x for p in ids for x in p} == {"a", "b", "c", "d", "e", "f", "long"}
    text = collections.defaultdict(list)
    for d, t in rows:
        text[d].append(t.split())
    for r in got:
        assert any(t[r.start:r.stop] == u[r.other_start:r.other_stop] for t in text[r.id] for u in text[r.other_id]) or r.similarity < 1
    assert [(r.start, r.stop) for r in got if r.id == "f"] == [(0, 80)]


def test_passages_of_documents_that_both_have_another(spark):
    """Two documents share 50 words, and each shares part of them, and more before it, with a
    document of its own: the two are linked though neither is without a passage, and each has its rows."""
    rng = random.Random(21)
    docs, want = [], set()
    for k in range(24):
        run = prose(rng, 50).split()
        for i in (0, 2):
            more = prose(rng, 30)
            docs += [(10 * k + i, f"{prose(rng, 40)} {more} {' '.join(run)} {prose(rng, 40)}"),
                     (10 * k + i + 1, f"{prose(rng, 50)} {more} {' '.join(run[:45])} {prose(rng, 50)}")]
            want.add((10 * k + i + 1, 10 * k + i))
        want.add((10 * k + 2, 10 * k))
    links = passages.repeated_passages(frame(spark, docs, "doc_id long, text string"))
    got = links.collect()
    assert want == {(r.id, r.other_id) for r in got}
    rows = passages.both_sides(links).collect()
    assert len(rows) == 2 * len(got) and {r.id for r in rows} == {d for d, _ in docs}
    assert {tuple(r) for r in got} | {(r.other_id, r.other_start, r.other_stop, r.id, r.start, r.stop, r.similarity) for r in got} == {tuple(r) for r in rows}


def test_every_place_of_a_shared_run_has_a_passage(spark):
    """A document holds a run twice, or only a part of what further ones share, or parts of it in
    another order, or it is one word over and over: each place of 50 words that documents share lies in
    a row of its document, and the rows that hold it connect all its documents; brute force on all places."""
    rng = random.Random(31)
    texts = []
    for k in range(20):
        run, words, (a, b, c) = prose(rng, 60), prose(rng, rng.choice([56, 60, 70])).split(), (prose(rng, 30) for _ in range(3))
        for parts in ([run, None, run], [run], [" ".join(words[:52])], [" ".join(words)], [" ".join(words)], [a, b, a, b], [a, b, a, c], [b, a, b]):
            texts.append(" ".join([prose(rng, 40), *(x or prose(rng, 40) for x in parts), prose(rng, 40)]))
    texts += [f"{prose(rng, 40)} {'of ' * n}{prose(rng, 40)}" for n in (55, 61, 400, 90)]
    docs = list(enumerate(texts))
    links = passages.repeated_passages(frame(spark, docs, "doc_id long, text string"))
    rows = collections.defaultdict(list)
    for r in passages.both_sides(links).collect():
        assert r.similarity >= 0.8 and r.stop - r.start >= 50
        rows[r.id].append(r)
    places = collections.defaultdict(list)
    for d, t in docs:
        words = t.split()
        for i in range(len(words) - 49):
            places[tuple(words[i:i + 50])].append((d, i))
    shared = [p for p in places.values() if len({d for d, _ in p}) > 1]
    assert len(shared) > 600
    for p in shared:
        group = {d: d for d, _ in p}
        for d, i in p:
            holding = [r.other_id for r in rows[d] if r.start <= i and i + 50 <= r.stop]
            assert holding, (d, i)
            group = {x: group[d] if x in holding or g in [group.get(o) for o in holding] else g for x, g in group.items()}
        assert len(set(group.values())) == 1, p


def test_shingles_of_many_texts_and_sliding_minima():
    rng = random.Random(22)
    texts = ["", None, "a b", " \t x  Y z\n w\x0bq \xa0É", "b"] + [" ".join(rng.choices("abcdefgh", k=n)) for n in (46, 49, 50, 300, 7000)] + [""]
    tokens, offsets = passages.shingled(pa.array(["no"] + texts, pa.string()).slice(1))
    assert np.diff(offsets).tolist() == [len((t or "").encode().split()) for t in texts] and offsets[-1] == len(tokens)
    named = {}
    for t, at in zip(texts, offsets):
        words = (t or "").encode().lower().split()
        for i in range(len(words) - 4):
            assert named.setdefault(tuple(words[i:i + 5]), tokens[at + i]) == tokens[at + i]
    assert len(set(named.values())) == len(named)
    assert passages.shingled(pa.array([], pa.string()))[1].tolist() == [0]
    rank = np.random.default_rng(3).permutation(6000).astype(np.uint64) << np.uint64(40)
    for least in (1, 2, 7, 46, 64, 4096):
        want = np.lib.stride_tricks.sliding_window_view(rank, least).argmin(axis=1) + np.arange(len(rank) - least + 1)
        assert (passages.smallest(rank, least) == want).all()
    rank = passages.mixed(tokens[offsets[8]:offsets[9] - 4], 0)
    starts = {}
    for s, at in enumerate(passages.smallest(rank, 46)):
        starts.setdefault(int(at), []).append(s)
    for lo, at, hi in passages.compact_windows(rank, 46):
        if (rank == rank[at]).sum() == 1:
            assert starts[at] == list(range(max(lo, at - 45), min(at, hi - 45) + 1))


def test_joint_keys_are_an_interval_join(spark):
    """Keys of two functions are made exactly where a range has both signatures."""
    docs = frame(spark, [(i, prose(random.Random(20 + i), 400)) for i in range(3)], "doc long, text string")
    found = passages.signatures(docs, 46, 3).where("place >= 0")
    windows = passages.unpacked(found).collect()
    want = collections.Counter()
    for a in windows:
        for b in windows:
            if a.doc == b.doc and b.f == (a.f + 1) % 3 and max(a.first, b.first) <= min(a.last, b.last):
                want[a.doc, a.at, a.sig, b.sig] += 1
    got = collections.Counter((r.doc, r.at) for r in passages.joint_keys(found, 46, 3).collect())
    assert got == collections.Counter((d, at) for d, at, *_ in want.elements())


def test_chat_windows_read_back(spark):
    rng = random.Random(1)
    bs = chr(92)
    said = ["</s>[INST] ok [/INST]", bs, bs * 2 + "n", "<|im_end|>\n", "[" + bs + "INST]", "", None, bs + "n[INST]<s>", "x y z " * 30,
            "<<SYS>>a<</SYS>>" + bs, "<|im_start|>user\nhi", "<" + bs + "|", "é <|é|>"]
    roles = ["system", "user", "assistant", None, "a\nb" + bs + "n"]
    rows = [(c or None, t if rng.random() < 0.95 else None, rng.choice(roles) if t else rng.choice(["system", "user"]), rng.choice(said))
            for c in range(60) for t in range(rng.randint(1, 30))]
    rows += rows[-1:]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1))
    groups = collections.defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((-1 if t is None else t, r or "", x or ""))
    for budget, history in ((2048, 256), (60, 20)):
        windows = chat.windows(df, budget, history).cache()
        got = {r.conv_id: r for r in chat.digests(chat.read_back(windows)).collect()}
        assert set(got) == set(groups)
        for c, turns in groups.items():
            turns.sort(key=lambda z: (z[0], z[1].encode(), z[2].encode()))
            whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
            loss = "".join(x for _, r, x in turns if r == "assistant")
            assert got[c].n_turns == len(turns) and got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
            assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        for r in windows.collect():
            assert not r.oversize or r.n_turns - r.n_repeated == 1
    assert chat.windows(df.limit(0)).collect() == []


def test_pipeline_stages_hold_their_contracts(spark):
    import corpus_pipeline as cp
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        after = cp.cut(stage(spark, docs, sf))
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= 2 * docs.count()
        docs = after
    assert cp.STAGES[-1][1](spark, docs, sf).count() == docs.count()


CLASHING = ["doc", "h", "fp", "size", "n", "rank", "key", "value", "row", "hash", "bytes", "words", "copies", "kept_by", "sig", "component_id"]


def test_filters_keep_clashing_columns_and_take_empty_tables(spark, corpus):
    """Operators that return the rows they got: columns named as their own
    intermediates come back untouched, and an empty table stays empty."""
    bench = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(30))), (2, None), (3, "")], "item_id long, text string")
    docs = frame(spark, corpus)
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c)
                              for c in CLASHING])
    for keep in (simhash.keep_one, mixing.mixed_rows, lambda d: decontam.keep_clean(d, bench),
                 lambda d: decontam.keep_clean(d, bench.limit(0))):
        out = keep(docs)
        assert out.columns == docs.columns and keep(docs.limit(0)).collect() == []
        for r in out.collect():
            known = "none" if r["doc_id"] is None else str(r["doc_id"])
            assert all(r[c] == f"{c} of {known}" for c in CLASHING)


def test_empty_tables_give_empty_results(spark):
    docs = frame(spark, [])
    assert simhash.near_duplicates(docs).collect() == []
    assert passages.repeated_passages(docs).collect() == []
    assert quality.judge(docs).collect() == []
    assert lm.score(docs).collect() == []
    assert mixing.mix(docs).collect() == []
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.read_back(chat.windows(talk))).collect() == []
