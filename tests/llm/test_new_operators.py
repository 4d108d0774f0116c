"""Spelling variants, conversation repair and exact top-k against brute force,
with nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from webcorpus.llm import queries, repair, spelling, topk
from webcorpus.llm.repair import ASSISTANT, GO, NOTHING, SHORT, SYSTEM, USER

SF001 = "/root/testdata/sf0.001"


# ------------------------------------------------------------ spelling
def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, min_length=7, min_count=2, ratio=10, noise=31):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    n = {w: c for w, c in count.items() if c >= min_count and len(w) >= min_length}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and x != w and one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def spelling_rows():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(7, 11))) for _ in range(40)]
    words = []
    for w in base:  # common words, then rarer words one edit away, and words one edit from those
        words += [w] * rng.choice((2, 30, 200))
        for _ in range(rng.randint(0, 5)):
            i = rng.randrange(len(w))
            v = rng.choice((w[:i] + w[i + 1:], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcé") + w[i + 1:]))
            words += [v] * rng.choice((1, 2, 3, 20))
            j = rng.randrange(len(v))
            words += [v[:j] + "z" + v[j + 1:]] * 2
    words += ["aaaaaaaa"] * 30 + ["aaaaaaa"] * 3 + ["aaaaaaaaa"] * 300 + ["Aaaaaaab"] * 2 + ["abcdefg"] * 2 + ["bbcdefg"] * 30 + ["cbcdefg"] * 30
    # hundreds of words that share prefix and suffix
    words += [f"common{x}{y}suffix" for x in "abcdefghijklmno" for y in "abcdefghijklmno" for _ in range(2)]
    rng.shuffle(words)
    rows = [(i, " ".join(words[i * 40:(i + 1) * 40])) for i in range(len(words) // 40 + 1)]
    rows += [(900, None), (901, ""), (902, " .,;:\n\t"), (None, "abcdefg abcdefg é×÷ééééé"), (903, "q" * 30000 + " " + "q" * 30000),
             (904, "q" * 29999 + "! " + "q" * 29999), rows[0], rows[0], (905, "ABCDEFG abcDefGÉ abcdefgé Ābcdefgh")]
    return rows


@pytest.mark.parametrize("block", [2048, 8])
def test_spelling_matches_brute_force(spark, block, monkeypatch):
    rows = spelling_rows()
    docs = spark.createDataFrame([(i, t, "x", 3, None) for i, t in rows], "doc_id long, text string, word string, n int, key string")
    real = spelling.dealt
    monkeypatch.setattr(spelling, "dealt", lambda words, windows=3, _=0: real(words, windows, block))  # blocks of 8 split hot keys
    got = [tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = brute_variants(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(r[1] is not None for r in got) > 20 and any(r[1] not in (None, r[2]) for r in got)


def test_spelling_edge_cases(spark):
    schema = "doc_id long, text string"
    assert spelling.variants(spark.createDataFrame([], schema)).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (None, "")], schema)).collect() == []
    # equal counts: the smallest in code-point order is the form; a path of forms ends in its root
    text = " ".join(["kaaaaaa"] * 2 + ["laaaaaa"] * 20 + ["maaaaaa"] * 20 + ["laaaaab"] * 200)
    got = {r.word: r for r in spelling.variants(spark.createDataFrame([(1, text)], schema), noise=0).collect()}
    assert (got["kaaaaaa"].form, got["kaaaaaa"].root, got["kaaaaaa"].n_near) == ("laaaaaa", "laaaaab", 2)
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], schema), ratio=1)


# ------------------------------------------------------------ repair
def every_repair(tokens):
    """(cost, audit) of all edits with at most two inserts in a row."""
    after = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
    found = []

    def go(i, state, cost, audit, inserts):
        if i == len(tokens) and state in (NOTHING, ASSISTANT):
            found.append((cost, audit))
        if inserts < 2:
            go(i, after[state], cost + 2, audit + "I", inserts + 1)
        if i < len(tokens):
            t = tokens[i]
            go(i + 1, state, cost + 3, audit + "D", 0)
            if not t & GO:
                own, extra = t & 3, 1 if t & SHORT else 0
                if (own == SYSTEM and state == NOTHING) or own == after[state]:
                    go(i + 1, own, cost + extra, audit + "K", 0)
                go(i + 1, after[state], cost + extra + 2, audit + "R", 0)

    go(0, NOTHING, 0, "", 0)
    return min(found)


def test_cheapest_edits_against_all_edits():
    kinds = [0, SYSTEM, USER, ASSISTANT, GO, USER | SHORT, ASSISTANT | SHORT, SYSTEM | SHORT]
    for n in range(4):
        for tokens in itertools.product(kinds, repeat=n):
            assert repair.cheapest_edits(bytes(tokens)) == every_repair(tokens), tokens
    rng = random.Random(5)
    for _ in range(60):
        tokens = [rng.choice(kinds) for _ in range(rng.randint(4, 5))]
        assert repair.cheapest_edits(bytes(tokens)) == every_repair(tokens), tokens


def test_long_conversations_stay_linear():
    rng = random.Random(6)
    for kinds in ([USER], [ASSISTANT, USER], [0, SYSTEM, USER, ASSISTANT, GO, USER | SHORT], [USER | SHORT, ASSISTANT | SHORT, GO]):
        began = time.time()
        cost, audit = repair.cheapest_edits(bytes(rng.choice(kinds) for _ in range(20000)))
        assert len(audit) - audit.count("I") == 20000 and time.time() - began < 20


def brute_report(rows, ids):
    """From the damaged rows, in the order the operator states."""
    out = {}
    for conv in ids:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, tokens, stat = set(), [], collections.Counter()
        for a, b in zip(own, own[1:]):
            stat["illegal"] += a[2][:1] + b[2][:1] not in ("su", "ua", "au")
        for _, _, role, text in own:
            inner = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else ""
            seen.add((role, text))
            stat[fault] += 1
            tokens.append(GO if fault in ("blank", "duplicate") else {"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + (SHORT if fault else 0))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit = repair.cheapest_edits(bytes(tokens))
        text = "\n".join(f"{role}:{t}" for _, role, t in repair.walk(audit, iter([(r[2], r[3]) for r in own])))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, stat["blank"], stat["duplicate"], stat["truncated"], stat["illegal"], cost, audit, hashlib.sha256(text.encode()).hexdigest())
        roles = [r[0] for _, r, _ in repair.walk(audit, iter([(r[2], r[3]) for r in own]))]
        assert re.fullmatch("(s?(ua)+)?", "".join(roles))
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def test_repair_report(spark):
    rng = random.Random(7)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(0, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "uncle"]) if conv is None or conv % 3 == 0 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "No!", "Why?", "and then", "", " \t\n", None, f"Turn {turn} é.", "z" * 20000 + "."])
            rows.append((conv, rng.choice([turn, turn + 1, None]) if rng.random() < 0.3 else turn, role, text))
    rows += [(3, None, "user", "Yes."), (3, None, "user", "Yes."), rows[0], rows[0]]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, copy int")
    got = repair.report(repair.damage(frame), frame.select(F.col("conv_id").alias("conv")))
    want = brute_report(damaged(rows), {r[0] for r in rows})
    assert {r.conv: tuple(r)[1:] for r in got.collect()} == want and got.count() == len(want)
    empty = frame.limit(0)
    assert repair.report(repair.damage(empty), empty.select(F.col("conv_id").alias("conv"))).collect() == []


def test_repaired_rows_and_text_ids(spark):
    rows = [("a", 0, "assistant", "Hi."), ("a", 1, "user", "Q?"), ("a", 1, "user", "Q?"), ("b", 0, "user", "only."), ("c", 0, "user", "cut")]
    marked = repair.faults(spark.createDataFrame(rows, "conv string, turn long, role string, text string"))
    found = repair.audits(marked)
    got = [tuple(r) for r in repair.repaired_rows(marked, found).orderBy("conv", "place").collect()]
    audit = {r.conv: (r.cost, r.audit) for r in found.collect()}
    # delete the leading answer (3) or put a question before it (2); an answer is put in behind the question
    assert audit == {"a": (7, "IKKDI"), "b": (2, "KI"), "c": (3, "D")}  # of equal costs the audit least in ASCII order
    assert got == [("a", 0, "I", "user", ""), ("a", 1, "K", "assistant", "Hi."), ("a", 2, "K", "user", "Q?"), ("a", 3, "I", "assistant", ""),
                   ("b", 0, "K", "user", "only."), ("b", 1, "I", "assistant", "")]


# ------------------------------------------------------------ exact top-k
def brute_top(rows, k, every=20):
    """Multiset of (query id, rank, id, score); rows are told apart by place."""
    whole = [(i, [int(np.floor(64 * np.float64(x))) for x in v]) for i, v in rows
             if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = collections.Counter()
    for a, (i, q) in enumerate(whole):
        if i is None or i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(whole) if b != a and len(v) == len(q))
        out.update((i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k]))
    return out


@pytest.mark.parametrize("bins,block", [(256, 512), (32, 7)])
def test_top_k_matches_brute_force(spark, bins, block, monkeypatch):
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "QUERY_ROWS", block)
    monkeypatch.setattr(topk, "VECTOR_ROWS", 5 * block)
    rng = np.random.default_rng(13)
    unit = rng.normal(size=(260, 8)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(unit)]
    rows += [(1000 + i, [0.5] * 8) for i in range(120)]  # one vector again and again
    rows += [(7, [0.25] * 8), (20, [0.5] * 8), (20, [0.5] * 8), (None, [0.5] * 8), (40, [0.0] * 8)]  # repeated ids, no id, zeros
    rows += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [3.0, -1.0]), (3020, [1.0, 2.0]), (4000, []), (4001, []), (5000, [1.0] * 3)]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, row string, vec int").repartition(5)
    got = topk.top_k(frame, F.col("id") % 20 == 0, k=20)
    assert collections.Counter(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute_top(rows, 20)


def test_top_k_large_components_and_empty(spark):
    schema = "vec_id long, embedding array<double>"
    rng = random.Random(1)
    for size in (1e3, 1e7):  # double precision, 64-bit integers (single: the test above)
        rows = [(i, [rng.uniform(-size, size) for _ in range(4)]) for i in range(60)]
        got = topk.top_k(spark.createDataFrame(rows, schema), F.col("id") % 20 == 0, k=7, salts=3)
        assert collections.Counter(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute_top(rows, 7)
    assert topk.top_k(spark.createDataFrame([], schema), F.col("id") % 20 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(20, [1.0])], schema), F.col("id") % 20 == 0).collect() == []
    with pytest.raises(Exception, match="2\\^62"):
        topk.top_k(spark.createDataFrame([(20, [1e300])], schema), F.col("id") % 20 == 0).collect()


def test_new_queries_have_contract_columns(spark):
    want = {"op11_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
            "op12_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
            "op13_topk": ["query_id", "rank", "vec_id", "score"]}
    for key, cols in want.items():
        got = queries.QUERIES[key](spark, SF001)
        assert got.columns == cols and got.count() > 0 and key in queries.ORACLE
