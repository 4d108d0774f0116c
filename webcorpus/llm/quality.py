"""Quality by weak supervision: rules vote or abstain, expectation-maximisation
estimates how often each rule is right, and a document is kept if its
posterior probability of being good is high enough.

Tasks turn whole texts into counts and votes.  Only the histogram of vote
patterns (at most 3 to the number of rules, whatever the input) reaches the
driver, where EM runs on it; patterns' posteriors go back as a small table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import as_bytes, cut, slices

#: The symbols that are counted.
SYMBOLS = b"#*$%&|<>"

#: Characters that plain prose has few words with.
ODD = re.compile(rb"[#*$%&|<>@^_=+~{}\\\\]|!!")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_shouts", "n_lines", "n_top_word",
          "n_odd_words")


def counts_of(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = text.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, (b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b" ")))
    array = np.frombuffer(text, np.uint8)
    points = chars - int(((array & 0xC0) == 0x80).sum())        # without continuation bytes
    symbols = sum(text.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:]))
        seen = Counter(grams)
        if len(seen) < len(grams):
            twice = np.fromiter((seen[g] > 1 for g in grams), bool, len(grams))
            inside = np.zeros(n, bool)
            for k in range(3):
                inside[k:n - 2 + k] |= twice
            repeated = int(inside.sum())
    upper = int(((array >= 65) & (array <= 90)).sum())
    letters = upper + int(((array >= 97) & (array <= 122)).sum())
    shouts = sum(w.endswith(b"!!") for w in words)
    each = Counter(words)
    top = max(each.values(), default=0)
    odd = sum(k for w, k in each.items() if ODD.search(w))
    return n, points, symbols, len(lines) - len(set(lines)), repeated, upper, letters, shouts, len(lines), top, odd


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, *COUNTS)`` per row, all counts long; a null text has none of anything."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = zip(*(counts_of(x) for x in as_bytes(b.column("text"))))
            cols = [pa.array(c, pa.int64()) for c in got] if b.num_rows else [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], names=["id", *COUNTS])

    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def rules() -> dict[str, Column]:
    """Rule → vote: 1 good, -1 bad, 0 abstains (always on texts without words).
    Most rules know a defect and are silent without it."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")

    def bad(x: Column, above: float) -> Column:
        return F.when((F.col("n_words") > 0) & (x > above), -1).otherwise(0)

    mean, odd = F.col("word_chars") / n, F.col("n_odd_words") / n
    some = F.col("n_words") > 0
    return {
        "length": F.when(F.col("n_words") < 50, -1).when(F.col("n_words") >= 80, 1).otherwise(0),
        "mean_word": F.when(some & ((mean < 2.5) | (mean > 12)), -1).when(some & mean.between(3, 10), 1).otherwise(0),
        "odd_words": F.when(some & (odd > 0.2), -1).when(some & (odd < 0.05), 1).otherwise(0),
        "symbols": bad(F.col("n_symbols") / n, 0.1),
        "repeats": bad(F.col("n_repeat_words") / n, 0.3),
        "top_word": F.when(F.col("n_words") < 20, 0).otherwise(bad(F.col("n_top_word") / n, 0.25)),
        "capitals": F.when(F.col("n_letters") < 20, 0).otherwise(bad(F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)), 0.35)),
        "shouting": bad(F.col("n_shouts") / n, 0.1),
        "dup_lines": F.when(F.col("n_lines") < 4, 0).otherwise(bad(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.3)),
    }


def expectation_maximisation(patterns: np.ndarray, n: np.ndarray, good: float = 0.8, rounds: int = 500) -> tuple[np.ndarray, float, np.ndarray]:
    """Votes per pattern and how many documents have it → posterior of good per
    pattern, share of good, and per class (good, bad) and rule the rates of
    the votes -1, 0 and 1.

    Rules are taken as independent given the class.  Every rule starts better
    than chance, its rates are smoothed, and it may not turn against its
    meaning (a vote against a text is at least as frequent among bad texts as
    among good ones), so the classes keep theirs."""
    votes = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)           # pattern, rule, vote
    polar = (patterns == 1).any(0)[:, None]                                          # rules that also vote for a text
    start = np.stack([np.where(polar, [0.01, 0.24, 0.75], [0.01, 0.98, 0.01]),
                      np.where(polar, [0.30, 0.20, 0.50], [0.30, 0.69, 0.01])])      # class, rule, vote
    rate, posterior = start, np.full(len(patterns), good)
    for _ in range(rounds):
        odds = np.einsum("prv,rv->p", votes, np.log(rate[0]) - np.log(rate[1])) + np.log(good / (1 - good))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        settled = np.abs(new - posterior).max(initial=0) < 1e-9
        posterior = new
        w = np.stack([posterior, 1 - posterior]) * n                                 # class, pattern
        rate = np.einsum("cp,prv->crv", w, votes) + 5 * start
        rate /= rate.sum(2, keepdims=True)
        rate[1, :, 0] = np.maximum(rate[1, :, 0], rate[0, :, 0])
        rate /= rate.sum(2, keepdims=True)
        good = float(np.clip((w[0].sum() + 8) / (n.sum() + 10), 0.02, 0.98))
        if settled:
            break
    return posterior, good, rate


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``(id, *COUNTS, base_failed, posterior, kept)`` per row of ``docs``.

    ``kept``: not ``base_failed`` and a posterior of good of at least
    ``least``.  Null and blank texts fail.  Every row is judged by itself and
    repeated rows alike; ids may be null.  An empty table gives no rows.
    """
    counts = text_counts(docs, id_col, text_col)
    votes = rules()
    # a pattern as one number: the votes as digits to base 3
    code = sum((v.cast("long") + 1) * 3 ** j for j, v in enumerate(votes.values()))
    rows = cut(counts.withColumn("base_failed", base_failed()).withColumn("pattern", code))
    seen = rows.groupBy("pattern").count().orderBy("pattern").collect()             # at most 3 ** len(rules) rows
    codes = np.array([r["pattern"] for r in seen], np.int64)
    patterns = np.stack([codes // 3 ** j % 3 - 1 for j in range(len(votes))], 1) if len(seen) else np.empty((0, len(votes)), np.int64)
    posterior, _, _ = expectation_maximisation(patterns, np.array([r["count"] for r in seen], float))
    known = docs.sparkSession.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior)], "pattern long, posterior double")
    out = rows.join(F.broadcast(known), "pattern")
    return out.select("id", *COUNTS, "base_failed", "posterior", (~F.col("base_failed") & (F.col("posterior") >= least)).alias("kept"))
