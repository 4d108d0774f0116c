"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max
inverted index, distance-weighted votes, calibrated scores and evidence.

Labelled examples (a bounded, documented sample) are indexed under all their words
(A-Z lower-cased, ASCII punctuation stripped), weighted by TF-IDF with document frequencies over all
documents.  Words, and letter groups that words begin with, whose presence among the labelled rows speaks for
the label are terms once more, with ``EXTRA`` times the weight: invented or
misspelt words then meet a known beginning, and a few telling words aren't
drowned in a long text.  The index holds posting lists by blocks of similar examples, with
each term's largest weight per block; words that many examples have are columns of a small
dense matrix instead.  A text visits blocks in the order of their bounds until no block can
hold a nearer example, so the nearest examples are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm.common import as_bytes, crc_mod, lower_words, slices

#: Labelled rows whose terms are counted, and examples kept of each label, at most.
SAMPLE, EXAMPLES = 24_000, 2_500
#: Terms in the vocabulary at most; letters of a beginning; least labelled rows with a term.
TERMS, STEMS, LEAST_ROWS = 2_000, (4, 5, 6, 7), 4
#: A beginning is a dense term too where at least one word of so many has it (cosine alone forgets how often).
DENSE = 150
#: A term must be so many times as frequent under label 1, and its likelihood ratio (chi-square) so large.
LIFT, RATIO = 8.0, 20.0
#: Weight of a telling term beside that of a word.
EXTRA = 10.0
#: Letters of example texts at most (fewer examples are taken of longer texts).
LETTERS = 48 << 20
#: Examples nearer than this are taken for copies, surely so at 1.
COPY = 0.9
#: Examples in a block; neighbours that vote; words that are columns.
BLOCK, K, COLUMNS = 64, 25, 512
#: Words whose terms a task remembers.
MEMORY = 400_000
STRIP = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_terms(word: bytes) -> tuple[bytes, ...]:
    """The terms of one lower-cased word: itself and its beginnings."""
    w = word.strip(STRIP)
    if not w:
        return ()
    if w.isascii():
        size = len(w)
        return (w, *[w[:n] + b"-" for n in STEMS if size >= n])
    letters = w.decode("utf-8", "replace")
    return (w, *[letters[:n].encode() + b"-" for n in STEMS if len(letters) >= n])


@dataclass
class Index:
    """Terms with IDF, examples as block-max posting lists, and calibration."""
    lean: dict[bytes, int]   # telling term → its term number
    words: np.ndarray        # sorted hashes of words; a word's place is its term number
    idf: np.ndarray          # by term: words, then telling terms
    ids: np.ndarray          # example → document id (evidence)
    label: np.ndarray        # example → 0 or 1
    weight: np.ndarray       # example → rows of its label that it stands for
    column: np.ndarray       # term → column of the dense matrix, or -1
    dense: np.ndarray        # example, column → value
    entry_start: np.ndarray  # term → its first entry; an entry is a block that has it
    entry_block: np.ndarray
    entry_max: np.ndarray    # largest value of the term in the block
    post_start: np.ndarray   # entry → its first posting
    post_example: np.ndarray
    post_value: np.ndarray
    prior: float             # share of label 1 among the labelled rows
    slope: float = 1.0
    offset: float = 0.0


def word_hash(word: bytes) -> int:
    """Words are told apart by 64-bit hashes (two of a million words agree with a chance of 3e-8)."""
    return xxhash.xxh64_intdigest(word)


def ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``start..end``, in order."""
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def vector(t: np.ndarray, n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and counts → (terms, unit-length TF-IDF weights)."""
    if not len(t):
        return np.empty(0, np.int64), np.empty(0)
    v = (1 + np.log(n)) * idf[t]
    order = np.argsort(t)
    t, v = t[order], v[order]
    return t, v / np.sqrt((v * v).sum())


def all_terms(text: bytes) -> set[bytes]:
    """Every term that a text has: words, beginnings and dense beginnings."""
    words = lower_words(text)
    seen: Counter = Counter()
    for w, n in Counter(words).items():
        for t in word_terms(w):
            seen[t] += n
    return {*seen, *(t + b"!" for t, n in seen.items() if t.endswith(b"-") and n * DENSE >= len(words))}


class Codes(dict):
    """Word → its number, given at the first look; the new words are kept aside."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class TermCounter:
    """A text's words (``place`` of their hash; -1: left out) and telling terms.  What a word stands for is
    worked out once and remembered, for up to ``MEMORY`` words."""

    def __init__(self, terms: dict[bytes, int], place=lambda h: h - (1 << 64) if h >> 63 else h):
        self.terms, self.place = terms, place
        # beginnings are counted even where only their dense term is in the vocabulary
        stems = {t.removesuffix(b"!") for t in terms if t.endswith(b"-") or t.endswith(b"-!")}
        self.local = {t: i for i, t in enumerate({*terms, *stems})}
        self.own = {i: terms[t] for t, i in self.local.items() if t in terms}
        self.dense = {self.local[t]: terms[t + b"!"] for t in stems if t + b"!" in terms}
        #: first bytes of telling terms: most words begin otherwise, and are looked up no further
        self.heads = {t[:3] for t in self.local}
        self.forget()

    def forget(self) -> None:
        self.code = Codes()
        self.at, self.tells, self.telling = np.empty(1 << 12, np.int64), np.zeros(1 << 12, bool), {}

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self.code) > MEMORY:
            self.forget()
        first = len(self.code)
        c = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        new, self.code.new = self.code.new, []
        while first + len(new) > len(self.at):
            self.at, self.tells = np.concatenate([self.at, self.at]), np.concatenate([self.tells, np.zeros_like(self.tells)])
        for i, word in enumerate(new, first):
            bare = word.strip(STRIP)
            self.at[i] = self.place(word_hash(bare)) if bare else -1
            if bare[:3] in self.heads and (told := [self.local[t] for t in word_terms(word) if t in self.local]):
                self.tells[i], self.telling[i] = True, told
        return c

    def places(self, text: bytes) -> np.ndarray:
        """The distinct places of a text's words."""
        words = lower_words(text)
        c = np.unique(self.codes(words)) if words else np.empty(0, np.int64)
        at = np.unique(self.at[c])
        return at[at != -1]

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """Places of words, how often each occurs, and telling term → count."""
        words = lower_words(text)
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64), {}
        c, n = np.unique(self.codes(words), return_counts=True)
        at = self.at[c]
        seen: Counter = Counter()
        for j in np.flatnonzero(self.tells[c]).tolist():
            for t in self.telling[int(c[j])]:
                seen[t] += int(n[j])
        out = {self.own[t]: x for t, x in seen.items() if t in self.own}
        for t, x in seen.items():
            if t in self.dense and x * DENSE >= len(words):
                out[self.dense[t]] = x
        have = at != -1
        place, inverse = np.unique(at[have], return_inverse=True)
        return place, np.bincount(inverse, n[have], len(place)).astype(np.int64), out


def place_in(words: np.ndarray):
    """Hash → its place among ``words``, or -1."""
    places = dict(zip(words.tolist(), range(len(words))))
    return lambda h: places.get(h, -1)


def arrays(place: np.ndarray, n: np.ndarray, told: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and counts."""
    return (np.r_[place, np.fromiter(told, np.int64, len(told))],
            np.r_[n, np.fromiter(told.values(), np.int64, len(told))].astype(np.float64))


def dense_scores(ix: Index, vecs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Per vector its product with every example over the dense columns: one matrix product for all."""
    q = np.zeros((len(vecs), ix.dense.shape[1]))
    for row, (t, v) in zip(q, vecs):
        col = ix.column[t]
        row[col[col >= 0]] = v[col >= 0]
    return q @ ix.dense.T


def nearest(ix: Index, t: np.ndarray, v: np.ndarray, k: int, leave: int = -1, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` examples of largest cosine with a unit vector (ties: the first
    example), and their cosines; ``leave`` is left out.  Exact: the k-th best dense score (``base``, of
    ``dense_scores``) is a lower bound of the k-th cosine, as no value is negative, and a block is skipped only if its
    own bound, its best dense score and the largest value of each other term, is below that."""
    base = dense_scores(ix, [(t, v)])[0] if base is None else base
    n = len(ix.label)
    own = base[:n] if leave < 0 else np.r_[base[:leave], base[leave + 1:n]]
    least = max(0.0, float(np.partition(own, len(own) - k)[len(own) - k])) - 1e-9 if len(own) > k else 0.0
    sparse = ix.column[t] < 0
    t, v = t[sparse], v[sparse]
    start, end = ix.entry_start[t], ix.entry_start[t + 1]
    entry, x = ranges(start, end), np.repeat(v, end - start)
    block = ix.entry_block[entry]
    n_blocks = len(base) // BLOCK
    bound = base.reshape(n_blocks, BLOCK).max(axis=1) + np.bincount(block, ix.entry_max[entry] * x, n_blocks)
    here = (bound >= least) & (bound > 0)
    if not here.all():
        pick = here[block]
        entry, x = entry[pick], x[pick]
    lo, hi = ix.post_start[entry], ix.post_start[entry + 1]
    post = ranges(lo, hi)
    score = np.bincount(ix.post_example[post], ix.post_value[post] * np.repeat(x, hi - lo), len(base)) + base
    score[~np.repeat(here, BLOCK)] = 0
    score[n:] = 0
    if leave >= 0:
        score[leave] = 0
    score = np.round(score, 10)
    if len(score) > k:
        i = np.flatnonzero(score >= max(np.partition(score, len(score) - k)[len(score) - k], 1e-10))
    else:
        i = np.flatnonzero(score > 0)
    i = i[np.argsort(-score[i], kind="stable")][:k]
    return i, score[i]


def votes(ix: Index, t: np.ndarray, v: np.ndarray, k: int, leave: int = -1, base: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """Distance-weighted share of label 1 among the nearest examples (a copy counts fifty times as much as an
    example at a right angle would), smoothed by the prior as one more, far neighbour."""
    i, s = nearest(ix, t, v, k, leave, base) if len(t) else (np.empty(0, np.int64), np.empty(0))
    w = s * s / (1.02 - np.minimum(s, 1.0)) * ix.weight[i]
    far = 0.002 * float(ix.weight.min(initial=1.0))
    return (float((w * ix.label[i]).sum()) + far * ix.prior) / (float(w.sum()) + far), i, s


def logit(p: np.ndarray | float) -> np.ndarray | float:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def score_of(ix: Index, share: float) -> float:
    return float(1 / (1 + np.exp(-(ix.slope * logit(share) + ix.offset))))


def build_index(lean: dict[bytes, int], words: np.ndarray, idf: np.ndarray, examples: list[tuple[int, int, np.ndarray, np.ndarray]],
                totals: tuple[int, int]) -> Index:
    """Examples (id, label, terms, counts) and the number of labelled rows by
    label → index.  Similar examples are put next to each other (by their
    heaviest shared terms), which makes the bounds of blocks tight."""
    vecs = [vector(t, n, idf) for _, _, t, n in examples]
    held = np.bincount(np.concatenate([t for t, _ in vecs] or [np.empty(0, np.int64)]), minlength=len(idf))
    lead = []
    for t, v in vecs:
        common = np.flatnonzero(held[t] * 100 >= len(vecs))
        lead.append(tuple(t[common[np.argsort(-v[common], kind="stable")][:6]].tolist()))
    order = sorted(range(len(examples)), key=lambda j: (lead[j], examples[j][0]))
    label = np.array([examples[j][1] for j in order], np.int64)
    vecs = [vecs[j] for j in order]
    have = np.bincount(label, minlength=2)
    weight = np.array([totals[x] / max(1, have[x]) for x in (0, 1)])[label] if len(label) else np.empty(0)
    n_blocks = max(1, -(-len(order) // BLOCK))
    term = np.concatenate([t for t, _ in vecs] or [np.empty(0, np.int64)])
    value = np.concatenate([v for _, v in vecs] or [np.empty(0)])
    example = np.repeat(np.arange(len(vecs)), [len(t) for t, _ in vecs])
    # terms that many examples have: columns
    wide = np.argsort(-held, kind="stable")[:COLUMNS]
    wide = wide[held[wide] * 20 >= max(1, len(vecs))]
    column = np.full(len(idf), -1)
    column[wide] = np.arange(len(wide))
    dense = np.zeros((n_blocks * BLOCK, len(wide)))
    inside = column[term] >= 0
    dense[example[inside], column[term[inside]]] = value[inside]
    term, value, example = term[~inside], value[~inside], example[~inside]
    cell = term * n_blocks + example // BLOCK
    by = np.lexsort((example, cell))
    cell, example, value = cell[by], example[by], value[by]
    entry, post_start = np.unique(cell, return_index=True)
    entry_max = np.maximum.reduceat(value, post_start) if len(entry) else np.empty(0)
    entry_start = np.searchsorted(entry, np.arange(len(idf) + 1) * n_blocks)
    prior = (totals[1] + 0.5) / (sum(totals) + 1)
    ix = Index(lean, words, idf, np.array([examples[j][0] for j in order], np.int64), label, weight, column, dense,
               entry_start, (entry % n_blocks).astype(np.int32), entry_max, np.r_[post_start, len(value)], example.astype(np.int32), value, prior)
    # words that no other example has would not be in the index if the example weren't
    vecs = [vector(*(x[held[examples[j][2]] > 1] for x in examples[j][2:]), idf) for j in order]
    # calibration: a logistic curve through the leave-one-out votes, each label at its own weight
    x = np.array([logit(votes(ix, *vecs[j + i], K, j + i, base)[0]) for j in range(0, len(vecs), BLOCK)
                  for i, base in enumerate(dense_scores(ix, vecs[j:j + BLOCK]))])
    a, b = 1.0, 0.0
    if len(set(label.tolist())) == 2:
        w = weight / weight.sum()
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([(w * (p - label) * x).sum() + 1e-3 * (a - 1), (w * (p - label)).sum()])
            r = w * p * (1 - p)
            h = np.array([[(r * x * x).sum() + 1e-3, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    ix.slope, ix.offset = max(0.05, float(a)), float(b)
    return ix


def fit(docs: DataFrame, labels: DataFrame, fold: int | None = 5, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE, examples: int = EXAMPLES) -> Index:
    """Index of labelled rows (those whose crc32 of the id mod ``fold`` is 0 are
    left out); document frequencies are counted over all of ``docs``.  ``sample`` bounds the rows whose terms are counted and
    ``examples`` the examples of each label; both are taken by a hash of the
    id.  Null labels and ids are no labels; an id labelled twice counts once,
    as toxic if either row says so.  Without labelled rows every score is
    0.5."""
    src = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if fold:
        src = src.where(crc_mod(F.col(id_col), fold) != 0)
    src = src.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    n = {r["label"]: r["count"] for r in src.groupBy("label").count().collect()}
    share = {x: min(1.0, sample / 2 / max(1, n.get(x, 0))) for x in (0, 1)}
    u = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    pick = src.withColumn("u", u).where(F.col("u") < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(pick), "id").select("id", "label", "u", "text")   # at most about ``sample`` narrow rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush() -> pa.RecordBatch:
            every = list({*seen[0], *seen[1]})
            out = pa.RecordBatch.from_arrays(
                [pa.array(every, pa.binary()), *(pa.array([seen[x][t] for t in every], pa.int64()) for x in (0, 1))],
                names=["term", "n0", "n1"])
            seen[0].clear()
            seen[1].clear()
            return out

        for b in slices(batches):
            for label, text in zip(b.column("label").to_pylist(), as_bytes(b.column("text"))):
                seen[label].update(all_terms(text))
            if len(seen[0]) + len(seen[1]) > 400_000:
                yield flush()
        yield flush()

    m = {x: n.get(x, 0) * share[x] for x in (0, 1)}
    counted = rows.mapInArrow(count, "term binary, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counted = counted.where(F.col("n0") + F.col("n1") >= LEAST_ROWS)
    # terms that favour label 1, by the likelihood ratio of their rates differing over being one rate
    n1, n0, rate = F.col("n1"), F.col("n0"), (F.col("n0") + F.col("n1")) / max(1.0, m[0] + m[1])
    ratio = 2 * (n1 * F.log(F.greatest(n1, F.lit(1)) / (m[1] * rate + 1e-9)) + n0 * F.log(F.greatest(n0, F.lit(1)) / (m[0] * rate + 1e-9)))
    lift = ((n1 + 0.5) / (m[1] + 1)) / ((n0 + 0.5) / (m[0] + 1))
    chosen = (counted.withColumn("ratio", ratio).where((lift > LIFT) & (F.col("ratio") > RATIO))
              .orderBy(F.round("ratio", 6).desc(), "term").limit(TERMS).select("term", "n0", "n1").collect())
    lean = {bytes(r["term"]): j for j, r in enumerate(chosen)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(lean)
        for b in slices(batches):
            got = [counter(x) for x in as_bytes(b.column("text"))]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in ([g[0] for g in got], [g[1] for g in got], [list(g[2]) for g in got], [list(g[2].values()) for g in got])]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), *lists], names=["id", "label", "w", "wn", "t", "tn"])

    near = {x: min(1.0, examples / max(1, n.get(x, 0))) for x in (0, 1)}
    closest = rows.where(F.col("u") < F.when(F.col("label") == 1, near[1]).otherwise(near[0])).select("id", "label", "u", "text")
    letters = closest.agg(F.sum(F.char_length("text"))).first()[0] or 0
    if letters > LETTERS:
        near = {x: share * LETTERS / letters for x, share in near.items()}
        closest = closest.where(F.col("u") < F.when(F.col("label") == 1, near[1]).otherwise(near[0]))
    got = closest.select("id", "label", "text").mapInArrow(vectors, "id long, label int, w array<long>, wn array<long>, t array<long>, tn array<long>").toArrow()
    by = sorted(range(got.num_rows), key=lambda i: (got["id"][i].as_py(), got["w"][i].as_py()))
    last = {got["id"][i].as_py(): i for i in reversed(by)}     # a repeated id is one example
    cells = {c: [got[c][i].values.to_numpy() for i in last.values()] for c in ("w", "wn", "t", "tn")}
    ids, marks = list(last), [got["label"][i].as_py() for i in last.values()]
    words = np.unique(np.concatenate([np.empty(0, np.int64), *cells["w"]]).view(np.uint64))
    # document frequencies: of words over all documents, of telling terms over the labelled rows at the labels' true shares
    df, n_docs = document_frequencies(docs, words, text_col)
    idf_words = np.log((1 + n_docs) / (1 + df)) + 1.0
    total = max(1, sum(n.values()))
    told = np.array([r["n0"] / max(share[0], 1e-12) + r["n1"] / max(share[1], 1e-12) for r in chosen])
    idf = np.r_[idf_words, EXTRA * (np.log((1 + total) / (1 + np.minimum(told, total))) + 1.0)]
    lean = {t: len(words) + j for t, j in lean.items()}
    made = [(i, x, np.r_[np.searchsorted(words, w.view(np.uint64)), len(words) + t], np.r_[wn, tn].astype(np.float64))
            for i, x, w, wn, t, tn in zip(ids, marks, cells["w"], cells["wn"], cells["t"], cells["tn"])]
    order = sorted(range(len(made)), key=lambda j: made[j][0])
    return build_index(lean, words, idf, [made[j] for j in order], (n.get(0, 0), n.get(1, 0)))


def document_frequencies(docs: DataFrame, words: np.ndarray, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all documents each word of the index occurs, and how many documents there are; tasks send counts of the
    index's words alone."""
    sent = docs.sparkSession.sparkContext.broadcast(words)      # as many as the examples have

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        counter = TermCounter({}, place_in(vocabulary))
        df, n = np.zeros(len(vocabulary) + 1, np.int64), 0
        for b in slices(batches):
            n += b.num_rows
            for text in as_bytes(b.column("text")):
                df[counter.places(text)] += 1
        df[len(vocabulary)] = n
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], names=["term", "n"])

    src = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    got = src.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(words) + 1, np.int64)
    df[got["term"].to_numpy()] = got["n"].to_numpy()
    return df[:-1], int(df[-1])


def ship(spark: SparkSession, ix: Index):
    return spark.sparkContext.broadcast(dict(vars(ix)))    # the words of at most ``LETTERS`` letters, and at most TERMS telling terms


def blank_score(ix: Index) -> float:
    return score_of(ix, ix.prior) if len(ix.label) else 0.5


def scorer(ix: Index, evidence: int):
    counter = TermCounter(ix.lean, place_in(ix.words))
    empty = blank_score(ix)

    def some(texts: list[bytes]) -> Iterator[tuple[float, list[int]]]:
        for j in range(0, len(texts), BLOCK):
            vecs = [vector(*arrays(*counter(x)), ix.idf) for x in texts[j:j + BLOCK]]
            for (t, v), base in zip(vecs, dense_scores(ix, vecs)):
                if not len(t) or not len(ix.label):
                    yield empty, []
                    continue
                share, i, s = votes(ix, t, v, K, -1, base)
                p, sure = score_of(ix, share), min(1.0, max(0.0, float(s[0]) - COPY) / (1 - COPY)) if len(s) else 0.0
                if sure:    # a labelled copy speaks for itself, whatever far neighbours are worth
                    same = ix.label[i[s > COPY]]
                    p = (1 - sure) * p + sure * (same.sum() + 0.02) / (len(same) + 0.04)
                yield p, ix.ids[i[:evidence]].tolist()

    return some


def scores(docs: DataFrame, ix: Index, id_col: str = "doc_id", text_col: str = "text", evidence: int = 3) -> DataFrame:
    """``(id, score, evidence)`` per row: the calibrated chance of label 1 and the
    ids of the nearest labelled examples.  A null or empty text, or one
    without any word of the examples, has the score of the prior.  Ids are carried, never looked at."""
    sent = ship(docs.sparkSession, ix)
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = scorer(Index(**sent.value), evidence)
        for b in slices(batches):
            got = list(some(as_bytes(b.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.list_(pa.int64()))],
                names=["id", "score", "evidence"])

    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, score double, evidence array<long>")


def keep_clean(docs: DataFrame, ix: Index, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, as they are."""
    sent = ship(docs.sparkSession, ix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = scorer(Index(**sent.value), 0)
        for b in slices(batches):
            yield b.filter(pa.array([x[0] < threshold for x in some(as_bytes(b.column(text_col)))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
