"""Language-model scores: a log-bilinear model trained with noise-contrastive
estimation, and a unigram base.

Symbols.  The ``VOCAB`` most frequent training tokens are symbols of their
own; every other token falls into one of ``CLASSES`` classes by its last
letters, and has the class's probability times its smoothed share of the
class.  So every token, seen or not, has a probability, and they sum to one
over the known tokens and one unseen token a class.

Model.  The two symbols before a token predict it: their embeddings, scaled
per position, add up to a prediction, whose product with the token's
embedding plus its bias is the token's score.  Tasks train on all training
tokens of their rows with noise words in place of the normaliser, and the
rounds' parameters are averaged by tokens seen.  As a context is only two
symbols, all normalisers fit into one table; batched matrix products fill it
in tasks, and after that a token's exact normalised log-probability is a few
lookups.

Counts.  Token counts cover the whole training corpus.  The counts of the
``KNOWN`` most frequent tokens are sent to all tasks (a bounded table); rarer
tokens leave their task as hashes and are joined with the count table, so no
key of that join is frequent.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import as_bytes, crc_mod, cut, lower_words, slices

VOCAB, CLASSES, DIM = 896, 128, 16
#: Tokens whose counts are sent to all tasks.
KNOWN = 131_072
#: Noise words a batch, tokens a batch, passes over the training tokens, learning rate, tasks whose parameters are averaged.
NOISE, BATCH, ROUNDS, RATE, TRAINERS = 48, 4096, 1, 0.15, 256
#: The end of a text; not a word, as words hold no space.
END = b" "
SYMBOLS = VOCAB + CLASSES
SEED = 11


def token_class(token: bytes) -> int:
    """The class of a token outside the vocabulary, by how it ends (without punctuation)."""
    return xxhash.xxh32_intdigest(token.rstrip(b".,;:!?")[-3:], SEED) % CLASSES


def token_hash(token: bytes) -> int:
    """64 bits as a signed number: two of n tokens share one with a chance of n * n / 2 ** 65."""
    h = xxhash.xxh64_intdigest(token, SEED)
    return h - (1 << 64) if h >> 63 else h


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, h, cls, c)`` over all rows of ``docs``; tokens are added up in a
    task before they are shuffled."""
    src = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "c"])
            seen.clear()
            return out

        for b in slices(batches):
            for t in as_bytes(b.column("text")):
                seen.update(lower_words(t))
                seen[END] += 1
            if len(seen) > 500_000:
                yield flush()
        yield flush()

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b.column("token").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("token"), pa.array([token_hash(t) for t in tokens], pa.int64()),
                 pa.array([token_class(t) for t in tokens], pa.int16()), b.column("c")], names=["token", "h", "cls", "c"])

    counted = src.mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))
    return counted.mapInArrow(marks, "token binary, h long, cls short, c long")


class Symbols(dict):
    """Symbols by token; a token met for the first time is entered with its class."""

    def __missing__(self, token: bytes) -> int:
        s = self[token] = VOCAB + token_class(token)
        return s


class Reader:
    """Texts to symbols: frequent tokens by table, others by class."""

    def __init__(self, vocab: list[bytes]):
        self.symbol = {t: i for i, t in enumerate(vocab)}
        self.known = Symbols(self.symbol)

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        if len(self.known) > 400_000:
            self.known = Symbols(self.symbol)
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))


def contexts(s: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two before each (a text begins after an end)."""
    return np.r_[end, s[:-1]], np.r_[end, end, s[:-2]][:len(s)]


def start_parameters(unigram: np.ndarray) -> dict[str, np.ndarray]:
    """Small embeddings and the unigram's logarithms as biases: the model starts as the unigram."""
    rng = np.random.default_rng(SEED)
    return {"context": rng.normal(0, 0.3, (SYMBOLS, DIM)), "target": rng.normal(0, 0.05, (SYMBOLS, DIM)),
            "scale": np.stack([np.ones(DIM), np.full(DIM, 0.6)]), "bias": np.log(unigram)}


def add_rows(index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by symbol, a column at a time."""
    return np.stack([np.bincount(index, column, SYMBOLS) for column in np.ascontiguousarray(rows.T)], 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.clip(x, -30, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Noise-contrastive estimation with Adagrad steps.  Noise is drawn from the
    unigram, once a batch, so its scores are one matrix product; the model's
    normaliser is taken as one while training."""

    def __init__(self, p: dict[str, np.ndarray], unigram: np.ndarray, seed: int):
        self.p = {k: v.copy() for k, v in p.items()}
        self.square = {k: np.full(v.shape, 1e-2) for k, v in p.items()}
        self.log_noise, self.unigram, self.rng, self.seen = np.log(NOISE * unigram).astype(np.float32), unigram, np.random.default_rng(seed), 0

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        # products in single precision, sums and parameters in double
        p, n = {k: v.astype(np.float32) for k, v in self.p.items()}, len(word)
        noise = self.rng.choice(SYMBOLS, NOISE, p=self.unigram)
        a, b = p["context"][one], p["context"][two]
        guess = a * p["scale"][0] + b * p["scale"][1]
        rows, other = p["target"][word], p["target"][noise]
        true = sigmoid((guess * rows).sum(1) + p["bias"][word] - self.log_noise[word])
        false = sigmoid(guess @ other.T + (p["bias"][noise] - self.log_noise[noise]))
        d_true = (1 - true)[:, None]
        d_guess = d_true * rows - false @ other
        grad = {"target": add_rows(word, d_true * guess) - add_rows(noise, false.T @ guess),
                "bias": np.bincount(word, 1 - true, SYMBOLS) - np.bincount(noise, false.sum(0), SYMBOLS),
                "context": add_rows(one, d_guess * p["scale"][0]) + add_rows(two, d_guess * p["scale"][1]),
                "scale": np.stack([(d_guess * a).sum(0), (d_guess * b).sum(0)])}
        for k, g in grad.items():
            g /= n ** 0.5
            self.square[k] += g * g
            self.p[k] += (RATE if k != "scale" else RATE / 10) * g / np.sqrt(self.square[k])
        self.seen += n


PARTS = {"context": (SYMBOLS, DIM), "target": (SYMBOLS, DIM), "scale": (2, DIM), "bias": (SYMBOLS,)}


def train(docs: DataFrame, vocab: list[bytes], unigram: np.ndarray, text_col: str = "text", rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameters trained on every token of ``docs``.  Tasks train on their own
    rows from the same start; their parameters come back as rows and are
    averaged by tokens seen in a grouped aggregate."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).coalesce(TRAINERS)
    p = start_parameters(unigram)
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((p, unigram, vocab))     # SYMBOLS x DIM numbers

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, noise, words = sent.value
            task = TaskContext.get().partitionId()
            reader, trainer = Reader(words), Trainer(start, noise, SEED + 1000 * turn + task)  # noqa: B023
            rng = np.random.default_rng(SEED + task)
            held: list[np.ndarray] = []
            n = 0

            def learn(rows: np.ndarray) -> None:
                rows = rows[:, rng.permutation(rows.shape[1])]
                for i in range(0, rows.shape[1], BATCH):
                    trainer.step(*rows[:, i:i + BATCH])

            for b in slices(batches):
                for t in as_bytes(b.column("text")):
                    s = reader([*lower_words(t), END])
                    held.append(np.stack([*contexts(s, reader.symbol[END]), s]))
                    n += len(s)
                    if n >= 64 * BATCH:
                        learn(np.concatenate(held, 1))
                        held, n = [], 0
            if n:
                learn(np.concatenate(held, 1))
            part, row, value = [], [], []
            for k, v in trainer.p.items():
                for i, x in enumerate(v.reshape(v.shape[0], -1)):
                    part.append(k)
                    row.append(i)
                    value.append(x * trainer.seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(row, pa.int32()), pa.array([float(trainer.seen)] * len(part)), pa.array(value, pa.list_(pa.float64()))],
                names=["part", "row", "n", "value"])

        rows = src.mapInArrow(run, "part string, row int, n double, value array<double>")
        sums = [F.sum(F.get("value", F.lit(j))).alias(f"v{j}") for j in range(DIM)]
        got = rows.groupBy("part", "row").agg(F.sum("n").alias("n"), *sums).collect()       # one row per parameter row
        new = {k: v.copy() for k, v in p.items()}
        for r in got:
            if r["n"] > 0:
                new[r["part"]].reshape(PARTS[r["part"]][0], -1)[r["row"]] = [
                    r[f"v{j}"] / r["n"] for j in range(DIM if len(PARTS[r["part"]]) > 1 else 1)]
        p = new
        sent.unpersist()
    return p


def normalisers(spark, p: dict[str, np.ndarray]) -> np.ndarray:
    """Log normaliser of every pair of context symbols: tasks take the first
    symbol's row each and multiply all second symbols' predictions with all
    targets."""
    sent = spark.sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = {k: v.astype(np.float32) for k, v in sent.value.items()}
        second = q["context"] * q["scale"][1]
        for b in batches:
            for i in b.column("id").to_pylist():
                x = (second + q["context"][i] * q["scale"][0]) @ q["target"].T + q["bias"]
                top = x.max(1)
                z = top + np.log(np.exp(x - top[:, None]).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([z.astype(np.float32)], pa.list_(pa.float32()))], names=["one", "z"])

    parts = spark.sparkContext.defaultParallelism * 2
    got = spark.range(0, SYMBOLS, 1, parts).mapInArrow(run, "one long, z array<float>").collect()      # SYMBOLS x SYMBOLS numbers
    out = np.zeros((SYMBOLS, SYMBOLS), np.float32)
    for r in got:
        out[r["one"]] = r["z"]
    sent.unpersist()
    return out


def score(docs: DataFrame, held_out_of: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Tokens are the lower-cased (A-Z) words and one end.  Rows whose crc32 of
    the id as text mod ``held_out_of`` is ``held_out`` are not learnt from.
    ``base_score``: log10 of the add-one unigram; ``score``: log10 of the
    model.  A null text is empty (an end alone); a null id counts as an empty
    id text; repeated rows are scored, and counted, each.  With no training
    rows at all N is 0 and every token unseen.
    """
    spark = docs.sparkSession
    out = crc_mod(F.col(id_col), held_out_of) == held_out
    src = docs.select(F.col(id_col).alias("id"), out.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    training = src.where(~F.col("held_out"))
    counts = cut(token_counts(training))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, n_types = int(total["n"]), int(total["v"])
    # frequent tokens: down to the least count of which (in steps of a sixteenth power of two) at most KNOWN tokens have as much
    step = F.floor(F.log2("c") * 16).cast("int")
    least, held = 1 << 20, 0
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):     # at most 16 x 63 rows
        held += r["count"]
        if held > KNOWN:
            break
        least = r["s"]
    top = [(bytes(r["token"]), r["c"]) for r in counts.where(step >= least).select("token", "c").collect()]   # at most KNOWN rows
    top.sort(key=lambda x: (-x[1], x[0]))
    vocab = [END, *(t for t, _ in top if t != END)][:VOCAB]
    vocab += [b" %d" % i for i in range(VOCAB - len(vocab))]         # never read: small corpora have fewer words
    inside = set(vocab)
    frequent = dict(top)
    # mass and types of each class: all counted tokens but the vocabulary's
    by_class = {r["cls"]: (r["n"], r["v"]) for r in counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    mass, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, (n, v) in by_class.items():
        mass[k], types[k] = n, v
    for t in inside & frequent.keys():
        mass[token_class(t)] -= frequent[t]
        types[token_class(t)] -= 1
    weights = np.r_[[frequent.get(t, 0) for t in vocab], mass] + 0.5
    unigram = weights / weights.sum()
    p = train(training, vocab, unigram)
    z = normalisers(spark, p)
    base_of = np.log10(n_all + n_types + 1)
    class_of = np.log10(mass + types + 1)
    sent = spark.sparkContext.broadcast((vocab, frequent, p, z, class_of))   # at most KNOWN counts and SYMBOLS x SYMBOLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, q, log_z, log_class = sent.value
        reader = Reader(words)
        first = ((q["context"] * q["scale"][0]) @ q["target"].T + q["bias"]).astype(np.float32)      # one before, word
        second = ((q["context"] * q["scale"][1]) @ q["target"].T).astype(np.float32)                 # two before, word
        part = TaskContext.get().partitionId() << 40
        row = 0
        for b in slices(batches):
            got: list[tuple] = []
            for t in as_bytes(b.column("text")):
                tokens = [*lower_words(t), END]
                s = reader(tokens)
                one, two = contexts(s, reader.symbol[END])
                log_p = float((first[one, s] + second[two, s] - log_z[one, two]).sum(dtype=np.float64)) / np.log(10)
                own = np.fromiter(map(seen.get, tokens, repeat(0)), np.float64, len(tokens))
                base = float(np.log10(own[own > 0] + 1).sum()) - len(tokens) * base_of
                rare = s >= VOCAB
                log_p += float(np.log10(own[rare] + 1).sum()) - float(log_class[s[rare] - VOCAB].sum())
                # tokens beyond the table of frequent ones: their counts are joined
                left = Counter(tokens[i] for i in np.flatnonzero(own == 0).tolist())
                got.append((part + row, len(tokens), int((own > 0).sum()), base, log_p,
                            [token_hash(w) for w in left] or [part + row], list(left.values()) or [0]))
                row += 1
            cols = list(zip(*got))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), b.column("id"), b.column("held_out"), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64()), pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int64()))],
                names=["row", "id", "held_out", "n_tokens", "known", "base", "log_p", "h", "n"])

    kind = dict(src.dtypes)["id"]
    rows = src.mapInArrow(run, f"row long, id {kind}, held_out boolean, n_tokens long, known long, base double, log_p double, h array<long>, n array<long>")
    # one row per document and rare token; the document's own columns ride on its first
    rare = rows.select("row", F.struct("id", "held_out", "n_tokens", "known", "base", "log_p").alias("d"), F.posexplode(F.arrays_zip("h", "n")).alias("at", "x"))
    rare = rare.select("row", F.when(F.col("at") == 0, F.col("d")).alias("d"), F.col("x.h").alias("h"), F.col("x.n").alias("n"))
    cold = counts.where(step < least).select("h", "c")
    met = rare.join(cold, "h", "left").select("row", "d", "n", F.coalesce("c", F.lit(0)).alias("c"))
    more = F.sum(F.col("n") * F.log10(F.col("c") + 1))
    per = met.groupBy("row").agg(F.max("d").alias("d"), more.alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("found"))
    return per.select("d.id", "d.held_out", "d.n_tokens", (F.col("d.known") + F.col("found")).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
                      (F.col("d.base") + F.col("more")).alias("base_score"), (F.col("d.log_p") + F.col("more")).alias("score"))
