"""Benchmark decontamination by template windows.

Texts and benchmark items are turned into templates: numbers, units after
numbers, and names become typed placeholders, words are lower-cased without
punctuation.  Windows of five template tokens are hashed and joined.  Of the
documents' windows, only those that may occur in the benchmark leave their
task: a bitmap of fixed size, built by a distributed bitwise OR, lets through
every window of the benchmark (and some others, which the join drops).  Where
the windows of an item follow each other in a document, with small steps where
tokens were put in or left out, and cover enough of the item, the slots are
checked: every value of the item must stand for one value of
the document throughout.  So an item is caught verbatim and with its numbers
or names exchanged, but not where only its template agrees by chance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import as_bytes, cut, hinted, mixed, slices, spare

#: Words in a window; share of an item's words that must be covered.
WINDOW, COVER = 5, 0.8
#: Tokens by which the place of an item may move where tokens were put in or left out.
DRIFT = 5
#: Bytes of text whose tokens are worked out together.
LETTERS = 1 << 20
#: Bits of the window bitmap (8 MB), whatever the size of the benchmark.
BITMAP = 1 << 26
#: Units that are a slot after a number.
UNITS = frozenset(
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons oz lb lbs pound pounds ml cl l liter "
    "liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years cent cents dollar dollars euro euros usd eur gbp percent mph kmh hz khz mhz ghz w kw v a".split())

#: Words that are no name at the start of a sentence either.
FUNCTION_WORDS = frozenset(
    "a an the this that these those there here it its he she they we you i his her their our your my if when while where what which who whom "
    "whose why how is are was were be been do does did has have had can could will would shall should may might must and or but nor so yet "
    "for of in on at to from by with as about after before between during into through over under until since each every all some any no "
    "not one two both either neither many much more most few other another such only then than let given find suppose because although".split())

_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?%?$")
_NUMBER_UNIT = re.compile(r"([+-]?[$€£]?\d[\d.,]*)([A-Za-z]{1,3})$")
_EDGE = re.compile(r"^\W+|\W+$")
_INNER = re.compile(r"\W+")
_CLOSES = (".", "!", "?", ":", "\"", "»", "”")


SKIP, WORD, NUMBER, JOINED = range(4)


def word_kind(word: bytes) -> tuple[int, bool, bool, bool, str, str]:
    """What one word can be, whatever stands beside it: its kind, whether it may
    be a unit or a name, whether it closes a sentence, its value, and the
    unit written together with a number.  Words of one name come joined by spaces."""
    raw = word.decode("utf-8", "replace")
    plain = raw.rstrip(".,;:!?")
    if plain.isalpha():     # most words: letters and a mark
        value = plain.lower()
        return WORD, value in UNITS, len(plain) > 1 and plain[0].isupper() and plain[1].islower(), raw.endswith(_CLOSES), value, ""
    closes, bare = raw.endswith(_CLOSES), _EDGE.sub("", raw)
    value = _INNER.sub("", bare).lower()
    if not bare:
        return SKIP, False, False, closes, "", ""
    if _NUMBER.match(bare):
        return NUMBER, False, False, closes, value, ""
    joined = _NUMBER_UNIT.match(bare)
    if joined and joined[2].lower() in UNITS:
        return JOINED, False, False, closes, joined[1], joined[2].lower()
    name = len(bare) > 1 and bare[0].isupper() and bare[1].islower()
    return WORD, value in UNITS, name, closes, value, ""


class Codes(dict):
    """Word → its number, given at the first look; the new words are kept aside."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Templates:
    """Template tokens of texts.  Kinds of words seen before are remembered, and
    context (sentence starts, units after numbers) is worked out for a whole
    text at once."""

    #: Words remembered; beyond that the memory starts anew (between texts).
    MEMORY = 400_000

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.code = Codes()
        self.seen: list[tuple[int, bool, bool, bool, str, str]] = []
        self.filled = 0
        self.table = np.empty((1 << 12, 6), np.int8)
        self.hashes = np.empty(1 << 12, np.uint64)

    def fill(self) -> None:
        """Bring the arrays up to the words seen (they double when full)."""
        words, self.code.new = self.code.new, []
        new = [word_kind(w) for w in words]
        self.seen += new
        while len(self.seen) > len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        if new:
            self.table[self.filled:len(self.seen)] = [(*x[:4], x[4] in FUNCTION_WORDS, w[-1:] in b".,;:!?)]\"'") for x, w in zip(new, words)]
            self.hashes[self.filled:len(self.seen)] = [xxhash.xxh64_intdigest(x[4]) for x in new]
        self.filled = len(self.seen)

    def tokens(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per template token: its hash, the code of its word (or words, of a name),
        and its form (0 word, 1 ``<num>``, 2 ``<unit>``, 3 ``<name>``)."""
        return self.readings([text])[0][0][:3]

    def readings(self, texts: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """Tokens of many texts behind each other (hash, code, form, and the text's number), with words at sentence
        starts as plain words, and once more with those that may be names as names; and which texts have such words
        (the others read the same both ways)."""
        if len(self.code) > self.MEMORY:
            self.forget()
        words: list[bytes] = []
        lines: list[int] = []
        first: list[int] = []
        for text in texts:
            first.append(len(words))
            for line in text.split(b"\n"):
                lines.append(len(words))
                words += line.split()
        if not words:
            none = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int8), np.empty(0, np.int64))
            return [none, none], np.zeros(len(texts), bool)
        c = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        self.fill()
        kind, unit, name, closes, function, marked = self.table[c].T
        ends = np.r_[0, np.cumsum(closes)]
        breaks = np.bincount(np.array(lines), minlength=len(words) + 1)[:len(words)].cumsum()
        at = np.flatnonzero(kind != SKIP)
        doc = np.searchsorted(np.array(first), at, "right") - 1
        c, kind, unit, name, function, marked = c[at], kind[at], unit[at], name[at], function[at], marked[at]
        # a sentence starts here if a word closes one, or a line (or a text) ends, since the token before
        before = np.r_[0, at[:-1]] if len(at) else at
        fresh = np.r_[True, doc[1:] != doc[:-1]] if len(at) else np.empty(0, bool)
        start = fresh | (ends[at] > ends[before]) | (breaks[at] > breaks[before])
        after_number = np.r_[False, kind[:-1] == NUMBER] & ~fresh if len(at) else np.empty(0, bool)
        own = [words[i] for i in at.tolist()] if name.any() else []
        maybe = start & (name == 1) & (function == 0)
        two = np.bincount(doc[maybe], minlength=len(texts)) > 0
        plain = self.shaped(c, own, kind, unit, name, marked, start, fresh, after_number, doc)
        return [plain, self.shaped(c, own, kind, unit, name, marked, start & (function == 1), fresh, after_number, doc) if two.any() else plain], two

    def shaped(self, c, words, kind, unit, name, marked, start, fresh, after_number, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forms of the words; names that follow each other without a mark are one."""
        form = np.where(kind != WORD, 1, np.where((unit == 1) & after_number, 2, np.where((name == 1) & ~start, 3, 0))).astype(np.int8)
        goes_on = np.r_[False, (form[1:] == 3) & (form[:-1] == 3) & (marked[:-1] == 0) & ~start[1:] & ~fresh[1:]] if len(form) else np.empty(0, bool)
        if goes_on.any():
            head = np.flatnonzero(~goes_on)
            long = np.flatnonzero(np.diff(np.r_[head, len(form)]) > 1)
            ends = np.r_[head, len(form)]
            c = c.copy()
            for k in long.tolist():
                c[head[k]] = self.code[b" ".join(words[ends[k]:ends[k + 1]])]
            self.fill()
            c, form, kind, doc = c[head], form[head], kind[head], doc[head]
        joined = kind == JOINED
        if joined.any():
            twice = 1 + joined
            second = np.cumsum(twice)[joined] - 1
            c, form, doc = np.repeat(c, twice), np.repeat(form, twice), np.repeat(doc, twice)
            form[second] = 2
        return np.where(form == 0, self.hashes[c], FORM_HASH[form]), c, form, doc

    def strings(self, c: np.ndarray, form: np.ndarray) -> tuple[list[str], list[str]]:
        """Codes and forms → template tokens and their own values."""
        forms, values = [], []
        for k, f in zip(c.tolist(), form.tolist()):
            seen = self.seen[k]
            values.append(seen[5] if f == 2 and seen[0] == JOINED else seen[4])
            forms.append(FORMS[f] or seen[4])
        return forms, values


FORMS = ("", "<num>", "<unit>", "<name>")
FORM_HASH = np.array([xxhash.xxh64_intdigest(f) for f in FORMS], np.uint64)


def template(text: str) -> tuple[list[str], list[str]]:
    """A text's template tokens and, for each, its own value (lower case).

    ``<num>`` and ``<unit>`` are numbers and the units after them; ``<name>``
    is a word, or several in a row, with a capital first letter and a small
    one, not at the start of a sentence or line.  Words without a letter or digit are left out.
    """
    t = Templates()
    _, c, form = t.tokens(text.encode())
    return t.strings(c, form)


def window_hashes(tokens: np.ndarray, form: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` tokens; windows
    of placeholders alone say nothing and get no hash (0)."""
    n = len(tokens)
    if n < width:
        return np.empty(0, np.uint64)
    h, said = np.full(n - width + 1, width, np.uint64), np.zeros(n - width + 1, bool)
    for k in range(width):
        h = mixed(h ^ tokens[k:n - width + 1 + k], k)
        said |= form[k:n - width + 1 + k] == 0
    return np.where(said, h | np.uint64(1), np.uint64(0))


def windows_of(tokens: np.ndarray, form: np.ndarray, doc: np.ndarray, size: np.ndarray, window: int, short: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(width, first tokens, hashes)`` of the windows of many texts behind each other (``doc``: a token's text, ``size``: a
    text's tokens): all of ``window`` tokens and of the ``short`` widths, and a shorter text as a whole."""
    every = set(np.unique(size[(size > 0) & (size < window)]).tolist())
    for width in sorted({window, *short, *every}):
        pick = slice(None)
        if width not in short and width < window:      # only texts of just this length
            pick = np.flatnonzero(size[doc] == width)
        t, f, d = tokens[pick], form[pick], doc[pick]
        h = window_hashes(t, f, width)
        inside = d[:len(h)] == d[width - 1:]
        at = np.flatnonzero(inside & (h != 0))
        yield width, at if isinstance(pick, slice) else pick[at], h[at]


def slots_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the bitmap that stand for a hash."""
    return h % np.uint64(BITMAP), (h >> np.uint64(32)) % np.uint64(BITMAP)


WINDOWS = "id {kind}, reading int, n_tokens int, pos int, h long, template string, vals array<string>"


def template_windows(texts: DataFrame, window: int, bitmap: np.ndarray | None = None, short: tuple[int, ...] = ()) -> DataFrame:
    """``texts(id, text)`` → a row per window (of those in ``bitmap`` alone, if given),
    and per window of the ``short`` widths; for both readings of the text, also if they are the same."""
    kind = dict(texts.dtypes)["id"]
    sent = None if bitmap is None else texts.sparkSession.sparkContext.broadcast(bitmap)   # BITMAP bits

    def some(maker: Templates, bits: np.ndarray | None, ids: pa.Array, part: list[bytes]) -> pa.RecordBatch:
        row, kinds, size, pos, hashes, forms, vals = [], [], [], [], [], [], []
        both, two = maker.readings(part)
        for reading, (tokens, c, form, doc) in enumerate(both):
            held = np.bincount(doc, minlength=len(part))
            first = np.cumsum(held) - held
            # texts that read the same both ways are hashed once, and reported under both
            mine = np.arange(len(tokens)) if reading == 0 else np.flatnonzero(two[doc])
            for width, at, h in windows_of(tokens[mine], form[mine], doc[mine], held, window, short):
                if bits is not None:
                    hit = np.ones(len(h), bool)
                    for slot in slots_of(h):
                        hit &= (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    at, h = at[hit], h[hit]
                for p, x in zip(mine[at].tolist(), h.view(np.int64).tolist()):
                    f, v = maker.strings(c[p:p + width], form[p:p + width])
                    d = int(doc[p])
                    for r in (0, 1) if reading == 0 and not two[d] else (reading,):
                        row.append(d)
                        kinds.append(r)
                        size.append(int(held[d]))
                        pos.append(p - int(first[d]))
                        hashes.append(x)
                        forms.append(" ".join(f))
                        vals.append(v)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row, pa.int64())), pa.array(kinds, pa.int32()), pa.array(size, pa.int32()), pa.array(pos, pa.int32()),
             pa.array(hashes, pa.int64()), pa.array(forms, pa.string()), pa.array(vals, pa.list_(pa.string()))],
            names=["id", "reading", "n_tokens", "pos", "h", "template", "vals"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if sent is None else sent.value
        maker = Templates()
        for b in slices(batches):
            texts_of = as_bytes(b.column("text"))
            ends = np.cumsum([len(t) for t in texts_of])
            at = 0
            while at < len(texts_of):     # about LETTERS bytes of text at a time, one text at least
                end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LETTERS, "right")))
                yield some(maker, bits, b.column("id").slice(at, end - at), texts_of[at:end])
                at = end

    return texts.select("id", "text").mapInArrow(run, WINDOWS.format(kind=kind))


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """``hashes(h)`` → the bitmap, as bytes: ORed per 64-bit word by the
    executors, so the driver gets at most ``BITMAP`` / 64 words."""
    # BITMAP is a power of two: the low bits, and the low bits of the upper half
    slot = F.explode(F.array(F.col("h").bitwiseAND(BITMAP - 1), F.call_function("shiftrightunsigned", "h", F.lit(32)).bitwiseAND(BITMAP - 1)))
    words = hashes.select(slot.alias("slot")).select(F.floor(F.col("slot") / 64).cast("int").alias("word"), (F.col("slot") % 64).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    out = np.zeros(BITMAP // 64, np.int64)
    got = words.toPandas()
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def best_chain(windows: list[tuple[int, int, list[dict], bool]], n: int, window: int, cover: float) -> tuple[float, bool, int, int] | None:
    """Windows ``(shift, pos, slots, same values)`` that an item of ``n`` tokens and a
    document share → ``(covered, exact, -shift, n_slots)`` of the best place, or none.

    Windows of one shift whose places follow each other are a run.  Runs are
    chained in the order of both texts, from one shift to another by at most
    ``DRIFT`` tokens; a chain never passes over a run of its shift, so a value
    that stands for two is not left out."""
    runs: list[list] = []   # shift, from, to (item tokens), slots, exact
    for shift, pos, slots, same in sorted(windows, key=lambda w: w[:2]):
        end, own = min(pos + window, n), {(s["kind"], s["of"], s["is"]) for s in slots}
        if runs and runs[-1][0] == shift and pos <= runs[-1][5] + 1:
            runs[-1][2], runs[-1][4], runs[-1][5] = end, runs[-1][4] and same, pos
            runs[-1][3] |= own
        else:
            runs.append([shift, pos, end, own, same, pos])
    follow = {i: i + 1 for i in range(len(runs) - 1) if runs[i][0] == runs[i + 1][0]}
    behind = {j: i for i, j in follow.items()}
    fits = lambda slots: len(slots) == len({x[:2] for x in slots})
    chains: dict[int, tuple] = {}   # last run → covered tokens, exact, -shift of the first, slots
    order = sorted(range(len(runs)), key=lambda j: (runs[j][1] + runs[j][0], runs[j][1]))
    for k, j in enumerate(order):
        shift, a, e, slots, same, _ = runs[j]
        options = [(e - a, same, -shift, slots)] if j not in behind and fits(slots) else []
        for i in reversed(order[:k]):
            s, c, d, _, _, _ = runs[i]
            if a + shift - (d + s) > n:
                continue
            if i not in chains or not (c < a and d < e and d + s < e + shift) or (s != shift and abs(s - shift) > DRIFT):
                continue
            if s == shift and follow.get(i) != j or s != shift and (i in follow and runs[follow[i]][2] <= a or j in behind and runs[behind[j]][1] >= d):
                continue
            covered, exact, back, held = chains[i]
            if fits(held | slots):
                options.append((covered + e - max(a, d), exact and same, back, held | slots))
        if options:
            chains[j] = max(options, key=lambda x: (*x[:3], len(x[3])))
    ends = [(x[0] / n, x[1], x[2], len(x[3])) for j, x in chains.items() if j not in follow and x[0] / n >= cover]
    return max(ends, default=None)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, text_hash, item_id, pos, covered, exact, n_slots)``: the best place
    of each item in each document that holds it; ``pos`` counts template
    tokens, ``covered`` is the share of the item's tokens inside matching
    windows, ``exact`` is false where slot values differ, ``n_slots`` is the
    number of slots checked.

    Items with the same template and values are looked for once and
    reported under the smallest of their ids.  Items without a usable window
    (no word, or placeholders alone) match nothing.  Null and empty texts
    hold nothing; rows with a null id are told apart by ``text_hash``;
    repeated rows are reported once.
    """
    items = benchmark.select(F.col(item_col).alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    items = items.groupBy("text").agg(F.min("id").alias("id"))
    want = cut(template_windows(items, window))
    bits = bitmap_of(want.select("h"))
    short = tuple(sorted(r["n_tokens"] for r in want.where(F.col("n_tokens") < window).select("n_tokens").distinct().collect()))   # under ``window`` of them
    text = F.coalesce(F.col(text_col), F.lit(""))
    # one id per row of documents: the id and the text's hash, so that ids may be null or repeat
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash")).alias("key"), text.alias("text"))
    packed = rows.select(F.to_json("key", {"ignoreNullFields": "false"}).alias("id"), "text")
    mine = template_windows(packed, window, bits, short).select(F.col("id").alias("doc"), "reading", F.col("pos").alias("at"), "h", F.col("template").alias("form"),
                                                         F.col("vals").alias("got"))
    both = mine.join(hinted(want), ["h", "reading"]).where(F.col("form") == F.col("template"))
    both = both.select("doc", F.col("id").alias("item"), "reading", "n_tokens", "pos", (F.col("at") - F.col("pos")).alias("shift"),
                       F.split("form", " ").alias("form"), "vals", "got")
    slots = F.filter(F.arrays_zip("form", "vals", "got"), lambda s: s["form"].startswith("<"))
    slots = F.transform(slots, lambda s: F.struct(s["form"].alias("kind"), s["vals"].alias("of"), s["got"].alias("is")))
    # per document, item and reading: the windows that both have
    per = both.groupBy("doc", "item", "reading").agg(
        F.max("n_tokens").alias("n_tokens"), F.collect_set("pos").alias("places"),
        F.collect_list(F.struct("shift", "pos", slots.alias("slots"), (F.col("vals") == F.col("got")).alias("same"))).alias("windows"))
    tokens = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, F.least(p + window, F.col("n_tokens")) - 1))))
    per = per.where(F.size(tokens) >= cover * F.col("n_tokens")).select("doc", "item", "n_tokens", "windows")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [best_chain([(w["shift"], w["pos"], w["slots"], w["same"]) for w in windows], n, window, cover)
                   for windows, n in zip(b.column("windows").to_pylist(), b.column("n_tokens").to_pylist())]
            hit = pa.array([x is not None for x in got], pa.bool_())
            columns = list(zip(*(x for x in got if x is not None))) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("doc").filter(hit), b.column("item").filter(hit),
                 *(pa.array(x, k) for x, k in zip(columns, (pa.float64(), pa.bool_(), pa.int32(), pa.int32())))],
                names=["doc", "item", "covered", "exact", "back", "n_slots"])

    best = per.mapInArrow(chained, f"doc string, item {dict(items.dtypes)['id']}, covered double, exact boolean, back int, n_slots int")
    best = best.groupBy("doc", "item").agg(F.max(F.struct("covered", "exact", "back", "n_slots")).alias("b"))
    kind = dict(docs.dtypes)[id_col] if id_col in docs.columns else "long"
    out = best.select(F.from_json("doc", f"id {kind}, text_hash long").alias("k"), "item", "b")
    return out.select("k.id", "k.text_hash", F.col("item").alias("item_id"), (-F.col("b.back")).alias("pos"), "b.covered", "b.exact", "b.n_slots")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, as they are."""
    found = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **how).select("id", "text_hash").distinct()
    key, own = spare(docs, "row_key"), spare(docs, "found_id")
    found = cut(found.select(F.xxhash64("id", "text_hash").alias(key), F.col("id").alias(own)))
    text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.withColumn(key, F.xxhash64(F.col(id_col), text))
    same = (rows[key] == found[key]) & rows[id_col].eqNullSafe(found[own])
    return rows.join(hinted(found), same, "left_anti").select(*docs.columns)
