"""Near-duplicate passages by compact windows.

Tokens are shingles of five words (A-Z lower-cased).  Under one hash function
every range of a text has a smallest token, its signature; all ranges with
the same smallest token form one compact window: the stretch in which that
token is the smallest.  Windows are the nodes of the text's Cartesian tree; of
each, the ranges of a passage's length are found as a run of starts with one
sliding minimum, for many texts at a time.  Two near-duplicate passages
of similarity s share a signature under each function with a chance of s.

Windows whose signature only one text has are dropped before anything else
is made of them.  The others are joined, within their text, with the windows
of the next function that they overlap by a passage's length (an interval
join, by buckets of that length): such a range has both signatures, and the
two together are its key.  With three functions a pair of ranges that shares
any two signatures shares a key.  Holders of a key are linked to the first of
them, never all with all, and the first one's further places to the last
holder.  Linked places are then verified on the texts:
around the shared token, the longest ranges whose shingles agree to
``similarity`` are reported if they are long enough.

A first holder may fail (it has a shorter run, or a line that many texts
have), which says nothing of the others; or its passage may leave out some of the
ranges that have the key, which others may share.  A link settles a key's places
only if passages of its two documents cover these ranges on either side.  All
holders of any other key are dealt anew once, by the ranges of a passage's length
around their token (if a passage was found, by those that have the key): by each
range's whole content, so that holders of one exact passage always meet under
a key whose members all verify, and by pairs of signatures, under other hash
functions, of some ranges for edited passages.  All these holders are linked,
also those that have a passage with somebody else: each place of an exact run of
a passage's length that documents share is thus in a passage of its document, and all
holders of the run are connected by links that cover it.  There are
no further rounds; edited passages are found by chance.

Equal texts are searched once: a unit is a text, named by its 64-bit hash (two
of n texts collide with a chance of n^2 / 2^65), and every further holder of a
text is a copy of the one with the smallest id.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import ASCII_LOWER, ASCII_UPPER, SPACES, cut, hinted, mixed, slices

#: Words in a shingle, words in a passage at least, similarity, hash functions.
SHINGLE, LEAST, SIMILARITY, FUNCTIONS = 5, 50, 0.8, 3
#: Holders dealt anew: places from one range with signatures to the next, pairs of signatures of each.
APART, PAIRS = 9, 8
#: The odd number whose powers hash sequences; whether a byte belongs to a word, and a byte's hash (A-Z as a-z).
ODD = np.uint64(0x9E3779B97F4A7C15)
WORD_BYTE = ~np.isin(np.arange(256), list(SPACES.encode()))
BYTE_HASH = mixed(np.array(list(bytes(range(256)).translate(bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode()))), np.uint64), 998)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` (1 at least) powers of an odd number modulo 2^64, and of its inverse."""
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x)]) for x in (ODD, np.uint64(pow(int(ODD), -1, 2 ** 64))))


def shingled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens, offsets)``: a 64-bit hash per word of all texts, one after the other, of the
    shingle that begins there, and where each text's words begin and the last one's end.
    A text's last four have no shingle of its own.  A word's hash is a remix of the sum of its remixed bytes
    (A-Z lower-cased) times powers of an odd number, and a shingle's the same of its words' hashes."""
    texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    cuts = np.frombuffer(places, np.int64 if large else np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[cuts[0]:cuts[-1]] if cuts[-1] > cuts[0] else np.zeros(0, np.uint8)
    cuts = cuts - cuts[0]
    inside = WORD_BYTE[data]
    before, behind = np.r_[False, inside], np.r_[inside, False]
    before[cuts[:-1]], behind[cuts[1:]] = False, False
    first, end = np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~behind[1:]) + 1
    power, undo = powers(max(1, len(data)))
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(BYTE_HASH[data] * power[:len(data)])]
        words = mixed((sums[end] - sums[first]) * undo[first], 999)
        tokens = words.copy()
        for k in range(1, SHINGLE):
            tokens *= ODD
            tokens[:max(0, len(words) - k)] += words[k:]
    return mixed(tokens, 1000), np.searchsorted(first, cuts)


def smallest(rank: np.ndarray, least: int) -> np.ndarray:
    """Place of a smallest token of each range of ``least`` (at most 4,096) tokens.
    Minima of doubled lengths; a rank's last 12 bits make room for its place modulo 4,096."""
    low = np.uint64(4095)
    m, width = rank & ~low | np.arange(len(rank), dtype=np.uint64) & low, 1
    while 2 * width <= least:
        m, width = np.minimum(m[:-width], m[width:]), 2 * width
    if width < least:
        m = np.minimum(m[:width - least], m[least - width:])
    start = np.arange(len(m))
    return start + ((m & low).astype(np.int64) - start & 4095)


def compact_windows(rank: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(left, smallest, right) of each compact window of at least ``least`` tokens,
    ends included; the first of equal tokens counts as the smallest."""
    out, stack = [], [(0, len(rank))] if len(rank) >= least else []
    while stack:
        lo, hi = stack.pop()
        c = lo + int(rank[lo:hi].argmin())
        out.append((lo, c, hi - 1))
        if c - lo >= least:
            stack.append((lo, c))
        if hi - c > least:
            stack.append((c + 1, hi))
    return out


def signatures(docs: DataFrame, least: int, functions: int) -> DataFrame:
    """``docs(doc, text)`` → ``(sig, doc, place)``: a row per compact window, its
    ``place`` as ``unpacked`` reads it.  A text with windows also has a row with
    place -1 and its number of words in place of a signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            tokens, offsets = shingled(b.column("text"))
            n = np.diff(offsets)
            row = np.flatnonzero(n >= least + SHINGLE - 1)
            if not len(row):
                continue
            parts = [(n[row].astype(np.uint64), row, np.full(len(row), -1))]
            # starts of ranges that end in their text
            text = np.repeat(row, n[row] - (least + SHINGLE - 2))
            begun = np.cumsum(n[row] - (least + SHINGLE - 2))
            start = np.arange(len(text)) + np.repeat(offsets[row] - np.r_[0, begun[:-1]], np.diff(np.r_[0, begun]))
            for f in range(functions):
                rank = mixed(tokens, f)
                at = smallest(rank, least)[start]
                new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                first, last, at, of = start[new], start[np.r_[new[1:] - 1, len(at) - 1]], at[new], text[new]
                parts.append((mixed(rank[at], 2000 + f), of, at - offsets[of] << 32 | f << 24 | (at - first) << 12 | (last - first)))
            sig, row, place = (np.concatenate(c) for c in zip(*parts))
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), b.column("doc").take(pa.array(row)), pa.array(place)], names=["sig", "doc", "place"])

    return docs.select("doc", "text").mapInArrow(run, "sig long, doc long, place long")


def unpacked(found: DataFrame) -> DataFrame:
    """``(sig, doc, place)`` → ``(sig, doc, f, at, first, last)``: the window's
    function, the place of its smallest token, and the first and last starts of
    its ranges around it.  A place has 32 bits for the token, 8 for the function
    and 12 each for how far the first start lies before it and the last behind that."""
    f, at, back, wide = (F.shiftright("place", n).bitwiseAND(F.lit(2 ** bits - 1)).cast("int") for n, bits in ((24, 8), (32, 31), (12, 12), (0, 12)))
    return found.select("sig", "doc", f.alias("f"), at.alias("at"), (at - back).alias("first"), (at - back + wide).alias("last"))


def joint_keys(found: DataFrame, least: int, functions: int) -> DataFrame:
    """``(key, doc, at, reach)``: the windows of each function joined with those of the
    next one in the same text that have a range of ``least`` tokens in common; the first
    and last starts of these ranges around the first window's token as ``reached`` reads them.

    Starts of ranges are dealt to buckets of ``least`` places; as a window's
    starts span at most that many, it lies in one bucket or two, and a pair is
    made in the bucket of its first common start."""
    spans = unpacked(found).withColumn("bucket", F.explode(F.sequence(F.floor(F.col("first") / least), F.floor(F.col("last") / least))))
    one = spans.withColumn("f", (F.col("f") + 1) % functions)
    two = spans.select("doc", "f", "bucket", F.col("sig").alias("sig2"), F.col("first").alias("first2"), F.col("last").alias("last2"))
    common = F.greatest("first", "first2")
    met = one.join(two, ["doc", "f", "bucket"]).where((common <= F.least("last", "last2")) & (F.floor(common / least) == F.col("bucket")))
    reach = (F.col("at") - common) * 4096 + F.least("last", "last2") - common
    return met.select(F.xxhash64("sig", "sig2").alias("key"), "doc", "at", reach.cast("int").alias("reach"))


def reached(at, reach):
    """``(first, last)`` starts of a key's ranges around the token ``at``: 12 bits
    each for how far the first lies before it and the last behind that."""
    first = at - F.shiftright(reach, 12) if isinstance(reach, Column) else at - (reach >> 12)
    return first, first + (reach.bitwiseAND(4095) if isinstance(reach, Column) else reach & 4095)


def grow(a: np.ndarray, i: int, b: np.ndarray, j: int, similarity: float) -> tuple[int, int, int, int]:
    """The ranges around the shared token a[i] = b[j] whose tokens agree:
    ``(a from, a to, b from, b to)``, ends not included.

    From the token outwards, equal runs are taken whole; after a difference
    both sides skip to their next common token (the nearest within a shingle's
    length of changed words), as long as the share of skipped tokens stays
    within what ``similarity`` allows."""
    def side(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
        p = q = same = lost = best_p = best_q = 0
        while p < len(x) and q < len(y):
            n = min(len(x) - p, len(y) - q)
            differ = np.flatnonzero(x[p:p + n] != y[q:q + n])
            run = int(differ[0]) if len(differ) else n
            p, q, same = p + run, q + run, same + run
            if run and same >= similarity * (same + lost):
                best_p, best_q = p, q
            reach = 3 * SHINGLE
            ahead = {int(v): k for k, v in reversed(list(enumerate(y[q:q + reach].tolist())))}
            step = next(((k, ahead[v]) for k, v in enumerate(x[p:p + reach].tolist()) if v in ahead), None)
            if step is None:
                break
            p, q, lost = p + step[0], q + step[1], lost + step[0] + step[1]
            if same + lost > 4 * reach and same < similarity * (same + lost):
                break
        return best_p, best_q

    left = side(a[:i][::-1], b[:j][::-1])
    right = side(a[i:], b[j:])
    return i - left[0], i + right[0], j - left[1], j + right[1]


def covered(lo: int, hi: int, spans: list[tuple[int, int]], least: int) -> bool:
    """Whether each range of ``least`` tokens that starts from ``lo`` to ``hi`` lies in one of the ``spans`` (in order)."""
    for s, e in spans:
        if s > lo or lo > hi:
            break
        lo = max(lo, e - least + 1)
    return lo > hi


def agreement(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two ranges' shingles."""
    x, y = np.unique(a), np.unique(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST,
                      similarity: float = SIMILARITY, functions: int = FUNCTIONS) -> DataFrame:
    """``(id, start, stop, other_id, other_start, other_stop, similarity)``: passages
    of at least ``least_words`` words in one document that another document
    has nearly the same (words ``start`` to ``stop``, end not included).
    Each passage is linked to the first holder of its key that has it (in the
    order of the units), so copies of one passage are links to one document,
    not to each other; a pair of documents has one row per passage that was
    found, with the smaller id as ``other_id``.  Each place of a run of ``least_words``
    words that two documents share is in a passage, also where one of them has the run
    several times; not each of one document's places is linked to each of the other's.

    Repeats inside one document are not reported.  Null, short and blank
    texts have no passage.  A text that several ids hold is one passage from
    end to end of each further id, linked to the smallest one; all other links
    of the text are given for that one.  Rows that repeat an id count with all
    their texts, and links of an id with itself are left out.  Rows without an
    id are left out, as nothing could name them.  Ids may be of any type that
    has an order.  An empty table gives no rows.
    """
    least = least_words - SHINGLE + 1
    if not 0 < least <= 4096 or not 1 < functions < 256:
        raise ValueError("passages have 5 to 4,100 words and 2 to 255 functions")
    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.select("id", F.xxhash64("text").alias("doc"), "text")
    held = cut(src.select("id", "doc"))
    units = cut(held.groupBy("doc").agg(F.min("id").alias("rep")))
    found = cut(signatures(src, least, functions))
    sizes, found = found.where("place < 0").select("doc", F.col("sig").cast("int").alias("n")).distinct(), found.where("place >= 0")
    # written out, so that the join deals both sides anew and can split a frequent signature
    shared = cut(found.groupBy("sig").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("sig"))
    # written before the rows of equal texts become one, so that a frequent signature can be split
    found = cut(found.join(shared, "sig"))
    found = cut(joint_keys(found.distinct(), least, functions))
    first, linked = stars(found, least)
    # texts of units with candidates, as shingle hashes; both sides of a candidate meet by unit
    wanted = linked.select("doc").union(linked.select("other")).distinct().join(units, "doc").select("doc", F.col("rep").alias("id"))
    hashes = cut(texts_of(src, wanted))

    def grown_passage(x: np.ndarray, at: int, y: np.ndarray, other_at: int) -> tuple[int, int, int, int, float] | None:
        """The passage around a shared token as ``grow`` gives it, and its similarity."""
        if at >= len(x) or other_at >= len(y) or x[at] != y[other_at]:
            return None
        # the widest ranges first; where they differ too much, narrower ones
        for strict in (similarity, (1 + similarity) / 2, 1.0):
            s, e, t, u = grow(x, at, y, other_at, strict)
            if min(e - s, u - t) + SHINGLE - 1 < least_words:  # the narrowest are equal
                return None
            alike = agreement(x[s:e], y[t:u])
            if alike >= similarity:
                return s, e, t, u, alike
        return None

    def verify(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            columns = (b.column(c).to_pylist() for c in ("doc", "other", "known"))
            ends = (b.column("places").offsets.to_numpy() - b.column("places").offsets[0].as_py()).tolist()
            fields = [c.to_pylist() for c in b.column("places").flatten().flatten()]
            for doc, other, known, mine, theirs, i, j in zip(*columns, b.column("mine"), b.column("theirs"), ends, ends[1:]):
                x, y = (np.asarray(v.values) for v in (mine, theirs))
                # passages of the two, as tokens; the same of either alone, in order
                done = [(k["start"], k["stop"] - SHINGLE + 1, k["other_start"], k["other_stop"] - SHINGLE + 1) for k in known or ()]
                ours, others = sorted(p[:2] for p in done), sorted(p[2:] for p in done)
                grown, loose = {}, {}
                for at, reach, other_at, other_reach, *first in zip(*(c[i:j] for c in fields)):
                    spans, other_spans = reached(at, reach), reached(other_at, other_reach)
                    if covered(*spans, ours, least) and covered(*other_spans, others, least):
                        continue
                    if (at, other_at) not in grown:
                        # a token of a passage's first or last equal run leads to the same one; any other inside of one
                        # is left to the last deal, if its ranges are not in the passages found
                        inside = [p for p in done if p[0] <= at < p[1] and p[2] <= other_at < p[3]]
                        again = any(at - other_at == s - t and (e - u == s - t or (x[s:at] == y[t:other_at]).all())
                                    or at - other_at == e - u and (x[at:e] == y[other_at:u]).all() for s, e, t, u in inside)
                        passage = None if again or inside and not last else grown_passage(x, at, y, other_at)
                        grown[at, other_at] = again or passage is not None
                        if passage:
                            s, e, t, u, alike = passage
                            # it has a range that no passage before has (of equal runs: around the token, as other ranges have theirs)
                            near, on = (least - 1, 0) if alike == 1 else (len(x) + len(y),) * 2
                            if not (covered(max(s, at - near), min(e - least, at + on), ours, least)
                                    and covered(max(t, other_at - near), min(u - least, other_at + on), others, least)):
                                out.append((doc, s, e + SHINGLE - 1, other, t, u + SHINGLE - 1, alike, None, None))
                                done.append((s, e, t, u))
                                insort(ours, (s, e))
                                insort(others, (t, u))
                    if not (covered(*spans, ours, least) and covered(*other_spans, others, least)):
                        # a token that comes twice in the ranges may have met the wrong one of the other's
                        loose[*first] = loose.get((*first,), True) and grown[at, other_at] and (x[spans[0]:spans[1] + least] == x[at]).sum() == 1
                out += [(doc, None, None, other, None, None, 1.0 if some else None, *first) for first, some in loose.items()]
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["id", "start", "stop", "other_id", "other_start", "other_stop", "similarity", "first_at", "first_reach"])

    def verified(linked: DataFrame, last: bool) -> DataFrame:
        """Passages; and, with null in ``stop``, first holders of keys with a range outside of the link's
        passage, ``(other_id, first_at, first_reach)``, with null in ``similarity`` if there is none at all."""
        met = (linked.join(hashes.select("doc", F.col("h").alias("mine")), "doc")
               .join(hashes.select(F.col("doc").alias("other"), F.col("h").alias("theirs")), "other"))
        return met.select("doc", "other", "places", "known", "mine", "theirs").mapInArrow(
            lambda batches: verify(batches, last), "id long, start int, stop int, other_id long, other_start int, other_stop int, similarity double, first_at int, first_reach int")

    seen = cut(verified(linked, False))
    good = seen.where("stop is not null").drop("first_at", "first_reach")
    # all holders of a key whose first holder failed one of them, or has a passage with it that leaves out some of
    # the key's ranges, which further holders may share; of the latter, these ranges alone
    loose = seen.where("stop is null").groupBy(F.col("other_id").alias("other"), F.col("first_at").alias("other_at"), F.col("first_reach").alias("other_reach"))
    loose = loose.agg(F.max(F.col("similarity").isNull()).alias("failed"))
    pool = found.join(first.join(loose, ["other", "other_at", "other_reach"]).where("failed or more").select("key", "failed"), "key")
    lo, hi = reached(F.col("at"), F.col("reach"))
    spans = F.struct(F.when(F.col("failed"), F.col("at") - least + 1).otherwise(lo).alias("lo"), F.when(F.col("failed"), F.col("at")).otherwise(hi).alias("hi"))
    pool = pool.groupBy("doc").agg(F.collect_set(spans).alias("spans"))
    _, linked = stars(cut(dealt_anew(pool, hashes, least)), least, good)
    good = good.unionByName(verified(linked, True).where("stop is not null").drop("first_at", "first_reach"))
    one, two = units.select(F.col("doc").alias("id"), F.col("rep").alias("a")), units.select(F.col("doc").alias("other_id"), F.col("rep").alias("b"))
    good = good.join(one, "id").join(two, "other_id").where("a <> b")
    # units are in no order that a user knows: the smaller id is always the other one
    mine, theirs = F.struct(F.col("a").alias("id"), "start", "stop"), F.struct(F.col("b").alias("id"), F.col("other_start").alias("start"), F.col("other_stop").alias("stop"))
    good = good.select(F.when(F.col("a") > F.col("b"), mine).otherwise(theirs).alias("p"), F.when(F.col("a") > F.col("b"), theirs).otherwise(mine).alias("q"), "similarity")
    good = good.select("p.id", "p.start", "p.stop", F.col("q.id").alias("other_id"), F.col("q.start").alias("other_start"), F.col("q.stop").alias("other_stop"), "similarity").distinct()
    copies = held.join(units, "doc").where("id <> rep").join(sizes, "doc").select(
        "id", F.lit(0).alias("start"), F.col("n").alias("stop"), F.col("rep").alias("other_id"),
        F.lit(0).alias("other_start"), F.col("n").alias("other_stop"), F.lit(1.0).alias("similarity")).distinct()
    return good.unionByName(copies)


def both_sides(links: DataFrame) -> DataFrame:
    """Rows of ``repeated_passages`` from either document's side: each document that holds
    a repeated passage has rows under its own ``id``."""
    mine, theirs = ["id", "start", "stop"], ["other_id", "other_start", "other_stop"]
    row = lambda one, two: F.struct(*(F.col(x).alias(name) for name, x in zip(mine + theirs, one + two)), "similarity")
    return links.select(F.inline(F.array(row(mine, theirs), row(theirs, mine))))


def stars(found: DataFrame, least: int, good: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``found(key, doc, at, reach)`` → the first holder of each key that two documents
    share, ``(key, other, other_at, other_reach, more)``, and all other places of the key linked,
    ``(doc, other, places, known)``: those of other documents to the first holder's first place, further ones
    of the first holder to the last holder's.  ``more``: the key has more than two places.
    ``known``: the passages of the two in ``good``; places whose ranges lie, on either side, in one of them are left out."""
    # of either holder its first place, from which a run of equal words goes on the longest
    first = found.groupBy("key").agg(F.min(F.struct("doc", "at", "reach")).alias("first"), F.max(F.struct("doc", (-F.col("at")).alias("at"), "reach")).alias("last"),
                                     (F.count("*") > 2).alias("more"))
    first = cut(first.where("first.doc < last.doc").selectExpr(
        "key", "first.doc AS other", "first.at AS other_at", "first.reach AS other_reach", "last.doc AS last", "-last.at AS last_at", "last.reach AS last_reach", "more"))
    linked = found.join(first, "key").where("doc <> other or at <> other_at or reach <> other_reach")
    own = F.col("doc") == F.col("other")
    sides = [F.when(own, F.col(a)).otherwise(F.col(b)).alias(name) for name, a, b in (
        ("at", "last_at", "at"), ("reach", "last_reach", "reach"), ("other_at", "at", "other_at"), ("other_reach", "reach", "other_reach"))]
    pair = F.struct(*sides, F.col("other_at").alias("first_at"), F.col("other_reach").alias("first_reach"))
    # the shared tokens of a pair of documents: at most as many as the text has windows
    linked = linked.groupBy(F.when(own, F.col("last")).otherwise(F.col("doc")).alias("doc"), "other").agg(F.array_sort(F.collect_set(pair)).alias("places"))
    span = "array<struct<start:int,stop:int,other_start:int,other_stop:int>>"
    if good is None:
        return first, cut(linked.withColumn("known", F.lit(None).cast(span)))
    known = good.groupBy(F.col("id").alias("doc"), F.col("other_id").alias("other")).agg(F.collect_set(F.struct("start", "stop", "other_start", "other_stop")).cast(span).alias("known"))

    def inside(p: Column, of: str) -> Column:
        lo, hi = reached(p[f"{of}at"], p[f"{of}reach"])
        return F.exists("known", lambda g: (lo >= g[f"{of}start"]) & (hi + (least + SHINGLE - 1) <= g[f"{of}stop"]))

    new = F.filter("places", lambda p: ~(inside(p, "") & inside(p, "other_")))
    linked = linked.join(known, ["doc", "other"], "left").withColumn("places", F.when(F.col("known").isNull(), F.col("places")).otherwise(new))
    linked = linked.where(F.size("places") > 0)
    return first, cut(linked)


def within(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` places lies in one of the spans from ``lo`` to ``hi`` (empty ones count for nothing)."""
    lo, hi = lo[lo <= hi], hi[lo <= hi]
    return np.cumsum(np.bincount(lo, minlength=n + 1) - np.bincount(hi + 1, minlength=n + 1))[:n] > 0


def range_keys(h: np.ndarray, s: np.ndarray, grid: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(key, place, first, last)`` of the ranges of ``least`` tokens from ``s`` on: of
    each by its whole content (a sum of remixed tokens times powers of an odd
    number, by prefix sums modulo 2^64), and of those on the ``grid`` by ``PAIRS`` pairs
    of signatures, a row for the ranges from ``first`` to ``last``, one after the other, that have a pair."""
    with np.errstate(over="ignore"):
        power, undo = powers(max(1, len(h)))
        sums = np.r_[np.uint64(0), np.cumsum(mixed(h, 3000) * power[:len(h)])]
        keys, places = [mixed((sums[s + least] - sums[s]) * undo[s], 3001)], [s]
    firsts, lasts, s = [s], [s], s[grid]
    for j in range(PAIRS if len(s) else 0):
        one, two = (mixed(h, 4000 + 2 * j + k) for k in (0, 1))
        at, other = smallest(one, least)[s], smallest(two, least)[s]
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (other[1:] != other[:-1])])
        at, other = at[new], other[new]
        keys.append(mixed(mixed(one[at], 4000 + j) ^ two[other], 5000 + j))
        places.append(at)
        firsts.append(s[new])
        lasts.append(s[np.r_[new[1:] - 1, len(s) - 1]])
    return tuple(np.concatenate(c) for c in (keys, places, firsts, lasts))


def dealt_anew(pool: DataFrame, hashes: DataFrame, least: int) -> DataFrame:
    """``pool(doc, spans)`` → ``(key, doc, at, reach)`` by ``range_keys`` of the ranges that
    start in a span; the grid is every ``APART``-th place of a text and the last, so that places near
    each other have theirs in common.  Texts are taken together, as many as have about a million tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            size = np.diff(b.column("h").offsets.to_numpy())
            parts = np.flatnonzero(np.diff(np.cumsum(size) >> 20, prepend=0))
            for i, j in zip([0, *parts], [*parts, b.num_rows]):
                if i < j:
                    yield dealt(b.slice(i, j - i))

    def dealt(b: pa.RecordBatch) -> pa.RecordBatch:
        h = b.column("h").flatten().to_numpy().view(np.uint32).astype(np.uint64)
        size, number = (np.diff(b.column(c).offsets.to_numpy()) for c in ("h", "spans"))
        begin = np.cumsum(size) - size
        final = begin + size - least
        of = np.repeat(np.arange(b.num_rows), number)
        lo, hi = (c.to_numpy().astype(np.int64) + begin[of] for c in b.column("spans").flatten().flatten())
        start = np.flatnonzero(within(np.maximum(lo, begin[of]), np.minimum(hi, final[of]), len(h)))
        doc = np.searchsorted(begin + size, start, "right")
        # the tokens of these ranges alone
        used = np.flatnonzero(within(start, start + least - 1, len(h)))
        grid = ((start - begin[doc]) % APART == 0) | (start == final[doc])
        key, at, first, last = range_keys(h[used], np.searchsorted(used, start), grid, least)
        at, first, last = used[at], used[first], used[last]
        doc = np.searchsorted(begin + size, at, "right")
        columns = [key.view(np.int64), np.asarray(b.column("doc"))[doc], (at - begin[doc]).astype(np.int32), ((at - first) * 4096 + last - first).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "doc", "at", "reach"])

    return pool.join(hashes, "doc").select("doc", "spans", "h").mapInArrow(run, "key long, doc long, at int, reach int")


def texts_of(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc, h)``: shingle hashes (their low 32 bits) of the wanted units, from
    the row ``(doc, id)`` of each."""
    rows = src.join(hinted(wanted), ["doc", "id"], "left_semi").dropDuplicates(["doc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            tokens, offsets = shingled(b.column("text"))
            n = np.diff(offsets)
            last = np.arange(len(tokens)) >= np.repeat(offsets[1:] - SHINGLE + 1, n)
            ends = np.r_[0, np.cumsum(np.maximum(n - SHINGLE + 1, 0))].astype(np.int32)
            h = pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens[~last].astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc"), h], names=["doc", "h"])

    return rows.mapInArrow(run, "doc long, h array<int>")
