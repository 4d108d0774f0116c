"""Conversation structure repair by depth-first branch-and-bound.

A conversation's rows, in order of turn, become one byte each (fault, first
letter of the role, truncated or not); texts stay out of the search.  A node
of the search is (rows done, what the output ends in: nothing, system, user,
assistant); edits lead from node to node: Delete, Insert, Keep, Rerole, in
ASCII order.  An explicit stack walks prefixes depth first in that order, so
audits are met in ASCII order and the first one met at a cost is the least.
A prefix goes when its cost plus a lower bound of the rest (the cheapest edits
of the rest if the conversation might end anywhere) doesn't beat the incumbent
(cost, audit), or when its node has been reached at no higher cost: the
node's table holds the least cost so far, and the earlier prefix comes first in
ASCII order.  What is left at the end is proved cheapest, and least of its cost.

The audits then meet the texts, sorted, and a task walks through both row by
row: neither step holds a conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import SPACES, cut

DELETE, MISROLED, INSERT, TRUNCATED = 3, 2, 2, 1
#: What the output ends in, and the role that must follow (a system row may only come first).
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LETTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: A row's byte: fault (must go) 64, truncated 32, else the state its role leads to (0: other roles).
GO, SHORT = 64, 32


def steps(token: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits of a row in a state, in ASCII order but for Insert: (initial, cost, rows done, state)."""
    out = [("D", DELETE, 1, state)]
    if token & GO:
        return out
    own, extra = token & 3, TRUNCATED if token & SHORT else 0
    if own == AFTER[state] or (own == SYSTEM and state == NOTHING):
        out.append(("K", extra, 1, own))
    out.append(("R", MISROLED + extra, 1, AFTER[state]))
    return out


def lower_bounds(tokens: bytes) -> list[tuple[int, int, int, int]]:
    """Per number of rows done and state: cheapest cost of the other rows when the
    output may end anywhere."""
    bound = [(0, 0, 0, 0)] * (len(tokens) + 1)
    for i in range(len(tokens) - 1, -1, -1):
        ahead = bound[i + 1]
        cost = [min(c + ahead[s] for _, c, _, s in steps(tokens[i], state)) for state in range(4)]
        for _ in range(2):  # an inserted row leads to the next state; two suffice, as they come round again
            cost = [min(cost[s], INSERT + cost[AFTER[s]]) for s in range(4)]
        bound[i] = tuple(cost)
    return bound


def first_incumbent(tokens: bytes, bound: list) -> int:
    """Cost of one repair: the cheapest-looking edit at every row, then rows inserted to the end."""
    i = state = cost = 0
    while i < len(tokens):
        moves = [("I", INSERT, 0, AFTER[state]), *steps(tokens[i], state)]
        _, c, done, s = min(moves, key=lambda m: (m[1] + bound[i + m[2]][m[3]], -m[2]))
        i, state, cost = i + done, s, cost + c
    while state not in (NOTHING, ASSISTANT):
        state, cost = AFTER[state], cost + INSERT
    return cost


def cheapest_edits(tokens: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits after which the roles read ``(s?(ua)+)?``;
    of equal costs the audit least in ASCII order."""
    n = len(tokens)
    bound = lower_bounds(tokens)
    best, audit = first_incumbent(tokens, bound) + 1, ""
    reached = [[best] * 4 for _ in range(n + 1)]
    path: list[str] = []
    stack = [(0, NOTHING, 0, 0, "")]
    while stack:
        i, state, cost, depth, edit = stack.pop()
        if cost + bound[i][state] >= best or reached[i][state] <= cost:
            continue
        reached[i][state] = cost
        if depth:
            del path[depth - 1:]
            path.append(edit)
        if i == n and state in (NOTHING, ASSISTANT):
            best, audit = cost, "".join(path[:depth])
            continue
        moves = [("I", INSERT, 0, AFTER[state])]
        if i < n:
            own = steps(tokens[i], state)
            moves = [own[0], *moves, *own[1:]]
        for e, c, done, s in reversed(moves):
            stack.append((i + done, s, cost + c, depth + 1, e))
    return best, audit


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, turn, role, text)``: the rows with faults put in by ``crc32("conv:turn") % 20``: 0 drops a row, 1
    empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes its role user.  A null (id and turn within
    the hashed text, role, text) counts as one space."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced(id_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20
    out = rows.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), spaced(role_col).alias("role"), spaced(text_col).alias("text"),
                      kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return out.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                      F.explode(times).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows(conv, turn, role, text)`` with what the search needs, written once: ``text_key`` (SHA-256),
    ``blank``, ``truncated`` and the role's first letter."""
    inner = F.btrim("text", F.lit(SPACES))
    return cut(rows.select("conv", "turn", "role", "text", F.unhex(F.sha2("text", 256)).alias("text_key"), (inner == "").alias("blank"),
                           (~F.right(inner, F.lit(1)).isin(".", "!", "?")).alias("truncated"), F.substring("role", 1, 1).alias("letter")))


#: A row's place in its conversation: rows of one turn by role, then text digest; equal rows stand together.
ORDER = ("turn", "role", "text_key")
STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(marked: DataFrame) -> DataFrame:
    """``marked`` (of ``faults``) → one row per conversation that has rows: ``conv`` and ``STATS``."""
    kind = dict(marked.dtypes)["conv"]
    own = ["conv", "role", "text_key"]
    start = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    first = marked.groupBy(*own).agg(start.alias("start")).select(*(F.col(c).alias(f"f_{c}") for c in own), F.col("start.turn").alias("f_turn"))
    same = F.lit(True)
    for c in own:
        same = same & F.col(c).eqNullSafe(F.col(f"f_{c}"))
    token = (marked.select(*own, "turn", "blank", "truncated", "letter").join(first, same)
             .select(*own, "turn", "blank", "truncated", "letter", F.col("turn").eqNullSafe(F.col("f_turn")).alias("first")))
    ordered = token.repartition("conv").sortWithinPartitions("conv", *ORDER)
    names = ["conv", "turn", "role", "text_key", "blank", "truncated", "letter", "first"]

    def summary(conv, s: dict) -> list:
        cost, audit = cheapest_edits(bytes(s["tokens"]))
        gaps = s["last"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
        return [conv, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost, audit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, before = None, None, None
        done: list[list] = []
        schema = None
        for b in batches:
            schema = pa.schema([("conv", b.schema.field("conv").type), *((c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in STATS.split(", "))])
            for c, turn, role, key, blank, truncated, letter, first in zip(*(b.column(n).to_pylist() for n in names)):
                if held is None or c != conv:
                    if held is not None:
                        done.append(summary(conv, held))
                    conv, before = c, None
                    held = {"tokens": bytearray(), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None, "last": None, "letter": None}
                repeated = not first or before == (turn, role, key)
                fault = "blank" if blank else "duplicate" if repeated else "truncated" if truncated else None
                if fault:
                    held[fault] += 1
                if held["letter"] is not None and held["letter"] + letter not in ("su", "ua", "au"):
                    held["illegal"] += 1
                if turn is not None and turn != held["last"]:
                    held["turns"] += 1
                    held["low"], held["last"] = turn if held["low"] is None else held["low"], turn
                held["letter"], before = letter, (turn, role, key)
                held["tokens"].append(GO if fault in ("blank", "duplicate") else LETTER.get(letter, 0) + (SHORT if fault else 0))
            if len(done) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if held is not None:
            done.append(summary(conv, held))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*done), schema)], schema=schema)

    return ordered.mapInArrow(run, f"conv {kind}, {STATS}")


def walk(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """A conversation's output rows (edit, role, text), one at a time, from its audit and rows."""
    state = NOTHING
    for edit in audit:
        if edit == "I":
            state = AFTER[state]
            yield edit, ROLE[state], ""
            continue
        role, text = next(rows)
        if edit == "K":
            state = LETTER[role[0]]
            yield edit, role, text
        elif edit == "R":
            state = AFTER[state]
            yield edit, ROLE[state], text


def _meet(marked: DataFrame, found: DataFrame) -> DataFrame:
    """Audits and rows of a conversation in one task, the audit first, then the rows in order."""
    lead = found.select("conv", F.lit(0).alias("what"), F.lit(None).cast(dict(marked.dtypes)["turn"]).alias("turn"), F.lit("").alias("role"),
                        F.lit(b"").alias("text_key"), F.col("audit").alias("text"))
    body = marked.select("conv", F.lit(1).alias("what"), *ORDER, "text")
    return lead.unionByName(body).repartition("conv").sortWithinPartitions("conv", "what", *ORDER)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str, str]]]]:
    """(conv, output rows) of each conversation of a task; its rows must be read before the next one is asked for."""
    def flat():
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                yield from zip(*(part.column(c).to_pylist() for c in ("conv", "what", "role", "text")))

    rows = flat()
    for conv, what, _, audit in rows:
        assert what == 0
        yield conv, walk(audit, ((role, text) for _, _, role, text in rows))


def repaired_rows(marked: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv, place, edit, role, text)``: the conversations after their audits (``found``, of ``audits``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.int64()
        for conv, out in _conversations(batches):
            part = []
            for place, (edit, role, text) in enumerate(out):
                part.append((conv, place, edit, role, text))
                if len(part) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], names=["conv", "place", "edit", "role", "text"])
                    part = []
            if part:
                yield pa.RecordBatch.from_arrays([pa.array(part_c, kind if i == 1 else None) for i, part_c in enumerate(zip(*part))],
                                                 names=["conv", "place", "edit", "role", "text"])

    return _meet(marked, found).mapInArrow(run, f"conv {dict(marked.dtypes)['conv']}, place long, edit string, role string, text string")


def digests(marked: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)``: of ``role:text`` of the repaired rows, joined by newlines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, hashes = [], []
        for conv, out in _conversations(batches):
            h = hashlib.sha256()
            for place, (_, role, text) in enumerate(out):
                h.update(("\n" if place else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            convs.append(conv)
            hashes.append(h.hexdigest())
            if len(convs) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(convs), pa.array(hashes)], names=["conv", "repaired_sha256"])
                convs, hashes = [], []
        if convs:
            yield pa.RecordBatch.from_arrays([pa.array(convs), pa.array(hashes)], names=["conv", "repaired_sha256"])

    return _meet(marked, found).mapInArrow(run, f"conv {dict(marked.dtypes)['conv']}, repaired_sha256 string")


def report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows(conv, turn, role, text)`` → per ``ids(conv)``: ``conv``, ``STATS`` and ``repaired_sha256``."""
    marked = faults(rows)
    found = cut(audits(marked))
    have = found.join(digests(marked, found).withColumnRenamed("conv", "d_conv"), F.col("conv").eqNullSafe(F.col("d_conv"))).drop("d_conv")
    out = ids.distinct().withColumnRenamed("conv", "i_conv").join(have, F.col("i_conv").eqNullSafe(F.col("conv")), "left").drop("conv").withColumnRenamed("i_conv", "conv")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv", *(z.cast("long").alias(c) for z, c in zip(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
