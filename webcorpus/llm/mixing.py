"""Mixing sources to target sizes by pivotal dependent rounding (DataFrame
functions only).

A source with target t and size s takes every document t/s times on average:
a whole number of copies each, and a fraction to be rounded.  Rounding works
on mass (fraction x words): two documents trade mass at random, without bias,
until one of them is taken or left for good, so the words taken by a source
stay equal to its target.  Documents trade inside small blocks; each block
leaves at most one fractional document, and the leftovers of the blocks trade
again, level by level, until at most ``2 * BLOCK`` a source remain.  Those are rounded long before
short, each handing its rounding error to the next, so a source misses its
target by about half a short document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.common import cut, hinted, spare, word_count

#: Documents that trade in one block, on average.
BLOCK = 48


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """``sizes(source, size)`` → ``(source, source_size, target)``.

    Sources by code point, null last, take the weights in turn and divide
    ``share`` of all sizes by them; a target stops at ``cap`` times its
    source's size and the excess goes to the others by weight, until none is
    above.  That is target = min(cap * size, level * weight) for one level;
    with sources sorted by the level at which they fill up, the level follows
    from running sums.  One row per source goes through these windows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (nth + 1).cast("int")))
    per = per.withColumn("most", cap * F.col("source_size")).withColumn("full_at", F.col("most") / F.col("w"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy("full_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * share
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    per = per.withColumn("level", level).withColumn("open", F.col("level") <= F.col("full_at"))
    # the level of the first source that does not fill up; beyond all of them every source is full
    at = F.min(F.when(F.col("open"), F.struct("full_at", "level"))).over(everything)
    target = F.least(F.col("most"), F.coalesce(at["level"] * F.col("w"), F.col("most")))
    return per.select("source", "source_size", target.cast("double").alias("target"))


def chance(*key: Column) -> Column:
    """A number in [0, 1) fixed by the key."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 52)) / F.lit(float(1 << 52))


ITEM = "struct<key:bigint,size:bigint,p:double>"


def trade(seed: int, level: int):
    """One step of a block's fold: the open document meets the next one."""
    def step(acc: Column, x: Column) -> Column:
        a = acc["open"]
        give = F.least((1 - a["p"]) * a["size"], x["p"] * x["size"])       # mass that x can give to a
        take = F.least(a["p"] * a["size"], (1 - x["p"]) * x["size"])       # mass that a can give to x
        to_a = chance(F.lit(seed), F.lit(level), a["key"], x["key"]) * (give + take) < take
        a_fills = (1 - a["p"]) * a["size"] <= x["p"] * x["size"]           # when x gives: which one is settled
        a_drains = a["p"] * a["size"] <= (1 - x["p"]) * x["size"]          # when a gives
        pa = F.when(to_a, F.when(a_fills, 1.0).otherwise(a["p"] + give / a["size"])).otherwise(
            F.when(a_drains, 0.0).otherwise(a["p"] - take / a["size"]))
        px = F.when(to_a, F.when(~a_fills, 0.0).otherwise(x["p"] - give / x["size"])).otherwise(
            F.when(~a_drains, 1.0).otherwise(x["p"] + take / x["size"]))
        a2 = F.struct(a["key"].alias("key"), a["size"].alias("size"), pa.cast("double").alias("p")).cast(ITEM)
        x2 = F.struct(x["key"].alias("key"), x["size"].alias("size"), px.cast("double").alias("p")).cast(ITEM)
        a_done = F.when(to_a, a_fills).otherwise(a_drains)
        met = F.struct(F.when(a_done, x2).otherwise(a2).alias("open"),
                       F.concat(acc["done"], F.array(F.when(a_done, a2).otherwise(x2))).alias("done"))
        first = F.struct(x.cast(ITEM).alias("open"), acc["done"].alias("done"))
        return F.when(a.isNull(), first).otherwise(met)
    return step


def round_on(acc: Column, x: Column) -> Column:
    """One step of the last fold: a document and the error so far, in words, are rounded together."""
    mass = x["p"] * x["size"] + acc["error"]
    up = F.when(mass * 2 >= x["size"], 1).otherwise(0)
    return F.struct((mass - up * x["size"]).cast("double").alias("error"),
                    F.concat(acc["done"], F.array(F.struct(x["key"].alias("key"), up.cast("int").alias("up")))).alias("done"))


def pivotal(items: DataFrame, seed: int) -> DataFrame:
    """``items(source, key, size, p)``, 0 < p < 1 → ``(source, key, up)``, one
    row per item; ``up`` is 0 or 1.  Sums of size * p per source are kept but
    for what the last, short items can't make up."""
    live = cut(items)
    done: list[DataFrame] = []
    level = 0
    while True:
        counts = live.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if not most:
            break
        last = most <= 2 * BLOCK
        blocks = F.lit(1) if last else F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(BLOCK)))
        dealt = live.withColumnRenamed("source", "s").join(
            hinted(counts), F.col("s").eqNullSafe(F.col("source"))).drop("s")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("key")), blocks))
        turn = (-F.col("size")) if last else F.xxhash64(F.lit(seed + level), F.col("key"))
        met = F.array_sort(F.collect_list(F.struct(turn.alias("o"), F.xxhash64(F.lit(seed), F.col("key")).alias("o2"), "key", "size", "p")))
        folded = dealt.groupBy("source", "block").agg(F.transform(met, lambda m: F.struct(
            m["key"].alias("key"), m["size"].alias("size"), m["p"].alias("p"))).alias("met"))
        if last:
            start = F.struct(F.lit(0.0).alias("error"), F.array().cast("array<struct<key:bigint,up:int>>").alias("done"))
            settled = folded.select("source", F.explode(F.aggregate("met", start, round_on, lambda acc: acc["done"])).alias("d"))
            done.append(settled.select("source", "d.key", "d.up"))
            break
        empty = F.struct(F.lit(None).cast(ITEM).alias("open"), F.array().cast(f"array<{ITEM}>").alias("done"))
        folded = folded.withColumn("f", F.aggregate("met", empty, trade(seed, level)))
        both = F.concat(F.transform("f.done", lambda d: F.struct(d.alias("i"), F.lit(True).alias("settled"))),
                        F.array(F.struct(F.col("f.open").alias("i"), F.lit(False).alias("settled"))))
        after = cut(folded.select("source", F.explode(both).alias("e")).select(
            "source", "e.i.key", "e.i.size", "e.i.p", "e.settled"))
        done.append(after.where("settled").select("source", "key", F.col("p").cast("int").alias("up")))
        live = after.where("not settled").select("source", "key", "size", "p")
        level += 1
    if not done:
        return items.select("source", "key", F.lit(0).alias("up"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, units, whole, extra)``, one row per
    distinct (id, source, size): ``units`` such rows in ``docs``, each taken
    ``whole`` times, and ``extra`` of them once more.

    Size: number of words (null text: 0).  A null source is a source of its
    own, the last.  Sources without words have target 0; texts without words
    are never taken.  Rows that repeat id, source and size are rounded
    together.  The same rows give the same mix in any partitioning.  An empty
    table gives no rows.
    """
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = cut(sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("units")))
    targets = cut(source_targets(rows.select("source", (F.col("size") * F.col("units")).alias("size")), weights, share, cap))
    rows = rows.withColumnRenamed("source", "s").join(
        hinted(targets), F.col("s").eqNullSafe(F.col("source"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rate = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(rate)
    # expected copies of all equal rows, snapped where only rounding keeps it from a whole number
    copies = rate * F.col("units")
    near = F.abs(copies - F.round(copies)) < 1e-9
    rows = rows.withColumn("copies", F.when(near, F.round(copies)).otherwise(copies))
    rows = rows.withColumn("base", F.floor("copies").cast("long"))
    rows = rows.withColumn("p", F.col("copies") - F.col("base")).withColumn("key", F.xxhash64("doc_id", "source", "size"))
    open_items = rows.where("p > 0").select("source", "key", "size", "p")
    up = pivotal(open_items, seed).select(F.col("source").alias("up_source"), F.col("key").alias("up_key"), "up")
    rows = rows.join(up, (F.col("key") == F.col("up_key")) & F.col("source").eqNullSafe(F.col("up_source")), "left")
    taken = F.col("base") + F.coalesce("up", F.lit(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", "units",
                       F.floor(taken / F.col("units")).cast("long").alias("whole"),
                       F.pmod(taken, F.col("units")).cast("long").alias("extra"))


def taken_rows(mixed: DataFrame) -> DataFrame:
    """One row per document: ``(doc_id, source, size, source_size, target, taken)``;
    ``taken`` is the words of its copies."""
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("units"))).alias("nth")
    rows = mixed.select("*", nth)
    copies = F.col("whole") + (F.col("nth") <= F.col("extra")).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    key, size, nth, copies = (spare(docs, c) for c in ("mix_key", "mix_size", "mix_nth", "mix_copies"))
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how).where("whole + extra > 0")
    plan = plan.select(F.xxhash64("doc_id", "source", "size").alias(key), F.struct("*").alias(copies))
    rows = docs.withColumn(size, word_count(F.col(text_col)))
    rows = rows.withColumn(key, F.xxhash64(F.col(id_col), F.col(source_col), F.col(size))).join(plan, key)
    rows = rows.where(F.col(id_col).eqNullSafe(F.col(copies)["doc_id"]) & F.col(source_col).eqNullSafe(F.col(copies)["source"])
                      & (F.col(size) == F.col(copies)["size"]))
    order = Window.partitionBy(key).orderBy(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = rows.withColumn(nth, F.row_number().over(order))
    n = F.col(copies)["whole"] + (F.col(nth) <= F.col(copies)["extra"]).cast("long")
    return rows.withColumn(nth, n).where(F.col(nth) > 0).withColumn(
        nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(nth)))).select(*docs.columns)
