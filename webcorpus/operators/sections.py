"""S1 — structure-aware sections (line kinds C8, section rule, G5 concat).

The splitter's rule looks sequential (a table line opens a section only when
the section being built has no ``|`` line yet), but it reduces to prefix
computations over the lines of one document, so it runs as window functions
sharing one ``partition by doc order by pos`` spec: one shuffle on the doc
key, no Python.

Line kinds, first match wins (``s`` = stripped line):

* ``H`` — line > 0 and ``s`` starts with ``#`` or the raw next line is an
  ``===`` / ``---`` underline (a heading on line 0 falls through);
* ``L`` — ``s`` starts with ``*``, ``+``, ``-``, ``<digits>.`` or ``[a-z])``;
* ``T`` — ``s`` contains ``|``;
* ``N`` — anything else.

A section starts before line *i* > 0 on ``H``; on ``L`` when not in a list;
on ``N`` when in a list; on ``T`` when the current section has no ``|`` line.
``L`` enters the list, ``N`` leaves it, ``H`` and ``T`` leave it alone.
Sections that are blank are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions import patterns as P
from webcorpus.functions.text import has_text, strip


def explode_lines(docs: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """One row per ``\\n``-separated line: ``keys…, pos, line, next_line``
    (narrow: the successor comes from the line array itself, not a window)."""
    lines = docs.select(*keys, F.split(F.col(text_col), "\n").alias("_lines"))
    nxt = F.slice("_lines", 2, F.greatest(F.size("_lines") - 1, F.lit(0)))
    zipped = F.arrays_zip(F.col("_lines").alias("line"), nxt.alias("next_line"))
    out = lines.select(*keys, F.posexplode(zipped).alias("pos", "_z"))
    return out.select(*keys, "pos", F.col("_z.line").alias("line"), F.col("_z.next_line").alias("next_line"))


def line_kind(line: Column, next_line: Column, pos: Column) -> Column:
    s = strip(line)
    heading = (pos > 0) & (
        s.startswith("#")
        | F.coalesce(next_line.rlike(P.UNDERLINE_EQ), F.lit(False))
        | F.coalesce(next_line.rlike(P.UNDERLINE_DASH), F.lit(False)))
    return (F.when(heading, F.lit("H"))
            .when(s.rlike(P.LIST_ITEM), F.lit("L"))
            .when(s.contains("|"), F.lit("T"))
            .otherwise(F.lit("N")))


def line_kinds(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``kind`` and ``section_no`` to ``keys…, pos, line`` rows."""
    w = Window.partitionBy(*keys).orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.col("pos")
    kind = F.col("kind")
    pipe = F.col("line").contains("|")
    nxt = F.col("next_line") if "next_line" in lines.columns else F.lead("line").over(w)
    df = lines.withColumn("kind", line_kind(F.col("line"), nxt, pos))
    # in-list state before line i: the last L-or-N kind seen, L meaning "in".
    df = df.withColumn(
        "in_list",
        F.coalesce(F.last(F.when(kind.isin("L", "N"), kind == "L"), ignorenulls=True).over(before),
                   F.lit(False)))
    nb = (pos > 0) & ((kind == "H")
                      | ((kind == "L") & ~F.col("in_list"))
                      | ((kind == "N") & F.col("in_list")))
    df = df.withColumn("nb", nb.cast("int"))
    # c = number of non-table boundaries up to and including line i
    df = df.withColumn("c", F.sum("nb").over(upto))
    # c at the last earlier line holding a pipe (that line's section)
    df = df.withColumn("cp", F.last(F.when(pipe, F.col("c")), ignorenulls=True).over(before))
    t_start = ((pos > 0) & (kind == "T")
               & (F.col("cp").isNull() | ((F.col("c") - F.col("nb")) > F.col("cp"))))
    df = df.withColumn("starts", ((F.col("nb") == 1) | t_start).cast("int"))
    df = df.withColumn("section_no", F.sum("starts").over(upto).cast("bigint"))
    return df.drop("in_list", "nb", "c", "cp", "starts", "next_line")


def ordered_concat(order_col: str, text_col: str, sep: str) -> Column:
    """``text_col`` values of a group joined in ``order_col`` order."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                 F.col(text_col).alias("t"))))
    return F.array_join(F.transform(items, lambda x: x["t"]), sep)


def sections(docs: DataFrame, keys: Sequence[str], text_col: str = "text",
             carry: Sequence[str] = ()) -> DataFrame:
    """``keys…, carry…, section_no, text`` — the non-blank sections of each
    document (``carry`` columns are per-document and pass through)."""
    keys, carry = list(keys), list(carry)
    kinds = line_kinds(explode_lines(docs, keys + carry, text_col), keys)
    out = (kinds.groupBy(*keys, *carry, "section_no")
           .agg(ordered_concat("pos", "line", "\n").alias("text")))
    return out.where(has_text("text"))
