"""Column → Column text functions (all JVM-side, no Python in the hot path).

Each Spark function has a twin ``*_sql`` that renders the same computation as
a DuckDB SQL expression; the oracle queries are built from those twins, so the
two engines are checked against one written contract.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions import patterns as P
from webcorpus.functions.patterns import sql_str


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- strip / tidy
def strip(col) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(_c(col), P.STRIP, "")


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {sql_str(P.STRIP)}, '', 'g')"


def has_text(col) -> Column:
    """True when the string holds any non-whitespace character."""
    return _c(col).rlike(P.NON_WS)


def has_text_sql(expr: str) -> str:
    return f"regexp_matches({expr}, {sql_str(P.NON_WS)})"


# ---------------------------------------------------------------- entities
def decode_entities(col) -> Column:
    """Decimal, hexadecimal and named entities → characters, in one pass (so
    ``&amp;lt;`` gives ``&lt;``).  What is no entity, or names no character, stays.

    The text is cut at ``&``; the entity at the start of each piece is read
    from its code point's four bytes, or from the table of names (one foldable
    literal: built of 500, the table was most of the time a plan took to make)."""
    names = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in P.NAMED_ENTITIES.items())), F.lit("\x01"), F.lit("\x02"))

    def piece(p: Column, i: Column) -> Column:
        body = F.regexp_extract(p, P.ENTITY, 1)
        low = F.lower(body)
        point = (F.when(low.startswith("#x"), F.conv(F.substring(low, 3, 6), 16, 10))
                 .when(low.startswith("#"), F.substring(low, 2, 7))).cast("int")
        good = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        char = (F.when(point == int(P.NO_BREAK_SPACE), F.lit(" "))
                .when(good, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")))
        char = F.coalesce(char, F.when(body.rlike("^[A-Za-z]"), F.try_element_at(names, body)))
        rest = F.substr(p, F.length(body) + 2)
        return (F.when(i == 0, p).when((body != "") & char.isNotNull(), F.concat(char, rest))
                .otherwise(F.concat(F.lit("&"), p)))

    def decode(text: Column) -> Column:
        return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&", -1), piece), "")).otherwise(text)

    return F.get(F.transform(F.array(_c(col)), decode), 0)


def decode_entities_sql(expr: str) -> str:
    names = "MAP {" + ", ".join(f"{sql_str(k)}: {sql_str(v)}" for k, v in P.NAMED_ENTITIES.items()) + "}"
    body = f"regexp_extract(p, {sql_str(P.ENTITY)}, 1)"
    point = (f"CASE WHEN lower({body}) LIKE '#x%' THEN CAST('0x' || substr({body}, 3) AS INTEGER) "
             f"WHEN {body} LIKE '#%' THEN CAST(substr({body}, 2) AS INTEGER) END")
    char = (f"CASE WHEN ({point}) = {P.NO_BREAK_SPACE} THEN ' ' WHEN ({point}) BETWEEN 1 AND 1114111 AND ({point}) NOT BETWEEN 55296 AND 57343 "
            f"THEN chr({point}) WHEN {body} <> '' AND {body} NOT LIKE '#%' THEN map_extract({names}, {body})[1] END")
    piece = (f"CASE WHEN i = 1 THEN p WHEN {body} = '' THEN '&' || p "
             f"ELSE coalesce(({char}) || substr(p, length({body}) + 2), '&' || p) END")
    return f"array_to_string(list_transform(string_split({expr}, '&'), lambda p, i: {piece}), '')"


# ---------------------------------------------------------------- C1 clean_html
def clean_html(col) -> Column:
    """HTML → markdown-like text: one ordered chain of regex rewrites.

    Drops comments, head, script, style, meta/link/img; headings become
    ``#`` lines, list items ``* `` lines, table cells `` | ``-joined rows,
    links ``[text](href)``; block tags break lines; other tags vanish;
    entities are decoded; lines are stripped and blank lines dropped.
    """
    out = _c(col)
    steps = list(P.CLEAN_STEPS)
    while steps[0][1] == "" and ".*?" in steps[0][0]:
        out = _delete(out, steps.pop(0)[0])
    strip_tags = next(i for i, s in enumerate(steps) if s[0] == P.ANY_TAG)
    links = [i for i, s in enumerate(steps[:strip_tags]) if ".*?" in s[0]]
    first, last = links[0], links[-1] + 1

    def tags(head: Column) -> Column:
        head = _before_last(_chain(head, steps[:first]), lambda h: _chain(h, steps[first:last]), P.LINK_END)
        return _chain(head, steps[last:strip_tags])

    # a tag needs a ">": in what follows the last one, only spaces are tidied
    out = _before_last(out, tags, change_rest=lambda rest: F.regexp_replace(rest, P.WS + "+", " "))
    return _chain(_delete(out, P.ANY_TAG), steps[strip_tags + 1:])


def _chain(out: Column, steps: list[tuple[str, ...]]) -> Column:
    for step in steps:
        if step[0] == P.ENTITIES:
            out = decode_entities(out)
        else:
            out = F.regexp_replace(out, step[0], P.spark_replacement(step[1]))
    return out


def _delete(col: Column, pattern: str) -> Column:
    """Matches removed.  The first opener that is never closed ends the search and
    stays with all that follows (nothing there could match); else each such
    opener would make the search read on to the end, quadratic on a hostile page."""
    return F.regexp_replace(col, P.or_unclosed(pattern), "$1")


def _before_last(col: Column, change, closer: str = ">", change_rest=lambda rest: rest) -> Column:
    """``change`` applied to the text up to its last ``closer`` (``>`` or a pattern),
    ``change_rest`` to what follows: openers there are never closed, see ``_delete``."""
    def split(text: Column) -> Column:
        head = (F.substr(text, F.lit(1), F.length(text) - F.length(F.substring_index(text, ">", -1))) if closer == ">"
                else F.regexp_extract(text, r"(?is)\A.*" + closer, 0))
        return F.get(F.transform(F.array(head), lambda h: F.concat(
            change(h), change_rest(F.substr(text, F.length(h) + 1)))), 0)

    return F.get(F.transform(F.array(col), split), 0)


def clean_html_sql(expr: str) -> str:
    out = expr
    for step in P.CLEAN_STEPS:
        if step[0] == P.ENTITIES:
            out = decode_entities_sql(out)
        else:
            out = (f"regexp_replace({out}, {sql_str(step[0])}, "
                   f"{sql_str(P.duck_replacement(step[1]))}, 'g')")
    return out


# ---------------------------------------------------------------- C2 metadata
def html_title(col) -> Column:
    """Text of the first ``<title>``, entities decoded, or ``""``."""
    return strip(decode_entities(F.regexp_extract(_c(col), P.TITLE, 1)))


def html_title_sql(expr: str) -> str:
    return strip_sql(decode_entities_sql(f"regexp_extract({expr}, {sql_str(P.TITLE)}, 1)"))


def html_description(col) -> Column:
    """Content of the first ``<meta name="description">`` tag (either kind of
    quotes, entities decoded), or ``""``."""
    metas = F.regexp_extract_all(_c(col), F.lit(P.META_TAG), 0)
    desc = F.filter(metas, lambda m: m.rlike(P.META_IS_DESCRIPTION))
    first = F.try_element_at(desc, F.lit(1))
    content = F.concat(F.regexp_extract(first, P.META_CONTENT, 1), F.regexp_extract(first, P.META_CONTENT, 2))
    return F.coalesce(strip(decode_entities(content)), F.lit(""))


def html_description_sql(expr: str) -> str:
    metas = f"regexp_extract_all({expr}, {sql_str(P.META_TAG)})"
    first = (f"list_filter({metas}, lambda m: "
             f"regexp_matches(m, {sql_str(P.META_IS_DESCRIPTION)}))[1]")
    content = " || ".join(f"regexp_extract({first}, {sql_str(P.META_CONTENT)}, {g})" for g in (1, 2))
    return f"coalesce({strip_sql(decode_entities_sql(content))}, '')"


# ---------------------------------------------------------------- C7 tokens
def token_count(col) -> Column:
    """Default token counter: letter runs, ≤3-digit runs, symbol runs."""
    return F.regexp_count(_c(col), F.lit(P.TOKEN)).cast("bigint")


def model_token_counter(make_encoder):
    """Token counter backed by a user codec (e.g. a BPE encoder): an iterator
    Pandas UDF that builds ``make_encoder()`` once per Python worker and
    returns ``text -> len(encoder(text))`` over Arrow batches.  Usable
    wherever a ``count_tokens`` column function is taken."""
    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make_encoder()
        for texts in batches:
            yield texts.fillna("").map(lambda t: len(encode(t))).astype("int64")

    return lambda col: count(_c(col))


def token_count_sql(expr: str) -> str:
    return f"CAST(len(regexp_extract_all({expr}, {sql_str(P.TOKEN)})) AS BIGINT)"


# ---------------------------------------------------------------- C9 paragraphs
def paragraphs(col) -> Column:
    """Split on blank lines (``\\n\\n+``), strip, drop empty."""
    parts = F.transform(F.split(_c(col), P.PARAGRAPH_BREAK), strip)
    return F.filter(parts, lambda p: p != F.lit(""))


def paragraphs_sql(expr: str) -> str:
    parts = (f"list_transform(string_split_regex({expr}, {sql_str(P.PARAGRAPH_BREAK)}), "
             f"lambda p: {strip_sql('p')})")
    return f"list_filter({parts}, lambda p: p <> '')"


# ---------------------------------------------------------------- URL parts
def authority(col) -> Column:
    """``urlparse(url).netloc``: the text between ``scheme://`` and the path."""
    return F.regexp_extract(_c(col), P.AUTHORITY, 1)


def authority_sql(expr: str) -> str:
    return f"regexp_extract({expr}, {sql_str(P.AUTHORITY)}, 1)"


def robots_path(col) -> Column:
    """Path + query + fragment after the authority, ``/`` when empty."""
    rest = F.regexp_extract(_c(col), P.PATH_REST, 1)
    return F.when(rest == "", F.lit("/")).otherwise(rest)


def robots_path_sql(expr: str) -> str:
    rest = f"regexp_extract({expr}, {sql_str(P.PATH_REST)}, 1)"
    return f"CASE WHEN {rest} = '' THEN '/' ELSE {rest} END"
