"""C10, C11, C14, C15 — fact sentences, fact cards, summary and links, all
as narrow column expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions import patterns as P
from webcorpus.functions.patterns import sql_str
from webcorpus.functions.text import strip, strip_sql

# Facts per text, facts in the summary, summary length.
MAX_FACTS = 10
SUMMARY_FACTS = 3
SUMMARY_CHARS = 200
FACT_TYPE = "statement"


def facts(text: Column, max_facts: int = MAX_FACTS) -> Column:
    """Sentences (split on runs of ``.!?``), stripped, at least 20 characters,
    not opening with a question word; the first ``max_facts``."""
    sentences = F.transform(F.split(text, P.SENTENCE_SPLIT), strip)
    kept = F.filter(sentences, lambda s: (F.length(s) >= 20) & ~F.lower(s).rlike(P.QUESTION_PREFIX))
    return F.slice(kept, 1, max_facts)


def facts_sql(expr: str, max_facts: int = MAX_FACTS) -> str:
    sentences = (f"list_transform(string_split_regex({expr}, {sql_str(P.SENTENCE_SPLIT)}), "
                 f"lambda s: {strip_sql('s')})")
    kept = (f"list_filter({sentences}, lambda s: length(s) >= 20 AND "
            f"NOT regexp_matches(lower(s), {sql_str(P.QUESTION_PREFIX)}))")
    return f"{kept}[1:{max_facts}]"


def fact_card(fact: Column, url: Column, title: Column) -> Column:
    return F.struct(fact.alias("fact"), F.coalesce(url, F.lit("")).alias("source"),
                    F.coalesce(title, F.lit("")).alias("title"), F.lit(FACT_TYPE).alias("type"))


def summary(fact_texts: Column) -> Column:
    """First three facts joined by ``". "``; over 200 characters → cut + ``...``."""
    s = F.array_join(F.slice(fact_texts, 1, SUMMARY_FACTS), ". ")
    return F.when(F.length(s) > SUMMARY_CHARS,
                  F.concat(F.substring(s, 1, SUMMARY_CHARS), F.lit("..."))).otherwise(s)


def summary_sql(fact_list: str) -> str:
    s = f"array_to_string(({fact_list})[1:{SUMMARY_FACTS}], '. ')"
    return f"CASE WHEN length({s}) > {SUMMARY_CHARS} THEN left({s}, {SUMMARY_CHARS}) || '...' ELSE {s} END"


def handoff_url(dataset: Column, query: Column) -> Column:
    """``/dataset/{dataset}/query?q={query}`` — not URL-encoded."""
    return F.concat(F.lit("/dataset/"), dataset, F.lit("/query?q="), query)
