"""Chat formatting into budgeted, turn-aligned windows (DataFrame functions
only), and reading the formatted windows back.

Template of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings
inside roles and texts are broken up by a backslash after their first
character, backslashes are doubled, and a line break in a role is written as
``\\n``; so the markers occur nowhere but in the template, and one pass undoes
it.

A conversation's turns are cut into windows of at most ``budget`` tokens.  A
window holds the system turn (the first turn, if its role is system), then as
many of the turns just before it as fit into ``history`` tokens, then new
turns, as many as the prefix sums of their tokens allow.  Repeated turns are
masked, so each assistant text is a training target in exactly one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.common import word_count

START, END = "<|im_start|>", "<|im_end|>\n"
#: Strings that templates give a meaning to.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Tokens of a turn beside its words: two markers, the role, and the line breaks.
TURN_TOKENS = 4

#: A control string is told by its first two or more characters; see CONTROL.
_CONTROL_RE = r"(<)(?=\||/?s>|</?SYS>>)|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    """Backslashes doubled, control strings broken after their first character."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL_RE, r"$1$2\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Undoes ``escape``: of two backslashes one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit(""))), "\\")


def windows(conversations: DataFrame, budget: int = 2048, history: int = 256) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` → one row per window:
    ``conv_id, window, formatted, n_repeated, n_turns, tokens, oversize, loss_spans``.

    ``loss_spans``: start and length (characters of ``formatted``) of each
    assistant text that is a target.  ``n_repeated``: turns that repeat
    earlier ones, at the window's start.  Turns are taken in the order of
    (turn, role, text), nulls first; null roles and texts are empty; repeated
    rows are turns of their own; a null ``conv_id`` is a conversation.  A turn
    over the budget fills a window alone (``oversize``); no text is cut.  One
    conversation's turns meet in one task, as its digest needs them together.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tok", word_count(F.col("text")) + TURN_TOKENS)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(order)).withColumn(
        "upto", F.sum("tok").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "upto", "tok", "role", "text"))).alias("t"))
    # sums[i]: tokens of the first i turns; lead: tokens of the system turn
    whole = whole.withColumn("sums", F.expr("concat(array(0L), transform(t, x -> x.upto))"))
    whole = whole.withColumn("sys", F.expr("cast(t[0].role = 'system' as int)")).withColumn("lead", F.expr("sys * sums[1]"))
    # turn i opens a new span when the budget has no room for it beside the system
    # turn and the history of the span under way; history goes back from i while it fits
    whole = whole.withColumn("cuts", F.expr(f"""
        aggregate(sequence(0, size(t) - 1), array(named_struct('first', 0, 'back', 0)), (a, i) -> if(
          i > element_at(a, -1).first and sums[i + 1] - sums[element_at(a, -1).back]
            + if(element_at(a, -1).first > 0, lead, 0L) > {budget}L,
          concat(a, array(named_struct('first', i, 'back',
            aggregate(sequence(i, greatest(sys, i - {max(1, history // TURN_TOKENS)}), -1), i, (b, j) -> if(
              j = b - 1 and sums[i] - sums[j] <= least({history}L, {budget}L - lead - t[i].tok), j, b))))),
          a))"""))
    spans = whole.select("conv_id", F.posexplode(F.expr("""
        transform(cuts, (c, k) -> named_struct(
          'n_repeated', if(c.first > 0, sys + c.first - c.back, 0),
          'used', concat(slice(t, 1, if(c.first > 0, sys, 0)),
                         slice(t, c.back + 1, if(k + 1 < size(cuts), cuts[k + 1].first, size(t)) - c.back))))
        """)).alias("window", "c")).select("conv_id", "window", "c.*")
    spans = spans.withColumn("head", F.transform("used", lambda x: F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n"))))
    spans = spans.withColumn("body", F.transform("used", lambda x: escape(x["text"])))
    # ends[i]: characters of the first i formatted turns
    spans = spans.withColumn("ends", F.expr(f"""
        aggregate(sequence(0, size(used) - 1), array(0), (a, i) -> concat(a, array(
          element_at(a, -1) + char_length(head[i]) + char_length(body[i]) + {len(END)})))"""))
    spans = spans.withColumn("loss_spans", F.expr("""
        transform(filter(sequence(0, size(used) - 1), i -> i >= n_repeated and used[i].role = 'assistant'),
          i -> named_struct('start', ends[i] + char_length(head[i]), 'length', char_length(body[i])))"""))
    turns = F.zip_with("head", "body", lambda h, b: F.concat(h, b, F.lit(END)))
    tokens = F.aggregate("used", F.lit(0).cast("long"), lambda a, x: a + x["tok"])
    return spans.select("conv_id", "window", F.array_join(turns, "").alias("formatted"), "n_repeated",
                        F.size("used").alias("n_turns"), tokens.alias("tokens"), (tokens > budget).alias("oversize"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Windows → per conversation: ``conv_id, turns`` (role, text, in order, each
    once), ``loss_text`` (all text under the mask, unescaped) and
    ``formatted_chars``, from the formatted strings and masks alone."""
    turns = F.slice(F.split("formatted", r"<\|im_start\|>"), F.col("n_repeated") + 2, F.col("n_turns"))
    one = F.transform(turns, lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(_body(x)).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    rows = formatted.select("conv_id", "window", one.alias("turns"), loss.alias("loss"), F.char_length("formatted").alias("chars"))
    per = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("chars").cast("long").alias("formatted_chars"))
    return per.select("conv_id", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
                      F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss_text"), "formatted_chars")


def _body(turn: Column) -> Column:
    """The text of ``role\\ntext<|im_end|>\\n``."""
    start = F.locate("\n", turn) + 1
    return F.substring(turn, start, F.char_length(turn) - len(END) - start + 1)


def digests(read: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
