"""A4 robots admission as a join.

The rules arrive as a table ``host, agent, seq, allow, path_prefix,
outcome`` (one row per rule line; hosts whose robots file had no rule carry
one row with a null prefix).  ``outcome`` says how the robots file was read:
``ok``; ``missing`` (other 4xx → allow everything); ``denied`` (401/403 →
deny everything); ``unreachable`` (5xx or no answer → deny, since the
rules were never read).  A host absent from the table counts as unread.

Per host the rules collapse to one row holding the applicable group (the
group naming our agent replaces ``*``) sorted by ``seq`` — bounded by the
size of one robots file — so the URL side joins many-to-one on host with no
aggregation after it: a hot host is split by AQE's skew handling, and a small
rules table is broadcast by Spark's own size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions.text import authority, robots_path, strip

LINE_END = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{0085}\x{2028}\x{2029}]"
#: Lines of a group that aren't agents; a group needs one of them to count.
GROUP_LINES = ("allow", "disallow", "crawl-delay", "request-rate")


def robots_rules(files: DataFrame, agent: str) -> DataFrame:
    """Robots files ``host, text, outcome`` (one a host) → the rules that ``robots_allowed`` takes.

    The grammar is a scan over lines.  What follows ``#`` is a comment, and
    lines that aren't ``field: value`` say nothing.  A group is a run of user-agent
    lines and the lines after it; it ends at the next user-agent line or at an empty line (a line with only a
    comment isn't empty), and is dropped if it has agents alone.  Rules outside a group say nothing.  Our
    group is the first one with an agent that our name (up to ``/``) contains, else the first
    one for ``*``; the first rule whose path starts ours decides.  No path is every
    path, and ``Disallow:`` without one allows.  Paths are prefixes: ``*`` is an ordinary character, and escapes are
    compared as written.  Hosts without a group for us get one row without a rule."""
    name = agent.split("/")[0].lower()
    lines = files.select("host", F.posexplode(F.split(F.coalesce("text", F.lit("")), LINE_END)).alias("seq", "raw"))
    body = strip(F.substring_index("raw", "#", 1))
    lines = lines.select("host", "seq", F.lower(strip(F.substring_index(body, ":", 1))).alias("field"),
                         F.when(F.instr(body, ":") > 0, strip(F.substr(body, F.instr(body, ":") + 1))).alias("value"), (F.col("raw") == "").alias("empty"))
    known = F.when(F.col("empty"), "end").when(F.col("value").isNull(), None).when(F.col("field") == "user-agent", "agent").when(
        F.col("field").isin(*GROUP_LINES), "rule")
    lines = lines.withColumn("kind", known).where("kind is not null")
    order = Window.partitionBy("host").orderBy("seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.last(F.when(F.col("kind") != "rule", F.col("kind")), ignorenulls=True).over(before) == "agent"
    lines = lines.withColumn("inside", F.coalesce(inside, F.lit(False))).where("kind <> 'rule' or inside")
    starts = (F.col("kind") == "agent") & (F.coalesce(F.lag("kind").over(order), F.lit("end")) != "agent")
    lines = lines.withColumn("grp", F.sum(starts.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    value = F.lower("value")
    groups = lines.groupBy("host", "grp").agg(
        F.bool_or((F.col("kind") == "agent") & (value == "*")).alias("star"),
        F.bool_or((F.col("kind") == "agent") & F.lit(name).contains(value)).alias("own"), F.bool_or(F.col("kind") == "rule").alias("whole"))
    mine = groups.where("whole and (own or star)").select("host", "grp", F.when(F.col("star"), "*").otherwise(agent).alias("agent"))
    mine = mine.groupBy("host", "agent").agg(F.min("grp").alias("grp"))
    paths = lines.where(F.col("field").isin("allow", "disallow") & (F.col("kind") == "rule")).select(
        "host", "grp", "seq", ((F.col("field") == "allow") | (F.col("value") == "")).alias("allow"),
        F.when(F.col("value") == "", "/").otherwise(F.col("value")).alias("path_prefix"))
    return (files.select("host", "outcome").join(mine, "host", "left").join(paths, ["host", "grp"], "left")
            .select("host", "agent", "seq", "allow", "path_prefix", "outcome"))


def host_rules(rules: DataFrame, agent: str) -> DataFrame:
    """``host, outcome, rules`` with ``rules`` = applicable ``(seq, allow,
    path_prefix)`` sorted by ``seq``."""
    agent_l = agent.lower()
    r = (rules.withColumn("_own", F.lower(F.col("agent")) == F.lit(agent_l))
         .withColumn("_star", F.col("agent") == F.lit("*")))
    per_host = r.groupBy("host").agg(
        F.max("outcome").alias("outcome"),
        F.coalesce(F.max("_own"), F.lit(False)).alias("_has_own"),
        F.collect_list(F.when(F.col("path_prefix").isNotNull(),
                              F.struct("seq", "allow", "path_prefix", "_own", "_star"))).alias("_all"))
    chosen = F.filter("_all", lambda x: F.when(F.col("_has_own"), x["_own"]).otherwise(x["_star"]))
    return per_host.select(
        "host", "outcome",
        F.array_sort(F.transform(chosen, lambda x: F.struct(x["seq"].alias("seq"), x["allow"].alias("allow"),
                                                            x["path_prefix"].alias("path_prefix"))))
        .alias("rules"))


def robots_allowed(urls: DataFrame, rules: DataFrame, agent: str,
                   url_col: str = "url", base_col: str | None = None) -> DataFrame:
    """Adds ``allowed``: may ``agent`` fetch the URL under the robots rules of
    the base URL's host (the URL's own host when ``base_col`` is None)?
    A rule without a path says nothing (``Disallow:`` allows everything)."""
    hr = host_rules(rules, agent).withColumnRenamed("host", "_rhost")
    base = F.col(base_col) if base_col else F.col(url_col)
    u = urls.withColumn("_rhost", authority(base)).withColumn("_path", robots_path(F.col(url_col)))
    joined = u.join(hr, "_rhost", "left")
    first = F.try_element_at(
        F.filter("rules", lambda r: (r["path_prefix"] != "") & F.col("_path").startswith(r["path_prefix"])), F.lit(1))
    decision = (F.when(F.col("outcome").isNull() | F.col("outcome").isin("unreachable", "denied"),
                       F.lit(False))
                .when(F.col("outcome") == "missing", F.lit(True))
                .otherwise(F.coalesce(first["allow"], F.lit(True))))
    return joined.withColumn("allowed", decision).drop("_rhost", "_path", "outcome", "rules")
