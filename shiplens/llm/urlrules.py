"""URL rules as a sort-merge range join.

A rule (host, path) fits its host with all subdomains and every path that starts with its own. A
url is keyed by its host read backwards, label by label, and its path; under one host the paths a
rule fits are the interval from the rule's path to the path followed by the highest byte. Such
intervals are nested or apart, so a sweep over the sorted ends and starts is a stack: a start
pushes its rule, an end uncovers the one below. The stack's top after each event is computed once
for the rules; urls are then merged into the sorted events and take the top of the last event
before them. A url meets one such sweep for each of its enclosing domains that has rules, and the
longest of the tops wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.llm.common import columns_of, fresh, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 32


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def backwards(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_events(rules: DataFrame) -> DataFrame:
    """The stack's top after each event: ``site``, ``at`` (binary), ``top`` (rule, verdict or null).

    ``rules``: ``host``, ``path``, ``verdict``. Of rules with the same host and path ``block`` wins
    over ``allow``. Rules with a null host, path or verdict are left out.
    """
    rules = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("site", F.array_join(backwards(F.col("host")), "."))
        .withColumn("rule", F.struct(F.concat("host", "path").alias("rule"), "verdict"))
    )
    start = F.col("path").cast("binary")
    ends = rules.select("site", F.concat(start, F.lit(bytearray(b"\xff"))).alias("at"), F.lit(-1).alias("push"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("rule"))
    events = rules.select("site", start.alias("at"), F.lit(1).alias("push"), "rule").unionByName(ends)
    sweep = Window.partitionBy("site").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # The level that is on top after the event: the pushed rule's own, or the one uncovered.
    levels = events.withColumn("level", F.sum("push").over(sweep))
    same_level = Window.partitionBy("site", "level").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    top = F.when(F.col("level") > 0, F.last("rule", ignorenulls=True).over(same_level))
    return levels.select("site", "at", F.struct(top.alias("rule")).alias("state"))


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow", salts: int = SALTS) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (host and path, or null) and ``verdict``.

    The longest fitting rule decides; of equally long ones the one of the closer domain. Without
    one the verdict is ``otherwise``. A null url, or one without ``://``, has an empty host and
    path and fits no rule. Repeated rows stay; columns of ``urls`` with the names of the results
    are replaced. Very long urls are judged whole; an empty table gives no rows, and without rules
    every verdict is ``otherwise``.
    """
    results = ("host", "path", "rule", "verdict")
    events = stage(rule_events(rules))
    deepest = events.agg(F.max(F.size(F.split("site", r"\.")))).first()[0] or 0
    parts = {"host": url_host(F.col(url)), "path": url_path(F.col(url))}
    given = urls.withColumns(parts).select(*columns_of(urls, *results), "host", "path")
    distinct = given.select("host", "path").distinct()
    labels = distinct.withColumn("labels", backwards(F.col("host")))
    # Only as many enclosing domains as the deepest rule has labels.
    depth = F.explode(F.when(F.col("host") != "", F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(deepest, 1))))))
    points = (
        labels.withColumn("depth", depth)
        .withColumn("site", F.expr("array_join(slice(labels, 1, depth), '.')"))
        .join(events.select("site").distinct(), "site", "left_semi")
        .select(
            "site",
            F.pmod(F.xxhash64("host", "path"), F.lit(salts)).alias("salt"),
            F.col("path").cast("binary").alias("at"),
            F.lit(1).alias("kind"),
            F.lit(None).cast(events.schema["state"].dataType).alias("state"),
            F.struct("host", "path", "depth").alias("point"),
        )
    )
    marks = events.select(
        "site",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")).alias("salt"),
        "at",
        F.lit(0).alias("kind"),
        "state",
        F.lit(None).cast(points.schema["point"].dataType).alias("point"),
    )
    merged = Window.partitionBy("site", "salt").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    tops = (
        marks.unionByName(points)
        .withColumn("state", F.last("state", ignorenulls=True).over(merged))
        .filter("point is not null and state.rule is not null")
    )
    best = tops.groupBy("point.host", "point.path").agg(
        F.max_by("state.rule", F.struct(F.length("state.rule.rule"), F.col("point.depth"))).alias("_best")
    )
    (found,) = fresh(given, "_best")
    judged = given.join(stage(best).withColumnRenamed("_best", found), ["host", "path"], "left")
    return judged.select(
        *columns_of(given),
        F.col(found)["rule"].alias("rule"),
        F.coalesce(F.col(found)["verdict"], F.lit(otherwise)).alias("verdict"),
    )
