"""Build monitoring: a build is one user's day of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.functions.stats import ratio, rounded
from shiplens.operators import monitoring

_BUILDS = """
WITH ev AS (SELECT user_id || ':' || strftime(ts, '%Y-%m-%d') AS build_id, user_id, ts::DATE AS build_date,
              event_type, 'case-' || regexp_extract(props, '(\\d+)', 1) AS case_name FROM events),
bd AS (SELECT build_id, build_date, min(event_type) || '-' || user_id AS build_name, count(*) AS total,
         count(*) FILTER (WHERE event_type <> 'error') AS passed,
         round((count(*) FILTER (WHERE event_type <> 'error') / count(*))::DECIMAL(28,10), 4)::DOUBLE AS pass_rate
       FROM ev GROUP BY build_id, build_date, user_id),
ci AS (SELECT build_id FROM bd WHERE contains(build_name, 'signup') OR contains(build_name, 'view')),
ok AS (SELECT * FROM bd WHERE build_id NOT IN (SELECT build_id FROM ci)),
fl AS (SELECT build_id, build_date, case_name FROM ev WHERE event_type = 'error'
       AND build_id NOT IN (SELECT build_id FROM ci))
"""


def _events(t: Tables) -> DataFrame:
    day = F.to_date("ts")
    return t.events.select(
        F.concat(F.col("user_id").cast("string"), F.lit(":"), day.cast("string")).alias("build_id"),
        "user_id",
        day.alias("build_date"),
        "event_type",
        F.concat(F.lit("case-"), F.get_json_object("props", "$.k")).alias("case_name"),
    )


def _builds(t: Tables) -> DataFrame:
    passed = F.sum(F.when(F.col("event_type") != "error", 1).otherwise(0))
    return (
        _events(t)
        .groupBy("build_id", "build_date", "user_id")
        .agg(
            F.concat(F.min("event_type"), F.lit("-"), F.first("user_id").cast("string")).alias("build_name"),
            F.count(F.lit(1)).alias("total"),
            passed.alias("passed"),
            rounded(ratio(passed, F.count(F.lit(1))), 4).alias("pass_rate"),
        )
        .drop("user_id")
    )


def _failures(t: Tables) -> DataFrame:
    return _events(t).where(F.col("event_type") == "error").drop("user_id", "event_type")


def _ignored(t: Tables) -> DataFrame:
    tagged = monitoring.tag_ci_builds(_builds(t), "build_name", ("signup", "view"))
    return monitoring.ignored_builds(tagged, "build_id")


@query(
    _BUILDS
    + """SELECT build_id, total - CASE WHEN build_date < '2024-01-10' AND total > 0 THEN 1 ELSE 0 END AS total,
      passed, total - passed AS not_passed,
      coalesce(round((passed / nullif(total - CASE WHEN build_date < '2024-01-10' AND total > 0 THEN 1 ELSE 0 END, 0))::DECIMAL(28,10), 4)::DOUBLE, 0) AS pass_rate
    FROM bd"""
)
def build_pass_rate(t):
    zero = F.lit(0).cast("long")
    rows = _builds(t).drop("pass_rate").withColumns(
        {c: zero for c in ("in_progress", "incomplete", "testfix", "blocked", "untested")}
    ).withColumn("failed", F.col("total") - F.col("passed"))
    out = monitoring.build_pass_rate(rows, "2024-01-10")
    return out.select(
        "build_id", "total", "passed", "not_passed", rounded("pass_rate", 4).alias("pass_rate")
    )


@query(
    _BUILDS
    + """SELECT build_id, build_name, CASE WHEN build_id IN (SELECT build_id FROM ci) THEN 'CI' END AS comment FROM bd"""
)
def tag_ci_builds(t):
    return monitoring.tag_ci_builds(_builds(t), "build_name", ("signup", "view")).select(
        "build_id", "build_name", "comment"
    )


@query(
    _BUILDS
    + """SELECT ev.build_id, case_name, CASE WHEN ci.build_id IS NOT NULL THEN 'CI' END AS ignore_build, count(*) AS n
    FROM ev LEFT JOIN ci ON ci.build_id = ev.build_id WHERE event_type = 'error' GROUP BY ALL"""
)
def propagate_tags(t):
    return (
        monitoring.propagate_tags(_failures(t), _ignored(t), "build_id")
        .groupBy("build_id", "case_name", "ignore_build")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    _BUILDS
    + """SELECT strftime(date_trunc('week', build_date), '%Y-%m-%d') AS week_of,
      count(DISTINCT build_id) FILTER (WHERE pass_rate < 1) AS failed_builds, count(DISTINCT build_id) AS total_builds,
      round(((count(DISTINCT build_id) - count(DISTINCT build_id) FILTER (WHERE pass_rate < 1)) / count(DISTINCT build_id))::DECIMAL(28,10), 4)::DOUBLE AS pass_rate
    FROM ok GROUP BY 1"""
)
def weekly_pass_rate(t):
    return monitoring.weekly_build_pass_rate(
        _builds(t), "build_id", "build_date", "pass_rate", _ignored(t)
    ).withColumn("week_of", F.col("week_of").cast("string"))


@query(
    _BUILDS
    + """, w AS (SELECT date_trunc('week', build_date) AS wk, count(DISTINCT build_id) AS total_builds FROM ok GROUP BY 1),
    f AS (SELECT case_name, date_trunc('week', build_date) AS wk, count(DISTINCT build_id) AS failures FROM fl GROUP BY 1, 2)
    SELECT strftime(wk, '%Y-%m-%d') AS week_of, case_name, failures, total_builds,
      round((failures / total_builds)::DECIMAL(28,10), 4)::DOUBLE AS failure_rate FROM f JOIN w USING (wk)"""
)
def case_failure_by_week(t):
    return monitoring.case_failure_rate_by_week(
        _builds(t), _failures(t), "build_id", "case_name", "build_date", _ignored(t)
    ).withColumn("week_of", F.col("week_of").cast("string"))


@query(
    _BUILDS
    + """, b AS (SELECT CASE WHEN build_date >= '2024-01-15' THEN 'Post-Change' ELSE 'Pre-Change' END AS era,
         count(DISTINCT build_id) AS total_builds FROM ok GROUP BY 1),
    f AS (SELECT case_name, CASE WHEN build_date >= '2024-01-15' THEN 'Post-Change' ELSE 'Pre-Change' END AS era,
         count(DISTINCT build_id) AS n FROM fl GROUP BY 1, 2)
    SELECT b.era, c.case_name, coalesce(n, 0) AS failures, total_builds, round((coalesce(n, 0) / total_builds)::DECIMAL(28,10), 4)::DOUBLE AS failure_rate
    FROM (SELECT DISTINCT case_name FROM fl) c, b LEFT JOIN f ON f.case_name = c.case_name AND f.era = b.era"""
)
def case_failure_by_era(t):
    return monitoring.case_failure_rate_by_era(
        _builds(t), _failures(t), "build_id", "case_name", "build_date", "2024-01-15", _ignored(t)
    )


@query(
    _BUILDS
    + """, todo AS (SELECT build_id, build_date FROM bd WHERE pass_rate < 1 AND build_date >= '2024-01-08'),
    k AS (SELECT build_id, case_name FROM ev WHERE event_type = 'error' AND case_name NOT LIKE 'case-9%')
    SELECT todo.build_id, strftime(todo.build_date, '%Y-%m-%d') AS build_date,
      coalesce(case_name, 'No failed items (or filtered out)') AS case_name, count(*) AS n
    FROM todo LEFT JOIN k ON k.build_id = todo.build_id GROUP BY ALL"""
)
def new_failed_tests(t):
    """Builds before the second week are listed already."""
    builds = _builds(t)
    known = builds.where(F.col("build_date") < F.to_date(F.lit("2024-01-08")))
    out = monitoring.new_failed_tests(
        builds, _failures(t), "build_id", "case_name", "pass_rate",
        F.col("case_name").startswith("case-9"), known,
    )
    return out.groupBy(
        "build_id", F.col("build_date").cast("string").alias("build_date"), "case_name"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    _BUILDS
    + """SELECT build_id, strftime(build_date, '%Y-%m-%d') AS build_date, pass_rate,
      CASE WHEN pass_rate >= 1 THEN 'PASS' ELSE '' END AS comment FROM bd
    WHERE build_date >= '2024-01-10' AND build_id NOT IN (SELECT build_id FROM ci)"""
)
def build_timeline(t):
    out = monitoring.build_timeline(
        _builds(t), "2024-01-10", "build_id", "build_date", "pass_rate", _ignored(t)
    )
    return out.select(
        "build_id", F.col("build_date").cast("string").alias("build_date"), "pass_rate", "comment"
    )
