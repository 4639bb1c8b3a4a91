"""Build pass rates, failure rates by era and week, build tagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.stats import ratio, rounded
from shiplens.operators.periods import week_start

# Counts that are no pass.
STATUS_COUNTS = ("in_progress", "incomplete", "testfix", "blocked", "untested", "failed")


def build_pass_rate(builds: DataFrame, fixed_on=None, date: str = "build_date") -> DataFrame:
    """not_passed and pass_rate per build; counters before ``fixed_on`` are one too high."""
    out = builds
    if fixed_on is not None:
        early = F.col(date) < F.lit(fixed_on)
        for c in ("untested", "total"):
            out = out.withColumn(
                c, F.when(early, F.greatest(F.col(c) - 1, F.lit(0))).otherwise(F.col(c))
            )
    missed = F.lit(0)
    for c in STATUS_COUNTS:
        missed = missed + F.coalesce(F.col(c), F.lit(0))
    return out.withColumn("not_passed", missed).withColumn(
        "pass_rate", F.coalesce(ratio(F.col("passed"), F.col("total")), F.lit(0.0))
    )


def tag_ci_builds(builds: DataFrame, name: str, marks=("PR", "Acceptance")) -> DataFrame:
    """``comment`` becomes CI where the build name holds one of the marks."""
    hit = F.lit(False)
    for m in marks:
        hit = hit | F.col(name).contains(m)
    old = F.col("comment") if "comment" in builds.columns else F.lit(None).cast("string")
    return builds.withColumn("comment", F.when(hit, "CI").otherwise(old))


def ignored_builds(timeline: DataFrame, build: str) -> DataFrame:
    """Builds whose comment mentions CI in any case."""
    return timeline.where(F.upper("comment").contains("CI")).select(build).distinct()


def propagate_tags(rows: DataFrame, ignored: DataFrame, build: str) -> DataFrame:
    """Stamps every table that carries the build: ``ignore_build`` is CI or null."""
    marks = ignored.select(build).distinct().withColumn("ignore_build", F.lit("CI"))
    return rows.drop("ignore_build").join(marks, build, "left")


def without_builds(rows: DataFrame, ignored: DataFrame | None, build: str) -> DataFrame:
    return rows if ignored is None else rows.join(ignored.select(build), build, "left_anti")


def failure_rate_by(
    builds: DataFrame,
    failures: DataFrame,
    build: str,
    case: str,
    bucket_builds: Column,
    bucket_failures: Column,
    bucket: str,
    ignored: DataFrame | None = None,
    every_bucket: bool = False,
) -> DataFrame:
    """Distinct failing builds over distinct builds per case and bucket.

    With ``every_bucket`` a case seen in any bucket gets a row, maybe zero, in each one
    that has builds.
    """
    total = (
        without_builds(builds, ignored, build)
        .where(F.col(build).isNotNull() & bucket_builds.isNotNull())
        .groupBy(bucket_builds.alias(bucket))
        .agg(F.count_distinct(build).alias("total_builds"))
    )
    failed = (
        without_builds(failures, ignored, build)
        .where(F.col(build).isNotNull() & bucket_failures.isNotNull())
        .groupBy(F.col(case), bucket_failures.alias(bucket))
        .agg(F.count_distinct(build).alias("failures"))
    )
    if every_bucket:
        # Buckets are two or three eras: their list rides along as one small array.
        eras = total.agg(F.collect_set(bucket)).scalar()
        grid = failed.select(case).distinct().withColumn(bucket, F.explode(eras))
        failed = grid.join(failed, [case, bucket], "left").withColumn(
            "failures", F.coalesce("failures", F.lit(0).cast("long"))
        )
    return failed.join(total, bucket).withColumn(
        "failure_rate", rounded(ratio(F.col("failures"), F.col("total_builds")), 4)
    )


def case_failure_rate_by_era(builds, failures, build, case, date, change_date, ignored=None):
    """Failure rate per case before and after a process change."""
    era = F.when(F.to_date(date) >= F.to_date(F.lit(change_date)), "Post-Change").otherwise(
        "Pre-Change"
    )
    return failure_rate_by(
        builds, failures, build, case, era, era, "era", ignored, every_bucket=True
    )


def case_failure_rate_by_week(builds, failures, build, case, date, ignored=None):
    """Failure rate per case and week (Monday)."""
    week = week_start(F.col(date))
    return failure_rate_by(builds, failures, build, case, week, week, "week_of", ignored)


def weekly_build_pass_rate(
    builds: DataFrame, build: str, date: str, pass_rate: str, ignored: DataFrame | None = None
) -> DataFrame:
    """Distinct failed and all builds per week, and the share that passed."""
    rows = without_builds(builds, ignored, build).where(
        F.col(build).isNotNull() & F.col(date).isNotNull()
    )
    return (
        rows.groupBy(week_start(F.col(date)).alias("week_of"))
        .agg(
            F.count_distinct(F.when(F.col(pass_rate) < 1, F.col(build))).alias("failed_builds"),
            F.count_distinct(build).alias("total_builds"),
        )
        .withColumn(
            "pass_rate",
            rounded(
                ratio(F.col("total_builds") - F.col("failed_builds"), F.col("total_builds")), 4
            ),
        )
    )


# Fixed value: what stands for an empty list.
PLACEHOLDER = "No failed items (or filtered out)"


def new_failed_tests(
    builds: DataFrame,
    failures: DataFrame,
    build: str,
    case: str,
    pass_rate: str,
    ignored_names: Column,
    known: DataFrame | None = None,
) -> DataFrame:
    """Failures of builds below 100 % not yet listed; a placeholder row where none is left."""
    todo = builds.where(F.col(pass_rate) < 1).select(build, "build_date").distinct()
    if known is not None:
        todo = todo.join(known.select(build), build, "left_anti")
    kept = failures.where(~ignored_names).select(
        build, *[c for c in failures.columns if c not in (build, "build_date")]
    )
    return todo.join(kept, build, "left").withColumn(
        case, F.coalesce(F.col(case), F.lit(PLACEHOLDER))
    )


def build_timeline(
    builds: DataFrame, since, build: str, date: str, pass_rate: str, known: DataFrame | None = None
) -> DataFrame:
    """Builds since a date that the timeline lacks, commented PASS at a full pass rate."""
    rows = builds.where(F.col(date).isNotNull() & (F.to_date(date) >= F.to_date(F.lit(since))))
    if known is not None:
        rows = rows.join(known.select(build), build, "left_anti")
    return rows.withColumn("comment", F.when(F.col(pass_rate) >= 1, "PASS").otherwise(""))
