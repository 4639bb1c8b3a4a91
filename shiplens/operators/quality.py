"""Data-quality checks: each returns the violating rows or one row of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.stats import ratio, rounded

# Allowed words in releases and verdicts.
RELEASE_STATUSES = ("RELEASED", "BRANCH_CUT", "IN_DEVELOPMENT")
CLASSIFICATIONS = ("BUG", "NEEDS_REVIEW", "FALSE_POSITIVE")
CONFIDENCES = ("high", "medium", "low")


class QualityError(ValueError):
    """A check that must hold did not."""


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def rule_violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row per (key, broken rule); a rule is a column that is true on violation."""
    names = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]),
        lambda x: x.isNotNull(),
    )
    return df.select(key, F.explode(names).alias("rule"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def release_violations(releases: DataFrame, statuses=RELEASE_STATUSES) -> DataFrame:
    """Required fields, status words and duplicate labels of a release registry."""
    status = F.upper(F.trim("release_status"))
    rules = {
        "label is required": blank(F.col("release_label")),
        "quarter_label is required": blank(F.col("quarter_label")),
        "git_tag is required": F.col("git_tag").isNull(),
        "is_major_release is required": F.col("is_major_release").isNull(),
        "status is unknown": status.isNull() | ~status.isin(*statuses),
    }
    twice = duplicate_keys(releases, ["release_label"]).select(
        "release_label", F.lit("label is duplicated").alias("rule")
    )
    return rule_violations(releases, "release_label", rules).unionByName(twice)


def releases_needing_attention(releases: DataFrame) -> DataFrame:
    """Released without a date, or released / cut without a tag."""
    status = F.col("release_status")
    no_tag = F.col("git_tag").isNull() | (F.col("git_tag") == "")
    return releases.where(
        ((status == "RELEASED") & F.col("release_date").isNull())
        | (status.isin("RELEASED", "BRANCH_CUT") & no_tag)
    )


def unmatched_keys(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Keys with no entry in the lookup, and how many rows carry each."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(known.select(F.col(known_key).alias(key)), key, "left_anti")


def coverage(df: DataFrame, present: Column) -> DataFrame:
    """Rows, covered rows and percent covered, as one row."""
    n = F.count(F.lit(1))
    hit = F.sum(F.when(present, 1).otherwise(0))
    return df.agg(
        n.alias("n_rows"),
        F.coalesce(hit, F.lit(0)).alias("n_covered"),
        rounded(ratio(hit, n) * 100, 2).alias("coverage_pct"),
    )


def require_coverage(df: DataFrame, present: Column, at_least: float = 95.0) -> None:
    pct = coverage(df, present).first()["coverage_pct"]
    if pct is None or pct < at_least:
        raise QualityError(f"coverage {pct}% is below {at_least}%")


def require_row_ceiling(df: DataFrame, limit: int) -> int:
    n = df.count()
    if n >= limit:
        raise QualityError(f"{n} rows, expected fewer than {limit}")
    return n


def periods_without_counts(facts: DataFrame, period: str, counts: list[str]) -> DataFrame:
    """Periods in which every count sums to zero."""
    sums = facts.groupBy(period).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    zero = F.lit(True)
    for c in counts:
        zero = zero & (F.col(c) == 0)
    return sums.where(zero)


def unresolved_with_files(modules: DataFrame, files: DataFrame, key: str, column: str) -> DataFrame:
    """Modules that own files but have no value in ``column``."""
    counts = files.groupBy(key).agg(F.count(F.lit(1)).alias("file_count"))
    return modules.where(F.col(column).isNull()).select(key).join(counts, key)


def verdict_violations(
    verdicts: DataFrame, expected: DataFrame, case_id: str = "case_id"
) -> DataFrame:
    """Broken rules of a verdict table against the cases that were to be classified."""
    cls = F.col("classification")
    rules = {
        "classification is unknown": cls.isNull() | ~cls.isin(*CLASSIFICATIONS),
        "confidence is unknown": F.col("confidence").isNull()
        | ~F.col("confidence").isin(*CONFIDENCES),
        "reason is empty": blank(F.col("reason")),
        "BUG without culprit_file": (cls == "BUG") & blank(F.col("culprit_file")),
    }
    broken = rule_violations(verdicts, case_id, rules)
    twice = duplicate_keys(verdicts, [case_id]).select(
        case_id, F.lit("case is duplicated").alias("rule")
    )
    ids = expected.select(case_id).distinct()
    fabricated = (
        verdicts.select(case_id)
        .distinct()
        .join(ids, case_id, "left_anti")
        .withColumn("rule", F.lit("case is not in the run"))
    )
    missing = ids.join(verdicts.select(case_id), case_id, "left_anti").withColumn(
        "rule", F.lit("case has no verdict")
    )
    return broken.unionByName(twice).unionByName(fabricated).unionByName(missing)


def grouped_verdict_violations(
    verdicts: DataFrame, expected: DataFrame, all_cases: DataFrame, group: str, case_ids: str
) -> DataFrame:
    """Rules for verdicts given per group with a list of member cases."""
    named = verdicts.where(F.col(group).isNotNull())
    twice = duplicate_keys(named, [group]).select(
        F.col(group).cast("string").alias("key"), F.lit("group is duplicated").alias("rule")
    )
    members = verdicts.select(group, F.explode(case_ids).alias("case_id"))
    empty = verdicts.where(F.coalesce(F.size(case_ids), F.lit(0)) <= 0).select(
        F.col(group).cast("string").alias("key"), F.lit("case list is empty").alias("rule")
    )
    fabricated = (
        members.join(all_cases.select("case_id"), "case_id", "left_anti")
        .select(F.col("case_id").cast("string").alias("key"))
        .distinct()
        .withColumn("rule", F.lit("case is not in the run"))
    )
    shared = duplicate_keys(
        members.join(expected.select("case_id").distinct(), "case_id", "left_semi"), ["case_id"]
    ).select(
        F.col("case_id").cast("string").alias("key"),
        F.lit("case has several verdicts").alias("rule"),
    )
    return twice.unionByName(empty).unionByName(fabricated).unionByName(shared)


def hash_mismatches(given: DataFrame, stored: DataFrame, key: str, column: str) -> DataFrame:
    """Builds whose given and stored commit hash differ."""
    other = stored.select(key, F.col(column).alias("stored"))
    return given.select(key, F.col(column).alias("given")).join(other, key).where(
        F.col("given").isNotNull() & (F.col("given") != F.col("stored"))
    )


def rows_without_match(target: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows with no baseline counterpart."""
    return target.join(baseline.select(*keys).dropna(), keys, "left_anti")


def routine_mismatches(pairs: DataFrame, builds: DataFrame, build: str, routine: str, left: str, right: str) -> DataFrame:
    """Compared builds that ran on different routines; a routine that is unknown is no mismatch."""
    one = builds.select(F.col(build).alias(left), F.col(routine).alias(f"{left}_routine"))
    two = builds.select(F.col(build).alias(right), F.col(routine).alias(f"{right}_routine"))
    return pairs.join(one, left).join(two, right).where(F.col(f"{left}_routine") != F.col(f"{right}_routine"))
