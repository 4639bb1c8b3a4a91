"""Failure rates, co-failure pairs and test quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.stats import ratio, rounded
from shiplens.lineage import cut_lineage, tasks_for
from shiplens.operators.joins import null_safe_join
from shiplens.operators.overlap import shared_unit_pairs
from shiplens.operators.packing import numbered

# Error texts of infrastructure failures, matched without case.
NOISE_PATTERNS = (
    "Failed prior to running test%",
    "%Failed to run test on CI%",
    "The build failed prior to running the test%",
    "%timed out after 2 hours%",
    "%Unable to synchronize with local Git mirror%",
    "%test failed to compile successfully%",
)
# Case types that compile or package and do not test a component.
NON_TEST_TYPES = (
    "Batch",
    "Modules Compile Test",
    "Modules Integration AWS Test",
    "Modules Semantic Versioning Test",
    "Release OSGI State Test",
    "Semantic Versioning Test",
    "LPKG Test",
)
# Components left out of test statistics, and statuses counted as failures.
EXCLUDED_COMPONENTS = ("A/B Test", "License", "Smoke")
FAILURE_STATUSES = ("FAILED", "BLOCKED", "UNTESTED", "TESTFIX")


def not_noise(errors: Column, patterns=NOISE_PATTERNS) -> Column:
    """True where the error is null or matches none of the noise patterns."""
    noisy = F.lit(False)
    for p in patterns:
        noisy = noisy | errors.ilike(p)
    return errors.isNull() | ~noisy


def scoped_failures(
    results: DataFrame,
    since,
    routines=None,
    case_types=NON_TEST_TYPES,
    status="FAILED",
) -> DataFrame:
    """Failures that count for co-failure: routine, date, case type and noise filters.

    A null case type drops out, as under SQL ``NOT IN``.
    """
    rows = results.where(
        (F.col("status") == status)
        & (F.col("start_date") >= since)
        & ~F.col("case_type").isin(*case_types)
        & not_noise(F.col("errors"))
    )
    return rows.where(F.col("routine_name").isin(*routines)) if routines else rows


def without_components(results: DataFrame, component: str, excluded=EXCLUDED_COMPONENTS):
    """Drops listed components; a null component stays."""
    return results.where(~F.coalesce(F.col(component).isin(*excluded), F.lit(False)))


def failure_and_cofailure_rate(
    results: DataFrame, unit: str, component: str, failed: Column, flaky: Column | None = None
) -> DataFrame:
    """Failure rate and share of failing units in which another component failed too."""
    flaky = F.lit(False) if flaky is None else flaky
    stats = results.groupBy(component).agg(
        F.count(F.lit(1)).alias("test_run_count"),
        F.sum(F.when(failed, 1).otherwise(0)).alias("failure_count"),
        F.sum(F.when(flaky, 1).otherwise(0)).alias("flaky_count"),
    )
    failing = results.where(failed).select(unit, component).distinct()
    per_unit = failing.groupBy(unit).agg(F.count(F.lit(1)).alias("_n"))
    co = (
        null_safe_join(failing, per_unit, [unit], "inner")
        .groupBy(component)
        .agg(
            F.count(F.lit(1)).alias("builds_with_failures"),
            F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).alias("builds_with_co_failures"),
        )
    )
    zero = F.lit(0).cast("long")
    return (
        null_safe_join(stats, co, [component])
        .withColumns(
            {
                "failure_rate": rounded(ratio(F.col("failure_count"), F.col("test_run_count")), 4),
                "builds_with_failures": F.coalesce("builds_with_failures", zero),
                "builds_with_co_failures": F.coalesce("builds_with_co_failures", zero),
            }
        )
        .withColumn(
            "co_failure_score",
            F.coalesce(
                rounded(
                    ratio(F.col("builds_with_co_failures"), F.col("builds_with_failures")), 4
                ),
                F.lit(0.0),
            ),
        )
    )


def to_module_grain(
    stats: DataFrame, crosswalk: DataFrame, component: str, module: str
) -> DataFrame:
    """Component statistics per module: sums, ratio of sums, mean of scores."""
    joined = null_safe_join(stats, crosswalk.select(component, module).distinct(), [component], "inner")
    return joined.groupBy(module).agg(
        F.min(component).alias("component_name"),
        F.sum("test_run_count").alias("test_run_count"),
        F.sum("failure_count").alias("failure_count"),
        rounded(ratio(F.sum("failure_count"), F.sum("test_run_count")), 4).alias("failure_rate"),
        rounded(F.avg("co_failure_score"), 4).alias("co_failure_score"),
    )


def cofailure_pairs(
    failures: DataFrame,
    unit: str,
    item: str,
    group: str,
    min_units: int = 10,
    min_pairs: int = 10,
    min_item_pairs: int = 5,
    hot_units: int = 20_000,
) -> DataFrame:
    """Group pairs that fail together, scored by the mean Jaccard index of their item pairs.

    A group pair needs ``min_units`` shared units, an item pair ``min_pairs``, and a group
    pair at least ``min_item_pairs`` item pairs. An item's failure count is global, so
    each Jaccard stays in [0, 1] even if an item belongs to several groups.
    """
    everything = cut_lineage(failures.select(unit, item, group).distinct())
    rows = everything.where(F.col(group).isNotNull())
    total = everything.select(F.count_distinct(unit)).scalar()
    groups = rows.select(unit, group).distinct()
    group_freq = groups.groupBy(group).agg(F.count(F.lit(1)).alias("_units"))
    pairs = cut_lineage(
        shared_unit_pairs(groups, unit, group, min_units, hot_units=hot_units).withColumnRenamed(
            "shared", "co_fail_builds"
        )
    )
    ga, gb = f"{group}_a", f"{group}_b"

    # Only groups in some qualifying pair can add item pairs.
    used = pairs.select(F.explode(F.array(ga, gb)).alias(group)).distinct()
    members = rows.join(used, group, "left_semi")
    item_freq = (
        everything.select(unit, item).distinct().groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    )
    # An item is numbered together with its group, as it may sit in two. Items of one group and
    # frequency are one class, and a class can be read off its items' numbers, so that pairs need
    # no look-up of their ends: they are counted by class first.
    listed = cut_lineage(
        numbered(members.select(item, group).distinct().join(item_freq, item), [group, "_n", item], "_place")
    )
    count = max(listed.count(), 1)
    classes = cut_lineage(numbered(listed.select(group, "_n").distinct(), [group, "_n"], "_class"))
    numbers = cut_lineage(
        listed.join(classes, [group, "_n"]).select(item, group, (F.col("_class") * count + F.col("_place")).alias("member"))
    )
    placed = members.join(numbers.hint("merge"), [item, group])
    item_pairs = shared_unit_pairs(
        cut_lineage(placed.select(unit, "member", group)), unit, "member", min_pairs, side=group, hot_units=hot_units
    )

    def end(suffix):
        return classes.select(
            F.col("_class").alias(f"_class_{suffix}"),
            F.col(group).alias(f"{group}_{suffix}"),
            F.col("_n").alias(f"_n{suffix}"),
        )

    jaccard = rounded(
        ratio(F.col("shared"), F.col("_na") + F.col("_nb") - F.col("shared")), 4
    )
    # Exact in longs, unlike a quotient of doubles.
    class_of = {f"_class_{x}": F.expr(f"member_{x} div {count}") for x in "ab"}
    final = (
        item_pairs.withColumns(class_of)
        .groupBy("_class_a", "_class_b", "shared")
        .agg(F.count(F.lit(1)).alias("_pairs"))
        .join(end("a"), "_class_a")
        .join(end("b"), "_class_b")
        .groupBy(ga, gb)
        .agg(
            rounded(F.sum(jaccard * F.col("_pairs")) / F.sum("_pairs"), 4).alias("jaccard_score"),
            F.sum(F.col("shared") * F.col("_pairs")).alias("co_fail_count"),
            F.sum("_pairs").alias("test_pair_count"),
        )
        .where(F.col("test_pair_count") >= min_item_pairs)
        .join(pairs, [ga, gb])
    )

    def freq(side, suffix):
        return group_freq.select(
            F.col(group).alias(side),
            F.col("_units").alias(f"fail_count_{suffix}"),
            rounded(ratio(F.col("_units"), total), 4).alias(f"fail_rate_{suffix}"),
        )

    return (
        final.join(freq(ga, "a"), ga)
        .join(freq(gb, "b"), gb)
        .select(
            F.col(ga).alias("component_a"),
            F.col(gb).alias("component_b"),
            "co_fail_builds",
            "jaccard_score",
            "co_fail_count",
            "test_pair_count",
            "fail_count_a",
            "fail_count_b",
            "fail_rate_a",
            "fail_rate_b",
            rounded(ratio(F.col("co_fail_builds"), total), 4).alias("co_fail_rate"),
        )
    )


def item_quality_chronic(
    failures: DataFrame,
    unit: str,
    item: str,
    attributes: list[str],
    component: str,
    issue: str,
    date: str,
    min_units: int = 10,
) -> DataFrame:
    """Investigation rate and damped signal per item over its failing units.

    Maxima in the signal run over all items before the ``min_units`` filter; an item in
    several components is reported under its newest one, with its best-covered row.
    """
    linked = F.col(issue).isNotNull() & (F.length(issue) > 0)
    # Units and issues are told apart first and counted then, each step combined before its shuffle.
    names = F.array(
        F.struct(F.lit(True).alias("is_unit"), F.col(unit).cast("string").alias("name"), linked.alias("linked")),
        F.struct(F.lit(False).alias("is_unit"), F.when(linked, F.col(issue).cast("string")).alias("name"), linked.alias("linked")),
    )
    keys = [item, *attributes, component]
    apart = failures.select(*keys, F.explode(names).alias("_n")).where(F.col("_n.name").isNotNull())
    apart = apart.groupBy(*keys, F.col("_n.is_unit").alias("_u"), F.col("_n.name").alias("_name")).agg(F.bool_or("_n.linked").alias("_l"))
    stats = cut_lineage(
        apart.groupBy(*keys).agg(
            F.count_if(F.col("_u")).alias("total_fail_builds"),
            F.count_if(F.col("_u") & F.col("_l")).alias("bug_linked_builds"),
            F.count_if(~F.col("_u")).alias("distinct_bugs_linked"),
        )
    )
    most = stats.agg(F.greatest(F.max("bug_linked_builds"), F.lit(1)), F.greatest(F.max("total_fail_builds"), F.lit(1))).first()
    max_linked, max_fail = F.lit(most[0]), F.lit(most[1])
    scored = stats.withColumn(
        "investigation_rate",
        rounded(ratio(F.col("bug_linked_builds"), F.col("total_fail_builds")), 4),
    ).withColumn(
        "signal_score",
        rounded(
            (
                F.col("investigation_rate") * 0.70
                + F.least(ratio(F.col("bug_linked_builds"), max_linked), F.lit(1.0)) * 0.30
            )
            * (1 - F.sqrt("total_fail_builds") / F.sqrt(max_fail)),
            4,
        ),
    )
    kept = scored.where(F.col("total_fail_builds") >= min_units)
    best = kept.groupBy(item).agg(
        F.max_by(
            F.struct(*[c for c in kept.columns if c not in (item, component)]),
            F.struct("total_fail_builds", component, *attributes),
        ).alias("_r")
    )
    newest = failures.groupBy(item).agg(
        F.max_by(component, F.struct(date, component)).alias(component)
    )
    return best.join(newest, item).select(item, component, "_r.*")


def item_quality_windowed(
    results: DataFrame,
    item: str,
    routine: str,
    window: str,
    unit: str,
    attributes: list[str],
    failed: Column,
    issue: str,
    order: list[str],
    min_pass_rate: float = 0.60,
) -> DataFrame:
    """Quality per item, routine and window; windows under the pass-rate gate are dropped.

    Failures count result rows, not units, as the source data model does. The first value
    of each attribute is taken along ``order``.
    """
    linked = failed & F.col(issue).isNotNull() & (F.length(F.trim(issue)) > 0)
    keys = [item, routine, window]
    # One row per unit first, so that units are counted without a distinct aggregate.
    per_unit = _dealt(results, item, unit).groupBy(*keys, unit).agg(
        F.min(F.struct(*order, *[c for c in attributes if c not in order])).alias("_first"),
        F.sum(F.when(failed, 1).otherwise(0)).alias("_failed"),
        F.sum(F.when(linked, 1).otherwise(0)).alias("_linked"),
    )
    stats = per_unit.groupBy(*keys).agg(
        F.min("_first").alias("_first"),
        F.count(unit).alias("total_builds"),
        F.sum("_failed").alias("total_fail_builds"),
        F.sum("_linked").alias("bug_linked_builds"),
    )
    issues = (
        results.where(linked)
        .groupBy(*keys)
        .agg(F.count_distinct(issue).alias("distinct_bugs_linked"))
    )
    stats = null_safe_join(stats, issues, keys).select(
        *keys,
        *[F.col(f"_first.{c}").alias(c) for c in attributes],
        "total_builds",
        "total_fail_builds",
        "bug_linked_builds",
        F.coalesce("distinct_bugs_linked", F.lit(0).cast("long")).alias("distinct_bugs_linked"),
    )
    rate = F.coalesce(
        rounded(ratio(F.col("bug_linked_builds"), F.col("total_fail_builds")), 4), F.lit(0.0)
    )
    scored = stats.withColumn("investigation_rate", rate).withColumn(
        "signal_score",
        rounded(
            F.col("investigation_rate")
            * ratio(F.col("total_fail_builds"), F.greatest(F.col("total_builds"), F.lit(1))),
            4,
        ),
    )
    bad = window_pass_rates(results, item, routine, window, unit, failed).where(F.col("window_pass_rate") < min_pass_rate)
    return null_safe_join(scored, bad.select(routine, window), [routine, window], "left_anti")


def _dealt(results: DataFrame, item: str, unit: str) -> DataFrame:
    """Rows dealt by item and unit before they are grouped by both: nearly every row is a group of
    its own, so a task's memory goes with its rows and adding up before the shuffle saves nothing."""
    return results.repartition(tasks_for(results.count()), item, unit)


def window_pass_rates(
    results: DataFrame, item: str, routine: str, window: str, unit: str, failed: Column
) -> DataFrame:
    """``window_pass_rate`` of each routine x window: the share of its items' units less its failed rows.

    Failures count rows, so a rate may be negative. Null items, routines and windows are values like
    others; a null unit is none.
    """
    per_unit = _dealt(results, item, unit).groupBy(item, routine, window, unit).agg(
        F.sum(F.when(failed, 1).otherwise(0)).alias("_failed")
    )
    builds = F.count(unit)
    rate = ratio(builds - F.sum("_failed"), F.greatest(builds, F.lit(1)))
    return per_unit.groupBy(routine, window).agg(rate.alias("window_pass_rate"))


def low_pass_windows(
    quality: DataFrame, routine: str, window: str, min_pass_rate: float = 0.60
) -> DataFrame:
    """Routine x window combinations whose pass rate is below the gate."""
    builds = F.sum("total_builds")
    rate = ratio(builds - F.sum("total_fail_builds"), F.greatest(builds, F.lit(1)))
    return (
        quality.groupBy(routine, window)
        .agg(rate.alias("window_pass_rate"))
        .where(F.col("window_pass_rate") < min_pass_rate)
    )


def clean_builds(
    results: DataFrame,
    build: str,
    routine: str,
    date: str,
    passed: Column,
    promoted: Column,
    gated_routines,
    promoted_routines,
    min_pass_rate: float = 0.50,
) -> DataFrame:
    """Builds that may be scored: good enough on gated routines, promoted on the others."""
    gated = (
        results.where(F.col(routine).isin(*gated_routines))
        .groupBy(build, routine)
        .agg(
            F.min(date).alias(date),
            ratio(F.sum(F.when(passed, 1).otherwise(0)), F.count(F.lit(1))).alias("_rate"),
        )
        .where(F.col("_rate") >= min_pass_rate)
        .select(build, routine, date)
    )
    shipped = (
        results.where(F.col(routine).isin(*promoted_routines) & promoted)
        .select(build, routine, date)
        .distinct()
    )
    return gated.unionByName(shipped)


def test_health(quality: DataFrame, keys: list[str], item: str, component: str | None = None):
    """Test effectiveness per component or team and case type."""
    zero = F.sum(F.when(F.col("investigation_rate") == 0, 1).otherwise(0))
    aggs = [
        F.count_distinct(item).alias("n_test_cases"),
        F.sum("total_fail_builds").alias("total_failures"),
        F.sum("bug_linked_builds").alias("bug_linked_failures"),
        F.sum("distinct_bugs_linked").alias("distinct_bugs_linked"),
        rounded(F.avg("investigation_rate"), 4).alias("avg_investigation_rate"),
        rounded(F.avg("signal_score"), 4).alias("avg_signal_score"),
        F.coalesce(
            rounded(ratio(F.sum("bug_linked_builds"), F.sum("total_fail_builds")), 4), F.lit(0.0)
        ).alias("bug_link_rate"),
        F.sum(F.when(F.col("signal_score") > 0.1, 1).otherwise(0)).alias("high_signal_tests"),
        zero.alias("zero_catch_tests"),
        rounded(ratio(zero, F.count_distinct(item)) * 100, 1).alias("pct_zero_catch"),
    ]
    if component:
        aggs.append(F.count_distinct(component).alias("n_components"))
    return quality.groupBy(*keys).agg(*aggs)
