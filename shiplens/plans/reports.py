"""Report tables over component x quarter facts, issues and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.stats import (
    exact_percentile,
    percentile_of_counts,
    ratio,
    risk_level,
    share_of_total,
    with_percent_rank,
    with_z_scores,
    rounded,
)
from shiplens.lineage import cut_lineage
from shiplens.operators.bridge import top_with_ties
from shiplens.operators.joins import null_safe_join
from shiplens.operators.periods import months_in_field

HIST_WEIGHTS = (0.6, 0.4)


def releases_report(releases: DataFrame, as_of) -> DataFrame:
    """Release registry with months in the field."""
    return releases.withColumn("months_in_field", months_in_field(F.col("release_date"), as_of))


def baseline(facts: DataFrame, component: str, quarter: str, measures: dict[str, str], year: str):
    """Mean of measures per component over the quarters of a baseline year."""
    rows = facts.where(F.col(quarter).contains(year))
    return rows.groupBy(component).agg(*[F.avg(m).alias(n) for m, n in measures.items()])


def baseline_join(
    facts: DataFrame, base: DataFrame, component: str, measures: list[str], flag: str
) -> DataFrame:
    """Baseline means on the facts; components without one get the median and flag 0."""
    out = facts.join(base, component, "left").withColumn(
        flag, F.when(F.col(measures[0]).isNull(), 0).otherwise(1)
    )
    for m in measures:
        median = exact_percentile(base, [], m, 0.5, "q").scalar()
        out = out.withColumn(m, F.coalesce(F.col(m), median))
    return out


def forecast_frame(
    facts: DataFrame,
    component: str,
    quarter: str,
    customer: str,
    internal: str,
    backend: str,
    frontend: str,
    base_year: str,
) -> DataFrame:
    """Facts with baselines, a historical risk score (percent rank) and its band.

    The score blends the z-scores of the customer baseline (median where missing) and of
    log churn over the whole frame.
    """
    base = baseline(
        facts, component, quarter,
        {customer: "legacy_customer_avg", internal: "legacy_internal_avg"}, base_year,
    )
    rows = cut_lineage(facts.join(base, component, "left"))
    median = exact_percentile(rows, [], "legacy_customer_avg", 0.5, "q").scalar()
    rows = rows.withColumns(
        {
            "_level": F.coalesce("legacy_customer_avg", median),
            "_churn": F.log1p(backend) + 0.5 * F.log1p(frontend),
        }
    )
    rows = with_z_scores(rows, {"_zl": F.col("_level"), "_zc": F.col("_churn")})
    a, b = HIST_WEIGHTS
    # Rounded before ranking: sums of doubles must not split equal scores.
    rows = rows.withColumn("_score", rounded(F.col("_zl") * a + F.col("_zc") * b, 9))
    ranked = with_percent_rank(rows, "_score", "hist_score", digits=1)
    return ranked.withColumn("hist_risk_level", risk_level(F.col("hist_score"))).drop(
        "_level", "_churn", "_zl", "_zc", "_score"
    )


def churn_by_component(facts: DataFrame, components: DataFrame, releases: DataFrame) -> DataFrame:
    """Facts with component, team and release attributes."""
    return facts.join(components, "component").join(releases, "quarter")


def churn_by_team(facts: DataFrame, quarter: list[str], team: str, sums: list[str], churn: str):
    """Sums per quarter and team with the mean churn of a component."""
    return facts.where(F.col(team).isNotNull()).groupBy(*quarter, team).agg(
        F.count(F.lit(1)).alias("n_components"),
        *[rounded(F.coalesce(F.sum(c), F.lit(0.0)), 2).alias(f"total_{c}") for c in sums],
        rounded(F.avg(churn), 1).alias("avg_churn_per_comp"),
    )


def team_scorecard(
    facts: DataFrame,
    quarter: str,
    team: str,
    customer: str,
    internal: str,
    blocker: str,
    sums: list[str],
    risk: str,
    level: str,
) -> DataFrame:
    """Per quarter and team: sums, customer/internal ratio, blocker rate, high-risk count."""
    rows = facts.where(F.col(team).isNotNull())
    out = rows.groupBy(quarter, team).agg(
        F.count(F.lit(1)).alias("n_components"),
        F.coalesce(F.sum(customer), F.lit(0)).alias("customer_count"),
        F.coalesce(F.sum(internal), F.lit(0)).alias("internal_count"),
        F.coalesce(F.sum(blocker), F.lit(0)).alias("blocker_count"),
        *[rounded(F.coalesce(F.sum(c), F.lit(0.0)), 2).alias(f"total_{c}") for c in sums],
        rounded(F.avg(risk), 1).alias("avg_risk_score"),
        F.sum(F.when(F.col(level).isin("High", "Very High"), 1).otherwise(0)).alias("n_high_risk"),
    )
    some = F.col("internal_count") > 0
    return out.withColumn(
        "customer_internal_ratio",
        F.when(some, rounded(ratio(F.col("customer_count"), F.col("internal_count")), 2)),
    ).withColumn(
        "blocker_rate",
        F.when(some, rounded(ratio(F.col("blocker_count"), F.col("internal_count")) * 100, 1)).otherwise(0.0),
    )


# Severity words and their order.
SEVERITIES = ("Fire", "Critical", "High", "Medium", "Low")


def severity_label(source: Column, priority: Column, score: Column) -> Column:
    """Customer issues by priority word, internal ones by score 5..1, else Unknown."""
    by_score = F.lit("Unknown")
    for i, name in enumerate(SEVERITIES):
        by_score = F.when(score == 5 - i, name).otherwise(by_score)
    return F.when(source == "customer", F.coalesce(priority, F.lit("Unknown"))).otherwise(by_score)


def severity_order(label: Column) -> Column:
    out = F.lit(len(SEVERITIES) + 1)
    for i, name in enumerate(SEVERITIES):
        out = F.when(label == name, i + 1).otherwise(out)
    return out


def severity_distribution(issues: DataFrame, source: str, quarter: str, label: str) -> DataFrame:
    """Count and percent per source, quarter and severity."""
    counts = issues.groupBy(source, quarter, label).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, [source, quarter], "n", "pct", 1).withColumn(
        "severity_order", severity_order(F.col(label))
    )


def discovery_timing(
    issues: DataFrame,
    quarter: str,
    component: str,
    source: str,
    date: str,
    customer="customer",
    internal="internal",
) -> DataFrame:
    """First customer and internal report per quarter and component, and their distance.

    ``days_diff`` is customer minus internal: positive means internal testing came first.
    """

    def first(value, name):
        hit = F.col(source) == value
        return [
            F.min(F.when(hit, F.to_date(date))).alias(f"first_{name}_date"),
            F.sum(F.when(hit, 1).otherwise(0)).alias(f"{name}_count"),
        ]

    both = (
        issues.groupBy(quarter, component)
        .agg(*first(customer, "customer"), *first(internal, "internal"))
        .where((F.col("customer_count") > 0) & (F.col("internal_count") > 0))
    )
    diff = F.datediff("first_customer_date", "first_internal_date")
    return both.withColumn("days_diff", diff).withColumn(
        "found_first_by",
        F.when(F.col("days_diff") > 0, "Internal")
        .when(F.col("days_diff") < 0, "Customer")
        .otherwise("Same day"),
    )


def discovery_summary(timing: DataFrame, quarter: str) -> DataFrame:
    """Per quarter: components, share internal first, mean and median distance in days."""
    caught = F.when(F.col("days_diff") >= 0, 1.0).otherwise(0.0)
    stats = timing.groupBy(quarter).agg(
        F.count(F.lit(1)).alias("n_components"),
        rounded(F.avg(caught) * 100, 1).alias("pct_internal_first"),
        rounded(F.avg("days_diff"), 1).alias("avg_days_diff"),
    )
    median = percentile_of_counts(timing, [quarter], "days_diff", 0.5, "median_days_diff")
    return null_safe_join(stats, median, [quarter])


def min_max_scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column on 0..1 over the whole frame; 0 where it is flat."""
    lo_hi = df.agg(
        F.struct(
            *[F.min(c).alias(f"lo_{c}") for c in columns],
            *[F.max(c).alias(f"hi_{c}") for c in columns],
        ).alias("s")
    ).scalar()
    return df.withColumns(
        {
            c: F.when(
                F.col(c).isNotNull(),
                F.coalesce(
                    ratio(F.col(c) - lo_hi[f"lo_{c}"], lo_hi[f"hi_{c}"] - lo_hi[f"lo_{c}"]),
                    F.lit(0.0),
                ),
            )
            for c in columns
        }
    )


def risk_matrix(df: DataFrame, ids: list[str], indicators: dict[str, Column]) -> DataFrame:
    """Indicators scaled to 0..1, in long form."""
    wide = df.select(*ids, *[c.cast("double").alias(n) for n, c in indicators.items()])
    names = list(indicators)
    return min_max_scaled(wide, names).unpivot(ids, names, "indicator", "value")


def top_per_team(df: DataFrame, team: str, score: str, n: int = 5) -> DataFrame:
    """Best ``n`` of each team with ties."""
    return top_with_ties(df.where(F.col(team).isNotNull()), [team], [F.desc(score)], n)


def history_ranking(facts: DataFrame, component: str, measure: str, churn: str) -> DataFrame:
    """Components by 0.6 z(mean measure) + 0.4 z(log mean churn), with percent-rank band."""
    stats = facts.groupBy(component).agg(
        F.avg(measure).alias("avg_measure"),
        F.avg(churn).alias("avg_churn"),
        F.count(F.lit(1)).alias("n_quarters"),
    )
    a, b = HIST_WEIGHTS
    scored = with_z_scores(
        cut_lineage(stats), {"_zm": F.col("avg_measure"), "_zc": F.log1p("avg_churn")}
    ).withColumn("history_score", rounded(F.col("_zm") * a + F.col("_zc") * b, 9))
    ranked = with_percent_rank(scored, "history_score", "history_pct", digits=1)
    return ranked.withColumn("risk_level", risk_level(F.col("history_pct")))


def history_by_quarter(facts: DataFrame, quarter: str, measures: list[str]) -> DataFrame:
    """Sums per quarter in long form."""
    sums = facts.groupBy(quarter).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("double").alias(m) for m in measures]
    )
    return sums.unpivot([quarter], measures, "measure", "n")


def period_summary(facts: DataFrame, keys: list[str], sums: list[str], churn: str) -> DataFrame:
    """Rows, sums and average churn per period: the summary printed after each load."""
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in sums],
        rounded(F.avg(churn), 0).alias("avg_churn"),
    )


def load_summary(facts: DataFrame, keys: list[str], counts: dict[str, str], spread: str):
    """Rows, distinct counts, first and last value per key."""
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_distinct(c).alias(n) for n, c in counts.items()],
        F.min(spread).alias(f"first_{spread}"),
        F.max(spread).alias(f"last_{spread}"),
    )


def complexity_top_components(files: DataFrame, component: str, n: int = 10) -> DataFrame:
    """Components with the worst single function, top ``n``."""
    return (
        files.groupBy(component)
        .agg(
            F.max("max_ccn").alias("component_max_ccn"),
            rounded(F.avg("avg_ccn"), 2).alias("component_avg_ccn"),
        )
        .orderBy(F.desc("component_max_ccn"), F.desc("component_avg_ccn"), component)
        .limit(n)
    )


def denormalise_results(
    results: DataFrame,
    lookups: list[tuple[DataFrame, str, str]],
    scope: Column,
    error: str | None = None,
    max_error: int = 1000,
) -> DataFrame:
    """Star join of results with their dimensions; long error texts cut and marked.

    ``lookups`` lists (dimension, key, join type). No broadcast is forced: Spark decides
    from sizes, and skewed keys are split by AQE.
    """
    out = results
    for dim, key, how in lookups:
        out = out.join(dim, key, how)
    out = out.where(scope)
    if error:
        out = out.withColumn("errors_truncated", F.length(error) > max_error).withColumn(
            error, F.substring(error, 1, max_error)
        )
    return out


def case_history(results: DataFrame, case: str, date: str, since=None, until=None) -> DataFrame:
    """Results per case and status within bounds, with first and last date."""
    rows = results
    if since is not None:
        rows = rows.where(F.to_date(date) >= F.to_date(F.lit(since)))
    if until is not None:
        rows = rows.where(F.to_date(date) <= F.to_date(F.lit(until)))
    return rows.groupBy(case, "status").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.to_date(date)).alias("first_date"),
        F.max(F.to_date(date)).alias("last_date"),
    )


def module_index(commits: DataFrame, path: str, module: Column) -> DataFrame:
    """Files and commit rows per module."""
    rows = commits.select(path, module.alias("module_name")).where(
        F.col("module_name").isNotNull()
    )
    per_file = rows.groupBy("module_name", path).agg(F.count(F.lit(1)).alias("_n"))
    return per_file.groupBy("module_name").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("_n").alias("commit_count")
    )


def coverage_matches(modules: DataFrame, covered: DataFrame, prefixes: DataFrame, name: str):
    """Modules covered by exact name, by a listed name prefix, and in total.

    Prefix rules are matched by exploding the leading pieces of a name at each dash and
    joining on equality.
    """
    names = modules.select(name).distinct()
    exact = names.join(covered.select(name), name, "left_semi").withColumn("how", F.lit("exact"))
    parts = F.split(name, "-")
    heads = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "-"), F.lit("-")),
    )
    lead = names.select(name, F.explode(heads).alias("prefix"))
    by_prefix = (
        lead.join(prefixes.select("prefix"), "prefix", "left_semi")
        .select(name)
        .distinct()
        .withColumn("how", F.lit("prefix"))
    )
    return exact.unionByName(by_prefix)


def file_registry(commits: DataFrame, path: str, modules: DataFrame, module_of: Column) -> DataFrame:
    """Distinct paths with module and language; unknown modules keep a null id."""
    from shiplens.functions.paths import language

    files = commits.select(path).distinct().withColumn("module_name", module_of)
    return files.join(modules, "module_name", "left").withColumn("language", language(F.col(path)))


def module_paths(files: DataFrame, modules: DataFrame, module: str, path: str, excluded: str):
    """Full and category path per module from its smallest file path, nulls filled only.

    Files under ``modules/`` decide first; a module with none takes its first path segment.
    """
    from shiplens.functions.paths import category_path, module_path

    inside = F.col(path).startswith("modules/")
    deep = inside & ~F.col(path).startswith(excluded)
    outside = ~inside & ~F.col(path).startswith("/")
    found = files.groupBy(module).agg(
        F.min(F.when(deep, F.col(path))).alias("_in"),
        F.min(F.when(outside, F.col(path))).alias("_out"),
    )
    derived = found.select(
        module,
        F.coalesce(
            module_path(F.col("_in")), F.split_part(F.col("_out"), F.lit("/"), F.lit(1))
        ).alias("_path"),
    )
    joined = modules.join(derived, module, "left")
    full = F.coalesce("module_path_full", "_path")
    return joined.withColumn("module_path_full", full).withColumn(
        "module_path_category",
        F.coalesce("module_path_category", category_path(F.col("module_path_full"))),
    ).drop("_path")


def unmapped_keys(rows: DataFrame, key: str, lists: DataFrame, text: str) -> DataFrame:
    """Distinct keys that appear in no comma-separated list."""
    listed = lists.select(F.explode(F.split(text, ",")).alias("_k")).select(
        F.trim("_k").alias(key)
    )
    return rows.select(key).distinct().join(listed, key, "left_anti")


def first_team_component(components: Column, team: list[str]) -> Column:
    """First component of an issue that is in the team's list, else empty."""
    hit = F.filter(components, lambda c: c.isin(*team))
    return F.coalesce(F.get(hit, F.lit(0)), F.lit(""))


# Heads and ends of the scenario table in an issue description.
SCENARIO_HEADS = r"\|\|\*Test Scenarios\*\|\||\|\|Test Scenarios\|\|"
SCENARIO_ENDS = ("h3. Test Cases", "h3. *Test Cases*", "*Case ", "\n*Design")


def scenario_rows(
    issues: DataFrame, key: str, text: str, head: str = SCENARIO_HEADS, ends=SCENARIO_ENDS
) -> DataFrame:
    """Rows of the scenario table inside a description, numbered from 1.

    The table runs from its head to the first listed end that occurs, else to the end of
    the text; its first row is the header.
    """
    start = F.regexp_instr(F.col(text), F.lit(head))
    stop = F.lit(0)
    for e in reversed(ends):
        at = F.instr(F.col(text), e)
        stop = F.when(at > 0, at).otherwise(stop)
    stop = F.when(stop > 1, stop).otherwise(F.length(text) + 1)
    body = F.when(start > 0, F.substring(F.col(text), start, F.greatest(stop - start, F.lit(0))))
    parts = F.filter(
        F.split(F.replace(body, F.lit("|\n"), F.lit("||\n")), r"\|\n"),
        lambda x: (x != "") & (x != "\n"),
    )
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return issues.select(key, F.posexplode(rest).alias("_i", "scenario")).select(
        key, (F.col("_i") + 1).alias("row_no"), "scenario"
    )
