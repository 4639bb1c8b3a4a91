"""Normalisers, decayed scores, the composite risk score and its tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions.paths import CODE_PATHS, TEST_PATHS, code_family
from shiplens.functions.stats import (
    cap_one,
    exact_percentile,
    mode_per_group,
    percentile_of_counts,
    ratio,
    rounded,
)
from shiplens.operators.bridge import top_per_group
from shiplens.operators.graph import reach_from
from shiplens.operators.joins import null_safe_join

# Window weights, signal weights and tier limits of the score.
DECAY = {30: 0.50, 90: 0.30, 365: 0.20}
SIGNAL_WEIGHTS = {
    "complexity_score": 0.28,
    "churn_score": 0.25,
    "defect_score": 0.20,
    "test_score": 0.15,
    "dependency_score": 0.12,
}
COMPLEXITY_PINNED_P95 = 16.0
TIERS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


def p95_params(
    facts: DataFrame, metrics: list[str], window: str | None = None, p: float = 0.95
) -> DataFrame:
    """p95 of the positive values of each metric (and window), rounded to 4 digits.

    Long form: metric, window, p95. Metrics are counts or rounded scores.
    """
    keys = ["metric"] + ([window] if window else [])
    ids = [window] if window else []
    long = (
        facts.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
        .unpivot(ids, metrics, "metric", "v")
        .where(F.col("v") > 0)
    )
    out = percentile_of_counts(long, keys, "v", p, "p95")
    return out.withColumn("p95", rounded("p95", 4))


def norms_by_window(
    params: DataFrame, window: str, windows: list[int], metrics: list[str], pinned: dict[str, int]
) -> DataFrame:
    """One row per window with the normaliser of each metric (``p95_<metric>``).

    A pinned metric uses one window's normaliser in all of them.
    """
    targets = F.array(F.col(window))
    for metric, at in pinned.items():
        everywhere = F.array(*[F.lit(int(w)) for w in windows])
        mine = F.col("metric") == metric
        targets = (
            F.when(mine & (F.col(window) == at), everywhere)
            .when(mine, F.array().cast("array<int>"))
            .otherwise(targets)
        )
    rows = params.select("metric", "p95", F.explode(targets).alias(window))
    return (
        rows.where(F.col(window).isin(*windows))
        .groupBy(window)
        .agg(*[F.max(F.when(F.col("metric") == m, F.col("p95"))).alias(f"p95_{m}") for m in metrics])
    )


def decayed_score(
    windowed: DataFrame,
    entity: str,
    window: str,
    blend: dict[str, float],
    params: DataFrame,
    decay: dict[int, float],
    name: str,
    pinned: dict[str, int] | None = None,
    plain=(),
) -> DataFrame:
    """One score in [0, 1] per entity: blended metrics, then a weighted mean over windows.

    ``blend`` maps a metric to its share; each is divided by its normaliser from
    ``params`` and capped at 1, but those in ``plain`` are scores already. Windows an
    entity lacks carry no weight.
    """
    normed = [m for m in blend if m not in plain]
    norms = norms_by_window(params, window, list(decay), normed, pinned or {})
    # One row per window of ``decay``: a fixed handful.
    rows = windowed.join(F.broadcast(norms), window)
    score = F.lit(0.0)
    for metric, share in blend.items():
        norm = F.lit(1.0) if metric in plain else F.col(f"p95_{metric}")
        score = score + cap_one(ratio(F.col(metric), norm)) * share
    weight = F.lit(None).cast("double")
    for days, w in decay.items():
        weight = F.when(F.col(window) == days, F.lit(w)).otherwise(weight)
    rows = rows.select(entity, score.alias("_s"), weight.alias("_w"))
    return rows.groupBy(entity).agg(
        rounded(ratio(F.sum(F.col("_s") * F.col("_w")), F.sum("_w")), 4).alias(name)
    )


def complexity_score(
    facts: DataFrame,
    entity: str,
    cyclomatic: str,
    cognitive: str,
    violations: Column,
    cyclomatic_p95: Column,
    cognitive_p95: Column,
) -> DataFrame:
    """0.35 cyclomatic + 0.40 cognitive + 0.25 weighted violations, each capped at 1."""
    score = (
        cap_one(ratio(F.col(cyclomatic), cyclomatic_p95)) * 0.35
        + cap_one(ratio(F.col(cognitive), cognitive_p95)) * 0.40
        + cap_one(ratio(violations, cyclomatic_p95 * 5)) * 0.25
    )
    return facts.select(entity, rounded(score, 4).alias("complexity_score"))


def clean_functions(functions: DataFrame, file: str, excluded: str) -> DataFrame:
    """Function rows ready for averaging: path trimmed, exclusions, complexity cut at 100."""
    from shiplens.functions.paths import module_path

    rows = functions.withColumn("file_path", F.regexp_replace(file, r"^\./", ""))
    rows = rows.where(~F.col("file_path").rlike(excluded))
    rows = rows.withColumns(
        {
            "ccn": F.when(F.col("ccn").isNotNull(), F.least("ccn", F.lit(100))),
            "module_path": module_path(F.col("file_path")),
            "language": code_family(F.col("file_path")),
        }
    )
    return rows.where(F.col("module_path").isNotNull() & (F.col("language") != "other"))


def function_to_file_complexity(
    functions: DataFrame, file: str, ccn: str, nloc: str, language: str
) -> DataFrame:
    """File averages overall and per language, worst function and language mix."""
    java, front = F.col(language) == "java", F.col(language) == "frontend"
    n_java = F.sum(F.when(java, 1).otherwise(0))
    n_front = F.sum(F.when(front, 1).otherwise(0))

    def mean(col, cond=None):
        c = F.col(col) if cond is None else F.when(cond, F.col(col))
        return rounded(F.avg(c), 2)

    return functions.groupBy(file).agg(
        mean(ccn).alias("avg_ccn"),
        mean(nloc).alias("avg_nloc"),
        F.max(ccn).alias("max_ccn"),
        mean(ccn, java).alias("avg_ccn_java"),
        mean(nloc, java).alias("avg_nloc_java"),
        mean(ccn, front).alias("avg_ccn_frontend"),
        mean(nloc, front).alias("avg_nloc_frontend"),
        F.when((n_java > 0) & (n_front > 0), "mixed")
        .when(n_java > 0, "java_only")
        .otherwise("frontend_only")
        .alias("language_mix"),
    )


def complexity_by_component(
    files: DataFrame, bridge: DataFrame, file: str, module: str, component: str
) -> DataFrame:
    """Complexity per component: plain means, weighted sums, commonest language mix, rank."""
    from shiplens.functions.stats import with_percent_rank

    joined = files.join(bridge.select(module, component, "weight"), module)
    stats = joined.groupBy(component).agg(
        F.count_distinct(file).alias("n_files"),
        F.avg("avg_ccn").alias("_ccn"),
        rounded(F.avg("avg_nloc"), 1).alias("avg_cognitive"),
        rounded(F.avg("avg_ccn_java"), 1).alias("avg_ccn_java"),
        rounded(F.avg("avg_ccn_frontend"), 1).alias("avg_ccn_frontend"),
        F.max("max_ccn").alias("component_max_ccn"),
        rounded(F.sum(F.col("lines_of_code") * F.col("weight")), 0).alias("weighted_loc"),
    )
    mix = mode_per_group(joined, [component], "language_mix", "language_mix")
    ranked = with_percent_rank(stats, "_ccn", "complexity_risk_pct", digits=1)
    return (
        null_safe_join(ranked, mix, [component])
        .withColumn("avg_cyclomatic", rounded("_ccn", 1))
        .drop("_ccn")
    )


def complexity_by_team(components: DataFrame, team: str) -> DataFrame:
    """Component complexity rolled up to teams; components without a team are left out."""
    return components.where(F.col(team).isNotNull()).groupBy(team).agg(
        F.count(F.lit(1)).alias("n_components"),
        F.sum("n_files").alias("total_files"),
        rounded(F.avg("avg_cyclomatic"), 1).alias("avg_cyclomatic"),
        rounded(F.avg("avg_cognitive"), 1).alias("avg_cognitive"),
        F.sum("weighted_loc").alias("total_loc"),
        rounded(F.avg("complexity_risk_pct"), 1).alias("avg_complexity_risk"),
    )


def amplifier(signals_above: Column) -> Column:
    return (
        F.when(signals_above >= 4, 1.25)
        .when(signals_above == 3, 1.15)
        .when(signals_above == 2, 1.05)
        .otherwise(1.0)
    )


def risk_tier(score: Column) -> Column:
    return (
        F.when(score >= 0.75, "CRITICAL")
        .when(score >= 0.50, "HIGH")
        .when(score >= 0.25, "MEDIUM")
        .otherwise("LOW")
    )


def composite_risk(
    entities: DataFrame,
    signals: list[tuple[DataFrame, str, str]],
    weights: dict[str, float] = SIGNAL_WEIGHTS,
) -> DataFrame:
    """Weighted sum of signals (a missing one is 0), amplified when several are high.

    ``signals`` lists (frame, join key, score column).
    """
    out = entities
    for frame, key, score in signals:
        out = out.join(frame.select(key, score), key, "left")
    for name in weights:
        present = F.coalesce(F.col(name), F.lit(0.0)) if name in out.columns else F.lit(0.0)
        out = out.withColumn(name, present)
    raw, above = F.lit(0.0), F.lit(0)
    for name, w in weights.items():
        raw = raw + F.col(name) * w
        above = above + F.when(F.col(name) > 0.50, 1).otherwise(0)
    out = out.withColumns({"composite_raw": raw, "signals_above_50": above})
    out = out.withColumn(
        "composite_risk",
        rounded(
            F.least(F.col("composite_raw") * amplifier(F.col("signals_above_50")), F.lit(1.0)), 4
        ),
    )
    return out.withColumn("risk_tier", risk_tier(F.col("composite_risk")))


def split_changed_paths(changes: DataFrame, path: str) -> DataFrame:
    """Adds ``path_kind``: test, code or other."""
    kind = (
        F.when(F.col(path).rlike(TEST_PATHS), "test")
        .when(F.col(path).rlike(CODE_PATHS), "code")
        .otherwise("other")
    )
    return changes.withColumn("path_kind", kind)


def change_risk(changed: DataFrame, change: str, entity: str, registry: DataFrame, scores: DataFrame):
    """One row per change: tier of its worst entity, average, tier counts, new, unscored.

    ``changed`` holds (change, entity); entities missing from ``registry`` are new, those
    without a score unscored.
    """
    known = registry.select(entity).distinct().withColumn("_known", F.lit(True))
    joined = (
        changed.select(change, entity)
        .distinct()
        .join(known, entity, "left")
        .join(scores.select(entity, "composite_risk", "risk_tier"), entity, "left")
    )
    scored = F.col("composite_risk").isNotNull()
    summary = joined.groupBy(change).agg(
        F.count(F.lit(1)).alias("n_changed"),
        F.sum(F.when(F.col("_known").isNull(), 1).otherwise(0)).alias("n_new"),
        F.sum(F.when(F.col("_known") & ~scored, 1).otherwise(0)).alias("n_unscored"),
        F.coalesce(rounded(F.avg("composite_risk"), 4), F.lit(0.0)).alias("avg_risk"),
        F.coalesce(rounded(F.max("composite_risk"), 4), F.lit(0.0)).alias("max_risk"),
        *[
            F.sum(F.when(F.col("risk_tier") == t, 1).otherwise(0)).alias(f"n_{t.lower()}")
            for t in TIERS
        ],
    )
    return summary.withColumn("change_tier", risk_tier(F.col("max_risk")))


def change_blast(
    changed: DataFrame, change: str, node: str, edges: DataFrame, src: str, dst: str, max_depth: int = 3
) -> DataFrame:
    """Per change: its nodes, and how many others depend on them directly, at a distance, in all."""
    hits = reach_from(changed, change, node, edges, src, dst, max_depth).groupBy(change).agg(
        F.count_if(F.col("depth") == 1).alias("direct_dependents"),
        F.count_if(F.col("depth") > 1).alias("transitive_dependents"),
        F.count("*").alias("total_blast"),
        F.max("depth").alias("depth_reached"),
    )
    nodes = changed.select(change, node).dropna().distinct().groupBy(change).agg(F.count("*").alias("n_nodes"))
    counts = ("direct_dependents", "transitive_dependents", "total_blast", "depth_reached")
    return nodes.join(hits, change, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def change_tests(
    changed: DataFrame, change: str, component: str, quality: DataFrame, item: str, n: int = 3, least: float = 0.10
) -> DataFrame:
    """The best ``n`` tests of each component that a change touches, ranked over the whole change.

    ``place`` counts from the strongest signal of the change, so a list of any length takes from
    all its components.
    """
    touched = changed.select(change, component).dropna().distinct()
    best = touched.join(recommended_tests(touched, quality, component, item, n, least), component)
    order = Window.partitionBy(change).orderBy(F.desc("signal_score"), component, item)
    return best.withColumn("place", F.row_number().over(order))


def tier_counts(scores: DataFrame, tiers=TIERS) -> DataFrame:
    """Rows per tier with every tier listed, zero where none."""
    spark = scores.sparkSession
    wanted = spark.range(1).select(
        F.explode(F.array(*[F.lit(t) for t in tiers])).alias("risk_tier")
    )
    counts = scores.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, "risk_tier", "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("long"))
    )


def recommended_tests(
    affected: DataFrame, quality: DataFrame, component: str, item: str, n: int = 3, least=0.10
) -> DataFrame:
    """Best ``n`` tests per affected component by signal, weak signals left out."""
    rows = quality.where(F.col("signal_score") >= least).join(
        affected.select(component).distinct(), component, "left_semi"
    )
    return top_per_group(rows, [component], [F.desc("signal_score"), F.col(item)], n)


def normalisation_update(
    params: DataFrame, version: str, files: DataFrame, pinned: float = COMPLEXITY_PINNED_P95
) -> DataFrame:
    """Normaliser rows with one version's complexity pinned and its p95 recomputed."""
    fresh = exact_percentile(files, [], "avg_nloc", 0.95, "p").scalar()
    mine = F.col("scoring_version") == version
    return params.withColumns(
        {
            "complexity_p95": F.when(mine, F.lit(pinned)).otherwise(F.col("complexity_p95")),
            "cognitive_p95": F.when(mine, fresh).otherwise(F.col("cognitive_p95")),
        }
    )


def latest_params(params: DataFrame, version: str, at: str, columns: list[str]) -> DataFrame:
    """Newest appended row per version."""
    return params.groupBy(version).agg(
        F.max_by(F.struct(*columns), F.struct(at, *columns)).alias("_r")
    ).select(version, "_r.*")
