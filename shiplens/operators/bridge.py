"""Weighted many-to-many bridges and lookups of paths in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions.stats import rounded
from shiplens.operators.containment import contained
from shiplens.operators.joins import null_safe_join


def bridge_weights(mappings: DataFrame, left: str, right: str, digits: int = 4) -> DataFrame:
    """Distinct pairs with weight 1/n over the right-hand entries of each left key."""
    pairs = mappings.select(left, right).distinct()
    n = pairs.groupBy(left).agg(F.count(F.lit(1)).alias("n_components"))
    return null_safe_join(pairs, n, [left], "inner").withColumn("weight", rounded(1 / F.col("n_components"), digits))


def build_bridge(
    primary: DataFrame,
    approved: DataFrame | None,
    path: str = "module_path",
    component: str = "component_name",
    team: str = "team_name",
    no_team=("", "NoMappedTeam"),
) -> tuple[DataFrame, DataFrame]:
    """Authoritative mappings plus approved fuzzy ones for paths they do not cover.

    Returns the weighted bridge and the component list with one team each.
    """
    clean = primary.select(
        F.trim(path).alias(path),
        F.trim(component).alias(component),
        F.when(F.trim(team).isin(*no_team), None).otherwise(F.trim(team)).alias(team),
    ).where(F.col(component).isNotNull() & (F.col(component) != ""))
    has_path = F.col(path).isNotNull() & (F.col(path) != "")
    mapped = clean.where(has_path)
    everything = mapped
    if approved is not None:
        extra = (
            approved.select(F.trim(path).alias(path), F.trim(component).alias(component))
            .where(F.col(path).isNotNull() & (F.col(component) != ""))
            .join(mapped.select(path), path, "left_anti")
            .withColumn(team, F.lit(None).cast("string"))
        )
        everything = mapped.unionByName(extra)
    teams = (
        everything.unionByName(clean.where(~F.coalesce(has_path, F.lit(False))))
        .groupBy(component)
        .agg(F.min_by(team, F.when(F.col(team).isNotNull(), F.struct(path, team))).alias(team))
    )
    return bridge_weights(everything, path, component), teams


def weighted_rollup(
    measures: DataFrame,
    bridge: DataFrame,
    join_key: str,
    keys: list[str],
    columns: list[str],
    weight: str = "weight",
) -> DataFrame:
    """Measures times bridge weight, summed; keys absent from the bridge drop out.

    A weighted sum is the weight times a sum, so measures are added up per join key before
    the bridge multiplies them: the join sees one row per key and period, however hot.
    """
    own = [k for k in keys if k in measures.columns and k not in bridge.columns]
    sums = measures.groupBy(join_key, *own).agg(*[F.sum(c).alias(c) for c in columns])
    joined = sums.join(bridge, join_key)
    return joined.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.col(c) * F.col(weight)), F.lit(0.0)).alias(c) for c in columns]
    )


# Which extensions make up the derived churn totals.
BACKEND = ("java",)
FRONTEND = ("tsx", "scss", "js")
OTHER_CHURN = ("ts", "jsp", "css")


def derived_churn(df: DataFrame) -> DataFrame:
    """backend, frontend and total churn from per-extension insertions and deletions."""

    def total(exts):
        cols = [F.col(f"{e}_Insertions") + F.col(f"{e}_Deletions") for e in exts]
        out = cols[0]
        for c in cols[1:]:
            out = out + c
        return out

    return df.withColumns(
        {"backend_changes": total(BACKEND), "frontend_changes": total(FRONTEND)}
    ).withColumn(
        "total_churn", F.col("backend_changes") + F.col("frontend_changes") + total(OTHER_CHURN)
    )


def breaking_rollup(
    breaking: DataFrame, bridge: DataFrame, first_label: str | None = None
) -> DataFrame:
    """Weighted breaking-change counts per component and quarter, rounded to whole ones."""
    rows = breaking.where(F.col("quarter").isNotNull())
    if first_label is not None:
        rows = rows.where(F.col("quarter") >= first_label)
    return (
        weighted_rollup(
            rows, bridge, "module_path", ["component_name", "quarter"], ["breaking_count"]
        )
        .withColumn("breaking_count", rounded("breaking_count").cast("bigint"))
    )


def flag_dampening(
    facts: DataFrame,
    flags: DataFrame,
    bridge: DataFrame,
    component: str,
    measures: list[str],
    factor: float,
    threshold: float,
    excluded: str | None = None,
) -> DataFrame:
    """Dampening factor per component: all rows start at 1, flagged components get ``factor``.

    Also returns each measure times the factor.
    """
    hot = flags.where(F.col("is_flagged") & (F.col("flag_pct") >= threshold))
    if excluded:
        hot = hot.where(~F.col("module_path").rlike(excluded))
    flagged = (
        bridge.join(hot.select("module_path"), "module_path", "left_semi")
        .select(component)
        .distinct()
        .withColumn("is_feature_flagged", F.lit(True))
    )
    out = facts.join(flagged, component, "left").withColumn(
        "is_feature_flagged", F.coalesce("is_feature_flagged", F.lit(False))
    )
    out = out.withColumn(
        "churn_dampening_factor", F.when(F.col("is_feature_flagged"), factor).otherwise(1.0)
    )
    return out.withColumns(
        {f"dampened_{m}": F.col(m) * F.col("churn_dampening_factor") for m in measures}
    )


def longest_prefix_match(
    paths: DataFrame, path: str, mapping: DataFrame, prefix: str, columns: list[str]
) -> DataFrame:
    """Mapping row with the longest folder prefix of each path; unmatched paths keep nulls.

    The prefixes of a path are exploded and equi-joined, so the work is (path depth x
    paths), never paths x mapping.
    """
    from shiplens.functions.paths import path_prefixes

    keys = paths.select(path).distinct()
    probes = keys.select(path, F.explode(path_prefixes(F.col(path))).alias("_prefix"))
    hits = probes.join(
        mapping.select(F.col(prefix).alias("_prefix"), *columns), "_prefix"
    )
    best = hits.groupBy(path).agg(
        F.max_by(
            F.struct(F.col("_prefix").alias(prefix), *columns),
            F.struct(F.length("_prefix"), F.struct(*columns)),
        ).alias("_hit")
    )
    picked = best.select(path, f"_hit.{prefix}", *[f"_hit.{c}" for c in columns])
    return paths.join(picked, path, "left")


def longest_contained_match(
    paths: DataFrame, path: str, mapping: DataFrame, fragment: str, columns: list[str]
) -> DataFrame:
    """Mapping row with the longest fragment that occurs anywhere in each path, case and all.

    Of equally long ones the first in order counts; unmatched paths keep nulls.
    """
    rows = mapping.where(F.length(fragment) > 0).select(F.col(fragment).alias("_part"), *columns)
    hits = contained(paths, path, rows, "_part")
    longest = hits.groupBy(path).agg(F.min_by("_part", F.struct(-F.length("_part"), F.col("_part"))).alias("_part"))
    first = rows.groupBy("_part").agg(F.min(F.struct(*columns)).alias("_row"))
    picked = longest.join(first, "_part").select(path, F.col("_part").alias(fragment), *[f"_row.{c}" for c in columns])
    return null_safe_join(paths, picked, [path], "left")


# File-name words that name no module.
GENERIC_FILE_WORDS = (
    "java", "tsx", "ts", "js", "jsx", "jsp", "test", "impl",
    "local", "service", "util", "helper", "base", "abstract",
)


def match_modules(
    paths: DataFrame,
    path: str,
    mapping: DataFrame,
    module_path: str = "module_path",
    component: str = "component_name",
    min_token: int = 5,
) -> DataFrame:
    """Component of each path: longest module prefix, else the row that holds most file-name words.

    A word counts once for a mapping row whose component name or last module folder contains it.
    Of rows with equal scores the first in order of component and folder counts.
    ``match_strategy`` tells which of the two was used, or ``no_match``.
    """
    lower = paths.select(path).distinct().withColumn("_path", F.lower(F.trim(path)))
    table = mapping.select(
        F.lower(module_path).alias("_module"), F.col(component)
    ).where(F.col(component).isNotNull())
    exact = longest_prefix_match(
        lower, "_path", table.where(F.col("_module").isNotNull()), "_module", [component]
    )
    rest = exact.where(F.col(component).isNull()).select(path, "_path")
    words = F.array_except(
        F.split(F.element_at(F.split("_path", "/"), -1), r"[.\-_]"),
        F.array(*[F.lit(w) for w in GENERIC_FILE_WORDS]),
    )
    tokens = rest.select(
        path, F.explode(F.filter(words, lambda w: F.length(w) >= min_token)).alias("_w")
    ).distinct()
    folder = F.element_at(F.split(F.coalesce("_module", F.lit("")), "/"), -1)
    # A word holds no line break, so it lies in one of the two names.
    names = table.select(component, F.concat_ws("\n", F.lower(component), folder).alias("_names")).distinct()
    holds = contained(names, "_names", tokens, "_w")
    scored = (
        tokens.join(holds, "_w")
        .groupBy(path, "_names")
        .agg(F.count("*").alias("_score"))
        .join(names, "_names")
        .groupBy(path)
        .agg(
            F.min_by(
                F.struct(F.col(component), F.col("_score")),
                F.struct(-F.col("_score"), F.col(component), F.col("_names")),
            ).alias("_best")
        )
        .select(path, F.col(f"_best.{component}").alias("_guess"), "_best._score")
    )
    strategy = (
        F.when(F.col(component).isNotNull(), "exact_module_path")
        .when(
            F.col("_guess").isNotNull(),
            F.concat(F.lit("token_match(score="), F.col("_score"), F.lit(")")),
        )
        .otherwise("no_match")
    )
    return exact.join(scored, path, "left").select(
        path,
        F.coalesce(component, "_guess").alias(component),
        strategy.alias("match_strategy"),
    )


def crosswalk_join(paths: DataFrame, path: str, mapping: DataFrame, module_path: str) -> DataFrame:
    """Rows of both sides whose paths are the same without their leading folders."""
    from shiplens.functions.paths import normalise_crosswalk_key

    right = mapping.withColumn("_key", normalise_crosswalk_key(F.col(module_path)))
    return paths.withColumn("_key", normalise_crosswalk_key(F.col(path))).join(right, "_key").drop("_key")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group; Spark limits within each task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_with_ties(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """Rows of rank <= n in each group, ties kept."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") <= n).drop("_rk")
