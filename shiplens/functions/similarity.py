"""Jaro-Winkler and the best-match search built on it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.functions.stats import rounded

PREFIX_SCALE = 0.1


def jaro(a: str, b: str) -> float:
    """Jaro similarity of two strings."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    left = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                left.append(ch)
                break
    m = len(left)
    if m == 0:
        return 0.0
    right = [ch for ch, t in zip(b, taken) if t]
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Jaro plus 0.1 per common leading character (four at most), with no threshold."""
    j = jaro(a, b)
    common = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        common += 1
    return j + common * PREFIX_SCALE * (1 - j)


SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("name", T.StringType()),
        T.StructField("jw", T.DoubleType()),
        T.StructField("token", T.DoubleType()),
    ]
)


@F.pandas_udf(T.ArrayType(SCORED))
def _top_two(keys: pd.Series, candidates: pd.Series) -> pd.Series:
    out = []
    for key, names in zip(keys, candidates):
        words = key.split(" ")
        scored = []
        for name, clean in ((c["name"], c["clean"]) for c in names):
            jw = jaro_winkler(key, clean)
            other = set(clean.split(" "))
            token = sum(w in other for w in words) / len(words)
            scored.append((0.5 * jw + 0.5 * token, name, jw, token))
        scored.sort(key=lambda s: (-s[0], s[1]))
        out.append([dict(zip(("score", "name", "jw", "token"), s)) for s in scored[:2]])
    return pd.Series(out)


def fuzzy_candidates(
    left: DataFrame,
    left_name: str,
    left_clean: str,
    right: DataFrame,
    right_name: str,
    right_clean: str,
    block: int = 2_000,
) -> DataFrame:
    """Best right-hand name for each left-hand one, with its lead over the runner-up.

    Every right-hand name is scored against every left-hand one, as the result demands, but
    no pair is emitted or shuffled: right-hand names are packed into blocks of about
    ``block``, a left-hand row meets each block once and keeps its two best names there,
    and the blocks' pairs of winners are merged by an aggregate.
    """
    names = right.select(
        F.col(right_name).alias("name"), F.col(right_clean).alias("clean")
    ).distinct()
    n_blocks = max(1, -(-names.count() // block))
    blocks = names.groupBy(F.pmod(F.xxhash64("name"), F.lit(n_blocks)).alias("_block")).agg(
        F.collect_list(F.struct("name", "clean")).alias("_names")
    )
    rows = left.select(left_name, left_clean).distinct().withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>"))
    )
    spread = rows.sparkSession.sparkContext.defaultParallelism
    scored = (
        rows.repartition(spread, left_name, "_block")
        .join(blocks, "_block")
        .select(left_name, F.explode(_top_two(F.col(left_clean), F.col("_names"))).alias("_c"))
    )
    order = F.struct(-F.col("_c.score"), F.col("_c.name"))
    best = scored.groupBy(left_name).agg(
        F.slice(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("_c").alias("c")))), 1, 2)
        .alias("_two")
    )
    one, two = F.get("_two", F.lit(0))["c"], F.get("_two", F.lit(1))["c"]
    score = rounded(one["score"], 3)
    return best.select(
        left_name,
        one["name"].alias("component_name"),
        F.when(one["score"] >= 0.70, "HIGH").when(one["score"] >= 0.50, "MEDIUM").otherwise("LOW").alias("confidence"),
        score.alias("combined_score"),
        rounded(F.coalesce(one["score"] - two["score"], F.lit(1.0)), 3).alias("confidence_gap"),
        rounded(one["jw"], 3).alias("jw_sim"),
        rounded(one["token"], 3).alias("token_sim"),
    )


def approved_mappings(
    candidates: DataFrame, approve: str, modules: DataFrame, components: DataFrame
) -> DataFrame:
    """Approved candidates with both ids resolved."""
    yes = F.lower(F.trim(approve)) == "true"
    return (
        candidates.where(yes)
        .join(modules.select("module_name", "module_id"), "module_name")
        .join(components.select("component_name", "component_id"), "component_name")
        .select("module_id", "component_id", "confidence")
        .distinct()
    )
