"""Exact order statistics and ratios that stay distributed at any group size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.lineage import cut_lineage
from shiplens.operators.joins import null_safe_join


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; null where den is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def rounded(x: Column, digits: int = 0) -> Column:
    """Half-up rounding that first drops the noise of sums taken in any order."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(F.round(x.cast("double"), 10), digits)


def cap_one(x: Column) -> Column:
    """min(x, 1) that keeps null, which ``least`` would skip."""
    return F.when(x.isNotNull(), F.least(x, F.lit(1.0)))


def cumulative_counts(
    df: DataFrame, keys: list[str], value: str, bins: int = 4096, limit: int = 1_000_000
) -> DataFrame:
    """Distinct values per key with how many rows lie below each one.

    Returns keys, ``value``, ``cnt``, ``below`` (rows with a smaller value) and ``total``.

    A plain window over the group would sort a whole group in one task. Here values are
    first counted (map-side combined) and written out, so that every later step sees the
    same doubles, then laid into equal-width bins per key; only the bin totals (at most
    ``bins`` rows) are summed over the group, and the fine order is resolved within a bin.
    Bins are split again while one holds more than ``limit`` distinct values, as a long
    tail would.
    """
    cur = cut_lineage(
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    part: list[str] = list(keys)
    cur = _join(cur, cur.groupBy(*keys).agg(F.sum("cnt").alias("total")), keys)
    cur = cur.withColumn("below", F.lit(0).cast("long"))
    for level in range(6):
        b = f"_b{level}"
        ends = cur.groupBy(*part).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
        cell = F.floor(F.try_divide((F.col("value") - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo")))
        cell = F.coalesce(F.least(cell, F.lit(bins - 1).cast("long")), F.lit(0).cast("long"))
        cur = _join(cur, ends, part).withColumn(b, cell).drop("_lo", "_hi")
        totals = cur.groupBy(*part, b).agg(
            F.sum("cnt").alias("_n"), F.count(F.lit(1)).alias("_values")
        )
        fullest = totals.agg(F.max("_values")).first()[0] or 0
        before = Window.partitionBy(*part).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            *part, b, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
        )
        part = [*part, b]
        cur = null_safe_join(cur, offsets, part, "inner").withColumn("below", F.col("below") + F.col("_off")).drop("_off")
        if fullest <= limit:
            break
        cur = cut_lineage(cur)
    inside = Window.partitionBy(*part).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("below") + F.coalesce(F.sum("cnt").over(inside), F.lit(0))
    return cur.select(*keys, "value", "cnt", below.alias("below"), "total")


def _join(left: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    if keys:
        return null_safe_join(left, small, keys, "inner")
    one = small.select(F.struct(*small.columns).alias("s")).scalar()
    return left.select("*", *[one[c].alias(c) for c in small.columns])


def exact_percentile(
    df: DataFrame, keys: list[str], value: str, p: float, name: str, **kwargs
) -> DataFrame:
    """Percentile with linear interpolation (type 7) per key for values of any kind.

    Distributed throughout: see ``cumulative_counts``. Nulls are ignored.
    """
    counts = cumulative_counts(df, keys, value, **kwargs)
    h = (F.col("total") - 1) * F.lit(float(p))
    lo, hi = F.floor(h), F.ceil(h)

    def at(rank: Column) -> Column:
        hit = (F.col("below") <= rank) & (rank < F.col("below") + F.col("cnt"))
        return F.max(F.when(hit, F.col("value")))

    picked = counts.groupBy(*keys).agg(
        at(lo).alias("_x0"), at(hi).alias("_x1"), F.max("total").alias("total")
    )
    return picked.select(
        *keys, (F.col("_x0") + (h - lo) * (F.col("_x1") - F.col("_x0"))).alias(name)
    )


def percentile_of_counts(
    df: DataFrame, keys: list[str], value: str, p: float, name: str
) -> DataFrame:
    """The same percentile for whole-number counts and for scores rounded to a few digits.

    Spark's own ``percentile`` keeps one entry per distinct value of a group. A count taken
    over N events has at most sqrt(2 N) distinct values (1.4 million for 10^12 events) and
    a score of four digits 10,001, so that map stays small at any scale.
    """
    return df.groupBy(*keys).agg(
        F.percentile(F.col(value).cast("double"), float(p)).alias(name)
    )


def with_percent_rank(
    df: DataFrame, value: str, name: str, digits: int | None = None, **kwargs
) -> DataFrame:
    """Percent rank 0..100 over the whole frame; a null value keeps a null rank."""
    df = cut_lineage(df)
    counts = cumulative_counts(df, [], value, **kwargs)
    rank = F.coalesce(ratio(F.col("below"), F.col("total") - 1), F.lit(0.0)) * 100
    if digits is not None:
        rank = rounded(rank, digits)
    ranks = counts.select(F.col("value").alias("_v"), rank.alias(name))
    return df.join(ranks, F.col(value).cast("double") == F.col("_v"), "left").drop("_v")


def mode_per_group(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Most frequent non-null value; the smallest one wins a tie.

    Counts first, so a group's values are never gathered in one place.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.groupBy(*keys).agg(
        F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name)
    )


def share_of_total(df: DataFrame, group: list[str], count: str, name: str, digits: int) -> DataFrame:
    """Adds the group total and each row's percent of it (joined, not windowed).

    A null in the group is a value like others.
    """
    totals = df.groupBy(*group).agg(F.sum(count).alias("total"))
    return null_safe_join(df, totals, group, "inner").withColumn(
        name, rounded(ratio(F.col(count), F.col("total")) * 100, digits)
    )


def with_z_scores(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds (value - mean) / max(sd, 1e-6) over the whole frame for each column."""
    moments = []
    for name, c in columns.items():
        moments.append(F.avg(c).alias(f"m_{name}"))
        moments.append(F.greatest(F.stddev_samp(c), F.lit(1e-6)).alias(f"s_{name}"))
    one = df.agg(F.struct(*moments).alias("s")).scalar()
    return df.withColumns(
        {name: (c - one[f"m_{name}"]) / one[f"s_{name}"] for name, c in columns.items()}
    )


def risk_level(pct: Column) -> Column:
    """Five right-closed bands of a 0..100 percent rank."""
    return (
        F.when(pct <= 20, "Very Low")
        .when(pct <= 40, "Low")
        .when(pct <= 60, "Medium")
        .when(pct <= 80, "High")
        .when(pct > 80, "Very High")
    )


def error_metrics(df: DataFrame, actual: str, predicted: str, keys: list[str] | None = None):
    """n, R2, MAE, RMSE and bias percent in one aggregate (two passes for the mean)."""
    keys = keys or []
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    sums = df.where(a.isNotNull() & p.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((a - p) * (a - p)).alias("_sse"),
        F.sum(F.abs(a - p)).alias("_sae"),
        F.var_pop(a).alias("_var"),
        F.avg(a).alias("_ma"),
        F.avg(p).alias("_mp"),
    )
    n = F.col("n")
    return sums.select(
        *keys,
        "n",
        rounded(1 - ratio(F.col("_sse"), F.col("_var") * n), 4).alias("r2"),
        rounded(F.col("_sae") / n, 4).alias("mae"),
        rounded(F.sqrt(F.col("_sse") / n), 4).alias("rmse"),
        rounded(ratio(F.col("_ma") - F.col("_mp"), F.col("_ma")) * 100, 4).alias("bias_pct"),
    )
