"""Order statistics, shares and scaling against numpy and hand-worked cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplens.functions import stats


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_percentile_of_four_numbers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert stats.exact_percentile(df, [], "v", 0.95, "p").first()["p"] == pytest.approx(8.95)
    assert stats.percentile_of_counts(df, [], "v", 0.95, "p").first()["p"] == pytest.approx(8.95)


@pytest.mark.parametrize("limit", [1, 1_000_000])
def test_percentile_against_numpy_on_long_tailed_values(spark, limit):
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.pareto(0.5, 500), rng.integers(0, 5, 300), [1e12, -4.0]])
    keys = rng.integers(0, 3, len(data))
    rows = [(int(k), float(v)) for k, v in zip(keys, data)] + [(0, None)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(6)
    for p in (0.0, 0.5, 0.9, 1.0):
        got = dict(values(stats.exact_percentile(df, ["k"], "v", p, "p", bins=16, limit=limit), "k", "p"))
        for k in range(3):
            assert got[k] == pytest.approx(np.percentile(data[keys == k], p * 100))


def test_percent_rank_leaves_nulls_out(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (3.0,)], "v double")
    got = {r["v"]: r["r"] for r in stats.with_percent_rank(df, "v", "r").collect()}
    assert got == {None: None, 1.0: 0.0, 2.0: 50.0, 3.0: 100.0}


def test_percent_rank_with_ties(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 5.0, 1.0, 9.0, 5.0)], "v double")
    got = sorted(r["r"] for r in stats.with_percent_rank(df, "v", "r").collect())
    assert got == [0.0, 25.0, 25.0, 25.0, 100.0]


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("b", "z")], "k string, v string")
    assert dict(values(stats.mode_per_group(df, ["k"], "v", "m"), "k", "m")) == {"a": "x", "b": "z"}


def test_bands_are_right_closed(spark):
    df = spark.createDataFrame([(20.0,), (20.1,), (80.0,), (80.1,), (None,)], "v double")
    got = [r[0] for r in df.select(stats.risk_level(F.col("v"))).collect()]
    assert got == ["Very Low", "Low", "High", "Very High", None]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(None,), (2.0,), (0.5,)], "v double")
    assert [r[0] for r in df.select(stats.cap_one(F.col("v"))).collect()] == [None, 1.0, 0.5]


def test_error_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "a double, p double")
    r = stats.error_metrics(df, "a", "p").first()
    assert (r["n"], r["r2"], r["mae"], r["bias_pct"]) == (3, 0.75, 0.6667, 0.0)
