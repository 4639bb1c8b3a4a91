"""The operators that join on group keys, on inputs in which some keys are null.

A null key is a group like others, as in data frames outside SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiplens.catalog.registry import query
from shiplens.functions.stats import exact_percentile, rounded, share_of_total
from shiplens.operators import bridge, testhealth
from shiplens.operators.joins import null_safe_join
from shiplens.plans import reports

BRAND, TYPE = "Brand#11", "PROMO"


def _null(column: str, value: str) -> Column:
    return F.when(F.col(column) != value, F.col(column))


_R = """
WITH r AS (SELECT nullif(l_orderkey % 5000, 7) AS unit, nullif(p_brand, 'Brand#11') AS brand, nullif(p_type, 'PROMO') AS kind,
        l_returnflag = 'R' AS failed, l_linestatus = 'F' AS flaky, l_discount, l_quantity
    FROM lineitem JOIN part ON p_partkey = l_partkey),
s AS (SELECT brand, count(*) AS test_run_count, count(*) FILTER (WHERE failed) AS failure_count,
        count(*) FILTER (WHERE flaky) AS flaky_count FROM r GROUP BY brand),
f AS (SELECT DISTINCT unit, brand FROM r WHERE failed),
u AS (SELECT unit, count(*) AS n FROM f GROUP BY unit),
c AS (SELECT brand, count(*) AS bf, count(*) FILTER (WHERE n > 1) AS bc
      FROM f JOIN u ON f.unit IS NOT DISTINCT FROM u.unit GROUP BY brand),
rate AS (SELECT s.*, round((failure_count / test_run_count)::DECIMAL(28,10), 4)::DOUBLE AS failure_rate,
        coalesce(bf, 0) AS builds_with_failures, coalesce(bc, 0) AS builds_with_co_failures,
        coalesce(round((bc / nullif(bf, 0))::DECIMAL(28,10), 4)::DOUBLE, 0) AS co_failure_score
      FROM s LEFT JOIN c ON s.brand IS NOT DISTINCT FROM c.brand)
"""


def _results(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.when(F.col("l_orderkey") % 5000 != 7, F.col("l_orderkey") % 5000).alias("unit"),
        _null("p_brand", BRAND).alias("brand"), _null("p_type", TYPE).alias("kind"),
        "l_returnflag", "l_linestatus", "l_discount", "l_quantity",
    )


def _rates(t):
    return testhealth.failure_and_cofailure_rate(
        _results(t), "unit", "brand", F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    )


@query(_R + "SELECT * FROM rate")
def null_component_rates(t):
    return _rates(t)


@query(
    _R
    + """SELECT kind, min(rate.brand) AS component_name, sum(test_run_count)::BIGINT AS test_run_count,
        sum(failure_count)::BIGINT AS failure_count,
        round((sum(failure_count) / sum(test_run_count))::DECIMAL(28,10), 4)::DOUBLE AS failure_rate,
        round((avg(co_failure_score))::DECIMAL(28,10), 4)::DOUBLE AS co_failure_score
    FROM rate JOIN (SELECT DISTINCT nullif(p_brand, 'Brand#11') AS brand, nullif(p_type, 'PROMO') AS kind FROM part) w
        ON rate.brand IS NOT DISTINCT FROM w.brand GROUP BY kind"""
)
def null_module_grain(t):
    crosswalk = t.part.select(_null("p_brand", BRAND).alias("brand"), _null("p_type", TYPE).alias("kind"))
    return testhealth.to_module_grain(_rates(t), crosswalk, "brand", "kind")


@query(
    """WITH p AS (SELECT DISTINCT nullif(p_brand, 'Brand#11') AS brand, nullif(p_type, 'PROMO') AS kind FROM part)
    SELECT brand, kind, count(*) OVER (PARTITION BY brand) AS n_components,
        round((1 / count(*) OVER (PARTITION BY brand))::DECIMAL(28,10), 4)::DOUBLE AS weight FROM p"""
)
def null_bridge_weights(t):
    pairs = t.part.select(_null("p_brand", BRAND).alias("brand"), _null("p_type", TYPE).alias("kind"))
    return bridge.bridge_weights(pairs, "brand", "kind")


@query(
    """WITH c AS (SELECT nullif(o_orderstatus, 'F') AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL)
    SELECT *, sum(n) OVER (PARTITION BY status)::BIGINT AS total,
        round((n / sum(n) OVER (PARTITION BY status) * 100)::DECIMAL(28,10), 1)::DOUBLE AS pct FROM c"""
)
def null_share_of_total(t):
    counts = t.orders.groupBy(_null("o_orderstatus", "F").alias("status"), F.col("o_orderpriority").alias("priority"))
    return share_of_total(counts.agg(F.count(F.lit(1)).alias("n")), ["status"], "n", "pct", 1)


@query(
    _R
    + """SELECT brand, kind, round(quantile_cont(l_quantity * (1 - l_discount), 0.95)::DECIMAL(28,10), 6)::DOUBLE AS p95
    FROM r GROUP BY brand, kind"""
)
def null_exact_percentile(t):
    rows = _results(t).withColumn("v", F.col("l_quantity") * (1 - F.col("l_discount")))
    return exact_percentile(rows, ["brand", "kind"], "v", 0.95, "p95").withColumn("p95", rounded("p95", 6))


@query(
    """WITH d AS (SELECT nullif(o_orderpriority, '1-URGENT') AS quarter, (o_custkey % 200)::INT - 90 AS days_diff FROM orders)
    SELECT quarter, count(*) AS n_components,
        round((avg(CASE WHEN days_diff >= 0 THEN 1.0 ELSE 0.0 END) * 100)::DECIMAL(28,10), 1)::DOUBLE AS pct_internal_first,
        round((avg(days_diff))::DECIMAL(28,10), 1)::DOUBLE AS avg_days_diff, median(days_diff)::DOUBLE AS median_days_diff
    FROM d GROUP BY quarter"""
)
def null_discovery_summary(t):
    timing = t.orders.select(
        _null("o_orderpriority", "1-URGENT").alias("quarter"), ((F.col("o_custkey") % 200).cast("int") - 90).alias("days_diff")
    )
    return reports.discovery_summary(timing, "quarter")


@query(
    """WITH a AS (SELECT nullif(p_brand, 'Brand#11') AS brand, count(*) AS parts FROM part GROUP BY 1),
    b AS (SELECT nullif(p_brand, 'Brand#11') AS brand, max(p_size)::INT AS largest FROM part WHERE p_brand < 'Brand#3' GROUP BY 1)
    SELECT a.brand, parts, largest FROM a LEFT JOIN b ON a.brand IS NOT DISTINCT FROM b.brand"""
)
def null_matching_join(t):
    brand = _null("p_brand", BRAND).alias("brand")
    a = t.part.groupBy(brand).agg(F.count(F.lit(1)).alias("parts"))
    b = t.part.where(F.col("p_brand") < "Brand#3").groupBy(brand).agg(F.max("p_size").cast("int").alias("largest"))
    return null_safe_join(a, b, ["brand"])
