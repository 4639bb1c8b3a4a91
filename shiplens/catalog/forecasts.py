"""Forecast models on order counts per nation and quarter."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.catalog.reports import _FACTS, facts
from shiplens.functions.stats import error_metrics, rounded
from shiplens.lineage import cut_lineage
from shiplens.operators.periods import months_in_field
from shiplens.plans import forecast, reports

AS_OF = "2001-12-31"
FORECAST_QUARTER = "2001.Q2"
#: Trees of a forest.
TREES = 500

_D = "::DECIMAL(28,10)"
_ROWS = (
    _FACTS
    + f""", q AS (SELECT component, team, quarter, internal AS actual, customer AS stories, backend, frontend,
        (quarter LIKE '%Q1')::INT AS is_major, (quarter LIKE '%Q4')::INT AS is_lts,
        make_date(quarter[1:4]::INT, quarter[7:7]::INT * 3, 1) AS release_date FROM facts),
    mq AS (SELECT *, round((date_diff('day', release_date, DATE '{AS_OF}') / 30.0){_D})::INT AS months FROM q),
    used AS (SELECT DISTINCT quarter FROM mq WHERE quarter = '{FORECAST_QUARTER}' OR months >= 9),
    j AS (SELECT mq.*, legacy_internal_avg AS legacy_raw FROM mq LEFT JOIN base USING (component)),
    fm AS (SELECT median(legacy_raw) AS v FROM j WHERE quarter IN (FROM used)),
    x AS (SELECT component, quarter, actual, stories, months, legacy_raw, coalesce(legacy_raw, v) AS legacy_avg,
        (legacy_raw IS NOT NULL)::INT AS has_legacy, ln(greatest(months, 1)) AS log_months, ln(1 + backend) AS log_backend,
        ln(1 + frontend) AS log_frontend, is_major, is_lts, is_major * stories AS major_stories FROM j, fm)
    """
)


def _mature(rows: DataFrame) -> list[str]:
    return forecast.mature_quarters(rows, FORECAST_QUARTER)


def _facts(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = cut_lineage(facts(t))  # the orders are read once, not again for each use of the means
    means = reports.baseline(base, "component", "quarter", {"internal": "legacy_avg"}, "1996")
    start = F.to_date(
        F.concat(F.substring("quarter", 1, 4), F.lit("-"), F.lpad((F.substring("quarter", 7, 1).cast("int") * 3).cast("string"), 2, "0"), F.lit("-01"))
    )
    rows = base.select(
        "component", "team", "quarter",
        F.col("internal").alias("actual"),
        F.col("customer").alias("stories"),
        "backend", "frontend",
        F.col("quarter").endswith("Q1").cast("int").alias("is_major"),
        F.col("quarter").endswith("Q4").cast("int").alias("is_lts"),
        start.alias("release_date"),
        months_in_field(start, AS_OF).alias("months"),
    )
    return rows, means


def _rows(t: Tables) -> DataFrame:
    rows, means = _facts(t)
    return cut_lineage(forecast.features(rows, means, [*_mature(rows), FORECAST_QUARTER]))


def _split(t: Tables):
    rows = _rows(t)
    q = _mature(rows)
    return rows.where(F.col("quarter").isin(*q[:-1])), rows.where(F.col("quarter") == q[-1])


@query(
    _ROWS
    + f"""SELECT component, quarter, actual::DOUBLE AS actual, stories::DOUBLE AS stories, months::DOUBLE AS months,
        round(legacy_avg{_D}, 6)::DOUBLE AS legacy_avg, has_legacy::DOUBLE AS has_legacy, round(log_months{_D}, 6)::DOUBLE AS log_months,
        round(log_backend{_D}, 6)::DOUBLE AS log_backend, round(log_frontend{_D}, 6)::DOUBLE AS log_frontend,
        is_major::DOUBLE AS is_major, is_lts::DOUBLE AS is_lts, major_stories::DOUBLE AS major_stories FROM x"""
)
def forecast_features(t):
    rows = _rows(t)
    logs = ("legacy_avg", "log_months", "log_backend", "log_frontend")
    return rows.select(
        "component", "quarter", "actual", "stories", "months", "has_legacy", "is_major", "is_lts",
        F.col("major_stories").cast("double").alias("major_stories"), *[rounded(c, 6).alias(c) for c in logs],
    )


def _model(train: DataFrame, name: str) -> forecast.Fitted:
    """The named model. Where the dispersion of few counts does not settle, selection leaves the
    count regression out; a query of its own shows the last round, and ``converged`` as false."""
    found = forecast.fit_all(train, TREES, names=[name])
    if found or name != "NegBin":
        return found[0]
    return forecast.Fitted(name, forecast.fit_negative_binomial(train, forecast.GLM_TERMS, "actual", "log_months"))


def _fitted(t: Tables, name: str) -> DataFrame:
    train, valid = _split(t)
    model = _model(train, name)
    converged = F.lit(bool(getattr(model.model, "converged", True)))
    return model.predict(valid).select(
        "component", "quarter", "actual", rounded("prediction", 4).alias("predicted"), converged.alias("converged")
    )


@query()
def negbin_forecast(t):
    return _fitted(t, "NegBin")


@query()
def poisson_forecast(t):
    return _fitted(t, "Quasi-Poisson")


@query()
def forest_forecast(t):
    return _fitted(t, "Random Forest")


_EQUATIONS = "SELECT unnest(['intercept', " + ", ".join(f"'{c}'" for c in forecast.GLM_TERMS) + "]) AS term, 0.0::DOUBLE AS share"


def _equations(t: Tables, name: str) -> DataFrame:
    """What is left of each score equation, as a share of the sum of its absolute terms.

    At the maximum of the likelihood the weighted residuals times a term add up to zero.
    """
    train, _ = _split(t)
    fitted = _model(train, name)
    fitted.cap = float("inf")
    theta = getattr(fitted.model, "theta", np.inf)
    rows = fitted.predict(train).withColumn("intercept", F.lit(1.0))
    part = (F.col("actual") - F.col("prediction")) / (1 + F.col("prediction") / F.lit(float(theta)))
    terms = ["intercept", *forecast.GLM_TERMS]
    sums = rows.agg(*[F.struct(F.sum(F.col(c) * part).alias("s"), F.sum(F.abs(F.col(c) * part)).alias("a")).alias(c) for c in terms])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("term"), F.col(c)["s"].alias("s"), F.col(c)["a"].alias("a")) for c in terms]))
    share = F.abs(rounded(F.col("p.s") / F.greatest(F.col("p.a"), F.lit(1e-9)), 3))
    return sums.select(pairs.alias("p")).select("p.term", share.alias("share"))


@query(_EQUATIONS)
def negbin_score_equations(t):
    return _equations(t, "NegBin")


@query(_EQUATIONS)
def poisson_score_equations(t):
    return _equations(t, "Quasi-Poisson")


@query(
    _ROWS
    + """, mm AS (SELECT quarter, row_number() OVER (ORDER BY release_date) - 1 AS i, n FROM
        (SELECT quarter, release_date, count(*) AS n FROM mq WHERE months >= 9 AND quarter <> '2001.Q2' GROUP BY 1, 2)),
    c AS (SELECT quarter, i, sum(n) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM mm)
    SELECT c.quarter, component, actual::DOUBLE AS actual, i::INT AS n_train_quarters, before::BIGINT AS n_train_rows
    FROM c JOIN x USING (quarter) WHERE i >= 2 AND before >= 10"""
)
def walk_forward_folds(t):
    """Which rows are predicted from how many earlier ones; the cheap model stands for all."""
    rows = _rows(t)
    wf = forecast.walk_forward(rows, _mature(rows), prefer=("Quasi-Poisson", "Random Forest"), trees=TREES)
    return wf.select("quarter", "component", "actual", "n_train_quarters", F.col("n_train_rows").cast("long").alias("n_train_rows"))


@query()
def walk_forward(t):
    rows = _rows(t)
    return forecast.walk_forward(rows, _mature(rows), TREES).drop("n_train_quarters", "n_train_rows")


@query()
def defect_forecast(t):
    rows = _rows(t)
    out = forecast.defect_forecast(rows, _mature(rows), FORECAST_QUARTER, trees=TREES)
    return out.select(
        "component", "quarter", "actual", "predicted", "predicted_pct", "risk_level",
        "model_name", "model_r2", "model_cal", "model_mae", "validated_on",
    )


def _bands(c: str) -> str:
    return f"CASE WHEN {c} <= 20 THEN 'Very Low' WHEN {c} <= 40 THEN 'Low' WHEN {c} <= 60 THEN 'Medium' WHEN {c} <= 80 THEN 'High' WHEN {c} > 80 THEN 'Very High' END"


@query(
    _ROWS
    + f""", given AS (SELECT component, quarter, actual, stories * 0.37 + months * 0.011 AS prediction, stories % 83 AS hist FROM x),
    main AS (SELECT *, round((percent_rank() OVER (ORDER BY prediction) * 100){_D}, 1)::DOUBLE AS pct FROM given WHERE quarter = '{FORECAST_QUARTER}'),
    both_ AS (SELECT *, round(((hist + pct) / 2){_D}, 9)::DOUBLE AS b FROM main),
    ranked AS (SELECT component, quarter, round(prediction{_D}, 2)::DOUBLE AS predicted, pct, round(b{_D}, 1)::DOUBLE AS score,
        percent_rank() OVER (ORDER BY b) * 100 AS overall FROM both_),
    wf AS (SELECT component, quarter, round(prediction{_D}, 2)::DOUBLE AS predicted FROM given WHERE quarter LIKE '1998%'),
    merged AS (SELECT g.component, g.quarter, g.actual, g.hist, coalesce(r.predicted, wf.predicted) AS predicted, r.pct, r.score, r.overall
        FROM given g LEFT JOIN ranked r USING (component, quarter) LEFT JOIN wf USING (component, quarter)),
    p AS (SELECT *, coalesce(pct, round((percent_rank() OVER (ORDER BY coalesce(predicted, actual)) * 100){_D}, 1)::DOUBLE) AS predicted_pct FROM merged),
    s AS (SELECT *, coalesce(score, round(((hist + predicted_pct) / 2){_D}, 1)::DOUBLE) AS risk_score FROM p),
    o AS (SELECT *, coalesce(overall, percent_rank() OVER (ORDER BY risk_score) * 100) AS band FROM s)
    SELECT component, quarter, predicted, predicted_pct, {_bands("predicted_pct")} AS risk_level, risk_score, {_bands("band")} AS overall_risk FROM o"""
)
def forecast_ranks(t):
    """Ranks and bands from given predictions, with the forecast quarter in a frame of its own."""
    given = _rows(t).select(
        "component", "quarter", "actual", (F.col("stories") * 0.37 + F.col("months") * 0.011).alias("prediction"), (F.col("stories") % 83).alias("hist")
    )
    given = cut_lineage(given)
    main = given.where(F.col("quarter") == FORECAST_QUARTER).drop("actual")
    wf = given.where(F.col("quarter").startswith("1998")).select("component", "quarter", rounded("prediction", 2).alias("predicted_wf"))
    ranked = forecast.ranked_forecast(main, "hist")
    out = forecast.merge_forecast(given.drop("prediction"), ranked, wf, FORECAST_QUARTER, "hist")
    return out.select("component", "quarter", "predicted", "predicted_pct", "risk_level", "risk_score", "overall_risk")


@query(
    _ROWS
    + f"""SELECT quarter, round((CASE WHEN abs((avg(actual) - avg(stories)) / avg(actual) * 100) > 20 THEN avg(actual) / avg(stories) ELSE 1 END){_D}, 6)::DOUBLE AS factor
    FROM x WHERE actual > 0 OR stories > 0 GROUP BY quarter HAVING avg(stories) > 0 AND avg(actual) > 0"""
)
def calibration_factors(t):
    """The calibration of given predictions for every quarter in which both are seen."""
    rows = _rows(t).withColumn("prediction", F.col("stories")).where("actual > 0 or stories > 0")
    both = rows.groupBy("quarter").agg(F.avg("actual").alias("a"), F.avg("stories").alias("p")).where("a > 0 and p > 0")
    out = forecast.calibration_factors(rows.join(both, "quarter", "left_semi"), ["quarter"])
    return out.withColumn("factor", rounded("factor", 6))


@query(
    _ROWS
    + f""", given AS (SELECT quarter, actual, unnest(['A flat', 'B months', 'C stories']) AS model, unnest([3.0::DOUBLE, months * 0.05::DOUBLE, stories * 0.9::DOUBLE]) AS prediction FROM x),
    s AS (SELECT quarter, model, round((1 - sum((actual - prediction) ** 2) / nullif(var_pop(actual) * count(*), 0)){_D}, 4)::DOUBLE AS r2, round((sum(abs(actual - prediction)) / count(*)){_D}, 4)::DOUBLE AS mae FROM given GROUP BY 1, 2)
    SELECT quarter, model, r2, mae FROM s QUALIFY row_number() OVER (PARTITION BY quarter ORDER BY r2 DESC NULLS LAST, model) = 1"""
)
def model_choice(t):
    """Which of three given predictions explains each quarter best."""
    one = lambda name, c: F.struct(F.lit(name).alias("model"), c.cast("double").alias("prediction"))
    named = F.array(one("A flat", F.lit(3.0)), one("B months", F.col("months") * 0.05), one("C stories", F.col("stories") * 0.9))
    given = _rows(t).select("quarter", "actual", F.explode(named).alias("m")).select("quarter", "actual", "m.*")
    return forecast.best_models(given, ["quarter"])


@query(
    _FACTS
    + """, z AS (SELECT quarter, internal AS a, customer + 1 AS p FROM facts),
    s AS (SELECT quarter, count(*) AS n, sum((a - p) ** 2) AS sse, sum(abs(a - p)) AS sae, var_pop(a) AS v, avg(a) AS ma, avg(p) AS mp FROM z GROUP BY 1)
    SELECT quarter, n, round((1 - sse / nullif(v * n, 0))::DECIMAL(28,10), 4)::DOUBLE AS r2, round((sae / n)::DECIMAL(28,10), 4)::DOUBLE AS mae, round((sqrt(sse / n))::DECIMAL(28,10), 4)::DOUBLE AS rmse,
      round(((ma - mp) / nullif(ma, 0) * 100)::DECIMAL(28,10), 4)::DOUBLE AS bias_pct FROM s"""
)
def error_measures(t):
    rows = facts(t).withColumn("p", F.col("customer") + 1)
    return error_metrics(rows, "internal", "p", ["quarter"])


@query(
    """SELECT round((count(*) FILTER (WHERE n = 0) / count(*) * 100)::DECIMAL(28,10), 2)::DOUBLE AS zero_pct FROM
      (SELECT l_partkey, count(*) FILTER (WHERE l_discount > 0.09 AND l_returnflag = 'R') AS n FROM lineitem GROUP BY 1)"""
)
def zero_share(t):
    hit = (F.col("l_discount") > 0.09) & (F.col("l_returnflag") == "R")
    return forecast.zero_share(
        t.lineitem.groupBy("l_partkey").agg(F.sum(F.when(hit, 1).otherwise(0)).alias("n")), "n"
    )
