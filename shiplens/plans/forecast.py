"""Defect forecast: features, three models, selection, calibration, walk-forward."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.lineage import cut_lineage
from shiplens.functions.stats import error_metrics, exact_percentile, ratio, risk_level, rounded, with_percent_rank

GLM_TERMS = ["legacy_avg", "stories", "log_backend", "log_frontend", "is_major", "is_lts", "has_legacy", "major_stories"]
FOREST_TERMS = ["months", "legacy_avg", "stories", "backend", "frontend", "is_major", "is_lts", "has_legacy"]
MIN_MATURE_MONTHS = 9
CAP_FACTOR = 3.0
BIAS_LIMIT = 20.0
THETA_MAX = 1e6  # from here on the model is a Poisson regression


def features(facts: DataFrame, base: DataFrame, quarters: list[str] | None = None) -> DataFrame:
    """Model columns from facts with component, quarter, months, stories, backend, frontend,
    is_major, is_lts and actual.

    A missing baseline is flagged and imputed by the median over the component x quarter rows of
    ``quarters``, the ones in use (all if None).
    """
    rows = facts.join(base.select("component", F.col("legacy_avg").cast("double").alias("legacy_raw")), "component", "left")
    used = rows if quarters is None else rows.where(F.col("quarter").isin(*quarters))
    return impute_baseline(rows, used).withColumns(
        {
            "log_months": F.log(F.greatest(F.col("months").cast("double"), F.lit(1.0))),
            "log_backend": F.log1p("backend"),
            "log_frontend": F.log1p("frontend"),
            "major_stories": F.col("is_major") * F.col("stories"),
            **{c: F.col(c).cast("double") for c in ("is_major", "is_lts", "has_legacy", "stories", "actual", "months")},
        }
    )


def impute_baseline(rows: DataFrame, used: DataFrame) -> DataFrame:
    """``legacy_avg`` and ``has_legacy`` of ``rows`` by the median of ``legacy_raw`` over ``used``."""
    return _imputed(rows, exact_percentile(used, [], "legacy_raw", 0.5, "q").scalar())


def _imputed(rows: DataFrame, median: Column) -> DataFrame:
    return rows.withColumns(
        {
            "legacy_avg": F.coalesce("legacy_raw", median),
            "has_legacy": F.col("legacy_raw").isNotNull().cast("double"),
        }
    )


def mature_quarters(releases: DataFrame, forecast_quarter: str, min_months: int = MIN_MATURE_MONTHS) -> list[str]:
    """Labels of mature quarters by date: all but the last train, the last validates."""
    rows = (
        releases.where(
            F.col("quarter").contains(".Q")
            & (F.col("quarter") != forecast_quarter)
            & F.col("release_date").isNotNull()
            & (F.col("months") >= min_months)
        )
        .select("quarter", "release_date")
        .distinct()
        .orderBy("release_date", "quarter")
    )
    return [r["quarter"] for r in rows.collect()]


@dataclass
class LogLinear:
    """A fitted log-link count model: exp(b . x + offset)."""

    terms: list[str]
    coef: np.ndarray
    theta: float = math.inf
    iterations: int = 0
    converged: bool = True

    def predict(self, df: DataFrame, offset: str) -> DataFrame:
        eta = F.lit(float(self.coef[0])) + F.col(offset)
        for t, b in zip(self.terms, self.coef[1:]):
            eta = eta + F.col(t) * F.lit(float(b))
        return df.withColumn("prediction", F.exp(eta))


def _psi(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digamma and trigamma of positive numbers: up to six by recurrence, then the asymptotic series."""
    x = np.array(x, dtype=float)
    first, second = np.zeros_like(x), np.zeros_like(x)
    while (low := x < 6).any():
        first[low] -= 1 / x[low]
        second[low] += 1 / x[low] ** 2
        x[low] += 1
    z = 1 / x**2
    first += np.log(x) - 0.5 / x - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240)))
    second += 1 / x + z / 2 + z / x * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z / 30)))
    return first, second


def _sums(rows: DataFrame, terms: list[str], target: str, offset: str, coef, theta: float):
    """One distributed pass at the current estimate: X'WX, X'Wz, the dispersion's score and
    slope, the Pearson sum and the row count.

    Each task adds up its own rows with numpy and emits p(p + 3)/2 + 4 numbers; Spark sums
    those by position. Only the sums reach the driver.
    """
    coef = np.asarray(coef, dtype=float)

    def partial(batches):
        total = None
        for pdf in batches:
            y = pdf[target].to_numpy(float)
            off = pdf[offset].to_numpy(float)
            x = np.column_stack([np.ones(len(pdf)), pdf[terms].to_numpy(float)])
            eta = np.clip(x @ coef + off, -30.0, 30.0)
            mu = np.exp(eta)
            w = mu / (1 + mu / theta)
            z = eta - off + (y - mu) / mu
            gram = (x * w[:, None]).T @ x
            right = x.T @ (w * z)
            at, at2 = _psi(y + theta)
            low, low2 = _psi(np.array([theta]))
            up, up2 = at - low, low2 - at2
            score = up + np.log(theta) + 1 - np.log(theta + mu) - (y + theta) / (theta + mu)
            slope = -up2 + 1 / theta - 2 / (theta + mu) + (y + theta) / (theta + mu) ** 2
            part = np.concatenate(
                [
                    gram[np.triu_indices(len(coef))],
                    right,
                    [score.sum(), slope.sum(), ((y / mu - 1) ** 2).sum(), len(y)],
                ]
            )
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": total})

    collected = rows.mapInPandas(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    flat = np.array([r["v"] for r in sorted(collected.collect())])
    if not len(flat):
        raise ValueError("no complete row to fit on")
    p = len(coef)
    cut = p * (p + 1) // 2
    gram = np.zeros((p, p))
    gram[np.triu_indices(p)] = flat[:cut]
    gram = gram + np.triu(gram, 1).T
    return gram, flat[cut : cut + p], *flat[cut + p :]


def fit_negative_binomial(
    df: DataFrame, terms: list[str], target: str, offset: str, max_iter: int = 40, tol: float = 1e-5
) -> LogLinear:
    """Negative-binomial regression with log link: reweighted least squares for the
    coefficients and Newton steps of the likelihood for the dispersion, one pass per round.
    """
    rows = df.select(
        F.col(target).cast("double").alias(target), F.col(offset).cast("double").alias(offset),
        *[F.col(t).cast("double").alias(t) for t in terms],
    ).dropna().cache()
    kept = rows
    # Terms are brought to a common size, so that near-collinear ones are told from small ones.
    first = rows.agg(
        F.avg(F.col(target) / F.exp(offset)).alias("m"), *[F.max(F.abs(t)).alias(t) for t in terms]
    ).first()
    size = np.array([first[t] or 1.0 for t in terms])
    rows = rows.select(target, offset, *[(F.col(t) / float(s)).alias(t) for t, s in zip(terms, size)])
    mean = first["m"]
    coef = np.zeros(len(terms) + 1)
    coef[0] = math.log(max(mean or 0.0, 1e-6))
    theta, done, converged = THETA_MAX, 0, False
    for done in range(1, max_iter + 1):
        gram, right, score, slope, pearson, n = _sums(rows, terms, target, offset, coef, theta)
        # Constant or collinear terms leave the system singular: least squares drops them.
        new = np.linalg.lstsq(gram, right, rcond=1e-10)[0]
        change = float(np.max(np.abs(new - coef) / (1 + np.abs(coef))))
        coef = new
        if done == 3:
            theta_new = n / pearson if pearson > 0 else theta
        elif done > 3 and slope < 0:
            theta_new = min(max(theta - score / slope, theta / 5, 1e-4), theta * 5, THETA_MAX)
        elif done > 3:
            theta_new = min(theta * 2, THETA_MAX) if score > 0 else max(theta / 2, 1e-4)
        else:
            theta_new = theta
        settled = done > 4 and abs(theta_new - theta) <= tol * theta
        theta = theta_new
        if change < tol and (settled or theta >= THETA_MAX):
            converged = True
            break
    kept.unpersist()
    coef = np.concatenate([coef[:1], coef[1:] / size])
    return LogLinear(terms, coef, float(theta), done, converged)


def fit_poisson(df: DataFrame, terms: list[str], target: str, offset: str):
    """Quasi-Poisson: same means as Poisson, the dispersion only widens errors."""
    rows = _vectors(df, terms)
    glm = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol=target, featuresCol="_features",
        offsetCol=offset, maxIter=50, regParam=1e-8,
    )
    return glm.fit(rows)


def fit_forest(df: DataFrame, terms: list[str], target: str, trees: int = 500, seed: int = 1234):
    """A third of the terms tried at each split, leaves of five rows, no other bound on depth than
    the learner's own of 30."""
    return RandomForestRegressor(
        numTrees=trees, seed=seed, labelCol=target, featuresCol="_features", maxDepth=30,
        minInstancesPerNode=5, featureSubsetStrategy="onethird",
    ).fit(_vectors(df, terms))


def _vectors(df: DataFrame, terms: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=terms, outputCol="_features").transform(df)


@dataclass
class Fitted:
    name: str
    model: object
    cap: float = math.inf
    r2: float = field(default=float("nan"))

    def predict(self, df: DataFrame) -> DataFrame:
        if self.name == "NegBin":
            out = self.model.predict(df, "log_months")
        elif self.name == "Quasi-Poisson":
            out = self.model.transform(_vectors(df, GLM_TERMS)).drop("_features")
        else:
            out = self.model.transform(_vectors(df, FOREST_TERMS)).drop("_features")
        if self.name != "Random Forest":
            out = out.withColumn("prediction", F.least("prediction", F.lit(self.cap)))
        return out


def fit_all(train: DataFrame, trees: int = 500, seed: int = 1234, names=None) -> list[Fitted]:
    """The three candidate models; one that cannot be fitted or has not converged is left out."""
    train = train.cache()
    cap = CAP_FACTOR * float(train.agg(F.max("actual")).first()[0] or 0.0)
    makers = {
        "NegBin": lambda: fit_negative_binomial(train, GLM_TERMS, "actual", "log_months"),
        "Quasi-Poisson": lambda: fit_poisson(train, GLM_TERMS, "actual", "log_months"),
        "Random Forest": lambda: fit_forest(train, FOREST_TERMS, "actual", trees, seed),
    }
    out = []
    for name in names or makers:
        try:
            model = makers[name]()
        except (ArithmeticError, ValueError, IndexError, np.linalg.LinAlgError, PySparkException):
            continue
        if getattr(model, "converged", True):
            out.append(Fitted(name, model, cap))
    train.unpersist()
    return out


def select_model(models: list[Fitted], valid: DataFrame) -> Fitted:
    """Highest R2 on the validation quarter."""
    for m in models:
        r = error_metrics(m.predict(valid), "actual", "prediction").first()
        m.r2 = r["r2"] if r and r["r2"] is not None else float("-inf")
    return max(models, key=lambda m: m.r2)


def calibration_factors(predicted: DataFrame, keys: list[str], limit: float = BIAS_LIMIT) -> DataFrame:
    """``factor`` per group: the scale for ``prediction`` against ``actual``, 1 unless the bias is
    beyond the limit or one of the means is zero."""
    actual, mean = F.avg("actual"), F.avg("prediction")
    biased = F.abs((actual - mean) / F.nullif(actual, F.lit(0.0)) * 100) > limit
    factor = F.when(biased & (mean != 0), actual / F.nullif(mean, F.lit(0.0))).otherwise(1.0)
    return predicted.groupBy(*keys).agg(factor.alias("factor"))


def calibration_factor(predicted: DataFrame, limit: float = BIAS_LIMIT) -> float:
    """The factor of all rows together."""
    return float(calibration_factors(predicted, [], limit).first()["factor"])


def best_models(predicted: DataFrame, keys: list[str], model: str = "model") -> DataFrame:
    """The model of highest R2 per group, of equal ones the first by name; R2 of none is lowest."""
    scores = error_metrics(predicted, "actual", "prediction", [*keys, model])
    order = F.struct(-F.coalesce("r2", F.lit(float("-inf"))), F.col(model))
    return scores.groupBy(*keys).agg(F.min_by(F.struct(model, "r2", "mae"), order).alias("_b")).select(*keys, "_b.*")


def calibration(model: Fitted, valid: DataFrame, limit: float = BIAS_LIMIT) -> float:
    return calibration_factor(model.predict(valid), limit)


def fold_baselines(rows: DataFrame, quarters: list[str]) -> dict[tuple[int, bool], float]:
    """Medians of ``legacy_raw`` by place of a quarter: over the quarters before it, and (True) over its own rows.

    All folds are keys of one grouped percentile. A key without a value is absent.
    """
    place = F.array_position(F.array(*[F.lit(q) for q in quarters]), F.col("quarter")).cast("int") - 1
    own = F.array(F.struct(place.alias("fold"), F.lit(True).alias("own")))
    # The place after the last keeps the sequence ascending; no fold has it.
    later = F.transform(F.sequence(place + 1, F.lit(len(quarters))), lambda i: F.struct(i.alias("fold"), F.lit(False).alias("own")))
    keyed = rows.where(place >= 0).select("legacy_raw", F.explode(F.concat(own, later)).alias("f")).select("legacy_raw", "f.*")
    found = exact_percentile(keyed, ["fold", "own"], "legacy_raw", 0.5, "q")
    return {(r["fold"], r["own"]): r["q"] for r in found.collect()}


def walk_forward(
    rows: DataFrame,
    quarters: list[str],
    trees: int = 500,
    prefer=("Random Forest", "NegBin", "Quasi-Poisson"),
    min_rows: int = 10,
    calibrate_on_target: bool = False,
    at_once: int = 4,
) -> DataFrame | None:
    """Out-of-sample predictions: each quarter from the third on, from the earlier ones only.

    Missing baselines are imputed anew from the rows each fit and each prediction uses.
    ``calibrate_on_target`` scales by the predicted quarter's own mean; it looks at the answer, so
    it is off by default. Up to ``at_once`` quarters are fitted at the same time, as one small fit
    leaves most of a cluster idle. Medians and row counts of all quarters are taken before the fits.
    """
    rows = rows.where(F.col("quarter").isin(*quarters)).cache()
    counts = {r["quarter"]: r["count"] for r in rows.groupBy("quarter").count().collect()}
    medians = fold_baselines(rows, quarters)

    def fold(i: int) -> DataFrame | None:
        n_train = sum(counts.get(q, 0) for q in set(quarters[:i]))
        if n_train < min_rows or not counts.get(quarters[i]):
            return None
        before, own = medians.get((i, False)), medians.get((quarters.index(quarters[i]), True))
        train = _imputed(rows.where(F.col("quarter").isin(*quarters[:i])), F.lit(before).cast("double"))
        target = _imputed(rows.where(F.col("quarter") == quarters[i]), F.lit(own).cast("double"))
        model = next((m for name in prefer for m in fit_all(train, trees, names=[name])), None)
        if model is None:
            return None
        scale = calibration(model, target) if calibrate_on_target else 1.0
        part = model.predict(target).select(
            "quarter", "component", "actual",
            rounded(F.col("prediction") * scale, 2).alias("predicted_wf"),
            F.lit(model.name).alias("model_name"),
            F.lit(i).alias("n_train_quarters"), F.lit(n_train).alias("n_train_rows"),
        )
        return cut_lineage(part)  # the plan of all folds is then a union of small tables

    with ThreadPoolExecutor(at_once) as pool:
        parts = [p for p in pool.map(fold, range(2, len(quarters))) if p is not None]
    rows.unpersist()
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def ranked_forecast(main: DataFrame, hist: str | None = None) -> DataFrame:
    """The forecast quarter's rows (``quarter``, ``component``, ``prediction``) ranked among themselves.

    Ranks are taken before rounding. With ``hist`` the mean of it and the rank is ranked too.
    """
    out = with_percent_rank(main, "prediction", "predicted_pct", digits=1)
    out = out.withColumns({"predicted": rounded("prediction", 2), "risk_level": risk_level(F.col("predicted_pct"))})
    if hist:
        out = out.withColumn("_both", rounded((F.col(hist) + F.col("predicted_pct")) / 2, 9))
        out = with_percent_rank(out, "_both", "_overall")
        out = out.withColumns({"risk_score": rounded("_both", 1), "overall_risk": risk_level(F.col("_overall"))})
        out = out.drop("_both", "_overall", hist)
    return out.drop("prediction")


def merge_forecast(rows: DataFrame, ranked: DataFrame, wf: DataFrame | None, forecast_quarter: str, hist: str | None = None) -> DataFrame:
    """Predictions on all rows: the ranked forecast on its quarter, walk-forward on mature ones,
    null on the earliest. Rows without a rank of their own are ranked over the whole frame by their
    prediction, or by what happened."""
    out = rows.join(ranked, ["quarter", "component"], "left")
    if wf is not None:
        out = out.join(wf.select("quarter", "component", "predicted_wf"), ["quarter", "component"], "left")
    else:
        out = out.withColumn("predicted_wf", F.lit(None).cast("double"))
    predicted = F.when(F.col("quarter") == forecast_quarter, F.col("predicted")).otherwise(F.col("predicted_wf"))
    out = out.withColumn("predicted", predicted).drop("predicted_wf")
    out = out.withColumn("_on", F.coalesce("predicted", "actual"))
    out = with_percent_rank(out, "_on", "_pct", digits=1)
    pct = F.coalesce("predicted_pct", "_pct")
    out = out.withColumns({"predicted_pct": pct, "risk_level": F.coalesce("risk_level", risk_level(pct))}).drop("_on", "_pct")
    if hist:
        score = F.coalesce("risk_score", rounded((F.coalesce(hist, F.lit(0.0)) + F.col("predicted_pct")) / 2, 1))
        out = with_percent_rank(out.withColumn("risk_score", score), "risk_score", "_overall")
        out = out.withColumn("overall_risk", F.coalesce("overall_risk", risk_level(F.col("_overall")))).drop("_overall")
    return out


def defect_forecast(
    rows: DataFrame,
    quarters: list[str],
    forecast_quarter: str,
    hist: str | None = None,
    trees: int = 500,
    forward: bool = True,
) -> DataFrame:
    """The selected model's forecast, walk-forward predictions, ranks and bands on all rows."""
    train = rows.where(F.col("quarter").isin(*quarters[:-1]))
    valid = rows.where(F.col("quarter") == quarters[-1])
    best = select_model(fit_all(train, trees), valid)
    scale = calibration(best, valid)
    mae = error_metrics(best.predict(valid), "actual", "prediction").first()["mae"]
    target = rows.where(F.col("quarter") == forecast_quarter).withColumns(
        {"log_months": F.lit(math.log(3)), "is_major": F.lit(1.0), "is_lts": F.lit(1.0), "major_stories": F.col("stories")}
    )
    main = best.predict(target).select(
        "quarter", "component", (F.col("prediction") * scale).alias("prediction"), *([hist] if hist else [])
    )
    ranked = ranked_forecast(main, hist).withColumns(
        {
            "model_name": F.lit(best.name),
            "model_r2": F.lit(round(float(best.r2), 3)),
            "model_cal": F.lit(round(scale, 3)),
            "model_mae": F.lit(round(float(mae), 2)),
            "validated_on": F.lit(quarters[-1]),
        }
    )
    return merge_forecast(rows, ranked, walk_forward(rows, quarters, trees) if forward else None, forecast_quarter, hist)


def zero_share(df: DataFrame, column: str) -> DataFrame:
    """Percent of rows at zero: too many make a count forecast pointless."""
    return df.agg(
        rounded(
            ratio(F.sum(F.when(F.col(column) == 0, 1).otherwise(0)), F.count(F.lit(1))) * 100, 2
        ).alias("zero_pct")
    )
