"""Look-back windows, scores and the composite risk on the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.operators import periods, scoring
from shiplens.functions.stats import rounded

WINDOWS = (7, 14, 30)
DECAY = {7: 0.50, 14: 0.30, 30: 0.20}

_ACTIVITY = """
WITH m AS (SELECT max(ts)::DATE AS d FROM events),
w(window_days) AS (VALUES (7), (14), (30)),
act AS (
  SELECT user_id, window_days, count(DISTINCT event_id) AS commit_count,
         count(DISTINCT event_type) AS unique_authors, max(ts::DATE) AS last_day
  FROM events, m, w WHERE ts::DATE >= m.d - window_days GROUP BY user_id, window_days),
bug AS (
  SELECT user_id, window_days, count(*) AS bug_count,
         round((sum(least(value, 100.0)) / (count(*) * 100))::DECIMAL(28,10), 4)::DOUBLE AS severity_weighted_score
  FROM events, m, w WHERE event_type = 'error' AND ts::DATE >= m.d - window_days
  GROUP BY user_id, window_days),
p AS (
  SELECT 'commit_count' AS metric, window_days, round((quantile_cont(commit_count::DOUBLE, 0.95))::DECIMAL(28,10), 4)::DOUBLE AS p95
  FROM act WHERE commit_count > 0 GROUP BY window_days
  UNION ALL SELECT 'unique_authors', window_days, round((quantile_cont(unique_authors::DOUBLE, 0.95))::DECIMAL(28,10), 4)::DOUBLE
  FROM act WHERE unique_authors > 0 GROUP BY window_days
  UNION ALL SELECT 'bug_count', window_days, round((quantile_cont(bug_count::DOUBLE, 0.95))::DECIMAL(28,10), 4)::DOUBLE
  FROM bug WHERE bug_count > 0 GROUP BY window_days),
wt(window_days, wgt) AS (VALUES (7, 0.5::DOUBLE), (14, 0.3::DOUBLE), (30, 0.2::DOUBLE)),
churn AS (
  SELECT user_id, round((sum((least(commit_count / pc.p95, 1.0) * 0.7::DOUBLE
           + least(unique_authors / pa.p95, 1.0) * 0.3::DOUBLE) * wgt) / sum(wgt))::DECIMAL(28,10), 4)::DOUBLE AS churn_score
  FROM act JOIN wt USING (window_days)
  JOIN p pc ON pc.metric = 'commit_count' AND pc.window_days = act.window_days
  JOIN p pa ON pa.metric = 'unique_authors' AND pa.window_days = 14
  GROUP BY user_id),
defect AS (
  SELECT user_id, round((sum((least(bug_count / pb.p95, 1.0) * 0.6::DOUBLE
           + least(severity_weighted_score, 1.0) * 0.4::DOUBLE) * wgt) / sum(wgt))::DECIMAL(28,10), 4)::DOUBLE AS defect_score
  FROM bug JOIN wt USING (window_days)
  JOIN p pb ON pb.metric = 'bug_count' AND pb.window_days = bug.window_days
  GROUP BY user_id),
users AS (SELECT DISTINCT user_id FROM events),
sig AS (
  SELECT user_id, coalesce(churn_score, 0) AS churn_score, coalesce(defect_score, 0) AS defect_score
  FROM users LEFT JOIN churn USING (user_id) LEFT JOIN defect USING (user_id)),
comp AS (
  SELECT *, churn_score * 0.25::DOUBLE + defect_score * 0.20::DOUBLE AS composite_raw,
         (churn_score > 0.5)::INT + (defect_score > 0.5)::INT AS signals_above_50
  FROM sig),
risk AS (
  SELECT *, round((least(composite_raw * CASE WHEN signals_above_50 >= 4 THEN 1.25::DOUBLE
      WHEN signals_above_50 = 3 THEN 1.15::DOUBLE WHEN signals_above_50 = 2 THEN 1.05::DOUBLE
      ELSE 1.0::DOUBLE END, 1.0))::DECIMAL(28,10), 4)::DOUBLE AS composite_risk FROM comp),
tiers AS (
  SELECT *, CASE WHEN composite_risk >= 0.75 THEN 'CRITICAL' WHEN composite_risk >= 0.5 THEN 'HIGH'
    WHEN composite_risk >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM risk)
"""


def _activity(t: Tables) -> DataFrame:
    return periods.windowed_activity(t.events, "user_id", "event_id", "event_type", "ts", WINDOWS)


def _errors(t: Tables) -> DataFrame:
    rows = periods.in_windows(
        t.events.select("user_id", "event_type", "value", "ts"), "ts", WINDOWS,
        periods.latest_date(t.events, "ts"),
    ).where(F.col("event_type") == "error")
    n = F.count(F.lit(1))
    return rows.groupBy("user_id", "window_days").agg(
        n.alias("bug_count"),
        rounded(F.sum(F.least("value", F.lit(100.0))) / (n * 100), 4).alias(
            "severity_weighted_score"
        ),
    )


def _params(t: Tables) -> DataFrame:
    return scoring.p95_params(
        _activity(t), ["commit_count", "unique_authors"], "window_days"
    ).unionByName(scoring.p95_params(_errors(t), ["bug_count"], "window_days"))


def _churn_score(t: Tables) -> DataFrame:
    act = _activity(t)
    params = scoring.p95_params(act, ["commit_count", "unique_authors"], "window_days")
    return scoring.decayed_score(
        act, "user_id", "window_days", {"commit_count": 0.7, "unique_authors": 0.3},
        params, DECAY, "churn_score", pinned={"unique_authors": 14},
    )


def _defect_score(t: Tables) -> DataFrame:
    bugs = _errors(t)
    params = scoring.p95_params(bugs, ["bug_count"], "window_days")
    return scoring.decayed_score(
        bugs, "user_id", "window_days", {"bug_count": 0.6, "severity_weighted_score": 0.4},
        params, DECAY, "defect_score", plain=("severity_weighted_score",),
    )


def _risk(t: Tables) -> DataFrame:
    users = t.events.select("user_id").distinct()
    return scoring.composite_risk(
        users,
        [
            (_churn_score(t), "user_id", "churn_score"),
            (_defect_score(t), "user_id", "defect_score"),
        ],
    )


@query(
    _ACTIVITY
    + """SELECT user_id, window_days, commit_count, unique_authors,
         strftime(last_day, '%Y-%m-%d') AS last_commit_date FROM act"""
)
def windowed_activity(t):
    return _activity(t).withColumn("last_commit_date", F.col("last_commit_date").cast("string"))


@query(_ACTIVITY + "SELECT metric, window_days, p95 FROM p")
def p95_params(t):
    return _params(t)


@query(_ACTIVITY + "SELECT user_id, churn_score FROM churn")
def decayed_score(t):
    return _churn_score(t)


@query(
    _ACTIVITY
    + """SELECT user_id, churn_score, defect_score, round((composite_raw)::DECIMAL(28,10), 6)::DOUBLE AS composite_raw,
         signals_above_50, composite_risk, risk_tier FROM tiers"""
)
def composite_risk(t):
    return _risk(t).select(
        "user_id", "churn_score", "defect_score",
        rounded("composite_raw", 6).alias("composite_raw"),
        "signals_above_50", "composite_risk", "risk_tier",
    )


@query(
    _ACTIVITY
    + """, chg AS (SELECT DISTINCT event_type AS change_id, user_id FROM events, m
                   WHERE ts::DATE >= m.d - 7),
    reg AS (SELECT DISTINCT user_id, 1 AS k FROM events, m WHERE ts::DATE < m.d - 7),
    j AS (SELECT change_id, chg.user_id, k, composite_risk, risk_tier FROM chg
          LEFT JOIN reg USING (user_id)
          LEFT JOIN (SELECT * FROM tiers WHERE defect_score > 0) s ON s.user_id = chg.user_id)
    SELECT change_id, count(*) AS n_changed, count(*) FILTER (WHERE k IS NULL) AS n_new,
      count(*) FILTER (WHERE k = 1 AND composite_risk IS NULL) AS n_unscored,
      coalesce(round((avg(composite_risk))::DECIMAL(28,10), 4)::DOUBLE, 0) AS avg_risk,
      coalesce(round((max(composite_risk))::DECIMAL(28,10), 4)::DOUBLE, 0) AS max_risk,
      count(*) FILTER (WHERE risk_tier = 'CRITICAL') AS n_critical,
      count(*) FILTER (WHERE risk_tier = 'HIGH') AS n_high,
      count(*) FILTER (WHERE risk_tier = 'MEDIUM') AS n_medium,
      count(*) FILTER (WHERE risk_tier = 'LOW') AS n_low,
      CASE WHEN coalesce(max(composite_risk), 0) >= 0.75 THEN 'CRITICAL'
           WHEN coalesce(max(composite_risk), 0) >= 0.5 THEN 'HIGH'
           WHEN coalesce(max(composite_risk), 0) >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS change_tier
    FROM j GROUP BY change_id"""
)
def change_risk(t):
    """Each event type of the last week is a change touching its users."""
    ev = t.events
    cut = F.date_sub(periods.latest_date(ev, "ts"), 7)
    changed = ev.where(F.to_date("ts") >= cut).select(
        F.col("event_type").alias("change_id"), "user_id"
    )
    registry = ev.where(F.to_date("ts") < cut).select("user_id")
    scores = _risk(t).where(F.col("defect_score") > 0)
    return scoring.change_risk(changed, "change_id", "user_id", registry, scores)


@query(
    _ACTIVITY
    + """SELECT x.risk_tier, coalesce(n, 0) AS n
    FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('LOW')) x(risk_tier)
    LEFT JOIN (SELECT risk_tier, count(*) AS n FROM tiers GROUP BY risk_tier) USING (risk_tier)"""
)
def tier_counts(t):
    return scoring.tier_counts(_risk(t))


_ISSUES = """
WITH i AS (
  SELECT p_brand, l_shipdate::DATE AS d,
         CASE WHEN l_linestatus = 'O' THEN 'customer' ELSE 'internal' END AS source,
         CASE l_returnflag WHEN 'R' THEN 5.0 WHEN 'A' THEN 3.0 END::DOUBLE AS sev
  FROM lineitem JOIN part ON p_partkey = l_partkey),
b AS (SELECT DISTINCT p_brand, p_type FROM part),
w(window_days) AS (VALUES (30), (90), (365)), m AS (SELECT max(d) AS e FROM i)
"""


@query(
    _ISSUES
    + """SELECT p_type, window_days, count(*) AS bug_count,
      count(*) FILTER (WHERE source = 'customer') AS customer_reported_count,
      count(*) FILTER (WHERE source = 'internal') AS internal_count,
      round((coalesce(sum(CASE WHEN source = 'internal' AND sev IS NULL THEN 3.0::DOUBLE
                              ELSE sev END), 0) / (count(*) * 5))::DECIMAL(28,10), 4)::DOUBLE AS severity_weighted_score
    FROM i JOIN b USING (p_brand), w, m WHERE d >= e - window_days GROUP BY p_type, window_days"""
)
def windowed_defects(t):
    issues = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_brand",
        "l_shipdate",
        F.when(F.col("l_linestatus") == "O", "customer").otherwise("internal").alias("source"),
        F.when(F.col("l_returnflag") == "R", 5.0)
        .when(F.col("l_returnflag") == "A", 3.0)
        .alias("severity"),
    )
    return periods.windowed_defects(
        issues, t.part, "p_brand", "p_type", "l_shipdate", "source", "severity",
        as_of=periods.latest_date(t.lineitem, "l_shipdate"),
    )


_FIVE = """
WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT user_id, ((n * 7 + user_id) % 101 / 100)::DOUBLE AS complexity_score, ((n * 11 + user_id) % 101 / 100)::DOUBLE AS churn_score,
    ((n * 13 + user_id) % 101 / 100)::DOUBLE AS defect_score, ((n * 17 + user_id) % 101 / 100)::DOUBLE AS test_score, ((n * 19 + user_id) % 101 / 100)::DOUBLE AS dependency_score FROM u),
c AS (SELECT *, complexity_score * 0.28::DOUBLE + churn_score * 0.25::DOUBLE + defect_score * 0.20::DOUBLE + test_score * 0.15::DOUBLE + dependency_score * 0.12::DOUBLE AS raw,
    (complexity_score > 0.5)::INT + (churn_score > 0.5)::INT + (defect_score > 0.5)::INT + (test_score > 0.5)::INT + (dependency_score > 0.5)::INT AS above FROM s),
k AS (SELECT user_id, above, round((least(raw * CASE WHEN above >= 4 THEN 1.25::DOUBLE WHEN above = 3 THEN 1.15::DOUBLE WHEN above = 2 THEN 1.05::DOUBLE ELSE 1.0::DOUBLE END, 1.0))::DECIMAL(28,10), 4)::DOUBLE AS composite_risk FROM c)
SELECT user_id, above AS signals_above_50, composite_risk, CASE WHEN composite_risk >= 0.75 THEN 'CRITICAL' WHEN composite_risk >= 0.5 THEN 'HIGH'
    WHEN composite_risk >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM k
"""


@query(_FIVE)
def composite_risk_of_five(t):
    """All five signals by a rule, so that each amplifier acts."""
    n = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    factors = {"complexity_score": 7, "churn_score": 11, "defect_score": 13, "test_score": 17, "dependency_score": 19}
    rows = n.select("user_id", *[(((F.col("n") * k + F.col("user_id")) % 101) / 100).alias(c) for c, k in factors.items()])
    out = scoring.composite_risk(rows.select("user_id"), [(rows.select("user_id", c), "user_id", c) for c in factors])
    return out.select("user_id", "signals_above_50", "composite_risk", "risk_tier")
