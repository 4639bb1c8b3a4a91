"""Bridges, periods and report tables on orders by nation and quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.functions.stats import ratio, rounded
from shiplens.operators import bridge, periods
from shiplens.plans import reports

_BASE = """
WITH co AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS d, o_orderpriority,
              c_custkey, c_mktsegment, n_name, r_name,
              year(o_orderdate)::VARCHAR || '.Q' || quarter(o_orderdate)::VARCHAR AS quarter
            FROM orders JOIN customer ON c_custkey = o_custkey
            JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
m AS (SELECT DISTINCT n_name AS module_path, r_name AS component_name FROM co
      UNION SELECT DISTINCT n_name, c_mktsegment FROM co),
b AS (SELECT module_path, component_name, count(*) OVER (PARTITION BY module_path) AS n_components,
        round((1 / count(*) OVER (PARTITION BY module_path))::DECIMAL(28,10), 4)::DOUBLE AS weight FROM m)
"""


def _orders(t: Tables) -> DataFrame:
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "o_orderkey", "o_orderstatus", "o_totalprice",
            F.to_date("o_orderdate").alias("d"), "o_orderpriority", "c_custkey",
            "c_mktsegment", "n_name", "r_name",
            periods.year_quarter(F.col("o_orderdate")).alias("quarter"),
        )
    )


def _bridge(t: Tables) -> DataFrame:
    co = _orders(t)
    pairs = co.select(
        F.col("n_name").alias("module_path"), F.explode(F.array("r_name", "c_mktsegment")).alias("component_name")
    )
    return bridge.bridge_weights(pairs, "module_path", "component_name")


@query(_BASE + "SELECT * FROM b")
def bridge_weights(t):
    return _bridge(t)


@query(
    _BASE
    + """, p AS (SELECT DISTINCT n_name AS module_path, r_name AS component_name,
        CASE WHEN r_name <> 'ASIA' THEN 'team ' || left(r_name, 2) END AS team_name FROM co),
    f AS (SELECT DISTINCT 'x-' || c_mktsegment AS module_path, c_mktsegment AS component_name FROM co),
    a AS (SELECT * FROM p UNION SELECT module_path, component_name, NULL FROM f)
    SELECT component_name, max(team_name) AS team_name, count(*) AS n_modules FROM a GROUP BY component_name"""
)
def build_bridge(t):
    """Authoritative map with teams, extended by approved extra paths."""
    co = _orders(t)
    primary = co.select(
        F.concat(F.lit(" "), F.col("n_name")).alias("module_path"),
        F.concat(F.col("r_name"), F.lit(" ")).alias("component_name"),
        F.when(F.col("r_name") == "ASIA", "NoMappedTeam")
        .otherwise(F.concat(F.lit("team "), F.substring("r_name", 1, 2)))
        .alias("team_name"),
    ).distinct()
    extra = co.select(
        F.concat(F.lit("x-"), F.col("c_mktsegment")).alias("module_path"),
        F.col("c_mktsegment").alias("component_name"),
    ).distinct()
    weights, teams = bridge.build_bridge(primary, extra)
    n = weights.groupBy("component_name").agg(F.count(F.lit(1)).alias("n_modules"))
    return teams.join(n, "component_name")


@query(
    _BASE
    + """, x AS (SELECT n_name, quarter, o_orderpriority[1:1] AS p, o_totalprice / 1000 AS v FROM co),
    s AS (SELECT component_name, quarter,
        sum(CASE WHEN p = '1' THEN v ELSE 0 END * weight) AS java_ins,
        sum(CASE WHEN p = '2' THEN v ELSE 0 END * weight) AS tsx_ins,
        sum(CASE WHEN p = '3' THEN v ELSE 0 END * weight) AS ts_ins
      FROM x JOIN b ON module_path = n_name GROUP BY 1, 2)
    SELECT component_name, quarter, round((java_ins)::DECIMAL(28,10), 4)::DOUBLE AS backend_changes,
      round((tsx_ins)::DECIMAL(28,10), 4)::DOUBLE AS frontend_changes, round((java_ins + tsx_ins + ts_ins)::DECIMAL(28,10), 4)::DOUBLE AS total_churn FROM s"""
)
def weighted_rollup(t):
    """Amounts by priority stand in for insertions by extension."""
    co = _orders(t)
    head = F.substring("o_orderpriority", 1, 1)
    value = F.col("o_totalprice") / 1000
    cols = {f"{e}_{m}": F.lit(0.0) for e in ("java", "tsx", "scss", "js", "ts", "jsp", "css") for m in ("Insertions", "Deletions")}
    for e, p in (("java", "1"), ("tsx", "2"), ("ts", "3")):
        cols[f"{e}_Insertions"] = F.when(head == p, value).otherwise(0.0)
    rows = co.select(F.col("n_name").alias("module_path"), "quarter", *[c.alias(n) for n, c in cols.items()])
    rolled = bridge.weighted_rollup(
        rows, _bridge(t), "module_path", ["component_name", "quarter"], list(cols)
    )
    out = bridge.derived_churn(rolled)
    return out.select(
        "component_name", "quarter",
        *[rounded(c, 4).alias(c) for c in ("backend_changes", "frontend_changes", "total_churn")],
    )


_PERIODS = _BASE + """, per AS (
    SELECT year(d)::VARCHAR || '.Q1' AS label, min(d) AS s, max(d) AS e FROM co
    WHERE month(d) <= 10 GROUP BY 1),
asg AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN quarter ELSE label END AS q
    FROM co LEFT JOIN per ON d BETWEEN s AND e)
"""


def _periods(t: Tables) -> DataFrame:
    co = _orders(t)
    return (
        co.where(F.month("d") <= 10)
        .groupBy(F.concat(F.year("d").cast("string"), F.lit(".Q1")).alias("label"))
        .agg(F.min("d").alias("s"), F.max("d").alias("e"))
    )


def _assigned(t: Tables) -> DataFrame:
    co = _orders(t).withColumnRenamed("quarter", "given")
    explicit = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("given"))
    return periods.assign_period(
        co, F.col("d"), _periods(t), "label", "s", "e", explicit, first_label="1996.Q1"
    )


@query(_PERIODS + "SELECT o_orderkey, q AS quarter FROM asg WHERE q >= '1996.Q1'")
def assign_period(t):
    return _assigned(t).select("o_orderkey", "quarter")


@query(
    _PERIODS
    + """, bounds AS (SELECT min(s) AS a, max(e) AS z FROM per)
    SELECT strftime(x, '%Y-%m-%d') AS day FROM bounds, unnest(generate_series(a, z, INTERVAL 1 DAY)) u(x)
    WHERE NOT EXISTS (SELECT 1 FROM per WHERE x::DATE BETWEEN s AND e)"""
)
def uncovered_days(t):
    return periods.uncovered_days(_periods(t), "label", "s", "e").select(
        F.col("day").cast("string").alias("day")
    )


_COUNTS = _BASE + """, i AS (
    SELECT quarter, o_orderstatus, CASE WHEN o_orderpriority < '3' THEN 'customer'
        WHEN o_orderpriority LIKE '3%' THEN 'story' ELSE 'internal' END AS kind,
      unnest([c_mktsegment, n_name]) AS component_id FROM co)
"""


def _issues(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    return _orders(t).withColumns(
        {
            "kind": F.when(p < "3", "customer").when(p.startswith("3"), "story").otherwise("internal"),
            "components": F.concat("c_mktsegment", F.lit("|"), "r_name", F.lit(" > "), "n_name", F.lit("| ")),
            "blocker": F.col("o_orderstatus") == "F",
        }
    )


def _component_dim(t: Tables) -> DataFrame:
    co = _orders(t)
    names = co.select(F.col("c_mktsegment").alias("component_name")).distinct()
    return names.withColumn("component_id", F.col("component_name"))


@query(
    _COUNTS
    + """SELECT component_id, quarter, count(*) FILTER (WHERE kind = 'customer') AS customer_count,
      count(*) FILTER (WHERE kind = 'internal') AS internal_count,
      count(*) FILTER (WHERE kind = 'story') AS story_count,
      count(*) FILTER (WHERE kind = 'internal' AND o_orderstatus = 'F') AS blocker_count
    FROM i WHERE component_id NOT LIKE 'NATION%' GROUP BY 1, 2"""
)
def period_counts(t):
    return periods.period_counts(
        _issues(t), _component_dim(t), F.col("components"), "kind", "quarter", blocker="blocker"
    )


@query(
    _COUNTS
    + "SELECT component_id AS component_name, count(*) AS n FROM i WHERE component_id LIKE 'NATION%' GROUP BY 1"
)
def unmatched_components(t):
    return periods.unmatched_components(_issues(t), _component_dim(t), F.col("components"))


@query(
    _BASE
    + """, br AS (SELECT n_name, quarter, count(*) AS c FROM co WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT component_name, quarter, round((sum(c * weight))::DECIMAL(28,10), 0)::DOUBLE::BIGINT AS breaking_count
    FROM br JOIN b ON module_path = n_name WHERE quarter >= '1996.Q1' GROUP BY 1, 2"""
)
def breaking_rollup(t):
    rows = (
        _orders(t)
        .where(F.col("o_orderstatus") == "F")
        .groupBy(F.col("n_name").alias("module_path"), "quarter")
        .agg(F.count(F.lit(1)).alias("breaking_count"))
    )
    return bridge.breaking_rollup(rows, _bridge(t), "1996.Q1")


@query(
    _BASE
    + """, fl AS (SELECT n_name, round((count(*) FILTER (WHERE o_orderstatus = 'F') / count(*))::DECIMAL(28,10), 4)::DOUBLE AS pct
       FROM co GROUP BY 1),
    hot AS (SELECT DISTINCT component_name FROM fl JOIN b ON module_path = n_name
       WHERE pct >= 0.34 AND component_name NOT IN (SELECT c_mktsegment FROM co)),
    s AS (SELECT r_name AS component_name, quarter, round((sum(o_totalprice) / 1000)::DECIMAL(28,10), 2)::DOUBLE AS total_churn FROM co GROUP BY 1, 2)
    SELECT s.component_name, quarter, total_churn, h.component_name IS NOT NULL AS is_feature_flagged,
      CASE WHEN h.component_name IS NOT NULL THEN 0.5 ELSE 1.0 END::DOUBLE AS churn_dampening_factor,
      round((total_churn * CASE WHEN h.component_name IS NOT NULL THEN 0.5 ELSE 1.0 END)::DECIMAL(28,10), 3)::DOUBLE AS dampened_total_churn
    FROM s LEFT JOIN hot h ON h.component_name = s.component_name"""
)
def flag_dampening(t):
    co = _orders(t)
    flags = (
        co.groupBy(F.col("n_name").alias("module_path"))
        .agg(
            rounded(
                ratio(F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)), F.count(F.lit(1))), 4
            ).alias("flag_pct")
        )
        .withColumn("is_flagged", F.col("flag_pct") >= 0.30)
    )
    facts = co.groupBy(F.col("r_name").alias("component_name"), "quarter").agg(
        rounded(F.sum("o_totalprice") / 1000, 2).alias("total_churn")
    )
    regions = _bridge(t).join(facts.select("component_name"), "component_name", "left_semi")
    out = bridge.flag_dampening(
        facts, flags, regions, "component_name", ["total_churn"], factor=0.5, threshold=0.34,
        excluded="feature-flag",
    )
    return out.withColumn("dampened_total_churn", rounded("dampened_total_churn", 3))


_FACTS = _BASE + """, facts AS (
    SELECT n_name AS component, r_name AS team, quarter,
      count(*) FILTER (WHERE o_orderstatus = 'F') AS customer, count(*) FILTER (WHERE o_orderstatus = 'O') AS internal,
      count(*) FILTER (WHERE o_orderstatus = 'O' AND o_orderpriority LIKE '1%') AS blocker,
      round((sum(CASE WHEN o_orderpriority < '3' THEN o_totalprice ELSE 0 END) / 1000)::DECIMAL(28,10), 2)::DOUBLE AS backend,
      round((sum(CASE WHEN o_orderpriority >= '3' THEN o_totalprice ELSE 0 END) / 1000)::DECIMAL(28,10), 2)::DOUBLE AS frontend,
      round((sum(o_totalprice) / 1000)::DECIMAL(28,10), 2)::DOUBLE AS total_churn
    FROM co GROUP BY 1, 2, 3),
base AS (SELECT component, avg(customer) AS legacy_customer_avg, avg(internal) AS legacy_internal_avg
    FROM facts WHERE quarter LIKE '%1996%' GROUP BY 1),
lv AS (SELECT facts.*, legacy_customer_avg, legacy_internal_avg FROM facts LEFT JOIN base USING (component)),
med AS (SELECT median(legacy_customer_avg) AS v FROM lv),
sc AS (SELECT lv.*, coalesce(legacy_customer_avg, v) AS level, ln(1 + backend) + 0.5::DOUBLE * ln(1 + frontend) AS ch FROM lv, med),
st AS (SELECT avg(level) AS ml, greatest(stddev_samp(level), 1e-6) AS sl, avg(ch) AS mc, greatest(stddev_samp(ch), 1e-6) AS dc FROM sc),
zz AS (SELECT sc.*, round(((level - ml) / sl * 0.6::DOUBLE + (ch - mc) / dc * 0.4::DOUBLE)::DECIMAL(28,10), 9)::DOUBLE AS score FROM sc, st),
fr AS (SELECT * EXCLUDE (level, ch, score), round((percent_rank() OVER (ORDER BY score) * 100)::DECIMAL(28,10), 1)::DOUBLE AS hist_score FROM zz),
frame AS (SELECT *, CASE WHEN hist_score <= 20 THEN 'Very Low' WHEN hist_score <= 40 THEN 'Low'
    WHEN hist_score <= 60 THEN 'Medium' WHEN hist_score <= 80 THEN 'High' ELSE 'Very High' END AS hist_risk_level FROM fr)
"""


def facts(t: Tables) -> DataFrame:
    """Orders per nation and quarter as component facts."""
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    def amount(cond):
        return rounded(F.sum(F.when(cond, F.col("o_totalprice")).otherwise(0.0)) / 1000, 2)

    return (
        _orders(t)
        .groupBy(F.col("n_name").alias("component"), F.col("r_name").alias("team"), "quarter")
        .agg(
            n(status == "F").alias("customer"),
            n(status == "O").alias("internal"),
            n((status == "O") & prio.startswith("1")).alias("blocker"),
            amount(prio < "3").alias("backend"),
            amount(prio >= "3").alias("frontend"),
            rounded(F.sum("o_totalprice") / 1000, 2).alias("total_churn"),
        )
    )


def frame(t: Tables) -> DataFrame:
    return reports.forecast_frame(
        facts(t), "component", "quarter", "customer", "internal", "backend", "frontend", "1996"
    )


@query(
    _FACTS
    + """SELECT component, team, quarter, customer, internal, blocker, backend, frontend, total_churn,
      round((legacy_customer_avg)::DECIMAL(28,10), 4)::DOUBLE AS legacy_customer_avg,
      round((legacy_internal_avg)::DECIMAL(28,10), 4)::DOUBLE AS legacy_internal_avg, hist_score, hist_risk_level FROM frame"""
)
def forecast_frame(t):
    return frame(t).withColumns(
        {c: rounded(c, 4) for c in ("legacy_customer_avg", "legacy_internal_avg")}
    )


@query(
    _FACTS
    + """SELECT quarter, team, count(*) AS n_components, round((sum(backend))::DECIMAL(28,10), 2)::DOUBLE AS total_backend,
      round((sum(frontend))::DECIMAL(28,10), 2)::DOUBLE AS total_frontend, round((sum(total_churn))::DECIMAL(28,10), 2)::DOUBLE AS total_total_churn,
      round((avg(total_churn))::DECIMAL(28,10), 1)::DOUBLE AS avg_churn_per_comp FROM facts GROUP BY 1, 2"""
)
def churn_by_team(t):
    return reports.churn_by_team(
        facts(t), ["quarter"], "team", ["backend", "frontend", "total_churn"], "total_churn"
    )


@query(
    _FACTS
    + """, rel AS (SELECT quarter, min(d) AS release_date FROM co GROUP BY 1)
    SELECT component, r_name AS region, quarter, total_churn, strftime(release_date, '%Y-%m-%d') AS release_date
    FROM facts JOIN rel USING (quarter) JOIN (SELECT DISTINCT n_name AS component, r_name FROM co) USING (component)"""
)
def churn_by_component(t):
    co = _orders(t)
    dims = co.select(F.col("n_name").alias("component"), F.col("r_name").alias("region")).distinct()
    rel = co.groupBy("quarter").agg(F.min("d").cast("string").alias("release_date"))
    return reports.churn_by_component(
        facts(t).select("component", "quarter", "total_churn"), dims, rel
    )


@query(
    _FACTS
    + """SELECT quarter, team, count(*) AS n_components, sum(customer)::BIGINT AS customer_count,
      sum(internal)::BIGINT AS internal_count, sum(blocker)::BIGINT AS blocker_count,
      round((sum(total_churn))::DECIMAL(28,10), 2)::DOUBLE AS total_total_churn, round((avg(hist_score))::DECIMAL(28,10), 1)::DOUBLE AS avg_risk_score,
      count(*) FILTER (WHERE hist_risk_level IN ('High', 'Very High')) AS n_high_risk,
      CASE WHEN sum(internal) > 0 THEN round((sum(customer) / sum(internal))::DECIMAL(28,10), 2)::DOUBLE END AS customer_internal_ratio,
      CASE WHEN sum(internal) > 0 THEN round((sum(blocker) / sum(internal) * 100)::DECIMAL(28,10), 1)::DOUBLE ELSE 0 END AS blocker_rate
    FROM frame GROUP BY 1, 2"""
)
def team_scorecard(t):
    return reports.team_scorecard(
        frame(t), "quarter", "team", "customer", "internal", "blocker", ["total_churn"],
        "hist_score", "hist_risk_level",
    )


@query(
    _FACTS
    + """, r AS (SELECT *, rank() OVER (PARTITION BY team ORDER BY hist_score DESC) AS rk FROM frame)
    SELECT team, component, quarter, hist_score FROM r WHERE rk <= 5"""
)
def top_per_team(t):
    return reports.top_per_team(frame(t), "team", "hist_score", 5).select(
        "team", "component", "quarter", "hist_score"
    )


@query(
    _FACTS
    + """, h AS (SELECT component, avg(customer) AS am, avg(total_churn) AS ac, count(*) AS n_quarters FROM facts GROUP BY 1),
    hs AS (SELECT avg(am) AS m1, greatest(stddev_samp(am), 1e-6) AS s1, avg(ln(1 + ac)) AS m2, greatest(stddev_samp(ln(1 + ac)), 1e-6) AS s2 FROM h),
    hz AS (SELECT h.*, round(((am - m1) / s1 * 0.6::DOUBLE + (ln(1 + ac) - m2) / s2 * 0.4::DOUBLE)::DECIMAL(28,10), 9)::DOUBLE AS hsc FROM h, hs),
    hp AS (SELECT *, round((percent_rank() OVER (ORDER BY hsc) * 100)::DECIMAL(28,10), 1)::DOUBLE AS history_pct FROM hz)
    SELECT component, n_quarters, round((am)::DECIMAL(28,10), 4)::DOUBLE AS avg_measure, round((hsc)::DECIMAL(28,10), 6)::DOUBLE AS history_score, history_pct,
      CASE WHEN history_pct <= 20 THEN 'Very Low' WHEN history_pct <= 40 THEN 'Low'
        WHEN history_pct <= 60 THEN 'Medium' WHEN history_pct <= 80 THEN 'High' ELSE 'Very High' END AS risk_level FROM hp"""
)
def history_ranking(t):
    out = reports.history_ranking(facts(t), "component", "customer", "total_churn")
    return out.select(
        "component", "n_quarters", rounded("avg_measure", 4).alias("avg_measure"),
        rounded("history_score", 6).alias("history_score"), "history_pct", "risk_level",
    )


@query(
    _FACTS
    + """SELECT quarter, measure, n::DOUBLE AS n FROM (SELECT quarter, sum(customer)::DOUBLE AS customer,
       sum(internal)::DOUBLE AS internal FROM facts GROUP BY 1) UNPIVOT (n FOR measure IN (customer, internal))"""
)
def history_by_quarter(t):
    return reports.history_by_quarter(facts(t), "quarter", ["customer", "internal"])


@query(
    _FACTS
    + """SELECT quarter, count(*) AS n_rows, sum(customer)::BIGINT AS total_customer,
       sum(internal)::BIGINT AS total_internal, round((avg(total_churn))::DECIMAL(28,10), 0)::DOUBLE AS avg_churn FROM facts GROUP BY 1"""
)
def period_summary(t):
    return reports.period_summary(facts(t), ["quarter"], ["customer", "internal"], "total_churn")


@query(
    """SELECT l_linestatus, count(*) AS n_rows, count(DISTINCT l_orderkey) AS builds,
      count(DISTINCT l_suppkey) AS routines, strftime(min(l_shipdate), '%Y-%m-%d') AS first_day,
      strftime(max(l_shipdate), '%Y-%m-%d') AS last_day FROM lineitem GROUP BY 1"""
)
def load_summary(t):
    rows = t.lineitem.withColumn("day", F.to_date("l_shipdate").cast("string"))
    return reports.load_summary(rows, ["l_linestatus"], {"builds": "l_orderkey", "routines": "l_suppkey"}, "day")


@query(
    _FACTS
    + """, md AS (SELECT median(legacy_customer_avg) AS v FROM (SELECT component, avg(customer) AS legacy_customer_avg
        FROM facts WHERE quarter LIKE '%1996%' AND customer > 5 GROUP BY 1)),
    bs AS (SELECT component, avg(customer) AS a FROM facts WHERE quarter LIKE '%1996%' AND customer > 5 GROUP BY 1)
    SELECT component, quarter, round((coalesce(a, v))::DECIMAL(28,10), 4)::DOUBLE AS legacy_customer_avg,
      CASE WHEN a IS NULL THEN 0 ELSE 1 END AS has_legacy_data FROM facts LEFT JOIN bs USING (component), md"""
)
def baseline_join(t):
    rows = facts(t)
    base = reports.baseline(
        rows.where(F.col("customer") > 5), "component", "quarter",
        {"customer": "legacy_customer_avg"}, "1996",
    )
    out = reports.baseline_join(rows, base, "component", ["legacy_customer_avg"], "has_legacy_data")
    return out.select(
        "component", "quarter", rounded("legacy_customer_avg", 4).alias("legacy_customer_avg"), "has_legacy_data"
    )


@query(
    _BASE
    + """, rel AS (SELECT quarter, CASE WHEN quarter < '2001.Q1' THEN max(d) END AS release_date FROM co GROUP BY 1)
    SELECT quarter, strftime(release_date, '%Y-%m-%d') AS release_date,
      coalesce(round(((DATE '2001-12-31' - release_date) / 30)::DECIMAL(28,10), 0)::DOUBLE::INT, 3) AS months_in_field FROM rel"""
)
def releases_report(t):
    rel = _orders(t).groupBy("quarter").agg(
        F.max(F.when(F.col("quarter") < "2001.Q1", F.col("d"))).alias("release_date")
    )
    return reports.releases_report(rel, "2001-12-31").withColumn(
        "release_date", F.col("release_date").cast("string")
    )


_SEV = _BASE + """, sv AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'customer' ELSE 'internal' END AS source,
    CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 400000 THEN 'Unknown' ELSE
        CASE o_orderpriority[1:1] WHEN '1' THEN 'Fire' WHEN '2' THEN 'Critical' WHEN '3' THEN 'High'
          WHEN '4' THEN 'Medium' ELSE 'Low' END END
      ELSE CASE WHEN o_totalprice > 400000 THEN 'Unknown' ELSE
        CASE 6 - o_orderpriority[1:1]::INT WHEN 5 THEN 'Fire' WHEN 4 THEN 'Critical' WHEN 3 THEN 'High'
          WHEN 2 THEN 'Medium' WHEN 1 THEN 'Low' END END END AS severity_label FROM co)
"""


def _severities(t: Tables) -> DataFrame:
    co = _orders(t)
    words = F.create_map(
        *[F.lit(x) for kv in (("1", "Fire"), ("2", "Critical"), ("3", "High"), ("4", "Medium"), ("5", "Low")) for x in kv]
    )
    digit = F.substring("o_orderpriority", 1, 1)
    dear = F.col("o_totalprice") > 400000
    source = F.when(F.col("o_orderstatus") == "F", "customer").otherwise("internal")
    return co.withColumn("source", source).withColumn(
        "severity_label",
        reports.severity_label(
            F.col("source"),
            F.when(~dear, F.element_at(words, digit)),
            F.when(~dear, 6 - digit.cast("int")),
        ),
    )


@query(
    _SEV
    + """, n AS (SELECT source, quarter, severity_label, count(*) AS n FROM sv GROUP BY 1, 2, 3)
    SELECT *, (sum(n) OVER (PARTITION BY source, quarter))::BIGINT AS total,
      round((n / sum(n) OVER (PARTITION BY source, quarter) * 100)::DECIMAL(28,10), 1)::DOUBLE AS pct,
      CASE severity_label WHEN 'Fire' THEN 1 WHEN 'Critical' THEN 2 WHEN 'High' THEN 3
        WHEN 'Medium' THEN 4 WHEN 'Low' THEN 5 ELSE 6 END AS severity_order FROM n"""
)
def severity_distribution(t):
    return reports.severity_distribution(_severities(t), "source", "quarter", "severity_label")


_TIMING = _SEV + """, tm AS (SELECT quarter, n_name, min(d) FILTER (WHERE source = 'customer') AS fc,
      count(*) FILTER (WHERE source = 'customer') AS customer_count, min(d) FILTER (WHERE source = 'internal') AS fi,
      count(*) FILTER (WHERE source = 'internal') AS internal_count FROM sv GROUP BY 1, 2),
ok AS (SELECT quarter, n_name, strftime(fc, '%Y-%m-%d') AS first_customer_date, customer_count,
      strftime(fi, '%Y-%m-%d') AS first_internal_date, internal_count, (fc - fi)::INT AS days_diff
      FROM tm WHERE customer_count > 0 AND internal_count > 0)
"""


def _timing(t: Tables) -> DataFrame:
    return reports.discovery_timing(_severities(t), "quarter", "n_name", "source", "d")


@query(
    _TIMING
    + """SELECT *, CASE WHEN days_diff > 0 THEN 'Internal' WHEN days_diff < 0 THEN 'Customer'
      ELSE 'Same day' END AS found_first_by FROM ok"""
)
def discovery_timing(t):
    return _timing(t).withColumns(
        {c: F.col(c).cast("string") for c in ("first_customer_date", "first_internal_date")}
    )


@query(
    _TIMING
    + """SELECT quarter, count(*) AS n_components,
      round((avg(CASE WHEN days_diff >= 0 THEN 1.0 ELSE 0.0 END) * 100)::DECIMAL(28,10), 1)::DOUBLE AS pct_internal_first,
      round((avg(days_diff))::DECIMAL(28,10), 1)::DOUBLE AS avg_days_diff, median(days_diff)::DOUBLE AS median_days_diff
    FROM ok GROUP BY quarter"""
)
def discovery_summary(t):
    return reports.discovery_summary(_timing(t), "quarter")


@query(
    """
WITH s AS (SELECT p_brand, p_type, avg(p_size) AS a, avg(p_retailprice) AS b, count(*)::DOUBLE AS c FROM part GROUP BY 1, 2),
l AS (SELECT p_brand, p_type, ln(1 + a) AS log_size, ln(1 + b) AS log_price, c AS parts FROM s),
m AS (SELECT min(log_size) AS a0, max(log_size) AS a1, min(log_price) AS b0, max(log_price) AS b1, min(parts) AS c0, max(parts) AS c1 FROM l),
w AS (SELECT p_brand, p_type, (log_size - a0) / (a1 - a0) AS log_size, (log_price - b0) / (b1 - b0) AS log_price,
        (parts - c0) / (c1 - c0) AS parts FROM l, m)
SELECT p_brand, p_type, indicator, round((value)::DECIMAL(28,10), 6)::DOUBLE AS value FROM w UNPIVOT (value FOR indicator IN (log_size, log_price, parts))"""
)
def risk_matrix(t):
    stats = t.part.groupBy("p_brand", "p_type").agg(
        F.avg("p_size").alias("a"), F.avg("p_retailprice").alias("b"), F.count(F.lit(1)).alias("c")
    )
    out = reports.risk_matrix(
        stats, ["p_brand", "p_type"],
        {"log_size": F.log1p("a"), "log_price": F.log1p("b"), "parts": F.col("c")},
    )
    return out.withColumn("value", rounded("value", 6))


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(o_orderdate, '%Y-%m-%d') AS build_date,
  p_name, p_brand, s_name, n.n_name AS supplier_nation, c_mktsegment, r_name,
  left('part ' || p_name || ' for ' || c_name || ' at ' || s_name, 40) AS errors,
  length('part ' || p_name || ' for ' || c_name || ' at ' || s_name) > 40 AS errors_truncated
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation n ON n.n_nationkey = s_nationkey
JOIN customer ON c_custkey = o_custkey JOIN nation cn ON cn.n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = cn.n_regionkey
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR (c_mktsegment = 'FURNITURE' AND o_orderdate >= '1999-01-01')"""
)
def denormalise_results(t):
    """Line items with all their dimensions, scoped by segment, or segment and date."""
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey"), "l_suppkey"
    )
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    supp = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    snat = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")
    cnat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    reg = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    seg = F.col("c_mktsegment")
    # The scope is one of orders, so these are joined and cut first; line items meet what is left.
    placed = reports.denormalise_results(
        orders,
        [(cust, "o_custkey", "inner"), (cnat, "c_nationkey", "inner"), (reg, "n_regionkey", "left")],
        seg.isin("BUILDING", "MACHINERY")
        | ((seg == "FURNITURE") & (F.to_date("o_orderdate") >= F.to_date(F.lit("1999-01-01")))),
    )
    out = reports.denormalise_results(
        li,
        [
            (placed.drop("o_custkey", "c_nationkey", "n_regionkey"), "l_orderkey", "inner"),
            (part, "l_partkey", "inner"), (supp, "l_suppkey", "left"), (snat, "s_nationkey", "left"),
        ],
        F.lit(True),
    )
    text = F.concat(F.lit("part "), "p_name", F.lit(" for "), "c_name", F.lit(" at "), "s_name")
    return reports.denormalise_results(
        out.withColumn("errors", text), [], F.lit(True), "errors", 40
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.to_date("o_orderdate").cast("string").alias("build_date"), "p_name", "p_brand", "s_name",
        "supplier_nation", "c_mktsegment", "r_name", "errors", "errors_truncated",
    )


@query(
    """SELECT l_partkey, l_returnflag AS status, count(*) AS n, strftime(min(l_shipdate), '%Y-%m-%d') AS first_date,
      strftime(max(l_shipdate), '%Y-%m-%d') AS last_date FROM lineitem
    WHERE l_shipdate >= '1997-01-01' AND l_shipdate <= '1999-12-31' GROUP BY 1, 2"""
)
def case_history(t):
    rows = t.lineitem.withColumn("status", F.col("l_returnflag"))
    out = reports.case_history(rows, "l_partkey", "l_shipdate", "1997-01-01", "1999-12-31")
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})
