"""Failure rates, co-failure pairs and item quality on line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.functions.stats import rounded
from shiplens.operators import periods, scoring, testhealth



def _failed():
    return F.col("l_returnflag") == "R"


def _results(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))


_RATE = """
WITH r AS (SELECT l_orderkey, p_brand, p_type, l_returnflag = 'R' AS failed, l_linestatus = 'F' AS flaky
           FROM lineitem JOIN part ON p_partkey = l_partkey),
s AS (SELECT p_brand, count(*) AS test_run_count, count(*) FILTER (WHERE failed) AS failure_count,
             count(*) FILTER (WHERE flaky) AS flaky_count FROM r GROUP BY p_brand),
f AS (SELECT DISTINCT l_orderkey, p_brand FROM r WHERE failed),
u AS (SELECT l_orderkey, count(*) AS n FROM f GROUP BY l_orderkey),
c AS (SELECT p_brand, count(*) AS builds_with_failures, count(*) FILTER (WHERE n > 1) AS builds_with_co_failures
      FROM f JOIN u USING (l_orderkey) GROUP BY p_brand),
rate AS (
  SELECT p_brand, test_run_count, failure_count, flaky_count,
    round((failure_count / test_run_count)::DECIMAL(28,10), 4)::DOUBLE AS failure_rate,
    coalesce(builds_with_failures, 0) AS builds_with_failures,
    coalesce(builds_with_co_failures, 0) AS builds_with_co_failures,
    coalesce(round((builds_with_co_failures / nullif(builds_with_failures, 0))::DECIMAL(28,10), 4)::DOUBLE, 0) AS co_failure_score
  FROM s LEFT JOIN c USING (p_brand))
"""


def _rates(t: Tables) -> DataFrame:
    return testhealth.failure_and_cofailure_rate(
        _results(t), "l_orderkey", "p_brand", _failed(), F.col("l_linestatus") == "F"
    )


@query(_RATE + "SELECT * FROM rate")
def failure_cofailure_rate(t):
    return _rates(t)


@query(
    _RATE
    + """SELECT p_type, min(p_brand) AS component_name, sum(test_run_count)::BIGINT AS test_run_count,
      sum(failure_count)::BIGINT AS failure_count,
      round((sum(failure_count) / sum(test_run_count))::DECIMAL(28,10), 4)::DOUBLE AS failure_rate,
      round((avg(co_failure_score))::DECIMAL(28,10), 4)::DOUBLE AS co_failure_score
    FROM rate JOIN (SELECT DISTINCT p_brand, p_type FROM part) USING (p_brand) GROUP BY p_type"""
)
def module_grain(t):
    return testhealth.to_module_grain(_rates(t), t.part, "p_brand", "p_type")


@query(
    """
WITH f AS (SELECT DISTINCT l_suppkey AS u, l_partkey AS i, p_brand AS g
           FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R'),
n AS (SELECT count(DISTINCT u) AS total FROM f),
ug AS (SELECT DISTINCT u, g FROM f),
gf AS (SELECT g, count(*) AS c FROM ug GROUP BY g),
gp AS (SELECT a.g AS ga, b.g AS gb, count(*) AS co FROM ug a JOIN ug b ON a.u = b.u AND a.g < b.g
       GROUP BY 1, 2 HAVING count(*) >= 10),
fi AS (SELECT i, count(*) AS c FROM f GROUP BY i),
ip AS (SELECT a.g AS ga, b.g AS gb, a.i AS ia, b.i AS ib, count(*) AS s
       FROM f a JOIN f b ON a.u = b.u AND a.g < b.g GROUP BY 1, 2, 3, 4 HAVING count(*) >= 2),
j AS (SELECT ga, gb, co, s, round((s / (x.c + y.c - s))::DECIMAL(28,10), 4)::DOUBLE AS jac
      FROM ip JOIN gp USING (ga, gb) JOIN fi x ON x.i = ia JOIN fi y ON y.i = ib)
SELECT ga AS component_a, gb AS component_b, co AS co_fail_builds,
  round((avg(jac))::DECIMAL(28,10), 4)::DOUBLE AS jaccard_score, sum(s)::BIGINT AS co_fail_count, count(*) AS test_pair_count,
  x.c AS fail_count_a, y.c AS fail_count_b, round((x.c / total)::DECIMAL(28,10), 4)::DOUBLE AS fail_rate_a,
  round((y.c / total)::DECIMAL(28,10), 4)::DOUBLE AS fail_rate_b, round((co / total)::DECIMAL(28,10), 4)::DOUBLE AS co_fail_rate
FROM j JOIN gf x ON x.g = ga JOIN gf y ON y.g = gb, n
GROUP BY ga, gb, co, x.c, y.c, total HAVING count(*) >= 5"""
)
def cofailure_pairs(t):
    failures = _results(t).where(_failed())
    return testhealth.cofailure_pairs(
        failures, "l_suppkey", "l_partkey", "p_brand", min_units=10, min_pairs=2
    )


def _chronic_rows(t: Tables) -> DataFrame:
    return (
        t.lineitem.where(_failed())
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "l_orderkey",
            "l_partkey",
            F.col("r_name").alias("component_name"),
            F.when(
                F.col("l_linestatus") == "F", F.concat(F.lit("T-"), F.col("l_suppkey"))
            ).alias("issue"),
            "l_shipdate",
        )
    )


_CHRONIC = """
WITH f AS (SELECT l_orderkey, l_partkey, r_name AS component_name, l_shipdate,
             CASE WHEN l_linestatus = 'F' THEN 'T-' || l_suppkey END AS issue
           FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
           JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
           WHERE l_returnflag = 'R'),
s AS (SELECT l_partkey, component_name, count(DISTINCT l_orderkey) AS total_fail_builds,
        count(DISTINCT CASE WHEN issue <> '' THEN l_orderkey END) AS bug_linked_builds,
        count(DISTINCT CASE WHEN issue <> '' THEN issue END) AS distinct_bugs_linked
      FROM f GROUP BY 1, 2),
mx AS (SELECT greatest(max(bug_linked_builds), 1) AS mb, greatest(max(total_fail_builds), 1) AS mf FROM s),
q AS (SELECT *, round((bug_linked_builds / total_fail_builds)::DECIMAL(28,10), 4)::DOUBLE AS investigation_rate FROM s),
k AS (SELECT l_partkey, component_name, total_fail_builds, bug_linked_builds, distinct_bugs_linked,
        investigation_rate, round(((investigation_rate * 0.7::DOUBLE
          + least(bug_linked_builds / mb, 1.0) * 0.3::DOUBLE)
          * (1 - sqrt(total_fail_builds) / sqrt(mf)))::DECIMAL(28,10), 4)::DOUBLE AS signal_score
      FROM q, mx WHERE total_fail_builds >= 3),
best AS (SELECT * EXCLUDE component_name FROM k QUALIFY row_number() OVER (
           PARTITION BY l_partkey ORDER BY total_fail_builds DESC, component_name DESC) = 1),
newest AS (SELECT DISTINCT ON (l_partkey) l_partkey, component_name FROM f
           ORDER BY l_partkey, l_shipdate DESC, component_name DESC),
iq AS (SELECT l_partkey, component_name, total_fail_builds, bug_linked_builds, distinct_bugs_linked,
         investigation_rate, signal_score FROM best JOIN newest USING (l_partkey))
"""


def _chronic(t: Tables) -> DataFrame:
    return testhealth.item_quality_chronic(
        _chronic_rows(t), "l_orderkey", "l_partkey", [], "component_name", "issue", "l_shipdate",
        min_units=3,
    )


@query(_CHRONIC + "SELECT * FROM iq")
def item_quality(t):
    return _chronic(t)


@query(
    _CHRONIC
    + """SELECT component_name, count(DISTINCT l_partkey) AS n_test_cases,
      sum(total_fail_builds)::BIGINT AS total_failures, sum(bug_linked_builds)::BIGINT AS bug_linked_failures,
      sum(distinct_bugs_linked)::BIGINT AS distinct_bugs_linked,
      round((avg(investigation_rate))::DECIMAL(28,10), 4)::DOUBLE AS avg_investigation_rate,
      round((avg(signal_score))::DECIMAL(28,10), 4)::DOUBLE AS avg_signal_score,
      coalesce(round((sum(bug_linked_builds) / nullif(sum(total_fail_builds), 0))::DECIMAL(28,10), 4)::DOUBLE, 0) AS bug_link_rate,
      count(*) FILTER (WHERE signal_score > 0.1) AS high_signal_tests,
      count(*) FILTER (WHERE investigation_rate = 0) AS zero_catch_tests,
      round((count(*) FILTER (WHERE investigation_rate = 0) / count(DISTINCT l_partkey) * 100)::DECIMAL(28,10), 1)::DOUBLE AS pct_zero_catch
    FROM iq GROUP BY component_name"""
)
def test_health(t):
    return testhealth.test_health(_chronic(t), ["component_name"], "l_partkey")


@query(
    _CHRONIC
    + """SELECT component_name, l_partkey, signal_score FROM iq WHERE signal_score >= 0.1
    QUALIFY row_number() OVER (PARTITION BY component_name ORDER BY signal_score DESC, l_partkey) <= 3"""
)
def recommended_tests(t):
    """Three best items for every component that has failures."""
    affected = _chronic_rows(t).select("component_name")
    return scoring.recommended_tests(
        affected, _chronic(t), "component_name", "l_partkey"
    ).select("component_name", "l_partkey", "signal_score")


_TYPED = _CHRONIC.rstrip() + """,
ty AS (SELECT iq.*, p_type AS case_type, 'team ' || substr(component_name, 1, 2) AS team_name FROM iq JOIN part ON p_partkey = l_partkey)
SELECT {keys}, {extra}count(DISTINCT l_partkey) AS n_test_cases,
  sum(total_fail_builds)::BIGINT AS total_failures, sum(bug_linked_builds)::BIGINT AS bug_linked_failures,
  sum(distinct_bugs_linked)::BIGINT AS distinct_bugs_linked,
  round((avg(investigation_rate))::DECIMAL(28,10), 4)::DOUBLE AS avg_investigation_rate,
  round((avg(signal_score))::DECIMAL(28,10), 4)::DOUBLE AS avg_signal_score,
  coalesce(round((sum(bug_linked_builds) / nullif(sum(total_fail_builds), 0))::DECIMAL(28,10), 4)::DOUBLE, 0) AS bug_link_rate,
  count(*) FILTER (WHERE signal_score > 0.1) AS high_signal_tests,
  count(*) FILTER (WHERE investigation_rate = 0) AS zero_catch_tests,
  round((count(*) FILTER (WHERE investigation_rate = 0) / count(DISTINCT l_partkey) * 100)::DECIMAL(28,10), 1)::DOUBLE AS pct_zero_catch
FROM ty GROUP BY {keys}"""


def _typed(t: Tables) -> DataFrame:
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("case_type"))
    team = F.concat(F.lit("team "), F.substring("component_name", 1, 2))
    return _chronic(t).join(kinds, "l_partkey").withColumn("team_name", team)


@query(_TYPED.format(keys="component_name, team_name, case_type", extra=""))
def test_health_by_component_type(t):
    return testhealth.test_health(_typed(t), ["component_name", "team_name", "case_type"], "l_partkey")


@query(_TYPED.format(keys="team_name, case_type", extra="count(DISTINCT component_name) AS n_components, "))
def test_health_by_team_type(t):
    return testhealth.test_health(_typed(t), ["team_name", "case_type"], "l_partkey", component="component_name")


@query(
    _CHRONIC.rstrip()
    + """,
ch AS (SELECT DISTINCT 'c' || n_nationkey % 4 AS change, r_name AS component_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 > 0),
tp AS (SELECT component_name, l_partkey, signal_score FROM iq WHERE signal_score >= 0.1
    QUALIFY row_number() OVER (PARTITION BY component_name ORDER BY signal_score DESC, l_partkey) <= 3)
SELECT change, component_name, l_partkey, signal_score,
  row_number() OVER (PARTITION BY change ORDER BY signal_score DESC, component_name, l_partkey)::INT AS place FROM ch JOIN tp USING (component_name)"""
)
def change_tests(t):
    """Three best items of each component that a change touches."""
    changed = t.nation.where("n_nationkey % 3 > 0").join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("c"), (F.col("n_nationkey") % 4).cast("string")).alias("change"), F.col("r_name").alias("component_name")
    )
    out = scoring.change_tests(changed, "change", "component_name", _chronic(t), "l_partkey")
    return out.select("change", "component_name", "l_partkey", "signal_score", "place")


_WINDOWED = """
WITH r AS (SELECT l_partkey, l_linestatus AS routine,
             year(l_shipdate)::VARCHAR || '.Q' || quarter(l_shipdate)::VARCHAR AS window_quarter,
             l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_returnflag = 'R' AS failed,
             CASE WHEN l_discount > 0.05 THEN 'T-' || l_suppkey ELSE ' ' END AS issue FROM lineitem),
a AS (SELECT l_partkey, routine, window_quarter,
        first(l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS l_suppkey,
        count(DISTINCT l_orderkey) AS total_builds, count(*) FILTER (WHERE failed) AS total_fail_builds,
        count(*) FILTER (WHERE failed AND trim(issue) <> '') AS bug_linked_builds,
        count(DISTINCT CASE WHEN failed AND trim(issue) <> '' THEN issue END) AS distinct_bugs_linked
      FROM r GROUP BY 1, 2, 3),
q AS (SELECT *, coalesce(round((bug_linked_builds / nullif(total_fail_builds, 0))::DECIMAL(28,10), 4)::DOUBLE, 0) AS investigation_rate FROM a),
s AS (SELECT *, round((investigation_rate * (total_fail_builds / greatest(total_builds, 1)))::DECIMAL(28,10), 4)::DOUBLE AS signal_score FROM q),
w AS (SELECT routine, window_quarter, (sum(total_builds) - sum(total_fail_builds)) / greatest(sum(total_builds), 1) AS window_pass_rate
      FROM s GROUP BY 1, 2)
"""


def _windowed_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_partkey",
        F.col("l_linestatus").alias("routine"),
        periods.year_quarter(F.col("l_shipdate")).alias("window_quarter"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag",
        F.when(
            F.col("l_discount") > 0.05, F.concat(F.lit("T-"), F.col("l_suppkey"))
        ).otherwise(" ").alias("issue"),
    )


def _windowed(t: Tables, gate: float) -> DataFrame:
    return testhealth.item_quality_windowed(
        _windowed_rows(t), "l_partkey", "routine", "window_quarter", "l_orderkey",
        ["l_suppkey"], _failed(), "issue",
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"], min_pass_rate=gate,
    )


@query(
    _WINDOWED
    + """SELECT s.* FROM s JOIN w USING (routine, window_quarter) WHERE NOT window_pass_rate < 0.66"""
)
def item_quality_windowed(t):
    return _windowed(t, 0.66)


@query(
    _WINDOWED
    + """SELECT routine, window_quarter, round((window_pass_rate)::DECIMAL(28,10), 6)::DOUBLE AS window_pass_rate
    FROM w WHERE window_pass_rate < 0.66"""
)
def low_pass_windows(t):
    """The windows the gate drops."""
    rates = testhealth.window_pass_rates(
        _windowed_rows(t), "l_partkey", "routine", "window_quarter", "l_orderkey", _failed()
    ).where(F.col("window_pass_rate") < 0.66)
    return rates.withColumn("window_pass_rate", rounded("window_pass_rate", 6))


@query(
    """
WITH g AS (SELECT l_suppkey, l_linestatus, min(l_shipdate)::DATE AS d,
             count(*) FILTER (WHERE l_returnflag <> 'R') / count(*) AS rate
           FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
SELECT l_suppkey, l_linestatus, strftime(d, '%Y-%m-%d') AS build_date FROM g WHERE rate >= 0.65
UNION ALL
SELECT DISTINCT l_suppkey, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') FROM lineitem
WHERE l_linestatus = 'O' AND l_discount > 0.09"""
)
def clean_builds(t):
    rows = t.lineitem.withColumn("build_date", F.to_date("l_shipdate"))
    return testhealth.clean_builds(
        rows, "l_suppkey", "l_linestatus", "build_date", ~_failed(), F.col("l_discount") > 0.09,
        ["F"], ["O"], min_pass_rate=0.65,
    ).withColumn("build_date", F.col("build_date").cast("string"))


_FUNCS = """
WITH f AS (SELECT l_partkey, round((avg(l_quantity))::DECIMAL(28,10), 2)::DOUBLE AS avg_ccn, round((avg(l_linenumber))::DECIMAL(28,10), 2)::DOUBLE AS avg_nloc,
    max(l_quantity) AS max_ccn,
    round((avg(l_quantity) FILTER (WHERE l_linestatus = 'O'))::DECIMAL(28,10), 2)::DOUBLE AS avg_ccn_java,
    round((avg(l_linenumber) FILTER (WHERE l_linestatus = 'O'))::DECIMAL(28,10), 2)::DOUBLE AS avg_nloc_java,
    round((avg(l_quantity) FILTER (WHERE l_linestatus = 'F'))::DECIMAL(28,10), 2)::DOUBLE AS avg_ccn_frontend,
    round((avg(l_linenumber) FILTER (WHERE l_linestatus = 'F'))::DECIMAL(28,10), 2)::DOUBLE AS avg_nloc_frontend,
    CASE WHEN bool_or(l_linestatus = 'O') AND bool_or(l_linestatus = 'F') THEN 'mixed'
         WHEN bool_or(l_linestatus = 'O') THEN 'java_only' ELSE 'frontend_only' END AS language_mix
  FROM lineitem GROUP BY l_partkey),
m AS (SELECT DISTINCT p_partkey, p_brand AS component FROM part UNION SELECT DISTINCT p_partkey, p_type FROM part),
b AS (SELECT p_partkey, component, round((1 / count(*) OVER (PARTITION BY p_partkey))::DECIMAL(28,10), 4)::DOUBLE AS weight FROM m),
x AS (SELECT f.*, component, weight, p_size AS lines_of_code FROM f JOIN b ON b.p_partkey = l_partkey
      JOIN part ON part.p_partkey = l_partkey)
"""


def _functions(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_partkey", F.col("l_quantity").alias("ccn"), F.col("l_linenumber").alias("nloc"),
        F.when(F.col("l_linestatus") == "O", "java").otherwise("frontend").alias("language"),
    )
    return scoring.function_to_file_complexity(rows, "l_partkey", "ccn", "nloc", "language")


def _part_bridge(t: Tables) -> DataFrame:
    from shiplens.operators.bridge import bridge_weights

    part = t.part
    both = part.select("p_partkey", F.col("p_brand").alias("component")).unionByName(
        part.select("p_partkey", F.col("p_type").alias("component"))
    )
    return bridge_weights(both, "p_partkey", "component").withColumnRenamed("p_partkey", "l_partkey")


@query(_FUNCS + "SELECT * FROM f")
def function_complexity(t):
    return _functions(t)


_COMPONENTS = _FUNCS + """, s AS (SELECT component, count(DISTINCT l_partkey) AS n_files, avg(avg_ccn) AS ccn,
      round((avg(avg_nloc))::DECIMAL(28,10), 1)::DOUBLE AS avg_cognitive, round((avg(avg_ccn_java))::DECIMAL(28,10), 1)::DOUBLE AS avg_ccn_java,
      round((avg(avg_ccn_frontend))::DECIMAL(28,10), 1)::DOUBLE AS avg_ccn_frontend, max(max_ccn) AS component_max_ccn,
      round((sum(lines_of_code * weight))::DECIMAL(28,10), 0)::DOUBLE AS weighted_loc FROM x GROUP BY component),
    md AS (SELECT component, language_mix FROM (SELECT component, language_mix, count(*) AS n FROM x GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY component ORDER BY n DESC, language_mix) = 1),
    rk AS (SELECT component, n_files, round((ccn)::DECIMAL(28,10), 1)::DOUBLE AS avg_cyclomatic, avg_cognitive, avg_ccn_java, avg_ccn_frontend,
      component_max_ccn, weighted_loc, language_mix,
      round((percent_rank() OVER (ORDER BY ccn) * 100)::DECIMAL(28,10), 1)::DOUBLE AS complexity_risk_pct
    FROM s JOIN md USING (component))
"""


def _component_complexity(t: Tables) -> DataFrame:
    files = _functions(t).join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("lines_of_code")),
        "l_partkey",
    )
    return scoring.complexity_by_component(
        files.withColumn("file", F.col("l_partkey")), _part_bridge(t), "file", "l_partkey", "component"
    )


@query(_COMPONENTS + "SELECT * FROM rk")
def complexity_rollup(t):
    return _component_complexity(t)


@query(
    _COMPONENTS
    + """SELECT CASE WHEN component LIKE 'Brand#1%' THEN 'team 1' WHEN component LIKE 'Brand%' THEN 'team 2' END AS team,
      count(*) AS n_components, sum(n_files)::BIGINT AS total_files, round((avg(avg_cyclomatic))::DECIMAL(28,10), 1)::DOUBLE AS avg_cyclomatic,
      round((avg(avg_cognitive))::DECIMAL(28,10), 1)::DOUBLE AS avg_cognitive, sum(weighted_loc) AS total_loc,
      round((avg(complexity_risk_pct))::DECIMAL(28,10), 1)::DOUBLE AS avg_complexity_risk FROM rk WHERE component LIKE 'Brand%' GROUP BY 1"""
)
def complexity_by_team(t):
    component = F.col("component")
    team = F.when(component.startswith("Brand#1"), "team 1").when(component.startswith("Brand"), "team 2")
    return scoring.complexity_by_team(_component_complexity(t).withColumn("team", team), "team")


@query(
    _FUNCS
    + """SELECT component, max(max_ccn) AS component_max_ccn, round((avg(avg_ccn))::DECIMAL(28,10), 2)::DOUBLE AS component_avg_ccn
    FROM x GROUP BY component ORDER BY 2 DESC, 3 DESC, 1 LIMIT 10"""
)
def complexity_top_components(t):
    from shiplens.plans.reports import complexity_top_components as top

    return top(_functions(t).join(_part_bridge(t), "l_partkey"), "component")


@query(
    _FUNCS
    + """, q AS (SELECT quantile_cont(avg_nloc, 0.95) AS cog FROM f)
    SELECT l_partkey, round((coalesce(least(max_ccn / 16.0::DOUBLE, 1.0), 0) * 0.35::DOUBLE
       + least(avg_nloc / cog, 1.0) * 0.40::DOUBLE
       + least(p_size / (16.0::DOUBLE * 5), 1.0) * 0.25::DOUBLE)::DECIMAL(28,10), 4)::DOUBLE AS complexity_score
    FROM f JOIN part ON p_partkey = l_partkey, q"""
)
def complexity_score(t):
    """Pinned complexity normaliser, recomputed p95 for the second one."""
    from shiplens.functions.stats import exact_percentile

    files = _functions(t).join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey"
    )
    p95 = exact_percentile(files, [], "avg_nloc", 0.95, "p").scalar()
    return scoring.complexity_score(
        files, "l_partkey", "max_ccn", "avg_nloc", F.col("p_size"),
        F.lit(scoring.COMPLEXITY_PINNED_P95), p95,
    )
