"""Regressions between two years of line items, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.operators import packing, quality, triage

TIEBREAK = ["d", "l_orderkey", "l_linenumber", "group_id", "l_discount", "l_tax", "l_linestatus"]

_REG = """
WITH cr AS (SELECT l_partkey AS case_id, p_name AS case_name, p_brand AS component_name, l_suppkey AS group_id,
    CASE l_returnflag WHEN 'N' THEN 'PASSED' WHEN 'A' THEN 'BLOCKED' ELSE 'FAILED' END AS status,
    CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 3 ELSE 4 END AS rk,
    CASE WHEN l_discount = 0 THEN NULL WHEN l_tax >= 0.07 THEN 'The build failed prior to running the test'
      WHEN l_tax <= 0.01 THEN 'x SESSION INFO: chrome=101' WHEN l_discount > 0.08 THEN 'data-startdate,''11/02/2024'''
      ELSE 'AssertionError in ' || p_type END AS errors,
    l_tax = 0.05 AS flaky, CASE WHEN l_discount < 0.03 THEN 'T-' || l_suppkey END AS issue,
    l_shipdate::DATE AS d, year(l_shipdate) AS y, l_orderkey, l_linenumber, l_discount, l_tax, l_linestatus
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE year(l_shipdate) IN (1998, 1999)),
a AS (SELECT * FROM cr WHERE y = 1998 QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY (status = 'PASSED') DESC, rk DESC,
    d DESC, l_orderkey DESC, l_linenumber DESC, group_id DESC, l_discount DESC, l_tax DESC, l_linestatus DESC) = 1),
b AS (SELECT * FROM cr WHERE y = 1999 QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY rk DESC,
    d DESC, l_orderkey DESC, l_linenumber DESC, group_id DESC, l_discount DESC, l_tax DESC, l_linestatus DESC) = 1),
rg AS (SELECT case_id, a.case_name, a.component_name, a.flaky, a.status AS status_a, b.status AS status_b, b.errors, b.issue, b.group_id
  FROM a JOIN b USING (case_id) WHERE a.status = 'PASSED' AND b.status IN ('FAILED', 'BLOCKED', 'UNTESTED')),
pc AS (SELECT *, CASE WHEN errors IS NULL OR errors = '' THEN 'NO_ERROR'
    WHEN regexp_matches(errors, '(?i)The build failed prior to running the test') THEN 'BUILD_FAILURE'
    WHEN regexp_matches(errors, '(?i)chrome=100.0|Session info: chrome=1') THEN 'ENV_CHROME'
    WHEN regexp_matches(errors, '(?i)data-startdate,''11/\\d{2}/20\\d{2}''') THEN 'ENV_DATE' END AS pre_classification FROM rg),
ct AS (SELECT *, CASE WHEN flaky THEN 'flaky' WHEN pre_classification IS NOT NULL THEN 'auto' ELSE 'to_classify' END AS bucket FROM pc),
gk AS (SELECT *, CASE WHEN group_id <> 0 THEN 'g' || group_id ELSE 'c' || case_id END AS group_key FROM ct),
vd AS (SELECT case_id, CASE WHEN hash % 3 = 0 THEN 'BUG' WHEN hash % 3 = 1 THEN 'FALSE_POSITIVE' ELSE 'NEEDS_REVIEW' END AS classification,
    CASE WHEN hash % 2 = 0 THEN 'high' ELSE 'low' END AS confidence, 'because ' || errors AS reason,
    CASE WHEN hash % 3 = 0 THEN component_name || '.java' END AS culprit_file
  FROM (SELECT *, length(case_name) + length(component_name) AS hash FROM ct) WHERE bucket = 'to_classify' AND status_b = 'FAILED'),
fo AS (SELECT ct.case_id, CASE WHEN pre_classification IS NOT NULL THEN 'AUTO_CLASSIFIED' ELSE coalesce(vd.classification, 'NEEDS_REVIEW') END AS classification,
    CASE WHEN pre_classification IS NOT NULL THEN 'pre_classification=' || pre_classification
      WHEN vd.classification IS NOT NULL THEN vd.reason || CASE WHEN vd.culprit_file <> '' THEN '  [culprit_file=' || vd.culprit_file || ']' ELSE '' END
      ELSE 'No verdict given, defaulted to NEEDS_REVIEW' END AS reason,
    CASE WHEN pre_classification IS NOT NULL THEN 'auto' WHEN vd.classification IS NOT NULL THEN 'confidence=' || vd.confidence ELSE 'missing' END AS match_strategy
  FROM ct LEFT JOIN vd USING (case_id) WHERE NOT flaky)
"""


def _results(t: Tables) -> DataFrame:
    flag, tax, disc = F.col("l_returnflag"), F.col("l_tax"), F.col("l_discount")
    error = (
        F.when(disc == 0, None)
        .when(tax >= 0.07, "The build failed prior to running the test")
        .when(tax <= 0.01, "x SESSION INFO: chrome=101")
        .when(disc > 0.08, "data-startdate,'11/02/2024'")
        .otherwise(F.concat(F.lit("AssertionError in "), "p_type"))
    )
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").alias("case_id"),
        F.col("p_name").alias("case_name"),
        F.col("p_brand").alias("component_name"),
        F.col("l_suppkey").alias("group_id"),
        F.when(flag == "N", "PASSED").when(flag == "A", "BLOCKED").otherwise("FAILED").alias("status"),
        error.alias("errors"),
        (tax == 0.05).alias("flaky"),
        F.when(disc < 0.03, F.concat(F.lit("T-"), F.col("l_suppkey").cast("string"))).alias("issue"),
        F.to_date("l_shipdate").alias("d"),
        F.year("l_shipdate").alias("y"),
        "l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_linestatus",
    )


def _regressions(t: Tables) -> DataFrame:
    rows = _results(t)
    # Ranges of the day itself, which reach the scan.
    base = rows.where(F.col("d").between("1998-01-01", "1998-12-31")).drop("y")
    target = rows.where(F.col("d").between("1999-01-01", "1999-12-31")).drop("y")
    out = triage.regressions(base, target, ["case_id"], "status", TIEBREAK)
    return out.select(
        "case_id",
        F.col("case_name_a").alias("case_name"),
        F.col("component_name_a").alias("component_name"),
        F.col("flaky_a").alias("flaky"),
        "status_a", "status_b",
        F.col("errors_b").alias("errors"),
        F.col("issue_b").alias("issue"),
        F.col("group_id_b").alias("group_id"),
    )


def _classified(t: Tables) -> DataFrame:
    return triage.pre_classify(_regressions(t), "case_id", "errors", "flaky")


def _verdicts(t: Tables) -> DataFrame:
    h = F.length("case_name") + F.length("component_name")
    return (
        _classified(t)
        .where((F.col("bucket") == "to_classify") & (F.col("status_b") == "FAILED"))
        .select(
            "case_id",
            F.when(h % 3 == 0, "BUG").when(h % 3 == 1, "FALSE_POSITIVE").otherwise("NEEDS_REVIEW").alias("classification"),
            F.when(h % 2 == 0, "high").otherwise("low").alias("confidence"),
            F.concat(F.lit("because "), "errors").alias("reason"),
            F.when(h % 3 == 0, F.concat("component_name", F.lit(".java"))).alias("culprit_file"),
            F.lit(None).cast("string").alias("specific_change"),
        )
    )


def _fanned(t: Tables) -> DataFrame:
    return triage.fan_out_verdicts(_classified(t), _verdicts(t), ["case_id"], "flaky")


@query(_REG + "SELECT * FROM rg")
def regressions(t):
    return _regressions(t)


@query(_REG + "SELECT case_id, errors, pre_classification, bucket FROM ct")
def pre_classify(t):
    return _classified(t).select("case_id", "errors", "pre_classification", "bucket")


@query(
    _REG
    + """, gs AS (SELECT group_key, max(CASE WHEN group_id <> 0 THEN group_id END) AS group_id, count(*) AS case_count,
      count(DISTINCT CASE WHEN errors <> '' THEN errors END) AS n_errors, count(DISTINCT component_name) AS n_components,
      count(DISTINCT issue) AS n_linked_issues,
      coalesce(string_agg(DISTINCT pre_classification, '|' ORDER BY pre_classification), '') AS pre_classifications,
      bool_or(flaky) AS any_known_flaky, bool_and(flaky) AS all_known_flaky, bool_and(pre_classification IS NOT NULL) AS all_pre_classified,
      count(*) FILTER (WHERE status_b = 'FAILED') AS n_failed, count(*) FILTER (WHERE status_b = 'BLOCKED') AS n_blocked,
      count(*) FILTER (WHERE status_b = 'UNTESTED') AS n_untested FROM gk GROUP BY 1),
    er AS (SELECT group_key, errors FROM (SELECT group_key, errors, count(*) AS n FROM gk WHERE errors <> '' GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY group_key ORDER BY n DESC, errors) = 1)
    SELECT gs.*, coalesce(er.errors, '') AS shared_error, CASE WHEN all_known_flaky THEN 'flaky-only'
      WHEN all_pre_classified THEN 'auto-only' ELSE 'classifiable' END AS bucket
    FROM gs LEFT JOIN er USING (group_key)"""
)
def failure_groups(t):
    return triage.failure_groups(
        _classified(t), "group_id", "case_id", "errors", "component_name", "issue", "flaky", "status_b"
    )


@query(_REG + "SELECT group_key, case_id FROM gk")
def group_members(t):
    return triage.group_members(_classified(t), "group_id", "case_id")


@query(_REG + "SELECT * FROM fo")
def fan_out_verdicts(t):
    return _fanned(t).select("case_id", "classification", "reason", "match_strategy")


@query(
    _REG
    + """SELECT match_strategy, count(*) AS total_cases, count(*) FILTER (WHERE classification = 'BUG') AS n_bug,
      count(*) FILTER (WHERE classification = 'NEEDS_REVIEW') AS n_needs_review,
      count(*) FILTER (WHERE classification = 'FALSE_POSITIVE') AS n_false_positive,
      count(*) FILTER (WHERE classification = 'AUTO_CLASSIFIED') AS n_auto_classified FROM fo GROUP BY 1"""
)
def run_summary(t):
    return triage.run_summary(_fanned(t), ["match_strategy"])


@query(
    _REG
    + """, g1 AS (SELECT group_key, min(reason) AS reason, min(classification) AS classification FROM vd JOIN gk USING (case_id) GROUP BY 1)
    SELECT case_id, coalesce(CASE WHEN pre_classification IS NOT NULL THEN 'AUTO_CLASSIFIED' ELSE g1.classification END, 'NEEDS_REVIEW') AS classification,
      CASE WHEN pre_classification IS NOT NULL THEN 'auto' WHEN g1.classification IS NOT NULL THEN 'group confidence=high' ELSE 'missing' END AS match_strategy
    FROM gk LEFT JOIN g1 USING (group_key) WHERE NOT flaky"""
)
def fan_out_group_verdicts(t):
    """One verdict per group reaches all members."""
    cases = _classified(t).withColumn("group_key", triage.group_key("group_id", "case_id"))
    per_group = (
        _verdicts(t).join(cases.select("case_id", "group_key"), "case_id").groupBy("group_key").agg(
            F.min("classification").alias("classification"),
            F.lit("high").alias("confidence"),
            F.min("reason").alias("reason"),
            F.lit(None).cast("string").alias("culprit_file"),
            F.lit(None).cast("string").alias("specific_change"),
        )
    )
    out = triage.fan_out_verdicts(cases, per_group, ["group_key"], "flaky", strategy="group ")
    return out.select("case_id", "classification", "match_strategy")


@query(
    _REG
    + """SELECT case_id, rule FROM (
      SELECT case_id, unnest([CASE WHEN classification NOT IN ('BUG', 'NEEDS_REVIEW', 'FALSE_POSITIVE') THEN 'classification is unknown' END,
        CASE WHEN confidence NOT IN ('high', 'medium', 'low') THEN 'confidence is unknown' END,
        CASE WHEN trim(coalesce(reason, '')) = '' THEN 'reason is empty' END,
        CASE WHEN classification = 'BUG' AND trim(coalesce(culprit_file, '')) = '' THEN 'BUG without culprit_file' END]) AS rule FROM vd) WHERE rule IS NOT NULL
    UNION ALL SELECT case_id, 'case has no verdict' FROM ct WHERE bucket = 'to_classify' AND case_id NOT IN (SELECT case_id FROM vd)
    UNION ALL SELECT case_id, 'case is not in the run' FROM vd WHERE case_id NOT IN (SELECT case_id FROM ct WHERE bucket = 'to_classify')"""
)
def verdict_violations(t):
    expected = _classified(t).where(F.col("bucket") == "to_classify")
    return quality.verdict_violations(_verdicts(t), expected)


_LABELS = """
WITH a AS (SELECT doc_id, CASE quality WHEN 1 THEN 'BUG' ELSE 'FALSE_POSITIVE' END AS c, 'r [culprit_file=' || source || ']' AS reason
           FROM labels JOIN documents USING (doc_id)),
b AS (SELECT doc_id, CASE WHEN n_chars > 3000 THEN 'BUG' WHEN lang = 'en' THEN 'FALSE_POSITIVE' ELSE 'NEEDS_REVIEW' END AS c,
        CASE WHEN n_chars > 6000 THEN 'none' ELSE 'see [culprit_file=' || CASE WHEN lang = 'en' THEN source ELSE lang END || '] there' END AS reason
      FROM documents WHERE source <> 'src1'),
p AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.c AS ca, b.c AS cb, a.reason AS ra, b.reason AS rb FROM a FULL JOIN b ON a.doc_id = b.doc_id)
"""


def _pairs(t: Tables) -> DataFrame:
    a = t.labels.join(t.documents, "doc_id").select(
        "doc_id",
        F.when(F.col("quality") == 1, "BUG").otherwise("FALSE_POSITIVE").alias("c"),
        F.concat(F.lit("r [culprit_file="), "source", F.lit("]")).alias("reason"),
    )
    english = F.col("lang") == "en"
    b = t.documents.where(F.col("source") != "src1").select(
        "doc_id",
        F.when(F.col("n_chars") > 3000, "BUG").when(english, "FALSE_POSITIVE").otherwise("NEEDS_REVIEW").alias("c"),
        F.when(F.col("n_chars") > 6000, "none")
        .otherwise(
            F.concat(F.lit("see [culprit_file="), F.when(english, F.col("source")).otherwise(F.col("lang")), F.lit("] there"))
        )
        .alias("reason"),
    )
    return triage.paired_labels(a, b, ["doc_id"], "c", "reason")


@query(
    _LABELS
    + """SELECT count(*) FILTER (WHERE ca IS NOT NULL AND cb IS NOT NULL) AS n_shared, count(*) FILTER (WHERE cb IS NULL) AS only_a,
      count(*) FILTER (WHERE ca IS NULL) AS only_b, count(*) FILTER (WHERE ca = cb) AS n_agree,
      round((count(*) FILTER (WHERE ca = cb) / count(*) FILTER (WHERE ca IS NOT NULL AND cb IS NOT NULL) * 100)::DECIMAL(28,10), 1)::DOUBLE AS agreement_pct,
      count(*) FILTER (WHERE ca = 'BUG' AND cb = 'BUG') AS shared_bugs,
      count(*) FILTER (WHERE ca = 'BUG' AND cb = 'BUG' AND contains(ra, 'culprit_file') AND contains(rb, 'culprit_file')) AS both_named,
      count(*) FILTER (WHERE ca = 'BUG' AND cb = 'BUG' AND regexp_extract(ra, 'culprit_file=([^\\]]*)', 1) = nullif(regexp_extract(rb, 'culprit_file=([^\\]]*)', 1), '')) AS same_culprit
    FROM p"""
)
def compare_labels(t):
    return triage.compare_labels(_pairs(t), "c", "reason")


@query(_LABELS + "SELECT ca AS c_a, cb AS c_b, count(*) AS n FROM p WHERE ca IS NOT NULL AND cb IS NOT NULL GROUP BY 1, 2")
def confusion_matrix(t):
    return triage.confusion_matrix(_pairs(t), "c")


@query(
    _LABELS
    + "SELECT ca AS c_a, cb AS c_b, count(*) AS n FROM p WHERE ca <> cb GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"
)
def top_disagreements(t):
    return triage.top_disagreements(_pairs(t), "c")


@query(
    """
WITH RECURSIVE s AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
r AS (SELECT source, doc_id, n_chars, i, n_chars AS used, 1::BIGINT AS batch_number FROM s WHERE i = 1
  UNION ALL SELECT s.source, s.doc_id, s.n_chars, s.i, CASE WHEN used + s.n_chars > 20000 THEN s.n_chars ELSE used + s.n_chars END,
    batch_number + CASE WHEN used + s.n_chars > 20000 THEN 1 ELSE 0 END
  FROM r JOIN s ON s.source = r.source AND s.i = r.i + 1)
SELECT source, doc_id, n_chars, batch_number FROM r"""
)
def pack_batches(t):
    """Documents of a source packed in order into batches of 20,000 characters."""
    return packing.pack_batches(t.documents, "source", "doc_id", "n_chars", 20_000)


@query(
    """SELECT c_custkey, c_name, CASE WHEN s_name IS NOT NULL AND c_acctbal < 2000 THEN s_name
      WHEN c_acctbal < 2000 THEN ' ' ELSE c_mktsegment END AS label
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""
)
def backfill_blanks(t):
    rows = t.customer.select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") < 2000, " ").otherwise(F.col("c_mktsegment")).alias("label"),
    )
    look = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("label"))
    return triage.backfill_blanks(rows, look, ["c_custkey"], ["label"])


@query(
    """SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS has_urgent FROM customer"""
)
def existence_flag(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey")
    )
    return triage.existence_flag(t.customer.select("c_custkey"), urgent, "c_custkey", "has_urgent")


@query(
    """
WITH g AS (SELECT o_orderkey AS build_id, CASE WHEN o_orderstatus = 'F' THEN 'h' || o_custkey WHEN o_orderstatus = 'O' THEN '' END AS gh,
     CASE WHEN o_orderpriority < '3' THEN o_orderpriority ELSE '' END AS gn FROM orders),
k AS (SELECT c_custkey AS build_id, 'h' || (c_custkey + c_nationkey) AS h, c_name AS n, c_nationkey AS routine_id FROM customer)
SELECT g.build_id, coalesce(nullif(gh, ''), h) AS git_hash, coalesce(nullif(gn, ''), n, 'csv:' || g.build_id) AS build_name, routine_id,
  coalesce(nullif(gh, '') <> h, false) AS hash_differs, coalesce(nullif(gh, ''), h) IS NULL AS unresolved
FROM g LEFT JOIN k USING (build_id)"""
)
def resolve_metadata(t):
    given = t.orders.select(
        F.col("o_orderkey").alias("build_id"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("h"), F.col("o_custkey").cast("string")))
        .when(F.col("o_orderstatus") == "O", "").alias("given_hash"),
        F.when(F.col("o_orderpriority") < "3", F.col("o_orderpriority")).otherwise("").alias("given_name"),
        F.lit("csv").alias("source"),
    )
    known = t.customer.select(
        F.col("c_custkey").alias("build_id"),
        F.concat(F.lit("h"), (F.col("c_custkey") + F.col("c_nationkey")).cast("string")).alias("git_hash"),
        F.col("c_name").alias("build_name"),
        F.col("c_nationkey").alias("routine_id"),
    )
    return triage.resolve_build_metadata(given, known, "build_id", "source")
