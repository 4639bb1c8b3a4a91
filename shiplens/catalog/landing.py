"""Readers and sinks: the given tables written in the forms that sources come in, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.functions.stats import rounded
from shiplens.lineage import run_folder
from shiplens.operators import graph, merge, periods, quality, triage
from shiplens.sources import readers, records, vcs


def _text(*parts) -> F.Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query(
    """SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    WHERE c_acctbal > 4000 AND c_nationkey < 20"""
)
def jdbc_scan(t):
    """Customers in a relational database, scanned in four key ranges with the filter pushed down.

    The database is one that this process holds in memory; a cluster names a server's address.
    """
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    readers.write_table(rows, url, "customers")
    ends = rows.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    scan = readers.read_table(t.spark, url, "customers", split=("c_custkey", ends[0], ends[1] + 1, 4))
    return scan.where("c_acctbal > 4000 and c_nationkey < 20").select("c_custkey", "c_mktsegment", "c_acctbal")


@query("SELECT s_nationkey, count(*) AS n, min(s_suppkey) AS first_key FROM supplier WHERE s_nationkey IN (1, 2, 3, 7) GROUP BY 1")
def jdbc_predicates(t):
    """One partition of the scan for each of the predicates."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    readers.write_table(t.supplier.select("s_suppkey", "s_nationkey"), url, "suppliers")
    parts = ['"s_nationkey" IN (1, 2)', '"s_nationkey" = 3', '"s_nationkey" = 7']
    scan = readers.read_table(t.spark, url, "suppliers", predicates=parts)
    return scan.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.min("s_suppkey").alias("first_key"))


_JUNIT = """
WITH r AS (SELECT 'part ' || l_partkey AS case_name, 's' || l_suppkey AS component_name, CASE WHEN l_linestatus = 'F' THEN 'team <' || l_tax || '>' END AS team_name,
    CASE l_returnflag WHEN 'R' THEN 'Failed' WHEN 'A' THEN 'did not run' ELSE 'passed' END AS word,
    CASE WHEN l_returnflag = 'R' THEN 'boom & "' || l_orderkey || '"' END AS errors FROM lineitem WHERE l_linenumber = 1)
"""


def _junit(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t.lineitem.where("l_linenumber = 1").select(
        _text("part ", F.col("l_partkey")).alias("case_name"),
        F.when(flag == "R", "Failed").when(flag == "A", "did not run").otherwise("passed").alias("status"),
        _text("s", F.col("l_suppkey")).alias("component_name"),
        F.when(F.col("l_linestatus") == "F", _text("team <", F.col("l_tax"), ">")).alias("team_name"),
        F.when(flag == "R", _text('boom & "', F.col("l_orderkey"), '"')).alias("errors"),
    )


@query(
    _JUNIT
    + """SELECT case_name, component_name, team_name, CASE word WHEN 'did not run' THEN 'UNTESTED' ELSE upper(word) END AS status, errors, count(*) AS n
    FROM r GROUP BY ALL"""
)
def junit_results(t):
    """Line items as JUnit test cases with property lists, and what the reader makes of them."""
    folder = run_folder(t.spark, "junit")
    records.write_junit(_junit(t), folder, "x.")
    rows = records.read_junit(t.spark, folder, "x.")
    return rows.groupBy("case_name", "component_name", "team_name", "status", "errors").agg(F.count("*").alias("n"))


@query(
    """SELECT '<testcase><properties><property name="' || o_orderkey || '"></testcase>' AS record FROM orders WHERE o_orderkey % 40 = 0"""
)
def junit_malformed(t):
    """Test cases that do not parse come back as they stand; the good ones beside them are not lost."""
    folder = run_folder(t.spark, "junit")
    broken = t.orders.where("o_orderkey % 40 = 0").select(
        _text('<testcase><properties><property name="', F.col("o_orderkey"), '"></testcase>').alias("value")
    )
    broken.write.text(f"{folder}/bad")
    records.write_junit(_junit(t).where("status = 'passed'"), f"{folder}/good", "x.")
    cases = records.junit_cases(t.spark, f"{folder}/*")
    return cases.where("_bad is not null").select(F.col("_bad").alias("record"))


@query("SELECT DISTINCT 'Run - ' || (100 + o_custkey % 7) || ' - nightly' AS build_name, 100 + o_custkey % 7 AS build_id FROM orders")
def junit_builds(t):
    """Build name and id per result file."""
    folder = run_folder(t.spark, "junit")
    none = F.lit(None).cast("string")
    cases = t.orders.select(
        _text("order ", F.col("o_orderkey")).alias("case_name"), F.lit("passed").alias("status"), none.alias("component_name"),
        none.alias("team_name"), none.alias("errors"), _text("Run - ", F.lit(100) + F.col("o_custkey") % 7, " - nightly").alias("build_name"),
    )
    records.write_junit(cases, folder, "x.", build="build_name")
    return records.build_meta(t.spark, folder, "x.").select("build_name", "build_id").distinct()


@query(
    """SELECT s_suppkey, 'third' AS name, s_acctbal + 2 AS s_acctbal FROM supplier WHERE s_suppkey % 3 > 0"""
)
def newest_snapshot(t):
    """Three snapshots land out of order; the folder whose name sorts last is the only one opened."""
    root = run_folder(t.spark, "snapshots")
    for day, name, more in (("20240101", "first", 0), ("20240301", "third", 2), ("20240201", "second", 1)):
        rows = t.supplier.where(F.col("s_suppkey") % 3 != (0 if name == "third" else 1))
        merge.export_csv(rows.select("s_suppkey", F.lit(name).alias("name"), (F.col("s_acctbal") + more).alias("s_acctbal")), f"{root}/supplier_{day}")
    schema = "s_suppkey long, name string, s_acctbal double"
    return readers.newest_folder(t.spark.read.schema(schema).option("header", True).csv(f"{root}/supplier_*"))


@query(
    """SELECT o_orderkey, o_custkey, count(*) AS n_lines, round(sum(l_quantity)::DECIMAL(28,10), 2)::DOUBLE AS quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_discount > 0.02 GROUP BY 1, 2"""
)
def bucketed_join(t):
    """Two tables bucketed by order: their join, and the totals per order, take no exchange."""
    left, right = f"orders_{uuid.uuid4().hex}", f"lines_{uuid.uuid4().hex}"
    orders = merge.create_table_as(t.orders.select("o_orderkey", "o_custkey"), left, [], "o_orderkey", 8, run_folder(t.spark, "bucketed"))
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_discount")
    merge.as_view(merge.create_table_as(lines, right, [], "l_orderkey", 8, run_folder(t.spark, "bucketed")).where("l_discount > 0.02"), f"view_{right}")
    view = t.spark.table(f"view_{right}")
    return orders.hint("merge").join(view, orders.o_orderkey == view.l_orderkey).groupBy("o_orderkey", "o_custkey").agg(
        F.count("*").alias("n_lines"), rounded(F.sum("l_quantity"), 2).alias("quantity")
    )


_STORIES = """
WITH s AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN year(DATE '2022-01-01') || '.Q' || (1 + c_nationkey % 4) || '.' || c_custkey % 9 END AS v,
    strftime(DATE '2023-01-01' + (c_custkey % 500)::INT, '%Y-%m-%d') AS d, c_mktsegment, c_name FROM customer WHERE c_custkey % 17 > 0)
"""


def _stories(t: Tables) -> DataFrame:
    """Customers as story JSON: some without fix versions, some cut off in the middle."""
    key = F.col("c_custkey")
    named = lambda c: F.array(F.struct(c.alias("name")))
    version = F.when(key % 3 == 0, named(_text("2022.Q", F.lit(1) + F.col("c_nationkey") % 4, ".", key % 9)))
    day = F.date_add(F.lit("2023-01-01").cast("date"), (key % 500).cast("int"))
    fields = F.struct(
        F.col("c_name").alias("summary"), F.struct(F.lit("Open").alias("name")).alias("status"), F.struct(F.lit("ST").alias("key")).alias("project"),
        _text(day, "T10:00:00.000+0000").alias("created"), named(F.col("c_mktsegment")).alias("components"), version.alias("fixVersions"),
    )
    whole = F.to_json(F.struct(_text("ST-", key).alias("key"), fields.alias("fields")))
    cut = F.substring(whole, F.lit(1), F.lit(20) + (key % 5).cast("int"))
    return t.customer.select("c_custkey", F.when(key % 17 == 0, cut).otherwise(whole).alias("value"))


@query(
    _STORIES
    + """SELECT 'ST-' || c_custkey AS issue_key, c_name AS summary, d AS created_date, c_mktsegment AS components, v[1:7] AS quarter,
      CASE WHEN v IS NULL THEN 'created_date' ELSE 'fixVersion' END AS quarter_source FROM s"""
)
def landed_stories(t):
    out = records.parse_stories(_stories(t), "value").where("issue_key is not null")
    return out.select("issue_key", "summary", F.col("created_date").cast("string").alias("created_date"), "components", "quarter", "quarter_source")


@query(
    """WITH w AS (SELECT c_custkey, '{"key":"ST-' || c_custkey || '","fields":{"summary":"' AS j FROM customer WHERE c_custkey % 17 = 0)
    SELECT c_custkey, j[1:20 + (c_custkey % 5)::INT] AS record FROM w"""
)
def malformed_stories(t):
    return records.malformed(_stories(t), "value", records.ISSUE_SCHEMA, "c_custkey")


@query(
    """SELECT l_orderkey * 10 + l_linenumber AS case_result_id, l_partkey AS case_id, p_name AS case_name, CASE WHEN s_acctbal > 0 THEN s_name END AS component_name,
      n_name AS team_name, CASE l_returnflag WHEN 'R' THEN 'FAILED' WHEN 'A' THEN 'PASSED' END AS status, CASE WHEN l_tax > 0.04 THEN l_linenumber ELSE 0 END AS subtask_id,
      strftime(l_shipdate, '%Y-%m-%d') AS date_created
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' JOIN part ON p_partkey = l_partkey AND p_size < 30
      LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = l_suppkey % 40"""
)
def landed_case_results(t):
    """Line items as case-result JSON, kept for known builds and cases and named by lookups."""
    flag = F.col("l_returnflag")
    status = F.when(flag == "R", "FAILED").when(flag == "A", "PASSED")
    doc = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_suppkey").alias("componentId"), (F.col("l_suppkey") % 40).alias("teamId"),
        F.col("l_orderkey").alias("buildId"), F.col("l_partkey").alias("caseId"), F.when(F.col("l_tax") > 0.04, F.col("l_linenumber")).alias("subtaskId"),
        F.when(status.isNotNull(), F.struct(F.lit("k").alias("key"), status.alias("name"))).alias("dueStatus"),
        _text(F.to_date("l_shipdate"), "T00:00:00Z").alias("dateCreated"),
    )
    rows = records.parse_case_results(t.lineitem.select(F.to_json(doc).alias("value")), "value")
    out = records.with_lookups(
        rows,
        t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("build_id")),
        t.part.where("p_size < 30").select(F.col("p_partkey").alias("case_id"), F.col("p_name").alias("case_name")),
        t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("component_id"), F.col("s_name").alias("component_name")),
        t.nation.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_name")),
    )
    return out.select(
        "case_result_id", "case_id", "case_name", "component_name", "team_name", "status", "subtask_id", F.col("date_created").cast("string").alias("date_created")
    )


@query(
    """
WITH c AS (SELECT 'C-' || o_orderkey AS issue_key, 'customer' AS source, CASE o_orderpriority[1:1] WHEN '1' THEN 5 WHEN '2' THEN 4 END::DOUBLE AS severity_score,
    NULL::DOUBLE AS fix_priority, false AS flag FROM orders WHERE o_orderkey % 3 = 0),
i AS (SELECT 'I-' || s_suppkey, 'internal', (s_suppkey % 6)::DOUBLE, (s_suppkey % 6)::DOUBLE, false FROM supplier),
b AS (SELECT 'I-' || s_suppkey AS k FROM supplier WHERE s_acctbal < 2000 UNION SELECT 'C-' || c_custkey FROM customer)
SELECT issue_key, source, severity_score, fix_priority, issue_key IN (SELECT k FROM b) AS is_release_blocker FROM (SELECT * FROM c UNION ALL SELECT * FROM i)"""
)
def combined_issues(t):
    """Two kinds of issue stacked; the second lacks the blocker flag, which a key list sets on both."""
    words = F.create_map(F.lit("1"), F.lit("Fire"), F.lit("2"), F.lit("Critical"))
    word = F.try_element_at(words, F.substring("o_orderpriority", 1, 1))
    one = F.struct(_text("C-", F.col("o_orderkey")).alias("key"), F.struct(F.struct(word.alias("name")).alias("priority")).alias("fields"))
    two = F.struct(_text("I-", F.col("s_suppkey")).alias("key"), F.struct(F.struct((F.col("s_suppkey") % 6).cast("string").alias("value")).alias("fix_priority")).alias("fields"))
    customer = records.parse_issues(t.orders.where("o_orderkey % 3 = 0").select(F.to_json(one).alias("v")), "v", "customer")
    internal = records.parse_issues(t.supplier.select(F.to_json(two).alias("v")), "v", "internal")
    blockers = t.supplier.where("s_acctbal < 2000").select(_text("I-", F.col("s_suppkey")).alias("issue_key")).union(t.customer.select(_text("C-", F.col("c_custkey"))))
    out = records.combine_issues(customer, internal, blockers)
    return out.select("issue_key", "source", "severity_score", "fix_priority", "is_release_blocker")


_TAGS = """
WITH r AS (SELECT o_orderpriority AS series, year(o_orderdate) AS y, CASE WHEN year(o_orderdate) % 3 > 0 THEN min(o_orderdate)::DATE END AS d
  FROM orders WHERE year(o_orderdate) <> 1997 GROUP BY 1, 2)
"""


def _tags(t: Tables) -> DataFrame:
    year = F.year("o_orderdate")
    rows = t.orders.where(year != 1997).groupBy(F.col("o_orderpriority").alias("series"), year.alias("y"))
    return rows.agg(F.min(F.to_date("o_orderdate")).alias("first")).select(
        "series", "y", F.when(F.col("y") % 3 > 0, F.col("first")).alias("d")
    )


@query(_TAGS + "SELECT series, y, lag(series || '-u' || y) OVER (PARTITION BY series ORDER BY y) || '...' || series || '-u' || y AS tag_range FROM r")
def tag_ranges(t):
    """The range of changes of each release: from the tag before it, whatever the gap."""
    tags = _tags(t).withColumn("tag", F.concat("series", F.lit("-u"), F.col("y").cast("string")))
    return periods.tag_ranges(tags, "series", "y", "tag").select("series", "y", "tag_range")


@query(
    _TAGS
    + """SELECT series, y, strftime(coalesce(d, DATE '9999-12-31'), '%Y-%m-%d') AS sort_date,
      row_number() OVER (PARTITION BY series ORDER BY d NULLS LAST, y)::INT AS place FROM r"""
)
def releases_in_order(t):
    """Releases of each series by date; those without one come last, under the far date."""
    out = periods.in_date_order(_tags(t), ["series"], "d", ["y"])
    return out.select("series", "y", F.col("sort_date").cast("string").alias("sort_date"), "place")


@query(
    """SELECT r_name AS team, n_name AS component, (2 - grouping(r_name) - grouping(n_name))::INT AS level, count(*) AS n_files, round(avg(s_acctbal)::DECIMAL(28,10), 4)::DOUBLE AS avg_score
    FROM (SELECT CASE WHEN n_regionkey <> 2 THEN r_name END AS r_name, n_name, s_acctbal FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)
    GROUP BY ROLLUP (r_name, n_name)"""
)
def rolled_up_scores(t):
    """Per component, per team and in all; a component without a team is no total."""
    rows = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.when(F.col("n_regionkey") != 2, F.col("r_name")).alias("team"), F.col("n_name").alias("component"), "s_acctbal")
    )
    return periods.rolled_up(rows, ["team", "component"], {"n_files": F.count("*"), "avg_score": rounded(F.avg("s_acctbal"), 4)})


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS c_nationkey, c_acctbal FROM customer"""
)
def csv_round_trip(t):
    """Customers exported, loaded twice over, and read as strings with types cast; words are no numbers."""
    folder = run_folder(t.spark, "csv")
    rows = t.customer.withColumn("c_nationkey", F.when(F.col("c_nationkey") < 20, F.col("c_nationkey").cast("string")).otherwise("many"))
    for _ in range(2):
        merge.export_csv(rows, folder)
    strings = readers.read_strings(t.spark, folder, ["c_custkey", "c_nationkey"])
    typed = readers.cast_columns(strings, {"c_custkey": "bigint", "c_nationkey": "bigint", "c_acctbal": "double"})
    return typed.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


@query(
    """SELECT l_quantity::INT AS nloc, l_linenumber::INT AS ccn, 'modules/apps/s' || l_suppkey || '/X' || l_partkey || '.java' AS file, 'f' || l_orderkey AS function_name
    FROM lineitem WHERE l_linenumber < 3"""
)
def positional_csv(t):
    """A header that says something else is replaced by the names of the schema, by position."""
    folder = run_folder(t.spark, "csv")
    same = lambda n: [F.lit(k).alias(f"x{k}") for k in range(n)]
    rows = t.lineitem.where("l_linenumber < 3").select(
        F.col("l_quantity").cast("int").alias("NLOC"), F.col("l_linenumber").alias("CCN"), *same(4),
        _text("modules/apps/s", F.col("l_suppkey"), "/X", F.col("l_partkey"), ".java").alias("where"), _text("f", F.col("l_orderkey")).alias("fn"),
        F.lit("long").alias("ln"), F.lit(1).alias("a"), F.lit(2).alias("b"),
    )
    merge.export_csv(rows, folder)
    return readers.read_positional(t.spark, folder, readers.FUNCTION_SCHEMA).select("nloc", "ccn", "file", "function_name")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 3)")
def rows_for_ids(t):
    ids = t.part.where("p_size = 3").select(F.col("p_partkey").alias("l_partkey"))
    return readers.rows_for(t.lineitem, "l_partkey", ids).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE 0.5 END AS price, n FROM orders, (VALUES (1), (2)) v(n)
    WHERE o_orderkey % 2 = 0 OR n = 1"""
)
def appended_rows(t):
    """A table reloaded once, appended to once, and a column that older rows lack."""
    folder = run_folder(t.spark, "appended")
    merge.reload(t.orders.select("o_orderkey"), folder)
    part = F.col("o_orderkey") % 2
    priced = t.orders.where(part == 0).select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    plain = merge.add_column(t.orders.where(part == 1).select("o_orderkey", "o_custkey"), "price", "double", 0.5)
    merge.reload(merge.add_column(priced.unionByName(plain), "price", "double", 0.0).withColumn("n", F.lit(1)), folder)
    merge.append(priced.withColumn("n", F.lit(2)), folder)
    return t.spark.read.parquet(folder)


@query(
    """SELECT 'R' || c_custkey AS release_label, trim(c_mktsegment) AS quarter_label, upper(CASE c_nationkey % 2 WHEN 0 THEN 'released' ELSE 'planned' END) AS release_status,
      c_nationkey > 12 AS is_major_release, false AS is_lts, '' AS notes FROM customer"""
)
def release_registry(t):
    raw = t.customer.select(
        _text(" R", F.col("c_custkey"), " ").alias("release_label"), _text(F.col("c_mktsegment"), "  ").alias("quarter_label"), F.lit("t").alias("git_tag"),
        F.lit("2024-02-01").alias("release_date"), F.when(F.col("c_nationkey") > 12, True).alias("is_major_release"), F.lit(None).cast("boolean").alias("is_lts"),
        F.when(F.col("c_nationkey") % 2 == 0, " released").otherwise("planned ").alias("release_status"), F.lit(None).cast("string").alias("notes"),
    )
    return readers.releases(raw).select("release_label", "quarter_label", "release_status", "is_major_release", "is_lts", "notes")


@query(
    """SELECT DISTINCT 'm' || p_size || '/' || replace(p_name, ' ', '_') || '.spec.' || CASE WHEN p_size % 2 = 0 THEN 'ts' ELSE 'js' END AS spec_path, 'm' || p_size AS module_name
    FROM part WHERE p_size % 3 > 0"""
)
def spec_modules(t):
    size = F.col("p_size")
    end = F.when(size % 3 == 0, ".spec.tsx").when(size % 2 == 0, ".spec.ts").otherwise(".spec.js")
    files = t.part.select(F.concat(_text("m", size, "/"), F.replace("p_name", F.lit(" "), F.lit("_")), end).alias("path")).distinct()
    return readers.spec_index(files, "path")


@query(
    """
WITH p AS (SELECT p_partkey AS k, 'apps/b' || replace(p_brand, 'Brand#', '') || '/p' || p_partkey AS path FROM part WHERE p_size < 15)
SELECT DISTINCT 'p' || a.k AS from_module, 'com.p' || a.k AS from_bsn, 'p' || b.k AS to_module, 'com.p' || b.k AS to_bsn
FROM lineitem JOIN p a ON a.k = l_partkey JOIN p b ON b.k = l_suppkey WHERE l_returnflag = 'R'"""
)
def build_file_edges(t):
    """Build files and bundle files as lines of text, to edges between named modules."""
    parts = t.part.where("p_size < 15").select(
        F.col("p_partkey").alias("k"), _text("apps/b", F.replace("p_brand", F.lit("Brand#"), F.lit("")), "/p", F.col("p_partkey")).alias("folder")
    )
    bundle = parts.select(F.concat("folder", F.lit("/bnd.bnd")).alias("path"), _text("Bundle-SymbolicName: com.p", F.col("k")).alias("value"))
    other = parts.select(F.col("k").alias("o"), F.translate("folder", "/", ":").alias("to"))
    kind = F.when(F.col("l_returnflag") == "N", "testImplementation").when(F.col("l_returnflag") == "R", "compileOnly").otherwise("implementation")
    uses = t.lineitem.join(parts, F.col("l_partkey") == F.col("k")).join(other, F.col("l_suppkey") == F.col("o")).select(
        F.concat("folder", F.lit("/build.gradle")).alias("path"), _text("\t", kind, ' project(":', F.col("to"), '")').alias("value")
    )
    lines = bundle.union(uses)
    edges = vcs.project_edges(lines, "path", "value")
    return graph.resolve_edges(edges, vcs.bundle_registry(lines, "path", "value")).select("from_module", "from_bsn", "to_module", "to_bsn").distinct()


@query(
    """
WITH b AS (SELECT DISTINCT o_orderkey AS k, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS r FROM orders),
p AS (SELECT DISTINCT l_orderkey AS a, l_partkey AS b FROM lineitem)
SELECT p.a, p.b, x.r AS a_routine, y.r AS b_routine FROM p JOIN b x ON x.k = p.a JOIN b y ON y.k = p.b WHERE x.r <> y.r"""
)
def routine_mismatches(t):
    builds = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("routine"))
    pairs = t.lineitem.select(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b")).distinct()
    return quality.routine_mismatches(pairs, builds, "o_orderkey", "routine", "a", "b")


@query(
    """
WITH n AS (SELECT DISTINCT p_partkey % 300 AS case_id, p_name AS case_name, p_brand AS component_name FROM part WHERE p_partkey < 300),
x AS (SELECT 'with ids' AS side, case_id::VARCHAR AS key FROM n WHERE case_id % 2 = 0 UNION ALL SELECT 'names', n.case_name || '|' || n.component_name FROM n JOIN n m USING (case_name, component_name) WHERE m.case_id % 3 = 0)
SELECT side, key, count(*) AS n FROM x GROUP BY 1, 2"""
)
def keys_at_run_time(t):
    """The same comparison by id where the other side has ids, by case and component name where it has none."""
    rows = t.part.where("p_partkey < 300").select(F.col("p_partkey").alias("case_id"), F.col("p_name").alias("case_name"), F.col("p_brand").alias("component_name"))
    out = []
    for side, target in (("with ids", rows.where("case_id % 2 = 0")), ("names", rows.where("case_id % 3 = 0").withColumn("case_id", F.lit(None).cast("long")))):
        keys = triage.join_keys(target)
        hit = rows.join(target.select(*keys), keys).select(F.lit(side).alias("side"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"))
        out.append(hit)
    return out[0].union(out[1]).groupBy("side", "key").agg(F.count("*").alias("n"))
