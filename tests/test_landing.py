"""Plans of the readers and sinks: what is pushed down, pruned or joined in place."""

import pytest

from shiplens.catalog import QUERIES
from shiplens.operators import graph, quality
from shiplens.sources import readers, records

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_filters_reach_the_database(spark):
    text = plan(QUERIES["jdbc_scan"](spark, FOLDER))
    scan = next(line for line in text.splitlines() if "Scan JDBCRelation" in line and "PushedFilters" in line)
    assert "*GreaterThan(c_acctbal,4000" in scan and "*LessThan(c_nati" in scan and "numPartitions=4" in scan
    assert QUERIES["jdbc_scan"](spark, FOLDER).rdd.getNumPartitions() == 4


def test_one_snapshot_is_opened(spark, tmp_path):
    for day in ("20240101", "20240301", "20240201"):
        spark.range(3).withColumnRenamed("id", day and "k").coalesce(1).write.csv(str(tmp_path / f"s_{day}"))
    df = readers.newest_folder(spark.read.schema("k string").csv(str(tmp_path / "s_*")))
    assert df.count() == 3 and len(set(df.select("_metadata.file_path").toPandas().iloc[:, 0])) == 1
    done = df.select("k")
    done.collect()
    scan = done._jdf.queryExecution().executedPlan()
    while not scan.metrics().contains("numFiles"):
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_bucketed_tables_join_in_place(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(QUERIES["bucketed_join"](spark, FOLDER)).split("== Physical Plan ==")[1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_reach_keeps_changes_apart(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "a"), ("x", "y"), ("b", "b"), (None, "a")], "s string, t string")
    seeds = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "y"), (3, "none"), (4, None)], "ch int, n string")
    got = sorted((r["ch"], r["n"] or "", r["depth"]) for r in graph.reach_from(seeds, "ch", "n", edges, "s", "t", 2).collect())
    assert got == [(1, "", 1), (1, "b", 1), (1, "c", 2), (1, "d", 1), (2, "a", 2), (2, "c", 1), (2, "x", 1)]


def test_malformed_records_are_told_apart(spark):
    df = spark.createDataFrame([(1, '{"key":"A","fields":{}}'), (2, '{"key":"B"'), (3, None), (4, "")], "i int, v string")
    bad = {r["i"]: r["record"] for r in records.malformed(df, "v", records.ISSUE_SCHEMA, "i").collect()}
    assert bad[2] == '{"key":"B"' and 1 not in bad and 3 not in bad


@pytest.mark.parametrize("a, b, n", [("r1", "r2", 1), ("r1", "r1", 0), (None, "r1", 0)])
def test_unknown_routines_do_not_differ(spark, a, b, n):
    builds = spark.createDataFrame([(1, a), (2, b)], "k int, r string")
    pairs = spark.createDataFrame([(1, 2)], "a int, b int")
    assert quality.routine_mismatches(pairs, builds, "k", "r", "a", "b").count() == n
