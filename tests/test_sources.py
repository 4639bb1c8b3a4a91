"""Readers and parsers on small files written by the test."""

import json

import pytest
from pyspark.sql import functions as F

from shiplens.functions import paths as P
from shiplens.operators import graph
from shiplens.plans import reports
from shiplens.sources import readers, records, vcs


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_readers(spark, tmp_path):
    p = write(tmp_path / "f.csv", "A,B,C,D,E,F,G,H,I,J,K\n3,120,1,1,4,l,./modules/a/b/X.java,f,long,1,9\n")
    r = readers.read_positional(spark, p, readers.FUNCTION_SCHEMA).first()
    assert (r["nloc"], r["ccn"], r["file"], r["end_line"]) == (3, 120, "./modules/a/b/X.java", 9)
    p = write(tmp_path / "s.csv", "name,n\na,1\nb,x\n")
    df = readers.cast_columns(readers.read_strings(spark, p, ["name"]), {"n": "int"})
    assert rows(df) == [("a", 1), ("b", None)] or {r["name"]: r["n"] for r in df.collect()} == {"a": 1, "b": None}
    with pytest.raises(ValueError, match="team"):
        readers.read_strings(spark, p, ["name", "team"])
    churn = ",".join(f.name for f in readers.CHURN_SCHEMA)
    p = write(tmp_path / "c.csv", churn + "\n" + ",".join(["2024.Q1", "m"] + ["1"] * 40) + "\n")
    assert readers.read_csv(spark, p, readers.CHURN_SCHEMA).first()["scss_Deletions"] == 1.0


def test_newest_snapshot(spark, tmp_path):
    write(tmp_path / "b_20240101.csv", "k\nold\n")
    write(tmp_path / "b_20240301.csv", "k\nnew\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.StringType())])
    assert rows(readers.read_latest(spark, str(tmp_path / "b_*.csv"), schema)) == [("new",)]


def test_small_readers(spark, tmp_path):
    lines = spark.createDataFrame([(" The ",), ("# no",), ("",), ("the",)], "value string")
    assert rows(readers.stopwords(lines)) == [("the",)]
    specs = spark.createDataFrame([("cart/a.spec.ts",), ("cart/a.ts",)], "p string")
    assert rows(readers.spec_index(specs, "p")) == [("cart/a.spec.ts", "cart")]
    write(tmp_path / "d" / "e" / "x.spec.ts", "x")
    assert readers.list_files(spark, str(tmp_path / "d"), "*.spec.ts").count() == 1
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    staged = readers.stage(df, str(tmp_path / "stage"))
    assert rows(readers.rows_for(staged, "k", df.where("k = 2"))) == [(2, "b")]
    rel = spark.createDataFrame([(" 2024.Q1 ", "q", "t", "2024-02-01", None, True, "released ", None)], "release_label string, quarter_label string, git_tag string, release_date string, is_major_release boolean, is_lts boolean, release_status string, notes string")
    r = readers.releases(rel).first()
    assert (r["release_label"], r["release_status"], r["is_major_release"], r["notes"]) == ("2024.Q1", "RELEASED", False, "")


def test_issue_kinds(spark):
    issue = {
        "key": "I-1",
        "fields": {
            "summary": "s", "created": "2024-02-03T01:02:03", "fix_priority": {"value": "4"},
            "components": [{"name": "A"}, {"name": "B > C"}], "fixVersions": [{"name": "2024.Q3.1"}, {"name": "x"}],
            "project": {"key": "I"}, "status": {"name": "Open"},
        },
    }
    df = spark.createDataFrame([(json.dumps(issue),)], "t string")
    r = records.parse_issues(df, "t", "internal").first()
    assert (r["severity_score"], r["components"], r["quarter_label"], str(r["created_date"])) == (4.0, "A|B > C", None, "2024-02-03")
    s = records.parse_stories(df, "t").first()
    assert (s["quarter"], s["quarter_source"]) == ("2024.Q3", "fixVersion")
    block = spark.createDataFrame([("I-1",)], "issue_key string")
    both = records.combine_issues(records.parse_issues(df, "t", "customer"), records.parse_issues(df, "t", "internal"), block)
    assert [x["is_release_blocker"] for x in both.collect()] == [True, True]


def test_case_results(spark):
    text = json.dumps({"id": 1, "buildId": 2, "caseId": 3, "componentId": 4, "teamId": 5, "dueStatus": {"name": "Failed"}, "dateCreated": "2024-01-02T00:00:00Z"})
    df = records.parse_case_results(spark.createDataFrame([(text,)], "t string"), "t")
    one = lambda **kw: spark.createDataFrame([tuple(kw.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'bigint'}" for k, v in kw.items()))
    r = records.with_lookups(df, one(build_id=2), one(case_id=3, case_name="c"), one(component_id=9, component_name="x"), one(team_id=5, team_name="t")).first()
    assert (r["case_name"], r["component_name"], r["team_name"], r["status"], r["subtask_id"]) == ("c", None, "t", "Failed", 0)
    export = spark.createDataFrame([("n", "c", "FAILED")], "`Case Name` string, Component string, Status string")
    e = records.from_export(export).first()
    assert (e["case_name"], e["status"], e["errors"], e["case_id"]) == ("n", "FAILED", None, None)


def test_junit(spark, tmp_path):
    p = write(
        tmp_path / "TESTS-1.xml",
        """<testsuite><properties><property name="x.build.name" value="B - 123 - y"/></properties>
<testcase name="a"><properties><property name="x.testcase.name" value="T1"/><property name="x.testcase.status" value="did not run"/>
<property name="x.main.component.name" value="C"/></properties></testcase>
<testcase name="b"><properties><property name="x.testcase.name" value="T2"/><property name="x.testcase.status" value="failed"/></properties>
<failure message="boom">trace</failure></testcase></testsuite>""",
    )
    got = rows(records.read_junit(spark, p, "x."), "case_name", "status")
    assert got == [("T1", "UNTESTED"), ("T2", "FAILED")]
    assert {r["errors"] for r in records.read_junit(spark, p, "x.").collect()} == {None, "boom"}
    assert records.build_meta(spark, p, "x.").first()["build_id"] == 123


def test_commit_log_file(spark, tmp_path):
    p = write(tmp_path / "log.txt", "COMMIT|a|x@y|2024-01-02 10:00\n\nm/A.java\nm/b.xml\nCOMMIT|b|z@y|2023-01-02\n\nm/A.java\nCOMMIT|c|z@y|2024-01-03\n\n")
    df = vcs.parse_commit_log(vcs.read_commit_log(spark, p), "value")
    assert rows(df, "commit_hash", "file_path") == [("a", "m/A.java"), ("a", "m/b.xml"), ("b", "m/A.java")]
    assert rows(vcs.code_commits(df, F.lit("2024-01-01").cast("date")), "commit_hash") == [("a",)]


def test_build_files_to_edges(spark, tmp_path):
    write(tmp_path / "m" / "apps" / "a" / "build.gradle", 'dependencies {\n compileOnly project(":apps:b")\n testImplementation project(":apps:c")\n}\n')
    write(tmp_path / "m" / "apps" / "a" / "bnd.bnd", "Bundle-SymbolicName: com.a\nBundle-Version: 1.0\n")
    write(tmp_path / "m" / "apps" / "b" / "bnd.bnd", "Bundle-SymbolicName: com.b\n")
    lines = vcs.read_file_lines(spark, str(tmp_path / "m")).withColumn("path", F.regexp_extract("path", r"/m/(.*)$", 1))
    reg = vcs.bundle_registry(lines, "path", "value")
    assert rows(reg, "module_path", "bundle_symbolic_name", "module_name") == [("apps/a", "com.a", "a"), ("apps/b", "com.b", "b")]
    edges = graph.resolve_edges(vcs.project_edges(lines, "path", "value"), reg)
    assert rows(edges, "from_module", "to_module") == [("a", "b")]
    assert vcs.project_edges(lines, "path", "value", "testImplementation").count() == 1


def test_diff_text(spark):
    text = (
        "diff --git a/m/A.java b/m/A.java\n--- a/m/A.java\n+++ b/m/A.java\n@@ -1 +1 @@\n-old\n+new\n+more\n"
        "diff --git a/pom.xml b/pom.xml\n+x\n"
        "diff --git a/gone.java b/gone.java\n--- a/gone.java\n+++ /dev/null\n-x\n"
    )
    df = spark.createDataFrame([(1, text)], "d int, t string")
    got = vcs.diff_blocks(df, "d", "t", P.glob_pattern(P.DIFF_EXCLUDES))
    assert rows(got, "file_path", "added", "removed", "is_deleted") == [("gone.java", 0, 1, True), ("m/A.java", 2, 1, False)]


def test_scenario_table(spark):
    text = "x ||Test Scenarios||Y||\n|a|b|\n|c|d|\nh3. Test Cases\nz"
    df = spark.createDataFrame([(1, text), (2, "none")], "k int, t string")
    got = reports.scenario_rows(df, "k", "t")
    assert [r["row_no"] for r in got.orderBy("row_no").collect()][0] == 1
    assert {r["k"] for r in got.collect()} == {1}


def test_flagged_files(spark):
    df = spark.createDataFrame([("m/A.java", "@FeatureFlag x"), ("m/A.java", "y"), ("m/B.java", "y"), ("m/ATest.java", "@FeatureFlag")], "p string, v string")
    r = vcs.flagged_share(df, "p", "v", F.lit("m")).first()
    assert (r["flagged_file_count"], r["total_file_count"], r["flag_pct"], r["is_flagged"]) == (1, 2, 0.5, True)


def test_word_ends_of_flagged_files_are_ascii(spark):
    df = spark.createDataFrame([("m/A.java", "nationé"), ("m/B.java", "nations"), ("m/C.java", "a nation"), ("m/D.java", "\\\\b")], "p string, v string")
    r = vcs.flagged_share(df, "p", "v", F.lit("m"), patterns=(r"ation\b", r"\\\\b")).first()
    assert (r["flagged_file_count"], r["total_file_count"]) == (3, 4)
