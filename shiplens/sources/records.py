"""Landed JSON and XML documents to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.functions.paths import latest_quarter

NAMED = "array<struct<name: string>>"
ISSUE_SCHEMA = (
    "key string, fields struct<summary: string, status: struct<name: string>, "
    "resolution: struct<name: string>, created: string, resolutiondate: string, "
    "priority: struct<name: string>, fix_priority: struct<value: string>, "
    f"project: struct<key: string>, components: {NAMED}, versions: {NAMED}, fixVersions: {NAMED}>"
)

# Priority words on a five-point scale.
PRIORITY_SCORE = {"Fire": 5, "Critical": 4, "High": 3, "Medium": 2, "Low": 1}


def _names(arr: Column) -> Column:
    joined = F.array_join(F.transform(arr, lambda x: x["name"]), "|")
    return F.when(F.size(arr) > 0, joined)


def _day(text: Column) -> Column:
    return F.to_date(F.substring(text, 1, 10))


def priority_score(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in PRIORITY_SCORE.items() for x in kv])
    return F.try_element_at(table, name).cast("double")


def parse_json(df: DataFrame, text: str, schema: str) -> DataFrame:
    return df.select(F.from_json(text, schema).alias("j")).select("j.*")


def malformed(df: DataFrame, text: str, schema: str, *keep: str) -> DataFrame:
    """The documents that do not parse under ``schema``, as they came, with the columns to keep."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    read = F.from_json(text, f"{schema}, _bad string", options)
    return df.withColumn("_bad", read["_bad"]).where(F.col("_bad").isNotNull()).select(*keep, F.col("_bad").alias("record"))


def parse_issues(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Issue JSON to rows: ``customer`` scores priority words, ``internal`` a numeric field."""
    f = F.col("fields")
    rows = parse_json(df, text, ISSUE_SCHEMA)
    if kind == "customer":
        raw = f["priority"]["name"]
        severity, fix = priority_score(raw), F.lit(None).cast("double")
        quarter = latest_quarter(_names(f["versions"]))
    else:
        raw = f["fix_priority"]["value"]
        severity = fix = raw.try_cast("double")
        quarter = F.lit(None).cast("string")
    return rows.select(
        F.col("key").alias("issue_key"),
        F.lit(kind).alias("source"),
        f["project"]["key"].alias("project"),
        f["summary"].alias("summary"),
        f["status"]["name"].alias("status"),
        f["resolution"]["name"].alias("resolution"),
        _day(f["created"]).alias("created_date"),
        _day(f["resolutiondate"]).alias("resolution_date"),
        raw.alias("priority_raw"),
        severity.alias("severity_score"),
        fix.alias("fix_priority"),
        _names(f["components"]).alias("components"),
        _names(f["versions"]).alias("affected_versions"),
        quarter.alias("quarter_label"),
    )


def combine_issues(customer: DataFrame, internal: DataFrame, blockers: DataFrame) -> DataFrame:
    """Both kinds stacked; keys in the blocker list are flagged."""
    from shiplens.operators.triage import existence_flag

    first = customer.withColumn("is_release_blocker", F.lit(False))
    both = first.unionByName(internal, allowMissingColumns=True)
    marked = existence_flag(both, blockers, "issue_key", "_blocker")
    return marked.withColumn(
        "is_release_blocker",
        F.coalesce("is_release_blocker", F.lit(False)) | F.col("_blocker"),
    ).drop("_blocker")


def parse_stories(df: DataFrame, text: str) -> DataFrame:
    """Story JSON to rows; the period is the newest fix version, else left to the date."""
    f = F.col("fields")
    rows = parse_json(df, text, ISSUE_SCHEMA)
    quarter = latest_quarter(_names(f["fixVersions"]))
    return rows.select(
        F.col("key").alias("issue_key"),
        f["project"]["key"].alias("project"),
        f["summary"].alias("summary"),
        f["status"]["name"].alias("status"),
        _day(f["created"]).alias("created_date"),
        _names(f["components"]).alias("components"),
        quarter.alias("quarter"),
        F.when(quarter.isNotNull(), "fixVersion").otherwise("created_date").alias("quarter_source"),
    )


CASE_RESULT_SCHEMA = (
    "id bigint, componentId bigint, teamId bigint, buildId bigint, caseId bigint, "
    "subtaskId bigint, dueStatus struct<key: string, name: string>, errors string, "
    "dateCreated string"
)


def parse_case_results(df: DataFrame, text: str) -> DataFrame:
    """Case-result JSON to rows."""
    rows = parse_json(df, text, CASE_RESULT_SCHEMA)
    return rows.select(
        F.col("id").alias("case_result_id"),
        F.col("componentId").alias("component_id"),
        F.col("teamId").alias("team_id"),
        F.col("buildId").alias("build_id"),
        F.col("caseId").alias("case_id"),
        F.coalesce("subtaskId", F.lit(0).cast("long")).alias("subtask_id"),
        F.col("dueStatus.name").alias("status"),
        "errors",
        _day(F.col("dateCreated")).alias("date_created"),
    )


def with_lookups(
    results: DataFrame, builds: DataFrame, cases: DataFrame, components: DataFrame, teams: DataFrame
) -> DataFrame:
    """Case results of known builds and cases, with component and team names."""
    return (
        results.join(builds.select("build_id"), "build_id", "left_semi")
        .join(cases, "case_id")
        .join(components, "component_id", "left")
        .join(teams, "team_id", "left")
    )


def from_export(df: DataFrame) -> DataFrame:
    """A result export's columns under the common names; ids are filled later by a join."""

    def opt(name):
        return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")

    return df.select(
        F.lit(None).cast("long").alias("case_id"),
        F.col("`Case Name`").alias("case_name"),
        F.lit(None).cast("boolean").alias("case_flaky"),
        F.col("Component").alias("component_name"),
        opt("Team").alias("team_name"),
        F.col("Status").alias("status"),
        opt("Errors").alias("errors"),
        opt("Issues").alias("issue"),
    )


JUNIT_SCHEMA = (
    "failure struct<_message: string, _text: string>, "
    "properties struct<property: array<struct<_name: string, _value: string, _text: string>>>"
)
# Raw result words that stand for another status.
RESULT_WORDS = {"IN PROGRESS": "UNTESTED", "DID NOT RUN": "UNTESTED"}


def _properties(col: Column) -> Column:
    pairs = F.filter(col, lambda p: p["_name"].isNotNull())
    return F.map_from_entries(
        F.array_distinct(F.transform(pairs, lambda p: F.struct(p["_name"], p["_value"])))
    )


def junit_cases(spark: SparkSession, path: str) -> DataFrame:
    """Test cases as they stand in JUnit XML; ``_bad`` holds the text of one that does not parse.

    A file is cut after each closing tag and every piece is parsed for itself, so a broken test
    case costs no other, and large files are split among tasks. A test case without content (one
    self-closing tag) says nothing and is passed over.
    """
    pieces = spark.read.option("lineSep", "</testcase>").text(path)
    opened = F.regexp_extract("value", r"(?s)^.*(<testcase[\s>].*)$", 1)
    text = pieces.select(F.concat(opened, F.lit("</testcase>")).alias("_xml")).where("_xml <> '</testcase>'")
    options = {"valueTag": "_text", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return text.select(F.from_xml("_xml", f"{JUNIT_SCHEMA}, _bad string", options).alias("c")).select("c.*")


def write_junit(results: DataFrame, path: str, prefix: str = "", build: str | None = None) -> None:
    """``case_name``, ``status``, ``component_name``, ``team_name``, ``errors`` as JUnit XML.

    With ``build``, a column of build names, each file holds the cases of one build.
    """
    names = {"testcase.name": "case_name", "testcase.status": "status", "main.component.name": "component_name", "team.name": "team_name"} | ({"build.name": build} if build else {})
    pairs = F.array(*[F.struct(F.lit(prefix + n).alias("_name"), F.col(c).alias("_value")) for n, c in names.items()])
    given = F.filter(pairs, lambda p: p["_value"].isNotNull())
    failure = F.when(F.col("errors").isNotNull(), F.struct(F.col("errors").alias("_message")))
    folder = [F.sha2(F.col(build), 224).alias("build")] if build else []
    rows = results.select(failure.alias("failure"), F.struct(given.alias("property")).alias("properties"), *folder)
    writer = rows.write.partitionBy("build") if build else rows.write
    writer.format("xml").option("rowTag", "testcase").option("rootTag", "testsuite").save(path)


def read_junit(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """JUnit XML test cases to the common result columns; statuses in upper case.

    ``prefix`` stands before the property names that carry name, status and owners. A test case
    that does not parse is left out; ``junit_cases`` has its text.
    """
    raw = junit_cases(spark, path).where(F.col("_bad").isNull())
    rows = raw.select(
        _properties(F.col("properties.property")).alias("p"),
        F.col("failure._message").alias("errors"),
    )

    def prop(name):
        return F.try_element_at("p", F.lit(prefix + name))

    status = F.upper(F.coalesce(prop("testcase.status"), F.lit("")))
    mapped = status
    for word, to in RESULT_WORDS.items():
        mapped = F.when(status == word, to).otherwise(mapped)
    return rows.select(
        F.lit(None).cast("long").alias("case_id"),
        prop("testcase.name").alias("case_name"),
        F.lit(None).cast("boolean").alias("case_flaky"),
        prop("main.component.name").alias("component_name"),
        prop("team.name").alias("team_name"),
        F.nullif(mapped, F.lit("")).alias("status"),
        "errors",
        F.lit(None).cast("string").alias("issue"),
    )


def build_meta(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Build name per result file and the id between dashes in it."""
    raw = (
        spark.read.format("xml")
        .option("rowTag", "property")
        .option("valueTag", "_text")
        .schema("_name string, _value string, _text string")
        .load(path)
        .select("_name", "_value", F.col("_metadata.file_path").alias("file_path"))
    )
    names = raw.where(F.col("_name") == prefix + "build.name")
    return names.groupBy("file_path").agg(F.min("_value").alias("build_name")).withColumn(
        "build_id", F.regexp_extract("build_name", r" - (\d+) - ", 1).try_cast("bigint")
    )
