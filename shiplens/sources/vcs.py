"""Output of version control and build files, as text, to rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.functions.paths import INVENTORY_TEST_FILES, SOURCE_FILES, leading_ticket, any_ticket
from shiplens.functions.stats import ratio, rounded
from shiplens.lineage import spread

# Extensions of the churn table, and tests left out of it.
CHURN_EXTENSIONS = ("java", "js", "jsp", "ts", "tsx", "css", "scss")
# Source text that puts a file behind a feature flag.
FLAG_PATTERNS = (
    r"FeatureFlagManagerUtil\.isEnabled",
    r"@FeatureFlag",
    r"featureFlagsTest\(\)",
    r"feature\.flag\.",
)


def read_commit_log(spark: SparkSession, path: str, mark: str = "COMMIT|") -> DataFrame:
    """One row per commit record of a log file, split at the record mark by the reader."""
    return spark.read.option("lineSep", mark).text(path).where(F.trim("value") != "")


def parse_commit_log(records: DataFrame, text: str, mark: str = "COMMIT|") -> DataFrame:
    """``hash|author|date`` head and one path per line to (commit, author, date, path)."""
    body = F.regexp_replace(F.col(text), "^" + mark.replace("|", r"\|"), "")
    lines = F.filter(F.transform(F.split(body, r"\n"), lambda x: F.trim(x)), lambda x: x != "")
    head = F.split(F.get(lines, F.lit(0)), r"\|")
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return records.select(
        F.get(head, F.lit(0)).alias("commit_hash"),
        F.get(head, F.lit(1)).alias("author_email"),
        F.to_date(F.substring(F.get(head, F.lit(2)), 1, 10)).alias("commit_date"),
        F.explode(rest).alias("file_path"),
    )


def code_commits(commits: DataFrame, since: Column, pattern=r"(?i)\.(java|js|ts|tsx|jsx)$"):
    """Rows of code files from a date on."""
    return commits.where(F.col("file_path").rlike(pattern) & (F.col("commit_date") >= since))


def numstat_churn(lines: DataFrame, text: str, module: Column, keys: list[str]) -> DataFrame:
    """``insertions<TAB>deletions<TAB>path`` lines to churn per module, wide by extension.

    Test files and binary entries (``-``) do not count as insertions or deletions.
    """
    parts = F.split(F.col(text), "\t")
    rows = lines.select(
        *keys,
        F.coalesce(F.get(parts, F.lit(0)).try_cast("bigint"), F.lit(0).cast("bigint")).alias("ins"),
        F.coalesce(F.get(parts, F.lit(1)).try_cast("bigint"), F.lit(0).cast("bigint")).alias("del"),
        F.get(parts, F.lit(2)).alias("path"),
    ).where(F.col("path").isNotNull() & ~F.col("path").rlike(INVENTORY_TEST_FILES))
    rows = rows.withColumn("module", module).withColumn(
        "ext", F.regexp_extract("path", r"\.([a-z]+)$", 1)
    )
    rows = rows.where(F.col("ext").isin(*CHURN_EXTENSIONS))
    aggs = [
        F.count(F.lit(1)).alias("Total_ModifiedFileCount"),
        F.sum("ins").alias("Total_Insertions"),
        F.sum("del").alias("Total_Deletions"),
    ]
    for e in CHURN_EXTENSIONS:
        hit = F.col("ext") == e
        aggs += [
            F.sum(F.when(hit, 1).otherwise(0)).alias(f"{e}_ModifiedFileCount"),
            F.sum(F.when(hit, F.col("ins")).otherwise(0)).alias(f"{e}_Insertions"),
            F.sum(F.when(hit, F.col("del")).otherwise(0)).alias(f"{e}_Deletions"),
        ]
    return rows.groupBy(*keys, "module").agg(*aggs)


def read_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every file below a folder with the file's path."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(folder)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )


def file_inventory(lines: DataFrame, path: str, module: Column) -> DataFrame:
    """File and line counts per module and extension, tests left out."""
    rows = lines.where(~F.col(path).rlike(INVENTORY_TEST_FILES)).select(
        path, module.alias("module"), F.regexp_extract(path, r"\.([a-z]+)$", 1).alias("ext")
    )
    per_file = (
        rows.where(F.col("ext").isin(*CHURN_EXTENSIONS))
        .groupBy("module", "ext", path)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return per_file.groupBy("module", "ext").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("_n").alias("lines_of_code")
    )


def ascii_boundaries(pattern: str) -> str:
    r"""The pattern with ``\b`` written out, as Java up to 18 counts letters such as é there, unlike in ``\w``."""
    edge = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
    return re.sub(r"\\(.)", lambda m: edge if m[1] == "b" else m[0], pattern, flags=re.S)


def flagged_share(
    lines: DataFrame,
    path: str,
    text: str,
    module: Column,
    patterns=FLAG_PATTERNS,
    threshold: float = 0.5,
    files: str | None = SOURCE_FILES,
    tests: str | None = INVENTORY_TEST_FILES,
) -> DataFrame:
    r"""Share of a module's files in which some line matches a pattern.

    ``\b`` in a pattern stands between an ASCII word character and any other, as ``\w`` has it.
    """
    rows = lines
    if files:
        rows = rows.where(F.col(path).rlike(files))
    if tests:
        rows = rows.where(~F.col(path).rlike(tests))
    hit = F.col(text).rlike("|".join(f"(?:{ascii_boundaries(p)})" for p in patterns))
    per_file = (
        rows.select(module.alias("module_path"), F.col(path).alias("_file"), hit.alias("_hit"))
        .groupBy("module_path", "_file")
        .agg(F.bool_or("_hit").alias("_hit"))
    )
    out = per_file.groupBy("module_path").agg(
        F.sum(F.when(F.col("_hit"), 1).otherwise(0)).alias("flagged_file_count"),
        F.count(F.lit(1)).alias("total_file_count"),
    )
    return out.withColumn(
        "flag_pct", rounded(ratio(F.col("flagged_file_count"), F.col("total_file_count")), 4)
    ).withColumn("is_flagged", F.col("flag_pct") >= threshold)


def marked_commits(
    commits: DataFrame, message: str, commit: str, module: str, period: str, marker="# breaking"
) -> DataFrame:
    """Commits whose message holds a marker (case ignored), once per module and period."""
    hits = commits.where(F.col(message).ilike(f"%{marker}%") & F.col(module).isNotNull())
    return (
        hits.select(commit, module, period)
        .distinct()
        .groupBy(F.col(module).alias("module_path"), F.col(period).alias("quarter"))
        .agg(F.count(F.lit(1)).alias("breaking_count"))
    )


def project_edges(lines: DataFrame, path: str, text: str, kind: str = "compileOnly") -> DataFrame:
    """``kind project(":a:b")`` lines of build files to (from_path, dependency_path)."""
    found = F.regexp_extract(
        F.col(text), kind + r"\s+project\s*\(\s*(?:path:\s*)?\":([^\"]+)\"", 1
    )
    folder = F.regexp_replace(F.col(path), r"/[^/]+$", "")
    return lines.where(found != "").select(
        folder.alias("from_path"), F.regexp_replace(found, ":", "/").alias("dependency_path")
    )


def bundle_registry(lines: DataFrame, path: str, text: str) -> DataFrame:
    """Bundle names and versions from bundle files; one row per symbolic name."""
    field = F.regexp_extract(F.col(text), r"^(Bundle-[A-Za-z]+):\s*(.*)$", 1)
    value = F.trim(F.regexp_extract(F.col(text), r"^(Bundle-[A-Za-z]+):\s*(.*)$", 2))
    folder = F.regexp_replace(F.col(path), r"/[^/]+$", "")
    rows = lines.select(folder.alias("module_path"), field.alias("f"), value.alias("v"))
    wide = rows.groupBy("module_path").agg(
        F.min(F.when(F.col("f") == "Bundle-SymbolicName", F.col("v"))).alias("bundle_symbolic_name"),
        F.min(F.when(F.col("f") == "Bundle-Version", F.col("v"))).alias("bundle_version"),
        F.min(F.when(F.col("f") == "Bundle-Name", F.col("v"))).alias("bundle_name"),
    )
    named = wide.where(F.col("bundle_symbolic_name").isNotNull()).withColumn(
        "module_name", F.regexp_extract("module_path", r"[^/]+$", 0)
    )
    rest = ["module_path", "module_name", "bundle_version", "bundle_name"]
    return (
        named.groupBy("bundle_symbolic_name")
        .agg(F.min(F.struct(*rest)).alias("_r"))
        .select("bundle_symbolic_name", "_r.*")
    )


def diff_blocks(diffs: DataFrame, diff_id: str, text: str, excluded: str | None = None) -> DataFrame:
    """One row per changed file of a unified diff: position, path, block, changed lines.

    Deleted files (``+++ /dev/null``) are marked, and paths matching ``excluded`` left out.
    """
    pieces = F.filter(
        F.split(F.col(text), r"(?m)^(?=diff --git )"), lambda b: b.startswith("diff --git ")
    )
    rows = spread(diffs.select(diff_id, text)).select(diff_id, F.posexplode(pieces).alias("block_no", "block"))
    rows = rows.withColumn(
        "file_path", F.regexp_extract("block", r"^diff --git a/(?:.+?) b/([^\n]+)", 1)
    )
    if excluded:
        rows = rows.where(~F.col("file_path").rlike(excluded))
    lines = F.split("block", r"\n")

    def n(first, header):
        return F.size(F.filter(lines, lambda x: x.startswith(first) & ~x.startswith(header)))

    return rows.select(
        diff_id,
        "block_no",
        "file_path",
        "block",
        n("+", "+++").alias("added"),
        n("-", "---").alias("removed"),
        F.col("block").rlike(r"(?m)^\+\+\+ /dev/null").alias("is_deleted"),
    ).withColumn("changed", F.col("added") + F.col("removed"))


def change_manifest(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Files and changed lines per folder of a diff, for the largest-first listing."""
    from shiplens.functions.paths import change_group

    return blocks.groupBy(*keys, change_group(F.col("file_path")).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("changed").alias("n_lines")
    )


def commit_clusters(commits: DataFrame, commit: str, subject: str, projects) -> DataFrame:
    """Commits per ticket; those without one under ``(no ticket)``."""
    ticket = F.coalesce(any_ticket(F.col(subject), projects), F.lit("(no ticket)"))
    return commits.groupBy(ticket.alias("ticket")).agg(
        F.count_distinct(commit).alias("n_commits")
    )


def tickets_in_range(subjects: DataFrame, subject: str, order: list[str]) -> DataFrame:
    """Distinct tickets and other leading words with where each was first seen.

    Sorting by ``first_seen`` gives the order of first appearance.
    """
    word = F.regexp_extract(F.col(subject), r"^(\S*)", 1)
    rows = subjects.select(subject, *order).where(word != "")
    ticket = leading_ticket(word)
    return rows.groupBy(
        F.coalesce(ticket, word).alias("token"), ticket.isNotNull().alias("is_ticket")
    ).agg(F.min(F.struct(*order)).alias("first_seen"), F.count(F.lit(1)).alias("n_commits"))


def revert_split(subjects: DataFrame, message: str, commit: str) -> DataFrame:
    """Reverts by commit, other commits by their ticket-like first word."""
    first = F.regexp_extract(F.col(message), r"^([^ \n]*)", 1)
    kind = (
        F.when(F.lower(message).contains("revert"), "revert")
        .when(first.contains("-"), "ticket")
        .otherwise("other")
    )
    return subjects.select(commit, kind.alias("kind"), first.alias("token"))
