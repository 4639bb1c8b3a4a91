"""Readers: declared schemas, required columns, newest snapshot, landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and declared types; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_strings(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """CSV as strings; fails where a required column is absent."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    return df


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """String columns cast; text that does not parse becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def read_positional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose header is replaced by the schema's names, by position."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


FUNCTION_SCHEMA = T.StructType(
    [
        T.StructField("nloc", T.IntegerType()),
        T.StructField("ccn", T.IntegerType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("param_count", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("location", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("function_name", T.StringType()),
        T.StructField("long_name", T.StringType()),
        T.StructField("start_line", T.IntegerType()),
        T.StructField("end_line", T.IntegerType()),
    ]
)

# Extensions and measures of the churn table.
CHURN_EXTENSIONS = ("Total", "java", "js", "jsp", "ts", "tsx", "css", "scss")
CHURN_MEASURES = ("FileCount", "LinesOfCode", "ModifiedFileCount", "Insertions", "Deletions")
CHURN_SCHEMA = T.StructType(
    [T.StructField("Quarter", T.StringType()), T.StructField("Module", T.StringType())]
    + [
        T.StructField(f"{e}_{m}", T.DoubleType())
        for e in CHURN_EXTENSIONS
        for m in CHURN_MEASURES
    ]
)


def read_latest(spark: SparkSession, glob: str, schema: T.StructType) -> DataFrame:
    """Rows of the file whose name sorts last among those the glob matches."""
    df = spark.read.schema(schema).option("header", True).csv(glob)
    return newest_file(df)


def newest_file(df: DataFrame) -> DataFrame:
    """Rows of the file whose name sorts last; the other files are listed but not opened."""
    names = {path.rsplit("/", 1)[-1] for path in df.inputFiles()}
    return df.where(F.col("_metadata.file_name") == max(names)) if names else df


def newest_folder(df: DataFrame) -> DataFrame:
    """Rows of the files in the folder whose path sorts last; the others are not opened."""
    folders = {path.rsplit("/", 1)[0] for path in df.inputFiles()}
    if not folders:
        return df
    # The listing says file:///, the column file:/; what follows the scheme is the same.
    last = "/" + max(folders).split(":", 1)[-1].lstrip("/") + "/"
    return df.where(F.contains("_metadata.file_path", F.lit(last)))


def stage(df: DataFrame, path: str) -> DataFrame:
    """Writes an intermediate once and reads it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(
    spark: SparkSession, url: str, table: str, predicates: list[str] | None = None,
    split: tuple[str, int, int, int] | None = None, **props,
) -> DataFrame:
    """Relational table over JDBC; the database applies filters and picks the columns.

    Each of ``predicates`` becomes one partition of the scan; ``split`` (a numeric column, its
    lowest and highest value, a number) makes that many ranges of the column.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if split:
        column, low, high, parts = split
        return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_table(df: DataFrame, url: str, table: str, mode: str = "overwrite", **props) -> None:
    """A relational table over JDBC, written by as many connections as there are partitions."""
    df.write.jdbc(url, table, mode=mode, properties=props)


def rows_for(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is in an id list: one semi join instead of chunked IN lists."""
    return df.join(ids.select(key), key, "left_semi")


RELEASE_SCHEMA = (
    "release_label string, quarter_label string, git_tag string, release_date date, "
    "is_major_release boolean, is_lts boolean, release_status string, notes string"
)


def releases(records: DataFrame) -> DataFrame:
    """Release registry with trimmed text and upper-case status."""
    return records.select(
        F.trim("release_label").alias("release_label"),
        F.trim("quarter_label").alias("quarter_label"),
        F.trim("git_tag").alias("git_tag"),
        F.col("release_date").cast("date").alias("release_date"),
        F.coalesce("is_major_release", F.lit(False)).alias("is_major_release"),
        F.coalesce("is_lts", F.lit(False)).alias("is_lts"),
        F.upper(F.trim("release_status")).alias("release_status"),
        F.trim(F.coalesce("notes", F.lit(""))).alias("notes"),
    )


def stopwords(lines: DataFrame, text: str = "value") -> DataFrame:
    """One lower-case word per line; blanks and ``#`` lines dropped."""
    word = F.lower(F.trim(text))
    return lines.select(word.alias("word")).where(
        (F.col("word") != "") & ~F.col("word").startswith("#")
    ).distinct()


def spec_index(files: DataFrame, path: str) -> DataFrame:
    """Spec files with the first folder of their path as module name."""
    return files.where(F.col(path).rlike(r"\.spec\.(ts|js)$")).select(
        F.col(path).alias("spec_path"), F.split_part(F.col(path), F.lit("/"), F.lit(1)).alias("module_name")
    )


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Paths below a folder, without reading the contents."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    return files.select("path", "length")
