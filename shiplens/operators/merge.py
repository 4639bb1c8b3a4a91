"""Keyed merges and table writes on plain files."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.lineage import cut_lineage


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace existing ones with the same key; all columns are taken."""
    return incoming.unionByName(
        existing.join(incoming.select(*keys), keys, "left_anti"), allowMissingColumns=True
    )


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is new are added; existing rows never change."""
    return existing.unionByName(
        incoming.join(existing.select(*keys), keys, "left_anti"), allowMissingColumns=True
    )


def _outer(existing: DataFrame, incoming: DataFrame, keys: list[str]):
    marked = incoming.select(
        *keys,
        F.lit(True).alias("_new"),
        *[F.col(c).alias(f"_in_{c}") for c in incoming.columns if c not in keys],
    )
    return existing.join(marked, keys, "full_outer")


def upsert_columns(
    existing: DataFrame, incoming: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Only ``columns`` are taken from incoming; the others keep their value or stay null."""
    rest = [c for c in existing.columns if c not in keys]
    return _outer(existing, incoming.select(*keys, *columns), keys).select(
        *keys,
        *[
            F.when(F.col("_new"), F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in rest
        ],
    )


def upsert_keep_old(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """As upsert, but an incoming null keeps the old value."""
    rest = [c for c in existing.columns if c not in keys]
    return _outer(existing, incoming, keys).select(
        *keys,
        *[
            F.coalesce(F.col(f"_in_{c}"), F.col(c)).alias(c) if c in incoming.columns else F.col(c)
            for c in rest
        ],
    )


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    values: dict[str, str],
    only_null: bool = False,
) -> DataFrame:
    """Update by join: target column -> source column, rows without a match unchanged."""
    picked = source.select(*keys, *[F.col(s).alias(f"_u_{t}") for t, s in values.items()])
    joined = target.join(picked.withColumn("_hit", F.lit(True)), keys, "left")
    for t in values:
        take = F.col("_hit") & (F.col(t).isNull() if only_null else F.lit(True))
        joined = joined.withColumn(t, F.when(take, F.col(f"_u_{t}")).otherwise(F.col(t)))
    return joined.select(*target.columns)


def add_column(df: DataFrame, name: str, dtype: str, default) -> DataFrame:
    """Adds a column only where it is missing."""
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(dtype))


def newest_row(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Newest appended row per key."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(at, *[c for c in rest if c != at])).alias("_r"))
        .select(*keys, "_r.*")
    )


def update_distinct(
    target: DataFrame, source: DataFrame, keys: list[str], values: dict[str, str]
) -> DataFrame:
    """Rows of ``target`` that the matching source row changes, with their new values.

    Target column -> source column; nulls compare like other values, so null to null is no change
    and null to a value is one. ``changed`` lists the columns that differ. Rows that stay as they
    are, and rows without a match, are not returned: what is written is the change alone.
    """
    picked = source.select(*keys, *[F.col(s).alias(f"_u_{t}") for t, s in values.items()])
    both = target.join(picked, keys)
    differs = {t: ~F.col(t).eqNullSafe(F.col(f"_u_{t}")) for t in values}
    names = F.array_compact(F.array(*[F.when(d, F.lit(t)) for t, d in differs.items()]))
    return (
        both.withColumn("changed", names)
        .where(F.size("changed") > 0)
        .select(*[F.col(f"_u_{c}").alias(c) if c in values else F.col(c) for c in target.columns], "changed")
    )


class PartitionedTable:
    """A Parquet table whose partition columns are among the keys of every merge.

    A merge reads the partitions that the incoming rows touch, and no others, and replaces just
    those by Spark's dynamic partition overwrite. The merged rows are written aside first, so a
    merge that fails can run again, and merging the same rows twice changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, partitions: list[str]):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), partitions
        empty = spark.createDataFrame([], schema)
        self.schema = empty.schema
        empty.write.mode("ignore").partitionBy(*partitions).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def read_touched(self, incoming: DataFrame) -> DataFrame | None:
        """The partitions of ``incoming``, named in the scan; None where it has no rows."""
        touched = incoming.select(*self.partitions).distinct().collect()
        if not touched:
            return None
        same = [reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in self.partitions]) for row in touched]
        return self.read().where(reduce(or_, same))

    def replace(self, rows: DataFrame) -> None:
        """Writes whole partitions; partitions without a row here stay as they are."""
        by = rows.select(*self.schema.names).repartition(*self.partitions)
        by.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.partitions).parquet(self.path)

    def merge(self, incoming: DataFrame, keys: list[str], how=upsert) -> None:
        if not set(self.partitions) <= set(keys):
            raise ValueError("the keys of a merge must hold the partition columns")
        incoming = cut_lineage(incoming.select(*self.schema.names))
        existing = self.read_touched(incoming)
        if existing is not None:
            self.replace(cut_lineage(how(existing, incoming, keys)))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def reload(df: DataFrame, path: str) -> None:
    """Truncate and reload."""
    df.write.mode("overwrite").parquet(path)


def create_table_as(
    df: DataFrame, name: str, partition_by: list[str], bucket_by: str, buckets: int, path: str | None = None
) -> DataFrame:
    """Create table as select: partitioned by date, bucketed and sorted by the common join key.

    Tables with equal buckets join, and group, on that key without an exchange. ``path`` puts the
    files of the table in a folder of the caller's choice.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
