"""Incremental builds as Structured Streaming: dedup, weekly buckets, tags, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiplens.lineage import run_folder
from shiplens.operators.merge import PartitionedTable, upsert
from shiplens.operators.periods import week_start


def build_stream(
    spark: SparkSession, folder: str, schema, glob: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def unseen(
    stream: DataFrame, key: str, ts: str, since=None, delay: str = "30 days"
) -> DataFrame:
    """Each build id once, nothing before the cutoff date.

    The watermark bounds the state: an id is remembered for ``delay`` of event time.
    """
    rows = stream if since is None else stream.where(F.col(ts) >= F.lit(since))
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def weekly(stream: DataFrame, ts: str, keys: list[str], failed, delay: str = "14 days") -> DataFrame:
    """Event and failure counts per Monday week and key."""
    # 1970-01-05 was a Monday, hence the four days of offset.
    week = F.window(ts, "7 days", startTime="4 days")
    return (
        stream.withWatermark(ts, delay)
        .groupBy(week.alias("_w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum(F.when(failed, 1).otherwise(0)).alias("n_failed"),
        )
        .select(F.to_date("_w.start").alias("week_of"), *keys, "n_events", "n_failed")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Takes what is there, then stops; a restart resumes from the checkpoint."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def upsert_to(stream: DataFrame, table: PartitionedTable, keys: list[str], checkpoint: str):
    """Each micro-batch is merged on its key, into the partitions it touches; a replayed batch
    gives the same table."""

    def merge(batch: DataFrame, _: int) -> None:
        table.merge(batch, keys, upsert)

    return (
        stream.writeStream.foreachBatch(merge)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()


def weekly_table(
    spark: SparkSession, stream: DataFrame, ts: str, keys: list[str], failed
) -> DataFrame:
    """Runs the weekly aggregation over all landed files and reads the merged table."""
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = ", ".join(["week_of date", *[f"{k} {kinds[k]}" for k in keys], "n_events long, n_failed long"])
    table = PartitionedTable(spark, run_folder(spark, "weekly"), schema, ["week_of"])
    run_to_end(
        upsert_to(
            weekly(stream, ts, keys, failed), table, ["week_of", *keys], run_folder(spark, "state")
        )
    )
    return table.read()


def land(rows: DataFrame, folder: str) -> None:
    """New files for a stream that reads the folder."""
    rows.write.mode("append").parquet(folder)


def deduplicated_table(spark: SparkSession, stream: DataFrame, key: str, ts: str, since=None):
    """Runs the dedup over all landed files and reads what was appended."""
    path = run_folder(spark, "unseen")
    run_to_end(append_to(unseen(stream, key, ts, since), path, run_folder(spark, "state")))
    return spark.read.parquet(path)


def recompute_weeks(
    rows: DataFrame, table: PartitionedTable, ignored: DataFrame, build: str, ts: str, failed
) -> None:
    """A late tag: recount only the weeks that hold a tagged build, without it, and merge."""
    week = week_start(F.col(ts))
    dated = rows.withColumn("week_of", week)
    touched = dated.join(ignored.select(build), build, "left_semi").select("week_of").distinct()
    fresh = (
        dated.join(touched, "week_of", "left_semi")
        .join(ignored.select(build), build, "left_anti")
        .groupBy("week_of")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum(F.when(failed, 1).otherwise(0)).alias("n_failed"),
        )
    )
    emptied = touched.join(fresh, "week_of", "left_anti").select(
        "week_of", F.lit(0).cast("long").alias("n_events"), F.lit(0).cast("long").alias("n_failed")
    )
    table.merge(fresh.unionByName(emptied), ["week_of"])
