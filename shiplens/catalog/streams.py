"""The event table as a file stream, run over all landed files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiplens.catalog.registry import query
from shiplens.lineage import run_folder
from shiplens.operators.merge import PartitionedTable
from shiplens.streaming import builds

_WEEK = """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_of, event_type, count(*) AS n_events,
  count(*) FILTER (WHERE value > 20) AS n_failed FROM events GROUP BY 1, 2"""


def _stream(t):
    # A watermark needs a timestamp with zone; the session zone is taken.
    s = builds.build_stream(t.spark, t.folder, t.events.schema, "events.parquet")
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


@query(_WEEK)
def stream_weekly(t):
    out = builds.weekly_table(t.spark, _stream(t), "ts", ["event_type"], F.col("value") > 20)
    return out.withColumn("week_of", F.col("week_of").cast("string"))


@query("SELECT user_id, count(*) AS n, min(event_id) AS first_event FROM events WHERE ts >= '2024-01-10' GROUP BY 1")
def stream_dedup(t):
    """Every file row arrives twice; each event id is kept once."""
    twice = _stream(t).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    out = builds.deduplicated_table(
        t.spark, twice, "event_id", "ts", F.to_timestamp(F.lit("2024-01-10 00:00:00"))
    )
    return out.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event")
    )


@query(
    """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_of, count(*) AS n_events,
      count(*) FILTER (WHERE value > 20) AS n_failed FROM events
    WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 95 AND ts >= '2024-01-22') GROUP BY 1"""
)
def stream_recompute(t):
    """Late tags: users are excluded afterwards and the weeks they touch are recounted."""
    failed = F.col("value") > 20
    table = PartitionedTable(t.spark, run_folder(t.spark, "weeks"), "week_of date, n_events long, n_failed long", ["week_of"])
    weekly = builds.weekly(_stream(t), "ts", [], failed)
    builds.run_to_end(builds.upsert_to(weekly, table, ["week_of"], run_folder(t.spark, "state")))
    late = t.events.where(
        (F.col("event_type") == "error") & (F.col("value") > 95) & (F.to_date("ts") >= F.to_date(F.lit("2024-01-22")))
    ).select("user_id").distinct()
    builds.recompute_weeks(t.events, table, late, "user_id", "ts", failed)
    return table.read().where(F.col("n_events") > 0).withColumn("week_of", F.col("week_of").cast("string"))


_ARRIVALS = """
WITH a AS (
  SELECT *, 1 AS b FROM events WHERE ts < '2024-01-11' AND event_id % 10 <> 0
  UNION ALL SELECT *, 2 FROM events WHERE ts >= '2024-01-11' AND ts < '2024-01-21' AND event_id % 10 <> 0
  UNION ALL SELECT *, 2 FROM events WHERE ts < '2024-01-11' AND event_id % 10 IN (0, 1)
  UNION ALL SELECT *, 3 FROM events WHERE ts >= '2024-01-21'
  UNION ALL SELECT *, 3 FROM events WHERE ts >= '2024-01-11' AND ts < '2024-01-21' AND event_id % 10 IN (0, 1)
  UNION ALL SELECT *, 3 FROM events WHERE ts < '2024-01-11' AND event_id % 10 = 2),
wm AS (SELECT 2 AS b, date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY AS late FROM a WHERE b = 1
  UNION ALL SELECT 3, date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY FROM a WHERE b <= 2),
kept AS (SELECT event_id, any_value(ts) AS ts, any_value(value) AS value, min(a.b) AS arrived FROM a LEFT JOIN wm USING (b) WHERE late IS NULL OR ts > late GROUP BY 1)
"""


def _arrivals(t):
    """The events as they land in three batches: late ones, and ones that came before, among them."""
    first, second = F.to_timestamp(F.lit("2024-01-11 00:00:00")), F.to_timestamp(F.lit("2024-01-21 00:00:00"))
    ts, part = F.col("ts"), F.col("event_id") % 10
    rows = t.events.withColumn("ts", ts.cast("timestamp"))
    early, middle = rows.where(ts < first), rows.where((ts >= first) & (ts < second))
    return [
        early.where(part != 0),
        middle.where(part != 0).union(early.where(part.isin(0, 1))),
        rows.where(ts >= second).union(middle.where(part.isin(0, 1))).union(early.where(part == 2)),
    ]


def _resumed(t, target):
    """Lands a batch, runs the stream to its end and stops it; the next run goes on from the checkpoint."""
    folder = run_folder(t.spark, "landed")
    for batch in _arrivals(t):
        builds.land(batch, folder)
        stream = t.spark.readStream.schema(batch.schema).parquet(folder)
        builds.run_to_end(target(builds.unseen(stream, "event_id", "ts", delay="3 days")))


@query(_ARRIVALS + "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM kept")
def stream_resumed_dedup(t):
    """Three runs of one stream: an id seen in an earlier run, or too late for the watermark, is dropped."""
    out, state = run_folder(t.spark, "unseen"), run_folder(t.spark, "state")
    _resumed(t, lambda stream: builds.append_to(stream, out, state))
    return t.spark.read.parquet(out).select("event_id", F.to_date("ts").cast("string").alias("day"))


@query(
    _ARRIVALS
    + """SELECT strftime(ts, '%Y-%m-%d') AS day, event_id, value FROM kept"""
)
def stream_resumed_upsert(t):
    """The same three runs, merged by day: a batch rewrites the days it touches and no other."""
    table = PartitionedTable(t.spark, run_folder(t.spark, "days"), "day string, event_id long, value double", ["day"])
    state = run_folder(t.spark, "state")

    def merged(stream):
        rows = stream.select(F.to_date("ts").cast("string").alias("day"), "event_id", "value")
        return builds.upsert_to(rows, table, ["day", "event_id"], state)

    _resumed(t, merged)
    return table.read()
