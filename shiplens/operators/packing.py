"""Running totals and next-fit packing over long ordered groups, in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.lineage import cut_lineage


def running_total(
    df: DataFrame, group: list[str], position: str, value: str, name: str, block: int = 10_000
) -> DataFrame:
    """Inclusive running sum along ``position`` (a non-negative integer) in each group.

    Positions are cut into blocks: the window sorts one block, and a second window sums one
    row per block, so no task sorts a whole group.
    """
    rows = df.withColumn("_blk", F.floor(F.col(position) / block))
    sums = rows.groupBy(*group, "_blk").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy(*group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_blk", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_o"))
    inside = (
        Window.partitionBy(*group, "_blk")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.join(offsets, [*group, "_blk"])
        .withColumn(name, F.col("_o") + F.sum(value).over(inside))
        .drop("_blk", "_o")
    )


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1 and so on along ``keys``, which no two rows share, counted range by range."""
    laid = cut_lineage(rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = laid.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1 + F.col("_before")
    return laid.join(before, "_range").withColumn(name, place).drop("_range", "_before")


def next_position(df: DataFrame, group: str, position: str, block: int = 10_000) -> DataFrame:
    """Adds ``_next``: the following position in the group, null at its end."""
    rows = df.select(group, position, F.floor(F.col(position) / block).alias("_blk"))
    heads = rows.groupBy(group, "_blk").agg(F.min(position).alias("_head"))
    along = Window.partitionBy(group).orderBy("_blk")
    heads = heads.select(group, "_blk", F.lead("_head").over(along).alias("_head"))
    inside = Window.partitionBy(group, "_blk").orderBy(position)
    return rows.join(heads, [group, "_blk"]).select(
        group, position, F.coalesce(F.lead(position).over(inside), F.col("_head")).alias("_next")
    )


def pack_batches(
    sections: DataFrame, group: str, position: str, size: str, max_size: int
) -> DataFrame:
    """Batch number of each section when packed in order under a size budget.

    A batch takes sections until the next one would exceed ``max_size``; a larger section
    stands alone. The batch that would start at each section is found by a join on the
    running total, and the real starts by doubling jumps from the first section, so the
    rounds grow with the logarithm of the number of batches.
    """
    rows = cut_lineage(
        running_total(sections.select(group, position, size), [group], position, size, "_end")
        .withColumn("_begin", F.col("_end") - F.col(size))
    )
    # The section that breaks the batch begun at i covers the point begin_i + max_size.
    covers = rows.where(F.col(size) > 0).select(
        group,
        F.col(position).alias("_breaker"),
        F.col("_begin").alias("_b"),
        F.col("_end").alias("_e"),
        F.explode(
            F.sequence(F.floor(F.col("_begin") / max_size), F.floor((F.col("_end") - 1) / max_size))
        ).alias("_cell"),
    )
    point = F.col("_begin") + max_size
    wanted = rows.select(
        group, position, point.alias("_pt"), F.floor(point / max_size).alias("_cell")
    )
    hits = (
        wanted.join(covers, [group, "_cell"])
        .where((F.col("_b") <= F.col("_pt")) & (F.col("_pt") < F.col("_e")))
        .select(group, F.col(position).alias("_from"), F.col("_breaker").alias("_to"))
    )
    # An oversized section breaks at itself: its batch ends there and the next one follows.
    stuck = hits.where(F.col("_from") == F.col("_to")).select(group, "_from")
    moved = stuck.join(
        next_position(rows, group, position).select(
            group, F.col(position).alias("_from"), F.col("_next").alias("_to")
        ),
        [group, "_from"],
    ).where(F.col("_to").isNotNull())
    jumps = cut_lineage(
        hits.where(F.col("_from") != F.col("_to")).unionByName(moved.select(group, "_from", "_to"))
    )
    starts = cut_lineage(rows.groupBy(group).agg(F.min(position).alias("_from")))
    known = starts.count()
    while True:
        more = starts.join(jumps, [group, "_from"]).select(group, F.col("_to").alias("_from"))
        starts = cut_lineage(starts.unionByName(more).distinct())
        grown = starts.count()
        if grown == known:
            break
        known = grown
        first = jumps.withColumnRenamed("_to", "_mid")
        second = jumps.withColumnRenamed("_from", "_mid")
        jumps = cut_lineage(first.join(second, [group, "_mid"]).select(group, "_from", "_to"))
    marked = rows.join(
        starts.select(group, F.col("_from").alias(position), F.lit(1).alias("_is")),
        [group, position],
        "left",
    ).withColumn("_is", F.coalesce("_is", F.lit(0)))
    return running_total(marked, [group], position, "_is", "batch_number").select(
        group, position, size, F.col("batch_number").cast("long").alias("batch_number")
    )
