"""How often two items meet in the same unit, without pairing up every unit's items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplens.lineage import cut_lineage
from shiplens.operators.joins import salted_join


def shared_unit_pairs(
    memberships: DataFrame,
    unit: str,
    item: str,
    min_shared: int,
    side: str | None = None,
    hot_units: int = 20_000,
    chunk: int = 5_000,
) -> DataFrame:
    """Item pairs that share at least ``min_shared`` units, with the exact count.

    ``memberships`` holds distinct (unit, item) rows. ``side`` names a column of the item;
    pairs are then built from a smaller to a larger side only, else from a smaller to a
    larger item. Result columns: ``<item>_a``, ``<item>_b``, ``shared``.

    * Items in fewer than ``min_shared`` units cannot qualify and leave first.
    * A unit of more than ``hot_units`` items is never paired up for an item that has it
      among its ``min_shared - 1`` largest units: two items sharing ``min_shared`` units
      must also share one outside those, so no pair is lost. The units set aside are
      added back to the count of each pair found.
    * What is paired is split into chunks of ``chunk`` rows per unit, and counts are
      combined before the shuffle.
    * Where items are in few units and units hold many items, nearly all pairs meet once.
      Items that share two units or more are then looked for by two units at a time, which
      makes no pair that meets once (``_pairs_by_two_units``).
    """
    a, b = f"{item}_a", f"{item}_b"
    cols = [unit, item] + ([side] if side and side != item else [])
    rows = memberships.select(*cols)
    often = rows.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    # Written out, so that a frequent item is left to adaptive skew handling; copies of all items
    # for a salt would be most of what is shuffled.
    often = cut_lineage(often.where(F.col("_n") >= min_shared).withColumnRenamed("_n", "_times"))
    rows = rows.join(often.hint("merge"), item)
    sizes = rows.groupBy(unit).agg(F.count(F.lit(1)).alias("_size"))
    # Written out once: read again for the pairs and, with hot units, for their counts.
    sized = cut_lineage(salted_join(rows, sizes, unit, F.col(item)))
    key = side or item

    aside = None
    if min_shared > 1 and not sized.where(F.col("_size") > hot_units).isEmpty():
        order = Window.partitionBy(item).orderBy(F.desc("_size"), unit)
        aside = (
            sized.where(F.col("_size") > hot_units)
            .withColumn("_rn", F.row_number().over(order))
            .where(F.col("_rn") <= min_shared - 1)
            .select(unit, item)
        )
        paired = sized.join(aside, [unit, item], "left_anti")
    else:
        paired = sized

    if min_shared > 1:
        twos = _two_units_of_items(sized, paired, unit, item, key, chunk)
        if twos is not None:
            return _pairs_by_two_units(twos, item, a, b, min_shared)

    met = _meetings(paired, unit, item, key, "_size", chunk)
    found = met.groupBy(F.col("_a").alias(a), F.col("_b").alias(b)).agg(F.count(F.lit(1)).alias("_n"))
    if aside is not None:
        found = cut_lineage(found)
        found = _add_units_set_aside(found, sized, paired, aside, unit, item, a, b, hot_units)
    return found.where(F.col("_n") >= min_shared).select(
        a, b, F.col("_n").alias("shared")
    )


def _meetings(rows, place, what, key, size, chunk):
    """``_a``, ``_b``: each two of ``what`` in one ``place``, from a smaller to a larger ``key``.

    The rest of ``rows`` is that of ``_a``. A place of ``size`` rows is dealt in chunks.
    """
    # The pairs far outnumber the bytes read, so tasks are not sized by bytes: the number is
    # given, and adaptive execution leaves it alone.
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    chunks = F.ceil(F.col(size) / chunk).cast("int")
    left = rows.withColumns(
        {"_a": F.col(what), "_ka": F.col(key), "_chunk": F.pmod(F.xxhash64(what), chunks).cast("int")}
    )
    right = rows.select(
        place,
        F.col(what).alias("_b"),
        F.col(key).alias("_kb"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_chunk"),
    ).repartition(tasks, place, "_chunk")
    # A staged table is far smaller as a file than in memory; neither side may be broadcast by it.
    return left.join(right.hint("merge"), [place, "_chunk"]).where(F.col("_ka") < F.col("_kb"))


def _two_units_of_items(sized, paired, unit, item, key, chunk):
    """``item``, ``_key``, ``_u``, ``_v``: each item with every two of its units.

    None where that and the pairs they make would outnumber the pairs of ``paired`` in one unit.
    """
    direct = paired.agg(F.sum(F.col("_size") - 1) / 2).first()[0] or 0
    twos = sized.agg(F.sum(F.col("_times") - 1) / 2).first()[0] or 0
    if twos >= direct:
        return None
    rows = _meetings(sized.withColumn("_key", F.col(key)), item, unit, unit, "_times", chunk)
    rows = rows.select(item, "_key", F.col("_a").alias("_u"), F.col("_b").alias("_v"))
    # How many items meet in two units is only estimated, by signed counts of hash values (a
    # sketch of the sum of squares, good to some per cent): it chooses the way, not the result.
    h = F.xxhash64("_u", "_v")
    signed = rows.groupBy(F.pmod(h, F.lit(4096)).alias("_h")).agg(F.sum(F.when(h < 0, -1).otherwise(1)).alias("_s"))
    squares = signed.agg(F.sum(F.col("_s").cast("double") * F.col("_s"))).first()[0] or 0
    return rows if twos + (squares - twos) / 2 < direct else None


def _pairs_by_two_units(twos, item, a, b, min_shared):
    """Item pairs that share at least ``min_shared`` (two or more) units, with the exact count.

    A pair that shares n units meets in n (n - 1) / 2 twos of units, from which n follows.
    """
    left = twos.select("_u", "_v", F.col(item).alias(a), F.col("_key").alias("_ka"))
    right = twos.select("_u", "_v", F.col(item).alias(b), F.col("_key").alias("_kb"))
    met = left.join(right.hint("merge"), ["_u", "_v"]).where(F.col("_ka") < F.col("_kb"))
    found = met.groupBy(a, b).agg(F.count(F.lit(1)).alias("_n"))
    shared = ((F.sqrt(F.col("_n") * 8 + 1) + 1) / 2).cast("long")
    return found.where(F.col("_n") >= min_shared * (min_shared - 1) // 2).select(a, b, shared.alias("shared"))


def _add_units_set_aside(found, sized, paired, aside, unit, item, a, b, hot_units):
    """Adds |aside(b) & all(a)| and |aside(a) & paired(b)| to each pair found.

    An item sets at most ``min_shared - 1`` units aside, so the fan-out is bounded.
    """

    def extra(mine, other, other_rows):
        hot = other_rows.where(F.col("_size") > hot_units).select(
            F.col(unit), F.col(item).alias(other)
        )
        return (
            found.select(a, b)
            .join(aside.select(unit, F.col(item).alias(mine)), mine)
            .join(hot, [unit, other], "left_semi")
            .groupBy(a, b)
            .agg(F.count(F.lit(1)).alias("_n"))
        )

    more = extra(b, a, sized).unionByName(extra(a, b, paired))
    return found.unionByName(more.select(a, b, "_n")).groupBy(a, b).agg(F.sum("_n").alias("_n"))
