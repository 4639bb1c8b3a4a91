"""Lines that many sites share, found by the spread of sites per line.

Each distinct line gets a HyperLogLog sketch of the sites it appears on; sketches merge in the
aggregate, so a line of a third of all documents costs one small sketch a task. Where the estimate
is near the threshold the sites are counted exactly. A line of enough sites is boilerplate: it
stays in the first document that has it and goes from all others, so no text is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import columns_of, fresh, row_key, stage

SITES = 10
#: Standard error of a sketch is 1.04 / sqrt(2 ** 12) = 1.6 %; the band is twelve times that.
LOG_SIZE = 12
BAND = 0.2


def _lines(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """One row a line that is not blank: ids, position, the line's key, its site."""
    line = F.col("line")
    return docs.select(
        F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row_key"), F.col(site).alias("site"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"),
    ).filter(F.trim(line) != "").select(
        "doc_id", "row_key", "site", "pos", F.struct(F.xxhash64("line").alias("hash"), F.length("line").alias("size")).alias("key")
    )


def shared_lines(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """``key``, ``first`` (the first place) of each line on at least ``sites`` distinct sites."""
    spread = stage(
        lines.groupBy("key")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_SIZE)).alias("estimate"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key", "pos")).alias("first"),
        )
        .filter(F.col("estimate") >= int(sites * (1 - BAND)))
    )
    near = spread.filter(F.col("estimate") <= sites * (1 + BAND))
    exact = (
        lines.join(near.select("key"), "key", "left_semi")
        .select("key", "site")
        .distinct()
        .groupBy("key")
        .agg(F.count("site").alias("n"))
        .filter(F.col("n") >= sites)
    )
    sure = spread.filter(F.col("estimate") > sites * (1 + BAND))
    return sure.select("key", "first").union(near.join(exact, "key", "left_semi").select("key", "first"))


def _without(lines: Column, places: Column) -> Column:
    """``lines`` without those at the sorted ``places``: the stretches between them, in turn."""
    ends = F.concat(F.array(F.lit(-1)), places, F.array(F.size(lines)))
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size(places)),
            lambda k: F.slice(lines, F.get(ends, k) + 2, F.get(ends, k + 1) - F.get(ends, k) - 1),
        )
    )


def remove_shared_lines(
    docs: DataFrame, sites: int = SITES, doc_id: str = "doc_id", text: str = "text", site: str = "source"
) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, and ``lines_removed``.

    The first place of a line is the one with the smallest doc_id (null last), then row key, then
    position; it stays, also in each copy of that very row. Blank lines are never counted. A null
    site counts as none. A null text stays null; a document may end up empty. A column of ``docs``
    named ``lines_removed`` is replaced, all others are kept. Texts of any length are cut into all
    their lines; an empty table gives no rows.
    """
    lines = stage(_lines(docs, doc_id, text, site))
    shared = stage(shared_lines(lines, sites))
    here = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key", "pos")
    places = (
        lines.join(shared, "key")
        .filter(~here.eqNullSafe(F.col("first")))
        .groupBy(F.col("row_key").alias("_key"))
        .agg(F.sort_array(F.collect_set("pos")).alias("_places"))
    )
    given = docs.drop("lines_removed")
    key, gone = fresh(given, "_key", "_places")
    # A merge at every size: the places of a large corpus are no smaller part of it than those of a
    # small one, so a broadcast that fits today is no plan for tomorrow.
    places = stage(places).withColumnsRenamed({"_key": key, "_places": gone}).hint("merge")
    keyed = given.withColumn(key, row_key(doc_id, text)).join(places, key, "left")
    cleaned = F.array_join(_without(F.split(F.col(text), "\n", -1), F.col(gone)), "\n")
    return keyed.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(cleaned)).select(
        *columns_of(given), F.coalesce(F.size(gone), F.lit(0)).alias("lines_removed")
    )
