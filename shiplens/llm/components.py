"""Connected components of an edge table, by stars that shrink in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import stage


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    """Per ``u``: the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))


def connected_components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``node``, ``component`` (its smallest node) for each node of ``edges`` (``u``, ``v`` long).

    Each round every node hands its larger neighbours to its smallest one, then does the same
    for the smaller ones, until nothing changes; the number of rounds grows with the logarithm
    of the longest path. Both sides of every join are staged tables, so adaptive execution can
    split a node with very many edges. An empty table gives an empty result; a node of which
    only a loop is given is its own component.
    """
    pairs = edges.filter("u is not null and v is not null").select("u", "v")
    links = stage(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    nodes = links.select("u").union(links.select("v")).distinct()
    links = links.filter("u > v")
    last = None
    for _ in range(most_rounds):
        both = stage(links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        low = stage(_smallest_neighbour(both))
        large = (
            both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = stage(large.filter("u > v"))
        low = stage(_smallest_neighbour(large))
        # Each remaining node and its smaller neighbours go to the smallest of them.
        small = (
            large.join(low, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u > v")
            .distinct()
        )
        links = stage(small)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            break
        last = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    found = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.select(F.col("u").alias("node")).join(found, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
