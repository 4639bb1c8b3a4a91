"""Dependency graph: degrees, capped reach from every node, blended score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.functions.stats import cap_one, percentile_of_counts, ratio, rounded
from shiplens.lineage import cut_lineage, spread


def degree_stats(
    nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str, quantile: float = 0.90, written: bool = False
) -> DataFrame:
    """Incoming and outgoing edges per node; ``is_shared_util`` marks the top by incoming.

    ``written`` says that ``edges`` is a table of distinct edges already.
    """
    pairs = edges.select(src, dst)
    if not written:
        pairs = pairs.distinct()
    zero = F.lit(0).cast("long")
    incoming = pairs.groupBy(F.col(dst).alias(node)).agg(F.count(F.lit(1)).alias("dependent_count"))
    outgoing = pairs.groupBy(F.col(src).alias(node)).agg(F.count(F.lit(1)).alias("dependency_count"))
    stats = (
        nodes.select(node)
        .distinct()
        .join(incoming, node, "left")
        .join(outgoing, node, "left")
        .withColumns(
            {
                "dependent_count": F.coalesce("dependent_count", zero),
                "dependency_count": F.coalesce("dependency_count", zero),
            }
        )
    )
    # Written once: the limit and the rows read the same counts.
    stats = cut_lineage(stats)
    limit = percentile_of_counts(stats, [], "dependent_count", quantile, "q").scalar()
    return stats.withColumn("is_shared_util", F.col("dependent_count") >= limit)


def reach(
    edges: DataFrame, src: str, dst: str, max_depth: int = 3, written: bool = False
) -> DataFrame:
    """(source, node, depth): who depends on each source, at least depth, within the cap.

    All sources advance together: one join per level, then an anti join against what each
    source has seen. Each level is written out, so a lost executor restarts one level.
    ``written`` says that ``edges`` is a table of distinct edges already.
    """
    back = edges.where(F.col(src) != F.col(dst)).select(
        F.col(dst).alias("_from"), F.col(src).alias("_to")
    )
    if not written:
        back = cut_lineage(back.distinct())
    seen = back.select(
        F.col("_from").alias("source"), F.col("_to").alias("node"), F.lit(1).alias("depth")
    )
    frontier = seen
    for depth in range(2, max_depth + 1):
        # A frontier of few bytes may reach very far, so its rows go to all cores; a large one is
        # in tasks enough, and the join deals it anyway.
        step = (
            spread(frontier)
            .join(back.withColumnRenamed("_from", "node"), "node")
            .where(F.col("source") != F.col("_to"))
            .select("source", F.col("_to").alias("node"))
            .distinct()
            .join(seen.select("source", "node"), ["source", "node"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = cut_lineage(step)
        seen = seen.unionByName(frontier)
    return seen


def blast_radius(
    nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str, max_depth=3, written=False
) -> DataFrame:
    """Direct, transitive and total dependents and depth reached, per node."""
    hits = reach(edges, src, dst, max_depth, written)
    zero = F.lit(0).cast("long")
    stats = hits.groupBy(F.col("source").alias(node)).agg(
        F.sum(F.when(F.col("depth") == 1, 1).otherwise(0)).alias("dependent_count"),
        F.sum(F.when(F.col("depth") > 1, 1).otherwise(0)).alias("transitive_count"),
        F.count(F.lit(1)).alias("total_blast"),
        F.max("depth").alias("max_depth_reached"),
    )
    counts = ["dependent_count", "transitive_count", "total_blast"]
    return (
        nodes.select(node)
        .distinct()
        .join(stats, node, "left")
        .withColumns({c: F.coalesce(c, zero) for c in counts})
        .withColumn("max_depth_reached", F.coalesce("max_depth_reached", F.lit(0)))
    )


def dependency_score(
    nodes: DataFrame,
    edges: DataFrame,
    node: str,
    src: str,
    dst: str,
    max_depth: int = 3,
    quantile: float = 0.90,
    p: float = 0.95,
    written: bool = False,
) -> DataFrame:
    """0.6 blast radius + 0.4 use of shared utilities, each over its p95 and capped at 1.

    A p95 of zero leaves the blast score null rather than infinite.
    """
    if not written:
        edges = cut_lineage(edges.select(src, dst).distinct())
    nodes = cut_lineage(nodes.select(node).distinct())
    flags = cut_lineage(degree_stats(nodes, edges, node, src, dst, quantile, written=True).select(node, "is_shared_util"))
    blast = blast_radius(nodes, edges, node, src, dst, max_depth, written=True)
    # Only the shared ones, which are few, meet the edges.
    targets = flags.where("is_shared_util").select(F.col(node).alias(dst), F.col("is_shared_util").alias("_shared"))
    out = (
        edges.join(targets, dst, "left")
        .groupBy(F.col(src).alias(node))
        .agg(
            F.count(F.lit(1)).alias("outgoing_count"),
            F.sum(F.when(F.col("_shared"), 1).otherwise(0)).alias("outgoing_critical_count"),
        )
    )
    zero = F.lit(0).cast("long")
    stats = (
        blast.join(out, node, "left")
        .join(flags, node)
        .withColumns(
            {
                "outgoing_count": F.coalesce("outgoing_count", zero),
                "outgoing_critical_count": F.coalesce("outgoing_critical_count", zero),
            }
        )
        .withColumn(
            "outgoing_critical_ratio",
            F.coalesce(
                rounded(ratio(F.col("outgoing_critical_count"), F.col("outgoing_count")), 4),
                F.lit(0.0),
            ),
        )
    )
    stats = cut_lineage(stats)
    # Counts have few distinct values, so both percentiles are one small aggregate.
    ends = stats.agg(F.percentile("total_blast", F.lit(p)).alias("b"), F.percentile("outgoing_critical_count", F.lit(p)).alias("o"))
    p95_blast, p95_out = (F.lit(x) if x is not None else F.lit(None).cast("double") for x in ends.first())
    return (
        stats.withColumn(
            "blast_score", rounded(cap_one(ratio(F.col("total_blast"), p95_blast)), 4)
        )
        .withColumn(
            "integration_score",
            rounded(
                cap_one(
                    ratio(F.col("outgoing_critical_count"), F.greatest(p95_out, F.lit(1.0)))
                ),
                4,
            ),
        )
        .withColumn(
            "dependency_score",
            rounded(F.col("blast_score") * 0.60 + F.col("integration_score") * 0.40, 4),
        )
    )


def file_dependencies(files: DataFrame, modules: DataFrame, module: str) -> DataFrame:
    """Module scores on each of its files; several rows of a module collapse to the best."""
    best = modules.where(F.col(module).isNotNull()).groupBy(module).agg(
        F.max("dependency_score").alias("dependency_score"),
        F.max_by("blast_score", F.struct("dependency_score", "blast_score")).alias("blast_score"),
    )
    return files.where(F.col(module).isNotNull()).join(best, module).where(
        F.col("dependency_score").isNotNull()
    )


def resolve_edges(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """Names at both ends of path-based edges; edges with an unknown end drop out."""
    ends = registry.select("module_path", "module_name", "bundle_symbolic_name")
    start = ends.select(
        F.col("module_path").alias("from_path"),
        F.col("module_name").alias("from_module"),
        F.col("bundle_symbolic_name").alias("from_bsn"),
    )
    stop = ends.select(
        F.col("module_path").alias("dependency_path"),
        F.col("module_name").alias("to_module"),
        F.col("bundle_symbolic_name").alias("to_bsn"),
    )
    return (
        raw.join(start, "from_path")
        .join(stop, "dependency_path")
        .select("from_module", "from_bsn", "to_module", "to_bsn", "dependency_path")
        .distinct()
    )


def reach_from(
    seeds: DataFrame, change: str, node: str, edges: DataFrame, src: str, dst: str, max_depth: int = 3
) -> DataFrame:
    """(``change``, ``node``, ``depth``): who depends on the nodes of each change, least depth first.

    Only what the changes touch is walked: rows start at the changed nodes and carry their change
    along, one join with the edges per level. The changed nodes themselves (depth 0) are not
    returned. Each level is written out, so a lost executor restarts one level.
    """
    back = cut_lineage(
        edges.where(~F.col(src).eqNullSafe(F.col(dst))).select(F.col(dst).alias(node), F.col(src).alias("_to")).distinct()
    )
    start = cut_lineage(seeds.select(change, node).dropna().distinct().withColumn("depth", F.lit(0)))
    seen = frontier = start
    for depth in range(1, max_depth + 1):
        step = frontier.join(back, node).select(change, F.col("_to").alias(node)).distinct()
        step = step.join(seen.select(change, node), [change, node], "left_anti")
        frontier = cut_lineage(step.withColumn("depth", F.lit(depth)))
        seen = seen.unionByName(frontier)
    return seen.where(F.col("depth") > 0)
