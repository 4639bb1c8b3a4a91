"""Dependency graph: brands use parts, parts suppliers, suppliers nations, nations regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.lineage import cut_lineage
from shiplens.operators import graph, scoring

_EDGES = """
WITH e AS (
  SELECT DISTINCT p_brand AS src, 'p' || p_partkey AS dst FROM part
  UNION SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
  UNION SELECT DISTINCT 's' || s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
  UNION SELECT DISTINCT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey),
v AS (SELECT src AS node FROM e UNION SELECT dst FROM e),
deg AS (SELECT node, (SELECT count(*) FROM e WHERE dst = node) AS dependent_count,
          (SELECT count(*) FROM e WHERE src = node) AS dependency_count FROM v),
flag AS (SELECT *, dependent_count >= (SELECT quantile_cont(dependent_count::DOUBLE, 0.96) FROM deg) AS is_shared_util FROM deg),
r1 AS (SELECT dst AS source, src AS node, 1 AS depth FROM e WHERE src <> dst),
r2 AS (SELECT DISTINCT source, e.src AS node, 2 AS depth FROM r1 JOIN e ON e.dst = r1.node
       WHERE source <> e.src AND NOT EXISTS (SELECT 1 FROM r1 x WHERE x.source = r1.source AND x.node = e.src)),
r3 AS (SELECT DISTINCT source, e.src AS node, 3 AS depth FROM r2 JOIN e ON e.dst = r2.node
       WHERE source <> e.src AND NOT EXISTS (SELECT 1 FROM r1 x WHERE x.source = r2.source AND x.node = e.src)
         AND NOT EXISTS (SELECT 1 FROM r2 x WHERE x.source = r2.source AND x.node = e.src)),
r AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3),
bl AS (SELECT source AS node, count(*) FILTER (WHERE depth = 1) AS d1, count(*) FILTER (WHERE depth > 1) AS d2,
         count(*) AS total, max(depth) AS md FROM r GROUP BY 1),
o AS (SELECT src AS node, count(*) AS oc, count(*) FILTER (WHERE is_shared_util) AS cc
      FROM e JOIN flag ON flag.node = dst GROUP BY 1),
st AS (SELECT v.node, coalesce(d1, 0) AS dependent_count, coalesce(d2, 0) AS transitive_count,
         coalesce(total, 0) AS total_blast, coalesce(md, 0) AS max_depth_reached, is_shared_util,
         coalesce(oc, 0) AS outgoing_count, coalesce(cc, 0) AS outgoing_critical_count
       FROM v LEFT JOIN bl USING (node) LEFT JOIN o USING (node) JOIN flag USING (node)),
pp AS (SELECT quantile_cont(total_blast::DOUBLE, 0.95) AS pb, quantile_cont(outgoing_critical_count::DOUBLE, 0.95) AS pi FROM st),
sc AS (SELECT st.*, coalesce(round((outgoing_critical_count / nullif(outgoing_count, 0))::DECIMAL(28,10), 4)::DOUBLE, 0) AS outgoing_critical_ratio,
         round((least(total_blast / nullif(pb, 0), 1))::DECIMAL(28,10), 4)::DOUBLE AS blast_score,
         round((least(outgoing_critical_count / greatest(pi, 1), 1))::DECIMAL(28,10), 4)::DOUBLE AS integration_score FROM st, pp)
"""


def _edges(t: Tables) -> DataFrame:
    def tag(letter, c):
        return F.concat(F.lit(letter), F.col(c).cast("string"))

    parts = t.part.select(F.col("p_brand").alias("src"), tag("p", "p_partkey").alias("dst"))
    used = t.lineitem.select(tag("p", "l_partkey").alias("src"), tag("s", "l_suppkey").alias("dst"))
    home = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        tag("s", "s_suppkey").alias("src"), F.col("n_name").alias("dst")
    )
    top = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("src"), F.col("r_name").alias("dst")
    )
    return cut_lineage(parts.union(used).union(home).union(top).distinct())


def _nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


@query(_EDGES + "SELECT node, dependent_count, dependency_count, is_shared_util FROM flag")
def degree_stats(t):
    e = _edges(t)
    return graph.degree_stats(_nodes(e), e, "node", "src", "dst", quantile=0.96, written=True)


@query(
    _EDGES
    + """SELECT *, round((blast_score * 0.6::DOUBLE + integration_score * 0.4::DOUBLE)::DECIMAL(28,10), 4)::DOUBLE AS dependency_score FROM sc"""
)
def dependency_score(t):
    e = _edges(t)
    return graph.dependency_score(_nodes(e), e, "node", "src", "dst", quantile=0.96, written=True)


_CHANGES = _EDGES + """, ch AS (SELECT DISTINCT 'n' || s_nationkey AS change, 's' || s_suppkey AS node FROM supplier WHERE s_suppkey % 7 = 0
    UNION SELECT 'n' || p_size % 5, 'p' || p_partkey FROM part WHERE p_partkey % 50 = 0),
  c1 AS (SELECT DISTINCT change, src AS node FROM ch JOIN e ON dst = node WHERE src <> dst AND (change, src) NOT IN (SELECT (change, node) FROM ch)),
  c2 AS (SELECT DISTINCT change, src AS node FROM c1 JOIN e ON dst = node WHERE (change, src) NOT IN (SELECT (change, node) FROM ch UNION ALL SELECT (change, node) FROM c1)),
  c3 AS (SELECT DISTINCT change, src AS node FROM c2 JOIN e ON dst = node WHERE (change, src) NOT IN (SELECT (change, node) FROM ch UNION ALL SELECT (change, node) FROM c1 UNION ALL SELECT (change, node) FROM c2)),
  ca AS (SELECT *, 1 AS depth FROM c1 UNION ALL SELECT *, 2 FROM c2 UNION ALL SELECT *, 3 FROM c3),
  cb AS (SELECT change, count(*) FILTER (WHERE depth = 1) AS direct_dependents, count(*) FILTER (WHERE depth > 1) AS transitive_dependents,
         count(*) AS total_blast, max(depth) AS depth_reached FROM ca GROUP BY 1)
"""


def _changes(t: Tables) -> DataFrame:
    name = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    homes = t.supplier.where("s_suppkey % 7 = 0").select(
        name("n", F.col("s_nationkey")).alias("change"), name("s", F.col("s_suppkey")).alias("node")
    )
    return homes.union(t.part.where("p_partkey % 50 = 0").select(name("n", F.col("p_size") % 5), name("p", F.col("p_partkey"))))


@query(_CHANGES + "SELECT change, node, depth FROM ca")
def reach_from_changes(t):
    """Who depends on the nodes of each change, within three steps of them."""
    return graph.reach_from(_changes(t), "change", "node", _edges(t), "src", "dst")


@query(
    _CHANGES
    + """SELECT change, n_nodes, coalesce(direct_dependents, 0) AS direct_dependents, coalesce(transitive_dependents, 0) AS transitive_dependents,
      coalesce(total_blast, 0) AS total_blast, coalesce(depth_reached, 0) AS depth_reached
    FROM (SELECT change, count(*) AS n_nodes FROM ch GROUP BY 1) LEFT JOIN cb USING (change)"""
)
def change_blast(t):
    return scoring.change_blast(_changes(t), "change", "node", _edges(t), "src", "dst")


@query(
    """
WITH f AS (SELECT p_partkey, p_brand AS module_name FROM part),
m AS (SELECT p_brand AS module_name, CASE WHEN p_size > 3 THEN round((p_size / 50)::DECIMAL(28,10), 4)::DOUBLE END AS dependency_score,
        round((p_retailprice / 2000)::DECIMAL(28,10), 4)::DOUBLE AS blast_score FROM part WHERE p_brand <> 'Brand#3'),
b AS (SELECT module_name, max(dependency_score) AS dependency_score,
        max({'a': dependency_score, 'b': blast_score}) FILTER (WHERE dependency_score IS NOT NULL) AS top FROM m GROUP BY 1)
SELECT p_partkey, module_name, dependency_score, top.b AS blast_score FROM f JOIN b USING (module_name) WHERE dependency_score IS NOT NULL"""
)
def file_dependencies(t):
    """Many rows of a module collapse to its best before the files take its score."""
    from shiplens.functions.stats import rounded

    modules = t.part.where("p_brand <> 'Brand#3'").select(
        F.col("p_brand").alias("module_name"),
        F.when(F.col("p_size") > 3, rounded(F.col("p_size") / 50, 4)).alias("dependency_score"),
        rounded(F.col("p_retailprice") / 2000, 4).alias("blast_score"),
    )
    files = t.part.select("p_partkey", F.col("p_brand").alias("module_name"))
    return graph.file_dependencies(files, modules, "module_name")
