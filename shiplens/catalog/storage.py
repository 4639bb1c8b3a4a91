"""Keyed merges, append-and-newest, and the data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.functions.stats import rounded
from shiplens.lineage import run_folder
from shiplens.operators import merge, quality, scoring

_HALVES = """
WITH old AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 6000),
new AS (SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment, CASE WHEN c_nationkey < 12 THEN c_acctbal + 1 END AS c_acctbal
        FROM customer WHERE c_acctbal > 3000)
"""


def _old(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_acctbal") < 6000).select("c_custkey", "c_mktsegment", "c_acctbal")


def _new(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_acctbal") > 3000).select(
        "c_custkey",
        F.lower("c_mktsegment").alias("c_mktsegment"),
        F.when(F.col("c_nationkey") < 12, F.col("c_acctbal") + 1).alias("c_acctbal"),
    )


@query(
    _HALVES
    + """SELECT * FROM new UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)"""
)
def upsert_merge(t):
    """A table on disk, partitioned by a key range; new rows merged onto it, then again."""
    by_range = lambda df: df.withColumn("part", F.floor(F.col("c_custkey") / 10000))
    schema = "c_custkey long, c_mktsegment string, c_acctbal double, part long"
    table = merge.PartitionedTable(t.spark, run_folder(t.spark, "customers"), schema, ["part"])
    for rows in (_old(t), _new(t), _new(t)):
        table.merge(by_range(rows), ["part", "c_custkey"])
    return table.read().drop("part")


_YEARS = """
WITH o AS (SELECT o_orderkey, year(o_orderdate)::BIGINT AS y, o_orderstatus, o_totalprice FROM orders),
i AS (SELECT o_orderkey, y, CASE WHEN o_orderkey % 3 > 0 THEN lower(o_orderstatus) END AS o_orderstatus,
        CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 END AS o_totalprice FROM o WHERE y IN (1997, 1999) AND o_orderkey % 5 < 2),
k AS (SELECT * FROM o WHERE o_orderkey % 5 > 0)
"""


def _years(t: Tables):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"), "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    incoming = rows.where(F.col("y").isin(1997, 1999) & (key % 5 < 2)).select(
        "o_orderkey", "y", F.when(key % 3 > 0, F.lower("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 2 == 0, F.col("o_totalprice") + 1).alias("o_totalprice"),
    )
    table = merge.PartitionedTable(
        t.spark, run_folder(t.spark, "years"), "o_orderkey long, o_orderstatus string, o_totalprice double, y long", ["y"]
    )
    table.replace(rows.where(key % 5 > 0))
    return table, incoming


@query(_YEARS + "SELECT * FROM i UNION ALL SELECT * FROM k WHERE o_orderkey NOT IN (SELECT o_orderkey FROM i)")
def partition_upsert(t):
    """Two of the years are merged into a table by year; the files of the others stay."""
    table, incoming = _years(t)
    table.merge(incoming, ["y", "o_orderkey"])
    return table.read()


@query(
    _YEARS
    + """SELECT coalesce(k.o_orderkey, i.o_orderkey) AS o_orderkey, coalesce(k.y, i.y) AS y, coalesce(i.o_orderstatus, k.o_orderstatus) AS o_orderstatus,
      coalesce(i.o_totalprice, k.o_totalprice) AS o_totalprice FROM k FULL JOIN i ON k.o_orderkey = i.o_orderkey"""
)
def partition_upsert_keep_old(t):
    table, incoming = _years(t)
    table.merge(incoming, ["y", "o_orderkey"], merge.upsert_keep_old)
    return table.read()


@query(
    """
WITH a AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS s, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS p FROM orders),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 > 0 THEN o_orderstatus END AS s2, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS p2
  FROM orders WHERE o_orderkey % 11 > 0)
SELECT o_orderkey, o_custkey, s2 AS s, p2 AS p, array_to_string(list_filter([CASE WHEN s IS DISTINCT FROM s2 THEN 's' END, CASE WHEN p IS DISTINCT FROM p2 THEN 'p' END], lambda x: x IS NOT NULL), ',') AS changed
FROM a JOIN b USING (o_orderkey) WHERE s IS DISTINCT FROM s2 OR p IS DISTINCT FROM p2"""
)
def update_distinct(t):
    """Equal, null and changed values meet: only the rows that change come out."""
    key = F.col("o_orderkey")
    target = t.orders.select(
        "o_orderkey", "o_custkey", F.when(key % 4 > 0, F.col("o_orderstatus")).alias("s"), F.when(key % 5 > 0, F.col("o_totalprice")).alias("p")
    )
    source = t.orders.where(key % 11 > 0).select(
        "o_orderkey", F.when(key % 6 > 0, F.col("o_orderstatus")).alias("s2"),
        F.when(key % 7 == 0, F.col("o_totalprice") + 1).when(key % 5 > 0, F.col("o_totalprice")).alias("p2"),
    )
    out = merge.update_distinct(target, source, ["o_orderkey"], {"s": "s2", "p": "p2"})
    return out.withColumn("changed", F.array_join("changed", ","))


@query(
    _HALVES
    + """SELECT coalesce(old.c_custkey, new.c_custkey) AS c_custkey, old.c_mktsegment,
      CASE WHEN new.c_custkey IS NOT NULL THEN new.c_acctbal ELSE old.c_acctbal END AS c_acctbal
    FROM old FULL JOIN new ON old.c_custkey = new.c_custkey"""
)
def partial_upsert(t):
    return merge.upsert_columns(_old(t), _new(t), ["c_custkey"], ["c_acctbal"])


@query(
    _HALVES
    + """SELECT coalesce(old.c_custkey, new.c_custkey) AS c_custkey, coalesce(new.c_mktsegment, old.c_mktsegment) AS c_mktsegment,
      coalesce(new.c_acctbal, old.c_acctbal) AS c_acctbal FROM old FULL JOIN new ON old.c_custkey = new.c_custkey"""
)
def upsert_keep_old(t):
    return merge.upsert_keep_old(_old(t), _new(t), ["c_custkey"])


@query(
    _HALVES
    + """SELECT * FROM old UNION ALL SELECT * FROM new WHERE c_custkey NOT IN (SELECT c_custkey FROM old)"""
)
def insert_if_absent(t):
    return merge.insert_if_absent(_old(t), _new(t), ["c_custkey"])


@query(
    _HALVES
    + """SELECT old.c_custkey, CASE WHEN new.c_custkey IS NOT NULL THEN new.c_mktsegment ELSE old.c_mktsegment END AS c_mktsegment,
      old.c_acctbal FROM old LEFT JOIN new USING (c_custkey)"""
)
def update_from_join(t):
    return merge.update_from(_old(t), _new(t), ["c_custkey"], {"c_mktsegment": "c_mktsegment"})


@query(
    """SELECT o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS at FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus DESC, o_totalprice DESC) = 1"""
)
def newest_row(t):
    rows = t.orders.select(
        "o_custkey", "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").cast("string").alias("at"),
    )
    return merge.newest_row(rows, ["o_custkey"], "at")


_PARAMS = """
WITH p AS (SELECT o_orderpriority AS scoring_version, round((avg(o_totalprice) / 1000)::DECIMAL(28,10), 2)::DOUBLE AS complexity_p95,
   round((max(o_totalprice) / 1000)::DECIMAL(28,10), 2)::DOUBLE AS cognitive_p95, year(o_orderdate)::BIGINT AS calculated_at FROM orders GROUP BY 1, 4)
"""


def _params(t: Tables) -> DataFrame:
    return t.orders.groupBy(
        F.col("o_orderpriority").alias("scoring_version"),
        F.year("o_orderdate").cast("bigint").alias("calculated_at"),
    ).agg(
        rounded(F.avg("o_totalprice") / 1000, 2).alias("complexity_p95"),
        rounded(F.max("o_totalprice") / 1000, 2).alias("cognitive_p95"),
    )


@query(
    _PARAMS
    + "SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY scoring_version ORDER BY calculated_at DESC) = 1"
)
def latest_params(t):
    return scoring.latest_params(
        _params(t), "scoring_version", "calculated_at", ["complexity_p95", "cognitive_p95", "calculated_at"]
    )


@query(
    _PARAMS
    + """, q AS (SELECT round((quantile_cont(a, 0.95))::DECIMAL(28,10), 6)::DOUBLE AS v FROM (SELECT avg(l_quantity) AS a FROM lineitem GROUP BY l_partkey))
    SELECT scoring_version, calculated_at, CASE WHEN scoring_version = '1-URGENT' THEN 16.0::DOUBLE ELSE complexity_p95 END AS complexity_p95,
      CASE WHEN scoring_version = '1-URGENT' THEN v ELSE cognitive_p95 END AS cognitive_p95 FROM p, q"""
)
def normalisation_update(t):
    files = t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("avg_nloc"))
    out = scoring.normalisation_update(_params(t), "1-URGENT", files)
    return out.withColumn("cognitive_p95", rounded("cognitive_p95", 6))


@query(
    """SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice > 450000 THEN 'price is high' END,
      CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status is unknown' END,
      CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 'customer is unknown' END], lambda x: x IS NOT NULL)) AS rule FROM orders
    UNION ALL SELECT * FROM (SELECT o_orderkey, 'key is duplicated' FROM orders GROUP BY 1 HAVING count(*) > 1)"""
)
def quality_checks(t):
    """Rules on each order plus duplicate keys."""
    known = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("_known"))
    rows = t.orders.join(known, "o_custkey", "left")
    rules = {
        "price is high": F.col("o_totalprice") > 450000,
        "status is unknown": ~F.col("o_orderstatus").isin("F", "O"),
        "customer is unknown": F.col("_known").isNull(),
    }
    twice = quality.duplicate_keys(t.orders, ["o_orderkey"]).select(
        "o_orderkey", F.lit("key is duplicated").alias("rule")
    )
    return quality.rule_violations(rows, "o_orderkey", rules).unionByName(twice)


_REL = """
WITH r AS (SELECT year(o_orderdate)::VARCHAR || '.' || o_orderstatus AS release_label,
    CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE year(o_orderdate)::VARCHAR END AS quarter_label,
    CASE o_orderstatus WHEN 'F' THEN 'tag' WHEN 'O' THEN '' END AS git_tag,
    CASE WHEN year(o_orderdate) < 2000 THEN min(o_orderdate)::DATE END AS release_date,
    CASE WHEN o_orderstatus <> 'O' THEN true END AS is_major_release,
    CASE o_orderstatus WHEN 'F' THEN 'RELEASED' WHEN 'O' THEN 'BRANCH_CUT' ELSE 'GONE' END AS release_status
  FROM orders GROUP BY o_orderstatus, year(o_orderdate))
"""


def _releases(t: Tables) -> DataFrame:
    s, y = F.col("o_orderstatus"), F.year("o_orderdate")
    return (
        t.orders.groupBy(s, y.alias("y"))
        .agg(F.min(F.to_date("o_orderdate")).alias("first"))
        .select(
            F.concat(F.col("y").cast("string"), F.lit("."), s).alias("release_label"),
            F.when(s == "P", " ").otherwise(F.col("y").cast("string")).alias("quarter_label"),
            F.when(s == "F", "tag").when(s == "O", "").alias("git_tag"),
            F.when(F.col("y") < 2000, F.col("first")).alias("release_date"),
            F.when(s != "O", True).alias("is_major_release"),
            F.when(s == "F", "RELEASED").when(s == "O", "BRANCH_CUT").otherwise("GONE").alias("release_status"),
        )
    )


@query(
    _REL
    + """SELECT release_label, 'quarter_label is required' AS rule FROM r WHERE trim(quarter_label) = ''
    UNION ALL SELECT release_label, 'git_tag is required' FROM r WHERE git_tag IS NULL
    UNION ALL SELECT release_label, 'is_major_release is required' FROM r WHERE is_major_release IS NULL
    UNION ALL SELECT release_label, 'status is unknown' FROM r WHERE release_status = 'GONE'"""
)
def release_violations(t):
    return quality.release_violations(_releases(t))


@query(
    _REL
    + """SELECT release_label FROM r WHERE (release_status = 'RELEASED' AND release_date IS NULL)
      OR (release_status IN ('RELEASED', 'BRANCH_CUT') AND coalesce(git_tag, '') = '')"""
)
def releases_needing_attention(t):
    return quality.releases_needing_attention(_releases(t)).select("release_label")


@query(
    """SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN
      (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1"""
)
def unmatched_keys(t):
    known = t.supplier.where(F.col("s_acctbal") > 0)
    return quality.unmatched_keys(t.lineitem, "l_suppkey", known, "s_suppkey")


@query(
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_returnflag <> 'N') AS n_covered,
      round((count(*) FILTER (WHERE l_returnflag <> 'N') / count(*) * 100)::DECIMAL(28,10), 2)::DOUBLE AS coverage_pct FROM lineitem"""
)
def coverage(t):
    return quality.coverage(t.lineitem, F.col("l_returnflag") != "N")


@query(
    """SELECT l_partkey, sum((l_returnflag = 'R' AND l_discount > 0.08)::INT)::BIGINT AS hot FROM lineitem GROUP BY 1
    HAVING sum((l_returnflag = 'R' AND l_discount > 0.08)::INT) = 0"""
)
def periods_without_counts(t):
    rows = t.lineitem.select(
        "l_partkey", F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08), 1).otherwise(0).alias("hot")
    )
    return quality.periods_without_counts(rows, "l_partkey", ["hot"])


@query(
    """SELECT s_suppkey AS l_suppkey, count(*) AS file_count FROM supplier JOIN lineitem ON l_suppkey = s_suppkey
    WHERE s_acctbal < 3000 GROUP BY 1"""
)
def unresolved_with_files(t):
    modules = t.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_acctbal") >= 3000, F.col("s_name")).alias("module_path"),
    )
    return quality.unresolved_with_files(modules, t.lineitem, "l_suppkey", "module_path")


@query(
    """SELECT o_orderkey, 'h' || o_custkey AS given, 'h' || l_suppkey AS stored FROM orders JOIN
      (SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    WHERE o_custkey <> l_suppkey"""
)
def hash_mismatches(t):
    given = t.orders.select("o_orderkey", F.concat(F.lit("h"), F.col("o_custkey").cast("string")).alias("h"))
    stored = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.concat(F.lit("h"), F.min("l_suppkey").cast("string")).alias("h")
    )
    return quality.hash_mismatches(given, stored, "o_orderkey", "h")


@query(
    """WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) = 1998)
    SELECT DISTINCT l_partkey, l_suppkey FROM lineitem b WHERE year(l_shipdate) = 1999
      AND NOT EXISTS (SELECT 1 FROM a WHERE a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey)"""
)
def rows_without_match(t):
    rows = t.lineitem.select("l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("d"))
    target = rows.where(F.col("d").between("1999-01-01", "1999-12-31")).select("l_partkey", "l_suppkey").distinct()
    source = rows.where(F.col("d").between("1998-01-01", "1998-12-31"))
    return quality.rows_without_match(target, source, ["l_partkey", "l_suppkey"])
