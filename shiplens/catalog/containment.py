"""Lookups by substring: parts as changed files, brands and part names as modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.operators import bridge, triage

_FILES = """
WITH f AS (SELECT p_partkey, 'src/modules/apps/' || lower(replace(p_brand, '#', '')) || '/' || replace(p_name, ' ', '-') || '/' ||
    CASE WHEN p_size % 2 = 0 THEN 'Test_' ELSE '' END || replace(p_name, ' ', '_') || '-' || p_type || CASE WHEN p_size % 3 = 0 THEN '.java' ELSE '.tsx' END AS path
  FROM part)
"""


def _files(t: Tables) -> DataFrame:
    path = F.concat(
        F.lit("src/modules/apps/"), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit("/"),
        F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/"),
        F.when(F.col("p_size") % 2 == 0, "Test_").otherwise(""), F.replace("p_name", F.lit(" "), F.lit("_")),
        F.lit("-"), "p_type", F.when(F.col("p_size") % 3 == 0, ".java").otherwise(".tsx"),
    )
    return t.part.select("p_partkey", path.alias("path"))


@query(
    _FILES
    + """, mp AS (SELECT DISTINCT 'modules/apps/' || lower(replace(p_brand, '#', '')) AS module_path, p_brand AS component_name FROM part WHERE p_size < 40
      UNION SELECT DISTINCT lower(replace(p_brand, '#', '')) || '/' || split_part(p_name, ' ', 1), split_part(p_name, ' ', 2) FROM part WHERE p_size < 10
      UNION SELECT '-', 'dash' FROM region)
    SELECT p_partkey, path, module_path, component_name FROM f LEFT JOIN mp ON contains(path, module_path)
    QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(module_path) DESC NULLS LAST, module_path, component_name) = 1"""
)
def contained_modules(t):
    """The longest module path that occurs anywhere in a file's path; a brand may begin another's name."""
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("")))
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    whole = t.part.where("p_size < 40").select(F.concat(F.lit("modules/apps/"), brand).alias("module_path"), F.col("p_brand").alias("component_name"))
    deep = t.part.where("p_size < 10").select(F.concat(brand, F.lit("/"), word(1)), word(2))
    short = t.region.select(F.lit("-"), F.lit("dash"))
    mapping = whole.union(deep).union(short).distinct()
    return bridge.longest_contained_match(_files(t), "path", mapping, "module_path", ["component_name"])


@query(
    _FILES
    + """, m AS (SELECT DISTINCT 'The ' || p_name || 's' AS component_name, 'ext/' || lower(p_type) || '-web' AS module_path FROM part WHERE p_size < 25),
    w AS (SELECT DISTINCT path, unnest(regexp_split_to_array(lower(regexp_extract(path, '[^/]*$')), '[.\\-_]')) AS w FROM f),
    tk AS (SELECT * FROM w WHERE length(w) > 4 AND w NOT IN ('java', 'tsx', 'ts', 'js', 'jsx', 'jsp', 'test', 'impl', 'local', 'service', 'util', 'helper', 'base', 'abstract')),
    s AS (SELECT path, component_name, module_path, count(*) AS score FROM tk JOIN m
          ON contains(lower(component_name), w) OR contains(split_part(module_path, '/', 2), w) GROUP BY ALL),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, component_name, module_path) = 1)
    SELECT DISTINCT f.path, component_name, coalesce('token_match(score=' || score || ')', 'no_match') AS match_strategy FROM f LEFT JOIN b USING (path)"""
)
def match_modules_by_words(t):
    """No module path begins a file's path, so the words of its name decide."""
    mapping = t.part.where("p_size < 25").select(
        F.concat(F.lit("The "), "p_name", F.lit("s")).alias("component_name"),
        F.concat(F.lit("ext/"), F.lower("p_type"), F.lit("-web")).alias("module_path"),
    ).distinct()
    return bridge.match_modules(_files(t), "path", mapping)


@query(
    _FILES
    + """, g AS (SELECT p_partkey AS case_id, unnest([lower(split_part(p_name, ' ', 2)) || '-' || lower(p_type) || '.java', 'x/' || lower(replace(p_name, ' ', '_')) || '-promo.tsx', ' ']) AS n FROM part WHERE p_size = 7),
    h AS (SELECT DISTINCT case_id, trim(n) AS n FROM g WHERE trim(n) <> '')
    SELECT DISTINCT case_id, path FROM h JOIN f ON ends_with(lower(path), n) OR regexp_extract(lower(path), '[^/]*$') = regexp_extract(n, '[^/]*$')"""
)
def named_blocks(t):
    """Changed files that a failure names by the end of their path or by their file name."""
    kind = F.lower("p_type")
    matched = F.concat_ws(
        "|", F.concat(F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))), F.lit("-"), kind, F.lit(".java")),
        F.concat(F.lit("x/"), F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit("-promo.tsx")), F.lit(" "),
    )
    fails = t.part.where("p_size = 7").select(F.col("p_partkey").alias("case_id"), matched.alias("matched"))
    return triage.named_blocks(fails, "case_id", "matched", _files(t), "path")
