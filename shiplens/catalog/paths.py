"""Module paths, registries and name matching on page addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.functions import paths as P
from shiplens.functions.similarity import fuzzy_candidates as best_names
from shiplens.operators import bridge
from shiplens.plans import reports

_PAGES = """
WITH pg AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
              regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS lang,
              regexp_extract(url, '/(\\d+)[^/]*/?$', 1) AS num FROM pages),
f AS (SELECT page_id, host, CASE WHEN host LIKE 'm.%' THEN 'portal-' || lang || '/src/' || num || '.ts'
        WHEN host LIKE 'blog.%' THEN 'modules/dxp/apps/' || lang || '/' || host || '/src/' || num || '.java'
        ELSE 'modules/apps/' || lang || '/' || host || '/src/' || num || '.js' END AS path FROM pg),
g AS (SELECT *, CASE WHEN host LIKE 'm.%' THEN split_part(path, '/', 1) ELSE host END AS module_name FROM f)
"""


def files(t: Tables) -> DataFrame:
    """A source-file path per page, built from its address."""
    url = F.col("url")
    host = F.regexp_extract(url, r"^https?://([^/]+)", 1)
    lang = F.regexp_extract(url, r"^https?://[^/]+/([a-z]+)/", 1)
    num = F.regexp_extract(url, r"/(\d+)[^/]*/?$", 1)

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    return t.pages.select("page_id", host.alias("host"), lang.alias("lang"), num.alias("num")).select(
        "page_id",
        "host",
        F.when(F.col("host").startswith("m."), text("portal-", F.col("lang"), "/src/", F.col("num"), ".ts"))
        .when(
            F.col("host").startswith("blog."),
            text("modules/dxp/apps/", F.col("lang"), "/", F.col("host"), "/src/", F.col("num"), ".java"),
        )
        .otherwise(text("modules/apps/", F.col("lang"), "/", F.col("host"), "/src/", F.col("num"), ".js"))
        .alias("path"),
    )


@query(
    _PAGES
    + """SELECT page_id, path, module_name,
      CASE WHEN path LIKE 'modules/dxp/%' THEN regexp_extract(path, '^(modules/[^/]+/[^/]+/[^/]+/[^/]+)', 1)
           WHEN path LIKE 'modules/%' THEN regexp_extract(path, '^(modules/[^/]+/[^/]+)', 1) END AS module_path,
      regexp_replace(path, '^(modules/(?:apps|dxp/apps|core|util)/[^/]+|portal-impl|portal-kernel|util-taglib).*$', '\\1') AS category,
      CASE WHEN path LIKE '%.java' THEN 'java' WHEN path LIKE '%.ts' THEN 'typescript' ELSE 'javascript' END AS language
    FROM g"""
)
def path_module(t):
    path = F.col("path")
    return files(t).select(
        "page_id", "path",
        P.module_of_path(path).alias("module_name"),
        P.module_path(path).alias("module_path"),
        P.category_path(path).alias("category"),
        P.language(path).alias("language"),
    )


@query(
    _PAGES
    + """SELECT module_name, count(DISTINCT path) AS file_count, count(*) AS commit_count FROM g GROUP BY 1"""
)
def module_index(t):
    return reports.module_index(files(t), "path", P.module_of_path(F.col("path")))


_MAP = _PAGES + """, mp AS (SELECT DISTINCT regexp_extract(path, '^(modules/(?:dxp/)?apps/[a-z]+)/', 1) AS prefix FROM f WHERE path LIKE 'modules/%'
      UNION SELECT DISTINCT regexp_extract(path, '^(modules/(?:dxp/)?apps/[a-z]+/[^/]+)/', 1) FROM f WHERE path LIKE 'modules/dxp/%')
"""


def _mapping(t: Tables) -> DataFrame:
    path = F.col("path")
    short = files(t).select(F.regexp_extract(path, r"^(modules/(?:dxp/)?apps/[a-z]+)/", 1).alias("prefix"))
    deep = files(t).where(path.startswith("modules/dxp/")).select(
        F.regexp_extract(path, r"^(modules/(?:dxp/)?apps/[a-z]+/[^/]+)/", 1).alias("prefix")
    )
    return short.union(deep).where("prefix <> ''").distinct().withColumn(
        "component_name", F.upper("prefix")
    )


@query(
    _MAP
    + """SELECT page_id, path, arg_max(prefix, length(prefix)) AS prefix, upper(arg_max(prefix, length(prefix))) AS component_name
    FROM f LEFT JOIN mp ON starts_with(path, prefix || '/') GROUP BY 1, 2"""
)
def longest_prefix_match(t):
    out = bridge.longest_prefix_match(files(t), "path", _mapping(t), "prefix", ["component_name"])
    return out.select("page_id", "path", "prefix", "component_name")


@query(
    _MAP
    + """, x AS (SELECT path, arg_max(prefix, length(prefix)) AS prefix FROM (SELECT DISTINCT path FROM f)
            LEFT JOIN mp ON starts_with(path, prefix || '/') GROUP BY 1)
    SELECT path, CASE WHEN prefix IS NOT NULL THEN upper(prefix) END AS component_name,
      CASE WHEN prefix IS NOT NULL THEN 'exact_module_path' ELSE 'no_match' END AS match_strategy FROM x"""
)
def match_modules(t):
    mapping = _mapping(t).withColumnRenamed("prefix", "module_path")
    return bridge.match_modules(files(t), "path", mapping)


@query(
    _PAGES
    + """, n AS (SELECT DISTINCT host FROM f WHERE host NOT LIKE 'm.%')
    SELECT DISTINCT path, g.module_name, n.host IS NOT NULL AS known,
      CASE WHEN path LIKE '%.java' THEN 'java' WHEN path LIKE '%.ts' THEN 'typescript' ELSE 'javascript' END AS language
    FROM g LEFT JOIN n ON n.host = g.module_name"""
)
def file_registry(t):
    known = (
        files(t).where(~F.col("host").startswith("m.")).select(F.col("host").alias("module_name"))
        .distinct().withColumn("module_id", F.xxhash64("module_name"))
    )
    out = reports.file_registry(files(t), "path", known, P.module_of_path(F.col("path")))
    return out.select("path", "module_name", F.col("module_id").isNotNull().alias("known"), "language")


@query(
    _PAGES
    + """, s AS (SELECT host, min(path) FILTER (WHERE path LIKE 'modules/%') AS i, min(path) FILTER (WHERE path NOT LIKE 'modules/%') AS o FROM f GROUP BY 1),
    fp AS (SELECT host, CASE WHEN host LIKE '%spam%' THEN 'modules/apps/given/x'
        WHEN i LIKE 'modules/dxp/%' THEN regexp_extract(i, '^(modules/[^/]+/[^/]+/[^/]+/[^/]+)', 1)
        WHEN i IS NOT NULL THEN regexp_extract(i, '^(modules/[^/]+/[^/]+)', 1) ELSE split_part(o, '/', 1) END AS module_path_full FROM s)
    SELECT host, module_path_full, regexp_replace(module_path_full,
      '^(modules/(?:apps|dxp/apps|core|util)/[^/]+|portal-impl|portal-kernel|util-taglib).*$', '\\1') AS module_path_category FROM fp"""
)
def module_paths(t):
    modules = files(t).select("host").distinct().select(
        "host",
        F.when(F.col("host").contains("spam"), "modules/apps/given/x").alias("module_path_full"),
        F.lit(None).cast("string").alias("module_path_category"),
    )
    return reports.module_paths(files(t), modules, "host", "path", "modules/dxp/apps/osb/")


@query(
    _PAGES
    + """, n AS (SELECT DISTINCT replace(host, '.', '-') AS name FROM f),
    c AS (SELECT DISTINCT replace(host, '.', '-') AS name FROM f WHERE path LIKE '%.java')
    SELECT name, 'exact' AS how FROM n WHERE name IN (SELECT name FROM c)
    UNION ALL SELECT name, 'prefix' FROM n WHERE starts_with(name, 'm-') OR starts_with(name, 'blog-')"""
)
def coverage_matches(t):
    names = files(t).select(F.regexp_replace("host", r"\.", "-").alias("name"), "path")
    covered = names.where(F.col("path").endswith(".java"))
    rules = names.select(F.explode(F.array(F.lit("m-"), F.lit("blog-"))).alias("prefix")).distinct()
    return reports.coverage_matches(names, covered, rules, "name")


@query(
    """
WITH l AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages),
ln AS (SELECT host, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(replace(host, '.', '-')),
        '-impl$|-api$|-service$|-web$|-test$|-client$|-spi$|-core$|-util$', '', 'g'), '[-_>]', ' ', 'g'), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g')) AS a FROM l),
r AS (SELECT DISTINCT p_name AS name, p_name AS b FROM part),
x AS (SELECT host, name, a, b, jaro_similarity(a, b) AS j,
        CASE WHEN a[1:1] <> b[1:1] THEN 0 WHEN a[1:2] <> b[1:2] THEN 1 WHEN a[1:3] <> b[1:3] THEN 2
             WHEN a[1:4] <> b[1:4] THEN 3 ELSE 4 END AS l,
        len(list_filter(string_split(a, ' '), lambda w: list_contains(string_split(b, ' '), w))) / len(string_split(a, ' ')) AS tok FROM ln, r),
y AS (SELECT *, j + l * 0.1::DOUBLE * (1 - j) AS jw FROM x),
z AS (SELECT *, 0.5::DOUBLE * jw + 0.5::DOUBLE * tok AS s FROM y),
k AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY s DESC, name) AS rn, lead(s) OVER (PARTITION BY host ORDER BY s DESC, name) AS s2 FROM z)
SELECT host, name AS component_name, CASE WHEN s >= 0.7 THEN 'HIGH' WHEN s >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
  round((s)::DECIMAL(28,10), 3)::DOUBLE AS combined_score, round((coalesce(s - s2, 1.0))::DECIMAL(28,10), 3)::DOUBLE AS confidence_gap, round((jw)::DECIMAL(28,10), 3)::DOUBLE AS jw_sim, round((tok)::DECIMAL(28,10), 3)::DOUBLE AS token_sim
FROM k WHERE rn = 1"""
)
def fuzzy_candidates(t):
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    left = t.pages.select(host.alias("host")).distinct().withColumn(
        "clean", P.short_name_key(F.regexp_replace("host", r"\.", "-"))
    )
    right = t.part.select("p_name", F.col("p_name").alias("p_clean")).distinct()
    return best_names(left, "host", "clean", right, "p_name", "p_clean")


@query(
    """
WITH k AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark),
l AS (SELECT DISTINCT trim(unnest(string_split(text, ','))) AS word FROM conversations)
SELECT word FROM k WHERE word NOT IN (SELECT word FROM l)"""
)
def unmapped_keys(t):
    """Words of one table that stand alone between commas nowhere in another."""
    words = t.benchmark.select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]+"), F.lit(0))).alias("word")
    )
    return reports.unmapped_keys(words, "word", t.conversations, "text")


@query(
    """
WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="/([^"]*)"', 1) AS links FROM pages)
SELECT page_id, coalesce(list_filter(links, lambda x: x IN ('the', 'of', 'and', 'is'))[1], '') AS first_component FROM h"""
)
def first_team_component(t):
    """First navigation link of a page that is in a team's list."""
    links = F.regexp_extract_all("html", F.lit(r'<a href="/([^"]*)"'), F.lit(1))
    return t.pages.select(
        "page_id",
        reports.first_team_component(links, ["the", "of", "and", "is"]).alias("first_component"),
    )


_KINDS = """
WITH pg AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, page_id % 8 AS k FROM pages),
f AS (SELECT page_id, CASE k WHEN 0 THEN 'modules/apps/' || host || '/src/test/A.java' WHEN 1 THEN 'modules/dxp/apps/' || host || '/FooTest.java'
    WHEN 2 THEN host || '/generated/B.java' WHEN 3 THEN host || '/BaseThingImpl.java' WHEN 4 THEN host || '/add.spec.ts'
    WHEN 5 THEN host || '/style.css' WHEN 6 THEN 'modules/apps/' || host || '/Page.jsp' ELSE host || '/BasethingImpl.java' END AS path FROM pg)
"""


def _kinds(t: Tables) -> DataFrame:
    host, k = F.regexp_extract("url", r"^https?://([^/]+)", 1), F.col("page_id") % 8
    shapes = ["modules/apps/%s/src/test/A.java", "modules/dxp/apps/%s/FooTest.java", "%s/generated/B.java", "%s/BaseThingImpl.java", "%s/add.spec.ts", "%s/style.css", "modules/apps/%s/Page.jsp"]
    path = F.format_string("%s/BasethingImpl.java", host)
    for n, shape in enumerate(shapes):
        path = F.when(k == n, F.format_string(shape, host)).otherwise(path)
    return t.pages.select("page_id", path.alias("path"))


@query(
    _KINDS
    + """SELECT page_id, path FROM f WHERE NOT regexp_matches(path,
        'Test\\.java$|TestCase\\.java$|TestUtil\\.java$|/test/|/testIntegration/|/generated-sources/|/generated/')
    AND NOT regexp_matches(regexp_extract(path, '[^/]+$'), '^Base[A-Z].*Impl\\.java$')"""
)
def scored_paths(t):
    return _kinds(t).where(P.is_scored(F.col("path")))


@query(
    _KINDS
    + """SELECT page_id, CASE WHEN regexp_matches(path, 'Test\\.java$|TestCase\\.java$|\\.spec\\.ts$|\\.test\\.js$|\\.test\\.ts$|/test/|/testIntegration/') THEN 'test'
        WHEN regexp_matches(path, '\\.java$|\\.ts$|\\.tsx$|\\.js$|\\.jsp$|\\.jsx$') THEN 'code' ELSE 'other' END AS path_kind FROM f"""
)
def changed_path_kinds(t):
    from shiplens.operators.scoring import split_changed_paths

    return split_changed_paths(_kinds(t), "path").select("page_id", "path_kind")


@query(_KINDS + "SELECT page_id, regexp_replace(path, '^modules/(dxp/)?apps/', '') AS key FROM f")
def crosswalk_keys(t):
    return _kinds(t).select("page_id", P.normalise_crosswalk_key(F.col("path")).alias("key"))


@query(
    _KINDS
    + """, k AS (SELECT page_id, regexp_replace(regexp_replace(path, '/[^/]+$', ''), '^modules/(dxp/)?apps/', '') AS key FROM f),
    m AS (SELECT DISTINCT host AS module_path, 'C-' || host[1:2] AS component_name FROM pg
      UNION SELECT DISTINCT 'modules/apps/' || host || '/src/test', 'T-' || host[1:3] FROM pg WHERE page_id % 3 = 0),
    mk AS (SELECT DISTINCT regexp_replace(module_path, '^modules/(dxp/)?apps/', '') AS key, component_name FROM m)
    SELECT page_id, component_name FROM k JOIN mk USING (key)"""
)
def crosswalk_join(t):
    """Folders of changed files meet the modules of the map, both without their leading folders."""
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    named = t.pages.select("page_id", host.alias("host"))
    mapping = named.select(F.col("host").alias("module_path"), F.concat(F.lit("C-"), F.substring("host", 1, 2)).alias("component_name")).union(
        named.where("page_id % 3 = 0").select(F.concat(F.lit("modules/apps/"), "host", F.lit("/src/test")), F.concat(F.lit("T-"), F.substring("host", 1, 3)))
    )
    files = _kinds(t).withColumn("folder", F.regexp_replace("path", r"/[^/]+$", ""))
    return bridge.crosswalk_join(files, "folder", mapping.distinct(), "module_path").select("page_id", "component_name").distinct()


@query(
    _KINDS
    + """, s AS (SELECT f.path, count(*) AS n, round(least(avg(length(url)) / 60, 1)::DECIMAL(28,10), 4)::DOUBLE AS churn_score,
        round(least(count(*) / 40, 1)::DECIMAL(28,10), 4)::DOUBLE AS defect_score FROM f JOIN pages USING (page_id)
      WHERE NOT regexp_matches(f.path, 'Test\\.java$|TestCase\\.java$|TestUtil\\.java$|/test/|/testIntegration/|/generated-sources/|/generated/')
      AND NOT regexp_matches(regexp_extract(f.path, '[^/]+$'), '^Base[A-Z].*Impl\\.java$') GROUP BY 1),
    c AS (SELECT *, round(least((churn_score * 0.25::DOUBLE + defect_score * 0.20::DOUBLE) * CASE WHEN (churn_score > 0.5)::INT + (defect_score > 0.5)::INT = 2 THEN 1.05::DOUBLE ELSE 1.0::DOUBLE END, 1.0)::DECIMAL(28,10), 4)::DOUBLE AS composite_risk FROM s)
    SELECT path, churn_score, defect_score, composite_risk,
      CASE WHEN composite_risk >= 0.75 THEN 'CRITICAL' WHEN composite_risk >= 0.5 THEN 'HIGH' WHEN composite_risk >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM c"""
)
def scored_file_risk(t):
    """Composite risk of the files that are scored at all: tests and generated files have none."""
    from shiplens.functions.stats import rounded
    from shiplens.operators.scoring import composite_risk

    rows = _kinds(t).where(P.is_scored(F.col("path"))).join(t.pages.select("page_id", "url"), "page_id")
    per_file = rows.groupBy("path").agg(
        rounded(F.least(F.avg(F.length("url")) / 60, F.lit(1.0)), 4).alias("churn_score"),
        rounded(F.least(F.count("*") / 40, F.lit(1.0)), 4).alias("defect_score"),
    )
    signals = [(per_file.select("path", s), "path", s) for s in ("churn_score", "defect_score")]
    out = composite_risk(per_file.select("path"), signals)
    return out.select("path", "churn_score", "defect_score", "composite_risk", "risk_tier")


@query(
    """
WITH c AS (SELECT p_name AS module_name, p_brand AS component_name, CASE WHEN p_size % 3 = 0 THEN ' TRUE ' WHEN p_size % 3 = 1 THEN 'false' END AS approve,
    CASE WHEN p_retailprice > 1000 THEN 'HIGH' ELSE 'LOW' END AS confidence FROM part),
m AS (SELECT p_name AS module_name, min(p_partkey) AS module_id FROM part WHERE p_size > 10 GROUP BY 1),
k AS (SELECT p_brand AS component_name, max(p_partkey) AS component_id FROM part GROUP BY 1)
SELECT DISTINCT module_id, component_id, confidence FROM c JOIN m USING (module_name) JOIN k USING (component_name) WHERE lower(trim(approve)) = 'true'"""
)
def approved_mappings(t):
    from shiplens.functions.similarity import approved_mappings as approved

    size = F.col("p_size")
    candidates = t.part.select(
        F.col("p_name").alias("module_name"), F.col("p_brand").alias("component_name"),
        F.when(size % 3 == 0, " TRUE ").when(size % 3 == 1, "false").alias("approve"),
        F.when(F.col("p_retailprice") > 1000, "HIGH").otherwise("LOW").alias("confidence"),
    )
    modules = t.part.where("p_size > 10").groupBy(F.col("p_name").alias("module_name")).agg(F.min("p_partkey").alias("module_id"))
    components = t.part.groupBy(F.col("p_brand").alias("component_name")).agg(F.max("p_partkey").alias("component_id"))
    return approved(candidates, F.col("approve"), modules, components)
