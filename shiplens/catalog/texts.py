"""Version-control texts, built from documents and orders, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.catalog.registry import Tables, query
from shiplens.functions import paths as P
from shiplens.operators import triage
from shiplens.plans import reports
from shiplens.sources import records, vcs

_LINES = """
WITH ln AS (SELECT doc_id, source, lang, string_split(text, chr(10)) AS l FROM documents),
bl AS (SELECT doc_id, 0 AS block_no, 'modules/apps/' || source || '/resources/META/nav/' || lang || '/d' || doc_id || '.js' AS file_path,
         len(l) AS added, 0 AS removed, false AS is_deleted FROM ln
       UNION ALL SELECT doc_id, 1, 'core/' || source || '/' || lang || '.java', 0, 1, lang = 'de' FROM ln)
"""


def _diffs(t: Tables) -> DataFrame:
    """A two-file diff per document: its lines added to one file, one line cut from another."""
    name = F.concat(
        F.lit("modules/apps/"), "source", F.lit("/resources/META/nav/"), "lang", F.lit("/d"),
        F.col("doc_id").cast("string"), F.lit(".js"),
    )
    other = F.concat(F.lit("core/"), "source", F.lit("/"), "lang", F.lit(".java"))
    body = F.array_join(F.transform(F.split("text", r"\n"), lambda x: F.concat(F.lit("+ "), x)), "\n")

    def head(path, new):
        return F.concat(
            F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\n--- a/"), path, F.lit("\n+++ "), new, F.lit("\n@@ -1 +1 @@\n")
        )

    new = F.when(F.col("lang") == "de", F.lit("/dev/null")).otherwise(F.concat(F.lit("b/"), other))
    text = F.concat(
        head(name, F.concat(F.lit("b/"), name)), body, F.lit("\n"), head(other, new), F.lit("- gone\n")
    )
    return t.documents.select("doc_id", text.alias("text"))


def _blocks(t: Tables) -> DataFrame:
    return vcs.diff_blocks(_diffs(t), "doc_id", "text", P.glob_pattern(P.DIFF_EXCLUDES))


@query(_LINES + "SELECT *, added + removed AS changed FROM bl")
def diff_blocks(t):
    return _blocks(t).drop("block")


@query(_LINES + "SELECT * FROM bl WHERE NOT (file_path LIKE '%/en.java' OR regexp_matches(file_path, '^modules/apps/src1[^/]*/'))")
def diff_blocks_kept(t):
    """The blocks of a comparison without the files that two globs leave out."""
    left_out = P.glob_pattern(("**/en.java", "modules/apps/src1*/**"))
    return vcs.diff_blocks(_diffs(t), "doc_id", "text", left_out).drop("block", "changed")


@query(
    _LINES
    + """SELECT CASE WHEN file_path LIKE 'modules/%' THEN regexp_extract(file_path, '^([^/]+/[^/]+/[^/]+)', 1) || '/'
      ELSE regexp_extract(file_path, '^([^/]+/[^/]+)', 1) || '/' END AS folder, count(*) AS n_files, sum(added + removed)::BIGINT AS n_lines
    FROM bl GROUP BY 1"""
)
def change_manifest(t):
    return vcs.change_manifest(_blocks(t), [])


@query(
    _LINES
    + """SELECT doc_id, file_path, added + removed AS changed FROM bl
    WHERE file_path LIKE '%/resources/META/nav/%' AND added + removed BETWEEN 1 AND 600"""
)
def shared_ui_changes(t):
    return triage.shared_ui_changes(_blocks(t), "file_path", "changed").select(
        "doc_id", "file_path", "changed"
    )


_FRAG = """
WITH pt AS (SELECT DISTINCT lower(regexp_extract(url, '^https?://([^?#]*)', 1)) AS path FROM pages),
fr AS (SELECT DISTINCT l_suppkey::VARCHAR AS f FROM lineitem UNION SELECT DISTINCT lower(regexp_extract(text, '^\\S+')) FROM benchmark),
ex AS (SELECT f, path FROM pt JOIN fr ON path = f OR ends_with(path, '/' || f)),
fz AS (SELECT f, path FROM pt JOIN fr ON contains(path, f) WHERE f NOT IN (SELECT f FROM ex))
"""


def _fragments(t: Tables):
    paths = t.pages.select(F.lower(F.regexp_extract("url", r"^https?://([^?#]*)", 1)).alias("path"))
    frags = (
        t.lineitem.select(F.col("l_suppkey").cast("string").alias("f"))
        .union(t.benchmark.select(F.lower(F.regexp_extract("text", r"^\S+", 0))))
        .distinct()
    )
    return paths, frags


@query(
    _FRAG
    + "SELECT f AS fragment, path, 'exact' AS match FROM ex UNION ALL SELECT f, path, 'fuzzy' FROM fz"
)
def relevant_changes(t):
    paths, frags = _fragments(t)
    return triage.relevant_changes(paths, "path", frags, "f", "auto")


@query(_FRAG + "SELECT f AS fragment FROM fr WHERE f NOT IN (SELECT f FROM ex UNION SELECT f FROM fz)")
def unmatched_fragments(t):
    paths, frags = _fragments(t)
    hits = triage.relevant_changes(paths, "path", frags, "f", "auto")
    return triage.unmatched_fragments(frags, "f", hits)


@query(
    """
WITH pt AS (SELECT DISTINCT lower(regexp_extract(url, '^https?://([^?#]*)', 1)) AS path FROM pages),
f AS (SELECT item_id, lower(text) AS x, regexp_extract(lower(text), '^\\S+') AS c FROM benchmark),
cw AS (SELECT DISTINCT item_id, w FROM (SELECT item_id, unnest(regexp_split_to_array(c, '[\\s/\\-_]')) AS w FROM f) WHERE length(w) > 3),
nw AS (SELECT DISTINCT item_id, w FROM (SELECT item_id, unnest(regexp_split_to_array(x, '[.\\-/_ >]')) AS w FROM f) WHERE length(w) > 5),
ws AS (SELECT *, 2 AS r FROM cw UNION SELECT *, 3 FROM nw),
mt AS (SELECT w, path FROM (SELECT DISTINCT w FROM ws) JOIN pt ON contains(path, w)),
h AS (SELECT item_id, path, r FROM ws JOIN mt USING (w)),
b AS (SELECT item_id, path, min(r) AS source_rank FROM h GROUP BY 1, 2)
SELECT item_id, path, source_rank FROM b QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY source_rank, path) <= 3"""
)
def blocks_for_failure(t):
    paths = t.pages.select(F.lower(F.regexp_extract("url", r"^https?://([^?#]*)", 1)).alias("path")).distinct()
    fails = t.benchmark.withColumn("component", F.regexp_extract("text", r"^\S+", 0))
    return triage.blocks_for_failure(fails, "item_id", "text", "component", paths, "path")


_LOG = """
WITH ln AS (SELECT doc_id, source, lang, trim(unnest(string_split(text, chr(10)))) AS p FROM documents)
"""


@query(
    _LOG
    + """SELECT 'c' || doc_id AS commit_hash, source || '@x' AS author_email, '2024-01-05' AS commit_date, p AS file_path, count(*) AS n
    FROM ln WHERE p <> '' GROUP BY ALL"""
)
def commit_log(t):
    """A log record per document, its lines standing for changed paths."""
    log = t.documents.select(
        F.concat(
            F.lit("COMMIT|c"), F.col("doc_id").cast("string"), F.lit("|"), "source", F.lit("@x|2024-01-05\n\n"), "text"
        ).alias("value")
    )
    rows = vcs.parse_commit_log(log, "value")
    return rows.groupBy(
        "commit_hash", "author_email", F.col("commit_date").cast("string").alias("commit_date"), "file_path"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
WITH n AS (SELECT l_suppkey, CASE l_returnflag WHEN 'R' THEN 'java' WHEN 'A' THEN 'tsx' ELSE 'xml' END AS ext,
   l_quantity::BIGINT AS ins, CASE WHEN l_tax = 0 THEN 0 ELSE l_linenumber END AS del, l_linestatus = 'F' AND l_discount = 0 AS test FROM lineitem)
SELECT 's' || l_suppkey AS module, count(*) AS Total_ModifiedFileCount, sum(ins)::BIGINT AS Total_Insertions, sum(del)::BIGINT AS Total_Deletions,
  count(*) FILTER (WHERE ext = 'java') AS java_ModifiedFileCount,
  coalesce(sum(ins) FILTER (WHERE ext = 'java'), 0)::BIGINT AS java_Insertions, coalesce(sum(del) FILTER (WHERE ext = 'tsx'), 0)::BIGINT AS tsx_Deletions
FROM n WHERE NOT test AND ext <> 'xml' GROUP BY 1"""
)
def numstat_churn(t):
    """Line items as ``insertions<TAB>deletions<TAB>path`` lines."""
    ext = F.when(F.col("l_returnflag") == "R", "java").when(F.col("l_returnflag") == "A", "tsx").otherwise("xml")
    folder = F.when((F.col("l_linestatus") == "F") & (F.col("l_discount") == 0), "/test/a.").otherwise("/src/a.")
    line = F.concat_ws(
        "\t",
        F.col("l_quantity").cast("bigint").cast("string"),
        F.when(F.col("l_tax") == 0, "-").otherwise(F.col("l_linenumber").cast("string")),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), folder, ext),
    )
    out = vcs.numstat_churn(
        t.lineitem.select(line.alias("value")), "value", F.regexp_extract("path", r"^([^/]+)", 1), []
    )
    return out.select(
        "module", "Total_ModifiedFileCount", "Total_Insertions", "Total_Deletions",
        "java_ModifiedFileCount", "java_Insertions", "tsx_Deletions",
    )


_FILES = """
WITH ln AS (SELECT 'mod-' || source || '/' || lang || CASE WHEN n_chars % 2 = 0 THEN '/src/' ELSE '/test/' END || doc_id || '.' ||
     CASE lang WHEN 'en' THEN 'java' WHEN 'de' THEN 'ts' ELSE 'js' END AS path, 'mod-' || source AS module,
     CASE lang WHEN 'en' THEN 'java' WHEN 'de' THEN 'ts' ELSE 'js' END AS ext, n_chars % 2 = 0 AS keep, unnest(string_split(text, chr(10))) AS x FROM documents)
"""


def _lines(t: Tables) -> DataFrame:
    ext = F.when(F.col("lang") == "en", "java").when(F.col("lang") == "de", "ts").otherwise("js")
    kind = F.when(F.col("n_chars") % 2 == 0, "/src/").otherwise("/test/")
    path = F.concat(F.lit("mod-"), "source", F.lit("/"), "lang", kind, F.col("doc_id").cast("string"), F.lit("."), ext)
    return t.documents.select(path.alias("path"), F.explode(F.split("text", r"\n")).alias("value"))


@query(
    _FILES
    + """SELECT module, ext, count(DISTINCT path) AS file_count, count(*) AS lines_of_code FROM ln WHERE keep GROUP BY 1, 2"""
)
def file_inventory(t):
    return vcs.file_inventory(_lines(t), "path", F.regexp_extract("path", r"^([^/]+)", 1))


@query(
    _FILES
    + """, f AS (SELECT module, path, bool_or(regexp_matches(x, 'ation\\b|the the')) AS hit FROM ln WHERE keep GROUP BY 1, 2)
    SELECT module AS module_path, count(*) FILTER (WHERE hit) AS flagged_file_count, count(*) AS total_file_count,
      round((count(*) FILTER (WHERE hit) / count(*))::DECIMAL(28,10), 4)::DOUBLE AS flag_pct, round((count(*) FILTER (WHERE hit) / count(*))::DECIMAL(28,10), 4)::DOUBLE >= 0.1 AS is_flagged FROM f GROUP BY 1"""
)
def flagged_share(t):
    return vcs.flagged_share(
        _lines(t), "path", "value", F.regexp_extract("path", r"^([^/]+)", 1),
        patterns=(r"ation\b", "the the"), threshold=0.1,
    )


_SUBJ = """
WITH s AS (SELECT o_orderkey, o_custkey, o_orderpriority AS prio, CASE o_orderstatus WHEN 'F' THEN 'ABC-' || o_custkey || ' fix'
    WHEN 'O' THEN 'XYZ-' || o_custkey || '-release note' ELSE CASE WHEN o_orderpriority < '3' THEN 'Revert "x"' ELSE 'Merge branch' END END AS subject,
    year(o_orderdate)::VARCHAR || '.Q' || quarter(o_orderdate)::VARCHAR AS quarter FROM orders)
"""


def _subjects(t: Tables) -> DataFrame:
    from shiplens.operators.periods import year_quarter

    key = F.col("o_custkey").cast("string")
    status = F.col("o_orderstatus")
    subject = (
        F.when(status == "F", F.concat(F.lit("ABC-"), key, F.lit(" fix")))
        .when(status == "O", F.concat(F.lit("XYZ-"), key, F.lit("-release note")))
        .otherwise(F.when(F.col("o_orderpriority") < "3", 'Revert "x"').otherwise("Merge branch"))
    )
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority", subject.alias("subject"),
        year_quarter(F.col("o_orderdate")).alias("quarter"),
    )


@query(
    _SUBJ
    + """SELECT CASE WHEN subject LIKE 'ABC%' THEN regexp_extract(subject, '^ABC-\\d+') ELSE '(no ticket)' END AS ticket,
      count(*) AS n_commits FROM s GROUP BY 1"""
)
def commit_clusters(t):
    return vcs.commit_clusters(_subjects(t), "o_orderkey", "subject", ["ABC"])


@query(
    _SUBJ
    + """, k AS (SELECT CASE WHEN regexp_matches(subject, '^[A-Z]+-[0-9]+') THEN regexp_extract(subject, '^[A-Z]+-[0-9]+') ELSE split_part(subject, ' ', 1) END AS token,
      regexp_matches(subject, '^[A-Z]+-[0-9]+') AS is_ticket, o_orderkey FROM s)
    SELECT token, is_ticket, min(o_orderkey) AS first_seen, count(*) AS n_commits FROM k GROUP BY 1, 2"""
)
def tickets_in_range(t):
    out = vcs.tickets_in_range(_subjects(t), "subject", ["o_orderkey"])
    return out.withColumn("first_seen", F.col("first_seen.o_orderkey"))


@query(
    _SUBJ
    + """SELECT CASE WHEN lower(subject) LIKE '%revert%' THEN 'revert' WHEN contains(split_part(subject, ' ', 1), '-') THEN 'ticket' ELSE 'other' END AS kind,
      count(*) AS n, count(DISTINCT split_part(subject, ' ', 1)) AS n_tokens FROM s GROUP BY 1"""
)
def revert_split(t):
    return vcs.revert_split(_subjects(t), "subject", "o_orderkey").groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("token").alias("n_tokens")
    )


@query(
    _SUBJ
    + """SELECT prio AS module_path, quarter, count(DISTINCT o_custkey) AS breaking_count FROM s WHERE subject LIKE 'Revert%' OR subject LIKE '%fix%' GROUP BY 1, 2"""
)
def marked_commits(t):
    """A customer is a commit here: it counts once per priority and quarter."""
    marked = F.col("subject").rlike("^Revert|fix")
    message = F.when(marked, F.concat(F.lit("change # BREAKING "), "subject")).otherwise(F.concat(F.lit("breaking no marker "), "subject"))
    rows = _subjects(t).withColumn("message", message)
    return vcs.marked_commits(rows, "message", "o_custkey", "o_orderpriority", "quarter")


@query(
    """
WITH r AS (SELECT conv_id, turn, unnest(regexp_extract_all(text, '[^\\n]+')) AS line, generate_subscripts(regexp_extract_all(text, '[^\\n]+'), 1) AS i FROM conversations)
SELECT conv_id * 1000 + turn AS key, i AS row_no, '|' || line || '|' AS scenario FROM r"""
)
def scenario_rows(t):
    """Each turn's lines as the rows of a scenario table inside a description."""
    lines = F.filter(F.split("text", r"\n"), lambda x: x != "")
    table = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("|"), x, F.lit("|"))), "\n")
    text = F.concat(
        F.lit("intro\n||*Test Scenarios*||Head||\n"), table, F.lit("\nh3. Test Cases\nrest")
    )
    rows = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), text.alias("text"))
    out = reports.scenario_rows(rows, "key", "text")
    return out.withColumn("scenario", F.regexp_replace("scenario", r"\n?h3.*$", "")).withColumn(
        "scenario", F.rtrim("scenario")
    )


@query(
    """
WITH o AS (SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderdate::DATE AS d, c_mktsegment, n_name
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
SELECT 'K-' || o_orderkey AS issue_key, 'sum ' || n_name AS summary, strftime(d, '%Y-%m-%d') AS created_date,
  CASE o_orderpriority[1:1] WHEN '1' THEN 5 WHEN '2' THEN 4 WHEN '3' THEN 3 WHEN '4' THEN 2 WHEN '5' THEN 1 END::DOUBLE AS severity_score,
  c_mktsegment || '|' || n_name AS components, year(d) || '.Q1.7|' || year(d) || '.Q2' AS affected_versions,
  CASE WHEN year(d) >= 2000 THEN year(d) || '.Q2' END AS quarter_label
FROM o"""
)
def parse_issues(t):
    """Orders written as issue JSON and read back."""
    words = F.create_map(
        *[F.lit(x) for kv in (("1", "Fire"), ("2", "Critical"), ("3", "High"), ("4", "Medium"), ("5", "Low")) for x in kv]
    )
    year = F.year("o_orderdate").cast("string")

    def named(*cols):
        return F.array(*[F.struct(c.alias("name")) for c in cols])

    j = F.struct(
        F.concat(F.lit("K-"), F.col("o_orderkey").cast("string")).alias("key"),
        F.struct(
            F.concat(F.lit("sum "), "n_name").alias("summary"),
            F.struct(F.lit("Open").alias("name")).alias("status"),
            F.concat(F.to_date("o_orderdate").cast("string"), F.lit("T00:00:00.000+0000")).alias("created"),
            F.struct(F.element_at(words, F.substring("o_orderpriority", 1, 1)).alias("name")).alias("priority"),
            named(F.col("c_mktsegment"), F.col("n_name")).alias("components"),
            named(F.concat(year, F.lit(".Q1.7")), F.concat(year, F.lit(".Q2"))).alias("versions"),
        ).alias("fields"),
    )
    text = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.to_json(j).alias("value"))
    )
    return records.parse_issues(text, "value", "customer").select(
        "issue_key", "summary", F.col("created_date").cast("string").alias("created_date"),
        "severity_score", "components", "affected_versions", "quarter_label",
    )
