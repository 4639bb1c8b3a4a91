"""The registered queries over the corpus and the SQL that checks them, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import stage
from shiplens.llm.labelled_pages import BARE_PAGES, PAGES, named_pages
from shiplens.llm.langid import identify, train
from shiplens.llm.linededup import remove_shared_lines
from shiplens.llm.maintext import extract_main_text
from shiplens.llm.maintext import train as train_tree
from shiplens.llm.mixing import mix_sources
from shiplens.llm.phrases import edited_fingerprints
from shiplens.llm.pii import KINDS, find_personal_data, span_list
from shiplens.llm.ppm import score_texts
from shiplens.llm.prefixtrie import ordered_turns, prefix_trie, rebuilt_turns
from shiplens.llm.simhash import simhash_groups
from shiplens.llm.tiling import leaked_items
from shiplens.llm.urlrules import judge_urls
from shiplens.llm.variants import variants_of
from shiplens.llm.wordpiece import ranked_vocabulary, token_counts
from shiplens.sources.readers import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, folder) under its own name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(load(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


#: The rules of the url query.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@query(
    """
    WITH rules(h, p, verdict) AS (VALUES
        ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    rest AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
        FROM pages),
    parts AS (
        SELECT page_id,
            translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rest),
    best AS (
        SELECT page_id, host, path,
            (SELECT max({'n': length(h || p), 'rule': h || p, 'verdict': verdict}) FROM rules
             WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS b
        FROM parts)
    SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM best
    """
)
def op4_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    # Literals, as a list handed to createDataFrame would start a Python worker.
    named = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*named)))
    pages = load(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query(
    """
    WITH lines AS (
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents),
    shared AS (
        SELECT line, min({'doc_id': doc_id, 'pos': pos}) AS first_place
        FROM lines WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
    marked AS (
        SELECT l.*, s.line IS NOT NULL AND {'doc_id': l.doc_id, 'pos': l.pos} <> s.first_place AS gone
        FROM lines l LEFT JOIN shared s USING (line))
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
        CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS lines_removed
    FROM marked GROUP BY doc_id
    """
)
def op6_shared_lines(spark: SparkSession, folder: str) -> DataFrame:
    return remove_shared_lines(load(spark, folder, "documents")).select("doc_id", "text", "lines_removed")


#: Where the public vocabulary files lie.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query()
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = ranked_vocabulary(spark, VOCABULARY)
    return token_counts(load(spark, folder, "documents"), pieces).select("doc_id", "n_words", "n_tokens")


#: The mixture: three domains of sources, their weights and those of the languages.
DOMAIN_WEIGHTS = {"web": 4, "forums": 3, "other": 3}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}


def mixture(docs: DataFrame) -> DataFrame:
    """Three fifths of all words, spread over the tree by weight, in at most two epochs."""
    domain = F.when(F.col("source") == "src0", "web").when(F.col("source").rlike("^src[1-9]$"), "forums").otherwise("other")
    return mix_sources(
        docs,
        {"domain": domain, "lang": F.col("lang"), "source": F.col("source")},
        {"domain": DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS},
        budget=F.expr("total * 3 div 5"),
    )


_SHARE = """
    {name}_w AS (
        SELECT *, {weight} AS weight FROM {name}_n),
    {name}_r AS (
        SELECT *,
            budget - coalesce(sum(capacity) OVER before, 0) AS rest,
            sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER before, 0) AS ws
        FROM {name}_w
        WINDOW before AS (PARTITION BY {parent} ORDER BY capacity / weight, {node}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    {name}_o AS (
        SELECT *, capacity * ws <= weight * rest AS filled,
            max(CASE WHEN capacity * ws > weight * rest THEN rest END) OVER (PARTITION BY {parent}) AS o_rest,
            max(CASE WHEN capacity * ws > weight * rest THEN ws END) OVER (PARTITION BY {parent}) AS o_ws
        FROM {name}_r),
    {name}_g AS (
        SELECT *, CASE WHEN filled THEN capacity ELSE (weight * o_rest) // o_ws END AS given FROM {name}_o)"""

MIX_SQL = f"""
    WITH docs AS (
        SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
            CASE WHEN source = 'src0' THEN 'web' WHEN regexp_matches(source, '^src[1-9]$') THEN 'forums'
                ELSE 'other' END AS domain,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
        FROM documents),
    leaves AS (
        SELECT domain, lang, source, sum(tokens)::HUGEINT AS supply FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
    a_n AS (
        SELECT 0 AS root, domain, sum(supply) * 2 AS capacity, (SELECT sum(supply) * 3 // 5 FROM leaves) AS budget
        FROM leaves GROUP BY domain),
    {_SHARE.format(name="a", parent="root", node="domain", weight="CASE domain WHEN 'web' THEN 4 ELSE 3 END")},
    b_n AS (
        SELECT l.domain, l.lang, sum(supply) * 2 AS capacity, any_value(given) AS budget
        FROM leaves l JOIN a_g USING (domain) GROUP BY ALL),
    {_SHARE.format(name="b", parent="domain", node="lang", weight="CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END")},
    c_n AS (
        SELECT l.domain, l.lang, l.source, supply, supply * 2 AS capacity, given AS budget
        FROM leaves l JOIN b_g USING (domain, lang)),
    {_SHARE.format(name="c", parent="domain, lang", node="source", weight="1")},
    cut AS (
        SELECT domain, lang, source, CAST(given // supply AS INTEGER) AS whole, given % supply AS rest FROM c_g),
    ordered AS (
        SELECT doc_id, domain, lang, source, whole, rest,
            sum(tokens) OVER (PARTITION BY domain, lang, source
                ORDER BY md5('20240607:' || (whole + 1) || ':' || doc_id)) AS upto
        FROM docs JOIN cut USING (domain, lang, source)),
    taken AS (
        SELECT doc_id, domain, lang, source, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS times FROM ordered)
    SELECT doc_id, lang, source, CAST(unnest(range(1, times + 1)) AS INTEGER) AS epoch FROM taken WHERE times > 0
"""


@query(MIX_SQL)
def op3_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(load(spark, folder, "documents")).select("doc_id", "lang", "source", "epoch")


@query()
def op8_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    found = leaked_items(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "tiles")


@query()
def op7_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    found = identify(docs, train(docs))
    return found.select("doc_id", "language", "confidence", "text_language", "accepted")


@query()
def op2_phrase_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(load(spark, folder, "documents")).drop("row_key")


@query()
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(load(spark, folder, "documents"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.concat("base", "added")).alias("spans"),
    )


@query()
def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(load(spark, folder, "pages"), train_tree([*PAGES, *BARE_PAGES, *named_pages()]))


@query()
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants_of(load(spark, folder, "documents"))


@query()
def op12_text_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_texts(load(spark, folder, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    ordered = stage(ordered_turns(load(spark, folder, "conversations")))
    return prefix_trie(*rebuilt_turns(ordered)).drop("enter", "exit")
