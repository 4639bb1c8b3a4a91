"""Words and bigrams of documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shiplens.catalog.registry import query
from shiplens.functions.stats import rounded
from shiplens.plans import terms
from shiplens.sources import readers

_STOPS = ", ".join(f"'{w}'" for w in terms.STOP_WORDS)
_KEEP = (
    "length({w}) >= 3 AND NOT regexp_full_match({w}, '\\p{{N}}+') AND {w} NOT IN (" + _STOPS + ")"
)


def _keep(w):
    return _KEEP.format(w=w)


_ROLES = f"""
WITH w AS (SELECT role, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word
           FROM conversations WHERE role IN ('user', 'assistant')),
c AS (SELECT role, word, count(*) AS n FROM w WHERE {_keep('word')} GROUP BY 1, 2),
s AS (SELECT role, word, n, n / sum(n) OVER (PARTITION BY role) AS p FROM c),
b AS (SELECT coalesce(x.word, y.word) AS word, coalesce(x.n, 0) AS customer_n, coalesce(y.n, 0) AS internal_n,
        coalesce(x.p, 0) AS cp, coalesce(y.p, 0) AS ip
      FROM (SELECT * FROM s WHERE role = 'user') x FULL JOIN (SELECT * FROM s WHERE role = 'assistant') y ON x.word = y.word)
"""


@query(
    _ROLES
    + """SELECT word, customer_n, internal_n, round((cp)::DECIMAL(28,10), 8)::DOUBLE AS customer_prop, round((ip)::DECIMAL(28,10), 8)::DOUBLE AS internal_prop,
      round((cp - ip)::DECIMAL(28,10), 6)::DOUBLE AS prop_diff, round((cp / nullif(ip, 0))::DECIMAL(28,10), 1)::DOUBLE AS customer_internal_ratio,
      CASE WHEN round((cp - ip)::DECIMAL(28,10), 6)::DOUBLE > 0.001 THEN 'Customer only' WHEN round((cp - ip)::DECIMAL(28,10), 6)::DOUBLE < -0.001 THEN 'Internal only'
        ELSE 'Shared' END AS blind_spot_type FROM b WHERE customer_n >= 10"""
)
def blind_spots(t):
    words = terms.tokens(t.conversations, ["role"], "text")
    return terms.blind_spots(words, "role", "user", "assistant")


@query(
    f"""
WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM documents)
SELECT lang, word, count(*) AS n FROM w WHERE {_keep('word')} GROUP BY 1, 2"""
)
def token_counts(t):
    return terms.token_counts(terms.tokens(t.documents, ["lang"], "text"), ["lang"])


@query(
    f"""
WITH d AS (SELECT lang, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
p AS (SELECT lang, unnest(list_zip(w[1:-2], w[2:])) AS x FROM d WHERE len(w) > 1),
c AS (SELECT lang, x[1] || ' ' || x[2] AS bigram, count(*) AS n FROM p WHERE {_keep('x[1]')} AND {_keep('x[2]')} GROUP BY 1, 2)
SELECT lang, bigram, n FROM c QUALIFY rank() OVER (PARTITION BY lang ORDER BY n DESC) <= 15"""
)
def top_bigrams(t):
    return terms.top_bigrams(t.documents, "lang", "text")


#: Topic tables of this process, by application, folder and period: the queries share each fit.
_FITTED: dict[tuple[str, str, str], dict] = {}


def _topic_tables(t, label="all"):
    """Topics of a period (all documents, or those of even or odd id), with a stop list of lines."""
    key = (t.spark.sparkContext.applicationId, t.folder, label)
    if key not in _FITTED:
        docs = t.documents.withColumn("side", F.when(F.col("lang") == "en", "customer").otherwise("internal"))
        # The list as it stands in a file: the commonest source names, a remark and a blank line.
        lines = t.documents.select(F.upper("source").alias("value")).distinct().union(t.region.select(F.lit("# no words")))
        inside = {"all": F.lit(True), "even": F.col("doc_id") % 2 == 0, "odd": F.col("doc_id") % 2 == 1}[label]
        _FITTED[key] = terms.topics_by_period(
            docs, {label: inside}, text="text", source="side", component="source",
            customer="customer", internal="internal", k=10, extra_stop=readers.stopwords(lines),
        )
    return _FITTED[key]


@query()
def topic_terms(t):
    return _topic_tables(t)["terms"]


@query()
def topic_divergence(t):
    return _topic_tables(t)["divergence"]


@query()
def topic_by_component(t):
    return _topic_tables(t)["by_component"]


@query()
def topics_between_periods(t):
    both = _topic_tables(t, "even")["terms"].unionByName(_topic_tables(t, "odd")["terms"])
    return terms.matched_topics(both, "even", "odd")


@query(
    "SELECT DISTINCT CASE lang WHEN 'en' THEN 'customer' ELSE 'internal' END AS side, 'all' AS period, 10::BIGINT AS n_topics, 1.0::DOUBLE AS weight FROM documents"
)
def topic_shares(t):
    """Mean topic weights of each source: ten of them, adding up to one."""
    by = _topic_tables(t)["by_source"].groupBy("side", "period")
    return by.agg(F.count("topic").alias("n_topics"), F.round(F.sum("avg_gamma"), 4).alias("weight"))


_WEIGHTS = """
WITH g AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'customer' ELSE 'internal' END AS side, source, unnest(range(1, 5)) AS topic, n_chars FROM documents),
w AS (SELECT side, source, topic, ((n_chars * topic) % 7 + 1 + CASE WHEN side = 'customer' THEN 3 * topic ELSE 0 END)::DOUBLE AS gamma FROM g),
m AS (SELECT side, topic, avg(gamma) AS avg_gamma FROM w GROUP BY 1, 2),
s AS (SELECT *, round((avg_gamma / sum(avg_gamma) OVER (PARTITION BY side) * 100)::DECIMAL(28,10), 1)::DOUBLE AS prop FROM m),
te AS (SELECT topic, r AS rank, 't' || topic || '-' || r AS term FROM range(1, 5) a(topic), range(1, 9) b(r)),
tt AS (SELECT topic, string_agg(term, ', ' ORDER BY rank) AS top_terms FROM te WHERE rank <= 5 GROUP BY 1)
"""


def _given_weights(t):
    """Topic weights by a rule, so that what is made of them can be checked to the digit."""
    side = F.when(F.col("lang") == "en", "customer").otherwise("internal")
    rows = t.documents.select(side.alias("side"), "source", "n_chars", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("topic"))
    extra = F.when(F.col("side") == "customer", F.col("topic") * 3).otherwise(0)
    return rows.select("side", "source", "topic", ((F.col("n_chars") * F.col("topic")) % 7 + 1 + extra).cast("double").alias("gamma"))


@query(_WEIGHTS + "SELECT side, topic::INT AS topic, round(avg_gamma::DECIMAL(28,10), 6)::DOUBLE AS avg_gamma, prop FROM s")
def shares_of_weights(t):
    out = terms.topic_by_source(_given_weights(t), "side")
    return out.withColumn("avg_gamma", rounded("avg_gamma", 6))


@query(
    _WEIGHTS
    + """, v AS (SELECT topic, coalesce(max(prop) FILTER (WHERE side = 'customer'), 0) AS customer_pct, coalesce(max(prop) FILTER (WHERE side = 'internal'), 0) AS internal_pct FROM s GROUP BY 1),
    d AS (SELECT *, round((customer_pct - internal_pct)::DECIMAL(28,10), 1)::DOUBLE AS difference FROM v)
    SELECT topic::INT AS topic, customer_pct, internal_pct, difference, abs(difference) AS abs_difference,
      CASE WHEN difference > 5 THEN 'Customer-skewed' WHEN difference < -5 THEN 'Internal-skewed' ELSE 'Balanced' END AS direction, top_terms FROM d JOIN tt USING (topic)"""
)
def divergence_of_weights(t):
    numbers = lambda n: F.explode(F.sequence(F.lit(1), F.lit(n)))
    names = t.documents.limit(1).select(numbers(4).alias("topic")).select("topic", numbers(8).alias("rank"))
    leading = names.select("topic", "rank", F.format_string("t%d-%d", "topic", "rank").alias("term"))
    return terms.topic_divergence(terms.topic_by_source(_given_weights(t), "side"), "side", "customer", "internal", leading)


@query(
    _WEIGHTS
    + """, tc AS (SELECT source FROM documents WHERE source <> '' GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 15)
    SELECT source, topic::INT AS topic, side, round(avg(gamma)::DECIMAL(28,10), 3)::DOUBLE AS avg_gamma FROM w WHERE source IN (FROM tc) GROUP BY ALL"""
)
def component_weights(t):
    return terms.topic_by_component(_given_weights(t), t.documents, "source", "side")


@query(
    f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM documents),
k AS (SELECT doc_id, word FROM w WHERE {_keep('word')}),
v AS (SELECT word FROM k GROUP BY word HAVING count(*) >= {terms.MIN_CORPUS_COUNT})
SELECT doc_id, count(DISTINCT word) AS n_terms, count(*)::DOUBLE AS n_words FROM k WHERE word IN (FROM v) GROUP BY doc_id"""
)
def term_matrix_rows(t):
    """The document-term matrix by its rows: terms and words of each document that has any."""
    # Terms are counted by their places, so no two words may share one.
    matrix, _ = terms.term_matrix(t.documents, "doc_id", "text", slots=None)
    # The files hold the vectors as plain structs, which need no conversion.
    cells = t.spark.read.parquet(*matrix.inputFiles()).select("doc_id", F.col("features.values").alias("v"))
    return cells.select("doc_id", F.size("v").cast("long").alias("n_terms"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("n_words"))
