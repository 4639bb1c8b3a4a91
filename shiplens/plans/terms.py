"""Words, bigrams and topics of text corpora."""

from __future__ import annotations

from pyspark.ml.clustering import LDA  # noqa: F401  Spark's own, which tests compare with
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.functions.stats import ratio, share_of_total, rounded
from shiplens.lineage import cut_lineage, run_folder, spread, tasks_for
from shiplens.operators.bridge import top_with_ties
from shiplens.operators.packing import numbered
from shiplens.plans.topicmodel import TopicModel, first_model

# A short stop list; callers add their own words as a table.
STOP_WORDS = (
    "the", "and", "for", "that", "with", "this", "from", "are", "was", "were", "has",
    "have", "had", "not", "but", "you", "your", "our", "its", "his", "her", "they",
    "their", "will", "would", "can", "could", "when", "what", "which", "who", "how",
    "https", "http", "com", "www", "org", "true", "false", "null",
)
MIN_WORD_LENGTH = 3
MIN_CORPUS_COUNT = 3
N_TOPICS = 10
#: Places of the term matrix at most.
SLOTS = 1 << 18
TOP_TERMS = 10
#: Characters of text whose word pairs one task counts.
PIECE = 16_000_000
#: Passes of the topic model over all documents before it is first tested, and the share of
#: log-perplexity that further ones must gain.
PASSES = 12
TOLERANCE = 0.02


def words_of(text: Column) -> Column:
    """Lower-case letter and digit runs of a whole text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def keeps(word: Column, stop=STOP_WORDS, min_length: int = MIN_WORD_LENGTH) -> Column:
    """Not a stop word, not a number, long enough."""
    return (
        (F.length(word) >= min_length)
        & ~word.rlike(r"^\p{N}+$")
        & ~word.isin(*stop)
    )


def tokens(
    docs: DataFrame, keys: list[str], text: str, stop=STOP_WORDS, extra_stop: DataFrame | None = None
) -> DataFrame:
    """One row per kept word of each document."""
    texts = spread(docs.select(*keys, text))
    rows = texts.select(*keys, F.explode(words_of(F.col(text))).alias("word")).where(
        keeps(F.col("word"), stop)
    )
    if extra_stop is not None:
        rows = rows.join(extra_stop.select("word"), "word", "left_anti")
    return rows


def token_counts(words: DataFrame, keys: list[str]) -> DataFrame:
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def word_shares(words: DataFrame, corpus: str) -> DataFrame:
    """Count and proportion of each word in its corpus; totals are joined, not windowed."""
    counts = token_counts(words, [corpus])
    totals = counts.groupBy(corpus).agg(F.sum("n").alias("_total"))
    return counts.join(totals, corpus).withColumn(
        "proportion", ratio(F.col("n"), F.col("_total"))
    ).drop("_total")


def blind_spots(
    words: DataFrame,
    corpus: str,
    customer,
    internal,
    min_customer: int = 10,
    gap: float = 0.001,
) -> DataFrame:
    """Words customers use far more often than internal reports, and the reverse.

    The ratio is null where the internal share is zero.
    """
    shares = word_shares(words.where(F.col(corpus).isin(customer, internal)), corpus)

    def side(value, name):
        return shares.where(F.col(corpus) == value).select(
            "word", F.col("n").alias(f"{name}_n"), F.col("proportion").alias(f"{name}_prop")
        )

    zero = F.lit(0).cast("long")
    both = side(customer, "customer").join(side(internal, "internal"), "word", "full_outer")
    both = both.withColumns(
        {
            "customer_n": F.coalesce("customer_n", zero),
            "internal_n": F.coalesce("internal_n", zero),
            "customer_prop": F.coalesce("customer_prop", F.lit(0.0)),
            "internal_prop": F.coalesce("internal_prop", F.lit(0.0)),
        }
    ).where(F.col("customer_n") >= min_customer)
    diff = rounded(F.col("customer_prop") - F.col("internal_prop"), 6)
    return both.select(
        "word",
        "customer_n",
        "internal_n",
        rounded("customer_prop", 8).alias("customer_prop"),
        rounded("internal_prop", 8).alias("internal_prop"),
        diff.alias("prop_diff"),
        rounded(ratio(F.col("customer_prop"), F.col("internal_prop")), 1).alias("customer_internal_ratio"),
        F.when(diff > gap, "Customer only")
        .when(diff < -gap, "Internal only")
        .otherwise("Shared")
        .alias("blind_spot_type"),
    )


def bigrams(
    docs: DataFrame, corpus: str, text: str, stop=STOP_WORDS, extra_stop: DataFrame | None = None
) -> DataFrame:
    """Neighbouring word pairs, both words kept.

    Texts are dealt in tasks of about ``PIECE`` characters: a large part of their pairs is new, so what
    a task counts before the shuffle grows with its text.
    """
    docs = docs.select(corpus, text)
    tasks = tasks_for(docs.agg(F.sum(F.length(text))).first()[0], PIECE)
    if tasks > docs.rdd.getNumPartitions():
        docs = docs.withColumn("_row", F.monotonically_increasing_id()).repartition(tasks, "_row")
    rows = spread(docs).select(corpus, words_of(F.col(text)).alias("_w"))
    pairs = F.arrays_zip(
        F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 1, F.lit(0))).alias("a"),
        F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0))).alias("b"),
    )
    rows = rows.select(corpus, F.inline(pairs).alias("a", "b"))
    rows = rows.where(keeps(F.col("a"), stop) & keeps(F.col("b"), stop))
    if extra_stop is not None:
        for side in ("a", "b"):
            rows = rows.join(extra_stop.select(F.col("word").alias(side)), side, "left_anti")
    return rows.select(corpus, F.concat_ws(" ", "a", "b").alias("bigram"))


def top_bigrams(
    docs: DataFrame, corpus: str, text: str, n: int = 15, stop=STOP_WORDS, extra_stop: DataFrame | None = None
) -> DataFrame:
    """Most frequent bigrams per corpus, ties kept."""
    counts = bigrams(docs, corpus, text, stop, extra_stop).groupBy(corpus, "bigram").agg(
        F.count(F.lit(1)).alias("n")
    )
    return top_with_ties(counts, [corpus], [F.desc("n")], n)


def term_matrix(
    docs: DataFrame,
    doc: str,
    text: str,
    min_count: int = MIN_CORPUS_COUNT,
    stop=STOP_WORDS,
    extra_stop: DataFrame | None = None,
    slots: int | None = SLOTS,
) -> tuple[DataFrame, DataFrame]:
    """Sparse term counts per document (``features``) and the ``slot``, ``term`` table of their places.

    Words are hashed to ``slots`` and the used ones numbered, so neither driver nor tasks hold a
    vocabulary and a model's size is bounded; words that share a slot are counted together under the
    name of the most frequent. Without ``slots`` each word has a place of its own. Rows of one document
    are added up first, so a document may be of any size. A document without a kept word has no row.
    The matrix is written in a part per core.
    """
    counts = cut_lineage(token_counts(tokens(docs, [doc], text, stop, extra_stop), [doc]))
    corpus = counts.groupBy("word").agg(F.sum("n").alias("_n")).where(F.col("_n") >= min_count)
    place = F.col("word") if slots is None else F.pmod(F.xxhash64("word"), F.lit(slots))
    corpus = cut_lineage(corpus.withColumn("_place", place))
    names = corpus.groupBy("_place").agg(F.max_by("word", F.struct("_n", "word")).alias("term"))
    places = cut_lineage(numbered(names, ["_place"], "slot").withColumn("slot", F.col("slot").cast("int")))
    known = corpus.join(places.select("_place", "slot"), "_place").select("word", "slot")
    # Dealt by document once, for the places and for the rows.
    cells = counts.join(known, "word").select(doc, "slot", "n").repartition(doc).groupBy(doc, "slot").agg(F.sum("n").cast("double").alias("v"))
    size = places.count()
    bags = cells.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("slot", "v"))).alias("_c"))
    # The stored form of a sparse vector; read back under the vector type, it is one.
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
        F.col("_c.slot").alias("indices"), F.col("_c.v").alias("values"),
    )
    spark = docs.sparkSession
    path = run_folder(spark, "matrix")
    bags.select(doc, vector.alias("features")).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    schema = T.StructType([docs.schema[doc], T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path), places.select("slot", "term")


def fit_topics(
    matrix: DataFrame, k: int = N_TOPICS, seed: int = 1234, max_iter: int = PASSES, tolerance: float = TOLERANCE
) -> TopicModel:
    """Topics of all documents, in full passes, until they explain the words no better.

    The number of passes doubles from ``max_iter`` on, each going on from the topics before it, until
    log-perplexity falls by less than ``tolerance`` of itself.
    """
    model, before, passes, done = first_model(matrix, k, seed), None, max_iter, 0
    while True:
        for _ in range(passes - done):
            model, _ = model.step(matrix)
        now = model.logPerplexity(matrix)
        if before is not None and before - now < tolerance * abs(before):
            return model
        before, passes, done = now, passes * 2, passes


def topic_terms(model: TopicModel, names: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    """Heaviest terms of each topic with their weights."""
    top = model.describeTopics(n)
    pairs = top.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t"))
    return pairs.withColumn("slot", F.col("t.termIndices")).join(names, "slot").select(
        (F.col("topic") + 1).alias("topic"),
        (F.col("rank") + 1).alias("rank"),
        "term",
        F.col("t.termWeights").alias("beta"),
    )


def topic_weights(model: TopicModel, matrix: DataFrame, doc: str) -> DataFrame:
    """Weight of each topic in each document, long form."""
    return model.weights(matrix, doc).select(doc, F.posexplode("gamma").alias("_t", "gamma")).select(
        doc, (F.col("_t") + 1).alias("topic"), "gamma"
    )


def topic_by_source(weights: DataFrame, source: str) -> DataFrame:
    """Mean weight of a topic per source and its percent of the source's total."""
    means = weights.groupBy(source, "topic").agg(F.avg("gamma").alias("avg_gamma"))
    return share_of_total(means, [source], "avg_gamma", "prop", 1).drop("total")


def topic_divergence(by_source: DataFrame, source: str, customer, internal, terms: DataFrame) -> DataFrame:
    """Topic shares of two sources side by side, skew label and leading terms."""
    wide = (
        by_source.groupBy("topic")
        .pivot(source, [customer, internal])
        .agg(F.first("prop"))
        .select(
            "topic",
            F.coalesce(F.col(f"`{customer}`"), F.lit(0.0)).alias("customer_pct"),
            F.coalesce(F.col(f"`{internal}`"), F.lit(0.0)).alias("internal_pct"),
        )
    )
    diff = rounded(F.col("customer_pct") - F.col("internal_pct"), 1)
    top = (
        terms.where(F.col("rank") <= 5)
        .groupBy("topic")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_t"))
        .select("topic", F.array_join(F.transform("_t", lambda x: x["term"]), ", ").alias("top_terms"))
    )
    return wide.select(
        "*",
        diff.alias("difference"),
        F.abs(diff).alias("abs_difference"),
        F.when(diff > 5, "Customer-skewed")
        .when(diff < -5, "Internal-skewed")
        .otherwise("Balanced")
        .alias("direction"),
    ).join(top, "topic", "left")


def topic_by_component(
    weights: DataFrame, docs: DataFrame, component: str, source: str, n: int = 15
) -> DataFrame:
    """Mean topic weight for the ``n`` components with most documents."""
    top = (
        docs.where(F.col(component).isNotNull() & (F.col(component) != ""))
        .groupBy(component)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), component)
        .limit(n)
    )
    return (
        weights.join(top.select(component), component, "left_semi")
        .groupBy(component, "topic", source)
        .agg(rounded(F.avg("gamma"), 3).alias("avg_gamma"))
    )


def topics(
    docs: DataFrame,
    text: str,
    source: str,
    component: str,
    customer,
    internal,
    k: int = N_TOPICS,
    seed: int = 1234,
    max_iter: int = PASSES,
    stop=STOP_WORDS,
    extra_stop: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The tables of a topic model: terms, by_source, divergence, by_component, bigrams.

    A document of the model is all text of one source and component; a null component is one.
    """
    name = F.coalesce(F.col(component).cast("string"), F.lit("Unspecified"))
    rows = docs.where(F.col(source).isNotNull()).withColumn("_doc", F.concat_ws("_", F.col(source).cast("string"), name))
    matrix, names = term_matrix(rows, "_doc", text, stop=stop, extra_stop=extra_stop)
    model = fit_topics(matrix, k, seed, max_iter)
    terms = cut_lineage(topic_terms(model, names))
    keys = rows.select("_doc", source, component).distinct()
    weights = cut_lineage(topic_weights(model, matrix, "_doc").join(keys, "_doc").drop("_doc"))
    by_source = topic_by_source(weights, source)
    return {
        "terms": terms,
        "weights": weights,
        "by_source": by_source,
        "divergence": topic_divergence(by_source, source, customer, internal, terms),
        "by_component": topic_by_component(weights, docs, component, source),
        "bigrams": top_bigrams(docs, source, text, stop=stop, extra_stop=extra_stop),
    }


def topics_by_period(
    docs: DataFrame, periods: dict[str, Column], min_docs: int = 50, **kwargs
) -> dict[str, DataFrame]:
    """``topics`` of each period (a label and the rows it takes), every table with its ``period``.

    Periods may overlap; one with fewer than ``min_docs`` rows is left out.
    """
    out: dict[str, DataFrame] = {}
    for label, inside in periods.items():
        part = docs.where(inside)
        if part.limit(min_docs).count() < min_docs:
            continue
        for name, table in topics(part, **kwargs).items():
            table = table.withColumn("period", F.lit(label))
            out[name] = out[name].unionByName(table) if name in out else table
    return out


def matched_topics(terms: DataFrame, one: str, two: str) -> DataFrame:
    """For each topic of period ``one`` the topic of ``two`` that shares most of its leading weight.

    ``shared`` adds up the lesser weight of each term that leads both; a topic without such a term
    has no match.
    """
    a = terms.where(F.col("period") == one).select("term", F.col("topic").alias("topic"), F.col("beta").alias("_a"))
    b = terms.where(F.col("period") == two).select("term", F.col("topic").alias("match"), F.col("beta").alias("_b"))
    both = a.join(b, "term").groupBy("topic", "match").agg(F.sum(F.least("_a", "_b")).alias("shared"))
    best = both.groupBy("topic").agg(F.min_by(F.struct("match", "shared"), F.struct(-F.col("shared"), F.col("match"))).alias("_m"))
    return best.select("topic", "_m.match", "_m.shared")
