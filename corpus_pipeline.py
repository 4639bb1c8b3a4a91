"""The corpus pipeline: documents through five stages, each a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import columns_of, drop_rows, fresh, row_key, stage
from shiplens.llm.langid import identify, train
from shiplens.llm.linededup import remove_shared_lines
from shiplens.llm.queries import mixture
from shiplens.llm.simhash import drop_near_duplicates
from shiplens.llm.tiling import leaked_items
from shiplens.sources.readers import load


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go; a told language replaces the declared one.

    Null and empty texts cannot be told and go; a null id or source is no evidence. Of languages with
    equal odds the first by name is told. Repeated rows stay or go together.
    """
    model = train(docs)
    if model is None:
        return docs
    told = stage(identify(docs, model))
    # A table of its own, whose size Spark knows before it plans the join with the texts.
    out = stage(told.filter("not accepted").select(F.col("row_key").alias("_key")).distinct())
    kept = drop_rows(docs, out, row_key())
    # Few declared languages are wrong, so this is the smaller side of the join.
    wrong = told.filter("accepted").select("row_key", "language").distinct()
    wrong = wrong.join(docs.select(row_key().alias("row_key"), "lang").distinct(), "row_key").filter("not language <=> lang")
    key, language = fresh(docs, "_key", "_language")
    wrong = stage(wrong.groupBy(F.col("row_key").alias(key)).agg(F.min("language").alias(language)))
    named = kept.withColumn(key, row_key()).join(wrong, key, "left")
    return named.withColumn("lang", F.coalesce(language, "lang")).select(*columns_of(docs))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sites go from all documents but the first; a document left empty goes too.

    A null text or source shares no line. The first document is that of the smallest id, null last, then
    of the smallest row key; repeated rows are treated alike.
    """
    cleaned = remove_shared_lines(docs)
    changed = F.col("lines_removed") > 0
    kept = cleaned.filter(~changed | (F.trim("text") != ""))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*columns_of(cleaned, "lines_removed"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id, null ids last.

    Of rows with that id the smallest row key stays, of repeated rows one. Null and empty texts are
    copies of each other.
    """
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item has leaked go, repeated rows together.

    A null or empty text holds no item; null ids are like others.
    """
    leaks = leaked_items(docs, load(spark, sf_dir, "benchmark"))
    return drop_rows(docs, stage(leaks.select(F.col("row_key").alias("_key")).distinct()), row_key())


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the mixture's weights, a row for each epoch that takes them.

    A null source or language is a node of its own, ``none``. Rows of one id, null ids too, are taken
    together; ties of the order are rows of one id.
    """
    return mixture(docs)


STAGES = [
    ("languages", languages),
    ("shared_lines", shared_lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: Trees of fingerprints and string tiles have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each result is written as Parquet and read again."""
    docs = load(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
