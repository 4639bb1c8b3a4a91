"""Which texts contain which strings, over an inverted index of short substrings (grams).

A string is looked up by the rarest of its grams, and only what shares that gram is compared, so
neither side is paired with the whole of the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.lineage import cut_lineage

#: Code points of a gram; shorter strings are grams themselves.
GRAM = 4


def grams(text: Column, size: int | Column) -> Column:
    """The distinct substrings of ``size`` code points; none where the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.transform(starts, lambda i: F.substring(text, i, size))
    return F.when(F.length(text) >= size, F.array_distinct(pieces))


def contained(texts: DataFrame, text: str, strings: DataFrame, string: str, size: int = GRAM) -> DataFrame:
    """Distinct (``text``, ``string``) pairs in which the text contains the string, case and all.

    Null texts and null or empty strings are in no pair. A string of which some gram occurs in no
    text drops out before the join. The names of the two columns must differ.
    """
    hay = cut_lineage(texts.select(text).where(F.col(text).isNotNull()).distinct())
    pins = cut_lineage(strings.select(string).where(F.length(string) > 0).distinct())
    width = F.least(F.length(string), F.lit(size))
    wanted = pins.select(string, F.explode(grams(F.col(string), width)).alias("_gram"))
    # Texts are cut only into the lengths that are asked for: `size`, and those of shorter strings.
    lengths = [r[0] for r in pins.select(width.alias("_n")).distinct().collect()]
    pieces = F.flatten(F.array(*[F.coalesce(grams(F.col(text), n), F.array().cast("array<string>")) for n in sorted({*lengths, size})]))
    index = hay.select(text, F.explode(pieces).alias("_gram"))
    asked = index.join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    counts = cut_lineage(asked.groupBy("_gram").agg(F.count("*").alias("_n")))
    rarest = (
        wanted.join(counts, "_gram", "left")
        .groupBy(string)
        .agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"), F.min(F.coalesce("_n", F.lit(0))).alias("_n"))
        .where("_n > 0")
    )
    return index.join(cut_lineage(rarest.select(string, "_gram")), "_gram").where(F.contains(F.col(text), F.col(string))).select(text, string)
