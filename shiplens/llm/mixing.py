"""Mixing sources to target weights over a tree of domains, languages and sources.

A token budget is shared out from the root. At each node the children get their weight's part, but
none more than it can supply in ``epochs`` passes; what a child cannot take goes to its siblings in
proportion to their weights. As the capacity of a child is that of its whole subtree, a shortage
leaves a subtree only once all siblings in it are full, and then reaches those of the parent.

A leaf's stream is a sequence of epochs, each a seeded permutation of its documents; the leaf takes
the prefix of that stream that its budget covers. Whole epochs need no order. In the last one the
cut is found by sums over hash ranges first, so only the documents of one range in 4096 are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.llm.common import WORD, columns_of, fresh, stage, text_or_empty

EPOCHS = 2
SEED = 20240607


def word_tokens(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def _big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` with ``given``, their part of the parent's ``budget``.

    Columns read: ``weight`` (positive long), ``capacity``, ``budget``. Children are filled in the
    order of capacity by weight; a child is full if its capacity is at most its part of what is left.
    """
    all_of = Window.partitionBy(*parent)
    before = all_of.orderBy(F.col("capacity") / F.col("weight"), name).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weights = F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = children.withColumns({"_left": left, "_weights": weights})
    rows = rows.withColumn("_full", _big("capacity") * _big("_weights") <= _big("weight") * _big("_left"))
    open_left = F.max(F.when(~F.col("_full"), F.col("_left"))).over(all_of)
    open_weights = F.max(F.when(~F.col("_full"), F.col("_weights"))).over(all_of)
    rows = rows.withColumns({"_open": open_left, "_over": open_weights})
    part = F.expr("(cast(weight as decimal(19,0)) * cast(_open as decimal(19,0))) div _over")
    return rows.withColumn("given", F.when(F.col("_full"), F.col("capacity")).otherwise(part)).drop(
        "_left", "_weights", "_full", "_open", "_over"
    )


def _weight(level: str, weights: dict[str, int]) -> Column:
    """The weight of a node's name, 1 where none is set."""
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: Column, epochs: int) -> DataFrame:
    """``levels``, ``supply``, ``given`` for each leaf with tokens; ``budget`` may read ``total``."""
    leaves = leaves.filter("supply > 0").withColumn("_root", F.lit(0))
    for level in levels:
        leaves = leaves.filter(_weight(level, weights.get(level, {})) > 0)
    leaves = stage(leaves)
    above = leaves.groupBy("_root").agg(F.sum("supply").alias("total")).select("_root", budget.cast("long").alias("budget"))
    for depth, level in enumerate(levels, 1):
        parent = ["_root", *levels[: depth - 1]]
        nodes = leaves.groupBy(*parent, level).agg((F.sum("supply") * epochs).alias("capacity"))
        nodes = nodes.join(above, parent).withColumn("weight", _weight(level, weights.get(level, {})))
        given = share_out(nodes, parent, level)
        above = given.select(*parent, level, F.col("given").alias("budget"))
    return leaves.join(above, ["_root", *levels]).select(*levels, "supply", F.col("budget").alias("given"))


def _order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")))


def mix_sources(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    budget: Column,
    epochs: int = EPOCHS,
    seed: int = SEED,
    tokens: Column | None = None,
    doc_id: str = "doc_id",
) -> DataFrame:
    """The selected rows of ``docs``, once for each epoch that takes them, with ``epoch`` (from 1).

    ``levels`` names the tree's levels from the root and how a row gets its node (null: ``none``);
    ``weights`` has positive integers by level and name, 1 where unset and 0 to leave a node out;
    ``budget`` is in tokens and may use ``total``, all tokens of the tree. ``tokens`` counts a row's
    tokens (words of ``text`` by default). Rows of one id share their place in an epoch's order and
    are taken together. A row without tokens is taken where its place falls into the prefix. A leaf
    without tokens gives nothing. Columns of ``docs`` stay, but ``epoch`` is replaced. Repeated rows
    are rows like others; a very long text is a row of many tokens; an empty table gives no rows.
    """
    names = fresh(docs, *[f"_level_{k}" for k in range(len(levels))])
    node = dict(zip(names, (F.coalesce(c.cast("string"), F.lit("none")) for c in levels.values())))
    named = {n: weights.get(level, {}) for n, level in zip(names, levels)}
    counted = tokens if tokens is not None else word_tokens()
    slim = stage(docs.withColumns(node).select(*names, F.col(doc_id).alias("_id"), counted.alias("_tokens")))
    leaves = slim.groupBy(*names).agg(F.sum("_tokens").alias("supply"))
    leaves = stage(
        leaf_budgets(leaves, names, named, budget, epochs).withColumns(
            {"whole": F.expr("given div supply"), "rest": F.expr("given % supply")}
        )
    )
    keyed = slim.join(leaves, names).withColumn("_key", _order_key(seed, F.col("whole") + 1, F.col("_id")))
    keyed = keyed.withColumn("_range", F.substr("_key", F.lit(1), F.lit(3)))
    sums = keyed.groupBy(*names, "rest", "_range").agg(F.sum("_tokens").alias("n"))
    so_far = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        sums.withColumn("upto", F.sum("n").over(so_far))
        .filter("upto > rest")
        .groupBy(*names)
        .agg(F.min(F.struct("_range", (F.col("upto") - F.col("n")).alias("base"))).alias("cut"))
        .select(*names, "cut.*")
    )
    cuts = stage(cuts)
    in_order = Window.partitionBy(*names).orderBy("_key")  # rows of one key are peers
    last = (
        keyed.join(cuts, [*names, "_range"])
        .withColumn("upto", F.col("base") + F.sum("_tokens").over(in_order))
        .filter("upto <= rest")
        .groupBy(*names)
        .agg(F.max("_key").alias("last"))
    )
    taken = leaves.join(cuts, names, "left").join(last, names, "left")
    taken = stage(taken.select(*names, "whole", F.coalesce("last", "_range").alias("last")))
    given = docs.drop("epoch")
    whole, end, times = fresh(given.withColumns(node), "_whole", "_last", "_times")
    chosen = given.withColumns(node).join(taken.withColumnsRenamed({"whole": whole, "last": end}), names)
    part = (_order_key(seed, F.col(whole) + 1, F.col(doc_id)) <= F.col(end)).cast("int")
    chosen = chosen.withColumn(times, (F.col(whole) + F.coalesce(part, F.lit(0))).cast("int")).filter(F.col(times) > 0)
    return chosen.select(*columns_of(given), F.explode(F.sequence(F.lit(1), F.col(times))).alias("epoch"))
