"""The trie of conversation prefixes, summed over its subtrees by the Euler-tour technique.

A node is a distinct sequence of first turns; it is named by its smallest conversation and its depth.
Every node gets an enter and an exit arc. The arc after ``enter`` is the first child's ``enter``, or
the own ``exit``; after ``exit`` comes the next sibling's ``enter``, or the parent's ``exit``. This is
one list over all arcs. It is ranked in two steps: each task joins the stretches of the list whose
arcs lie in its block of nodes, then rounds of random mating let elements absorb their successors
until few are left, and undo that in reverse. What a rank adds up are arcs, leaves and savings, so
each arc learns its position and the sums before it, and a subtree is the difference of its two arcs.

No step needs all rows of one key in a task. Rows are laid out by ranges; running counts and running
keys are taken within a range, and what the ranges before it hold of the same key is added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.llm.common import stage

#: Nodes whose arcs are joined at once in a task, and elements that one task ranks at the end.
BLOCK = 1 << 18
FEW = 1 << 16
#: Conversation ids of one text piece of the digest.
IDS = 1024


def _laid_out(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` by ranges of the keys, with the number of the range as ``_range``."""
    return stage(rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))


def _before(laid: DataFrame, group: list[str], total: Column, running) -> DataFrame:
    """For groups in several ranges: ``_carry``, what ``running`` makes of the totals of earlier ranges."""
    parts = laid.groupBy("_range", *group).agg(total.alias("_total"))
    spread = Window.partitionBy(*group)
    earlier = spread.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_range", *group, running(F.col("_total")).over(earlier).alias("_carry")).filter("_carry is not null")


def ordered_turns(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``h1``, ``h2`` (of role and text), ``n_bytes`` of each turn.

    Turns are ordered by ``turn``, nulls first; ties by a hash of role and text. Null role or text is
    an empty one. Rows without a conversation id belong to none and are left out.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    slim = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("_turn"),
        F.xxhash64(by, said).alias("h1"),
        F.xxhash64(F.lit(1), said, F.lit(2), by).alias("h2"),
        F.octet_length(said).cast("long").alias("n_bytes"),
    )
    laid = _laid_out(slim, "conv_id", "_turn", "h1", "h2")
    here = Window.partitionBy("_range", "conv_id").orderBy("_turn", "h1", "h2")
    earlier = _before(laid, ["conv_id"], F.count("*"), F.sum)
    numbered = laid.withColumn("_n", F.row_number().over(here)).join(earlier, ["_range", "conv_id"], "left")
    return numbered.select("conv_id", (F.col("_n") + F.coalesce("_carry", F.lit(0))).alias("pos"), "h1", "h2", "n_bytes")


def _prefix_keys(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, the keys ``k1``, ``k2`` of its first turns and ``p1``, ``p2`` of one less."""
    marked = turns.select(
        "conv_id", F.col("pos").alias("depth"), "n_bytes",
        F.xxhash64("pos", "h1", "h2").alias("m1"), F.xxhash64("h2", "pos", "h1").alias("m2"),
    )
    laid = _laid_out(marked, "conv_id", "depth")
    here = Window.partitionBy("_range", "conv_id").orderBy("depth")
    out = laid.withColumns({f"k{i}": F.bit_xor(f"m{i}").over(here) for i in (1, 2)})
    for i in (1, 2):
        earlier = _before(laid, ["conv_id"], F.bit_xor(f"m{i}"), F.bit_xor).withColumnRenamed("_carry", f"_c{i}")
        out = out.join(earlier, ["_range", "conv_id"], "left")
    whole = [F.col(f"k{i}").bitwiseXOR(F.coalesce(f"_c{i}", F.lit(0).cast("long"))) for i in (1, 2)]
    return out.select(
        "conv_id", "depth", "n_bytes",
        *[k.alias(f"k{i}") for i, k in enumerate(whole, 1)],
        *[k.bitwiseXOR(F.col(f"m{i}")).alias(f"p{i}") for i, k in enumerate(whole, 1)],
    )


KEY = ["depth", "k1", "k2"]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per key over pieces that come in order; only the state of one hash is held."""
    key = state = None

    def out():
        columns = [[key[0]], [key[1]], [key[2]], [state.hexdigest()]]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*KEY, "ends_sha256"])

    for batch in batches:
        for depth, k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if key != (depth, k1, k2):
                if key is not None:
                    yield out()
                key, state = (depth, k1, k2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if key is not None:
        yield out()


def _end_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` per key of the conversations that end there.

    A digest takes its ids one after the other, so those of one key are hashed in one task, piece
    by piece; the pieces are put together before.
    """
    pieces = (
        ends.groupBy(*KEY, F.floor(F.col("conv_id") / IDS).alias("_piece"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "_piece").select(*KEY, "ids")
    return ordered.mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


_SUMS = ("arcs", "leaves", "saved")
_ARC = ("c", "d", "x")


def _chains(after: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a set of lists given by successors (-1 at ends): the first element of each one's list
    and the weights before it, by doubling."""
    n = len(after)
    first = np.arange(n)
    sums = np.zeros_like(weights)
    inner = np.flatnonzero(after >= 0)
    first[after[inner]] = inner
    sums[after[inner]] = weights[inner]
    while True:
        further = first[first]
        sums += np.where((first != np.arange(n))[:, None], sums[first], 0)
        if (further == first).all():
            return first, sums
        first = further


def _join_arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of nodes in; nodes with the places of their arcs and the joined stretches out."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            yield from _joined(pa.Table.from_batches(held))
            held, rows = [], 0
    if rows:
        yield from _joined(pa.Table.from_batches(held))


_NODE_ARCS = [f"{a}_{k}" for a in ("enter", "exit") for k in (*_ARC, *_SUMS)]
_JOINED = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "depth", *_NODE_ARCS, *_ARC, *(f"n{k}" for k in _ARC), *_SUMS)]
)
JOINED = ", ".join(f"{f.name} long" for f in _JOINED)


def _joined(nodes: pa.Table) -> Iterator[pa.RecordBatch]:
    get = lambda name: nodes.column(name).to_numpy(zero_copy_only=False)
    whole = lambda name: nodes.column(name).fill_null(0).to_numpy().astype(np.int64)
    has = lambda name: nodes.column(name).is_valid().to_numpy(zero_copy_only=False)
    c, d = get("conv_id"), get("depth")
    m = len(c)
    names, rank = np.unique(c, return_inverse=True)
    wide = int(d.max()) + 2
    keys = rank * wide + d
    order = np.argsort(keys)

    def place(cc, dd, there):
        """The row of each node (cc, dd) in this block, -1 where it is elsewhere or not ``there``."""
        at = np.minimum(np.searchsorted(names, cc), len(names) - 1)
        there = there & (names[at] == cc) & (dd < wide)
        want = at * wide + dd
        k = np.minimum(np.searchsorted(keys[order], want), m - 1)
        return np.where(there & (keys[order][k] == want), order[k], -1)

    child, sibling, parent = whole("first_child"), whole("sibling"), whole("parent_conv_id")
    has_child, has_sibling, has_parent = has("first_child"), has("sibling"), has("parent_conv_id")
    # Arc 2 i enters node i, arc 2 i + 1 leaves it. What follows, by name:
    next_c, next_d, next_x = (np.empty(2 * m, dtype=np.int64) for _ in range(3))
    next_c[0::2], next_d[0::2], next_x[0::2] = np.where(has_child, child, c), np.where(has_child, d + 1, d), ~has_child
    next_c[1::2] = np.where(has_sibling, sibling, parent)
    next_d[1::2] = np.where(has_sibling, d, d - 1)
    next_x[1::2] = ~has_sibling
    ends = np.zeros(2 * m, dtype=bool)
    ends[1::2] = ~has_sibling & ~has_parent
    at = place(next_c, next_d, ~ends)
    after = np.where(at >= 0, 2 * at + next_x, -1)

    weights = np.zeros((2 * m, 3), dtype=np.int64)
    weights[:, 0] = 1
    weights[0::2, 1] = ~has_child
    weights[0::2, 2] = whole("saving")
    first, sums = _chains(after, weights)

    def columns(values: dict[str, np.ndarray], n: int, gone: np.ndarray | None = None):
        arrays = []
        for f in _JOINED:
            if f.name in values:
                mask = gone if gone is not None and f.name in ("nc", "nd", "nx") else None
                arrays.append(pa.array(values[f.name], pa.int64(), mask=mask))
            else:
                arrays.append(pa.nulls(n, pa.int64()))
        return pa.RecordBatch.from_arrays(arrays, schema=_JOINED)

    out = {"conv_id": c, "depth": d}
    for k, name in enumerate(("enter", "exit")):
        head = first[k::2]
        out |= {f"{name}_c": c[head // 2], f"{name}_d": d[head // 2], f"{name}_x": head % 2}
        out |= {f"{name}_{s}": sums[k::2, j] for j, s in enumerate(_SUMS)}
    yield columns(out, m)
    tail = np.flatnonzero(after < 0)
    head = first[tail]
    out = {"c": c[head // 2], "d": d[head // 2], "x": head % 2, "nc": next_c[tail], "nd": next_d[tail], "nx": next_x[tail]}
    out |= {s: sums[tail, j] + weights[tail, j] for j, s in enumerate(_SUMS)}
    yield columns(out, len(tail), ends[tail])


RANKS = "c long, d long, x long, " + ", ".join(f"{s} long" for s in _SUMS)


def _rank_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    rows = table.to_pydict()
    place = {k: i for i, k in enumerate(zip(rows["c"], rows["d"], rows["x"]))}
    after = np.array([place.get(k, -1) for k in zip(rows["nc"], rows["nd"], rows["nx"])], dtype=np.int64)
    _, sums = _chains(after, np.array([rows[s] for s in _SUMS], dtype=np.int64).T.copy())
    arrays = [table.column(k).combine_chunks() for k in _ARC] + [pa.array(sums[:, j]) for j in range(3)]
    yield pa.RecordBatch.from_arrays(arrays, names=[*_ARC, *_SUMS])


def list_ranks(elements: DataFrame, few: int = FEW) -> DataFrame:
    """``c``, ``d``, ``x`` and the sums before it of each element of one list.

    An element has its name ``c``, ``d``, ``x``, its successor's ``nc``, ``nd``, ``nx`` (null at the
    end) and three weights. In a round the elements that draw tails absorb a successor that draws
    heads, a quarter of all; each has one predecessor, so no key of the join has more than one row.
    """
    here, there = [F.col(k) for k in _ARC], [F.col(f"n{k}") for k in _ARC]
    nexts = [f"n{k}" for k in _ARC]
    now, absorbed, turn = stage(elements.select(*_ARC, *nexts, *_SUMS)), [], 0
    while now.count() > few:
        heads = lambda names: F.xxhash64(F.lit(turn), *names).bitwiseAND(F.lit(1)) == 1  # noqa: B023, E731
        takes = now.filter(~heads(here) & F.col("nc").isNotNull() & heads(there))
        given = now.filter(heads(here))
        rest = now.filter(~heads(here) & ~(F.col("nc").isNotNull() & heads(there)))
        by = takes.select(*[F.col(f"n{k}").alias(k) for k in _ARC], *[F.col(k).alias(f"b{k}") for k in _ARC], *[F.col(s).alias(f"b{s}") for s in _SUMS])
        both = stage(given.join(by, list(_ARC), "left"))
        alone = F.col("bc").isNull()
        left = both.select(
            *[F.when(alone, F.col(k)).otherwise(F.col(f"b{k}")).alias(k) for k in _ARC], *nexts,
            *[F.when(alone, F.col(s)).otherwise(F.col(s) + F.col(f"b{s}")).alias(s) for s in _SUMS],
        )
        absorbed.append(both.filter(~alone).select(*_ARC, *[f"b{k}" for k in _ARC], *[f"b{s}" for s in _SUMS]))
        now = stage(rest.union(left))
        turn += 1
    ranks = now.repartition(1).mapInArrow(_rank_few, RANKS)
    for gone in reversed(absorbed):
        known = stage(ranks)
        by = known.select(*[F.col(k).alias(f"b{k}") for k in _ARC], *_SUMS)
        more = gone.join(by, [f"b{k}" for k in _ARC]).select(*_ARC, *[(F.col(s) + F.col(f"b{s}")).alias(s) for s in _SUMS])
        ranks = known.union(more)
    return ranks


def prefix_trie(turns: DataFrame, conversations: DataFrame, few: int = FEW) -> DataFrame:
    """One row per node of the trie of ``turns`` (as ``ordered_turns`` returns them).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and ``enter`` and ``exit``, the
    positions of its arcs on the tour: a node lies below another if its positions lie between the
    other's. ``conversations`` (``conv_id``, once each) are all members of the root, with turns or not.
    Without conversations there is no node. Equal conversations share their nodes.
    """
    keys = stage(_prefix_keys(turns))
    grouped = keys.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    nothing = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        *[nothing.alias(k) for k in KEY], "conv_id", "n_convs", nothing.alias("n_bytes"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2")
    )
    named = stage(grouped.withColumn("depth", F.col("depth").cast("long")).unionByName(root))
    above = named.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = stage(named.join(above, ["depth", "p1", "p2"], "left").drop("p1", "p2"))

    inner = nodes.filter("parent_conv_id is not null")
    children = inner.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first_child")
    )
    family = ["parent_conv_id", "depth"]
    laid = _laid_out(inner.select(*family, "conv_id"), *family, "conv_id")
    here = Window.partitionBy("_range", *family)
    # Of a family in several ranges the last child of one is followed by the first of the next.
    firsts = laid.groupBy("_range", *family).agg(F.min("conv_id").alias("_first"))
    later = firsts.select("_range", *family, F.lead("_first").over(Window.partitionBy(*family).orderBy("_range")).alias("_later")).filter("_later is not null")
    siblings = (
        laid.withColumn("_next", F.lead("conv_id").over(here.orderBy("conv_id")))
        .join(later, ["_range", *family], "left")
        .select("conv_id", "depth", F.coalesce("_next", "_later").alias("sibling"))
    )
    linked = stage(
        nodes.join(children, ["conv_id", "depth"], "left").join(siblings, ["conv_id", "depth"], "left").select(
            *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", nothing).alias("n_children"), "first_child", "sibling",
            ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saving"),
        )
    )

    tour = linked.select("conv_id", "depth", "parent_conv_id", "first_child", "sibling", "saving")
    joined = stage(tour.repartitionByRange("conv_id", "depth").mapInArrow(_join_arcs, JOINED))
    ranks = stage(list_ranks(joined.filter("c is not null"), few))
    arcs = joined.filter("conv_id is not null").select("conv_id", "depth", *_NODE_ARCS)
    for arc in ("enter", "exit"):
        start = ranks.select(*[F.col(k).alias(f"{arc}_{k}") for k in _ARC], *[F.col(s).alias(f"_{s}") for s in _SUMS])
        arcs = arcs.join(start, [f"{arc}_{k}" for k in _ARC]).withColumns(
            {f"{arc}_{s}": F.col(f"{arc}_{s}") + F.col(f"_{s}") for s in _SUMS}
        ).drop(*[f"_{s}" for s in _SUMS])
    sums = arcs.select(
        "conv_id", "depth",
        (F.col("exit_leaves") - F.col("enter_leaves")).alias("n_leaves"), (F.col("exit_saved") - F.col("enter_saved")).alias("saved_tokens"),
        F.col("enter_arcs").alias("enter"), F.col("exit_arcs").alias("exit"),
    )

    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("depth"))
    ending = keys.join(lengths, ["conv_id", "depth"], "left_semi").select(F.col("depth").cast("long").alias("depth"), "k1", "k2", "conv_id")
    turnless = conversations.join(lengths, "conv_id", "left_anti").select(*[nothing.alias(k) for k in KEY], "conv_id")
    digests = _end_digests(ending.union(turnless))
    return (
        linked.join(sums, ["conv_id", "depth"]).join(digests, KEY, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "enter", "exit")
    )


def conversation_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", few: int = FEW
) -> DataFrame:
    """``prefix_trie`` of conversations as they are given.

    Null role or text is an empty one, null turns come first, rows of equal turn are ordered by a
    hash of role and text, repeated rows are turns of their own. Rows without a conversation id are
    left out. Texts of any length count by their hash. An empty table gives no rows. Further columns
    are ignored.
    """
    ordered = stage(ordered_turns(turns, conv_id, turn, role, text))
    return prefix_trie(ordered, ordered.select("conv_id").distinct(), few)


def rebuilt_turns(ordered: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Each conversation with the head of its family's first one, and all conversations.

    Conversation c begins with the first h turns of c - c % family (h: crc32 of c % ``most``), which
    may be absent, and goes on with its own turns after its first h.
    """
    sizes = ordered.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    of = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), h.alias("h"))
    heads = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    of = stage(of.join(heads, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("head")))
    told = ["h1", "h2", "n_bytes"]
    first = ordered.filter((F.col("pos") < most) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    taken = first.join(of.filter("h > 0"), "base").filter("pos <= h").select("conv_id", "pos", *told)
    own = ordered.join(of, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), *told)
    return taken.union(own), of.select("conv_id")
