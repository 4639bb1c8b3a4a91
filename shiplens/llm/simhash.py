"""SimHash near-duplicates, found by pigeonring chains.

A fingerprint is a ring of ``segments`` equal pieces. Where two fingerprints differ in at most
``limit`` bits, there is a piece from which the differences of the first k pieces, added up, stay
within k * limit / segments for every k. The pieces of such a chain whose budget is below one
must be equal, so they are the key of an equi-join, one for each starting piece; the rest of the
chain prunes what the key brings together, and its last step is the full check.

Equal texts have equal fingerprints, so only distinct fingerprints are compared. Where one key
gathers more than ``dense`` of them (a tight cluster of near copies), its fingerprints are not
paired: each is linked to the 64 fingerprints that differ in one bit and to itself. Two of them
share such a neighbour exactly if they differ in two bits at most, so the clusters are the same
and the work is proportional to their members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import columns_of, drop_rows, fresh, row_key, slices, stage, text_or_empty
from shiplens.llm.components import connected_components

SHINGLE = 3
SEED = 42
LIMIT = 2
SEGMENTS = 16
DENSE = 512


def text_fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of one UTF-8 text: the majority bit over its word shingles."""
    from xxhash import xxh64_intdigest

    # bytes.lower() and bytes.split() know ASCII only: A-Z, and blank, \t, \n, \v, \f, \r.
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxh64_intdigest(b" ".join(words), seed)
    set_bits = np.zeros(64, dtype=np.int64)
    n = len(words) - width + 1
    for start in range(0, n, 1 << 15):
        part = words[start : min(start + (1 << 15), n) + width - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(width))))
        hashes = np.fromiter((xxh64_intdigest(x, seed) for x in shingles), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        prints = [text_fingerprint(x.as_buffer().to_pybytes()) for x in batch.column("text").cast(pa.binary())]
        prints = np.array(prints, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(prints)],
            names=[*batch.schema.names[:-1], "fingerprint"],
        )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_key``, ``fingerprint`` (its 64 bits as a long) of every row."""
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), text_or_empty(text).alias("text")
    )
    return slim.mapInArrow(_fingerprint_batches, "doc_id long, row_key long, fingerprint long")


def _rotated(bits: Column, by: int) -> Column:
    if by == 0:
        return bits
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, 64 - by))


def chain_budgets(segments: int, limit: int) -> list[int]:
    """Differences allowed in the first 1, 2, ... pieces of a chain."""
    return [k * limit // segments for k in range(1, segments + 1)]


def near_pairs(prints: DataFrame, limit: int = LIMIT, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Edges ``u``, ``v`` that connect the distinct longs ``fp`` just as links of ``limit`` bits do.

    An edge is a link itself, or leads from a fingerprint of a dense key to a one-bit neighbour
    that stands for the links through it (``limit`` must then be 2).
    """
    if 64 % segments or not limit < segments:
        raise ValueError("segments must divide 64 and exceed the limit")
    width = 64 // segments
    budgets = chain_budgets(segments, limit)
    equal = sum(1 for b in budgets if b == 0)
    key = [
        F.shiftrightunsigned(_rotated(F.col("fp"), s * width), 64 - equal * width) for s in range(segments)
    ]
    rows = prints.select("fp", F.posexplode(F.array(*key)).alias("start", "key"))
    full = stage(rows.groupBy("start", "key").agg(F.count("*").alias("n")).filter(F.col("n") > 1))
    shared = stage(rows.join(full, ["start", "key"]))

    thin = shared.filter(F.col("n") <= dense)
    a = thin.select("start", "key", F.col("fp").alias("u"))
    b = thin.select("start", "key", F.col("fp").alias("v"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    # A chain starts at any piece: turn the difference so that this piece comes first.
    by = F.col("start") * width
    turned = F.when(by == 0, differ).otherwise(
        F.expr(f"shiftleft(u ^ v, start * {width}) | shiftrightunsigned(u ^ v, 64 - start * {width})")
    )
    in_budget = F.lit(True)
    for k in range(equal + 1, segments + 1):
        if k < segments and budgets[k] == budgets[k - 1]:
            continue  # the next piece has the same budget and says more
        head = turned if k == segments else F.shiftrightunsigned(turned, 64 - k * width)
        in_budget = in_budget & (F.bit_count(head) <= budgets[k - 1])
    links = a.join(b, ["start", "key"]).filter((F.col("u") < F.col("v")) & in_budget).select("u", "v")

    crowded = shared.filter(F.col("n") > dense).select("fp").distinct()
    if limit != 2:
        if not crowded.isEmpty():
            raise ValueError("dense keys are linked exactly for a limit of 2 only; raise `dense`")
        return links.distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)])
    around = crowded.select(F.col("fp").alias("u"), F.explode(flips).alias("v"))
    return links.union(around).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _grouped(docs: DataFrame, limit: int, segments: int, dense: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``row_key``, ``fingerprint``, ``component_id``, ``cluster`` (a fingerprint of the group)."""
    prints = stage(fingerprints(docs, doc_id, text))
    classes = stage(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_id")))
    parts = stage(connected_components(near_pairs(classes.select("fp"), limit, segments, dense)))
    first = (
        classes.join(parts, classes.fp == parts.node)
        .groupBy("component")
        .agg(F.min("first_id").alias("component_id"))
    )
    named = classes.join(parts, classes.fp == parts.node, "left").select("fp", "first_id", "component")
    named = named.join(first, "component", "left").select(
        F.col("fp").alias("fingerprint"),
        F.coalesce("component_id", "first_id").alias("component_id"),
        F.coalesce("component", "fp").alias("cluster"),
    )
    # Both sides are tables, so a fingerprint that a third of all rows have is split.
    return prints.join(stage(named), "fingerprint")


def simhash_groups(
    docs: DataFrame, limit: int = LIMIT, segments: int = SEGMENTS, dense: int = DENSE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``row_key``, ``fingerprint`` (hex), ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``limit`` bits. A null
    or empty text has fingerprint zero and is linked like any other. A repeated row is returned as
    often as it is given. A null doc_id gets the component of its group, null if no row of the
    group has an id. An empty table gives no rows. Further columns are ignored.
    """
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return _grouped(docs, limit, segments, dense, doc_id, text).select(
        "doc_id", "row_key", hexed.alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, limit: int = LIMIT, segments: int = SEGMENTS, dense: int = DENSE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id.

    Where rows share that id, the one with the smallest row key stays, and of equal rows a single
    one. Null ids come last. The columns and any further ones are those of ``docs``. Texts
    are read whole; an empty table gives no rows.
    """
    rows = stage(_grouped(docs, limit, segments, dense, doc_id, text))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    best = stage(rows.groupBy("cluster").agg(F.min(order)["row_key"].alias("_key")))
    again = stage(
        rows.groupBy(F.col("row_key").alias("_key")).agg(F.count("*").alias("n")).filter("n > 1")
        .join(best, "_key", "left_semi").select("_key")
    )
    out = rows.select(F.col("row_key").alias("_key")).join(best, "_key", "left_anti").distinct()
    key = row_key(doc_id, text)
    single = drop_rows(docs, stage(out.union(again)), key)
    (name,) = fresh(docs, "_key")
    held = docs.withColumn(name, key).join(again.withColumnRenamed("_key", name), name, "left_semi")
    return single.union(held.dropDuplicates([name]).select(*columns_of(docs)))
