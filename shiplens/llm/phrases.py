"""Document fingerprints by locally consistent parsing.

A text's bytes are the symbols of level zero. On each level runs of one symbol become a symbol of
their own, deterministic coin tossing (the lowest bit in which a symbol differs from the one before
it, and its value) shrinks the alphabet to six labels that differ from neighbour to neighbour, and a
phrase starts at each local maximum of the labels. Whether a place is one depends on a few symbols
around it only, so equal substrings are cut alike inside, wherever they stand. A phrase's name is a
hash of its symbols; the names are the next level's symbols, until one is left.

The fingerprint is a one-permutation min-hash sketch of all names from level ``LOWEST`` up: 64 bins
of 32 bits, which unrelated texts of a hundred megabytes do not fill up. The likeness of two fingerprints is the share of equal bins among those that either
fills, an estimate of how many phrases the texts share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import row_key, slices, text_or_empty

LOWEST = 2
BINS = 64
EMPTY = 0xFFFFFFFF
#: Rows of an id range, and id ranges at most.
RANGE_ROWS, RANGES = 2_000, 10_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _lowest_bit(bits: int) -> np.ndarray:
    """The number of the lowest set bit of each value of so many bits; ``bits`` for zero."""
    x = np.arange(1 << bits, dtype=np.int64)
    out = np.full(1 << bits, bits, dtype=np.uint8)
    for k in reversed(range(bits)):
        out[(x >> k) & 1 == 1] = k
    return out


_LOWEST = {np.dtype(np.uint8): _lowest_bit(8), np.dtype(np.uint16): _lowest_bit(16)}
_POWERS = np.cumprod(np.full(64, _A, dtype=np.uint64))


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 2 k + bit k, where k is the lowest bit that differs from the symbol before."""
    differ = np.empty_like(x)
    np.bitwise_xor(x[1:], x[:-1], out=differ[1:])
    differ[first] = 1  # before a text stands a symbol that differs in the lowest bit
    k = _LOWEST[x.dtype][differ]
    bit = ((x >> k.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)
    return (k << np.uint8(1)) | bit


def next_level(names: np.ndarray, sizes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and their number per text one level up; ``sizes`` are positive.

    Coins are tossed with the names' low 16 bits. Where two neighbours agree in all of these, their
    labels may agree too, and neither starts a phrase; that depends on the two names only.
    """
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    starts = np.ones(len(names), dtype=bool)
    np.not_equal(names[1:], names[:-1], out=starts[1:])
    starts[first] = True
    at = np.nonzero(starts)[0]
    x = names
    if len(at) < len(names):
        run = np.diff(np.append(at, len(names)))
        x = names[at]
        long_run = np.nonzero(run > 1)[0]
        x[long_run] = _mix(x[long_run] * _A + run[long_run].astype(np.uint64))
        # Where the texts begin among the symbols that are left.
        first = np.searchsorted(at, first)
    label = x.astype(np.uint16)
    for _ in range(4):
        label = _toss(label, first)
    label = label.astype(np.int8)
    rises = np.ones(len(label), dtype=bool)
    falls = np.ones(len(label), dtype=bool)
    np.greater(label[1:], label[:-1], out=rises[1:])
    np.greater(label[:-1], label[1:], out=falls[:-1])
    # Beyond either end of a text everything is lower.
    rises[first] = True
    falls[np.append(first[1:], len(label)) - 1] = True
    cut = rises & falls
    cut[first] = True
    at = np.nonzero(cut)[0]
    length = np.diff(np.append(at, len(x)))
    place = np.arange(len(x), dtype=np.int64) - np.repeat(at, length)
    sums = np.add.reduceat(x * _POWERS[np.minimum(place, 63)], at)
    up = _mix(sums ^ (length.astype(np.uint64) * _C + np.uint64(level)))
    begin = np.searchsorted(at, first)
    return up, np.diff(np.append(begin, len(at)))


def sketches(texts: list[bytes], lowest: int = LOWEST) -> np.ndarray:
    """One row of ``BINS`` values for each text; all bins of an empty text are ``EMPTY``."""
    out = np.full((len(texts), BINS), EMPTY, dtype=np.uint32)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    which = np.nonzero(sizes)[0]
    if not len(which):
        return out
    sizes = sizes[which]
    # Scattered names keep what is tossed first from being the alphabet's own order.
    table = _mix(np.arange(1, 257, dtype=np.uint64) * _A)
    names = table[np.frombuffer(b"".join(texts[i] for i in which), dtype=np.uint8)]
    flat = out.reshape(-1)
    level = 0
    while len(names):
        level += 1
        names, sizes = next_level(names, sizes, level)
        if level >= lowest:
            owner = np.repeat(which, sizes) * BINS
            value = ((names >> np.uint64(6)) % np.uint64(EMPTY)).astype(np.uint32)
            np.minimum.at(flat, owner + (names & np.uint64(BINS - 1)).astype(np.int64), value)
            # A text that is down to one symbol is done, whatever stands beside it.
            going = sizes > 1
            names, which, sizes = names[np.repeat(going, sizes)], which[going], sizes[going]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those that one of the sketches fills; 1 for two empty texts."""
    filled = (a != EMPTY) | (b != EMPTY)
    n = int(np.count_nonzero(filled))
    return float(np.count_nonzero((a == b) & filled) / n) if n else 1.0


def as_hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _by_range(rows: DataFrame, at: str) -> DataFrame:
    """``rows`` with ``part``, a range of ``at``; each range also gets the first rows of the next.

    The bounds are quantiles, at most ``RANGES``, in an array of arrays so that a row compares with
    a few of them only. The rows a range borrows have ``ahead`` = 1; the last range borrows from the
    first one.
    """
    n = rows.count()
    wide = int(min(RANGES, max(1, n // RANGE_ROWS)) ** 0.5) or 1
    parts = wide * wide
    found = rows.agg(F.percentile_approx(at, [(k + 1) / parts for k in range(parts)], max(10_000, parts * 20))).first()[0]
    # Range k holds the ids above bound k - 1 and up to bound k; above the last one, the last range.
    bounds = sorted(set(found or []))[:-1]
    inner = [bounds[k : k + wide] for k in range(0, len(bounds), wide)]
    if bounds:
        outer = F.array(*[F.lit(x[-1]) for x in inner[:-1]]).cast("array<bigint>")
        nested = F.array(*[F.array(*map(F.lit, x)).cast("array<bigint>") for x in inner])
        below = lambda c: F.size(F.filter(c, lambda b: b < F.col(at)))
        coarse = below(outer)
        part = coarse * wide + below(F.get(nested, coarse))
    else:
        part = F.lit(0)
    ranged = rows.withColumn("part", part)
    # At most RANGES rows.
    firsts = [tuple(r) for r in ranged.groupBy("part").agg(F.min(at)).collect()]
    firsts.sort()
    links = [(firsts[k][1], firsts[k - 1][0]) for k in range(len(firsts))]
    small = rows.sparkSession.createDataFrame(links, f"`{at}` long, before int")
    borrowed = ranged.join(F.broadcast(small), at).withColumn("part", F.col("before")).drop("before")
    return ranged.withColumn("ahead", F.lit(0)).unionByName(borrowed.withColumn("ahead", F.lit(1)))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of range, ahead, id: each with the row after it."""
    held = None
    for batch in slices(batches, "text"):
        parts, aheads = batch.column("part").to_pylist(), batch.column("ahead").to_pylist()
        ids, keys, texts = (batch.column(c).to_pylist() for c in ("doc_id", "row_key", "text"))
        own = sketches([t.encode() for t in texts])
        rows = [*([held] if held else []), *zip(parts, aheads, ids, keys, texts, own)]
        held = rows[-1]
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1]]
        new = [edited(a[4], b[4]) for a, b in pairs]
        theirs = sketches([t.encode() for t in new])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a[2] for a, _ in pairs], pa.int64()),
                pa.array([a[3] for a, _ in pairs], pa.int64()),
                pa.array([len(a[4]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                pa.array([as_hex(a[5]) for a, _ in pairs], pa.string()),
                pa.array([as_hex(s) for s in theirs], pa.string()),
                pa.array([likeness(a[5], s) for (a, _), s in zip(pairs, theirs)], pa.float64()),
                pa.array([likeness(a[5], b[5]) for a, b in pairs], pa.float64()),
            ],
            names=["doc_id", "row_key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that to the next.

    The next row is that of the next higher doc_id, after the last the first; a null id comes
    before all, rows of one id are in the order of their texts. Null texts are empty; two empty
    texts are alike (1), an empty and another one are not (0). Repeated rows are rows like others.
    Further columns are ignored. Each text moves once, to the task of its range of ids, and is read
    whole; an empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("at"),
        F.col(doc_id).cast("long").alias("doc_id"),
        row_key(doc_id, text).alias("row_key"),
        text_or_empty(text).alias("text"),
    )
    ordered = _by_range(rows, "at").repartition("part").sortWithinPartitions("part", "ahead", "at", "text")
    return ordered.select("part", "ahead", "doc_id", "row_key", "text").mapInArrow(
        _walk,
        "doc_id long, row_key long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def fingerprint_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_key``, ``fingerprint`` of each row; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = sketches([x.as_buffer().to_pybytes() for x in batch.column("text").cast(pa.binary())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([as_hex(s) for s in found], pa.string())],
                names=["doc_id", "row_key", "fingerprint"],
            )

    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), text_or_empty(text).alias("text")
    )
    return slim.mapInArrow(run, "doc_id long, row_key long, fingerprint string")


def fingerprint_likeness(a: Column, b: Column) -> Column:
    """``likeness`` of two fingerprint strings as a column expression."""
    places = F.sequence(F.lit(0), F.lit(BINS - 1))
    piece = lambda c, k: F.substr(c, k * 8 + 1, F.lit(8))
    filled = F.size(F.filter(places, lambda k: (piece(a, k) != "ffffffff") | (piece(b, k) != "ffffffff")))
    equal = F.size(F.filter(places, lambda k: (piece(a, k) == piece(b, k)) & (piece(a, k) != "ffffffff")))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled)
