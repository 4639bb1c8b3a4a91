"""Benchmark decontamination by greedy string tiling.

Token windows of ``SEED_WORDS`` words that an item shares with a document are its seeds, found by a
running Karp-Rabin hash. A match starts where the words before a shared seed differ and goes on as far
as running hashes agree; the longest match that overlaps no tile becomes a tile, again and again, where
the free parts of a cut match stay in the race. As tiles may lie in any order, a reordered passage is
covered like a straight one. An item whose tiles cover enough of its words is leaked into the document.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import row_key, slices, text_or_empty

SEED_WORDS = 5
COVERAGE = 0.8
#: Bytes of benchmark text that one pass over the documents carries along.
BLOCK_BYTES = 32 << 20

#: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han, whose words have no blanks between.
UNSPACED = r"\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def rolling_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each window of ``width`` ids."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    x = (ids.astype(np.int64) + 2).view(np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * _BASE + x[k : k + n]
    return out


def greedy_tiles(
    matches: list[tuple[int, int, int]], least: int, item: np.ndarray, doc: np.ndarray
) -> list[tuple[int, int, int]]:
    """Tiles (length, item place, document place) out of maximal matches, longest first.

    Ties go to the smaller item place, then the smaller document place. Each tile is compared word
    by word; once less than ``least`` words of the item are free, no further one can lie.
    """
    heap = [(-n, a, b) for n, a, b in matches]
    heapq.heapify(heap)
    item_free, doc_free = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool)
    left = len(item)
    tiles = []
    while heap and left >= least:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = item_free[a : a + n] & doc_free[b : b + n]
        if free.all():
            if np.array_equal(item[a : a + n], doc[b : b + n]):
                tiles.append((n, a, b))
                item_free[a : a + n] = doc_free[b : b + n] = False
                left -= n
            continue
        if np.count_nonzero(free) < least:
            continue
        free = free.tolist()
        k = 0
        while k < n:
            if not free[k]:
                k += 1
                continue
            start = k
            while k < n and free[k]:
                k += 1
            if k - start >= least:
                heapq.heappush(heap, (-(k - start), a + start, b + start))
    return tiles


class Benchmark:
    """The items of one block, their seeds sorted by hash."""

    def __init__(self, items: list[tuple[int, str]], seed_words: int, coverage: float):
        self.least, self.coverage = seed_words, coverage
        self.words: dict[str, int] = {}
        self.ids, self.items, self.short = [], [], {}
        for item, text in items:
            found = tokens(text)
            if not found:
                continue
            if len(found) < seed_words:
                self.short.setdefault(tuple(found), []).append(item)
                continue
            self.items.append(item)
            self.ids.append(np.array([self.words.setdefault(w, len(self.words)) for w in found], dtype=np.int64))
        hashes = [rolling_hashes(x, seed_words) for x in self.ids]
        none = np.empty(0, dtype=np.int64)
        every = np.concatenate([*hashes, none.view(np.uint64)])
        owner = np.concatenate([*(np.full(len(h), k) for k, h in enumerate(hashes)), none]).astype(np.int64)
        place = np.concatenate([*(np.arange(len(h)) for h in hashes), none]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        self.seeds, first, sizes = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.sizes = first, sizes
        self.owner, self.place = owner[order], place[order]

    def leaks(self, text: str) -> list[tuple[int, float, int]]:
        """(item, share of its words under tiles, number of tiles) where the share is enough."""
        found = tokens(text)
        if len(found) < self.least:
            return [(item, 1.0, 1) for item in self.short.get(tuple(found), ())]
        if not len(self.seeds):
            return []
        get = self.words.get
        ids = np.fromiter((get(w, -1) for w in found), dtype=np.int64, count=len(found))
        hashes = rolling_hashes(ids, self.least)
        at = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        hits = np.nonzero(self.seeds[at] == hashes)[0]
        if not len(hits):
            return []
        # Items first, by how much of them the seeds could cover at most; few get as far as tiles.
        seed = np.unique(at[hits])
        rows = np.concatenate([np.arange(self.first[s], self.first[s] + self.sizes[s]) for s in seed])
        out = []
        by_seed: dict[int, np.ndarray] | None = None
        for k in np.unique(self.owner[rows]):
            mine = rows[self.owner[rows] == k]
            item = self.ids[k]
            reach = np.zeros(len(item) + 1, dtype=np.int64)
            np.add.at(reach, self.place[mine], 1)
            np.add.at(reach, self.place[mine] + self.least, -1)
            if np.count_nonzero(np.cumsum(reach[:-1])) < self.coverage * len(item):
                continue
            if by_seed is None:
                order = np.argsort(at[hits], kind="stable")
                cut = np.unique(at[hits][order], return_index=True)
                by_seed = dict(zip(cut[0].tolist(), np.split(hits[order], cut[1][1:])))
            seed_of = np.searchsorted(self.first, mine, side="right") - 1
            starts = _starts(item, ids, seed_of, self.place[mine], by_seed)
            tiles = greedy_tiles(_matches(item, ids, starts), self.least, item, ids)
            share = sum(t[0] for t in tiles) / len(item)
            if share >= self.coverage:
                out.append((self.items[k], share, len(tiles)))
        return out


#: Pairs of places that are laid side by side at once.
PAIRS = 1 << 20


def _starts(item: np.ndarray, doc: np.ndarray, seed_of: np.ndarray, places: np.ndarray, by_seed: dict[int, np.ndarray]):
    """Blocks of (item places, document places) that share a seed and differ in the word before.

    Places with the same word before lie within a longer match, so a seed that repeats itself (la la
    la) is paired where a run begins and nowhere else.
    """
    order = np.argsort(seed_of, kind="stable")
    cuts = np.flatnonzero(np.diff(seed_of[order])) + 1
    for group in np.split(order, cuts):
        a, b = places[group], by_seed[int(seed_of[group[0]])]
        before_a = np.where(a > 0, item[a - 1], -2)
        before_b = np.where(b > 0, doc[b - 1], -3)
        for word in np.unique(before_a):
            mine, other = a[before_a == word], b[before_b != word]
            step = max(1, PAIRS // max(1, len(mine)))
            for k in range(0, len(other), step):
                part = other[k : k + step]
                yield np.repeat(mine, len(part)), np.tile(part, len(mine))


def _matches(item: np.ndarray, doc: np.ndarray, starts) -> list[tuple[int, int, int]]:
    """Length, item place and document place of the match from each start, by bisection on hashes."""
    x, y = ((w + 2).view(np.uint64) for w in (item, doc))
    power = np.ones(max(len(x), len(y)) + 1, dtype=np.uint64)
    np.cumprod(np.full(len(power) - 1, _BASE), out=power[1:])
    zero = np.zeros(1, dtype=np.uint64)
    hx = np.concatenate([zero, np.cumsum(x * power[: len(x)], dtype=np.uint64)])
    hy = np.concatenate([zero, np.cumsum(y * power[: len(y)], dtype=np.uint64)])
    out = []
    for a, b in starts:
        low, high = np.zeros(len(a), dtype=np.int64), np.minimum(len(x) - a, len(y) - b)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = (hx[a + middle] - hx[a]) * power[b] == (hy[b + middle] - hy[b]) * power[a]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        out += zip(low.tolist(), a.tolist(), b.tolist())
    return out


def leaked_items(
    docs: DataFrame,
    benchmark: DataFrame,
    seed_words: int = SEED_WORDS,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id``, ``row_key``, ``item_id``, ``coverage``, ``tiles`` for each leak.

    Words are lower-cased runs of letters, digits and underscores; in scripts without blanks each
    character is one. An item of fewer than ``seed_words`` words leaks only into a document of
    exactly its words; an item without words leaks nowhere. Null texts are empty. Repeated documents
    and repeated items are reported each; an empty table of either gives no rows. Texts are compared
    whole; repeated words in long ones cost no more than their runs.
    The benchmark goes to the tasks in blocks of at most ``block_bytes`` (or one longer item), one
    pass over the documents for each, so it may grow without any task holding more.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), text_or_empty(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // max(1, block_bytes // 2)))
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), text_or_empty(text).alias("text")
    )
    found = None
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        block = sorted(((r[0], r[1]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        rows = slim.mapInArrow(
            _finder(block, seed_words, coverage), "doc_id long, row_key long, item_id long, coverage double, tiles int"
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def _finder(block: list[tuple[int, str]], seed_words: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(block, seed_words, coverage)
        for batch in slices(batches, "text"):
            rows = []
            for doc, key, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                leaks = bench.leaks(text.as_py())
                rows += [(doc.as_py(), key.as_py(), *leak) for leak in leaks]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[i] for r in rows], kind)
                    for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()))
                ],
                names=["doc_id", "row_key", "item_id", "coverage", "tiles"],
            )

    return run
