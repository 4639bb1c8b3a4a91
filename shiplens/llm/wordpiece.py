"""Token counts by greedy longest match, in one pass over each word.

A trie of the vocabulary gets failure links: where a word leaves the trie at a node, the pieces
that a greedy longest match has settled by then are popped at once and the match goes on at the
linked node. Only the number of popped pieces is kept, so lengths come without building pieces,
in time linear in the word even where it has no white space at all.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import row_key, slices, text_or_empty

#: Words a task remembers before it starts afresh.
MEMORY = 1 << 19


class LongestMatch:
    """Counts the pieces of words; ``first`` pieces may begin a word, ``rest`` may go on."""

    def __init__(self, first: Iterable[bytes], rest: Iterable[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        self.ends = [False, False]
        starts, goes_on = set(first), set(rest)
        for root, pieces in ((0, starts), (1, goes_on)):
            for piece in pieces:
                self._add(root, piece)
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        self._link()
        self.known: dict[bytes, int] = {}

    def _add(self, node: int, piece: bytes) -> None:
        if not piece:
            return
        for c in piece:
            after = self.next[node].get(c)
            if after is None:
                after = self.next[node][c] = len(self.next)
                self.next.append({})
                self.ends.append(False)
            node = after
        self.ends[node] = True

    def _link(self) -> None:
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for c, node in self.next[parent].items():
                if self.ends[node]:
                    self.fail[node], self.popped[node] = 1, 1
                else:
                    at, n = self.fail[parent], self.popped[parent]
                    while at >= 0 and c not in self.next[at]:
                        n += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.next[at][c], n
                queue.append(node)

    def count(self, word: bytes) -> int:
        """Pieces of the word; 1 (an unknown token) where no greedy match reaches its end."""
        at = n = 0
        for c in word:
            after = self.next[at].get(c)
            while after is None:
                n += self.popped[at]
                at = self.fail[at]
                if at < 0:
                    return 1
                after = self.next[at].get(c)
            at = after
        while at != 1:
            n += self.popped[at]
            at = self.fail[at]
            if at < 0:
                return 1 if word else 0
        return n

    def counts(self, words: list[bytes], mark: bytes) -> int:
        known, total = self.known, 0
        for w in words:
            n = known.get(w)
            if n is None:
                if len(known) >= MEMORY:
                    known.clear()
                n = self.count(mark + w)
                if len(w) <= 64:
                    known[w] = n
            total += n
        return total


def split_vocabulary(pieces: Iterable[bytes], mark: bytes, continues: bytes) -> tuple[list[bytes], list[bytes]]:
    """Pieces that may begin a word and pieces that may go on.

    With ``continues`` (such as ``##``) the pieces that have it go on and the others begin. With
    ``mark`` (a blank before each word) all pieces may do both, as only the first holds the mark.
    """
    pieces = [p for p in pieces if p]
    if continues:
        return [p for p in pieces if not p.startswith(continues)], [
            p[len(continues) :] for p in pieces if p.startswith(continues) and len(p) > len(continues)
        ]
    return pieces, [p for p in pieces if not (mark and p.startswith(mark))]


@lru_cache(maxsize=4)
def _automaton(pieces: tuple[bytes, ...], mark: bytes, continues: bytes) -> LongestMatch:
    return LongestMatch(*split_vocabulary(pieces, mark, continues))


def ranked_vocabulary(spark: SparkSession, path: str) -> list[bytes]:
    """The pieces of a ranks file, one base64 piece and its rank a line (some 50,000 lines)."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def token_counts(
    docs: DataFrame,
    pieces: list[bytes],
    mark: bytes = b" ",
    continues: bytes = b"",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``row_key``, ``n_words``, ``n_tokens`` of each row of ``docs``.

    Words are runs without ASCII white space; each is preceded by ``mark`` and matched greedily in
    UTF-8. A word that no pieces cover is one token. Null and empty texts have none; repeated rows
    are returned as often as given; further columns are ignored; an empty table gives no rows. The
    work is linear in a text, whatever its length. The vocabulary is part of the
    task and must be of a tokenizer's usual size.
    """
    if len(pieces) > 2_000_000:
        raise ValueError("a vocabulary of over two million pieces is not shipped with a task")
    vocabulary = tuple(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(vocabulary, mark, continues)
        for batch in slices(batches, "text"):
            words, tokens = [], []
            for x in batch.column("text").cast(pa.binary()):
                found = x.as_buffer().to_pybytes().split()
                words.append(len(found))
                tokens.append(machine.counts(found, mark))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "row_key", "n_words", "n_tokens"],
            )

    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), text_or_empty(text).alias("text")
    )
    return slim.mapInArrow(run, "doc_id long, row_key long, n_words long, n_tokens long")
