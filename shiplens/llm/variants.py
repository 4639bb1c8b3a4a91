"""Spelling variants by finite-state composition: acceptor, one-edit transducer, acceptor.

The pairs of words at one edit are what the composition of the vocabulary acceptor with a one-edit
transducer and the acceptor again accepts. It is enumerated in partitions, each with initial states
of its own: a partition is the right language of the state behind one prefix (its words share the
first half and differ in the second) or, for edits in the first half, the left language of the state
before one suffix. Of two words of ``base`` and ``base`` or ``base + 1`` code points, the edit stands
at the end of what they share from the left, so it lies in exactly one of the two halves and each
pair comes from exactly one partition. A partition of more than ``most`` words is cut again at half
of what is left; one open code point is the end, where the alphabet bounds the words.

Inside a task the words of many partitions share one minimal acceptor (equal right languages are one
state), in which each partition has two initial states: for its words of the base length and for
those one longer.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import slices, stage, text_or_empty

#: Fixed values of the contract: what a run is, and which runs lose a code point.
RUN = rb"(?:[a-z]|\xc3[\x80-\xbf])+"
DROP_EVERY = 97
#: Words a task remembers before it hands on their counts.
MEMORY = 1 << 18
#: Bytes of a text that are cut into runs at once.
PIECE = 1 << 22
#: Words of a partition before it is cut again, and words for which an acceptor is built at once.
MOST = 20_000
BATCH = 20_000


def runs(text: bytes) -> Iterator[list[bytes]]:
    """The runs of a text, whose ASCII letters are lower-cased, in pieces of bounded size."""
    find = re.compile(RUN)
    if len(text) <= PIECE:
        yield find.findall(text.lower())
        return
    start = 0
    while start < len(text):
        stop = min(start + PIECE, len(text))
        if stop < len(text):
            # No run is cut: from the middle of one the piece goes on to its end.
            if text[stop] & 0xC0 == 0x80:
                stop += 1
            while rest := find.match(text[stop : stop + 4096].lower()):
                stop += rest.end()
        yield find.findall(text[start:stop].lower())
        start = stop


def damaged(prefix: int, run: bytes, drop_every: int = DROP_EVERY) -> bytes:
    """The run, less one code point if its hash after ``<doc_id>:`` (crc32 ``prefix``) says so."""
    h = zlib.crc32(run, prefix)
    if h % drop_every:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def vocabulary(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``word``, ``n`` of the words of all texts that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return batch

        for batch in batches:
            for part in slices(iter([batch]), "text"):
                for key, x in zip(part.column("id"), part.column("text").cast(pa.binary())):
                    prefix = zlib.crc32(key.as_buffer().to_pybytes() + b":")
                    for found in runs(x.as_buffer().to_pybytes()):
                        for run, n in Counter(found).items():
                            held[damaged(prefix, run)] += n
                if len(held) > MEMORY:
                    yield out()
        yield out()

    slim = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary").alias("id"), text_or_empty(text).alias("text"))
    parts = slim.mapInArrow(count, "word string, n long").filter(F.length("word") >= least_length)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Acceptor:
    """A minimal acceptor: states with equal right languages are one. State 0 accepts the end."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.final = [True]
        self._known: dict[tuple, int] = {(True,): 0}
        self._meets: dict[tuple[int, int], bool] = {}

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, *arcs.items())
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self.next)
            self.next.append(arcs)
            self.final.append(final)
        return found

    def add(self, words: list[str]) -> int:
        """The initial state of a sorted list of distinct words."""
        path: list[dict[str, int]] = [{}]
        ends = [False]
        last = ""
        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            self._close(path, ends, last, same)
            for _ in range(same, len(word)):
                path.append({})
                ends.append(False)
            ends[-1] = True
            last = word
        self._close(path, ends, last, 0)
        return self._state(path[0], ends[0])

    def _close(self, path: list[dict[str, int]], ends: list[bool], last: str, keep: int) -> None:
        for at in range(len(path) - 1, keep, -1):
            state = self._state(path.pop(), ends.pop())
            path[-1][last[at - 1]] = state

    def meets(self, p: int, q: int) -> bool:
        """Whether the right languages of two states have a word in common.

        All words behind one of them are of one length, so the search is as deep as the words; it
        keeps its own stack, as words may be very long.
        """
        if p == q:
            return True
        known = self._meets
        got = known.get((p, q))
        if got is not None:
            return got
        stack = [(p, q)]
        while stack:
            a, b = stack[-1]
            if (a, b) in known:
                stack.pop()
                continue
            if self.final[a] and self.final[b]:
                known[a, b] = True
                stack.pop()
                continue
            one, two = self.next[a], self.next[b]
            answer, todo = False, None
            for c, x in one.items():
                y = two.get(c)
                if y is None:
                    continue
                deeper = True if x == y else known.get((x, y))
                if deeper:
                    answer = True
                    break
                if deeper is None and todo is None:
                    todo = (x, y)
            if answer or todo is None:
                known[a, b] = answer
                stack.pop()
            else:
                stack.append(todo)
        return known[p, q]

    def common(self, p: int, q: int) -> Iterator[str]:
        """The words in the right languages of both states."""
        stack = [(p, q, "")] if self.meets(p, q) else []
        while stack:
            a, b, word = stack.pop()
            if self.final[a] and self.final[b]:
                yield word
            two = self.next[b]
            for c, x in self.next[a].items():
                y = two.get(c)
                if y is not None and self.meets(x, y):
                    stack.append((x, y, word + c))

    def replaced(self, start: int) -> Iterator[tuple[str, str]]:
        """Pairs of the words behind ``start`` that differ in one replaced code point."""
        stack = [(start, "")]
        while stack:
            state, head = stack.pop()
            arcs = list(self.next[state].items())
            for k, (a, x) in enumerate(arcs):
                for b, y in arcs[k + 1 :]:
                    for tail in self.common(x, y):
                        yield head + a + tail, head + b + tail
                stack.append((x, head + a))

    def inserted(self, longer: int, shorter: int) -> Iterator[tuple[str, str, bool]]:
        """Pairs of a word behind ``longer`` and one behind ``shorter`` that lacks one code point.

        Of equal neighbours the last one counts as inserted. The third value tells whether the
        inserted code point ends the word.
        """
        stack = [(longer, shorter, "")]
        while stack:
            p, q, head = stack.pop()
            two = self.next[q]
            for a, x in self.next[p].items():
                if self.final[x] and self.final[q]:
                    yield head + a, head, True
                for c, y in self.next[x].items():
                    z = two.get(c)
                    if c != a and z is not None:
                        for tail in self.common(y, z):
                            yield head + a + c + tail, head + c + tail, False
                if a in two:
                    stack.append((x, two[a], head + a))


PAIRS = "u string, n_u long, v string, n_v long"
_OUT = pa.schema([("u", pa.string()), ("n_u", pa.int64()), ("v", pa.string()), ("n_v", pa.int64())])
KEY = ["base", "head", "tail"]


def composed(partitions: list[tuple[str, str, dict[str, int], dict[str, int]]]) -> Iterator[tuple[str, int, str, int]]:
    """The accepted pairs of some partitions: head, tail, words of the base length, words one longer."""
    machine = Acceptor()
    starts = [(machine.add(sorted(short)), machine.add(sorted(long))) for _, _, short, long in partitions]
    for (head, tail, short, long), (s, b) in zip(partitions, starts):
        for x, y in machine.replaced(s):
            yield head + x + tail, short[x], head + y + tail, short[y]
        for x, y, at_end in machine.inserted(b, s):
            # Before a shared tail the place belongs to the partition of the other half.
            if not (at_end and tail):
                yield head + x + tail, long[x], head + y + tail, short[y]


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by partition in, accepted pairs out."""
    ready: list[tuple[str, str, dict[str, int], dict[str, int]]] = []
    words = 0
    key, current = None, None

    def flush():
        rows: list[tuple[str, int, str, int]] = []
        for pair in composed(ready):
            rows.append(pair)
            if len(rows) >= 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=_OUT)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=_OUT)

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for base, head, tail, long, middle, n in zip(*columns):
            if (base, head, tail) != key:
                if words >= BATCH:
                    yield from flush()
                    ready, words = [], 0
                key, current = (base, head, tail), (head, tail, {}, {})
                ready.append(current)
            current[3 if long else 2][middle] = n
            words += 1
    yield from flush()


def _halves(rows: DataFrame) -> DataFrame:
    """Each row in the partition of its first half and in that of its second."""
    half = "(base - length(head) - length(tail)) div 2"
    rest = f"(base - length(head) - length(tail) - {half})"
    return rows.select(
        "base", "long", "n",
        F.explode(F.expr(
            f"array(struct(concat(head, left(middle, int({half}))) AS head, tail, substr(middle, int({half}) + 1) AS middle),"
            f" struct(head, concat(right(middle, int({rest})), tail) AS tail, left(middle, int(length(middle) - {rest})) AS middle))"
        )).alias("p"),
    ).select("base", "p.head", "p.tail", "long", "p.middle", "n")


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """``u``, ``n_u``, ``v``, ``n_v``: each pair of the distinct words ``word`` (with ``n``) at one edit, once.

    A word at one edit from the empty word has no half to share; empty words are left out.
    """
    size = F.length("word")
    both = F.array(F.struct(size.alias("base"), F.lit(False).alias("long")), F.struct((size - 1).alias("base"), F.lit(True).alias("long")))
    whole = words.filter(size > 0).select("word", "n", F.explode(both).alias("as")).select(
        "as.base", F.lit("").alias("head"), F.lit("").alias("tail"), "as.long", F.col("word").alias("middle"), "n"
    )
    rows = _halves(whole)
    found = []
    while True:
        rows = stage(rows)
        # Pairs need a word of the base length and a second word of either.
        sizes = stage(rows.groupBy(*KEY).agg(F.count("*").alias("_n"), F.count_if(~F.col("long")).alias("_short")).filter("_n > 1 and _short > 0"))
        open_ = F.col("base") - F.length("head") - F.length("tail")
        crowded = (F.col("_n") > most) & (open_ > 1)
        fit = rows.join(sizes.filter(~crowded).select(*KEY), KEY, "left_semi")
        ordered = fit.repartition(*[F.col(c) for c in KEY]).sortWithinPartitions(*KEY)
        found.append(ordered.select(*KEY, "long", "middle", "n").mapInArrow(_pairs_of, PAIRS))
        more = sizes.filter(crowded)
        if more.isEmpty():
            break
        rows = _halves(rows.join(more.select(*KEY), KEY, "left_semi"))
    out = found[0]
    for pairs in found[1:]:
        out = out.union(pairs)
    return out


def last_forms(links: DataFrame) -> DataFrame:
    """``word``, ``root`` for the rows ``word``, ``form`` of a forest: what the forms lead to.

    Each round doubles the steps taken, and counts at least double at each step, so a handful of
    rounds reach every root.
    """
    now = stage(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not now.filter("moved").isEmpty():
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stage(
            now.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            )
        )
    return now.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2, most: int = MOST) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for the distinct words ``word`` (with ``n``).

    The form is the near word of largest ``n`` (ties: smallest in code-point order) if that is at
    least ``ratio`` times the word's own; ``root`` is where forms lead, the word itself if it has none.
    Null and empty words must not be given; an empty table gives no rows; very long words are
    compared like others.
    """
    if ratio < 2:
        raise ValueError("a ratio below two lets forms lead in a circle or on for very long")
    pairs = stage(near_words(words, most))
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("u").alias("word"), F.col("n_u").alias("n"), F.col("v").alias("near"), F.col("n_v").alias("near_n")),
        F.struct(F.col("v").alias("word"), F.col("n_v").alias("n"), F.col("u").alias("near"), F.col("n_u").alias("near_n")),
    )).alias("e")).select("e.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    per_word = ends.groupBy("word").agg(F.max("n").alias("n"), F.count("*").alias("n_near"), best.alias("best"))
    has = -F.col("best.less") >= F.col("n") * ratio
    per_word = stage(
        per_word.select("word", "n_near", F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n"))
    )
    roots = last_forms(per_word.filter("form is not null"))
    return (
        words.select("word", "n").join(per_word, "word", "left").join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )


def variants_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """``spelling_variants`` of the words of all ``docs``.

    A null text has no words; a null id is an empty one in the hash. Repeated rows count as often as
    they are given. Texts are read whole, in pieces that cut no run. An empty table gives no rows.
    Further columns are ignored.
    """
    return spelling_variants(stage(vocabulary(docs, doc_id=doc_id, text=text)), most=most)
