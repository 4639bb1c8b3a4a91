"""Scores of texts by prediction by partial matching, with word counts beside them.

The model is a trie of byte contexts, read backwards from the predicted byte: context length five
down to none, counted over all training texts with a mark before each text and an end after it.
A symbol is predicted in the longest context that was ever seen. Where it did not occur there, the
model escapes to the context shorter by one byte with probability d / (n + d) (d different symbols
among n), and the symbols of the longer context are excluded from then on.

As every context of a position ends in the same two bytes, the trie falls into parts by its two top
levels; what lies above is at most 256 * 256 counts. So no task holds the model: texts are cut into
slices, each slice says how often which of its documents needs which (context, symbol) or word, these
requests travel to the part of the model that answers them, and the sums per document travel back.
Where there is much text the parts are copied, so that each copy answers a bounded share of it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import row_key, slices, stage, text_or_empty

#: Bytes of the longest context; its code and the symbol leave room for part and document in 64 bits.
ORDER = 5
SYMBOL = 8
MASK = (1 << SYMBOL) - 1
CODE = SYMBOL * (ORDER + 1)
#: Stands before a text and, as a predicted symbol, after it. UTF-8 has no such byte.
EDGE = 0xFF
#: Parts of the trie (five of six bits), and as many of the word counts.
PARTS = 32
#: Documents (ten bits) and bytes of a slice; a longer text is a slice of its own, worked on in pieces.
DOC = 10
SLICE_DOCS = 1 << DOC
SLICE_BYTES = 1 << 21
#: Training tokens for which one copy of the model answers.
TOKENS_A_COPY = 20_000_000
#: Words, and codes, that a task remembers before it hands on their counts.
MEMORY = 1 << 18
CODES = 1 << 21

_U64 = np.uint64


def _parts_of(codes: np.ndarray) -> np.ndarray:
    """The part that holds each code: a hash of the two bytes before the symbol."""
    top = codes >> _U64(SYMBOL * (ORDER - 1))
    return ((top * _U64(2654435761)) & _U64(0xFFFFFFFF)) >> _U64(27)


def word_part(word: bytes) -> int:
    return PARTS + zlib.crc32(word) % PARTS


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes (context backwards, then symbol) and document numbers of all positions of a slice."""
    if len(texts) > 1 or len(texts[0]) <= 2 * SLICE_BYTES:
        lengths = np.array([len(t) for t in texts])
        wide = lengths + ORDER + 1
        symbols = np.full(int(wide.sum()), EDGE, dtype=np.uint64)
        number = np.repeat(np.arange(len(texts), dtype=np.uint64), wide)
        before = np.repeat(np.cumsum(wide) - wide, lengths)
        at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        symbols[before + ORDER + at] = np.frombuffer(b"".join(texts), dtype=np.uint8)
        starts = np.zeros(len(symbols), dtype=bool)
        for k in range(ORDER):
            starts[np.cumsum(wide) - wide + k] = True
        yield _codes(symbols)[~starts[ORDER:]], number[ORDER:][~starts[ORDER:]]
        return
    data = np.frombuffer(texts[0], dtype=np.uint8)
    for start in range(0, len(data), SLICE_BYTES):
        stop = min(start + SLICE_BYTES, len(data))
        lead = np.full(ORDER, EDGE, dtype=np.uint64) if start == 0 else data[start - ORDER : start]
        end = [EDGE] if stop == len(data) else []
        codes = _codes(np.concatenate([lead, data[start:stop], np.array(end, dtype=np.uint64)]).astype(np.uint64))
        yield codes, np.zeros(len(codes), dtype=np.uint64)


def _codes(symbols: np.ndarray) -> np.ndarray:
    n = len(symbols) - ORDER
    codes = symbols[ORDER:].copy()
    for j in range(1, ORDER + 1):
        codes |= symbols[ORDER - j : ORDER - j + n] << _U64(SYMBOL * (ORDER - j + 1))
    return codes


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        # bytes.split() knows the six ASCII white-space bytes only; the last word may go on.
        found = text[start : start + SLICE_BYTES].split()
        stop = start + SLICE_BYTES
        while stop < len(text) and not text[stop - 1 : stop].isspace() and not text[stop : stop + 1].isspace():
            stop = next((k for k in range(stop, min(stop + 4096, len(text))) if text[k : k + 1].isspace()), min(stop + 4096, len(text)))
        if stop > start + SLICE_BYTES:
            found = text[start:stop].split()
        yield found
        start = stop
    yield text[start:].split()


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE_DOCS):
            yield from slices(iter([batch.slice(k, SLICE_DOCS)]), "text", SLICE_BYTES)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    texts = [x.as_buffer().to_pybytes().lower() for x in batch.column("text").cast(pa.binary())]
    # A string that is not UTF-8 may hold the edge.
    return [t.replace(b"\xff", b"\xfe") if b"\xff" in t else t for t in texts]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part``, ``code`` or ``word``, ``n`` of training texts."""
    held: Counter[bytes] = Counter()

    def words_out():
        words = list(held)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([word_part(w) for w in words], pa.int32()),
                pa.nulls(len(words), pa.int64()),
                pa.array(words, pa.binary()),
                pa.array(list(held.values()), pa.int64()),
            ],
            names=["part", "code", "word", "n"],
        )

    def codes_out():
        codes, n = _summed(np.concatenate([c for c, _ in seen]), np.concatenate([n for _, n in seen]))
        seen.clear()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(_parts_of(codes).astype(np.int32)),
                pa.array(codes.astype(np.int64)),
                pa.nulls(len(codes), pa.binary()),
                pa.array(n),
            ],
            names=["part", "code", "word", "n"],
        )

    seen: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for batch in _sliced(batches):
        texts = _texts(batch)
        for codes, _ in _pieces(texts):
            seen.append(np.unique(codes, return_counts=True))
            waiting += len(seen[-1][0])
            if waiting > CODES:
                yield codes_out()
                waiting = 0
        held[b""] += len(texts)  # the end of a text is a token
        for text in texts:
            for found in _words(text):
                held.update(found)
                if len(held) > MEMORY:
                    yield words_out()
                    held.clear()
    if seen:
        yield codes_out()
    if held:
        yield words_out()


_REQUEST = pa.schema(
    [
        ("part", pa.int32()), ("copy", pa.int32()), ("slice", pa.int64()), ("piece", pa.int32()), ("size", pa.int32()),
        ("asked", pa.binary()), ("plain", pa.int64()),
        ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64())),
    ]
)
REQUEST = (
    "part int, copy int, slice long, piece int, size int, asked binary, plain long, "
    "ids array<long>, keys array<long>, held array<boolean>, tokens array<long>"
)
_NONE = (None,) * 4


def _planes(values: np.ndarray, kind: str) -> bytes:
    """All first bytes, then all second ones, and so on: high bytes are mostly zero and pack well."""
    values = values.astype(kind)
    return values.view("u1").reshape(-1, values.itemsize).T.tobytes()


def _unplaned(data: memoryview, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, dtype="u1").reshape(width, -1).T.copy().view(kind).ravel()


def _request(wanted: np.ndarray | list[bytes], spans, docs, times) -> tuple[bytes, int]:
    """What is wanted, how many entries each has, and their documents and times, packed.

    Codes and the documents of one code ascend, so their differences are kept. A count above 255 is
    as many entries as it needs.
    """
    again = (times + 254) // 255
    if (again > 1).any():
        first = np.concatenate([[0], np.cumsum(again)[:-1]])
        full = np.full(int(again.sum()), 255, dtype=np.int64)
        full[np.cumsum(again) - 1] = times - (again - 1) * 255
        edges = np.cumsum(spans)
        spans = np.diff(np.concatenate([[0], np.concatenate([first, [len(full)]])[edges]]))
        docs, times = np.repeat(docs, again), full
    steps = np.diff(docs.astype(np.int64), prepend=0)
    starts = np.cumsum(spans) - spans
    steps[starts] = docs[starts]
    data = b" ".join(wanted) if isinstance(wanted, list) else _planes(np.diff(wanted, prepend=_U64(0)), "<u8")
    sizes = np.array([len(data), len(spans), len(docs)], dtype="<u4").tobytes()
    plain = b"".join([sizes, data, _planes(spans, "<u4"), _planes(steps, "<u2"), times.astype("u1").tobytes()])
    return pa.Codec("zstd", 1).compress(plain, asbytes=True), len(plain)


def _opened(asked: bytes, plain: int) -> tuple[memoryview, np.ndarray, np.ndarray, np.ndarray]:
    """What ``_request`` packed; codes or words are still bytes."""
    data = memoryview(pa.Codec("zstd").decompress(asked, plain, asbytes=True))
    wanted, n, entries = np.frombuffer(data[:12], dtype="<u4").astype(int)
    at = np.cumsum([12, wanted, 4 * n, 2 * entries, entries])
    spans = _unplaned(data[at[1] : at[2]], "<u4").astype(np.int64)
    steps = np.cumsum(_unplaned(data[at[2] : at[3]], "<u2").astype(np.int64))
    starts = np.cumsum(spans) - spans
    before = np.concatenate([[0], steps])[starts]
    docs = steps - np.repeat(before, spans)
    return data[12 : at[1]], spans, docs, np.frombuffer(data[at[3] : at[4]], dtype="u1").astype(float)


def _requests(copies: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId() << 32
        for serial, batch in enumerate(_sliced(batches)):
            texts = _texts(batch)
            number, copy = here + serial, (here // (1 << 32) + serial) % copies
            rows = []
            for piece, (codes, docs) in enumerate(_pieces(texts)):
                keys = (_parts_of(codes) << _U64(CODE + DOC)) | (codes << _U64(DOC)) | docs
                keys, times = np.unique(keys, return_counts=True)
                code = keys >> _U64(DOC)  # part and code
                new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, int)
                spans = np.diff(np.append(new, len(code)))
                docs = keys & _U64(SLICE_DOCS - 1)
                part = code[new] >> _U64(CODE)
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
                for a, b in zip(cuts, np.append(cuts[1:], len(part))):
                    x, y = new[a], new[b] if b < len(new) else len(code)
                    wanted = code[new[a:b]] & _U64((1 << CODE) - 1)
                    rows.append((int(part[a]), copy, number, piece, len(texts), *_request(wanted, spans[a:b], docs[x:y], times[x:y]), *_NONE))
            tokens = _word_requests(texts, rows, copy, number)
            rows.append((2 * PARTS, copy, number, 0, len(texts), None, None, *(batch.column(c).to_pylist() for c in ("doc_id", "row_key", "held_out")), tokens))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _REQUEST)], schema=_REQUEST)

    return run


def _word_requests(texts: list[bytes], rows: list, copy: int, number: int) -> list[int]:
    """Adds the requests for words to ``rows``; the tokens of each text are returned."""
    tokens = [1] * len(texts)
    if len(texts) > 1:
        found = [text.split() for text in texts]
        pieces = iter([([w for words in found for w in words], np.repeat(np.arange(len(texts)), [len(f) for f in found]))])
        tokens = [1 + len(f) for f in found]
    else:
        pieces = ((f, np.zeros(len(f), dtype=np.int64)) for f in _words(texts[0]))
    for piece, (words, docs) in enumerate(pieces):
        if len(texts) == 1:
            tokens[0] += len(words)
        if piece == 0:  # every text has one end
            words, docs = words + [b""] * len(texts), np.append(docs, np.arange(len(texts)))
        coded = pa.array(words, pa.binary()).dictionary_encode()
        names = coded.dictionary.to_pylist()
        part = np.array([word_part(w) for w in names], dtype=np.int64)
        # Words in the order of their parts, then each word's documents in turn.
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        keys, times = np.unique((place[coded.indices.to_numpy()] << DOC) | docs, return_counts=True)
        word = keys >> DOC
        spans = np.bincount(word, minlength=len(order))
        edges = np.concatenate([[0], np.cumsum(spans)])
        docs, part = keys & (SLICE_DOCS - 1), part[order]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
        for x, y in zip(cuts, np.append(cuts[1:], len(part))):
            asked = [names[k] for k in order[x:y]]
            inner = slice(edges[x], edges[y])
            rows.append((int(part[x]), copy, number, piece, len(texts), *_request(asked, spans[x:y], docs[inner], times[inner]), *_NONE))
    return tokens


class ContextTrie:
    """One part of the trie: log10 probabilities of (context, symbol) codes.

    ``codes`` with ``counts`` are those of the longest contexts of the part; ``top`` and ``top_counts``
    are all (one byte, symbol) codes of the corpus, which stand above every part.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, top: np.ndarray, top_counts: np.ndarray):
        self.levels: dict[int, tuple] = {}
        symbol = codes & _U64(MASK)
        grams = {k: (((codes >> _U64(SYMBOL * (ORDER - k + 1))) << _U64(SYMBOL)) | symbol, counts) for k in range(ORDER, 1, -1)}
        grams[1] = (top, top_counts)
        grams[0] = (top & _U64(MASK), top_counts)
        for k in range(ORDER + 1):
            gram, n = _summed(*grams[k])
            context, total = _summed(gram >> _U64(SYMBOL), n)
            _, distinct = _summed(gram >> _U64(SYMBOL), np.ones(len(gram), dtype=np.int64))
            less_n = less_d = None
            if k:
                # What is left of the shorter context once the symbols of this one are excluded.
                below, below_n, shorter, shorter_n, shorter_d = self.levels[k - 1][:5]
                same = ((gram >> _U64(2 * SYMBOL)) << _U64(SYMBOL)) | (gram & _U64(MASK))
                _, shared = _summed(gram >> _U64(SYMBOL), below_n[np.searchsorted(below, same)] if len(gram) else n)
                at = np.searchsorted(shorter, context >> _U64(SYMBOL))
                less_n, less_d = (shorter_n[at] - shared, shorter_d[at] - distinct) if len(gram) else (total, distinct)
            self.levels[k] = (gram, n, context, total, distinct, less_n, less_d)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes))
        alive = np.ones(len(codes), dtype=bool)
        # Totals left by the exclusion of the longer context; -1 where no longer context was seen.
        left_n = np.full(len(codes), -1, dtype=np.int64)
        left_d = np.full(len(codes), -1, dtype=np.int64)
        symbol = codes & _U64(MASK)
        for k in range(ORDER, -1, -1):
            gram, n, context, total, distinct, less_n, less_d = self.levels[k]
            if not len(gram):
                continue
            want = codes >> _U64(SYMBOL * (ORDER - k + 1))
            at = np.minimum(np.searchsorted(context, want), len(context) - 1)
            seen = alive & (context[at] == want)
            here_n, here_d = np.where(left_n >= 0, left_n, total[at]), np.where(left_n >= 0, left_d, distinct[at])
            same = (want << _U64(SYMBOL)) | symbol
            which = np.minimum(np.searchsorted(gram, same), len(gram) - 1)
            hit = seen & (gram[which] == same)
            out[hit] += np.log10(n[which[hit]] / (here_n[hit] + here_d[hit]))
            miss = seen & ~hit & (here_d > 0)
            out[miss] += np.log10(here_d[miss] / (here_n[miss] + here_d[miss]))
            alive &= ~hit
            if k:
                left_n, left_d = np.where(seen, less_n[at], left_n), np.where(seen, less_d[at], left_d)
        out[alive] -= np.log10(EDGE + 1 - len(self.levels[0][0]))
        return out


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the values of each."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], np.asarray(values)[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(values, new)


_ANSWER = pa.schema(
    [
        ("part", pa.int32()), ("slice", pa.int64()), ("piece", pa.int32()), ("sums", pa.binary()), ("known", pa.binary()),
        ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64())),
    ]
)
ANSWER = (
    "part int, slice long, piece int, sums binary, known binary, "
    "ids array<long>, keys array<long>, held array<boolean>, tokens array<long>"
)


def _answers(top: np.ndarray, top_counts: np.ndarray, tokens: int, words: int):
    """Of one part of the model and the requests for it: sums per document of each slice."""

    def run(key: tuple, model: pa.Table, asked: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if part == 2 * PARTS:  # what is known of the documents themselves
            none = pa.nulls(asked.num_rows, pa.binary())
            columns = [asked.column(c) for c in ("part", "slice", "piece")] + [none, none]
            return pa.table([*columns, *(asked.column(c) for c in ("ids", "keys", "held", "tokens"))], schema=_ANSWER)
        requests = asked.select(["slice", "piece", "size", "asked", "plain"]).to_pylist()
        n = model.column("n").to_numpy()
        if part >= PARTS:
            counts = dict(zip(model.column("word").to_pylist(), n.tolist()))
        else:
            trie = ContextTrie(model.column("code").to_numpy().astype(np.uint64), n, top, top_counts)
            # Requests stay packed but for the one at work; every code is scored once.
            wanted = [np.cumsum(_unplaned(_opened(r["asked"], r["plain"])[0], "<u8"), dtype=np.uint64) for r in requests]
            codes = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, dtype=np.uint64)
            logs = trie.log10(codes)
        rows = []
        for k, r in enumerate(requests):
            what, spans, docs, times = _opened(r["asked"], r["plain"])
            known = None
            if part >= PARTS:
                c = np.array([counts.get(w, 0) for w in bytes(what).split(b" ")], dtype=float)
                each = np.log10((c + 1) / (tokens + words + 1))
                known = np.bincount(docs, np.repeat(c > 0, spans) * times, r["size"]).astype("<i8").tobytes()
            else:
                each = logs[np.searchsorted(codes, wanted[k])]
            sums = np.bincount(docs, np.repeat(each, spans) * times, r["size"])
            rows.append((part, r["slice"], r["piece"], sums.astype("<f8").tobytes(), known, *_NONE))
        columns = zip(*rows) if rows else [[]] * len(_ANSWER)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ANSWER)], schema=_ANSWER)

    return run


SCORES = "doc_id long, row_key long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(answers: pa.Table) -> pa.Table:
    """One slice: the answers of all parts, added in the order of the parts."""
    rows = sorted(answers.to_pylist(), key=lambda r: (r["part"], r["piece"]))
    head = rows.pop()
    size = len(head["ids"])
    base, known, score = np.zeros(size), np.zeros(size, dtype=np.int64), np.zeros(size)
    for r in rows:
        sums = np.frombuffer(r["sums"], dtype="<f8")
        if r["known"] is None:
            score += sums
        else:
            base += sums
            known += np.frombuffer(r["known"], dtype="<i8")
    columns = [head["ids"], head["keys"], head["held"], head["tokens"], known, base, score]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in SCORES.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def score_texts(docs: DataFrame, held_out: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    Texts with A-Z lower-cased; those for which ``held_out`` is false train the model (default: the
    crc32 of the id as text leaves another rest than 2 by 7; null counts as false). ``score`` is the
    log10 probability of all bytes and the end of the text; ``base_score`` that of its tokens (words
    and one end) by add-one counts, of which ``n_known`` occur in training. A null or empty text is
    its end alone; a null id is an empty one; repeated rows train and are scored as often as they are
    given. Texts are read whole, long ones in pieces. Without training texts every symbol has
    probability 1/256 and ``n_known`` is 0. An empty table gives no rows. Further columns are ignored.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        row_key(doc_id, text).alias("row_key"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_or_empty(text).alias("text"),
    )
    counts = slim.filter(~F.col("held_out")).select("text").mapInArrow(_counts, "part int, code long, word binary, n long")
    model = stage(counts.groupBy("part", "code", "word").agg(F.sum("n").alias("n")))
    sizes = model.filter("word is not null").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, words = sizes
    # At most 256 * 256 rows, whatever the corpus.
    short = model.filter("code is not null").groupBy(
        F.shiftright("code", SYMBOL * ORDER).alias("byte"), F.col("code").bitwiseAND(F.lit(MASK)).alias("symbol")
    )
    top = short.agg(F.sum("n").alias("n")).orderBy("byte", "symbol").collect()
    codes = np.array([(r.byte << SYMBOL) | r.symbol for r in top], dtype=np.uint64)
    counted = np.array([r.n for r in top], dtype=np.int64)

    copies = 1 + tokens // TOKENS_A_COPY // PARTS
    asked = slim.mapInArrow(_requests(copies), REQUEST)
    known = model.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    answers = known.groupBy("part", "copy").cogroup(asked.groupBy("part", "copy")).applyInArrow(
        _answers(codes, counted, tokens, words), ANSWER
    )
    scores = answers.groupBy("slice").applyInArrow(_scores, SCORES)
    return scores.select(
        "doc_id", "row_key", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
