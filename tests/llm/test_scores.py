"""Scores of texts against a plain trie of contexts with escapes and exclusion."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplens.llm import ppm
from shiplens.llm.ppm import ContextTrie, score_texts
from shiplens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
EDGE = b"\xff"


def lowered(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class PlainTrie:
    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for text in texts:
            whole = EDGE * order + text + EDGE
            for i in range(order, len(whole)):
                for k in range(order + 1):
                    self.seen[whole[i - k : i]][whole[i]] += 1

    def log10(self, context, symbol):
        out, gone = 0.0, set()
        for k in range(self.order, -1, -1):
            here = {s: n for s, n in self.seen.get(context[self.order - k :], {}).items() if s not in gone}
            if not here:
                continue
            total = sum(here.values()) + len(here)
            if symbol in here:
                return out + math.log10(here[symbol] / total)
            out += math.log10(len(here) / total)
            gone |= set(here)
        return out - math.log10(256 - len(gone))

    def score(self, text):
        whole = EDGE * self.order + text + EDGE
        return sum(self.log10(whole[i - self.order : i], whole[i]) for i in range(self.order, len(whole)))


def plain_scores(rows):
    train = [lowered(t) for d, t in rows if not held(d)]
    trie = PlainTrie(train, ppm.ORDER)
    tokens = Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(tokens.values()), len(tokens)
    out = []
    for d, t in rows:
        words = [*lowered(t).split(), None]
        base = sum(math.log10((tokens[w] + 1) / (n + v + 1)) for w in words)
        out.append((d, held(d), len(words), sum(w in tokens for w in words), n, base, trie.score(lowered(t))))
    return out


def check(got, want):
    order = lambda r: (str(r[0]), r[2:4], round(r[5], 6), round(r[6], 6))
    got = sorted((tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in got), key=order)
    want = sorted(want, key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op12_text_scores"](spark, FOLDER).collect(), plain_scores(rows))


def test_odd_documents_in_pieces_and_copies(spark, odd, clashing, none, monkeypatch):
    short = odd.withColumn("text", F.left("text", F.lit(9000)))
    want = plain_scores([(r.doc_id, r.text) for r in short.collect()])
    check(score_texts(short).collect(), want)
    again = clashing.withColumn("text", F.left("text", F.lit(9000)))
    # Driver and tasks share these numbers through the slices alone.
    monkeypatch.setattr(ppm, "TOKENS_A_COPY", 20)
    check(score_texts(again).collect(), want)
    assert score_texts(none).collect() == []


def test_long_texts_in_pieces(spark, odd):
    """Texts of several pieces: the sums are those of the whole text."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6))) for _ in range(50)]
    long = " ".join(rnd.choice(words) for _ in range(1_500_000))
    df = spark.createDataFrame([(1, long), (2, long), (3, "x" * 6_000_000), (8, long[:1000])], "doc_id long, text string")
    got = {r.doc_id: r for r in score_texts(df, F.col("doc_id") > 1).collect()}
    assert not got[1].held_out and got[1].n_tokens == 1_500_001 == got[1].train_tokens
    assert got[1].score == got[2].score and got[1].n_known == got[2].n_known == 1_500_001
    assert got[3].n_tokens == 2 and got[3].n_known == 1
    counts = Counter([*long.split(), None])
    base = sum(n * math.log10((n + 1) / (1_500_001 + len(counts) + 1)) for n in counts.values())
    assert got[1].base_score == pytest.approx(base, rel=1e-9)
    trie = PlainTrie([long.encode()], ppm.ORDER)
    assert got[8].score == pytest.approx(trie.score(long[:1000].encode()), rel=1e-9)
    assert got[1].score == pytest.approx(trie.score(long.encode()), rel=1e-9)


def test_no_training_text(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in score_texts(df, F.lit(True)).collect()}
    assert got[1].score == pytest.approx(-3 * math.log10(256)) and got[2].score == pytest.approx(-math.log10(256))
    assert got[1].train_tokens == 0 and got[1].n_known == 0 and got[1].base_score == 0


def test_probabilities_add_up():
    rnd = random.Random(1)
    whole = EDGE * ppm.ORDER + bytes(rnd.choice(b"abc ") for _ in range(400)) + EDGE
    codes = ppm._codes(np.frombuffer(whole, dtype=np.uint8).astype(np.uint64))
    codes, n = np.unique(codes, return_counts=True)
    top, top_n = ppm._summed(((codes >> np.uint64(ppm.SYMBOL * ppm.ORDER)) << np.uint64(ppm.SYMBOL)) | (codes & np.uint64(ppm.MASK)), n)
    trie = ContextTrie(codes, n, top, top_n)
    for _ in range(50):
        context = sum(rnd.choice(b"abcd ") << (8 * k) for k in range(1, ppm.ORDER + 1))
        every = np.array([context | s for s in range(256)], dtype=np.uint64)
        assert (10 ** trie.log10(every)).sum() == pytest.approx(1)
