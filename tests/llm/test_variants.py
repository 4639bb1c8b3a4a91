"""Spelling variants against plain versions: all pairs, and the whole query by deletion keys."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from shiplens.llm import variants
from shiplens.llm.queries import QUERIES
from shiplens.llm.variants import near_words, runs, spelling_variants, variants_of

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    keys = defaultdict(set)
    for w in words:
        keys[w].add(w)
        for i in range(len(w)):
            keys[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in keys.values():
        for a, b in itertools.combinations(group, 2):
            if is_near(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def rows(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_query(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = plain_variants(plain_words(map(tuple, given)))
    assert rows(QUERIES["op11_spelling_variants"](spark, FOLDER)) == sorted(want, key=str) and len(want) > 500


@pytest.mark.parametrize("most", [20_000, 2])
def test_pairs_of_made_words(spark, most):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("abé😀") for _ in range(rnd.randint(1, 8))): rnd.randint(3, 400) for _ in range(700)}
    words |= {"ab" * 400: 7, "ab" * 400 + "a": 9, "ba" * 400: 8, "a" + "ab" * 399 + "b": 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted(tuple(sorted((r.u, r.v))) for r in near_words(df, most).collect())
    assert got == sorted(tuple(sorted(p)) for p in itertools.combinations(words, 2) if is_near(*p))
    assert rows(spelling_variants(df, most=most)) == sorted(plain_variants(words), key=str)


def test_one_prefix_holds_most_words(spark):
    """A partition that a third of all words share is cut until its parts fit."""
    rnd = random.Random(2)
    words = {"shared" + "".join(rnd.choice("abcd") for _ in range(6)): rnd.randint(3, 50) for _ in range(1500)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(spelling_variants(df, most=50)) == sorted(plain_variants(words), key=str)


def test_odd_documents(spark, odd, clashing, none):
    want = sorted(plain_variants(plain_words([(r.doc_id, r.text) for r in odd.collect()])), key=str)
    assert want and rows(variants_of(odd)) == want == rows(variants_of(clashing))
    assert variants_of(none).collect() == []


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 50)
    rnd = random.Random(3)
    for _ in range(200):
        text = "".join(rnd.choice(["A", "é", "ß", " ", "字", "😀", "x" * rnd.randint(1, 300)]) for _ in range(60)).encode()
        assert [r for part in runs(text) for r in part] == re.findall(variants.RUN, text.lower())
