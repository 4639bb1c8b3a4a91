"""SimHash groups against brute force; fingerprints by phrases against a plain version."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st

from shiplens.llm import phrases, simhash
from shiplens.llm.components import connected_components


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@over(st.text(max_size=80))
@settings(max_examples=150, deadline=None)
def test_fingerprint_is_the_majority_of_hashes(text):
    assert simhash.text_fingerprint(text.encode()) == plain_fingerprint(text)


def test_long_text_is_counted_in_parts_alike():
    text = " ".join(f"w{k * k % 7919}" for k in range(70_000))
    assert simhash.text_fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("segments, dense", [(16, 512), (8, 2), (64, 1), (4, 30)])
def test_pairs_connect_what_is_near(spark, segments, dense):
    rng = random.Random(segments)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = set(seeds)
    for s in seeds[:6]:
        x = s
        for _ in range(40):  # chains of near fingerprints, some of them in one tight cluster
            x = (x if rng.random() < 0.5 else s) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            prints.add(x)
    prints = sorted(prints)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    want = plain_groups(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
    rows = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    edges = simhash.near_pairs(rows, segments=segments, dense=dense)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    classes = {}
    for x in prints:
        classes.setdefault(got.get(signed(x), ("alone", x)), set()).add(want[x])
    assert all(len(v) == 1 for v in classes.values()) and len(classes) == len(set(want.values()))


def test_groups_of_the_given_documents(spark, given):
    docs = {r.doc_id: r.text for r in given.collect()}
    prints = {k: plain_fingerprint(t) for k, t in docs.items()}
    want = plain_groups(docs, [(a, b) for a in docs for b in docs if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    got = simhash.simhash_groups(given).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(int(r.fingerprint, 16) == prints[r.doc_id] and len(r.fingerprint) == 16 for r in got)
    kept = simhash.drop_near_duplicates(given)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == given.columns


def test_groups_of_odd_documents(odd, clashing, none):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == odd.count()
    zero = {r.doc_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {4, 5, 6, None} and {r.component_id for r in rows if r.fingerprint == "0" * 16} == {4}
    same = [r for r in rows if r.doc_id in (1, 2)]
    assert len(same) == 3 and {r.component_id for r in same} == {1}
    kept = simhash.drop_near_duplicates(clashing)
    found = kept.collect()
    assert kept.columns == clashing.columns and all(r._key == "old _key" and r["a.b"] == "old a.b" for r in found)
    # The two rows of id 9 differ and are no copies of each other.
    assert sorted(r.doc_id for r in found) == sorted([*{r.component_id for r in rows}, 9])
    assert simhash.simhash_groups(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


def test_repeated_row_stays_once(spark):
    docs = spark.createDataFrame([(2, "a b c d"), (2, "a b c d"), (None, "z y x w"), (None, "z y x w")], "doc_id long, text string")
    assert sorted(simhash.drop_near_duplicates(docs).collect(), key=str) == sorted([(2, "a b c d"), (None, "z y x w")], key=str)


def test_components_of_chains_and_loops(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 500), (300, 301), (301, 300), (None, 4)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(201)}, 500: 500, 300: 300, 301: 300}


def plain_edited(docs):
    rows = sorted(((-(1 << 63) if d is None else d), t or "", d) for d, t in docs)
    for k, (_, text, doc) in enumerate(rows):
        yield doc, text, phrases.edited(text, rows[(k + 1) % len(rows)][1]), rows[(k + 1) % len(rows)][1]


@pytest.mark.parametrize("rows_each", [2_000, 3])
def test_edited_fingerprints(spark, odd, given, clashing, rows_each, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE_ROWS", rows_each)
    for docs in (given, odd, clashing):
        pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        want = []
        for doc, text, new, after in plain_edited(pairs):
            a, b, c = (phrases.sketches([x.encode()])[0] for x in (text, new, after))
            want.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), phrases.as_hex(a), phrases.as_hex(b), phrases.likeness(a, b), phrases.likeness(a, c)))
        got = [tuple(r) for r in phrases.edited_fingerprints(docs).drop("row_key").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_edited_of_none_and_one(spark, none):
    assert phrases.edited_fingerprints(none).count() == 0
    one = phrases.edited_fingerprints(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0


def test_fingerprint_depends_on_the_text_alone():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(400))).encode() for _ in range(60)] + [b"", b"aaaaaaaa", b"x"]
    together = phrases.sketches(texts)
    assert all(np.array_equal(phrases.sketches([t])[0], s) for t, s in zip(texts, together))


def test_shared_part_has_shared_phrases_at_any_offset():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    shared = " ".join(word() for _ in range(800))
    near, far = [], []
    for k in range(20):
        a = phrases.sketches([shared.encode()])[0]
        b = phrases.sketches([("y" * k + shared).encode()])[0]
        c = phrases.sketches([" ".join(word() for _ in range(800)).encode()])[0]
        near.append(phrases.likeness(a, b))
        far.append(phrases.likeness(a, c))
    assert min(near) > 0.9 and max(far) < 0.2


def test_likeness_column_is_likeness(spark, given):
    from pyspark.sql import functions as F

    rows = phrases.edited_fingerprints(given).select("near_edited", phrases.fingerprint_likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("x"))
    assert all(abs(r.near_edited - r.x) < 1e-12 for r in rows.collect())
    whole = {r.doc_id: r.fingerprint for r in phrases.fingerprint_texts(given).collect()}
    assert whole == {r.doc_id: r.fingerprint for r in phrases.edited_fingerprints(given).collect()}


def test_unrelated_long_texts_stay_unlike():
    rnd = np.random.default_rng(3)
    one, two = (rnd.integers(32, 127, 20_000_000, dtype=np.uint8).tobytes() for _ in range(2))
    a, b = phrases.sketches([one]), phrases.sketches([two])
    assert phrases.likeness(a[0], b[0]) < 0.05
    half = phrases.sketches([one[:12_000_000] + two[:8_000_000]])
    assert 0.2 < phrases.likeness(a[0], half[0]) < 0.7
