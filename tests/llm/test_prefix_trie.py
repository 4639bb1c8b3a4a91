"""The prefix trie against a plain one, whole and with every limit small."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shiplens.llm import prefixtrie
from shiplens.llm.prefixtrie import conversation_trie, list_ranks, ordered_turns, prefix_trie, rebuilt_turns
from shiplens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_order(rows):
    convs = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        convs[c].append((role or "", text or ""))
    return convs


def plain_rebuilt(convs):
    out = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + convs[c][h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        kids = children[node]
        below[node] = (sum(below[k][0] for k in kids) or 1, saved + sum(below[k][1] for k in kids))
    out = set()
    for node, inside in members.items():
        ends = ",".join(str(c) for c in inside if len(convs[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.add((inside[0], len(node), parent, len(inside), len(children[node]), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(got, convs):
    got = got.collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == sorted(plain_trie(convs) if convs else [], key=str)
    if got and "enter" in got[0].asDict():
        # The positions of all arcs are those of one tour, and children lie within their parents.
        assert sorted(p for r in got for p in (r.enter, r.exit)) == list(range(2 * len(got)))
        place = {(r.conv_id, r.depth): (r.enter, r.exit) for r in got}
        for r in got:
            if r.depth:
                up = place[r.parent_conv_id, r.depth - 1]
                assert up[0] < r.enter < r.exit < up[1]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op13_prefix_trie"](spark, FOLDER), plain_rebuilt(plain_order(rows)))


def made_rows():
    rnd = random.Random(6)
    rows = []
    for c in [*range(0, 60), 73, 78, 91]:
        for t in range(rnd.randint(1, 7)):
            rows.append((c, t if t else None, rnd.choice(["user", None]), rnd.choice(["a", "bé", None, ""])))
    rows += [(200, t, "user", f"turn {t % 3}") for t in range(400)] + [(203, t, "user", f"turn {t % 3}") for t in range(390)]
    return rows + [(None, 1, "user", "nobody's"), (None, None, None, None)]


@pytest.mark.parametrize("few", [5, 1 << 16])
def test_made_conversations(spark, monkeypatch, few):
    monkeypatch.setattr(prefixtrie, "IDS", 7)
    rows = made_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    convs = plain_order(rows)
    check(conversation_trie(df, few=few), convs)
    ordered = ordered_turns(df)
    check(prefix_trie(*rebuilt_turns(ordered), few), plain_rebuilt(convs))
    again = df.withColumns({c: F.lit(9) for c in ("depth", "k1", "_range", "pos", "n_bytes", "h1", "c", "a.b")})
    check(conversation_trie(again, few=few), convs)


def test_turnless_conversations_and_none(spark):
    # Their first turns are dropped and the family has no first conversation.
    lonely = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:4]
    rows = [(c, t, "user", f"{c}") for c in lonely for t in range(2)] + [(None, 1, "user", "x")]
    convs = plain_rebuilt(plain_order(rows))
    assert convs and not any(convs.values())
    df = spark.createDataFrame(rows, SCHEMA)
    check(prefix_trie(*rebuilt_turns(ordered_turns(df))), convs)
    check(conversation_trie(df.filter("conv_id < 0")), {})


def test_copies_and_ties_and_repeated_rows(spark):
    rows = [(c, t, "user", f"text {t}") for c in range(3000) for t in range(2)]
    check(conversation_trie(spark.createDataFrame(rows, SCHEMA)), plain_order(rows))
    tied = [(1, 1, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "a"), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a")]
    got = conversation_trie(spark.createDataFrame(tied, SCHEMA)).collect()
    # Equal sets of tied rows are equal conversations.
    assert sorted((r.depth, r.n_convs) for r in got) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_ranks_of_a_list(spark):
    n = 3000
    order = list(range(n))
    random.Random(3).shuffle(order)
    rows = [(order[k], 0, 1, order[k + 1] if k + 1 < n else None, 0 if k + 1 < n else None, 1 if k + 1 < n else None, 1, k % 2, k) for k in range(n)]
    df = spark.createDataFrame(rows, "c long, d long, x long, nc long, nd long, nx long, arcs long, leaves long, saved long")
    got = {r.c: (r.arcs, r.leaves, r.saved) for r in list_ranks(df, few=400).collect()}
    assert got == {order[k]: (k, k // 2, k * (k - 1) // 2) for k in range(n)}


def test_blocks_smaller_than_the_trie(monkeypatch):
    """Whatever the blocks, the joined stretches make one list that holds all arcs."""
    import pyarrow as pa

    nodes = [(0, 0, None, 0, None), (0, 1, 0, 0, 1), (0, 2, 0, None, 2), (2, 2, 0, None, None), (1, 1, 0, None, None)]
    names = ["conv_id", "depth", "parent_conv_id", "first_child", "sibling"]
    rows = [dict(zip(names, n)) | {"saving": 1} for n in nodes]
    types = pa.schema([(n, pa.int64()) for n in [*names, "saving"]])
    for cut in range(len(rows) + 1):
        found = {}
        for part in (rows[:cut], rows[cut:]):
            if part:
                for out in prefixtrie._joined(pa.Table.from_pylist(part, types)):
                    found |= {(r["c"], r["d"], r["x"]): r for r in out.to_pylist() if r["c"] is not None}
        at, arcs = (0, 0, 0), 0
        while at[0] is not None:
            arcs += found[at]["arcs"]
            at = (found[at]["nc"], found[at]["nd"], found[at]["nx"])
        assert arcs == 2 * len(rows)
