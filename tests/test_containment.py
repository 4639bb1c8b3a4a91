"""Substring lookups against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from shiplens.operators import bridge, triage
from shiplens.operators.containment import contained


def pairs(df):
    return sorted((r["t"], r["s"]) for r in df.collect())


@pytest.mark.parametrize("size", [1, 3, 4])
def test_pairs_are_those_of_contains(spark, size):
    rnd = random.Random(size)
    word = lambda n: "".join(rnd.choice("abé😀/") for _ in range(n))
    texts = [word(rnd.randint(0, 12)) for _ in range(120)] + [None, "", "abcabc"]
    strings = [word(rnd.randint(1, 6)) for _ in range(80)] + [None, "", "abcabc", "longer than any of the texts"]
    got = contained(spark.createDataFrame([(t,) for t in texts], "t string"), "t", spark.createDataFrame([(s,) for s in strings], "s string"), "s", size)
    assert pairs(got) == sorted({(t, s) for t in texts for s in strings if t is not None and s and s in t})


def test_nothing_to_look_up(spark):
    texts = spark.createDataFrame([("abc",)], "t string")
    none = spark.createDataFrame([], "s string")
    assert contained(texts, "t", none, "s").collect() == []
    assert contained(texts.limit(0), "t", spark.createDataFrame([("a",)], "s string"), "s").collect() == []


def test_longest_part_of_a_path(spark):
    paths = spark.createDataFrame([("x/apps/cart/a.java",), ("APPS/cart",), (None,)], "p string")
    mapping = spark.createDataFrame([("apps/cart", "Cart"), ("cart", "B"), ("cart", "A"), (None, "N"), ("", "E")], "m string, c string")
    got = {r["p"]: (r["m"], r["c"]) for r in bridge.longest_contained_match(paths, "p", mapping, "m", ["c"]).collect()}
    assert got == {"x/apps/cart/a.java": ("apps/cart", "Cart"), "APPS/cart": ("cart", "A"), None: (None, None)}


def test_words_inside_words_find_a_module(spark):
    mapping = spark.createDataFrame([("a/checkouts", "Shop"), ("b/x", "Recheckouted"), ("c/y", "Invoice")], "module_path string, component_name string")
    df = spark.createDataFrame([("z/Checkout-view.java",), ("z/invoice_checkout.js",), ("z/view.js",)], "p string")
    got = {r["p"]: (r["component_name"], r["match_strategy"]) for r in bridge.match_modules(df, "p", mapping).collect()}
    assert got["z/Checkout-view.java"] == ("Recheckouted", "token_match(score=1)")
    assert got["z/invoice_checkout.js"] == ("Invoice", "token_match(score=1)") and got["z/view.js"] == (None, "no_match")


def test_blocks_by_parts_of_words(spark):
    fails = spark.createDataFrame([(1, "Cart", "x.CheckoutPage > y", "pay.java|deep/Other.js")], "id int, component string, name string, matched string")
    blocks = spark.createDataFrame([("m/shopcart/A.java",), ("m/mycheckoutpages/B.java",), ("m/Repay.java",), ("n/other.js",), ("q/none.js",)], "path string")
    named = triage.named_blocks(fails, "id", "matched", blocks, "path")
    assert sorted(r["path"] for r in named.collect()) == ["m/Repay.java", "n/other.js"]
    got = triage.blocks_for_failure(fails, "id", "name", "component", blocks, "path", named, n=4)
    assert [(r["source_rank"], r["path"]) for r in got.orderBy("source_rank", "path").collect()] == [(1, "m/Repay.java"), (1, "n/other.js"), (2, "m/shopcart/A.java"), (3, "m/mycheckoutpages/B.java")]


def test_double_stars_cross_folders():
    import re

    from shiplens.functions.paths import glob_pattern

    pattern = re.compile(glob_pattern(("lib/*/x/**", "**/gen.js")))
    assert pattern.search("lib/a/x/b/c/d.js") and pattern.search("gen.js") and pattern.search("a/b/gen.js")
    assert not pattern.search("lib/a/b/x/c.js") and not pattern.search("a/regen.js.map")


def test_paths_of_common_names_are_dealt_over_tasks(spark):
    """A few names in few bytes, each of which ends very many paths."""
    fails = spark.range(500).select("id", F.concat(F.lit("/x.java|"), F.lit("/no"), "id").alias("matched"))
    blocks = spark.range(600).select(F.concat(F.lit("d"), "id", F.lit("/x.java")).alias("path"))
    named = triage.named_blocks(fails, "id", "matched", blocks, "path")
    held = named.groupBy(F.spark_partition_id()).count().select("count").collect()
    assert sum(r[0] for r in held) == 300_000 and max(r[0] for r in held) < 250_000
