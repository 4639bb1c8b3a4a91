"""Hand-worked cases and brute-force checks of the operators."""

import collections
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplens.functions import paths as P
from shiplens.functions.similarity import fuzzy_candidates, jaro_winkler
from shiplens.operators import bridge, graph, merge, overlap, packing, periods, quality, scoring, testhealth, triage


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "x string").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("hot", "chunk"), [(20_000, 5_000), (10, 7), (3, 2), (0, 1)])
@pytest.mark.parametrize("min_shared", [1, 2, 4])
def test_shared_unit_pairs_equal_brute_force(spark, hot, chunk, min_shared):
    rng = np.random.default_rng(min_shared)
    members = {("u0", f"i{i}") for i in range(40)} | {("u1", f"i{i}") for i in range(30)}
    members |= {(f"u{rng.integers(0, 12)}", f"i{rng.integers(0, 40)}") for _ in range(150)}
    df = spark.createDataFrame(sorted(members), "u string, i string")
    by_item = collections.defaultdict(set)
    for u, i in members:
        by_item[i].add(u)
    want = sorted(
        (a, b, len(by_item[a] & by_item[b]))
        for a, b in itertools.combinations(sorted(by_item), 2)
        if len(by_item[a] & by_item[b]) >= min_shared
    )
    got = overlap.shared_unit_pairs(df, "u", "i", min_shared, hot_units=hot, chunk=chunk)
    assert rows(got, "i_a", "i_b", "shared") == want


def _shuffled(plan) -> int:
    """Rows written to shuffles by a plan that has run; an exchange that is used again counts once."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _shuffled(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _shuffled(plan.plan())
    n = plan.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    return n + sum(_shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


@pytest.mark.parametrize(("units", "least", "by_two"), [(80, 2, True), (80, 3, True), (5, 2, False)])
def test_pairs_that_meet_once_are_not_shuffled(spark, units, least, by_two):
    rng = np.random.default_rng(units)
    items = 1600 if by_two else 60
    members = {(int(u), i) for i in range(items) for u in rng.choice(units, 4, replace=False)}
    by_item = collections.defaultdict(set)
    for u, i in members:
        by_item[i].add(u)
    # As with groups: pairs only of items of different sides.
    want = sorted(
        (a, b, len(by_item[a] & by_item[b]))
        for a in by_item for b in by_item if a % 7 < b % 7 and len(by_item[a] & by_item[b]) >= least
    )
    df = spark.createDataFrame(sorted((u, i, i % 7) for u, i in members), "u int, i int, s int")
    pairs = overlap.shared_unit_pairs(df, "u", "i", least, side="s")
    assert rows(pairs, "i_a", "i_b", "shared") == want
    if by_two:
        once = sum(len(by_item[a] & by_item[b]) for a in by_item for b in by_item if a % 7 < b % 7)
        assert _shuffled(pairs._jdf.queryExecution().executedPlan()) < once / 3


def test_pairs_are_the_same_with_hot_units_set_aside(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").join(
        spark.read.parquet("/root/testdata/sf0.001/part.parquet"), F.col("l_partkey") == F.col("p_partkey")
    ).where("l_returnflag = 'R'")
    args = (t, "l_suppkey", "l_partkey", "p_brand", 5, 2, 2)
    assert rows(testhealth.cofailure_pairs(*args)) == rows(testhealth.cofailure_pairs(*args, hot_units=20))


def test_cofailure_pairs_score(spark):
    data = [(f"b{u}", i, g) for u in range(10) for i, g in (("a1", "A"), ("b1", "B"))]
    data += [(f"x{u}", "a1", "A") for u in range(2)] + [(f"y{u}", "b1", "B") for u in range(5)]
    df = spark.createDataFrame(data, "u string, i string, g string")
    r = testhealth.cofailure_pairs(df, "u", "i", "g", 10, 10, 1).first()
    assert (r["jaccard_score"], r["co_fail_builds"], r["fail_count_a"], r["fail_count_b"]) == (0.5882, 10, 12, 15)


def test_an_item_in_two_groups_counts_once(spark):
    data = [(u, "i", g) for u in range(3) for g in ("A", "B")] + [(u, "j", "B") for u in range(3)]
    df = spark.createDataFrame(data, "u int, i string, g string")
    r = testhealth.cofailure_pairs(df, "u", "i", "g", 1, 1, 1).first()
    assert r["test_pair_count"] == 2 and r["jaccard_score"] == 1.0


def test_composite_of_five_signals(spark):
    names = list(scoring.SIGNAL_WEIGHTS)
    df = spark.createDataFrame([(1, 0.6, 0.6, 0.6, 0.2, 0.2)], "e int, " + ", ".join(f"{n} double" for n in names))
    r = scoring.composite_risk(df.select("e"), [(df, "e", n) for n in names]).first()
    assert (round(r["composite_raw"], 4), r["composite_risk"], r["risk_tier"]) == (0.492, 0.5658, "HIGH")


def test_bridge_weights_of_three(spark):
    df = spark.createDataFrame([("p", c) for c in "abc"] + [("q", "a"), ("q", "a")], "l string, r string")
    got = bridge.bridge_weights(df, "l", "r")
    assert rows(got, "l", "weight") == [("p", 0.3333)] * 3 + [("q", 1.0)]


def test_periods_first_match_and_ends(spark):
    per = spark.createDataFrame([("Q1", "2024-01-01", "2024-01-10"), ("Q2", "2024-01-10", "2024-01-20")], "q string, s string, e string")
    ev = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-10"), (3, "2024-01-20"), (4, "2024-01-21")], "k int, d string")
    got = periods.assign_period(ev, F.col("d"), per, "q", "s", "e", out="period")
    assert rows(got, "k", "period") == [(1, "Q1"), (2, "Q1"), (3, "Q2")]


def test_names_versions_and_paths(spark):
    assert one(spark, "X > A|B| ", P.component_names) == ["A", "B"]
    assert one(spark, "2025.Q1.15|2025.Q2.3|7.4", P.latest_quarter) == "2025.Q2"
    assert one(spark, "modules/apps/h/h-x/h-x-impl/src/A.java", P.module_of_path) == "h-x-impl"
    assert one(spark, "modules/apps/h/h-x/A.java", P.module_of_path) == "h-x"
    assert one(spark, "portal-impl/src/A.java", P.module_of_path) == "portal-impl"
    assert one(spark, "modules/dxp/apps/a/b/c/D.java", P.module_path) == "modules/dxp/apps/a/b"
    assert one(spark, "modules/util/x/y.js", P.module_path) == "modules/util/x"
    assert one(spark, "a/b/c.xml", lambda c: c.rlike(P.glob_pattern(["**/*.xml"]))) is True
    assert one(spark, "c.xml", lambda c: c.rlike(P.glob_pattern(["**/*.xml"]))) is True
    assert one(spark, "a/c.java", lambda c: c.rlike(P.glob_pattern(["**/*.xml", "cloud/**"]))) is False
    assert one(spark, "why [culprit_file= a/B.java ] x", P.culprit_file) == "a/B.java"
    assert one(spark, "no marker", P.culprit_file) is None
    assert one(spark, "ABC-12-release", P.leading_ticket) == "ABC-12"
    for path, scored in {"a/FooTest.java": False, "x/test/a.java": False, "a/BaseFooImpl.java": False, "a/Base.java": True, "BasefooImpl.java": True}.items():
        assert one(spark, path, P.is_scored) is scored
    assert one(spark, "modules/dxp/apps/a/b", P.normalise_crosswalk_key) == "a/b"
    assert one(spark, "com.acme.search.FooTest#run", lambda c: P.name_fragments(c)) == ["FooTest.java", "search"]
    assert one(spark, "cart/add.spec.ts > adds", lambda c: P.name_fragments(c)) == ["cart"]
    assert one(spark, "LocalFile.Blog#x", lambda c: P.name_fragments(c))[0] == "Blog.java"
    assert one(spark, "Portal-Search_Engine > X-impl", P.short_name_key) == "portal search engine x"


def test_reach_with_cycle_and_diamond(spark):
    rng = np.random.default_rng(5)
    edges = [("B", "A"), ("C", "B"), ("D", "C"), ("E", "D"), ("A", "A")]
    edges += [(f"n{a}", f"n{b}") for a, b in rng.integers(0, 12, (30, 2))]
    df = spark.createDataFrame(edges, "s string, d string")
    back = collections.defaultdict(set)
    for s, d in edges:
        back[d].add(s)
    want = []
    for start in {x for e in edges for x in e}:
        seen, front = {start}, {start}
        for depth in (1, 2, 3):
            front = {n for f in front for n in back[f]} - seen
            seen |= front
            want += [(start, n, depth) for n in front]
    assert rows(graph.reach(df, "s", "d", 3), "source", "node", "depth") == sorted(want)
    nodes = df.select(F.explode(F.array("s", "d")).alias("n")).distinct()
    r = graph.blast_radius(nodes, df, "n", "s", "d").where("n = 'A'").first()
    assert (r["dependent_count"], r["transitive_count"], r["total_blast"], r["max_depth_reached"]) == (1, 2, 3, 3)


def test_retries_and_regressions(spark):
    base = spark.createDataFrame([(1, "FAILED"), (1, "PASSED"), (2, "FAILED"), (3, "PASSED"), (4, None), (4, "PASSED")], "c int, status string")
    target = spark.createDataFrame([(1, "PASSED"), (1, "FAILED"), (2, "FAILED"), (3, "PASSED"), (4, "UNTESTED")], "c int, status string")
    got = triage.regressions(base, target, ["c"])
    assert rows(got, "c", "status_b") == [(1, "FAILED"), (4, "UNTESTED")]


def test_error_rules(spark):
    assert one(spark, None, triage.error_label) == "NO_ERROR"
    assert one(spark, "x session INFO: chrome=1 TEST_SETUP_ERROR", triage.error_label) == "ENV_CHROME"
    assert one(spark, "plain", triage.error_label) is None


def test_unlinked_cases_are_groups_of_their_own(spark):
    df = spark.createDataFrame(
        [(1, None, "e"), (2, None, "e"), (3, 7, "x"), (4, 7, "y"), (5, 7, "x"), (6, 0, "")],
        "case_id int, g int, error string",
    ).withColumns({"comp": F.lit("c"), "issue": F.lit(""), "flaky": F.lit(False), "status": F.lit("FAILED"), "pre_classification": F.lit(None).cast("string")})
    got = triage.failure_groups(df, "g", "case_id", "error", "comp", "issue", "flaky", "status")
    assert rows(got, "group_key", "case_count", "shared_error") == [("c1", 1, "e"), ("c2", 1, "e"), ("c6", 1, ""), ("g7", 3, "x")]


def test_noise_filter(spark):
    df = spark.createDataFrame([(None,), ("FAILED PRIOR TO RUNNING TEST x",), ("real",)], "e string")
    assert [r[0] for r in df.where(testhealth.not_noise(F.col("e"))).collect()] == [None, "real"]


def test_scoped_failures_drop_null_types(spark):
    df = spark.createDataFrame(
        [("FAILED", "2024-01-02", "Unit", None, "r"), ("FAILED", "2024-01-02", None, None, "r"), ("PASSED", "2024-01-02", "Unit", None, "r"), ("FAILED", "2023-01-02", "Unit", None, "r"), ("FAILED", "2024-01-02", "Batch", None, "r")],
        "status string, start_date string, case_type string, errors string, routine_name string",
    )
    assert testhealth.scoped_failures(df, "2024-01-01", ["r"]).count() == 1
    names = spark.createDataFrame([("Smoke",), (None,), ("X",)], "c string")
    assert testhealth.without_components(names, "c").count() == 2


@pytest.mark.parametrize("budget", [5, 10, 1000])
def test_packing_equals_a_plain_loop(spark, budget):
    rng = np.random.default_rng(budget)
    data = [(g, p * 3, int(s)) for g in "ab" for p, s in enumerate(rng.integers(0, 14, 60))]
    df = spark.createDataFrame(data, "g string, p long, s long")
    want = []
    for g in "ab":
        used, batch = None, 1
        for _, p, s in (r for r in data if r[0] == g):
            if used is not None and used + s > budget:
                batch, used = batch + 1, 0
            used = (used or 0) + s
            want.append((g, p, s, batch))
    assert rows(packing.pack_batches(df, "g", "p", "s", budget)) == sorted(want)


def test_running_total_over_blocks(spark):
    df = spark.createDataFrame([("a", i, 1) for i in range(50)], "g string, p long, v long")
    got = packing.running_total(df, ["g"], "p", "v", "t", block=7)
    assert rows(got, "p", "t") == [(i, i + 1) for i in range(50)]


def test_merge_twice_is_the_same(spark, tmp_path):
    a = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    b = spark.createDataFrame([(2, None, 20), (3, "c", 30)], "k int, x string, y int")
    table = merge.PartitionedTable(spark, str(tmp_path / "t"), "k int, x string, y int", ["k"])
    table.merge(a, ["k"])
    files = lambda: {r[0] for r in table.read().where("k = 1").select("_metadata.file_path").collect()}
    before = files()
    for _ in range(2):
        table.merge(b, ["k"])
        assert rows(table.read().fillna("-")) == [(1, "a", 1), (2, "-", 20), (3, "c", 30)]
    table.merge(b.limit(0), ["k"])
    assert files() == before and table.read().count() == 3
    with pytest.raises(ValueError, match="keys"):
        table.merge(b, ["y"])
    # The scan of a merge names the touched partitions.
    scan = table.read_touched(b)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan and table.read_touched(b).count() == 2
    assert rows(merge.upsert_keep_old(a, b, ["k"])) == [(1, "a", 1), (2, "b", 20), (3, "c", 30)]
    assert rows(merge.upsert_columns(a, b, ["k"], ["y"]).fillna("-")) == [(1, "a", 1), (2, "b", 20), (3, "-", 30)]
    assert rows(merge.insert_if_absent(a, b, ["k"])) == [(1, "a", 1), (2, "b", 2), (3, "c", 30)]
    assert rows(merge.update_from(a, b, ["k"], {"y": "y"})) == [(1, "a", 1), (2, "b", 20)]
    gaps = spark.createDataFrame([(1, None), (2, "kept")], "k int, x string")
    fill = spark.createDataFrame([(1, "new"), (2, "other")], "k int, x string")
    assert rows(merge.update_from(gaps, fill, ["k"], {"x": "x"}, only_null=True)) == [(1, "new"), (2, "kept")]
    assert merge.add_column(a, "z", "double", 1).columns == ["k", "x", "y", "z"]
    assert merge.add_column(a, "x", "string", "").columns == a.columns


def test_sinks_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    merge.export_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    merge.append(df, str(tmp_path / "p"))
    merge.append(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 4
    merge.reload(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert merge.as_view(df, "v_kept").count() == 2


def test_longest_prefix_wins_and_tokens_follow(spark):
    mapping = spark.createDataFrame([("modules/apps/a", "A"), ("modules/apps/a/b", "AB"), (None, "Calendar Tools")], "module_path string, component_name string")
    df = spark.createDataFrame([("modules/apps/a/b/x.java",), ("modules/apps/a/c.java",), ("other/CALENDAR-view.java",), ("z/y.java",), ("modules/apps/ab/x.java",)], "p string")
    got = {r["p"]: (r["component_name"], r["match_strategy"]) for r in bridge.match_modules(df, "p", mapping).collect()}
    assert got["modules/apps/a/b/x.java"] == ("AB", "exact_module_path")
    assert got["modules/apps/a/c.java"] == ("A", "exact_module_path")
    assert got["other/CALENDAR-view.java"] == ("Calendar Tools", "token_match(score=1)")
    assert got["z/y.java"] == (None, "no_match") and got["modules/apps/ab/x.java"] == (None, "no_match")


def test_jaro_winkler_plain_formula(spark):
    assert jaro_winkler("abcdzzzz", "abqqqqqq") == pytest.approx(0.6)
    assert jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert jaro_winkler("", "a") == 0.0


@pytest.mark.parametrize("block", [1, 2, 2000])
def test_fuzzy_search_does_not_depend_on_blocks(spark, block):
    left = spark.createDataFrame([("search api",), ("blog tool",), ("zzz",)], "l string")
    right = spark.createDataFrame([(x,) for x in ("search", "blogs", "search engine", "tool", "wiki")], "r string")
    got = {r["l"]: r for r in fuzzy_candidates(left, "l", "l", right, "r", "r", block=block).collect()}
    for name, r in got.items():
        scores = []
        for (c,) in right.collect():
            words = name.split(" ")
            tok = sum(w in c.split(" ") for w in words) / len(words)
            scores.append((0.5 * jaro_winkler(name, c) + 0.5 * tok, c))
        scores.sort(key=lambda s: (-s[0], s[1]))
        assert r["component_name"] == scores[0][1]
        assert r["combined_score"] == pytest.approx(scores[0][0], abs=6e-4)
        assert r["confidence_gap"] == pytest.approx(scores[0][0] - scores[1][0], abs=6e-4)


def test_fuzzy_fragments_only_without_exact_hit(spark):
    p = spark.createDataFrame([("mod/x/Document.java",), ("mod/x/DocumentHelper.java",)], "p string")
    f = spark.createDataFrame([("document.java",), ("helper",), ("absent",)], "f string")
    got = triage.relevant_changes(p, "p", f, "f", "auto")
    assert rows(got) == [("document.java", "mod/x/Document.java", "exact"), ("helper", "mod/x/DocumentHelper.java", "fuzzy")]
    assert rows(triage.unmatched_fragments(f, "f", got)) == [("absent",)]
    assert triage.relevant_changes(p, "p", f, "f", "exact").count() == 1
    causes = spark.createDataFrame([("`a/b.java` / Page.tsx (old)",)], "c string")
    assert rows(triage.cause_fragments(causes, "c")) == [("a/b.java",), ("page.tsx",)]


def test_grouped_verdicts_reach_all_members(spark):
    members = spark.createDataFrame([(7, 1), (7, 2)], "g int, case_id int")
    v = spark.createDataFrame([(7, [1], "BUG"), (None, [9], "NEEDS_REVIEW")], "g int, case_ids array<int>, classification string")
    got = triage.members_of_verdicts(v, members, "g", "case_ids")
    assert rows(got, "case_id", "classification") == [(1, "BUG"), (2, "BUG"), (9, "NEEDS_REVIEW")]
    bad = spark.createDataFrame([(7, [1, 5]), (7, [1]), (8, [])], "g int, case_ids array<int>")
    known = spark.createDataFrame([(1,), (2,)], "case_id int")
    found = {r["rule"] for r in quality.grouped_verdict_violations(bad, known, known, "g", "case_ids").collect()}
    assert found == {"group is duplicated", "case list is empty", "case is not in the run", "case has several verdicts"}


def test_gates_raise(spark):
    df = spark.range(10)
    with pytest.raises(quality.QualityError):
        quality.require_coverage(df, F.col("id") < 5)
    quality.require_coverage(df, F.col("id") >= 0)
    with pytest.raises(quality.QualityError):
        quality.require_row_ceiling(df, 10)
    assert quality.require_row_ceiling(df, 11) == 10


def test_function_rows_are_cleaned(spark):
    df = spark.createDataFrame(
        [("./modules/apps/a/X.java", 200, 5), ("modules/third-party/y/Z.java", 1, 1), ("modules/apps/a/x.css", 1, 1), ("build/X.java", 1, 1)],
        "file string, ccn int, nloc int",
    )
    got = scoring.clean_functions(df, "file", P.EXCLUDED_COMPLEXITY_PATHS)
    assert rows(got, "file_path", "ccn", "module_path", "language") == [("modules/apps/a/X.java", 100, "modules/apps/a", "java")]


def test_names_resolve_through_aliases(spark):
    df = spark.createDataFrame([("A > B",), ("C > D",), ("Old",)], "r string")
    known = spark.createDataFrame([("A > B",), ("New",)], "n string")
    got = periods.resolve_names(df, "r", known, "n", {"Old": "New"}, "name")
    assert rows(got, "r", "name") == [("A > B", "A > B"), ("C > D", "C"), ("Old", "New")]


def test_salted_copies_are_not_broadcast(spark):
    from shiplens.operators.joins import salted_join

    many, few = spark.range(100).selectExpr("id % 5 AS k", "id AS v"), spark.range(5).selectExpr("id AS k", "id * 2 AS w")
    out = salted_join(many, few, "k", F.col("v"))
    assert sorted((r.v, r.w) for r in out.collect()) == [(i, i % 5 * 2) for i in range(100)]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_windows_of_more_failed_rows_than_units_are_low(spark, tmp_path):
    """Failures count rows, so one unit that fails three times has a rate of -2."""
    from shiplens.catalog import QUERIES

    row = "1L l_orderkey, 2L l_partkey, 3L l_suppkey, 'R' l_returnflag, 'F' l_linestatus, 0.01D l_discount, timestamp'1996-02-01' l_shipdate"
    lines = spark.range(3).selectExpr("cast(id as int) l_linenumber", *row.split(", "))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["low_pass_windows"](spark, str(tmp_path)).collect()
    assert [(r["routine"], r["window_quarter"], r["window_pass_rate"]) for r in got] == [("F", "1996.Q1", -2.0)]


def test_scope_of_orders_is_applied_before_line_items_join(spark):
    from shiplens.catalog import QUERIES

    plan = QUERIES["denormalise_results"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()

    def nodes(node):
        yield node
        for k in range(node.children().size()):
            yield from nodes(node.children().apply(k))

    joins = [n for n in nodes(plan) if n.nodeName() == "Join" and "(o_custkey" in n.simpleString(99)]
    assert len(joins) == 1 and "l_partkey" not in joins[0].output().mkString(",")


def test_bigrams_of_much_text_are_counted_in_pieces(spark, monkeypatch):
    from shiplens.plans import terms

    monkeypatch.setattr(terms, "PIECE", 1000, raising=False)
    docs = spark.range(50, numPartitions=1).select(F.lit("a").alias("lang"), F.repeat(F.concat(F.lit("word"), "id", F.lit(" other ")), 100).alias("text"))
    pairs = terms.bigrams(docs, "lang", "text")
    assert pairs.rdd.getNumPartitions() > 50 and pairs.count() == 50 * 199
    top = terms.top_bigrams(docs, "lang", "text", 3)
    assert {r["n"] for r in top.collect()} == {100}


def test_large_frontiers_are_dealt_once_and_distinct_edges_not_again(spark, monkeypatch):
    edges = spark.range(40, numPartitions=8).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).distinct().repartition(16)
    steps = []

    def held(df):
        steps.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.cache()

    monkeypatch.setattr(graph, "cut_lineage", held)
    graph.dependency_score(edges.select(F.col("a").alias("n")), edges, "n", "a", "b", written=True).count()
    assert not any("RepartitionByExpression [source" in s for s in steps)
    assert graph.degree_stats(edges.select(F.col("a").alias("n")), edges, "n", "a", "b", written=True).count() == 7
    spark.catalog.clearCache()
