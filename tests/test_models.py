"""Forecast, topic and streaming behaviour."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiplens.catalog import QUERIES
from shiplens.operators.merge import PartitionedTable
from shiplens.plans import forecast, terms
from shiplens.streaming import builds


def test_negative_binomial_recovers_coefficients(spark):
    rng = np.random.default_rng(1)
    n = 4000
    x = rng.normal(size=(n, 2))
    off = rng.uniform(0, 1, n)
    mu = np.exp(0.5 + 0.8 * x[:, 0] - 0.4 * x[:, 1] + off)
    y = rng.negative_binomial(2.5, 2.5 / (2.5 + mu))
    df = spark.createDataFrame(pd.DataFrame({"y": y, "a": x[:, 0], "b": x[:, 1], "o": off})).repartition(5)
    m = forecast.fit_negative_binomial(df, ["a", "b"], "y", "o")
    assert m.coef == pytest.approx([0.5, 0.8, -0.4], abs=0.06)
    assert m.theta == pytest.approx(2.5, rel=0.15)


def _facts(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i, q in enumerate(["2023.Q1", "2023.Q2", "2023.Q3", "2023.Q4", "2024.Q1"]):
        for c in range(20):
            backend = float(rng.integers(1, 500))
            rows.append((f"c{c}", q, 20 - 3 * i, int(rng.integers(0, 9)), backend, backend / 2, i % 2, 0, int(rng.poisson(2 + backend / 60))))
    df = spark.createDataFrame(rows, "component string, quarter string, months int, stories int, backend double, frontend double, is_major int, is_lts int, actual int")
    base = df.where("quarter = '2023.Q1'").where("component < 'c5'").groupBy("component").agg(F.avg("actual").alias("legacy_avg"))
    return forecast.features(df, base).cache()


def test_forecast_precedence_and_walk_forward(spark):
    rows = _facts(spark)
    quarters = ["2023.Q1", "2023.Q2", "2023.Q3", "2023.Q4"]
    wf = forecast.walk_forward(rows, quarters, trees=5)
    assert {r["quarter"] for r in wf.select("quarter").distinct().collect()} == {"2023.Q3", "2023.Q4"}
    out = forecast.defect_forecast(rows, quarters, "2024.Q1", trees=5, forward=False)
    got = out.groupBy("quarter").agg(F.count("predicted").alias("n")).collect()
    assert {r["quarter"]: r["n"] for r in got} == {**{q: 0 for q in quarters}, "2024.Q1": 20}
    named = {r["quarter"] for r in out.where("model_name is not null").collect()}
    assert named == {"2024.Q1"}
    ranks = [r["predicted_pct"] for r in out.where("quarter = '2024.Q1'").collect()]
    assert min(ranks) == 0.0 and max(ranks) == 100.0


def test_soft_cap(spark):
    rows = _facts(spark)
    m = forecast.fit_all(rows, names=["NegBin"])[0]
    top = rows.agg(F.max("actual")).first()[0]
    huge = rows.withColumn("log_backend", F.lit(80.0)).withColumn("log_frontend", F.lit(80.0))
    assert m.predict(huge).agg(F.max("prediction")).first()[0] <= 3 * top


def _corpus(spark, n=600):
    """Words of three topics; the third is in two documents of a hundred."""
    draw = random.Random(1)
    words = {"en": [f"red{i}" for i in range(20)], "de": [f"blue{i}" for i in range(20)], "fr": [f"rare{i}" for i in range(12)]}
    langs = ["fr" if i % 50 == 0 else "en" if i % 2 else "de" for i in range(n)]
    rows = [(i, " ".join(draw.choices(words[x], k=30)) + " banned 77", x, None if i % 7 == 0 else f"c{i % 3}{x}") for i, x in enumerate(langs)]
    return spark.createDataFrame(rows, "d int, t string, s string, c string").repartition(4)


def test_topic_tables(spark):
    df = _corpus(spark).where("s <> 'fr'")
    stop = spark.createDataFrame([("banned",)], "word string")
    periods = {"early": F.col("d") < 300, "late": F.col("d") >= 300, "none": F.col("d") < 0}
    out = terms.topics_by_period(df, periods, text="t", source="s", component="c", customer="en", internal="de", k=2, extra_stop=stop)
    sums = out["by_source"].groupBy("period", "s").agg(F.sum("avg_gamma").alias("g"), F.sum("prop").alias("p")).collect()
    assert len(sums) == 4 and all(r.g == pytest.approx(1) and r.p == pytest.approx(100, abs=0.2) for r in sums)
    assert {r[0] for r in out["terms"].where("period = 'early'").select("term").collect()} <= {f"{c}{i}" for c in ("red", "blue") for i in range(20)}
    assert out["bigrams"].where("bigram like '%banned%' or bigram like '%77%'").count() == 0
    # Each component has documents of one source, so it has a row for each topic, source and period.
    assert out["by_component"].count() == out["by_component"].select("c", "topic", "s", "period").distinct().count() == 6 * 2 * 2
    # A topic is named by its place in the fit, but its words are the same in both periods.
    match = {r.topic: (r.match, r.shared) for r in terms.matched_topics(out["terms"], "early", "late").collect()}
    assert sorted(m for m, _ in match.values()) == [1, 2] and all(s > 0.05 for _, s in match.values())
    sides = {(r.period, r.direction) for r in out["divergence"].collect()}
    assert sides == {(p, f"{x}-skewed") for p in ("early", "late") for x in ("Customer", "Internal")}


def test_topics_beat_one_topic_and_reach_every_document(spark):
    df = _corpus(spark)
    matrix, names = terms.term_matrix(df, "d", "t", stop=("banned",))
    assert matrix.rdd.getNumPartitions() >= min(4, spark.sparkContext.defaultParallelism) and matrix.count() == 600
    model = terms.fit_topics(matrix, k=3)
    flat = terms.LDA(k=2, maxIter=5, optimizer="online", subsamplingRate=1.0).fit(matrix)
    assert model.logPerplexity(matrix) < flat.logPerplexity(matrix)
    rare = terms.topic_terms(model, names, 12).groupBy("topic").agg(F.sum(F.when(F.col("term").startswith("rare"), F.col("beta"))).alias("weight"))
    assert rare.agg(F.max("weight")).first()[0] > 0.75


def test_rounds_of_a_document_do_not_grow_with_its_words():
    """A document of ten million words settles like one of a thousand, and to the same shares."""
    from shiplens.plans import topicmodel

    draw = random.Random(3)
    beta = np.array([[draw.random() * (1.05 if i % 3 == t else 1) for i in range(300)] for t in range(3)])
    counts = np.array([float(draw.randint(1, 9)) for _ in range(300)])
    few, many = (topicmodel.document_weights(counts * n, beta, 1 / 3) for n in (1, 10_000))
    assert many[3] <= few[3] + 5
    assert np.abs(few[0] / few[0].sum() - many[0] / many[0].sum()).max() < 0.05


def test_places_of_words_are_shared_not_dropped(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma delta " * 3), (2, "alpha " * 4), (3, "x 12"), (4, None)], "d int, t string")
    matrix, names = terms.term_matrix(df, "d", "t", slots=2)
    cells = {r.d: float(sum(r.features.values)) for r in matrix.collect()}
    assert cells == {1: 12.0, 2: 4.0} and names.count() <= 2 and "alpha" in {r.term for r in names.collect()}


def test_words_of_one_hash_are_two_terms(spark, tmp_path):
    pair = ["word256557", "word276253"]
    hashes = spark.createDataFrame([(w,) for w in pair], "w string").select(F.pmod(F.xxhash64("w"), F.lit((1 << 31) - 1)))
    assert hashes.distinct().count() == 1
    data = [(1, " ".join(pair * 3)), (2, pair[0] + " other other other")]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["term_matrix_rows"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 6.0), (2, 2, 4.0)]
    df = spark.createDataFrame([(n, f"word{n} " * 3) for n in range(500)], "d int, t string")
    _, names = terms.term_matrix(df, "d", "t", slots=None)
    assert sorted(r.slot for r in names.collect()) == list(range(500))


def test_stream_resumes_and_merges(spark, tmp_path):
    src, table = tmp_path / "in", PartitionedTable(spark, str(tmp_path / "out"), "week_of date, n_events long, n_failed long", ["week_of"])
    schema = "id long, ts timestamp, bad boolean"

    def land(name, data):
        spark.createDataFrame(data, "id long, ts string, bad boolean").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(src / name))

    def run():
        s = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(src))
        builds.run_to_end(builds.upsert_to(builds.weekly(s, "ts", [], F.col("bad")), table, ["week_of"], str(tmp_path / "cp")))

    land("a", [(1, "2024-01-01 10:00:00", True), (2, "2024-01-07 23:00:00", False)])
    run()
    land("b", [(3, "2024-01-03 10:00:00", True), (4, "2024-01-08 00:00:00", False)])
    run()
    got = sorted((str(r["week_of"]), r["n_events"], r["n_failed"]) for r in table.read().collect())
    assert got == [("2024-01-01", 3, 2), ("2024-01-08", 1, 0)]
    rows = spark.read.option("recursiveFileLookup", True).parquet(str(src))
    builds.recompute_weeks(rows, table, spark.createDataFrame([(3,)], "id long"), "id", "ts", F.col("bad"))
    got = sorted((str(r["week_of"]), r["n_events"], r["n_failed"]) for r in table.read().collect())
    assert got == [("2024-01-01", 2, 1), ("2024-01-08", 1, 0)]


def test_term_matrix_deals_cells_once_and_reads_vectors_as_stored(spark):
    """The rows' query parses no vector, and the stored vectors are structs in files."""
    from shiplens.catalog import QUERIES

    out = QUERIES["term_matrix_rows"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "json" not in plan.lower().replace(".json", "") and out.count() > 0


def test_forecast_reads_the_orders_once(spark):
    """What the fits and their baselines use starts from the written facts, not from the orders again."""
    from shiplens.catalog import forecasts
    from shiplens.catalog.registry import Tables

    for df in forecasts._facts(Tables(spark, "/root/testdata/sf0.001")):
        assert df.inputFiles() and not any("orders.parquet" in f for f in df.inputFiles())


def test_baselines_of_all_folds_in_one_pass(spark):
    rows = _facts(spark).withColumn("legacy_raw", F.when(F.col("quarter") != "2023.Q2", F.col("legacy_raw") + F.col("stories")))
    quarters = ["2023.Q1", "2023.Q2", "2023.Q3", "2023.Q4"]
    got = forecast.fold_baselines(rows, quarters)
    pdf = rows.select("quarter", "legacy_raw").toPandas()
    for i, q in enumerate(quarters):
        for own in (False, True):
            values = pdf.legacy_raw[pdf.quarter.isin([q] if own else quarters[:i])].dropna()
            assert got.get((i, own)) == (pytest.approx(values.median()) if len(values) else None)
