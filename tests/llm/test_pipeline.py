"""Each stage against a plain version on its own input, and on odd rows; queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shiplens.llm.queries import ORACLES, QUERIES
from tests.llm.test_near_duplicates import plain_fingerprint, plain_groups
from tests.llm.test_sources import plain_lines
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, FOLDER, name, con)[0] is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["languages", "shared_lines", "near_duplicates", "decontaminate", "mix"]


def stage_of(name):
    return dict(corpus_pipeline.STAGES)[name]


def plain(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_stages_in_turn(spark, given):
    docs = given
    told = stage_of("languages")(spark, docs, FOLDER)
    assert told.columns == docs.columns and plain(told) == plain(docs)  # all of them are clean
    rows = plain(told)
    lines = stage_of("shared_lines")(spark, told, FOLDER)
    want = {d: (text, len(text)) for d, text, n in plain_lines(rows, 10) if n == 0 or text.strip(" ")}
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == want
    docs = lines.collect()
    near = stage_of("near_duplicates")(spark, lines, FOLDER)
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    groups = plain_groups(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(groups.values()))
    clean = stage_of("decontaminate")(spark, near, FOLDER)
    leaks = {r.doc_id for r in QUERIES["op8_leaked_items"](spark, FOLDER).collect()}
    # A leak found in the whole text may have lost lines, so the stage finds no others.
    assert {r.doc_id for r in near.collect()} - {r.doc_id for r in clean.collect()} <= leaks
    mixed = stage_of("mix")(spark, clean, FOLDER)
    assert mixed.columns == [*given.columns, "epoch"] and 0 < mixed.count() <= 2 * clean.count()


def test_stages_on_odd_documents(spark, odd, clashing, none):
    for name, step in corpus_pipeline.STAGES:
        more = ["epoch"] if name == "mix" else []
        for docs in (odd, clashing, none):
            out = step(spark, docs, FOLDER)
            assert out.columns == [*docs.columns, *more]
            rows = out.collect()
            assert docs is not clashing or all(r["_key"] == "old _key" for r in rows)
            assert docs is not none or rows == []


def test_languages_stage_drops_what_it_cannot_tell(spark, given):
    junk = spark.createDataFrame([(70_001, "ђжшчћ дђжшчћ " * 60, None, "src1", 1), (70_002, "12 34 --", "en", "src1", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    wrong = given.filter("lang = 'de'").limit(1).withColumns({"doc_id": F.lit(70_003).cast("long"), "lang": F.lit("fr")})
    out = stage_of("languages")(spark, given.unionByName(junk).unionByName(wrong), FOLDER)
    ids = {r.doc_id: r.lang for r in out.collect()}
    assert set(ids) == {r.doc_id for r in given.collect()} | {70_003} and ids[70_003] == "de"
