"""Mixing, url rules, shared lines, languages: against plain versions and on odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shiplens.llm import langid, linededup, mixing, urlrules
from tests.llm.conftest import SCHEMA

# ---- mixing


def plain_fill(budget, children):
    """children: name -> (weight, capacity); integer water filling."""
    given, left = {}, budget
    open_ = sorted(children, key=lambda n: (children[n][1] / children[n][0], n))
    while open_:
        total = sum(children[n][0] for n in open_)
        n = open_[0]
        w, c = children[n]
        if c * total > w * left:
            return given | {m: children[m][0] * left // total for m in open_}
        given[n], left = c, left - c
        open_.pop(0)
    return given


def plain_mix(rows, budget, epochs, seed, weights):
    supply = Counter()
    for _, leaf, n in rows:
        supply[leaf] += n
    supply = {k: v for k, v in supply.items() if v}
    capacity = Counter()
    for leaf, n in supply.items():
        for d in range(len(leaf) + 1):
            capacity[leaf[:d]] += n * epochs
    given = {(): budget}
    for d in range(2):
        for node in [n for n in given if len(n) == d]:
            kids = {n[-1]: (weights.get(n[-1], 1), capacity[n]) for n in capacity if len(n) == d + 1 and n[:d] == node}
            given |= {(*node, k): v for k, v in plain_fill(given[node], kids).items()}
    out = Counter()
    for leaf, n in supply.items():
        whole, rest = divmod(given[leaf], n)
        order = defaultdict(int)
        for doc, at, tokens in rows:
            if at == leaf:
                order[hashlib.md5(f"{seed}:{whole + 1}:{doc}".encode()).hexdigest()] += tokens
        taken, upto = set(), 0
        for key in sorted(order):
            upto += order[key]
            if upto > rest:
                break
            taken.add(key)
        for doc, at, _ in rows:
            if at == leaf:
                times = whole + (hashlib.md5(f"{seed}:{whole + 1}:{doc}".encode()).hexdigest() in taken)
                out.update((doc, leaf, e) for e in range(1, times + 1))
    return out


@pytest.mark.parametrize("share", [0.1, 0.7, 1.3, 5.0])
def test_mixture_equals_plain_water_filling(spark, share):
    rng = random.Random(int(share * 10))
    rows = [(k, (rng.choice("aab"), rng.choice("wwwwxyz")), rng.randrange(0, 30)) for k in range(400)]
    rows += [(3, ("a", "w"), 7), (3, ("a", "w"), 7), (900, ("c", "w"), 0)]
    budget = int(share * sum(r[2] for r in rows))
    docs = spark.createDataFrame([(d, *leaf, n) for d, leaf, n in rows], "doc_id long, top string, low string, n long")
    weights = {"a": 5, "b": 2, "w": 3, "x": 9}
    got = mixing.mix_sources(
        docs, {"top": F.col("top"), "low": F.col("low")}, {"top": weights, "low": weights}, F.lit(budget), epochs=2, seed=11, tokens=F.col("n")
    )
    assert Counter((r.doc_id, (r.top, r.low), r.epoch) for r in got.collect()) == plain_mix(rows, budget, 2, 11, weights)


def test_shortage_goes_to_siblings_first(spark):
    docs = spark.createDataFrame(
        [(k, "a", "poor", 1) for k in range(10)] + [(100 + k, "a", "rich", 1) for k in range(500)] + [(1000 + k, "b", "only", 1) for k in range(500)],
        "doc_id long, top string, low string, n long",
    )
    got = mixing.mix_sources(docs, {"top": F.col("top"), "low": F.col("low")}, {}, F.lit(400), epochs=1, tokens=F.col("n"))
    assert {r.low: r["count"] for r in got.groupBy("low").count().collect()} == {"poor": 10, "rich": 190, "only": 200}


def test_mixture_of_odd_documents(odd, clashing, none):
    def mix(docs):
        return mixing.mix_sources(docs, {"lang": F.col("lang"), "source": F.col("source")}, {"lang": {"es": 3}}, F.expr("total div 2"))

    got, more = mix(odd), mix(clashing)
    assert got.columns == [*odd.columns, "epoch"] and more.columns == [*clashing.columns, "epoch"]
    key = lambda df: sorted((str(r.doc_id), len(r.text or ""), r.epoch) for r in df.collect())
    assert key(got) == key(more) and key(got) and all(r["whole"] == "old whole" for r in more.collect())
    assert mix(none).count() == 0


# ---- url rules

RULES = [("org", "/", "allow"), ("x.org", "/a", "block"), ("x.org", "/a/b", "allow"), ("x.org", "/a/b/", "block"), ("Y.x.org", "/", "block"), ("com", "", "block"), ("x.org", "/é", "block"), ("x.org", "/a", "allow"), (None, "/", "block"), ("z", None, "block")]


def plain_verdict(url, otherwise="allow"):
    if url is None or "://" not in url:
        return "", "", None, otherwise
    rest = url.split("://", 1)[1]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [(len(h) + len(p), h.count("."), h.lower() + p, v) for h, p, v in RULES if h and p is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    if not fits:
        return host, path, None, otherwise
    best = max(fits)
    return host, path, best[2], best[3]


def test_urls_are_judged_by_the_longest_rule(spark):
    rng = random.Random(4)
    hosts = ["org", "x.org", "X.ORG", "y.x.org", "q.y.x.org", "com", "a.com", "xx.org", "net", "", "a..org", ".org", "z"]
    paths = ["", "/", "/a", "/a/b", "/a/b/c", "/ab", "/é/x", "/a/b/c?x=/a", "#/a", "?/a"]
    urls = [None, "", "no scheme", "://", "http://", "a://b://x.org/a", "http://" + "a." * 3000 + "org/a", "http://x.org/a" + "b/" * 50_000]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)] + ["http://x.org/a/b/c"] * 300
    docs = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"rule": F.lit("old"), "_best": F.lit("old"), "site": F.lit("s"), "a.b": F.lit(1)})
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = urlrules.judge_urls(docs, rules)
    assert got.columns == ["page_id", "url", "_best", "site", "a.b", "host", "path", "rule", "verdict"]
    for r in got.collect():
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(urls[r.page_id]), urls[r.page_id][:80]
    assert got.count() == len(urls)
    none = urlrules.judge_urls(docs, rules.filter("host = 'q'"), otherwise="block")
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "block")} and none.count() == len(urls)
    assert urlrules.judge_urls(docs.filter("page_id < 0"), rules).count() == 0


def test_deep_stack_of_rules(spark):
    path = "/" + "/".join(map(str, range(60)))
    rules = [("h", path[:k], "block" if k % 2 else "allow") for k in range(1, len(path) + 1)]
    urls = [(k, "s://h" + path[:k] + "~") for k in range(1, len(path) + 1)]
    got = urlrules.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert all(r.rule == "h" + path[: r.page_id] for r in got.collect())


# ---- shared lines


def plain_lines(rows, sites):
    places, spread = {}, defaultdict(set)
    order = lambda r: (r[0] is None, r[0] or 0)
    for r in rows:
        for pos, line in enumerate((r[1] or "").split("\n")):
            if line.strip(" "):
                spread[line] |= {r[3]} - {None}
                places[line] = min(places.get(line, (order(r), pos)), (order(r), pos))
    shared = {x for x, s in spread.items() if len(s) >= sites}
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], None, 0))
            continue
        lines = r[1].split("\n")
        kept = [x for pos, x in enumerate(lines) if x not in shared or places[x] == (order(r), pos)]
        out.append((r[0], "\n".join(kept), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("sites", [2, 5])
def test_shared_lines_leave_all_but_the_first(spark, sites):
    rng = random.Random(sites)
    lines = [f"line {k}" for k in range(30)] + ["", " "]
    rows = [(k, "\n".join(rng.choice(lines) if rng.random() < 0.6 else f"own {rng.random()}" for _ in range(rng.randrange(6))), "en", rng.choice([None, *"abcdefgh"]), 1) for k in range(150)]
    got = linededup.remove_shared_lines(spark.createDataFrame(rows, SCHEMA), sites=sites)
    assert sorted((r.doc_id, r.text, r.lines_removed) for r in got.collect()) == sorted(plain_lines(rows, sites))


def test_many_sites_need_no_exact_count(spark):
    rows = [(k, "shared\n" + f"own {k}", "en", f"s{k}", 1) for k in range(300)]
    got = linededup.remove_shared_lines(spark.createDataFrame(rows, SCHEMA), sites=10)
    assert got.filter("lines_removed = 1").count() == 299


def test_shared_lines_of_odd_documents(odd, clashing, none):
    got, more = linededup.remove_shared_lines(odd, sites=2), linededup.remove_shared_lines(clashing, sites=2)
    key = lambda df: sorted((str(r.doc_id), r.text or "", r.lines_removed) for r in df.collect())
    assert key(got) == key(more) and more.columns == [*clashing.columns, "lines_removed"]
    assert {r.doc_id for r in got.filter("text is null").collect()} == {4, None}
    assert got.filter("doc_id = 1").first().text.startswith("The river") and got.count() == odd.count()
    assert linededup.remove_shared_lines(none).count() == 0


# ---- languages


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fitted, held = docs.filter("pmod(xxhash64(doc_id), 2) = 0"), docs.filter("pmod(xxhash64(doc_id), 2) = 1")
    model = langid.train(fitted, size=50)
    told = langid.identify(held.withColumn("lang", F.lit(None).cast("string")), model).join(held.select("doc_id", "lang"), "doc_id")
    n, right = told.count(), told.filter("language = lang").count()
    assert right / n > 0.98 and told.filter("accepted").count() / n > 0.99


@pytest.fixture(scope="module")
def model(given):
    return langid.train(given, size=60)


def test_evidence_adds_up(spark, model):
    rows = [(1, "the", "de", None, 1), (2, "the", None, None, 1), (3, "", "fr", "http://a.fr/x", 1), (4, "ђжшчћ ђжшчћ дђжш " * 40, "en", None, 1), (5, "12 34 ?!", "en", None, 1)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert got[2].confidence > got[1].confidence or got[1].language != got[2].language
    assert got[3].language == "fr" and got[3].text_language is None and not got[3].accepted
    assert not got[4].accepted and not got[5].accepted


def test_host_prior_decides_where_the_text_cannot(spark, model, given):
    german = given.filter("lang = 'de'").select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("x.host").alias("source"), "n_chars")
    short = spark.createDataFrame([(9_999, "ta", None, "x.host", 2), (9_998, "ta", None, "y.other", 2)], SCHEMA)
    got = {r.doc_id: r for r in langid.identify(german.unionByName(short), model).filter("doc_id >= 9998").collect()}
    assert got[9_999].language == "de"
    even = langid.identify(short, model).filter("doc_id = 9999").first()
    assert got[9_999].confidence > even.confidence or even.language != "de"


def test_languages_of_odd_documents(spark, odd, clashing, none, model):
    key = lambda df: sorted(((r.doc_id, r.language, r.accepted) for r in df.collect()), key=str)
    got = key(langid.identify(odd, model))
    assert got == key(langid.identify(clashing, model)) and len(got) == odd.count()
    assert langid.identify(none, model).count() == 0 and langid.train(none) is None
    assert {r[1:] for r in key(langid.identify(odd, None))} == {(None, False)}
    assert langid.train(odd).languages == ["en", "es"]


def test_every_label_is_a_language(spark):
    """Seventy labels, the last the rarest, some in two cases; a language of its own letters each."""

    def prose(lang, draw):
        letters = random.Random(lang).sample("abcdefghijklmnopqrstuvwxyz", 6)
        own = random.Random(lang + 1)
        words = ["".join(own.choices(letters, k=5)) for _ in range(20)]
        return " ".join(draw.choices(words, k=80))

    draw, names = random.Random(3), [f"l{n:02}" for n in range(70)]
    rows = [(n * 10 + j, prose(n, draw), names[n].upper() if j == 1 else names[n], None, 1) for n in range(70) for j in range(2 if n == 69 else 3)]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == names
    held = [(n, prose(n, draw), names[n].upper(), None, 1) for n in range(70)]
    told = langid.identify(spark.createDataFrame(held, SCHEMA), model).collect()
    assert [(r.language, r.accepted) for r in sorted(told, key=lambda r: r.doc_id)] == [(x, True) for x in names]


def test_long_text_in_pieces(spark, model, given, monkeypatch):
    rows = given.select("doc_id", F.lower("text").alias("text"))
    whole = {r.doc_id: r.means for r in langid.text_scores(rows, model, ["doc_id"]).collect()}
    monkeypatch.setattr(langid, "CELLS", 100)
    for r in langid.text_scores(rows, model, ["doc_id"]).collect():
        assert r.means == pytest.approx(whole[r.doc_id], abs=1e-9)


def test_suffixes():
    for address, want in {"http://a.DE/x": "de", "b.fr": "fr", "src0": None, "http://x.com/a.de": None, "x.es:80/": "es", None: None}.items():
        m = re.match(r"^(?:[^/?#]*://)?([^/?#:]*)", address or "")
        s = re.search(r"\.([A-Za-z]{2})$", m[1])
        assert (s and s[1].lower()) == want


def test_the_language_model_counts_every_labelled_document(spark):
    """One word that only the last of 400 documents has is counted."""
    rows = [(i, "common words of this", "aa") for i in range(399)] + [(399, "zzqqzz", "AA"), (400, "other letters", None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    code = int(langid.trigram_codes(b"zqq")[0])
    assert model.languages == ["aa"]
    assert model.logp[code, 0] > model.logp.min() + 1
