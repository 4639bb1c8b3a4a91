"""Token counts, leaks, main text, personal data: each against a plain version."""

import random
import re
from collections import Counter
from html import unescape

import pytest
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiplens.llm import maintext, pii, tiling, wordpiece
from shiplens.llm.labelled_pages import BARE_PAGES, PAGES, named_pages
from shiplens.llm.queries import VOCABULARY

# ---- token counts


def plain_count(word, first, rest):
    n = at = 0
    while at < len(word):
        pieces = first if at == 0 else rest
        size = next((k for k in range(len(word), at, -1) if word[at:k] in pieces), None)
        if size is None:
            return 1
        n, at = n + 1, size
    return n


@over(
    st.sets(st.text("ab", min_size=1, max_size=4).map(str.encode), max_size=8),
    st.sets(st.text("abc", min_size=1, max_size=4).map(str.encode), max_size=8),
    st.text("abc", max_size=14).map(str.encode),
)
@settings(max_examples=400, deadline=None)
def test_automaton_counts_greedy_pieces(first, rest, word):
    assert wordpiece.LongestMatch(first, rest).count(word) == plain_count(word, first, rest)


def test_counts_equal_a_public_wordpiece(spark, given):
    from tokenizers import Tokenizer, models, pre_tokenizers

    words = sorted({w for r in given.collect() for w in r.text.split()})
    rng = random.Random(3)
    pieces = {c for w in words for c in w[:1]} | {"##" + c for w in words for c in w[1:]}
    pieces |= {w[: rng.randrange(1, 6)] for w in words[:3000]} | {"##" + w[2 : 2 + rng.randrange(1, 6)] for w in words[:3000] if len(w) > 2}
    vocabulary = {p: k for k, p in enumerate(sorted(pieces))} | {"[UNK]": len(pieces)}
    other = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**6))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    got = wordpiece.token_counts(given, [p.encode() for p in sorted(pieces)], mark=b"", continues=b"##").collect()
    want = {r.doc_id: len(other.encode(r.text, add_special_tokens=False).ids) for r in given.collect()}
    assert {r.doc_id: r.n_tokens for r in got} == want


def test_counts_of_odd_documents(spark, odd, clashing, none):
    pieces = wordpiece.ranked_vocabulary(spark, VOCABULARY)
    known = set(pieces)
    got = sorted(wordpiece.token_counts(odd, pieces).select("doc_id", "n_words", "n_tokens").collect(), key=str)
    assert got == sorted(wordpiece.token_counts(clashing, pieces).select("doc_id", "n_words", "n_tokens").collect(), key=str)
    want = []
    for r in odd.collect():
        words = re.findall(r"[^ \t-\r]+", r.text or "")
        n = sum(plain_count(b" " + w.encode(), known, known) for w in words) if len(words) < 100 and len(r.text or "") < 1000 else None
        want.append((r.doc_id, len(words), n))
    for a, b in zip(got, sorted(want, key=str)):
        assert a[:2] == b[:2] and (b[2] is None or a[2] == b[2])
    assert wordpiece.token_counts(none, pieces).count() == 0
    assert {r.n_tokens for r in wordpiece.token_counts(odd, []).filter("n_words > 0").collect() if r.n_words == r.n_tokens} != set()


# ---- leaks


def plain_tiles(item, doc, least):
    """Greedy string tiling by its definition: the longest free match first, again and again."""
    in_item, in_doc, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = (least - 1, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and not in_item[a + n] and not in_doc[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return tiles
        tiles.append(best)
        for k in range(n):
            in_item[a + k] = in_doc[b + k] = True


@over(st.lists(st.sampled_from("abcd"), min_size=3, max_size=25), st.lists(st.sampled_from("abcde"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_tiles_cover_as_by_definition(item, doc):
    bench = tiling.Benchmark([(1, " ".join(item))], 3, 0.0)
    got = bench.leaks(" ".join(doc))
    want = plain_tiles(item, doc, 3) if len(doc) >= 3 else []
    share = sum(t[0] for t in want) / len(item)
    assert (got[0][1] if got else 0.0) == pytest.approx(share)


def test_leaks_with_gaps_and_new_order(spark):
    words = [f"w{k}" for k in range(40)]
    item = " ".join(words)
    docs = [
        (1, "Intro. " + item.upper() + ". End"),
        (2, " ".join(words[20:]) + " some words between " + " ".join(words[:20])),
        (3, " ".join(words[:19] + ["changed"] + words[20:])),
        (4, " ".join(words[:20])),
        (5, " ".join(w for k in range(0, 40, 4) for w in (*words[k : k + 4], "z"))),
        (6, "two words"), (7, None), (8, ""), (9, "two words more"),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, "Two, words!"), (12, None), (13, ""), (14, "?!")], "item_id long, text string")
    want = [(1, 10, 1.0, 1), (2, 10, 1.0, 2), (3, 10, 0.975, 2), (6, 11, 1.0, 1)]
    for size in (32 << 20, 64):  # in one block and in several
        got = tiling.leaked_items(docs, bench, block_bytes=size).drop("row_key").collect()
        assert sorted(tuple(r) for r in got) == want
    assert tiling.leaked_items(docs, bench.filter("item_id < 0")).count() == 0


def test_repeated_words_and_long_texts():
    item = "la " * 5000
    bench = tiling.Benchmark([(1, item), (2, "intro " + "la " * 3000 + "outro words here at the end")], 5, 0.8)
    doc = "la " * 1_000_000
    assert bench.leaks(doc) == [(1, 1.0, 1), (2, pytest.approx(3000 / 3007), 1)]
    assert bench.leaks("so " + "la la la la " * 40 + "la") == []


def test_scripts_without_blanks():
    item = "東京は日本の首都であり、人口は千四百万人を超える。"
    bench = tiling.Benchmark([(1, item), (2, "กรุงเทพมหานครเป็นเมืองหลวง")], 5, 0.8)
    assert bench.leaks("前書き。" + item + "後書きもある。")[0][:2] == (1, 1.0)
    assert bench.leaks("คำนำ กรุงเทพมหานครเป็นเมืองหลวง จบ")[0][:2] == (2, 1.0)
    assert bench.leaks("大阪は日本の西にある大きな町である。") == []


def test_leaks_in_the_given_documents(spark, given, odd, clashing, none):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, tiling.tokens(r.text)) for r in bench.collect()]
    want = set()
    for r in given.collect():
        doc = tiling.tokens(r.text)
        for item, words in items:
            if len(set(words) & set(doc)) > len(set(words)) * 0.6:
                grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
                if sum(tuple(doc[i : i + 5]) in grams for i in range(len(doc) - 4)) * 5 >= len(words) * 0.8:
                    tiles = plain_tiles(words, doc, 5)
                    if sum(t[0] for t in tiles) >= 0.8 * len(words):
                        want.add((r.doc_id, item))
    assert {(r.doc_id, r.item_id) for r in tiling.leaked_items(given, bench).collect()} == want and want
    assert tiling.leaked_items(odd, bench).count() == tiling.leaked_items(clashing, bench).count()
    assert tiling.leaked_items(none, bench).count() == 0


# ---- main text

MODEL = maintext.train([*PAGES, *BARE_PAGES, *named_pages()])


def test_messages_equal_summing_over_all_states():
    from itertools import product

    page = maintext.parse(PAGES[4])
    look = [MODEL._look(f) for f in maintext.features(page)][:7]
    page.tags, page.parents, page.words, page.labels = page.tags[:7], page.parents[:7], page.words[:7], page.labels[:7]
    page.chunks = [c for c in page.chunks if c[1] < 7]
    look = [MODEL._look(f) for f in maintext.features(page)]
    total, main = 0.0, [0.0] * 7
    for states in product(range(3), repeat=6):
        states = (maintext.AROUND, *states)
        p = 1.0
        for v in range(7):
            p *= look[v][states[v]] if v else look[0][0]
            if v:
                p *= MODEL.given[states[page.parents[v]]][states[v]]
        total += p
        for v in range(7):
            main[v] += p * (states[v] == maintext.MAIN)
    assert MODEL.marginals(page) == pytest.approx([m / total for m in main])


def test_each_labelled_page_read_by_a_model_of_the_others():
    pages, right, every = [*PAGES, *BARE_PAGES, *named_pages()], 0, 0
    for k, html in enumerate(pages):
        model = maintext.train(pages[:k] + pages[k + 1 :])
        page = maintext.parse(html)
        states, inside = maintext._states(page), model.marginals(page)
        for _, element, text, _ in page.chunks:
            if text.strip():
                every += len(text)
                right += len(text) * ((inside[element] > 0.5) == (states[element] == maintext.MAIN))
    assert right / every > 0.9


def test_main_text_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in maintext.extract_main_text(pages, MODEL).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_bare_text_stays():
    bare = "Some bare article text, which stands in the body and in nothing else."
    assert MODEL.main_text(f"<html><body>{bare}<br><br>Second paragraph, with a stop.</body></html>") == f"{bare} Second paragraph, with a stop."
    assert MODEL.main_text(f"<font>An old page about ships. It is long enough.<p>{bare}</p></font>") == f"An old page about ships. It is long enough.\n\n{bare}"
    assert MODEL.main_text("text") == "text" and MODEL.main_text("<body>one &amp; two</body>") == "one & two"
    mixed = f"<article><h1>Head</h1>{bare}<p>{bare}</p>{bare}<ul><li>Point one</li></ul>And an end, at last.</article>"
    nav = "<nav><a href='/'>Home</a> <a href='/n'>News</a></nav>"
    assert MODEL.main_text(f"<body>{nav}{mixed}<footer>&copy; us</footer></body>") == "\n\n".join(["Head", bare, bare, bare, "Point one", "And an end, at last."])


#: Pages of layouts that no labelled page has: {m..} is main text, the rest is not.
HELD_OUT = (
    "<body bgcolor=white><table width=100%><tr><td><a href=/>Main</a> <a href=/x>Archive</a></td></tr></table><table><tr><td>{The mill stands where two streams meet, and it has done so for six hundred years.}<br><br>{Nobody knows who built it.} {A charter of 1423 names a miller, but not his mill.}</td></tr></table><hr><small>Last change: 3 May 1998</small></body>",
    "<div id=app><div class=topbar><a href=/>Logo</a><a href=/login>Log in</a></div><div class=layout><div class=col-left><a href=/1>First</a><a href=/2>Second</a><a href=/3>Third</a></div><div class=reader><h1>{On mills}</h1><div class=para>{A mill needs water, and water needs a slope.}</div><div class=para>{Where there is none, people built weirs; some of them still hold.}</div></div></div><div class=legal>Terms and privacy. All rights reserved.</div></div>",
    "<body><h1>{A letter from the coast}</h1>{Dear all, the storm has passed and the boats are safe.}<p>{We lost two nets, but nobody was hurt, which is what counts.}</p><p>{Write soon.}</p><hr><a href=/prev>Earlier letter</a> <a href=/next>Later letter</a></body>",
    "<header class=masthead><h2>The Evening Paper</h2></header><main><h1>{Ferry stops for the winter}</h1><p class=standfirst>{The last boat leaves on Sunday at noon, the company said.}</p><p>{Passengers have to take the bridge until March. It adds an hour to the way.}</p><div class=newsletter-box><p>Sign up for our letter and read it every morning.</p></div><p>{The company hopes for a mild winter.}</p></main><section class=comments><p>I will miss it. It was always late, but it came.</p></section>",
    "<body><center><b>Home page of the river club</b></center><ul><li><a href=/a>About</a></li><li><a href=/t>Trips</a></li></ul><h3>{Trip to the falls}</h3><p>{We met at six, which was early, and drove north for three hours.}</p><p>{The falls were higher than we had thought.} <i>{Nobody fell in.}</i></p><address>Mail the keeper of these pages.</address></body>",
    "<div class=blog><div class=post><h2 class=post-title>{How I mend a net}</h2><div class=post-body><p>{First find the hole, and cut it square.}</p><ol><li>{Tie on at a corner.}</li><li>{Work along the row, one knot for each mesh.}</li></ol><p>{It takes an evening.}</p></div><div class=post-tags><a href=/t/net>net</a><a href=/t/boat>boat</a></div></div><div class=sidebar><h4>About me</h4><p>I fish and I write about it, mostly in that order.</p></div></div>",
    "<html><body><div class=cookie-bar>We use cookies. <button>Fine</button></div><article><header><h1>{The price of salt}</h1></header><section><p>{Salt was once worth its weight in silver, or so they say.}</p><p>{It never was, but it made towns rich.}</p></section><section><h2>{Roads of salt}</h2><p>{From the coast it went inland on mules; the roads are still there.}</p></section></article><div class=ad-slot>Boots at half price!</div></body></html>",
    "<frameset></frameset><noframes><body>{This page tells the story of a lighthouse, from its first lamp to its last.}<br>{It was lit in 1811, and put out in 1975.}</body></noframes>",
    "<body><pre>{A poem of the sea}\n{The tide comes in, the tide goes out,}\n{and nobody asks it why.}</pre><p><a href=/>Back to all poems</a></p></body>",
    "<div role=navigation><a href=/>Start</a><a href=/map>Map</a></div><div role=main><h1>{Walk five}</h1><p>{Start at the church and go down to the water.}</p><table><tr><td>{Length}</td><td>{nine miles}</td></tr></table><p>{Mind the cows, which mind you less.}</p></div><div role=contentinfo>The walkers of the valley, since 1962.</div>",
)


def held_out_scores():
    """Share of what is kept that is main text, and share of main text that is kept, by words of each page."""
    out = []
    for page in HELD_OUT:
        main = " ".join(unescape(re.sub(r"<[^>]+>", " ", x)) for x in re.findall(r"\{(.*?)\}", page, re.S)).split()
        got = MODEL.main_text(page.replace("{", "").replace("}", "")).split()
        right = sum((Counter(main) & Counter(got)).values())
        out.append((right / len(got) if got else 0.0, right / len(main)))
    return out


def test_pages_of_other_layouts():
    scores = held_out_scores()
    precision, recall = (sum(s[k] for s in scores) / len(scores) for k in (0, 1))
    assert precision > 0.85 and recall > 0.9, scores


def test_odd_pages(spark):
    body = "<p>One line of text that is long enough to be read, and then some more.</p>"
    rows = [
        (1, "u", None), (1, "u", None), (2, None, ""), (None, "u", "<"), (3, "u", "<p>&eacute;&#233;&amp;lt; a < b</p>" + body),
        (4, "u", "<!-- open " + body), (5, "u", "<script>var t='</p>'"), (6, "u", "<div>" * 20_000 + "x"), (7, "u", "<a href=\"" + "x" * 100_000),
        (8, "u", "</p></div></body>" + body), (9, "u", "plain text only, without any element at all, but with a stop."), (10, "u", "<p " + "a='" * 50_000),
        (11, "u", "<article>" + "<p>word, word and word again.</p>" * 30_000 + "</article>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("old"), "n_chars": F.lit(1)})
    got = maintext.extract_main_text(pages, MODEL).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert text[1] == text[2] == text[5] == "" and text[11].count("\n\n") == 29_999
    assert text[3].startswith("éé&lt; a < b\n\nOne line")
    assert text[8].startswith("One line") and text[9] == "plain text only, without any element at all, but with a stop."
    assert maintext.extract_main_text(pages.filter("page_id < 0"), MODEL).count() == 0


# ---- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    values = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}
            if ok[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def spans(docs):
    found = pii.find_personal_data(docs)
    return found.select("doc_id", "base", "added", pii.span_list(F.col("base")).alias("b"), pii.span_list(F.concat("base", "added")).alias("every")).collect()


def test_base_spans_of_random_texts(spark):
    rng = random.Random(9)
    parts = ["1", "23", "456", "4111", ".", ".", "-", " ", "@", "a", "b_c", "+", "+1 ", "(", ")", "é", "😀", ",", "255.", "999.", "x.de", "a@b.c", "5500 0000 0000 0004"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for k in range(3000)]
    for r in spans(spark.createDataFrame(rows, "doc_id long, text string")):
        assert r.b == plain_base(rows[r.doc_id][1])


def test_base_spans_of_long_runs(spark):
    rows = list(enumerate([
        "1 " * 30_000, "4" * 50_000, "a" * 50_000 + "@", "1.1" * 20_000, "+1" * 20_000, "a@b.c" * 2_000, "+1 (736) 555-2678", None, "",
        "1.2.3.4.5.6.7.8 999.1.1.1.5.6.7.8 1.2.3", "a@b.c_d@e.f a@b.c@d.e x@y..z", "++1 736 555 2678 +1234567890123456",
    ]))
    got = {r.doc_id: r.b for r in spans(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got == {k: plain_base(t) for k, t in rows}


def test_method_adds_what_examples_show(spark, given):
    texts = ["Please phone (415) 555-0199 soon", "mail me at joe.x(at)example.org thanks", "on 2023-11-05 or 12-14-16 here", "sum 10,200,300,400"]
    docs = given.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    got = {r.doc_id: r for r in spans(docs)}
    assert [(s.kind, s.start, s.end) for s in got[10_000].added] == [("phone", 13, 27)]
    assert [(s.kind, s.start, s.end) for s in got[10_001].added] == [("email", 11, 31)]
    assert not got[10_002].added and not got[10_003].added
    assert all(r.b == plain_base(t) for r, t in ((got[x.doc_id], x.text) for x in given.collect()))


def test_trees_learn_from_all_candidates(spark):
    """Alike candidates of which two in three are wrong, the right ones first by hash."""
    features = {f: F.lit(1.0 if f in ("is_phone", "hint") else 9.0 if f in ("length", "digits") else 0.0) for f in pii.FEATURES}
    rows = spark.range(60_000).select(F.col("id").alias("row_key"), F.lit("phone").alias("kind"), F.lit(0).alias("start"), F.lit(9).alias("end"))
    order = F.xxhash64("row_key", "kind", "start", "end")
    first = rows.orderBy(order).limit(20_000).select("row_key", F.lit(True).alias("base"))
    rows = rows.join(first, "row_key", "left").withColumn("base", F.coalesce("base", F.lit(False))).withColumns(features).cache()
    found = pii.train(rows)
    assert pii.scored(rows.limit(1), found.trees).first()["score"] < pii.LEAST_SCORE
    rows.unpersist()


def test_personal_data_of_odd_documents(spark, odd, clashing, none):
    key = lambda docs: sorted(((r.doc_id, r.every) for r in spans(docs)), key=str)
    assert key(odd) == key(clashing) and len(key(odd)) == odd.count() and spans(none) == []


def test_redaction_replaces_spans(spark):
    row = spark.createDataFrame([("a b@c.de 10.0.0.1 z", [("ip", 9, 17), ("email", 2, 8)])], "text string, spans array<struct<kind:string,start:int,end:int>>")
    assert row.select(pii.redact(F.col("text"), F.col("spans"))).first()[0] == "a [email] [ip] z"
