"""Personal data by candidate generation and gradient boosting.

For each kind a strict generator finds the base spans and a loose one finds whatever might be one,
overlapping the base or other kinds. Boosted trees score the candidates by format and context; they
are fitted on all candidates of the corpus, in which the base spans are the positive rows, and on a
few labelled examples of what the strict patterns miss. What the trees see are small whole numbers, so
candidates that look alike are counted first and one row stands for them, with their number as weight.
Per kind the lowest score at which held-out candidates are right often enough is the threshold. Base
spans always stay.

All of it is column expressions and Spark's own tree learner. Regular expressions are written with
possessive repeats and look-behinds, so that each is linear in the text and needs no deep stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import row_key, stage, text_or_empty

KINDS = ("email", "ip", "card", "phone")

#: What the contract's patterns match, in linear form. A run that fails where it
#: starts fails further on too, hence the look-behinds; \G lets a match begin where one ended.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Loose patterns: spelt-out signs, other separators, no country code.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|[\[(]at[\])])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])(?<![0-9][\x20.-])[0-9](?:[\x20.-]?[0-9]){12,18}(?![\x20.-]?[0-9])",
    "phone": r"(?<![0-9+(])[+(]{0,2}[0-9]{1,4}+\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}+\)?){2,4}(?![0-9])",
}

#: What must be in a text before a pattern is tried at all.
NEEDED = {"email": r"@|[\[(]at[\])]", "ip": r"[0-9][.,][0-9]", "card": r"[0-9]", "phone": r"[0-9]"}

#: Words before a candidate that speak for its kind.
HINTS = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to)\b",
    "ip": r"(?i)\b(?:ip|host|server|address)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment|account)\b",
    "phone": r"(?i)\b(?:tel|phone|telephone|call|mobile|fax|cell)\b",
}

#: Labelled examples: a text with one candidate and the kind it is of, if any.
EXAMPLES = (
    ("call (415) 555-0134 today", "phone"), ("or ring 415-555-0134 after six", "phone"),
    ("phone 415 555 0134 please", "phone"), ("at (212) 555-0187 or so", "phone"),
    ("our line 020 7946 0958 is open", "phone"), ("reach us on 0044 20 7946 0958 now", "phone"),
    ("mobile 030 901 820 44 in town", "phone"), ("fax (030) 901-82044 only", "phone"),
    ("ask jane.doe(at)example.org for it", "email"), ("write to bob[at]example[dot]com now", "email"),
    ("mail carol.b @ example.net or so", "email"), ("the dan (at) mail (dot) example (dot) org box", "email"),
    ("card 4111.1111.1111.1111 was used", "card"), ("paid with 5500.0000.0000.0004 then", "card"),
    ("on 2024-01-15 we met", None), ("until 1999.12.31 it ran", None), ("from 12/05/2021 on", None),
    ("between 1990-1995 and 2001", None), ("order 1234-5678-90 came", None), ("pages 10-20-30 of it", None),
    ("ISBN 978-3-16-148410-1 in print", None), ("sum of 1,200,300,400 in all", None),
    ("about 12,500,000,100 items", None), ("the rows 100 200 300 400 add up", None),
    ("number 1234567890123456 is odd", None), ("id 40418949746087950 was kept", None),
    ("score 3-2, 14-12, 11-9 won", None), ("at 10.15 20.30 40.45 sharp", None),
    ("section 12.34.56 of 2020", None), ("totals 1000 2000 3000 4001 here", None),
    ("build 999.1.1.1 failed", None), ("release 10.20.300.400 is out", None), ("sizes 512.640.768.900 fit", None),
    ("it sold @ 3.50 then", None), ("lot 555-01 34-22 stays", None),
)
#: An example's row weighs as much as this many of the corpus, and all of them at least as much as
#: the corpus. A leaf needs a share of the weight that no single row of the corpus has: a span that
#: the strict patterns miss is an unlabelled row there, not a proven negative.
EXAMPLE_WEIGHT = 20.0
LEAST_LEAF = 0.005

#: Sizes up to this one count each for itself, larger ones in four steps for each doubling.
EXACT = 32
#: Every value of a feature may be a split, so that the learner draws no sample to find them.
BINS = 256
#: Share of selected held-out candidates that must be right.
PRECISION = 0.98
LEAST_SCORE = 0.5
BEFORE = 24

FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "length", "digits", "groups", "signs", "plus",
    "luhn", "octets", "at", "letter_before", "letter_after", "hint",
)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check: every second one from the right counts double."""
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    part = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0)))
    return F.aggregate(part, F.lit(0), lambda a, v: a + v) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:[.,]0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"


def _step(n: Column) -> Column:
    """A size as the trees see it: whole numbers, few for all lengths."""
    n = n.cast("double")
    return F.when(n <= EXACT, n).otherwise(EXACT + F.floor(F.log2(n / EXACT) * 4)).cast("double")


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(OCTETS)
    n = F.length(_digits(value))
    return luhn(_digits(value)) if kind == "card" else n.between(9, 15)


def _spans(text: Column, found: Column, pattern: str) -> Column:
    """Matches with their places in code points: the text between matches and they, in turn."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    turns = F.zip_with(
        F.split(text, pattern, -1), found, lambda gap, v: F.struct(F.length(gap).alias("gap"), F.length(v).alias("size"), v.alias("value"))
    )
    begin = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def add(acc: Column, turn: Column) -> Column:
        start = acc["at"] + turn["gap"]
        end = start + turn["size"]
        one = F.struct(start.alias("start"), end.alias("end"), turn["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    # Behind the last match there is a gap only.
    matched = F.filter(turns, lambda turn: turn["value"].isNotNull())
    return F.when(F.size(found) > 0, F.aggregate(matched, begin, add, lambda acc: acc["out"])).otherwise(none)


def _matches(text: Column, kind: str, pattern: str) -> Column:
    none = F.array().cast("array<string>")
    return F.when(text.rlike(NEEDED[kind]), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)


def _candidate(kind: str, text: Column, span: Column, base: Column) -> Column:
    """A candidate's place, whether it is a base span, and what the trees look at."""
    value, digits = span["value"], _digits(span["value"])
    before = F.substr(text, F.greatest(span["start"] - BEFORE, F.lit(0)) + 1, F.least(span["start"], F.lit(BEFORE)))
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    told = {f"is_{k}": F.lit(float(k == kind)) for k in KINDS}
    told |= {
        "length": _step(F.length(value)),
        "digits": _step(F.length(digits)),
        "groups": _step(F.size(F.split(F.regexp_replace(value, "^[^0-9]+|[^0-9]+$", ""), "[^0-9]+"))),
        "signs": _step(F.length(F.regexp_replace(value, "[A-Za-z0-9]", ""))),
        "plus": number(F.startswith(value, F.lit("+"))),
        "luhn": number(F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)),
        "octets": number(value.rlike(OCTETS)),
        "at": number(F.contains(value, F.lit("@"))),
        "letter_before": number(before.rlike(r"[\p{L}\p{N}]$")),
        "letter_after": number(F.substr(text, span["end"] + 1, F.lit(1)).rlike(r"[\p{L}\p{N}]")),
        "hint": number(before.rlike(HINTS[kind])),
    }
    return F.struct(
        F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), base.alias("base"),
        *[told[f].alias(f) for f in FEATURES],
    )


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_key``, and for each kind the base spans and all candidates of a row."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), text_or_empty(text).alias("text")
    )
    text_ = F.col("text")
    rows = rows.withColumns({f"{g}_{k}": _matches(text_, k, p[k]) for k in KINDS for g, p in (("strict", STRICT), ("loose", LOOSE))})
    rows = rows.withColumns(
        {f"{g}_{k}": _spans(text_, F.col(f"{g}_{k}"), p[k]) for k in KINDS for g, p in (("strict", STRICT), ("loose", LOOSE))}
    )
    rows = rows.withColumns({f"valid_{k}": F.filter(f"strict_{k}", lambda s: _valid(k, s["value"])) for k in KINDS})
    every = {}
    for k in KINDS:
        spans = F.array_distinct(F.concat(f"strict_{k}", f"loose_{k}"))
        every[k] = F.transform(spans, lambda s: _candidate(k, text_, s, F.array_contains(f"valid_{k}", s)))
    place = lambda k: F.transform(f"valid_{k}", lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select(
        "doc_id", "row_key", *[place(k).alias(f"base_{k}") for k in KINDS], F.concat(*every.values()).alias("candidates")
    )


@dataclass
class Selector:
    trees: GBTClassificationModel
    thresholds: dict[str, float]


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def _examples(spark: SparkSession) -> DataFrame:
    rows = [(k, text, kind) for k, (text, kind) in enumerate(EXAMPLES)]
    told = spark.createDataFrame(rows, "doc_id long, text string, told string")
    found = candidates(told).select("doc_id", "row_key", F.explode("candidates").alias("c")).join(told, "doc_id")
    label = F.col("c.kind").eqNullSafe(F.col("told")).cast("double")
    return found.select("row_key", "c.*", label.alias("label"))


def train(rows: DataFrame, precision: float = PRECISION) -> Selector | None:
    """Trees and thresholds from all candidates and the examples.

    A third of the candidates, by hash, is held out and tells the thresholds. None where the corpus
    has no candidate.
    """
    held_out = F.pmod(F.xxhash64("row_key", "kind", "start", "end"), F.lit(3)) == 0
    alike = rows.groupBy("kind", *FEATURES, F.col("base").cast("double").alias("label"), held_out.alias("held"))
    counted = stage(alike.agg(F.count("*").cast("double").alias("weight")).withColumn("told", F.lit(False)))
    weight = max(EXAMPLE_WEIGHT, (counted.agg(F.sum("weight")).first()[0] or 0.0) / len(EXAMPLES))
    told = _examples(rows.sparkSession).withColumns({"held": F.lit(False), "weight": F.lit(weight), "told": F.lit(True)})
    # One row for all candidates that look alike, in one ordered partition, so that the same rows give the same trees.
    every = counted.unionByName(told.select(*counted.columns))
    every = stage(every.coalesce(1).sortWithinPartitions("told", "held", "label", "kind", *FEATURES)).coalesce(1)
    fitted, held = every.filter("told or not held"), every.filter("held")
    if held.isEmpty():
        return None
    learner = GBTClassifier(
        maxIter=20, maxDepth=5, stepSize=0.4, seed=7, labelCol="label", featuresCol="features", weightCol="weight",
        minWeightFractionPerNode=LEAST_LEAF, maxBins=BINS,
    )
    trees = learner.fit(_assembled(fitted))
    # An example is held against the trees too: of each kind there are always some candidates.
    tried = scored(held.unionByName(every.filter("told")), trees)
    counts = (
        tried.groupBy("kind", F.floor(F.col("score") * 100).alias("step"))
        .agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("right"))
        .collect()
    )
    thresholds = {}
    for kind in KINDS:
        steps = sorted((r for r in counts if r["kind"] == kind), key=lambda r: -r["step"])
        n = right = 0.0
        for k, row in enumerate(steps):
            n, right = n + row["n"], right + row["right"]
            if right >= precision * n:
                # Down to the next step that was seen, as nothing speaks against what lies between.
                below = steps[k + 1]["step"] + 1 if k + 1 < len(steps) else 0
                thresholds[kind] = max(LEAST_SCORE, below / 100)
    return Selector(trees, thresholds)


def scored(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """``rows`` with ``score``, the trees' probability of a right candidate."""
    out = trees.transform(_assembled(rows)).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def _crosses(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_key``, ``base`` and ``added``: spans (kind, start, end) of each row of ``docs``.

    Places are in code points, the end exclusive, in the order of the kinds as listed and the start.
    A selected candidate that overlaps a base span, or a selected one of a higher score (ties: the
    kind listed first), is not added. Null and empty texts have no spans; repeated rows are returned
    as often as given; further columns are ignored. Texts are read whole; the work grows with the
    square of the spans of one text. An empty table gives no rows.
    """
    found = stage(candidates(docs, doc_id, text))
    base = F.concat(*[F.col(f"base_{k}") for k in KINDS])
    slim = found.select("doc_id", "row_key", base.alias("base"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    rows = found.select("row_key", F.explode("candidates").alias("c")).select("row_key", "c.*")
    selector = train(rows)
    if selector is None or not selector.thresholds:
        return slim.select("doc_id", "row_key", "base", none.alias("added"))
    free = found.select("row_key", base.alias("base"), F.explode("candidates").alias("c")).filter(
        ~F.col("c.base") & ~F.exists("base", lambda b: _crosses(b, F.col("c")))
    )
    least = F.try_element_at(F.create_map(*[F.lit(x) for kv in selector.thresholds.items() for x in kv]), F.col("kind"))
    picked = scored(free.select("row_key", "c.*").distinct(), selector.trees).filter(F.col("score") >= least)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct(rank.alias("rank"), "start", "end", "kind", "score")
    spans = picked.groupBy("row_key").agg(F.sort_array(F.collect_list(span)).alias("s"))

    def wins(a: Column) -> Column:
        beats = lambda b: _crosses(a, b) & ((b["score"] > a["score"]) | ((b["score"] == a["score"]) & (b["rank"] < a["rank"])))
        return ~F.exists("s", beats)

    added = F.transform(F.filter("s", wins), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    joined = slim.join(stage(spans.select("row_key", added.alias("added"))), "row_key", "left")
    return joined.select("doc_id", "row_key", "base", F.coalesce("added", none).alias("added"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas, in the order of the kinds and the start."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.sort_array(F.transform(spans, lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans are merged."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], kept, F.lit("["), s["kind"], F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(ordered, begin, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
