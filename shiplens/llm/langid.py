"""Language identification by fusing evidence.

Four kinds of evidence on a document's language are added up as log-odds: what its characters say
(naive Bayes over hashed byte trigrams of the lower-cased text), the language its markup declares,
the suffix of its address, and how often its host has each language. Host counts are smoothed
towards those of the host's domain and these towards the whole corpus, all by grouped sums of what
the texts alone say.

Neighbouring trigrams are no independent witnesses, so the mean log-likelihood counts as the square
root of their number, not as the number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.llm.common import row_key, slices, stage, text_or_empty

BUCKETS = 1 << 16
#: Table cells that scoring reads of a text at a time.
CELLS = 1 << 22
#: How often a declared language or an address suffix is right.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.8
#: Weight of the level above, in documents.
HOST_PRIOR = 20.0
#: Mean log-likelihood that a text may fall below all but two in a hundred of the labelled; the mean
#: of n trigrams scatters, so a short text may fall lower by SCATTER / sqrt(n) times as much.
SLACK, LOWEST_SHARE, SCATTER = 1.0, 0.02, 10.0
CONFIDENT = 0.5


@dataclass
class LanguageModel:
    languages: list[str]
    logp: np.ndarray  # BUCKETS x languages
    floor: float  # mean log-likelihood that all but the least likely texts reach


def trigram_codes(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, dtype=np.uint16)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)


def _sample(docs: DataFrame, label: Column, key: Column, size: int) -> DataFrame:
    """Up to ``size`` labelled rows of each lower-cased label, by hash of the key.

    Rows are thinned by their hash first, to some four times the sample of each label, so that the
    ranking of a label sees about as many at any size of the corpus.
    """
    slim = docs.select(key.alias("_key"), F.lower(label).alias("_label")).filter("_label is not null and _label <> ''")
    counts = slim.groupBy("_label").agg(F.count("*").alias("n"))
    hashed = F.pmod(F.xxhash64("_key"), F.lit(1 << 40))
    thinned = slim.join(F.broadcast(counts), "_label").filter(hashed * (F.col("n") / (4.0 * size)) < float(1 << 40))
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_key"), "_key")
    ranked = thinned.select("_key", "_label").distinct().withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= size).select("_key", "_label")


def train(docs: DataFrame, label: str = "lang", text: str = "text", doc_id: str = "doc_id", size: int | None = None) -> LanguageModel | None:
    """A model of all labels, lower-cased, from all labelled documents, or ``size`` of each; None without any."""
    name = F.lower(F.col(label))
    if size is None:
        rows = docs.select(name.alias("label"), F.lower(text_or_empty(text)).alias("text")).filter("label <> ''")
    else:
        key = F.col(doc_id)
        picked = stage(_sample(docs, F.col(label), key, size))
        # At most size rows a label.
        rows = docs.select(key.alias("_key"), F.lower(text_or_empty(text)).alias("text"))
        rows = stage(rows.join(F.broadcast(picked), "_key").select(F.col("_label").alias("label"), "text")).coalesce(4)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, x in zip(batch.column("label").to_pylist(), batch.column("text").cast(pa.binary())):
                n = np.bincount(trigram_codes(x.as_buffer().to_pybytes()), minlength=BUCKETS)
                sums[name] = sums.get(name, 0) + n
        for name in sorted(sums):
            seen = np.flatnonzero(sums[name])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(sums[name][seen], pa.int64())],
                names=["label", "bucket", "n"],
            )

    counted = rows.mapInArrow(count, "label string, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    totals: dict[str, np.ndarray] = {}
    for batch in counted.toArrow().to_batches():
        columns = batch.column("label").to_pylist(), batch.column("bucket").to_pylist(), batch.column("n").to_pylist()
        for found, bucket, n in zip(*columns):
            if found not in totals:
                totals[found] = np.zeros(BUCKETS, dtype=np.int64)
            totals[found][bucket] = n
    totals = {k: v for k, v in totals.items() if v.sum() > 0}
    if not totals:
        return None
    languages = sorted(totals)
    logp = np.empty((BUCKETS, len(languages)), dtype=np.float32)
    for i, name in enumerate(languages):
        counts = totals.pop(name) + 0.5
        logp[:, i] = np.log(counts / counts.sum())
    model = LanguageModel(languages, logp, -np.inf)
    worst = text_scores(rows.withColumn("_one", F.lit(1)).select("_one", "text"), model, ["_one"])
    # Rounded, so that the values counted for the percentile are few whatever the number of texts.
    best = F.round(F.array_max("means"), 4)
    lowest = worst.filter("n_grams > 0").agg(F.percentile(best, F.lit(LOWEST_SHARE))).first()[0]
    model.floor = lowest if lowest is not None else -np.inf
    return model


def text_scores(rows: DataFrame, model: LanguageModel, carried: list[str]) -> DataFrame:
    """``carried`` columns, ``n_grams`` and the mean log-likelihoods ``means`` of ``text`` (lower-cased)."""
    table = model.logp
    width = table.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 19):
            texts = [x.as_buffer().to_pybytes() for x in batch.column("text").cast(pa.binary())]
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            grams = np.maximum(sizes - 2, 0)
            codes = trigram_codes(b"".join(texts))
            ends = np.cumsum(sizes)
            begin = ends - sizes
            means = np.zeros((len(texts), width))
            for k in np.nonzero(grams)[0]:
                own, step = codes[begin[k] : begin[k] + grams[k]], max(1, CELLS // width)
                parts = (table[own[i : i + step]].sum(axis=0, dtype=np.float64) for i in range(0, len(own), step))
                means[k] = sum(parts) / grams[k]
            flat = pa.array(means.reshape(-1))
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], pa.array(grams), pa.ListArray.from_arrays(offsets, flat)],
                names=[*carried, "n_grams", "means"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in carried)
    return rows.select(*carried, "text").mapInArrow(run, f"{kinds}, n_grams long, means array<double>")


def address_suffix(address: Column) -> Column:
    """The last label of the address's host where it has two letters, else null."""
    host = F.regexp_extract(address, r"^(?:[^/?#]*://)?([^/?#:]*)", 1)
    suffix = F.lower(F.regexp_extract(host, r"\.([A-Za-z]{2})$", 1))
    return F.when(suffix != "", suffix)


def host_of(address: Column) -> Column:
    return F.lower(F.regexp_extract(address, r"^(?:[^/?#]*://)?([^/?#:]*)", 1))


def domain_of(host: Column) -> Column:
    """The host without its first label; of a host of two labels or one, its name without digits."""
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) > 2, F.array_join(F.slice(labels, F.lit(2), F.size(labels) - 1), ".")).otherwise(
        F.regexp_replace(host, r"[0-9]+", "")
    )


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not once for each use within a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _added(parts: list[Column]) -> Column:
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _evidence(said: Column, languages: list[str], right: float) -> Column:
    """Log-likelihoods of what was said, given each language; zero where nothing known is said."""
    k = len(languages)
    wrong = (1 - right) / max(1, k - 1)
    hit, miss = F.lit(float(np.log(right))), F.lit(float(np.log(wrong) if k > 1 else 0.0))
    told = F.transform(F.array(*map(F.lit, languages)), lambda name: F.when(said == name, hit).otherwise(miss))
    return F.when(said.isin(languages), told).otherwise(F.array_repeat(F.lit(0.0), k))


def _softmax(scores: Column) -> Column:
    raised = _bound(scores, lambda s: _bound(F.array_max(s), lambda m: F.transform(s, lambda x: F.exp(x - m))))
    return _bound(raised, lambda r: _bound(_total(r), lambda t: F.transform(r, lambda x: x / t)))


def _smoothed(slim: DataFrame, languages: list[str], strength: float) -> DataFrame:
    """``host``, ``prior`` (array): counts by host, smoothed by its domain, that by the corpus."""
    k = len(languages)

    def summed(values: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.get(values, F.lit(i))), F.lit(0.0)) for i in range(k)])

    hosts = slim.groupBy("host", "domain").agg(summed("alone").alias("n"))
    domains = hosts.groupBy("domain").agg(summed("n").alias("n"))

    def prior(n: Column, above: Column) -> Column:
        return _bound(_total(n), lambda t: F.zip_with(n, above, lambda x, p: (x + strength * p) / (t + strength)))

    corpus = domains.agg(summed("n")).first()[0]
    corpus = F.array(*[F.lit((x + strength / k) / (sum(corpus) + strength)) for x in corpus])
    domains = domains.alias("d").select("domain", prior(F.col("d.n"), corpus).alias("prior"))
    joined = hosts.alias("h").join(domains.alias("p"), F.col("h.domain").eqNullSafe(F.col("p.domain")))
    return joined.select(F.col("h.host").alias("host"), prior(F.col("h.n"), F.col("p.prior")).alias("prior"))


def identify(
    docs: DataFrame,
    model: LanguageModel | None,
    declared: str = "lang",
    address: str = "source",
    suffixes: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``row_key``, ``language``, ``confidence``, ``text_language``, ``accepted`` a row.

    ``declared`` and ``address`` may be null and are then no evidence; a null address takes the
    corpus prior. ``suffixes`` maps two-letter address suffixes to languages (by default a suffix
    names its own language). A document is accepted if it has letters, its text is no less likely
    than the model's floor and slack allow, and the posterior of its best language is at least one half; ties go to
    the first language by name. Repeated rows are judged each, null and empty texts rejected. Without a
    model no row has a language and none is accepted. Texts are read whole, however long; an empty
    table gives no rows.
    """
    if model is None:
        none = F.lit(None).cast("string")
        return docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), none.alias("language"),
            F.lit(0.0).alias("confidence"), none.alias("text_language"), F.lit(False).alias("accepted"),
        )
    languages, k = model.languages, len(model.languages)
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        row_key(doc_id, text).alias("row_key"),
        F.lower(F.col(declared)).alias("declared"),
        host_of(F.col(address)).alias("host"),
        address_suffix(F.col(address)).alias("suffix"),
        text_or_empty(text).rlike(r"\p{L}").alias("letters"),
        F.lower(text_or_empty(text)).alias("text"),
    )
    carried = ["doc_id", "row_key", "declared", "host", "suffix", "letters"]
    tempered = F.transform("means", lambda x: x * F.sqrt(F.col("n_grams")))
    scored = text_scores(slim, model, carried)
    scored = scored.withColumns({"scores": tempered, "domain": domain_of(F.col("host"))})
    scored = stage(scored.withColumn("alone", _softmax(F.col("scores"))))
    priors = stage(_smoothed(scored.filter("n_grams > 0"), languages, HOST_PRIOR))
    joined = scored.join(priors.withColumnRenamed("host", "_host"), scored.host.eqNullSafe(F.col("_host")), "left").drop("_host")
    prior = F.coalesce("prior", F.array(*[F.lit(1.0 / k)] * k))
    spoken = F.create_map(*[F.lit(x) for pair in (suffixes or {n: n for n in languages}).items() for x in pair])
    parts = [
        F.col("scores"),
        F.transform(prior, lambda p: F.log(p)),
        _evidence(F.col("declared"), languages, DECLARED_RIGHT),
        _evidence(F.try_element_at(spoken, F.col("suffix")), languages, SUFFIX_RIGHT),
    ]
    total = _added(parts)
    names = F.array(*[F.lit(n) for n in languages])
    best = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    likely = F.array_max("means") >= model.floor - SLACK * (1 + SCATTER / F.sqrt(F.greatest("n_grams", F.lit(1))))
    judged = joined.withColumn("posterior", _softmax(total)).withColumn("confidence", F.array_max("posterior"))
    return judged.select(
        "doc_id",
        "row_key",
        best(F.col("posterior")).alias("language"),
        "confidence",
        F.when(F.col("n_grams") > 0, best(F.col("scores"))).alias("text_language"),
        (F.col("letters") & likely & (F.col("confidence") >= CONFIDENT)).alias("accepted"),
    )
