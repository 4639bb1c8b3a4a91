"""Latent Dirichlet allocation by variational passes over all documents.

Spark's own fit iterates a document until its weights move by less than a thousandth of a word,
however many words it has, and starts again for every number of passes; with documents of millions
of words one pass takes minutes. Here a document stops at a share of its words, and passes go on.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A document's weights stand when they move by less than this share of its words on average.
STILL = 1e-4
#: Rounds of one document in one pass at most; the next pass goes on from the new topics.
ROUNDS = 100


def _shifted(x):
    """x + 6, where the asymptotic series hold to ten digits, and the six terms below it."""
    x = np.asarray(x, dtype=float)
    return x + 6, [x + i for i in range(6)]


def digamma(x):
    y, below = _shifted(x)
    r = 1 / (y * y)
    series = np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240)))
    return series - sum(1 / b for b in below)


def log_gamma(x):
    y, below = _shifted(x)
    r = 1 / (y * y)
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - r * (1 / 360 - r / 1260)) / y
    return series - sum(np.log(b) for b in below)


def document_weights(counts, beta, alpha):
    """Weights of the topics in one document, its share of each word's count and the rounds taken.

    ``beta`` holds the exponent of the expected logarithm of each topic's words of the document.
    """
    k = len(beta)
    gamma = np.full(k, alpha + counts.sum() / k)
    rounds = 0
    while True:
        rounds += 1
        theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
        each = counts / (theta @ beta + 1e-100)
        new = alpha + theta * (beta @ each)
        moved = np.abs(new - gamma).sum()
        gamma = new
        if moved <= STILL * max(gamma.sum(), 1.0) or rounds == ROUNDS:
            break
    theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
    return gamma, theta, counts / (theta @ beta + 1e-100), rounds


class TopicModel:
    """Topics as pseudo-counts of words (``lam``, topics by places); both priors are 1 / k."""

    def __init__(self, lam):
        self.lam = lam
        self.prior = 1.0 / len(lam)

    def _log_beta(self):
        return digamma(self.lam) - digamma(self.lam.sum(axis=1, keepdims=True))

    def step(self, matrix: DataFrame) -> tuple[TopicModel, float]:
        """The model after one more pass over all documents, and this one's log-perplexity a word."""
        log_beta, prior = self._log_beta(), self.prior
        sc = matrix.sparkSession.sparkContext
        shared = sc.broadcast(np.exp(log_beta))

        def part(rows):
            beta = shared.value
            found, bound, words = np.zeros_like(beta), 0.0, 0.0
            for row in rows:
                ids, counts = row[0].indices, row[0].values
                gamma, theta, each, _ = document_weights(counts, beta[:, ids], prior)
                found[:, ids] += np.outer(theta, each)
                log_theta = digamma(gamma) - digamma(gamma.sum())
                bound += float(counts @ (np.log(counts) - np.log(each)))
                bound += float(((prior - gamma) * log_theta + log_gamma(gamma) - log_gamma(prior)).sum())
                bound += float(log_gamma(prior * len(beta)) - log_gamma(gamma.sum()))
                words += counts.sum()
            yield found, bound, words

        found, bound, words = matrix.select("features").rdd.mapPartitions(part).treeReduce(
            lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] + b[2])
        )
        bound += ((prior - self.lam) * log_beta + log_gamma(self.lam) - log_gamma(prior)).sum()
        bound += (log_gamma(prior * self.lam.shape[1]) - log_gamma(self.lam.sum(axis=1))).sum()
        model = TopicModel(prior + found * shared.value)
        shared.destroy()
        return model, -float(bound) / words

    def logPerplexity(self, matrix: DataFrame) -> float:
        return self.step(matrix)[1]

    def describeTopics(self, n: int) -> DataFrame:
        """The ``n`` heaviest places of each topic, as Spark's model returns them."""
        from pyspark.sql import SparkSession

        shares = self.lam / self.lam.sum(axis=1, keepdims=True)
        rows = []
        for topic, share in enumerate(shares):
            top = np.argsort(-share, kind="stable")[:n]
            rows.append((topic, [int(i) for i in top], [float(share[i]) for i in top]))
        return SparkSession.active().createDataFrame(rows, "topic int, termIndices array<int>, termWeights array<double>")

    def weights(self, matrix: DataFrame, doc: str) -> DataFrame:
        """``doc`` and the shares of the topics in it (``gamma``, an array)."""
        shared, prior = matrix.sparkSession.sparkContext.broadcast(np.exp(self._log_beta())), self.prior

        def part(rows):
            for key, vector in rows:
                gamma = document_weights(vector.values, shared.value[:, vector.indices], prior)[0]
                yield key, [float(g) for g in gamma / gamma.sum()]

        rows = matrix.select(doc, "features").rdd.mapPartitions(part)
        schema = matrix.select(doc, F.array(F.lit(0.0)).alias("gamma")).schema
        return matrix.sparkSession.createDataFrame(rows, schema)


def first_model(matrix: DataFrame, k: int, seed: int) -> TopicModel:
    """Topics half of one document and half of all: each next one is least like those before it.

    The documents are unlike by the cosine of their counts; equal ones are ordered by a hash.
    """
    rows = matrix.select("features").rdd
    size = matrix.select("features").first()[0].size

    def add(parts):
        total = np.zeros(size)
        for row in parts:
            total[row[0].indices] += row[0].values
        yield total

    total = rows.mapPartitions(add).treeReduce(np.add)
    sc = matrix.sparkSession.sparkContext
    chosen: list[np.ndarray] = []
    for _ in range(k):
        shared = sc.broadcast([c / np.sqrt(c @ c) for c in chosen])

        def unlike(parts):
            best = None
            for row in parts:
                ids, counts = row[0].indices, row[0].values
                near = max((float(c[ids] @ counts) for c in shared.value), default=0.0) / np.sqrt(counts @ counts)
                mark = hashlib.md5(ids.tobytes() + counts.tobytes() + str(seed).encode()).hexdigest()
                if best is None or (round(near, 9), mark) < best[0]:
                    best = ((round(near, 9), mark), row[0])
            return [] if best is None else [best]

        vector = rows.mapPartitions(unlike).reduce(lambda a, b: min(a, b, key=lambda x: x[0]))[1]
        shared.destroy()
        chosen.append(Vectors.sparse(size, vector.indices, vector.values).toArray())
    words = total.sum() / k
    return TopicModel(np.array([1.0 / k + words * (0.5 * c / c.sum() + 0.5 * total / total.sum()) for c in chosen]))
