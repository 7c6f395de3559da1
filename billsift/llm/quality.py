"""Quality classifier trained on weak labels.

Labellers are plain rules on the form of a text; each votes good or bad or abstains, and they
overlap. Expectation-maximisation finds how reliable each is from how they agree (the
Dawid-Skene model): documents are counted by their pattern of votes, so its input is at
most 3 ** (number of labellers) counts however large the corpus is. The posterior of a
pattern labels its documents, and these labels train a linear scorer on hashed
features of the words, which then scores every document. No label column is read.

The scorer is trained on at most ``TRAIN_ROWS`` documents per side (likely good, likely bad;
lowest hashes of ids); votes, counts and scores cover all documents.

Null and empty texts have no words: all labellers abstain and features are empty, so they get the
scorer's constant. Repeated rows count and are scored each. Columns other than
id and text are not read. Without documents, or if all look alike, every row is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift.llm.rules import slab_statistics
from billsift.llm.tables import kept
from billsift.llm.texts import Slab, slabs

TRAIN_ROWS = 4096
FEATURES = 1 << 14
ROUNDS = 200
KEPT_FROM = 0.5
LEAST_WORDS = 5  # below, labellers abstain

#: Statistic of each labeller that votes bad, and the limit above which it does.
BAD_FROM = {"symbols": 0.3, "pipes": 0.3, "marks": 0.5, "capitals": 0.6, "repeats": 0.5, "neighbours": 0.3}
#: The labeller "plain" votes good where all these statistics are at most so high.
GOOD_UPTO = {"marks": 0.15, "capitals": 0.2, "repeats": 0.3, "neighbours": 0.1}
LABELLERS = [*BAD_FROM, "plain"]
_PATTERN = "doc_id long, pattern int"


def _same_as_before(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slab, and which of them repeat the word before."""
    first, last, row = slab.words()
    words = slab.hashes(first, last)
    same = np.zeros(len(first), bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    return first, last, row, same


def slab_votes(slab: Slab) -> np.ndarray:
    """Votes of the labellers on each text as one number: digits 0 (abstains), 1 (good), 2 (bad)."""
    stats = slab_statistics(slab)
    words = np.maximum(stats["n_words"], 1)
    _, _, row, same = _same_as_before(slab)
    stats |= {"repeats": stats["n_repeat_words"] / words, "neighbours": np.bincount(row, same, len(slab)) / words}
    votes = [np.where(stats[name] > limit, 2, 0) for name, limit in BAD_FROM.items()]
    votes.append(np.logical_and.reduce([stats[name] <= limit for name, limit in GOOD_UPTO.items()]).astype(np.int64))
    pattern = np.zeros(len(slab), np.int64)
    for vote in votes:
        pattern = pattern * 3 + np.where(stats["n_words"] < LEAST_WORDS, 0, vote)
    return pattern


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for slab in slabs(batch.column("text")):
            ids = batch.column("doc_id").slice(slab.first_row, len(slab)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(slab_votes(slab), pa.int32())], ["doc_id", "pattern"])


def _digits(patterns: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return patterns[:, None] // powers % 3


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Chance that a document of each pattern is bad, and the chance of each vote in both classes.

    Starts from the majority of votes, so that "bad" keeps its meaning. Who abstains says
    nothing. Votes are smoothed by one document each way.
    """
    votes = _digits(patterns)
    good, bad = (votes == 1).sum(1), (votes == 2).sum(1)
    chance = (bad + 0.5) / (good + bad + 1.0)
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - chance), counts * chance])
        for vote in (1, 2):
            table[:, :, vote] = weight @ (votes == vote) + 1.0
        table[:, :, 0] = weight.sum(1)[:, None] + 2.0
        table /= table[:, :, :1]
        prior = (weight.sum(1) + 1.0) / (weight.sum() + 2.0)
        logs = np.log(prior)[:, None] + np.stack([np.log(t[np.arange(votes.shape[1]), votes]).sum(1) for t in table])
        chance = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return chance, table


def slab_features(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features as row, feature and value: ends, beginnings and shapes of words.

    Values are roots of shares, so each text has length one per kind of feature.
    """
    first, last, row, same = _same_as_before(slab)
    size = last - first
    n_words = np.maximum(slab.per_row(first), 1)
    upper = np.zeros(len(slab.data) + 1, np.int64)
    np.cumsum((slab.data >= 65) & (slab.data <= 90), out=upper[1:])
    loud = (2 * (upper[last] - upper[first]) > size) & (size > 1)
    kinds = [
        slab.hashes(np.maximum(last - 3, first), last, seed=5),
        slab.hashes(first, np.minimum(first + 2, last), seed=6),
        (np.minimum(size, 30) * 4 + loud * 2 + same).astype(np.uint64),
    ]
    rows, features, values = [], [], []
    for number, keys in enumerate(kinds):
        feature = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) + np.uint64(number * 7919)
        cell = row * FEATURES + (feature % np.uint64(FEATURES)).astype(np.int64)
        cell, count = np.unique(cell, return_counts=True)
        rows.append(cell // FEATURES)
        features.append(cell % FEATURES)
        values.append(np.sqrt(count / n_words[cell // FEATURES]))
    return np.concatenate(rows), np.concatenate(features), np.concatenate(values)


class LinearScorer:
    """Logistic regression on hashed features."""

    def __init__(self):
        self.weights, self.constant = np.zeros(FEATURES), 0.0

    def margins(self, rows: np.ndarray, features: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        return self.constant + np.bincount(rows, values * self.weights[features], n)

    def fit(self, rows, features, values, labels: np.ndarray, strength: float = 1e-4, rounds: int = 150) -> LinearScorer:
        """Accelerated gradient descent on soft labels."""
        n = len(labels)
        before, constant_before = self.weights.copy(), self.constant
        for i in range(rounds):
            pull = i / (i + 3)
            ahead = self.weights + pull * (self.weights - before)
            constant = self.constant + pull * (self.constant - constant_before)
            before, constant_before = self.weights, self.constant
            self.weights, self.constant = ahead, constant
            miss = 1 / (1 + np.exp(-np.clip(self.margins(rows, features, values, n), -30, 30))) - labels
            self.weights = ahead - 2.0 * (np.bincount(features, values * miss[rows], FEATURES) / n + strength * ahead)
            self.constant = constant - 2.0 * miss.mean()
        return self


def _train(documents: DataFrame, votes: DataFrame, patterns: np.ndarray, bad: np.ndarray, counts: np.ndarray) -> LinearScorer | None:
    """A scorer from a bounded sample of documents that their patterns call good or bad."""
    spark = documents.sparkSession
    known = spark.createDataFrame([(int(p), float(b)) for p, b in zip(patterns, bad, strict=True)], "pattern int, bad double")
    judged = votes.filter("doc_id is not null").join(F.broadcast(known), "pattern")  # as many rows as patterns
    parts = []
    for likely in (F.col("bad") > 0.5, F.col("bad") <= 0.5):
        parts.append(judged.filter(likely).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS))
    chosen = parts[0].union(parts[1]).select(F.col("doc_id").alias("_id"), "bad")
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    texts, labels = [], []
    rows_all, features_all, values_all, at = [], [], [], 0
    for row in rows.select("text", "bad", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * TRAIN_ROWS).toLocalIterator():
        texts.append(row["text"])
        labels.append(1 - row["bad"])
        if len(texts) == 500:
            at = _add(texts, rows_all, features_all, values_all, at)
            texts = []
    at = _add(texts, rows_all, features_all, values_all, at)
    if not labels or max(labels) < 0.5 or min(labels) > 0.5:
        return None
    scorer = LinearScorer().fit(*(np.concatenate(x) for x in (rows_all, features_all, values_all)), np.array(labels))
    # The sample holds more bad documents than there are: shift the chances to the true share.
    good, own = 1 - counts @ bad / counts.sum(), np.mean(labels)
    scorer.constant += np.log(good / (1 - good)) - np.log(own / (1 - own))
    return scorer


def _add(texts, rows_all, features_all, values_all, at: int) -> int:
    for slab in slabs(pa.array(texts, pa.string())):
        rows, features, values = slab_features(slab)
        rows_all.append(rows + at + slab.first_row), features_all.append(features), values_all.append(values)
    return at + len(texts)


def classify_quality(documents: DataFrame) -> DataFrame:
    """Per document: ``score`` (chance of being good), ``kept`` and ``weak_label``.

    ``weak_label`` is the posterior of the document's votes.
    """
    votes = kept(documents.select("doc_id", "text").mapInArrow(_votes, _PATTERN), "votes")
    counted = votes.groupBy("pattern").count().toPandas()  # at most 3 ** len(LABELLERS) rows
    patterns, counts = counted["pattern"].to_numpy(np.int64), counted["count"].to_numpy(float)
    bad, _ = posteriors(patterns, counts) if len(patterns) else (np.zeros(0), None)
    scorer = _train(documents, votes, patterns, bad, counts) if len(patterns) else None
    label_of = dict(zip(patterns.tolist(), (1 - bad).tolist(), strict=True))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column("text")):
                if scorer is None:
                    chance = np.ones(len(slab))
                else:
                    margin = scorer.margins(*slab_features(slab), len(slab))
                    chance = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
                weak = [label_of.get(p, 1.0) for p in slab_votes(slab).tolist()]
                ids = batch.column("doc_id").slice(slab.first_row, len(slab)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(chance), pa.array(weak, pa.float64())], ["doc_id", "score", "weak_label"])

    scored = documents.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, weak_label double")
    return scored.select("doc_id", "score", (F.col("score") >= KEPT_FROM).alias("kept"), "weak_label")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
