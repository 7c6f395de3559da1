"""Quality rules: an isolation forest on rule statistics.

Each document gets counts (words, symbols, repeated lines, repeated windows of three
words and others). Documents that break a plain limit fail at once. The rest
are judged by an isolation forest: trees split random statistics at random points,
and a document that few splits set apart is unlike the documents the forest was
grown from. The forest is grown from rows labelled good, the threshold is
calibrated on all labelled rows.

Nulls and empty texts have no words and fail the limit of ``MIN_WORDS``. A null id
is kept as it is; such a row never counts as labelled. Repeated rows are judged
alike. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift.llm.tables import kept
from billsift.llm.texts import Slab, slabs, window_hashes, windows

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SAMPLE_ROWS = 8192  # bound of the labelled rows the forest is grown from
TREES = 128
TREE_ROWS = 256
LOST_GOOD_ROWS = 0.005  # share of good rows that the threshold may cost at most
BINS = 4096

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["symbols", "pipes", "marks", "capitals"]  # what the forest sees: how a text is written, not its length
_STATS = (
    "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in SHARES)
)


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


_SYMBOL = _flags("#*$%&|<>")
_MARK = _flags("!?#*$%&|<>{}[]=+^~_@\\/")
_CAPITAL = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _CAPITAL | _flags("abcdefghijklmnopqrstuvwxyz")


def _repeated(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which entries have a (row, key) that others have too, and which are not its first."""
    order = np.lexsort((np.arange(len(keys)), keys, row))
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = (keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1])
    repeated, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    repeated[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return repeated, later


def slab_statistics(slab: Slab) -> dict[str, np.ndarray]:
    """The counts and shares of each text of a slab."""
    n, data = len(slab), slab.data
    first, last, row = slab.words()
    n_words = slab.per_row(first)
    points = np.concatenate([[0], np.cumsum(slab.code_points(), dtype=np.int64)])
    word_chars = np.bincount(row, points[last] - points[first], n).astype(np.int64)
    n_symbols = slab.total(_SYMBOL[data])

    line_first, line_last, line_row = slab.spans(data != 10)
    has_word = np.searchsorted(first, line_last) > np.searchsorted(first, line_first)
    line_first, line_last, line_row = line_first[has_word], line_last[has_word], line_row[has_word]
    _, later = _repeated(slab.hashes(line_first, line_last, seed=3), line_row)
    n_dup_lines = np.bincount(line_row, later, n).astype(np.int64)

    at = windows(row, 3)
    again, _ = _repeated(window_hashes(slab.hashes(first, last), at, 3), row[at])
    covered = np.zeros(len(first) + 3, bool)
    for step in range(3):
        covered[at[again] + step] = True
    n_repeat_words = np.bincount(row, covered[: len(first)], n).astype(np.int64)

    words = np.maximum(n_words, 1)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
        "symbols": n_symbols / words,
        "pipes": slab.total(data == 124) / words,
        "marks": slab.total(_MARK[data]) / words,
        "capitals": slab.total(_CAPITAL[data]) / np.maximum(slab.total(_LETTER[data]), 1),
    }


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for slab in slabs(batch.column("text")):
            stats = slab_statistics(slab)
            ids = batch.column("doc_id").slice(slab.first_row, len(slab)).cast(pa.int64())
            arrays = [ids, *(pa.array(stats[c].astype(np.int64)) for c in COUNTS)]
            arrays += [pa.array(stats[c].astype(float)) for c in SHARES]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *COUNTS, *SHARES])


def rule_statistics(documents: DataFrame) -> DataFrame:
    """One row of counts and shares per document, in one narrow pass."""
    return documents.select("doc_id", "text").mapInArrow(_statistics, _STATS)


def base_failed() -> F.Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED_PERCENT) * F.col("n_words"))


class IsolationForest:
    """Trees over rows of statistics; ``depths`` gives mean path lengths."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7):
        random = np.random.default_rng(seed)
        self.size = min(tree_rows, len(rows))
        self.limit = int(np.ceil(np.log2(max(self.size, 2)))) + 1
        self.trees = [
            self._grow(rows[random.choice(len(rows), self.size, replace=False)], random) for _ in range(trees)
        ]

    @staticmethod
    def _rest(n: np.ndarray) -> np.ndarray:
        """Mean path length below a leaf of n rows."""
        n = np.maximum(np.asarray(n, float), 1)
        return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))

    def _grow(self, rows: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, point, left, depth = [], [], [], []

        todo = [(rows, 0, 0)]
        feature.append(-1), point.append(0.0), left.append(0), depth.append(0.0)
        while todo:
            own, level, node = todo.pop()
            low, high = (own.min(0), own.max(0)) if len(own) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if level >= self.limit or not len(open_):
                depth[node] = level + float(self._rest(len(own)))
                continue
            chosen = int(random.choice(open_))
            split = float(random.uniform(low[chosen], high[chosen]))
            feature[node], point[node], left[node] = chosen, split, len(feature)
            for side in (own[own[:, chosen] <= split], own[own[:, chosen] > split]):
                todo.append((side, level + 1, len(feature)))
                feature.append(-1), point.append(0.0), left.append(0), depth.append(0.0)
        return np.array(feature), np.array(point), np.array(left), np.array(depth)

    def depths(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, point, left, depth in self.trees:
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.limit):
                split = feature[node]
                inner = split >= 0
                right = rows[every, np.maximum(split, 0)] > point[node]
                node = np.where(inner, left[node] + right, node)
            total += depth[node]
        return total / max(len(self.trees), 1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """From 0 (deep, ordinary) to 1 (set apart at once)."""
        usual = float(self._rest(self.size)) or 1.0
        return np.exp2(-self.depths(rows) / usual)


def grow_forest(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> IsolationForest | None:
    """A forest from at most ``sample_rows`` rows labelled good (lowest hashes of ids)."""
    good = labelled.filter((F.col("quality") == 1) & ~base_failed())
    order = F.xxhash64("doc_id")
    rows = good.orderBy(order, "doc_id").limit(sample_rows).select(*SHARES).toPandas().to_numpy(float)
    return IsolationForest(rows) if len(rows) else None


def with_scores(statistics: DataFrame, forest: IsolationForest | None) -> DataFrame:
    """Adds ``anomaly``; 0 where no forest could be grown."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in SHARES])
            values = forest.scores(rows) if forest is not None and len(rows) else np.zeros(len(rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, "anomaly"])

    fields = ", ".join(f"{name} {kind}" for name, kind in statistics.dtypes)
    return statistics.mapInArrow(score, f"{fields}, anomaly double")


def calibrate(scored: DataFrame, lost_good: float = LOST_GOOD_ROWS) -> float:
    """The score above which rows are rejected, from a histogram of all labelled rows.

    Of all thresholds that reject at most ``lost_good`` of the good rows, the one
    with the best balanced accuracy, from the middle of equal ones. Without rows
    of both labels nothing is rejected.
    """
    bin_ = F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    judged = scored.filter(F.col("quality").isin(0, 1) & ~base_failed())
    counts = judged.groupBy(bin_).agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")
    )
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for row in counts.collect():  # at most BINS rows
        good[row["bin"]], bad[row["bin"]] = row["good"], row["bad"]
    if not good.sum() or not bad.sum():
        return 2.0
    lost = good[::-1].cumsum()[::-1] / good.sum()  # at a threshold at the lower edge of each bin
    caught = bad[::-1].cumsum()[::-1] / bad.sum()
    value = np.where(lost <= lost_good, caught - lost, -1.0)
    best = np.flatnonzero(value == value.max())
    return (best[0] + best[-1]) / 2 / BINS if value.max() > 0 else 2.0


def fitted(statistics: DataFrame, labels: DataFrame) -> tuple[IsolationForest | None, float]:
    """Forest and threshold from the labelled rows of written statistics.

    Labels join by id; where an id has several labels, all of them count.
    """
    labels = labels.select(F.col("doc_id").alias("_id"), F.col("quality"))
    labelled = statistics.join(labels, F.col("doc_id") == F.col("_id")).drop("_id")
    forest = grow_forest(labelled)
    return forest, calibrate(with_scores(labelled, forest))


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the counts, ``base_failed``, ``kept``, ``anomaly``.

    Statistics are computed once and kept in the shared folder.
    """
    statistics = kept(rule_statistics(documents), "rule-statistics")
    forest, threshold = fitted(statistics, labels)
    return with_scores(statistics, forest).select(
        "doc_id",
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("anomaly") < F.lit(threshold))).alias("kept"),
        "anomaly",
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the rules, with all their columns, without a shuffle of texts."""
    statistics = kept(rule_statistics(documents), "rule-statistics")
    forest, threshold = fitted(statistics, labels)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column("text")):
                stats = slab_statistics(slab)
                few = stats["n_words"] < MIN_WORDS
                failed = few | (100 * stats["n_repeat_words"] > MAX_REPEATED_PERCENT * stats["n_words"])
                if forest is not None:
                    failed |= forest.scores(np.column_stack([stats[c] for c in SHARES])) >= threshold
                yield batch.slice(slab.first_row, len(slab)).filter(pa.array(~failed))

    return documents.mapInArrow(good, documents.schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
