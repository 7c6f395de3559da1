"""Toxicity by compression distance.

From texts labelled toxic and ordinary two zstandard dictionaries are made: the ordinary
one of stretches of ordinary text, the toxic one of stretches that are much commoner in
toxic texts. Each window of a text is compressed with and without them. Where the toxic
dictionary shortens a window, toxic wording is in it; how often and how much it does is
turned into a score by a logistic calibration on the labelled rows.

Training reads at most ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` labelled rows (lowest hashes of
ids, and only rows that are not held out); everything else is done for every document in
one narrow pass over its whole text. Language, source and id are never inputs.

A null or empty text has one window of filler and gets a low score. Without labels of both
kinds each score is 0. Repeated rows are scored alike. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOXIC_ROWS = 2048
ORDINARY_ROWS = 4096
WINDOW, STEP = 192, 96
GRAM = 6  # bytes; runs of such grams make the toxic dictionary
TOXIC_BYTES, ORDINARY_BYTES = 8000, 4000
LEAST_SHARE = 0.03  # of toxic texts that a gram must occur in
TIMES_COMMONER = 6
PREDICTED_FROM = 0.3
_STEPS = np.arange(-1, 9)


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def _plain(text: str | None) -> bytes:
    return b" " + (text or "").replace("\n", " ").encode() + b" "


def _grams(text: bytes) -> np.ndarray:
    """Each stretch of ``GRAM`` bytes as a number."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(0, len(data) - GRAM + 1)
    value = np.zeros(n, np.uint64)
    for i in range(GRAM):
        value = (value << np.uint64(8)) | data[i : i + n]
    return value


def telling_stretches(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Stretches of the toxic texts made of grams that ordinary texts rarely have, rarest first."""
    grams, counts = np.unique(np.concatenate([np.unique(_grams(t)) for t in toxic]), return_counts=True)
    enough = counts >= max(4, LEAST_SHARE * len(toxic))
    grams, counts = grams[enough], counts[enough]
    if not len(grams):
        return []
    usual = np.zeros(len(grams))
    for text in ordinary:
        own = np.unique(_grams(text))
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        usual[at[grams[at] == own]] += 1
    telling = grams[counts / len(toxic) > TIMES_COMMONER * (usual + 1) / len(ordinary)]
    found: Counter[bytes] = Counter()
    for text in toxic:
        edge = np.zeros(len(text) + 2, np.int64)
        hits = np.flatnonzero(np.isin(_grams(text), telling))
        np.add.at(edge, hits + 1, 1)
        np.add.at(edge, hits + 1 + GRAM, -1)
        change = np.flatnonzero(np.diff((np.cumsum(edge) > 0).astype(np.int8)))
        found.update(text[a:b] for a, b in change.reshape(-1, 2))
    return sorted(found, key=lambda s: (found[s], s))


class Distance:
    """Compression lengths of windows with the two dictionaries, and features of a text."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.filler = (ordinary * (WINDOW // max(len(ordinary), 1) + 1))[:WINDOW]
        self.contents = toxic, ordinary
        self.compressors = None

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters(
            window_log=16,
            hash_log=16,
            chain_log=16,
            search_log=8,
            min_match=GRAM,
            strategy=zstandard.STRATEGY_GREEDY,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        if not content:
            return zstandard.ZstdCompressor(compression_params=settings)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"compressors": None}

    def margins(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window, alone and beside the ordinary one."""
        if self.compressors is None:
            toxic, ordinary = self.contents
            self.compressors = [self._compressor(c).compress for c in (b"", toxic, ordinary, ordinary + toxic)]
        none, toxic, ordinary, both = self.compressors
        out = []
        for at in range(0, max(1, len(text) - WINDOW + STEP), STEP):
            window = text[at : at + WINDOW]
            window = self.filler[: WINDOW - len(window)] + window
            out.append((len(none(window)) - len(toxic(window)), len(ordinary(window)) - len(both(window))))
        return np.array(out)

    def features(self, text: bytes) -> np.ndarray:
        margins = self.margins(text)
        parts = [np.log([len(margins)])]
        for own in margins.T:
            over = (own[:, None] >= _STEPS).sum(0)
            top = np.sort(own)[::-1][:3]
            parts += [np.log1p(over), over / len(own), [top[0], top[:2].mean(), top.mean(), own.mean(), own.std()]]
        return np.concatenate(parts)


class Calibration:
    """Logistic regression on standardised features, by Newton steps."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, strength: float = 0.01):
        self.mean, self.scale = features.mean(0), features.std(0) + 1e-9
        x = self._prepared(features)
        ridge = strength * len(x) * np.eye(x.shape[1])
        ridge[-1, -1] = 0
        self.weights = np.zeros(x.shape[1])
        for _ in range(50):
            p = self._chances(x)
            slope = x.T @ (p - labels) + ridge @ self.weights
            bend = (x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-6 * np.eye(x.shape[1])
            self.weights -= np.linalg.solve(bend, slope)

    def _prepared(self, features: np.ndarray) -> np.ndarray:
        return np.c_[(features - self.mean) / self.scale, np.ones(len(features))]

    def _chances(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))

    def chances(self, features: np.ndarray) -> np.ndarray:
        return self._chances(self._prepared(features))


def train(toxic: list[bytes], ordinary: list[bytes], toxic_share: float) -> tuple[Distance, Calibration]:
    """Dictionaries and calibration; ``toxic_share`` is that of all labelled rows."""
    stretches = telling_stretches(toxic, ordinary)
    step = max(1, len(ordinary) // (ORDINARY_BYTES // 40))
    common = b"".join(t[len(t) // 2 : len(t) // 2 + 40] for t in ordinary[::step])[:ORDINARY_BYTES]
    # The end of a dictionary is its nearest part: there the commonest stretches are.
    distance = Distance(b" ".join(stretches)[-TOXIC_BYTES:], common)
    rows = np.array([distance.features(t) for t in toxic + ordinary])
    labels = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))]
    calibration = Calibration(rows, labels)
    own = len(toxic) / len(labels)
    # The sample holds more toxic rows than there are: shift the chances to their true share.
    calibration.weights[-1] += np.log(toxic_share / (1 - toxic_share)) - np.log(own / (1 - own))
    return distance, calibration


def labelled_sample(documents: DataFrame, labels: DataFrame) -> tuple[list[bytes], list[bytes], float]:
    """Texts of at most ``TOXIC_ROWS`` toxic and ``ORDINARY_ROWS`` other rows, and the share of toxic ones."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")
    counts = dict(known.groupBy("toxic").count().collect())  # two rows
    if not counts.get(0) or not counts.get(1):
        return [], [], 0.0
    texts = []
    for toxic, bound in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS)):
        chosen = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        chosen = F.broadcast(chosen.select(F.col("doc_id").alias("_id")))  # at most ``bound`` ids
        rows = documents.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        texts.append([_plain(r["text"]) for r in rows.limit(bound).toLocalIterator()])
    return texts[0], texts[1], counts[1] / (counts[0] + counts[1])


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``held_out``, ``score`` from 0 to 1, and ``predicted``."""
    toxic, ordinary, share = labelled_sample(documents, labels)
    model = train(toxic, ordinary, share) if toxic and ordinary else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                chances = np.zeros(batch.num_rows)
            else:
                rows = [model[0].features(_plain(t.as_py())) for t in batch.column("text")]
                chances = model[1].chances(np.array(rows)) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(chances)], ["doc_id", "score"])

    scored = documents.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
    predicted = F.when(F.col("score") >= PREDICTED_FROM, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
