"""Substring dedup: word windows that an earlier document has too are removed.

1. Each window of ``WIDTH`` words stands for the smallest Rabin-Karp hash among the
   runs of ``CORE`` words inside it. Neighbouring windows mostly share that core, so a
   quarter of the hashes suffices to find every window that two documents may share:
   equal windows have equal cores. Cores are dealt out (see ``keyed``); one found in two
   documents is a candidate for all its documents.
2. Documents with candidates are read once more. The Rabin-Karp hashes of each window
   with such a core, 128 bits, are counted: among equals the smallest id keeps its
   window and all others lose theirs. Only this step decides.
3. Lost windows merge into maximal intervals of words, which are cut from the text.

Windows are judged on the input, not on what is left. Words are runs other than 0x20
and 0x09-0x0D. A null or empty text has no words and keeps none (a null stays null). A
document shorter than a window loses nothing. Rows that share an id are one document
for this purpose: none takes a window from another. Rows without an id neither give
nor take. All rows are kept, in any number of repetitions, and so are other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift.llm import keyed
from billsift.llm.tables import kept
from billsift.llm.texts import Slab, slabs, window_hashes, windows

WIDTH = 13
CORE = 7
LOST = "_lost_windows"
_WORDS = r"[ \t-\r]+"


def _hashed(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a slab, the first word of each window, and the window's row."""
    first, last, row = slab.words()
    at = windows(row, WIDTH)
    return slab.hashes(first, last), at, row[at]


def _cores(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The core of each window, as 48 bits."""
    if not len(at):
        return np.zeros(0, np.uint64)
    runs = window_hashes(words, np.arange(len(words) - CORE + 1), CORE) & keyed.KEY48
    least = runs[: len(runs) - (WIDTH - CORE)].copy()
    for step in range(1, WIDTH - CORE + 1):
        np.minimum(least, runs[step : step + len(least)], out=least)
    return least[at]


def _id_slabs(batch: pa.RecordBatch) -> Iterator[tuple[Slab, np.ndarray]]:
    """Slabs with the ids of their rows; the rows without an id have empty texts."""
    batch = batch.filter(batch.column("doc_id").is_valid())
    ids = batch.column("doc_id").cast(pa.int64()).to_numpy()
    for slab in slabs(batch.column("text")):
        yield slab, ids[slab.first_row : slab.first_row + len(slab)]


def _deal_cores(buckets: int):
    """Each core of a slab once; those of several documents are candidates already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab, ids in _id_slabs(batch):
                words, at, row = _hashed(slab)
                cores, ids = _cores(words, at), ids[row]
                new = np.ones(len(cores), bool)
                new[1:] = (cores[1:] != cores[:-1]) | (ids[1:] != ids[:-1])
                cores, ids = cores[new], ids[new]
                order = np.lexsort((ids, cores))
                cores, ids = cores[order], ids[order]
                begin = keyed.group_begin(cores)
                several = np.zeros(len(cores), bool)
                several[begin[ids != ids[begin]]] = True
                several = several[begin]
                head = begin == np.arange(len(cores))
                if head.any():
                    yield keyed.pack(cores[head], [(cores[head], 6), (ids[head], 8)], buckets)
                if several.any():
                    pair = several & ((keyed.group_begin(cores, ids) == np.arange(len(cores))))
                    yield keyed.passed_on(ids[pair], cores[pair], buckets)

    return run


def _shared(cores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and cores of the entries whose core has two ids."""
    ids = ids.view(np.int64)
    order = np.lexsort((ids, cores))
    cores, ids = cores[order], ids[order]
    begin = keyed.group_begin(cores)
    several = np.zeros(len(cores), bool)
    several[begin[ids != ids[begin]]] = True
    return ids[several[begin]], cores[several[begin]]


def _deal_windows(buckets: int):
    """128-bit hashes of the windows with candidate cores.

    Of the equal windows of a slab only those of the smallest id are dealt out; the
    others are lost whatever else there is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("candidates")
            for slab, ids in _id_slabs(batch):
                words, at, row = _hashed(slab)
                cores = _cores(words, at)
                wanted = [b"".join(packed[slab.first_row + r].as_py()) for r in range(len(slab))]
                owner = np.repeat(np.arange(len(slab)), [len(w) // 8 for w in wanted])
                candidates = np.frombuffer(b"".join(wanted), np.uint64)
                # (row, core) pairs as one number; row numbers beyond 16 bits only add candidates
                pairs = (row.astype(np.uint64) << np.uint64(48)) | cores
                look = np.isin(pairs, (owner.astype(np.uint64) << np.uint64(48)) | candidates)
                at, own = at[look], ids[row[look]]
                if not len(at):
                    continue
                first, last, _ = slab.words()
                key = window_hashes(words, at, WIDTH, seed=1)
                check = window_hashes(slab.hashes(first, last, seed=2), at, WIDTH, seed=2)
                order = np.lexsort((own, check, key))
                key, check, own = key[order], check[order], own[order]
                begin = keyed.group_begin(key, check)
                head = begin == np.arange(len(key))
                yield keyed.pack(key[head], [(key[head], 8), (check[head], 8), (own[head], 8)], buckets)
                lost = own != own[begin]
                if lost.any():
                    yield keyed.passed_on(own[lost], key[lost], buckets)

    return run


def _lost(key: np.ndarray, check: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and windows of all entries but those of the smallest id of each window."""
    ids = ids.view(np.int64)
    order = np.lexsort((ids, check, key))
    key, check, ids = key[order], check[order], ids[order]
    lost = ids != ids[keyed.group_begin(key, check)]
    return ids[lost], key[lost]


def _cut(names: list[str]):
    """Cuts the lost windows from the texts and says what went."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            packed = batch.column(LOST)
            texts, n_words, n_removed, spans = [], [], [], []
            for slab in slabs(column):
                first, last, row = slab.words()
                counts = slab.per_row(first)
                begin = np.cumsum(counts) - counts
                words = None
                for r in range(len(slab)):
                    whole = column[slab.first_row + r]
                    lost = packed[slab.first_row + r].as_py()
                    n_words.append(int(counts[r]))
                    if not lost or counts[r] < WIDTH:
                        texts.append(whole.as_py())
                        n_removed.append(0)
                        spans.append([])
                        continue
                    if words is None:
                        words = slab.hashes(first, last)
                    own = words[begin[r] : begin[r] + counts[r]]
                    keys = window_hashes(own, np.arange(len(own) - WIDTH + 1), WIDTH, seed=1)
                    hit = np.flatnonzero(np.isin(keys, np.frombuffer(b"".join(lost), np.uint64)))
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, hit, 1)
                    np.add.at(edge, hit + WIDTH, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    own_first, own_last = first[begin[r] :], last[begin[r] :]
                    pieces, at = [], int(slab.starts[r])
                    for a, b in change.reshape(-1, 2):
                        pieces.append(slab.text(at, own_first[a]))
                        at = int(own_last[b - 1])
                    pieces.append(slab.text(at, int(slab.ends[r])))
                    texts.append(b"".join(pieces).decode())
                    n_removed.append(int(gone.sum()))
                    spans.append([{"first": int(a), "last": int(b) - 1} for a, b in change.reshape(-1, 2)])
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            arrays += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            arrays.append(pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))))
            yield pa.RecordBatch.from_arrays(arrays, [*names, "n_words", "n_removed", "removed"])

    return run


def _by_document(packed: DataFrame, name: str) -> DataFrame:
    return packed.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("packed").alias(name))


def lost_windows(documents: DataFrame) -> DataFrame:
    """Per document that loses windows: ``_id`` and their packed hashes."""
    texts = documents.select("doc_id", "text")
    shared = kept(keyed.deal(texts, _deal_cores, _shared, [6, 8]), "shared-cores")
    candidates = _by_document(shared, "candidates")
    again = texts.join(candidates, F.col("doc_id") == F.col("_id")).drop("_id")
    lost = kept(keyed.deal(again, _deal_windows, _lost, [8, 8, 8]), "lost-windows")
    return _by_document(lost, LOST)


def substring_dedup(documents: DataFrame) -> DataFrame:
    """The documents with their texts cut, and ``n_words``, ``n_removed``, ``removed``.

    ``removed`` lists the intervals (first and last word, counted from 0). A text that
    loses nothing is unchanged; elsewhere white space around an interval stays.
    Columns named like the results are replaced.
    """
    names = [c for c in documents.columns if c not in ("n_words", "n_removed", "removed", LOST)]
    documents = documents.select(*names)
    lost = lost_windows(documents)
    joined = documents.join(lost, documents["doc_id"] == lost["_id"], "left").select(*(documents[c] for c in names), LOST)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    added = "n_words long, n_removed long, removed array<struct<first: long, last: long>>"
    return joined.mapInArrow(_cut(names), f"{fields}, {added}")


def cut_documents(documents: DataFrame) -> DataFrame:
    """The documents with their texts cut, and no other change but to ``n_chars``."""
    own = {c: f"_own_{i}" for i, c in enumerate(documents.columns) if c in ("n_words", "n_removed", "removed", LOST)}
    cut = substring_dedup(documents.withColumnsRenamed(own)).withColumnsRenamed({"n_removed": "_n_removed"})
    if "n_chars" in documents.columns:
        length = F.char_length("text").cast(documents.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("_n_removed") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*(F.col(own.get(c, c)).alias(c) for c in documents.columns))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), _WORDS), lambda w: w != "")
    return substring_dedup(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256")
    )
