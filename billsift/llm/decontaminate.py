"""Benchmark decontamination: documents that hold a benchmark item up to a few edits.

Texts and items are sequences of words, compared in lower case of A-Z. An item of n
words is found where a stretch of a text has an edit distance of at most n // 10
words from it.

The CGK embedding walks over a sequence: at each step the word under the walker decides,
by a random bit for the step, whether the walker moves on. Sequences that differ by
few edits soon have walkers at matching words, so their edit distance becomes a Hamming
distance of what the walkers see. Walkers start at every word of a text. Those that
meet stay together and go on as one, which makes walks from all starts cheap. Keys are
words seen at sampled steps (bit sampling), in several samples of several walks;
the steps sampled for an item depend on its length class, so that a walker stays within
a window of the item's size. Longer items have keys at every ``STRETCH`` words besides, so
that edits that sit together leave other stretches as they were. Where a key of a text is
one of an item, the edit distance is computed and decides alone.

Recall: a copy without edits is found always, as equal words give equal keys. For edited
copies ``WALKS`` and ``SAMPLES`` set the recall, which the tests measure.

The benchmark is the query set. It is read by the driver in blocks of about
``BLOCK_ITEMS`` items, a long one counted as often as it has stretches, for each of which all documents are scanned in one narrow pass. Null
or empty items and texts match nothing. Items of fewer than 8 words allow no edit and
are found by the hash of the whole. Repeated rows are reported each. Columns other than
ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift.llm.texts import mix, slabs, window_hashes

WALKS = 2
SAMPLES = 8
SAMPLED_STEPS = 4
CLASSES = (8, 16, 32, 64)  # least number of words; items of the last are looked for by their stretches too
STRETCH = 32
EDITS_PER_WORDS = 10
BLOCK_ITEMS = 20_000
_ONE = np.uint64(1)
_FOUND = "doc_id long, item_id long, n_edits int, first_word long, n_words long"


def _ended(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with a 0 after each row's last one, and where each row begins."""
    counts = np.bincount(rows, minlength=n)
    begin = np.cumsum(counts + 1) - counts - 1
    out = np.zeros(len(words) + n, np.uint64)
    out[np.arange(len(words)) + rows] = np.maximum(words, np.uint64(1))
    return out, begin


class Walks:
    """The random bits and sampled steps of all walks."""

    def __init__(self, seed: int = 11):
        random = np.random.default_rng(seed)
        self.salts = random.integers(1, 2**63, (WALKS, 2), dtype=np.uint64)
        self.samples = [
            [[np.sort(random.choice(np.arange(c // 2, 3 * c // 2), SAMPLED_STEPS, replace=False)) for _ in range(SAMPLES)] for c in CLASSES]
            for _ in range(WALKS)
        ]

    def keys(self, words: np.ndarray, starts: np.ndarray, wanted: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each class wanted and each sample: class, keys, first and last start of each walker.

        ``words`` is ended by zeros, on which walkers stay; ``starts`` are ascending.
        """
        for walk in range(WALKS):
            seen = mix(words ^ self.salts[walk, 0])
            seen[words == 0] = 0
            later = None
            at, first = starts, np.arange(len(starts))
            step = 0
            for number, least in enumerate(CLASSES):
                if number > max(wanted):
                    break
                while step < least // 2:
                    at = at + ((seen.take(at) >> np.uint64(step)) & _ONE).view(np.int64)
                    step += 1
                new = np.ones(len(at), bool)
                new[1:] = at[1:] != at[:-1]
                at, first = at[new], first[new]
                if number not in wanted:
                    continue
                last = np.append(first[1:], len(starts)) - 1
                samples = self.samples[walk][number]
                keys = [np.full(len(at), number + 1, np.uint64) for _ in samples]
                own = at
                for s in range(step, int(max(x[-1] for x in samples)) + 1):
                    if s == 64:
                        later = mix(words ^ self.salts[walk, 1])
                        later[words == 0] = 0
                    under = (seen if s < 64 else later).take(own)
                    for i, sample in enumerate(samples):
                        if s in sample:
                            keys[i] = keys[i] * np.uint64(0x9E3779B97F4A7C15) + under
                    own = own + ((under >> np.uint64(s % 64)) & _ONE).view(np.int64)
                for i, key in enumerate(keys):
                    yield number, mix(key + np.uint64(walk * SAMPLES + i)), first, last


def class_of(n: int) -> int:
    """Index of an item's length class, -1 for short ones."""
    return int(np.searchsorted(CLASSES, n, "right")) - 1


def _stretches(n: int) -> list[tuple[int, np.ndarray]]:
    """Classes of the keys of an item of n words, and the words from which it has them."""
    own = [(class_of(n), np.zeros(1, np.int64))]
    return own if n < CLASSES[-1] else [*own, (class_of(STRETCH), np.arange(0, n - STRETCH + 1, STRETCH))]


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of an item to a stretch of a text, and the first end of such a stretch."""
    across = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        step = np.empty_like(row)
        step[0] = i
        step[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(step - across) + across
    end = int(row.argmin())
    return int(row[end]), end


def _merged(spots: list[tuple[int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """Ranges of starts, those at most ``reach`` apart made one."""
    low, high = spots[0]
    for a, b in spots[1:]:
        if a > high + reach:
            yield low, high
            low = a
        high = max(high, b)
    yield low, high


class Index:
    """Keys of a block of items, and their words for the exact comparison."""

    def __init__(self, ids: list[int], texts: pa.Array):
        self.ids, self.items, self.short, keys, owners, offsets = [], [], {}, [], [], []
        self.wanted: set[int] = set()
        self.walks = Walks()
        row = 0
        for slab in slabs(texts):
            first, last, rows = slab.words()
            words = slab.hashes(first, last, lower=True)
            edge = np.searchsorted(rows, np.arange(len(slab) + 1))
            for r in range(len(slab)):
                item, number = words[edge[r] : edge[r + 1]], len(self.items)
                if len(item) and ids[row] is not None:
                    self.ids.append(ids[row])
                    self.items.append(item)
                    if class_of(len(item)) < 0:
                        whole = int(window_hashes(item, np.zeros(1, np.int64), len(item))[0])
                        self.short.setdefault(len(item), {}).setdefault(whole, []).append(number)
                    else:
                        ended, _ = _ended(item, np.zeros(len(item), np.int64), 1)
                        for own, starts in _stretches(len(item)):
                            self.wanted.add(own)
                            for c, key, begin, end in self.walks.keys(ended, starts, [own]):
                                if c == own:
                                    keys.append(np.repeat(key, end - begin + 1))
                                    owners.append(np.full(len(starts), number))
                                    offsets.append(starts)
                row += 1
        self.keys = np.concatenate([np.zeros(0, np.uint64), *keys])
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.owners, self.offsets = (np.concatenate([np.zeros(0, np.int64), *x])[order] for x in (owners, offsets))
        self.bits = np.zeros(1 << max(16, (64 * len(self.keys)).bit_length()), bool)
        self.bits[self.keys & np.uint64(len(self.bits) - 1)] = True

    def found(self, words: np.ndarray, rows: np.ndarray, n: int) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(row, item) to edits, first word and number of words of the best stretch."""
        counts = np.bincount(rows, minlength=n)
        begin = np.cumsum(counts) - counts
        places: dict[tuple[int, int], set[tuple[int, int]]] = {}
        if self.wanted and len(words):
            ended, _ = _ended(words, rows, n)
            starts = np.arange(len(words)) + rows
            for _, key, first, last in self.walks.keys(ended, starts, sorted(self.wanted)):
                maybe = np.flatnonzero(self.bits[key & np.uint64(len(self.bits) - 1)])
                low = np.searchsorted(self.keys, key[maybe], "left")
                high = np.searchsorted(self.keys, key[maybe], "right")
                for m, a, b in zip(maybe[high > low], low[high > low], high[high > low], strict=True):
                    spot = (int(first[m]), int(last[m]))
                    for number, offset in zip(self.owners[a:b].tolist(), self.offsets[a:b].tolist(), strict=True):
                        # walkers of two texts never meet, so both ends are in one row
                        places.setdefault((int(rows[spot[0]]), number), set()).add((spot[0] - offset, spot[1] - offset))
        best = {}
        for (row, number), spots in places.items():
            item = self.items[number]
            edits = len(item) // EDITS_PER_WORDS
            for low, high in _merged(sorted(spots), len(item)):
                a = max(begin[row], low - edits)
                b = max(a, min(begin[row] + counts[row], high + len(item) + 2 * edits))
                if np.isin(item, words[a:b]).sum() < len(item) - edits:
                    continue  # each word that is missing is an edit
                distance, end = best_match(item, words[a:b])
                if distance <= edits and distance < best.get((row, number), (edits + 1,))[0]:
                    _, back = best_match(item[::-1], words[a : a + end][::-1])
                    best[row, number] = (distance, int(a + end - back - begin[row]), int(back))
        for width, wholes in self.short.items():
            at = np.flatnonzero(rows[: len(rows) - width + 1] == rows[width - 1 :]) if len(rows) >= width else rows[:0]
            hashes = window_hashes(words, at, width)
            for m in np.flatnonzero(np.isin(hashes, np.array(list(wholes), np.uint64))):
                for number in wholes[int(hashes[m])]:
                    row = int(rows[at[m]])
                    best.setdefault((row, number), (0, int(at[m] - begin[row]), width))
        return best


def _search(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for slab in slabs(batch.column("text")):
                first, last, rows = slab.words()
                found = index.found(slab.hashes(first, last, lower=True), rows, len(slab))
                if found:
                    keys = sorted(found)
                    values = [found[k] for k in keys]
                    columns = [
                        pa.array([ids[slab.first_row + row].as_py() for row, _ in keys], pa.int64()),
                        pa.array([index.ids[number] for _, number in keys], pa.int64()),
                        *(pa.array([v[i] for v in values], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_edits", "first_word", "n_words"])

    return run


def _indexes(benchmark: DataFrame, block_items: int) -> Iterator[Index]:
    """The items in blocks, each with its keys; a block is all that the driver holds."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    stretches = F.greatest(F.lit(1), F.floor(F.size(F.split("text", r"\s+")) / STRETCH))
    count = items.agg(F.sum(stretches)).first()[0] or 0
    blocks = max(1, -(-int(count) // block_items))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        yield Index(part.column("item_id").to_pylist(), part.column("text"))


def contaminated(documents: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """A row per document and item found in it: edits, first word and number of words."""
    texts = documents.select("doc_id", "text")
    return reduce(DataFrame.union, [texts.mapInArrow(_search(i), _FOUND) for i in _indexes(benchmark, block_items)])


def _clean(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch.column("text")):
                first, last, rows = slab.words()
                found = index.found(slab.hashes(first, last, lower=True), rows, len(slab))
                clean = np.ones(len(slab), bool)
                clean[[row for row, _ in found]] = False
                yield batch.slice(slab.first_row, len(slab)).filter(pa.array(clean))

    return run


def decontaminated(documents: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    for index in _indexes(benchmark, block_items):
        documents = documents.mapInArrow(_clean(index), documents.schema)
    return documents


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
