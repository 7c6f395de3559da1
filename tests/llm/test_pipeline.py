"""Benchmark decontamination and the pipeline of five stages."""

import random

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from billsift.llm import decontaminate, registry, rules
from billsift.llm.tables import kept


def _lower_words(text):
    return brute.WORDS.findall((text or "").translate(brute.LOWER))


def _edited(words: list[str], edits: int, rnd: random.Random) -> list[str]:
    words = list(words)
    for _ in range(edits):
        at = rnd.randrange(len(words))
        change = rnd.randrange(3)
        if change == 0:
            words[at] = f"new{rnd.randrange(999)}"
        elif change == 1:
            words.insert(at, f"new{rnd.randrange(999)}")
        else:
            del words[at]
    return words


def test_found_items_are_all_right(spark, sf_dir, texts):
    """Every exact copy is found, and what is found is within the edit distance."""
    items = {r.item_id: _lower_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    rows = registry.QUERIES["op3_benchmark_decontamination"](spark, sf_dir).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    for doc_id, text in texts.items():
        joined = f" {' '.join(_lower_words(text))} "
        for item_id, words in items.items():
            if f" {' '.join(words)} " in joined:
                assert (doc_id, item_id) in found
    for r in rows:
        words = _lower_words(texts[r.doc_id])
        assert r.n_edits == brute.edit_distance_in(items[r.item_id], words) <= len(items[r.item_id]) // 10
        stretch = words[r.first_word : r.first_word + r.n_words]
        assert brute.edit_distance_in(items[r.item_id], stretch) == r.n_edits


def test_recall_of_edited_items(spark):
    """Measured against the most edits that are allowed: 0.9 or more."""
    rnd = random.Random(7)
    table = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    filler = [w for r in table for w in brute.WORDS.findall(r.text)]
    rnd.shuffle(filler)
    index = decontaminate.Index([r.item_id for r in table], pa.array([r.text for r in table]))
    documents, truth = [], []
    for _ in range(25):
        for r in table:
            words = brute.WORDS.findall(r.text)
            at = rnd.randrange(len(filler) - 100)
            around = filler[at : at + 100]
            documents.append(" ".join(around[: rnd.randrange(60)] + _edited(words, len(words) // 10, rnd) + around[60:]))
            truth.append(r.item_id)
    hits = 0
    for slab in decontaminate.slabs(pa.array(documents)):
        first, last, rows = slab.words()
        found = {(row, index.ids[n]) for row, n in index.found(slab.hashes(first, last, lower=True), rows, len(slab))}
        hits += sum((row, truth[slab.first_row + row]) in found for row in range(len(slab)))
    assert hits / len(truth) >= 0.9


def clustered(n, rnd, copies=20):
    """Items of n words, and texts with each item, whose n // 10 edits sit together at its beginning, middle or end."""
    items = [[f"w{rnd.randrange(5000)}" for _ in range(n)] for _ in range(4)]
    texts = []
    for number, words in enumerate(items):
        for copy in range(copies * 3):
            edits = n // 10
            at = (rnd.randrange(n // 10), (n - edits) // 2, n - edits - rnd.randrange(n // 10))[copy % 3]
            # an equal number of words replaced, added or dropped in one place
            kind = copy // 3 % 3
            put = [f"x{rnd.randrange(5000)}" for _ in range(edits)] if kind < 2 else []
            edited = words[:at] + put + words[at + (edits if kind != 1 else 0) :]
            around = [f"w{rnd.randrange(5000)}" for _ in range(60)]
            texts.append((number, " ".join(around[:30] + edited + around[30:])))
    return [" ".join(i) for i in items], texts


@pytest.mark.parametrize("n", [64, 100, 320, 1000])
def test_recall_of_long_items_with_edits_in_one_place(n):
    items, texts = clustered(n, random.Random(n))
    index = decontaminate.Index(list(range(len(items))), pa.array(items))
    hits = 0
    for slab in decontaminate.slabs(pa.array([t for _, t in texts])):
        first, last, rows = slab.words()
        found = {(row, index.ids[k]) for row, k in index.found(slab.hashes(first, last, lower=True), rows, len(slab))}
        hits += sum((row, texts[slab.first_row + row][0]) in found for row in range(len(slab)))
    assert hits / len(texts) >= 0.99


def test_best_match_is_the_edit_distance():
    rnd = np.random.default_rng(8)
    for _ in range(100):
        item, text = rnd.integers(1, 5, rnd.integers(1, 9)), rnd.integers(1, 5, rnd.integers(0, 20))
        assert decontaminate.best_match(item, text)[0] == brute.edit_distance_in(list(item), list(text))


def test_hard_items_and_blocks(spark, hard, no_rows):
    rows = [(1, "c d E f g h i j k l"), (2, None), (3, ""), (None, "one two three"), (4, "ONE two three"), (5, "w5 w6 w7 w8 w9 w10 w11 w12 w13")]
    rows += [(6, "ONE two three"), (7, " ".join(f"w{i}" for i in range(900)))]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    expected = sorted(
        [(d, 1) for d in (1, 2, 2, 3, None)] + [(d, i) for d in (7, 8) for i in (4, 6)] + [(d, i) for d in (9, 10) for i in (5, 7)], key=str
    )
    for block_items in (2, 1000):
        found = decontaminate.contaminated(hard, benchmark, block_items).collect()
        assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == expected
        left = decontaminate.decontaminated(hard, benchmark, block_items)
        assert left.columns == hard.columns
        assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([None, 4, 5, 6, 11], key=str)
    assert decontaminate.contaminated(no_rows, benchmark).count() == decontaminate.contaminated(hard, benchmark.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage makes of the smallest tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(kept(stage(spark, out[-1], sf_dir), name))
    return out


def test_stages_against_plain_versions(spark, sf_dir, stages):
    docs, good, single, cut, clean, encoded = stages
    by_id = lambda frame: {r.doc_id: r for r in frame.collect()}
    judged = {r.doc_id for r in rules.quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("kept").collect()}
    assert set(by_id(good)) == judged
    groups = brute.jaccard_groups({d: r.text for d, r in by_id(good).items()})
    assert set(by_id(single)) == {d for d, (_, group) in groups.items() if d == group}
    removed = brute.substring_dedup({d: r.text for d, r in by_id(single).items()})
    for d, r in by_id(cut).items():
        assert len(brute.WORDS.findall(r.text)) == removed[d][0] - removed[d][1] and r.n_chars == len(r.text)
    found = {r.doc_id for r in decontaminate.contaminated(cut, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert set(by_id(clean)) == set(by_id(cut)) - found
    assert by_id(encoded).keys() == by_id(clean).keys() and all(r.round_trip for r in by_id(encoded).values())
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == before.columns


def test_run_is_its_stages(spark, sf_dir, stages):
    key = lambda rows: sorted((r.doc_id, r.text, tuple(r.ids)) for r in rows)
    assert key(corpus_pipeline.run(spark, sf_dir).collect()) == key(stages[-1].collect())


def test_stages_of_hard_rows(spark, hard, no_rows, sf_dir):
    for frame in (hard, no_rows):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = kept(stage(spark, docs, sf_dir), name)
        assert docs.count() <= frame.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, hard, sf_dir).columns == hard.columns
