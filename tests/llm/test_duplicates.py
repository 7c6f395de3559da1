"""Substring dedup and the Jaccard join against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from billsift.llm import registry, similar, substrings, tables


def test_substring_dedup_on_a_table(spark, sf_dir, texts):
    rows = registry.QUERIES["op4_substring_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute.substring_dedup(texts)


def test_jaccard_groups_on_a_table(spark, sf_dir, texts):
    rows = registry.QUERIES["op7_ngram_jaccard_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.jaccard_groups(texts)


def _near_copies(seed: int) -> dict[int, str]:
    """Chains of near copies around the limit, documents with a common passage, short texts."""
    rnd = random.Random(seed)
    word = lambda: f"v{rnd.randrange(4000)}"
    passage = [word() for _ in range(40)]
    documents = {}
    for group in range(6):
        own = [word() for _ in range(rnd.choice([8, 20, 60, 150]))]
        for _ in range(12):
            for _ in range(rnd.randrange(3)):
                own[rnd.randrange(len(own))] = word()
            documents[len(documents)] = " ".join(own)
            own = list(own)
    for _ in range(60):
        own = [word() for _ in range(rnd.randrange(30, 80))]
        at = rnd.randrange(len(own))
        documents[len(documents)] = " ".join(own[:at] + passage + own[at:])
    for n in range(1, 5):
        documents[len(documents)] = documents[len(documents) + 1] = " ".join("abcd"[:n])
    return documents


@pytest.mark.parametrize("shard", [400, similar.SHARD_SHINGLES])
def test_jaccard_groups_of_near_copies(spark, shard):
    """With small shards, links across shards decide."""
    documents = _near_copies(shard)
    frame = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.jaccard_groups(frame, shard).collect()}
    assert got == brute.jaccard_groups(documents)


def test_documents_of_one_template_are_not_paired(spark, monkeypatch):
    """160 documents with 170 of 200 shingles in common do not link; near copies of some do, in other shards."""
    rnd = random.Random(5)
    word = lambda: f"v{rnd.randrange(100000)}"
    common = [word() for _ in range(174)]
    documents = [common + [word() for _ in range(30)] for _ in range(160)]
    documents += [d[:-3] + [word()] * 3 for d in documents[:20]]
    texts = {i: " ".join(d) for i, d in enumerate(documents)}
    written = []

    def counted(frame, name):
        written.append((name, (out := keep(frame, name)).count()))
        return out

    keep = similar.kept
    monkeypatch.setattr(similar, "kept", counted)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.jaccard_groups(frame, 9000).collect()}
    assert got == brute.jaccard_groups(texts)
    assert len({c for _, c in got.values()}) == 160
    assert dict(written)["block-sizes"] == 1 and max(n for _, n in written) <= 10 * len(texts), written


def _counted(monkeypatch, spark):
    """Rows of the tables that the join keeps, and of what it deals out with repartition()."""
    written, moved = [], []
    keep, kind = similar.kept, type(spark.range(0))
    deal = kind.repartition
    monkeypatch.setattr(similar, "kept", lambda frame, name: written.append((name, (out := keep(frame, name)).count())) or out)
    monkeypatch.setattr(kind, "repartition", lambda self, *a: moved.append(self.count()) or deal(self, *a))
    return written, moved


def test_passages_do_not_chain_documents_to_one_large_block(spark, monkeypatch):
    """120 documents with two of eight common passages each, and near copies of some: only those are searched."""
    rnd = random.Random(11)
    word = lambda: f"v{rnd.randrange(100000)}"
    passages = [[word() for _ in range(20)] for _ in range(8)]
    documents = [passages[i % 8] + [word() for _ in range(24)] + passages[i % 7] for i in range(120)]
    documents += [[*d[:-2], word(), word()] for d in documents[:15]]
    texts = {i: " ".join(d) for i, d in enumerate(documents)}
    written, moved = _counted(monkeypatch, spark)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.jaccard_groups(frame, 1500).collect()}
    assert got == brute.jaccard_groups(texts)
    assert max(n for name, n in written if name == "records") >= 100, written
    assert [n for name, n in written if name == "labels"] == [0] and max(moved) <= 60, (written, moved)


def test_sets_of_many_shards_are_dealt_once(spark, monkeypatch):
    """Documents that no filter tells apart, in 20 shards or more: each set is dealt once, not once for each other shard."""
    rnd = random.Random(6)
    word = lambda: f"v{rnd.randrange(100000)}"
    common = [word() for _ in range(90)]
    documents = [common[: 86 + i % 2] + [word() for _ in range(15)] for i in range(60)]
    documents += [[*d[:-3], *(word() for _ in range(3))] for d in documents[:20]]
    texts = {i: " ".join(d) for i, d in enumerate(documents)}
    written, moved = _counted(monkeypatch, spark)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.jaccard_groups(frame, 380).collect()}
    assert got == brute.jaccard_groups(texts)
    assert len({c for _, c in got.values()}) == 60 and max(moved) <= len(texts), (written, moved)


def test_texts_of_many_records_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_IDS", 8)
    monkeypatch.setattr(similar, "BROADCAST_IDS", 8, raising=False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
        records = tables.kept(spark.createDataFrame([(i, 2 * i) for i in range(0, 60, 2)], "rep long, block long"), "records")
        got = similar._with_texts(documents, records)
        assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.doc_id, r.text, r.rep, r.block) for r in got.collect()) == [(i, f"text {i}", i, 2 * i) for i in range(0, 60, 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_shards_do_not_matter_to_rows_that_share_an_id(spark):
    rows = [*_near_copies(4).items()]
    rows += [(i, rows[(7 * i + 20) % len(rows)][1]) for i in range(0, 60, 4)] + rows[:9] + [(None, rows[3][1]), (90, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted(map(tuple, similar.jaccard_groups(frame, n).collect()), key=str) for n in (300, similar.SHARD_SHINGLES)]
    assert got[0] == got[1]


def test_linking_sets_share_a_rare_shingle():
    """Of sets in one order, as the two dealers choose them; bytes stand for what goes through the shuffle."""
    rnd = np.random.default_rng(9)
    passage = rnd.integers(0, 2**60, 60, dtype=np.uint64)
    sets = []
    for _ in range(40):
        base = np.append(rnd.integers(0, 2**60, rnd.integers(0, 60), dtype=np.uint64), passage[: rnd.integers(1, 60)])
        sets += [base, np.append(base[len(base) // 9 :], rnd.integers(0, 2**60, len(base) // 10, dtype=np.uint64))]
    sets = [np.unique(s) & np.uint64(2**48 - 1) for s in sets]
    names = np.arange(len(sets)).astype(np.uint64)
    records, values = similar._shared(np.concatenate(sets), np.repeat(names, [len(s) for s in sets]))
    size = np.array([len(s) for s in sets])
    batch = pa.table(
        {"doc_id": pa.array(range(len(sets)), pa.int64()), "n_shingles": size, "packed": [[values[records == i].tobytes()] for i in range(len(sets))]}
    ).to_batches()
    blocks = next(similar._deal_rarest(1)(iter(batch))).column("packed").to_pylist()
    keys, owner = similar.keyed.unpack(blocks, [6, 8])
    mine = [set(keys[owner == n].tolist()) for n in names]
    linked = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (size[i] + size[j] - both):
                linked += 1
                assert mine[i] & mine[j]
    assert linked > 30 and sum(map(len, mine)) < size.sum() / 2


def test_parts_across_two_shards():
    rnd = np.random.default_rng(3)
    for _ in range(50):
        base = [rnd.choice(200, 40, replace=False).astype(np.uint64) for _ in range(4)]
        sets = [[np.unique(np.append(rnd.choice(base[rnd.integers(4)], 37, replace=False), rnd.integers(200, 220, 1, np.uint64))) for _ in range(8)] for _ in range(2)]
        parts = [similar.parts_of(s) for s in sets]
        parts = [[p for p in parts[0]], [p + 100 for p in parts[1]]]
        group = {x: x for own in parts for x in own}
        expected = dict(group)

        def joined(groups, a, b):
            a, b = groups[a], groups[b]
            return {x: min(a, b) if g in (a, b) else g for x, g in groups.items()}

        for a, b in similar.parts_across(sets, parts):
            group = joined(group, a, b)
        for x, p in zip(sets[0], parts[0], strict=True):
            for y, q in zip(sets[1], parts[1], strict=True):
                both = len(np.intersect1d(x, y))
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    expected = joined(expected, p, q)
        assert group == expected


def test_search_finds_all_links():
    rnd = np.random.default_rng(1)
    base = np.unique(rnd.integers(0, 2**60, 300, dtype=np.uint64))
    sets = []
    for _ in range(60):
        changed = base.copy()
        changed[rnd.choice(len(base), rnd.integers(0, 60), replace=False)] = rnd.integers(0, 2**60, dtype=np.uint64)
        sets.append(np.unique(np.concatenate([changed, rnd.integers(0, 2**60, rnd.integers(0, 30), dtype=np.uint64)])))
    lists = similar.Lists(sets)
    for own in sets:
        expected = [
            i for i, other in enumerate(sets) if 100 * len(np.intersect1d(own, other)) >= 80 * len(np.union1d(own, other))
        ]
        assert lists.links(own).tolist() == expected
    assert 60 < sum(len(lists.links(s)) for s in sets) < 3600


def test_linking_sets_share_a_signature():
    rnd = np.random.default_rng(2)
    for _ in range(400):
        n = int(rnd.integers(1, 200))
        base = rnd.integers(0, 2**62, n, dtype=np.uint64)
        gone, new = int(rnd.integers(0, n // 8 + 1)), int(rnd.integers(0, n // 8 + 1))
        other = np.unique(np.concatenate([base[gone:], rnd.integers(0, 2**62, new, dtype=np.uint64)]))
        base = np.unique(base)
        both = len(np.intersect1d(base, other))
        if not both or 100 * both < 80 * (len(base) + len(other) - both):
            continue
        rows = np.repeat([0, 1], [len(base), len(other)])
        keys, owner = similar._signatures(rows, np.concatenate([base, other]), np.array([len(base), len(other)]))
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_hard_rows(hard, no_rows):
    cut = substrings.substring_dedup(hard)
    assert cut.columns[0] == "doc_id" and "lang" in cut.columns
    got = [(r.doc_id, r.n_words, r.n_removed) for r in cut.collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 16, 0), (2, 16, 16), (2, 16, 16), (3, 16, 13), (4, 0, 0), (5, 0, 0), (6, 0, 0), (7, 3, 0), (8, 3, 0), (None, 16, 0)]
        + [(None, 0, 0), (9, 30000, 0), (10, 30001, 30000), (11, 11, 0)],
        key=str,
    )
    groups = [(r.doc_id, r.n_shingles, r.component_id) for r in similar.jaccard_groups(hard).collect()]
    assert sorted(groups, key=str) == sorted(
        [(1, 12, 1), (2, 12, 1), (2, 12, 1), (3, 12, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 1, 7), (8, 1, 7), (None, 12, None)]
        + [(None, 0, None), (9, 977, 9), (10, 978, 9), (11, 7, 11)],
        key=str,
    )
    left = similar.one_of_each_group(hard)
    assert left.columns == hard.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 4, 5, 6, 7, 9, 11, None, None], key=str)
    assert substrings.substring_dedup(no_rows).count() == similar.jaccard_groups(no_rows).count() == 0


def test_many_dropped_documents_do_not_move_the_texts(spark, monkeypatch):
    """40 of 90 documents are dropped, ten ids are sent at a time; the texts that stay are read where they lie."""
    monkeypatch.setattr(tables, "BROADCAST_IDS", 10)
    monkeypatch.setattr(similar, "BROADCAST_IDS", 10, raising=False)
    monkeypatch.setattr(similar, "TURNS", 5, raising=False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, " ".join(f"w{i % 20}x{k}" for k in range(30)) if i % 3 else None) for i in range(90)]
        documents = tables.kept(spark.createDataFrame(rows, "doc_id long, text string"), "documents")
        left = similar.one_of_each_group(documents)
        assert "Exchange hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()
        expected = [(i, t) for i, t in rows if t is None or all(t != other for _, other in rows[:i])]
        assert sorted(map(tuple, left.collect()), key=str) == sorted(expected, key=str) and len(expected) == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_one_of_rows_with_the_same_id(spark):
    frame = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 2), (2, "z", 3)], "doc_id long, text string, n int")
    assert sorted(map(tuple, similar.one_of_each_group(frame).collect())) == [(1, "a", 2), (2, "z", 3)]
