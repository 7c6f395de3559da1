"""Quality rules, quality classifier, toxicity: counts exactly, models on held-out rows."""

import zlib

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from billsift.llm import quality, registry, rules, toxicity
from billsift.llm.texts import slabs

SF = "/root/testdata/sf0.01"


def _auc(score, label) -> float:
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    good = np.asarray(label) == 1
    return (rank[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


def test_rule_counts(spark):
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.QUERIES["op8_quality_rules"](spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in rows} == {d: brute.rule_counts(t) for d, t in documents.items()}
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_rules_keep_good_documents(spark):
    judged = registry.QUERIES["op8_quality_rules"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    share = {r.quality: r.kept for r in judged.filter("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share[0] < 0.1


def test_forest_sets_strange_rows_apart():
    rnd = np.random.default_rng(4)
    forest = rules.IsolationForest(rnd.normal(0, 1, (2000, 3)))
    usual, strange = forest.scores(rnd.normal(0, 1, (500, 3))), forest.scores(rnd.normal(8, 1, (50, 3)))
    assert strange.min() > np.quantile(usual, 0.98)
    assert rules.IsolationForest(np.zeros((5, 2))).scores(np.zeros((2, 2))).shape == (2,)


def test_quality_rules_of_hard_rows(spark, hard, no_rows, labels):
    got = rules.quality_rules(hard, labels)
    counts = [tuple(r)[1:6] for r in got.collect()]
    assert sorted(counts) == sorted(brute.rule_counts(r.text) for r in hard.collect())
    kept = rules.keep_good(hard, labels)
    assert kept.columns == hard.columns
    assert rules.quality_rules(no_rows, labels.limit(0)).count() == rules.keep_good(no_rows, labels).count() == 0


def test_posteriors_find_reliable_labellers():
    """Votes drawn from known accuracies; labellers that often err get less say."""
    rnd = np.random.default_rng(5)
    n, bad = 20000, rnd.random(20000) < 0.2
    accuracy = np.array([0.95, 0.9, 0.9, 0.85, 0.8, 0.55, 0.9])
    right = rnd.random((n, 7)) < accuracy
    votes = np.where(right == bad[:, None], 2, 1) * (rnd.random((n, 7)) < 0.8)
    patterns, where, counts = np.unique(votes @ 3 ** np.arange(6, -1, -1), return_inverse=True, return_counts=True)
    chance, table = quality.posteriors(patterns, counts.astype(float))
    found = table[1, :, 2] / (table[1, :, 1] + table[1, :, 2])
    assert np.abs(found - accuracy).max() < 0.03
    assert ((chance[where] > 0.5) == bad).mean() > 0.97


def test_quality_classifier(spark):
    judged = registry.QUERIES["op6_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert _auc(judged["score"], judged["quality"]) > 0.98
    assert judged.loc[judged["quality"] == 1, "kept"].mean() > 0.98
    assert judged.loc[judged["quality"] == 0, "kept"].mean() < 0.1


def test_quality_classifier_of_hard_rows(hard, no_rows):
    rows = quality.classify_quality(hard).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify_quality(no_rows).count() == 0


def test_votes_of_texts():
    texts = pa.array(["", "word " * 20, "a*** b### c$$$ d%%% e&&& f", "SHOUT!! LOUD!! VERY!! MUCH!! NOW!!", None, "The quick fox sits. It is here."])
    (slab,) = slabs(texts)
    digits = quality._digits(quality.slab_votes(slab))
    bad = (digits == 2).any(1)
    assert bad.tolist() == [False, True, True, True, False, False]
    assert digits[0].sum() == digits[4].sum() == 0 and digits[5].tolist() == [0, 0, 0, 0, 0, 0, 1]


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    judged = registry.QUERIES["op10_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(judged["doc_id"], judged["held_out"], strict=True))
    held = judged[judged["held_out"]]
    assert _auc(held["score"], held["toxic"]) > 0.85
    assert (held["predicted"] == (held["score"] >= 0.3)).all()
    toxic = held["toxic"] == 1
    assert held.loc[toxic, "predicted"].mean() > 0.55 and held.loc[~toxic, "predicted"].mean() < 0.03


def test_toxicity_of_hard_rows(spark, hard, no_rows, labels):
    rows = toxicity.score_toxicity(hard, labels).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in toxicity.score_toxicity(hard, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(no_rows, labels).count() == 0


def test_telling_stretches():
    toxic = [b" you are a grumbleflop and that is bad %d " % i for i in range(20)]
    ordinary = [b" you are a friend and that is good %d " % i for i in range(200)]
    joined = b"|".join(toxicity.telling_stretches(toxic, ordinary))
    assert b"grumbleflop" in joined and b"friend" not in joined
