"""Ranked lexical search against a plain scoring of every document."""

import math
from collections import Counter

import regex
from pyspark.sql import functions as F

from billsift.llm import lexical

TERM = regex.compile(lexical.TERM)


def terms(text):
    if text is None:
        return []
    return TERM.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, k=10):
    bags = {}
    for doc_id, text in docs:
        if doc_id is not None:
            bags.setdefault(doc_id, Counter()).update(terms(text))
    bags = {d: b for d, b in bags.items() if sum(b.values())}
    n_docs, length = len(bags), sum(sum(b.values()) for b in bags.values())
    df = Counter(t for b in bags.values() for t in b)
    out = []
    for item_id, text in items:
        scores = {}
        for d, bag in bags.items():
            n = sum(bag.values())
            m = 25 + (75 * n * n_docs) // length
            s = 0
            for t in terms(text):
                tf = bag.get(t, 0)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scores[d] = s
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(item_id, r + 1, d, s) for r, (d, s) in enumerate(ranked)]
    return sorted(out)


ITEMS = [(1, "a b c"), (2, "ONE two three three"), (3, None), (4, ""), (5, "w1 w2 end é 日本"), (6, "zzz-unknown"), (7, "p")]


def test_search_equals_brute_force_on_hard_rows(spark, hard):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(tuple(r) for r in lexical.search(hard, items).collect())
    assert got == brute([(r.doc_id, r.text) for r in hard.collect()], ITEMS)


def test_search_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = sorted(tuple(r) for r in lexical.search(docs, items).collect())
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and got


def test_ties_and_copies(spark):
    # Ten equal copies and more: ranks follow doc_id; every cluster is probed or bounded.
    rows = [(i, "same words here") for i in range(30)] + [(100 + i, f"other {i} words") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "same"), (2, "words"), (3, "other 7")], "item_id long, text string")
    got = sorted(tuple(r) for r in lexical.search(docs, items).collect())
    assert got == brute(rows, [(1, "same"), (2, "words"), (3, "other 7")])


def test_empty_tables(spark, no_rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(no_rows, items).count() == 0


def test_each_step_is_computed_once(spark, monkeypatch):
    """What is counted and then joined is written before, so postings are read a fixed few times."""
    plans = []
    real = lexical.small

    def noted(frame):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return real(frame)

    monkeypatch.setattr(lexical, "small", noted)
    docs = spark.createDataFrame([(i, f"a b{i % 3} c{i % 7}") for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b1 c2"), (2, "c3 b2")], "item_id long, text string")
    lexical.search(docs, items).collect()
    assert plans and not [p for p in plans if "Window" in p or "Join" in p]


def test_terms_of_ascii_and_other_texts(spark):
    texts = ["ABC xYz", "", None, " lead", "trail ", "İI Ünï ÀB", "a\u0130B K\u212a", "--", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", lexical.terms(F.col("text")).alias("t")).collect()
    assert [r.t for r in rows] == [terms(r.text) for r in rows]
