"""Ranked lexical search: exact top-k by block summaries over clustered posting lists.

Scoring (BM25 in integers): terms are maximal runs of ASCII letters and digits and of
all other non-ASCII characters, A-Z lower-cased. N counts documents with a term, L all
their terms, n one document's terms, df a term's documents, tf its occurrences in one
document. w = floor(1000 ln((2N+2)/(2df+1))); m = 25 + (75 n N) div L; a posting's
impact is w * ((10^9 tf) div (1000 tf + 8 m)), and a document's score for a query is the
sum of the impacts of the query's terms, repeats included.

Method (per-term geometric blocking):

1. Documents are clustered by similarity: sorted by their min-hash term (the term of
   smallest hash; similar documents share it with the probability of their Jaccard
   overlap), then doc_id, and cut into runs of ``CLUSTER_DOCS`` (range partitions, so
   a large family of copies is spread over many tasks and clusters).
2. Each query term's posting list is cut by cluster into blocks; a block's summary is
   the coordinatewise maximum of its documents' impact vectors, stored per term, so a
   cluster's summary over all terms is the union of its entries in all lists.
3. Each query first scores exactly the ``SEED_DOCS`` documents of highest impact in
   each of its terms' lists; the k-th best of those scores (or 1 if fewer are
   positive) is a threshold that no true top-k score is below.
4. Terms whose summed peak impacts stay below the threshold cannot lift a document to
   it on their own, so only clusters in the lists of the other (essential) terms are
   candidates. A cluster's bound is the sum of q * summary over all the query's
   terms; no document of the cluster scores above it.
5. Clusters whose bound is below the threshold are skipped: their postings are dropped
   where they are read. All documents of the others are scored exactly, and the k best
   (ties by ascending doc_id) are returned.

Every step is a join or an aggregate of DataFrames; nothing goes through the driver
but N and L. What two later steps read (impacts, seeds, summaries, passing clusters) is
written once: a plan that is counted and then joined would read all postings twice.

Null texts have no terms; rows without doc_id are not documents. Rows of one doc_id
form one document (their terms are added up). Empty tables give no rows. Only doc_id,
text, item_id and text are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billsift.llm.tables import kept, small

TOP_K = 10
CLUSTER_DOCS = 16
SEED_DOCS = 10
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits
_ROW_MASK = (1 << _ROW_BITS) - 1

# Fixed values of the contract: term pattern and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K1_PER_MILLE, B_PERCENT = 800, 75


def _pieces(text: Column) -> Column:
    """The terms of a text, in order, repeats kept, with an empty piece where a separator begins or ends it.

    The maximal runs of the term class are the pieces between runs of its complement;
    splitting is several times faster than extracting the matches one by one. In a text
    of ASCII characters alone ``lower`` changes A-Z only, and is faster than ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.split(folded, SEPARATOR)


def terms(text: Column) -> Column:
    """The terms of a text, in order, repeats kept; none for null."""
    return F.filter(_pieces(text), lambda t: t != "")


def _postings(docs: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Postings (term, doc_id, tf) of query terms, documents (doc_id, n, cluster), N and L.

    One read and one split of the texts: every term occurrence is looked up in the
    (broadcast) query vocabulary; occurrences of other terms fall into one group per
    document, which still gives the document's length and min-hash. The grouped rows
    are written once, as postings and length both come from them.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.explode(_pieces(F.col("text"))).alias("raw")
    ).withColumn("raw", F.nullif("raw", F.lit("")))
    asked = small(vocabulary.select(F.col("term").alias("raw"), F.lit(True).alias("_asked")))
    marked = rows.join(asked, "raw", "left")
    grouped = kept(
        marked.groupBy("doc_id", F.when(F.col("_asked"), F.col("raw")).alias("term")).agg(
            F.count("raw").alias("tf"), F.min(F.when(F.col("raw").isNotNull(), F.xxhash64("raw"))).alias("minhash")
        ),
        "lexical-grouped",
    )
    per_doc = grouped.groupBy("doc_id").agg(F.sum("tf").alias("n"), F.min("minhash").alias("minhash")).where(F.col("n") > 0)
    # Runs of CLUSTER_DOCS within range partitions of (minhash, doc_id); written once,
    # as a second evaluation could sample other range bounds.
    row = F.monotonically_increasing_id()
    run = F.shiftleft(F.shiftright(row, _ROW_BITS), _ROW_BITS) + F.floor(row.bitwiseAND(F.lit(_ROW_MASK)) / CLUSTER_DOCS)
    documents = kept(
        per_doc.repartitionByRange("minhash", "doc_id").sortWithinPartitions("minhash", "doc_id")
        .select("doc_id", "n", run.cast("long").alias("cluster")),
        "lexical-docs",
    )
    totals = documents.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    n_docs, length = int(totals["N"]), int(totals["L"] or 0)
    postings = grouped.where(F.col("term").isNotNull()).select("term", "doc_id", "tf")
    return postings, documents, n_docs, length


def _impacts(postings: DataFrame, documents: DataFrame, n_docs: int, length: int) -> DataFrame:
    """term, doc_id, cluster, impact (> 0 only)."""
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    weights = kept(df.select("term", weight.alias("w")), "lexical-weights")
    m = f"({100 - B_PERCENT} + ({B_PERCENT} * n * {n_docs}L) div {max(length, 1)}L)"
    part = F.expr(f"(1000000000L * tf) div (1000L * tf + {K1_PER_MILLE // 100}L * {m})")
    impacts = (
        postings.join(small(weights), "term")
        .join(documents.hint("shuffle_hash"), "doc_id")
        .select("term", "doc_id", "cluster", (F.col("w") * part).alias("impact"))
        .where(F.col("impact") > 0)
    )
    return kept(impacts, "lexical-impacts")


def _scores(queries: DataFrame, impacts: DataFrame, keep: DataFrame, on: list[str]) -> DataFrame:
    """Exact scores of (item_id, doc_id) pairs whose ``on`` columns are in ``keep`` (distinct, written).

    Postings meet their queries and the kept keys in the task that reads them (both
    small sides are sent to all tasks after a count), so a skipped block's postings are
    dropped before any shuffle, and only partial sums per (item, document) move.
    """
    hits = impacts.join(small(queries), "term").join(small(keep), on, "left_semi")
    return hits.groupBy("item_id", "doc_id").agg(F.sum(F.col("q") * F.col("impact")).alias("score"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return scores.where(F.col("score") > 0).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: the k best documents of each item."""
    queries = kept(
        items.select("item_id", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("item_id", "term")
        .agg(F.count(F.lit(1)).cast("long").alias("q")),
        "lexical-queries",
    )
    vocabulary = queries.select("term").distinct()
    postings, documents, n_docs, length = _postings(docs, vocabulary)
    impacts = _impacts(postings, documents, n_docs, length)

    by_impact = Window.partitionBy("term").orderBy(F.col("impact").desc(), F.col("doc_id"))
    tops = impacts.withColumn("_r", F.row_number().over(by_impact)).where(F.col("_r") <= SEED_DOCS)
    seeds = kept(queries.join(tops.select("term", "doc_id"), "term").select("item_id", "doc_id").distinct(), "lexical-seeds")
    # Other documents' postings go before each is multiplied by the items that ask for its term.
    seeded = impacts.join(small(seeds.select("doc_id").distinct()), "doc_id", "left_semi")
    thresholds = _best(_scores(queries, seeded, seeds, ["item_id", "doc_id"]), k).groupBy("item_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(1)).alias("threshold")
    )

    summaries = kept(impacts.groupBy("term", "cluster").agg(F.max("impact").alias("summary")), "lexical-summaries")
    peaks = summaries.groupBy("term").agg(F.max("summary").alias("peak"))
    upward = Window.partitionBy("item_id").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weighted = (
        queries.join(peaks, "term")
        .withColumn("most", F.col("q") * F.col("peak"))
        .withColumn("upto", F.sum("most").over(upward))
        .join(thresholds, "item_id", "left")
        .withColumn("threshold", F.coalesce(F.col("threshold"), F.lit(1)))
    )
    essential = kept(
        weighted.select("item_id", "term", "q", "threshold", (F.col("upto") >= F.col("threshold")).alias("essential")),
        "lexical-essential",
    )
    bounds = (
        summaries.join(small(essential), "term")
        .groupBy("item_id", "cluster", "threshold")
        .agg(F.sum(F.col("q") * F.col("summary")).alias("bound"), F.max("essential").alias("essential"))
        .where(F.col("essential") & (F.col("bound") >= F.col("threshold")))
    )
    passing = kept(bounds.select("item_id", "cluster"), "lexical-passing")
    best = _best(_scores(queries, impacts, passing, ["item_id", "cluster"]), k)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", F.col("score").cast("long").alias("score"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of all documents for every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search(docs, items)
