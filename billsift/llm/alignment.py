"""Cross-tokenizer alignment: groups and links between the tokens of two vocabularies.

A (tokenizers, byte-level BPE) encodes " " + text; B (sentencepiece) encodes text and
adds the space itself. Both are read as byte ranges of the same string. A byte offset
where an A token and a B token both end cuts the two streams into groups; an A-B pair
of token occurrences whose byte ranges overlap is a link.

Method (associative fragment monoid): the byte range is cut into chunks of
``CHUNK_BYTES``. A chunk yields a fragment: its open prefix (tokens up to its first
cut), its closed groups, and its open suffix (tokens after its last cut), or one open
run if no cut falls in it. Two fragments compose associatively (the suffix of the
left and the prefix of the right close into one group), so the fragments of a long
document are reduced as a balanced tree, never as one quadratic pass. The groups, their
text and the links are read from the one fragment that is left; a chunk sees no token
beyond its own. Links are the elementary segments between the union of both streams'
token ends, each lying in exactly one A and one B token.

Corpus statistics are Spark aggregates: each document's distinct linked id pairs are
counted over all documents (partial aggregation before the shuffle), each A id's
highest count taken, and the counts joined back to the documents' pairs.

Texts that are null, empty, or whose joined A or B token bytes differ from " " + text
have no tokens: all numbers are 0 and groups_sha256 is ''. Strings of special tokens
inside texts are plain text. Each row is a document, repeated rows too. Only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billsift.llm.tables import kept, small
from billsift.llm.word_codes import word_codes

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 16
PAIR_BITS = 20  # a pair of ids packs into a*2^20 + b

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, repeats array<long>"


@cache
def _a_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = printable + [256 + k for k in range(256 - len(printable))]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(c): b for c, b in zip(chars, printable + others, strict=True)}
    codes = word_codes(path, True)
    vocab = codes.tokenizer.get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocab.values()) + 1)
    for token, number in vocab.items():
        table[number] = token.encode() if number in codes.special_ids.values() else bytes(byte_of[c] for c in token)
    return table


class ByteTable:
    """Token bytes of a vocabulary as one buffer, offsets and lengths, for numpy gathers."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.buffer = np.frombuffer(b"".join(pieces), np.uint8)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.lengths[ids])

    def spells(self, ids: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> bool:
        """Whether the tokens' bytes, joined, are exactly ``whole``."""
        total = int(ends[-1]) if len(ends) else 0
        if total != len(whole):
            return False
        if not total:
            return True
        starts = ends - self.lengths[ids]
        gather = np.repeat(self.offsets[ids] - starts, self.lengths[ids]) + np.arange(total)
        return bool(np.array_equal(self.buffer[gather], whole))


@cache
def _tables(a_path: str, b_path: str) -> tuple[ByteTable, ByteTable]:
    return ByteTable(_a_bytes(a_path)), ByteTable(_b_model(b_path)[1])


@cache
def _b_model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            table.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(number) or model.is_unknown(number):
            table.append(b"")
        else:
            table.append(piece.replace("▁", " ").encode())
    return model, table


class Fragment:
    """Tokens of a byte range, read as: open prefix, closed groups, open suffix.

    ``a`` and ``b`` are the ids of the range's tokens, ``n_a`` and ``n_b`` how many of
    them each segment has. A range with k cuts has k + 1 segments: the first is the open
    prefix, the last the open suffix, those between are closed groups. Without a cut
    there is one segment, an open run.
    """

    __slots__ = ("a", "b", "n_a", "n_b")

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b

    @property
    def prefix(self) -> tuple[np.ndarray, np.ndarray]:
        return self.a[: self.n_a[0]], self.b[: self.n_b[0]]

    @property
    def suffix(self) -> tuple[np.ndarray, np.ndarray]:
        return self.a[len(self.a) - self.n_a[-1] :], self.b[len(self.b) - self.n_b[-1] :]

    def __add__(self, right: Fragment) -> Fragment:
        """The left suffix and the right prefix become one segment: a closed group if
        both sides have a cut, else a longer prefix, suffix or open run."""
        seam = lambda x, y: np.concatenate([x[:-1], [x[-1] + y[0]], y[1:]])
        return Fragment(
            np.concatenate([self.a, right.a]), np.concatenate([self.b, right.b]),
            seam(self.n_a, right.n_a), seam(self.n_b, right.n_b),
        )


def _segments(ends: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many tokens end up to the first cut, between cuts, and after the last."""
    upto = np.empty(len(cuts) + 2, np.int64)
    upto[0], upto[-1] = 0, len(ends)
    upto[1:-1] = ends.searchsorted(cuts, side="right")
    return upto[1:] - upto[:-1]


def chunk_fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, lo: int, hi: int) -> Fragment:
    """The fragment of the range (lo, hi] from the tokens that end in it, and their ends."""
    is_a, is_b = np.zeros(hi - lo + 1, bool), np.zeros(hi - lo + 1, bool)
    is_a[a_ends - lo] = True
    is_b[b_ends - lo] = True
    cuts = np.flatnonzero(is_a & is_b) + lo
    return Fragment(a, b, _segments(a_ends, cuts), _segments(b_ends, cuts))


def reduce_tree(fragments: list[Fragment]) -> Fragment:
    while len(fragments) > 1:
        fragments = [fragments[k] + fragments[k + 1] if k + 1 < len(fragments) else fragments[k]
                     for k in range(0, len(fragments), 2)]
    return fragments[0]


COMMA, BAR, END = range(3)


@cache
def _words(size: int) -> list[bytes]:
    """Decimal ids below ``size`` with each separator behind them: id + size * separator."""
    return [b"%d%s" % (number, sep) for sep in (b",", b"|", b";") for number in range(size)]


class Groups:
    """The groups of a whole text, from its fragment.

    A whole text starts and ends at a cut, so its prefix is the first group and its
    suffix is empty.
    """

    def __init__(self, fragment: Fragment):
        if fragment.n_a[-1] or fragment.n_b[-1]:
            raise ValueError("tokens after the last cut of a whole text")
        self.a, self.b, self.n_a, self.n_b = fragment.a, fragment.b, fragment.n_a[:-1], fragment.n_b[:-1]

    def __len__(self) -> int:
        return len(self.n_a)

    def text(self, size: int = 1 << 16) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: decimal ids, A before B in each group, groups in order."""
        a_upto, b_upto = np.cumsum(self.n_a), np.cumsum(self.n_b)
        a_at = np.arange(len(self.a)) + np.repeat(b_upto - self.n_b, self.n_a)
        b_at = np.arange(len(self.b)) + np.repeat(a_upto, self.n_b)
        words = np.empty(len(self.a) + len(self.b), np.int64)
        words[a_at], words[b_at] = self.a, self.b
        words[a_upto + b_upto - self.n_b - 1] += BAR * size
        words[a_upto + b_upto - 1] += END * size
        return b"".join(map(_words(size).__getitem__, words.tolist()))[:-1]

    def links(self, a_table: ByteTable, b_table: ByteTable) -> np.ndarray:
        """Linked id pairs, packed, one per elementary segment."""
        a_ends, b_ends = a_table.ends(self.a), b_table.ends(self.b)
        is_end = np.zeros(a_ends[-1] + 1, bool)
        is_end[a_ends] = is_end[b_ends] = True
        segments = np.flatnonzero(is_end)
        return (self.a[np.searchsorted(a_ends, segments)] << PAIR_BITS) | self.b[np.searchsorted(b_ends, segments)]


def align(text: str | None, a_path: str, b_path: str, chunk: int = CHUNK_BYTES):
    """(a_ids, b_ids, groups, link pairs) of one text, or None if it has no tokens."""
    if not text:
        return None
    spaced = " " + text
    whole = np.frombuffer(spaced.encode(), np.uint8)
    a_table, b_table = _tables(a_path, b_path)
    a_ids = word_codes(a_path, True).encode(spaced).astype(np.int64)
    b_ids = np.array(_b_model(b_path)[0].encode(text), np.int64)
    a_ends, b_ends = a_table.ends(a_ids), b_table.ends(b_ids)
    if not a_table.spells(a_ids, a_ends, whole) or not b_table.spells(b_ids, b_ends, whole):
        return None
    bounds = np.append(np.arange(0, len(whole), chunk), len(whole))
    a_at, b_at = (np.searchsorted(ends, bounds, side="right") for ends in (a_ends, b_ends))
    fragments = [
        chunk_fragment(a_ids[a0:a1], a_ends[a0:a1], b_ids[b0:b1], b_ends[b0:b1], lo, hi)
        for lo, hi, a0, a1, b0, b1 in zip(
            *(x.tolist() for x in (bounds[:-1], bounds[1:], a_at[:-1], a_at[1:], b_at[:-1], b_at[1:])), strict=True)
    ]
    groups = Groups(reduce_tree(fragments))
    return groups.a, groups.b, groups, groups.links(a_table, b_table)


def groups_text(groups) -> str:
    """The groups' text, from ``Groups`` or from a list of (A ids, B ids) pairs."""
    if isinstance(groups, Groups):
        return groups.text().decode()
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """A column of lists of long."""
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int64), *arrays]))


def _aligner(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            sizes, digests, pairs, repeats = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = align(text, a_path, b_path)
                if found is None:
                    sizes.append((0, 0, 0))
                    digests.append("")
                    pairs.append(nothing)
                    repeats.append(nothing)
                    continue
                a_ids, b_ids, groups, links = found
                distinct, times = np.unique(links, return_counts=True)
                sizes.append((len(a_ids), len(b_ids), len(groups)))
                digests.append(hashlib.sha256(groups.text()).hexdigest())
                pairs.append(distinct)
                repeats.append(times)
            counts = np.array(sizes, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *(pa.array(counts[:, k].copy()) for k in range(3)),
                 pa.array(digests, pa.string()), _lists(pairs), _lists(repeats)],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "repeats"],
            )

    return run


def alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    a_path = a_path or public_tokenizers.path(A_FILE)
    b_path = b_path or public_tokenizers.path(B_FILE)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    aligned = kept(rows.mapInArrow(_aligner(a_path, b_path), ALIGNED), "alignment-docs")
    held = aligned.select("row", F.posexplode("pairs").alias("k", "pair"), "repeats").select(
        "row", "pair", F.col("repeats")[F.col("k")].alias("repeat")
    )
    counts = held.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    a_id = F.shiftright(F.col("pair"), PAIR_BITS)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("highest"))
    counted = kept(
        counts.withColumn("a", a_id).join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best")),
        "alignment-counts",
    )
    per_row = held.join(small(counted), "pair").groupBy("row").agg(
        F.sum("repeat").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("repeat")).otherwise(0)).alias("n_best"),
        F.sum(F.col("repeat") * F.col("docs")).alias("count_sum"),
    )
    return aligned.join(per_row, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256",
    )


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the two vocabularies on every document."""
    return alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"))
