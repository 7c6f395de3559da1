"""SentencePiece encoding and decoding by batched Viterbi.

The distinct words of a batch are sorted by length, and words of one length advance
together: at each position the hashes of the substrings that begin there are looked up
among the sorted hashes of the pieces and their beginnings, and vectorised maxima of the
path scores leave a backpointer per word and position. White space always begins a word (``vocabulary`` refuses models with
pieces that go on after it), so the best path of a text is that of its words.

For a unigram model the scores are its piece scores. A BPE model's result is the one path on
which all neighbours are pieces that its merges leave side by side, so there all other
steps count as impossible. Either way the ids are those of the SentencePiece library.
Characters without a piece become their bytes, or the unknown piece if the model has none.

Decoding joins the pieces, turns bytes into characters and drops the blank that encoding
puts in front. Nulls and empty texts have no pieces; a null is read back as an empty text.
A text that holds U+2581 itself is not read back as it was, since models use that
character for a blank. Texts are encoded whole. Repeated rows are encoded each; other
columns are kept unless named like the results.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from billsift.llm.texts import mix
from billsift.llm.vocabulary import BPE, SPACE, Vocabulary, vocabulary_of

MAX_WORDS = 1 << 19  # encodings of words that a worker remembers, beside those of the texts at hand
PAIR_BITS = 19
MANY_PAIRS = 256  # from here on pairs are tested together
SLOT_BITS = 18
ROWS = 1000  # texts encoded together
_WORDS = re.compile(" *[^ ]+| +")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNKNOWN = -2
_NOT_YET = -2


class Encoder:
    """Piece tables of a vocabulary, and the words that a worker has encoded."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.longest = vocabulary.longest
        names = list(vocabulary.ids)
        codes = np.zeros((len(names), self.longest), np.uint32)
        for row, name in enumerate(names):
            codes[row, : len(name)] = [ord(c) for c in name]
        sizes = np.array([len(n) for n in names], np.int64)
        heads, row, size = self._heads(codes, sizes)
        whole = size == sizes[row]
        order = np.lexsort((~whole, heads))  # a piece before longer ones that begin with it
        first = np.ones(len(order), bool)
        first[1:] = heads[order][1:] != heads[order][:-1]
        order = order[first]
        self.keys = np.append(heads[order], np.uint64(2**64 - 1))
        numbers = np.array([vocabulary.ids[n] for n in names], np.int64)[row[order]]
        self.number = np.append(np.where(whole[order], numbers, -1), -1)
        slots = np.arange(1 << SLOT_BITS, dtype=np.uint64) << np.uint64(64 - SLOT_BITS)
        self.slots = np.searchsorted(self.keys, slots).astype(np.int32)  # first key of each slot
        self.depth = int(np.diff(np.append(self.slots, len(self.keys) - 1)).max())
        self.codes = np.zeros((len(vocabulary.pieces), self.longest), np.uint32)
        self.codes[list(vocabulary.ids.values())] = codes
        self.sizes = (self.codes > 0).sum(1)
        self.hashes = self._prefixes(self.codes)[np.arange(len(self.codes)), self.sizes]
        self.powers = np.array([pow(int(_BASE), n, 1 << 64) for n in range(self.longest + 1)], np.uint64)
        self.blank = np.array([SPACE in p for p in vocabulary.pieces])
        self.halves = np.full((2, len(vocabulary.pieces)), _NOT_YET, np.int64)  # -1: none
        self.odd = np.zeros(len(vocabulary.pieces), bool)  # pieces whose merges need the strings
        self.scores = np.array(vocabulary.scores)
        self.text = [p.encode() for p in vocabulary.pieces]
        for byte, number in vocabulary.bytes.items():
            self.text[number] = bytes([byte])
        for number in vocabulary.control:
            self.text[number] = " ⁇ ".encode() if number == vocabulary.unknown else b""
        self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)  # verdicts on pairs, one pair in each slot
        self.verdicts = np.zeros(1 << PAIR_BITS, bool)
        self.words: dict[str, bytes] = {}

    def _prefixes(self, codes: np.ndarray) -> np.ndarray:
        """Hashes of the first 0, 1, 2 ... characters of each row."""
        sums = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        for i in range(codes.shape[1]):
            sums[:, i + 1] = sums[:, i] * _BASE + mix(codes[:, i].astype(np.uint64) + np.uint64(1))
        return sums

    def _heads(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each beginning of each piece, whose it is, and its length."""
        prefixes = self._prefixes(codes)
        row, size = np.nonzero(np.arange(1, self.longest + 1) <= sizes[:, None])
        return prefixes[row, size + 1] + (size + 1).astype(np.uint64), row, size + 1

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is among the sorted keys, or would be."""
        at = self.slots[(keys >> np.uint64(64 - SLOT_BITS)).view(np.int64)]
        for _ in range(self.depth):
            at += self.keys[at] < keys
        return at

    def _joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that is both pieces in a row, or -1."""
        n, m = self.sizes[left], self.sizes[right]
        joint = np.full(len(left), -1, np.int64)
        fits = np.flatnonzero(n + m <= self.longest)
        left, right, n, m = left[fits], right[fits], n[fits], m[fits]
        keys = self.hashes[left] * self.powers[m] + self.hashes[right] + (n + m).view(np.uint64)
        at = self._find(keys)
        hit = np.flatnonzero((self.keys[at] == keys) & (self.number[at] >= 0))
        codes, tails = self.codes[left[hit]], self.codes[right[hit]]
        row, col = np.nonzero(tails)
        codes[row, col + n[hit][row]] = tails[row, col]
        found = self.number[at[hit]]
        joint[fits[hit]] = np.where((self.codes[found] == codes).all(1), found, -1)
        return joint

    def _fill_halves(self, pieces: np.ndarray) -> None:
        """Halves of pieces and of their halves, as far as they are not known yet."""
        stack = pieces[self.halves[0, pieces] == _NOT_YET].tolist()
        known, ids = self.halves, self.vocabulary.ids
        while stack:
            piece = stack[-1]
            name = self.vocabulary.pieces[piece]
            halves = self.vocabulary.halves(name)
            inner = [ids.get(h) for h in halves or ()]
            later = [i for i in inner if i is not None and known[0, i] == _NOT_YET]
            if later:
                stack += later
                continue
            stack.pop()
            self.odd[piece] = None in inner or self.odd[[i for i in inner if i is not None]].any()
            self.odd[piece] |= len(self.vocabulary.merged_piece(name)) > 1
            known[:, piece] = inner if inner and None not in inner else -1

    def _neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``Vocabulary.neighbours`` of many pairs, its merges undone for all of them together."""
        result = np.ones(len(left), bool)
        self._fill_halves(np.unique(np.concatenate([left[left >= 0], right])))
        by_text = (left >= 0) & (self.blank[left] & self.blank[right] | self.odd[left] | self.odd[right])
        for i in np.flatnonzero(by_text).tolist():
            result[i] = self.vocabulary.neighbours(int(left[i]), int(right[i]))
        rest = np.flatnonzero((left >= 0) & ~by_text)
        left, right = left[rest], right[rest]
        undone_left = undone_right = np.full(len(rest), np.nan)  # scores of the merges undone last, by side
        while len(rest):
            joint = self._joint(left, right)
            score = np.where(joint >= 0, self.scores[joint], np.nan)
            first = np.isnan(undone_left) & np.isnan(undone_right) & (joint >= 0)
            across = first | (score > undone_left) | (score >= undone_right)
            result[rest[across]] = False
            no_left, no_right = self.halves[1, left] < 0, self.halves[0, right] < 0
            go = np.flatnonzero(~across & ~(no_left & no_right))
            rest, left, right, no_left, no_right = rest[go], left[go], right[go], no_left[go], no_right[go]
            # the merge that came later has the worse score; of equal ones the right one did
            on_left = no_right | ~no_left & (self.scores[left] < self.scores[right])
            undone_left = np.where(on_left, self.scores[left], np.nan)
            undone_right = np.where(on_left, np.nan, self.scores[right])
            left, right = np.where(on_left, self.halves[1, left], left), np.where(on_left, right, self.halves[0, right])
        return result

    def _may_meet(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pieces can be neighbours; tested once for each distinct pair."""
        if self.vocabulary.kind != BPE:
            return np.ones(len(left), bool)
        pairs = (left + 2) * len(self.text) + right
        slots = (mix(pairs.view(np.uint64)) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
        unknown = np.flatnonzero(self.pairs[slots] != pairs)
        if not len(unknown):
            return self.verdicts[slots]
        result = self.verdicts[slots]
        fresh, where = np.unique(pairs[unknown], return_inverse=True)
        left, right = fresh // len(self.text) - 2, fresh % len(self.text)
        if len(fresh) >= MANY_PAIRS:
            verdicts = self._neighbours(left, right)
        else:
            verdicts = np.array(list(map(self.vocabulary.neighbours, left.tolist(), right.tolist())), bool)
        result[unknown] = verdicts[where]
        self.pairs[slots[unknown]] = pairs[unknown]
        self.verdicts[slots] = result
        # where several of these pairs share a slot, no verdict is kept
        clash = np.flatnonzero(self.pairs[slots] != pairs)
        self.pairs[slots[clash]] = -1
        return result

    def _relax(self, best, back, length, row, piece, start: int, stop: int) -> None:
        """Let paths that end in these pieces be the best ones where they are better."""
        if not len(row):
            return
        known = piece >= 0
        allowed = best[start].take(row) > -np.inf
        allowed[known] &= self._may_meet(back[start].take(row[known]), piece[known])
        row, piece = row[allowed], piece[allowed]
        score = best[start].take(row) + np.where(piece >= 0, self.scores[piece], self.vocabulary.unknown_score)
        better = score > best[stop].take(row)
        row = row[better]
        best[stop][row], back[stop][row], length[stop][row] = score[better], piece[better], stop - start

    def _best_paths(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length, as packed 32-bit numbers."""
        size = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size)
        prefixes = np.ascontiguousarray(self._prefixes(codes).T)
        best = np.full((size + 1, len(words)), -np.inf)
        best[0] = 0
        back = np.full((size + 1, len(words)), _UNKNOWN, np.int64)  # the piece that ends here
        back[0] = -1
        length = np.ones((size + 1, len(words)), np.int64)
        every = np.arange(len(words))
        for start in range(size):
            row, single = every, np.zeros(len(words), bool)
            for stop in range(start + 1, min(size, start + self.longest) + 1):
                # which words have a piece, or the beginning of one, from start to stop
                power = np.uint64(pow(int(_BASE), stop - start, 1 << 64))
                keys = prefixes[stop].take(row) - prefixes[start].take(row) * power + np.uint64(stop - start)
                at = self._find(keys)
                hit = self.keys[at] == keys
                row, piece = row[hit], self.number[at[hit]]
                if not len(row):
                    break
                own, piece = row[piece >= 0], piece[piece >= 0]
                same = (self.codes[piece, : stop - start] == codes[own, start:stop]).all(1)
                own, piece = own[same], piece[same]
                if stop == start + 1:
                    single[own] = True
                self._relax(best, back, length, own, piece, start, stop)
            own = np.flatnonzero(~single)
            self._relax(best, back, length, own, np.full(len(own), _UNKNOWN), start, start + 1)
        return self._walks(words, back, length)

    def _walks(self, words: list[str], back: np.ndarray, length: np.ndarray) -> list[bytes]:
        """The pieces of each word, from its backpointers; all words step back together."""
        every = np.arange(len(words))
        row, at = every, np.full(len(words), len(words[0]))
        odd = np.zeros(len(words), bool)
        rows, steps = [], []
        while len(row):
            piece = back[at, row]
            odd[row[piece == _UNKNOWN]] = True
            rows.append(row)
            steps.append(piece)
            at = at - length[at, row]
            row, at = row[at > 0], at[at > 0]
        row, piece = np.concatenate(rows[::-1]), np.concatenate(steps[::-1]).astype(np.int32)
        order = np.argsort(row, kind="stable")
        edge = np.searchsorted(row[order], np.arange(len(words) + 1)) * 4
        packed = piece[order].tobytes()
        out = [packed[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._walk(words[i], back[:, i], length[:, i])
        return out

    def _walk(self, word: str, back: np.ndarray, length: np.ndarray) -> bytes:
        ids, at, unknown = [], len(word), False
        while at:
            piece, size = int(back[at]), int(length[at])
            if piece != _UNKNOWN:
                ids.append(piece)
            elif self.vocabulary.bytes or not unknown:  # neighbouring unknowns are one
                ids += self.vocabulary.unknown_tokens(word[at - 1])[::-1]
            unknown = piece == _UNKNOWN
            at -= size
        return array("i", ids[::-1]).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = [_WORDS.findall(self.vocabulary.prepared(t)) for t in texts]
        if len(self.words) > MAX_WORDS:  # the older half goes, before this batch's words are looked up
            for word in list(islice(self.words, len(self.words) - MAX_WORDS // 2)):
                del self.words[word]
        fresh: dict[int, list[str]] = {}
        for word in set().union(*split).difference(self.words):
            fresh.setdefault(len(word), []).append(word)
        for words in fresh.values():
            inner = [w.replace(" ", SPACE) for w in words]
            self.words.update(zip(words, self._best_paths(inner), strict=True))
        return [np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.text.__getitem__, ids.tolist())).decode(errors="replace").replace(SPACE, " ")
        return text[1:] if self.vocabulary.dummy_prefix and text.startswith(" ") else text


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(model: bytes) -> Encoder:
    """The worker's encoder of a model."""
    vocabulary = vocabulary_of(model)
    if id(vocabulary) not in _ENCODERS:
        _ENCODERS[id(vocabulary)] = Encoder(vocabulary)
    return _ENCODERS[id(vocabulary)]


def encode_documents(documents: DataFrame, model: bytes) -> DataFrame:
    """The documents with ``ids``, ``n_pieces`` and ``round_trip`` (ids decode to the text)."""
    names = [c for c in documents.columns if c not in ("ids", "n_pieces", "round_trip")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = encoder.encode(texts)
                sizes = np.array([len(i) for i in ids], np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))
                same = pa.array([encoder.decode(i) == t for i, t in zip(ids, texts, strict=True)], pa.bool_())
                columns = [part.column(c) for c in names] + [lists, pa.array(sizes, pa.int64()), same]
                yield pa.RecordBatch.from_arrays(columns, [*names, "ids", "n_pieces", "round_trip"])
        encoder.words.clear()  # a worker that goes on to other work keeps its tables only

    kept = documents.select(*names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, ids array<int>, n_pieces long, round_trip boolean")


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """``text`` from ``ids``; the other columns are kept. Null ids give an empty text."""
    names = [c for c in encoded.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in batches:
            texts = [encoder.decode(np.array(i or [], np.int32)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, "text"])

    fields = ", ".join(f"`{n}` {encoded.schema[n].dataType.simpleString()}" for n in names)
    return encoded.mapInArrow(run, f"{fields}, text string")


MODEL_PATH = public_tokenizers.path("piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(documents, Vocabulary.load(model_path).content).select("doc_id", "n_pieces", "round_trip", "ids")
