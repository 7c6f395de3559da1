"""Token ids of the tokenizers library for a byte-level BPE file, by remembered runs.

A byte-level BPE splits a text before any merge: first at its added special tokens,
then by the pre-tokenizer's pattern. No match of the pattern goes from a solid character
on to white space, and none that ends in white space looks beyond the next solid
character. So the ids of a text are the ids of its runs (white space and the solid
characters after it) one after the other, and a run is encoded by the library only the
first time a worker meets it; the new runs of a text go to the library as one text,
whose ids are cut by their bytes. Whole texts give the library's ids exactly (tests
compare them on all documents). The four ASCII separators, which not every regex library
counts as white space, keep a text in one run.

The memo drops its older half once it holds more than ``MAX_WORDS`` runs, before a
text is looked up, so it never holds more than that plus one text's runs. Runs longer
than ``MAX_RUN`` are not remembered.

Columns of texts (``ColumnCodes``) are cut into the pattern's words all together, by
numpy on their bytes, and each distinct word is looked up once per batch. What a word
is follows from the kinds of its characters (letter, number, space, other), which the
library's own pre-tokenizer is asked for once per character. New words go to the
library's BPE model. Texts that hold a special token go the way of single texts.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

MAX_WORDS = 1 << 19
MAX_RUN = 64
BATCH_BYTES = 4 << 20  # texts that are looked up together, or one longer text
RUNS = re.compile(r"\s*\S+|\s+")
SEPARATORS = "\x1c\x1d\x1e\x1f"


class WordCodes:
    """Ids of texts by a tokenizers JSON file of the byte-level kind."""

    def __init__(self, path: str, special_as_text: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # ``split`` takes them out of texts before
        spec = json.loads(open(path, encoding="utf-8").read())
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level files without normaliser or prefix space")
        specials = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.only_special = len(specials) == len(spec.get("added_tokens", []))
        self.usual_words = pre.get("use_regex", True)
        self.special_ids = {t: self.tokenizer.token_to_id(t) for t in specials}
        self.split = None
        if specials and not special_as_text:
            alternatives = "|".join(regex.escape(t) for t in sorted(specials, key=len, reverse=True))
            self.split = regex.compile(f"({alternatives})")
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each id: one per character
        self.lengths[list(vocab.values())] = list(map(len, vocab))
        self.memo: dict[str, bytes] = {}  # ids of runs, as bytes of uint32

    def _new(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of runs in the order of their text, by one call of the library."""
        ids = np.array(self.tokenizer.encode("".join(runs), add_special_tokens=False).ids, np.uint32)
        ends = np.cumsum(self.lengths[ids])
        bounds = np.cumsum([len(run.encode()) for run in runs])
        at = np.searchsorted(ends, bounds, side="right")
        if len(ids) != at[-1] or not np.array_equal(ends[at - 1], bounds):
            # A vocabulary without some bytes drops them, so bytes do not tell the runs apart.
            return {run: np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, np.uint32).tobytes() for run in runs}
        packed, at = ids.tobytes(), (at * ids.itemsize).tolist()
        return {run: packed[lo:hi] for run, lo, hi in zip(runs, [0, *at[:-1]], at, strict=True)}

    def _part(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        runs = [text] if any(c in text for c in SEPARATORS) else RUNS.findall(text)
        memo = self.memo
        found = list(map(memo.get, runs))
        if None in found:
            new = self._new(list(dict.fromkeys(run for run, ids in zip(runs, found, strict=True) if ids is None)))
            found = [new[run] if ids is None else ids for run, ids in zip(runs, found, strict=True)]
            memo.update((run, ids) for run, ids in new.items() if len(run) <= MAX_RUN)
        return b"".join(found)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text as uint32; a null text has none."""
        if not text:
            return np.zeros(0, np.uint32)
        if len(self.memo) > MAX_WORDS:  # drop the older half before this text's runs are looked up
            for run in list(self.memo)[: len(self.memo) // 2]:
                del self.memo[run]
        if self.split is None:
            return np.frombuffer(self._part(text), np.uint32)
        parts = self.split.split(text)
        ids = [np.uint32(self.special_ids[p]).tobytes() if k % 2 else self._part(p) for k, p in enumerate(parts)]
        return np.frombuffer(b"".join(ids), np.uint32)


_UNKNOWN, _LETTER, _NUMBER, _OTHER, _SPACE = range(5)
_BLANK, _QUOTE = b" '"
#: Endings that the pattern takes off a word, by their length without the quote.
_ENDINGS = {1: (b"s", b"t", b"m", b"d"), 2: (b"re", b"ve", b"ll")}


class Words:
    """Where the words of a byte-level file's pattern begin, in many texts at once."""

    def __init__(self, pre_tokenizer):
        self.pre_tokenizer = pre_tokenizer
        self.kinds = np.zeros(0x110000, np.uint8)
        self.bytes = np.zeros(256, np.uint8)
        self.bytes[:128] = self._kinds_of(np.arange(128))

    def _kind(self, character: str) -> int:
        """The kind of a character: it makes one word with another of its kind."""
        for kind, other in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")):
            if len(self.pre_tokenizer.pre_tokenize_str(other + character)) == 1:
                return kind
        return _SPACE

    def _kinds_of(self, characters: np.ndarray) -> np.ndarray:
        found = self.kinds[characters]
        if not found.all():
            for number in np.unique(characters[found == _UNKNOWN]).tolist():
                self.kinds[number] = self._kind(chr(number))
            found = self.kinds[characters]
        return found

    def _byte_kinds(self, data: np.ndarray) -> np.ndarray:
        """The kind of each byte's character."""
        kinds = self.bytes[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            head = data[lead]
            width = 2 + (head >= 0xE0) + (head >= 0xF0)
            characters = (head & (0x7F >> width)).astype(np.int32)
            for k in (1, 2, 3):
                on = width > k
                characters[on] = characters[on] << 6 | data[lead[on] + k] & 0x3F
            kinds[lead] = found = self._kinds_of(characters)
            for k in (1, 2, 3):
                on = width > k
                kinds[lead[on] + k] = found[on]
        return kinds

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Offsets at which words begin in the texts between ``offsets``, and the end."""
        size = len(data)
        kinds = self._byte_kinds(data)
        first = np.zeros(size + 4, bool)  # of a text
        first[offsets], first[size:] = True, True
        start = first.copy()
        start[1:size] |= kinds[1:] != kinds[:-1]
        # The last white space before a word is apart from the others; a blank belongs to the word.
        solid = np.flatnonzero(start[1:size] & ~first[1:size] & (kinds[:-1] == _SPACE)) + 1
        last = solid - 1
        start[solid] = data[last] != _BLANK
        for _ in range(3):
            last = last - (data[last] & 0xC0 == 0x80)
        start[last] = True
        quotes = np.flatnonzero(data == _QUOTE)
        quotes = quotes[start[quotes]]
        for length, endings in _ENDINGS.items():
            for ending in endings:
                at = quotes
                for k, byte in enumerate(ending, 1):
                    at = at[~first[at + k]]
                    at = at[data[at + k] == byte]
                start[at + 1] = False
                start[at + 1 + length] = True
        return np.flatnonzero(start[: size + 1])


def _byte_characters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    characters = np.zeros(256, "<u4")
    characters[printable] = printable
    characters[[b for b in range(256) if b not in printable]] = range(256, 512 - len(printable))
    return characters


class ColumnCodes:
    """Ids of columns of texts, by remembered words.

    Words are remembered in two halves of ``MAX_WORDS``: once the newer one is full, it
    takes the place of the older one. Words met again move to the newer half.
    """

    def __init__(self, codes: WordCodes):
        self.codes = codes
        self.words = Words(codes.tokenizer.pre_tokenizer)
        self.model = codes.tokenizer.model
        self.characters = _byte_characters()
        self.newer: dict[bytes, bytes] = {}  # ids of words, as bytes of uint32
        self.older: dict[bytes, bytes] = {}

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words by the library's model."""
        spelled = self.characters[np.frombuffer(b"".join(words), np.uint8)].tobytes().decode("utf-32-le")
        ends = np.cumsum([0, *map(len, words)]).tolist()
        ids = [[t.id for t in self.model.tokenize(spelled[lo:hi])] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        packed = np.array([i for word in ids for i in word], np.uint32).tobytes()
        at = (4 * np.cumsum([0, *map(len, ids)])).tolist()
        return {word: packed[lo:hi] for word, lo, hi in zip(words, at[:-1], at[1:], strict=True)}

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.newer) > MAX_WORDS // 2:
            self.newer, self.older = {}, self.newer
        found = list(map(self.newer.get, words))
        if None in found:
            missed = [word for word, ids in zip(words, found, strict=True) if ids is None]
            more = {word: self.older[word] for word in missed if word in self.older}
            more |= self._new([word for word in missed if word not in more])
            found = [more[word] if ids is None else ids for word, ids in zip(words, found, strict=True)]
            self.newer.update((word, ids) for word, ids in more.items() if len(word) <= MAX_RUN)
        return found

    def _together(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without nulls and special tokens, one after the other, and how many each has."""
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        if offsets[0] == offsets[-1]:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts = self.words.starts(data, offsets)
        words = pa.Array.from_buffers(
            pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)]
        ).dictionary_encode()
        found = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        pool = np.frombuffer(b"".join(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // pool.itemsize
        word = words.indices.to_numpy()
        n_ids = sizes[word]
        upto = np.concatenate([[0], np.cumsum(n_ids)])
        ids = pool[np.repeat((np.cumsum(sizes) - sizes)[word] - upto[:-1], n_ids) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.searchsorted(starts, offsets)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts as uint32, one text after the other, and how many each has; null texts have none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.codes.only_special or not self.codes.usual_words:
            apart = np.ones(len(texts), bool)
        else:
            apart = np.zeros(len(texts), bool)
            for special in self.codes.special_ids if self.codes.split else ():
                apart |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        alone = [self.codes.encode(text) for text in texts.filter(pa.array(apart)).to_pylist()]
        texts = pc.if_else(pa.array(apart), "", texts) if alone else texts
        upto = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)])
        parts, sizes, at = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            end = max(int(np.searchsorted(upto, upto[at] + BATCH_BYTES, side="right")) - 1, at + 1)
            ids, n_ids = self._together(texts.slice(at, end - at))
            parts.append(ids)
            sizes.append(n_ids)
            at = end
        ids, n_ids = np.concatenate(parts), np.concatenate(sizes)
        if alone:
            before = (np.cumsum(n_ids) - n_ids)[apart]
            ids = np.insert(ids, np.repeat(before, list(map(len, alone))), np.concatenate(alone))
            n_ids[apart] = list(map(len, alone))
        return ids, n_ids


@cache
def word_codes(path: str, special_as_text: bool = False) -> WordCodes:
    """One encoder per worker process and file."""
    return WordCodes(path, special_as_text)


@cache
def column_codes(path: str) -> ColumnCodes:
    """One encoder of columns per worker process and file."""
    return ColumnCodes(word_codes(path))
