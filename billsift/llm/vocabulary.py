"""A SentencePiece vocabulary read from its file, and the merge rule of its BPE kind.

Only what the operators need is read: pieces with score and type, the kind of model,
and the two switches of the normaliser. Models that rewrite characters are refused.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

SPACE = "▁"
UNIGRAM, BPE = 1, 2
MAX_PAIRS = 1 << 16  # verdicts that a vocabulary remembers
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6  # fixed values of the file format


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and content of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Vocabulary:
    """Pieces, scores and kind of a model file's content."""

    def __init__(self, content: bytes):
        self.content = content
        self.pieces: list[str] = []
        self.scores: list[float] = []
        types: list[int] = []
        self.kind, name, self.dummy_prefix, squeeze = UNIGRAM, b"identity", True, True
        for number, value in _fields(content):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                types.append(piece.get(3, _NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                name, self.dummy_prefix, squeeze = spec.get(1, name), bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if name != b"identity" or squeeze or self.kind not in (UNIGRAM, BPE) or _USER in types:
            raise ValueError("only models that leave characters and white space as they are can be used")
        self.ids = {p: i for i, (p, kind) in enumerate(zip(self.pieces, types, strict=True)) if kind == _NORMAL}
        self.unknown = types.index(_UNKNOWN)
        self.control = {i for i, kind in enumerate(types) if kind in (_CONTROL, _UNKNOWN)}
        self.bytes = {int(p[3:5], 16): i for i, (p, kind) in enumerate(zip(self.pieces, types, strict=True)) if kind == _BYTE}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that go on after white space can't be used")
        self.longest = max(map(len, self.ids), default=1)
        self._pairs: dict[tuple[int, int], bool] = {}
        self._halves: dict[str, tuple[str, str] | None] = {}
        self._alone: dict[str, list[str]] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return cls(Path(path).read_bytes())

    def prepared(self, text: str) -> str:
        """The text as the model sees it, with a plain blank for white space."""
        text = text.replace(SPACE, " ")
        return " " + text if self.dummy_prefix and text else text

    @cached_property
    def unknown_score(self) -> float:
        """What an unknown character costs in a unigram model (10 below the worst piece)."""
        return min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0

    def n_unknown_tokens(self, character: str) -> int:
        return len(character.encode()) if self.bytes else 1

    def unknown_tokens(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode()] if self.bytes else [self.unknown]

    def merged(self, text: str) -> list[str]:
        """BPE: join the neighbours whose joint piece has the best score, leftmost first."""
        parts = list(text)
        while (place := self._next_merge(parts)) >= 0:
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def merged_piece(self, piece: str) -> list[str]:
        """What merges make of a piece's own characters; almost always the piece."""
        if piece not in self._alone:
            self._alone[piece] = self.merged(piece)
        return self._alone[piece]

    def _next_merge(self, parts: list[str]) -> int:
        best, place = None, -1
        for i in range(len(parts) - 1):
            joint = self.ids.get(parts[i] + parts[i + 1])
            if joint is not None and (best is None or self.scores[joint] > best):
                best, place = self.scores[joint], i
        return place

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes a piece; None for a character, or if merges stop before."""
        if piece not in self._halves:
            parts = list(piece)
            while len(parts) > 2 and (place := self._next_merge(parts)) >= 0:
                parts[place : place + 2] = [parts[place] + parts[place + 1]]
            self._halves[piece] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[piece]

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge across the seam comes before those that make the two pieces.

        Goes back through the merges on both sides of the seam, the later one first. A
        merge across is due before that if the joint piece has a better score; at equal
        scores the place further left comes first.
        """
        undone_left = undone_right = None  # scores of the merges undone last, by side
        while True:
            joint = self.ids.get(left + right)
            if joint is not None:
                score = self.scores[joint]
                if undone_left is None and undone_right is None:
                    return False
                if undone_left is not None and score > undone_left or undone_right is not None and score >= undone_right:
                    return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            left_score = self.scores[self.ids[left]] if a else None
            right_score = self.scores[self.ids[right]] if b else None
            # The merge that came later has the worse score; of equal ones the right one did.
            if b is None or a is not None and left_score < right_score:
                undone_left, undone_right, left = left_score, None, a[1]
            else:
                undone_left, undone_right, right = None, right_score, b[0]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the model can leave these two pieces side by side.

        A BPE result is one in which all neighbours pass this test, and each text
        has exactly one such result. In a unigram model all pieces may meet.
        """
        if self.kind == UNIGRAM or left < 0:
            return True
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs.clear()
            a, b = self.pieces[left], self.pieces[right]
            if SPACE in a and SPACE in b or len(self.merged_piece(a)) + len(self.merged_piece(b)) > 2:
                known = self.merged(a + b) == [a, b]
            else:
                known = self._stay_apart(a, b)
            self._pairs[left, right] = known
        return known


_LOADED: dict[int, Vocabulary] = {}


def vocabulary_of(content: bytes) -> Vocabulary:
    """The vocabulary of a file's content, parsed once per worker process."""
    key = hash(content)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(content)
    return _LOADED[key]
