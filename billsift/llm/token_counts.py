"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

Reading a text from the left, a machine knows for each start of a piece that may
still grow: the place in the trie of pieces, the token before that start, and how many
tokens fewer there were. From this it finds the one piece that ends the encoding of
each longer prefix, so each transition has a fixed next state and a fixed change of
the token count. States are numbered as they are first met and their table is kept by
the worker, which is a deterministic transducer compiled on demand.

White space begins a new piece always, so it brings the machine into one and the same
state. A chunk of text is therefore a map of states in closed form: what is read from
the state before it (its head, up to the first white space), what it emits after that
whatever came before, and the state it ends in. Such maps are composed
associatively; the chunks of a long text are composed by a parallel prefix scan.

Nulls count as empty texts: no bytes, no tokens. Texts are read whole; a long one
is cut in chunks of ``CHUNK`` characters. Repeated rows are counted each. Only id and
text are read, and other columns are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from billsift.llm.vocabulary import SPACE, Vocabulary, vocabulary_of

TOKEN_LIMIT = 4096
CHUNK = 1 << 15
MAX_STATES = 1 << 18  # then the table is compiled anew
MAX_WORDS = 1 << 18  # words whose count a worker remembers

_ROOT = 0
_START = 0
_WORDS = re.compile(" +[^ ]*")


class Transducer:
    """States, transitions and emitted-token counts of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.children: list[dict[str, int]] = [{}]
        self.piece_at: list[int] = [-1]
        for piece, number in vocabulary.ids.items():
            node = _ROOT
            for character in piece:
                if character not in self.children[node]:
                    self.children[node][character] = len(self.children)
                    self.children.append({})
                    self.piece_at.append(-1)
                node = self.children[node][character]
            self.piece_at[node] = number
        self.reset()

    def reset(self) -> None:
        begin = ((_ROOT, -1, 0),)
        self.number = {begin: _START}
        self.live: list[tuple] = [begin]
        self.table: list[dict[str, tuple[int, int]]] = [{}]

    def compile(self, state: int, character: str) -> tuple[int, int]:
        """The transition of a state on a character: next state, tokens emitted."""
        vocabulary = self.vocabulary
        glyph = SPACE if character == " " else character
        if glyph not in vocabulary.ids:
            found = (_START, vocabulary.n_unknown_tokens(glyph))
        else:
            ends, emitted, grown = -1, 0, []
            for node, before, fewer in self.live[state]:
                below = self.children[node].get(glyph)
                if below is None:
                    continue
                piece = self.piece_at[below]
                if piece >= 0 and ends < 0 and vocabulary.neighbours(before, piece):
                    ends, emitted = piece, fewer + 1
                grown.append((below, before, fewer))
            if ends < 0:
                raise AssertionError("a known character always ends a piece")
            live = [(node, before, fewer - emitted) for node, before, fewer in grown if self.children[node]]
            key = (*live, (_ROOT, ends, 0))
            if key not in self.number:
                self.number[key] = len(self.live)
                self.live.append(key)
                self.table.append({})
            found = (self.number[key], emitted)
        self.table[state][character] = found
        return found

    def read(self, text: str, state: int = _START) -> tuple[int, int]:
        """Tokens emitted and state reached; ``text`` has white space only at its start."""
        total, table = 0, self.table
        for character in text:
            state, emitted = table[state].get(character) or self.compile(state, character)
            total += emitted
        return total, state


class WordCounts(dict):
    """Tokens of a word read from the start; filled by running the transducer."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        count, _ = self.transducer.read(word)
        self[word] = count
        return count


@dataclass
class StateMap:
    """What a chunk does to any state: read ``head``, then emit ``tokens``, end in ``exit``.

    ``exit`` is None in a chunk without white space: it is all head.
    """

    head: str
    tokens: int
    exit: int | None


class Counter:
    """Counts of texts with the tables of one worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.transducer = Transducer(vocabulary)
        self.words = WordCounts(self.transducer)

    def trim(self) -> None:
        """Keep the tables within their bounds; to be called between texts."""
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        if len(self.transducer.live) > MAX_STATES:
            self.transducer.reset()

    def state_map(self, chunk: str) -> StateMap:
        space = chunk.find(" ")
        if space < 0:
            return StateMap(chunk, 0, None)
        words = _WORDS.findall(chunk, space)
        last, exit_ = self.transducer.read(words.pop())
        return StateMap(chunk[:space], sum(map(self.words.__getitem__, words)) + last, exit_)

    def compose(self, left: StateMap, right: StateMap) -> StateMap:
        if left.exit is None:
            return StateMap(left.head + right.head, right.tokens, right.exit)
        # A blank at the seam belongs to the blanks before it: only then is a head read on.
        tokens, exit_ = self.transducer.read(right.head, left.exit)
        return StateMap(left.head, left.tokens + tokens + right.tokens, exit_ if right.exit is None else right.exit)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """All prefixes of a sequence of maps, in a logarithmic number of rounds."""
        step = 1
        while step < len(maps):
            maps = maps[:step] + [self.compose(maps[i - step], maps[i]) for i in range(step, len(maps))]
            step *= 2
        return maps

    def count(self, text: str) -> int:
        text = self.vocabulary.prepared(text)
        if not text:
            return 0
        if len(text) <= CHUNK:
            whole = self.state_map(text)
        else:
            whole = self.scan([self.state_map(c) for c in chunks(text)])[-1]
        return whole.tokens + self.transducer.read(whole.head)[0]


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Pieces of about ``size`` characters, none of which begins inside a run of blanks."""
    at = 0
    while at < len(text):
        stop = at + size
        while 0 < stop < len(text) and text[stop - 1] == " " == text[stop]:
            stop += 1
        yield text[at:stop]
        at = stop


_COUNTERS: dict[int, Counter] = {}


def counter_of(model: bytes) -> Counter:
    """The worker's counter of a model; its tables serve all tasks of the worker."""
    vocabulary = vocabulary_of(model)
    if id(vocabulary) not in _COUNTERS:
        _COUNTERS[id(vocabulary)] = Counter(vocabulary)
    return _COUNTERS[id(vocabulary)]


def count_tokens(documents: DataFrame, model: bytes, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per document: bytes, tokens of its whole text, and whether they exceed ``limit``.

    ``model`` is the content of a SentencePiece BPE file. One narrow pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            tokens = []
            for text in texts:
                tokens.append(counter.count(text.as_py()))
                counter.trim()
            n_tokens = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pc.binary_length(texts).cast(pa.int64()),
                    n_tokens,
                    pc.greater(n_tokens, limit),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def op2_token_counts(
    spark: SparkSession, sf_dir: str, model_path: str = public_tokenizers.path("piece_bpe_32k.model")
) -> DataFrame:
    vocabulary = Vocabulary.load(model_path)
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary.content)
