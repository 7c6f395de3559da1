"""Token counts and SentencePiece ids against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from billsift.llm import pieces, registry, token_counts
from billsift.llm.vocabulary import UNIGRAM, Vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = (
    "a b e t h he in ing 1 2 é ß 日 本 語 🙂 <s> </s> <0x0A> 한 xxxxxxxxx the ation !! ... </ ́ = == -".split()
    + ["  ", "   ", " ", "\n", "\t", "\x00"]
)


def some_texts(n: int, seed: int = 1) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(25))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_counts_of_random_texts(vocabulary, library):
    counter = token_counts.Counter(vocabulary)
    texts = some_texts(4000)
    assert [counter.count(t) for t in texts] == [len(i) for i in library.encode(texts)]


@pytest.mark.parametrize("size", [1, 3, 8])
def test_state_maps_compose(vocabulary, library, size):
    """However a text is cut, and however its maps are grouped, the count is the same."""
    counter = token_counts.Counter(vocabulary)
    for text in some_texts(500, seed=size):
        prepared = vocabulary.prepared(text)
        maps = [counter.state_map(c) for c in token_counts.chunks(prepared, size)]
        assert "".join(token_counts.chunks(prepared, size)) == prepared
        if not maps:
            continue
        whole = counter.scan(maps)[-1]
        from_right = maps[-1]
        for one in maps[-2::-1]:
            from_right = counter.compose(one, from_right)
        assert whole == from_right
        assert whole.tokens + counter.transducer.read(whole.head)[0] == len(library.encode(text))


def test_tables_stay_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 20)
    counter = token_counts.Counter(vocabulary)
    for text in some_texts(300):
        assert counter.count(text) == len(library.encode(text))
        counter.trim()
        assert len(counter.transducer.live) <= 50 and len(counter.words) <= 20


def test_counts_of_a_table(spark, sf_dir, texts, library):
    rows = registry.QUERIES["op2_token_counts"](spark, sf_dir).collect()
    expected = {d: (len((t or "").encode()), len(library.encode(t or ""))) for d, t in texts.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == expected
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)


def test_ids_of_random_texts(vocabulary, library):
    encoder = pieces.Encoder(vocabulary)
    texts = some_texts(4000, seed=2)
    got = encoder.encode(texts)
    assert [g.tolist() for g in got] == library.encode(texts)
    assert [encoder.decode(g) for g in got] == [library.decode(g.tolist()) for g in got] == texts


def test_verdicts_of_many_pairs_equal_those_of_one(vocabulary):
    """Random pairs, and pairs that are cuts of a piece, whose joint piece is in the vocabulary."""
    encoder = pieces.Encoder(vocabulary)
    rnd = np.random.default_rng(5)
    ids = np.array(list(vocabulary.ids.values()))
    pairs = list(zip(rnd.choice(ids, 20000).tolist(), rnd.choice(ids, 20000).tolist(), strict=True))
    for name in rnd.choice(list(vocabulary.ids), 3000).tolist():
        cuts = [(vocabulary.ids.get(name[:i]), vocabulary.ids.get(name[i:])) for i in range(1, len(name))]
        pairs += [c for c in cuts if None not in c]
    pairs += [(-1, pairs[0][1]), (-2, pairs[1][1])]
    left, right = np.array(pairs, np.int64).T
    got = encoder._neighbours(left, right)
    assert got.tolist() == [vocabulary.neighbours(a, b) for a, b in pairs]
    assert 0 < got.sum() < len(got)


def test_words_of_the_older_half_are_dropped(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_WORDS", 8)
    encoder = pieces.Encoder(vocabulary)
    for i in range(30):
        texts = [f"w{i} v{i}"]
        assert [g.tolist() for g in encoder.encode(texts)] == library.encode(texts)
        assert len(encoder.words) <= 8 + 2
        assert i == 0 or f" v{i - 1}" in encoder.words


def test_unigram_paths_are_best(vocabulary):
    """Without merges the path has the best sum of scores, here by brute force."""
    vocabulary = Vocabulary(vocabulary.content)
    vocabulary.kind = UNIGRAM
    encoder = pieces.Encoder(vocabulary)

    def best(word: str) -> float:
        scores = [0.0] + [-np.inf] * len(word)
        for stop in range(1, len(word) + 1):
            for start in range(max(0, stop - vocabulary.longest), stop):
                piece = vocabulary.ids.get(word[start:stop])
                if piece is not None:
                    scores[stop] = max(scores[stop], scores[start] + vocabulary.scores[piece])
        return scores[-1]

    for word in ("the", "ation", "inhethe", "einging", "the1the2"):
        (ids,) = encoder.encode([word])
        assert sum(vocabulary.scores[i] for i in ids) == best("▁" + word)


def test_ids_of_a_table(spark, sf_dir, texts, library):
    rows = registry.QUERIES["op9_sentencepiece"](spark, sf_dir).collect()
    assert {r.doc_id: r.ids for r in rows} == {d: library.encode(t or "") for d, t in texts.items()}
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)


def test_hard_rows(hard, no_rows, vocabulary, library):
    model = vocabulary.content
    counted = token_counts.count_tokens(hard, model).collect()
    encoded = pieces.encode_documents(hard, model)
    rows = encoded.collect()
    for before, count, row in zip(hard.collect(), counted, rows, strict=True):
        text = before.text or ""
        assert (count.doc_id, count.n_bytes, count.n_tokens) == (before.doc_id, len(text.encode()), len(library.encode(text)))
        assert row.ids == library.encode(text) and row.lang == before.lang
        assert row.round_trip == ("▁" not in text)
    decoded = pieces.decode_documents(encoded, model).collect()
    assert [r.text for r in decoded] == [(r.text or "").replace("▁", " ") for r in rows]
    assert token_counts.count_tokens(no_rows, model).count() == pieces.encode_documents(no_rows, model).count() == 0


def test_other_models_are_refused():
    with pytest.raises((ValueError, KeyError, IndexError)):
        Vocabulary(b"")
