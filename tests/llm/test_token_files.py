"""Token files against the library and a plain concatenation of ids."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from billsift.llm import registry, token_files, word_codes
from billsift.llm.word_codes import WordCodes

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    """doc_id, start, n_tokens, crc for (doc_id, text) rows, by the library alone."""
    library = Tokenizer.from_file(PATH)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, start = [], 0
    for doc_id, text in ordered:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0] if text else [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def rows_of(frame):
    return sorted(
        [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frame.collect()],
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
    )


def test_word_codes_equal_the_library(texts):
    library = Tokenizer.from_file(PATH)
    codes = WordCodes(PATH)
    extra = ["a<|endoftext|>b", "<|endoftext|>", " x  y   \n\n z ", "日本語 🙂 é", "it's  they'll", "\t\t", "a" * 5000]
    for text in [*texts.values(), *extra]:
        assert list(codes.encode(text)) == library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert np.array_equal(token_files.from_planes(token_files.to_planes(ids, kind), n), ids)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_equal_brute_force_on_hard_rows(spark, hard, kind, tmp_path):
    # Small blocks and many parts: documents cross blocks, parts are empty.
    path = token_files.write_token_files(hard, str(tmp_path / kind), kind=kind, block_ids=64, part_bytes=1000)
    got = rows_of(token_files.read_token_index(spark, path))
    assert got == brute([(r.doc_id, r.text) for r in hard.collect()])


def test_empty_table(spark, no_rows, tmp_path):
    path = token_files.write_token_files(no_rows, str(tmp_path / "none"))
    assert token_files.read_token_index(spark, path).count() == 0


def test_ids_read_back_in_order(spark, hard, tmp_path):
    path = token_files.write_token_files(hard, str(tmp_path / "ids"), block_ids=50)
    blocks = sorted(spark.read.parquet(path).select("part", "block").collect())
    decoded = {(r.part, r.block): r.ids for r in token_files.read_ids(spark, path).collect()}
    stream = [i for key in blocks for i in decoded[key]]
    library = Tokenizer.from_file(PATH)
    ordered = sorted([(r.doc_id, r.text) for r in hard.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = [i for _, t in ordered for i in ((library.encode(t, add_special_tokens=False).ids if t else []) + [0])]
    assert stream == expected


def test_query_on_the_documents(spark, sf_dir):
    got = rows_of(registry.QUERIES["op13_token_files"](spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([(r.doc_id, r.text) for r in docs])


def test_word_memo_drops_old_words_and_stays_exact(monkeypatch):
    from billsift.llm import word_codes

    monkeypatch.setattr(word_codes, "MAX_WORDS", 8)
    codes = WordCodes(PATH)
    library = Tokenizer.from_file(PATH)
    texts = [" ".join(f"w{i}x{k}" for k in range(6)) for i in range(30)] + ["w0x1 w29x5 new words here again"]
    for text in texts * 2:
        assert list(codes.encode(text)) == library.encode(text, add_special_tokens=False).ids
        assert len(codes.memo) <= 8 + 6


ODD_TEXTS = [
    "it's they'll we've I'm you're he'd don't 's 'll\n's\t're", "it'sfoo 'sx ''s !'s a's's 'S x'", "'", "'s", "'r", "e 'v", "'ll", "l",
    "  two  three   four \n\n x \n y\n z  ", " ", "   ", " x", "x ", "x  ", "\t", "\r\n\r\n a", None, "", None,
    "\u00a0a \u00a0 b\u00a0\u00a0c \u2003\u2003d\u3000 e\u3000", "\u3000", " \u2028x\u0085y \u0085", "a\x1cb \x1d c\x1e\x1f d", "x\x0by \x0c z",
    "<|endoftext|>", "a<|endoftext|> b", "<|endoftext|><|endoftext|>x", "<|endoftext", "|>", "\x00", "a\x00 b",
    "日本語 🙂🙂 é e\u0301 ½² ٣٤ Ⅷ x²y ñandú", "é", "🙂", " 🙂", "naïve café's", "a" * 5000, "1" * 300, "$$$ ### a1b2 3c", "▁x ▁ y",
]


def column_equals_library(texts, codes=None):
    codes = codes or word_codes.ColumnCodes(WordCodes(PATH))
    library = Tokenizer.from_file(PATH)
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    ids, sizes = codes.encode(pa.array(texts, pa.string()))
    assert ids.dtype == np.uint32 and ids.tolist() == [i for t in expected for i in t]
    assert sizes.tolist() == list(map(len, expected))


def test_columns_equal_the_library(texts, monkeypatch):
    column_equals_library([*texts.values(), *ODD_TEXTS])
    column_equals_library([])
    column_equals_library([None, ""])
    monkeypatch.setattr(word_codes, "BATCH_BYTES", 40)
    column_equals_library(ODD_TEXTS)
    whole, (ids, sizes) = pa.array(["cut", *ODD_TEXTS], pa.large_string()), word_codes.column_codes(PATH).encode(pa.array(ODD_TEXTS))
    again = word_codes.column_codes(PATH).encode(whole.slice(1))
    assert np.array_equal(again[0], ids) and np.array_equal(again[1], sizes)


def test_columns_of_drawn_texts_equal_the_library():
    draw = random.Random(5)
    bits = [*" \n\t'", "  ", "s", "t", "re", "ll", "ve", "d", "S", "x", "é", "1", "²", "!", "$", "🙂", "日", "\u0301", "\u00a0", "\u2003", "\x85", "\x1c", "\x0b"]
    column_equals_library(["".join(draw.choices(bits, k=draw.randrange(12))) for _ in range(4000)])


def test_a_file_that_takes_other_words_goes_text_by_text(tmp_path):
    library = Tokenizer.from_file(PATH)
    library.add_tokens(["lo wo"])  # not special, and across words
    library.save(str(tmp_path / "more.json"))
    texts = ["hello world", None, "a b", ""]
    ids, sizes = word_codes.ColumnCodes(WordCodes(str(tmp_path / "more.json"))).encode(pa.array(texts))
    codes = WordCodes(str(tmp_path / "more.json"))
    assert ids.tolist() == [i for t in texts for i in codes.encode(t).tolist()]
    assert sizes.tolist() == [len(codes.encode(t)) for t in texts]


def test_packing_asks_the_library_once_for_each_word(monkeypatch):
    """Words in ever new company were new runs, and each text was looked up alone."""
    asked, single = [], []
    monkeypatch.setattr(WordCodes, "_new", lambda self, runs, f=WordCodes._new: single.extend(runs) or f(self, runs))
    monkeypatch.setattr(word_codes.ColumnCodes, "_new", lambda self, words, f=word_codes.ColumnCodes._new: asked.extend(words) or f(self, words))
    word_codes.word_codes.cache_clear()
    word_codes.column_codes.cache_clear()
    words, signs = [f"q{c}x" for c in "abcdefgh"], [",", ".", "!", ";", "$$", "##"]
    texts = [f" {w}{s}" for w in words for s in signs] * 3
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array([4] * len(texts), pa.int32())], ["doc_id", "text", "part"])
    blocks = [r for b in token_files._packer(PATH, "byte", 64)(iter([batch, batch])) for r in b.to_pylist()]
    library = Tokenizer.from_file(PATH)
    expected = [i for t in texts * 2 for i in [*library.encode(t).ids, 0]]
    assert [i for b in blocks for i in token_files.from_planes(b["planes"], b["n_ids"]).tolist()] == expected
    assert {b["part"] for b in blocks} == {4} and [i for b in blocks for i in b["doc_ids"]] == [*range(len(texts))] * 2
    assert sorted(asked) == sorted([f" {w}".encode() for w in words] + [s.encode() for s in signs])
    assert not single


def test_column_memo_is_bounded_and_stays_exact(monkeypatch):
    monkeypatch.setattr(word_codes, "MAX_WORDS", 16)
    codes = word_codes.ColumnCodes(WordCodes(PATH))
    for k in range(40):
        column_equals_library([f"common w{chr(97 + k % 26)}{chr(97 + k // 26)}q more", "b" * 100], codes)
        assert len(codes.newer) <= 8 + 3 and len(codes.older) <= 8 + 3
        assert b"common" in codes.newer or b"common" in codes.older
