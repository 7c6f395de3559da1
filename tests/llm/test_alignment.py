"""Cross-tokenizer alignment against a plain walk over both token streams."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from billsift.llm import alignment

A, B = public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE)


def walk(text):
    """(n_a, n_b, groups, links) by the libraries and a two-pointer walk, or None."""
    if not text:
        return None
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    a = library.encode(" " + text, add_special_tokens=False).ids
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    b = model.encode(text)
    a_bytes, (_, b_table) = alignment._a_bytes(A), alignment._b_model(B)
    whole = (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_table[i] for i in b) != whole:
        return None
    groups, links, i, j, ea, eb, ga, gb = [], [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        links.append((a[i], b[j]))
        na, nb = ea + len(a_bytes[a[i]]), eb + len(b_table[b[j]])
        if na <= nb:
            ga.append(a[i]); ea = na; i += 1
        if nb <= na:
            gb.append(b[j]); eb = nb; j += 1
        if ea == eb:
            groups.append((ga, gb)); ga, gb = [], []
    return len(a), len(b), groups, links


def brute(rows):
    walked = [(d, walk(t)) for d, t in rows]
    counts = Counter(p for _, w in walked if w for p in set(w[3]))
    highest = Counter()
    for (x, _), c in counts.items():
        highest[x] = max(highest[x], c)
    out = []
    for d, w in walked:
        if w is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = w
        digest = hashlib.sha256(alignment.groups_text(groups).encode()).hexdigest()
        best = sum(counts[p] == highest[p[0]] for p in links)
        out.append((d, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=repr)


def result(frame):
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in frame.collect()), key=repr)


def test_alignment_equals_walk_on_hard_rows(spark, hard):
    extra = spark.createDataFrame([(20, "<s> </s> <|endoftext|> ▁▁ x"), (21, "é" * 70000 + " tail"), (22, "�\U0001F642 a  b")],
                                  "doc_id long, text string")
    docs = hard.select("doc_id", "text").unionByName(extra)
    assert result(alignment.alignment(hard.unionByName(extra, allowMissingColumns=True))) == brute(
        [(r.doc_id, r.text) for r in docs.collect()])


def test_small_chunks_give_the_same_groups():
    text = "Hello wörld, 日本語 text with  spaces\nand lines " * 40
    whole = alignment.align(text, A, B)
    for chunk in (1, 3, 17, 1000):
        got = alignment.align(text, A, B, chunk=chunk)
        assert alignment.groups_text(got[2]) == alignment.groups_text(whole[2])


def _chunks(text, chunk):
    """Fragments of a text's chunks, each from the ids and ends of its own tokens only."""
    a, b, _, _ = alignment.align(text, A, B)
    (a_ends, b_ends), size = (t.ends(i) for t, i in zip(alignment._tables(A, B), (a, b))), len((" " + text).encode())
    for lo in range(0, size, chunk):
        hi = min(lo + chunk, size)
        mine = [(ids[(ends > lo) & (ends <= hi)], ends[(ends > lo) & (ends <= hi)]) for ids, ends in ((a, a_ends), (b, b_ends))]
        yield alignment.chunk_fragment(*mine[0], *mine[1], lo, hi)


def test_fragments_compose_from_prefix_groups_and_suffix():
    text = "Hello wörld, 日本語 text internationalization of electroencephalographically \U0001F642 " * 5
    whole = walk(text)[2]
    for chunk in (1, 2, 5, 64):
        fragments = list(_chunks(text, chunk))
        left = fragments[0]
        for fragment in fragments[1:]:
            closes = (*left.suffix, *fragment.prefix)
            joined = left + fragment
            if len(left.n_a) > 1 and len(fragment.n_a) > 1:  # suffix and prefix close into one group
                k = len(left.n_a) - 1
                assert joined.n_a[k] == len(closes[0]) + len(closes[2]) and joined.n_b[k] == len(closes[1]) + len(closes[3])
            left = joined
        right = fragments[-1]
        for fragment in fragments[-2::-1]:
            right = fragment + right
        for got in (left, right, alignment.reduce_tree(fragments)):
            assert alignment.groups_text(alignment.Groups(got)) == alignment.groups_text(whole)


def test_query_on_the_documents(spark, sf_dir):
    from billsift.llm import registry

    got = result(registry.QUERIES["op11_tokenizer_alignment"](spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([(r.doc_id, r.text) for r in docs])


def test_empty_table(spark, no_rows):
    assert alignment.alignment(no_rows).count() == 0
