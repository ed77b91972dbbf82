"""Operators 3 and 10 against the tokenizers library."""

import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelsync.llm import bpe, token_counts

BYTES, WORDS = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def encoded(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_counts_match_the_library(documents, edge):
    tokenizer = Tokenizer.from_file(BYTES)
    for docs in (documents.select("doc_id", "text"), edge):
        texts = {(r.doc_id, r.text) for r in docs.collect()}
        want = sorted((i is None, i or 0, len((t or "").encode()), len(tokenizer.encode(t or "").ids)) for i, t in texts)
        got = token_counts.count_tokens(docs, BYTES, limit=1024).collect()
        assert sorted({(r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got}) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
        assert len(got) == docs.count()


def test_counts_of_nothing_and_of_clashing_columns(empty, edge):
    assert token_counts.count_tokens(empty, BYTES).collect() == []
    clash = edge.withColumns({"n_tokens": F.lit("x"), "N_bytes": F.lit(1), "over_limit": F.lit(0)})
    got = token_counts.count_tokens(clash, BYTES, limit=5)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert got.count() == edge.count()


def test_counts_do_not_depend_on_the_frequent_table():
    full, bare = token_counts.Counting(BYTES, {" the": 1, "The": 1}), token_counts.Counting(BYTES, {})
    for text in ("The the  the\n the", " a\n\n b ", "x   y\t z w", "don't DON'T 123 ½"):
        assert full.count(text) == bare.count(text) == len(encoded(BYTES, text))


def test_random_texts_match_the_library():
    draw = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", " \n", "\t", "'s", "'LL", "the", "Zürich", "ſ", "K",
             "Σ", "ΑΣ ", "İ", "é", "漢字", "½", "1", "!?", "\x1c", "\x85", " ", "😀", "͸", "\U0001e6c0"]
    counting, coder = token_counts.Counting(BYTES, {}), bpe.WordBpe(WORDS)
    byte, word = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    for _ in range(3_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert counting.count(text) == len(byte.encode(text, add_special_tokens=False).ids), repr(text)
        ids = word.encode(text, add_special_tokens=False).ids
        assert coder.encode(text).tolist() == ids, repr(text)
        assert coder.decode(ids) == word.decode(ids, skip_special_tokens=False)


def test_long_words_merge_alike_on_both_paths():
    coder = bpe.WordBpe(WORDS)
    draw = random.Random(6)
    for n in (1, 2, 7, 40, 128, 129, 700):
        word = "".join(draw.choice("etaoinsh") for _ in range(n))
        parts = [coder.first[b] for b in word.encode()]
        parts[-1] = coder.last[word.encode()[-1]]
        assert coder._scan(list(parts)) == coder._heap(list(parts)) == encoded(WORDS, word)


def test_bounded_caches_do_not_change_ids():
    coder = bpe.WordBpe(WORDS)
    coder.run_ids.size = coder.word_ids.size = 3
    text = "one two three four five one two six seven one Two, three!"
    assert coder.encode(text).tolist() == coder.encode(text).tolist() == encoded(WORDS, text)


def test_encode_and_decode_tables(edge, empty):
    library = Tokenizer.from_file(WORDS)
    clash = edge.withColumns({"ids": F.lit(1), "N_TOKENS": F.lit("x")})
    for docs in (edge, clash):
        rows = bpe.decode(bpe.encode(docs, WORDS), WORDS).collect()
        fused = bpe.encode(docs, WORDS, decoded=True).collect()
        assert len(rows) == edge.count() and sorted(map(str, rows)) == sorted(map(str, fused))
        for r in rows:
            want = library.encode(r.text or "", add_special_tokens=False).ids
            assert (r.n_tokens, r.ids) == (len(want), want)
            assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(empty, WORDS), WORDS).collect() == []
