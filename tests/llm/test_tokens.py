"""Token counts and packing against the tokenizers library itself."""

import random
import zlib

import numpy as np
import pytest

from ledgerloom.llm import packing, token_counts
from ledgerloom.llm.encoding import byte_encoder, spaced_pieces, tokenizer

WORDS, BYTES, RANKS = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
PARTS = [" ", "  ", "\n", "\t", "b", "Abc", "'s", "'re", "\xa0", "　", "1", "é", "e", "́", "!", "<", "|", ">", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "Σ", "İ", "日", "x" * 7]


def random_texts(n, most=40):
    chosen = random.Random(5)
    return ["".join(chosen.choice(PARTS) for _ in range(chosen.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("chunk,overlap", [(5, 2), (16, 4), (40, 8), (65_536, 512)])
def test_counts_equal_the_library(chunk, overlap):
    texts = random_texts(1500)
    want = [len(tokenizer(WORDS).encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.counts(texts, WORDS, chunk, overlap) == want


def test_long_texts_are_spliced_or_widened():
    ran = random.Random(2)
    prose = " ".join("".join(ran.choice("abcdeé'1") for _ in range(ran.randint(1, 9))) for _ in range(30_000))
    for text in (prose, "a" * 70_000, "!" * 70_000, " " * 70_000, "é" * 66_000):
        assert token_counts.counts([text], WORDS) == [len(tokenizer(WORDS).encode(text, add_special_tokens=False).ids)]


def test_pieces_give_the_ids_of_whole_texts():
    encode = byte_encoder(RANKS, BYTES)
    for text in [*random_texts(4000), "a" * 3000, " " * 3000, " \n" * 900]:
        pieces = spaced_pieces(text)
        assert "".join(pieces) == text
        assert [i for p in pieces for i in encode(p)] == tokenizer(BYTES).encode(text, add_special_tokens=False).ids


def test_count_rows(spark, corpus, clash):
    docs = corpus([None, "", "Hello, World", "a " * 3000, "a " * 3000], ids=[None, 1, 2, 3, 3])
    rows = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(clash(docs)).collect()}
    assert rows == {(None, 0, 0, False), (1, 0, 0, False), (2, 12, 3, False), (3, 6000, 3000, True)}
    assert token_counts.token_counts(docs).count() == 5
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_packing_round_trip(spark, corpus, clash):
    texts = [None, "", "one two  three", "x" * 5000, "é 日本 <|endoftext|> z", *random_texts(60, 200), "same", "same"]
    docs = clash(corpus(texts, ids=[*range(len(texts) - 1), len(texts) - 2]))
    rows = packing.pack(docs, length=64).collect()
    want = {i: tokenizer(BYTES).encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4"))
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, pieces in by_sequence.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 64 or k == len(by_sequence) - 1
    assert packing.pack(docs.limit(0)).count() == 0
