"""Cross-tokenizer alignment against whole texts encoded by the libraries."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerloom.llm import alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def grouped(text, libraries, enc):
    """Lists of (A ids, B ids), one for each group."""
    if not text:
        return []
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    if not b"".join(enc.a_bytes[i] for i in a) == (" " + text).encode() == b"".join(enc.b_bytes[i] for i in b):
        return []
    ends_a, ends_b = np.cumsum([len(enc.a_bytes[i]) for i in a]).tolist(), np.cumsum([len(enc.b_bytes[i]) for i in b]).tolist()
    found, common, i, j = [], sorted(set(ends_a) & set(ends_b)), 0, 0
    for end in common:
        k, m = bisect.bisect_right(ends_a, end), bisect.bisect_right(ends_b, end)
        found.append((a[i:k], b[j:m]))
        i, j = k, m
    return found


def brute(ids, texts, libraries):
    enc = alignment.encoders("byte_bpe_50k.json", "piece_bpe_32k.model")
    each = [grouped(t, libraries, enc) for t in texts]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in each]
    counts = Counter(p for own in links for p in set(own))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    rows = []
    for i, g, own in zip(ids, each, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own), sum(counts[p] == most[p[0]] for p in own),
                     sum(counts[p] for p in own), hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return rows


def some_texts(ran):
    marks = ["<|endoftext|>", "<s>", "<0x41>", "don't", "a\nb", " \n ", "\t", "  ", "   x", "日本語の文", "ça Ünï", "😀👩‍👩‍👧", "▁", " ", " ", "\x00", "\x1c ", "\u180e ", "12345", "=====", "aaaaaaaaaaaaaaaa", "é", "'ll", "\r\n"]
    plain = ["word", "another", "Sentence.", "with", "tokens,", "inside", "it"]
    texts = [None, "", " ", "  ", "\n", "a ", " a", "a  ", "   b", "▁", "x▁y"]
    for k in range(150):
        pool = plain + (marks if k % 2 else ["ü", "日本", "don't"])
        if k % 5:
            pool = [m for m in pool if m != "▁"]
        texts.append(ran.choice([" ", " ", "", "  "]).join(ran.choice(pool) for _ in range(ran.randint(1, 40))))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_alignment_against_the_libraries(spark, corpus, clash, libraries, monkeypatch, small):
    if small:  # diagonals, runs, slices and stretches inside documents
        for name, value in (("PIECE", 4), ("WORDS", 3), ("SLICE", 40), ("BLOCK", 16), ("STRETCH", 20), ("CROWDED", 3)):
            monkeypatch.setattr(alignment, name, value)
    texts = some_texts(random.Random(1))
    texts += texts[20:30]
    docs = clash(corpus(texts, ids=[5, *range(1, len(texts))])).repartition(3)
    got = sorted(map(tuple, alignment.aligned(docs).collect()))
    assert got == sorted(brute([5, *range(1, len(texts))], texts, libraries))
    assert sum(r[-1] == "" for r in got) > 4


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_pieces_of_the_merge_path(size):
    ran = np.random.default_rng(4)
    for _ in range(40):
        a, b = (np.unique(ran.integers(1, 120, ran.integers(1, 60))) for _ in range(2))
        a, b = np.append(a, 200), np.append(b, 200)
        common = np.intersect1d(a, b)
        group_a, group_b = alignment.groups(a, b, size)
        assert group_a.tolist() == np.searchsorted(common, a).tolist()
        assert group_b.tolist() == np.searchsorted(common, b).tolist()
        i, j = alignment.diagonals(a, b, size)
        assert set(np.diff(i + j)[:-1]) <= {size}


def test_empty_table_string_ids_and_long_texts(spark, corpus, libraries):
    assert alignment.aligned(corpus(["a"]).limit(0)).count() == 0
    long = "words in a very long text that ends, " * 3_000 + "x" * 5_000
    named = corpus([long, None, "a b"]).selectExpr("concat('k', doc_id) AS doc_id", "text")
    assert sorted(map(tuple, alignment.aligned(named).collect())) == brute(["k0", "k1", "k2"], [long, None, "a b"], libraries)
