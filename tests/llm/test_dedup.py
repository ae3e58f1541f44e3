"""Suffix-array, De Bruijn and SimHash dedup against brute force."""

import hashlib
import random
from collections import Counter

import pytest
import xxhash

from ledgerloom.llm import debruijn, near_copies, parity, repeats, simhash, suffix_dedup
from ledgerloom.llm.components import components


def spliced(alphabet, make, join, seed=3):
    ran = random.Random(seed)
    draw = lambda n: [ran.choice(alphabet) for _ in range(n)]
    passage, base = draw(50), [draw(ran.randint(0, 160)) for _ in range(40)]
    texts = [None, "", join(["a"] * 90), join(["a", "b"] * 40), *map(join, base)]
    for _ in range(80):
        x, y = ran.choice(base), ran.choice(base)
        texts.append(join(x[: ran.randint(0, len(x))] + ran.choice([[], passage, make]) + y[ran.randint(0, len(y)) :]))
    return texts + [join(passage)] * 4


def brute(texts, split, glue, length, keep_first=False):
    whole = [split((t or "").encode()) for t in texts]
    starts = [[tuple(b[i : i + length]) for i in range(len(b) - length + 1)] for b in whole]
    counts, seen, found = Counter(w for s in starts for w in s), set(), []
    for b, s in zip(whole, starts):
        gone = [False] * len(b)
        for i, w in enumerate(s):
            if (w in seen) if keep_first else counts[w] > 1:
                gone[i : i + length] = [True] * length
            seen.add(w)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((len(b), sum(gone), runs, hashlib.sha256(glue([x for x, g in zip(b, gone) if not g])).hexdigest()))
    return found


@pytest.mark.parametrize("crowd", [4096, 1])
@pytest.mark.parametrize("keep_first", [False, True])
def test_suffix_arrays(spark, corpus, clash, monkeypatch, crowd, keep_first):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    texts = spliced("abcdefgh ", ["é"] * 5, "".join)
    docs = clash(corpus(texts)).coalesce(1)
    got = [tuple(r)[1:] for r in sorted(suffix_dedup.removals(docs, length=20, gram=6, keep_first=keep_first).collect())]
    assert got == brute(texts, list, bytes, 20, keep_first)


def test_longest_previous_factors():
    import numpy as np

    text = np.frombuffer(b"banana bandana banana", np.uint8)
    for length in (1, 3, 6, 13):
        entries = np.arange(len(text) - length + 1)
        before, after = suffix_dedup.factors(suffix_dedup.prefix_ranks(text, length)[entries], entries)
        strings = [text[i : i + length].tobytes() for i in entries]
        assert before.tolist() == [s in strings[:i] for i, s in enumerate(strings)]
        assert after.tolist() == [s in strings[i + 1 :] for i, s in enumerate(strings)]


def test_texts_without_repeats_keep_whole_characters(spark, corpus, clash):
    passage = "äöüß" * 20
    docs = clash(corpus(["x" + passage + "y", "z" + passage + "w", passage, None, "", "short"]))
    rows = {r.doc_id: r for r in suffix_dedup.deduplicated(docs.coalesce(1), length=30, gram=10).collect()}
    assert rows[0].text == "x" + passage[: len(rows[0].text) - 2] + "y"
    assert rows[1].text == "zw" and rows[1].n_chars == 2
    assert 2 not in rows and rows[3].text is None and rows[4].text == "" and rows[5].text == "short"
    assert suffix_dedup.deduplicated(docs).columns == docs.columns
    assert suffix_dedup.deduplicated(docs.limit(0)).count() == 0
    assert suffix_dedup.removals(docs.limit(0)).count() == 0


def test_debruijn(spark, corpus, clash):
    texts = spliced("abcdefgh", ["é"] * 5, "  ".join)
    got = [tuple(r)[1:] for r in sorted(debruijn.removals(clash(corpus(texts)), length=8, gram=3).collect())]
    assert got == [(n, gone, sha) for n, gone, _, sha in brute(texts, lambda b: b.split(), b" ".join, 8)]
    assert debruijn.removals(corpus(texts).limit(0)).count() == 0


def test_debruijn_compacts_paths(spark, corpus):
    words = [f"w{i}" for i in range(400)]
    table = repeats.stored(corpus([" ".join(words), " ".join(["x", *words]), "other " * 3]))
    found = debruijn.written(debruijn.repeated_edges(table, 10, 4))
    spans = debruijn.spans(found).collect()
    assert found.count() > 40 and len(spans) < 8
    assert sum(r.windows for r in spans) == 2 * (400 - 10 + 1)


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_components(spark, corpus, clash):
    ran = random.Random(4)
    base = [" ".join(ran.choice(["Aa", "b", "C", "dé"]) for _ in range(ran.randint(0, 5))) for _ in range(250)]
    texts = [None, "", " \t", *base, *base[:20]]
    docs = clash(corpus(texts))
    prints = [brute_fingerprint(t) for t in texts]
    low = list(range(len(texts)))
    while True:
        new = [min(low[j] for j in range(len(texts)) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(len(texts))]
        if new == low:
            break
        low = new
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(i, f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, low))}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shard", [4096, 8])
def test_bk_tree_links(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    ran = random.Random(6)
    centres = [ran.getrandbits(64) for _ in range(6)]
    values = {c ^ sum(1 << b for b in ran.sample(range(64), ran.randint(0, 4))) for c in centres for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    roots = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), 2)).collect()
    root = {v: v for v in signed} | {r.node: r.root for r in roots}
    for a in signed:
        for b in signed:
            if (a ^ b).bit_count() <= 2 or ((a ^ b) % (1 << 64)).bit_count() <= 2:
                assert root[a] == root[b]
    assert len(set(root.values())) > 1


def test_near_copies_leave_one(spark, corpus, clash):
    ran = random.Random(8)
    words = [f"w{ran.randint(0, 5000)}" for _ in range(300)]
    near = list(words)
    near[100] = near[200] = "changed"
    far = [w if i % 6 else "changed" for i, w in enumerate(words)]
    clean = [" ".join(f"w{ran.randint(0, 5000)}" for _ in range(300)) for _ in range(20)]
    docs = clash(corpus([" ".join(near), " ".join(words), " ".join(words).upper(), " ".join(far), None, "", *clean], ids=[7, 5, 6, 8, 9, 10, *range(20, 40)]))
    kept = near_copies.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 8, 9, *range(20, 40)]
    assert near_copies.without_near_copies(docs.limit(0)).count() == 0


def similarity(a, b, words):
    one, two = set(simhash.shingles(a, words)), set(simhash.shingles(b, words))
    return len(one & two) / len(one | two) if one or two else 1.0


def firsts_of_groups(texts, least=0.8):
    """Least index of each group of near copies, all pairs compared."""
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and similarity(texts[i], texts[j], 5) >= least:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return sorted(set(root))


def test_appended_cut_and_short_copies_are_linked(spark, corpus):
    ran = random.Random(21)
    prose = lambda n: [f"w{ran.randint(0, 50000)}" for _ in range(n)]
    line = prose(12)
    texts = []
    for n in (10, 12, 20, 60, 200, 400):
        for _ in range(6):
            words = prose(n)
            block = max(1, n // 20)
            texts += [words, words + prose(max(1, n // 10)), words + prose(n // 5), words[: n - n // 6], words[: n // 2] + prose(block) + words[n // 2 + block :], line + words]
    texts = [" ".join(x) for x in texts] + ["a a a a a", "a a a a a a", "a a", "a a a"]
    got = sorted(r.doc_id for r in near_copies.without_near_copies(corpus(texts)).select("doc_id").collect())
    assert got == firsts_of_groups(texts)


def test_copies_meet_beside_an_unlike_head_of_equal_words(spark, corpus):
    ran = random.Random(22)
    words = [f"w{i}" for i in range(200)]
    mixed = lambda: " ".join(ran.sample(words, len(words)))
    head, one, other = mixed(), mixed().split(), mixed().split()
    swapped = lambda x, i: " ".join([*x[:i], x[i + 1], x[i], *x[i + 2 :]])
    texts = [head, " ".join(one), swapped(one, 50), swapped(one, 150), " ".join(other), swapped(other, 90), mixed()]
    got = sorted(r.doc_id for r in near_copies.without_near_copies(corpus(texts)).select("doc_id").collect())
    assert got == firsts_of_groups(texts) == [0, 1, 4, 6]


def test_a_forest_of_a_group_has_few_pairs(spark):
    """Copies of one key that nothing linked yet are as many pairs as they need, not their square; with ``forest`` off all pairs are left."""
    sketch = bytes(8)
    rows = [(key, node, True, node, 100, sketch) for key in range(2) for node in range(60)]
    frame = spark.createDataFrame(rows, "key long, node long, is_left boolean, root long, n long, sketch binary")
    assert parity.open_pairs(frame, 90, True).distinct().count() == 59
    assert parity.open_pairs(frame, 90, False).distinct().count() == 60 * 59 // 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (102, 101)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(61)} | {(i, 100) for i in (100, 101, 102)}
