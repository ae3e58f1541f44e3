"""Parity-sketch join against all pairs."""

import random

import numpy as np
import pytest

from ledgerloom.llm import near_copies, parity
from ledgerloom.sources.sinks import written


def shingle_set(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, min(len(words), 1)))}


def brute(ids, texts, least=90):
    sets = [shingle_set(t) for t in texts]
    low = list(ids)
    while True:
        new = [min([low[i]] + [low[j] for j, b in enumerate(sets) if a and b and 100 * len(a & b) >= least * len(a | b)]) for i, a in enumerate(sets)]
        if new == low:
            return sorted((i, len(s), c) for i, s, c in zip(ids, sets, low))
        low = new


def near_texts(ran):
    """Texts of all sizes with copies that lose, gain or change words around the limit."""
    texts = [None, "", " \t", "A", "a", "a b", "A B c", "a b c", "a b c d"]
    for size in (3, 9, 12, 20, 40, 95, 200):
        for _ in range(4):
            base = [f"w{ran.randint(0, 400)}" for _ in range(size)]
            texts.append(" ".join(base))
            for share in (0.02, 0.04, 0.08, 0.1, 0.12):
                cut = base[: round(size * (1 - share))]
                texts += [" ".join(cut), " ".join(base + [f"x{ran.random()}" for _ in range(round(size * share))])]
                changed = [w if ran.random() > share / 3 else "y" for w in base]
                texts.append("  ".join(changed).upper())
    return texts


@pytest.mark.parametrize("shard", [1024, 3])
def test_join_against_all_pairs(spark, corpus, clash, monkeypatch, shard):
    monkeypatch.setattr(parity, "SHARD", shard)
    monkeypatch.setattr(parity, "MEETINGS", 2 if shard == 3 else 256)
    texts = near_texts(random.Random(5))
    texts += texts[10:40]
    ids = random.Random(6).sample(range(1000), len(texts))
    got = sorted(tuple(r) for r in parity.joined(clash(corpus(texts, ids=ids)).repartition(7)).collect())
    assert got == brute(ids, texts)
    assert len({c for *_, c in got}) < len(texts) - 60


def test_links_that_miss_the_head(spark, corpus):
    """Near pairs whose keys' heads are unlike both of them are found by the later passes."""
    ran = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(30):
        own = list(base)
        for i in ran.sample(range(200), 6):
            own[i] = f"v{k}.{i}"
        texts.append(" ".join(own))
        own[ran.randrange(200)] = f"u{k}"
        texts.append(" ".join(own))
    got = sorted(tuple(r) for r in parity.joined(corpus(texts)).collect())
    assert got == brute(range(len(texts)), texts)


def test_sketch_distance_never_exceeds_the_difference():
    ran = np.random.default_rng(2)
    for n in (1, 5, 30, 400):
        one = np.unique(ran.integers(0, 1 << 63, n, dtype=np.uint64))
        for gone in {0, 1, n // 10}:
            two = np.unique(np.concatenate((one[gone:], ran.integers(0, 1 << 63, gone, dtype=np.uint64))))
            apart = len(np.setxor1d(one, two))
            a, b = parity.folded([parity.compact(one, n), parity.compact(two, 4 * n)])
            assert int(np.bitwise_count(a ^ b).sum()) <= apart
            a, b = parity.folded([parity.screened(parity.compact(one, 4 * n)), parity.compact(two, 3 * n)])
            assert a.nbytes <= parity.SCREEN and int(np.bitwise_count(a ^ b).sum()) <= apart
            for spare in (0, 1, 5):
                keys = [set(parity.piece_keys(x, 3, apart + 1 + spare, spare).tolist()) for x in (one, two)]
                assert keys[0] & keys[1]


def test_size_bands_hold_all_partners():
    bands = parity.Bands(90)
    for n in range(1, 3000):
        band = bands.of(n)
        most = n * 100 // 90
        assert bands.bounds[band] <= n < bands.bounds[band + 1] and bands.of(most) <= band + 1
        pieces, spare = bands.pieces(band)
        assert parity.differing(n, most, 90) < pieces - spare
        for m in range(n, most + 1):
            assert bands.of(m) == band or bands.reaches_down(m, bands.of(m))


def test_edges_of_the_table(spark, corpus, clash):
    assert parity.joined(clash(corpus(["a b"]).limit(0))).count() == 0
    rows = corpus([None, "", "long " * 300_000, "long " * 200_000, "one two"], ids=[4, 4, 9, 7, None])
    assert sorted(parity.joined(rows).collect(), key=str) == sorted([(4, 0, 4), (4, 0, 4), (9, 1, 7), (7, 1, 7), (None, 1, None)], key=str)
    named = corpus(["a b c d", "a b c d", "e"]).selectExpr("concat('k', doc_id) AS doc_id", "text")
    assert sorted(map(tuple, parity.joined(named).collect())) == [("k0", 2, "k0"), ("k1", 2, "k0"), ("k2", 1, "k2")]


def test_keys_of_two_rows_are_not_looked_at_again(spark):
    """Their pair is the head's, which was compared before; a third row may be like the second."""
    sketch = bytearray(b"\x01" * 64)
    rows = spark.createDataFrame([(1, 5, 5, True), (1, 6, 6, True), (2, 5, 5, True), (2, 7, 7, True), (2, 8, 8, False)], "key long, node long, root long, is_left boolean")
    sketches = spark.createDataFrame([(n, 9, sketch) for n in range(5, 9)], "node long, n long, sketch binary")
    assert sorted(map(tuple, parity.open_pairs(rows, 90, False, sketches).collect())) == [(5, 7), (5, 8), (7, 8)]
    assert parity.open_pairs(rows.filter("key = 1"), 90, False, sketches).count() == 0


def test_later_passes_see_only_what_a_forest_left_out(spark):
    sketch = bytearray(b"\x01" * 64)
    rows = spark.createDataFrame([(1, 5, 5, True), (1, 6, 6, True), (1, 7, 7, True), (2, 5, 5, True), (2, 9, 9, True), (2, 10, 10, True)], "key long, node long, root long, is_left boolean")
    sketches = spark.createDataFrame([(n, 9 if n < 9 else 900, sketch) for n in range(5, 11)], "node long, n long, sketch binary")
    assert [r.key for r in parity.met(rows, 90, True, sketches).filter("u IS NULL").collect()] == [1]  # key 2 has one near pair, which is told
    assert parity.met(rows, 90, False, sketches).filter("u IS NULL").count() == 0


def test_texts_and_shards_are_not_written_again(spark, corpus, monkeypatch):
    tables = []

    def recorded(df):
        tables.append(written(df))
        return tables[-1]

    for module in (parity, near_copies):
        monkeypatch.setattr(module, "written", recorded)
    texts = near_texts(random.Random(7))
    assert 0 < near_copies.without_near_copies(corpus(texts)).count() < len(texts)
    assert sum("blob" in t.columns or "text" in t.columns for t in tables) == 1
    assert all(t.count() == 0 for t in tables if "own" in t.columns)


def test_keys_of_the_same_rows_are_one(spark, corpus, monkeypatch):
    """Copies of one text share many keys, of which one is looked at; keys travel in few bytes."""
    tables = []
    monkeypatch.setattr(parity, "written", lambda df: tables.append(written(df)) or tables[-1])
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base + [f"x{k}"] * 3) for k in range(6)] + [" ".join(f"v{k}.{i}" for i in range(300)) for k in range(3)]
    got = sorted(tuple(r) for r in parity.joined(corpus(texts)).collect())
    assert got == brute(range(len(texts)), texts)
    keyed = next(t for t in tables if {"key", "head"} <= set(t.columns) and "alike" not in t.columns)
    sets = keyed.groupBy("key").agg({"node": "collect_set"}).collect()
    assert sets and len({frozenset(r[1]) for r in sets}) == len(sets)
    table = next(t for t in tables if "lefts" in t.columns)
    assert all(len(r.lefts) % parity.KEY_BYTES == 0 for r in table.select("lefts").collect())


def test_shared_keys_of_both_sides(spark, monkeypatch):
    """Every key of several rows with a left one, whatever the blocks; against a plain count."""
    ran = random.Random(3)
    sides = [[[ran.randrange(40) << 33 for _ in range(ran.randrange(4))] for _ in range(2)] for _ in range(60)]
    blob = lambda keys: parity.packed(np.array(sorted(set(keys)), np.int64)) if keys else None
    rows = spark.createDataFrame([((k % 3 << 36) + k // 3, blob(a), blob(b)) for k, (a, b) in enumerate(sides)], "node long, lefts binary, rights binary")
    held = {}
    for k, (a, b) in enumerate(sides):
        for left, keys in ((True, a), (False, b)):
            for key in set(keys):
                held.setdefault(key, set()).add(((k % 3 << 36) + k // 3, left))
    want = {frozenset(v) for v in held.values() if len(v) > 1 and any(left for _, left in v)}
    for size in (1 << 20, 8):
        monkeypatch.setattr(parity, "KEYS_AT_ONCE", size)
        got = {}
        for r in parity.shared_keys(rows.repartition(3)).collect():
            got.setdefault(r.key, set()).add((r.node, r.is_left))
            assert r["size"] > 1
        assert {frozenset(v) for v in got.values()} == want and len(got) == len(want)
    first = rows.filter("node % 2 = 0").select("node")
    assert sorted(r.node for r in parity.picked(rows, first).collect()) == sorted(r.node for r in first.collect())
    assert parity.picked(rows, first.limit(0)).count() == 0
