"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from ledgerloom.llm import spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    forms, found = {}, []
    for w in words:
        best = sorted((-words[v], v) for v in words if near(w, v))
        forms[w] = (best[0][1] if best and -best[0][0] >= 2 * words[w] else None, len(best))
    for w, n in words.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        form = forms[w][0]
        found.append((w, form, root, n, forms[w][1], words[form] if form else None))
    return sorted(found)


def test_variants_against_brute_force(spark, corpus, clash):
    ran = random.Random(8)
    syllables = ["an", "ti", "on", "É", "ß", "re", "a", "x×", "AN"]
    words = ["".join(ran.choice(syllables) for _ in range(ran.randint(1, 4))) for _ in range(150)]
    edited = [w[:k] + ran.choice(["", "q", "a"]) + w[k + ran.randint(0, 1) :] for w in words for k in range(0, len(w), 2)]
    pool = words * 3 + edited
    texts = [None, "", "12 3", *[ran.choice([" ", "-", "7"]).join(ran.choice(pool) for _ in range(ran.randint(1, 80))) for _ in range(120)]]
    texts += ["anant " * 40 + "anantt " * 20 + "anantti " * 10 + "nantti " * 3] * 2
    docs = clash(corpus(texts, ids=[None, *range(1, len(texts))])).repartition(5)
    got = sorted((tuple(r) for r in spelling.variant_groups(docs).collect()))
    assert got == brute([(None, texts[0]), *enumerate(texts[1:], 1)])
    assert any(r[2] not in (r[0], r[1]) for r in got)  # a root beyond the form


def test_all_pairs_at_distance_one_are_found(spark):
    ran = random.Random(3)
    words = sorted({"".join(ran.choice("abcä") for _ in range(ran.randint(5, 8))) for _ in range(500)} | {"aaaaa", "aaaaaa", "aaaaaaa"})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {(r.word, r.other) for r in spelling.near_pairs(frame).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_empty_tables_and_long_texts(spark, corpus):
    assert spelling.variant_groups(corpus(["a"]).limit(0)).count() == 0
    assert spelling.variant_groups(corpus([None, "", "ab cd"])).count() == 0
    text = "letters lettres lettrs " * 100_000
    assert sorted(tuple(r) for r in spelling.variant_groups(corpus([text])).collect()) == brute([(0, text)])
