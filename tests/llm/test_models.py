"""Mixing, fingerprints, scoring, classification and search: brute force, closed forms, held-out accuracy."""

import hashlib
import itertools
import math
import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import imatch, mixing, neighbours, pseudo_likelihood, toxicity


# --- mixing ---------------------------------------------------------------------------------------


def test_flow_is_largest_with_fewest_repeats():
    ran = random.Random(1)
    for _ in range(150):
        sources = [f"s{i}" for i in range(ran.randint(1, 4))]
        patterns = {tuple(sorted(ran.sample(sources, ran.randint(1, len(sources))))): ran.randint(0, 20) for _ in range(ran.randint(1, 6))}
        quota = {s: Fraction(ran.randint(0, 30)) for s in sources}

        def largest(uses):
            cuts = (c for r in range(len(sources) + 1) for c in itertools.combinations(sources, r))
            return min(sum(quota[s] for s in cut) + sum(uses * w for p, w in patterns.items() if not set(p) <= set(cut)) for cut in cuts)

        for uses in (1, 2, 3):
            flow = mixing.route(patterns, quota, uses)
            assert sum(flow.values()) == largest(uses)
            assert all(0 <= f <= uses * patterns[p] for p, f in flow.items())
        flow = mixing.route(patterns, quota, 3)
        assert sum(min(f, patterns[p]) for p, f in flow.items()) >= largest(1)


def test_targets_are_capped_and_reshared():
    assert mixing.targets({"a": 10, "b": 1, None: 5}) == {"b": 3, "a": Fraction(13, 4), None: Fraction(39, 4)}
    assert mixing.targets({"a": 0, "b": 0}) == {"a": 0, "b": 0}


def test_mix_comes_near_its_targets(spark, corpus, clash):
    ran = random.Random(2)
    sources = [ran.choice(["a", "b", "c", None, "hot", "hot", "hot"]) for _ in range(600)]
    texts = [None, "", *[" ".join(["w"] * ran.randint(1, 30)) for _ in sources[2:]]]
    docs = clash(corpus(texts, sources=sources))
    rows = mixing.mix(docs).collect()
    assert len(rows) == 600 and sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    for source in set(sources):
        own = [r for r in rows if sources[r.doc_id] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 31
        assert all(r.taken == r.copies * r.size <= 3 * r.size for r in own)
    taken = {r.doc_id: r.copies for r in rows}
    got = mixing.mixed_rows(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == {i: n for i, n in taken.items() if n}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_overlapping_members(spark, corpus):
    docs = corpus(["w " * 10] * 30, sources=["a"] * 10 + ["b"] * 10 + ["ab"] * 10)
    members = F.when(docs.source == "ab", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))
    rows = mixing.mix(docs, members, weights=(1, 3)).collect()
    assert sum(r.taken for r in rows) == 400  # each source counts what both have, as its target does


# --- fingerprints -----------------------------------------------------------------------------------


def test_imatch_follows_the_order(spark, corpus, clash):
    ran = random.Random(3)
    texts = [None, "", "x", *[" ".join(f"w{int(ran.paretovariate(0.4))}" for _ in range(ran.randint(1, 60))) for _ in range(120)]]
    texts += texts[5:9]
    ids = [*range(0, 2 * len(texts) - 2, 2), None]
    docs = clash(corpus(texts, ids=ids))
    for each in (7, 4000):
        got = {r.doc_id: r for r in imatch.fingerprints(docs, rows_each=each).collect()}
        order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
        assert len(got) == len(texts)
        prints = {}
        for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
            text, r = text or "", got[doc]
            cut = len(text) // 3
            changed = text[: len(text) - cut] + (following or "")[:cut]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            prints.setdefault(text, set()).add(r.fingerprint)
            if changed == text:
                assert r.near_edited == 1 and r.edited_fingerprint == r.fingerprint
        assert all(len(p) == 1 for p in prints.values())
    single = imatch.fingerprints(corpus(["alone again"])).collect()
    assert len(single) == 1 and single[0].near_next == 1
    assert imatch.fingerprints(docs.limit(0)).count() == 0


def test_imatch_lexicon_is_the_band(spark, corpus):
    docs = corpus([f"all some{i % 20} one{i}" for i in range(200)])
    assert imatch.lexicon(docs, (math.log(10), math.log(25))) == sorted(f"some{i}" for i in range(20))


def test_likeness_falls_with_edits():
    words = [f"w{i}" for i in range(200)]
    own = imatch.Lexicons(words)
    whole, small, large = (own.fingerprint(" ".join(words[n:])) for n in (0, 4, 100))
    assert imatch.likeness(whole, whole) == 1 > imatch.likeness(whole, small) > imatch.likeness(whole, large)


# --- language model ---------------------------------------------------------------------------------


def test_probabilities_sum_to_one_and_gradient_descends():
    params = pseudo_likelihood.shaped(pseudo_likelihood.flat(pseudo_likelihood.start()))
    context = np.tile(np.array([[3, 1024, 7, 0]], np.int32), (1024, 1))
    assert abs(np.exp(pseudo_likelihood.log_probabilities(params, context, np.arange(1024))).sum() - 1) < 1e-4
    ran = np.random.default_rng(0)
    center = ran.integers(0, 40, 3000).astype(np.int32)
    context = np.stack([center, center, (center + 1) % 40, center], 1).astype(np.int32)
    squares = [np.full_like(x, 1e-4) for x in params]
    before = pseudo_likelihood.log_probabilities(params, context, center).mean()
    for _ in range(30):
        pseudo_likelihood.step(params, squares, context, center)
    assert pseudo_likelihood.log_probabilities(params, context, center).mean() > before + 2


def test_likely_texts_score_higher(spark, corpus, clash):
    ran = random.Random(5)
    follow = {f"w{i}": f"w{(i * 7 + 3) % 60}" for i in range(60)}

    def chain(n):
        word, out = ran.choice(list(follow)), []
        for _ in range(n):
            out.append(word)
            word = follow[word]
        return " ".join(out)

    mixed = lambda n: " ".join(ran.choice(list(follow)) for _ in range(n))
    docs = clash(corpus([None, "", *[chain(80) for _ in range(300)], *[mixed(80) for _ in range(20)], "never seen"]))
    fitted = pseudo_likelihood.fit(docs)
    rows = {r.doc_id: r for r in pseudo_likelihood.score(docs, fitted).collect()}
    assert rows[0].n_tokens == rows[1].n_tokens == 0 and rows[0].log_prob == 0 and rows[0].mean_log_prob is None
    ordered, shuffled = (np.mean([rows[i].mean_log_prob for i in r]) for r in (range(2, 302), range(302, 322)))
    assert ordered > shuffled + 0.3
    assert rows[5].log_prob == np.float64(rows[5].mean_log_prob) * rows[5].n_tokens or abs(rows[5].log_prob / rows[5].n_tokens - rows[5].mean_log_prob) < 1e-9
    empty = docs.limit(0)
    assert pseudo_likelihood.score(empty, pseudo_likelihood.fit(empty)).count() == 0


# --- toxicity ----------------------------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark, corpus, clash):
    ran = random.Random(7)
    plain, bad = [f"word{i}" for i in range(300)], ["vile", "awful", "rotten"]
    toxic = [int(ran.random() < 0.3) for _ in range(900)]
    texts = [" ".join(ran.choice(plain) for _ in range(ran.randint(5, 60))) + (" " + ran.choice(bad).upper() + "!" if y else "") for y in toxic]
    docs = clash(corpus([*texts, None, ""], langs=[ran.choice(["en", "de", None]) for _ in range(902)]))
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)] + [(3, None)], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score(docs, fitted).collect()}
    held = [i for i in range(900) if rows[i].held_out]
    assert 100 < len(held) < 260
    assert np.mean([rows[i].predicted == toxic[i] for i in held]) > 0.95
    assert np.mean([rows[i].rejected == bool(toxic[i]) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    assert rows[900].score == rows[901].score
    kept = toxicity.accepted(docs, fitted)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [i for i in rows if not rows[i].rejected]
    assert toxicity.score(docs.limit(0), fitted).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).count() == 902


def test_toxic_documents_of_small_languages_are_found(spark, corpus):
    ran = random.Random(17)
    bad = {"en": ["trash", "moron"], "de": ["achlich" + x for x in "abcdefghijkl"], "es": ["bomente" + x for x in "abcdefgh"]}
    spelt = lambda n: "".join("abcdefghij"[int(d)] for d in str(n))
    langs = ["en"] * 1500 + ["de"] * 300 + ["es"] * 200
    toxic = [int(ran.random() < 0.12) for _ in langs]
    texts = [" ".join([*(f"{x}{spelt(int(ran.paretovariate(0.4)) % 5000)}" for _ in range(60)), *(ran.sample(bad[x], 2) if y else [])]) for x, y in zip(langs, toxic)]
    docs = corpus(texts, langs=langs)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    for sample in (6000, 900):
        rows = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels, sample=sample)).collect()}
        for lang in bad:
            own = [i for i in rows if rows[i].held_out and langs[i] == lang]
            assert np.mean([rows[i].rejected for i in own if toxic[i]]) >= 0.8, (sample, lang)
            assert np.mean([rows[i].rejected for i in own if not toxic[i]]) <= 0.05, (sample, lang)


def test_all_labelled_documents_are_learned_from(spark, corpus):
    """Words that tell are spread thin, so no sixth of the documents knows them all."""
    ran = random.Random(23)
    spelt = lambda n: "".join("abcdefghij"[int(d)] for d in str(n))
    toxic = [int(ran.random() < 0.3) for _ in range(1500)]
    texts = [" ".join([*(f"w{spelt(ran.randrange(400))}" for _ in range(30)), *([f"bad{spelt(ran.randrange(60))}"] if y else [])]) for y in toxic]
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model, cuts = toxicity.fit(corpus(texts), labels, sample=150)
    known = {i for i in range(60) if model.place[toxicity.bucket(f"bad{spelt(i)}")]}
    assert len(known) >= 55
    rows = [r for r in toxicity.score(corpus(texts), (model, cuts)).collect() if r.held_out]
    assert np.mean([r.rejected == bool(toxic[r.doc_id]) for r in rows]) > 0.9


def test_thresholds_lean_on_all_languages():
    scores, labels = np.concatenate((np.full(300, 0.1), np.full(60, 0.8))), np.concatenate((np.zeros(300, int), np.ones(60, int)))
    langs = ["en"] * 350 + ["es"] * 10
    cuts = toxicity.thresholds(scores, labels, langs)
    assert set(cuts) == {None, "en", "es"} and all(0.1 < c <= 0.8 for c in cuts.values())


# --- neighbours -----------------------------------------------------------------------------------------


def exact(vectors, k, every):
    found = {}
    for i, v in vectors:
        if i % every == 0:
            scores = [(float((np.array(v) * np.array(w)).sum()), j) for j, w in vectors if j != i]
            found[i] = sorted(scores, key=lambda x: (-x[0], x[1]))[:k]
    return found


def test_search_recall_and_few_visits_on_clusters(spark):
    ran = np.random.default_rng(1)
    centres = ran.normal(size=(40, 16))
    vectors = [(i, (centres[i % 40] + 0.2 * ran.normal(size=16)).tolist()) for i in range(3000)]
    router, visits = neighbours.fit(np.array([v for _, v in vectors]))
    assert visits <= 4
    rows = neighbours.search(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    want, found = exact(vectors, 20, 20), {}
    for r in rows:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = sum(len({v for _, v, _ in found[q]} & {j for _, j in best}) for q, best in want.items())
    assert set(found) == set(want) and hits >= 0.9 * 20 * len(want)
    lookup = {i: np.array(v) for i, v in vectors}
    for q, got in found.items():
        got.sort()
        assert [r for r, _, _ in got] == list(range(1, 21))
        assert all(abs(s - lookup[q] @ lookup[v]) < 1e-9 for _, v, s in got)
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)


def test_visits_reach_recall_with_skewed_lengths():
    ran = np.random.default_rng(6)
    centres = ran.normal(size=(16, 16))
    vectors = centres[ran.integers(0, 16, 4000)] + 0.3 * ran.normal(size=(4000, 16))
    vectors *= np.exp(1.5 * ran.normal(size=(4000, 1)))
    router, visits = neighbours.fit(vectors[:3000])
    stored, asked = vectors, vectors[3000:]
    filed = router.log_odds(neighbours.unit(stored)).argmax(axis=1)
    true = np.argsort(-(asked @ stored.T), axis=1)[:, :20]
    visited = np.argsort(-router.log_odds(neighbours.unit(asked)), axis=1)[:, :visits]
    assert np.mean([np.isin(filed[t], v).mean() for t, v in zip(true, visited)]) >= 0.93


def test_repeated_queries_keep_all_their_neighbours(spark):
    ran = np.random.default_rng(9)
    vectors = [(i, ran.normal(size=4).tolist()) for i in range(60)]
    other = (40, ran.normal(size=4).tolist())
    got = {}
    for r in neighbours.search(spark.createDataFrame([*vectors, vectors[20], vectors[20], other], "vec_id long, embedding array<double>"), k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(x for x, _ in got[20]) == list(range(1, 11)) and len({v for _, v in got[20]} - {40}) >= 9
    assert sorted(x for x, _ in got[40]) == sorted([*range(1, 11)] * 2)


def test_search_edges(spark, clash, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 16)
    monkeypatch.setattr(neighbours, "BLOCK", 4)
    ran = np.random.default_rng(2)
    vectors = [(i, [1.0, 2.0, 2.0] if i % 3 == 0 else ran.normal(size=3).tolist()) for i in range(100)]
    odd = [(101, None), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 0.0]), (104, [float("nan"), 1.0, 1.0]), (120, [float("inf"), 1.0, 1.0]), (105, [1.0, 1.0]), (140, []), (None, [9.0, 9.0, 9.0])]
    df = clash(spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>"))
    got = {}
    for r in neighbours.search(df, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    best = exact(vectors, 5, 20)
    assert {q: [v for _, v in sorted(x)] for q, x in got.items()} == {q: [j for _, j in b] for q, b in best.items()}
    assert neighbours.search(df.limit(0)).count() == 0


def test_only_texts_that_may_have_a_label_are_learned_from(spark, corpus):
    """Texts without a label are left out before any shuffle; labelled ones all stay."""
    docs = corpus(["a" * (k + 1) for k in range(300)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 300, 3)], "doc_id long, toxic int").withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]))
    rows = toxicity._learning(docs, labels, "doc_id", "text")
    want = labels.filter(toxicity.fold(F.col("doc_id")) != 0).count()
    assert rows.count() == want == rows.select("ids").distinct().count()
    bits = toxicity._bits(labels)
    assert int(np.bitwise_count(bits).sum()) == 100
    held = spark.range(300).select(F.xxhash64(F.col("id").cast(dict(docs.dtypes)["doc_id"]))).toArrow()[0].to_numpy() & (toxicity.BITS - 1)
    assert [k for k in range(300) if bits[held[k] >> 3] >> (held[k] & 7) & 1] == list(range(0, 300, 3))
