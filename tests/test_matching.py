"""Blocking against all pairs, scorer definitions, decisions, one row per pair, partition independence."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.fuzzy import lcs_lengths, name_scores, token_set_scores
from ledgerloom.operators import blocking, decisions, matching
from ledgerloom.operators.ordered import salted_join
from ledgerloom.plans.adapters import Tables
from ledgerloom.plans.matching_queries import items, registry

SMALL = "/root/testdata/sf0.001"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def names(seed, count):
    rng = random.Random(seed)
    parts = ["an", "be", "co", "th", "er", "in", "o", "ra", "x", "li", "the"]
    made = {" ".join("".join(rng.choice(parts) for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(rng.choice([1, 1, 2, 2, 3, 4]))) for _ in range(count)}
    return sorted(made)


def test_lcs_with_short_and_long_patterns():
    rng = random.Random(3)
    a = ["".join(rng.choice("abc ") for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 90]))) for _ in range(60)]
    b = ["".join(rng.choice("abcd") for _ in range(rng.choice([0, 2, 30, 64, 70, 120]))) for _ in range(60)]
    assert list(lcs_lengths(a, b)) == [plain_lcs(x, y) for x, y in zip(a, b)]


def test_scores():
    got = name_scores(["acme", "red ring", "abc", "", "the big company of rings", "abcd"], ["acme", "ring red", "xabcx", "x", "rings", "abce"])
    assert [round(x, 2) for x in got] == [100.0, 100.0, 100.0, 0.0, 100.0, 85.71]
    assert round(token_set_scores(["acme widgets"], ["acme wodgets"])[0], 2) == 91.67


def test_blocking_finds_every_pair(spark):
    left, right = names(1, 260), names(2, 260)
    right = sorted(set(right) | {n.replace("a", "", 1).strip() or "q" for n in left[:120]} | {"the", "th", "t h e"})
    scores = token_set_scores([a for a in left for _ in right], right * len(left))
    want = {(a, b) for (a, b), s in zip(((a, b) for a in left for b in right), scores) if s >= 80 - 1e-9}
    frame = lambda ns: spark.createDataFrame([(n,) for n in ns], "name string")
    got = {(r.left_name, r.right_name) for r in blocking.similar_names(frame(left), frame(right)).collect()}
    assert got == want


def test_close_pairs_of_small_blocks_are_exact_and_few(spark, monkeypatch):
    monkeypatch.setattr(blocking, "BLOCK_NAMES", 7)
    left, right = names(5, 220), names(6, 220) + ["a" * 70 + " b", "a" * 71 + " b"]
    left += ["a" * 70 + " c"]
    frame = lambda ns: spark.createDataFrame([(n,) for n in ns], "name string")
    scores = token_set_scores([a for a in left for _ in right], right * len(left))
    want = {(a, b) for (a, b), s in zip(((a, b) for a in left for b in right), scores) if s >= 80 - 1e-9}
    found = [(r.left_name, r.right_name) for r in blocking.candidate_pairs(frame(left), frame(right)).collect()]
    assert len(found) == len(set(found)) and want <= set(found)
    # Pairs that share frequent letters and bigrams alone are dropped before they are shuffled.
    assert len(found) <= 3 * len(want)


def test_blocks_are_chosen_after_the_aggregate(spark):
    items = spark.createDataFrame([(1, "a.com"), (2, "shop.org"), (3, ""), (4, "a.com")], "id int, domain string")
    rows = [("GOTS", "a.com", 5, 1), ("GOTS", "a.com", 4, 9), ("B Corp", "a.com", 7, 0), ("GOTS", "shop.org", 1, 1), ("GOTS", "", 2, 2)]
    registry = spark.createDataFrame(rows, "certification string, host string, src_ordinal int, src_tie int")
    got = matching.exact_blocks(items, registry, "domain", "host", lambda k: F.col(k) != "shop.org")
    want = [(i, *r) for i in (1, 4) for r in (("B Corp", 1, 7, 0), ("GOTS", 2, 4, 9))]
    assert sorted(map(tuple, got.collect())) == want


def test_salted_join_splits_hot_keys_and_keeps_every_pair(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3)], "k string, v int")
    got = sorted((r.id, r.v) for r in salted_join(left, right, "k", "id", rows_per_task=100).collect())
    assert got == sorted((r.id, r.v) for r in left.join(right, "k").collect())


DIRECT = [  # c, p, d, entity, product, short, level, has_product -> decision, confidence, score, method
    ((50, 100, 100, False, True, False, "product", True), ("Direct Yes", "High", 100.0, "domain_and_product_exact")),
    ((100, 100, 0, True, True, False, "product", True), ("Direct Yes", "High", 98.0, "company_exact_and_product_exact")),
    ((95, 85, 0, False, False, False, "product", True), ("Direct Yes", "High", 90.5, "company_high_fuzzy_and_product_high_fuzzy")),
    ((90, 75, 0, False, False, False, "product", True), ("Direct Yes", "Medium", 83.25, "company_medium_fuzzy_and_product_medium_fuzzy")),
    ((95, 10, 0, False, False, False, "product", True), ("Direct Review", "Medium", 65.25, "company_high_but_product_uncertain")),
    ((75, 90, 0, False, False, False, "product", True), ("Direct Review", "Medium", 83.25, "product_high_but_company_uncertain")),
    ((10, 20, 0, False, False, False, "product", True), ("No", "", 20.0, "hint")),
    ((10, 0, 100, False, False, False, "company", False), ("Direct Yes", "High", 100.0, "domain_exact")),
    ((100, 0, 0, True, False, True, "brand", False), ("Direct Yes", "High", 100.0, "company_or_brand_exact_normalized")),
    ((97, 0, 0, False, False, True, "company", False), ("Direct Yes", "Medium", 97.0, "company_or_brand_very_high_fuzzy")),
    ((93, 0, 0, False, False, True, "company", False), ("Direct Review", "Low", 93.0, "company_or_brand_high_fuzzy")),
    ((93, 0, 0, False, False, False, "company", False), ("Direct Yes", "Medium", 93.0, "company_or_brand_high_fuzzy")),
    ((86, 0, 0, False, False, False, "company", False), ("Direct Review", "Medium", 86.0, "company_or_brand_possible_fuzzy")),
]
SUPPLIER = [
    ((98, 0, 0, False, False, False, "company", False), ("Direct Yes", "Medium", 98.0, "supplier_oriented_registry_very_high_company_fuzzy")),
    ((98, 0, 0, False, False, True, "company", False), ("Supplier Candidate", "Medium", 98.0, "supplier_oriented_registry_company_candidate")),
    ((88, 0, 0, False, False, False, "company", False), ("Supplier Candidate", "Low", 88.0, "supplier_oriented_registry_company_candidate")),
    ((70, 100, 0, False, True, False, "company", True), ("Supplier Candidate", "Low", 86.5, "supplier_oriented_registry_product_candidate")),
    ((60, 88, 0, False, False, False, "company", True), ("Supplier Candidate", "Low", 75.4, "supplier_oriented_registry_product_fuzzy_candidate")),
    ((59, 88, 0, False, False, False, "company", True), ("No", "", 88.0, "hint")),
]


def test_decision_branches(spark):
    rows = [(i, "direct_registry", *map(float, x[:3]), *x[3:], "hint") for i, (x, _) in enumerate(DIRECT)]
    rows += [(100 + i, "supplier_oriented_registry", *map(float, x[:3]), *x[3:], "hint") for i, (x, _) in enumerate(SUPPLIER)]
    frame = spark.createDataFrame(rows, "i int, registry_usage_mode string, company_score double, product_score double, domain_score double, entity_exact_match boolean, "
                                        "product_exact_match boolean, short_name boolean, evidence_level string, has_product boolean, hint string")
    got = {r.i: (r.decision, r.confidence, r.final_score, r.match_method) for r in decisions.decide(frame, -1.0).collect()}
    want = {i: y for i, (_, y) in enumerate(DIRECT)} | {100 + i: y for i, (_, y) in enumerate(SUPPLIER)}
    assert got == want


@pytest.fixture(scope="module")
def sides(spark):
    t = Tables(spark, SMALL)
    return items(t).cache(), registry(t).cache()


def test_best_match_once_per_pair_and_equal_to_brute_force(spark, sides):
    catalogue, rows = sides
    best = {(r.configurator_id, r.certification): r for r in matching.best_matches(catalogue, rows, stamp="-").collect()}
    certifications = sorted({c for _, c in best})
    assert len(best) == catalogue.count() * len(certifications)
    wanted = {(r.configurator_id, r.certification) for r in best.values() if r.decision != "No"}
    profiles, evidence = matching.item_profiles(catalogue), rows.select(*matching.EVIDENCE, "src_ordinal", "src_tie", "master_record_id")
    pairs = profiles.crossJoin(evidence).filter(
        ((F.col("company_strict") != "") & (F.col("company_strict") == F.col("entity_strict"))) | (F.col("domain_matchable") & F.array_contains("domains", F.col("registry_domain"))))
    exact = decisions.decide(matching.pair_features(pairs.withColumns({"hint": F.lit("x")}))).filter("decision <> 'No'")
    members = catalogue.join(profiles, matching.PROFILE).select("id", "profile")
    rank = exact.withColumns({"d": decisions.decision_rank(), "c": decisions.confidence_rank()}).groupBy("profile", "certification").agg(F.max(F.struct("d", "c", "final_score")).alias("m"))
    for row in members.join(rank, "profile").collect():
        got = best[(row.id, row.certification)]
        order = {"Direct Yes": 5, "Direct Review": 4, "Supplier Candidate": 3, "No": 1}[got.decision], {"High": 3, "Medium": 2, "Low": 1, "": 0}[got.confidence], got.final_score
        assert order >= tuple(row.m)
        assert (row.id, row.certification) in wanted


def test_result_does_not_depend_on_partitions(spark, sides):
    catalogue, rows = sides
    seen = []
    for count in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", count)
        seen.append(sorted(map(tuple, matching.candidate_matches(catalogue, rows, stamp="-").collect()), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1]


def test_copies_of_a_registry_row_are_one_class_and_are_told(spark):
    """A thousand copies of one row: one pair with its item; only the first of a name may be fuzzy candidates."""
    kinds = "certification string, entity_strict string, registry_product_strict string, registry_domain string, domain_matchable boolean, registry_usage_mode string, evidence_level string, has_product boolean, entity_short boolean, master_record_id string, src_ordinal int, src_tie int"
    row = lambda i, entity: ("GOTS", entity, "ring", "acme.org", True, "direct_registry", "product", True, False, f"r{i}", i, 0)
    registry = spark.createDataFrame([row(i, "acme mills") for i in range(1000)] + [row(5000, "acme mill")], kinds)
    rows = matching.classed_rows(registry, 5)
    classes = {(c.entity_strict, c.company_head): (c.evidence_rows, c.first_rows[0].master_record_id) for c in matching.evidence_classes(rows).collect()}
    # Heads of the product are rows 0 to 4 too, so head flags split the copies in two.
    assert classes == {("acme mills", True): (5, "r0"), ("acme mills", False): (995, "r5"), ("acme mill", True): (1, "r5000")}
    members = {r.member_record_id: r.master_record_id for r in matching.evidence_members(registry).collect()}
    assert len(members) == 1001 and {i: members[i] for i in ("r3", "r7", "r999", "r5000")} == {"r3": "r0", "r7": "r5", "r999": "r5", "r5000": "r5000"}
    first = [sorted(x.master_record_id for x in c.first_rows) for c in matching.evidence_classes(rows, 3).collect() if c.entity_strict == "acme mills"]
    assert sorted(first) == [["r0", "r1", "r2"], ["r5", "r6", "r7"]]


def test_pairs_of_a_domain_that_cannot_lead_are_left_out(spark, sides, monkeypatch):
    """With all rows on one host the audits are those of all pairs, from far fewer."""
    catalogue, rows = sides
    catalogue = catalogue.filter("id % 4 = 0").withColumn("domains", F.array(F.lit("one.example.com")))
    rows = rows.filter("src_ordinal % 9 = 0").withColumns({"registry_domain": F.lit("one.example.com"), "domain_matchable": F.lit(True)})
    every, counts = matching.scored_classes, []

    def counted(*args, **limits):
        pairs = every(*args, **limits)
        counts.append(pairs.count())
        return pairs

    for find in (matching.best_matches, matching.candidate_matches):
        monkeypatch.setattr(matching, "scored_classes", counted)
        got = sorted(map(tuple, find(catalogue, rows, stamp="-").collect()), key=str)
        monkeypatch.setattr(matching, "scored_classes", lambda *args, keep=None, **limits: counted(*args, **limits))
        assert got == sorted(map(tuple, find(catalogue, rows, stamp="-").collect()), key=str)
        assert counts[-2] < counts[-1] / 3, counts


def test_members_of_evidence_equal_the_classes(spark, sides):
    """Representatives are the first rows of the classes, with any ids and blank names."""
    _, rows = sides
    rows = rows.filter("src_ordinal % 5 = 0").withColumns({
        "master_record_id": F.when(F.col("src_ordinal") % 3 == 0, F.concat(F.lit("Z é "), "master_record_id")).otherwise(F.col("master_record_id")),
        "entity_strict": F.when(F.col("src_ordinal") % 7 == 0, "").otherwise(F.col("entity_strict"))})
    classed = matching.classed_rows(matching._rows(rows))
    first = matching.evidence_classes(classed).select(*matching.CLASS, F.col("first_rows")[0]["master_record_id"].alias("first"))
    want = classed.join(first, matching.CLASS).select("master_record_id", "first")
    found = matching.evidence_members(rows)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert "entity_strict" not in found._jdf.queryExecution().executedPlan().toString()
