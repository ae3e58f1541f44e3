"""Cleaning and keys against Python's own Unicode rules, and hand-made URL cases."""

import re
import unicodedata

from pyspark.sql import functions as F

from ledgerloom.functions import text

NAMES = [
    "Société Générale S.A.", "Straße & Söhne GmbH", "Acme  Widgets\tLtd", "ﬁne ½ ﬂour №5", "ACME™ Group", "İstanbul A/S", "﻿Beta☻Gamma", "", "  ", "co co ltd", "x\x07y",
]


def python_key(value):
    value = re.sub(r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "", value).replace(" ", " ").replace("﻿", "").replace("☻", " ")
    value = unicodedata.normalize("NFKD", re.sub(r"\s+", " ", value).strip().casefold())
    value = "".join(c for c in value if not unicodedata.combining(c)).replace("&", " and ")
    return re.sub(r"[^a-z0-9]+", " ", value).strip()


def test_match_and_strict_keys(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES], "n string").select("n", text.match_key("n").alias("k"), text.strict_key("n").alias("s")).collect()
    legal = set(text.suffix_tokens())
    for row in rows:
        assert row.k == python_key(row.n)
        assert row.s == " ".join(t for t in row.k.split() if t not in legal)


def test_every_bmp_letter_folds_like_python(spark):
    chars = [chr(c) for c in range(0x20, 0x10000) if not 0xD800 <= c <= 0xDFFF and chr(c) not in "﻿☻"]
    rows = spark.createDataFrame([(c, f"a{c}b") for c in chars], "c string, t string").select("c", text.match_key("t").alias("k")).collect()
    assert [r.c for r in rows if r.k != python_key(f"a{r.c}b")] == []


def test_domains_and_urls(spark):
    cases = {
        "HTTPS://www.Acme.it:8080/x?y": ("acme.it", "HTTPS://www.Acme.it:8080/x"),
        "acme_shop.example.com/a//": ("acme_shop.example.com", "acme_shop.example.com/a"),
        "http://h": ("h", "http://h/"), "http://h/?q=1#f": ("h", "http://h/"), "": ("", ""),
    }
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select("u", text.domain_of("u").alias("d"), text.canonical_url("u").alias("c")).collect()
    assert {r.u: (r.d, r.c) for r in rows} == cases
    hosts = spark.createDataFrame([("db.ewg.org",), ("notewg.org",), ("",)], "h string").select(text.is_matchable_domain("h").alias("m"))
    assert [r.m for r in hosts.collect()] == [False, True, False]
    assert spark.range(1).select(text.domain_suffixes(F.lit("a.b.c")).alias("s")).head().s == ["a.b.c", "b.c", "c"]


def test_text_columns_stay_out_of_whole_stage_methods(spark):
    """Many cleaned columns in one such method outgrow what the JVM compiles."""
    rows = spark.createDataFrame([("  Café  A ",), ("A  b",), ("plain & simple",), (None,), ("a\n",)], "t string")
    cleaned = rows.select(text.clean("t").alias("c"), text.match_key("t").alias("k"))
    plan = rows.select(text.clean("t"))._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "*(" in line and "Project" in line]
    assert [tuple(r) for r in cleaned.collect()] == [("Café A", "cafe a"), ("A b", "a b"), ("plain & simple", "plain and simple"), ("", ""), ("a", "a")]
