"""Spelling variants: words one edit apart, by PartEnum signatures of their letter multisets.

A word is a binary vector with one dimension for each letter and occurrence (the second ``e`` is another
one than the first). One replaced code point changes two dimensions, an inserted or deleted one changes
one. The dimensions are divided into ``PARTS`` parts; two vectors that differ in at most k dimensions are
equal after the right k parts are left out, so a word has one signature for every choice of k parts
(partition and enumerate), with k = 2 among words of one length and k = 1 between lengths that follow
each other. The edit leaves either the first or the last half of the word as it is, so every signature
also holds one half: this keeps words of the same few syllables in another order apart, and the groups
of one signature small. Equal signatures meet in an equi-join, and an edit distance verifies the pairs.
No pair at distance one is missed; hash collisions only cost a comparison.
"""

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.sinks import written

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = 4
#: One in so many words of a document loses a letter, as told by a hash.
EVERY = 97


def spellings(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(word): the runs of letters of every text, A-Z in lower case, every 97th without one of its letters.

    Null texts have none; a null id counts as an empty string.
    """
    runs = docs.select(
        F.coalesce(docs[doc_id].cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(docs[text], F.lit(RUN), F.lit(0))).alias("run"))
    lower = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lower.select("run", F.crc32(F.encode(F.concat("doc", F.lit(":"), "run"), "UTF-8")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run")).alias("word"))


def frequent(words: DataFrame, shortest=5, least=3) -> DataFrame:
    """(word, n) of the words with so many code points and occurrences; counts are summed up in tasks first."""
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def vectors(words: DataFrame, parts=PARTS) -> DataFrame:
    """(word, n, size, own): ``own`` has for every part the exclusive or of the hashes of the word's dimensions in it."""
    letters = F.array_sort(F.split("word", ""))
    place = lambda all_of: F.transform(all_of, lambda c, i: F.struct(c.alias("c"), (i - F.array_position(all_of, c)).alias("before")))
    part = lambda e: F.pmod(F.ascii(e.c) + 5 * e.before, F.lit(parts))
    mixed = lambda dims, p: F.aggregate(F.filter(dims, lambda e: part(e) == p), F.lit(0).cast("long"), lambda a, e: a.bitwiseXOR(F.xxhash64(e.c, e.before)))
    rows = words.select("word", "n", letters.alias("letters")).select("word", "n", place(F.col("letters")).alias("dims"))
    return rows.select("word", "n", F.size("dims").alias("size"), F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: mixed(F.col("dims"), p)).alias("own"))


def signatures(words: DataFrame, parts=PARTS) -> DataFrame:
    """(key, word, n): every signature of every word, hashed."""
    size, own = F.col("size"), [F.col("own")[p] for p in range(parts)]

    def key(kind, shorter: Column, out, half):
        rest = F.lit(0).cast("long")
        for p in range(parts):
            if p not in out:
                rest = rest.bitwiseXOR(own[p])
        return F.xxhash64(F.lit(kind), shorter, rest, half)

    def halves(shorter):
        """First half, and what follows the first half of the shorter word, counted from the end."""
        middle = F.floor(shorter / 2).cast("int")
        return [F.substring("word", F.lit(1), middle), F.substring("word", size - shorter + middle + 1, size)]

    keys = [key(f"2 {out} {i}", size, out, half) for out in itertools.combinations(range(parts), 2) for i, half in enumerate(halves(size))]
    for shorter in (size, size - 1):
        keys += [key(f"1 {out} {i}", shorter, (out,), half) for out in range(parts) for i, half in enumerate(halves(shorter))]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("key"))


def near_pairs(words: DataFrame, parts=PARTS) -> DataFrame:
    """(word, n, other, other_n): every two words at edit distance one, once, the smaller word first.

    The signatures of both sides are one exchange; a signature of very many words is split where Spark
    measures it in the join.
    """
    keyed = signatures(vectors(words, parts), parts)
    others = keyed.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = keyed.join(others, "key").filter(F.col("word") < F.col("other"))
    return met.filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: its form's form and so on, to the last.

    Every step at least doubles the count, so there are no circles and paths are short; each round
    halves them, so rounds grow with the logarithm of the logarithm of the largest count.
    """
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        above = now.select(F.col("word").alias("root"), F.col("root").alias("upper"))
        stepped = written(now.join(above, "root", "left").select("word", F.coalesce("upper", "root").alias("root"), F.col("upper").isNotNull().alias("moved")))
        now = stepped.select("word", "root")
        if not stepped.filter("moved").limit(1).count():
            return now


def variant_groups(docs: DataFrame, shortest=5, least=3, ratio=2, parts=PARTS, doc_id="doc_id", text="text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word of all texts.

    A word's form is its near word of largest n (ties: smallest word), if that n is ``ratio`` times its own
    or more, else null; root follows forms to the last. Repeated rows count as often as they come; null and
    empty texts add nothing; no texts give no rows. Other columns, whatever their names, are left out.
    """
    words = written(frequent(spellings(docs, doc_id, text), shortest, least))
    pairs = written(near_pairs(words, parts))
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    takes = -F.col("best.less") >= ratio * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("best.other")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")))
    return formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
