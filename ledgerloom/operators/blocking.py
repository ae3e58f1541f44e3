"""Name pairs that can reach a token-set ratio of 80, without comparing all names.

Names are distinct match keys. A pair at or above 80 takes one of two exact routes:

1. Shared words cover one name. Unshared words then weigh at most (W - 1) / 3 of that name, where a
   word weighs its length plus one and W is their sum, so one of its rarest words up to that weight
   is shared.
2. The rests are close: at most 0.2 (La + Lb) insertions and deletions, so the lengths, the letter
   counts of each class and the letter counts themselves differ by no more than that. Names go into
   blocks of one length and class counts; only blocks within that distance meet, and inside two
   blocks bit sets of the letter counts, then common subsequences, drop the rest.

Rare words come first in route 1, so a word that a third of all names carry is joined on only by the
few names that consist of little else. Route 2 has no hot keys: a block holds some ``BLOCK_NAMES``
names, less than about twice as many, and a pair of names meets in one pair of blocks.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.fuzzy import close_names, token_set_score
from ledgerloom.operators.ordered import salted_join, top_n
from ledgerloom.sources.sinks import written

LOWEST_CUTOFF = 80.0
BLOCK_NAMES = 4096
#: Letter classes of the blocks; every other character is the last class.
CLASSES = ["aeiou", "dlnrt"]


def _features(names):
    """Words of every distinct name, its length, and its letters of each class."""
    shaped = names.withColumn("words", F.array_sort(F.array_distinct(F.split("name", " "))))
    full = F.array_join("words", " ")
    shaped = shaped.withColumn("size", F.length(full))
    counts = {f"class{i}": F.length(full) - F.length(F.translate(full, letters, "")) for i, letters in enumerate(CLASSES)}
    return shaped.withColumns(counts).withColumn(f"class{len(CLASSES)}", F.col("size") - sum((F.col(c) for c in counts), F.lit(0)))


def _rarest_first(names, feature):
    """(name, features ordered from rare to frequent) over the distinct names of both sides."""
    rows = names.select("name", F.explode(feature).alias("f"))
    counts = rows.groupBy("f").agg(F.count("*").alias("n"))
    ordered = rows.join(counts, "f").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "f"))).alias("fs"))
    return ordered.select("name", F.transform("fs", lambda s: s["f"]).alias(feature))


def _word_prefix(words):
    """Rarest words up to one third of the name's weight."""
    weight = lambda ws: F.aggregate(ws, F.lit(0), lambda a, w: a + F.length(w) + 1)
    total = weight(words)
    return F.filter(words, lambda w, i: weight(F.slice(words, F.lit(1), i)) <= (total - 1) / 3 + 1e-9)


def close_pairs(shaped: DataFrame) -> DataFrame:
    """(left_name, right_name) by route 2, from names with sides, size and class counts."""
    classes = [f"class{i}" for i in range(len(CLASSES) + 1)]
    cell = ["size", *classes]
    # Few cells: neighbours in the order of their counts fill a block together, large ones are split.
    cells = shaped.groupBy(*cell).count()
    before = F.sum("count").over(Window.partitionBy("size").orderBy(*classes)) - F.col("count")
    cells = cells.select(*cell, F.floor(before / BLOCK_NAMES).alias("_run"), F.ceil(F.col("count") / BLOCK_NAMES).alias("_parts"))
    placed = shaped.join(cells, cell).withColumn("_part", F.pmod(F.xxhash64("name"), F.col("_parts")))

    def blocks(side, prefix):
        rows = placed.filter(F.col("sides").bitwiseAND(side) > 0).groupBy("size", "_run", "_part").agg(
            F.collect_list("name").alias("names"), *[F.min(c).alias(f"least_{c}") for c in classes], *[F.max(c).alias(f"most_{c}") for c in classes])
        named = rows.withColumn("block", F.concat_ws("/", F.lit(prefix), "size", "_run", "_part")).drop("_run", "_part")
        return named.select(*[F.col(c).alias(f"{prefix}_{c}") for c in named.columns])

    # Lengths of a pair differ by half of the shorter one at most.
    lengths = F.sequence(F.ceil(F.col("l_size") * 2 / 3 - 1e-9).cast("int"), F.floor(F.col("l_size") * 1.5 + 1e-9).cast("int"))
    met = blocks(1, "l").withColumn("r_size", F.explode(lengths)).join(blocks(2, "r"), "r_size")
    gap = lambda c: F.greatest(F.lit(0), F.col(f"l_least_{c}") - F.col(f"r_most_{c}"), F.col(f"r_least_{c}") - F.col(f"l_most_{c}"))
    met = met.filter(sum((gap(c) for c in classes), F.lit(0)) <= F.floor((F.col("l_size") + F.col("r_size")) * 0.2 + 1e-9))
    # Pairs of blocks are few and each is much work, so they are dealt out by number.
    tasks = 4 * shaped.sparkSession.sparkContext.defaultParallelism
    dealt = met.select("l_block", "l_names", "r_block", "r_names").repartition(tasks, "l_block", "r_block")
    return dealt.mapInArrow(close_names, "left_name string, right_name string")


def candidate_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_name, right_name) pairs that may reach the lowest cutoff; inputs have one column name."""
    names = left.select("name", F.lit(1).alias("side")).unionByName(right.select("name", F.lit(2).alias("side")))
    # One row per distinct name with the sides it stands on: 1, 2 or 3 for both.
    names = names.filter("name <> ''").groupBy("name").agg(F.bit_or("side").alias("sides"))
    # Names are far fewer than rows and are read by every route below.
    shaped = written(_features(names))
    words = _rarest_first(shaped, "words")
    keyed = shaped.select("name", "sides").join(words, "name").withColumn("rare_words", _word_prefix(F.col("words")))
    on_left, on_right = F.col("sides").bitwiseAND(1) > 0, F.col("sides").bitwiseAND(2) > 0

    def rows(side, column):
        return keyed.filter(side).select("name", F.explode(column).alias("k"))

    def meet(a, b):
        return salted_join(a.withColumnRenamed("name", "left_name"), b.withColumnRenamed("name", "right_name"), "k", "left_name")

    by_left = meet(rows(on_left, "rare_words"), rows(on_right, "words"))
    by_right = meet(rows(on_left, "words"), rows(on_right, "rare_words"))
    pair = ["left_name", "right_name"]
    return by_left.select(*pair).unionByName(by_right.select(*pair)).unionByName(close_pairs(shaped)).distinct()


def similar_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct name pairs with a token-set ratio of at least the lowest cutoff."""
    scored = candidate_pairs(left, right).withColumn("score", token_set_score("left_name", "right_name"))
    return scored.filter(F.col("score") >= LOWEST_CUTOFF - 1e-9)


def best_names(pairs: DataFrame, choices: DataFrame, cutoff, limit=8) -> DataFrame:
    """Per left name and certification the ``limit`` best choices, equal scores in name order.

    ``choices`` has certification and name.
    """
    able = pairs.filter(F.col("score") >= cutoff - 1e-9)
    offered = able.join(choices.select("certification", F.col("name").alias("right_name")), "right_name")
    return top_n(offered, ["left_name", "certification"], [F.desc("score"), F.asc("right_name")], limit, "name_rank")
