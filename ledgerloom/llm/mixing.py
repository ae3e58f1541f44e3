"""Mixing sources to target weights by a minimum-cost flow.

Documents are summed up by membership pattern, the set of sources they belong to. The flow sends
the words of patterns to the sources' targets; the first use of a document costs nothing and each
further one more than the last (convex), so nothing is repeated while anything fresh may serve. A
pattern's flow is then spent on its documents: all of them as often as it covers them whole, and once
more a prefix of them in the order of a seeded hash.

To the driver go one row for each pattern and one for each source; both are as many as there are
combinations of sources, not documents. Prefixes are found on sums over slices of the hash order;
only the one slice of each pattern in which its prefix ends is sorted.
"""

import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.sinks import written

WORD = r"[^\x20\x09-\x0D]+"
#: Documents meant for one slice of the hash order.
SLICE = 4096


def targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Share of the total of all sizes for each source, by weights dealt in code point order (None last).

    No share is above ``most`` times the source's size; the excess goes to the others by weight.
    """
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    rest, open_, found = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        shared = sum(weight[x] for x in open_)
        full = [x for x in open_ if rest * weight[x] > most * sizes[x] * shared]
        if not full:
            return found | {x: rest * weight[x] / shared for x in open_}
        for x in full:
            found[x] = Fraction(most * sizes[x])
            open_.remove(x)
        rest -= sum(found[x] for x in full)
    return found


def route(patterns: dict, quotas: dict, most=3) -> dict:
    """Words that each pattern (a tuple of sources) gives in all, at least cost.

    ``patterns`` has the words of one use. Costs rise with each use and are the same for all, so the
    cheapest flow is the largest one with one use of everything, enlarged with a second use, and so
    on; each is found by augmenting paths.
    """
    room, given = dict(quotas), {p: {} for p in patterns}
    users = {s: set() for s in quotas}

    def push(pattern, amount):
        """Send at most so much from the pattern along one path; 0 if there is none."""
        came, queue = {("p", pattern): None}, [pattern]
        for p in queue:
            for s in p:
                if ("s", s) in came:
                    continue
                came["s", s] = p
                if room[s] > 0:
                    path, at = [], s
                    while True:
                        giver = came["s", at]
                        path.append((giver, at))
                        if came["p", giver] is None:
                            break
                        at = came["p", giver]
                    amount = min(amount, room[s], *(given[path[i][0]][path[i + 1][1]] for i in range(len(path) - 1)))
                    for i, (giver, source) in enumerate(path):
                        given[giver][source] = given[giver].get(source, 0) + amount
                        users[source].add(giver)
                        if i + 1 < len(path):
                            given[giver][path[i + 1][1]] -= amount
                    room[s] -= amount
                    return amount
                for other in users[s]:
                    if ("p", other) not in came and given[other].get(s, 0) > 0:
                        came["p", other] = s
                        queue.append(other)
        return 0

    for _ in range(most):
        for pattern, words in patterns.items():
            left = Fraction(words)
            while left > 0 and (sent := push(pattern, left)):
                left -= sent
    return {p: sum(flow.values(), Fraction(0)) for p, flow in given.items()}


def sized(docs: DataFrame, members, doc_id="doc_id", text="text", keep=False) -> DataFrame:
    """(doc_id, size, members, pattern) of every row, and all its columns in ``row`` if kept; a null text has no words."""
    return docs.select(
        docs[doc_id].alias("doc_id"),
        F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.array_sort(F.array_distinct(members)).alias("members"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if keep else []),
    ).withColumn("pattern", F.to_json("members"))


def mix(docs: DataFrame, members=None, weights=(1, 2, 3), most=3, seed=7, doc_id="doc_id", text="text", keep=False) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row of ``docs``; with ``keep`` also ``row``, a struct of all its columns.

    ``members`` is an array of the sources a document belongs to; by default its ``source`` alone, a
    null being a source of its own. ``source_size`` and ``target`` are sums over the document's
    sources. ``taken`` is ``copies`` times ``size``, at most ``most`` times it. Rows are taken in the order of
    an md5 of seed and doc_id, then of doc_id and size, so reruns agree; repeated rows count again;
    documents without words take nothing; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = written(sized(docs, F.array(docs["source"]) if members is None else members, doc_id, text, keep))
    found = rows.groupBy("pattern", "members").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()
    sources = {}
    for x in found:
        for s in x.members or ():
            sources[s] = sources.get(s, 0) + x.words
    quota = targets(sources, weights, most) if sources else {}
    words = {}
    for x in found:
        words[tuple(x.members or ())] = x.words
    flow = route(words, quota, most)
    plan = []
    for x in found:
        own, f = tuple(x.members or ()), flow[tuple(x.members or ())]
        base = min(most, f // x.words) if x.words else 0
        plan.append((x.pattern, sum(sources[s] for s in own), float(sum(quota[s] for s in own)), int(base), float(f - base * x.words)))
    plan = spark.createDataFrame(plan, "pattern string, source_size long, target double, base int, rest double")

    digits = max(2, math.ceil(math.log(max(sum(x.n for x in found) / SLICE, 1), 16)))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("hash", order).withColumn("slice", F.substring("hash", 1, digits)).drop("members")
    key = F.coalesce("pattern", F.lit("")).alias("own")
    sums = rows.groupBy(key, "slice").agg(F.sum("size").alias("words"))
    before = sums.withColumn("before", F.sum("words").over(Window.partitionBy("own").orderBy("slice")) - F.col("words"))
    slices = written(before.join(plan.withColumn("own", key).drop("pattern"), "own").withColumn(
        "extra", F.when(F.col("before") + F.col("words") <= F.col("rest"), 1).when(F.col("before") > F.col("rest"), 0)))
    placed = rows.withColumn("own", key).drop("pattern").join(slices.drop("words"), ["own", "slice"])
    inside = F.sum("size").over(Window.partitionBy("own").orderBy("hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    cut = placed.filter("extra IS NULL").withColumn("extra", (F.col("before") + inside - F.col("size") / 2 <= F.col("rest")).cast("int"))
    return placed.filter("extra IS NOT NULL").unionByName(cut).select(
        "doc_id", "size", "source_size", "target", F.least(F.col("base") + F.col("extra"), F.lit(most)).alias("copies"),
        (F.col("size") * F.least(F.col("base") + F.col("extra"), F.lit(most))).alias("taken"),
        *(["row"] if keep else []))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    return mix(docs, keep=True, **options).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5(concat('7:', coalesce(cast(doc_id AS varchar), ''))) AS hash FROM documents
), sources AS (
    SELECT source, cast(sum(size) AS bigint) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source
), ratios AS (
    SELECT *, 3 * source_size / cast(weight AS double) AS ratio FROM sources
), levels AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, row_number() OVER (ORDER BY ratio, source) AS k FROM ratios
), level AS (
    SELECT rest, open, k FROM levels WHERE rest <= ratio * open ORDER BY k LIMIT 1
), quotas AS (
    SELECT l.source, l.source_size, CASE WHEN l.k < level.k THEN cast(3 * l.source_size AS double) ELSE cast(level.rest AS double) * l.weight / cast(level.open AS double) END AS target FROM levels l, level
), placed AS (
    SELECT s.doc_id, s.size, q.source_size, q.target, floor(q.target / nullif(q.source_size, 0)) AS base,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS upto
    FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, cast(size AS bigint) AS size, source_size, target, cast(least(coalesce(base, 0) + CASE WHEN upto - size / 2 <= target - coalesce(base, 0) * source_size THEN 1 ELSE 0 END, 3) AS integer) AS copies,
    cast(size * least(coalesce(base, 0) + CASE WHEN upto - size / 2 <= target - coalesce(base, 0) * source_size THEN 1 ELSE 0 END, 3) AS bigint) AS taken
FROM placed
"""
