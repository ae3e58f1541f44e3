"""Approximate nearest neighbours over learned partitions.

A bounded sample of the vectors gets its exact neighbour graph, which is cut into parts of equal size with
few cut edges; a small softmax network learns to tell a vector's part. It then files every vector under its most
probable part, and sends each query to the several most probable ones, whose vectors are scored exactly.
How many parts a query visits is measured on the sample: the fewest with which queries held out of the
graph find ``recall`` of their true neighbours.

Parts are stored in chunks of bounded size, so one that is very full (a common vector, say) is many
tasks; queries of a part come in blocks. Each pair of a chunk and a block gives the block's best in that
chunk, and these are merged by query.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.sinks import written

#: Vectors that the partition is learned from, at most.
SAMPLE = 4096
PARTS, GRAPH, HIDDEN, EPOCHS, RATE = 16, 12, 96, 60, 0.02
RECALL = 0.95
CHUNK, BLOCK = 8192, 1024


def unit(vectors):
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def graph(vectors, k):
    """The k nearest others of each vector by inner product."""
    near = vectors @ vectors.T
    np.fill_diagonal(near, -np.inf)
    k = min(k, len(vectors) - 1)
    return np.argpartition(-near, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(vectors), 0), int)


def balanced_cut(near, parts, rounds=12):
    """Part of each node: halves by halves, each half found by moving nodes towards their neighbours.

    In every round the nodes of a piece are ranked by how many more of their neighbours (either way) are
    in the second half, and the ranking's halves are the next ones; so all parts stay equal.
    """
    n = len(near)
    rows = np.repeat(np.arange(n), near.shape[1])
    ends = near.ravel()
    a, b = np.concatenate((rows, ends)), np.concatenate((ends, rows))
    part = np.zeros(n, np.int64)
    rng = np.random.default_rng(3)
    while (1 << int(part.max(initial=0)).bit_length()) < parts or part.max(initial=0) == 0 and parts > 1:
        pieces = int(part.max()) + 1
        side = rng.permutation(n) % 2
        for _ in range(rounds):
            inner = part[a] == part[b]
            pull = np.bincount(a[inner], weights=(2 * side[b[inner]] - 1), minlength=n) + 0.5 * (2 * side - 1)
            for p in range(pieces):
                own = np.flatnonzero(part == p)
                order = own[np.argsort(pull[own], kind="stable")]
                side[order[: len(order) // 2]], side[order[len(order) // 2 :]] = 0, 1
        part = part * 2 + side
        if pieces * 2 >= parts:
            return part
    return part


class Router:
    """Softmax network of one hidden layer from a vector to its part."""

    def __init__(self, dim, parts, seed=4):
        rng = np.random.default_rng(seed)
        self.w1, self.b1 = rng.normal(0, 1, (dim, HIDDEN)) , np.zeros(HIDDEN)
        self.w2, self.b2 = rng.normal(0, 0.1, (HIDDEN, parts)), np.zeros(parts)

    def log_odds(self, vectors):
        return np.tanh(vectors @ self.w1 + self.b1) @ self.w2 + self.b2

    def fit(self, vectors, part, seed=4):
        rng = np.random.default_rng(seed)
        params = [self.w1, self.b1, self.w2, self.b2]
        means, squares, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(vectors))
            for at in range(0, len(order), 128):
                own = order[at : at + 128]
                x = vectors[own]
                h = np.tanh(x @ self.w1 + self.b1)
                z = h @ self.w2 + self.b2
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(own)), part[own]] -= 1
                p /= len(own)
                back = (p @ self.w2.T) * (1 - h**2)
                t += 1
                for q, g, m, s in zip(params, [x.T @ back, back.sum(0), h.T @ p, p.sum(0)], means, squares):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g**2 - s)
                    q -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        return self


def fit(vectors, k=20, recall=RECALL, parts=PARTS):
    """(router, parts to visit) from sample vectors, scaled to length one for routing; true neighbours are those of the vectors as they are."""
    whole, vectors = vectors, unit(vectors)
    if len(vectors) < 8 * parts:
        return Router(vectors.shape[1], 1), 1
    held = len(vectors) // 4
    part = balanced_cut(graph(vectors[held:], GRAPH), parts)
    router = Router(vectors.shape[1], parts).fit(vectors[held:], part)
    filed = router.log_odds(vectors[held:]).argmax(axis=1)
    near = whole[:held] @ whole[held:].T
    true = np.argpartition(-near, k - 1, axis=1)[:, :k]
    rank = np.argsort(np.argsort(-router.log_odds(vectors[:held]), axis=1), axis=1)
    needed = np.take_along_axis(rank, filed[true], axis=1)
    found = np.array([(needed < m).mean() for m in range(1, parts + 1)])
    return router, int(np.argmax(found >= recall) + 1) if found.max() >= recall else parts


def _vectors(lists, dim):
    return np.array(lists, np.float64).reshape(-1, dim)


def best(queries, query_ids, vectors, ids, k):
    """(query index, vec_id, score) of each query's k best, itself left out, ties to the smaller id.

    A matrix product finds who can be among them; scores are then summed anew pair by pair, so that
    equal vectors have equal scores wherever they are stored.
    """
    rough = queries @ vectors.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    size = min(k, len(ids))
    last = np.partition(rough, len(ids) - size, axis=1)[:, len(ids) - size]
    q, v = np.nonzero((rough >= last[:, None] - 1e-9) & np.isfinite(rough))
    score = (queries[q] * vectors[v]).sum(axis=1)
    order = np.lexsort((ids[v], -score, q))
    q, v, score = q[order], v[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], ids[v[place < k]], score[place < k]


def search(vectors: DataFrame, every=20, k=20, recall=RECALL, sample=SAMPLE, parts=PARTS, id_col="vec_id", vector="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by ``every``.

    All rows are indexed. Rows whose vector is null, zero, or holds null or non-finite components, or
    is not as long as the sample's most frequent length, or whose id is null, take no part. A row is no
    neighbour of rows with its own id. Equal rows ask once; rows of one id with different vectors each have their ``k``. With fewer than 8 sampled vectors for each part, all are searched.
    """
    import pyarrow as pa

    spark = vectors.sparkSession
    value = F.transform(vectors[vector], lambda x: x.cast("double"))
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), value.alias("v")).filter(usable & F.col("vec_id").isNotNull())
    drawn = [x.v for x in rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample).collect()]  # at most ``sample`` vectors
    lengths = np.bincount([len(x) for x in drawn]) if drawn else np.array([0, 1])
    dim = int(lengths.argmax())
    rows = rows.filter(F.size("v") == dim)
    router, visits = fit(_vectors([x for x in drawn if len(x) == dim], dim), k, recall, parts)
    shared = spark.sparkContext.broadcast(router.__dict__)

    def route(batches):
        own = Router.__new__(Router)
        own.__dict__ |= shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            odds = own.log_odds(unit(_vectors(batch.column(1).flatten().to_numpy(), dim)))
            ranked = np.argsort(-odds, axis=1, kind="stable")[:, :visits].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranked.tolist(), pa.list_(pa.int32()))], ["vec_id", "v", "parts"])

    filed = written(rows.mapInArrow(route, "vec_id long, v array<double>, parts array<int>"))
    sizes = filed.groupBy(F.col("parts")[0].alias("part")).agg(F.ceil(F.count("*") / (CHUNK / 2)).alias("chunks"))
    counted = filed.select("vec_id", "v", F.col("parts")[0].alias("part")).join(F.broadcast(sizes), "part")  # one row for each part
    chunks = counted.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), "chunks")).groupBy("part", "chunk").agg(
        F.collect_list("vec_id").alias("ids"), F.flatten(F.collect_list("v")).alias("vs"))
    asking = filed.filter(F.col("vec_id") % every == 0).withColumn("mark", F.xxhash64("v")).groupBy("vec_id", "mark").agg(F.first("v").alias("v"), F.first("parts").alias("parts"))
    asked = asking.select("vec_id", "mark", "v", F.explode("parts").alias("part"))
    asked_sizes = asked.groupBy("part").agg(F.ceil(F.count("*") / (BLOCK / 2)).alias("blocks"))
    blocks = asked.join(F.broadcast(asked_sizes), "part").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), "blocks")).groupBy("part", "block").agg(
        F.collect_list("vec_id").alias("query_ids"), F.collect_list("mark").alias("marks"), F.flatten(F.collect_list("v")).alias("queries"))

    def scored(batches):
        for batch in batches:
            for ids, vs, asked_ids, asked_marks, asked_vs in zip(*(batch.column(i) for i in range(5))):
                own_ids, asking, marks = (x.values.to_numpy(zero_copy_only=False) for x in (ids, asked_ids, asked_marks))
                q, v, s = best(_vectors(asked_vs.values.to_numpy(), dim), asking, _vectors(vs.values.to_numpy(), dim), own_ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(asking[q]), pa.array(marks[q]), pa.array(v), pa.array(s)], ["query_id", "mark", "vec_id", "score"])

    pairs = chunks.join(blocks, "part").select("ids", "vs", "query_ids", "marks", "queries").repartition(spark.sparkContext.defaultParallelism * 2, F.xxhash64("ids", "query_ids"))
    found = pairs.mapInArrow(scored, "query_id long, mark long, vec_id long, score double")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
