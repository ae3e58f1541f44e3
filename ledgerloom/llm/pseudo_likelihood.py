"""Masked pseudo-likelihood: how well both sides of each word predict it, summed over a document.

A small network reads the two words on either side of a masked one and gives the probabilities of the
``VOCABULARY`` most frequent words, in two steps: of a class of neighbouring frequency ranks, then of the word in it.
Rarer words are one entry together, and then a bucket of their hashes with its share of the corpus.

All documents train it: counts of every word of the corpus give vocabulary and buckets, and in each of
``ROUNDS`` rounds the documents of one share of the hashes are trained on where they lie, from the same
parameters, which are then averaged by tokens (block by block, each block streamed through one task).
To driver and tasks go the parameters and the bucket table, whose sizes are fixed.
"""

from collections import Counter

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column, whole_texts
from ledgerloom.llm.encoding import remembered
from ledgerloom.sources.sinks import written

#: Entries of the output, the first for all rarer words; classes of as many entries as there are classes.
CLASSES = 32
VOCABULARY = CLASSES * CLASSES
REACH, DIM, BUCKETS = 2, 16, 1 << 16
ROUNDS, BATCH, RATE = 2, 8192, 0.1
#: Parameters in one block of the averaging; words counted in a task before they are handed on.
BLOCK, FLUSH = 1024, 300_000
AT_ONCE = 100_000
SHAPES = [(2 * REACH, VOCABULARY + 1, DIM), (DIM,), (DIM, CLASSES), (CLASSES,), (CLASSES, DIM, CLASSES), (CLASSES, CLASSES)]
SIZES = [int(np.prod(s)) for s in SHAPES]


def start(seed=9):
    rng = np.random.default_rng(seed)
    return [rng.normal(0, 0.1, s).astype(np.float32) if len(s) > 1 and s != (CLASSES, CLASSES) else np.zeros(s, np.float32) for s in SHAPES]


def flat(params):
    return np.concatenate([p.ravel() for p in params])


def shaped(vector):
    return [x.reshape(s) for x, s in zip(np.split(np.asarray(vector, np.float32), np.cumsum(SIZES)[:-1]), SHAPES)]


def words(text: str) -> list[str]:
    return text.lower().split()


def windows(lists):
    """(context of each word: 2 * REACH columns, the words) of documents end to end; outside is VOCABULARY."""
    pad = np.full(REACH, VOCABULARY, np.int32)
    line = np.concatenate([x for ids in lists for x in (pad, ids)] + [pad])
    sizes = np.array([len(ids) for ids in lists])
    spots = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(lists) + 1) * REACH, sizes)
    offsets = [o for o in range(-REACH, REACH + 1) if o]
    return np.stack([line[spots + o] for o in offsets], 1), line[spots]


def _softmax(x):
    x = np.exp(x - x.max(axis=1, keepdims=True))
    x /= x.sum(axis=1, keepdims=True)
    return x


def hidden(params, context):
    total = params[0][0][context[:, 0]] + params[1]
    for k in range(1, 2 * REACH):
        total += params[0][k][context[:, k]]
    return np.tanh(total)


def _chosen(x, at):
    """Log-softmax of each row at one place."""
    x = x - x.max(axis=1, keepdims=True)
    return x[np.arange(len(at)), at] - np.log(np.exp(x).sum(axis=1))


def _by_class(kinds):
    order = np.argsort(kinds.astype(np.int16), kind="stable")
    cuts = np.searchsorted(kinds[order], np.arange(CLASSES + 1))
    return [(c, order[cuts[c] : cuts[c + 1]]) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


def log_probabilities(params, context, center):
    h = hidden(params, context)
    kinds, within = center // CLASSES, center % CLASSES
    found = _chosen(h @ params[2] + params[3], kinds).astype(np.float64)
    for c, own in _by_class(kinds):
        found[own] += _chosen(h[own] @ params[4][c] + params[5][c], within[own])
    return found


def step(params, squares, context, center):
    """One Adagrad step on the mean log loss of a batch."""
    n = len(center)
    h = hidden(params, context)
    kinds, within = center // CLASSES, center % CLASSES
    p = _softmax(h @ params[2] + params[3])
    p[np.arange(n), kinds] -= 1
    p /= n
    back = p @ params[2].T
    grads = [None, None, h.T @ p, p.sum(axis=0), np.zeros_like(params[4]), np.zeros_like(params[5])]
    for c, own in _by_class(kinds):
        q = _softmax(h[own] @ params[4][c] + params[5][c])
        q[np.arange(len(own)), within[own]] -= 1
        q /= n
        grads[4][c], grads[5][c] = h[own].T @ q, q.sum(axis=0)
        back[own] += q @ params[4][c].T
    back *= 1 - h**2
    grads[1] = back.sum(axis=0)
    grads[0] = np.zeros_like(params[0])
    for k in range(2 * REACH):
        order = np.argsort(context[:, k].astype(np.int16), kind="stable")
        used = context[order, k]
        first = np.flatnonzero(np.concatenate(([True], used[1:] != used[:-1])))
        grads[0][k, used[first]] = np.add.reduceat(back[order], first, axis=0)
    for p_, s, g in zip(params, squares, grads):
        s += g * g
        p_ -= RATE * g / np.sqrt(s)


def word_counts(rows: DataFrame) -> DataFrame:
    """(term, n): occurrences of every word in the corpus; summed up in tasks first."""
    import pyarrow as pa

    def table(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    def run(batches):
        counts = Counter()
        for batch in batches:
            for text in column(batch, "text"):
                counts.update(words(text))
                if len(counts) > FLUSH:
                    yield table(counts)
                    counts.clear()
        yield table(counts)

    return written(rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")))


def vocabulary(counts: DataFrame):
    """(frequent words by rank, log shares of the buckets among rarer words)."""
    top = [x.term for x in counts.orderBy(F.desc("n"), "term").limit(VOCABULARY - 1).select("term").collect()]
    known = F.broadcast(counts.sparkSession.createDataFrame([(t,) for t in top], "term string"))  # VOCABULARY rows at most
    rare = counts.join(known, "term", "left_anti").groupBy(F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).alias("bucket")).agg(F.sum("n").alias("n"))
    shares = np.ones(BUCKETS)
    for x in rare.collect():  # BUCKETS rows at most
        shares[x.bucket] += x.n
    return top, np.log(shares / shares.sum())


def _ids(known, text):
    found = words(text)
    return found, np.fromiter((known.get(w, 0) for w in found), np.int32, len(found))


def train(rows: DataFrame, top, rounds=ROUNDS, seed=9):
    """Parameters after all rounds; every document is trained on once."""
    import pyarrow as pa

    spark, params = rows.sparkSession, flat(start(seed))
    share = F.pmod(F.xxhash64("text"), F.lit(rounds))
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((params, top))

        def run(batches):
            vector, terms = shared.value
            own, known = [x.copy() for x in shaped(vector)], {w: i + 1 for i, w in enumerate(terms)}
            squares, seen = [np.full_like(x, 1e-4) for x in own], 0
            lists, size = [], 0

            def learn():
                context, center = windows(lists)
                for at in range(0, len(center), BATCH):
                    step(own, squares, context[at : at + BATCH], center[at : at + BATCH])
                return len(center)

            for batch in batches:
                for text in column(batch, "text"):
                    lists.append(_ids(known, text)[1])
                    size += len(lists[-1])
                    if size > AT_ONCE:
                        seen += learn()
                        lists, size = [], 0
            if size:
                seen += learn()
            if seen:
                values, part = flat(own), TaskContext.get().partitionId()
                starts = range(0, len(values), BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(starts)), pa.int32()), pa.array([part] * len(starts), pa.int32()), pa.array([seen] * len(starts), pa.int64()), pa.array([values[i : i + BLOCK].tobytes() for i in starts], pa.binary())],
                    ["block", "part", "tokens", "piece"])

        def mean(batches):
            sums, tokens = {}, {}
            for batch in batches:
                for block, n, piece in zip(*(column(batch, c) for c in ("block", "tokens", "piece"))):
                    sums[block] = sums.get(block, 0) + n * np.frombuffer(piece, np.float32).astype(np.float64)
                    tokens[block] = tokens.get(block, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(sums[b] / tokens[b]).astype(np.float32).tobytes() for b in sums], pa.binary())], ["block", "piece"])

        trained = rows.filter(share == k).select("text").mapInArrow(run, "block int, part int, tokens long, piece binary")
        means = trained.repartition("block").sortWithinPartitions("block", "part").mapInArrow(mean, "block int, piece binary").collect()
        if means:
            params = np.concatenate([np.frombuffer(x.piece, np.float32) for x in sorted(means, key=lambda x: x.block)])
    return params


def fit(docs: DataFrame, rounds=ROUNDS, doc_id="doc_id", text="text"):
    """(parameters, frequent words, log shares of buckets) from all documents."""
    rows = whole_texts(docs, doc_id, text)
    top, shares = vocabulary(word_counts(rows))
    return train(rows, top, rounds), top, shares


def score(docs: DataFrame, fitted, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) of every row of ``docs``.

    ``log_prob`` sums the natural log-probability of each word given both sides. A text without words
    (null, empty) has 0.0 and a null mean. Repeated rows stay; equal texts score alike up to rounding.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches):
        vector, top, shares = shared.value
        params, known = shaped(vector), {w: i + 1 for i, w in enumerate(top)}
        tail = remembered("rare words", lambda w: xxhash.xxh64_intdigest(w, 42) % BUCKETS)

        def sums(lists):
            sizes = np.array([len(x) for x in lists])
            if not sizes.sum():
                return np.zeros(len(lists))
            each = np.concatenate((log_probabilities(params, *windows(lists)), [0.0]))
            totals = np.add.reduceat(each, np.minimum(np.concatenate(([0], np.cumsum(sizes[:-1]))), len(each) - 1))
            return np.where(sizes > 0, totals, 0.0)

        for batch in batches:
            tail.trimmed()
            totals, rare, counts, lists, size = [], [], [], [], 0
            for text in column(batch, "text"):
                found, ids = _ids(known, text)
                rare.append(shares[[tail[w] for w, i in zip(found, ids.tolist()) if not i]].sum() if len(ids) else 0.0)
                counts.append(len(ids))
                lists.append(ids)
                size += len(ids)
                if size > AT_ONCE:
                    totals.append(sums(lists))
                    lists, size = [], 0
            if lists:
                totals.append(sums(lists))
            n, total = np.array(counts, np.int64), np.concatenate([*totals, []]) + np.array(rare, np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1), mask=n == 0)], ["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    rows = whole_texts(docs, doc_id, text)
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, log_prob double, mean_log_prob double")
