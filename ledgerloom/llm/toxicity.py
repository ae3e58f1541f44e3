"""Toxicity: a convolutional text classifier in numpy, scored over whole texts by Spark tasks.

Words are hashed to rows of an embedding table; filters of several widths slide over a text, each keeps
its greatest response (max pooling), and a logistic layer weighs these. Every labelled document of the learning
folds is learned from: tasks count the words of all, then train on parts of some ``PART`` documents each, all from one
start, and what they learned of a word is averaged over the parts that hold it, by documents. The first number of a word's
row is its log-odds among the documents trained on, shrunk towards zero by ``SHRUNK`` documents; in training, a document's own words have those of
the other documents, so that rare ones can't be learned by heart. The rest of the row is learned. The
thresholds of languages are fitted on the fifth of the documents kept from training, all of them; they decide what is
rejected but are no part of a score. The driver gets counts and rows of ``BUCKETS`` buckets at most.
"""

import math
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column
from ledgerloom.llm.encoding import remembered
from ledgerloom.sources.sinks import written

#: Labelled documents that one task trains on, about.
PART = 6000
#: Bits that tell which texts may have a label.
BITS = 1 << 26
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 20, 16, 12, (1, 2, 3)
SHRUNK, EPOCHS, BATCH, RATE, DECAY = 2, 4, 32, 0.05, 3e-4
#: Holders from which on a word's row starts at full length; log-odds that chance gives some word of a long text, and
#: what each unit above them adds to a document's at the start.
LEARNED, SILENT, SLOPE = 20, 1.5, 8.0
#: Documents of all languages that count beside a language's own when its threshold is fitted.
PRIOR = 200
WORD = re.compile(r"[^\W\d_]+")


def bucket(word: str) -> int:
    """Bucket of a word; 0 is for none."""
    return 1 + xxhash.xxh64_intdigest(word) % (BUCKETS - 1)


def buckets_of(text: str, known=None) -> np.ndarray:
    found = WORD.findall(text.lower())
    return np.fromiter(map(known.__getitem__ if known is not None else bucket, found), np.int32, len(found))


class Classifier:
    """Row of each bucket, embedding table, filters of each width (FILTERS x width*DIM), and the logistic layer.

    Buckets that only one document has, whose words tell nothing of others, share the zero row with unseen ones.
    """

    def __init__(self, holders, seed=5):
        rng = np.random.default_rng(seed)
        seen = np.flatnonzero(holders > 1)
        self.place = np.zeros(BUCKETS, np.int32)
        self.place[seen] = np.arange(1, len(seen) + 1)
        self.table = np.empty((len(seen) + 1, DIM), np.float32)
        for at in range(0, len(self.table), 1 << 16):  # the numbers drawn are twice as long
            own = self.table[at : at + (1 << 16)]
            own[...] = rng.normal(0, 0.3, own.shape)
        self.table[0] = 0
        self.filters = [rng.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shifts = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.weights = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(0)

    def projected(self, rows):
        """For each width the rows times each row block of its filters: a response is a sum of looked-up rows."""
        return [[rows @ f[k * DIM : (k + 1) * DIM] for k in range(w)] for w, f in zip(WIDTHS, self.filters)]

    def pooled(self, ids, starts, tables, where=False):
        """Greatest response (at least zero) of every filter in every document, and where it is.

        ``ids`` are the documents' rows end to end, each followed by zeros for the widest filter.
        """
        values, places = [], []
        for w, tables_w, shift in zip(WIDTHS, tables, self.shifts):
            out = tables_w[0][ids]
            for k in range(1, w):
                out[:-k] += tables_w[k][ids[k:]]
            best = np.maximum.reduceat(out, starts, axis=0)
            if where:
                ends = np.append(starts[1:], len(ids))
                places.append(np.stack([s + out[s:e].argmax(axis=0) for s, e in zip(starts, ends)]))
            values.append(np.maximum(best + shift, 0))
        return np.concatenate(values, axis=1), places

    def scores(self, ids, starts):
        """Scores of documents. Only the rows at hand are projected; projections of all would take several times the table's memory."""
        used, local = np.unique(ids, return_inverse=True)
        return 1 / (1 + np.exp(-(self.pooled(local, starts, self.projected(self.table[used]))[0] @ self.weights + self.bias).astype(np.float64)))


def joined(lists):
    """Documents end to end with the starts of each; each is followed by zeros, so none is empty."""
    pad = np.zeros(max(WIDTHS), np.int32)
    parts = [x for ids in lists for x in (ids, pad)]
    sizes = np.array([len(ids) + len(pad) for ids in lists])
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes[:-1])))


def log_odds(toxic, holders, share):
    """Shrunken log-odds of toxic documents among a word's holders, against those among all."""
    p = (toxic + SHRUNK * share) / (holders + SHRUNK)
    return (np.log(p / (1 - p)) - np.log(share / (1 - share))).astype(np.float32)


def counted(lists, labels):
    """Documents that hold each bucket, and toxic ones among them."""
    holders, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for ids, label in zip(lists, labels):
        own = np.unique(ids)
        holders[own] += 1
        toxic[own] += label
    return holders, toxic


def started(holders, toxic, share, seed=5):
    """(classifier before training, log-odds of its rows for documents of label 0 and 1) from the counts of all documents and their toxic share."""
    model = Classifier(holders, seed)
    holders, toxic = (np.concatenate(([0], x[holders > 1])) for x in (holders, toxic))
    share = min(max(float(share), 1e-3), 1 - 1e-3)
    model.table *= np.minimum(1, holders / LEARNED)[:, None].astype(np.float32)  # the less is known of a word, the nearer to zero it starts
    model.table[:, 0] = log_odds(toxic, holders, share)  # a start from which max pooling finds words that tell
    model.table[0] = 0
    # by label: what a document with it sees of its words
    others = [log_odds(np.maximum(toxic - label, 0), np.maximum(holders - 1, 0), share) for label in (0, 1)]
    for o in others:
        o[0] = 0
    for filters, shift in zip(model.filters, model.shifts):
        filters[:, : FILTERS // 2] *= 0.1
        filters[::DIM, : FILTERS // 2] = 1
        shift[: FILTERS // 2] = -SILENT
    model.weights.reshape(len(WIDTHS), FILTERS)[:, : FILTERS // 2] = SLOPE / (FILTERS // 2 * len(WIDTHS))
    model.bias = np.float32(np.log(share / (1 - share)))
    return model, others


def learned(model, others, lists, labels, seed=5) -> Classifier:
    """The classifier after training on lists of buckets and their 0/1 labels by Adagrad on the log loss."""
    rng = np.random.default_rng(seed)
    lists = [model.place[ids] for ids in lists]
    labels = np.asarray(labels, np.float32)
    parts = [model.table, *_dense(model)]
    squares = [np.full_like(p, 1e-2) for p in parts]
    bias_square = 1e-2
    for _ in range(EPOCHS):
        order = rng.permutation(len(lists))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            ids, starts = joined([lists[i] for i in own])
            # only the rows at hand are projected, once for each label
            keys = 2 * ids + np.repeat(labels[own].astype(np.int32), np.diff(np.append(starts, len(ids))))
            keys, local = np.unique(keys, return_inverse=True)
            used = keys >> 1
            held = model.table[used]
            held[:, 0] = np.where(keys & 1, others[1][used], others[0][used])
            small = model.projected(held)
            values, places = model.pooled(local, starts, small, where=True)
            p = 1 / (1 + np.exp(-(values @ model.weights + model.bias)))
            error = ((p - labels[own]) / len(own)).astype(np.float32)
            back = error[:, None] * model.weights * (values > 0)
            table_grad = np.zeros((len(used), DIM), np.float32)
            grads_f, grads_s = [], []
            for j, w in enumerate(WIDTHS):
                g = back[:, j * FILTERS : (j + 1) * FILTERS]
                grad_f = np.zeros_like(model.filters[j])
                for k in range(w):
                    spot = local[np.minimum(places[j] + k, len(local) - 1)]
                    rows = held[spot]
                    grad_f[k * DIM : (k + 1) * DIM] = np.einsum("df,dfe->ef", g, rows)
                    np.add.at(table_grad, spot.ravel(), (g[:, :, None] * model.filters[j][k * DIM : (k + 1) * DIM].T[None]).reshape(-1, DIM))
                grads_f.append(grad_f + DECAY * model.filters[j])
                grads_s.append(g.sum(axis=0))
            words, first = np.unique(used, return_index=True)
            table_grad = np.add.reduceat(table_grad, first, axis=0) + DECAY * model.table[words]
            table_grad[:, 0] = 0  # the log-odds stay
            table_grad[words == 0] = 0
            squares[0][words] += table_grad**2
            model.table[words] -= RATE * table_grad / np.sqrt(squares[0][words])
            for part, square, grad in zip(parts[1:], squares[1:], [*grads_f, *grads_s, values.T @ error + DECAY * model.weights]):
                square += grad**2
                part -= RATE * grad / np.sqrt(square)
            bias_square += float(error.sum()) ** 2
            model.bias -= np.float32(RATE * error.sum() / np.sqrt(bias_square))
    return model


CUTS = np.arange(0.02, 0.981, 0.02)


def right_at(cuts, scores, labels, weights):
    """Share of right decisions at each cut, by weight."""
    right = (scores[:, None] >= cuts) == (labels[:, None] == 1)
    return weights @ right / max(weights.sum(), 1e-12)


def thresholds(scores, labels, langs, weights=None) -> dict:
    """Threshold of each language, and of all under None: the cut with the most right decisions.

    A language's decisions count together with ``PRIOR`` decisions of all, so few documents move its
    cut little. On a tie the cut nearest to 0.5 is taken.
    """
    scores, labels, langs = np.asarray(scores), np.asarray(labels), np.array([x or "" for x in langs])
    weights = np.ones(len(scores)) if weights is None else np.asarray(weights, float)
    cuts = CUTS
    overall = right_at(cuts, scores, labels, weights)

    def best(right):
        return float(min(cuts[right >= right.max() - 1e-12], key=lambda c: abs(c - 0.5)))

    found = {None: best(overall)}
    for lang in np.unique(langs):
        own = langs == lang
        found[str(lang)] = best(weights[own].sum() * right_at(cuts, scores[own], labels[own], weights[own]) + PRIOR * overall)
    return found


def slices(batches):
    """The batches in parts of ``ROWS_AT_ONCE`` rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def fold(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def _learning(docs, labels, doc_id, text):
    """A written table of the labelled documents outside the held-out fold: row number, language, label, if kept from training, buckets of the words."""
    import pyarrow as pa

    ids = written(labels.filter(labels["toxic"].isNotNull() & (fold(labels["doc_id"]) != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    lang = F.coalesce(docs["lang"], F.lit("")) if "lang" in docs.columns else F.lit("")
    texts = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[doc_id]).alias("hash"), F.coalesce(docs[text], F.lit("")).alias("text"), lang.alias("lang"))
    kinds = dict(texts.dtypes)
    bits = _bits(ids) if dict(ids.dtypes)["doc_id"] == kinds["doc_id"] else None
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        known, bits = remembered("toxicity words", bucket), shared.value
        for batch in slices(batches):
            known.trimmed()
            if bits is not None:
                at = batch.column(1).to_numpy(zero_copy_only=False) & (BITS - 1)
                batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            ids = pa.array([buckets_of(x, known) for x in column(batch, "text")], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), ids], ["doc_id", "lang", "ids"])

    # labels grow with the texts, so the join is by a shuffle at all sizes; no more than labelled texts go through it
    rows = texts.mapInArrow(run, f"doc_id {kinds['doc_id']}, lang string, ids array<int>").join(ids.hint("merge"), "doc_id")
    kept = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "lang", "toxic", kept.alias("kept"), "ids"))


def _bits(ids):
    """One bit of ``BITS``, eight to a number, for the hash of every id: a text without its bit has no label."""
    at = F.xxhash64("doc_id").bitwiseAND(BITS - 1)
    words = ids.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("1L << cast(at & 31 as int)")).alias("bits")).toArrow()  # BITS / 32 rows at most
    bits = np.zeros(BITS // 32, "<u4")
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype("<u4")
    return bits.view(np.uint8)


def _lists(batch):
    """Buckets of each document of an Arrow batch or table, and the labels."""
    return list(batch.column(batch.schema.get_field_index("ids")).to_numpy(zero_copy_only=False)), column(batch, "toxic")


def _dense(model):
    return [*model.filters, *model.shifts, model.weights]


def _counts(rows):
    """(holders, toxic holders) of every bucket, summed up in tasks first."""
    import pyarrow as pa

    def run(batches):
        sums = np.zeros((2, BUCKETS))
        for batch in batches:
            sums += counted(*_lists(batch))
        seen = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(x[seen]) for x in sums]], ["bucket", "holders", "toxic"])

    counts = rows.select("ids", "toxic").mapInArrow(run, "bucket long, holders double, toxic double").groupBy("bucket").agg(F.sum("holders").alias("holders"), F.sum("toxic").alias("toxic"))
    found, sums = counts.filter("holders > 1").toArrow(), np.zeros((2, BUCKETS))  # BUCKETS rows at most
    for own, name in zip(sums, ("holders", "toxic")):
        own[found["bucket"].to_numpy()] = found[name].to_numpy()
    return sums


def _averaged(rows, start, documents, size):
    """The classifier trained on all rows, by parts of some ``size`` documents. Parts send rows of ``DIM`` numbers: those of their words,
    by place, and the filters and the logistic layer under negative places."""
    import pyarrow as pa

    shared, names = rows.sparkSession.sparkContext.broadcast(start), [f"v{k}" for k in range(DIM)]

    def run(group):
        lists, labels = _lists(group)
        model, others = started(*shared.value)
        model = learned(model, others, lists, labels)
        held = np.bincount(np.concatenate([np.unique(model.place[ids]) for ids in lists]), minlength=len(model.table)) if lists else np.zeros(len(model.table), int)
        held[0] = 0
        dense = np.concatenate([x.ravel() for x in (*_dense(model), np.array([model.bias]))])
        dense = np.pad(dense, (0, -len(dense) % DIM)).reshape(-1, DIM)
        own = np.flatnonzero(held)
        places, counts = np.concatenate((own, -1 - np.arange(len(dense)))), np.concatenate((held[own], np.full(len(dense), len(lists))))
        values = np.concatenate((model.table[own], dense), dtype=np.float32)
        return pa.Table.from_arrays([pa.array(places.astype(np.int64)), pa.array(counts.astype(np.float64)), *[pa.array(v) for v in values.T]], ["place", "n", *names])

    parts = F.pmod(F.xxhash64("row"), F.lit(max(1, math.ceil(documents / size))))
    trained = rows.withColumn("part", parts).select("part", "ids", "toxic").groupBy("part").applyInArrow(run, "place long, n double, " + ", ".join(f"{v} float" for v in names))
    means = trained.groupBy("place").agg(*[(F.sum(F.col("n") * F.col(v)) / F.sum("n")).cast("float").alias(v) for v in names]).toArrow()  # BUCKETS rows and the filters' at most
    places, values = means["place"].to_numpy(), np.stack([means[v].to_numpy() for v in names], axis=1)
    model = started(*start)[0]
    model.table[places[places > 0]] = values[places > 0]
    dense = values[places < 0][np.argsort(-places[places < 0])].ravel()
    for part in _dense(model):
        part[...], dense = dense[: part.size].reshape(part.shape), dense[part.size :]
    model.bias = np.float32(dense[0])
    return model


def fit(docs: DataFrame, labels: DataFrame, sample=PART, doc_id="doc_id", text="text"):
    """(classifier, thresholds) from all labels outside the held-out fold; a task trains on some ``sample`` documents."""
    import pyarrow as pa

    rows = _learning(docs, labels, doc_id, text)
    used = rows.filter("NOT kept")
    documents, toxic = used.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    start = (*_counts(used), toxic / documents if documents else 0.5)
    if not documents:
        return started(*start)[0], {None: 0.5}
    model = _averaged(used, start, documents, sample)
    ready = _scorer(docs.sparkSession, model, from_ids=True)

    def run(batches):
        scores = ready()
        for batch in batches:
            at = np.searchsorted(CUTS, scores(_lists(batch)[0]), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(at.astype(np.int32))], ["lang", "toxic", "cuts"])

    passed = rows.filter("kept").select("lang", "toxic", "ids").mapInArrow(run, "lang string, toxic int, cuts int").groupBy("lang", "toxic", "cuts").count().collect()  # languages x labels x cuts at most
    if not passed:
        return model, {None: 0.5}
    return model, thresholds([CUTS[r.cuts - 1] if r.cuts else 0 for r in passed], [r.toxic for r in passed], [r.lang for r in passed], [r["count"] for r in passed])


#: Words scored at once, and rows read at once.
WORDS_AT_ONCE, ROWS_AT_ONCE = 200_000, 1000


def _scorer(spark, model, from_ids=False):
    """Function from texts, or their buckets, to scores, for use in tasks."""
    shared = spark.sparkContext.broadcast(model.__dict__)

    def ready():
        own = Classifier.__new__(Classifier)
        own.__dict__ |= shared.value
        known = remembered("toxicity words", bucket)

        def scores(texts):
            known.trimmed()
            found, lists, size = [np.empty(0)], [], 0
            for text in texts:
                lists.append(own.place[text if from_ids else buckets_of(text or "", known)])
                size += len(lists[-1])
                if size > WORDS_AT_ONCE:
                    found.append(own.scores(*joined(lists)))
                    lists, size = [], 0
            if lists:
                found.append(own.scores(*joined(lists)))
            return np.concatenate(found)

        return scores

    return ready


def score(docs: DataFrame, fitted, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, rejected) of every row of ``docs``.

    A text without words (null, empty) has the score of the logistic layer's constant. ``rejected`` holds
    the score against the threshold of the row's language, or of all for a language without its own.
    Repeated rows stay. Without labels all scores are about even.
    """
    import pyarrow as pa

    model, cuts = fitted
    ready = _scorer(docs.sparkSession, model)

    def run(batches):
        scores = ready()
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores(column(batch, "text")))], [*batch.schema.names[:-1], "score"])

    lang = docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(docs[doc_id].alias("doc_id"), lang.alias("lang"), F.coalesce(docs[text], F.lit("")).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang string, score double")
    cut = F.lit(cuts[None])
    for name, value in cuts.items():
        if name is not None:
            cut = F.when(F.coalesce("lang", F.lit("")) == name, value).otherwise(cut)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         cut.alias("threshold"), (F.col("score") >= cut).alias("rejected"))


def accepted(docs: DataFrame, fitted, text="text", lang="lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    import pyarrow as pa

    model, cuts = fitted
    ready = _scorer(docs.sparkSession, model)

    def run(batches):
        scores = ready()
        for batch in slices(batches):
            limits = np.array([cuts.get(x or "", cuts[None]) for x in column(batch, lang)])
            yield batch.filter(pa.array(scores(column(batch, text)) < limits, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
