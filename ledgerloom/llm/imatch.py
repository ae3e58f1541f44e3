"""I-Match fingerprints over randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band, so neither everyday
words nor rare ones and slips matter. Each fingerprint part is the hash of a document's sorted
distinct terms in one random subset of the lexicon; subsets come in several densities, so that short
and long documents both have parts that small edits leave alone. The likeness of two fingerprints is
the share of equal parts among those that are not empty in both.

The band's upper end bounds the lexicon: a term in a share f of the documents takes f of all (document,
term) pairs, so there are at most (mean distinct terms of a document) / f such terms, whatever the size
of the corpus. That is what goes to the driver and to every task.
"""

import hashlib
import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column, whole_texts

#: Inverse document frequency, as -ln of the share of documents that hold a term.
BAND = (math.log(10), math.log(2000))
#: Of the lexicon, for the subsets of each density.
DENSITIES, SUBSETS = (32, 128, 512), 16
FLUSH = 300_000
HEX = 4


def terms(text: str) -> set[str]:
    return set(text.lower().split())


def document_frequencies(rows: DataFrame) -> DataFrame:
    """(term, n): in how many rows of (doc_id, text) each term occurs; summed up in tasks first."""
    import pyarrow as pa
    from collections import Counter

    def run(batches):
        counts = Counter()
        for batch in batches:
            for text in column(batch, "text"):
                counts.update(terms(text))
                if len(counts) > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
                    counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(rows: DataFrame, band=BAND) -> list[str]:
    """Terms in the band, in code point order."""
    total = rows.count()
    low, high = total * math.exp(-band[1]), total * math.exp(-band[0])
    return sorted(x.term for x in document_frequencies(rows).filter(F.col("n").between(low, high)).select("term").collect())


class Lexicons:
    """For each term the subsets it is in, drawn from a hash of seed and term."""

    def __init__(self, words, seed=11):
        self.parts = {}
        for word in words:
            bits = xxhash.xxh128_intdigest(word, seed)
            own = [d * SUBSETS + i for d, density in enumerate(DENSITIES) for i in [(bits >> (32 * d)) % density] if i < SUBSETS]
            self.parts[word] = own, xxhash.xxh64_intdigest(word, seed)
        self.words = self.parts.keys()

    def fingerprint(self, text: str) -> str:
        """Hash of each subset's terms in the text, in hexadecimal; empty ones are blank (``-``).

        A text without terms in the lexicon has one part more, the hash of all its terms, so that
        such texts are alike only if their terms are.
        """
        found = terms(text)
        lists = {}
        for word in sorted(found & self.words):
            own, digest = self.parts[word]
            for i in own:
                lists.setdefault(i, []).append(digest)
        shown = [xxhash.xxh64_hexdigest(np.array(lists[i], np.uint64).tobytes())[:HEX] if i in lists else "-" * HEX for i in range(len(DENSITIES) * SUBSETS)]
        rest = "" if lists else xxhash.xxh64_hexdigest("\0".join(sorted(found)))[: 4 * HEX]
        return "".join(shown) + rest


def likeness(a: str, b: str) -> float:
    """Share of equal parts among those filled in either; equal fingerprints are fully alike."""
    if a == b:
        return 1.0
    pairs = [(a[i : i + HEX], b[i : i + HEX]) for i in range(0, HEX * len(DENSITIES) * SUBSETS, HEX)]
    filled = [x == y for x, y in pairs if x != "-" * HEX or y != "-" * HEX]
    return sum(filled) / len(filled) if filled else 0.0


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much (or all) of the start of the one that follows."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def ordered_buckets(ids: DataFrame, rows_each: int, most: int):
    """Cuts of doc_id into slices of about equal size, and each slice's greatest doc_id; both by slice.

    Slice k holds ids up to cut k (and above cut k-1); what is null lies below all, in slice -1.
    """
    total = ids.count()
    n = min(total // rows_each + 1, most)
    cuts = []
    if n > 1:
        cuts = ids.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100_000)).first()[0] or []
    cuts = sorted(set(cuts))
    ends = np.array(cuts, np.int64)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            own = column(batch, "doc_id")
            yield pa.RecordBatch.from_arrays([pa.array([_slice(ends, x) for x in own], pa.int32()), batch.column(0)], ["slice", "doc_id"])

    heads = ids.mapInArrow(run, "slice int, doc_id long").groupBy("slice").agg(F.max("doc_id").alias("head")).collect()
    return cuts, {x.slice: x.head for x in heads}


def _slice(ends, doc_id):
    """0, 1, ... by how many cuts lie below doc_id; -1 for null."""
    return -1 if doc_id is None else int(np.searchsorted(ends, doc_id))


def fingerprints(docs: DataFrame, band=BAND, seed=11, rows_each=4000, most=20_000, doc_id="doc_id", text="text") -> DataFrame:
    """Fingerprint of every row's text and of its edited text, with their likeness and that to the next row's.

    The next row is the one with the next smaller doc_id, null last; after the last comes the first.
    Equal doc_ids are ordered by their compressed texts; a single row follows itself. Null texts are
    empty. The order needs no global sort: ids are cut into slices, and each slice gets a copy of the
    row that follows it. Texts are shuffled once, compressed.
    """
    import pyarrow as pa

    rows = whole_texts(docs, doc_id, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    words = lexicon(rows, band)
    cuts, heads = ordered_buckets(rows.select("doc_id"), rows_each, most)
    order = sorted(heads, reverse=True)
    guest_of = {}  # doc_id of a slice's first row -> slice that it follows
    for before, after in zip(order, order[1:] + order[:1]):
        guest_of.setdefault(heads[after], []).append(before)
    shared = rows.sparkSession.sparkContext.broadcast((words, np.array(cuts, np.int64), guest_of))
    spread = rows.sparkSession.sparkContext.defaultParallelism

    def compressed(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        _, ends, guests = shared.value
        for batch in batches:
            ids, slices, late, blobs = [], [], [], []
            for own, text in zip(column(batch, "doc_id"), column(batch, "text")):
                blob = pack(text.encode("utf-8", "surrogatepass"))
                for place, guest in [(_slice(ends, own), False), *((s, True) for s in guests.get(own, ()))]:
                    ids.append(own)
                    slices.append(place)
                    late.append(guest)
                    blobs.append(blob)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(slices, pa.int32()), pa.array(late, pa.bool_()), pa.array(blobs, pa.binary())], ["doc_id", "slice", "guest", "blob"])

    def printed(batches):
        import zstandard

        unpack, own = zstandard.ZstdDecompressor().decompress, Lexicons(shared.value[0], seed)
        last, place, done = None, None, []
        for batch in batches:
            for doc, slice_, guest, blob in zip(*(column(batch, n) for n in ("doc_id", "slice", "guest", "blob"))):
                if slice_ != place:
                    last, place = None, slice_
                elif last is None:
                    continue  # further rows tied with the guest
                text = unpack(blob).decode("utf-8", "surrogatepass")
                shown = own.fingerprint(text)
                if last:
                    changed = edited(last[1], text)
                    print_ = own.fingerprint(changed)
                    done.append((last[0], len(last[1]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), last[2], print_, likeness(last[2], print_), likeness(last[2], shown)))
                last = None if guest else (doc, text, shown)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done) if done else [()] * 7, kinds)], names)
            done = []

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    dealt = rows.mapInArrow(compressed, "doc_id long, slice int, guest boolean, blob binary").repartition(max(spread, len(heads)), "slice")
    ordered = dealt.sortWithinPartitions("slice", "guest", F.desc_nulls_last("doc_id"), "blob")
    return ordered.mapInArrow(printed, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
