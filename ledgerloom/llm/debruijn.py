"""Substring dedup on a De Bruijn graph of token k-mers.

The k-mers are windows of ``length`` words; each is an edge from its first to its last ``length`` - 1 words.
Most of the graph needs no rows: windows that share an anchor (see anchors.py) follow each other, and
an anchor whose gram has one content only is a path without branches whatever its number of copies. Such
blocks are single compacted edges. Where one gram has several contents, the graph may branch, and its
windows become edges of their own.

Repeated edges are compacted further: an edge is joined to the one that follows it wherever it occurs, if
there it has one successor only and is that one's only predecessor. Pointer doubling over these joins
names each path by its first edge, and gives each edge its place in it. Source coordinates verify the
paths: occurrences of a path's edges that follow each other in a text, each starting where the one before
ends, make up one span.
"""

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import anchors
from ledgerloom.llm.common import column
from ledgerloom.llm.repeats import blocks, contents, repeated, runs_of, stored, unpacker, with_texts
from ledgerloom.sources.sinks import written

LENGTH, GRAM = 35, 16


def word_symbols(text: bytes):
    words = text.split()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def _edges(length):
    """The windows of each content as edges named by the hash of their words."""
    import pyarrow as pa

    names = ["rid", "first", "copies", "key", "block", "edge"]

    def run(batches):
        unpack = unpacker()
        for batch in batches:
            made = []
            for rid, blob, rows in zip(*(column(batch, n) for n in ("rid", "blob", "rows"))):
                words = unpack(blob).split()
                for r in rows:
                    for at in range(r["first"], r["first"] + r["windows"]):
                        digest = hashlib.blake2b(b" ".join(words[at : at + length]), digest_size=16).digest()
                        made.append((rid, at, r["copies"], r["key"], r["block"], digest))
                if len(made) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), kinds)], names)
                    made = []
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), kinds)], names)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return run


def repeated_edges(table: DataFrame, length: int, gram: int) -> DataFrame:
    """(rid, first, windows, edge): occurrences of the edges that occur more than once, compacted by blocks."""
    found = repeated(blocks(table, word_symbols, length, gram))
    name = F.xxhash64("key", "block").alias("edge")
    mixed = found.filter("mixed").drop("mixed", "earliest")
    each = contents(mixed, 0).drop("crowded")
    # a content that occurs more than once stays one edge wherever it does; its windows count for the others
    several = mixed.join(each.filter("copies > 1").select("key", "block"), ["key", "block"]).select("rid", "first", "windows", name)
    single = written(with_texts(each, table).select("rid", "blob", "rows").mapInArrow(
        _edges(length), "rid long, first int, copies long, key long, block long, edge binary"))
    again = single.groupBy("edge").agg(F.count("*").alias("n")).filter("n > 1")
    windows = single.filter("copies = 1").join(again, "edge").select("rid", "first", F.lit(1).alias("windows"), F.xxhash64("edge").alias("edge"))
    return found.filter("NOT mixed").select("rid", "first", "windows", name).unionByName(several).unionByName(windows)


def paths(occurrences: DataFrame) -> DataFrame:
    """(edge, path, place): edges compacted to paths without branches.

    An edge links to the next one if everywhere it is followed by that one at once, and that one
    preceded by it. Links are doubled by joins until none moves. There are no rings: the last edge of
    a text is not followed everywhere.
    """
    order = Window.partitionBy("rid").orderBy("first")
    seen = occurrences.select(
        "edge", F.when(F.lead("first").over(order) == F.col("first") + F.col("windows"), F.lead("edge").over(order)).alias("after"))
    pairs = written(seen.groupBy("edge", "after").agg(F.count("*").alias("n")))
    total = pairs.groupBy("edge").agg(F.count("*").alias("ways"), F.sum("n").alias("n"), F.first("after").alias("after"))
    into = pairs.filter("after IS NOT NULL").groupBy("after").agg(F.count("*").alias("ways_in"), F.sum("n").alias("came"))
    # an occurrence of an edge that does not follow its predecessor is one more way into it
    alone = into.join(total.select(F.col("edge").alias("after"), "n"), "after").filter("ways_in = 1 AND came = n").select("after")
    onward = total.filter("ways = 1 AND after IS NOT NULL AND after <> edge")
    links = written(onward.join(alone, "after").select(F.col("after").alias("edge"), F.col("edge").alias("path"), F.lit(1).cast("long").alias("place")))
    while True:
        above = links.select(F.col("edge").alias("path"), F.col("path").alias("path_2"), F.col("place").alias("place_2"))
        moved = written(links.join(above, "path", "left"))
        if not moved.filter("path_2 IS NOT NULL").limit(1).count():
            return links
        links = moved.select("edge", F.coalesce("path_2", "path").alias("path"), (F.col("place") + F.coalesce("place_2", F.lit(0))).alias("place"))


def spans(occurrences: DataFrame) -> DataFrame:
    """(rid, first, windows): runs of occurrences that follow a path edge by edge, by their coordinates."""
    named = occurrences.join(paths(occurrences), "edge", "left").select(
        "rid", "first", "windows", F.coalesce("path", "edge").alias("path"), F.coalesce("place", F.lit(0)).alias("place"))
    order = Window.partitionBy("rid").orderBy("first")
    goes_on = (F.lag("path").over(order) == F.col("path")) & (F.lag("place").over(order) + 1 == F.col("place")) & (
        F.lag(F.col("first") + F.col("windows")).over(order) == F.col("first"))
    runs = named.withColumn("run", F.sum(F.when(goes_on, 0).otherwise(1)).over(order))
    return runs.groupBy("rid", "run").agg(F.min("first").alias("first"), F.sum("windows").cast("int").alias("windows")).drop("run")


def removals(docs: DataFrame, length=LENGTH, gram=GRAM, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``.

    Every word in a window of ``length`` words that also starts elsewhere (in any row, this one included) goes; the
    hash is that of the others, joined by a space. Null texts have no words; texts shorter than a window
    keep all; repeated rows are copies of each other.
    """
    import pyarrow as pa

    def run(batches):
        unpack = unpacker()
        for batch in batches:
            made = []
            for blob, (first, windows) in zip(column(batch, "blob"), runs_of(batch)):
                words = unpack(blob).split()
                starts, ends = anchors.merged(first, first + windows + length - 1)
                edges = [0, *np.stack((starts, ends), 1).ravel().tolist(), len(words)]
                kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                made.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*made)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    table = stored(docs, doc_id, text)
    found = spans(written(repeated_edges(table, length, gram)))
    lists = found.groupBy("rid").agg(F.collect_list(F.struct("first", "windows")).alias("rows"))
    rows = table.join(lists, "rid", "left").select("doc_id", "blob", "rows")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string")
