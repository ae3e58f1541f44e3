"""Blocks of windows that may occur again: the first half of the suffix-array and the De Bruijn dedup."""

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import anchors
from ledgerloom.llm.common import column
from ledgerloom.sources.sinks import written

#: Row numbers of a part of the table; the part's number stands above.
ROW_BITS = 36


def stored(docs: DataFrame, doc_id="doc_id", text="text", keep=()) -> DataFrame:
    """(rid, doc_id, blob): every row with a number of its own and its compressed UTF-8 text, written once;
    with a struct ``kept`` of further columns, if any are asked for.

    Later passes read this table, so numbers hold even if the input would be dealt out otherwise again.
    """
    import pyarrow as pa

    def run(batches):
        import zstandard

        pack, rid = zstandard.ZstdCompressor(level=3).compress, TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            blobs = [pack(x.encode("utf-8", "surrogatepass")) for x in column(batch, "text")]
            ids = pa.array(range(rid, rid + len(blobs)), pa.int64())
            rid += len(blobs)
            yield pa.RecordBatch.from_arrays([ids, batch.column(0), pa.array(blobs, pa.binary()), *batch.columns[2:]], ["rid", "doc_id", "blob", *batch.schema.names[2:]])

    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"), *([F.struct(*[docs[c] for c in keep]).alias("kept")] if keep else []))
    kinds = dict(rows.dtypes)
    return written(rows.mapInArrow(run, f"rid long, doc_id {kinds['doc_id']}, blob binary" + (f", kept {kinds['kept']}" if keep else "")))


def unpacker():
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def blocks(table: DataFrame, values, length: int, gram: int) -> DataFrame:
    """(rid, first, windows, key, block): the blocks of every text; ``values`` turns its bytes into symbols."""
    import numpy as np
    import pyarrow as pa

    names = ["rid", "first", "windows", "key", "block"]

    def run(batches):
        unpack, powers = unpacker(), anchors.powers()
        for batch in batches:
            rows, parts = [], []
            for rid, blob in zip(column(batch, "rid"), column(batch, "blob")):
                found = anchors.blocks(values(unpack(blob)), length, gram, powers)
                rows.append(np.full(len(found[0]), rid, np.int64))
                parts.append(found)
            if parts:
                first, windows, key, block = map(np.concatenate, zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((np.concatenate(rows), first, windows, key, block), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names)

    return table.select("rid", "blob").mapInArrow(run, "rid long, first int, windows int, key long, block long")


def repeated(found: DataFrame) -> DataFrame:
    """Blocks whose anchor occurs again, as a written table, with

    mixed: blocks of more than one content have the anchor; earliest: none of the anchor comes before.
    Counts are summed up in tasks before they are shuffled, so a frequent anchor is no large group.
    """
    keys = found.groupBy("key").agg(
        F.count("*").alias("n"), F.min("block").alias("low"), F.max("block").alias("high"), F.min(F.struct("rid", "first")).alias("least"),
    ).filter("n > 1").select("key", (F.col("low") != F.col("high")).alias("mixed"), "least")
    return written(found.join(keys, "key").select(
        "rid", "first", "windows", "key", "block", "mixed", (F.struct("rid", "first") == F.col("least")).alias("earliest")))


def contents(mixed: DataFrame, crowd: int) -> DataFrame:
    """One row for each content of the mixed anchors: how often it occurs, where first, and if its anchor
    has more than ``crowd`` contents."""
    each = mixed.groupBy("key", "block").agg(F.count("*").alias("copies"), F.min(F.struct("rid", "first", "windows")).alias("at"))
    crowded = each.groupBy("key").agg((F.count("*") > crowd).alias("crowded"))
    return written(each.join(crowded, "key").select("key", "block", "copies", "at.*", "crowded"))


def with_texts(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows of each text as a list beside it; texts without any are left out."""
    lists = rows.groupBy("rid").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "rid"])).alias("rows"))
    return table.join(lists, "rid")


def runs_of(batch):
    """(first, windows) of every row's list ``rows`` in an Arrow batch, as arrays; a null list has none."""
    lists = batch.column(batch.schema.get_field_index("rows"))
    flat = lists.flatten()
    first, windows = (flat.field(c).to_numpy(zero_copy_only=False).astype("int64") for c in ("first", "windows"))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at = 0
    for size in sizes.tolist():
        yield first[at : at + size], windows[at : at + size]
        at += size
