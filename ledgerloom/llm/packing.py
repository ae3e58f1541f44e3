"""Packing: all documents end to end, cut into sequences of a fixed length.

First pass: every task encodes its rows once and writes their ids with the number of tokens before
them in its part of the table (a running sum inside the task). The parts' totals, one row for each
task, are summed up in order, which gives every part its place in the whole. Second pass: a row's
place is its part's plus its own, and the row is cut where a sequence ends. Nothing is encoded twice
and nothing is sorted; a lost executor repeats its own rows.
"""

import zlib
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import column, whole_texts
from ledgerloom.llm.encoding import byte_encoder, remembered, spaced_pieces
from ledgerloom.sources.sinks import written

LENGTH = 1024
#: Ids are kept as these; vocabularies of up to 65,536 ids only.
KIND = "<u2"


def id_bytes(ids) -> bytes:
    return array("H", ids).tobytes()


def token_rows(docs: DataFrame, vocabulary: str, ranks: str, end_id: int, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, part, before, ids): the ids of each row and the end id, as little-endian 16-bit
    integers; ``before`` counts the tokens before the row in its part."""
    import pyarrow as pa

    end = id_bytes([end_id])

    def run(batches):
        encode = byte_encoder(ranks, vocabulary)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            value = remembered((vocabulary, "ids"), lambda piece: id_bytes(encode(piece))).__getitem__
            blobs = [b"".join(map(value, spaced_pieces(x))) + end for x in column(batch, "text")]
            starts = before + np.concatenate(([0], np.cumsum([len(x) // 2 for x in blobs])))
            before = int(starts[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(blobs), pa.int32()), pa.array(starts[:-1], pa.int64()), pa.array(blobs, pa.binary())],
                ["doc_id", "part", "before", "ids"])

    rows = whole_texts(docs, doc_id, text)
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, part int, before long, ids binary")


def pieces(tokens: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces of the rows of ``token_rows``: where each lies in its document and in its sequence."""
    import pyarrow as pa

    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.octet_length("ids") / 2).cast("long").alias("total"))
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").select(  # one row of two numbers for each task of the first pass
        "doc_id", (F.col("base") + F.col("before")).alias("place"), "ids")

    def cut(batches):
        for batch in batches:
            rows, starts, sizes, sums, totals, places = [], [], [], [], [], []
            for k, (place, blob) in enumerate(zip(column(batch, "place"), column(batch, "ids"))):
                ids = np.frombuffer(blob, KIND).astype("<u4")
                ends = [*range(length - place % length, len(ids), length), len(ids)]
                for a, b in zip([0, *ends], ends):
                    rows.append(k)
                    starts.append(a)
                    sizes.append(b - a)
                    sums.append(zlib.crc32(ids[a:b]))
                    totals.append(len(ids))
                    places.append(place + a)
            spots = np.array(places, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int32())), *(pa.array(x, pa.int64()) for x in (starts, sizes, sums, totals, spots // length, spots % length))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = dict(placed.dtypes)["doc_id"]
    return placed.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary="byte_bpe_50k.json", ranks="byte_bpe_50k.tiktoken", end_id=0, length=LENGTH, doc_id="doc_id", text="text") -> DataFrame:
    """One row for each piece of each row of ``docs``.

    A null or empty text is its end token alone. Repeated rows are packed again. All sequences but
    the last are full; the last holds what is left. No rows give no pieces. The order of documents
    is that in which the input is read.
    """
    return pieces(written(token_rows(docs, vocabulary, ranks, end_id, doc_id, text)), length)
