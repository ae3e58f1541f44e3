"""Suffix-array dedup: longest previous factors find what has occurred before.

A position's longest previous factor is the longest string from there that also starts earlier. In
suffix order it is shared with the previous or the next entry of smaller position. Here only factors of
``length`` bytes matter: suffixes are ordered by so many bytes, those equal in all of them by position.
The previous entry is then also the previous smaller position, so a factor of full length exists where it
is equal, and where the next entry is, the same string starts again later.

The suffixes to sort are dealt out by anchors (see anchors.py), since suffixes equal in ``length`` bytes
have equal anchors: each task builds the arrays of whole anchors' suffixes. Before that, blocks of equal
content are counted by hash, and one of each stands for all. An anchor with very many contents is dealt
out by the hashes of its single suffixes instead, each a group of its own.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import anchors
from ledgerloom.llm.common import column
from ledgerloom.llm.repeats import blocks, contents, repeated, runs_of, stored, unpacker, with_texts
from ledgerloom.sources.sinks import written

LENGTH, GRAM = 200, 48
#: Bytes of text sorted at once; one anchor's may be more, up to CROWD contents.
SORTED, CROWD = 1 << 20, 4096


def byte_symbols(text: bytes):
    return anchors.BYTE_VALUES[np.frombuffer(text, np.uint8)]


def _ranks(*columns):
    """Dense ranks of the rows of some integer columns in lexicographic order."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def prefix_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Rank of each position's first ``length`` bytes among all such, by doubling; past the end is zero."""
    n, done = len(text), min(8, 1 << (length.bit_length() - 1))
    padded = np.concatenate((text, np.zeros(length + 8, np.uint8))).astype(np.uint64)
    head = np.zeros(n, np.uint64)
    for k in range(done):
        head = (head << np.uint64(8)) | padded[k : k + n]
    ranks = _ranks(head)
    while done < length:
        step = min(done, length - done)
        later = np.full(n, -1, np.int64)
        later[: max(n - step, 0)] = ranks[step:]
        ranks = _ranks(ranks * (n + 1) + later + 1)
        done += step
    return ranks


def factors(ranks, positions):
    """(previous, next): if the factor at each entry also starts at an earlier, at a later position.

    ``ranks`` are those of the entries' first bytes, ``positions`` tell which entry comes first.
    """
    order = np.lexsort((positions, ranks))
    same = ranks[order][1:] == ranks[order][:-1]
    before, after = np.zeros(len(order), bool), np.zeros(len(order), bool)
    before[order[1:]] = same
    after[order[:-1]] = same
    return before, after


def sorted_pieces(pieces, length):
    """For pieces (place, first, windows, bytes) the (place, first) of each window and its two flags."""
    texts = [np.frombuffer(p[3], np.uint8) for p in pieces]
    offsets = np.cumsum([0, *map(len, texts)])
    entry = np.concatenate([np.arange(p[2]) + at for p, at in zip(pieces, offsets)])
    owner = np.repeat(np.arange(len(pieces)), [p[2] for p in pieces])
    first = np.concatenate([np.arange(p[2]) + p[1] for p in pieces])
    order = np.lexsort((first, np.array([p[0] for p in pieces], np.int64)[owner]))
    positions = np.empty(len(order), np.int64)
    positions[order] = np.arange(len(order))
    before, after = factors(prefix_ranks(np.concatenate(texts), length)[entry], positions)
    return owner, first, before, after


def _cut(length):
    """Bytes of each content; for a crowded anchor the hashes of its windows."""
    import pyarrow as pa

    names = ["rid", "first", "windows", "copies", "key", "block", "piece"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        unpack = unpacker()
        for batch in batches:
            made = []
            for rid, blob, rows in zip(*(column(batch, n) for n in ("rid", "blob", "rows"))):
                text = unpack(blob)
                for r in rows:
                    piece = text[r["first"] : r["first"] + r["windows"] + length - 1]
                    if not r["crowded"]:
                        made.append((rid, r["first"], r["windows"], r["copies"], r["key"], None, piece))
                        continue
                    for k in range(r["windows"]):
                        digest = np.frombuffer(hashlib.blake2b(piece[k : k + length], digest_size=16).digest(), np.int64)
                        made.append((rid, r["first"] + k, 1, r["copies"], int(digest[0]), int(digest[1]), None))
                if len(made) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), kinds)], names)
                    made = []
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), kinds)], names)

    return run


def _sort(length, keep_first):
    """Windows of the pieces that go, as runs; pieces come in the order of their keys."""
    import pyarrow as pa

    def flush(pieces):
        owner, first, before, after = sorted_pieces(pieces, length)
        gone = before if keep_first else before | after
        owner, first = owner[gone], first[gone]
        head = np.concatenate(([True], (owner[1:] != owner[:-1]) | (first[1:] != first[:-1] + 1))) if len(owner) else np.empty(0, bool)
        at = np.flatnonzero(head)
        size = np.diff(np.concatenate((at, [len(owner)])))
        rids = np.array([p[0] for p in pieces], np.int64)[owner[at]]
        return pa.RecordBatch.from_arrays([pa.array(rids), pa.array(first[at], pa.int32()), pa.array(size, pa.int32())], ["rid", "first", "windows"])

    def run(batches):
        pieces, size, key = [], 0, None
        for batch in batches:
            for rid, first, windows, own, piece in zip(*(column(batch, n) for n in ("rid", "first", "windows", "key", "piece"))):
                if size > SORTED and own != key:
                    yield flush(pieces)
                    pieces, size = [], 0
                key, size = own, size + len(piece)
                pieces.append((rid, first, windows, piece))
        if pieces:
            yield flush(pieces)

    return run


def removed_windows(table: DataFrame, length=LENGTH, gram=GRAM, keep_first=False) -> DataFrame:
    """(rid, first, windows): runs of windows that occur elsewhere, or earlier if the first is kept."""
    run_schema = "rid long, first int, windows int"
    found = repeated(blocks(table, byte_symbols, length, gram))
    alike = found.filter("NOT mixed" + " AND NOT earliest" * keep_first).select("rid", "first", "windows")
    mixed = found.filter("mixed").drop("mixed", "earliest")
    each = contents(mixed, CROWD)
    several = mixed.join(each.filter("copies > 1").select("key", "block", F.col("rid").alias("rid_1"), F.col("first").alias("first_1")), ["key", "block"])
    if keep_first:
        several = several.filter("NOT (rid = rid_1 AND first = first_1)")
    pieces = written(with_texts(each.drop("block"), table).select("rid", "blob", "rows").mapInArrow(
        _cut(length), "rid long, first int, windows int, copies long, key long, block long, piece binary"))
    whole = pieces.filter("piece IS NOT NULL").repartition("key").sortWithinPartitions("key", "rid", "first")
    sorted_ = whole.select("rid", "first", "windows", "key", "piece").mapInArrow(_sort(length, keep_first), run_schema)
    single = pieces.filter("piece IS NULL").drop("piece")
    again = single.groupBy("key", "block").agg(F.count("*").alias("n"), F.min(F.struct("rid", "first")).alias("least")).filter("n > 1")
    crowded = single.join(again, ["key", "block"])
    if keep_first:
        crowded = crowded.filter(F.struct("rid", "first") != F.col("least"))
    return alike.unionByName(several.select("rid", "first", "windows")).unionByName(sorted_).unionByName(crowded.select("rid", "first", "windows"))


def _kept(batch, unpack, length):
    """(text, starts, ends) of every row: its bytes and the runs that go."""
    for blob, (first, windows) in zip(batch.column(batch.schema.get_field_index("blob")), runs_of(batch)):
        yield (unpack(blob.as_py()), *anchors.merged(first, first + windows + length - 1))


def rest(text, starts, ends) -> bytes:
    edges = [0, *np.stack((starts, ends), 1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _texts_with_runs(docs, length, gram, keep_first, doc_id, text, keep=()):
    table = stored(docs, doc_id, text, keep)
    runs = removed_windows(table, length, gram, keep_first)
    lists = runs.groupBy("rid").agg(F.collect_list(F.struct("first", "windows")).alias("rows"))
    return table.join(lists, "rid", "left").select("rid", "doc_id", "blob", "rows", *(["kept"] if keep else []))


def removals(docs: DataFrame, length=LENGTH, gram=GRAM, keep_first=False, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    Every byte in a string of ``length`` bytes that also starts elsewhere (in any row, this one included) goes; with
    ``keep_first`` only in strings that also start earlier, in the order in which rows are read. Null
    texts are empty; texts shorter than ``length`` keep all; repeated rows are copies of each other.
    """
    import pyarrow as pa

    def run(batches):
        unpack = unpacker()
        for batch in batches:
            made = []
            for whole, starts, ends in _kept(batch, unpack, length):
                made.append((len(whole), int((ends - starts).sum()), len(starts), hashlib.sha256(rest(whole, starts, ends)).hexdigest()))
            cols = list(zip(*made)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _texts_with_runs(docs, length, gram, keep_first, doc_id, text)
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(text, starts, ends):
    """The runs without characters of which they hold a part only."""
    kept = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            kept.append((a, b))
    return np.array([a for a, _ in kept], np.int64), np.array([b for _, b in kept], np.int64)


def deduplicated(docs: DataFrame, length=LENGTH, gram=GRAM, keep_first=True, doc_id="doc_id", text="text") -> DataFrame:
    """``docs`` with all columns, their texts without what ``removals`` counts; a removed run is cut back to
    whole characters. Rows of which nothing is left go; texts empty before stay as they were."""
    import pyarrow as pa

    def run(batches):
        unpack = unpacker()
        for batch in batches:
            left = [rest(whole, *whole_characters(whole, starts, ends)).decode("utf-8", "surrogatepass") if len(starts) else None for whole, starts, ends in _kept(batch, unpack, length)]
            same = [unpack(blob).decode("utf-8", "surrogatepass") if x is None else x for blob, x in zip(column(batch, "blob"), left)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("kept")), pa.array(same, pa.string()), pa.array([x == "" for x in left], pa.bool_()), pa.array([x is None for x in left], pa.bool_())], ["kept", "text", "gone", "same"])

    others = [c for c in docs.columns if c != text]
    rows = _texts_with_runs(docs.withColumn("ledgerloom_null", docs[text].isNull()), length, gram, keep_first, doc_id, text, [*others, "ledgerloom_null"])
    made = rows.mapInArrow(run, f"kept {dict(rows.dtypes)['kept']}, text string, gone boolean, same boolean").filter("NOT gone")
    new = F.when(F.col("kept.ledgerloom_null"), None).otherwise(F.col("text"))
    size = F.when(F.col("same"), F.col("kept.n_chars")).otherwise(F.length("text")) if "n_chars" in docs.columns else None
    return made.select(*[new.alias(c) if c == text else (size.cast(dict(docs.dtypes)[c]).alias(c) if c == "n_chars" else F.col("kept").getField(c).alias(c)) for c in docs.columns])
