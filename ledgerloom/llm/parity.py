"""Joining documents by the Jaccard similarity of their shingles, through parity sketches.

Every shingle is hashed to one bit and the bits of a document are joined by exclusive or, so the Hamming
distance of two sketches is at most the number of shingles that only one of the documents has. Two
documents of a and b shingles with a share ``least`` of 100 in common differ in at most
(a + b) (100 - least) / (100 + least) of them. Documents are dealt to bands of sizes; within a size band
and towards the next one the largest such difference is d, so a sketch cut into d + 1 pieces agrees in
one piece at least (pigeonhole). Each piece has ``PIECE`` bits for some eight shingles; its hash is the
key of an equi-join. A piece of very few bits is in many documents by chance. So larger sketches have
some more pieces, ``spare`` ones: two documents then agree in spare + 1 pieces, and a document with no
more poor pieces than that leaves them out, since a rich one is left to meet by. Whoever has more keeps
all. The candidates' whole texts are compared, so results are exact.

Keys are sent in sorted blocks, one for each group of keys and task, of some five bytes for a key and its document. What a later pass
needs of the documents is told by one bit for each, which goes to them; texts and sketches that no pass needs are not sent.

Documents of equal sets are one class. Keys of the same classes are one key. Of the classes that share a key, all first meet the key's head
(one pair for each row). What these pairs leave in different components meets in bounded shards, where
the distance of compact sketches drops the unlike ones: first along a spanning forest, at last all
pairs that are left. A key of two rows has no other pair than its head's. So a group of near copies costs pairs in proportion to its size, and no link
between different texts is lost.
"""

import bisect
import hashlib
import math

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.anchors import mixed
from ledgerloom.llm.common import column
from ledgerloom.llm.components import components
from ledgerloom.llm.encoding import remembered
from ledgerloom.llm.repeats import ROW_BITS, unpacker
from ledgerloom.llm.simhash import LOWER, Forest, shingles
from ledgerloom.sources.sinks import written

PIECE = 256
#: Bits below which a piece is poor; pieces from which on a sketch has spare ones, and pieces for each more of them.
POOR, LARGE, SPARED = 3, 10, 25
#: Bits of a compact sketch for each shingle of difference; rows of a shard; pairs of a head in one task.
SHARP, SHARD, MEETINGS = 16, 1024, 256
#: Bytes of the sketch that rows of keys carry, at most and (where the sketch has as many) at least; a quarter of the sketch
#: lies between. Pairs it lets pass meet by their whole sketches.
SCREEN, SMALL = 512, 32
#: Bytes of a key, and bits; keys that are brought together in one group, about. Keys of unlike texts that agree in these bits
#: cost a comparison and nothing else.
KEY_BYTES, KEYS_AT_ONCE = 5, 1 << 18
KEY_BITS = 8 * KEY_BYTES
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def differing(a: int, b: int, least: int) -> int:
    """Most shingles that only one of two documents with ``least`` of 100 in common has."""
    return (a + b) * (100 - least) // (100 + least)


class Bands:
    """Size bands: ``bounds[k]`` is the least size of band k; partners of a size lie in its band or in a next one."""

    def __init__(self, least: int):
        self.least, self.bounds = least, [1]

    def of(self, n: int) -> int:
        while self.bounds[-1] <= n:
            self._extend()
        return bisect.bisect_right(self.bounds, n) - 1

    def _extend(self):
        low = self.bounds[-1]
        self.bounds.append(max(low * 100 // self.least, low * 5 // 4) + 1)

    def pieces(self, band: int) -> tuple[int, int]:
        """Pieces of the sketches of a band and the next one, one more than the largest difference and the spare ones; how many are spare."""
        while len(self.bounds) < band + 2:
            self._extend()
        most = self.bounds[band + 1] - 1
        needed = differing(most, most * 100 // self.least, self.least) + 1
        spare = 2 + needed // SPARED if needed >= LARGE else 0
        return needed + spare, spare

    def reaches_down(self, n: int, band: int) -> bool:
        """Whether a smaller band has sizes that go with n."""
        return band > 0 and -(-n * self.least // 100) < self.bounds[band]


def hashes(text: str, words: int, known) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles; a text of fewer words is one shingle, without words it has none."""
    found = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    each = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    runs = max(len(found) - words + 1, min(len(found), 1))
    total = np.full(runs, min(len(found), words), np.uint64)
    for k in range(min(words, len(found))):
        total = total * _FACTOR + each[k : k + runs]
    return np.unique(mixed(mixed(total)))


def piece_keys(values: np.ndarray, band: int, pieces: int, spare: int) -> np.ndarray:
    """Hashes of the pieces of the parity sketch of a set of hashes; without poor ones if they are no more than the spare ones."""
    places, counts = np.unique((values >> np.uint64(9)) % np.uint64(PIECE * pieces), return_counts=True)
    odd = places[counts % 2 == 1]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed((odd + np.uint64(1)) * _FACTOR), dtype=np.uint64)))
    cuts = np.searchsorted(odd, np.arange(pieces + 1, dtype=np.uint64) * np.uint64(PIECE))
    salts = mixed((np.arange(pieces, dtype=np.uint64) + np.uint64(band << 32)) * _FACTOR)
    keys = mixed(((sums[cuts[1:]] - sums[cuts[:-1]]) ^ salts) * _FACTOR).view(np.int64)
    poor = np.diff(cuts) < POOR
    return keys[~poor] if poor.sum() <= spare else keys


def compact(values: np.ndarray, pieces: int) -> bytes:
    """Parity sketch of a power of two of bits, several times the largest difference."""
    bits = 1 << max(6, (SHARP * pieces - 1).bit_length())
    parity = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """The sketches as rows of 64-bit words, longer ones folded to the length of the shortest."""
    size = min(map(len, sketches))
    rows = np.zeros((len(sketches), size // 8), np.uint64)
    for row, sketch in zip(rows, sketches):
        for part in np.frombuffer(sketch, np.uint64).reshape(-1, size // 8):
            row ^= part
    return rows


def screened(sketch):
    """A sketch folded to a quarter, within ``SMALL`` and ``SCREEN`` bytes; no set has none."""
    if sketch is None or len(sketch) <= SMALL:
        return sketch
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, max(SMALL, min(SCREEN, len(sketch) // 4)) // 8), axis=0).tobytes()


def band_keys(least: int):
    """Function from a set's hashes to its keys as a left and as a right partner, and its compact sketch."""
    bands = Bands(least)

    def keys(values):
        n = len(values)
        if not n:
            return None, None, None
        band = bands.of(n)
        rights = piece_keys(values, band - 1, *bands.pieces(band - 1)) if bands.reaches_down(n, band) else None
        return piece_keys(values, band, *bands.pieces(band)), rights, compact(values, bands.pieces(band)[0])

    return keys


def packed(keys):
    """The low bytes of 64-bit keys, end to end."""
    return None if keys is None else np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def unpacked_keys(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, KEY_BYTES)
    return wide.view(np.int64).ravel()


def sketched(docs: DataFrame, words: int, keys_of, doc_id="doc_id", text="text", mark=None, rest=None) -> DataFrame:
    """A written table with one row for each row of ``docs``: number, id, size and digest of its set, the keys
    and the compact sketch that ``keys_of()`` makes of its hashes, compressed text, ``mark`` of the text, if asked for, and a
    column ``rest``, if given. Numbers rise with the order of the rows."""
    import pyarrow as pa

    names = ["node", "doc_id", "n", "digest", "lefts", "rights", "sketch", "screen", "blob", "mark"]

    def run(batches):
        import zstandard

        known = remembered("parity words", lambda w: xxhash.xxh64_intdigest(w, 42))
        node, keys, pack = TaskContext.get().partitionId() << ROW_BITS, keys_of(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            known.trimmed()
            rows = []
            for doc, said in zip(column(batch, "doc_id"), column(batch, "text")):
                values = hashes(said, words, known)
                lefts, rights, sketch = keys(values)
                rows.append((node, doc, len(values), hashlib.blake2b(values.tobytes(), digest_size=16).digest(), packed(lefts), packed(rights), sketch, screened(sketch), pack(said.encode("utf-8", "surrogatepass")), mark(said) if mark else None))
                node += 1
            each = list(zip(*rows)) if rows else [()] * len(names)
            kinds = [pa.int64(), batch.schema.field("doc_id").type, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*[pa.array(list(x), kind) for x, kind in zip(each, kinds)], *batch.columns[2:]], [*names, *batch.schema.names[2:]])

    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"), *([] if rest is None else [rest.alias("rest")]))
    kinds = dict(rows.dtypes)
    return written(rows.mapInArrow(run, f"node long, doc_id {kinds['doc_id']}, n long, digest binary, lefts binary, rights binary, sketch binary, screen binary, blob binary, mark long" + (f", rest {kinds['rest']}" if rest is not None else "")))


def picked(table: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those rows of a ``sketched`` table whose ``node`` is among the given ones. A bit for each row goes to the table,
    which Spark may broadcast for long, so that its texts stay where they are."""
    import pyarrow as pa

    def run(group):
        row = group.column("row").to_numpy()
        bits = np.zeros((int(row.max()) >> 6) + 1, np.uint64)
        np.bitwise_or.at(bits, row >> 6, np.uint64(1) << (row & 63).astype(np.uint64))
        return pa.Table.from_arrays([group.column("part").slice(0, 1), pa.array([bits.view(np.int64)], pa.list_(pa.int64()))], ["part", "bits"])

    own = nodes.select(F.shiftright("node", ROW_BITS).alias("part"), F.col("node").bitwiseAND((1 << ROW_BITS) - 1).alias("row"))
    bits = written(own.groupBy("part").applyInArrow(run, "part long, bits array<long>"))
    found = table.join(bits, F.shiftright("node", ROW_BITS) == F.col("part"))
    word = f"get(bits, cast((node & {(1 << ROW_BITS) - 1}) >> 6 as int))"
    return found.filter(F.expr(f"({word} >>> cast(node & 63 as int)) & 1 = 1")).select(*table.columns)


def _blocks(groups: int):
    """Deals keys to groups: a row for each group of up to ``KEYS_AT_ONCE`` keys or so, sorted by key."""
    import pyarrow as pa

    def run(batches):
        import zstandard

        remembered("no words", None)  # those of the pass before are given up
        pack, parts, held = zstandard.ZstdCompressor(level=1).compress, [], 0

        def sent():
            key, node, left = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(key, kind="stable")
            key, node, left = key[order], node[order], left[order]
            cuts = np.flatnonzero(np.diff((key * groups) >> KEY_BITS)) + 1
            starts, base, rows = np.concatenate(([0], cuts)), int(node.min()), []
            for a, b in zip(starts, np.append(cuts, len(key))):
                planes = [x.view(np.uint8).reshape(b - a, 8)[:, :size].T for x, size in ((key[a:b], KEY_BYTES), (node[a:b] - base, 8))]
                rows.append(base.to_bytes(8, "little") + (b - a).item().to_bytes(8, "little") + pack(b"".join(np.ascontiguousarray(x).tobytes() for x in (*planes, left[a:b]))))
            return pa.RecordBatch.from_arrays([pa.array((key[starts] * groups) >> KEY_BITS), pa.array(rows, pa.binary())], ["group", "block"])

        for batch in batches:
            for node, *sides in zip(column(batch, "node"), column(batch, "lefts"), column(batch, "rights")):
                for left, blob in zip((1, 0), sides):
                    if blob:
                        keys = unpacked_keys(blob)
                        parts.append((keys, np.full(len(keys), node, np.int64), np.full(len(keys), left, np.uint8)))
                        held += len(keys)
            if held >= KEYS_AT_ONCE:
                yield sent()
                parts, held = [], 0
        if parts:
            yield sent()

    return run


def _shared(blocks):
    """(key, node, is_left, head, size, alike) of the keys of a group that several rows have, a left one among them."""
    import pyarrow as pa
    import zstandard

    remembered("no words", None)
    unpack, found = zstandard.ZstdDecompressor().decompress, []
    for block in blocks.column("block").to_pylist():
        base, n = int.from_bytes(block[:8], "little"), int.from_bytes(block[8:16], "little")
        planes = np.frombuffer(unpack(block[16:]), np.uint8).reshape(-1, n)
        key, node = np.zeros((n, 8), np.uint8), np.ascontiguousarray(planes[KEY_BYTES : KEY_BYTES + 8].T)
        key[:, :KEY_BYTES] = planes[:KEY_BYTES].T
        found.append((key.view(np.int64).ravel(), node.view(np.int64).ravel() + base, planes[-1]))
    key, node, left = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((node, key))
    key, node, left = key[order], node[order], left[order] == 1
    starts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1))
    size, none = np.diff(np.append(starts, len(key))), np.iinfo(np.int64).max
    head = np.minimum.reduceat(np.where(left, node, none), starts)
    # equal for keys of the same rows
    alike = np.add.reduceat(mixed((2 * node + left).astype(np.uint64) * _FACTOR + np.uint64(1)), starts).view(np.int64)
    kept = np.repeat((size > 1) & (head < none), size)
    each = [key, node, left, *[np.repeat(x, size) for x in (head, size, alike)]]
    return pa.Table.from_arrays([pa.array(x[kept]) for x in each], ["key", "node", "is_left", "head", "size", "alike"])


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, node, is_left, head, size) of the keys that several of a ``sketched`` table's rows have; of keys of the same rows one is kept."""
    total = rows.agg(F.sum(F.coalesce(F.length("lefts"), F.lit(0)) + F.coalesce(F.length("rights"), F.lit(0)))).first()[0] or 0
    groups = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(total / KEY_BYTES / KEYS_AT_ONCE))
    blocks = rows.select("node", "lefts", "rights").mapInArrow(_blocks(groups), "group long, block binary")
    found = written(blocks.groupBy("group").applyInArrow(_shared, "key long, node long, is_left boolean, head long, size long, alike long"))
    one = written(found.groupBy("alike", "size").agg(F.min("key").alias("key")).select("key"))
    return found.join(one, "key", "left_semi").drop("alike")


def _alike(words: int, least: int):
    """Reads a head's text and then the texts that meet it; keeps the pairs that are similar enough."""
    import pyarrow as pa

    def run(batches):
        unpack, head = unpacker(), None
        runs = lambda blob: set(shingles(unpack(blob).decode("utf-8", "surrogatepass"), words))
        for batch in batches:
            found = []
            for u, v, blob in zip(column(batch, "u"), column(batch, "v"), column(batch, "blob")):
                if v is None:
                    head = runs(blob)
                else:
                    other = runs(blob)
                    both = len(head & other)
                    if 100 * both >= least * (len(head) + len(other) - both):
                        found.append((u, v))
            u, v = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(u), pa.int64()), pa.array(list(v), pa.int64())], ["u", "v"])

    return run


def alike(pairs: DataFrame, texts: DataFrame, words: int, least: int) -> DataFrame:
    """Those of the different (u, v) pairs of a written table whose texts are similar enough. Each text meets its partners in tasks of
    ``MEETINGS`` pairs or so, and is sent once to each; a partner is sent once for each pair."""
    counts = pairs.groupBy("u").agg(F.ceil(F.count("*") / MEETINGS).cast("int").alias("salts"))
    salted = written(pairs.join(written(counts), "u").select("u", "v", F.pmod(F.xxhash64("v"), "salts").cast("int").alias("salt")))
    heads = salted.select(F.col("u").alias("node"), "u", "salt", F.lit(None).cast("long").alias("v")).distinct()
    needed = written(heads.unionByName(salted.select(F.col("v").alias("node"), "u", "salt", "v")))  # so Spark knows its size beside that of the texts
    rows = needed.join(picked(texts, needed), "node").select("u", "salt", "v", "blob").repartition("u", "salt").sortWithinPartitions("u", "salt", F.col("v").asc_nulls_first())
    return rows.mapInArrow(_alike(words, least), "u long, v long")


def promising(pairs: DataFrame, sketches: DataFrame, least: int) -> DataFrame:
    """Those of the different (u, v) pairs whose compact sketches are near enough, so that texts of unlike ones need not meet."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            keep = []
            for a, b, one, two in zip(*(column(batch, c) for c in ("n_u", "n_v", "sketch_u", "sketch_v"))):
                both = folded([one, two])
                keep.append(int(np.bitwise_count(both[0] ^ both[1]).sum()) <= differing(a, b, least))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    of = lambda side: sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
    return pairs.join(of("u"), "u").join(of("v"), "v").filter(100 * F.least("n_u", "n_v") >= least * F.greatest("n_u", "n_v")).mapInArrow(run, "u long, v long")


def _open_pairs(least: int, forest: bool):
    """Pairs of a shard or of two shards that differ in root and whose sketches are near enough; the key instead of a pair, if the forest left some out."""
    import pyarrow as pa

    def pairs(own, other):
        rows = own + other if other else own
        first = len(own) if other else len(rows)
        words, n = folded([r["sketch"] for r in rows]), np.array([r["n"] for r in rows], np.int64)
        root, left = np.array([r["root"] for r in rows], np.int64), np.array([r["is_left"] for r in rows], bool)
        parts, whole = Forest(), True
        for i in range(first):
            start = first if other else i + 1
            apart = np.bitwise_count(words[start:] ^ words[i]).sum(axis=1, dtype=np.int64)
            near = (apart <= (n[start:] + n[i]) * (100 - least) // (100 + least)) & (root[start:] != root[i]) & (left[start:] | left[i])
            near &= 100 * np.minimum(n[start:], n[i]) >= least * np.maximum(n[start:], n[i])
            for j in np.flatnonzero(near) + start:
                if not forest or parts.joined(int(root[i]), int(root[j])):
                    yield rows[i]["node"], rows[j]["node"]
                else:
                    whole = False
        if not whole:
            yield None

    def run(batches):
        for batch in batches:
            for key, own, other in zip(column(batch, "key"), column(batch, "own"), column(batch, "other")):
                found = [(None, None, key) if p is None else (min(p), max(p), None) for p in pairs(own, other)]
                each = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in each], ["u", "v", "key"])

    return run


def open_rows(rows: DataFrame) -> DataFrame:
    """The rows of keys with different roots, and the number of the key's shards.

    Keys of one root are left out before sketches are looked up, and so are keys of two rows, whose one pair
    is the head's; most keys that are shared by chance are such. Both stay so, hence a later pass needs no other rows.
    """
    key = Window.partitionBy("key")
    over = rows.select("*", F.min("root").over(key).alias("low"), F.max("root").over(key).alias("high"), F.max("is_left").over(key).alias("any_left"), F.count("*").over(key).alias("size"))
    return over.filter("low < high AND any_left AND size > 2").select(*rows.columns, F.ceil(F.col("size") / SHARD).cast("int").alias("shards"))


def met(rows: DataFrame, least: int, forest: bool, sketches: DataFrame = None) -> DataFrame:
    """(u, v, key): the pairs of ``open_pairs``, without a key, and the keys of which the forest left pairs out, without a pair."""
    dealt = rows if "shards" in rows.columns else open_rows(rows)

    def shards(dealt):
        dealt = dealt if sketches is None else dealt.join(sketches, "node")
        return dealt.withColumn("shard", F.pmod(F.xxhash64("node"), "shards").cast("int")).groupBy("key", "shard").agg(F.collect_list(F.struct("node", "root", "is_left", "n", "sketch")).alias("own"))

    alone, several = shards(dealt.filter("shards = 1")), written(shards(dealt.filter("shards > 1")))  # most keys are of one shard, which goes nowhere else
    others = several.select("key", F.col("shard").alias("shard_2"), F.col("own").alias("other"))
    between = several.join(others, "key").filter("shard < shard_2").select("key", "own", "other")
    alone = alone.unionByName(several).select("key", "own", F.lit(None).cast(dict(several.dtypes)["own"]).alias("other"))
    return alone.unionByName(between).mapInArrow(_open_pairs(least, forest), "u long, v long, key long")


def open_pairs(rows: DataFrame, least: int, forest: bool, sketches: DataFrame = None) -> DataFrame:
    """(u, v) of classes of different roots that share a key, as told by their compact sketches; with
    ``forest`` only so many of a shard that they join what all of them would.

    A key's rows are dealt to shards of bounded size. ``sketches`` has the size and sketch of every node, if
    ``rows`` has not; ``open_rows`` is applied to rows without shards.
    """
    return met(rows, least, forest, sketches).filter("u IS NOT NULL").select("u", "v")


def linked_classes(table: DataFrame, classes: DataFrame, words: int, least: int, first: DataFrame = None) -> DataFrame:
    """(node, root): the least node reachable over links, of every class that may have one.

    ``table`` is made by ``sketched``, ``classes`` has the nodes to be linked; ``first`` are pairs (u, v) to be compared
    with those of the keys' heads.
    """
    shared = written(shared_keys(picked(table.filter("n > 0").select("node", "lefts", "rights"), classes)))
    pairs = shared.filter("node <> head").select(F.least("head", "node").alias("u"), F.greatest("head", "node").alias("v"))
    pairs = written((pairs if first is None else pairs.unionByName(first.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))).distinct())
    # sketches of what meets no other class are not needed again
    needed = written(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    plain = written(picked(table.select("node", "n", "sketch", "screen"), needed))
    texts = table.select("node", "blob")
    root = written(needed.select("node", F.col("node").alias("root")))

    def linked(root, pairs):
        """Roots after the links among the pairs; only edges between roots are looked at."""
        found = alike(pairs, texts, words, least)
        of = lambda side: root.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        edges = found.join(of("u"), "u").join(of("v"), "v").select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))
        upper = components(edges).select(F.col("node").alias("root"), F.col("root").alias("upper"))
        return written(root.join(upper, "root", "left").select("node", F.coalesce("upper", "root").alias("root")))

    seen = written(promising(pairs, plain, least))
    root = linked(root, seen)
    rows = shared.filter("size > 2")
    for forest in (True, False):
        rows = written(open_rows(rows.select("key", "node", "is_left").join(root, "node")))
        found = written(met(rows, least, forest, plain.select("node", "n", F.col("screen").alias("sketch"))))
        open_ = written(found.filter("u IS NOT NULL").select("u", "v").distinct().join(seen, ["u", "v"], "left_anti"))
        needed = written(open_.select(F.explode(F.array("u", "v")).alias("node")).distinct())
        pairs = written(promising(open_, plain.join(needed, "node", "left_semi"), least))
        root, seen = linked(root, pairs), seen.unionByName(pairs)
        rows = rows.join(found.filter("key IS NOT NULL").select("key").distinct(), "key", "left_semi")
    return root


def joined(docs: DataFrame, words=3, least=90, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    A document's set are its distinct runs of ``words`` words, A-Z in lower case; fewer words are one run. Two
    documents link when they have ``least`` of 100 shingles of both in common; a component's id is its least
    doc_id (null if it has none). Null and wordless texts have no shingles and link with nothing, so their
    component is their own id. Repeated rows stay and are copies; no rows give no rows.
    """
    table = sketched(docs, words, lambda: band_keys(least), doc_id, text)
    classes = written(table.filter("n > 0").groupBy("digest").agg(F.min("node").alias("node"), F.min("doc_id").alias("first_id")))
    root = linked_classes(table, classes, words, least)
    rooted = classes.join(root, "node", "left").select("digest", "first_id", F.coalesce("root", "node").alias("root"))
    least_id = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    component = written(rooted.join(least_id, "root").select("digest", "component_id"))
    return table.select("doc_id", "n", "digest").join(component, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
