"""SimHash near-dedup: 64-bit fingerprints, linked through BK-trees.

Fingerprints within the radius agree in at least one of radius + 1 bands (pigeonhole), so the
distinct fingerprints of a band value form one group. A group is cut into shards of bounded size;
each shard becomes a BK-tree whose children are keyed by their Hamming distance to the parent, and a
search follows only edges within the radius of the distance found. Trees of a group with several
shards are sent to the group's other shards, again as trees, never as pairs of fingerprints. A shard
emits a spanning forest of its links, so a group of m fingerprints emits fewer than m edges for each
tree it meets.
"""

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column, whole_texts
from ledgerloom.llm.components import components
from ledgerloom.sources.sinks import written

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42
SHARD = 4096
BLOCK = 1 << 17


def shingles(text: str, words: int) -> list[bytes]:
    """Runs of so many words, joined by a space; a shorter text is one run, none without words."""
    found = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    return list(map(b" ".join, zip(*(found[i:] for i in range(words)))))


def fingerprint(text: str, words: int = 3) -> int:
    """Majority of the bits of the shingles' hashes, repeats included, as a signed 64-bit integer."""
    runs = shingles(text, words)
    if not runs:
        return 0
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(runs), BLOCK):
        part = runs[at : at + BLOCK]
        hashes = np.fromiter((digest(run, SEED) for run in part), np.uint64, len(part))
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(runs)).view(">u8")[0].astype(np.int64))


def fingerprints(docs: DataFrame, words: int = 3, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, fingerprint long) of every row."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            values = [fingerprint(x, words) for x in column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fingerprint"])

    rows = whole_texts(docs, doc_id, text)
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint long")


class BKTree:
    """Node k has ``values[k]`` and ``children[k]``, a dict from Hamming distance to child."""

    def __init__(self):
        self.values, self.children = [], []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new, at = len(self.values) - 1, 0
        while new:
            step = (self.values[at] ^ value).bit_count()
            if step not in self.children[at]:
                self.children[at][step] = new
                return
            at = self.children[at][step]

    def near(self, value: int, radius: int):
        """Nodes within the radius."""
        stack = [0] if self.values else []
        while stack:
            at = stack.pop()
            step = (self.values[at] ^ value).bit_count()
            if step <= radius:
                yield at
            below = self.children[at]
            if len(below) > 2 * radius:
                stack += [below[d] for d in range(step - radius, step + radius + 1) if d in below]
            else:
                stack += [child for d, child in below.items() if abs(d - step) <= radius]


class Forest:
    """Union-find over values; joined() is true where two parts become one."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = self.parent[up]
            x = self.parent[x]
        return x

    def joined(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def tree_links(values, radius, tree=None):
    """Spanning forest of the links among the values, or between them and a ready tree, near ones first."""
    own, forest, links = tree or BKTree(), Forest(), []
    for value in values:
        for node in sorted(own.near(value, radius), key=lambda n: (own.values[n] ^ value).bit_count()):
            if forest.joined(value, own.values[node]):
                links.append((value, own.values[node]))
        if tree is None:
            own.add(value)
    return links


def _grouped(batches, *names):
    """Runs of equal keys in sorted Arrow batches: (key, values)."""
    key, values = None, []
    for batch in batches:
        for *own, value in zip(*(column(batch, n) for n in names)):
            if own != key:
                if values:
                    yield key, values
                key, values = own, []
            values.append(value)
    if values:
        yield key, values


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that join all within the radius of each other."""
    import pyarrow as pa

    cuts = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    bands = F.array(*[
        F.struct(F.lit(i).cast("int").alias("band"), F.shiftrightunsigned(F.shiftleft("fingerprint", 64 - high), 64 - (high - low)).alias("part"))
        for i, (low, high) in enumerate(zip(cuts, cuts[1:]))])
    keyed = distinct.select("fingerprint", F.inline(bands))
    sizes = keyed.groupBy("band", "part").agg(F.count("*").alias("size")).filter("size > 1")
    sharded = keyed.join(sizes, ["band", "part"]).withColumn(
        "shard", F.when(F.col("size") > SHARD, F.pmod(F.xxhash64("fingerprint", "band"), F.ceil(F.col("size") / (SHARD / 2)))).otherwise(0))
    ordered = sharded.repartition("band", "part", "shard").sortWithinPartitions("band", "part", "shard", "fingerprint")

    def edges(found):
        left, right = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

    def unsigned(x):
        return x & 0xFFFFFFFFFFFFFFFF

    def signed(pairs):
        return [tuple(x - (1 << 64) if x >> 63 else x for x in pair) for pair in pairs]

    def within(batches):
        found = []
        for _, values in _grouped(batches, "band", "part", "shard", "fingerprint"):
            found += signed(tree_links(map(unsigned, values), radius))
            if len(found) > 50_000:
                yield edges(found)
                found = []
        yield edges(found)

    def across(batches):
        for batch in batches:
            for members, other in zip(column(batch, "members"), column(batch, "other")):
                tree = BKTree()
                for value in other:
                    tree.add(unsigned(value))
                yield edges(signed(tree_links(map(unsigned, members), radius, tree)))

    inside = ordered.select("band", "part", "shard", "fingerprint").mapInArrow(within, "u long, v long")
    shards = sharded.filter(F.col("size") > SHARD).groupBy("band", "part", "shard").agg(F.collect_list("fingerprint").alias("members"))
    others = shards.select("band", "part", F.col("shard").alias("shard_2"), F.col("members").alias("other"))
    between = shards.join(others, ["band", "part"]).filter("shard < shard_2").select("members", "other").repartition("members").mapInArrow(across, "u long, v long")
    return inside.unionByName(between).distinct()


def near_groups(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(fingerprint, component_id): the least doc_id reachable over links, for every distinct fingerprint.

    Repeated fingerprints and rows count once; a component whose ids are all null has a null id; no
    rows give no rows. ``radius`` 0 links equal fingerprints alone.
    """
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct, radius))
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, fingerprint hex, component_id) of every row of ``docs``.

    Null and wordless texts have fingerprint zero and link like any other. Repeated rows stay.
    """
    prints = written(fingerprints(docs, words, doc_id, text))
    return prints.join(near_groups(prints, radius), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
