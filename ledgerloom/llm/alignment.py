r"""Cross-tokenizer alignment: the tokens of two vocabularies over the same text, grouped between common ends.

Both tokenizers cut a text (with a space before it) into tokens whose bytes are the text's, so each is a
growing list of byte ends, and a group runs from one end that both have to the next. Merging the two
lists is divided by merge-path diagonals: a binary search on each diagonal finds how many ends of either
list stand among the first so many of both, so the merge falls into pieces of ``PIECE`` ends each, of
equal work and independent of each other whatever the text. A piece sorts its own ends and emits the
common ones; a pair of equal ends that a diagonal divides is found at the seam, and running totals of the
pieces' common ends stitch their open groups together and number them.

Id pairs are counted by the documents that hold them. Tasks count them by slices of some ``SLICE``
links, so a pair is one row for each slice and not for each document; the corpus-wide counts come back
to each slice's dictionary, and the documents of the slice read them by place. A document may lie in
several slices; its pairs are then made distinct before they are counted.

Where both tokenizers are bound to cut, before a space that follows something other than white space,
texts are cut first and each distinct word is encoded once by the libraries and remembered: byte-level
merges never leave a pre-token, and no piece of the other vocabulary has a space after something else.
"""

import hashlib
import itertools
import os
import re

import numpy as np
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import column, whole_texts, worker_state
from ledgerloom.llm.encoding import REMEMBERED
from ledgerloom.llm.repeats import ROW_BITS
from ledgerloom.sources.sinks import written

#: Merged ends of a piece; words aligned at once; links of a slice; links expanded at once; characters split at once.
PIECE, WORDS, SLICE, BLOCK, STRETCH = 1024, 1 << 17, 1 << 21, 1 << 20, 1 << 20
#: Links of a group beyond which equal tokens of the group are counted before they are paired.
CROWDED = 4096
AT_ONCE = 20_000
SPACES = "\t-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Before spaces that follow no white space and do not end the text.
CUT = re.compile(f"(?<=[^ {SPACES}]) (?= *[^ ])")
UNCUT = re.compile(f"  |[{SPACES}] | $|^ ")
SLOT = 1 << 32


def words(text: str):
    """Lists of the stretches between safe cuts, which leave out the space before each; together they are the text."""
    at = 0
    while True:
        end = len(text)
        if at + STRETCH < end and (found := CUT.search(text, at + STRETCH)):
            end = found.start()
        part = text[at:end]
        yield CUT.split(part) if UNCUT.search(part) else part.split(" ")
        if end == len(text):
            return
        at = end + 1


def _byte_level():
    """Character of each byte in byte-level vocabularies: printable ones stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Flat:
    """Integer lists one after the other in one growing array."""

    def __init__(self):
        self.values, self.bounds = np.empty(1 << 16, np.int32), np.zeros(1, np.int64)

    def extend(self, flat: np.ndarray, sizes):
        """Adds lists of so many values each."""
        used = int(self.bounds[-1])
        while used + len(flat) > len(self.values):
            self.values = np.concatenate((self.values, np.empty(len(self.values), np.int32)))
        self.values[used : used + len(flat)] = flat
        self.bounds = np.concatenate((self.bounds, used + np.cumsum(sizes)))

    def of(self, numbers):
        """Values of the numbered lists in turn, and the length of each."""
        sizes = self.bounds[numbers + 1] - self.bounds[numbers]
        before = np.cumsum(sizes) - sizes
        return self.values[np.repeat(self.bounds[numbers] - before, sizes) + np.arange(int(sizes.sum()))], sizes


class Encoders:
    """Both tokenizers and the words they have encoded."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        file = lambda name: name if "/" in name else public_tokenizers.path(name)
        self.a = Tokenizer.from_file(file(byte_bpe))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=file(piece_bpe))
        bytes_of = _byte_level()
        entries = sorted((i, t) for t, i in self.a.get_vocab(with_added_tokens=True).items())
        special = {i for i in self.a.get_added_tokens_decoder()}
        self.a_bytes = [b""] * (entries[-1][0] + 1)
        for i, token in entries:
            self.a_bytes[i] = token.encode() if i in special else bytes(map(bytes_of.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes)]
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        #: ids as text with what follows them: of A within and at the end of a group, then of B
        self.strings = np.array([f"{i}{after}" for n, after in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)], object)
        self.clear()

    def clear(self):
        self.known, self.flat, self.sound, self.size = {}, (Flat(), Flat()), np.zeros(0, bool), 0

    def numbers(self, found: list[str]) -> np.ndarray:
        """Numbers of the words; new ones are encoded."""
        new = list(set(found).difference(self.known))
        plain = [w for w in new if w and not w[-1].isspace() and w[-1] != "\u180e" and "▁" not in w]
        for at in range(0, len(plain), AT_ONCE):
            self._learn_together(plain[at : at + AT_ONCE])
        if len(plain) < len(new):
            self._learn_each(list(set(new).difference(plain)))
        self.size += sum(map(len, new)) + 100 * len(new)
        return np.fromiter(map(self.known.__getitem__, found), np.int32, len(found))

    def _learn(self, part, ids, sizes, sound):
        for flat, own, n in zip(self.flat, ids, sizes):
            flat.extend(own, n)
        self.sound = np.concatenate((self.sound, sound))
        self.known.update(zip(part, range(len(self.known), len(self.known) + len(part))))

    def _learn_together(self, part: list[str]):
        """Encodes words between which both tokenizers are bound to cut as one text, and divides its tokens among them."""
        text = " " + " ".join(part)
        raw = text.encode("utf-8", "surrogatepass")
        ids = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:], num_threads=1)
        word_ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in part])
        places, sound = [], True
        for own, spelled, size in zip(ids, (self.a_bytes, self.b_bytes), self.sizes):
            ends = np.cumsum(size[own])
            places.append(np.searchsorted(ends, word_ends))
            sound = sound and b"".join(map(spelled.__getitem__, own)) == raw and (ends[np.minimum(places[-1], len(ends) - 1)] == word_ends).all()
        if sound:
            self._learn(part, [np.array(own, np.int32) for own in ids], [np.diff(p, prepend=-1) for p in places], np.ones(len(part), bool))
        else:
            self._learn_each(part)

    def _learn_each(self, part: list[str]):
        a = [x.ids for x in self.a.encode_batch_fast([" " + w for w in part], add_special_tokens=False)]
        # an empty word is a space alone, which the library would not encode
        b = [ids if w else [self.b.piece_to_id("▁")] for w, ids in zip(part, self.b.encode(part, num_threads=1))]
        own = [(" " + w).encode("utf-8", "surrogatepass") for w in part]
        sound = [b"".join(map(self.a_bytes.__getitem__, x)) == w == b"".join(map(self.b_bytes.__getitem__, y)) for x, y, w in zip(a, b, own)]
        self._learn(part, [np.fromiter(itertools.chain.from_iterable(x), np.int32) for x in (a, b)], [[len(one) for one in x] for x in (a, b)], np.array(sound, bool))

    def encoded(self, texts: list) -> list:
        """Numbers of all words of each text; None if a tokenizer's bytes are not the text's, or it is empty.

        Some ``WORDS`` words are looked up at once, of one text or of many.
        """
        parts, found, owners = [[] for _ in texts], [], []

        def look_up():
            numbers, at = self.numbers(found), 0
            for owner, n in owners:
                parts[owner].append(numbers[at : at + n])
                at += n
            found.clear()
            owners.clear()

        for owner, text in enumerate(texts):
            for part in words(text) if text else ():
                found += part
                owners.append((owner, len(part)))
                if len(found) > WORDS:
                    look_up()
        look_up()
        whole = [np.concatenate(p) if p else None for p in parts]
        return [n if n is not None and self.sound[n].all() else None for n in whole]


def together(rows, size: int):
    """Lists of successive (id, text) rows of some ``size`` characters, each of one row at least."""
    taken, n = [], 0
    for row in rows:
        taken.append(row)
        n += len(row[1])
        if n >= size:
            yield taken
            taken, n = [], 0
    if taken:
        yield taken


def encoders(byte_bpe: str, piece_bpe: str) -> Encoders:
    kept = worker_state()
    if (key := ("alignment", byte_bpe, piece_bpe)) not in kept:
        kept[key] = Encoders(byte_bpe, piece_bpe)
    return kept[key]


def diagonals(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a and of b stand among the first 0, size, 2 size, ... of both, those of a first where
    equal: a binary search on every diagonal, all of them at once."""
    d = np.append(np.arange(0, len(a) + len(b), size), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = a[np.minimum(middle, len(a) - 1)] <= b[np.clip(d - 1 - middle, 0, len(b) - 1)]
        low, high = np.where(open_ & first, middle + 1, low), np.where(open_ & ~first, middle, high)
    return low, d - low


def groups(a: np.ndarray, b: np.ndarray, size: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of every token of a and of b, given their growing ends, the last of which is common."""
    size = size or PIECE
    from_a, from_b = diagonals(a, b, size)
    pieces, in_a, in_b = len(from_a) - 1, np.diff(from_a), np.diff(from_b)
    merged = np.full(pieces * size, np.iinfo(np.int64).max, np.int64)
    start = np.arange(pieces) * size
    merged[np.repeat(start - from_a[:-1], in_a) + np.arange(len(a))] = 2 * a
    merged[np.repeat(start + in_a - from_b[:-1], in_b) + np.arange(len(b))] = 2 * b + 1
    rows = merged.reshape(pieces, size)
    rows.sort(axis=1, kind="stable")  # each piece on its own
    common = np.zeros((pieces, size), bool)
    common[:, 1:] = (rows[:, 1:] ^ rows[:, :-1]) == 1  # 2e and 2e + 1
    common[1:, 0] = (rows[1:, 0] ^ rows[:-1, -1]) == 1  # a seam
    before = np.cumsum(common.sum(axis=1)) - common.sum(axis=1)  # groups that end in earlier pieces
    number = (np.cumsum(common, axis=1) - common + before[:, None]).reshape(-1)[: len(a) + len(b)]
    of_b = (merged[: len(number)] & 1).astype(bool)
    return number[~of_b], number[of_b]


def counted(group, ids):
    """(group, id, times) of a group's equal ids."""
    keys, times = np.unique(group << 32 | ids, return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, times


def links(group_a, a, group_b, b, n_groups: int):
    """Blocks of (group, a, b, times): all links of every group; equal ones of a block may stand apart."""
    times_a, times_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
    if (np.bincount(group_a, minlength=n_groups) * np.bincount(group_b, minlength=n_groups)).max(initial=0) > CROWDED:
        (group_a, a, times_a), (group_b, b, times_b) = counted(group_a, a), counted(group_b, b)
    in_b = np.bincount(group_b, minlength=n_groups)
    start = np.cumsum(in_b) - in_b
    each = in_b[group_a]
    upto = np.cumsum(each)
    at = 0
    while at < len(a):
        end = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK, "right")), at + 1)
        sizes = each[at:end]
        left = np.repeat(np.arange(at, end), sizes)
        right = np.repeat(start[group_a[at:end]] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(left))
        yield group_a[left], a[left], b[right], times_a[left] * times_b[right]
        at = end


class Doc:
    """A document's totals so far: tokens of either vocabulary, groups, links. Without tokens it has no hash."""

    def __init__(self, rid, doc_id, empty):
        self.rid, self.doc_id, self.sha, self.parts, self.ended = rid, doc_id, None if empty else hashlib.sha256(), 0, empty
        self.totals = np.zeros(4, np.int64)

    def told(self):
        """(rid, doc_id, totals, hash), the last five once only, where the document ends."""
        if not self.ended:
            return self.rid, self.doc_id, 0, 0, 0, 0, None
        return self.rid, self.doc_id, *self.totals.tolist(), self.sha.hexdigest() if self.sha else ""


class Slicer:
    """Aligns documents in order and hands out slices of them."""

    def __init__(self, enc: Encoders, part: int):
        self.enc, self.n_b, self.number = enc, len(enc.b_bytes), part << ROW_BITS
        self.waiting, self.n_waiting, self.closed = [], 0, []
        self._fresh()

    def _fresh(self):
        self.docs, self.slots, self.keys, self.times, self.n_links = [], {}, [], [], 0

    def _slot(self, doc: Doc) -> int:
        if doc.rid not in self.slots:
            self.slots[doc.rid] = len(self.docs)
            self.docs.append(doc)
            doc.parts += 1
        return self.slots[doc.rid]

    def add(self, doc: Doc, numbers):
        if numbers is None:
            self._slot(doc)
            return
        for at in range(0, len(numbers), WORDS):
            part = numbers[at : at + WORDS]
            self.waiting.append((doc, part, at + WORDS >= len(numbers)))
            self.n_waiting += len(part)
            if self.n_waiting >= WORDS:
                self.align()

    def align(self):
        """Merges the waiting words of all documents in one go; a document's end is a common end."""
        if not self.waiting:
            return
        enc, numbers = self.enc, np.concatenate([x[1] for x in self.waiting])
        edges = np.cumsum([0] + [len(x[1]) for x in self.waiting])
        (a, in_words_a), (b, in_words_b) = (flat.of(numbers) for flat in enc.flat)
        group_a, group_b = groups(np.cumsum(enc.sizes[0][a]), np.cumsum(enc.sizes[1][b]))
        n_groups = int(group_a[-1]) + 1
        in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        cut_a, cut_b = np.append(0, np.cumsum(in_words_a))[edges], np.append(0, np.cumsum(in_words_b))[edges]
        cut_g = np.append(group_a[cut_a[:-1]], n_groups)
        last = lambda group: np.append(group[1:] != group[:-1], True)
        said = np.empty(len(a) + len(b), object)  # ids with what follows them, groups in turn, a before b
        said[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = enc.strings[a + last(group_a) * len(enc.a_bytes)]
        said[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = enc.strings[2 * len(enc.a_bytes) + b + last(group_b) * len(enc.b_bytes)]
        upto = np.append(0, np.cumsum(in_a * in_b))
        slots = np.array([self._slot(doc) for doc, _, _ in self.waiting])
        for k, (doc, _, ends) in enumerate(self.waiting):
            own = "".join(said[cut_a[k] + cut_b[k] : cut_a[k + 1] + cut_b[k + 1]].tolist())
            doc.sha.update((own[:-1] if ends else own).encode())
            doc.totals += (cut_a[k + 1] - cut_a[k], cut_b[k + 1] - cut_b[k], cut_g[k + 1] - cut_g[k], upto[cut_g[k + 1]] - upto[cut_g[k]])
            doc.ended = ends
        slot = np.repeat(slots, np.diff(cut_g))
        for group, x, y, times in links(group_a, a.astype(np.int64), group_b, b.astype(np.int64), n_groups):
            self.keys.append(slot[group] * SLOT + (x * self.n_b + y))
            self.times.append(times)
            self.n_links += len(group)
            if self.n_links > 2 * SLICE:
                self._sum_up()
        self.waiting, self.n_waiting = [], 0
        if self.n_links >= SLICE:
            self.close()

    def _sum_up(self):
        """Adds equal (document, pair) entries."""
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.times, self.n_links = [keys[first]], [np.add.reduceat(times[order], first)], len(first)

    def close(self):
        """Ends the slice: rows of its documents with the places and times of their pairs, its pairs in order of place
        with the number of whole documents that hold each, and the pairs of documents that lie in several slices."""
        if not self.docs:
            return
        slot = pair = times = np.zeros(0, np.int64)
        if self.keys:
            self._sum_up()
            (keys,), (times,) = self.keys, self.times
            slot, pair = keys // SLOT, keys % SLOT
        whole = np.array([d.ended and d.parts == 1 for d in self.docs], bool)
        pairs, inverse = np.unique(pair, return_inverse=True)
        order = np.argsort(-np.bincount(inverse, minlength=len(pairs)), kind="stable")  # frequent ones have small places
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        own = place[inverse]
        counts = np.bincount(own[whole[slot]], minlength=len(pairs))
        by, edges = np.lexsort((own, slot)), np.searchsorted(slot, np.arange(len(self.docs) + 1))
        own, times, pairs = own[by], times[by], pairs[order]
        each = list(zip(edges.tolist(), edges[1:].tolist()))
        held = [(d.told(), own[low:high], times[low:high]) for d, (low, high) in zip(self.docs, each)]
        cut = [(d.rid, pairs[own[low:high]]) for d, (low, high), one in zip(self.docs, each, whole) if not one and low < high]
        self.closed.append((self.number, held, pairs, counts, cut))
        self.number += 1
        self._fresh()


_NAMES = ["slice", "rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_pairs", "blob", "place", "pair", "docs"]
_TEXTS = {"doc_id": "{kind}", "sha": "string", "blob": "binary"}


def _aligned(byte_bpe: str, piece_bpe: str):
    import pyarrow as pa

    def columns(closed, id_type):
        """Columns of a slice's rows: of documents (with a blob), of pairs (with a place), of pairs of divided documents."""
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for number, held, pairs, counts, cut in closed:
            rows = [(number, *told, len(own), pack(np.diff(own, prepend=0).astype(np.int32).tobytes() + times.astype(np.int64).tobytes())) for told, own, times in held]
            kinds = [pa.int64(), pa.int64(), id_type, *[pa.int64()] * 4, pa.string(), pa.int64(), pa.binary()]
            yield {k: pa.array(list(c), t) for k, c, t in zip(_NAMES, zip(*rows), kinds)}
            for low in range(0, len(pairs), 1 << 16):
                part = slice(low, low + (1 << 16))
                n = len(pairs[part])
                yield {"slice": pa.array(np.full(n, number)), "place": pa.array(np.arange(low, low + n)), "pair": pa.array(pairs[part]), "docs": pa.array(counts[part])}
            for rid, own in cut:
                yield {"rid": pa.array(np.full(len(own), rid)), "pair": pa.array(own)}

    def run(batches):
        enc, part = encoders(byte_bpe, piece_bpe), TaskContext.get().partitionId()
        slicer, rid = Slicer(enc, part), part << ROW_BITS
        types = dict.fromkeys(_NAMES, pa.int64()) | {"sha": pa.string(), "blob": pa.binary()}

        def ready():
            for filled in columns(slicer.closed, types["doc_id"]):
                n = len(next(iter(filled.values())))
                yield pa.RecordBatch.from_arrays([filled[k] if k in filled else pa.nulls(n, types[k]) for k in _NAMES], _NAMES)
            slicer.closed.clear()

        for batch in batches:
            types["doc_id"] = batch.schema.field("doc_id").type
            for some in together(zip(column(batch, "doc_id"), column(batch, "text")), STRETCH):
                for (doc_id, _), numbers in zip(some, enc.encoded([text for _, text in some])):
                    slicer.add(Doc(rid, doc_id, numbers is None), numbers)
                    rid += 1
                if enc.size > REMEMBERED:
                    slicer.align()  # waiting words are known by number
                    enc.clear()
                yield from ready()
        slicer.align()
        slicer.close()
        yield from ready()

    return run


_OUT = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_best", "count_sum"]


def _tallied(left, right):
    """Documents of a slice with the sums over their links, read from the slice's counts by place."""
    import pyarrow as pa
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, bool)
    place = right.column("place").to_numpy()
    n[place], best[place] = right.column("n").to_numpy(), right.column("is_best").to_numpy()
    sums = []
    for size, blob in zip(left.column("n_pairs").to_pylist(), left.column("blob").to_pylist()):
        raw = unpack(blob)
        own, times = np.cumsum(np.frombuffer(raw, np.int32, size), dtype=np.int64), np.frombuffer(raw, np.int64, size, 4 * size)
        sums.append((int(times[best[own]].sum()), int((times * n[own]).sum())))
    n_best, count_sum = zip(*sums) if sums else ((), ())
    kept = left.select(_OUT[:7])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def aligned(docs: DataFrame, byte_bpe="byte_bpe_50k.json", piece_bpe="piece_bpe_32k.model", doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    Token A of a space and the text by the byte-level vocabulary, token B of the text by the other one, which
    adds the space; special strings are plain text. Links are all pairs of A and B tokens of a group, a pair's
    count is the number of rows that hold it linked, n_best counts the links whose count is the highest of
    their A id, ties included. Null and empty texts, and those whose tokens' bytes are not the text's,
    have no tokens: zeros and an empty hash. Repeated rows count as often as they come; no rows give no rows.
    """
    rows = whole_texts(docs, doc_id, text)
    kind = dict(rows.dtypes)["doc_id"]
    schema = ", ".join(f"{c} {_TEXTS.get(c, 'long').format(kind=kind)}" for c in _NAMES)
    table = written(rows.mapInArrow(_aligned(byte_bpe, piece_bpe), schema))
    pairs = table.filter("place IS NOT NULL").select("slice", "place", "pair", "docs")
    cut = table.filter("slice IS NULL").select("rid", "pair").distinct().select("pair", F.lit(1).cast("long").alias("docs"))
    n_b = len(encoders(byte_bpe, piece_bpe).b_bytes)
    counts = written(pairs.select("pair", "docs").unionByName(cut).groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.expr(f"pair DIV {n_b}")))
    highest = written(counts.groupBy("a").agg(F.max("n").alias("most")))  # as many rows as the vocabulary at most
    judged = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))
    numbered = pairs.join(judged, "pair").select(F.col("slice").alias("part"), "place", "n", "is_best")
    held = table.filter("blob IS NOT NULL").select("slice", "n_pairs", "blob", *_OUT[:7])
    out = ", ".join(f"{c} {_TEXTS.get(c, 'long').format(kind=kind)}" for c in _OUT)
    parts = held.groupBy("slice").cogroup(numbered.groupBy("part")).applyInArrow(_tallied, out)
    return parts.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], F.max("sha").alias("groups_sha256")).drop("rid")
