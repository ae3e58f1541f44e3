r"""Token counts of whole texts by overlap resynchronisation.

A text of more than ``chunk`` characters is encoded in overlapping chunks with offsets. Two chunks are
spliced at a boundary that both have in their overlap and that no context can move; counts left of it
come from the one, right of it from the other. Where the overlap holds no such boundary it is widened,
then the chunk, until one is found or the rest is encoded as one.

A boundary x of the vocabulary whose pre-tokens are ``'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+``
is stable if neither side can take part in a match of the other:

* beside ASCII white space, which is dropped and which no normal form composes;
* beside an ASCII digit, each of which is a match of its own;
* between an ASCII letter and an ASCII sign after it: letters end there whether as a run or as a
  contraction. The signs of the special strings (``< | >``) are left out, and so is a place whose next
  character is not ASCII, as it might compose with the letter.

Shorter texts are one chunk. Its pieces between white space are encoded once each and remembered.
"""

import re

import numpy as np
from pyspark.sql import DataFrame

from ledgerloom.llm.common import column, whole_texts
from ledgerloom.llm.encoding import piece_counts, tokenizer

CHUNK, OVERLAP = 65_536, 512
STABLE = re.compile(r"(?<=[ \t-\r0-9])(?=.)|(?<=.)(?=[ \t-\r0-9])|(?<=[A-Za-z])(?=[!-/:;=?@\[-`{}~])", re.S)
ASCII_SPACE = re.compile(r"[ \t-\r]+")


def spans(name: str, text: str, at: int):
    """Starts and ends of the tokens of a chunk that begins at character ``at``."""
    pairs = np.array(tokenizer(name).encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
    return pairs[:, 0] + at, pairs[:, 1] + at


def _left_of(chunk, x):
    """Tokens that end by x, or None if one lies across it or the order of offsets does not tell."""
    starts, ends = chunk
    n = int(np.count_nonzero(ends <= x))
    return n if n + int(np.count_nonzero(starts >= x)) == len(starts) else None


def splice(text: str, left, right, low: int, high: int):
    """The last stable boundary in (low, high) that both chunks have, with the counts left of it."""
    found = None
    for match in STABLE.finditer(text, low + 1, high - 1):
        x = match.start()
        if x > low + 1 and (a := _left_of(left, x)) is not None and (b := _left_of(right, x)) is not None:
            found = x, a, b
            if x > (low + high) // 2:
                break
    return found


def count_long(name: str, text: str, chunk=CHUNK, overlap=OVERLAP) -> int:
    """Tokens of a text of any length; at most a chunk and what widening adds is encoded at once."""
    total = done = 0  # tokens counted left of the splice in the current chunk's predecessor
    start, end = 0, min(chunk, len(text))
    left = spans(name, text[start:end], start)
    while end < len(text):
        wide, spliced = overlap, None
        while True:
            begin = max(start, end - wide)
            stop = min(begin + chunk + wide, len(text))
            right = spans(name, text[begin:stop], begin)
            spliced = splice(text, left, right, begin, end)
            if spliced or begin == start:
                break
            wide *= 2
        if spliced:
            x, before, skip = spliced
            total += before - done
            start, end, left, done = begin, stop, right, skip
        else:  # the chunk holds no stable boundary: grow it from where it began
            end = min(start + 2 * (end - start), len(text))
            left = spans(name, text[start:end], start)
    return total + len(left[0]) - done


def words(text: str) -> list[str]:
    """Pieces between white space. Four control characters are white space to Python alone."""
    return ASCII_SPACE.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


def counts(texts, name: str, chunk=CHUNK, overlap=OVERLAP) -> list[int]:
    pieces = [[] if len(x) > chunk else words(x) for x in texts]
    values = piece_counts(name, pieces)
    return [count_long(name, x, chunk, overlap) if len(x) > chunk else sum(map(values.__getitem__, own)) for x, own in zip(texts, pieces)]


def token_counts(docs: DataFrame, name="word_bpe_49k.json", limit=2048, chunk=CHUNK, overlap=OVERLAP, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    Null and empty texts have no tokens. Special strings inside a text count as one token each, as the
    library has it. Repeated rows stay; no rows give no rows. Nothing is shuffled.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            texts = column(batch, "text")
            n = np.array(counts(texts, name, chunk, overlap), np.int64)
            size = np.array([len(x.encode("utf-8", "surrogatepass")) for x in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = whole_texts(docs, doc_id, text)
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, n_tokens long, over_limit boolean")
