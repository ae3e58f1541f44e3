r"""Token ids piece by piece, equal to those of the whole text.

Both vocabularies are cut into pre-tokens by a pattern, and merges never leave a pre-token. A text may
therefore be cut wherever the pattern is bound to end one match and to start the next whatever
surrounds it; each distinct piece is then encoded once by the library and remembered.

* Byte-level, spaces kept: `` ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``. A cut before a space
  is safe unless white space stands on both sides of it: what ends before the space cannot reach over
  it, and the pattern only looks ahead. Texts with such a place are cut before white space that
  follows something else, which is safe without exception.
* White space dropped: any ASCII white space is a safe cut.

Special strings hold no white space, so no cut divides one.
"""

import re

import numpy as np
import public_tokenizers

from ledgerloom.llm.common import worker_state

BEFORE_SPACE = re.compile(r"(?<=\S)(?=[ \t-\r])")
#: A space after white space other than a space.
SPACE_AFTER = re.compile(r"[\t-\r\x1c-\x1f] ")
#: Characters a worker remembers, with 100 for each piece; beyond, it forgets all and starts anew.
REMEMBERED = 60_000_000
AT_ONCE = 20_000


def tokenizer(name: str):
    """The tokenizers library's reader of a vocabulary file; once for each worker."""
    kept = worker_state()
    if name not in kept:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        kept[name] = Tokenizer.from_file(public_tokenizers.path(name) if "/" not in name else name)
        kept[name].no_truncation()
        kept[name].no_padding()
    return kept[name]


def piece_counts(name: str, lists) -> dict:
    """Tokens of every piece in the lists, as a dict that may hold more; for a vocabulary that drops
    white space. New pieces are encoded as one text, and its tokens dealt to them by their offsets."""
    kept = worker_state().setdefault((name, "counts"), {"size": 0, "values": {}})
    if kept["size"] > REMEMBERED:
        kept["size"], kept["values"] = 0, {}
    values = kept["values"]
    new = list(set().union(*lists).difference(values))
    for at in range(0, len(new), AT_ONCE):
        part = new[at : at + AT_ONCE]
        starts = np.cumsum([0, *map(len, part[:-1])]) + np.arange(len(part))
        encoded = tokenizer(name).encode(" ".join(part), add_special_tokens=False)
        own = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded))
        values.update(zip(part, np.bincount(np.searchsorted(starts, own, "right") - 1, minlength=len(part)).tolist()))
    kept["size"] += sum(map(len, new)) + 100 * len(new)
    return values


def byte_ranks(name: str):
    """The same vocabulary as ``byte_bpe_50k.json`` read by tiktoken, which gives the same ids faster; its
    special string is the id after the last."""
    import base64

    import tiktoken

    kept = worker_state()
    if name not in kept:
        with open(public_tokenizers.path(name) if "/" not in name else name, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        kept[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    return kept[name]


#: Longer pieces go to the tokenizers library: the other one's pattern fails on very long runs.
LONG = 500


def byte_encoder(ranks: str, name: str):
    """Function from a piece to its ids."""
    short, whole = byte_ranks(ranks).encode, tokenizer(name).encode

    def encode(piece):
        return short(piece, allowed_special="all") if len(piece) <= LONG else whole(piece, add_special_tokens=False).ids

    return encode


class Remembered(dict):
    """Values of pieces, made when first asked for; forgotten between batches once they are many."""

    def __init__(self, make):
        super().__init__()
        self.make, self.size = make, 0

    def __missing__(self, piece):
        self[piece] = found = self.make(piece)
        self.size += len(piece) + 100
        return found

    def trimmed(self):
        if self.size > REMEMBERED:
            self.clear()
            self.size = 0
        return self


def remembered(key, make) -> Remembered:
    """The worker's own, so that later tasks find what earlier ones made; others are given up, and with a key of plain text,
    whose values no tokenizer makes, so are tokenizers."""
    kept = worker_state()
    for other in [k for k, v in kept.items() if k != key and not str(k).startswith("__") and (isinstance(key, str) or hasattr(v, "trimmed"))]:
        del kept[other]
    if key not in kept:
        kept[key] = Remembered(make)
    return kept[key].trimmed()


def spaced_pieces(text: str) -> list[str]:
    """Pieces of a text whose spaces are kept; together they are the text."""
    first, *rest = text.split(" ")
    if "  " in text or not text.isascii() or SPACE_AFTER.search(text):
        last = first
        for piece in rest:
            if (not last or last[-1].isspace()) and (not piece or piece[0].isspace()):
                return BEFORE_SPACE.split(text)
            last = piece
    return [first, *[" " + piece for piece in rest]]
