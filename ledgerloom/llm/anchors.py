"""Sampled anchors for finding windows of a fixed length that occur more than once.

Every window of ``length`` symbols holds ``length - gram + 1`` grams; its anchor is the leftmost of those
with the least hash, so equal windows have anchors with equal grams at the same place. Windows that
follow each other and share an anchor form a block, some 2 for every ``length - gram`` symbols. A window
can therefore only occur again in a block whose anchor's gram occurs again, and of all symbols only one
row for each block is shuffled.

Hashes of grams and blocks are differences of prefix sums of symbol values times powers of an odd base,
modulo 2**64, so each costs a few array operations whatever its length.
"""

import numpy as np

#: Symbols worked on at once; a longer text is cut, its windows divided among the parts.
PART = 1 << 22
_POSITION = np.uint64((1 << 24) - 1)
_random = np.random.default_rng(20240607)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def mixed(x):
    """Spreads the information of all bits over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of a base and of its inverse, as far as needed so far."""

    def __init__(self, base):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), None, None

    def upto(self, n):
        if self.up is None or len(self.up) < n:
            size = max(n, 1 << 12, 0 if self.up is None else 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))), dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


class Hashes:
    """Hashes of any stretch of a sequence of 64-bit symbol values."""

    def __init__(self, values, powers: Powers):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)))

    def of(self, starts, ends):
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, size):
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def least(keys, width):
    """Minimum of every ``width`` successive keys."""
    done = 1
    while done * 2 <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    return np.minimum(keys[: len(keys) - (width - done)], keys[width - done :]) if done < width else keys


def blocks(values, length, gram, powers):
    """(first window, windows, anchor key, block hash) of every block, as four arrays.

    The block hash covers all symbols of the block's windows; both hashes are signed 64-bit integers.
    """
    found = []
    for at in range(0, max(len(values) - length + 1, 0), PART):
        part = values[at : at + PART + length - 1]
        hashes = Hashes(part, powers[0])
        grams = hashes.grams(gram)
        keys = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        anchors = (least(keys, length - gram + 1) & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
        size = np.diff(np.concatenate((first, [len(anchors)])))
        own = Hashes(part, powers[1]).of(first, first + size + length - 1)
        found.append((first + at, size, grams[anchors[first]].view(np.int64), own.view(np.int64)))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.empty(0, np.int64),) * 4


def powers():
    return tuple(map(Powers, BASES))


def merged(starts, ends):
    """Union of half-open ranges as sorted, disjoint, non-touching ones."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1])) if len(starts) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return starts[first], reach[np.concatenate((first[1:] - 1, [len(starts) - 1]))] if len(starts) else reach
