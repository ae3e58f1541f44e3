"""Name similarity on Arrow batches: indel ratios after the published fuzzy-ratio definitions.

Spark decides which pairs meet; these helpers only score the pairs of one Arrow batch, all pairs at
once, with bit-parallel longest common subsequences in numpy words.
"""

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship these helpers with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = 64


def _encode(strings, table):
    """Padded code matrix; 0 is padding."""
    width = max(map(len, strings), default=0)
    codes = np.zeros((len(strings), max(width, 1)), dtype=np.int64)
    for row, text in enumerate(strings):
        codes[row, : len(text)] = [table[c] for c in text]
    return codes


def _masks(patterns, table, codes):
    masks = np.zeros((len(patterns), len(table) + 1), dtype=np.uint64)
    rows = np.arange(len(patterns))
    for position in range(codes.shape[1]):
        column = codes[:, position]
        masks[rows, column] |= np.uint64(1 << position)
    masks[:, 0] = 0
    return masks


def _long_lcs(a, b):
    """Same recurrence on Python integers, for patterns beyond one machine word."""
    masks = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        used = state & masks.get(c, 0)
        state = ((state + used) | (state - used)) & full
    return len(a) - state.bit_count()


def lcs_lengths(lefts, rights):
    """Longest common subsequence length of every pair."""
    out = np.zeros(len(lefts), dtype=np.int64)
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(lefts, rights)]
    short = [i for i, (a, b) in enumerate(pairs) if 0 < len(a) <= WORD]
    for i, (a, b) in enumerate(pairs):
        if len(a) > WORD:
            out[i] = _long_lcs(a, b)
    if not short:
        return out
    short.sort(key=lambda i: len(pairs[i][1]))
    for begin in range(0, len(short), 4096):
        part = short[begin : begin + 4096]
        a, b = [pairs[i][0] for i in part], [pairs[i][1] for i in part]
        table = {c: n + 1 for n, c in enumerate(sorted(set("".join(a)) | set("".join(b))))}
        masks = _masks(a, table, _encode(a, table))
        codes, rows = _encode(b, table), np.arange(len(part))
        state = np.full(len(part), ~np.uint64(0))
        for position in range(codes.shape[1]):
            used = state & masks[rows, codes[:, position]]
            state = (state + used) | (state - used)
        out[part] = np.bitwise_count(~state)
    return out


def partial_ratios(lefts, rights):
    """Best ratio of the shorter string against any window of the longer one (0-100)."""
    out = np.zeros(len(lefts))
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(lefts, rights)]
    jobs, owner = [], []
    for i, (a, b) in enumerate(pairs):
        if not a:
            continue
        if a in b:
            out[i] = 100.0
            continue
        jobs.append((a, b))
        owner.append(i)
        if len(a) == len(b):
            jobs.append((b, a))
            owner.append(i)
    order = sorted(range(len(jobs)), key=lambda j: (len(jobs[j][1]), len(jobs[j][0])))
    for begin in range(0, len(order), 4096):
        part = order[begin : begin + 4096]
        narrow = [j for j in part if len(jobs[j][0]) <= WORD]
        if narrow:
            best = _window_best([jobs[j][0] for j in narrow], [jobs[j][1] for j in narrow])
            np.maximum.at(out, [owner[j] for j in narrow], best)
        for j in part:
            if len(jobs[j][0]) > WORD:
                out[owner[j]] = max(out[owner[j]], _long_window_best(*jobs[j]))
    return out


def _window_best(a, b):
    table = {c: n + 1 for n, c in enumerate(sorted(set("".join(a)) | set("".join(b))))}
    masks = _masks(a, table, _encode(a, table))
    codes, rows = _encode(b, table), np.arange(len(a))
    n = np.array([len(x) for x in a])
    m = np.array([len(x) for x in b])
    best = np.zeros(len(a))
    widest, steps = codes.shape[1], int(n.max())
    for start in range(widest):
        state = np.full(len(a), ~np.uint64(0))
        window = np.minimum(n, m - start)
        for k in range(min(steps, widest - start)):
            code = np.where(k < window, codes[:, start + k], 0)
            used = state & masks[rows, code]
            state = (state + used) | (state - used)
            if start == 0:
                ratio = 200.0 * np.bitwise_count(~state) / (n + k + 1)
                best = np.where(k < window, np.maximum(best, ratio), best)
        if start:
            ratio = 200.0 * np.bitwise_count(~state) / np.maximum(n + window, 1)
            best = np.where(window > 0, np.maximum(best, ratio), best)
    return best


def _long_window_best(a, b):
    n, m = len(a), len(b)
    spans = [(0, k) for k in range(1, n)] + [(s, min(s + n, m)) for s in range(m)]
    return max(200.0 * _long_lcs(a, b[s:e]) / (n + e - s) for s, e in spans)


def _ratio(lcs, left_size, right_size):
    total = left_size + right_size
    return 200.0 * lcs / total if total else 0.0


def _parts(a, b):
    ta, tb = set(a.split()), set(b.split())
    common = ta & tb
    return " ".join(sorted(common)), " ".join(sorted(ta - common)), " ".join(sorted(tb - common))


def token_set_scores(lefts, rights):
    """Token-set ratio (0-100)."""
    parts = [_parts(a, b) for a, b in zip(lefts, rights)]
    lcs = lcs_lengths([p[1] for p in parts], [p[2] for p in parts])
    return np.array([_token_set(p, l) for p, l in zip(parts, lcs)], dtype=float)


def _token_set(parts, lcs):
    common, rest_a, rest_b = parts
    if not common and (not rest_a or not rest_b):
        return 0.0
    if common and (not rest_a or not rest_b):
        return 100.0
    size = len(common)
    gap = 1 if size else 0
    full_a, full_b = size + gap + len(rest_a), size + gap + len(rest_b)
    distance = len(rest_a) + len(rest_b) - 2 * lcs
    best = 100.0 * (1 - distance / (full_a + full_b))
    if size:
        best = max(
            best,
            100.0 * (1 - (gap + len(rest_a)) / (size + full_a)),
            100.0 * (1 - (gap + len(rest_b)) / (size + full_b)),
        )
    return best


def name_scores(lefts, rights):
    """Highest of token-set, token-sort, partial and weighted ratio; 0 if empty, 100 if equal."""
    scores = np.zeros(len(lefts))
    todo = []
    for i, (a, b) in enumerate(zip(lefts, rights)):
        if a and b:
            if a == b:
                scores[i] = 100.0
            else:
                todo.append(i)
    if not todo:
        return scores
    a, b = [lefts[i] for i in todo], [rights[i] for i in todo]
    sorted_a, sorted_b = [" ".join(sorted(x.split())) for x in a], [" ".join(sorted(x.split())) for x in b]
    sizes = [(len(x), len(y)) for x, y in zip(a, b)]
    best = token_set_scores(a, b)
    for x, y in ((a, b), (sorted_a, sorted_b)):
        plain = [_ratio(l, len(p), len(q)) for l, p, q in zip(lcs_lengths(x, y), x, y)]
        best = np.maximum(best, plain)
    best = np.maximum(best, partial_ratios(a, b))
    wide = [j for j, (p, q) in enumerate(sizes) if max(p, q) / min(p, q) >= 1.5]
    if wide:
        parts = [_parts(a[j], b[j]) for j in wide]
        by_sort = partial_ratios([sorted_a[j] for j in wide], [sorted_b[j] for j in wide])
        by_rest = partial_ratios([p[1] for p in parts], [p[2] for p in parts])
        token_partial = [100.0 if p[0] else max(s, r) for p, s, r in zip(parts, by_sort, by_rest)]
        scale = [0.9 if max(sizes[j]) / min(sizes[j]) <= 8 else 0.6 for j in wide]
        best[wide] = np.maximum(best[wide], np.array(token_partial) * 0.95 * np.array(scale))
    scores[todo] = best
    return scores


# --- close names of two blocks -------------------------------------------------------------------

SYMBOLS, LEVELS, TILE = 64, 4, 1 << 17


class _Block:
    """Names of one length as codes, bit sets of letter counts and hashed words."""

    def __init__(self, names):
        words = [sorted(set(n.split(" "))) for n in names]
        fulls = [" ".join(w) for w in words]
        self.names, size = np.array(names, dtype=object), len(fulls[0])
        self.size = size
        text = np.array(fulls, dtype=f"U{size}")
        self.codes = text.view(np.uint32).reshape(len(fulls), size)
        # Characters that share a symbol only make two names look closer.
        symbols = self.codes % SYMBOLS
        counts = np.zeros((len(fulls), SYMBOLS), dtype=np.int32)
        np.add.at(counts, (np.arange(len(fulls))[:, None], symbols), 1)
        levels = counts[:, :, None] > np.arange(LEVELS)
        self.bits = np.packbits(levels.reshape(len(fulls), -1), axis=1).view(np.uint64)
        self.words = np.full((len(fulls), max(map(len, words))), -1, dtype=np.int64)
        for row, found in enumerate(words):
            self.words[row, : len(found)] = [hash(w) >> 1 for w in found]


def _share_word(a, b, i, j):
    out = np.zeros(len(i), dtype=bool)
    for x in range(a.words.shape[1]):
        left = a.words[i, x]
        for y in range(b.words.shape[1]):
            out |= (left == b.words[j, y]) & (left != -1)
    return out


def _block_lcs(a, b, i, j):
    """Common subsequences of rows i of a, up to one machine word long, and rows j of b."""
    letters = np.unique(np.concatenate([a.codes.ravel(), b.codes.ravel()]))
    mine, theirs = np.searchsorted(letters, a.codes), np.searchsorted(letters, b.codes)
    masks = np.zeros((len(mine), len(letters)), dtype=np.uint64)
    for at in range(a.size):
        masks[np.arange(len(mine)), mine[:, at]] |= np.uint64(1 << at)
    state = np.full(len(i), ~np.uint64(0))
    for at in range(b.size):
        used = state & masks[i, theirs[j, at]]
        state = (state + used) | (state - used)
    return np.bitwise_count(~state).astype(np.int64)


def _close(a, b):
    """Index pairs that letter counts and common subsequences leave; pairs with a common word pass the latter."""
    allowed = int(0.2 * (a.size + b.size) + 1e-9)
    used = np.flatnonzero((a.bits != 0).any(axis=0) | (b.bits != 0).any(axis=0))
    rights = [np.ascontiguousarray(b.bits[:, w]) for w in used]
    step = max(1, TILE // len(b.names))
    for begin in range(0, len(a.names), step):
        apart = np.zeros((min(step, len(a.names) - begin), len(b.names)), dtype=np.uint16)
        for w, right in zip(used, rights):
            apart += np.bitwise_count(a.bits[begin : begin + step, w][:, None] ^ right)
        i, j = np.nonzero(apart <= allowed)
        i += begin
        if len(i) and a.size <= WORD:
            near = a.size + b.size - 2 * _block_lcs(a, b, i, j) <= allowed
            near[~near] = _share_word(a, b, i[~near], j[~near])
            i, j = i[near], j[near]
        if len(i):
            yield i, j


def close_names(batches):
    """Pairs of names of (l_block, l_names, r_block, r_names) block pairs that may have close rests."""
    kept = {}

    def block(key, names):
        if key not in kept:
            if len(kept) >= 32:
                kept.pop(next(iter(kept)))
            kept[key] = _Block(names.as_py())
        return kept[key]

    for batch in batches:
        for row in range(batch.num_rows):
            a, b = (block(batch.column(f"{side}_block")[row].as_py(), batch.column(f"{side}_names")[row]) for side in "lr")
            for i, j in _close(a, b):
                yield pa.RecordBatch.from_arrays([pa.array(a.names[i], pa.string()), pa.array(b.names[j], pa.string())], ["left_name", "right_name"])


def _by_distinct_pair(score, left, right):
    """Score each different pair of the batch once."""
    pairs = list(zip(left.fillna(""), right.fillna("")))
    distinct = list(dict.fromkeys(pairs))
    values = dict(zip(distinct, score([p[0] for p in distinct], [p[1] for p in distinct])))
    return pd.Series([float(values[p]) for p in pairs])


@F.pandas_udf(DoubleType())
def name_score(left: pd.Series, right: pd.Series) -> pd.Series:
    return _by_distinct_pair(name_scores, left, right)


@F.pandas_udf(DoubleType())
def token_set_score(left: pd.Series, right: pd.Series) -> pd.Series:
    return _by_distinct_pair(token_set_scores, left, right)
