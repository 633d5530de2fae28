"""Edit distances of many pairs at once, in numpy: a column of the distance table is kept as bits, a step for each base of the targets.

The functions take texts as Texts and pairs as places in them, and give what sequences.anchored_distance gives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Pairs that are worked on together; their bits stay in the processor's cache.
PAIRS = 1 << 14
_ONE = np.uint64(1)


class Texts:
    """Texts as numbers of their characters, one behind the other; nulls are empty."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        if data.size and data.max() >= 128:
            points = [np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in texts.to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in points])]).astype(np.int64)
            data = np.concatenate(points)
            kinds, codes = np.unique(data, return_inverse=True)
        else:
            kinds = np.flatnonzero(np.bincount(data, minlength=1))
            number = np.zeros(256, np.int64)
            number[kinds] = np.arange(len(kinds))
            codes = number[data]
        self.codes, self.kinds = codes, max(1, len(kinds))
        self.starts, self.lengths = offsets[:-1] - offsets[0], np.diff(offsets)


def budgets(lengths: np.ndarray, fraction: float) -> np.ndarray:
    """As sequences.edit_budget."""
    return np.maximum(1, np.rint(lengths * fraction).astype(np.int64))


def prefix_edits(texts: Texts, query: np.ndarray, target: np.ndarray, budget: np.ndarray) -> np.ndarray:
    """The least edit distance of each query to a prefix of its target, -1 above the budget."""
    out = np.full(len(query), -1, np.int64)
    m, n = texts.lengths[query], texts.lengths[target]
    near = np.flatnonzero(n >= m - budget)
    # Only so many bases of a target can be within the budget; pairs that end first come last.
    steps = np.minimum(n, m + budget)[near]
    near = near[np.lexsort((-steps, (m[near] + 63) // 64))]
    for i in range(0, len(near), PAIRS):
        part = near[i : i + PAIRS]
        d = (_short if m[part[-1]] <= 64 else _distances)(texts, query[part], target[part], np.minimum(n, m + budget)[part], budget[part])
        out[part] = np.where(d <= budget[part], d, -1)
    return out


def _short(texts: Texts, query: np.ndarray, target: np.ndarray, steps: np.ndarray, budget: np.ndarray) -> np.ndarray:
    """As _distances where queries have at most 64 bases: a word each. Pairs that can't come within the budget any more are left out, and distances are read off where they may be."""
    out = np.full(len(query), 1 << 30, np.int64)
    own, row = np.unique(query, return_inverse=True)
    size = texts.lengths[own]
    held = np.zeros(len(own) * texts.kinds, np.uint64)
    for i in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > i)
        held[has * texts.kinds + texts.codes[texts.starts[own[has]] + i]] |= _ONE << np.uint64(i)
    m = texts.lengths[query]
    out[m <= budget] = m[m <= budget]
    pair = np.flatnonzero(steps > 0)
    pair = pair[np.argsort(-steps[pair], kind="stable")]
    row, start, m, steps, budget = row[pair] * texts.kinds, texts.starts[target[pair]], m[pair], steps[pair], budget[pair]
    # A query without bases has no bits.
    mask = np.where(m > 0, ~np.uint64(0) >> np.minimum(64 - m, 63).astype(np.uint64), 0).astype(np.uint64)
    plus, minus = np.full(len(pair), ~np.uint64(0)), np.zeros(len(pair), np.uint64)
    j = 0
    while len(pair):
        same = held[row + texts.codes[start + j]]
        x = same | minus
        h = (((same & plus) + plus) ^ plus) | same
        up, down = minus | ~(h | plus), plus & h
        up, down = up << _ONE | _ONE, down << _ONE
        plus, minus = down | ~(x | up), up & x
        j += 1
        near = j >= (m - budget).min()
        if near or j % 6 == 0 or steps[-1] == j:
            # The table's first row is j there, and the bits are the steps from row to row.
            now = j + np.bitwise_count(plus & mask).astype(np.int64) - np.bitwise_count(minus & mask)
            if near:
                out[pair] = np.minimum(out[pair], now)
            on = np.flatnonzero((steps > j) & (now - (steps - j) <= budget))
            if len(on) < 0.9 * len(pair) or steps[-1] == j:
                pair, row, start, m, steps, budget, mask, plus, minus = (v[on] for v in (pair, row, start, m, steps, budget, mask, plus, minus))
    return out


def _distances(texts: Texts, query: np.ndarray, target: np.ndarray, steps: np.ndarray, budget: np.ndarray) -> np.ndarray:
    order = np.argsort(-steps, kind="stable")
    query, target, steps = query[order], target[order], steps[order]
    own, row = np.unique(query, return_inverse=True)
    size = texts.lengths[own]
    most = int(size.max(initial=0))
    n_words = max(1, -(-most // 64))
    # For each query and character, the places that hold it.
    held = np.zeros((n_words, len(own) * texts.kinds), np.uint64)
    for i in range(most):
        has = np.flatnonzero(size > i)
        held[i // 64, has * texts.kinds + texts.codes[texts.starts[own[has]] + i]] |= _ONE << np.uint64(i % 64)
    m = texts.lengths[query]
    row, start = row * texts.kinds, texts.starts[target]
    last, top = (m - 1) // 64, ((m - 1) % 64).astype(np.uint64)
    now, least = m.copy(), m.copy()
    plus, minus = np.full((n_words, len(query)), ~np.uint64(0)), np.zeros((n_words, len(query)), np.uint64)
    active = np.searchsorted(-steps, -np.arange(1, int(steps.max(initial=0)) + 1), side="right")
    for j, a in enumerate(active):
        at = row[:a] + texts.codes[start[:a] + j]
        up_in, down_in = _ONE, np.uint64(0)
        for w in range(n_words):
            p, q, same = plus[w, :a], minus[w, :a], held[w, at]
            x = same | q
            same = same | down_in
            h = (((same & p) + p) ^ p) | same
            up, down = q | ~(h | p), p & h
            change = ((up >> top[:a]) & _ONE).astype(np.int64) - ((down >> top[:a]) & _ONE).astype(np.int64)
            now[:a] += change if n_words == 1 else np.where(last[:a] == w, change, 0)
            up_out, down_out = up >> np.uint64(63), down >> np.uint64(63)
            up, down = up << _ONE | up_in, down << _ONE | down_in
            plus[w, :a], minus[w, :a] = down | ~(x | up), up & x
            up_in, down_in = up_out, down_out
        np.minimum(least[:a], now[:a], out=least[:a])
    out = np.empty(len(query), np.int64)
    out[order] = np.where(m == 0, 0, least)
    return out


def fold(texts: Texts, rows: np.ndarray, group: np.ndarray, fraction: float) -> np.ndarray:
    """For each of rows, which are in order in groups that lie together, the number of the seed in its group that it joins.

    The first of a group is a seed, and all that match it join it, as no seed is before it. So is the first of those that are left, and so
    on; a round takes one seed of each group.
    """
    own = np.full(len(rows), -1, np.int64)
    k = budgets(texts.lengths[rows], fraction)
    left, number = np.arange(len(rows)), 0
    while len(left):
        g = group[left]
        new = np.concatenate([[True], g[1:] != g[:-1]])
        own[left[new]] = number
        seed = left[new][np.cumsum(new) - 1][~new]
        left = left[~new]
        fits = prefix_edits(texts, rows[left], rows[seed], k[left]) >= 0
        own[left[fits]] = number
        left, number = left[~fits], number + 1
    return own
