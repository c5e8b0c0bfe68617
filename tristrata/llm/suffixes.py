"""Suffix arrays of byte rows by two-stage sorting, and their common prefixes.

A suffix is *small* if it precedes its successor (the suffix one byte on), else *large*.
Stage one sorts the small suffixes directly. Stage two scans the buckets of the first byte in
order and induces every large suffix from its successor, which the scan has already passed.
"""

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)


class Row:
    """Symbols 0 to 256 (0 parts the texts) with prefix hashes for comparing stretches."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.symbols, self.depth, self.n = symbols, depth, len(symbols)
        padded = np.concatenate([symbols, np.zeros(depth + 8, symbols.dtype)]).astype(np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(len(padded) + 1, BASE)) * ~BASE
            terms = (padded + np.uint64(1)) * powers[:-1]
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
            self.powers = powers
        # seven symbols of nine bits in one number, in their order
        word = np.zeros(len(padded) - 7, np.uint64)
        for k in range(7):
            word = (word << np.uint64(9)) | padded[k : len(padded) - 7 + k]
        self.words = word

    def alike(self, a: np.ndarray, b: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Whether the stretches of ``length`` from ``a`` and from ``b`` are equal."""
        top = self.n + self.depth
        i, j = np.minimum(a + length, top), np.minimum(b + length, top)
        with np.errstate(over="ignore"):
            left = (self.sums[i] - self.sums[a]) * self.powers[b]
            right = (self.sums[j] - self.sums[b]) * self.powers[a]
        return left == right

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes ``a`` and ``b``, ``depth`` at most."""
        found = np.zeros(len(a), np.int64)
        step = 1 << (self.depth.bit_length() - 1)
        while step:
            longer = np.minimum(found + step, self.depth)
            found = np.where(self.alike(a, b, longer), longer, found)
            step >>= 1
        return found


def small_suffixes(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix precedes its successor; the last one does not."""
    change = np.diff(symbols.astype(np.int16), append=np.int16(-1))
    place = np.where(change != 0, np.arange(len(change)), len(change))
    following = np.minimum.accumulate(place[::-1])[::-1]  # the next change decides
    return change[following] > 0


def directly_sorted(row: Row, at: np.ndarray) -> np.ndarray:
    """Suffixes ``at`` in order of their first ``depth`` symbols.

    Ties are sorted on: the stretch that all of a group share is skipped, the next symbols
    split it.
    """
    order = at[np.argsort(row.words[at], kind="stable")]
    word = row.words[order]
    group = np.cumsum(np.concatenate([[0], (word[1:] != word[:-1]).astype(np.int64)]))
    open_at = np.arange(len(order))
    while len(open_at):
        g = group[open_at]
        sizes = np.bincount(g - g[0]) if len(g) else np.empty(0, np.int64)
        keep = sizes[g - g[0]] > 1
        open_at, g = open_at[keep], g[keep]
        if not len(open_at):
            break
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        suffix = order[open_at]
        shared = np.full(len(suffix), row.depth, np.int64)
        pair = np.flatnonzero(g[1:] == g[:-1])
        shared[pair] = row.common(suffix[pair], suffix[pair + 1])
        least = np.minimum.reduceat(shared, first)
        spread = np.diff(np.concatenate([first, [len(g)]]))
        skip = np.repeat(least, spread)
        live = skip < row.depth
        open_at, g, suffix, skip = open_at[live], g[live], suffix[live], skip[live]
        if not len(open_at):
            break
        word = row.words[np.minimum(suffix + skip, len(row.words) - 1)]
        turn = np.lexsort((word, g))
        order[open_at] = suffix[turn]
        word = word[turn]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (word[1:] != word[:-1])])
        group[open_at] = open_at[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return order


def with_successors(wanted: np.ndarray, small: np.ndarray) -> np.ndarray:
    """``wanted`` suffixes and those that inducing them takes: large ones up to the next small."""
    n = len(wanted)
    place = np.where(small, np.arange(n), n - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]
    change = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(wanted)
    np.add.at(change, at, 1)
    np.add.at(change, following[at] + 1, -1)
    return np.cumsum(change[:-1]) > 0


def suffix_array(row: Row, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of a row in order of their first ``depth`` symbols or more.

    With ``wanted`` only those, and the few that are needed to induce them.
    """
    symbols, n = row.symbols, row.n
    if n == 0:
        return np.empty(0, np.int64)
    small = small_suffixes(symbols)
    used = np.ones(n, bool) if wanted is None else with_successors(wanted, small)
    kinds = int(symbols.max()) + 1
    sizes = np.bincount(symbols[used], minlength=kinds)
    larges = np.bincount(symbols[used & ~small], minlength=kinds)
    start = np.cumsum(sizes) - sizes
    out = np.empty(int(used.sum()), np.int64)
    direct = directly_sorted(row, np.flatnonzero(used & small))
    first = symbols[direct]
    within = np.arange(len(direct)) - np.searchsorted(first, first, side="left")
    out[start[first] + larges[first] + within] = direct
    head = start.copy()
    if used[-1]:
        out[head[symbols[-1]]] = n - 1  # before all others of its bucket: nothing follows it
        head[symbols[-1]] += 1
    for c in np.flatnonzero(sizes).tolist():
        done = start[c]
        while done < head[c]:  # large suffixes that repeat the byte
            wave = out[done : head[c]]
            done = head[c]
            before = wave[wave > 0] - 1
            before = before[used[before] & (symbols[before] == c)]
            out[head[c] : head[c] + len(before)] = before
            head[c] += len(before)
        before = out[start[c] : start[c] + sizes[c]]
        before = before[before > 0] - 1
        byte = symbols[before]
        larger = used[before] & (byte > c)
        before, byte = before[larger], byte[larger]
        turn = np.argsort(byte, kind="stable")
        before, byte = before[turn], byte[turn]
        within = np.arange(len(byte)) - np.searchsorted(byte, byte, side="left")
        out[head[byte] + within] = before
        head += np.bincount(byte, minlength=kinds)
    return out
