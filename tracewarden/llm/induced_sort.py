"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classed as smaller or larger than their right neighbour; the leftmost smaller ones
are sorted by their substrings, recursively where substrings repeat, and induce the order of all
others. Over a small alphabet a bucket is induced by whole arrays: what its suffixes induce goes to
the ends of later buckets in scanning order, and repeats of its own symbol make one more round.
"""

from __future__ import annotations

import numpy as np

# alphabets up to this many symbols, or a bucket of this many symbols on average, are induced by arrays
_SMALL_ALPHABET, _WIDE_BUCKET = 1 << 9, 1 << 6


def classes(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last symbol is the only smallest one."""
    ends = np.flatnonzero(s[:-1] != s[1:])
    smaller = np.repeat(s[ends] < s[ends + 1], np.diff(ends, prepend=-1))
    return np.concatenate([smaller, np.ones(1, bool)])


def _by_symbol(symbols: np.ndarray, places: np.ndarray):
    order = np.argsort(symbols, kind="stable")
    symbols, places = symbols[order], places[order]
    cuts = np.flatnonzero(np.diff(symbols)) + 1
    return zip(symbols[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts))


def _sweep(s, wanted, chars, seeds, reverse):
    """Induce the suffixes marked wanted, bucket by bucket; seeds[c] are scanned after them in bucket c."""
    waiting: dict[int, list[np.ndarray]] = {}
    found: dict[int, np.ndarray] = {}
    none = np.zeros(0, np.int64)

    def spill(places, symbols):
        if len(places):
            for c, part in _by_symbol(symbols, places):
                waiting.setdefault(c, []).append(part)

    for c in (chars[::-1] if reverse else chars).tolist():
        rounds, parts = [], waiting.pop(c, None)
        current = none if parts is None else parts[0] if len(parts) == 1 else np.concatenate(parts)
        while len(current):
            rounds.append(current)
            before = current[current > 0] - 1
            before = before[wanted[before]]
            symbols = s[before]
            own = symbols == c
            current = before[own]
            spill(before[~own], symbols[~own])
        found[c] = none if not rounds else rounds[0] if len(rounds) == 1 else np.concatenate(rounds)
        seed = seeds.get(c)
        if seed is not None and len(seed):
            before = seed[seed > 0] - 1
            before = before[wanted[before]]
            spill(before, s[before])
    return found


def _induce_arrays(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    chars = np.flatnonzero(np.bincount(s))
    larger = _sweep(s, ~smaller, chars, dict(_by_symbol(s[lms], lms)), False)
    least = _sweep(s, smaller, chars, {c: part[::-1] for c, part in larger.items()}, True)
    out = [np.array([len(s) - 1])]
    for c in chars.tolist():
        out += [larger[c], least[c][::-1]]
    return np.concatenate(out)


def _induce_places(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The same one suffix at a time, for alphabets about as large as the text."""
    n, counts = len(s), np.bincount(s)
    ends = np.cumsum(counts)
    heads, tails = (ends - counts).tolist(), ends.tolist()
    # the symbol on the left of each place if its suffix is of the wanted class, else -1; the last entry is for gaps
    left = np.full(n + 1, -1)
    left[1:n] = np.where(smaller[:-1], -1, s[:-1])
    larger_left = left.tolist()
    left[1:n] = np.where(smaller[:-1], s[:-1], -1)
    smaller_left = left.tolist()
    out, last = [-1] * n, tails[:]
    for p, c in zip(lms[::-1].tolist(), s[lms[::-1]].tolist()):
        last[c] -= 1
        out[last[c]] = p
    # both loops read what they have written further on
    for p in out:
        c = larger_left[p]
        if c >= 0:
            out[heads[c]] = p - 1
            heads[c] += 1
    for p in reversed(out):
        c = smaller_left[p]
        if c >= 0:
            tails[c] -= 1
            out[tails[c]] = p - 1
    out[0] = n - 1
    return np.array(out, np.int64)


def sorted_substrings(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leftmost smaller places in the order of their substrings, and where another substring begins.

    One symbol (with its class) a round orders the groups still tied; tied substrings end together.
    """
    length = np.zeros(len(s), np.int64)
    length[lms] = np.append(np.diff(lms) + 1, 1)
    order = lms[np.argsort(s[lms], kind="stable")]
    new = np.concatenate([[True], np.diff(s[order]) != 0])
    place = np.arange(len(order))
    group = np.maximum.accumulate(np.where(new, place, 0))
    scale, step, open_ = 2 * (int(s.max()) + 1), 1, place
    while len(open_):
        fresh = new[open_]
        open_ = open_[~fresh | np.append(~fresh[1:], False)]
        open_ = open_[length[order[open_]] > step]
        if not len(open_):
            break
        p = order[open_]
        key = group[open_] * scale + 2 * s[p + step] + smaller[p + step]
        turn = np.argsort(key, kind="stable")
        order[open_], key = p[turn], key[turn]
        new[open_[1:][key[1:] != key[:-1]]] = True
        group[open_] = np.maximum.accumulate(np.where(new[open_], open_, 0))
        step += 1
    return order, new


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of whole numbers >= 0 whose last one is 0, the only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = classes(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    alphabet = int(s.max()) + 1
    induce = _induce_arrays if alphabet <= _SMALL_ALPHABET or n > _WIDE_BUCKET * alphabet else _induce_places
    order, new = sorted_substrings(s, smaller, lms)
    if not new.all():
        names = np.zeros(n, np.int64)
        names[order] = np.cumsum(new) - 1
        order = lms[suffix_array(names[lms])]
    return induce(s, smaller, order)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the place before it in the suffix array (-1 for the first) and their common prefix.

    Only irreducible places (whose left symbols differ) are compared; each place after one has
    a prefix shorter by one.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    wide = np.concatenate([s.astype(np.uint64), np.zeros(4, np.uint64)])
    words = wide[:-3] | wide[1:-2] << np.uint64(16) | wide[2:-1] << np.uint64(32) | wide[3:] << np.uint64(48)
    place = np.arange(n)
    apart = (before <= 0) | (place == 0)
    inner = np.flatnonzero(~apart)
    apart[inner] = s[inner - 1] != s[before[inner] - 1]
    heads = np.flatnonzero(apart)
    value = np.zeros(len(heads), np.int64)
    open_ = np.flatnonzero(before[heads] >= 0)
    x, y = heads[open_], before[heads[open_]]
    while len(open_):
        same = words[x] == words[y]
        value[open_] += 4 * same
        ended = ~same
        for _ in range(3):
            at = np.flatnonzero(ended)
            at = at[s[x[at]] == s[y[at]]]
            value[open_[at]] += 1
            x[at] += 1
            y[at] += 1
            ended = np.zeros(len(open_), bool)
            ended[at] = True
        open_, x, y = open_[same], x[same] + 4, y[same] + 4
    at = np.searchsorted(heads, place, "right") - 1
    return before, value[at] - (place - heads[at])
