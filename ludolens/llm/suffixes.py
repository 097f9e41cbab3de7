"""Suffix order by difference cover, and the places whose prefix occurs again.

Positions not divisible by three are the sample: among any two positions a step of 0, 1 or 2 leads both into
it. Sampled suffixes are sorted by their triples; the names of the triples form a shorter text that is
sorted the same way, until names cover ``depth`` symbols. The remaining suffixes are sorted by their first
symbol and the rank of the next, and merged with the sample by the step that both share.
"""

import numpy as np

# A packed key of three names must stay below this many bits.
_KEY_BITS = 63


def _names(columns: list[np.ndarray]) -> np.ndarray:
    """Names from 1 on, in the order of the rows of ``columns``; equal rows get equal names."""
    bits = max(1, int(max(c.max(initial=0) for c in columns)).bit_length())
    if bits * len(columns) <= _KEY_BITS:
        key = columns[0].copy()
        for column in columns[1:]:
            key = (key << bits) + column
        order = np.argsort(key)
        key = key[order]
        fresh = key[1:] != key[:-1]
    else:
        order = np.lexsort(columns[::-1])
        fresh = np.zeros(max(0, len(order) - 1), bool)
        for column in columns:
            fresh |= column[order[1:]] != column[order[:-1]]
    names = np.empty(len(order), np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(fresh)])[: len(order)]
    return names


def suffix_order(text: np.ndarray, depth: int, span: int = 1) -> np.ndarray:
    """Positions of ``text`` (whole numbers from 1 on) ordered by at least their first ``depth // span`` symbols."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: tuple(text[i:])), np.int64)
    padded = np.concatenate([text, np.zeros(3, np.int64)])
    # One position past the end keeps the last triple of the first class apart where n % 3 is 1.
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    names = _names([padded[sample], padded[sample + 1], padded[sample + 2]])
    if names.max() < len(sample) and span * 3 < depth:
        order = suffix_order(names, depth, span * 3)
    else:
        order = np.argsort(names, kind="stable")
    sample = sample[order]
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    sample = sample[sample < n]

    ranks, symbols = int(n + 3).bit_length(), int(text.max()).bit_length()
    one = lambda at: (padded[at] << ranks) + rank[at + 1]
    rest = np.arange(0, n, 3)
    rest_key = one(rest)
    order = np.argsort(rest_key)
    rest, rest_key = rest[order], rest_key[order]
    before = np.searchsorted(np.sort(one(sample[sample % 3 == 1])), rest_key)
    second = sample[sample % 3 == 2]
    if ranks + 2 * symbols <= _KEY_BITS:
        two = lambda at: (padded[at] << ranks + symbols) + (padded[at + 1] << ranks) + rank[at + 2]
        before += np.searchsorted(np.sort(two(second)), two(rest))
    else:
        # Too wide for one number: name the symbol pairs first, over both sides together.
        both = np.concatenate([second, rest])
        pair = _names([padded[both], padded[both + 1]])
        key = (pair << ranks) + rank[both + 2]
        before += np.searchsorted(np.sort(key[: len(second)]), key[len(second) :])
    # Equal prefixes may leave the counts of neighbours one apart; the order of ``rest`` holds.
    place = np.maximum.accumulate(before) + np.arange(len(rest))
    out = np.empty(n, np.int64)
    out[place] = rest
    taken = np.zeros(n, bool)
    taken[place] = True
    out[~taken] = sample
    return out


def equal_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Which pairs of places in the bytes ``data`` start the same ``length`` bytes (8 at least)."""
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    alive = np.arange(len(a))
    for step in [*range(0, length - 7, 8), length - 8]:
        alive = alive[words[a[alive] + step] == words[b[alive] + step]]
    equal = np.zeros(len(a), bool)
    equal[alive] = True
    return equal


def repeated_starts(pieces: list[bytes], starts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece, which of its first ``starts[i]`` places start ``length`` bytes that another start has too.

    Equal pieces are sorted once; all their starts are repeated.
    """
    seen: dict[tuple[bytes, int], int] = {}
    which = [seen.setdefault((piece, int(n)), len(seen)) for piece, n in zip(pieces, starts)]
    alone = np.bincount(which, minlength=len(seen)) == 1
    once = _repeated_starts([p for p, _ in seen], np.array([n for _, n in seen], np.int64), length)
    return [once[i] if alone[i] else np.arange(n) for i, n in zip(which, starts)]


def _repeated_starts(pieces: list[bytes], starts: np.ndarray, length: int) -> list[np.ndarray]:
    sizes = np.array([len(p) for p in pieces])
    data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    offset = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = data.astype(np.int64) + 2
    text[offset + sizes] = 1
    own = np.zeros(len(data) + 1, np.int64)
    np.add.at(own, offset, 1)
    np.add.at(own, offset + starts, -1)
    own = np.cumsum(own[:-1]) > 0
    order = suffix_order(text, length)
    order = order[own[order]]
    equal = equal_prefixes(data, order[:-1], order[1:], length)
    again = np.zeros(len(data), bool)
    again[order[:-1][equal]] = True
    again[order[1:][equal]] = True
    return [np.flatnonzero(again[at : at + n]) for at, n in zip(offset, starts)]
