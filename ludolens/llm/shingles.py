"""Hashes of word shingles, computed for many texts at once.

Words are runs of characters other than ASCII white space, in lower case. A
shingle is ``size`` words in a row; a shorter text that has words is one
shingle. The n-th time a shingle occurs in a text it counts as another element,
so that sets of elements compare like counts of shingles.
"""

from typing import NamedTuple

import numpy as np

_U = np.uint64
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _multipliers(count: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BYTE = _multipliers(256, 1)


class Elements(NamedTuple):
    """Elements of all texts, text by text: those of text ``i`` are ``start[i]`` to ``start[i + 1]``."""

    hashes: np.ndarray
    start: np.ndarray

    def text(self) -> np.ndarray:
        """The text of each element."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words start among them."""
    encoded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(e) + 1 for e in encoded])
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    word = np.cumsum(~space & before) - 1
    inside = np.flatnonzero(~space)
    place = inside - starts[word[inside]]
    terms = np.zeros(len(data), np.uint64)
    terms[inside] = _BYTE[data[inside]] * _multipliers(int(place.max()) + 1, 2)[place]
    hashes = mixed(np.add.reduceat(terms, starts))
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends)])


def shingle_elements(texts: list[str], size: int) -> Elements:
    words, first = _word_hashes(texts)
    counts = np.diff(first)
    weights = _multipliers(size, 3)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    full = sum((padded[i : len(words) + i] * weights[i] for i in range(size)), np.zeros(len(words), np.uint64))
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[first[i] : first[i + 1]]
        full[first[i]] = (own * weights[: len(own)]).sum(dtype=np.uint64)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    start = np.concatenate([[0], np.cumsum(made)])
    text = np.repeat(np.arange(len(texts)), made)
    hashes = mixed(full[first[text] + np.arange(len(text)) - start[text]])
    order = np.lexsort((hashes, text))
    hashes = hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    runs = np.flatnonzero(fresh)
    nth = np.arange(len(hashes)) - np.repeat(runs, np.diff(np.append(runs, len(hashes))))
    return Elements(mixed(hashes + nth.astype(np.uint64) * _U(0xD6E8FEB86659FD93)), start)
