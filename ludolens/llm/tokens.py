"""Token ids of whole texts, with the ids of each word looked up once while it is remembered.

The vocabulary splits text into words before it merges, so a word's ids do not
depend on its neighbours. Texts made of plain Latin characters are split
here and each distinct word is encoded once, together with the other new words of its
batch: the ids of each word end with one that closes a word. All other texts, and texts that
may spell a special token, are encoded whole.
"""

import re
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# Fixed value: how the vocabulary splits text, for characters of the plain range.
_PLAIN = [chr(c) for c in (*range(9, 14), *range(32, 127), *range(0xA0, 0x130))]
_LETTERS = re.escape("".join(c for c in _PLAIN if unicodedata.category(c)[0] == "L"))
_NUMBERS = re.escape("".join(c for c in _PLAIN if unicodedata.category(c)[0] == "N"))
_SPACES = "\t\n\v\f\r \xa0"
WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
)
_NOT_PLAIN = re.compile("[^\t-\r -~\xa0-į]")

# Words remembered by a worker process over its tasks; beyond it the memory starts anew.
_REMEMBERED = 300_000


# What ids that close a word end with.
_CLOSES = "</w>"


class WordEncoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        entries = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.closes = np.array([(entry or "").endswith(_CLOSES) for entry in entries])
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of ``words``, from one call for all of them."""
        ids = self._whole(" ".join(words))
        ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
        if len(ends) != len(words):
            self.known.update((word, self._whole(word).tobytes()) for word in words)
            return
        data, edges = ids.tobytes(), [0, *ends.tolist()]
        self.known.update((word, data[i:j]) for word, i, j in zip(words, edges, edges[1:]))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        words = [None if "<|" in t or _NOT_PLAIN.search(t) else WORDS.findall(t.lower()) for t in texts]
        known = self.known
        fresh = list(set().union(*filter(None, words)).difference(known))
        if fresh:
            self._learn(fresh)
        return [
            self._whole(text).tobytes() if found is None else b"".join(map(known.__getitem__, found))
            for text, found in zip(texts, words)
        ]

    def encode(self, text: str) -> bytes:
        """Ids of one whole text."""
        return self.encode_all([text])[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per file and worker process."""
    return WordEncoder(path)
