"""Words of texts and their hashes, shared by the operators on word runs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from itertools import chain

import numpy as np

#: Runs of letters or digits.
WORD = re.compile(r"[^\W_]+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public constants of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Blanks for the ASCII characters that are no letters or digits.
_ASCII = {i: " " for i in range(128) if not chr(i).isalnum()}


def words_of(text: str) -> list[str]:
    """The words of the lower-cased text."""
    low = text.lower()
    return low.translate(_ASCII).split() if low.isascii() else WORD.findall(low)


class Kept(dict):
    """Values of `make` by their argument; all are forgotten where there are `most`."""

    def __init__(self, make: Callable, most: int) -> None:
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _word_hash(w: str) -> int:
    return int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class WordHasher:
    """64-bit hashes of words; those of frequent words are kept."""

    KEEP = 200_000

    def __init__(self) -> None:
        self.known = Kept(_word_hash, self.KEEP)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes of the texts one after another, the text number of each, and the number of words of each text."""
        lists = [words_of(t) for t in texts]
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), dtype=np.uint64, count=int(sizes.sum()))
        return flat, np.repeat(np.arange(len(texts)), sizes), sizes


def run_hashes(flat: np.ndarray, doc: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `run` words that lie within one text, in order, and their text numbers."""
    n = len(flat) - run + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(run):
        h = mix(h * _GOLDEN + flat[k : k + n])
    ok = doc[:n] == doc[run - 1 :]
    return h[ok], doc[:n][ok]
