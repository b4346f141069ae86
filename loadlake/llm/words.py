"""Words of a text and their hashes, shared by the operators that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: The white space of every operator, as a character class: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def words(text: str | None) -> list[bytes]:
    """Runs of anything but white space, in UTF-8; ``bytes.split`` splits at exactly the six characters of ``SPACE``."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


class WordHashes(dict):
    """Word to 64-bit hash, kept for words seen lately; at most ``limit`` words are held."""

    def __init__(self, seed: int, limit: int = 60_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, listed: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, listed), np.uint64, len(listed))


class Rolling:
    """Hashes of any run of words of one text from running sums, modulo 2**64."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        if len(Rolling._powers) <= n:
            size = max(4096, 2 * n + 1)
            factor = np.full(size, _ODD, np.uint64)
            inverse = np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
            factor[0] = inverse[0] = 1
            Rolling._powers, Rolling._inverses = np.cumprod(factor), np.cumprod(inverse)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * Rolling._powers[:n], out=self._sums[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of words ``start`` to ``end``, the end left out, for each pair of the two arrays."""
        return scrambled((self._sums[end] - self._sums[start]) * Rolling._inverses[start] + (end - start).astype(np.uint64))


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as a signed long, Spark's only 64-bit type."""
    return x.view(np.int64)


def portions(texts: list[str | None], size: int = 1_000_000) -> Iterator[list[str]]:
    """Texts in groups of about that many characters, NULL as an empty one."""
    group: list[str] = []
    held = 0
    for text in texts:
        group.append(text or "")
        held += len(text or "")
        if held > size:
            yield group
            group, held = [], 0
    yield group
