"""Word shingles, MinHash signatures and their byte-level kernels.

Everything here works on one text inside a task; Spark deals the texts out.
A word is a run of bytes that are not ASCII white space (space, tab to
carriage return), lower-cased for A-Z only, so the result does not depend on a
locale or a Unicode version.
"""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


_CHUNK = 1 << 20  # bytes hashed at a time; only memory depends on it
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B]  # A-Z count as a-z


class WordHashes:
    """64-bit hashes of all words of a text, without a loop over words.

    A word's hash is a polynomial of its bytes modulo 2**64, taken as a
    difference of prefix sums and shifted back to the word's own start.
    """

    def __init__(self):
        self._powers = np.ones(1, dtype=np.uint64)
        self._inverses = np.ones(1, dtype=np.uint64)

    def _reach(self, size: int) -> None:
        if len(self._powers) < size:
            size = 1 << int(size - 1).bit_length()
            inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
            for name, base in (("_powers", _MULTIPLIER), ("_inverses", inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _chunk(self, data: np.ndarray) -> np.ndarray:
        space = _SPACE[data]
        edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]
        if len(starts) == 0:
            return np.zeros(0, dtype=np.uint64)
        self._reach(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_LETTER[data] * self._powers[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self._inverses[starts])

    def __call__(self, text: str | None) -> np.ndarray:
        """Hashes of the words in order; null and blank texts have none."""
        if not text:
            return np.zeros(0, dtype=np.uint64)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        if len(data) <= _CHUNK:
            return self._chunk(data)
        parts, start = [], 0
        while start < len(data):
            end = start + _CHUNK
            while end < len(data) and not (gap := _SPACE[data[end : end + _CHUNK]]).any():
                end += _CHUNK  # a word longer than a chunk stays whole
            end = end + int(gap.argmax()) if end < len(data) else len(data)
            parts.append(self._chunk(data[start:end]))
            start = end
        return np.concatenate(parts)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, in order; a shorter text is one run."""
    if len(hashes) == 0:
        return hashes
    width = min(width, len(hashes))
    count = len(hashes) - width + 1
    out = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        out = out * _MULTIPLIER + hashes[k : k + count]
    return mix(out)


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (empty without words)."""
    return np.unique(rolling(hashes(text), width))


class MinHasher:
    """``bands * rows`` minima of seeded permutations of a shingle set."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        size = bands * rows
        self.bands, self.rows = bands, rows
        self.factor = (draw.integers(0, 2**32, size, dtype=np.uint32) | np.uint32(1))[:, None]
        self.offset = draw.integers(0, 2**32, size, dtype=np.uint32)[:, None]
        self.band_salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * _MULTIPLIER)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Minimum under each permutation, uint32; ``shingles`` is not empty."""
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self.factor), np.iinfo(np.uint32).max, dtype=np.uint32)
        for start in range(0, len(low), 1024):  # blocks stay in the CPU's cache
            block = low[start : start + 1024][None, :] * self.factor + self.offset
            np.minimum(best, block.min(axis=1), out=best)
        return best

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band: equal keys mean equal rows of that band."""
        table = signature.reshape(self.bands, self.rows).astype(np.uint64)
        key = self.band_salt.copy()
        for k in range(self.rows):
            key = mix(key * _MULTIPLIER + table[:, k])
        return key.view(np.int64)
