"""Hashes of word n-grams, many texts at a time, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x.copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Shingler:
    """The distinct n-grams of words of a text as sorted 64-bit hashes.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A
    text of fewer words than n has one gram, the whole sequence; one without words
    has none. Words are hashed by differences of a running polynomial sum, so that
    no step loops over words or characters in Python."""

    def __init__(self, n: int = 5, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.n = n
        self.of_byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = int(rng.integers(1 << 62, 1 << 63)) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.at = (rng.integers(1, 1 << 63, n, dtype=np.uint64) | U(1)).astype(np.uint64)
        self.short = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            for name, x in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, x, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each word, and for each text the end of its words."""
        data = np.frombuffer(b"\n" + b"\n".join(texts).lower() + b"\n", np.uint8)
        self._grow(len(data))
        white = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.diff(white.view(np.int8))
        starts, ends = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.powers[: len(data)], out=total[1:])
        hashes = mixed((total[ends] - total[starts]) * self.inverses[starts])
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        return hashes, np.searchsorted(starts, text_ends)

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        words, ends = self._words(texts)
        n = self.n
        if len(words) >= n:
            grams = np.zeros(len(words) - n + 1, np.uint64)
            for k in range(n):
                grams += words[k : len(words) - n + 1 + k] * self.at[k]
            grams = mixed(grams)
        lo = 0
        for hi in ends.tolist():
            if hi - lo >= n:
                yield np.unique(grams[lo : hi - n + 1])
            elif hi > lo:
                own = words[lo:hi]
                yield mixed(np.array([(own * self.at[: hi - lo]).sum(dtype=np.uint64) ^ self.short[hi - lo]], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
            lo = hi

    def of_column(self, column: Iterable, size: int = 1 << 18) -> Iterator[np.ndarray]:
        """The set of each text of an Arrow string column; null is empty. Texts go
        in groups of about `size` bytes, so memory does not depend on the batch."""
        group: list[bytes] = []
        total = 0
        for x in column:
            data = x.as_buffer().to_pybytes() if x.is_valid else b""
            group.append(data)
            total += len(data) + 1
            if total >= size:
                yield from self.sets(group)
                group, total = [], 0
        if group:
            yield from self.sets(group)
