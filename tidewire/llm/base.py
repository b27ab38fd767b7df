"""What the operators of this package share: reading, key columns, and rolling hashes over one text at a time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = 2**63 - 1
U = np.uint64


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id long and text only, so that other columns of the input cannot clash with derived ones."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def ordered_key(doc_id: str = "doc_id") -> Column:
    """The id as a key of joins and comparisons; rows without an id share the greatest one."""
    return F.coalesce(F.col(doc_id), F.lit(LAST_ID))


# -- rolling hashes: a window's hash is a difference of prefix sums, so any window of a text costs the same

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_TABLES = [np.random.default_rng(seed).integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1) for seed in (11, 12)]
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    z = z ^ (z >> U(30))
    z *= U(0xBF58476D1CE4E5B9)
    z ^= z >> U(27)
    z *= U(0x94D049BB133111EB)
    z ^= z >> U(31)
    return z


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least n of each."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size, r = max(n, 1 << 16), _MULTIPLIERS[which]
        _powers[which] = have = tuple(np.cumprod(np.full(size, x, dtype=np.uint64)) for x in (r, pow(r, -1, 2**64)))
    return have


class Rolling:
    """Hashes of any window of a sequence of 64-bit numbers."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.n = len(values)
        up, self.down = powers(self.n + 1, which)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.multiply(values, up[: self.n], out=self.sums[1:])
        np.cumsum(self.sums[1:], out=self.sums[1:])

    def grams(self, width: int) -> np.ndarray:
        """The hash of each window of the width, by start; none if the sequence is shorter."""
        if self.n < width:
            return np.zeros(0, dtype=np.uint64)
        found = self.sums[width:] - self.sums[:-width]
        found *= self.down[: self.n - width + 1]
        return mix(found)

    def at(self, start: np.ndarray, width: int) -> np.ndarray:
        """The hashes of the windows of the width at given starts."""
        return mix((self.sums[start + width] - self.sums[start]) * self.down[start])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hashes of given windows; windows of different lengths differ."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + mix((end - start).astype(np.uint64)))


class Rows:
    """Hashes of the windows of each row of a table of bytes."""

    def __init__(self, table: np.ndarray, which: int = 0):
        self.n = table.shape[1]
        up, self.down = powers(self.n + 1, which)
        self.sums = np.zeros((len(table), self.n + 1), dtype=np.uint64)
        np.cumsum(_TABLES[which][table] * up[: self.n], axis=1, out=self.sums[:, 1:])

    def grams(self, width: int) -> np.ndarray:
        return mix((self.sums[:, width:] - self.sums[:, :-width]) * self.down[: self.n - width + 1])


def raw_bytes(text: str | None, lowered: bool = False) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return _LOWERED[data] if lowered else data


def byte_hashes(data: np.ndarray, which: int = 0) -> Rolling:
    return Rolling(_TABLES[which][data], which)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of a text's bytes."""
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).view(np.int8)))
    return edges[::2], edges[1::2]


def word_hashes(text: str | None, lowered: bool = False, which: int = 0) -> np.ndarray:
    """One number for each word [^\\x20\\x09-\\x0D]+ of the text."""
    data = raw_bytes(text, lowered)
    return byte_hashes(data, which).spans(*word_bounds(data))


def longs(values) -> np.ndarray:
    """A row's array of numbers; null is empty."""
    return np.asarray([] if values is None else values, dtype=np.int64)


def sliding(values: np.ndarray, width: int, keep: np.ufunc) -> np.ndarray:
    """The least or greatest value of each window of the width, in logarithmically many passes."""
    if len(values) < width:
        return values[:0]
    done = 1
    while 2 * done <= width:
        values = keep(values[:-done], values[done:])
        done *= 2
    return keep(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions whose gram is the least of some window of `width` grams, ties included.

    Two equal windows choose equal positions, so texts that share a window share an anchor inside it.
    """
    least = sliding(grams, width, np.minimum)
    if not len(least):
        return np.zeros(0, dtype=np.int64)
    padded = np.zeros(len(least) + 2 * (width - 1), dtype=np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    return np.flatnonzero(sliding(padded, width, np.maximum) == grams)


def with_least_among(grams: np.ndarray, width: int, values: np.ndarray) -> np.ndarray:
    """Starts of the runs of `width` grams whose least gram is one of the values."""
    if not len(values) or len(grams) < width:
        return np.zeros(0, dtype=np.int64)
    least, values = sliding(grams, width, np.minimum), np.sort(values)
    return np.flatnonzero(values[np.minimum(np.searchsorted(values, least), len(values) - 1)] == least)


def covered(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the half-open ranges."""
    if not len(low):
        return np.zeros(n, dtype=bool)
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, np.clip(low, 0, n), 1)
    np.add.at(change, np.clip(high, 0, n), -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    return edges[::2], edges[1::2]
