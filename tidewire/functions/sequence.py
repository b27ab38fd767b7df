"""The sequence ratio of many pairs of texts at once.

The ratio counts the characters in matching blocks: the longest common block (the one that starts first in the left text, then
in the right one), then the same on both sides of it. All pairs of a batch go through these steps together, as
arrays of characters: one step finds the longest block of every open stretch by running lengths along the left text. In right texts of 200
characters or more, characters that make up over a hundredth of them start no block, but blocks grow over them. So
the order of the two texts matters.
"""

from __future__ import annotations

import numpy as np

#: Cells of the table of running lengths that are worked on together; bounds the memory of a batch.
CELLS = 2_000_000
#: From this length of the right text on, frequent characters start no block.
LONG = 200
OUTSIDE_LEFT, OUTSIDE_RIGHT, FREQUENT = -1, -2, -3


class Texts:
    """Texts as one array of code points and the places where they start."""

    def __init__(self, texts: list[str]):
        coded = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4") for t in texts]
        self.lengths = np.array([len(c) for c in coded], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.codes = np.concatenate([*coded, np.zeros(1, dtype="<u4")]).astype(np.int64)

    def table(self, at: np.ndarray, size: np.ndarray, outside: int) -> np.ndarray:
        """A row of characters for each stretch, padded to the longest."""
        column = np.arange(size.max(initial=0))
        inside = column < size[:, None]
        return np.where(inside, self.codes[np.where(inside, at[:, None] + column, 0)], outside)


def frequent(right: Texts) -> np.ndarray:
    """Which characters of the right texts start no block."""
    out = np.zeros(len(right.codes), dtype=bool)
    for start, n in zip(right.starts[right.lengths >= LONG].tolist(), right.lengths[right.lengths >= LONG].tolist()):
        _, which, count = np.unique(right.codes[start : start + n], return_inverse=True, return_counts=True)
        out[start : start + n] = (count > n // 100 + 1)[which]
    return out


def longest_blocks(a: np.ndarray, b: np.ndarray, seeds: np.ndarray, heights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in a, start in b and length of the longest common block of each row; rows come longest a first."""
    rows = len(a)
    best, end_a, end_b = (np.zeros(rows, dtype=np.int64) for _ in range(3))
    run = np.zeros(seeds.shape, dtype=np.int32)
    for step in range(a.shape[1]):
        live = int(np.searchsorted(-heights, -step, side="left"))
        equal = seeds[:live] == a[:live, step, None]
        grown = np.empty((live, seeds.shape[1]), dtype=np.int32)
        grown[:, 0] = 1
        np.add(run[:live, :-1], 1, out=grown[:, 1:])
        grown *= equal
        run = grown
        most = grown.max(axis=1, initial=0)
        better = np.flatnonzero(most > best[:live])
        best[better], end_a[better], end_b[better] = most[better], step + 1, grown[better].argmax(axis=1) + 1
    start_a, start_b = end_a - best, end_b - best
    if (seeds == FREQUENT).any():
        row = np.arange(rows)
        sizes_b = (b != OUTSIDE_RIGHT).sum(axis=1)
        while True:  # blocks grow to both sides over frequent characters
            before = (start_a > 0) & (start_b > 0)
            before &= a[row, np.maximum(start_a - 1, 0)] == b[row, np.maximum(start_b - 1, 0)]
            after = (start_a + best < heights) & (start_b + best < sizes_b)
            at_a, at_b = np.minimum(start_a + best, a.shape[1] - 1), np.minimum(start_b + best, b.shape[1] - 1)
            after &= (a[row, at_a] == b[row, at_b]) & ~before
            if not (before | after).any():
                break
            start_a, start_b, best = start_a - before, start_b - before, best + before + after
    return start_a, start_b, best


def matched_characters(left: list[str], right: list[str]) -> np.ndarray:
    """For each pair, how many characters of the left text lie in matching blocks."""
    one, two = Texts(left), Texts(right)
    dull = frequent(two)
    total = np.zeros(len(left), dtype=np.int64)
    pair, from_a, to_a, from_b, to_b = np.arange(len(left)), one.starts, one.starts + one.lengths, two.starts, two.starts + two.lengths
    while len(pair):
        high, wide = to_a - from_a, to_b - from_b
        order = np.lexsort((-high, wide))
        open_ = order[(high[order] > 0) & (wide[order] > 0)]
        found = []
        for rows in stretches(open_, wide):
            rows = rows[np.argsort(-high[rows], kind="stable")]
            a, b = one.table(from_a[rows], high[rows], OUTSIDE_LEFT), two.table(from_b[rows], wide[rows], OUTSIDE_RIGHT)
            column = np.arange(b.shape[1])
            flags = dull[np.where(column < wide[rows, None], from_b[rows, None] + column, len(dull) - 1)]
            start_a, start_b, size = longest_blocks(a, b, np.where(flags, FREQUENT, b), high[rows])
            np.add.at(total, pair[rows], size)
            hit = size > 0
            rows, start_a, start_b, size = rows[hit], from_a[rows[hit]] + start_a[hit], from_b[rows[hit]] + start_b[hit], size[hit]
            found.append((pair[rows], from_a[rows], start_a, from_b[rows], start_b))
            found.append((pair[rows], start_a + size, to_a[rows], start_b + size, to_b[rows]))
        if not found:
            break
        pair, from_a, to_a, from_b, to_b = (np.concatenate(x) for x in zip(*found))
    return total


def stretches(order: np.ndarray, wide: np.ndarray):
    """Rows of similar width, so many at once that their tables stay within CELLS."""
    at = 0
    while at < len(order):
        size = 1
        while at + 2 * size <= len(order) and 2 * size * int(wide[order[at + 2 * size - 1]]) <= CELLS:
            size *= 2
        yield order[at : at + size]
        at += size


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    """2 * matched characters / all characters of each pair; 1 for two empty texts."""
    total = np.array([len(a) + len(b) for a, b in zip(left, right)], dtype=np.int64)
    return np.where(total > 0, 2.0 * matched_characters(left, right) / np.maximum(total, 1), 1.0)
