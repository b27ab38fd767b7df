"""The batch ratio equals the ratio of one pair at a time."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from tidewire.functions import sequence


def drawn(rng: random.Random, n: int, letters: str) -> str:
    return "".join(rng.choices(letters, k=rng.randint(0, n)))


@pytest.mark.parametrize(("letters", "n"), [("ab", 12), ("abcdeあいう😀", 40), ("abcdefghijklmnopqrstuvwxyz", 70), ("ab ", 260), ("abcdefgh", 500)])
def test_ratios_equal_those_of_single_pairs(letters, n, monkeypatch):
    rng = random.Random(n)
    left, right = [], []
    for _ in range(150):
        a = drawn(rng, n, letters)
        b = list(a) if rng.random() < 0.6 else list(drawn(rng, n, letters))
        for _ in range(rng.randint(0, 6)):
            if b:
                b[rng.randrange(len(b))] = rng.choice(letters)
        left.append(a)
        right.append("".join(b)[rng.choice([0, 0, 3]) :])
    want = [SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right)]
    for cells in (sequence.CELLS, 500):
        monkeypatch.setattr(sequence, "CELLS", cells)
        assert sequence.ratios(left, right).tolist() == want


def test_the_order_of_the_texts_matters():
    pairs = [("tide", "diet"), ("diet", "tide")]
    got = sequence.ratios(*[list(x) for x in zip(*pairs)])
    assert got.tolist() == [SequenceMatcher(None, a, b).ratio() for a, b in pairs] and got[0] != got[1]


def test_empty_batches_and_texts():
    assert sequence.ratios([], []).tolist() == []
    assert sequence.ratios(["", "", "a"], ["", "a", ""]).tolist() == [1.0, 0.0, 0.0]
    assert sequence.matched_characters(["x" * 3000], ["x" * 2500]).tolist() == [SequenceMatcher(None, "x" * 3000, "x" * 2500).get_matching_blocks()[0].size]


def test_a_block_grows_over_frequent_characters():
    a, b = "zz" + "ab" * 150 + "q", "ab" * 150 + "qz"
    assert np.isclose(sequence.ratios([a], [b])[0], SequenceMatcher(None, a, b).ratio())
