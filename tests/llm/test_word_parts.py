"""Words are taken apart and looked up together; ids stay those of the library."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidewire.llm import packing

PIECES = ["abc", "é", "É", "ß", "ñu", "İ", "ﬁ", "é", "́", ".", ",", "...", "&&&", "'s", "'", "7", "42", "A", "zZ", "\t", "\r", "\x85", "　", "日本", "😀", "<|", "|>", "<|endoftext|>"]


@pytest.fixture(scope="module")
def vocabulary() -> str:
    return packing.default_vocabulary()


def test_signs_around_a_word_make_no_new_words(vocabulary):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(200)]
    tails = ["".join(rng.choices("!#$%&*+", k=3)) for _ in range(20)]
    tokenizer = packing.WordTokenizer(vocabulary)
    texts = [" ".join(w + tail for w in words) for tail in tails]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokenizer.encode(texts)] == [tokenizer.tokenizer.encode(t).ids for t in texts]
    assert len(tokenizer.known) <= 230


@pytest.mark.parametrize("remembered", [1_000_000, 3])
def test_ids_are_those_of_the_library(vocabulary, monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    rng, tokenizer = random.Random(remembered), packing.WordTokenizer(vocabulary)
    for _ in range(60):
        texts = ["".join(rng.choice(["", " ", " ", "\n", "  "]) + rng.choice(PIECES) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(6))]
        want = [tokenizer.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in tokenizer.encode(texts)] == want, texts
