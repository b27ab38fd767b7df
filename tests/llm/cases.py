"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows(seed: int = 3) -> list[tuple]:
    """Copies, near copies, shared passages, periodic, short, empty, null and very long texts, ties, repeated rows and null ids."""
    rng = random.Random(seed)
    passage = sentence(rng, 70)
    base = [sentence(rng, rng.choice([3, 19, 20, 21, 60, 200])) for _ in range(30)]
    texts = [*base, *base[:8], *(f"{sentence(rng, 15)} {passage} {sentence(rng, 9)}" for _ in range(6))]
    for text in base[20:28]:
        words = text.split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += ["", " \t\n", "a", "is it " * 60, "Is it " * 40, "x" * 300, "x" * 120, "é" * 90, "ß é\x85 " * 30, None, None, sentence(rng, 12_000, 900)]
    rows = [(i * 3, t, rng.choice(["en", "de", None]), "src0", len(t or "")) for i, t in enumerate(texts)]
    return rows


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, DOCS)


def awkward(spark: SparkSession) -> DataFrame:
    """Repeated rows, rows without an id, and columns whose names the operators use themselves."""
    rows = [(1, "one two three", "en", "s", 1), (1, "one two three", "en", "s", 1), (None, "one two three", None, None, None), (None, None, None, None, None)]
    clash = "key text_ n_words kept score length digest spans blob row sequence_id".split()
    return documents(spark, rows).selectExpr("*", *[f"'x' as `{c}`" for c in clash])
