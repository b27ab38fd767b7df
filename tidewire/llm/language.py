"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram's vector binds the vectors of its letters,
each permuted by its place; a text's vector bundles (adds) those of its trigrams, words being set apart by a blank. A
language's prototype bundles all texts it was learned from. A text has the language whose prototype has the greatest cosine
with it; that cosine, not below 0, is the score.

Learning counts trigrams of all learned texts; what reaches the driver is one vector for each language. Ties go to the lesser
language name. A null text, or one without letters, is `und` with score 0; with nothing to learn from all are. Rows without an
id are held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.base import U, mix, read

DIMENSIONS, BATCH = 1024, 64
UNKNOWN = "und"
_BITS = U(21)
_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def trigrams(text: str | None) -> np.ndarray:
    """The trigrams of the lower-cased text as numbers; each run of other characters counts as one blank."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = is_letter()[points]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    signs = np.where(letter, points, 0)
    signs = signs[letter | np.concatenate(([True], letter[:-1]))]
    signs = np.concatenate(([0], signs, [0])).astype(np.uint64)
    one, two, three = signs[:-2], signs[1:-1], signs[2:]
    return ((one << (_BITS + _BITS)) | (two << _BITS) | three)[two > 0]


def vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """One row of +1 and -1 for each trigram; binding is an exclusive or of bits, permuting a rotation of words."""
    words = dimensions // 64
    place, low = np.arange(words, dtype=np.uint64), U((1 << 21) - 1)
    bits = np.zeros((len(codes), words), dtype=np.uint64)
    for turn, shift in enumerate((42, 21, 0)):
        letters, where = np.unique((codes >> U(shift)) & low, return_inverse=True)
        own = mix(letters[:, None] * U(words) + place + U(0x5851F42D4C957F2D))
        bits ^= np.roll(own, turn, axis=1)[where]
    return 1 - 2 * np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32)


def bundles(texts: list[np.ndarray], dimensions: int) -> np.ndarray:
    """A text's vector for each array of trigrams; sums of whole numbers, so exact in any order."""
    parts = [np.unique(t, return_counts=True) for t in texts]
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros((len(texts), len(codes)), dtype=np.float32)
    counts[np.repeat(np.arange(len(texts)), [len(p[0]) for p in parts]), where] = np.concatenate([p[1] for p in parts])
    return counts @ vectors(codes, dimensions) if len(codes) else np.zeros((len(texts), dimensions), dtype=np.float32)


def prototype_rows(dimensions: int):
    """One sum for each language and task."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                for at in range(0, len(group), 16 * BATCH):
                    found = np.concatenate([trigrams(t) for t in group["text"].iloc[at : at + 16 * BATCH]])
                    codes, counts = np.unique(found, return_counts=True)
                    total = counts.astype(np.float64) @ vectors(codes, dimensions) if len(codes) else 0.0
                    sums[lang] = sums.get(lang, np.zeros(dimensions)) + total
        if sums:
            yield pd.DataFrame({"lang": list(sums), "sum": list(sums.values())})

    return rows


def learn_languages(learned: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Language names and their prototypes of length 1, from rows with lang and text."""
    sums = learned.select("lang", "text").filter("lang is not null and text is not null").mapInPandas(prototype_rows(dimensions), "lang string, sum array<double>")
    whole = sums.select("lang", F.posexplode("sum")).groupBy("lang", "pos").agg(F.sum("col").alias("value"))
    table = whole.toPandas().pivot(index="lang", columns="pos", values="value").sort_index()
    lengths = np.sqrt((table.to_numpy() ** 2).sum(axis=1, keepdims=True)) if len(table) else np.zeros((0, 1))
    known = (lengths > 0).ravel()
    return [str(x) for x in table.index[known]], table.to_numpy()[known] / lengths[known]


def predicted_rows(names: list[str], prototypes: np.ndarray, dimensions: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best, score = [UNKNOWN] * len(batch), np.zeros(len(batch))
            for at in range(0, len(batch) if names else 0, BATCH):
                found = [trigrams(t) for t in batch["text"].iloc[at : at + BATCH]]
                bundle = bundles(found, dimensions).astype(np.float64)
                length = np.sqrt((bundle**2).sum(axis=1))
                cosine = bundle @ prototypes.T / np.maximum(length, 1e-300)[:, None]
                for i in np.flatnonzero([len(f) > 0 for f in found]).tolist():
                    best[at + i] = names[int(cosine[i].argmax())]
                    score[at + i] = min(1.0, max(0.0, float(cosine[i].max())))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "lang_pred": best, "score": score})

    return rows


def predict_language(docs: DataFrame, learned: Column, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned says which rows (with doc_id, text, lang) to learn from."""
    rows = docs.select("doc_id", "text", "lang", F.coalesce(learned, F.lit(False)).alias("learned"))
    names, prototypes = learn_languages(rows.filter("learned"), dimensions)
    return rows.select("doc_id", "text", (~F.col("learned")).alias("held_out")).mapInPandas(
        predicted_rows(names, prototypes, dimensions), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    return predict_language(read(spark, folder, "documents"), F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
