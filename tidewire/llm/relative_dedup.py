"""Substring de-duplication: windows of words that occurred before are found by a join and listed as factors.

This is not a relative Lempel-Ziv parse: no reference text is read and no longest factor is looked for.

The reference is every earlier text, indexed in two steps so that the index stays small. Sampled ten-word grams (the least
of every run of eleven, so that each window of twenty words holds one) are looked up first, one row for each gram and
document. Only windows whose sampled gram occurs again are indexed themselves: each window goes to its first occurrence.
All windows of a document that occurred earlier are removed; every window is looked up, so nothing that straddles two
factors is missed. Factors only list them: neighbouring windows whose first occurrences run on in one document make one
factor, so a factor ends where the next window occurred first elsewhere, even if the words go on in the same reference.

Order is (doc_id, position). Rows without an id come last, as one document; rows that share an id do not count as earlier
at the same position. Null text has no words. Texts with fewer words than a window, and empty tables, lose nothing.
Windows are compared by 96 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.base import Rolling, U, anchors, byte_hashes, covered, id_and_text, longs, mix, ordered_key, raw_bytes, read, with_least_among, word_bounds

WINDOW, GRAM = 20, 10
HALF = U(0xFFFFFFFF00000000)
FACTORS = "array<struct<start:int,length:int,ref_doc:long,ref_start:int>>"


class Words:
    """A text's words as numbers, its sampled grams and its windows."""

    def __init__(self, text: str | None, window: int, gram: int):
        self.data, self.window = raw_bytes(text), window
        self.starts, self.ends = word_bounds(self.data)
        self.n = len(self.starts)
        if self.n >= window:
            self.words = byte_hashes(self.data).spans(self.starts, self.ends)
            self.rolling, self.span = Rolling(self.words), window - gram + 1
            self.grams = self.rolling.grams(gram)
            self.at = anchors(self.grams, self.span)

    def repeated(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the windows whose least gram occurs elsewhere or again here, and two hashes of each."""
        grams = self.grams[self.at]
        order = np.sort(grams)
        hot = np.concatenate((grams[np.isin(grams, shared)], order[1:][order[1:] == order[:-1]]))
        starts = with_least_among(self.grams, self.span, hot)
        second = Rolling(mix(self.words ^ U(0xA0761D6478BD642F)), 1)
        return starts, self.rolling.at(starts, self.window), second.at(starts, self.window)


def first_of_each(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each row the index of the first row with the same pair."""
    _, first, which = np.unique(one ^ mix(two), return_index=True, return_inverse=True)
    return first[which]


def gram_rows(window: int, gram: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, found = [], []
            for key, text in zip(batch["key"], batch["text"]):
                words = Words(text, window, gram)
                if words.n >= window:
                    found.append(np.unique(words.grams[words.at]).view(np.int64))
                    keys.append(np.full(len(found[-1]), key, dtype=np.int64))
            if found:
                yield pd.DataFrame({"gram": np.concatenate(found), "key": np.concatenate(keys)})

    return rows


def window_rows(window: int, gram: int):
    """One row for each distinct window of a document around a repeated gram, at its first position there.

    `tail` holds half of the second hash above the position, which keeps the shuffled rows short.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for key, text, shared in zip(batch["key"], batch["text"], batch["shared"]):
                words = Words(text, window, gram)
                if words.n >= window:
                    starts, one, two = words.repeated(longs(shared).view(np.uint64))
                    own = first_of_each(one, two) == np.arange(len(one))
                    tail = (two[own] & HALF) | starts[own].astype(np.uint64)
                    found.append((np.full(own.sum(), key, dtype=np.int64), one[own].view(np.int64), tail.view(np.int64)))
            if found:
                yield pd.DataFrame(dict(zip(("key", "one", "tail"), map(np.concatenate, zip(*found)))))

    return rows


def parse(key: int, words: Words, shared: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """Greedy factors of one document, a row (start, length, reference document, reference start) each."""
    starts, one, two = words.repeated(shared)
    own = first_of_each(one, two)
    order = np.argsort(found[0])
    known, ref_doc, ref_start = (x[order] for x in found)
    place = np.minimum(np.searchsorted(known, starts[own]), max(0, len(known) - 1))
    before = known[place] == starts[own] if len(known) else np.zeros(len(starts), dtype=bool)
    again = own != np.arange(len(starts))
    doc = np.where(before, ref_doc[place] if len(known) else key, key)
    at = np.where(before, ref_start[place] if len(known) else 0, starts[own])
    starts, doc, at = (x[before | again] for x in (starts, doc, at))
    if not len(starts):
        return np.zeros((0, 4), dtype=np.int64)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (np.diff(at) != np.diff(starts)) | (np.diff(starts) > words.window)
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(starts)) - 1
    return np.column_stack((starts[head], starts[tail] - starts[head] + words.window, doc[head], at[head]))


def parsed_rows(window: int, gram: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, doc_id, text, shared, *found in zip(*(batch[c] for c in ("key", "doc_id", "text", "shared", "starts", "ref_docs", "ref_starts"))):
                words = Words(text, window, gram)
                kept, factors = np.ones(words.n, dtype=bool), np.zeros((0, 4), dtype=np.int64)
                if words.n >= window:
                    factors = parse(key, words, longs(shared).view(np.uint64), [longs(x) for x in found])
                    kept = ~covered(factors[:, 0], factors[:, 0] + factors[:, 1], words.n)
                pieces = words.data.tobytes().split()
                left = b" ".join(pieces if kept.all() else [w for w, k in zip(pieces, kept.tolist()) if k])
                spans = [dict(zip(("start", "length", "ref_doc", "ref_start"), x)) for x in factors.tolist()]
                out.append((doc_id, words.n, int(words.n - kept.sum()), left.decode("utf-8", "surrogatepass"), spans))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_text", "factors"]).astype({"doc_id": "Int64"})

    return rows


def relative_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and the factors that were removed, one row for each row of docs.

    The texts are dealt out by id once; both later passes over them read that shuffle again.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("key", ordered_key())
    texts = rows.repartition("key")
    grams = rows.select("key", "text").mapInPandas(gram_rows(window, gram), "gram long, key long")
    of_gram = Window.partitionBy("gram")
    shared = (
        grams.withColumn("low", F.min("key").over(of_gram))
        .withColumn("high", F.max("key").over(of_gram))
        .filter("low <> high")
        .groupBy("key")
        .agg(F.collect_list("gram").alias("shared"))
    )
    with_grams = texts.join(shared, "key", "left")
    windows = with_grams.mapInPandas(window_rows(window, gram), "key long, one long, tail long").repartition("one")
    start = F.col("tail").bitwiseAND(2**32 - 1).cast("int")
    earlier = Window.partitionBy("one", F.shiftrightunsigned("tail", 32)).orderBy("key", "tail").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        windows.withColumns({"ref_key": F.first("key").over(earlier), "ref_tail": F.first("tail").over(earlier)})
        .filter("ref_key < key")
        .groupBy("key")
        .agg(F.collect_list(F.struct(start.alias("start"), F.col("ref_key").alias("ref_doc"), F.col("ref_tail").bitwiseAND(2**32 - 1).cast("int").alias("ref_start"))).alias("found"))
    )
    found = found.select("key", F.col("found.start").alias("starts"), F.col("found.ref_doc").alias("ref_docs"), F.col("found.ref_start").alias("ref_starts"))
    return with_grams.join(found, "key", "left").mapInPandas(
        parsed_rows(window, gram), f"doc_id long, n_words long, n_removed long, kept_text string, factors {FACTORS}"
    )


def op10_relative_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = relative_dedup(read(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def removed_by_definition(rows: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """The same by brute force, for tests."""
    words = {i: (t or "").encode().split() for i, t in rows}
    seen: set[tuple[bytes, ...]] = set()
    out = {}
    for i in sorted(words):
        gone = set()
        for p in range(len(words[i]) - window + 1):
            piece = tuple(words[i][p : p + window])
            gone |= set(range(p, p + window)) if piece in seen else set()
            seen.add(piece)
        kept = b" ".join(w for p, w in enumerate(words[i]) if p not in gone)
        out[i] = (len(words[i]), len(gone), hashlib.sha256(kept).hexdigest())
    return out
