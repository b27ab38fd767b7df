"""Exact substring de-duplication by bucket-pointer refinement over sampled suffixes.

Suffixes start in buckets of one q-gram, named by the gram's hash, so that a bucket has the same name in every task. Only
sampled suffixes are sorted (the least gram of each run, so every window holds one). A bucket of one document is unique, and a suffix whose
whole surroundings occur in an earlier document has every window around it repeated. Every other suffix is undecided, and its
bucket is refined by the identifiers of the buckets at later offsets: its windows are halved into those that reach further
right and those that reach further left, and the windows of a half share all bytes between two buckets, one at their first and one at their last
common offset. The old identifier and those of the two buckets are the new one. A half of one document is unique, and a half whose
whole surroundings an earlier document has is repeated. Only the others are halved again, by their new identifiers, and at last their windows are
named the same way, one by one; a window goes if an earlier document has it too. A window is looked at once, by its least gram, and not if it
is known to be repeated (an earlier document then stands for it). Each refinement is one shuffle of narrow rows, at most one for each
document, whatever the size of a bucket.

A byte goes if a window of 50 bytes over it also starts in a document with a smaller id. Rows without an id come last, as
one document; rows that share an id never remove from one another. Null text is empty. Shorter texts lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.base import U, byte_hashes, covered, id_and_text, longs, mix, ordered_key, read, runs, sliding

WINDOW, GRAM = 50, 20
#: Bytes of the texts that a task looks at together, and how often the windows of a suffix are halved before they are named.
BLOCK, LEVELS = 300_000, 2


class Suffixes:
    """The bytes of several texts, the bucket of each suffix, and the sampled suffixes; nothing crosses from one text to the next."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        self.window, self.gram, self.span = window, gram, window - gram + 1
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.n, sizes = len(self.data), np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.at = np.zeros(0, dtype=np.int64)
        if self.n >= window:
            self.rolling = byte_hashes(self.data)
            self.bucket = self.rolling.grams(gram)
            self.least = sliding(self.bucket, self.span, np.minimum)
            over = self.ends[:, None] - np.arange(1, window)  # windows that would reach into the next text
            self.least[over[(over >= self.starts[:, None]) & (over < len(self.least))]] = 0
            around = np.zeros(len(self.least) + 2 * (self.span - 1), dtype=np.uint64)
            around[self.span - 1 : self.span - 1 + len(self.least)] = self.least
            self.at = np.flatnonzero(sliding(around, self.span, np.maximum) == self.bucket)
        self.doc = self.doc_of(self.at)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        """Which text a place lies in."""
        return np.searchsorted(self.ends, at, side="right")

    def surroundings(self) -> np.ndarray:
        """The name (48 bits) of what every window around a sampled suffix covers together."""
        low = np.maximum(self.at + self.gram - self.window, self.starts[self.doc])
        high = np.minimum(self.at + self.window, self.ends[self.doc])
        return mix(self.rolling.spans(low, high) + mix((self.at - low).astype(np.uint64))) >> U(16)

    def names(self) -> np.ndarray:
        """The names (48 bits) of the buckets of the sampled suffixes."""
        return self.bucket[self.at] >> U(16)

    def windows(self, at: np.ndarray, doc: np.ndarray, least: np.ndarray | int, most: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """The first and the end of the windows that start that far before each of the places, in the same text."""
        low, high = np.maximum(at - most, self.starts[doc]), np.minimum(at - least, self.ends[doc] - self.window) + 1
        return low, np.maximum(low, high)

    def undecided(self, mine: np.ndarray) -> Ranges:
        """All windows around some sampled suffixes, to be halved."""
        at, doc = self.at[mine], self.doc[mine]
        return Ranges(self.bucket[at], at, at, doc, np.zeros_like(at), np.full_like(at, self.span - 1))

    def halved(self, of: Ranges) -> Ranges:
        """Both halves of ranges of windows, as far as the text holds what all windows of a half share."""
        middle = (of.least + of.most) // 2
        both = (np.concatenate(x) for x in ((of.name, of.name), (of.at, of.at), (of.doc, of.doc), (of.least, middle + 1), (middle, of.most)))
        name, at, doc, least, most = both
        held = (least <= most) & (at - least >= self.starts[doc]) & (at + self.window - most <= self.ends[doc])
        name, at, doc, least, most = (x[held] for x in (name, at, doc, least, most))
        first, last = self.bucket[at - least], self.bucket[at + self.window - most - self.gram]
        name = mix(name ^ mix(first ^ mix(last + least.astype(np.uint64) + U(1)))) >> U(16)
        low, high = np.maximum(at - most, self.starts[doc]), np.minimum(at + self.window - least, self.ends[doc])
        whole = mix(self.rolling.spans(low, high) ^ mix(name + (at - low).astype(np.uint64)))
        return Ranges(name, whole >> U(16), at, doc, least, most)

    def named(self, of: Ranges, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows of ranges that are not known, by their least gram: where they start, and their names of 64 and 16 bits."""
        half, at = of.name, of.at
        distance = of.least[:, None] + np.arange((of.most - of.least).max(initial=0) + 1)
        start = at[:, None] - distance
        inside = (distance <= of.most[:, None]) & (start >= self.starts[of.doc][:, None])
        inside &= start + self.window <= self.ends[of.doc][:, None]
        row, column = np.nonzero(inside)
        start = start[row, column]
        own = ~known[start] & (self.least[start] == self.bucket[at[row]])
        start, step, half = start[own], distance[row[own], column[own]].astype(np.uint64), half[row[own]]
        first, last = self.bucket[start], self.bucket[start + self.window - self.gram]
        name = mix(half ^ mix(first ^ mix(last + step)))
        return start, name, (mix(first ^ mix(last ^ mix(half + step + U(3)))) >> U(48)).astype(np.uint16)


class Ranges(NamedTuple):
    """Ranges of windows: the identifier, that of the whole surroundings, the suffix, its text, and the least and greatest distance of a window's start."""

    name: np.ndarray
    whole: np.ndarray
    at: np.ndarray
    doc: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def some(self, mine: np.ndarray) -> Ranges:
        return Ranges(*(x[mine] for x in self))


class Verdicts:
    """The names that earlier steps listed for each text of a block."""

    def __init__(self, lists: pd.Series):
        values = [longs(x).view(np.uint64) for x in lists]
        docs = np.repeat(np.arange(len(values)), [len(v) for v in values])
        self.known = np.sort(self.tagged(np.concatenate([*values, np.zeros(0, dtype=np.uint64)]), docs))

    @staticmethod
    def tagged(names: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return mix(names ^ mix(docs.astype(np.uint64) + U(1)))

    def hold(self, names: np.ndarray, docs: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(names), dtype=bool)
        tags = self.tagged(names, docs)
        return self.known[np.minimum(np.searchsorted(self.known, tags), len(self.known) - 1)] == tags


def distinct_rows(names: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Places of the first of the rows of equal names and texts."""
    return np.flatnonzero(~pd.Series(Verdicts.tagged(names, docs)).duplicated().to_numpy())


def blocks(batches: Iterator[pd.DataFrame], window: int, gram: int, limit: int = BLOCK) -> Iterator[tuple[pd.DataFrame, Suffixes]]:
    """Rows of a batch whose texts have about `limit` bytes together, or one long text, with their suffixes."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        if "packed" in batch:
            texts = [unpack(p) if p is not None else b"" for p in batch["packed"]]
        else:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch["text"]]
        number = np.cumsum([len(t) for t in texts]) // limit
        for first, last in zip(*(np.searchsorted(number, np.unique(number), side=side) for side in ("left", "right"))):
            yield batch.iloc[first:last].reset_index(drop=True), Suffixes(texts[first:last], window, gram)


def packed(texts: DataFrame) -> DataFrame:
    """The rows with compressed texts, as they are dealt out and read several times."""

    @F.pandas_udf("binary")
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pd.Series([compress(t.encode("utf-8", "surrogatepass")) if t else None for t in batch], dtype=object)

    return texts.select("doc_id", "key", pack("text").alias("packed"))


def suffix_rows(window: int, gram: int):
    """One row for each document and distinct surroundings of a sampled suffix.

    The bucket's 48 bits and the first 16 of the surroundings' 48 are one number, the others a second, to keep rows short.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, block in blocks(batches, window, gram):
            if len(block.at):
                around = block.surroundings()
                own = distinct_rows(around, block.doc)
                around, head = around[own], block.names()[own] << U(16)
                head = (head | (around >> U(32))).view(np.int64)
                yield pd.DataFrame({"head": head, "tail": around.astype(np.uint32).view(np.int32), "key": batch["key"].to_numpy()[block.doc[own]]})

    return rows


def refined(batch: pd.DataFrame, block: Suffixes, level: int, with_known: bool = True) -> tuple[np.ndarray | None, Ranges]:
    """Which windows are known to be repeated after some levels of refinement, if asked for, and the ranges that are still open."""
    around = block.surroundings()
    known = []
    if with_known:
        whole = Verdicts(batch["done0"]).hold(around, block.doc)
        known.append(block.windows(block.at[whole], block.doc[whole], 0, block.span - 1))
    left = block.undecided(Verdicts(batch["open0"]).hold(around, block.doc))
    for n in range(1, level + 1):
        halves = block.halved(left)
        if with_known:
            done = halves.some(Verdicts(batch[f"done{n}"]).hold(halves.whole, halves.doc))
            known.append(block.windows(done.at, done.doc, done.least, done.most))
        left = halves.some(Verdicts(batch[f"open{n}"]).hold(halves.whole, halves.doc))
    return covered(*map(np.concatenate, zip(*known)), len(block.least)) if with_known else None, left


def half_rows(window: int, gram: int, level: int):
    """The halves of the ranges that are open after some levels, once for each document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, block in blocks(batches, window, gram):
            if len(block.at):
                found = block.halved(refined(batch, block, level, with_known=False)[1])
                own = distinct_rows(found.whole, found.doc)
                key = batch["key"].to_numpy()[found.doc[own]]
                yield pd.DataFrame({"half": found.name[own].view(np.int64), "whole": found.whole[own].view(np.int64), "key": key})

    return rows


def window_rows(window: int, gram: int):
    """The windows of the ranges that are open after all levels, once for each document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, block in blocks(batches, window, gram):
            if len(block.at):
                known, left = refined(batch, block, LEVELS)
                start, name, rest = block.named(left, known)
                doc = block.doc_of(start)
                own = distinct_rows(name, doc)
                yield pd.DataFrame({"name": name[own].view(np.int64), "rest": rest[own].view(np.int16), "key": batch["key"].to_numpy()[doc[own]]})

    return rows


def kept_rows(window: int, gram: int):
    """What is left of each text; `repeated` are the names of windows that an earlier document has."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, block in blocks(batches, window, gram):
            mask = np.zeros(block.n, dtype=bool)
            if len(block.at):
                known, left = refined(batch, block, LEVELS)
                start, name, _ = block.named(left, known)
                known[start[Verdicts(batch["repeated"]).hold(name, block.doc_of(start))]] = True
                sums, rest = np.append(0, np.cumsum(known, dtype=np.int32)), np.zeros(window - 1, dtype=np.int32)
                mask = np.append(sums[1:], rest + sums[-1]) > np.append(rest, sums[:-1])
            edge = np.zeros(block.n + 1, dtype=bool)
            edge[block.starts], edge[block.ends] = True, True
            low = np.flatnonzero(mask & (edge[:-1] | ~np.concatenate(([False], mask[:-1]))))
            high = np.flatnonzero(mask & (edge[1:] | ~np.concatenate((mask[1:], [False])))) + 1
            first, last = np.searchsorted(low, block.starts), np.searchsorted(low, block.ends)
            gone = np.append(0, np.cumsum(mask, dtype=np.int32))
            data, left, out = block.data[~mask].tobytes(), np.arange(block.n + 1) - gone, []
            for n, doc_id in enumerate(batch["doc_id"].tolist()):
                a, b = block.starts[n], block.ends[n]
                spans = [{"start": x, "end": y} for x, y in zip((low[first[n] : last[n]] - a).tolist(), (high[first[n] : last[n]] - a).tolist())]
                out.append((doc_id, b - a, gone[b] - gone[a], len(spans), data[left[a] : left[b]], spans))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"]).astype({"doc_id": "Int64"})

    return rows


def lists_by_key(rows: DataFrame, value: str, **states: str) -> DataFrame:
    """For each key the values of each state, as a list under the state's new name."""
    found = rows.filter("state is not null").groupBy("key")
    return found.agg(*[F.collect_list(F.when(F.col("state") == state, F.col(value))).alias(name) for name, state in states.items()])


def with_state(rows: DataFrame, bucket: str, whole: str) -> DataFrame:
    """`state` of each row: done if an earlier document has the whole, open if its bucket holds others of another whole, else null."""
    of_bucket = Window.partitionBy(bucket)
    of_whole = Window.partitionBy(bucket, whole).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    measures = {"low": F.min("key"), "high": F.max("key"), "one": F.min(whole), "other": F.max(whole)}
    judged = rows.withColumn("first", F.first("key").over(of_whole)).withColumns({name: value.over(of_bucket) for name, value in measures.items()})
    state = F.when(F.col("first") < F.col("key"), "done").when(F.col("one") < F.col("other"), "open")
    return judged.filter("low < high").withColumn("state", state)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the kept bytes and the removed spans, one row for each row of docs.

    The window is longer than the gram by less than twice its length. The texts are dealt out by id once,
    compressed; the later passes over them read that shuffle again.
    """
    if not gram < window < 3 * gram:
        raise ValueError("the buckets at later offsets cover windows of less than three grams")
    rows = id_and_text(docs, id_col, text_col).withColumn("key", ordered_key())
    texts = packed(rows).repartition("key")
    bucket = F.shiftrightunsigned("head", 16)
    rest = F.shiftleft(F.col("head").bitwiseAND(0xFFFF), 32).bitwiseOR(F.col("tail").cast("long").bitwiseAND(0xFFFFFFFF))
    suffixes = rows.select("key", "text").mapInPandas(suffix_rows(window, gram), "head long, tail int, key long")
    around = suffixes.repartition(bucket).select(bucket.alias("bucket"), rest.alias("around"), "key")
    judged = texts.join(lists_by_key(with_state(around, "bucket", "around"), "around", done0="done", open0="open"), "key", "left")
    for level in range(LEVELS):
        halves = judged.mapInPandas(half_rows(window, gram, level), "half long, whole long, key long")
        lists = lists_by_key(with_state(halves, "half", "whole"), "whole", **{f"done{level + 1}": "done", f"open{level + 1}": "open"})
        judged = judged.join(lists, "key", "left")
    windows = judged.mapInPandas(window_rows(window, gram), "name long, rest short, key long")
    first = F.first("key").over(Window.partitionBy("name", "rest").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    repeated = windows.withColumn("first", first).filter("first < key").groupBy("key").agg(F.collect_list("name").alias("repeated"))
    return judged.join(repeated, "key", "left").mapInPandas(
        kept_rows(window, gram), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,end:long>>"
    )


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup(read(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def removed_by_definition(rows: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, tuple[int, int, int, str]]:
    """The same by brute force, for tests."""
    texts = {i: (t or "").encode() for i, t in rows}
    seen: set[bytes] = set()
    out = {}
    for i in sorted(texts):
        data, gone = texts[i], np.zeros(len(texts[i]), dtype=bool)
        pieces = [data[p : p + window] for p in range(len(data) - window + 1)]
        for p, piece in enumerate(pieces):
            if piece in seen:
                gone[p : p + window] = True
        seen.update(pieces)
        out[i] = (len(data), int(gone.sum()), len(runs(gone)[0]), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out
