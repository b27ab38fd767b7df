"""Runs (maximal periodic stretches) of words by string synchronising sets at dyadic scales.

At scale t a position is chosen if, among the windows of t words that start in the t + 1 positions from it on, the one of
least hash starts at the first or the last of them; windows of a period of at most t / 3 take no part. The choice depends on
the 2 t words from a position on, so equal contexts choose alike, and every t consecutive positions hold a chosen
one unless 3 t words around them have such a small period. A run of period q with 3 t - 1 <= q <= 6 t - 2 therefore has two
chosen positions q apart with equal contexts, unless its period is itself highly periodic. Chosen positions of equal context
are more than t / 3 apart, so at most 19 partners lie within 6 t of one.

Supplied separately: periods under 3 * LEAST_SCALE - 1, by comparing each word at multiples of the shortest possible stretch with the
word a period later; and runs whose period is highly periodic, which need two long runs of one small period p, touching
or overlapping, whose roots are rotations of each other: their rotation leaves one period modulo p.

A proposed (place, period) is extended to both sides by hashes of windows and checked word by word. Of equal stretches the least
period stays. So no run is missed and none is invented, whatever the hashes; tests compare with the definition.

Documents are dealt with in blocks of BLOCK words, each a task's work, without a shuffle; words of different texts never match.
Null, empty and blank texts have no words and no run. Repeated rows, rows without an id, ties and very long texts (one block of
their own) are treated alike; an empty table gives no row. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.base import Rolling, covered, id_and_text, mix, read, sliding

LEAST_LENGTH, LEAST_SCALE, BLOCK = 12, 16, 400_000
NEVER = np.uint64(2**64 - 1)
Stretches = tuple[np.ndarray, np.ndarray, np.ndarray]


class Words:
    """The words of several texts as numbers, a number that occurs once after each text, and hashes of their windows."""

    def __init__(self, texts: list[np.ndarray], least: int):
        self.least = least
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.codes = np.concatenate([np.append(t, -1 - i) for i, t in enumerate(texts)]) if texts else np.zeros(0, dtype=np.int64)
        self.longest = int(lengths.max(initial=0))
        self.rolling = Rolling(mix(self.codes.view(np.uint64)))

    def common(self, one: np.ndarray, two: np.ndarray, back: bool) -> np.ndarray:
        """How many words are equal from `one` and from `two` on, or before them."""
        done = np.zeros(len(one), dtype=np.int64)
        for bit in reversed(range(self.longest.bit_length())):
            width = 1 << bit
            a, b = (one - done - width, two - done - width) if back else (one + done, two + done)
            inside = np.flatnonzero((a >= 0) & (b + width <= len(self.codes)))
            equal = inside[self.rolling.at(a[inside], width) == self.rolling.at(b[inside], width)]
            done[equal] += width
        return done

    def stretches(self, at: np.ndarray, period: np.ndarray) -> Stretches:
        """The maximal runs of the period around given places: start, end, period; those too short are left out."""
        low = at - self.common(at, at + period, True)
        high = at + self.common(at, at + period, False)
        long_enough = high - low >= np.maximum(self.least - period, period)
        found = np.unique(np.stack((low, high, period))[:, long_enough], axis=1)
        out = []
        for a, b, q in found.T.tolist():
            equal = self.codes[a:b] == self.codes[a + q : b + q]
            if equal.all():
                out.append((a, b + q, q))
            else:  # windows of equal hash that differ
                edges = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8))).tolist()
                out += [(a + x, a + y + q, q) for x, y in zip(edges[::2], edges[1::2]) if y - x >= max(self.least - q, q)]
        start, end, q = (np.array(x, dtype=np.int64) for x in (zip(*out) if out else ((), (), ())))
        return start, end, q

    def small_periods(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and periods up to `most` where a word comes again; every long enough stretch holds one of them."""
        places, periods, n = [], [], len(self.codes)
        for q in range(1, min(most, self.longest // 2) + 1):
            step = max(self.least - q, q)
            at = np.arange(step - 1, n - q, step)
            at = at[self.codes[at] == self.codes[at + q]]
            places.append(at)
            periods.append(np.full(len(at), q, dtype=np.int64))
        return np.concatenate([np.zeros(0, dtype=np.int64), *places]), np.concatenate([np.zeros(0, dtype=np.int64), *periods])

    def chosen(self, scale: int, runs: Stretches) -> np.ndarray:
        """The synchronising set of a scale; `runs` holds all runs of smaller periods."""
        hashes = self.rolling.grams(scale)
        start, end, period = runs
        small = (3 * period <= scale) & (end - start >= scale)
        hashes = np.where(covered(start[small], end[small] - scale + 1, len(hashes)), NEVER, hashes)
        least = sliding(hashes, scale + 1, np.minimum)
        first, last = hashes[: len(least)], hashes[scale : scale + len(least)]
        return np.flatnonzero((least != NEVER) & ((first == least) | (last == least)))

    def equal_contexts(self, scale: int, runs: Stretches) -> tuple[np.ndarray, np.ndarray]:
        """Chosen places whose context comes again 3 scale - 1 to 6 scale - 2 words later, and how much later."""
        at = self.chosen(scale, runs)
        context = self.rolling.at(at, 2 * scale)
        order = np.lexsort((at, context))
        at, context = at[order], context[order]
        places, periods = [], []
        for ahead in range(1, len(at)):
            apart = at[ahead:] - at[:-ahead]
            near = (context[ahead:] == context[:-ahead]) & (apart <= 6 * scale - 2)
            if not near.any():
                break
            near &= apart >= 3 * scale - 1
            places.append(at[:-ahead][near])
            periods.append(apart[near])
        return np.concatenate([at[:0], *places]), np.concatenate([at[:0], *periods])

    def periodic_periods(self, scale: int, runs: Stretches) -> tuple[np.ndarray, np.ndarray]:
        """The same for periods that have a small period themselves: two runs that meet and have roots of one rotation class."""
        order = np.lexsort((runs[0], runs[2]))
        start, end, period = (x[order] for x in runs)
        low, high = 3 * scale - 1, 6 * scale - 2
        wide = (3 * period <= scale) & (end - start >= low)
        start, end, period = start[wide], end[wide], period[wide]
        places, periods = [], []
        for i in np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= end[:-1])).tolist():
            p, one, two = int(period[i]), int(start[i]), int(start[i + 1])
            turns = np.arange(one, one + p)
            turn = np.flatnonzero(self.rolling.at(turns, p) == self.rolling.at(np.array([two]), p))
            if len(turn):
                first = low + (two - one - int(turn[0]) - low) % p
                longest = min(high, int(end[i]) - one, int(end[i + 1]) - two)
                found = np.arange(first, longest + 1, p)
                periods.append(found)
                places.append(np.full(len(found), two - 1))
        return np.concatenate([start[:0], *places]), np.concatenate([start[:0], *periods])

    def runs(self) -> Stretches:
        """Start, end and period of every run, by start, then period."""
        found = self.least_periods(self.stretches(*self.small_periods(3 * LEAST_SCALE - 2)))
        scale = LEAST_SCALE
        while 3 * scale - 1 <= self.longest // 2:
            proposed = [np.concatenate(x) for x in zip(self.equal_contexts(scale, found), self.periodic_periods(scale, found))]
            more = self.stretches(*proposed)
            found = self.least_periods(tuple(np.concatenate(x) for x in zip(found, more)))
            scale *= 2
        order = np.lexsort((found[2], found[0]))
        return tuple(x[order] for x in found)

    @staticmethod
    def least_periods(runs: Stretches) -> Stretches:
        """Of each stretch the least period: any other one is a multiple of it."""
        start, end, period = runs
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        fresh = np.ones(len(start), dtype=bool)
        fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        return start[fresh], end[fresh], period[fresh]


def block_rows(ids: list[int | None], split: list[list[bytes]], least: int) -> pd.DataFrame:
    """The runs and the words that are left of some texts."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    words = Words([np.fromiter(map(numbers.__getitem__, s), dtype=np.int64, count=len(s)) for s in split], least)
    start, end, period = words.runs()
    bounds = np.searchsorted(start, words.starts)
    out = []
    for n, (doc_id, text) in enumerate(zip(ids, split)):
        mine = slice(bounds[n], bounds[n + 1])
        low, high, q = start[mine] - words.starts[n], end[mine] - words.starts[n], period[mine]
        runs = [{"start": a, "length": b - a, "period": c} for a, b, c in zip(low.tolist(), high.tolist(), q.tolist())]
        kept = compress(text, (~covered(low + q, high, len(text))).tolist()) if runs else text
        out.append((doc_id, len(text), runs, b" ".join(kept).decode("utf-8", "surrogatepass")))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "runs", "collapsed"]).astype({"doc_id": "Int64"})


def run_rows(least: int, block: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, split, held = [], [], 0
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"]):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if ids and held + len(words) > block:
                    yield block_rows(ids, split, least)
                    ids, split, held = [], [], 0
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                split.append(words)
                held += len(words)
            if ids:
                yield block_rows(ids, split, least)

    return rows


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, the runs and the text without repeats (kept words joined by one blank), one row for each row of docs."""
    return id_and_text(docs, id_col, text_col).mapInPandas(
        run_rows(least, block), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


# -- the query: every tenth document by hash gets a periodic tail first


def with_periodic_tail(docs: DataFrame) -> DataFrame:
    """doc_id and text; of documents whose id's crc32 is divisible by 10 every word from a place on repeats the words there."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    split = id_and_text(docs).withColumns({"h": h, "w": F.when(h % 10 == 0, words)})
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    a = F.when(n > 0, g % n)
    p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
    tail = F.transform(F.sequence(a, n - 1), lambda i: F.get("w", (a + (i - a) % p).cast("int")))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), a.cast("int")), tail), " ")
    return split.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def longest_first(runs: Column) -> Column:
    """The run of greatest length, then least start, then least period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_periodic_tail(read(spark, folder, "documents"))).withColumn("best", longest_first(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best")["length"] / F.col("best")["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def runs_by_definition(words: list, least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """The same by brute force, for tests: (start, length, period) by start, then period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())
