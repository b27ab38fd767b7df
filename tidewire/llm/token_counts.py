"""Token counts by heap-and-linked-list byte-pair merging: symbols minus merges, without token ids.

A text is normalised as its vocabulary says and starts as a linked list of characters, a character that the vocabulary
lacks as its bytes. A heap holds every adjacent pair that is a piece, best piece first and then leftmost; the lowest is
popped, joined in the list, and its new neighbours are pushed, until none is left. A merge takes one symbol away.

A merge never crosses two neighbouring characters that no piece has side by side, so texts are cut there first (blanks
and line ends are such places too, if the vocabulary has no piece across them) and the counts of parts are remembered.
All this is read off the vocabulary. A part costs n log n, whatever its length.

Null and empty texts have no tokens and no bytes. Repeated rows, rows without an id and very long texts are counted like any
other; an empty table gives no row. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.base import id_and_text, read

LIMIT = 4096
#: Parts whose counts a worker remembers before it forgets those not used lately, and the longest that it remembers.
REMEMBERED, LONGEST = 500_000, 48
BLANK, NONE = "▁", -1


class Merger(dict):
    """The token count of each part of a text, worked out when first asked for."""

    def __init__(self, ranks: dict[str, int], symbols: set[str]):
        super().__init__()
        self.ranks, self.known = ranks, frozenset(symbols)
        self.joined = frozenset(p[i : i + 2] for p in ranks for i in range(len(p) - 1))
        self.older: dict[str, int] = {}

    def __missing__(self, part: str) -> int:
        count = self.older.get(part)
        if count is None:
            pairs = list(map(add, part, part[1:]))
            if self.joined.issuperset(pairs):
                count = self.symbols(part) - self.merges(part)
            else:
                cuts = [0, *[i for i, pair in enumerate(pairs, 1) if pair not in self.joined], len(part)]
                count = sum([self[part[a:b]] for a, b in zip(cuts, cuts[1:])])
        if len(part) <= LONGEST:
            self[part] = count
        return count

    def forget(self) -> None:
        """Only the parts asked for since the last time stay."""
        self.older = dict(self)
        self.clear()

    def symbols(self, part: str) -> int:
        """Characters, and for each one that is no piece its bytes."""
        known = self.known
        return len(part) if known.issuperset(part) else sum([1 if c in known else len(c.encode("utf-8", "replace")) for c in part])

    def merges(self, part: str) -> int:
        """A heap entry is rank and place of a pair in one number; it counts only while `now` still has that rank at that place.

        The symbol that starts at character i ends at end[i], and the one before it starts at before[i]; one more character
        than the part has stands behind it and is in no piece.
        """
        rank, n = self.ranks.get, len(part)
        bits = n.bit_length()
        now = list(map(rank, map(add, part, part[1:]), repeat(NONE, n - 1)))
        heap = [r << bits | i for i, r in enumerate(now) if r != NONE]
        if not heap:
            return 0
        if len(heap) > 1:
            heapify(heap)
        now.append(NONE)
        end, before, places, done = [*range(1, n + 1), n], [*range(-1, n)], (1 << bits) - 1, 0
        while heap:
            entry = heappop(heap)
            i = entry & places
            if now[i] == entry >> bits:
                done += 1
                middle = end[i]
                end[i] = stop = end[middle]
                now[middle] = now[i] = NONE
                before[stop] = i
                if stop < n:
                    r = rank(part[i : end[stop]])
                    if r is not None:
                        now[i] = r
                        heappush(heap, r << bits | i)
                if i:
                    left = before[i]
                    now[left] = r = rank(part[left:stop], NONE)
                    if r != NONE:
                        heappush(heap, r << bits | left)
        return done


class PieceCounter:
    """Counts the tokens of texts for a byte-pair vocabulary of pieces with byte fallback."""

    def __init__(self, vocabulary: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=vocabulary)
        size = model.get_piece_size()
        if not any(model.is_byte(i) for i in range(size)):
            raise ValueError(f"{vocabulary} has no byte pieces")
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        order = {score: n for n, score in enumerate(sorted(set(scores.values()), reverse=True))}
        longer = [p for p in scores if len(p) > 1]
        self.normalize = model.normalize
        self.counts = Merger({p: order[scores[p]] for p in longer}, {p for p in scores if len(p) == 1})
        inside = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in longer)
        alone = "" if any("\n" in p for p in longer) else "\n"
        self.parts = re.compile(f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+|\n" if inside else r"(?s:.+)").findall

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if len(self.counts) > REMEMBERED:
            self.counts.forget()
        return sum(map(self.counts.__getitem__, self.parts(self.normalize(text))))


_counters: dict[str, PieceCounter] = {}


def token_count(text: Column, vocabulary: str) -> Column:
    """The number of tokens of a text, as a long."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if vocabulary not in _counters:
            _counters[vocabulary] = PieceCounter(vocabulary)
        for texts in batches:
            yield pd.Series([_counters[vocabulary].count(t) for t in texts], dtype="int64")

    return counted.asNondeterministic()(text)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; one pass without a shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = id_and_text(docs, id_col, text_col).select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), token_count(text, vocabulary).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    return token_counts(read(spark, folder, "documents"), vocabulary or default_vocabulary())
