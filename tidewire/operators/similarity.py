"""Lossless blocking for title similarity.

The score of two normalised titles is the best of sequence ratio, bigram Jaccard and containment. With
S = len(a) + len(b) and a threshold t above 2/3:

* ratio >= t means at least t*S/2 characters matched in at most (1-t)*S + 1 blocks, hence at least
  (1.5t-1)*S - 1 shared bigram occurrences, and min/max length >= t/(2-t); containment implies both;
* Jaccard >= t means at least t*n shared distinct bigrams out of the n of either side.

Each title is therefore indexed by a prefix of its numbered bigrams (ratio) and of its distinct bigrams
(Jaccard), long enough that every matching pair shares an indexed token. Titles so short that the first bound
is vacuous are indexed by characters as well. Tokens come in one order for both sides, rarest first: the counts of the
most frequent bigrams, a table of bounded size, decide; all others come before them in a fixed order, so any table
gives the same pairs. Token and length class are the key of the join, and a key with many rows is split into numbered blocks
that meet pair by pair, so the largest task does not grow with a frequent bigram. Small groups meet without tokens. Candidate pairs are reduced by length and by exact
overlap counts before the sequence ratio is computed, a whole Arrow batch at once.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.sequence import ratios
from tidewire.functions.text import TEXTS, arrow, each
from tidewire.session import cut_lineage

EPSILON = 1e-9
#: Bigrams whose counts order the tokens, at most; rows of a key on either side that meet in one block.
FREQUENT, BLOCK = 5_000, 2_000
#: Pairs of a group up to which all of them are scored, without tokens.
DIRECT = 4_096
#: Split keys that are sent to every task at most; more are joined by shuffling.
SMALL = 100_000
TOKENS = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("n", T.IntegerType())]))


def bigrams_of(title: str) -> list[str]:
    return [title[i:i + 2] for i in range(max(1, len(title) - 1))]


def numbered(items: list[str], tag: str) -> list[str]:
    """Each item with its occurrence number, so that a multiset becomes a set."""
    seen: Counter[str] = Counter()
    out = []
    for item in items:
        seen[item] += 1
        out.append(f"{tag}{item}{seen[item]}")
    return out


def prefix(tokens: list[str], shared: float, counts: dict[str, int]) -> list[str]:
    """The start, rarest first, that meets every set sharing at least `shared` of these tokens.

    A token is a letter for its kind, a bigram and perhaps the number of the occurrence; later occurrences are rarer.
    """
    size = len(tokens) - max(1, math.ceil(shared - EPSILON)) + 1

    def place(token: str) -> tuple:
        occurrence = int(token[3:] or 1) if token[0] == "m" and len(token) > 3 else 1
        return counts.get(token[1:3], 0) // occurrence**2, zlib.crc32(token.encode()), token

    return sorted(tokens, key=place)[: max(size, 0)]


def title_tokens(title: str, threshold: float, counts: dict[str, int], full: bool = True) -> list[tuple[str, int]]:
    """The tokens under which a title is found, each with the number that bounds a partner's: its length or its distinct bigrams.

    Without `full`, those of distinct bigrams alone, which find every pair whose Jaccard reaches the threshold.
    """
    pairs = bigrams_of(title)
    distinct = sorted(set(pairs))
    sets = [(token, len(distinct)) for token in prefix(["s" + p for p in distinct], threshold * len(distinct), counts)]
    if not full:
        return sets
    gain, total = 1.5 * threshold - 1, 2 * len(title) / (2 - threshold)  # total: least len(a) + len(b) of a match
    tokens = prefix(numbered(pairs, "m"), gain * total - 1, counts)
    if len(title) * gain <= 1:
        tokens += prefix(numbered(list(title), "u"), threshold * total / 2, {})
    return [(token, len(title)) for token in tokens] + sets


def frequent_bigrams(titles: DataFrame, title: str, most: int = FREQUENT) -> dict[str, int]:
    """In how many titles the most frequent bigrams occur; a table of bounded size, whatever the input."""

    @arrow(TEXTS)
    def sets(values: pa.Array) -> pa.Array:
        return each(values, lambda v: sorted(set(bigrams_of(v))), pa.list_(pa.string()))

    counts = titles.select(F.explode(sets(F.col(title))).alias("gram")).groupBy("gram").agg(F.count("*").alias("f"))
    return {r["gram"]: r["f"] for r in counts.orderBy(F.desc("f"), "gram").limit(most).collect()}


def indexed(df: DataFrame, title: str, threshold: float, counts: dict[str, int], partners: bool, full: bool = True) -> DataFrame:
    """One row for each token of each row and, with `partners`, each length class a match can have; else for its own class.

    Classes are so wide that a match lies in at most two of them.
    """
    if full and threshold <= 2 / 3:
        raise ValueError("the blocking bound needs a threshold above 2/3")

    @arrow(TOKENS)
    def tokens(titles: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("token", pa.string()), ("n", pa.int32())]))
        return each(titles, lambda v: [{"token": t, "n": n} for t, n in title_tokens(v, threshold, counts, full)], kind)

    rows = df.select("*", F.inline(tokens(F.col(title)))).drop(title)
    bound = shortest_share(F.col("token"), threshold)

    def length_class(n: Column, slack: float) -> Column:
        return F.floor(F.ln(n) / (-2 * F.ln(bound)) + slack)

    if not partners:
        return rows.withColumn("class", length_class(F.col("n"), 0))
    return rows.withColumn("class", F.explode(F.sequence(length_class(F.col("n") * bound, -EPSILON), length_class(F.col("n") / bound, EPSILON))))


def shortest_share(token: Column, threshold: float) -> Column:
    """The least share of the longer side's number that the shorter one has in a match found by this kind of token."""
    return F.when(F.substring(token, 1, 1) == "s", F.lit(threshold)).otherwise(F.lit(threshold / (2 - threshold)))


def in_blocks(left: DataFrame, right: DataFrame, keys: list[str], block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Both sides with `a_block` and `b_block`, by which their rows meet as often as by the keys alone.

    The rows of a key are dealt to numbered blocks of about `block` rows on each side, and every block of one
    side meets every block of the other. Only keys that are split are listed; they are sent to every task if few.
    """
    def sized(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias(name))

    split = cut_lineage(sized(left, "a_blocks").join(sized(right, "b_blocks"), keys).filter("a_blocks > 1 or b_blocks > 1"))
    few = split.limit(SMALL + 1).count() <= SMALL
    split = F.broadcast(split) if few else split

    def dealt(df: DataFrame, row: str, own: str, other: str) -> DataFrame:
        df = df.join(split, keys, "left").na.fill(1, ["a_blocks", "b_blocks"])
        mine = F.pmod(F.xxhash64(row), F.col(f"{own}_blocks")).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        return df.withColumn(f"{own}_block", mine).withColumn(f"{other}_block", others).drop("a_blocks", "b_blocks")

    return dealt(left, "l__row", "a", "b"), dealt(right, "r__row", "b", "a")


@arrow(T.DoubleType())
def bigram_jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaccard of the distinct bigrams, built once for each title of a batch; expressions would be quadratic in long titles."""
    pairs = list(zip(left.to_pylist(), right.to_pylist()))
    sets = {title: set(bigrams_of(title)) for pair in pairs for title in pair}
    shared = [len(sets[a] & sets[b]) for a, b in pairs]
    return pa.array([k / (len(sets[a]) + len(sets[b]) - k) for (a, b), k in zip(pairs, shared)], pa.float64())


def likeness_from(threshold: float):
    """Column function: the score of two titles where it reaches the threshold, else anything below it.

    Bigrams are counted once for each title of a batch. Pairs whose lengths or shared bigram occurrences rule the sequence
    ratio out keep their Jaccard or containment; the ratios of the others are worked out together.
    """
    gain = 1.5 * threshold - 1

    @arrow(T.DoubleType())
    def scores(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = list(zip(left.to_pylist(), right.to_pylist()))
        counts = {title: Counter(bigrams_of(title)) for pair in pairs for title in pair}
        out, open_ = [], []
        for i, (a, b) in enumerate(pairs):
            short, long = sorted((len(a), len(b)))
            shared = counts[a].keys() & counts[b].keys()
            overlap = len(shared) / (len(counts[a]) + len(counts[b]) - len(shared))
            out.append(max(overlap, short / long if a in b or b in a else 0.0))
            if short * (2 - threshold) >= long * threshold - EPSILON:
                occurrences = sum([min(counts[a][g], counts[b][g]) for g in shared])
                if occurrences >= gain * (short + long) - 1 - EPSILON:
                    open_.append(i)
        for i, found in zip(open_, ratios(*[[pairs[i][side] for i in open_] for side in (0, 1)]).tolist()):
            out[i] = max(out[i], found)
        return pa.array(out, pa.float64())

    return scores


def similar_pairs(
    left: DataFrame,
    right: DataFrame,
    left_title: str,
    right_title: str,
    threshold: float,
    on: tuple[str, ...] = (),
    extra: Column | None = None,
    full: bool = True,
) -> DataFrame:
    """Pairs of rows whose normalised titles score at least `threshold`, with `similarity`.

    The columns of both sides must have different names except the equi-join columns `on`. Titles are compared
    as (left, right): the sequence ratio depends on the order. Without `full`, the score is the bigram Jaccard alone.

    Groups (rows of one `on`) of so few rows that all their pairs are fewer than their tokens meet directly. In all others only
    numbers of rows are exploded and met; titles are joined back to the distinct pairs.
    """
    left = cut_lineage(left.filter(F.col(left_title).isNotNull()).withColumn("l__row", F.monotonically_increasing_id()))
    right = cut_lineage(right.filter(F.col(right_title).isNotNull()).withColumn("r__row", F.monotonically_increasing_id()))
    met, large = None, None
    if on:
        sizes = left.groupBy(*on).agg(F.count("*").alias("l__n")).join(right.groupBy(*on).agg(F.count("*").alias("r__n")), list(on))
        sizes = cut_lineage(sizes.select(*on, (F.col("l__n") * F.col("r__n") <= DIRECT).alias("l__few")))
        few = sizes.filter("l__few").select(*on)
        met = left.join(few, list(on), "left_semi").join(right, list(on)).drop("l__row", "r__row")
        large = sizes.filter("not l__few").select(*on)
    if large is None or not large.isEmpty():
        found = met_by_tokens(left, right, left_title, right_title, threshold, on, large, full)
        met = found if met is None else met.unionByName(found)
    if extra is not None:
        met = met.filter(extra)
    score = likeness_from(threshold) if full else bigram_jaccard
    return met.withColumn("similarity", score(F.col(left_title), F.col(right_title))).filter(F.col("similarity") >= threshold)


def met_by_tokens(
    left: DataFrame, right: DataFrame, left_title: str, right_title: str, threshold: float, on: tuple[str, ...], groups: DataFrame | None, full: bool
) -> DataFrame:
    """Pairs of numbered rows (of some groups) that share a token and whose numbers allow a match."""
    if groups is not None:
        left, right = (cut_lineage(side.join(groups, list(on), "left_semi")) for side in (left, right))
    titles = left.select(F.col(left_title).alias("t")).unionByName(right.select(F.col(right_title).alias("t")))
    counts = frequent_bigrams(titles, "t")
    a = cut_lineage(indexed(left.select(*on, "l__row", left_title), left_title, threshold, counts, True, full))
    b = cut_lineage(indexed(right.select(*on, "r__row", right_title), right_title, threshold, counts, False, full))
    keys = [*on, "token", "class"]
    a, b = in_blocks(a.withColumnRenamed("n", "l__n"), b.withColumnRenamed("n", "r__n"), keys)
    close = F.least("l__n", "r__n") >= F.greatest("l__n", "r__n") * shortest_share(F.col("token"), threshold) - EPSILON
    met = a.join(b, [*keys, "a_block", "b_block"]).filter(close).select("l__row", "r__row").distinct()
    return met.join(left, "l__row").join(right.drop(*on), "r__row").drop("l__row", "r__row")


def jaccard_pairs(df: DataFrame, title: str, threshold: float, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of distinct normalised titles (left < right) whose bigram Jaccard reaches the threshold."""
    rows = df.select(*on, title).distinct().filter(F.col(title) != "")
    left, right = (rows.withColumnRenamed(title, name) for name in ("left_title", "right_title"))
    ordered = F.col("left_title") < F.col("right_title")
    pairs = similar_pairs(left, right, "left_title", "right_title", threshold, on, ordered, full=False)
    return pairs.select(*on, "left_title", "right_title", F.col("similarity").alias("jaccard"))
