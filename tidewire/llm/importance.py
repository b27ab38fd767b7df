"""Target-distribution importance resampling: array-scored weights, then a numeric bisection of the threshold.

A text is an array of hashed n-gram buckets, written once. One exact count job a side gives how often a bucket occurs in the
source and in the target; the gains of all buckets are one array, whose size is the parameter `buckets`, so it grows with neither side.
A document's weight is the floored mean of the gains at its buckets; with a Gumbel draw from a hash of its id it becomes a
score, so the highest scores are a sample without replacement by weight.

The cutoff is found by bisection: exact counts over the written scores at the next midpoints, a few levels a job, then the same over
the ids tied at the cutoff score, then over the row numbers of one repeated id. No row is ever sorted for that. Only the drawn
rows are range-partitioned and numbered: a row's rank is its place in its partition after the sizes of the earlier ones.

Null and empty texts have no features and a weight of 0. Rows without an id get the draw of an empty id and come last in ties. Repeated rows
each count, each are scored and may each be drawn. An empty source gives no row; an empty target gives every bucket its smoothed gain.
Very long texts are one array each. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.base import ascii_lower, id_and_text, ordered_key, read
from tidewire.session import cut_lineage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 2024, 10, 20
#: Levels of the bisection that one count job settles: it counts at 2 ** LEVELS - 1 midpoints.
LEVELS = 4


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def grams_of(words: Column, longest: int) -> Column:
    """All runs of one to `longest` consecutive words, joined by a blank."""

    def of(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))

    return F.concat(words, *[of(n) for n in range(2, longest + 1)]) if longest > 1 else words


def bucket_arrays(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """Every row's key, number of words and the bucket of each of its features."""
    split = texts.withColumn("words", words_of(F.col("text")))
    hashed = F.transform(grams_of(F.col("words"), longest), lambda g: (F.crc32(g) % buckets).cast("int"))
    return split.select("doc_id", F.size("words").alias("n_words"), hashed.alias("buckets"))


def bucket_counts(arrays: DataFrame, name: str) -> DataFrame:
    return arrays.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))


def gain_array(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """One row: the gain of every bucket, by bucket number. Both inputs have at most `buckets` rows."""
    counts = (
        source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(bucket_counts(source, "s"), "bucket", "left")
        .join(bucket_counts(target, "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in "st"])
    )
    of_all = F.array_sort(F.collect_list(F.struct("bucket", "s", "t")))
    totals = counts.agg(of_all.alias("c"), F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))

    def gain(c: Column) -> Column:
        ratio = (c["t"] + 1) * (F.col("all_s") + buckets) / ((c["s"] + 1) * (F.col("all_t") + buckets))
        return F.floor(1000 * F.ln(ratio))

    return totals.select(F.transform("c", gain).alias("gains"))


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw from the id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = 1, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row of docs; `target` is one column of texts."""
    arrays = cut_lineage(bucket_arrays(id_and_text(docs, id_col, text_col), buckets, longest))
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target.columns[0]).cast("string").alias("text"))
    gains = cut_lineage(gain_array(arrays, bucket_arrays(wanted, buckets, longest), buckets))
    features = F.size("buckets")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda acc, b: acc + F.get("gains", b))
    weight = F.when(features > 0, F.floor(total / features)).otherwise(F.lit(0)).cast("long")
    return (
        arrays.withColumn("gains", gains.scalar())
        .select("doc_id", "n_words", features.cast("long").alias("n_features"), weight.alias("weight"))
        .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    )


def least_reaching(rows: DataFrame, value: Column, wanted: int, levels: int = LEVELS) -> int:
    """The least number v for which at least `wanted` (one or more) rows have a value of at most v, by exact counts."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        step = max(1, -(-(high - low) // 2**levels))
        marks = list(range(low, high, step))
        counts = rows.agg(*[F.count(F.when(value <= m, 1)) for m in marks]).first()
        reached = next((i for i, n in enumerate(counts) if n >= wanted), len(marks))
        low, high = (marks[reached - 1] + 1 if reached else low), (marks[reached] if reached < len(marks) else high)
    return high


def draw(rows: DataFrame, wanted: int, eligible: Column) -> DataFrame:
    """rows (doc_id, score and a number of its own in `row`) with the rank of the `wanted` best eligible ones, null for the others.

    Best is the highest score, then the least doc_id, then the least row number.
    """
    if wanted < 1:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    stages = [-F.col("score"), ordered_key(), F.col("row")]
    left, pool, ahead, chosen = wanted, rows.filter(eligible), F.lit(True), F.lit(False)
    for value in stages:
        cut = least_reaching(pool, value, left)
        left -= pool.filter(value < cut).count()
        chosen, ahead = chosen | (ahead & (value < cut)), ahead & (value == cut)
        pool = pool.filter(value == cut)
        if pool.count() == left:
            break
    drawn = F.coalesce(eligible & (chosen | ahead), F.lit(False))
    order = [F.col("score").desc(), ordered_key(), F.col("row")]
    placed = cut_lineage(
        rows.filter(drawn).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    )
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(2**33 - 1)
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())  # a number for each partition
    before, upto = {}, 0
    for p in sorted(sizes):
        before[p], upto = upto, upto + sizes[p]
    offsets = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    ranked = placed.withColumn("rank", (offsets[part] + within + 1).cast("long")).drop("place")
    return rows.filter(~drawn).withColumn("rank", F.lit(None).cast("long")).unionByName(ranked)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
    longest: int = 1, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank: percent of the documents with enough words, drawn by importance weight."""
    rows = scored(docs, target, buckets, longest, seed, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    stored = cut_lineage(rows)
    eligible = F.col("n_words") >= least_words
    wanted = percent * stored.filter(eligible).count() // 100
    return draw(stored, wanted, eligible).select("doc_id", "n_features", "weight", "score", "rank")


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    return resample(read(spark, folder, "documents"), read(spark, folder, "benchmark").select("text"))
