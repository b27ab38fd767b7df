"""Benchmark decontamination by a prefix-filtered set join. DataFrame functions only.

A window (13 consecutive words of an item, or the whole of a shorter item) is a set of its shingles, each with its offset. A
document contains it only if it contains all of them, so it is enough to join one: the rarest by its count over all
documents. Windows with a shingle that no document has are out at once. A join hit aligns item and document; the length bound asks
that the window fits there (both ends inside the document), the positional bound that the offset is the one in the
window. Each alignment that is left is verified word by word over the item, and every run of equal words as long as the window is
an occurrence.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lowering A-Z. Shingles have five words, or the item's if it has fewer; they
meet by hash and are verified as words. Null text has no words; items without words have no window. Repeated items count once
by id; items without an id count under an empty one. Repeated documents and those without an id are judged row by row. Empty
tables give empty or all-clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.base import ascii_lower, ordered_key, read
from tidewire.session import cut_lineage

WINDOW, SHINGLE = 13, 5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text in order; of a null none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), lambda w: w != "")


def shingles_of(words: Column, size: int) -> Column:
    """For each word the hash of the shingle that starts there; past the last whole shingle the hashes mean nothing."""
    if size == 1:
        return F.transform(words, lambda w: F.xxhash64(F.lit(size), w))
    return F.transform(words, lambda w, i: F.xxhash64(F.lit(size), w, *[F.get(words, i + k) for k in range(1, size)]))


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, words, n_window, size (of a shingle) and the shingles of each item with words, by offset."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("words"))
    rows = rows.filter(F.size("words") > 0).distinct().withColumn("n_window", F.least(F.size("words"), F.lit(window)))
    rows = rows.withColumn("size", F.least("n_window", F.lit(shingle)))
    by_size = F.lit(None).cast("array<bigint>")
    for size in range(1, shingle + 1):
        by_size = F.when(F.col("size") == size, shingles_of(F.col("words"), size)).otherwise(by_size)
    whole = F.slice(by_size, F.lit(1), F.size("words") - F.col("size") + 1)
    return rows.withColumn("shingles", whole).withColumn("item", F.xxhash64("item_id", "words"))


def shingle_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """key, position, size and hash of every shingle of a document that some item has."""
    wanted = cut_lineage(items.select("size", F.explode("shingles").alias("shingle")).distinct())
    sizes = [r["size"] for r in wanted.select("size").distinct().collect()]  # at most as many as the shingle's length
    each = docs.select("key", words_of(F.col("text")).alias("words"))
    found = None
    for size in sizes:
        hits = each.select("key", F.posexplode(shingles_of(F.col("words"), size)).alias("position", "shingle"))
        hits = hits.join(wanted.filter(F.col("size") == size).select("shingle"), "shingle", "left_semi").withColumn("size", F.lit(size))
        found = hits if found is None else found.unionByName(hits)
    return found


def anchors_of(items: DataFrame, hits: DataFrame) -> DataFrame:
    """item, offset and shingle of the rarest shingle of each window all of whose shingles occur."""
    counts = hits.groupBy("size", "shingle").agg(F.count("*").alias("n"))
    places = items.select("item", "size", "n_window", F.size("words").alias("n_item"), F.posexplode("shingles").alias("offset", "shingle"))
    counted = places.join(counts, ["size", "shingle"])
    # a shingle covers the windows that hold it whole
    first = F.greatest(F.lit(0), F.col("offset") + F.col("size") - F.col("n_window"))
    last = F.least(F.col("offset"), F.col("n_item") - F.col("n_window"))
    windows = counted.withColumn("start", F.explode(F.sequence(first, last)))
    rarest = windows.groupBy("item", "start", "size", "n_window").agg(F.min(F.struct("n", "shingle", "offset")).alias("least"), F.count("*").alias("found"))
    rarest = rarest.filter(F.col("found") == F.col("n_window") - F.col("size") + 1)
    return rarest.groupBy("item", "size", F.col("least.shingle").alias("shingle"), F.col("least.offset").alias("offset")).agg(
        F.min("start").alias("low"), F.max("start").alias("high")
    )


def equal_ends(words: Column, item_words: Column, shift: Column, n_window: Column) -> Column:
    """The last offsets of the item's windows that the document has at the given shift."""
    begin = F.struct(F.lit(0).alias("run"), F.array().cast("array<int>").alias("ends"))

    def step(state: Column, i: Column) -> Column:
        at = shift + i
        same = (at >= 0) & F.coalesce(F.get(words, at) == F.get(item_words, i), F.lit(False))
        run = F.when(same, state["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.when(run >= n_window, F.concat(state["ends"], F.array(i))).otherwise(state["ends"]).alias("ends"))

    return F.aggregate(F.sequence(F.lit(0), F.size(item_words) - 1), begin, step, lambda state: state["ends"])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, text, n_words, n_hit, the sorted item_ids with occurrences and the hit spans (item_id, start, end) of every row.

    The struct `carried` holds the other columns of docs that are asked for.
    """
    carried = F.struct(F.lit(1).alias("_"), *[F.col(c) for c in carry]).alias("carried")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), carried).withColumn("key", ordered_key())
    items = cut_lineage(item_windows(benchmark, window, shingle))
    found = shingle_hits(rows.select("key", "text"), items)
    if found is None:  # no item has a word
        judged = rows.withColumn("candidates", F.array().cast("array<struct<item_id:string,item_words:array<string>,n_window:int,shift:int>>"))
    else:
        hits = cut_lineage(found)
        anchors = cut_lineage(anchors_of(items, hits))
        aligned = hits.join(anchors, ["size", "shingle"]).select("key", "item", (F.col("position") - F.col("offset")).alias("shift"), "low")
        # the length bound: the earliest window that needs the shingle starts inside the document
        aligned = aligned.filter(F.col("shift") + F.col("low") >= 0).select("key", "item", "shift").distinct()
        with_words = aligned.join(items.select("item", "item_id", F.col("words").alias("item_words"), "n_window"), "item")
        candidates = with_words.groupBy("key").agg(F.collect_list(F.struct("item_id", "item_words", "n_window", "shift")).alias("candidates"))
        judged = rows.join(candidates, "key", "left")
    words = words_of(F.col("text"))

    def spans(c: Column) -> Column:
        ends = equal_ends(F.col("words"), c["item_words"], c["shift"], c["n_window"])
        return F.transform(ends, lambda e: F.struct((c["shift"] + e - c["n_window"] + 1).alias("start"), (c["shift"] + e + 1).alias("end"), c["item_id"].alias("item_id")))

    occurrences = F.sort_array(F.flatten(F.transform("candidates", spans)))
    out = judged.withColumn("words", words).withColumn("n_words", F.size("words").cast("long"))
    out = out.withColumn("spans", F.coalesce(F.when(F.size("candidates") > 0, occurrences), F.array().cast("array<struct<start:int,end:int,item_id:string>>")))
    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))
    n_hit = F.aggregate(
        "spans",
        begin,
        lambda s, x: F.struct(F.greatest(s["at"], x["end"]).alias("at"), (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["at"], x["start"]))).alias("n")),
        lambda s: s["n"].cast("long"),
    )
    return out.select("doc_id", "text", "carried", "n_words", n_hit.alias("n_hit"), F.array_sort(F.array_distinct(F.transform("spans", lambda x: x["item_id"]))).alias("item_ids"), "spans")


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    out = decontaminate(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), digest.alias("items_sha256"), contaminated().alias("contaminated"))
