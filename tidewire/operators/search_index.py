"""A persisted n-gram index for the search over all editions.

Articles are numbered and written once with their search form. The index holds, for each gram (two characters) and block of
consecutive numbers, the numbers of the articles that contain it, as differences; grams are dealt to buckets, which are partitions of
the table, so a search reads the buckets of its grams only. A block bounds the length of a list, however frequent a gram.

A search takes the rarest gram of each term by the counts in the index, intersects their lists and checks the terms on
the texts of what is left, so the rows are those of a scan. Terms of one character, which have no gram, are checked on all rows the other terms
leave, or on all rows. A search without a term finds everything, as a scan does.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import text

WIDTH, BUCKETS, BLOCK = 2, 32, 4096


def bucket_of(gram: Column, buckets: int) -> Column:
    return (F.crc32(gram) % buckets).cast("int")


def terms_of(query: str) -> list[str]:
    """The terms of a query in search form, longest first, without those inside another."""
    terms = sorted({re.sub(text.NON_TITLE, "", text.wide(t).lower()) for t in query.split()} - {""}, key=lambda t: (-len(t), t))
    return [t for i, t in enumerate(terms) if not any(t in longer for longer in terms[:i])]


@dataclass(frozen=True)
class SearchIndex:
    spark: SparkSession
    folder: str
    buckets: int = BUCKETS

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/rows")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/postings")

    def read(self, grams: list[str]) -> DataFrame:
        """The lists of some grams; other buckets are pruned by partition."""
        wanted = sorted({zlib.crc32(g.encode()) % self.buckets for g in grams})
        return self.postings.filter(F.col("bucket").isin(wanted) & F.col("gram").isin(grams))

    def rarest(self, terms: list[str]) -> dict[str, str]:
        """The gram of each term that the fewest articles contain; a term with a gram that nothing contains gets that one."""
        grams = {t: sorted({t[i : i + WIDTH] for i in range(len(t) - WIDTH + 1)}) for t in terms}
        every = sorted({g for found in grams.values() for g in found})
        counts = {r["gram"]: r["n"] for r in self.read(every).groupBy("gram").agg(F.sum("n").alias("n")).collect()} if every else {}
        return {t: min(found, key=lambda g: (counts.get(g, 0), g)) for t, found in grams.items() if found}

    def search(self, query: str) -> DataFrame:
        """The rows of the articles that contain every term of the query."""
        terms = terms_of(query)
        chosen = sorted(set(self.rarest(terms).values()))
        rows = self.rows
        if chosen:
            listed = self.read(chosen).select("gram", F.explode(numbers(F.col("first"), F.col("steps"))).alias("number"))
            found = listed.groupBy("number").agg(F.count("*").alias("grams")).filter(F.col("grams") == len(chosen))
            rows = rows.join(found.select("number"), "number", "left_semi")
        for term in terms:
            rows = rows.filter(F.contains("haystack", F.lit(term)))
        return rows.drop("number", "haystack")


def numbers(first: Column, steps: Column) -> Column:
    """The numbers of a list from its first one and the differences of the others."""
    start = F.struct(first.alias("last"), F.array(first).alias("all"))
    grow = lambda acc, step: F.struct((acc["last"] + step).alias("last"), F.concat(acc["all"], F.array(acc["last"] + step)).alias("all"))
    return F.aggregate(steps, start, grow, lambda acc: acc["all"])


def build_index(articles: DataFrame, haystack: Column, folder: str, buckets: int = BUCKETS, block: int = BLOCK) -> SearchIndex:
    """Write the numbered rows and the lists below the folder; `haystack` is the text that a search looks into."""
    spark = articles.sparkSession
    formed = text.comparison_text(articles, "haystack", haystack).withColumn("number", F.monotonically_increasing_id())
    formed.write.mode("overwrite").parquet(f"{folder}/rows")
    index = SearchIndex(spark, folder, buckets)
    grams = index.rows.select("number", F.explode(text.pair_sets(F.col("haystack"))).alias("gram"))
    lists = grams.groupBy("gram", F.floor(F.col("number") / block).alias("block")).agg(F.array_sort(F.collect_list("number")).alias("all"))
    steps = F.zip_with(F.slice("all", F.lit(2), F.size("all")), F.slice("all", F.lit(1), F.size("all") - 1), lambda b, a: (b - a).cast("int"))
    coded = lists.select(
        "gram", "block", F.size("all").alias("n"), F.get("all", F.lit(0)).alias("first"), steps.alias("steps"), bucket_of(F.col("gram"), buckets).alias("bucket")
    )
    dealt = coded.repartition("bucket", F.pmod(F.xxhash64("gram", "block"), F.lit(4))).sortWithinPartitions("bucket", "gram", "block")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")
    return index
