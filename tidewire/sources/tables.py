"""Deterministic adapters from the given parquet tables to the domain's tables.

Whole tables and whole texts; only the shape changes. Times are TIMESTAMP_NTZ in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.profiles import CATEGORIES
from tidewire.functions.slots import edition_of
from tidewire.session import bounded_batches

EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table that landed in fewer parts than there are cores; leave others alone.

    Text work is bound by the processor, and a small single file would keep it on one core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(table(spark, folder, name))


def after_epoch(seconds: Column) -> Column:
    return F.to_timestamp_ntz(F.lit(EPOCH)) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """documents as news items: one every five minutes, title = first sentence, description = whole text."""
    docs = texts(spark, folder, "documents")
    number = F.col("doc_id")
    return docs.select(
        F.concat(F.lit("d"), number).alias("id"),
        F.regexp_extract("text", r"^[^.\n]+", 0).alias("title"),
        F.col("text").alias("description"),
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), number).alias("url"),
        F.col("source").alias("source_name"),
        F.col("source").alias("publisher_id"),
        F.get(F.array(*[F.lit(c) for c in CATEGORIES]), (number % 9).cast("int")).alias("category"),
        after_epoch(number * 300).alias("published_at"),
        (1 + number % 5).cast("int").alias("priority"),
        (number % 7 == 0).alias("primary_source"),
        F.lit(False).alias("context_only"),
        F.lit("").alias("origin_edition_id"),
        number.alias("ord"),
    )


def page_items(spark: SparkSession, folder: str) -> DataFrame:
    """pages as linked items: one every ten minutes, host as publisher."""
    return texts(spark, folder, "pages").select(
        "page_id",
        "url",
        "html",
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("publisher"),
        after_epoch(F.col("page_id") * 600).alias("published_at"),
    )


def bulletins(spark: SparkSession, folder: str) -> DataFrame:
    """events as official bulletins: user as event, k as serial, value as intensity."""
    ranks = F.array(*[F.lit(x) for x in ("0", "1", "2", "3", "4", "5-", "5+", "6-")])
    return texts(spark, folder, "events").select(
        F.col("event_id").alias("ord"),
        F.lit("jma").alias("publisher"),
        F.col("user_id").cast("string").alias("event_key"),
        F.get_json_object("props", "$.k").alias("serial"),
        F.col("ts").cast("timestamp_ntz").alias("published_at"),
        F.get(ranks, (F.floor("value") % 8).cast("int")).alias("max_intensity"),
        F.length("event_type").alias("richness"),
        F.col("event_type").alias("product_title"),
    )


def with_edition(df: DataFrame, ts: str = "published_at") -> DataFrame:
    return df.withColumn("edition_id", edition_of(F.col(ts)))
