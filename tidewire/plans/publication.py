"""Write, audit, publish: editions become visible with the history that knows them, or not at all.

A run writes its editions to a folder of its own commit number and a manifest of what they hold, reads them back and
compares, and only then appends the pointer row that makes history and editions of that number current. Readers follow the
pointers, so whatever a killed run left behind is invisible, and the next run, which takes the same number, overwrites it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.dedup import first_per_key
from tidewire.sources.state import pointers

STORED = "edition_id string, commit long, articles array<string>"
MANIFEST = "edition_id string, articles long"


class AuditFailure(RuntimeError):
    """What was written is not what was to be published; nothing was published."""


def next_commit(mark: dict | None) -> int:
    return (mark["commit"] if mark else 0) + 1


def stage(editions: list[DataFrame], folder: str, number: int) -> None:
    """Write the editions of one commit, then their manifest."""
    staged, listed = f"{folder}/editions/commit={number}", f"{folder}/manifests/commit={number}"
    spark = editions[0].sparkSession
    spark.createDataFrame([], MANIFEST).write.mode("overwrite").parquet(listed)  # what a killed run listed no longer counts
    both = editions[0]
    for other in editions[1:]:
        both = both.unionByName(other, allowMissingColumns=True)
    both.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("edition_id").json(staged)
    both.select("edition_id", F.size("articles").cast("long").alias("articles")).write.mode("overwrite").parquet(listed)


def audit(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """(edition_id, problem) of the staged editions, compared with the manifest; empty when they are whole."""
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifests/commit={number}")
    stored = spark.read.schema("edition_id string, articles array<string>").json(f"{folder}/editions/commit={number}")
    found = stored.groupBy("edition_id").agg(F.count("*").alias("documents"), F.sum(F.size("articles")).alias("stored"))
    both = listed.join(found, "edition_id", "full")
    problem = (
        F.when(F.col("articles").isNull(), F.lit("not in the manifest"))
        .when(F.coalesce("documents", F.lit(0)) != 1, F.concat(F.coalesce("documents", F.lit(0)).cast("string"), F.lit(" documents")))
        .when(F.coalesce("stored", F.lit(-1)) != F.col("articles"), F.lit("articles are missing"))
    )
    return both.select("edition_id", problem.alias("problem")).filter(F.col("problem").isNotNull())


def checked(spark: SparkSession, folder: str, number: int) -> None:
    found = audit(spark, folder, number).limit(20).collect()
    if found:
        raise AuditFailure("; ".join(f"{r['edition_id']}: {r['problem']}" for r in found))


def published_editions(spark: SparkSession, folder: str) -> DataFrame:
    """(edition_id, commit, articles as JSON texts): every published edition as its newest commit has it."""
    current = pointers(spark, folder).select("commit").distinct()
    if current.isEmpty():
        return spark.createDataFrame([], STORED)
    stored = spark.read.schema(STORED).json(f"{folder}/editions").join(current, "commit", "left_semi")
    return first_per_key(stored, ["edition_id"], (F.desc("commit"),)).select("edition_id", "commit", "articles")
