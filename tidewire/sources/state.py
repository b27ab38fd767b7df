"""Published history: stories with append order, and the high-water mark, in versioned folders.

Each commit writes a new version and then one small pointer row; readers follow the newest complete pointer. A
lost executor or a failed run leaves the previous version untouched.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import slots
from tidewire.functions.profiles import STATE_VERSION
from tidewire.operators.windows import advance_mark

STORY = "seq long, edition_id string, title string, published_at timestamp_ntz, urls array<string>"
POINTER = "version int, commit long, last_end timestamp_ntz, last_edition string"
JSON_STATE = (
    "version int, lastCompletedEnd string, lastCompletedEdition string, "
    "stories array<struct<editionId: string, title: string, publishedAt: string, urls: array<string>>>"
)


def empty_stories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STORY)


def pointers(spark: SparkSession, folder: str) -> DataFrame:
    """All commits of this state version; empty when the state is missing or unreadable."""
    try:
        return spark.read.schema(POINTER).parquet(f"{folder}/pointer").filter(F.col("version") == STATE_VERSION)
    except AnalysisException:
        return spark.createDataFrame([], POINTER)


def load_state(spark: SparkSession, folder: str) -> tuple[DataFrame, dict | None]:
    """Stories of the newest commit and its pointer row (one row at most)."""
    newest = pointers(spark, folder).orderBy(F.desc("commit")).limit(1).collect()
    if not newest:
        return empty_stories(spark), None
    mark = newest[0].asDict()
    return spark.read.schema(STORY).parquet(f"{folder}/stories/commit={mark['commit']}"), mark


def commit_state(spark: SparkSession, folder: str, stories: DataFrame, last_end, last_edition: str | None) -> int:
    """Write a new version of the stories, then the pointer that makes it current; returns its number."""
    _, mark = load_state(spark, folder)
    number = (mark["commit"] if mark else 0) + 1
    if mark and mark["last_end"] and (last_end is None or mark["last_end"] > last_end):
        last_end, last_edition = mark["last_end"], mark["last_edition"]
    stories.write.mode("overwrite").parquet(f"{folder}/stories/commit={number}")
    row = spark.createDataFrame([(STATE_VERSION, number, last_end, last_edition)], POINTER)
    row.coalesce(1).write.mode("append").parquet(f"{folder}/pointer")
    return number


def stories_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Stories of a JSON state document; another version or shape gives none, bad times are dropped."""
    raw = spark.read.schema(JSON_STATE).json(path, multiLine=True).filter(F.col("version") == STATE_VERSION)
    rows = raw.select(F.posexplode("stories").alias("seq", "s"))
    return rows.select(
        F.col("seq").cast("long"),
        F.col("s.editionId").alias("edition_id"),
        F.col("s.title").alias("title"),
        slots.parse_iso(F.col("s.publishedAt")).alias("published_at"),
        F.col("s.urls").alias("urls"),
    ).filter(F.col("published_at").isNotNull())


def completed(progress: DataFrame, end: Column) -> DataFrame:
    """Progress rows after another window is complete: the mark only moves forward."""
    return progress.withColumn("last_end", advance_mark(F.col("last_end"), end))
