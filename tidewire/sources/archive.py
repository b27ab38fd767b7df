"""Published editions as a source: context candidates and typed articles."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import slots, text
from tidewire.functions.profiles import CATEGORIES, JAPANESE, OTHER_CATEGORY, SEEN_SIMILARITY, Profile
from tidewire.functions.text import likeness

CREDIT = "公開情報をもとに"
LINK = "struct<title: string, url: string, publishedAt: string, isContinuation: boolean, originEditionId: string>"
DOCUMENT = "edition struct<id: string>, articles array<string>, broken string"


def stored_ids(spark: SparkSession, folder: str, newest: int | None = None) -> list[str]:
    """Ids of the stored editions, newest first, from the names of the files alone."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.regexp_extract("path", "edition_id=([^/]+)/", 1).alias("id"))
    ids = listed.filter("id <> ''").distinct().orderBy(F.desc("id"))
    return [r["id"] for r in (ids.limit(newest) if newest else ids).collect()]


def read_editions(spark: SparkSession, folder: str, newest: int | None = 12) -> DataFrame:
    """(edition_id, edition, articles, broken) of the newest stored editions, one row for each document.

    Documents are lines of JSON in one partition for each edition, and only the partitions of the newest editions are read. Articles
    stay JSON texts, as their fields changed over time (`article_rows`); a line that is no document has `broken` instead.
    """
    ids = stored_ids(spark, folder, newest)
    schema = f"{DOCUMENT}, edition_id string"
    if not ids:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "broken").option("mode", "PERMISSIVE")
    rows = reader.json(folder).filter(F.col("edition_id").isin(ids))
    unusable = F.col("broken").isNull() & F.col("articles").isNull()
    return rows.withColumn("broken", F.when(unusable, F.lit("no articles")).otherwise(F.col("broken")))


def article_rows(documents: DataFrame) -> DataFrame:
    """One row for each article of the readable documents, its JSON text parsed to `article` (null if it is none)."""
    rows = documents.filter(F.col("broken").isNull()).select("edition_id", F.posexplode("articles").alias("place", "json"))
    return rows.select("edition_id", "place", F.try_parse_json("json").alias("article"))


def with_documents(index: DataFrame, documents: DataFrame) -> DataFrame:
    """Each edition of the index with its documents; one without a readable document is empty, not missing."""
    readable = documents.filter(F.col("broken").isNull()).groupBy("edition_id").agg(F.sum(F.size("articles")).alias("articles"), F.count("*").alias("documents"))
    broken = documents.filter(F.col("broken").isNotNull()).groupBy("edition_id").agg(F.count("*").alias("broken"))
    return index.join(readable, "edition_id", "left").join(broken, "edition_id", "left").na.fill(0, ["articles", "documents", "broken"])


def unlike_title(df: DataFrame, out: str, points: str, title: str, threshold: float = SEEN_SIMILARITY) -> DataFrame:
    """Items of an array that are no credit line and do not repeat the title."""

    @text.arrow(T.ArrayType(T.DoubleType()))
    def scores(items: pa.Array, titles: pa.Array) -> pa.Array:
        rows = zip(items.to_pylist(), titles.to_pylist())
        return pa.array([None if v is None else [likeness(p, t or "") for p in v] for v, t in rows], pa.list_(pa.float64()))

    df = text.nfkc_items(df, "__wide", F.transform(points, lambda p: text.squash(p, 300)))
    norm = lambda w: F.regexp_replace(F.regexp_replace(F.lower(w), text.TITLE_SUFFIX, ""), text.NON_TITLE, "")
    df = df.withColumn("__norms", F.transform("__wide", norm))
    df = text.normalize_title(df, "__title", F.col(title))
    df = df.withColumn("__scores", scores(F.col("__norms"), F.col("__title")))
    judged = F.zip_with(points, "__scores", lambda p, s: F.struct(p.alias("p"), s.alias("s")))
    # a title without a letter that a normalised one keeps scores nothing, also against itself
    repeats = lambda x: (x["s"] >= threshold) | (x["p"] == F.coalesce(F.col(title), F.lit("")))
    kept = F.filter(judged, lambda x: ~repeats(x) & ~F.contains(x["p"], F.lit(CREDIT)))
    return df.withColumn(out, F.transform(kept, lambda x: x["p"])).drop("__wide", "__norms", "__title", "__scores")


def archive_context(editions: DataFrame, profile: Profile = JAPANESE, most_sources: int = 3) -> DataFrame:
    """Every source link of earlier editions as a context candidate, with `published_at`.

    Articles with `most_sources` or more sources are left out, so that context is not built from roundups.
    Callers keep the rows inside their window's span.
    """
    nothing = F.array().cast("array<string>")
    rows = editions.select(F.col("edition.id").alias("origin_edition_id"), F.posexplode("articles").alias("article_no", "a"))
    rows = rows.filter(F.coalesce("a.sourceCount", F.lit(0)) < most_sources)
    rows = rows.withColumn("__single", F.size("a.sources") == 1)
    rows = rows.select("*", F.posexplode("a.sources").alias("source_no", "s"))
    fallback = F.struct(
        F.col("a.title").alias("title"),
        F.col("s.url").alias("url"),
        F.coalesce("s.publishedAt", "a.publishedAt").alias("publishedAt"),
        F.lit(False).alias("isContinuation"),
        F.lit("").alias("originEditionId"),
    )
    links = F.when(F.size(F.coalesce("s.links", F.array().cast(f"array<{LINK}>"))) > 0, F.col("s.links")).otherwise(F.array(fallback))
    rows = rows.withColumn("points", F.coalesce("s.keyPoints", nothing)).withColumn("__heading", F.coalesce("a.title", F.lit("")))
    rows = unlike_title(rows, "points", "points", "__heading")
    own = F.concat(*[F.coalesce(f"a.{n}", nothing) for n in ("facts", "impactPoints", "watchPoints")], F.filter(F.array("a.background"), lambda b: F.coalesce(b, F.lit("")) != ""))
    values = F.array_distinct(F.concat("points", F.when(F.col("__single"), own).otherwise(nothing)))
    rows = text.clean_text(rows, "description", F.array_join(values, " "), 900)
    rows = rows.select("*", F.posexplode(links).alias("link_no", "x")).filter(F.coalesce("x.url", F.lit("")) != "")
    at = slots.parse_iso(F.coalesce("x.publishedAt", "s.publishedAt", "a.publishedAt"))
    rows = text.clean_text(rows.withColumn("published_at", at), "title", F.coalesce(F.nullif("x.title", F.lit("")), F.col("a.title")), 180)
    publisher = F.coalesce(F.nullif("s.publisherId", F.lit("")), F.nullif("s.name", F.lit("")), F.lit("archive"))
    return rows.filter((F.col("title") != "") & F.col("published_at").isNotNull()).select(
        F.concat(F.lit("context-"), text.stable_hash(F.concat_ws("|", "origin_edition_id", "x.url"), 20)).alias("id"),
        "title",
        "description",
        F.col("x.url").alias("url"),
        text.squash(F.coalesce("s.name", F.lit("既報の配信元")), 80).alias("source_name"),
        text.squash(publisher, 60).alias("publisher_id"),
        F.when(F.col("a.category").isin(*CATEGORIES), F.col("a.category")).otherwise(OTHER_CATEGORY).alias("category"),
        "published_at",
        F.least(F.greatest(F.coalesce("a.importance", F.lit(3)), F.lit(1)), F.lit(5)).alias("priority"),
        F.coalesce("s.isPrimary", F.lit(False)).alias("primary_source"),
        F.lit(True).alias("context_only"),
        "origin_edition_id",
        (F.col("article_no") * 1000 + F.col("source_no") * 100 + F.col("link_no")).cast("long").alias("ord"),
    )
