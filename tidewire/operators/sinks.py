"""Edition, archive and feed outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions import slots
from tidewire.functions.profiles import ARCHIVE_LIMIT
from tidewire.operators.articles import category_rank, counts_map
from tidewire.operators.dedup import first_per_key

EMPTY_HEADLINE = "この時間帯の新着記事はありません"
SAMPLE_LABEL = "サンプル"


def write_editions(editions: DataFrame, folder: str) -> None:
    """One partition per edition; a rerun replaces exactly the editions it contains."""
    (
        editions.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("edition_id")
        .json(folder)
    )


def latest_edition(editions: DataFrame) -> DataFrame:
    return editions.orderBy(F.desc("edition_id")).limit(1)


def archive_rows(articles: DataFrame, windows: DataFrame, generated_at: Column) -> DataFrame:
    """Index row of each edition: labels, headline, article and category counts."""
    heads = first_per_key(articles, ["edition_id"], (F.col("position"),)).select("edition_id", F.col("title").alias("headline"))
    counts = articles.groupBy("edition_id").agg(F.count("*").alias("article_count"))
    df = windows.join(heads, "edition_id", "left").join(counts, "edition_id", "left")
    df = df.join(counts_map(articles, ["edition_id"], "category", "categories"), "edition_id", "left")
    path = F.concat(F.lit("data/editions/"), "edition_id", F.lit(".json"))
    return df.select(
        "edition_id",
        path.alias("path"),
        generated_at.alias("generated_at"),
        F.date_format("window_end", "yyyy-MM-dd").alias("date"),
        F.date_format("window_end", "HH:mm").alias("time"),
        slots.slot_label(F.col("window_end")).alias("label"),
        slots.coverage_label(F.col("window_end")).alias("coverage_label"),
        F.coalesce("headline", F.lit(EMPTY_HEADLINE)).alias("headline"),
        F.coalesce("article_count", F.lit(0)).alias("article_count"),
        "categories",
    )


def upsert_archive(archive: DataFrame, new: DataFrame, limit: int = ARCHIVE_LIMIT) -> DataFrame:
    """Index with the new rows in front: same ids replaced, samples dropped, the newest `limit` insertions kept.

    `archive` has `place` (0 = newest insertion); `new` has `place` among the new rows, 0 = inserted last.
    """
    kept = archive.filter(~F.coalesce("is_sample", F.lit(False)) & ~F.contains(F.coalesce("label", F.lit("")), F.lit(SAMPLE_LABEL)))
    both = kept.withColumn("__age", F.lit(1)).unionByName(new.withColumn("__age", F.lit(0)), allowMissingColumns=True)
    newest = first_per_key(both, ["edition_id"], (F.col("__age"), F.col("place")))
    top = newest.orderBy("__age", "place").limit(limit)
    order = Window.orderBy("__age", "place")
    return top.withColumn("place", F.row_number().over(order) - 1).drop("__age")


def feed_items(archive: DataFrame, articles: DataFrame, base_url: str = "", editions: int = 20, per_edition: int = 5) -> DataFrame:
    """Items of the newest editions for export: title, link, guid, description, RFC 2822 date."""
    newest = archive.orderBy("place").limit(editions).select("edition_id", "place")
    mine = articles.join(newest, "edition_id")
    top = first_per_key(mine, ["edition_id"], (F.col("position"),), per_edition)
    root = base_url.rstrip("/") + "/"
    return top.select(
        "place",
        "position",
        "title",
        F.concat(F.lit(f"{root}?article="), F.url_encode("slug")).alias("link"),
        F.col("id").alias("guid"),
        F.col("summary").alias("description"),
        slots.rfc2822(F.col("published_at")).alias("pub_date"),
    )


def write_feed(items: DataFrame, folder: str) -> None:
    """Feed items as XML rows."""
    ordered = items.orderBy("place", "position").drop("place", "position")
    ordered.coalesce(1).write.mode("overwrite").option("rootTag", "channel").option("rowTag", "item").format("xml").save(folder)


def category_listing(articles: DataFrame) -> DataFrame:
    """Articles in category order, then article order."""
    rank = F.row_number().over(Window.partitionBy("edition_id").orderBy(category_rank(), "category", "position"))
    return articles.withColumn("listing", rank)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The rows, counted while the job that writes them runs, so no second pass is needed."""
    seen = Observation(name)
    return df.observe(seen, *[value.alias(key) for key, value in metrics.items()]), seen


def run_summary(spark: SparkSession, *observations: Observation) -> DataFrame:
    """One row of everything that was observed while a run was written."""
    values = {key: value for seen in observations for key, value in seen.get.items()}
    return spark.range(1).select(*[F.lit(value).alias(key) for key, value in values.items()])
