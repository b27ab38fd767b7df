"""De-duplication: by URL, against published history, and between fresh and context evidence.

Every "first of group" is a `row_number` filter: Spark plans a partial group limit before the shuffle, so a URL
or key that holds a large share of the rows leaves each task with at most one row of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.profiles import SEEN_HOURS, SEEN_SIMILARITY, STATE_DAYS, STATE_LIMIT
from tidewire.operators.similarity import similar_pairs


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First `n` rows of each key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def dedupe_urls(df: DataFrame, keys: Sequence[str] = ("url",), order: Sequence[Column] = ()) -> DataFrame:
    return first_per_key(df, keys, order or (F.col("ord"),))


def merge_evidence(fresh: DataFrame, context: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Fresh and context rows united, one per URL: fresh beats context, then the longer description, then order."""
    both = fresh.withColumn("__side", F.lit(0)).unionByName(
        context.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    order = (
        F.col("context_only").cast("int"),
        F.length("description").desc(),
        F.col("__side"),
        F.col("ord"),
    )
    return first_per_key(both, keys, order).drop("__side")


def unseen_urls(df: DataFrame, stories: DataFrame, url: str = "url", edition: str | None = None) -> DataFrame:
    """Rows whose URL no published story holds; with `edition`, no story of an earlier edition than the row's.

    Each URL is reduced to its first edition before the join, so a URL of many stories is one row.
    """
    seen = stories.select(F.explode("urls").alias("__seen"), (F.col(edition) if edition else F.lit("")).alias("__first"))
    seen = seen.groupBy("__seen").agg(F.min("__first").alias("__first"))
    known = F.col(url) == F.col("__seen")
    if edition:
        known &= F.col("__first") < F.col(edition)
    return df.join(seen, known, "left_anti")


def seen_titles(
    df: DataFrame,
    stories: DataFrame,
    threshold: float = SEEN_SIMILARITY,
    within_hours: int = SEEN_HOURS,
    edition: str | None = None,
    full: bool = True,
) -> DataFrame:
    """Distinct (normalised title, published_at, edition) of `df` that resemble a story published close in time.

    Every story counts; with `edition`, every one of an earlier edition, and so of an earlier time, than the row's. A story
    lies in one stretch of `within_hours`, and a row looks into its own, the one before and, without editions, the one after, so a
    pair meets once and neither side is broadcast. `full` is the parameter of `similar_pairs`.
    """
    def number(at: str) -> Column:
        return F.floor((F.datediff(at, F.lit("1970-01-01")) * 24 + F.hour(at)) / within_hours)

    at_edition = F.col(edition) if edition else F.lit("")
    titles = text.normalize_title(df.select("title", "published_at", at_edition.alias("__edition")), "title_norm", F.col("title"))
    titles = titles.filter((F.col("title_norm") != "") & F.col("published_at").isNotNull()).select("title_norm", "published_at", "__edition").distinct()
    titles = titles.withColumnsRenamed({"published_at": "item_at", "__edition": "item_edition"})
    around = F.sequence(number("item_at") - 1, number("item_at") + (0 if edition else 1))
    history = text.normalize_title(stories.select("title", "published_at", at_edition.alias("__edition")), "norm", F.col("title"))
    history = history.filter(F.col("norm") != "").groupBy("norm", F.col("published_at").alias("story_at"))
    history = history.agg(F.min("__edition").alias("story_edition")).withColumn("stretch", number("story_at"))
    gap = F.make_dt_interval(hours=F.lit(within_hours))
    close = (F.col("item_at") - F.col("story_at")).between(-gap, gap)
    if edition:
        close &= F.col("story_edition") < F.col("item_edition")
    pairs = similar_pairs(titles.withColumn("stretch", F.explode(around)), history, "title_norm", "norm", threshold, ("stretch",), close, full)
    return pairs.select("title_norm", F.col("item_at").alias("published_at"), F.col("item_edition").alias("__edition")).distinct()


def filter_seen(df: DataFrame, stories: DataFrame, edition: str | None = None, **title_rule) -> DataFrame:
    """Drop what was already published: exact URLs always, resembling titles unless the source is primary.

    `stories` is the history as it stands, or, with `edition` (a column of both sides), that of many editions at once,
    of which each row only knows the earlier ones.
    """
    fresh = unseen_urls(df, stories, edition=edition)
    judged = fresh.filter(~F.col("primary_source"))
    seen = seen_titles(judged, stories, edition=edition, **title_rule).withColumnsRenamed({"published_at": "__at", "__edition": "__of"})
    judged = text.normalize_title(judged, "__norm", F.col("title"))
    same = (F.col("__norm") == F.col("title_norm")) & (F.col("published_at") == F.col("__at"))
    if edition:
        same &= F.col(edition) == F.col("__of")
    return fresh.filter("primary_source").unionByName(judged.join(seen, same, "left_anti").drop("__norm"))


def remember(articles: DataFrame, edition_id: Column, last_seq: Column) -> DataFrame:
    """Stories to append to the history: one per article that has at least one URL.

    `articles` carries sources: array<struct<url?, links: array<struct<url>>>>, `title`, `published_at`, `position`.
    """
    links = F.flatten(
        F.transform("sources", lambda s: F.transform(F.coalesce(s["links"], F.array()), lambda x: x["url"]))
    )
    urls = F.array_sort(F.array_distinct(F.filter(links, lambda u: u.isNotNull() & (u != ""))))
    stories = text.normalize_title(articles.withColumn("urls", urls), "title_norm", F.col("title"))
    return stories.filter(F.size("urls") > 0).select(
        (last_seq + F.col("position")).alias("seq"),
        edition_id.alias("edition_id"),
        F.col("title_norm").alias("title"),
        "published_at",
        "urls",
    )


def prune_stories(stories: DataFrame, now: Column, days: int = STATE_DAYS, limit: int = STATE_LIMIT) -> DataFrame:
    """Stories inside the retention, newest `limit` by append order; rows without a time are dropped."""
    kept = stories.filter(F.col("published_at") >= now - F.make_dt_interval(days=F.lit(days)))
    return kept.orderBy(F.col("seq").desc()).limit(limit)


def forget_edition(stories: DataFrame, edition_id: Column) -> DataFrame:
    """History without the stories of an edition that is being regenerated."""
    return stories.filter(~F.col("edition_id").eqNullSafe(edition_id))


def distinct_articles(df: DataFrame, keys: Sequence[str] = ("edition_id",)) -> DataFrame:
    """First article of an id, or of a folded title where there is no id, in edition order."""
    folded = F.lower(F.regexp_replace("title", text.SPACE, ""))
    keyed = df.withColumn("__key", F.coalesce(F.nullif(F.col("id"), F.lit("")), folded))
    return first_per_key(keyed, (*keys, "__key"), (F.col("position"),)).drop("__key")
