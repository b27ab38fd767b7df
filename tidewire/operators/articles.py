"""Articles and editions: evidence aggregated by publisher into nested records, and the measures over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import slots, text
from tidewire.functions.profiles import ARTICLE_TYPES, CATEGORIES, JAPANESE, Profile

# fixed values: section headings, source types, separators stripped from a shared name
HEADINGS = (("facts", "確認できた事実"), ("impact", "影響・対象地域"), ("background", "背景"), ("watch", "次に注目"))
PRIMARY_TYPE, REPORT_TYPE = "一次情報", "報道"
NAME_SEPARATORS = r"[ \t　:：/／|｜・\-–—（(［\[【「『]+$"
SITE_DEFAULTS = {"name": "Digest", "tagline": "", "baseUrl": ""}


def evidence_of(drafts: DataFrame, evidence: DataFrame) -> DataFrame:
    """(edition, draft position, evidence row): the candidates each draft cites, in its order."""
    cited = drafts.select(
        "edition_id",
        "position",
        F.posexplode("candidate_ids").alias("n", "id"),
        "source_notes",
    )
    cited = cited.withColumn("note", F.element_at("source_notes", F.col("id"))).drop("source_notes")
    columns = (
        "edition_id id title description url source_name publisher_id published_at priority primary_source context_only "
        "origin_edition_id"
    ).split()
    return cited.join(evidence.select(*columns), ["edition_id", "id"])


def common_prefix(a: Column, b: Column) -> Column:
    ends = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.array_max(F.filter(ends, lambda n: F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n)))


def display_name(df: DataFrame, out: str, names: str, publisher: Column) -> DataFrame:
    """One label for the feeds of a publisher: shared words, else a shared start, else the id if it is not a slug,
    else the shortest label. `names` is an array of the distinct labels in order."""
    df = df.withColumn("__words", F.transform(names, lambda n: F.split(n, " ")))
    first = F.get("__words", F.lit(0))
    least_words = F.array_min(F.transform("__words", lambda w: F.size(w)))
    shared = F.array_max(
        F.filter(
            F.sequence(F.lit(0), least_words),
            lambda n: F.forall(
                F.col("__words"),
                lambda w: F.lower(F.array_join(F.slice(w, F.lit(1), n), " ")) == F.lower(F.array_join(F.slice(first, F.lit(1), n), " ")),
            ),
        )
    )
    df = df.withColumns({"__shared": shared, "__low": F.array_min(names), "__high": F.array_max(names)})
    start = F.substring("__low", F.lit(1), common_prefix(F.col("__low"), F.col("__high")))
    start = F.regexp_replace(start, NAME_SEPARATORS, "")
    shortest = F.array_min(F.transform(names, lambda n: F.struct(F.length(n).alias("n"), n.alias("name"))))["name"]
    slug = publisher.rlike(r"^[a-z0-9\-]*$")
    label = (
        F.when(F.size(names) == 0, publisher)
        .when(F.size(names) == 1, F.get(names, F.lit(0)))
        .when(F.col("__shared") > 0, F.array_join(F.slice(first, F.lit(1), F.col("__shared")), " "))
        .when(F.length(start) >= 2, start)
        .when((publisher != "") & ~slug, publisher)
        .otherwise(shortest)
    )
    return df.withColumn(out, label).drop("__words", "__shared", "__low", "__high")


def sources_by_publisher(cited: DataFrame, profile: Profile = JAPANESE, close_titles: bool = True) -> DataFrame:
    """One row per (edition, draft, publisher): the nested source record, ordered later by its earliest time.

    `close_titles` is the parameter `close` of `text.clip_title` for link titles.
    """
    df = text.clip_title(cited, "link_title", F.col("title"), 180, close_titles)
    df = text.complete_text(df, "note", F.col("note"), 240, profile)
    df = df.withColumn("publisher", text.squash(F.coalesce(F.nullif("publisher_id", F.lit("")), F.col("source_name")), 60))
    item = F.struct(
        F.col("published_at").alias("at"),
        F.col("n"),
        F.struct(
            F.col("link_title").alias("title"),
            "url",
            slots.iso_local(F.col("published_at")).alias("publishedAt"),
            F.col("context_only").alias("isContinuation"),
            F.col("origin_edition_id").alias("originEditionId"),
        ).alias("link"),
        "note",
        text.squash(F.col("source_name"), 80).alias("name"),
    )
    strength = F.struct("primary_source", "priority", F.col("description") != "", "published_at")
    grouped = df.groupBy("edition_id", "position", "publisher").agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        F.max_by("published_at", strength).alias("shown_at"),
        F.bool_or("primary_source").alias("is_primary"),
    )
    notes = F.filter(F.transform("items", lambda i: i["note"]), lambda v: v.isNotNull() & (v != ""))
    titles = F.transform("items", lambda i: i["link"]["title"])
    grouped = grouped.withColumns(
        {
            "__points": F.when(F.size(notes) > 0, notes).otherwise(titles),
            "__names": F.array_distinct(F.filter(F.transform("items", lambda i: i["name"]), lambda v: v != "")),
        }
    )
    grouped = text.nfkc_fold_items(grouped, "__folded", F.col("__points"))
    keyed = F.zip_with("__points", "__folded", lambda t, k: F.struct(t.alias("text"), k.alias("key")))
    grouped = text.distinct_by_key(grouped, "__points", keyed)
    grouped = display_name(grouped, "name", "__names", F.col("publisher"))
    first = F.get("items", F.lit(0))
    return grouped.select(
        "edition_id",
        "position",
        first["at"].alias("first_at"),
        first["n"].alias("first_n"),
        F.struct(
            "name",
            F.col("publisher").alias("publisherId"),
            F.transform("items", lambda i: i["link"]).alias("links"),
            slots.iso_local(F.col("shown_at")).alias("publishedAt"),
            F.transform(F.slice("__points", 1, 4), lambda x: x["text"]).alias("keyPoints"),
            F.when(F.col("is_primary"), F.lit(PRIMARY_TYPE)).otherwise(F.lit(REPORT_TYPE)).alias("type"),
            F.col("is_primary").alias("isPrimary"),
        ).alias("source"),
    )


def evidence_measures(cited: DataFrame, keys: Sequence[str] = ("edition_id", "position")) -> DataFrame:
    """Per article: earliest time, identity from its sorted URLs, distinct URLs, fresh and continued rows, origins, publishers."""
    publisher = text.squash(F.coalesce(F.nullif("publisher_id", F.lit("")), F.col("source_name")), 60)
    origin = F.when(F.col("context_only") & (F.col("origin_edition_id") != ""), F.col("origin_edition_id"))
    out = cited.groupBy(*keys).agg(
        F.min("published_at").alias("published_at"),
        F.array_sort(F.collect_set("url")).alias("urls"),
        F.count_if(~F.col("context_only")).cast("int").alias("fresh_source_count"),
        F.count_if("context_only").cast("int").alias("continuation_source_count"),
        F.array_sort(F.collect_set(origin)).alias("continuation_origins"),
        F.array_sort(F.collect_set(publisher)).alias("publisher_ids"),
        F.bool_or("primary_source").alias("has_primary"),
    )
    return out.withColumns(
        {
            "id": text.stable_hash(F.array_join("urls", "|"), 16),
            "source_count": F.size("urls"),
            "publisher_count": F.size("publisher_ids"),
        }
    )


def capped_importance(importance: Column, publishers: Column, has_primary: Column) -> Column:
    """A single secondary publisher cannot carry more than 3."""
    bounded = F.least(F.greatest(importance, F.lit(1)), F.lit(5))
    return F.when((bounded >= 4) & (publishers < 2) & ~has_primary, 3).otherwise(bounded).cast("int")


def promote_lead(df: DataFrame) -> DataFrame:
    """Where no article of an edition reaches 4, the first with two publishers becomes 4; sets `position` anew."""
    edition = Window.partitionBy("edition_id")
    order = edition.orderBy(F.desc("importance"), F.desc("published_at"), "position")
    eligible = (F.col("publisher_count") >= 2).cast("int")
    df = df.withColumns(
        {"__order": F.row_number().over(order), "__top": F.max("importance").over(edition)}
    ).withColumn("__first", F.min(F.when(eligible == 1, F.col("__order"))).over(edition))
    lifted = (F.col("__top") < 4) & F.col("__order").eqNullSafe(F.col("__first"))
    df = df.withColumn("importance", F.when(lifted, 4).otherwise(F.col("importance")).cast("int"))
    again = edition.orderBy(F.desc("importance"), F.desc("published_at"), "__order")
    return df.withColumn("position", (F.row_number().over(again) - 1).cast("int")).drop("__order", "__top", "__first")


def reading_body(paragraphs: Column) -> Column:
    """Paragraphs in order, without those contained in, or containing, an earlier one."""
    kept = F.filter(paragraphs, lambda p: p != "")
    return F.aggregate(
        kept,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(F.exists(acc, lambda e: F.contains(e, p) | F.contains(p, e)), acc).otherwise(F.concat(acc, F.array(p))),
    )


def sections(facts: Column, impact: Column, background: Column, watch: Column) -> Column:
    paragraphs = {"facts": facts, "impact": impact, "background": F.filter(F.array(background), lambda b: b != ""), "watch": watch}
    rows = [F.struct(F.lit(heading).alias("heading"), paragraphs[name].alias("paragraphs")) for name, heading in HEADINGS]
    return F.filter(F.array(*rows), lambda s: F.size(s["paragraphs"]) > 0)


def updates(sources: Column, generated: Column, site: str) -> Column:
    checked = F.transform(
        sources,
        lambda s: F.struct(
            s["publishedAt"].alias("at"), F.concat(s["name"], F.lit("の公開情報を確認")).alias("text"), s["name"].alias("source")
        ),
    )
    own = F.struct(generated.alias("at"), F.lit("要約・出典情報を更新").alias("text"), F.lit(site).alias("source"))
    return F.concat(checked, F.array(own))


def build_articles(drafts: DataFrame, evidence: DataFrame, generated_at: Column, profile: Profile = JAPANESE) -> DataFrame:
    """Published article records of all editions; drafts without evidence are dropped."""
    cited = evidence_of(drafts, evidence)
    nested = (
        sources_by_publisher(cited, profile)
        .groupBy("edition_id", "position")
        .agg(F.array_sort(F.collect_list(F.struct("first_at", "first_n", "source"))).alias("__s"))
        .withColumn("sources", F.transform("__s", lambda s: s["source"]))
        .drop("__s")
    )
    df = drafts.join(evidence_measures(cited), ["edition_id", "position"]).join(nested, ["edition_id", "position"])
    df = df.withColumn("importance", capped_importance(F.col("importance"), F.col("publisher_count"), F.col("has_primary")))
    df = text.clip_title(df, "title", F.col("title"), 120)
    df = text.complete_text(df, "dek", F.col("dek"), 180, profile)
    df = text.complete_text(df, "summary", F.col("summary"), 420, profile)
    df = df.withColumn("background", text.squash(F.col("background"), 500))
    generated = slots.iso_local(generated_at)
    df = df.withColumns(
        {
            "slug": F.concat_ws("-", "edition_id", F.substring("id", 1, 8)),
            "publishedAt": slots.iso_local(F.col("published_at")),
            "updated_at": generated_at,
            "updatedAt": generated,
            "article_type": F.when(F.col("article_type").isin(*ARTICLE_TYPES), F.col("article_type")).otherwise("brief"),
            "body": reading_body(F.concat(F.array("summary"), "impact", F.array("background"), "watch")),
            "sections": sections(F.col("facts"), F.col("impact"), F.col("background"), F.col("watch")),
            "updates": updates(F.col("sources"), generated, profile.site_name),
            "tags": F.slice("tags", 1, 3),
        }
    )
    return promote_lead(df).drop("candidate_ids", "publishers", "source_notes", "has_primary")


def counts_map(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Per key group a map value -> count, in value order; counted before it is collected."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    entry = F.struct(F.col(value).alias("key"), F.col("__n").alias("value"))
    return counted.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(out))


def edition_stats(articles: DataFrame, failures: Column | None = None) -> DataFrame:
    """Per edition: article, source and publisher counts and the count maps by category, publisher and type."""
    base = articles.groupBy("edition_id").agg(
        F.count("*").alias("article_count"),
        F.count_if(F.col("importance") >= 4).alias("important_count"),
    )
    urls = articles.select("edition_id", F.explode("urls").alias("url"))
    base = base.join(urls.groupBy("edition_id").agg(F.count_distinct("url").alias("source_count")), "edition_id", "left")
    names = articles.select("edition_id", F.explode("publisher_ids").alias("publisher"))
    base = base.join(names.groupBy("edition_id").agg(F.count_distinct("publisher").alias("publisher_count")), "edition_id", "left")
    by_publisher = counts_map(names, ["edition_id"], "publisher", "publisher_counts")
    out = base
    for maps in (
        counts_map(articles, ["edition_id"], "category", "category_counts"),
        by_publisher,
        counts_map(articles, ["edition_id"], "article_type", "article_type_counts"),
    ):
        out = out.join(maps, "edition_id", "left")
    return out.withColumn("feed_failure_count", F.lit(0) if failures is None else failures)


def edition_summary(articles: Column, important: Column, publishers: Column) -> Column:
    """Lead text of an edition from its counts."""
    phrase = F.when(publishers > 0, F.concat(publishers.cast("string"), F.lit("配信元の"))).otherwise("")
    return (
        F.when(articles == 0, F.lit("この時間帯には、公開条件を満たす新着記事がありませんでした。"))
        .when(
            important > 0,
            F.concat(F.lit("対象時間帯の"), phrase, F.lit("ニュースを"), articles.cast("string"), F.lit("本に整理しました。うち重要ニュースは"), important.cast("string"), F.lit("本です。")),
        )
        .otherwise(F.concat(F.lit("対象時間帯の"), phrase, F.lit("主なニュースを"), articles.cast("string"), F.lit("本に整理しました。")))
    )


def digest_lead(articles: Column, important: Column) -> Column:
    """Opening line of the digest listing."""
    n, m = articles.cast("string"), important.cast("string")
    return (
        F.when(articles == 0, F.lit("この時間帯には、公開条件を満たす新着記事がありませんでした。"))
        .when(important > 0, F.concat(n, F.lit("件を掲載。特に注目度の高いニュースは"), m, F.lit("件です。")))
        .otherwise(F.concat(F.lit("この時間帯の主なニュースを"), n, F.lit("件に整理しました。")))
    )


def public_mode(mode: Column) -> Column:
    cleaned = F.lower(text.squash(mode, 40))
    return F.when(cleaned.isin("", "fallback", "deterministic"), F.lit("structured")).otherwise(cleaned)


ARTICLE_FIELDS = {
    "id": "id", "slug": "slug", "publishedAt": "publishedAt", "updatedAt": "updatedAt", "title": "title", "dek": "dek",
    "summary": "summary", "whyItMatters": "why_it_matters", "articleType": "article_type", "deskLens": "desk_lens",
    "eventKeys": "event_keys", "facts": "facts", "impactPoints": "impact", "background": "background", "watchPoints": "watch",
    "body": "body", "sections": "sections", "updates": "updates", "category": "category", "importance": "importance",
    "sources": "sources", "sourceCount": "source_count", "freshSourceCount": "fresh_source_count",
    "continuationSourceCount": "continuation_source_count", "continuationOrigins": "continuation_origins",
    "publisherCount": "publisher_count", "tags": "tags",
}


def article_record() -> Column:
    """The published form of an article row."""
    return F.struct(*[F.col(column).alias(name) for name, column in ARTICLE_FIELDS.items()])


def editions(articles: DataFrame, windows: DataFrame, site: dict[str, str] | None = None, mode: str = "structured", failures: Column | None = None) -> DataFrame:
    """One nested edition document per window (`edition_id`, `window_start`, `window_end` on the wall clock).

    An edition holds at most 18 articles, so its collected array is small.
    """
    site = SITE_DEFAULTS | (site or {})
    listed = articles.groupBy("edition_id").agg(F.array_sort(F.collect_list(F.struct("position", article_record().alias("a")))).alias("__a"))
    failed = F.array().cast("array<string>") if failures is None else failures
    df = windows.join(listed, "edition_id", "left").join(edition_stats(articles), "edition_id", "left")
    records = F.coalesce(F.transform("__a", lambda x: x["a"]), F.array().cast(f"array<{_record_type(articles)}>"))
    n, m, p = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("article_count", "important_count", "publisher_count"))
    iso_wall = lambda c: slots.iso_local(slots.utc(F.col(c)))
    return df.select(
        "edition_id",
        F.lit(3).alias("schemaVersion"),
        F.struct(*[F.lit(v).alias(k) for k, v in site.items()]).alias("site"),
        F.get("__a", F.lit(0))["a"]["updatedAt"].alias("generatedAt"),
        edition_summary(n, m, p).alias("summary"),
        public_mode(F.lit(mode)).alias("generationMode"),
        F.struct(
            F.col("edition_id").alias("id"),
            F.date_format("window_end", "yyyy-MM-dd").alias("date"),
            F.date_format("window_end", "HH:mm").alias("slot"),
            slots.slot_label(F.col("window_end")).alias("label"),
        ).alias("edition"),
        F.struct(
            iso_wall("window_start").alias("start"),
            iso_wall("window_end").alias("end"),
            F.lit("Asia/Tokyo").alias("timezone"),
            slots.coverage_label(F.col("window_end")).alias("label"),
        ).alias("coverage"),
        F.struct(
            n.alias("articleCount"),
            F.col("category_counts").alias("categoryCounts"),
            F.coalesce(F.col("source_count"), F.lit(0)).alias("sourceCount"),
            p.alias("publisherCount"),
            F.col("publisher_counts").alias("publisherCounts"),
            F.col("article_type_counts").alias("articleTypeCounts"),
            F.size(failed).alias("feedFailureCount"),
        ).alias("stats"),
        failed.alias("feedFailures"),
        records.alias("articles"),
    )


def _record_type(articles: DataFrame) -> str:
    return articles.select(article_record().alias("a")).schema["a"].dataType.simpleString()


def category_rank() -> Column:
    """Fixed category order; unknown categories follow."""
    known = F.create_map(*[F.lit(x) for i, c in enumerate(CATEGORIES) for x in (c, i)])
    return F.coalesce(F.element_at(known, F.col("category")), F.lit(len(CATEGORIES)))


def digest_listing(articles: DataFrame) -> DataFrame:
    """One row per source link, in reading order: category order, article order, source and link order."""
    rows = articles.select(
        "edition_id", "category", category_rank().alias("category_rank"), "position", "title", "dek", "summary",
        F.posexplode("sources").alias("source_no", "source"),
    ).select("*", F.posexplode("source.links").alias("link_no", "link"))
    many = F.size("source.links") > 1
    label = F.when(many & (F.col("link.title") != ""), F.concat("source.name", F.lit("："), "link.title")).otherwise(F.col("source.name"))
    return rows.filter(F.col("link.url") != "").select(
        "edition_id", "category_rank", "category", "position", "title", "dek", "summary", "source_no", "link_no",
        label.alias("label"), F.col("link.url").alias("url"), F.col("link.publishedAt").alias("published"),
    )
