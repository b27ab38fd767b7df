"""Domain tables derived from the given tables for the registered queries. All of them grow with their input."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions import slots, text
from tidewire.functions.profiles import CATEGORIES, LATIN, Profile
from tidewire.operators import articles as art
from tidewire.operators import dedup, sinks
from tidewire.sources import tables
from tidewire.sources.registry import FEED_FIELDS

FIXTURE_INJECTION = r"(?i:\b(?:with|avec|mit|con)\b.{0,60}\b(?:the|le|der|la)\b)"
ARTICLE_SPAN = 6


def with_injection(profile: Profile, pattern: str) -> Profile:
    return replace(profile, injections=(*profile.injections, pattern))


def titled_items(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates whose URL depends on the title, so that copies meet."""
    items = tables.with_edition(tables.candidates(spark, sf))
    return items.withColumn("url", F.concat(F.lit("https://news.example.org/"), F.md5("title")))


def already_published() -> Column:
    """Documents at even positions of a day count as published, the others as new."""
    return F.col("ord") % 2 == 0


def published_stories(items: DataFrame) -> DataFrame:
    """History of the published half, one story per document, in document order."""
    published = items.filter(already_published()).withColumns(
        {
            "position": F.col("ord"),
            "sources": F.array(F.struct(F.array(F.struct(F.col("url").alias("url"))).alias("links"))),
        }
    )
    return dedup.remember(published, F.col("edition_id"), F.lit(0))


def bulletin_documents(rows: DataFrame) -> DataFrame:
    """Each event as an official bulletin document."""
    def tag(name: str, value) -> Column:
        return F.concat(F.lit(f"<{name}>"), F.col(value) if isinstance(value, str) else value, F.lit(f"</{name}>"))

    region = F.concat(F.lit("region "), (F.col("ord") % 47).cast("string"))
    head = tag("Head", F.concat(tag("Title", F.concat(F.lit("震度 "), "product_title")), tag("EventID", "event_key"), tag("Serial", "serial"),
        tag("Headline", tag("Text", F.concat(F.lit("報 "), F.col("ord").cast("string"))))))
    item = tag("Item", F.concat(tag("Kind", tag("Name", F.lit("警報"))), tag("Areas", tag("Area", tag("Name", region)))))
    quake = tag("Earthquake", F.concat(tag("OriginTime", slots.iso_local(F.date_trunc("second", "published_at").cast("timestamp_ntz"))),
        tag("Hypocenter", tag("Area", tag("Name", region)))))
    body = tag("Body", F.concat(quake, tag("Intensity", tag("MaxInt", "max_intensity")), item))
    xml = F.concat(F.lit('<Report xmlns="urn:bulletin">'), tag("Control", tag("Title", F.lit("control"))), head, body, F.lit("</Report>"))
    return rows.withColumn("xml", xml)


def feed_registry(spark: SparkSession, sf: str) -> DataFrame:
    """One feed per source; the source number decides its rules, and some break one."""
    sources = tables.table(spark, sf, "documents").select("source").distinct()
    n = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    nothing = F.lit(None)
    values = {
        "id": F.col("source"),
        "publisher": F.concat(F.lit("house"), (n % 7).cast("string")),
        "name": F.concat(F.lit("Feed "), "source"),
        "url": F.concat(F.lit("https://"), "source", F.lit(".example.org/feed")),
        "category": F.when(n % 11 == 10, F.lit("unknown")).otherwise(F.get(F.array(*[F.lit(c) for c in CATEGORIES]), n % 9)),
        "priority": n % 8,
        "primarySource": n % 5 == 0,
        "inferCategory": n % 2 == 0,
        "metadataOnly": n % 6 == 5,
        "forceHttps": n % 3 == 0,
        "maxFeedBytes": F.when(n % 10 == 9, 9_000_000).when(n % 4 == 3, 20_000),
        "includeTitlePatterns": F.when(n % 3 == 1, F.array(F.lit(r"\bthe\b"), F.lit("^[aeiou]"))),
        "excludeTitlePatterns": F.when(n % 4 == 2, F.array(F.lit(r"\bmit\b"))).when(n % 13 == 12, F.array(F.lit("("))),
    }
    columns = []
    for spec in FEED_FIELDS.split(", "):
        name, kind = spec.strip().split(" ", 1)
        columns.append(values.get(name, nothing).cast(kind).alias(name))
    return sources.select(*columns)


def xml_text(c: Column) -> Column:
    escaped = F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.replace(escaped, F.lit(">"), F.lit("&gt;"))


def tagged_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The feeds without byte limits and with rules on tags, product titles and bracket titles."""
    n = F.regexp_extract("id", r"(\d+)$", 1).cast("int")
    return feed_registry(spark, sf).withColumns(
        {
            "maxFeedBytes": F.lit(None).cast("int"),
            "includeEntryCategories": F.when(n % 5 == 1, F.array(F.lit("it・デジタル"), F.lit("Local"))),
            "excludeEntryCategories": F.when(n % 5 == 2, F.array(F.lit("ＭＩＳＣ"))),
            "titleFromDescriptionBrackets": n % 2 == 1,
            "includeProductTitlePatterns": F.when(n % 7 == 3, F.array(F.lit(r"\bthe\b"))),
        }
    )


def tagged_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """The payloads with subjects by document number; every sixth description opens with a numbered title in brackets."""
    n = F.col("ord")

    def subjects(*names: str) -> Column:
        return F.lit("".join(f"<category>{x}</category>" for x in names))

    tags = F.when(n % 4 == 0, subjects("スポーツ")).when(n % 4 == 1, subjects("misc, サイエンス", "ＩＴ・デジタル")).when(n % 4 == 3, subjects("  税、観光 ", "local"))
    bracket = F.when(n % 6 == 1, F.concat(F.lit("【No. "), n.cast("string"), F.lit(" "), "title", F.lit("】"))).otherwise("")
    return feed_payloads(spark, sf, F.concat(bracket, "description"), F.coalesce(tags, F.lit("")))


def page_documents(rows: DataFrame) -> DataFrame:
    """Items as official pages, a paragraph for each line of the text; every fifth page is missing."""
    lines = F.transform(F.split("description", "\n"), lambda line: F.concat(F.lit("<p>"), xml_text(line), F.lit("</p>")))
    opening = F.concat(F.lit("<html><body><nav><p>menu</p></nav><main><h1>"), xml_text(F.col("title")), F.lit("</h1>"))
    html = F.concat(opening, F.array_join(lines, "<br>"), F.lit("</main><footer><p>imprint</p></footer></body></html>"))
    return rows.filter(F.col("ord") % 5 != 4).select("url", "title", html.alias("html"))


def feed_payloads(spark: SparkSession, sf: str, description: Column | None = None, tags: Column | None = None) -> DataFrame:
    """Every document as one landed RSS payload of its source; a few are not allowed or not readable."""
    items = tables.candidates(spark, sf)
    n = F.col("ord")
    description = F.col("description") if description is None else description
    link = F.concat(F.when(n % 2 == 0, F.lit("http://")).otherwise(F.lit("https://")), "source_name", F.lit(".example.org//doc/"), n.cast("string"), F.lit("/?utm_source=feed&id="), n.cast("string"))
    body = F.concat(
        F.lit("<rss><channel><title>feed</title><item><title>"),
        xml_text(F.col("title")),
        F.lit("</title><link>"),
        xml_text(link),
        F.lit("</link><pubDate>"),
        F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" GMT</pubDate><description>"),
        xml_text(description),
        F.lit("</description>"),
        F.lit("") if tags is None else tags,
        F.lit("</item></channel></rss>"),
    )
    body = F.when(n % 97 == 96, F.concat(F.lit("<!DOCTYPE rss>"), body)).otherwise(body)
    return items.select(F.col("source_name").alias("feed_id"), F.encode(body, "UTF-8").alias("body"))


def quake_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a short note; the event number decides how much it states."""
    rows = tables.table(spark, sf, "events").withColumn("published_at", F.col("ts").cast("timestamp_ntz"))
    n = F.col("event_id")
    day = F.concat((n % 31 + 1).cast("string"), F.lit("日"))
    size = F.concat(F.lit("マグニチュード"), (n % 8).cast("string"), F.lit("."), (n % 10).cast("string"))
    month = F.concat((n % 12 + 1).cast("string"), F.lit("月"))
    place = F.concat(F.lit("震央・震源地域: 地点"), (n % 47).cast("string"), F.lit("。"))
    origin = F.concat(F.lit("発生時刻: "), slots.iso_local(F.date_trunc("second", "published_at").cast("timestamp_ntz")), F.lit("。"))
    note = (
        F.when(n % 5 == 0, F.concat(F.lit("インドネシアで"), month, day, F.lit("に地震。"), size))
        .when(n % 5 == 1, F.concat(F.lit("フローレスの地震は"), day, F.lit("に発生。"), size))
        .when(n % 5 == 2, F.concat(origin, place))
        .when(n % 5 == 3, F.lit("Ｃｌａｕｄｅの透かし"))
        .otherwise(F.col("event_type"))
    )
    return rows.select("event_id", "published_at", F.col("event_type").alias("title"), note.alias("description"))


def cited_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence of articles of six consecutive documents; every fourth document is a continuation."""
    rows = tables.candidates(spark, sf)
    article = F.floor(F.col("ord") / ARTICLE_SPAN)
    first_at = tables.after_epoch(article * ARTICLE_SPAN * 300)
    return rows.withColumns(
        {
            "position": article.cast("long"),
            "edition_id": slots.edition_of(first_at),
            "n": (F.col("ord") % ARTICLE_SPAN).cast("int"),
            "context_only": F.col("ord") % 4 == 3,
            "origin_edition_id": F.when(F.col("ord") % 4 == 3, slots.edition_of(F.col("published_at"))).otherwise(""),
            "note": F.lit(""),
        }
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Published articles of six documents each, with typed columns and nested sources by publisher."""
    cited = cited_rows(spark, sf)
    link = F.struct(
        F.col("published_at").alias("at"),
        F.struct("title", "url", slots.iso_local(F.col("published_at")).alias("publishedAt"), F.col("context_only").alias("isContinuation"), F.col("origin_edition_id").alias("originEditionId")).alias("link"),
    )
    sources = cited.groupBy("position", "publisher_id").agg(
        F.min("published_at").alias("first_at"),
        F.array_sort(F.collect_list(link)).alias("l"),
        F.bool_or("primary_source").alias("isPrimary"),
    )
    source = F.struct(
        F.col("publisher_id").alias("name"), F.col("publisher_id").alias("publisherId"), F.transform("l", lambda x: x["link"]).alias("links"),
        F.array().cast("array<string>").alias("keyPoints"), "isPrimary",
    )
    nested = sources.groupBy("position").agg(F.array_sort(F.collect_list(F.struct("first_at", source.alias("s")))).alias("l"))
    nested = nested.select("position", F.transform("l", lambda x: x["s"]).alias("sources"))
    measures = art.evidence_measures(cited, ("edition_id", "position"))
    heads = cited.filter("n = 0").select(
        "position", "title", "category", "description",
        F.col("priority").alias("importance"),
    )
    newest = cited.groupBy("position").agg(F.max("published_at").alias("updated_at"))
    none = F.array().cast("array<string>")
    df = measures.join(nested, "position").join(heads, "position").join(newest, "position")
    return df.withColumns(
        {
            "article_type": F.when(F.col("position") % 3 == 0, F.lit("feature")).otherwise(F.lit("brief")),
            "slug": F.concat_ws("-", "edition_id", F.substring("id", 1, 8)),
            "dek": F.when(F.col("position") % 2 == 0, F.concat(F.lit("1月1日 10:50更新。"), "title")).otherwise(F.col("title")),
            "summary": F.col("description"),
            "desk_lens": F.when(F.col("position") % 3 == 0, F.lit("event")).otherwise(""),
            "event_keys": F.array(F.concat(F.lit("event "), (F.col("position") % 4).cast("string"))),
            "facts": text.pieces(text.squash(F.col("description")), LATIN), "impact": none, "background": F.lit(""), "watch": none,
            "body": F.array("description"),
            "tags": F.array("category"),
        }
    )


def edition_windows(articles: DataFrame) -> DataFrame:
    """The window of every edition that has articles."""
    ends = articles.select(slots.slot_end(F.col("published_at")).alias("window_end")).distinct()
    return ends.select("window_end", slots.slot_start(F.col("window_end")).alias("window_start"), slots.edition_id(F.col("window_end")).alias("edition_id"))


def archive(articles: DataFrame) -> DataFrame:
    """Index rows of the editions, `place` 0 for the newest; the number of editions grows with time, not with rows."""
    rows = sinks.archive_rows(articles, edition_windows(articles), F.lit(dt.datetime(2024, 3, 1)).cast("timestamp_ntz"))
    place = F.row_number().over(Window.orderBy(F.desc("edition_id"))) - 1
    return rows.withColumns({"place": place, "is_sample": F.lit(False)})


def edition_times(articles: DataFrame) -> DataFrame:
    """(edition_id, generated_at): the wall-clock end of each edition as its generation time."""
    return edition_windows(articles).select("edition_id", F.col("window_end").alias("generated_at"))


def stored_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as stored articles of three schema generations, one JSON text each."""
    rows = tables.candidates(spark, sf)
    n = F.col("ord")
    link = F.struct(F.col("title").alias("title"), "url")
    newest = F.to_json(
        F.struct(
            "id", "title", F.col("description").alias("summary"), F.lit("経済").alias("category"), F.col("priority").alias("importance"),
            F.lit("feature").alias("articleType"), F.lit(2).alias("sourceCount"),
            F.array(F.struct(F.col("source_name").alias("name"), F.col("publisher_id").alias("publisherId"), F.array(link, link).alias("links"), F.col("primary_source").alias("isPrimary"))).alias("sources"),
        )
    )
    older = F.to_json(
        F.struct(
            "id", F.col("title").alias("headline"), F.col("description").alias("description"), F.lit(" Business ").alias("section"), (F.col("priority") + 3).alias("priority"),
            F.lit("SHORT").alias("storyType"), F.array("url", F.lit("ftp://nowhere/"), "url").alias("references"),
        )
    )
    oldest = F.to_json(F.struct("id", "title", F.array(F.col("title"), F.col("title")).alias("keyFacts"), F.lit("mystery").alias("category"), F.col("url").alias("unused")))
    return rows.select("ord", F.when(n % 3 == 0, newest).when(n % 3 == 1, older).otherwise(oldest).alias("json"))


def written_editions(spark: SparkSession, sf: str, folder: str) -> None:
    """Every document as a stored edition document of one article in one of three schema generations; every 50th line is cut off, every 51st holds no article."""
    rows = stored_articles(spark, sf).withColumn("published_at", tables.after_epoch(F.col("ord") * 300))
    edition = slots.edition_of(F.col("published_at"))
    whole = F.concat(F.lit('{"edition": {"id": "'), edition, F.lit('"}, "articles": ['), "json", F.lit("]}"))
    n = F.col("ord")
    line = F.when(n % 50 == 7, F.substring(whole, 1, 60)).when(n % 51 == 11, F.lit('{"note": "empty"}')).otherwise(whole)
    rows.select(edition.alias("edition_id"), line.alias("value")).write.mode("overwrite").partitionBy("edition_id").text(folder)


def stored_editions(spark: SparkSession, sf: str) -> DataFrame:
    """Each article as a stored edition document of its own; the article number decides its declared source count."""
    found = articles(spark, sf)
    source = F.transform(
        "sources",
        lambda s: F.struct(
            s["name"].alias("name"), s["publisherId"].alias("publisherId"), F.lit(None).cast("string").alias("url"), s["links"].alias("links"),
            F.lit(None).cast("string").alias("publishedAt"), F.array(F.col("title"), F.concat(F.lit("point "), s["name"])).alias("keyPoints"),
            F.lit("").alias("type"), s["isPrimary"].alias("isPrimary"),
        ),
    )
    nothing = F.lit(None).cast("array<string>")
    article = F.struct(
        "title", "category", "importance", (F.col("position") % 4).cast("int").alias("sourceCount"), nothing.alias("facts"), nothing.alias("impactPoints"),
        nothing.alias("watchPoints"), F.lit("").alias("background"), slots.iso_local(F.col("published_at")).alias("publishedAt"), source.alias("sources"),
    )
    return found.select(F.struct(F.col("edition_id").alias("id")).alias("edition"), F.array(article).alias("articles"))


def proposals(rows: DataFrame) -> DataFrame:
    """One external draft per document about itself and its successor."""
    n = F.col("ord")
    ids = F.array(F.concat(F.lit("d"), n), F.concat(F.lit("d"), n + 1), F.lit("unknown"))
    sentences = text.pieces(text.squash(F.col("description")), LATIN)
    return rows.select(
        "edition_id", n.alias("draft_no"), ids.alias("candidate_ids"), "title", F.lit("").alias("dek"), F.col("description").alias("summary"), F.lit("").alias("why"),
        F.when(n % 2 == 0, F.col("category")).otherwise("none").alias("category"), F.lit("feature").alias("article_type"), (n % 9).cast("int").alias("importance"),
        F.array("category", "category").alias("tags"), sentences.alias("facts"), F.array().cast("array<string>").alias("impact"),
        F.lit("").alias("background"), F.array().cast("array<string>").alias("watch"),
        F.create_map(F.concat(F.lit("d"), n), F.lit("note"), F.lit("stranger"), F.lit("dropped")).alias("source_notes"),
    )
