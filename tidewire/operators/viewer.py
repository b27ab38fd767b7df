"""Read side: normalisation of published documents, search, filters, rankings and statistics over all editions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.urls import safe_external_url
from tidewire.operators.dedup import first_per_key

# fixed values: category ids in display order, their labels, and the aliases that map to them
CATEGORY_LABELS = {
    "domestic": "国内", "world": "海外", "technology": "テクノロジー", "economy": "経済", "science": "科学",
    "entertainment": "エンタメ", "sports": "スポーツ", "society": "社会", "other": "その他",
}
CATEGORY_ALIASES = {
    "国内": "domestic", "japan": "domestic", "national": "domestic", "海外": "world", "international": "world",
    "global": "world", "テクノロジー": "technology", "tech": "technology", "it": "technology", "エンタメ": "entertainment",
    "culture": "entertainment", "スポーツ": "sports", "sport": "sports", "経済": "economy", "business": "economy",
    "finance": "economy", "科学": "science", "社会": "society",
}
BRIEF_TYPES = ("brief", "short", "newsbrief", "news-brief", "bulletin", "速報", "短報")
FEATURE_TYPES = ("feature", "full", "analysis", "longform", "long-form", "詳報", "解説")

# fixed values: headings that hold a section, boilerplate sentences, update kinds
FACT_HEADINGS = "要点|確認できた事実|何が起きた|概要"
IMPACT_HEADINGS = "影響|対象地域|被害|注意点"
BACKGROUND_HEADINGS = "背景|経緯|これまで"
WATCH_HEADINGS = "注目|なぜ重要|今後"
GENERIC_WATCH = (
    r"各配信元.*(?:続報|訂正)",
    r"別の独立した配信元.*(?:確認|報道)",
    r"関係機関や当事者.*公式発表",
    r"一次情報として扱える発表.*(?:解釈|影響).*別の独立した報道.*確認",
    r"(?:現時点では)?単一の配信元.*(?:続報|照合|訂正)",
    r"^(?:今後の)?公式発表や続報.*(?:注目|確認)",
)
PROCEDURAL = (
    r"(?i:rss(?:の)?(?:見出し|フィード))",
    r"(?:見出し|配信概要|公開時刻).*(?:使用|参照|取得)",
    r"(?:情報源|出典).*(?:使用|参照|表示)",
    r"(?:記事|要約).*(?:作成|生成).*(?:使用|参照)?",
    r"(?:公開情報|提供情報|公開データ).*(?:もと|基に).*(?:要約|編集|加工)",
)
PROCEDURAL_DETAIL = r"は「.+」と報じました[。.]?$"
SOURCE_DIRECTION = (
    r"(?:詳しい|詳しくは|詳細|全文|続報|最新情報).{0,80}(?:出典|原典|リンク|配信元|公式サイト|元記事).{0,50}(?:確認|参照|ご覧)",
    r"(?:出典|原典|リンク|配信元|公式サイト|元記事).{0,60}(?:確認|参照|ご覧)(?:ください|できます)?",
)
HEADLINE_ATTRIBUTION = (
    r"^.{1,80}(?:は|が)「.+」と(?:報じ|伝え)ました[。.]?$",
    r"^.{1,100}(?:は|が)この動きを(?:報じ|伝え)ています[。.]?$",
    r"^.{1,100}の配信概要では、",
)
EMPTY_ATTRIBUTION = (
    r"^(?:一次情報を発信する|一次情報を提供する).{1,160}(?:更新|発表|配信)(?:です|となります)[。.]?$",
    r"^.{1,100}(?:は|が)この動きを(?:報じ|伝え)ています[。.]?$",
)
QUOTED_TITLE = r"^.{1,80}?(?:は|が)[「『](.+)[」』]と(?:報じ|伝え)ました[。.]?$"
FEED_PREFIX = r"^.{1,100}?の配信概要では[、,]\s*"
AUTOMATIC_KINDS = ("automatic", "auto", "system", "scheduled", "metadata")
MATERIAL_KINDS = ("material", "correction", "訂正", "追記")
ROUTINE_UPDATES = (
    r"^元情報の公開時刻$",
    r"^この要約の最終更新$",
    r"^(?:要約・出典情報|要約と出典情報|出典情報|要約)を更新$",
    r"^(?:この記事|記事データ|記事|要約)を(?:自動)?(?:作成|生成|公開)$",
    r"^(?:定期|自動)更新$",
    r"の公開情報を確認$",
)
STOPS = "。！？!?"
NO_TEXT = "array<string>"


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def category_id(c: Column) -> Column:
    """One of the nine ids, 'other' for anything unknown."""
    name = F.lower(F.trim(c))
    return F.coalesce(F.when(name.isin(*CATEGORY_LABELS), name), F.element_at(_map(CATEGORY_ALIASES), name), F.lit("other"))


def category_label(c: Column) -> Column:
    return F.coalesce(F.element_at(_map(CATEGORY_LABELS), c), F.lit(CATEGORY_LABELS["other"]))


# ---- sentence rules ---------------------------------------------------------------------------------

def sentence_items(c: Column) -> Column:
    found = F.regexp_extract_all(F.trim(c), F.lit(f"[^{STOPS}]+[{STOPS}]?"), F.lit(0))
    return F.filter(F.transform(found, text.trimmed), lambda s: s != "")


def generic_watch(key: Column) -> Column:
    return key.rlike(text.any_of(GENERIC_WATCH))


def procedural(key: Column) -> Column:
    return key.rlike(text.any_of(PROCEDURAL))


def brief_sentence(sentence: Column) -> Column:
    """The sentence says something, rather than where to read on or who reported."""
    key = F.lower(F.regexp_replace(sentence, text.SPACE, ""))
    return ~(sentence.rlike(text.any_of(SOURCE_DIRECTION + HEADLINE_ATTRIBUTION)) | procedural(key))


def brief_text(c: Column) -> Column:
    return F.array_join(F.filter(sentence_items(c), brief_sentence), "")


def editorial_text(c: Column, title_key: Column) -> Column:
    """Text without attribution-only sentences, quotes of the title, and feed prefixes."""

    def keep(s: Column) -> Column:
        quoted = F.lower(F.regexp_replace(F.regexp_extract(s, QUOTED_TITLE, 1), text.SPACE, ""))
        return ~s.rlike(text.any_of(EMPTY_ATTRIBUTION)) & ~(s.rlike(QUOTED_TITLE) & (quoted == title_key))

    kept = F.transform(F.filter(sentence_items(c), keep), lambda s: F.trim(F.regexp_replace(s, FEED_PREFIX, "")))
    return F.array_join(kept, "")


def distinct_paragraphs(items: Column) -> Column:
    """Non-empty paragraphs, first of each space-free lower-case form (bounded per article)."""
    keyed = F.transform(
        items, lambda p: F.struct(F.trim(p).alias("text"), F.lower(F.regexp_replace(p, text.SPACE, "")).alias("key"))
    )
    kept = F.filter(keyed, lambda x: x["text"] != "")
    return F.aggregate(
        kept,
        F.array().cast("array<struct<text:string,key:string>>"),
        lambda acc, x: F.when(F.exists(acc, lambda e: e["key"] == x["key"]), acc).otherwise(F.concat(acc, F.array(x))),
        lambda acc: F.transform(acc, lambda x: x["text"]),
    )


def editorial_paragraphs(items: Column, title_key: Column, drop_generic: bool = False) -> Column:
    cleaned = distinct_paragraphs(F.filter(F.transform(items, lambda p: editorial_text(p, title_key)), lambda p: p != ""))
    if not drop_generic:
        return cleaned
    return F.filter(cleaned, lambda p: ~generic_watch(F.lower(F.regexp_replace(p, text.SPACE, ""))))


def material_update(update: Column) -> Column:
    """An update readers should see: flagged, of a material kind, or not routine text."""
    kind = F.lower(F.trim(F.coalesce(update["kind"], F.lit(""))))
    routine = F.regexp_replace(update["text"], text.SPACE, "").rlike(text.any_of(ROUTINE_UPDATES))
    return (
        F.when(F.coalesce(update["text"], F.lit("")) == "", False)
        .when(update["material"].isNotNull(), update["material"])
        .when(kind.isin(*AUTOMATIC_KINDS), False)
        .when(kind.isin(*MATERIAL_KINDS), True)
        .otherwise(~routine)
    )


def distinct_content(sentences: DataFrame, out: str, paragraph: Column, references: Column) -> DataFrame:
    """Add `out`: the paragraph without sentences that repeat the references ('' when nothing new is left)."""
    df = text.comparison_text(sentences, "__whole", paragraph)
    df = df.withColumn("__refs", references)
    df = text.nfkc_items(df, "__refs", F.col("__refs"))
    bare = lambda v: F.regexp_replace(F.lower(v), text.NON_TITLE, "")
    df = df.withColumn("__refs", F.filter(F.transform("__refs", bare), lambda r: r != ""))
    df = df.withColumn("__parts", sentence_items(paragraph))
    df = text.nfkc_items(df, "__wide", F.transform("__parts", lambda s: F.regexp_replace(s, r"^.{1,100}?の配信概要では、", "")))
    df = df.withColumn("__own", F.concat(F.array("__whole"), F.transform("__wide", bare)))
    df = df.withColumn("__shares", text.known_shares(F.col("__own"), F.col("__refs")))

    def repeats(c: Column, share: Column) -> Column:
        inside = F.exists(F.col("__refs"), lambda r: F.contains(r, c))
        known = F.array_contains(F.col("__refs"), c) | F.when(F.length(c) < 12, inside).otherwise(share >= 0.68)
        return F.coalesce((c != "") & known, F.lit(False))

    # the whole paragraph first, then its sentences
    df = df.withColumn("__repeats", F.zip_with("__own", "__shares", repeats))
    df = df.withColumn("__overlap", F.get("__repeats", F.lit(0)))
    repeated = F.slice("__repeats", 2, F.size("__parts"))
    judged = F.zip_with("__parts", repeated, lambda s, old: F.struct(s.alias("text"), (~old & ~F.regexp_replace(s, text.SPACE, "").rlike(PROCEDURAL_DETAIL)).alias("new")))
    df = df.withColumn("__judged", judged)
    fresh = F.transform(F.filter("__judged", lambda s: s["new"]), lambda s: s["text"])
    whole = F.trim(paragraph)
    result = (
        F.when((whole == "") | F.col("__overlap"), F.lit(""))
        .when((F.size("__parts") <= 1) | (F.size(fresh) == F.size("__parts")), whole)
        .otherwise(F.array_join(fresh, ""))
    )
    return df.withColumn(out, result).drop("__whole", "__refs", "__own", "__shares", "__repeats", "__overlap", "__parts", "__wide", "__judged")


# ---- normalisation of stored documents ---------------------------------------------------------------

def _first(v: Column, *paths: str, kind: str = "string") -> Column:
    """First non-empty of alternative paths of a VARIANT."""
    values = [F.try_variant_get(v, f"$.{p}", kind) for p in paths]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in values]) if kind == "string" else F.coalesce(*values)


def _list(v: Column, *paths: str) -> Column:
    return F.coalesce(_first(v, *paths, kind="array<variant>"), F.array().cast("array<variant>"))


def _paragraphs(v: Column, *paths: str) -> Column:
    """A list of paragraphs, or one text split at blank lines."""
    listed = _first(v, *paths, kind="array<string>")
    split = F.filter(F.transform(F.split(_first(v, *paths), r"\n\s*\n"), text.trimmed), lambda p: p != "")
    return F.filter(F.coalesce(listed, split, F.array().cast(NO_TEXT)), lambda p: p != "")


def _flag(v: Column, *paths: str) -> Column:
    return F.coalesce(_first(v, *paths, kind="boolean"), F.lit(False))


def _link(v: Column) -> Column:
    plain = F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))
    return F.struct(
        F.coalesce(_first(v, "title", "headline", "name"), F.lit("原典を開く")).alias("title"),
        F.coalesce(plain, _first(v, "url", "link"), F.lit("#")).alias("url"),
        F.coalesce(_first(v, "publishedAt", "published_at", "date"), F.lit("")).alias("publishedAt"),
        _flag(v, "isContinuation", "continuation").alias("isContinuation"),
        F.coalesce(_first(v, "originEditionId", "originEdition"), F.lit("")).alias("originEditionId"),
    )


def _distinct_links(links: Column) -> Column:
    safe = F.filter(links, lambda x: safe_external_url(x["url"]).isNotNull())
    return F.aggregate(
        safe,
        F.array().cast("array<struct<title:string,url:string,publishedAt:string,isContinuation:boolean,originEditionId:string>>"),
        lambda acc, x: F.when(F.exists(acc, lambda e: e["url"] == x["url"]), acc).otherwise(F.concat(acc, F.array(x))),
    )


def _source(v: Column, i: Column) -> Column:
    plain = F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))
    nth = F.concat(F.lit("情報源 "), (i + 1).cast("string"))
    name = F.coalesce(_first(v, "name", "publisher", "title"), nth)
    url = F.coalesce(plain, _first(v, "url", "link"), F.lit("#"))
    links = _distinct_links(F.transform(_list(v, "links", "articles", "items"), _link))
    own = F.struct(
        F.coalesce(_first(v, "title", "name", "publisher"), nth).alias("title"),
        url.alias("url"),
        F.coalesce(_first(v, "publishedAt", "published_at", "date"), F.lit("")).alias("publishedAt"),
        _flag(v, "isContinuation", "continuation").alias("isContinuation"),
        F.coalesce(_first(v, "originEditionId", "originEdition"), F.lit("")).alias("originEditionId"),
    )
    return F.struct(
        name.alias("name"),
        F.coalesce(_first(v, "publisherId", "publisher_id"), F.lit("")).alias("publisherId"),
        url.alias("url"),
        F.coalesce(_first(v, "publishedAt", "published_at", "date"), F.lit("")).alias("publishedAt"),
        F.coalesce(_first(v, "type", "kind"), F.lit("")).alias("type"),
        _flag(v, "isPrimary", "primary").alias("isPrimary"),
        distinct_paragraphs(_paragraphs(v, "keyPoints", "points", "summary", "note")).alias("keyPoints"),
        F.when(F.size(links) > 0, links).when(url == "#", links).otherwise(F.array(own)).alias("links"),
    )


def _section(v: Column) -> Column:
    plain = F.when(F.schema_of_variant(v) == "STRING", F.array(v.cast("string")))
    return F.struct(
        F.coalesce(_first(v, "heading", "title"), F.lit("")).alias("heading"),
        F.coalesce(plain, _paragraphs(v, "paragraphs", "body", "content")).alias("paragraphs"),
    )


def _update(v: Column) -> Column:
    plain = F.when(F.schema_of_variant(v) == "STRING", v.cast("string"))
    return F.struct(
        F.coalesce(_first(v, "at", "updatedAt", "time", "date"), F.lit("")).alias("at"),
        F.coalesce(plain, _first(v, "text", "note", "summary", "change"), F.lit("")).alias("text"),
        F.coalesce(_first(v, "source", "by"), F.lit("")).alias("source"),
        F.coalesce(_first(v, "kind", "type"), F.lit("")).alias("kind"),
        _first(v, "material", "isMaterial", kind="boolean").alias("material"),
    )


def normalize_articles(df: DataFrame, article: str = "article") -> DataFrame:
    """Stored articles of any schema version (a VARIANT column) as typed columns; other columns pass through.

    Alternative field names are tried in order; text or list values are accepted where both occurred.
    """
    v = F.col(article)
    sections_in = F.filter(F.transform(_list(v, "sections"), _section), lambda s: (s["heading"] != "") | (F.size(s["paragraphs"]) > 0))
    df = df.withColumns(
        {
            "title": F.coalesce(_first(v, "title", "headline"), F.lit("無題の記事")),
            "published_at": _first(v, "publishedAt", "published_at", "date"),
            "sources": F.transform(_list(v, "sources", "sourceLinks", "references"), _source),
            "__sections": sections_in,
            "__body": _paragraphs(v, "body", "content"),
            "__facts": _paragraphs(v, "facts", "confirmedFacts", "keyFacts"),
            "__background": _paragraphs(v, "background", "context"),
            "__impact": _paragraphs(v, "impactPoints", "impact", "impacts", "affectedAreas", "consequences"),
            "__watch": F.concat(_paragraphs(v, "watchPoints", "whatToWatch", "outlook"), _paragraphs(v, "whyItMatters")),
            "updates": F.filter(F.transform(_list(v, "updates", "updateHistory", "revisions"), _update), lambda u: u["text"] != ""),
            "__summary": F.coalesce(_first(v, "summary", "description", "dek"), F.lit("")),
            "__dek": F.coalesce(_first(v, "dek", "subtitle", "lead"), F.lit("")),
        }
    )
    df = text.paragraph_key(df, "__title_key", F.col("title"))

    def under(headings: str) -> Column:
        return F.flatten(F.transform(F.filter("__sections", lambda s: s["heading"].rlike(headings)), lambda s: s["paragraphs"]))

    def own_or(name: str, headings: str) -> Column:
        return F.when(F.size(name) > 0, F.col(name)).otherwise(under(headings))

    facts = own_or("__facts", FACT_HEADINGS)
    fallback = F.filter(F.array(_first(v, "summary", "description")), lambda s: s.isNotNull())
    df = df.withColumn("__facts", F.when(F.size(facts) > 0, facts).otherwise(fallback))
    key = F.col("__title_key")
    df = df.withColumns(
        {
            "body": editorial_paragraphs(F.col("__body"), key, drop_generic=True),
            "sections": F.filter(
                F.transform(
                    "__sections",
                    lambda s: F.struct(s["heading"].alias("heading"), editorial_paragraphs(s["paragraphs"], key, drop_generic=True).alias("paragraphs")),
                ),
                lambda s: F.size(s["paragraphs"]) > 0,
            ),
            "facts": editorial_paragraphs(distinct_paragraphs(F.col("__facts")), key),
            "impact": editorial_paragraphs(distinct_paragraphs(own_or("__impact", IMPACT_HEADINGS)), key),
            "background": editorial_paragraphs(distinct_paragraphs(own_or("__background", BACKGROUND_HEADINGS)), key),
            "watch": editorial_paragraphs(distinct_paragraphs(F.concat("__watch", under(WATCH_HEADINGS))), key, drop_generic=True),
            "__dek": editorial_text(F.col("__dek"), key),
            "__summary": editorial_text(F.col("__summary"), key),
        }
    )
    overview = "|".join((FACT_HEADINGS, IMPACT_HEADINGS, BACKGROUND_HEADINGS, WATCH_HEADINGS))
    declared = F.lower(F.trim(F.coalesce(_first(v, "articleType", "storyType", "format", "presentation"), F.lit(""))))
    detailed = (
        (F.size("facts") >= 3)
        | (F.size("impact") > 0)
        | (F.size("background") > 0)
        | F.exists("sections", lambda s: ~s["heading"].rlike(overview))
        | (F.length(F.array_join("body", "")) >= 240)
    )
    df = df.withColumn(
        "article_type",
        F.when(declared.isin(*BRIEF_TYPES), F.lit("brief"))
        .when(declared.isin(*FEATURE_TYPES), F.lit("feature"))
        .otherwise(F.when(detailed, F.lit("feature")).otherwise(F.lit("brief"))),
    )
    brief = F.col("article_type") == "brief"
    df = df.withColumns(
        {
            "facts": F.when(brief, F.filter(F.transform("facts", brief_text), lambda f: f != "")).otherwise(F.col("facts")),
            "__dek": F.when(brief, brief_text(F.col("__dek"))).otherwise(F.col("__dek")),
            "__summary": F.when(brief, brief_text(F.col("__summary"))).otherwise(F.col("__summary")),
        }
    )
    first_fact = F.coalesce(F.get("facts", F.lit(0)), F.lit(""))
    urls = F.array_distinct(F.flatten(F.transform("sources", lambda s: F.transform(s["links"], lambda x: safe_external_url(x["url"])))))
    identifier = F.coalesce(_first(v, "id", "slug"), F.regexp_replace(F.lower("title"), r"(?U)[^\p{L}\p{N}]+", "-"))
    declared_count = lambda p: F.try_variant_get(v, f"$.{p}", "int")
    source_count = F.coalesce(F.when(declared_count("sourceCount") > 0, declared_count("sourceCount")), F.nullif(F.size(F.array_compact(urls)), F.lit(0)), F.size("sources"))
    continued = F.greatest(F.coalesce(declared_count("continuationSourceCount"), F.lit(0)), F.lit(0))
    df = df.withColumns(
        {
            "id": identifier,
            "slug": F.coalesce(_first(v, "slug"), identifier),
            "updated_at": F.coalesce(_first(v, "updatedAt", "updated_at"), F.col("published_at")),
            "dek": F.coalesce(F.nullif("__dek", F.lit("")), F.nullif("__summary", F.lit("")), first_fact),
            "summary": F.coalesce(F.nullif("__summary", F.lit("")), F.nullif("__dek", F.lit("")), first_fact),
            "category": category_id(F.coalesce(_first(v, "category", "section"), F.lit("other"))),
            "importance": F.least(F.greatest(F.coalesce(declared_count("importance"), declared_count("priority"), F.lit(3)), F.lit(1)), F.lit(5)),
            "source_count": source_count,
            "publisher_count": F.coalesce(F.when(declared_count("publisherCount") > 0, declared_count("publisherCount")), F.size("sources")),
            "continuation_source_count": continued,
            "tags": F.coalesce(F.try_variant_get(v, "$.tags", "array<string>"), F.array().cast(NO_TEXT)),
        }
    )
    df = df.withColumn(
        "fresh_source_count", F.greatest(F.coalesce(declared_count("freshSourceCount"), F.col("source_count") - F.col("continuation_source_count")), F.lit(0))
    )
    return df.drop(article, *[c for c in df.columns if c.startswith("__")])


# ---- search and rankings ------------------------------------------------------------------------------

SEARCHED = "title dek summary".split()
SEARCHED_LISTS = "facts impact background watch body tags".split()


def search(df: DataFrame, query: str, columns: Sequence[str] = SEARCHED, lists: Sequence[str] = (), haystack: Column | None = None) -> DataFrame:
    """Rows whose searchable text contains every term of the query (all compared in search form)."""
    if haystack is None:
        haystack = F.concat_ws(" ", *columns, *[F.array_join(c, " ") for c in lists])
    df = text.comparison_text(df, "__haystack", haystack)
    terms = [re.sub(text.NON_TITLE, "", text.wide(term).lower()) for term in query.split()]
    for term in filter(None, terms):
        df = df.filter(F.contains("__haystack", F.lit(term)))
    return df.drop("__haystack")


def article_haystack() -> Column:
    """Everything a reader can search in an article."""
    names = F.transform(
        "sources", lambda s: F.concat_ws(" ", s["name"], F.array_join(s["keyPoints"], " "), F.array_join(F.transform(s["links"], lambda x: x["title"]), " "))
    )
    return F.concat_ws(" ", *SEARCHED, category_label(F.col("category")), *[F.array_join(c, " ") for c in SEARCHED_LISTS], F.array_join(names, " "))


def of_category(df: DataFrame, category: str) -> DataFrame:
    if category == "all":
        return df
    return df.filter(F.col("importance") >= 4) if category == "important" else df.filter(F.col("category") == category)


def by_importance(*tie: str) -> list[Column]:
    return [F.desc("importance"), F.desc("updated_at"), *[F.col(t) for t in tie]]


def lookup(df: DataFrame, identifier: str) -> DataFrame:
    return df.filter((F.col("id") == identifier) | (F.col("slug") == identifier))


def is_feature() -> Column:
    return F.col("article_type") != "brief"


def bulletin_list(df: DataFrame, n: int = 8) -> DataFrame:
    """Newest articles of each edition without its lead feature."""
    lead = first_per_key(df.filter(is_feature()), ["edition_id"], by_importance("id")).select("edition_id", "id")
    rest = df.join(lead, ["edition_id", "id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("edition_id").orderBy(F.desc("updated_at"), "id"))
    return rest.withColumn("rank", rank).filter(F.col("rank") <= n)


def desk_order(df: DataFrame, n: int = 6) -> DataFrame:
    """Lead and up to five more per edition and category: features, importance, newest."""
    order = [is_feature().cast("int").desc(), *by_importance("id")]
    rank = F.row_number().over(Window.partitionBy("edition_id", "category").orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def newest_key(c: str) -> Column:
    """Ascending key for newest first, for sorting structs in arrays."""
    return -F.unix_micros(F.col(c).cast("timestamp"))


def related_articles(df: DataFrame, n: int = 3) -> DataFrame:
    """For each article the best other features of its edition: same category first, importance, newest.

    Only the n+1 best features of its own category and the n best of the others can be chosen. They are worked
    out once per edition and category, so an article meets at most 2n+1 rows however large its edition is.
    """
    features = df.filter(is_feature()).select("edition_id", "category", "id", "importance", "updated_at")
    order = by_importance("id")
    own = first_per_key(features, ["edition_id", "category"], order, n + 1).withColumn("other", F.lit(0))
    heads = first_per_key(features, ["edition_id", "category"], order, n)
    desks = df.select("edition_id", F.col("category").alias("desk")).distinct()
    others = desks.join(heads, "edition_id").filter(F.col("desk") != F.col("category"))
    others = first_per_key(others, ["edition_id", "desk"], order, n)
    others = others.drop("category").withColumnRenamed("desk", "category").withColumn("other", F.lit(1))
    entry = F.struct("other", (-F.col("importance")).alias("weight"), newest_key("updated_at").alias("age"), "id")
    pool = own.unionByName(others).groupBy("edition_id", "category").agg(F.array_sort(F.collect_list(entry)).alias("__pool"))
    chosen = F.slice(F.filter("__pool", lambda x: x["id"] != F.col("id")), 1, n)
    return (
        df.select("edition_id", "category", "id")
        .join(pool, ["edition_id", "category"])
        .select("edition_id", F.col("id"), F.posexplode(chosen).alias("rank", "__r"))
        .select("edition_id", "id", (F.col("rank") + 1).alias("rank"), F.col("__r.id").alias("related_id"))
    )


def recent_features(df: DataFrame, archive: DataFrame, visible: int = 3, look_back: int = 8, within_hours: int = 48) -> DataFrame:
    """Features of earlier editions that fill up editions with fewer than `visible` features of their own.

    Looks at the `look_back` newest earlier editions within `within_hours`; a title seen before is skipped. Per
    edition only the first few distinct titles of each earlier edition matter, so the join stays small.
    """
    features = text.paragraph_key(df.filter(is_feature()), "title_key", F.col("title"))
    own = features.groupBy("edition_id").agg(F.count("*").alias("own"), F.collect_set("title_key").alias("own_titles"))
    needy = archive.select("edition_id", "generated_at").join(own, "edition_id", "left")
    needy = needy.withColumn("own", F.coalesce("own", F.lit(0))).filter(F.col("own") < visible)
    timeline = archive.select(F.col("edition_id").alias("earlier_id"), F.col("generated_at").alias("earlier_at"))
    day = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / (within_hours * 3600))
    days = needy.withColumn("__day", F.explode(F.array(day("generated_at"), day("generated_at") - 1)))
    span = F.make_dt_interval(hours=F.lit(within_hours))
    near = days.join(timeline.withColumn("__day", day("earlier_at")), "__day").filter(
        (F.col("earlier_at") < F.col("generated_at")) & (F.col("generated_at") - F.col("earlier_at") <= span)
    )
    near = first_per_key(near, ["edition_id"], (F.desc("earlier_at"), F.desc("earlier_id")), look_back)
    # an earlier edition can lose at most visible-1 titles to the own features and visible-1 to other editions
    distinct = first_per_key(features, ["edition_id", "title_key"], by_importance("id"))
    offered = first_per_key(distinct, ["edition_id"], by_importance("id"), 2 * visible)
    offered = offered.select(
        F.col("edition_id").alias("earlier_id"), "id", "title", "title_key", "importance", "updated_at"
    )
    met = near.join(offered, "earlier_id").filter(~F.coalesce(F.array_contains("own_titles", F.col("title_key")), F.lit(False)))
    order = (F.desc("earlier_at"), F.desc("earlier_id"), *by_importance("id"))
    unique = first_per_key(met, ["edition_id", "title_key"], order)
    rank = F.row_number().over(Window.partitionBy("edition_id").orderBy(*order))
    kept = unique.withColumn("rank", rank).filter(F.col("rank") <= visible - F.col("own"))
    return kept.select("edition_id", "rank", F.col("earlier_id").alias("from_edition"), "id", "title", "importance", "updated_at")


def front_page(df: DataFrame, recent: DataFrame, n: int = 3) -> DataFrame:
    """Lead (rank 0) and the next `n` of each edition: own features, then recent features, then any article."""
    columns = ["edition_id", "from_edition", "id", "title", "importance", "updated_at", "shelf", "recent_rank"]
    own = df.withColumns(
        {"from_edition": F.col("edition_id"), "shelf": F.when(is_feature(), 0).otherwise(2), "recent_rank": F.lit(0)}
    )
    earlier = recent.withColumns({"shelf": F.lit(1), "recent_rank": F.col("rank")})
    both = own.select(*columns).unionByName(earlier.select(*columns))
    both = text.paragraph_key(both, "title_key", F.col("title"))
    within = F.coalesce("recent_rank", F.lit(0))
    order = [F.col("shelf"), within, F.desc("importance"), F.desc("updated_at"), F.col("id")]
    unique = first_per_key(both, ["edition_id", "title_key"], order)
    rank = F.row_number().over(Window.partitionBy("edition_id").orderBy(*order)) - 1
    return unique.withColumn("rank", rank).filter(F.col("rank") <= n).drop("shelf", "title_key", "recent_rank")


# ---- statistics ---------------------------------------------------------------------------------------

def source_rows(df: DataFrame) -> DataFrame:
    """One row per (edition, article, source) with the publisher key."""
    rows = df.select("edition_id", "id", "position", F.posexplode("sources").alias("source_no", "s"))
    folded = F.lower(F.regexp_replace("s.name", text.SPACE, ""))
    return rows.withColumn("publisher", F.coalesce(F.nullif("s.publisherId", F.lit("")), folded))


def publisher_network(df: DataFrame, n: int | None = 10) -> DataFrame:
    """Per edition the publishers by primary count, article count and name, with their first usable URL."""
    rows = source_rows(df).filter("publisher <> ''").withColumn(
        "url", F.get(F.filter(F.transform("s.links", lambda x: safe_external_url(x["url"])), lambda u: u.isNotNull()), F.lit(0))
    )
    at = F.struct("position", "source_no")
    out = rows.groupBy("edition_id", "publisher").agg(
        F.min_by("s.name", at).alias("name"),
        F.min_by("url", F.when(F.col("url").isNotNull(), at)).alias("url"),
        F.count("*").alias("articles"),
        F.count_if("s.isPrimary").alias("primary_articles"),
    )
    order = [F.desc("primary_articles"), F.desc("articles"), F.col("name"), F.col("publisher")]
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("edition_id").orderBy(*order)))
    return out if n is None else out.filter(F.col("rank") <= n)


def distinct_originals(df: DataFrame) -> DataFrame:
    """Per edition one row per original URL; a continuation anywhere makes it a continuation."""
    links = source_rows(df).select("edition_id", F.explode("s.links").alias("x"))
    usable = links.withColumn("url", safe_external_url(F.col("x.url"))).filter(F.col("url").isNotNull())
    return usable.groupBy("edition_id", "url").agg(
        F.bool_or("x.isContinuation").alias("is_continuation"), F.min("x.title").alias("title")
    )


def edition_overview(df: DataFrame) -> DataFrame:
    """Per edition: articles, features, briefs, publishers, categories, originals and continued originals."""
    articles = df.groupBy("edition_id").agg(
        F.count("*").alias("articles"),
        F.count_if(is_feature()).alias("features"),
        F.count_if(~is_feature()).alias("briefs"),
        F.count_distinct("category").alias("categories"),
    )
    publishers = source_rows(df).groupBy("edition_id").agg(F.count_distinct("publisher").alias("publishers"))
    originals = distinct_originals(df).groupBy("edition_id").agg(
        F.count("*").alias("originals"), F.count_if("is_continuation").alias("continued")
    )
    out = articles.join(publishers, "edition_id", "left").join(originals, "edition_id", "left")
    return out.fillna(0, ["publishers", "originals", "continued"])


def archive_list(archive: DataFrame, n: int = 12) -> DataFrame:
    return archive.filter((F.col("edition_id") != "") & F.col("generated_at").isNotNull()).orderBy(F.desc("generated_at"), F.desc("edition_id")).limit(n)
