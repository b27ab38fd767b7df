"""Quality gates as violation tables: an edition may be published when it has no row here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.profiles import (
    ARTICLE_TYPES,
    BACKGROUND_CHARS,
    CATEGORIES,
    FEATURE_MIN_CHARS,
    FEATURE_MIN_POINTS,
    FEATURE_SUMMARY_CHARS,
    JAPANESE,
    SECTION_CAPS,
    Profile,
    forbidden_copy,
)
from tidewire.operators.drafts import exclusive_sections, key_chars

# fixed values: time scope a feature's opening must state, endings of an incomplete title, official copy fields
TIME_SCOPE = r"\d{1,2}月\d{1,2}日(?:\s+\d{2}:\d{2}|\d{1,2}時\d{2}分)"
OPEN_TITLE = r"(?:\.\.\.|[/／｜|：:、,（(【「『\-])$"
OFFICIAL_COPY = (
    r"発生時刻(?:は|\s*[:：])",
    r"震源は|震央・震源地域\s*[:：]",
    r"(?:地震の規模は)?マグニチュード",
    r"最大震度(?:は|\s*[:：])",
    r"津波.*(?:心配|影響).*(?:ありません|ない)",
)
#: Columns of described candidates that the validation of proposals reads.
JUDGED = "edition_id id category publisher classified field_count primary_source".split()


def source_mix_violations(articles: DataFrame, edition_ids: DataFrame) -> DataFrame:
    """(edition_id, violation): editions without sourced articles, or with one publisher and no primary source."""
    sources = articles.select("edition_id", F.explode("sources").alias("s"))
    named = F.nullif(F.trim(F.coalesce(F.nullif("s.publisherId", F.lit("")), F.col("s.name"))), F.lit(""))
    per_edition = sources.groupBy("edition_id").agg(
        F.count_distinct(named).alias("publishers"), F.bool_or("s.isPrimary").alias("primary")
    )
    judged = edition_ids.select("edition_id").distinct().join(per_edition, "edition_id", "left")
    violation = F.when(F.coalesce("publishers", F.lit(0)) == 0, F.lit("no sourced articles")).when(
        (F.col("publishers") == 1) & ~F.col("primary"), F.lit("single secondary publisher")
    )
    return judged.select("edition_id", violation.alias("violation")).filter(F.col("violation").isNotNull())


def complete_copy(values: Column, profile: Profile) -> Column:
    forbidden = "(?U)" + forbidden_copy(profile.site_name)
    return F.forall(values, lambda v: (v == "") | (text.balanced(v) & ~text.truncated(v, profile) & ~v.rlike(forbidden)))


def feature_rules(articles: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """Features with `violations`: the names of the rules each one breaks."""
    df = articles.filter(F.col("article_type") == "feature")
    df = text.clean_text(df, "__title", F.col("title"), 500)
    backgrounds = F.filter(F.array("background"), lambda b: F.trim(b) != "")
    df = df.withColumn("__grounded", F.concat("facts", "impact", backgrounds, "watch"))
    joined = F.array_join("__grounded", " ")
    stops = F.greatest(F.lit(1), F.regexp_count("background", F.lit("[。！？!?]")))
    points = F.size("facts") + F.size("impact") + F.size("watch") + F.when(F.size(backgrounds) > 0, stops).otherwise(0)
    primary = F.exists("sources", lambda s: s["isPrimary"])
    least = F.when(primary, 1).otherwise(2)
    official = F.exists("sources", lambda s: s["isPrimary"] & (F.lower(s["publisherId"]) == profile.bulletin_publisher)) & (
        sum((joined.rlike("(?U)" + p).cast("int") for p in OFFICIAL_COPY), F.lit(0)) >= 3
    )
    links = F.array_distinct(F.flatten(F.transform("sources", lambda s: F.transform(s["links"], lambda x: x["url"]))))
    keys = F.array_distinct(F.filter("event_keys", lambda k: F.trim(k) != ""))
    title = F.col("__title")
    rules = {
        "lens": F.col("desk_lens") == "event",
        "sources": F.col("source_count") >= least,
        "fresh": F.col("fresh_source_count") >= 1,
        "publishers": primary | (F.col("publisher_count") >= 2),
        "category": F.exists("tags", lambda t: t.isin(*CATEGORIES)),
        "event": F.size(keys) == 1,
        "points": points >= FEATURE_MIN_POINTS,
        "material": (F.length(F.regexp_replace(joined, text.SPACE, "")) >= FEATURE_MIN_CHARS) | official,
        "summary": F.length(F.regexp_replace("summary", text.SPACE, "")) >= FEATURE_SUMMARY_CHARS,
        "time scope": F.col("dek").rlike("(?U)" + TIME_SCOPE),
        "links": F.size(F.filter(links, lambda u: u != "")) >= least,
        "title": F.length(title).between(8, 120) & ~title.rlike(OPEN_TITLE) & text.balanced(title) & ~text.truncated(title, profile),
        "copy": complete_copy(F.concat(F.array("title", "dek", "summary"), "__grounded"), profile),
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("violations", broken).drop("__title", "__grounded")


def shared_event_keys(features: DataFrame) -> DataFrame:
    """(edition_id, key): events that more than one feature of an edition claims."""
    keys = features.select("edition_id", "position", F.explode(F.array_distinct("event_keys")).alias("key"))
    return keys.filter("key <> ''").groupBy("edition_id", "key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")


def feature_violations(articles: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """(edition_id, violation): unqualified features, repeated feature titles, events claimed twice."""
    features = feature_rules(articles, profile)
    unqualified = features.filter(F.size("violations") > 0).select(
        "edition_id", F.concat(F.lit("unqualified feature: "), F.array_join("violations", ", ")).alias("violation")
    )
    repeated = features.groupBy("edition_id", "title").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = repeated.select("edition_id", F.lit("repeated feature title").alias("violation"))
    shared = shared_event_keys(features).select("edition_id", F.lit("event in two features").alias("violation"))
    return unqualified.union(repeated).union(shared).distinct()


def infer_article_type(members: DataFrame, keys: tuple[str, ...], profile: Profile = JAPANESE) -> DataFrame:
    """Per draft: feature when one primary source, or two publishers together, give enough grounded points.

    `members` are described candidates, one row per (keys, candidate).
    """
    material = key_chars(F.col("classified"))
    enough = (F.size("classified") >= FEATURE_MIN_POINTS) & (material >= FEATURE_MIN_CHARS)
    official = (F.lower("publisher") == profile.bulletin_publisher) & (F.col("field_count") >= 3)
    alone = F.col("primary_source") & (official | enough)
    has_text = F.when(F.size("classified") > 0, F.col("publisher"))  # a section for each sentence
    out = members.groupBy(*keys).agg(
        F.bool_or(alone).alias("__alone"),
        F.count_distinct(has_text).alias("__publishers"),
        F.flatten(F.array_sort(F.collect_list("classified"))).alias("__all"),
    )
    out = text.distinct_by_key(out, "__all", F.col("__all"))
    for name, cap in SECTION_CAPS.items():
        out = out.withColumn(f"__{name}", F.slice(F.filter("__all", lambda s: s["section"] == name), 1, cap))
    out = out.withColumn("__points", F.concat(*[f"__{n}" for n in SECTION_CAPS]))
    together = (F.col("__publishers") >= 2) & (F.size("__points") >= FEATURE_MIN_POINTS) & (key_chars(F.col("__points")) >= FEATURE_MIN_CHARS)
    kind = F.when(F.col("__alone") | together, F.lit("feature")).otherwise(F.lit("brief"))
    return out.select(*keys, kind.alias("inferred_type"))


def owned_candidates(proposals: DataFrame, candidates: DataFrame, most: int | None = 3) -> DataFrame:
    """(edition_id, draft_no, n, id): known candidates of each proposal; the first proposal that uses an id keeps it.

    `most` proposals of an edition are read, as many as the caller may submit.
    """
    df = proposals if most is None else proposals.filter(F.col("draft_no") <= most)
    cited = df.select("edition_id", "draft_no", F.posexplode("candidate_ids").alias("n", "id"))
    known = cited.join(candidates.select("edition_id", "id").distinct(), ["edition_id", "id"])
    first = Window.partitionBy("edition_id", "id").orderBy("draft_no", "n")
    return known.withColumn("__r", F.row_number().over(first)).filter("__r = 1").drop("__r")


def validated_drafts(proposals: DataFrame, described: DataFrame, profile: Profile = JAPANESE, most: int | None = 3) -> DataFrame:
    """External draft proposals reduced to what the candidates support.

    proposals(edition_id, draft_no, candidate_ids, title, dek, summary, why, category, article_type, importance,
    tags, facts, impact, background, watch, source_notes map<string,string>). Unknown and taken ids go, categories
    and importance fall back, the article type cannot exceed what the evidence carries, sections are exclusive.
    """
    owned = owned_candidates(proposals, described, most)
    rows = owned.join(described.select(*JUDGED), ["edition_id", "id"])
    kinds = infer_article_type(rows, ("edition_id", "draft_no"), profile)
    ids = rows.groupBy("edition_id", "draft_no").agg(
        F.array_sort(F.collect_list(F.struct("n", "id", F.col("category").alias("own")))).alias("__ids"),
        F.array_sort(F.collect_set("publisher")).alias("publishers"),
    )
    df = proposals.drop("candidate_ids").join(ids, ["edition_id", "draft_no"]).join(kinds, ["edition_id", "draft_no"])
    df = df.withColumn("candidate_ids", F.transform("__ids", lambda x: x["id"]))
    df = text.safe_text(df, "title", F.col("title"), 70, profile)
    df = text.once(df, "title", F.col("title")).filter(F.col("title") != "")
    for name, width in (("facts", 240), ("impact", 240), ("watch", 180)):
        clean = F.transform(F.coalesce(F.col(name), F.array().cast("array<string>")), lambda v: text.squash(v, 720))
        df = text.complete_items(df, name, clean, width, profile)
        df = df.withColumn(name, F.slice(F.array_distinct(name), 1, SECTION_CAPS[name]))
    df = text.safe_text(df, "summary", F.col("summary"), 420, profile)
    df = df.withColumn("summary", F.when(F.col("summary") != "", F.col("summary")).otherwise(F.substring(F.array_join("facts", " "), 1, 420)))
    df = text.once(df, "summary", F.col("summary")).filter(text.readable(F.concat_ws(" ", "title", "summary"), profile))
    df = text.safe_text(df, "background", F.col("background"), BACKGROUND_CHARS, profile)
    df = text.description_sentences(df, "__bg", F.col("background"), profile)
    df = exclusive_sections(df.withColumn("background_points", F.transform("__bg", lambda s: s["text"]))).drop("__bg")
    df = text.safe_text(df, "dek", F.col("dek"), 140, profile)
    df = text.safe_text(df, "why_it_matters", F.col("why"), 220, profile)
    notes = F.map_filter("source_notes", lambda k, v: F.array_contains(F.col("candidate_ids"), k) & (F.trim(v) != ""))
    upgrade = (F.col("article_type") == "feature") & (F.col("inferred_type") != "feature")
    allowed = F.col("article_type").isin(*ARTICLE_TYPES) & ~upgrade
    return df.withColumns(
        {
            "category": F.when(F.col("category").isin(*CATEGORIES), F.col("category")).otherwise(F.get("__ids", F.lit(0))["own"]),
            "importance": F.least(F.greatest(F.coalesce("importance", F.lit(3)), F.lit(1)), F.lit(5)),
            "article_type": F.when(F.coalesce(allowed, F.lit(False)), F.col("article_type")).otherwise(F.col("inferred_type")),
            "source_notes": F.transform_values(notes, lambda k, v: text.squash(v, 180)),
            "tags": F.slice(F.array_distinct(F.transform("tags", lambda t: text.squash(t, 30))), 1, 3),
            "desk_lens": F.lit(""),
            "event_keys": F.array().cast("array<string>"),
        }
    ).drop("__ids", "inferred_type", "why")
