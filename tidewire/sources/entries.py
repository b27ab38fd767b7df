"""Feed entries to typed candidates, by the rules of their registry row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import slots, text
from tidewire.functions.profiles import CATEGORIES, CATEGORY_FAMILIES, JAPANESE, OTHER_CATEGORY, Profile
from tidewire.functions.urls import canonical_url, linked_page_allowed
from tidewire.sources.registry import text_passes


def tag_values(df: DataFrame, out: str, tags: Column) -> DataFrame:
    """Distinct supplied subjects in order, split at commas, 120 code points each."""
    parts = F.flatten(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.split(F.substring(text.squash(t), 1, 120), "[,、]")))
    values = F.transform(parts, lambda p: text.squash(p, 120))
    return df.withColumn(out, F.array_distinct(F.filter(values, lambda v: v != "")))


def tags_pass(folded: Column, include: Column, exclude: Column) -> Column:
    """No excluded tag, and at least one included one when there is an include rule (all sides folded)."""
    return ~F.arrays_overlap(folded, exclude) & ((F.size(include) == 0) | F.arrays_overlap(folded, include))


def first_description(df: DataFrame, out: str, atom: Column, limit: int | None = 900) -> DataFrame:
    """First non-empty of the Atom contents (opt-in), summary, description and subtitle, cleaned."""
    nothing = F.array().cast("array<string>")
    names = [f"__{out}{i}" for i in range(4)]
    written = F.filter(F.coalesce("content", nothing), lambda c: F.trim(F.regexp_replace(c, r"(?U)<[^>]*>|\s", "")) != "")
    contents = F.when(atom, F.get(written, F.lit(0)))
    sources = (contents, F.col("summary"), F.col("description"), F.col("subtitle"))
    for name, source in zip(names, sources):
        df = text.clean_text(df, name, source, limit)
    return df.withColumn(out, F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names], F.lit(""))).drop(*names)


def bracket_title(description: Column) -> Column:
    """Text of a leading lenticular bracket, '' when there is none."""
    return F.trim(F.regexp_extract(description, r"^【\s*([^】]{1,180}?)\s*】", 1))


def inferred_category(df: DataFrame, out: str, title: Column, description: Column, tags: str, default: Column, profile: Profile = JAPANESE) -> DataFrame:
    """Category of the first known tag, else of the first rule found in the text, else the default."""
    known = F.create_map(*[F.lit(x) for pair in profile.tag_categories.items() for x in pair])
    df = text.nfkc_fold_items(df, "__folded", F.col(tags))
    by_tag = F.get(F.filter(F.transform("__folded", lambda t: F.element_at(known, t)), lambda c: c.isNotNull()), F.lit(0))
    df = text.nfkc(df, "__haystack", F.concat_ws(" ", title, description, F.array_join(tags, " ")))
    by_text = F.coalesce(
        *[F.when(F.col("__haystack").rlike("(?iU)" + rule), F.lit(category)) for category, rule in profile.text_categories]
    )
    return df.withColumn(out, F.coalesce(by_tag, by_text, default)).drop("__folded", "__haystack")


def candidates(entries: DataFrame, rules: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """Entries that pass their feed's rules, as candidates.

    `rules` comes from `prepared_rules`. The cheap built-in predicates come first, because Catalyst does not
    order filters by the cost of a Python step.
    """
    df = entries.join(rules, "feed_id")
    df = tag_values(df, "__tags", F.col("tags"))
    df = text.nfkc_fold_items(df, "__folded", F.col("__tags"))
    df = text.nfkc_fold_items(df, "__include", F.coalesce("includeEntryCategories", F.array().cast("array<string>")))
    df = text.nfkc_fold_items(df, "__exclude", F.coalesce("excludeEntryCategories", F.array().cast("array<string>")))
    df = df.filter(tags_pass(F.col("__folded"), F.col("__include"), F.col("__exclude")))
    df = df.filter(F.coalesce("published", "updated").isNotNull())

    df = text.clean_text(df, "__product_title", F.col("title"), 260)
    df = first_description(df, "__description", F.col("extractAtomContent"))
    derived = F.when(F.col("titleFromDescriptionBrackets"), F.nullif(bracket_title(F.col("__description")), F.lit("")))
    df = df.withColumn("__title", F.coalesce(derived, F.col("__product_title")))
    df = df.filter(
        (F.col("__title") != "")
        & text_passes(F.col("__title"), F.col("includeTitlePatterns"), F.col("excludeTitlePatterns"))
        & text_passes(F.col("__product_title"), F.col("includeProductTitlePatterns"), F.col("excludeProductTitlePatterns"))
    )

    link = F.coalesce(F.nullif("link", F.lit("")), F.nullif("id", F.lit("")))
    link = F.when(F.col("forceHttps"), F.regexp_replace(link, "^http://", "https://")).otherwise(link)
    df = df.withColumn("__link", link).withColumn("__url", canonical_url(F.col("__link"))).filter(F.col("__url").isNotNull())
    page_ok = linked_page_allowed(
        F.col("__url"), F.col("allowedHosts"), F.coalesce("linkedHtmlPathPrefixes", F.array().cast("array<string>")), F.col("linkedHtmlRequireExactHost")
    )
    df = df.filter(~F.col("fetchLinkedHtml") | page_ok)

    df = inferred_category(df, "__category", F.col("__title"), F.col("__description"), "__tags", F.col("category"), profile)
    df = df.withColumn("__at", F.coalesce("published", "updated"))
    identity = F.concat_ws("|", "name", "__url", slots.iso_utc(F.col("__at")))
    return df.select(
        text.stable_hash(identity, 18).alias("id"),
        F.col("__title").alias("title"),
        F.col("__product_title").alias("product_title"),
        F.when(F.col("metadataOnly"), F.lit("")).otherwise(F.col("__description")).alias("description"),
        F.col("__url").alias("url"),
        text.squash(F.col("name"), 80).alias("source_name"),
        text.squash(F.col("publisher"), 60).alias("publisher_id"),
        F.when(F.col("inferCategory"), F.col("__category")).otherwise(F.col("category")).alias("category"),
        F.col("__at").alias("published_at"),
        "priority",
        F.col("aiRequired").alias("ai_required"),
        F.col("primarySource").alias("primary_source"),
        F.lit(False).alias("context_only"),
        F.lit("").alias("origin_edition_id"),
        "feed_id",
    )


def editorial_category(df: DataFrame, out: str, title: Column, category: Column, profile: Profile = JAPANESE) -> DataFrame:
    df = text.safe_text(df, f"__{out}_t", title, 180, profile)
    df = text.nfkc(df, f"__{out}_t", F.col(f"__{out}_t"))
    return df.withColumn(out, desk_of(F.col(f"__{out}_t"), category, profile)).drop(f"__{out}_t")


def desk_of(title: Column, category: Column, profile: Profile = JAPANESE) -> Column:
    """Desk category of a safe NFKC title: the first title rule that matches, else the own category."""
    by_title = [F.when(title.rlike("(?U)" + rule), F.lit(name)) for name, rule in profile.title_categories]
    own = F.when(category.isin(*CATEGORIES), category).otherwise(F.lit(OTHER_CATEGORY))
    return F.coalesce(*by_title, own)


def category_family(category: Column) -> Column:
    return F.coalesce(*[F.when(category.isin(*names), F.lit(family)) for family, names in CATEGORY_FAMILIES.items()], category)
