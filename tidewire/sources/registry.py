"""Feed registry: the rule table that drives entry conversion."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.profiles import CATEGORIES, INTENSITY_RANKS
from tidewire.functions.text import arrow, each
from tidewire.functions.urls import canonical_url, url_parts

# fixed values: limits a registry row may ask for
FEED_BYTES = (2_000_000, 8_000_000)
LINKED_BYTES = (750_000, 2_000_000)
LINKED_SECONDS = (8, 20)
LINKED_CHARS = (160, 900)

PATTERN_FIELDS = (
    "includeTitlePatterns",
    "excludeTitlePatterns",
    "includeProductTitlePatterns",
    "excludeProductTitlePatterns",
    "linkedXmlIncludePatterns",
    "linkedXmlExcludePatterns",
    "minimumMaxIntensityExemptPatterns",
)
STRING_LISTS = {
    "includeEntryCategories": (32, 120),
    "excludeEntryCategories": (32, 120),
    "linkedHtmlRootIds": (8, 100),
    "linkedHtmlPathPrefixes": (8, 200),
}
BOUNDED = {
    "maxFeedBytes": FEED_BYTES,
    "linkedXmlMaxBytes": LINKED_BYTES,
    "linkedXmlTimeoutSeconds": LINKED_SECONDS,
    "linkedHtmlMaxBytes": LINKED_BYTES,
    "linkedHtmlTimeoutSeconds": LINKED_SECONDS,
    "linkedHtmlMinimumChars": LINKED_CHARS,
}

FEED_FIELDS = ", ".join(
    [
        "id string, publisher string, name string, url string, allowedHosts array<string>, category string",
        "priority int, primarySource boolean, inferCategory boolean, metadataOnly boolean, forceHttps boolean",
        "aiRequired boolean, extractAtomContent boolean, titleFromDescriptionBrackets boolean",
        "minimumMaxIntensity string, fetchLinkedXml boolean, linkedXmlParser string, linkedXmlRequired boolean",
        "fetchLinkedHtml boolean, linkedHtmlParser string, linkedHtmlRequired boolean",
        "linkedHtmlRequireExactHost boolean",
        *[f"{name} int" for name in BOUNDED],
        *[f"{name} array<string>" for name in (*PATTERN_FIELDS, *STRING_LISTS)],
    ]
)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per feed of a `{"feeds": [...]}` JSON document."""
    return spark.read.schema(_schema()).json(path, multiLine=True).select(F.inline("feeds"))


def _schema() -> str:
    fields = ", ".join(f.strip().replace(" ", ": ", 1) for f in FEED_FIELDS.split(", "))
    return f"feeds array<struct<{fields}>>"


def compiles(pattern: str) -> bool:
    try:
        re.compile(pattern, re.IGNORECASE)
    except re.error:
        return False
    return True


@arrow(T.BooleanType())
def _all_compile(lists: pa.Array) -> pa.Array:
    return each(lists, lambda items: all(compiles(p) for p in items if p is not None), pa.bool_())


def registry_problems(registry: DataFrame) -> DataFrame:
    """(id, rule) for every rule a registry row breaks; an empty result means the registry is usable."""
    rules: dict[str, Column] = {
        "category": F.col("category").isin(*CATEGORIES),
        "url": F.col("__url").isNotNull(),
        "xml_or_html": ~(F.col("fetchLinkedXml") & F.col("fetchLinkedHtml")),
    }
    for name, (_, top) in BOUNDED.items():
        rules[name] = F.col(name).between(1, top)
    for name in PATTERN_FIELDS:
        item_ok = F.forall(name, lambda p: p.isNotNull() & F.length(p).between(1, 200))
        rules[name] = (F.size(name) <= 32) & item_ok & F.col(f"__{name}")
    for name, (most, width) in STRING_LISTS.items():
        rules[name] = (F.size(name) <= most) & F.forall(
            name, lambda v: v.isNotNull() & (F.trim(v) != "") & (F.length(v) <= width)
        )
    xml, page = F.coalesce("fetchLinkedXml", F.lit(False)), F.coalesce("fetchLinkedHtml", F.lit(False))
    hosts = F.coalesce(F.size("allowedHosts") > 0, F.lit(False))
    prefixes = F.col("linkedHtmlPathPrefixes")
    usable = F.coalesce(
        (F.size(prefixes) > 0) & F.forall(prefixes, lambda p: F.startswith(p, F.lit("/")) & ~p.rlike("[?#]")), F.lit(False)
    )
    rules |= {
        "linkedXmlParser": ~xml | F.col("linkedXmlParser").eqNullSafe("jma"),
        "linkedHtmlParser": ~page | F.col("linkedHtmlParser").eqNullSafe("official"),
        "linkedHosts": ~(xml | page) | hosts,
        "linkedPathPrefixes": ~page | usable,
        "minimumMaxIntensity": ~xml | F.col("minimumMaxIntensity").isNull()
        | F.trim("minimumMaxIntensity").isin(*INTENSITY_RANKS),
    }
    checked = registry.withColumn("__url", canonical_url(F.col("url")))
    for name in PATTERN_FIELDS:
        checked = checked.withColumn(f"__{name}", _all_compile(F.col(name)))
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(name not in ("category", "url"))), F.lit(name)) for name, rule in rules.items()])
    )
    return checked.select("id", F.explode(broken).alias("rule"))


def usable_feeds(registry: DataFrame) -> DataFrame:
    """Registry rows that break no rule."""
    return registry.join(registry_problems(registry), "id", "left_anti")


def prepared_rules(registry: DataFrame) -> DataFrame:
    """Registry rows as a join dimension: one regex per rule, host lists completed, defaults applied.

    Rows are as many as there are feeds; callers join it without a hint and let the size decide.
    """
    out = registry.withColumn("own_host", url_parts(F.col("url"))["host"])
    for name in PATTERN_FIELDS:
        joined = F.concat(F.lit("(?iU)"), F.array_join(F.transform(name, lambda p: F.concat(F.lit("(?:"), p, F.lit(")"))), "|"))
        out = out.withColumn(name, F.when(F.size(name) > 0, joined))
    hosts = F.transform("allowedHosts", lambda h: F.regexp_replace(F.lower(h), r"\.+$", ""))
    hosts = F.array_union(F.coalesce(hosts, F.array().cast("array<string>")), F.array("own_host"))
    defaults = {name: F.coalesce(F.col(name), F.lit(low)) for name, (low, _) in BOUNDED.items()}
    flags = (
        "primarySource inferCategory metadataOnly forceHttps aiRequired extractAtomContent titleFromDescriptionBrackets "
        "fetchLinkedXml linkedXmlRequired fetchLinkedHtml linkedHtmlRequired linkedHtmlRequireExactHost"
    ).split()
    return out.withColumns(
        {
            **defaults,
            **{f: F.coalesce(F.col(f), F.lit(False)) for f in flags},
            "allowedHosts": F.filter(hosts, lambda h: h != ""),
            "priority": F.least(F.greatest(F.coalesce("priority", F.lit(3)), F.lit(1)), F.lit(5)),
            "publisher": F.coalesce("publisher", "id", "name"),
        }
    ).withColumnRenamed("id", "feed_id")


def text_passes(value: Column, include: Column, exclude: Column) -> Column:
    """Exclusion wins; without an include rule everything else passes."""
    excluded = F.coalesce(F.rlike(value, exclude), F.lit(False))
    return ~excluded & F.coalesce(F.rlike(value, include), F.lit(True))
