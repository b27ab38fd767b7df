"""Landed feed payloads to entries, with the rejected ones accounted for."""

from __future__ import annotations

import gzip
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.text import arrow, each

TAG = "struct<_term string, _label string, _VALUE string>"
ITEM = (
    "struct<title string, link string, guid string, pubDate string, date string, description string, "
    "encoded string, category array<string>, subject array<string>>"
)
ATOM_ENTRY = (
    "struct<title string, link array<struct<_href string, _rel string>>, id string, published string, updated string, "
    f"summary string, subtitle string, content array<string>, category array<{TAG}>>"
)
FEED_XML = f"channel struct<item array<{ITEM}>>, item array<{ITEM}>, entry array<{ATOM_ENTRY}>, broken string"
XML_OPTIONS = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "broken", "mode": "PERMISSIVE"}


@arrow(T.BinaryType())
def _gunzip(values: pa.Array) -> pa.Array:
    return each(values, unpacked, pa.binary())


def unpacked(body: bytes) -> bytes | None:
    try:
        return gzip.decompress(body)
    except (OSError, EOFError, zlib.error):
        return None


def decode_payloads(payloads: DataFrame, registry: DataFrame) -> DataFrame:
    """payloads(feed_id, body binary) with `xml` text and, where it is unusable, a `rejected` reason."""
    limits = registry.select("feed_id", "maxFeedBytes")
    zipped = F.hex(F.substring("body", 1, 2)) == "1F8B"
    df = payloads.join(limits, "feed_id")
    too_big = F.octet_length("body") > F.col("maxFeedBytes")
    df = df.withColumn("__plain", F.when(zipped & ~too_big, _gunzip(F.when(zipped & ~too_big, F.col("body")))).otherwise(F.col("body")))
    head = F.upper(F.decode(F.substring("__plain", 1, 4096), "ISO-8859-1"))
    reason = (
        F.when(too_big, F.lit("too large"))
        .when(F.col("__plain").isNull(), F.lit("invalid gzip"))
        .when(F.octet_length("__plain") > F.col("maxFeedBytes"), F.lit("too large unpacked"))
        .when(head.rlike("<!DOCTYPE|<!ENTITY"), F.lit("document type not allowed"))
    )
    df = df.withColumn("rejected", reason)
    xml = F.when(F.col("rejected").isNull(), F.decode("__plain", "UTF-8"))
    return df.withColumn("xml", xml).drop("__plain", "body", "maxFeedBytes")


def _rss(items: Column) -> Column:
    no_text = F.lit(None).cast("string")
    return F.transform(
        F.coalesce(items, F.array().cast(f"array<{ITEM}>")),
        lambda i: F.struct(
            i["title"].alias("title"),
            i["link"].alias("link"),
            i["guid"].alias("id"),
            F.coalesce(i["pubDate"], i["date"]).alias("published"),
            no_text.alias("updated"),
            i["description"].alias("summary"),
            no_text.alias("description"),
            no_text.alias("subtitle"),
            F.array_compact(F.array(i["encoded"])).alias("content"),
            F.coalesce(i["category"], i["subject"], F.array().cast("array<string>")).alias("tags"),
        ),
    )


def _atom(entries: Column) -> Column:
    no_tags = F.array().cast("array<string>")
    return F.transform(
        F.coalesce(entries, F.array().cast(f"array<{ATOM_ENTRY}>")),
        lambda e: F.struct(
            e["title"].alias("title"),
            F.get(F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0))["_href"].alias("link"),
            e["id"].alias("id"),
            e["published"].alias("published"),
            e["updated"].alias("updated"),
            e["summary"].alias("summary"),
            F.lit(None).cast("string").alias("description"),
            e["subtitle"].alias("subtitle"),
            F.coalesce(e["content"], no_tags).alias("content"),
            F.coalesce(F.transform(e["category"], lambda t: F.coalesce(t["_term"], t["_label"], t["_VALUE"])), no_tags).alias("tags"),
        ),
    )


def feed_time(c: Column) -> Column:
    """UTC time of an RFC 2822 or ISO 8601 text, null when unreadable."""
    numeric = F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z]{3},?\s+", ""), r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    instant = F.coalesce(
        F.try_to_timestamp(numeric, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(numeric, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(c),
    )
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.unix_seconds(instant).cast("decimal(18,6)"))


def parse_payloads(decoded: DataFrame) -> DataFrame:
    """Decoded payloads with `found`, the entries of RSS 2.0, RSS 1.0 or Atom, and `rejected` completed."""
    df = decoded.withColumn("__doc", F.from_xml("xml", FEED_XML, XML_OPTIONS))
    found = F.concat(_rss(F.col("__doc.channel.item")), _rss(F.col("__doc.item")), _atom(F.col("__doc.entry")))
    df = df.withColumn("found", F.when(F.col("rejected").isNull(), F.coalesce(found, F.array().cast(found_type()))))
    broken = F.col("rejected").isNull() & F.col("__doc.broken").isNotNull() & (F.size("found") == 0)
    return df.withColumn("rejected", F.when(broken, F.lit("invalid feed")).otherwise(F.col("rejected"))).drop("__doc", "xml")


def found_type() -> str:
    names = "title link id published updated summary description subtitle".split()
    return "array<struct<" + ", ".join(f"{n}: string" for n in names) + ", content: array<string>, tags: array<string>>>"


def entries(parsed: DataFrame) -> DataFrame:
    """One row per entry of the accepted payloads."""
    rows = parsed.filter(F.col("rejected").isNull()).select("feed_id", F.inline("found"))
    return rows.withColumns({"published": feed_time(F.col("published")), "updated": feed_time(F.col("updated"))})


def feed_failures(parsed: DataFrame, registry: DataFrame) -> DataFrame:
    """Per feed: whether any payload was accepted, and the reasons of the rejected ones."""
    seen = parsed.groupBy("feed_id").agg(
        F.bool_or(F.col("rejected").isNull()).alias("ok"),
        F.array_sort(F.collect_set("rejected")).alias("reasons"),
    )
    return registry.select("feed_id").join(seen, "feed_id", "left").withColumns(
        {"ok": F.coalesce("ok", F.lit(False)), "reasons": F.coalesce("reasons", F.array().cast("array<string>"))}
    )


def success_floor(outcome: DataFrame) -> DataFrame:
    """One row: feeds, successes, the required minimum (a quarter, rounded up, at least one) and the verdict."""
    counted = outcome.agg(F.count("*").alias("feeds"), F.count_if("ok").alias("succeeded"))
    required = F.greatest(F.lit(1), F.floor((F.col("feeds") + 3) / 4))
    return counted.withColumn("required", required).withColumn("passed", F.col("succeeded") >= F.col("required"))


def behind_floor(df: DataFrame, outcome: DataFrame) -> DataFrame:
    """The rows, in a job that fails when too few feeds succeeded; the verdict is worked out inside the job, once."""
    verdict = success_floor(outcome)
    message = F.concat(F.lit("only "), F.col("succeeded"), F.lit(" of "), F.col("feeds"), F.lit(" feeds succeeded, "), F.col("required"), F.lit(" are needed"))
    return df.filter(verdict.select(F.when(F.col("passed"), True).otherwise(F.raise_error(message).cast("boolean"))).scalar())
