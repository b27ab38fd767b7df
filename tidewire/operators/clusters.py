"""Event clusters of the candidates of an edition.

Clustering runs after the candidate limiter, so an edition has at most 24 fresh and 24 context rows here. The
similarity edges come from blocked joins over all editions at once; only the order-dependent assignment of an
edition's few rows to clusters is a grouped function.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.profiles import (
    CLUSTER_SIMILARITY,
    FEATURE_MAX_AGE_HOURS,
    FEATURE_SIMILARITY,
    JAPANESE,
    Profile,
)
from tidewire.operators.similarity import similar_pairs
from tidewire.sources.entries import category_family, desk_of

SUBSTANTIVE_CHARS = 45
CLUSTERED = pa.schema([("edition_id", pa.string()), ("pos", pa.int32()), ("cluster", pa.int32())])


def publisher_key() -> Column:
    return F.coalesce(F.nullif("publisher_id", F.lit("")), F.col("source_name"))


def safe_description(df: DataFrame, out: str, c: Column, profile: Profile = JAPANESE, limit: int | None = 900) -> DataFrame:
    """Safe, complete, readable description; a trailing ellipsis fragment is cut when enough text precedes it."""
    df = text.safe_text(df, out, c, limit and limit * 3, profile)
    if limit:
        df = text.complete_text(df, out, F.col(out), limit, profile)
    df = df.withColumn(out, F.when(text.readable(F.col(out), profile), F.col(out)).otherwise(""))
    before = F.substring(F.col(out), F.lit(1), F.greatest(F.length(out) - 2, F.lit(0)))
    whole = F.regexp_extract(before, "(?s)^(.*[。！？])", 1)
    cut = F.col(out).rlike(r"(?:…|\.\.\.)[。.]?$") & (F.length(whole) >= SUBSTANTIVE_CHARS)
    return df.withColumn(out, F.when(cut, whole).otherwise(F.col(out)))


def substantive(description: Column) -> Column:
    return F.length(F.regexp_replace(description, text.SPACE, "")) >= SUBSTANTIVE_CHARS


def classify(sentences: str, wide: str, profile: Profile) -> Column:
    """array<struct<text, key, section>>: watch, then impact, then background, else facts."""

    def section(w: Column) -> Column:
        return (
            F.when(w.rlike("(?U)" + profile.watch), F.lit("watch"))
            .when(w.rlike("(?U)" + profile.concrete_impact) | w.rlike("(?U)" + profile.broad_impact), F.lit("impact"))
            .when(w.rlike("(?U)" + profile.background), F.lit("background"))
            .otherwise(F.lit("facts"))
        )

    return F.zip_with(
        sentences, wide, lambda s, w: F.struct(s["text"].alias("text"), s["key"].alias("key"), section(w).alias("section"))
    )


def with_sections(df: DataFrame, out: str, sentences: str, profile: Profile = JAPANESE) -> DataFrame:
    """Classify each sentence of array<struct<text, key>>."""
    df = text.nfkc_items(df, f"__{out}_w", F.transform(sentences, lambda s: s["text"]))
    return df.withColumn(out, classify(sentences, f"__{out}_w", profile)).drop(f"__{out}_w")


def in_section(classified: Column, name: str, cap: int | None = None) -> Column:
    found = F.transform(F.filter(classified, lambda s: s["section"] == name), lambda s: s["text"])
    return F.slice(found, 1, cap) if cap else found


def bulletin_fields(wide: Column, profile: Profile = JAPANESE) -> Column:
    """How many of the bulletin field labels an NFKC text contains."""
    return sum((wide.rlike("(?U)" + p).cast("int") for p in profile.bulletin_fields), F.lit(0))


def date_anchor(folded: Column, published_at: Column) -> Column:
    """Calendar date a text states, '' when it states none or an impossible one."""
    wall = published_at + F.make_dt_interval(hours=F.lit(9))
    iso = r"(20\d{2})[-/](\d{1,2})[-/](\d{1,2})"
    full = r"(?:(20\d{2})年)?(\d{1,2})月(\d{1,2})日"
    day_only = r"(\d{1,2})日(?:に|、)?(?:起き|発生|観測)"

    def date(year: Column, month: Column, day: Column) -> Column:
        text_date = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return F.coalesce(F.date_format(F.try_to_timestamp(text_date, F.lit("yyyy-MM-dd")), "yyyy-MM-dd"), F.lit(""))

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(folded, pattern, group)

    year, month = F.date_format(wall, "yyyy"), F.date_format(wall, "MM")
    return (
        F.when(part(iso, 0) != "", date(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(part(full, 0) != "", date(F.coalesce(F.nullif(part(full, 1), F.lit("")), year), part(full, 2), part(full, 3)))
        .when(part(day_only, 0) != "", date(year, month, part(day_only, 1)))
        .otherwise("")
    )


def magnitude_anchor(folded: Column) -> Column:
    return F.regexp_extract(folded, r"(?U)(?:マグニチュード|m)\s*[:：]?\s*(\d+(?:\.\d+)?)", 1)


def event_signature(df: DataFrame, out: str, title: Column, description: Column, profile: Profile = JAPANESE) -> DataFrame:
    df = text.nfkc_fold(df, f"__{out}_f", F.concat_ws(" ", title, description))
    return df.withColumn(out, signature_of(F.col(f"__{out}_f"), F.col("published_at"), profile)).drop(f"__{out}_f")


def signature_of(t: Column, published_at: Column, profile: Profile = JAPANESE) -> Column:
    """Identity, in folded text, of events whose headlines paraphrase each other; '' for all others."""
    day, size = date_anchor(t, published_at), magnitude_anchor(t)
    known = (day != "") & (size != "")
    origin = F.regexp_extract(t, r"(?U)発生時刻\s*[:：]\s*(20\d{2}-\d{2}-\d{2}t\d{2}:\d{2}:\d{2}[+\-]\d{2}:\d{2})", 1)
    place = F.regexp_replace(F.regexp_extract(t, r"(?U)震央・震源地域\s*[:：]\s*([^。]{2,80})", 1), text.NON_WORD, "")
    result = None
    for name, region in profile.quake_regions:
        hit = t.rlike(profile.quake_words) & t.rlike(region)
        value = F.when(known, F.concat(F.lit(name + ":"), day, F.lit(":m"), size)).otherwise("")
        result = F.when(hit, value) if result is None else result.when(hit, value)
    official = (origin != "") & (place != "")
    value = F.concat_ws(":", F.lit("earthquake"), place, origin)
    result = F.when(official, value) if result is None else result.when(official, value)
    for name, patterns in profile.themes:
        hit = F.lit(True)
        for p in patterns:
            hit = hit & t.rlike(p)
        result = result.when(hit, F.lit(name))
    return result.otherwise("")


def described(df: DataFrame, profile: Profile = JAPANESE, limit: int | None = 900) -> DataFrame:
    """Candidates with what clustering and editing read: safe text, sentences with sections, keys, desk and order."""
    df = df.withColumn("publisher", publisher_key())
    df = safe_description(df, "safe_description", F.col("description"), profile, limit)
    df = text.safe_text(df, "safe_title", F.col("title"), 360, profile)
    df = text.description_sentences(df, "sentences", F.col("safe_description"), profile)
    df = df.withColumns(
        {
            "__desk_title": F.rtrim(F.substring("safe_title", 1, 180)),
            "__event_text": F.concat_ws(" ", "title", "safe_description"),
            "__sentence_texts": F.transform("sentences", lambda s: s["text"]),
            "__ground": F.array("safe_title", "safe_description"),
        }
    )
    df = df.withColumns(
        {
            "title_norm": text.title_norm_of("title"),
            "title_key": text.point_key_of("title"),
            "wide_description": text.nfkc_of("safe_description"),
            "__desk_title": text.nfkc_of("__desk_title"),
            "__event_text": text.nfkc_fold_of("__event_text"),
            "__sentence_texts": text.nfkc_items_of("__sentence_texts"),
            "__ground_keys": text.nfkc_fold_items_of("__ground"),
        }
    )
    grounded = F.zip_with(
        "__ground",
        "__ground_keys",
        lambda t, k: F.struct(
            F.regexp_replace(F.substring(k, 1, 500), text.NON_WORD, "").alias("key"),
            F.length(F.regexp_replace(t, text.SPACE, "")).alias("chars"),
        ),
    )
    has_text = F.col("safe_description") != ""
    rank = F.struct(
        (~F.col("context_only")).alias("fresh"),
        (F.col("primary_source") & has_text).alias("primary_text"),
        has_text.alias("text"),
        F.col("primary_source").alias("primary"),
        F.length("safe_description").alias("chars"),
        F.col("priority").alias("priority"),
        F.col("published_at").alias("at"),
    )
    df = df.withColumns(
        {
            "classified": classify("sentences", "__sentence_texts", profile),
            "desk": desk_of(F.col("__desk_title"), F.col("category"), profile),
            "signature": signature_of(F.col("__event_text"), F.col("published_at"), profile),
            "field_count": bulletin_fields(F.col("wide_description"), profile),
            "grounded": F.filter(grounded, lambda g: g["key"] != ""),
            "alert": F.col("title").rlike("(?U)" + profile.alert_words),
            "rank": rank,
        }
    )
    df = df.withColumn("family", category_family(F.col("desk")))
    return df.drop("__desk_title", "__event_text", "__sentence_texts", "__ground", "__ground_keys")


def lead_ordered(df: DataFrame) -> DataFrame:
    """Add `lead_order`: place of the row in its edition by detail rank, best first."""
    return df.withColumn("lead_order", F.row_number().over(Window.partitionBy("edition_id").orderBy(F.desc("rank"), "pos")))


def title_edges(df: DataFrame, threshold: float = CLUSTER_SIMILARITY, on: str = "category") -> DataFrame:
    """(edition_id, pos, match): rows of one category whose title resembles that of an earlier row."""
    titled = df.filter(F.col("title_norm") != "")
    later = titled.select("edition_id", on, F.col("pos"), F.col("title_norm").alias("later_title"))
    earlier = titled.select("edition_id", on, F.col("pos").alias("match"), F.col("title_norm").alias("earlier_title"))
    pairs = similar_pairs(
        later, earlier, "later_title", "earlier_title", threshold, on=("edition_id", on), extra=F.col("match") < F.col("pos")
    )
    return pairs.select("edition_id", "pos", "match").distinct()


def feature_edges(df: DataFrame, threshold: float = FEATURE_SIMILARITY) -> DataFrame:
    """(edition_id, pos, match): pairs that report the same event.

    One URL; else at most 48 hours apart and one signature, or, when not both carry a signature and neither is
    context, one category family and similar titles.
    """
    a, b = df.alias("a"), df.alias("b")
    earlier = F.col("b.pos") < F.col("a.pos")
    span = F.make_dt_interval(hours=F.lit(FEATURE_MAX_AGE_HOURS))
    close = (F.col("a.published_at") - F.col("b.published_at")).between(-span, span)
    chosen = [F.col("a.edition_id").alias("edition_id"), F.col("a.pos").alias("pos"), F.col("b.pos").alias("match")]
    same_edition = F.col("a.edition_id") == F.col("b.edition_id")
    by_url = a.join(b, same_edition & (F.col("a.url") == F.col("b.url")) & earlier).select(*chosen)
    signed = (F.col("a.signature") == F.col("b.signature")) & (F.col("a.signature") != "")
    by_signature = a.join(b, same_edition & signed & earlier & close).select(*chosen)

    fresh = df.filter(~F.col("context_only") & (F.col("title_norm") != ""))
    later = fresh.select(
        "edition_id", "family", "pos", F.col("title_norm").alias("later_title"),
        F.col("signature").alias("later_signature"), F.col("published_at").alias("later_at"),
    )
    before = fresh.select(
        "edition_id", "family", F.col("pos").alias("match"), F.col("title_norm").alias("earlier_title"),
        F.col("signature").alias("earlier_signature"), F.col("published_at").alias("earlier_at"),
    )
    allowed = (
        (F.col("match") < F.col("pos"))
        & (F.col("later_at") - F.col("earlier_at")).between(-span, span)
        & ((F.col("later_signature") == "") | (F.col("earlier_signature") == ""))
    )
    by_title = similar_pairs(
        later, before, "later_title", "earlier_title", threshold, on=("edition_id", "family"), extra=allowed
    ).select("edition_id", "pos", "match")
    return by_url.union(by_signature).union(by_title).distinct()


def assign_clusters(df: DataFrame, edges: DataFrame, by_lead: bool) -> DataFrame:
    """Add `cluster`: each row, in order, joins the first cluster that matches it, or opens a new one.

    A cluster matches through its current lead (`by_lead`) or through any member. `df` has `pos` and
    `lead_order` and is bounded per edition by the limiter.
    """

    def walk(nodes: pa.Table, links: pa.Table) -> pa.Table:
        rows = sorted(nodes.to_pylist(), key=lambda r: r["pos"])
        near: dict[int, set[int]] = defaultdict(set)
        for link in links.to_pylist():
            near[link["pos"]].add(link["match"])
        order = {r["pos"]: r["lead_order"] for r in rows}
        members: list[list[int]] = []
        chosen = []
        for r in rows:
            hits = near[r["pos"]]
            heads = ([min(m, key=order.get)] if by_lead else m for m in members)
            target = next((n for n, head in enumerate(heads) if hits.intersection(head)), len(members))
            if target == len(members):
                members.append([])
            members[target].append(r["pos"])
            chosen.append({"edition_id": r["edition_id"], "pos": r["pos"], "cluster": target})
        return pa.Table.from_pylist(chosen, CLUSTERED)

    # fresh aliases: the edges derive from the same rows
    nodes = df.select(*[F.col(c).alias(c) for c in ("edition_id", "pos", "lead_order")]).groupBy("edition_id")
    edges = edges.select(*[F.col(c).alias(c) for c in ("edition_id", "pos", "match")])
    placed = nodes.cogroup(edges.groupBy("edition_id")).applyInArrow(walk, "edition_id string, pos int, cluster int")
    return df.join(placed, ["edition_id", "pos"])


def importance(priority: Column, publishers: Column, alert: Column) -> Column:
    """Mean priority rounded half to even, raised by a second publisher and by an alert word, within 1..5."""
    score = F.bround(priority) + F.when(publishers >= 2, 1).otherwise(0) + F.when(alert, 1).otherwise(0)
    return F.least(F.greatest(score, F.lit(1)), F.lit(5)).cast("int")


def distinct_chars(grounded: Column) -> Column:
    """Total size of array<struct<key, chars>> counting each key once, at its first item (bounded arrays)."""
    keys = F.transform(grounded, lambda g: g["key"])
    firsts = F.filter(grounded, lambda g, i: F.array_position(keys, g["key"]) == i + 1)
    return F.aggregate(firsts, F.lit(0), lambda acc, g: acc + g["chars"])


MEMBER = (
    "pos id url title safe_title title_key safe_description publisher source_name category desk signature priority "
    "published_at primary_source context_only origin_edition_id sentences classified field_count wide_description"
).split()


#: What clustering reads of described candidates, besides the fields of members; `grounded` only where clusters are ordered.
CLUSTERING = "edition_id pos url category family publisher priority published_at context_only signature title_norm alert rank".split()


def cluster_rows(df: DataFrame, extra: Sequence[str] = (), fields: Sequence[str] = MEMBER) -> DataFrame:
    """One row per (edition_id, cluster): members best first, lead, publishers, importance and sort measures.

    Members hold `fields` and `extra`; the fewer, the less text is shuffled. `grounded_chars` needs the column `grounded`.
    """
    member = F.struct("lead_order", *fields, *extra)
    grounded = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "grounded"))), lambda g: g["grounded"])) if "grounded" in df.columns else None
    out = df.groupBy("edition_id", "cluster").agg(
        F.array_sort(F.collect_list(member)).alias("members"),
        F.array_sort(F.collect_set("publisher")).alias("publishers"),
        F.avg("priority").alias("__mean"),
        F.bool_or("alert").alias("__alert"),
        F.bool_or(~F.col("context_only")).alias("any_fresh"),
        F.max("priority").alias("max_priority"),
        F.max("published_at").alias("max_published_at"),
        *([] if grounded is None else [grounded.alias("__grounded")]),
    )
    return out.withColumns(
        {
            "lead": F.get("members", F.lit(0)),
            "importance": importance(F.col("__mean"), F.size("publishers"), F.col("__alert")),
        }
        | ({} if grounded is None else {"grounded_chars": distinct_chars(F.col("__grounded"))})
    ).drop("__mean", "__alert", "__grounded")


def ordered_clusters(rows: DataFrame) -> DataFrame:
    """Add `place`: order of the clusters of an edition for selection."""
    order = [F.desc(c) for c in ("any_fresh", "importance", "grounded_chars", "max_priority", "max_published_at")]
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("edition_id").orderBy(*order, "cluster")))


def modal_category(members: Column, lead: Column) -> Column:
    """Most frequent desk of the members; a tie goes to the lead's desk, then to the earliest."""
    desks = F.transform(members, lambda m: m["desk"])
    counted = F.transform(
        F.array_distinct(desks),
        lambda d: F.struct(
            F.size(F.filter(desks, lambda x: x == d)).alias("n"), (d == lead["desk"]).cast("int").alias("own"), d.alias("desk")
        ),
    )
    return F.array_max(counted)["desk"]


def event_clusters(df: DataFrame, threshold: float = CLUSTER_SIMILARITY) -> DataFrame:
    """Described, limited candidates to title clusters."""
    return assign_clusters(df, title_edges(df, threshold), by_lead=False)


def feature_clusters(df: DataFrame, threshold: float = FEATURE_SIMILARITY) -> DataFrame:
    """Described, limited candidates (with context) to same-event clusters."""
    return assign_clusters(df, feature_edges(df, threshold), by_lead=True)
