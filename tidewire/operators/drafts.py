"""Drafts: what an edition says about each chosen cluster, in sections, from source sentences only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import slots, text
from tidewire.functions.profiles import (
    BACKGROUND_CHARS,
    FEATURE_MIN_CHARS,
    FEATURE_MIN_POINTS,
    FEATURE_RICH_SOURCE_CHARS,
    FEATURE_SUMMARY_CHARS,
    JAPANESE,
    MAX_FEATURES,
    SECTION_CAPS,
    SECTION_WIDTHS,
    Profile,
    forbidden_copy,
)
from tidewire.operators.clusters import (
    CLUSTERING,
    cluster_rows,
    event_clusters,
    feature_clusters,
    in_section,
    lead_ordered,
    modal_category,
    ordered_clusters,
    with_sections,
)
from tidewire.operators.selection import fill_with_individuals, select_diverse
from tidewire.session import cut_lineage

LABEL = r"^[^：]{1,80}："
POINT_SECTIONS = ("facts", "impact", "watch")
ISO_TIME = r"20\d{2}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+\-]\d{2}:\d{2}"

# fixed values: bulletin fields as prose (pattern, replacement)
FIELD_PROSE = (
    (r"震央・震源地域\s*[:：]\s*([^。]+)。?", "震源は$1です。"),
    (r"マグニチュード\s*[:：]\s*M?([^。]+)。?", "地震の規模はマグニチュード$1です。"),
    (r"最大震度\s*[:：]\s*([^。]+)。?", "最大震度は$1です。"),
    (r"震度([0-7](?:弱|強)?)\s*[:：]\s*([^。]+)。?", "$2で震度$1を観測しました。"),
)
ORIGIN_FIELD = rf"発生時刻\s*[:：]\s*({ISO_TIME})"
STATION_FOOTNOTE = r"^[*＊]印は気象庁以外の震度観測点"


def origin_clock(at: Column, joiner: str = "") -> Column:
    return F.concat(F.date_format(slots.local(at), "M'月'd'日'H'時'mm'分'"), F.lit(joiner))


def natural(wide: Column) -> Column:
    """One NFKC sentence with bulletin fields turned into prose; '' for the station footnote."""
    result = F.when(wide.rlike(STATION_FOOTNOTE), F.lit(""))
    at = slots.parse_iso(F.regexp_extract(wide, ORIGIN_FIELD, 1))
    told = F.coalesce(F.concat(F.lit("発生時刻は"), origin_clock(at), F.lit("です。")), F.lit(""))
    result = result.when(wide.rlike(rf"^(?U){ORIGIN_FIELD}。?$"), told)
    for pattern, prose in FIELD_PROSE:
        result = result.when(wide.rlike(rf"^(?U){pattern}$"), F.regexp_replace(wide, "(?U)" + pattern, prose))
    return result.otherwise(wide)


def feature_points(df: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """Add `natural`: distinct naturalised sentences with keys, and `points`: capped classified points."""
    df = text.nfkc_items(df, "__w", F.transform("sentences", lambda s: s["text"]))
    df = df.withColumn("__prose", F.transform("__w", lambda w: natural(F.trim(w))))
    df = text.with_keys(df, "__n", F.col("__prose"))
    df = text.distinct_by_key(df, "natural", F.col("__n"))
    prose = F.zip_with(
        "classified", "__prose", lambda s, w: F.struct(w.alias("text"), s["section"].alias("section"))
    )
    df = df.withColumn("__p", prose)
    for name, cap in SECTION_CAPS.items():
        capped = F.slice(F.filter("__p", lambda s: s["section"] == name), 1, cap)
        wide = 180 if name == "watch" else 240
        fits = F.filter(capped, lambda s: (s["text"] != "") & (F.length(s["text"]) <= wide) & text.balanced(s["text"]))
        df = df.withColumn(f"point_{name}", F.transform(fits, lambda s: s["text"]))
    return df.drop("__w", "__n", "__prose", "__p")


def bulletin_dek(df: DataFrame, out: str, profile: Profile = JAPANESE) -> DataFrame:
    """Add `out`: null unless the row is a fresh primary bulletin with three fields; its lead sentence, or ''."""
    wide = F.col("wide_description")
    at = slots.parse_iso(F.regexp_extract(wide, ORIGIN_FIELD, 1))
    place = F.regexp_extract(wide, r"(?U)震央・震源地域\s*[:：]\s*([^。]+)", 1)
    size = F.regexp_extract(wide, r"(?U)マグニチュード\s*[:：]\s*M?([^。]+)", 1)
    most = F.regexp_extract(wide, r"(?U)最大震度\s*[:：]\s*([^。]+)", 1)
    calm = wide.rlike("津波の(?:心配|影響)はありません")
    told = F.concat(
        origin_clock(at, "、"), place, F.lit("を震源とするマグニチュード"), size, F.lit("の地震があり、最大震度"), most,
        F.lit("を観測しました。"), F.when(calm, F.lit("津波の心配はありません。")).otherwise(""),
    )
    full = at.isNotNull() & (place != "") & (size != "") & (most != "")
    df = text.complete_text(df, "__dek", F.when(full, told), 220, profile)
    return df.withColumn(out, F.when(is_structured_bulletin(profile), F.col("__dek"))).drop("__dek")


def is_structured_bulletin(profile: Profile = JAPANESE) -> Column:
    return (
        ~F.col("context_only")
        & F.col("primary_source")
        & (F.lower("publisher") == profile.bulletin_publisher)
        & (F.col("field_count") >= 3)
    )


def source_note(df: DataFrame, out: str, profile: Profile = JAPANESE) -> DataFrame:
    """Attribution of a primary source, else an excerpt of its text, else its title."""
    df = text.excerpt(df, "__x", F.col("safe_description"), 180, profile)
    credit = F.concat("source_name", F.lit("の公開情報をもとに" + profile.site_name + "が要約・加工"))
    title = F.rtrim(F.substring("safe_title", 1, 180))
    own = F.when(F.col("__x") != "", F.col("__x")).otherwise(title)
    return df.withColumn(out, F.when(F.col("primary_source"), credit).otherwise(own)).drop("__x")


def merged(members: Column, field: str) -> Column:
    return F.flatten(F.transform(members, lambda m: m[field]))


def leading(items: Column, limit: int) -> Column:
    """Items from the start whose text, joined by spaces, fits in the limit."""
    ends = F.sequence(F.lit(0), F.size(items))
    count = F.array_max(F.filter(ends, lambda n: F.length(F.array_join(F.slice(items, F.lit(1), n), " ")) <= limit))
    return F.slice(items, F.lit(1), count)


def exclusive_sections(df: DataFrame) -> DataFrame:
    """Make facts, impact, background and watch mutually exclusive, in that order, within caps and widths.

    Reads complete sentences in the array columns facts, impact, background_points, watch; rewrites them and adds
    `background` and `background_count`.
    """
    given = {"facts": "facts", "impact": "impact", "background": "background_points", "watch": "watch"}
    df = df.withColumn("background_points", leading(F.col("background_points"), BACKGROUND_CHARS))
    df = df.withColumns(
        {f"__{n}": F.filter(c, lambda v: (v != "") & (F.length(v) <= SECTION_WIDTHS[n])) for n, c in given.items()}
    )
    df = df.withColumns({f"__{n}_c": F.transform(f"__{n}", lambda v: F.regexp_replace(v, LABEL, "")) for n in given})
    df = df.withColumns({f"__{n}_c": text.nfkc_fold_items_of(f"__{n}_c") for n in given})
    taken: list[str] = []
    for name in given:
        keyed = F.zip_with(
            f"__{name}", f"__{name}_c", lambda v, k: F.struct(v.alias("text"), F.regexp_replace(k, text.NON_WORD, "").alias("key"))
        )
        before = F.concat(*[F.transform(f"__{t}_d", lambda x: x["key"]) for t in taken]) if taken else F.array().cast("array<string>")
        df = df.withColumns({"__keyed": keyed, "__before": before})
        fresh = F.filter("__keyed", lambda x: ~F.array_contains(F.col("__before"), x["key"]))
        df = text.distinct_by_key(df, f"__{name}_d", fresh)
        df = df.withColumn(f"__{name}_d", F.slice(f"__{name}_d", 1, SECTION_CAPS[name]))
        taken.append(name)
    df = df.withColumns({n: F.transform(f"__{n}_d", lambda x: x["text"]) for n in ("facts", "impact", "watch")})
    df = df.withColumns(
        {
            "background": text.fitting(F.transform("__background_d", lambda x: x["text"]), BACKGROUND_CHARS),
            "background_count": F.size("__background_d"),
        }
    )
    return df.drop("background_points", "__before", "__keyed", *[f"__{n}{s}" for n in given for s in ("", "_c", "_d")])


def notes_map(members: Column) -> Column:
    return F.map_from_entries(F.transform(members, lambda m: F.struct(m["id"].alias("key"), m["note"].alias("value"))))


DRAFT = (
    "edition_id draft_no candidate_ids publishers title dek summary why_it_matters category importance tags facts impact "
    "background watch source_notes article_type desk_lens event_keys"
).split()


def individual_drafts(chosen: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """One brief per chosen cluster row (`pick` is its order)."""
    lead = F.col("lead")
    df = text.clip_title(chosen, "__title", lead["safe_title"], 120)
    generic = F.concat(lead["source_name"], F.lit("が報じた"), lead["category"], F.lit("ニュース"))
    df = df.withColumn("title", F.when(text.readable(F.col("__title"), profile), F.col("__title")).otherwise(generic))
    df = text.distinct_by_key(df, "detail", merged(F.col("members"), "sentences"))
    df = with_sections(df, "__c", "detail", profile)
    df = text.excerpt(df, "__summary", F.array_join(F.transform("detail", lambda s: s["text"]), " "), 280, profile)
    df = df.withColumn("summary", text.safe_sentences(F.col("__summary"), 420, profile))
    classified = F.col("__c")
    df = df.withColumns(
        {
            **{n: in_section(classified, n, SECTION_CAPS[n]) for n in POINT_SECTIONS},
            "background_points": in_section(classified, "background", SECTION_CAPS["background"]),
        }
    )
    first = F.coalesce(*[F.get(n, F.lit(0)) for n in ("impact", "facts", "watch")], F.lit(""))
    df = df.withColumn("dek", text.safe_sentences(first, 140, profile))
    df = exclusive_sections(df)
    return df.withColumns(
        {
            "draft_no": F.col("pick"),
            "candidate_ids": F.transform(F.array_sort(F.transform("members", lambda m: F.struct(m["pos"], m["id"]))), lambda x: x["id"]),
            "why_it_matters": F.lit(""),
            "category": lead["category"],
            "tags": F.array(lead["category"]),
            "source_notes": notes_map(F.col("members")),
            "article_type": F.lit("brief"),
            "desk_lens": F.lit(""),
            "event_keys": F.array().cast("array<string>"),
        }
    ).select(*DRAFT)


def event_summary(sentences: Column, limit: int = 420, most: int = 8, enough: int | Column = 100) -> Column:
    """Leading sentences until their keys hold `enough` characters, at most eight and within the limit."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("keys"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(acc, s):
        over = acc["done"] | (acc["n"] >= most) | (F.length(acc["text"]) + F.length(s["text"]) > limit)
        keys = acc["keys"] + F.length(s["key"])
        stop = F.struct(acc["text"].alias("text"), acc["keys"].alias("keys"), acc["n"].alias("n"), F.lit(True).alias("done"))
        more = F.struct(
            F.concat(acc["text"], s["text"]).alias("text"), keys.alias("keys"), (acc["n"] + 1).alias("n"), (keys >= enough).alias("done")
        )
        return F.when(over, stop).otherwise(more)

    return F.aggregate(sentences, start, step, lambda acc: F.trim(acc["text"]))


def key_chars(keyed: Column) -> Column:
    return F.aggregate(keyed, F.lit(0), lambda acc, s: acc + F.length(s["key"]))


def feature_drafts(rows: DataFrame, profile: Profile = JAPANESE, most: int = MAX_FEATURES) -> DataFrame:
    """The best qualified features of each edition from same-event cluster rows (members carry points and notes)."""
    members, lead = F.col("members"), F.col("lead")
    df = rows.filter(F.col("any_fresh") & sourced(members))  # before the work on texts, below which Spark moves no condition
    df = text.distinct_by_key(df, "detail", merged(members, "natural"))
    df = df.withColumns({n: merged(members, f"point_{n}") for n in POINT_SECTIONS} | {"background_points": merged(members, "point_background")})
    df = exclusive_sections(df)
    start = F.array_min(F.transform(members, lambda m: m["published_at"]))
    end = F.array_max(F.transform(members, lambda m: m["published_at"]))
    shown = "M'月'd'日' HH:mm"
    until = F.concat(F.date_format(slots.local(end), shown), F.lit("更新。"))
    scope = F.when(start != end, F.concat(F.date_format(slots.local(start), shown), F.lit("〜"), until)).otherwise(until)
    opening = F.concat(scope, F.coalesce(F.get("detail", F.lit(0))["text"], F.lit("")))
    official = F.get(F.filter(F.transform(members, lambda m: m["bulletin_dek"]), lambda d: d.isNotNull()), F.lit(0))
    df = df.withColumn("__official", F.coalesce(official, F.lit("")))
    df = text.complete_text(df, "__opening", opening, 220, profile)
    df = df.withColumn("dek", F.when(F.col("__official") != "", F.col("__official")).otherwise(F.col("__opening")))

    own_chars = F.length(F.regexp_replace("__official", text.NON_WORD, ""))
    told = F.filter(
        "impact",
        lambda p: ~(F.contains(p, F.lit("津波")) & F.contains(F.col("__official"), F.lit("津波"))) & ~F.contains(F.col("__official"), p),
    )
    told = F.transform(told, lambda p: F.struct(p.alias("text"), F.regexp_replace(p, text.NON_WORD, "").alias("key")))
    rest = event_summary(told, 420, SECTION_CAPS["impact"], F.greatest(F.lit(100) - own_chars, F.lit(1)))
    df = text.complete_text(df, "__official_summary", F.concat("__official", rest), 420, profile)
    summary = F.when(F.col("__official") != "", F.col("__official_summary")).otherwise(event_summary(F.col("detail")))
    df = df.withColumn("summary", summary)

    signatures = F.array_distinct(F.filter(F.transform(members, lambda m: m["signature"]), lambda s: s != ""))
    event_key = F.when(F.size(signatures) == 1, F.get(signatures, F.lit(0))).otherwise(lead["title_key"])
    df = text.clip_title(df, "title", lead["safe_title"], 120)
    category = modal_category(members, lead)
    df = df.withColumns(
        {
            "candidate_ids": F.transform(members, lambda m: m["id"]),
            "why_it_matters": F.lit(""),
            "category": category,
            "tags": F.array(category),
            "source_notes": notes_map(members),
            "article_type": F.lit("feature"),
            "desk_lens": F.lit("event"),
            "event_keys": F.array(event_key),
            "detail_chars": key_chars(F.col("detail")),
        }
    )
    df = qualified(df, profile)
    order = Window.partitionBy("edition_id").orderBy(
        F.desc("importance"), F.desc("detail_chars"), F.desc(F.size("candidate_ids")), F.desc("any_fresh"), F.desc("max_published_at"), "cluster"
    )
    return df.withColumn("draft_no", F.row_number().over(order)).filter(F.col("draft_no") <= most).select(*DRAFT)


def sourced(members: Column) -> Column:
    """A primary source with sentences, or two publishers with much to say."""
    rich = F.filter(members, lambda m: key_chars(m["sentences"]) >= FEATURE_RICH_SOURCE_CHARS)
    rich_publishers = F.size(F.array_distinct(F.transform(rich, lambda m: m["publisher"])))
    primary = F.exists(members, lambda m: m["primary_source"] & (F.size(m["sentences"]) > 0))
    return primary | (rich_publishers >= 2)


def qualified(df: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """Features with enough grounded, independent and natural material."""
    members = F.col("members")
    bulletin = F.exists(members, lambda m: m["structured_bulletin"])
    points = F.concat("facts", "impact", F.filter(F.array("background"), lambda b: b != ""), "watch")
    df = df.withColumn("__grounded", F.array_join(points, " "))
    df = df.withColumns({"__grounded": text.point_key_of("__grounded"), "__summary_key": text.point_key_of("summary")})
    count = F.size("facts") + F.size("impact") + F.col("background_count") + F.size("watch")
    copy = F.concat_ws(" ", "title", "dek", "summary", F.array_join(points, " "))
    return df.filter(
        F.col("any_fresh")
        & sourced(members)
        & ((F.col("detail_chars") >= FEATURE_MIN_CHARS) | bulletin)
        & (count >= FEATURE_MIN_POINTS)
        & ((F.length("__grounded") >= FEATURE_MIN_CHARS) | bulletin)
        & (F.length("__summary_key") >= FEATURE_SUMMARY_CHARS)
        & ~copy.rlike("(?U)" + forbidden_copy(profile.site_name))
    ).drop("__grounded", "__summary_key")


def edited(described: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """Described candidates with the columns drafts need."""
    df = feature_points(described, profile)
    df = bulletin_dek(df, "bulletin_dek", profile)
    df = df.withColumn("structured_bulletin", is_structured_bulletin(profile))
    return source_note(df, "note", profile)


EDITED = "natural point_facts point_impact point_background point_watch bulletin_dek structured_bulletin note".split()


#: Fields of members that features and briefs read.
FEATURE_FIELDS = "id safe_title title_key publisher desk signature published_at primary_source sentences".split()
BRIEF_FIELDS = "pos id safe_title source_name category priority published_at sentences".split()
#: Columns of edited candidates that `build_drafts` reads.
DRAFTED_FROM = list(dict.fromkeys([*CLUSTERING, "grounded", *FEATURE_FIELDS, *BRIEF_FIELDS, *EDITED]))


def chosen_clusters(fresh: DataFrame, extra: Sequence[str] = ("note",), fields: Sequence[str] = BRIEF_FIELDS) -> DataFrame:
    """Cluster rows of the fresh candidates with `pick`, the diverse selection."""
    rows = ordered_clusters(cluster_rows(event_clusters(fresh), extra, fields))
    lead = F.col("lead")
    rows = rows.withColumns({"category": lead["category"], "lead_priority": lead["priority"], "lead_at": lead["published_at"]})
    return select_diverse(rows)


def build_drafts(fresh: DataFrame, pool: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """Drafts of each edition in order (`position`): qualified features of the pool, then individual briefs.

    `fresh` and `pool` are limited, described and `edited`, with `pos` and `lead_order`; the pool adds context.
    """
    events = cut_lineage(cluster_rows(feature_clusters(pool), EDITED, FEATURE_FIELDS))
    chosen = cut_lineage(chosen_clusters(fresh))
    features = cut_lineage(feature_drafts(events, profile))
    return fill_with_individuals(features, cut_lineage(individual_drafts(chosen, profile)))
