"""Linked official documents: detail text, severity, and one bulletin per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.markup import html_blocks, parsed_bulletin
from tidewire.functions.profiles import BULLETIN_PUBLISHER, INTENSITY_DISPLAY, INTENSITY_RANKS
from tidewire.operators.dedup import first_per_key
from tidewire.sources.registry import text_passes

# fixed values: page boilerplate, share buttons, bare labels, bulletin product words
BOILERPLATE = (
    r"(?iU)^(?:お?問い合わせ先|お?問合せ先|連絡先|電話\s*[:：]|TEL\s*[:：]|FAX\s*[:：]|〒\d{3}|PDF形式のファイル|"
    r"このページの先頭へ|ページトップへ|シェアする|番組放送後|配信期間は|放送日\s|再生時間\s|配信終了予定日\s|"
    r"音声が再生されない場合|動画が表示されない場合)"
)
SHARE_BUTTONS = r"(?iU)^(?:プレスリリース\s*)?(?:(?:X\s*ポスト|Tweet|印刷)\s*)+"
BARE_LABELS = r"^(?:別紙|関連資料|参考資料|添付資料|概要)$"
QUAKE_PRODUCT = r"震源|震度|地震"
OTHER_PRODUCT = r"津波|噴火|火山"
FULL_PRODUCT = r"震源・震度"
SEA = r"津波|海面変動"
STOPS = "。！？!?"


def intensity_rank(c: Column) -> Column:
    """0..7 in half steps; null for anything that is not an intensity."""
    known = F.create_map(*[F.lit(x) for pair in INTENSITY_RANKS.items() for x in pair])
    return F.element_at(known, text.squash(c, 20))


def intensity_display(c: Column) -> Column:
    shown = F.create_map(*[F.lit(x) for pair in INTENSITY_DISPLAY.items() for x in pair])
    return F.coalesce(F.element_at(shown, c), c)


def magnitude_display(c: Column) -> Column:
    """M<number> of an already NFKC upper-case magnitude text, else the text."""
    number = F.regexp_extract(c, r"(?U)M?\s*([0-9]+(?:\.[0-9]+)?)", 1)
    return F.when(number != "", F.concat(F.lit("M"), number)).otherwise(F.rtrim(F.substring(c, 1, 30)))


def join_details(df: DataFrame, out: str, values: Column, limit: int = 900) -> DataFrame:
    """Distinct detail texts, each ended by a stop, joined while they fit."""
    raw, folded = f"__{out}_v", f"__{out}_f"
    df = df.withColumn(raw, F.filter(F.transform(values, lambda v: text.squash(v, 500)), lambda v: v != ""))
    df = text.nfkc_fold_items(df, folded, F.col(raw))
    keyed = F.zip_with(raw, folded, lambda t, k: F.struct(t.alias("text"), k.alias("key")))
    df = text.distinct_by_key(df, raw, keyed)
    ended = F.transform(raw, lambda x: F.when(x["text"].rlike(f"[{STOPS}]$"), x["text"]).otherwise(F.concat(x["text"], F.lit("。"))))
    return df.withColumn(out, text.fitting(ended, limit)).drop(raw, folded)


def _some(values: Column, most: int, width: int = 500) -> Column:
    cleaned = F.transform(values, lambda v: text.squash(v, width))
    return F.slice(F.array_distinct(F.filter(cleaned, lambda v: v != "")), 1, most)


def extract_bulletins(df: DataFrame, xml: str = "xml", product: str = "product_title") -> DataFrame:
    """Add `bulletin`: struct<title, description, product_title, max_intensity, event_id, serial>, null when unreadable.

    `product` is the column with the title of the feed entry that linked the document.
    """
    df = df.withColumn("__p", parsed_bulletin(F.col(xml)))
    p, given = F.col("__p"), text.squash(F.coalesce(F.col(product), F.lit("")), 180)
    named = F.coalesce(F.nullif(text.squash(p["head_title"], 180), F.lit("")), F.nullif(text.squash(p["control_title"], 180), F.lit("")), given)
    df = df.withColumns(
        {
            "__product": named,
            "__origin": text.squash(p["origin_time"], 180),
            "__place": text.squash(p["hypocenter"], 100),
            "__max": text.squash(p["max_intensity"], 180),
            "__value": text.squash(p["magnitude"], 500),
            "__note": text.squash(p["magnitude_note"], 40),
            "__headlines": _some(p["headlines"], 4),
            "__texts": _some(p["texts"], 8),
        }
    )
    identity = F.concat_ws(" ", given, F.col("__product"))
    df = df.withColumn("__quake", identity.rlike(QUAKE_PRODUCT) & ~identity.rlike(OTHER_PRODUCT))
    df = text.nfkc(df, "__mag", F.coalesce(F.nullif("__value", F.lit("")), F.col("__note")))
    df = df.withColumn("__mag", magnitude_display(F.upper(F.trim("__mag"))))
    df = df.withColumn("__shown", intensity_display(F.col("__max")))

    parts = F.concat_ws(
        " ",
        F.concat("__place", F.lit("で地震")),
        F.nullif("__mag", F.lit("")),
        F.when(F.col("__shown") != "", F.concat(F.lit("最大震度"), "__shown")),
    )
    told = (F.col("__value") != "") | (F.col("__max") != "")
    first_headline = F.regexp_extract(text.squash(F.get("__headlines", F.lit(0)), 200), f"^[^{STOPS}]*[{STOPS}]?", 0)
    title = (
        F.when(F.col("__quake") & (F.col("__place") != "") & told, text.squash(parts, 100))
        .when(F.col("__product") != "", text.squash(F.col("__product"), 100))
        .otherwise(F.coalesce(text.squash(first_headline, 100), F.lit("")))
    )
    shown_magnitude = F.coalesce(F.nullif("__note", F.lit("")), F.when(F.col("__value") != "", F.concat(F.lit("M"), "__value")), F.lit(""))
    labelled = [
        F.when(value != "", F.concat(F.lit(label), value))
        for label, value in (
            ("発生時刻: ", F.col("__origin")),
            ("震央・震源地域: ", F.col("__place")),
            ("マグニチュード: ", shown_magnitude),
            ("最大震度: ", F.col("__shown")),
        )
    ]

    def names(values: Column) -> Column:
        return F.array_join(F.array_distinct(F.filter(F.transform(values, lambda v: text.squash(v, 180)), lambda v: v != "")), "、")

    items = F.transform(
        p["items"],
        lambda i: F.struct(
            names(i["kinds"]).alias("kinds"),
            names(i["areas"]).alias("areas"),
            text.squash(i["height"], 80).alias("height"),
            text.squash(i["arrival"], 180).alias("arrival"),
            text.squash(i["condition"], 180).alias("condition"),
            i["tsunami"].alias("tsunami"),
        ),
    )
    df = df.withColumn("__items", items)
    areas = F.transform(
        F.filter("__items", lambda i: (i["kinds"] != "") & (i["areas"] != "")), lambda i: F.concat(i["kinds"], F.lit(": "), i["areas"])
    )
    waves = F.transform(
        F.filter("__items", lambda i: i["tsunami"]),
        lambda i: F.concat_ws(
            " / ",
            F.nullif(i["kinds"], F.lit("")),
            F.when(i["areas"] != "", F.concat(F.lit("対象地域 "), i["areas"])),
            F.when(i["height"] != "", F.concat(F.lit("予想される最大波 "), i["height"])),
            F.when(i["arrival"] != "", F.concat(F.lit("到達予想時刻 "), i["arrival"])),
            F.nullif(i["condition"], F.lit("")),
        ),
    )
    nothing = F.array().cast("array<string>")
    sea_first = F.when(F.col("__quake"), F.filter("__texts", lambda t: t.rlike(SEA))).otherwise(nothing)
    details = F.concat(F.array_compact(F.array(*labelled)), sea_first, "__headlines", _some(areas, 8), _some(waves, 8), "__texts")
    details = F.when(F.size(details) > 0, details).otherwise(F.array("__product"))
    df = join_details(df.withColumn("__title", title), "__description", details)
    record = F.struct(
        F.col("__title").alias("title"),
        F.col("__description").alias("description"),
        F.col("__product").alias("product_title"),
        F.col("__max").alias("max_intensity"),
        text.squash(p["event_id"], 180).alias("event_id"),
        text.squash(p["serial"], 180).alias("serial"),
    )
    df = df.withColumn("bulletin", F.when(p.isNotNull(), record))
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def severe_enough(rank: Column, minimum: Column, identity: Column, exempt: Column) -> Column:
    """Below the minimum only an exempt product passes; an unknown rank or no minimum passes."""
    return ~F.coalesce(rank < minimum, F.lit(False)) | F.coalesce(F.rlike(identity, exempt), F.lit(False))


def bulletin_candidates(linked: DataFrame) -> DataFrame:
    """Candidates rewritten from their bulletin, with event id, serial and richness.

    `linked` has the candidate columns, `bulletin`, and the feed's `linkedXmlIncludePatterns`,
    `linkedXmlExcludePatterns`, `minimumMaxIntensity`, `minimumMaxIntensityExemptPatterns`.
    """
    b = F.col("bulletin")
    detail = F.concat_ws(" ", F.nullif(b["title"], F.lit("")), b["description"])
    identity = F.concat_ws(" ", "product_title", b["product_title"], "title")
    kept = linked.filter(b.isNotNull() & (b["description"] != "")).filter(
        text_passes(detail, F.col("linkedXmlIncludePatterns"), F.col("linkedXmlExcludePatterns"))
        & severe_enough(
            intensity_rank(b["max_intensity"]),
            intensity_rank(F.col("minimumMaxIntensity")),
            identity,
            F.col("minimumMaxIntensityExemptPatterns"),
        )
    )
    richness = (
        F.length(b["description"])
        + F.when(b["title"].rlike(r"(?U)\bM[0-9]"), 300).otherwise(0)
        + F.when(b["max_intensity"] != "", 100).otherwise(0)
        + F.when(b["product_title"].rlike(FULL_PRODUCT), 200).otherwise(0)
    )
    return kept.withColumns(
        {
            "event_id": b["event_id"],
            "serial": b["serial"],
            "richness": richness,
            "title": F.coalesce(F.nullif(b["title"], F.lit("")), "title"),
            "description": b["description"],
        }
    ).drop("bulletin", "linkedXmlIncludePatterns", "linkedXmlExcludePatterns", "minimumMaxIntensity", "minimumMaxIntensityExemptPatterns")


def extract_pages(df: DataFrame, html: str = "html", title: str = "title", root_ids: Column | None = None, limit: int | None = 900, minimum: int = 160) -> DataFrame:
    """Add `detail`: the distinct article paragraphs of an official page, clipped at a sentence end."""
    ids = F.array().cast("array<string>") if root_ids is None else root_ids
    df = df.withColumn("__blocks", html_blocks(F.col(html), ids))
    cleaned = F.transform("__blocks", lambda b: F.trim(F.regexp_replace(text.squash(b, 1500), SHARE_BUTTONS, "")))
    df = df.withColumn("__blocks", F.filter(cleaned, lambda b: (b != "") & ~b.rlike(BOILERPLATE) & ~b.rlike(BARE_LABELS)))
    df = text.normalize_title(df, "__norm", F.col(title))
    df = text.nfkc_items(df, "__wide", F.col("__blocks"))
    df = text.nfkc_fold_items(df, "__fold", F.col("__blocks"))
    as_title = F.transform(
        "__wide", lambda b: F.regexp_replace(F.regexp_replace(F.lower(F.substring(b, 1, 300)), text.TITLE_SUFFIX, ""), text.NON_TITLE, "")
    )
    df = df.withColumn("__as_title", as_title)
    keyed = F.zip_with("__blocks", "__fold", lambda t, k: F.struct(t.alias("text"), F.regexp_replace(k, text.SPACE, "").alias("key")))
    distinct_from_title = F.filter(
        F.zip_with(keyed, "__as_title", lambda x, n: F.struct(x["text"].alias("text"), x["key"].alias("key"), n.alias("norm"))),
        lambda x: (F.col("__norm") == "") | (x["norm"] != F.col("__norm")),
    )
    df = text.distinct_by_key(df, "__kept", distinct_from_title)
    df = df.withColumn("detail", F.array_join(F.transform("__kept", lambda x: x["text"]), " "))
    df = df.drop("__blocks", "__norm", "__wide", "__fold", "__as_title", "__kept")
    if limit is None:
        return df
    clipped = F.substring("detail", 1, limit)
    ended = F.regexp_extract(clipped, "^(.*[。！？])", 1)
    short = F.when(F.length(ended) > minimum, F.rtrim(ended)).otherwise(F.rtrim(clipped))
    return df.withColumn("detail", F.when(F.length("detail") <= limit, F.col("detail")).otherwise(short))


def page_candidates(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates with the page detail as description.

    `pages(url, detail)`; candidates carry `linkedHtmlMinimumChars` and `linkedHtmlRequired`. A missing or short
    detail drops the candidate when it is required and leaves it as it was otherwise.
    """
    joined = candidates.join(pages.select("url", "detail"), "url", "left")
    enough = F.coalesce(F.length("detail") >= F.col("linkedHtmlMinimumChars"), F.lit(False))
    return (
        joined.filter(enough | ~F.col("linkedHtmlRequired"))
        .withColumn("description", F.when(enough, F.col("detail")).otherwise(F.col("description")))
        .drop("detail", "linkedHtmlMinimumChars", "linkedHtmlRequired")
    )


def latest_per_event(records: DataFrame, publisher: Column, title_norm: Column, collapse: str = BULLETIN_PUBLISHER) -> DataFrame:
    """One record per event of the bulletin publisher: newest, then highest serial, then richest.

    Records of other publishers, and those without event id and title, pass through.
    """
    identity = F.when(F.coalesce("event_id", F.lit("")) != "", F.concat(F.lit("event:"), "event_id")).otherwise(
        F.concat(F.lit("title:"), title_norm)
    )
    df = records.withColumn("__event", F.when(publisher == collapse, F.nullif(identity, F.lit("title:"))))
    order = (
        F.col("published_at").desc(),
        F.coalesce(F.expr("try_cast(trim(serial) as int)"), F.lit(-1)).desc(),
        F.col("richness").desc(),
        F.col("ord"),
    )
    collapsed = first_per_key(df.filter(F.col("__event").isNotNull()), ("__event",), order)
    return df.filter(F.col("__event").isNull()).unionByName(collapsed).drop("__event")
