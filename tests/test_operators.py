import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewire.functions.profiles import JAPANESE
from tidewire.functions.text import likeness
from tidewire.operators import clusters, dedup, drafts, enrich, selection, viewer, windows
from tidewire.sources import state

T0 = dt.datetime(2026, 8, 15, 0, 0)

BULLETIN = """<Notice xmlns="urn:test"><Control><Title>震源・震度の知らせ</Title></Control><Head><Title>震源・震度の知らせ</Title>
<EventID>試験-77</EventID><Serial>5</Serial><Headline><Text>沿岸で弱い揺れが続いています。</Text></Headline></Head>
<Body><Earthquake><OriginTime>2031-02-03T21:45:00+09:00</OriginTime><Hypocenter><Area><Name>青葉湾沖</Name></Area></Hypocenter>
<Magnitude description="Ｍ６．１">6.1</Magnitude></Earthquake>
<Intensity><Observation><MaxInt>5+</MaxInt></Observation></Intensity></Body></Notice>"""


def candidates(spark, rows):
    """rows: (id, title, description, publisher, category, minutes, priority, primary)"""
    data = [
        (f"{i}", t, d, f"https://{p}.example.com/{i}", p, p, c, T0 + dt.timedelta(minutes=m), pr, prim, False, "", n, "2026-08-15-12")
        for n, (i, t, d, p, c, m, pr, prim) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        "id string, title string, description string, url string, source_name string, publisher_id string, category string, "
        "published_at timestamp_ntz, priority int, primary_source boolean, context_only boolean, origin_edition_id string, "
        "ord long, edition_id string",
    )


def test_bulletin_parts(spark):
    df = spark.createDataFrame([(BULLETIN, "震源・震度の知らせ"), ("<!DOCTYPE x><Report/>", ""), ("<broken", "")], "xml string, product_title string")
    rows = [r["bulletin"] for r in enrich.extract_bulletins(df).collect()]
    assert rows[1] is None and rows[2] is None
    b = rows[0]
    assert b["event_id"] == "試験-77" and b["serial"] == "5" and b["max_intensity"] == "5+"
    assert "青葉湾沖" in b["title"] and "M6.1" in b["title"]
    assert all(part in b["description"] for part in ("青葉湾沖", "2031-02-03T21:45:00+09:00", "沿岸で弱い揺れが続いています"))


def test_page_detail_reads_the_article_only(spark):
    page = (
        "<nav><p>案内</p></nav><main><article><p>見出し</p><script>x()</script><p>本文の一段落目です。</p><ul><li>項目です。</li></ul>"
        "<aside><p>関連</p></aside><p>本文の一段落目です。</p><p>お問い合わせ先 係</p></article></main><footer><p>著作権</p></footer>"
    )
    df = spark.createDataFrame([(page, "見出し")], "html string, title string")
    assert enrich.extract_pages(df).first()["detail"] == "本文の一段落目です。 項目です。"


def test_latest_bulletin_prefers_time_then_serial_then_richness(spark):
    rows = [("jma", "e1", "1", 10, 5, 1), ("jma", "e1", "2", 10, 1, 2), ("jma", "e1", "9", 5, 9, 3), ("other", "e1", "1", 1, 1, 4)]
    df = spark.createDataFrame(
        [(p, e, s, T0 + dt.timedelta(minutes=m), r, o) for p, e, s, m, r, o in rows],
        "publisher string, event_id string, serial string, published_at timestamp_ntz, richness int, ord int",
    )
    got = enrich.latest_per_event(df, F.col("publisher"), F.lit("")).select("ord").collect()
    assert sorted(r["ord"] for r in got) == [2, 4]


@pytest.mark.parametrize("rank, minimum, identity, kept", [(2.0, 3.0, "x", False), (3.0, 3.0, "x", True), (None, 3.0, "x", True), (1.0, 3.0, "津波情報", True)])
def test_severity(spark, rank, minimum, identity, kept):
    df = spark.createDataFrame([(rank, minimum, identity)], "r double, m double, i string")
    assert df.select(enrich.severe_enough(F.col("r"), F.col("m"), F.col("i"), F.lit("(?iU)津波")).alias("k")).first()["k"] is kept


def test_seen_titles_equal_brute_force(spark):
    rows = [(f"c{i}", f"大雨で川が増水し{i % 5}人が避難した", "", "p", "社会", i * 100, 3, i % 7 == 0) for i in range(30)]
    df = candidates(spark, rows)
    stories = spark.createDataFrame(
        [(i, "e", f"大雨で川が増水し{i}人が避難した", T0 + dt.timedelta(hours=i * 20), [f"https://p.example.com/c{i}"]) for i in range(4)], state.STORY
    )
    got = {r["id"] for r in dedup.filter_seen(df, stories).select("id").collect()}
    history = stories.collect()

    def seen(r):
        if any(r["url"] in s["urls"] for s in history):
            return True
        near = [s for s in history if abs(r["published_at"] - s["published_at"]) <= dt.timedelta(hours=36)]
        return not r["primary_source"] and any(likeness(r["title"], s["title"]) >= 0.86 for s in near)

    assert got == {r["id"] for r in df.collect() if not seen(r)}
    assert 0 < len(got) < 30


def test_seen_titles_of_many_editions_know_earlier_ones_only(spark):
    titles = [f"大雨で川が増水し{i % 3}人が避難した" if i % 4 else f"動物園でパンダが誕生{i}" for i in range(60)]
    rows = [(f"c{i}", title, "", "p", "社会", i * 100, 3, i % 7 == 0) for i, title in enumerate(titles)]
    df = candidates(spark, rows).withColumn("edition_id", F.date_format("published_at", "yyyy-MM-dd-HH"))
    stories = spark.createDataFrame(
        [(i, f"{at:%Y-%m-%d-%H}", f"大雨で川が増水し{i % 4}人が避難した", at, [f"https://p.example.com/{'s' if i % 10 else 'c'}{i}"])
         for i in range(400) for at in [T0 + dt.timedelta(minutes=37 * (i - 200))]], state.STORY)
    got = {r["id"] for r in dedup.filter_seen(df, stories, "edition_id").select("id").collect()}
    history = stories.collect()

    def seen(r):
        earlier = [s for s in history if s["edition_id"] < r["edition_id"]]
        near = [s for s in earlier if abs(r["published_at"] - s["published_at"]) <= dt.timedelta(hours=36)]
        same = any(r["url"] in s["urls"] for s in earlier)
        return same or not r["primary_source"] and any(likeness(r["title"], s["title"]) >= 0.86 for s in near)

    assert got == {r["id"] for r in df.collect() if not seen(r)}
    assert 0 < len(got) < 60


def test_limiter_respects_publisher_cap_and_reserves_publishers(spark):
    rows = [(f"a{i}", f"大きな発表その{i}", "", "big", "国内", i, 5, False) for i in range(40)]
    rows += [(f"b{i}", f"小さな発表その{i}", "", f"small{i}", "海外", i, 1, False) for i in range(3)]
    got = selection.limit_candidates(candidates(spark, rows)).orderBy("pos").collect()
    assert [r["source_name"] for r in got].count("big") == 6
    assert {r["source_name"] for r in got} == {"big", "small0", "small1", "small2"}
    assert got[0]["id"] == "a39"


def test_clusters_and_importance(spark):
    rows = [
        ("1", "首相が経済対策を発表", "首相は対策を発表した。", "a", "国内", 0, 3, False),
        ("2", "首相が経済対策を発表へ", "首相は対策を発表した。詳細は今後示す見通しだ。", "b", "国内", 5, 4, False),
        ("3", "動物園でパンダが誕生", "", "c", "社会", 9, 2, False),
        ("4", "首相が経済対策を発表", "", "d", "海外", 9, 2, False),
    ]
    df = candidates(spark, rows).withColumn("pos", F.col("ord").cast("int"))
    described = clusters.lead_ordered(clusters.described(df))
    got = {r["lead"]["id"]: r for r in clusters.cluster_rows(clusters.event_clusters(described)).collect()}
    assert sorted(got) == ["2", "3", "4"]
    assert sorted(m["id"] for m in got["2"]["members"]) == ["1", "2"]
    assert got["2"]["importance"] == 5 and got["3"]["importance"] == 2  # half to even 4, two publishers, an alert word
    chosen = drafts.individual_drafts(drafts.chosen_clusters(clusters.lead_ordered(drafts.edited(clusters.described(df)))))
    first = chosen.filter(F.array_contains("candidate_ids", "2")).first()
    assert first["watch"] == ["詳細は今後示す見通しだ。"] and first["facts"] == ["首相は対策を発表した。"]


def test_bulletin_prose(spark):
    df = spark.createDataFrame([("最大震度: 5強。",), ("震度5強: 石川県。",), ("発生時刻: 2026-08-15T10:12:34+09:00。",), ("*印は気象庁以外の震度観測点です。",), ("普通の文。",)], "s string")
    got = [r["o"] for r in df.select(drafts.natural(F.col("s")).alias("o")).collect()]
    assert got == ["最大震度は5強です。", "石川県で震度5強を観測しました。", "発生時刻は8月15日10時12分です。", "", "普通の文。"]


def test_missing_windows(spark):
    at = lambda d, h: dt.datetime(2026, 8, d, h)
    rows = [("gap", at(14, 18), at(15, 18)), ("none", None, at(15, 12)), ("done", at(15, 12), at(15, 12)), ("off", at(15, 7), at(15, 12))]
    df = spark.createDataFrame(rows, "k string, mark timestamp_ntz, target timestamp_ntz")
    got: dict[str, list[str]] = {}
    for r in windows.missing_windows(df, "mark", "target", 9).orderBy("k", "run_order").collect():
        got.setdefault(r["k"], []).append(r["edition_id"])
    assert got == {"gap": ["2026-08-15-06", "2026-08-15-12", "2026-08-15-18"], "none": ["2026-08-15-12"], "off": ["2026-08-15-12"]}


def test_reading_aids(spark):
    df = spark.createDataFrame([("A社は「見出し」と報じました。本文です。",)], "s string")
    row = df.select(viewer.editorial_text(F.col("s"), F.lit("見出し")).alias("e"), viewer.brief_text(F.col("s")).alias("b")).first()
    assert row["e"] == "本文です。" and row["b"] == "本文です。"


def test_injected_profile_is_plain_data():
    assert JAPANESE.terminators == "。！？!?"
