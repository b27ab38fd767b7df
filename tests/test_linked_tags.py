"""Linked pages with required detail, tags and bracket titles, repeats in reading texts, lists of articles, used ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.profiles import LATIN
from tidewire.operators import dedup, enrich, selection, viewer
from tidewire.sources import entries


def test_required_page_detail_drops_and_optional_detail_keeps_the_summary(spark):
    rows = [
        ("a", "long and required", 10, True), ("b", "short and required", 10, True), ("c", "short and optional", 10, False),
        ("d", "missing and required", 0, True), ("e", "missing and optional", 0, False),
    ]
    candidates = spark.createDataFrame(rows, "url string, description string, linkedHtmlMinimumChars int, linkedHtmlRequired boolean")
    pages = spark.createDataFrame([("a", "ten letters"), ("b", "few"), ("c", "few"), ("x", "of nobody at all")], "url string, detail string")
    out = {r.url: r.description for r in enrich.page_candidates(candidates, pages).collect()}
    assert out == {"a": "ten letters", "c": "short and optional", "e": "missing and optional"}
    assert enrich.page_candidates(candidates, pages).columns == ["url", "description"]


def test_tags_are_split_folded_and_decide_the_category(spark):
    rows = [(1, ["misc, サイエンス、x", "x"]), (2, ["ＩＴ・デジタル"]), (3, []), (4, None), (5, [" ", "local"])]
    df = spark.createDataFrame(rows, "n int, tags array<string>").withColumns({"title": F.lit("plain"), "description": F.lit("words"), "own": F.lit("国内")})
    df = entries.tag_values(df, "values", F.col("tags"))
    df = entries.inferred_category(df, "category", F.col("title"), F.col("description"), "values", F.col("own"), LATIN)
    out = {r.n: (r["values"], r.category) for r in df.collect()}
    assert out == {1: (["misc", "サイエンス", "x"], "科学"), 2: (["ＩＴ・デジタル"], "テクノロジー"), 3: ([], "国内"), 4: ([], "国内"), 5: (["local"], "国内")}


def test_an_excluded_tag_wins_over_an_included_one(spark):
    rows = [(1, ["a"], ["a"], []), (2, ["a", "b"], ["a"], ["b"]), (3, [], ["a"], []), (4, [], [], ["b"]), (5, ["c"], [], [])]
    df = spark.createDataFrame(rows, "n int, tags array<string>, include array<string>, exclude array<string>")
    assert {r.n for r in df.filter(entries.tags_pass(F.col("tags"), F.col("include"), F.col("exclude"))).collect()} == {1, 4, 5}


def test_bracket_titles(spark):
    rows = [("【 A title 】 and text",), ("text 【late】",), ("【】empty",), ("【" + "x" * 181 + "】",)]
    df = spark.createDataFrame(rows, "d string").select(entries.bracket_title(F.col("d")).alias("t"))
    assert [r.t for r in df.collect()] == ["A title", "", "", ""]


def test_sentences_said_before_are_left_out(spark):
    said = ["The harbour was closed for the night。"]
    rows = [
        (1, "The harbour was closed for the night。", said),  # the whole text
        (2, "The harbour was closed for the night。A ferry leaves at dawn tomorrow with all who waited through it。", said),  # one sentence
        (3, "A ferry leaves at dawn。Nobody waits。", said),  # nothing
        (4, "the night。A ferry leaves at dawn tomorrow with all who waited through it。", said),  # a short sentence inside
        (5, "", said), (6, None, said), (7, "Alone。", []), (8, "The harbour was closed for the night。", [""]),
    ]
    df = spark.createDataFrame(rows, "n int, t string, r array<string>")
    out = {r.n: r.fresh for r in viewer.distinct_content(df, "fresh", F.col("t"), F.col("r")).collect()}
    ferry = "A ferry leaves at dawn tomorrow with all who waited through it。"
    assert out.pop(6) in (None, "")
    assert out == {1: "", 2: ferry, 3: rows[2][1], 4: ferry, 5: "", 7: "Alone。", 8: rows[7][1]}


def test_known_shares_follow_the_definition(spark):
    rows = [(["abcd", "ab", "", "xyz"], ["zabc", "ab"])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert df.select(text.known_shares(F.col("a"), F.col("b")).alias("s")).first().s == [0.5, 1.0, 0.0, 0.0]


def test_articles_stand_once_by_id_or_folded_title(spark):
    rows = [("e", 1, "x", "One"), ("e", 2, "x", "Other"), ("e", 3, None, "A  Title"), ("e", 4, "", "a title"), ("f", 1, "x", "One")]
    df = spark.createDataFrame(rows, "edition_id string, position int, id string, title string")
    assert {(r.edition_id, r.position) for r in dedup.distinct_articles(df).collect()} == {("e", 1), ("e", 3), ("f", 1)}


def test_a_draft_with_a_used_candidate_is_passed_over_and_preferred_drafts_come_first(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [
        ("e", 0, ["p"], ["a", "b"], "x", 5, 1, at, False), ("e", 1, ["q"], ["b", "c"], "x", 4, 1, at, False),
        ("e", 2, ["r"], ["c"], "x", 1, 1, at, True), ("e", 3, [], ["z"], "x", 9, 1, at, True),
    ]
    df = spark.createDataFrame(
        rows, "edition_id string, place int, publishers array<string>, ids array<string>, category string, importance int, lead_priority int, lead_at timestamp_ntz, preferred boolean"
    )
    out = selection.select_diverse(df, "ids", "preferred").orderBy("pick").collect()
    assert [(r.place, r.pick) for r in out] == [(2, 1), (0, 2)]
