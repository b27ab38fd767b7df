"""Classes of characters written as ranges find what the plain classes find, and proposals' texts are judged once."""

import re

import pytest
from pyspark.sql import functions as F

from tidewire.functions import text
from tidewire.functions.profiles import JAPANESE, LATIN
from tidewire.operators import gates
from tidewire.plans import fixtures
from tidewire.sources import tables

AWKWARD = [
    "", ".", "..", "a", "a.", ".a", "a..b!?c", " . a", "「一。」二。三", "x\U0001f600.y\U0001f600", "é。ü！ß？", "a\u3001b\u3003c", "\uff00.\uff02!\uff1e?\uff20", "\x00.\x7f",
]


@pytest.mark.parametrize("profile", [JAPANESE, LATIN])
def test_ranges_find_what_a_plain_class_finds(spark, profile):
    stops = profile.terminators
    df = spark.createDataFrame([(s,) for s in AWKWARD], "s string")
    found = df.select("s", text.pieces(F.col("s"), profile).alias("p"), text.begun_pieces(F.col("s"), profile).alias("b"), text.ends_in_stop(F.col("s"), profile).alias("e"))
    for row in found.collect():
        wanted = [p.strip(" ") for p in re.findall(f"[^{stops}]*[{stops}]|[^{stops}]+", row["s"])]
        assert row["p"] == [p for p in wanted if p]
        assert row["b"] == re.findall(f"[^{stops}]+[{stops}]?", row["s"])
        assert row["e"] == bool(re.search(f"[{stops}]$", row["s"]))


def test_no_class_is_a_negated_list():
    for chars in (text.BRACKET_CHARS, JAPANESE.terminators, LATIN.terminators):
        others = text.one_of(chars, other=True)
        assert "^" not in others
        assert not re.search(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{int(m[1], 16):08x}", others), chars)
    assert text.one_of("") == "[]" and text.one_of("", other=True) == r"[\x{0}-\x{10ffff}]"


def test_only_characters_that_a_normal_form_changes_go_to_python(spark):
    rows = [chr(n) for n in range(1, 0x180)] + ["Straße", "ÀÉÎÕÜ çñ", "e\u0301", "A\u030a", "ﬁ Ⅷ", "İıſK", "Σας"]
    df = spark.createDataFrame([(s, [s, "x" + s]) for s in rows], "s string, a array<string>")
    found = df.select("s", text.nfkc_of("s").alias("w"), text.nfkc_fold_of("s").alias("f"), text.nfkc_items_of("a").alias("v"), text.nfkc_fold_items_of("a").alias("g"))
    for row in found.collect():
        s = row["s"]
        assert [row["w"], row["f"], row["v"], row["g"]] == [text.wide(s), text.fold(s), [text.wide(s), text.wide("x" + s)], [text.fold(s), text.fold("x" + s)]], repr(s)
    assert not re.search(text.COMPOSED.replace(r"\x{100}-\x{10FFFF}", "\u0100-\U0010ffff"), "ÀÉÎÕÜçñß")


def test_squash_evens_every_run_of_white_space(spark):
    rows = ["a b", "a  b", "a \n b", "\ta\u3000\u00a0b ", "\n", " ", "a\r\nb", "a\u2028 b c  d"]
    df = spark.createDataFrame([(s,) for s in rows], "s string")
    for row in df.select("s", text.squash(F.col("s")).alias("t")).collect():
        assert row["t"] == " ".join(row["s"].replace("\r", "").split())


def test_title_and_summary_of_a_proposal_are_judged_once(spark):
    rows = tables.with_edition(tables.candidates(spark, "/root/testdata/sf0.001"))
    none = F.array().cast("array<struct<text: string, key: string, section: string>>")
    described = rows.select("*", F.col("publisher_id").alias("publisher"), none.alias("classified"), none.alias("sentences"), F.lit(0).alias("field_count"))
    out = gates.validated_drafts(fixtures.proposals(rows), described, LATIN, None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ignore|disregard") <= 5  # title, summary, background, dek, why
