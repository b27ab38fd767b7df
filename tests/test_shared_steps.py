"""Steps that many queries share: bounded batches, work done once, per-edition choices, joins of small groups."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa
from pyspark.sql import functions as F

from tests.test_similarity import variants
from tidewire import session
from tidewire.functions import text
from tidewire.functions.profiles import JAPANESE, LATIN
from tidewire.functions.text import likeness
from tidewire.operators import selection, similarity
from tidewire.sources import tables


def test_reading_a_table_bounds_the_bytes_of_a_batch(spark):
    given = spark.conf.get(session.BATCH_BYTES)
    try:
        spark.conf.set(session.BATCH_BYTES, 64 << 20)
        session.bounded_batches(spark)
        assert spark.conf.get(session.BATCH_BYTES).startswith(str(session.MOST_BYTES))
        spark.conf.set(session.BATCH_BYTES, 1 << 20)
        session.bounded_batches(spark)
        assert spark.conf.get(session.BATCH_BYTES).startswith(str(1 << 20))
    finally:
        spark.conf.set(session.BATCH_BYTES, given)


def test_only_a_slice_of_a_batch_is_held_as_objects():
    class Watched:
        def __init__(self, values):
            self.values, self.null_count = values, values.null_count

        def __len__(self):
            return len(self.values)

        def slice(self, at, n):
            assert n <= text.SLICE
            return self.values.slice(at, n)

    values = pa.array([None if n % 7 == 0 else f"t{n}" for n in range(1000)])
    assert text.each(Watched(values), str.upper, pa.string()).to_pylist() == [None if v is None else v.upper() for v in values.to_pylist()]
    assert text.each(pa.nulls(3, pa.string()), str.upper, pa.string()).to_pylist() == [None] * 3
    assert text.each(pa.array([], pa.string()), str.upper, pa.string()).to_pylist() == []


def test_readable_counts_letters_as_before(spark):
    texts = ["", "abc", "123", "か", "ab か", "a" + "か" * 20, "か" * 3 + "a" * 40, "É", "漢字kana", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for profile in (LATIN, JAPANESE):
        script = F.length(F.regexp_replace("t", f"[^{profile.script}]", ""))
        letters = F.length(F.regexp_replace("t", f"[^{profile.letters}]", ""))
        want = F.coalesce((letters > 0) & (script / F.greatest(letters, F.lit(1)) >= profile.script_share), F.lit(False))
        assert df.filter(text.readable(F.col("t"), profile) != want).count() == 0


def test_texts_are_ranked_in_one_pass(spark):
    """The rows that quotas choose from are written once; both uses read that table."""
    at = dt.datetime(2024, 1, 1)
    rows = [("e", n, f"https://a.example.org/{n}", f"s{n % 3}", "国内", True, n % 5, at) for n in range(20)]
    keys = spark.createDataFrame(rows, "edition_id string, ord long, url string, publisher string, category string, legible boolean, priority int, published_at timestamp_ntz")
    plan = selection.quota_prefilter(keys, 2, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan


def test_small_groups_meet_without_tokens(spark, monkeypatch):
    titles = variants(25)
    groups = [(t, f"g{random.Random(t).randrange(3)}") for t in titles]
    df = spark.createDataFrame(groups, "t string, g string")
    left, right = df.withColumnRenamed("t", "a"), df.withColumnRenamed("t", "b")
    want = {(a, b) for a, g in groups for b, h in groups if g == h and likeness(a, b) >= 0.78}
    for direct in (0, 700, 10**9):
        monkeypatch.setattr(similarity, "DIRECT", direct)
        if direct == 10**9:
            monkeypatch.setattr(similarity, "met_by_tokens", None)
        assert {(r["a"], r["b"]) for r in similarity.similar_pairs(left, right, "a", "b", 0.78, ("g",)).collect()} == want


def test_jaccard_alone_takes_no_tokens_of_the_sequence_ratio():
    tokens = similarity.title_tokens("abcdefghijklmnopqrstuvwxyz", 0.72, {}, full=False)
    assert {t[0] for t, _ in tokens} == {"s"} and len(tokens) == 25 - 18 + 1


def test_overlap_goes_by_trigrams(spark):
    rows = [("abcdefghijklmnop", "abcdefghijklmnop"), ("abcdefghijklmnop", "xxabcdefghijklmxx"), ("abcdefghijklmnop", "nothing"), ("abc", "xabcx"), ("", ""), ("abcdefghijklmnop", "")]
    df = spark.createDataFrame(rows, "own string, before string").withColumn("references", F.array("before"))
    plan = df.select(text.text_overlap(F.col("own"), F.col("references")).alias("o"))
    assert [r.o for r in plan.collect()] == [True, True, False, True, False, False]
    assert "sequence(" not in plan._jdf.queryExecution().optimizedPlan().toString()
