"""Queries read whole texts: no prefix of sentences or characters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions.profiles import LATIN
from tidewire.operators import clusters
from tidewire.plans import edition_run, fixtures


def test_proposals_hold_every_sentence(spark):
    text = " ".join(f"Sentence number {i} says something new." for i in range(30))
    rows = spark.createDataFrame([("e", 1, "t", text, "world")], "edition_id string, ord long, title string, description string, category string")
    assert fixtures.proposals(rows).select(F.size("facts")).first()[0] == 30


def test_the_edition_pool_describes_without_a_limit(spark, monkeypatch):
    limits = []

    def described(df, profile, limit=900):
        limits.append(limit)
        return df

    rows = spark.createDataFrame([("e", "u", 0, 0)], "edition_id string, url string, pos int, lead_order int")
    monkeypatch.setattr(edition_run, "described", described)
    for name, stand_in in (("limit_candidates", lambda df, profile: df), ("edited", lambda df, profile: df), ("lead_ordered", lambda df: df)):
        monkeypatch.setattr(edition_run, name, stand_in)
    edition_run.edition_pool(rows, rows.limit(0), LATIN)
    long = " ".join(f"Sentence number {i} says something new." for i in range(60))
    whole = clusters.safe_description(spark.createDataFrame([(long,)], "d string"), "safe", F.col("d"), LATIN, limits[0]).first().safe
    assert limits == [None] and len(whole) > 900
