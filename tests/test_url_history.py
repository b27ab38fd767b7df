"""URLs that are put out once ever, by state without a horizon."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewire.streaming import history, run, slots

T0 = dt.datetime(2024, 1, 1)
#: url a comes back after 200 days, with the watermark far behind it
ROWS = [("https://x.example.org/a", 0, T0, 0), ("https://x.example.org/b", 1, T0 + dt.timedelta(days=190), 1), ("https://x.example.org/a", 2, T0 + dt.timedelta(days=200), 2),
        ("https://x.example.org/a", 3, T0 + dt.timedelta(days=800), 2), ("https://x.example.org/c", 4, T0 + dt.timedelta(days=1), 2)]


def test_keyed_state_without_a_horizon_never_forgets(spark):
    history.use_rocks(spark)
    rows = spark.createDataFrame(ROWS, "url string, ord long, published_at timestamp_ntz, landing int")
    flow = run.by_landings(rows, F.col("landing"), 3, lambda s: history.kept_stories(s, F.col("url"), F.col("ord"), F.col("published_at"), None))
    assert sorted(r.number for r in flow.result().collect()) == [0, 1, 4]
    assert {r.at for r in flow.result().collect()} == {ROWS[0][2], ROWS[1][2], ROWS[4][2]}


def test_distinct_urls_without_a_horizon_are_distinct(spark):
    rows = spark.createDataFrame(ROWS, "url string, ord long, published_at timestamp, landing int")
    flow = run.by_landings(rows, F.col("landing"), 3, lambda s: slots.distinct_urls(s, horizon=None))
    assert sorted(r.url[-1] for r in flow.result().collect()) == ["a", "b", "c"]
