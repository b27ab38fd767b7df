"""Keys with a horizon share states, so calls and timers follow the buckets and not the keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewire.streaming import history, run

T0 = dt.datetime(2024, 1, 1)


def test_many_titles_share_few_states(spark):
    history.use_rocks(spark)
    rows = spark.range(3000).select(
        F.concat(F.lit("t"), F.col("id") % 2900).alias("title"), F.col("id").alias("ord"), F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("published_at")
    )
    flow = run.by_landings(rows, F.floor(F.col("ord") / 1000), 3, lambda s: history.kept_stories(s, F.col("title"), F.col("ord"), F.col("published_at"), 36))
    assert sorted(r.number for r in flow.result().collect()) == list(range(2900))
    states = [p["stateOperators"][0]["numRowsTotal"] for q in flow.finished for p in q.recentProgress if p["stateOperators"]]
    assert 0 < max(states) <= 4 * history.BUCKETS < 2900
