"""Streams over several landings: state, watermark, late rows, restarts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewire.streaming import history, run, slots

T0 = dt.datetime(2024, 1, 1)
ITEM = "key string, number long, published_at timestamp_ntz, primary_source boolean, landing int"


def kept_by_definition(rows, hours):
    last, kept = {}, []
    for key, number, at, exempt, _ in sorted((r for r in rows if r[2]), key=lambda r: (r[4], r[2], r[1])):
        if not key:
            continue
        if key not in last or exempt or at - last[key] > dt.timedelta(hours=hours):
            kept.append(number)
            last[key] = max(at, last.get(key, at))
    return sorted(kept)


def flow_of(spark, hours, folder=""):
    history.use_rocks(spark)
    step = lambda s: history.kept_stories(s, F.col("key"), F.col("number"), F.col("published_at"), hours, F.col("primary_source"))
    return run.Landings(spark, ITEM, step, folder)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(3)
    rows = []
    for n in range(240):
        at = T0 + dt.timedelta(hours=n // 2)
        rows.append((f"k{rng.randrange(6)}" if rng.random() < 0.8 else "hot", n, at, rng.random() < 0.1, n // 80))
    return rows + [("", 900, T0, False, 0), (None, 901, T0, False, 0), ("k1", 902, None, False, 1), ("k2", 0, T0, False, 0)]


def test_a_later_landing_knows_what_an_earlier_one_published(spark, items, tmp_path):
    rows = spark.createDataFrame(items, ITEM)
    flow = flow_of(spark, 36)
    for number in range(3):
        flow.land(rows.filter(F.col("landing") == number), number)
        flow.run()
        flow = flow_of(spark, 36, flow.folder)  # another driver goes on from the checkpoint
    got = flow.result()
    assert set(r.number for r in got.collect()) ^ set(kept_by_definition(items, 36)) == set()
    assert sorted(r.number for r in got.collect()) == kept_by_definition(items, 36)
    before = got.count()
    flow.run()  # nothing new has landed
    assert flow.result().count() == before


def test_a_replayed_batch_overwrites_its_own_part(spark, items, tmp_path):
    rows = spark.createDataFrame(items, ITEM)
    flow = flow_of(spark, 36)
    flow.land(rows.filter("landing = 0"), 0)
    flow.run()
    want = kept_by_definition([r for r in items if r[4] == 0], 36)
    flow.result().filter("batch = 0").drop("batch").limit(3).write.parquet(f"{tmp_path}/half")
    spark.read.parquet(f"{tmp_path}/half").write.mode("overwrite").parquet(f"{flow.folder}/out/batch=0")  # what a killed writer left
    again = run.Landings(spark, ITEM, flow.step, flow.folder + "-again")
    again.land(rows.filter("landing = 0"), 0)
    again.run()
    assert sorted(r.number for r in again.result().collect()) == want


def test_state_is_pruned_when_the_retention_has_passed(spark):
    flow = flow_of(spark, 10)
    for number, hours in enumerate((0, 100)):
        rows = [(f"k{n}", n, T0 + dt.timedelta(hours=hours, minutes=n), False, number) for n in range(number * 50, number * 50 + 20)]
        flow.land(spark.createDataFrame(rows, ITEM), number)
        query = flow.run()
    state = query.recentProgress[-1]["stateOperators"][0]
    later = flow_of(spark, 10, flow.folder)
    later.land(spark.createDataFrame([("k0", 99, T0 + dt.timedelta(hours=101), False, 2), ("k1", 98, T0 + dt.timedelta(hours=9), False, 2)], ITEM), 2)
    later.run()
    assert 99 in {r.number for r in later.result().collect()}
    assert 98 not in {r.number for r in later.result().collect()}  # behind the watermark
    assert query.recentProgress[-1]["eventTime"]["watermark"] > "2024-01-04T19:" and state["numRowsTotal"] < 100


def test_closed_slots_come_once_and_late_rows_are_counted(spark):
    def at(hours, minutes=0):
        return T0 + dt.timedelta(hours=hours, minutes=minutes)

    rows = [("a", at(1), 0), ("a", at(2, 30), 0), ("b", at(3, 10), 0), ("b", at(10, 20), 0)]
    rows += [("late", at(2, 59), 1), ("grace", at(3, 30), 1), ("a", at(11), 1), ("a", at(22, 20), 1)]
    rows += [("late", at(8, 59), 2), ("late", at(0), 2), ("grace", at(16), 2), ("c", at(40), 2)]
    df = spark.createDataFrame(rows, "kind_of string, ts timestamp, landing int").withColumnRenamed("ts", "published_at")
    got = slots.closed_slot_counts(df, F.col("landing"), 3, by=["kind_of"])
    found = sorted((r.kind, r.window_start.hour + 24 * (r.window_start.day - 1) if r.window_start.year == 2024 else -3, r.kind_of, r.n) for r in got.collect())
    assert found == sorted([
        ("closed", -3, "a", 2), ("closed", 3, "b", 1), ("closed", 9, "b", 1), ("closed", 3, "grace", 1), ("closed", 9, "a", 1), ("closed", 21, "a", 1),
        ("closed", 15, "grace", 1), ("late", -3, "late", 2), ("late", 3, "late", 1),
    ])


def test_distinct_urls_over_landings(spark):
    rows = [(f"https://example.org/{n % 7}", T0 + dt.timedelta(hours=n), n // 10) for n in range(30)]
    df = spark.createDataFrame(rows, "url string, ts timestamp, landing int").withColumnRenamed("ts", "published_at")
    flow = run.by_landings(df, F.col("landing"), 3, lambda s: slots.distinct_urls(s))
    assert sorted(r.url for r in flow.result().collect()) == [f"https://example.org/{n}" for n in range(7)]
