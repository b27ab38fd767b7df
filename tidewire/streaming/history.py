"""Published history as keyed state of a stream.

A story is kept if no kept story of its key was published within the horizon before it; what is kept becomes the state, so a
later micro-batch knows what an earlier one published. Keys are dealt by hash into `BUCKETS` that share one state, as a call and
its trips to the store cost far more than a row: one time for each key published within the horizon. Times fall out of it when the watermark
has passed their horizon, which is the retention of the history, and an event-time timer clears a bucket that gets no more rows. (A time to
live would go by the clock of the machine, and a replay would give other rows.) Only keys, times and numbers go through the operator; a
caller joins its rows back.

Without a horizon a key is kept once ever, each key has a state of its own that stays, and no row is late. Keys are URLs (180 days, or for good) or normalised
titles (36 hours, primary sources exempt, though they renew the state). Rows without a
key or a time are dropped. Rows of one key and micro-batch are taken in order of time, then number. Rows that come later than
`delay` (the horizon, unless given) behind the newest one of an earlier micro-batch are dropped by the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT = "key string, number long, at timestamp"


#: Groups into which keys with a horizon are dealt.
BUCKETS = 256


def as_rows(keys, number, at) -> pd.DataFrame:
    return pd.DataFrame({"key": pd.Series(keys, dtype=object), "number": number, "at": pd.to_datetime(at, unit="ms")})


class KeptOnce(StatefulProcessor):
    """Emits the first row of a key ever, and exempt rows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("last", "at_ms long, timer_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(r["at_ms"].to_numpy(), r["number"].to_numpy(), r["exempt"].to_numpy()) for r in rows]
        at, number, exempt = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((number, at))
        at, number, keep = at[order], number[order], exempt[order].astype(bool)
        if not self.first.exists():
            keep[0] = True
            self.first.update((int(at[0]), 0))
        if keep.any():
            yield as_rows([key[0]] * int(keep.sum()), number[keep], at[keep])

    def close(self) -> None:
        pass


class KeptStories(StatefulProcessor):
    """Emits the rows of a bucket's keys that come more than the horizon after the last kept one of their key, and exempt rows."""

    def __init__(self, horizon_ms: int):
        self.horizon = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "keys array<string>, at_ms array<long>, timer_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        table = pd.concat([r[["key", "at_ms", "number", "exempt"]] for r in rows]).sort_values(["at_ms", "number"], kind="stable", ignore_index=True)
        keys, times, timer = self.last.get() or ((), (), None)
        last = dict(zip(keys, times))
        kept = []
        for n, (name, at, exempt) in enumerate(zip(table["key"].tolist(), table["at_ms"].tolist(), table["exempt"].tolist())):
            before = last.get(name)
            if before is None or exempt or at - before > self.horizon:
                kept.append(n)
                last[name] = at if before is None else max(before, at)
        now = timerValues.getCurrentWatermarkInMs()
        last = {name: at for name, at in last.items() if at + self.horizon >= now}
        if timer is not None:
            self.handle.deleteTimer(timer)
        if last:
            timer = max(max(last.values()) + self.horizon, now) + 1
            self.handle.registerTimer(timer)
            self.last.update((list(last), list(last.values()), timer))
        else:
            self.last.clear()
        if kept:
            some = table.iloc[kept]
            yield as_rows(some["key"].to_numpy(), some["number"].to_numpy(), some["at_ms"].to_numpy())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def kept_stories(stream: DataFrame, key: Column, number: Column, at: Column, hours: int | None, exempt: Column | None = None, delay: str | None = None) -> DataFrame:
    """key, number and time of the rows that are kept; the session keeps its state in RocksDB (`use_rocks`)."""
    exempt = F.lit(False) if exempt is None else F.coalesce(exempt, F.lit(False))
    narrow = stream.select(key.alias("key"), number.cast("long").alias("number"), at.cast("timestamp").alias("at"), exempt.alias("exempt"))
    narrow = narrow.filter((F.col("key") != "") & F.col("at").isNotNull()).withColumn("at_ms", F.unix_millis("at"))
    if hours is None:
        return narrow.groupBy("key").transformWithStateInPandas(KeptOnce(), KEPT, "Append", "None")
    marked = narrow.withWatermark("at", delay or f"{hours} hours").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
    return marked.groupBy("bucket").transformWithStateInPandas(KeptStories(hours * 3_600_000), KEPT, "Append", "EventTime")


def use_rocks(spark: SparkSession) -> None:
    """State of several columns and timers need this store; a cluster sets it for itself."""
    if spark.conf.get(STORE, "") != ROCKS:
        spark.conf.set(STORE, ROCKS)
