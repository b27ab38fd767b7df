"""Coverage windows over tables: assignment with grace, catch-up windows, rolling context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import slots
from tidewire.functions.profiles import (
    CATCHUP_LIMIT,
    CONTEXT_HOURS,
    GRACE_MINUTES,
    MAX_MISSING_WINDOWS,
)
from tidewire.functions.text import stable_hash


def in_window(ts: Column, start: Column, end: Column, grace_minutes: int = GRACE_MINUTES) -> Column:
    """Half-open window with a grace before its start (UTC times); reaches a parquet scan as a range filter."""
    return (ts >= start - F.make_dt_interval(mins=F.lit(grace_minutes))) & (ts < end)


def assign_windows(df: DataFrame, ts: str = "published_at", grace_minutes: int = GRACE_MINUTES) -> DataFrame:
    """One row per window an item falls in: its own slot, and the next one when it is inside that slot's grace.

    Arithmetic on the time gives at most two windows per item, so no range join is needed.
    """
    own = slots.slot_end(F.col(ts))
    late = slots.local(F.col(ts)) >= F.col("__own") - F.make_dt_interval(mins=F.lit(grace_minutes))
    ends = F.when(late, F.array(F.col("__own"), following_of("__own"))).otherwise(F.array(F.col("__own")))
    return (
        df.withColumn("__own", own)
        .withColumn("window_end", F.explode(ends))
        .withColumn("edition_id", slots.edition_id(F.col("window_end")))
        .withColumn("late", F.col("window_end") != F.col("__own"))
        .drop("__own")
    )


def following_of(end: str) -> Column:
    return F.when(F.hour(end) == 18, F.col(end) + slots.hours(12)).otherwise(F.col(end) + slots.hours(6))


def coverage_windows(df: DataFrame, now: str, slot: str = "auto") -> DataFrame:
    """The window each run time resolves to: edition, start and end (wall clock)."""
    end = slots.last_completed_end(F.col(now)) if slot == "auto" else slots.requested_end(F.col(now), slot.zfill(2))
    return df.withColumn("window_end", end).withColumns(
        {
            "edition_id": slots.edition_id(F.col("window_end")),
            "window_start": slots.slot_start(F.col("window_end")),
        }
    )


def missing_windows(df: DataFrame, mark: str, target: str, limit: int = CATCHUP_LIMIT) -> DataFrame:
    """Windows still to process for each progress row, oldest first.

    `mark` is the wall-clock end of the last completed window (may be null), `target` the wall-clock end of
    the newest window. From a mark on the slot grid follow at most 61 windows, the newest `limit` are kept;
    without a usable mark only the target remains; a mark at or past the target gives none.
    """
    cursor = F.date_trunc("hour", F.col(mark)).cast("timestamp_ntz")
    on_grid = F.hour("__cursor").isin(6, 12, 18)
    day = F.date_trunc("day", F.col("__cursor")).cast("timestamp_ntz")
    days = F.sequence(F.lit(0), F.lit(MAX_MISSING_WINDOWS // 3 + 1))
    grid = F.flatten(
        F.transform(
            days,
            lambda d: F.transform(
                F.array(F.lit(6), F.lit(12), F.lit(18)),
                lambda h: F.col("__day") + F.make_dt_interval(days=d, hours=h),
            ),
        )
    )
    after = F.filter(grid, lambda e: (e > F.col("__cursor")) & (e <= F.col("__last")))
    newest = F.slice(F.col("__ends"), F.greatest(F.size("__ends") - max(1, limit) + 1, F.lit(1)), max(1, limit))
    return (
        df.withColumn("__cursor", cursor)
        .withColumn("__day", day)
        .withColumn("__last", F.col(target))
        .withColumn("__ends", F.slice(after, 1, MAX_MISSING_WINDOWS))
        .withColumn(
            "__ends",
            F.when(F.col("__cursor").isNull(), F.array(F.col("__last")))
            .when(F.col("__cursor") >= F.col("__last"), F.array().cast("array<timestamp_ntz>"))
            .when(~on_grid, F.array(F.col("__last")))
            .otherwise(newest),
        )
        .select("*", F.posexplode("__ends").alias("run_order", "window_end"))
        .drop("__cursor", "__day", "__last", "__ends")
        .withColumns(
            {
                "edition_id": slots.edition_id(F.col("window_end")),
                "window_start": slots.slot_start(F.col("window_end")),
            }
        )
    )


def advance_mark(current: Column, end: Column) -> Column:
    """The high-water mark never moves backwards."""
    return F.greatest(current, end)


def rolling_context(df: DataFrame, ts: str = "published_at", context_hours: int = CONTEXT_HOURS) -> DataFrame:
    """Each item as context of the windows that follow its own slot and end within the last `context_hours`.

    A 24 hour span meets at most four later slot ends, so the range condition is an explode of four
    arithmetic ends and a filter. Rows get a context id, the edition they come from and `context_only`.
    """
    own = slots.slot_end(F.col(ts))
    ends = F.array("__e1", "__e2", "__e3", "__e4")
    steps = df.withColumn("__own", own).withColumn("__e1", following_of("__own"))
    for a, b in (("__e1", "__e2"), ("__e2", "__e3"), ("__e3", "__e4")):
        steps = steps.withColumn(b, following_of(a))
    return (
        steps.withColumn("window_end", F.explode(ends))
        .filter(F.col("window_end") - slots.hours(context_hours) <= slots.local(F.col(ts)))
        .withColumns(
            {
                "origin_edition_id": slots.edition_id(F.col("__own")),
                "edition_id": slots.edition_id(F.col("window_end")),
                "id": F.concat(F.lit("context-"), stable_hash(F.col("url"), 20)),
                "context_only": F.lit(True),
            }
        )
        .drop("__own", "__e1", "__e2", "__e3", "__e4")
    )
