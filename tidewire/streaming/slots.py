"""Continuous forms of slot assignment, URL de-duplication and grace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.functions import slots
from tidewire.functions.profiles import GRACE_MINUTES
from tidewire.functions.urls import canonical_url
from tidewire.streaming.run import Landings

GRACE = f"{GRACE_MINUTES} minutes"


def slot_counts(stream: DataFrame, ts: str = "published_at", by: Sequence[str] = (), grace: str = GRACE) -> DataFrame:
    """Counts per edition slot, final once the watermark passes the slot's end plus the grace.

    Slots are unequal (12, 6 and 6 hours), so `window()` does not fit. All boundaries lie on a six-hour grid of
    the wall clock, so the stream is counted in six-hour windows, which the watermark can close, and the two
    windows of the long slot are added up when the finished counts are read (`merge_slots`).
    """
    counted = stream.withWatermark(ts, grace).groupBy(F.window(ts, "6 hours", None, "3 hours"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n")


def merge_slots(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Finished six-hour counts to edition slots."""
    start = F.col("window_start").cast("timestamp_ntz")
    return counted.groupBy(slots.edition_of(start).alias("edition_id"), *by).agg(F.sum("n").alias("n"))


def distinct_urls(stream: DataFrame, ts: str = "published_at", horizon: str | None = "36 hours") -> DataFrame:
    """First arrival of each canonical URL; state is kept for the horizon only, or for good without one (a URL is then put out once ever)."""
    urls = stream.withColumn("url", canonical_url(F.col("url"))).filter(F.col("url").isNotNull())
    if horizon is None:
        return urls.dropDuplicates(["url"])
    return urls.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(["url"])


def watermark_of(query: StreamingQuery) -> str:
    """The watermark that a finished run had when it read its rows; nothing was closed before a first run."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if p["numInputRows"] and "watermark" in p["eventTime"]]
    return min(marks, default="1970-01-01T00:00:00.000Z")


def closed_slot_counts(rows: DataFrame, landing: Column, count: int, ts: str = "published_at", by: Sequence[str] = (), grace: str = GRACE) -> DataFrame:
    """Six-hour counts that are final (`kind` closed) and the rows that came too late for theirs (late), over several landings.

    A window is put out once, when the watermark passes its end, and its state goes. Rows of a window that was closed when
    their landing was read are not counted; they are counted here instead, by the watermark that the run itself reports.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    flow = Landings(rows.sparkSession, schema, lambda stream: slot_counts(stream, ts, by, grace))
    window = F.window(ts, "6 hours", None, "3 hours")
    late = None
    for number in range(count):
        part = rows.filter(landing == F.lit(number))
        flow.land(part, number)
        closed_to = F.to_timestamp(F.lit(watermark_of(flow.run())))
        behind = part.withColumn("w", window).filter(F.col("w.end") <= closed_to)
        found = behind.groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by).agg(F.count("*").alias("n"))
        late = found if late is None else late.unionByName(found)
    late = late.groupBy("window_start", "window_end", *by).agg(F.sum("n").alias("n"))
    closed = flow.result().drop("batch").withColumn("kind", F.lit("closed"))
    return closed.unionByName(late.withColumn("kind", F.lit("late")))
