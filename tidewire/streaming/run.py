"""Run a stream over everything that has landed, and read its result back as a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.session import checkpoint_dir


def landed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table as a stream of landed files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.{{parquet}}")  # a pattern: one file is a valid table


def drain(stream: DataFrame, mode: str) -> DataFrame:
    """Process all landed input and return the result table.

    Progress and result live below the checkpoint folder the cluster names, so a restarted run finds them. In
    complete mode every batch replaces the result; in append mode each batch writes its own part, which a replayed
    batch overwrites.
    """
    spark = stream.sparkSession
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        part = "whole" if mode == "complete" else f"batch={number}"
        batch.write.mode("overwrite").parquet(f"{base}/out/{part}")

    job = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{base}/progress")
    job.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{base}/out")


@dataclass
class Landings:
    """A landing folder, the stream over it and what the stream has put out, all below one shared folder.

    Every `run` ends when all landed rows are processed; the next one goes on from the checkpoint, on this driver or another. A batch
    that is replayed after a failure overwrites its own part of the output.
    """

    spark: SparkSession
    schema: str
    step: Callable[[DataFrame], DataFrame]
    folder: str = ""
    finished: list[StreamingQuery] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.folder = self.folder or f"{checkpoint_dir(self.spark)}/streams/{uuid.uuid4().hex}"

    def land(self, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/landed/landing={number}")

    def stream(self) -> DataFrame:
        landed = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
        return self.step(landed.parquet(f"{self.folder}/landed"))

    def run(self) -> StreamingQuery:
        stream = self.stream()

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.folder}/out/batch={number}")

        job = stream.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", f"{self.folder}/progress")
        query = job.trigger(availableNow=True).start()
        query.awaitTermination()
        self.finished.append(query)
        return query

    def result(self) -> DataFrame:
        """Everything put out so far, with the number of its batch."""
        return self.spark.read.option("basePath", f"{self.folder}/out").parquet(f"{self.folder}/out")


def by_landings(rows: DataFrame, landing: Column, count: int, step: Callable[[DataFrame], DataFrame]) -> Landings:
    """Land the rows of each number in turn and run the stream after each, so that every run but the first is a restart."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    flow = Landings(rows.sparkSession, schema, step)
    for number in range(count):
        flow.land(rows.filter(landing == F.lit(number)), number)
        flow.run()
    return flow
