"""Editions as a stream of micro-batches over landed candidates.

Each micro-batch is folded into the history window by window with the same code as the batch catch-up. A batch
that is replayed after a failure rewrites the same editions and the same state version chain, because editions
are replaced by id and a completed window is skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def edition_writer(stream: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """A stream writer that hands every micro-batch of candidates to `publish(batch, batch_id)`."""
    return stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).outputMode("append")
