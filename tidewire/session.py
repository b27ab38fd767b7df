"""Session construction for tests and local benchmarks, and the one place that cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewire") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set (local tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return configured or current
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tidewire-checkpoint-")
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared checkpoint folder and go on from there.

    The table outlives any executor, is worked out once, and unlike a checkpointed RDD it tells the planner its size
    and lets later steps read only the columns they need.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch at most: a stage can hold a batch in each of its chained Python steps and cores at one time.
MOST_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in bytes, unless the session keeps them smaller; whole texts would fill far larger ones by the count of rows."""
    given = int(re.match(r"-?\d+", spark.conf.get(BATCH_BYTES))[0])
    if not 0 < given <= MOST_BYTES:
        spark.conf.set(BATCH_BYTES, MOST_BYTES)
