"""Session helpers: shared folders and cutting lineage between rounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Nothing is broadcast by hand beyond this many bytes.
BROADCAST_BYTES = 64 << 20
# A scan with fewer splits than this per core does not keep the cores evenly busy.
SPLITS_PER_CORE = 4
CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, reachable by every executor.

    A folder of our own is made only where none is named, and only on a local
    master: on a cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vellumflow-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder and drop its lineage.

    Used between rounds and where a result of model calls is read more than
    once. The data survives the loss of any executor.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read that: later reads prune and filter it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def few(df: DataFrame, row_bytes: int = 200, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` to be broadcast if, counted, it fits; else as it is. Give it a settled frame."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core on a scan of few splits; one with several per core is not moved at all.

    Splits of a small file may be empty, as a row group is read whole by one of
    them. ``key`` should be unique, so that rows spread evenly whatever their contents.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, key) if df.rdd.getNumPartitions() < SPLITS_PER_CORE * wanted else df
