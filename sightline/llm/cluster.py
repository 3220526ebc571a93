"""What the operators share about the session: the shared folder, lineage cuts, input size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.names import fresh  # noqa: F401  (the operators take it from here)
from sightline.functions.shared import checkpoint_dir
from sightline.functions.ship import ship


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, set for checkpoints."""
    return checkpoint_dir(spark)


def cut(frame: DataFrame) -> DataFrame:
    """The frame read back from a checkpoint in the shared folder, so later jobs don't recompute it and survive lost executors."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def text_size(frame: DataFrame, column: str) -> int:
    """Characters in the column, over all rows; sizes partitions only."""
    return frame.agg(F.sum(F.length(column))).first()[0] or 0


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Let Arrow batches end at size bytes as well as at a row count, so that long texts don't pile up in a Python worker."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
