"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, set for checkpoints too. Where it is unset, a temporary folder in local mode (tests), else an error."""
    context = spark.sparkContext
    chosen = spark.conf.get("spark.checkpoint.dir", None)
    now = context._jsc.sc().getCheckpointDir()
    if chosen is None and now.isDefined():
        chosen = now.get()
    if chosen is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        chosen = tempfile.mkdtemp(prefix="shared-")
    if not now.isDefined():
        context.setCheckpointDir(chosen)
    return chosen
