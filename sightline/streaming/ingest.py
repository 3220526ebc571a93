"""Ingestion of pushed imagesets and logs as streams: filters, quotas, merged topics, resumable shards."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def imagesets(stream: DataFrame, detections: str, least: int = 1) -> DataFrame:
    """The imagesets with at least least detections (an array column); others are dropped. Null detections count as none."""
    return stream.withColumn("n_detections", F.coalesce(F.size(detections), F.lit(0))).where(F.col("n_detections") >= least)


def merged(topics: dict[str, DataFrame], ts: str, late: str = "10 minutes") -> DataFrame:
    """Several topics as one stream of rows in event time, with their topic; a column that a topic lacks is null. Rows later than late count as late in windows downstream."""
    out = None
    for name, d in topics.items():
        d = d.withColumn("topic", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out.withWatermark(ts, late) if out.isStreaming else out.orderBy(ts, "topic")


def until_quota(stream: DataFrame, key: str, order: list[str], wanted: Column, quota: int) -> DataFrame:
    """Each key's rows until quota wanted ones came, that row included; then none. The state of a key is its count."""
    marked = stream.withColumn("_wanted", F.coalesce(wanted, F.lit(False)))
    fields = [f for f in marked.schema if f.name != "_wanted"]

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (n,) = state.get if state.exists else (0,)
        rows = pd.concat(list(batches)).sort_values(order)
        before = rows["_wanted"].astype(int).cumsum() - rows["_wanted"].astype(int) + n
        kept = rows[before < quota]
        state.update((int(n + kept["_wanted"].sum()),))
        yield kept[[f.name for f in fields]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return marked.groupBy(key).applyInPandasWithState(step, schema, "n long", "append", "NoTimeout")


def shards(stream: DataFrame, path: str, progress: str, form: str = "parquet") -> StreamingQuery:
    """Writes what has come since the last run and stops; a run that was cut off is taken up where its last complete batch ended."""
    return stream.writeStream.format(form).option("path", path).option("checkpointLocation", progress).trigger(availableNow=True).start()
