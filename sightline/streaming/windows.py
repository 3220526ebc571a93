"""Event-time windows and the ordered selector on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(df: DataFrame, ts: str, key: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows per tumbling window and key; on a stream, rows later than late are dropped."""
    df = df.withWatermark(ts, late) if df.isStreaming else df
    return df.groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n"))


def sessions(df: DataFrame, ts: str, key: str, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    """Rows per session of a key."""
    df = df.withWatermark(ts, late) if df.isStreaming else df
    return df.groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("n"))


def selector(df: DataFrame, key: str, ts: str, id_col: str, value: str, gap: float, most: int) -> DataFrame:
    """Each row of a stream with whether it is selected: at least gap from the key's last selected value, until most are.

    The state of a key is its last selected value and its count. Rows of a micro-batch are put in
    order by time and id; batches are taken to arrive in order, as the source logs are.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (None, 0)
        rows = pd.concat(list(batches)).sort_values([ts, id_col])
        out = []
        for i, v in zip(rows[id_col], rows[value], strict=True):
            reason = "max_selected" if n >= most else "near_duplicate" if last is not None and abs(v - last) < gap else "selected"
            if reason == "selected":
                last, n = float(v), n + 1
            out.append((k[0], i, reason))
        state.update((last, n))
        yield pd.DataFrame(out, columns=[key, id_col, "reason"])

    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.groupBy(key).applyInPandasWithState(step, f"{key} {types[key]}, {id_col} {types[id_col]}, reason string", "last double, n long", "append", "NoTimeout")
