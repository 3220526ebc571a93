"""Streams put in order: rows wait in the key's buffer until the watermark has passed them.

Sources deliver late and out of order. A key's rows are held back until no earlier one can come any
more, then leave by time, and a fold that needs their order (a selection, a running state) sees them so.
The buffer holds what came within the delay; a timer empties it when a key falls silent.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Fold = Callable[[object, pd.DataFrame], tuple[object, pd.DataFrame]]


def in_order(stream: DataFrame, key: str, ts: str, delay: str, ties: list[str] = (), fold: Fold | None = None, start: object = None, schema: str | None = None) -> DataFrame:
    """The stream's rows, per key by ts and then ties, with place (from 0); or what fold makes of them.

    Rows later than delay behind the latest time seen are dropped, as by every watermark; a null time
    never leaves. fold gets the key's state (start at first) and its next rows in order, place
    included, and returns the new state and the rows to put out, of the given schema. Rows within
    delay of the end of a stream stay in the state.
    """
    fields = [(f.name, f.dataType.simpleString()) for f in stream.schema]
    names = [n for n, _ in fields]
    out_schema = schema or ", ".join([*(f"`{n}` {t}" for n, t in fields), "place bigint"])
    ties = list(ties)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        waiting, held, place = state.get if state.exists else (None, None, 0)
        rows = [pickle.loads(waiting)] if waiting else []
        folded = pickle.loads(held) if held else start
        if not state.hasTimedOut:
            rows += list(batches)
        rows = pd.concat(rows) if rows else pd.DataFrame(columns=names)
        passed = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        ready = rows[ts] < passed
        now, rest = rows[ready].sort_values([ts, *ties], kind="stable"), rows[~ready]
        if len(now):
            now = now.assign(place=range(place, place + len(now)))[[*names, "place"]]
            place += len(now)
            if fold is not None:
                folded, now = fold(folded, now)
            yield now
        state.update((pickle.dumps(rest) if len(rest) else None, pickle.dumps(folded), place))
        if len(rest) and rest[ts].notna().any():
            state.setTimeoutTimestamp(max(int(rest[ts].min().timestamp() * 1000), state.getCurrentWatermarkMs()) + 1)

    marked = stream.withWatermark(ts, delay)
    return marked.groupBy(key).applyInPandasWithState(step, out_schema, "waiting binary, held binary, place bigint", "append", "EventTimeTimeout")


def merged_in_order(topics: dict[str, DataFrame], ts: str, key: str, delay: str) -> DataFrame:
    """Several topics of a recording (key) as one stream by time, ties by topic; a column that a topic lacks is null."""
    out = None
    for name, d in topics.items():
        d = d.withColumn("topic", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return in_order(out, key, ts, delay, ["topic"])


def selected_in_order(stream: DataFrame, key: str, ts: str, id_col: str, value: str, gap: float, most: int, delay: str) -> DataFrame:
    """Per key, in order of time and id: whether a row is selected, as its value is at least gap from the last selected one, until most are. Columns key, id, reason."""

    def choose(state: tuple, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        last, n = state
        said = []
        for v in rows[value]:
            reason = "max_selected" if n >= most else "near_duplicate" if last is not None and abs(v - last) < gap else "selected"
            if reason == "selected":
                last, n = float(v), n + 1
            said.append(reason)
        return (last, n), rows.assign(reason=said)[[key, id_col, "reason"]]

    types = {f.name: f.dataType.simpleString() for f in stream.schema}
    return in_order(stream, key, ts, delay, [id_col], choose, (None, 0), f"{key} {types[key]}, {id_col} {types[id_col]}, reason string")
