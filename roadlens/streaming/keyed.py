"""The latest speed of every monitor as keyed state (Q13a).

A monitor's state is its newest closed window and the sums of its panes that
may still close a newer one.  It is touched when the monitor reports and when
its timer says that the watermark has closed another window, so the work of a
batch grows with the monitors that reported lately, not with all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadlens import schemas as S
from roadlens.functions import duration_seconds, whole_number

_STATE = "window_end bigint, panes array<bigint>, sums array<bigint>, counts array<bigint>"


def _closed(panes: dict[int, tuple[int, int]], last: int, window: int, slide: int) -> int | None:
    """The start of the newest window with a reading that starts at or before ``last``."""
    starts = [min(last, p // slide * slide) for p in panes]
    return max((s for s, p in zip(starts, panes) if s <= p < s + window), default=None)


def _step(panes: dict[int, tuple[int, int]], end: int, watermark: int, window: int, slide: int):
    """``(end, average or None, panes, timer)`` after the watermark: the newest
    closed window's end, its average if it is a new one, the panes that later
    windows need, and the next second at which a window closes (None: never)."""
    last, average = (watermark - window) // slide * slide, None
    start = _closed(panes, last, window, slide)
    if start is not None and start + window > end:
        total, n = (sum(v[i] for p, v in panes.items() if start <= p < start + window) for i in (0, 1))
        end, average = start + window, (total // n if total >= 0 else -(-total // n))
    panes = {p: v for p, v in panes.items() if p >= last + slide}
    timer = None
    if panes:
        first = (min(panes) - window) // slide * slide + slide + window
        timer = max(last + slide + window, first)
    return end, average, panes, timer


def stream_latest_speed(log_stream: DataFrame, watermark: str = "1 minute", window: str = S.SPEED_WINDOW,
                        slide: str = S.SPEED_SLIDE, monitor: str = S.MONITOR, speed: str = S.SPEED) -> DataFrame:
    """``(monitor, avg_speed, window_end)``: a row whenever a monitor's newest
    closed window is another one (append mode); the newest row of a monitor is
    its state.  The same windows as ``latest_speed`` of the closed windows of
    ``windowed_avg_speed``.  A reading at or behind the watermark is late:
    Spark drops and counts it.  Readings without a time or a whole speed are
    dropped; readings without a monitor belong to the monitor NULL.

    A monitor's readings of one batch are summed per pane as they stream
    through its task.  Works on the default state store and on RocksDB."""
    from roadlens.streaming import as_event_time

    window_s, slide_s = duration_seconds(window), duration_seconds(slide)
    pane_s = gcd(window_s, slide_s)
    rows = as_event_time(log_stream).withWatermark("event_time", watermark)
    rows = rows.select(F.col(monitor).alias("_key"), "event_time", whole_number(speed).alias("_speed"))
    pane = F.floor(F.unix_micros("event_time") / F.lit(pane_s * 1_000_000)) * pane_s
    rows = rows.where(F.col("event_time").isNotNull() & F.col("_speed").isNotNull()).withColumn("_pane", pane.cast("bigint"))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        end, panes = 0, {}
        if state.exists:
            end, starts, sums, counts = state.get
            panes = {p: (s, n) for p, s, n in zip(starts, sums, counts)}
        if not state.hasTimedOut:
            for pdf in batches:
                for p, total, n in pdf.groupby("_pane")["_speed"].agg(["sum", "count"]).itertuples():
                    s, m = panes.get(int(p), (0, 0))
                    panes[int(p)] = (s + int(total), m + int(n))
        end, average, panes, timer = _step(panes, end, state.getCurrentWatermarkMs() // 1000, window_s, slide_s)
        starts = sorted(panes)
        state.update((end, starts, [panes[p][0] for p in starts], [panes[p][1] for p in starts]))
        if timer is not None:
            state.setTimeoutTimestamp(timer * 1000 - 1)  # a timer fires once the watermark is beyond it
        if average is not None:
            name = None if pd.isna(key[0]) else key[0]
            yield pd.DataFrame({"_key": pd.Series([name], dtype=object), "avg_speed": [average], "window_end": [end]})

    kind = rows.schema["_key"].dataType.simpleString()
    out = rows.groupBy("_key").applyInPandasWithState(
        run, f"_key {kind}, avg_speed bigint, window_end bigint", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("_key").alias(monitor), "avg_speed",
                      F.timestamp_seconds("window_end").cast("timestamp_ntz").alias("window_end"))
