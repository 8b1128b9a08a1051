"""Sliding-window aggregates and the congestion snapshot (Q11-Q13), batch
forms.  The streaming forms in ``roadlens.streaming`` apply the same
functions to a streaming DataFrame.

``groupBy(window(t, w, s), key)`` expands each row into w/s windows before
a partial aggregate, so the shuffle carries at most one row per (window,
key) and map task; a very busy monitor does not make a large shuffle group.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from roadlens import schemas as S
from roadlens.functions import congestion_level, duration_seconds, truncating_average, whole_number


def _flat_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def windowed_avg_speed(log: DataFrame, window: str = S.SPEED_WINDOW, slide: str = S.SPEED_SLIDE,
                       time: str = "event_time", monitor: str = S.MONITOR,
                       speed: str = S.SPEED, panes: bool = True) -> DataFrame:
    """``(window_start, window_end, monitor, speed_sum, n, avg_speed)`` per
    sliding window and monitor: integer speeds (fractions truncated) summed,
    ``avg_speed = speed_sum div n``.  Rows without a speed (NULL, NaN,
    infinite) are dropped; empty windows do not exist.

    ``panes=True`` (default) first sums each monitor's readings per pane, then
    spreads the pane sums over the windows that cover the pane.  A pane is as
    long as the greatest common divisor of window and slide, so every window
    is made of whole panes.  The expansion then runs over panes, not readings — the plan for a large, dense log (a busy monitor has many
    readings per pane).  On a stream in append mode these are two chained
    aggregates: a pane is handed on once the watermark has passed it, and only
    closed panes are spread over windows.  ``panes=False`` expands every
    reading (one shuffle fewer; better for sparse logs, and the form a
    streaming query in complete mode needs).  Same answer either way."""
    rows = log.where(whole_number(speed).isNotNull() & F.col(time).isNotNull())
    if panes:
        pane_len = f"{gcd(duration_seconds(window), duration_seconds(slide))} seconds"
        pane = (rows.groupBy(F.window(time, pane_len).alias("pane"), monitor)
                .agg(F.sum(whole_number(speed)).alias("_s"), F.count(F.lit(1)).alias("_n")))
        agg = (pane.groupBy(F.window(F.window_time("pane"), window, slide), monitor)
               .agg(F.sum("_s").alias("speed_sum"), F.sum("_n").alias("n")))
    else:
        agg = (rows.groupBy(F.window(time, window, slide), monitor)
               .agg(F.sum(whole_number(speed)).alias("speed_sum"),
                    F.count(F.lit(1)).alias("n")))
    return _flat_window(agg).withColumn("avg_speed", truncating_average("speed_sum", "n"))


def windowed_count(df: DataFrame, value: str = "value", window: str = S.TOKEN_WINDOW,
                   slide: str = S.TOKEN_SLIDE, time: str = "event_time") -> DataFrame:
    """``(window_start, window_end, value, n)``: occurrences of each distinct
    value per sliding window."""
    agg = (df.where(F.col(time).isNotNull())
           .groupBy(F.window(time, window, slide), value)
           .agg(F.count(F.lit(1)).alias("n")))
    return _flat_window(agg)


def closing_time(log: DataFrame, slide: str = S.SPEED_SLIDE, time: str = "event_time",
                 speed: str = S.SPEED):
    """Scalar column: the default ``as_of`` of :func:`latest_speed` computed
    from the log itself — the newest window start is the newest reading
    time floored to the slide — a one-column max, no window expansion."""
    newest = (log.where(whole_number(speed).isNotNull() & F.col(time).isNotNull())
              .agg(F.max(time).alias("_t")))
    return newest.select(F.window("_t", slide)["end"]).scalar()


def _floor_to(time: Column, seconds: int) -> Column:
    """``time`` cut down to whole slides, as ``window`` starts them."""
    return F.window(time, f"{seconds} seconds")["start"]


def latest_speed_of_log(log: DataFrame, as_of=None, window: str = S.SPEED_WINDOW, slide: str = S.SPEED_SLIDE,
                        time: str = "event_time", monitor: str = S.MONITOR, speed: str = S.SPEED) -> DataFrame:
    """``(monitor, avg_speed, window_end)``: :func:`latest_speed` of the
    sliding windows of ``log``, without building those windows.

    A monitor's newest closed window is told by its newest reading alone: it
    starts at that time cut down to the slide, or earlier where that window
    has not closed by ``as_of`` (default :func:`closing_time`).  So one
    aggregate finds each monitor's window, and one more sums the readings
    that fall into it; nothing is expanded."""
    slide_s, window_s = duration_seconds(slide), duration_seconds(window)
    length = F.expr(f"INTERVAL {window_s} SECONDS")
    rows = log.where(whole_number(speed).isNotNull() & F.col(time).isNotNull()).select(
        F.col(time).alias("_time"), F.col(monitor).alias("_monitor"), whole_number(speed).alias("_speed"))
    # the start of the last window that has closed; one value, so one row
    newest = rows.agg(F.max("_time").alias("_t"))
    if as_of is None:
        newest = newest.select(F.window("_t", slide)["end"].alias("_as_of"))
    else:
        as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast(rows.schema["_time"].dataType)
        newest = newest.select(as_of.alias("_as_of"))
    last_start = newest.select((F.col("_as_of") - length).alias("_s")).select(_floor_to(F.col("_s"), slide_s).alias("s"))
    rows = rows.withColumn("_last", last_start.scalar()).where(F.col("_time") < F.col("_last") + length)
    newest = rows.groupBy("_monitor").agg(F.max("_time").alias("_t"), F.first("_last").alias("_last"))
    start = newest.select("_monitor", "_last", F.window("_t", f"{slide_s} seconds")["start"].alias("_s"))
    start = start.select(F.col("_monitor").alias("_m"), F.least("_s", "_last").alias("_start"))
    met = rows.join(start, F.col("_monitor").eqNullSafe(F.col("_m"))).where(
        (F.col("_time") >= F.col("_start")) & (F.col("_time") < F.col("_start") + length))
    agg = met.groupBy("_m", "_start").agg(F.sum("_speed").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    return agg.select(F.col("_m").alias(monitor), truncating_average("_sum", "_n").alias("avg_speed"),
                      (F.col("_start") + length).alias("window_end"))


def latest_speed(windowed: DataFrame, as_of=None, slide: str = S.SPEED_SLIDE,
                 monitor: str = S.MONITOR) -> DataFrame:
    """``(monitor, avg_speed, window_end)``: per monitor the average of its
    newest window that has closed by ``as_of``.  Default ``as_of`` = the
    newest window start + ``slide``: the window that ends right after the
    newest reading (a window ending later is only partly filled).  The
    default is a scalar subquery, no join; ``as_of`` may be a scalar column
    such as :func:`closing_time` of the log the windows came from."""
    if as_of is None:
        as_of = windowed.agg(F.max("window_start") + F.expr(f"INTERVAL {slide}")).scalar()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of).cast(windowed.schema["window_end"].dataType)
    closed = windowed.where(F.col("window_end") <= as_of)
    return closed.groupBy(monitor).agg(
        F.max_by("avg_speed", "window_end").alias("avg_speed"),
        F.max("window_end").alias("window_end"))


def congestion_status(monitors: DataFrame, latest: DataFrame,
                      monitor: str = S.MONITOR) -> DataFrame:
    """``(monitor, avg_speed, level, reported)`` for every known monitor: its
    latest average speed, 0 when it never reported (``reported`` false), and
    the level <=5 jammed, <=10 severe, <=30 slow, else normal.  Readings
    without a monitor belong to the monitor NULL."""
    known = monitors.select(monitor).distinct()
    now = latest.select(F.col(monitor).alias("_latest_monitor"), "avg_speed")
    j = known.join(now, F.col(monitor).eqNullSafe(F.col("_latest_monitor")), "left")
    spd = F.coalesce(F.col("avg_speed"), F.lit(0)).cast("bigint")
    return j.select(monitor, spd.alias("avg_speed"), congestion_level(spd).alias("level"),
                    F.col("avg_speed").isNotNull().alias("reported"))
