"""Structured Streaming forms of the windowed operators and their sinks.

The same operator functions as in batch run on a streaming DataFrame
(``windowed_avg_speed``, ``windowed_count``); the stream adds an event-time
watermark so window state is dropped once the watermark passes it.  Sinks
use ``foreachBatch`` and are idempotent per ``batch_id`` (a replayed batch
replaces its own folder):

* :func:`commit_sink` — append mode: a commit log names the files of finished
  batches, and :func:`read_committed` reads those alone              (S14)
* :func:`table_sink`  — append/update mode writes ``table/batch=<id>``;
  complete mode writes the whole table as ``table/batch_id=<id>``     (S14)
* :func:`snapshot_sink` — complete-mode input: per batch recompute the
  congestion snapshot of every known monitor                          (S15)
* :func:`snapshot_merge_sink` — append-mode input (the production form):
  merge the batch's closed windows into the previous batch's per-monitor
  state and write ``state/`` and ``snapshot/`` per batch id           (S15)

What is replaced as a whole (complete tables, snapshots, states) is written
to a folder of its batch, and the last two are kept.  :func:`read_current`
reads the newest finished one, so a reader never meets a half-written table.

:func:`start_stream` runs a query with a processing-time trigger (5 s in
the original jobs); :func:`run_available_now` processes what is available
and stops, resuming from an earlier folder's checkpoint when given one.
Checkpoints and outputs live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlens import schemas as S
from roadlens.operators.windows import (
    congestion_status, latest_speed, windowed_avg_speed, windowed_count,
)
from roadlens.plans.checkpoint import finished_ids, remove_folder, scratch_path
from roadlens.streaming.commits import (
    append_batch, commit_sink, committed_batches, compact, newest_per_key, read_committed, remove_uncommitted,
)
from roadlens.streaming.keyed import stream_latest_speed
from roadlens.streaming.progress import ProgressLog, read_progress


def as_event_time(df: DataFrame, time: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (with local time zone); a TIMESTAMP_NTZ
    column is cast in the session time zone (use UTC for exact windows
    across daylight-saving changes)."""
    if df.schema[time].dataType.typeName() == "timestamp_ntz":
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    return df


def _windows_to_ntz(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
              .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


def stream_avg_speed(log_stream: DataFrame, watermark: str = "1 minute",
                     window: str = S.SPEED_WINDOW, slide: str = S.SPEED_SLIDE,
                     monitor: str = S.MONITOR, speed: str = S.SPEED) -> DataFrame:
    """Streaming ``windowed_avg_speed`` with an event-time watermark."""
    s = as_event_time(log_stream).withWatermark("event_time", watermark)
    # one stateful aggregate, which complete mode asks for; see stream_avg_speed_panes
    return windowed_avg_speed(s, window, slide, "event_time", monitor, speed, panes=False)


def stream_avg_speed_panes(log_stream: DataFrame, watermark: str = "1 minute",
                           window: str = S.SPEED_WINDOW, slide: str = S.SPEED_SLIDE,
                           monitor: str = S.MONITOR, speed: str = S.SPEED) -> DataFrame:
    """The same windows in append mode without a state row per reading and
    window: readings are summed per pane (state: one row per monitor and open
    pane), and a pane that the watermark has closed is spread over the windows
    that cover it.  The watermark passes on from the first aggregate to the
    second.  A reading is late when its pane is closed."""
    s = as_event_time(log_stream).withWatermark("event_time", watermark)
    return windowed_avg_speed(s, window, slide, "event_time", monitor, speed, panes=True)


def stream_window_count(stream: DataFrame, value: str = "value", watermark: str = "1 minute",
                        window: str = S.TOKEN_WINDOW, slide: str = S.TOKEN_SLIDE) -> DataFrame:
    """Streaming ``windowed_count`` with an event-time watermark."""
    s = as_event_time(stream).withWatermark("event_time", watermark)
    return windowed_count(s, value, window, slide, "event_time")


#: Finished versions of a replaced table that stay: the newest and the one before.
KEEP_VERSIONS = 2


def _publish(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a whole version of a table and drop the versions before the last."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    spark = df.sparkSession
    for old in [i for i in finished_ids(spark, path) if i <= batch_id][:-KEEP_VERSIONS]:
        remove_folder(spark, f"{path}/batch_id={old}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version of a table that a sink replaces per batch."""
    done = finished_ids(spark, path)
    if not done:
        raise FileNotFoundError(f"no finished version in {path}")
    return spark.read.parquet(f"{path}/batch_id={done[-1]}")


def table_sink(path: str, mode: str, sort_by: list[str] | None = None) -> Callable:
    """foreachBatch writer; see module doc.  Complete tables are read with
    :func:`read_current`, append tables as ``<path>/table``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = _windows_to_ntz(batch) if "window_start" in batch.columns else batch
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
        if mode == "complete":
            _publish(out, f"{path}/table", batch_id)
        else:
            out.write.mode("overwrite").parquet(f"{path}/table/batch={batch_id}")
    return write


def snapshot_sink(path: str, monitors: DataFrame, slide: str = S.SPEED_SLIDE,
                  monitor: str = S.MONITOR) -> Callable:
    """foreachBatch writer of the congestion snapshot (complete-mode input:
    every batch holds all windows, so the snapshot is recomputed whole)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # used twice (cutoff subquery and main aggregate): keep the batch
        # result instead of re-running the micro-batch plan
        w = _windows_to_ntz(batch).persist()
        try:
            snap = congestion_status(monitors, latest_speed(w, slide=slide, monitor=monitor), monitor)
            _publish(snap, f"{path}/snapshot", batch_id)
        finally:
            w.unpersist()
    return write


def snapshot_merge_sink(path: str, monitors: DataFrame, monitor: str = S.MONITOR) -> Callable:
    """foreachBatch writer for append-mode input (each batch holds only the
    windows the watermark has closed): the latest window per monitor is
    merged with the state of the previous batch and written as
    ``state/batch_id=<id>`` (at most one row per monitor); the congestion
    snapshot of every known monitor goes to ``snapshot/batch_id=<id>``.
    Each batch reads only the previous batch's state, so the work per batch
    does not grow with the stream's age; a replayed batch overwrites its
    own folders.  Only batch 0 starts without a state; later, a missing one
    is an error, for going on would forget every monitor's last speed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        w = _windows_to_ntz(batch).select(monitor, "avg_speed", "window_end")
        if batch_id > 0:
            if batch_id - 1 not in finished_ids(spark, f"{path}/state"):
                raise RuntimeError(f"the state of batch {batch_id - 1} is missing in {path}/state")
            prev = spark.read.parquet(f"{path}/state/batch_id={batch_id - 1}")
            w = w.unionByName(prev.select(monitor, "avg_speed", "window_end"))
        state = w.groupBy(monitor).agg(F.max_by("avg_speed", "window_end").alias("avg_speed"),
                                       F.max("window_end").alias("window_end"))
        _publish(state, f"{path}/state", batch_id)
        latest = spark.read.parquet(f"{path}/state/batch_id={batch_id}")
        _publish(congestion_status(monitors, latest, monitor), f"{path}/snapshot", batch_id)
    return write


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot written by a snapshot sink."""
    return read_current(spark, f"{path}/snapshot")


def start_stream(sdf: DataFrame, make_sink: Callable[[str], Callable], folder: str,
                 output_mode: str = "append", every: str = S.SPEED_SLIDE):
    """Production start: a micro-batch every ``every`` (5 s in the original
    jobs), checkpoint in ``folder/checkpoint``; a restart with the same
    folder resumes from the last committed batch.  Returns the query."""
    return (sdf.writeStream.outputMode(output_mode)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .foreachBatch(make_sink(folder))
            .trigger(processingTime=every)
            .start())


def run_available_now(sdf: DataFrame, make_sink: Callable[[str], Callable], name: str,
                      output_mode: str = "complete", timeout_s: int | None = None,
                      folder: str | None = None, resumable: bool = True, progress: bool = False) -> str:
    """Run a streaming query over everything available now, with a
    checkpoint in the shared folder; ``make_sink(folder)`` gives the
    foreachBatch writer.  Passing the ``folder`` of an earlier run resumes
    from its checkpoint (only new input is read); ``resumable=False`` removes
    the checkpoint after the run.  ``timeout_s`` stops a run that takes
    longer (default: no limit).  ``progress`` keeps a row per batch and
    stateful operator in ``<folder>/progress``, late rows among them (read it
    with :func:`read_progress`).  Returns the folder."""
    spark = sdf.sparkSession
    base = folder or scratch_path(spark, name)
    run_name = f"{name}-{uuid.uuid4().hex[:12]}"
    log = ProgressLog(spark, f"{base}/progress", run_name) if progress else None
    if log:
        spark.streams.addListener(log)
    try:
        q = (sdf.writeStream.outputMode(output_mode).queryName(run_name)
             .option("checkpointLocation", f"{base}/checkpoint")
             .foreachBatch(make_sink(base))
             .trigger(availableNow=True)
             .start())
        q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
        if q.isActive:
            q.stop()
            raise TimeoutError(f"stream {name} did not finish")
        if log:
            log.wait()
    finally:
        if log:
            spark.streams.removeListener(log)
    if q.exception() is not None:
        raise q.exception()
    if not resumable:
        remove_folder(sdf.sparkSession, f"{base}/checkpoint")
    return base


__all__ = [
    "as_event_time", "stream_avg_speed", "stream_avg_speed_panes", "stream_window_count", "stream_latest_speed",
    "table_sink", "snapshot_sink", "snapshot_merge_sink", "read_current", "latest_snapshot", "start_stream",
    "run_available_now", "commit_sink", "append_batch", "read_committed", "committed_batches", "compact",
    "remove_uncommitted", "newest_per_key", "ProgressLog", "read_progress",
]
