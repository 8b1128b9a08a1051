"""Progress of a stream, kept as a table: one row per batch and stateful
operator, with the rows that came too late (section 2.5: late rows are
dropped *and counted*).
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from roadlens.streaming.commits import write_file

SCHEMA = ("query_id string, run_id string, batch_id bigint, watermark string, input_rows bigint, operator int, "
          "operator_name string, state_rows bigint, updated_rows bigint, removed_rows bigint, late_rows bigint")


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the query named ``query_name`` into ``folder``,
    one file per batch, put in place by a rename; a batch that is run again
    replaces its file.  A query without state has one row per batch, its
    operator null.  ``late_rows`` is what Spark counts: rows that reach the
    operator behind the watermark (for a windowed aggregate, groups)."""

    def __init__(self, spark: SparkSession, folder: str, query_name: str):
        self._spark, self._folder, self._name = spark, folder, query_name
        self._run, self._ended = None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self._name:
            self._run = event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self._name:
            return
        base = {"query_id": str(p.id), "run_id": str(p.runId), "batch_id": p.batchId,
                "watermark": dict(p.eventTime or {}).get("watermark"), "input_rows": p.numInputRows}
        rows = [base | {"operator": i, "operator_name": s.operatorName, "state_rows": s.numRowsTotal,
                        "updated_rows": s.numRowsUpdated, "removed_rows": s.numRowsRemoved,
                        "late_rows": s.numRowsDroppedByWatermark} for i, s in enumerate(p.stateOperators)]
        write_file(self._spark, self._folder, f"{p.id}-{p.batchId:020d}.json",
                   "\n".join(json.dumps(r) for r in rows or [base]), replace=True)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run:
            self._ended.set()

    def wait(self, seconds: float = 60.0) -> None:
        """Until the listener has seen the query's end (and so every batch)."""
        if not self._ended.wait(seconds):
            raise TimeoutError(f"the progress of {self._name} is not complete")


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(folder)
