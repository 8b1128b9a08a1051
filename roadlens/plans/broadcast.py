"""Broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest row bound we broadcast on the strength of a static bound alone.
MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, row_bound: int | None,
                      max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint ``broadcast`` when ``df`` provably has at most ``row_bound`` rows
    (a ``limit(n)``, one row per partition, ...) and that bound is small.
    Otherwise return ``df`` unchanged: the planner then decides from runtime
    statistics (AQE converts to a broadcast join only under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``), and a sort-merge
    join is used beyond it."""
    if row_bound is not None and row_bound <= max_rows:
        return F.broadcast(df)
    return df
