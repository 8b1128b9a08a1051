"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """``(id, comp)`` for every id of ``edges (a, b)``: the smallest id of its
    component.

    Every round takes the smallest label of the neighbours and then follows
    the label's own label (pointer jumping), until nothing changes; each
    round is a written table in the shared folder."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("comp"))
                     .withColumnRenamed("a", "id"), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("_l")), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("_l").alias("_near")))
        low = labels.join(near, "id").select("id", F.col("comp").alias("_old"),
                                             F.least("comp", "_near").alias("_low"))
        # a label is an id of the same component, so its own label is too
        jumped = (low.join(labels.select(F.col("id").alias("_low"), F.col("comp").alias("_far")), "_low")
                  .select("id", "_old", F.least("_low", "_far").alias("comp")))
        new = written(jumped, "labels")
        changed = new.where(F.col("comp") != F.col("_old")).limit(1).count()
        drop_written(labels)
        labels = new.select("id", "comp")
        if not changed:
            drop_written(both)
            return labels
