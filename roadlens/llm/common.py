"""Helpers shared by the corpus operators: Arrow batch passes, per-process
caches, the shared scratch folder and two-level prefix sums.
"""

from __future__ import annotations

import contextlib
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadlens.plans.checkpoint import checkpoint_root

#: The white space of the word rule ``[^\x20\x09-\x0D]+`` (fixed value).
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"


def process_cache(key, make: Callable[[], object]):
    """One value per Python process and ``key``.  Task functions are shipped
    by value, so their own globals are new in every task; the cache lives in
    a module of its own and survives from task to task of a reused worker."""
    name = "_corpus_process_cache"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Sequence], schema: str,
                max_rows: int = 512) -> DataFrame:
    """``mapInArrow`` of ``fn`` over slices of at most ``max_rows`` rows.
    ``fn`` returns the arrays of ``schema`` in order; lists become arrays of
    the declared type."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, max_rows):
                cols = fn(batch.slice(at, max_rows))
                arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                          for c, f in zip(cols, target)]
                yield pa.RecordBatch.from_arrays(arrays, names=target.names)

    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written tables: the session's
    ``spark.checkpoint.dir`` (unset in tests on one machine: a folder of the
    library's own; unset on a cluster: an error)."""
    return checkpoint_root(spark)


#: Rows that go to a Python worker at a time while a table is written.
ARROW_ROWS = 1024


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS):
    """Holds the session's Arrow batches at ``rows`` rows: whole documents are
    long, and a batch is held several times over on its way to the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read again:
    cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpus/{name}-{uuid.uuid4().hex[:12]}"
    with arrow_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Remove the files of a table made by ``written`` that nothing reads any
    more (only ever a folder below the shared folder's ``corpus/``)."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    root = f"{shared_dir(spark)}/corpus/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/corpus/" in folder and folder.split("/corpus/")[0].split(":")[-1].lstrip("/") \
                == root.split("/corpus/")[0].split(":")[-1].lstrip("/"):
            p = jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def running_start(df: DataFrame, group: Sequence[str], value: str, order: Sequence[str],
                  out: str, bucket: Column, carry: Sequence[str]) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the same
    ``group`` that come before, in the order (bucket, ``order``).

    Two levels, so that a group with a third of all rows is no single task:
    sums per (group, bucket), running sums of those few rows, then running
    sums inside each (group, bucket).  Rows equal in all of ``order`` may
    swap places; give a total order up to equal rows."""
    rows = df.select(*group, value, *order, *carry, bucket.alias("_b"))
    sums = rows.groupBy(*group, "_b").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                         F.col("_b").alias("_gb"),
                         F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    inside = (Window.partitionBy(*group, "_b").orderBy(*[F.col(c).asc_nulls_first() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    on = F.col("_b") == F.col("_gb")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(starts, on)
            .withColumn(out, (F.col("_base") + F.col("_in")).cast("bigint"))
            .select(*dict.fromkeys([*group, value, *order, *carry, out])))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """``df`` as a written table with ``out``: the 0-based place of a row in
    its ``group`` by ``order`` (nulls first; equal rows in any fixed order).

    Rows are dealt by ranges of (group, order), so a group with a third of
    all rows, or of equal rows, lies in many tasks; a row's place is its place
    in its range plus the rows of the group in the ranges before.  The
    columns ``_salt``, ``_at``, ``_range``, ``_first`` and ``_base`` are used."""
    rows = written(df.withColumn("_salt", F.monotonically_increasing_id()), "unordered")
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order, "_salt"]]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = written(dealt.withColumn("_at", F.monotonically_increasing_id())
                    .withColumn("_range", F.shiftright("_at", 33)), "dealt")
    sizes = dealt.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_range").alias("_r"),
                          "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    on = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    placed = dealt.join(starts, on).withColumn(out, (F.col("_base") + F.col("_at") - F.col("_first")).cast("bigint"))
    placed = written(placed.select(*df.columns, out), "ranked")
    drop_written(rows)
    drop_written(dealt)
    return placed
