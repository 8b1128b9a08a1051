"""Append tables with a commit log (S14).

A batch writes its rows into a folder of its own attempt and then one small
manifest, put in place by a rename that never replaces a file.  Readers take
the files that manifests name and nothing else: not those of a batch that is
being written, nor of an attempt that failed or came second.  A batch that is
in the log is not written again, so a replay changes nothing.

:func:`compact` gathers all committed batches into one folder and one
manifest, which keeps the log short and the files large;
:func:`remove_uncommitted` deletes folders that no manifest in force names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_LOG, _DATA = "_commits", "data"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    fs = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(_path(spark, path))) if fs.exists(_path(spark, path)) else []


def write_file(spark: SparkSession, folder: str, name: str, text: str, replace: bool = False) -> bool:
    """Puts a small text file in place by a rename; without ``replace`` an
    existing one stays and the answer is False."""
    jvm, fs = spark._jvm, _fs(spark, folder)
    target, temporary = _path(spark, f"{folder}/{name}"), _path(spark, f"{folder}/.{name}.{uuid.uuid4().hex[:12]}")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE if replace else kinds.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(temporary), fs.makeQualified(target), options)
        return True
    except Exception:
        fs.delete(temporary, False)
        if replace or not fs.exists(target):
            raise
        return False


def _entries(spark: SparkSession, path: str) -> list[tuple[int, bool, str]]:
    """The log's entries in force, ``(batch, compacted, file name)``: the
    newest compacted one and the batches after it."""
    found = []
    for name in _names(spark, f"{path}/{_LOG}"):
        if not name.startswith(".") and name.endswith(".json"):
            batch, _, kind = name.removesuffix(".json").partition("-")
            found.append((int(batch), kind == "compact", name))
    start = max((b for b, whole, _ in found if whole), default=None)
    return sorted(e for e in found if start is None or (e[1] and e[0] == start) or (not e[1] and e[0] > start))


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids in force, ascending; a compacted entry stands for all up to its id."""
    return [b for b, _, _ in _entries(spark, path)]


def _read_entry(spark: SparkSession, path: str, name: str) -> dict:
    stream = _fs(spark, path).open(_path(spark, f"{path}/{_LOG}/{name}"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(df: DataFrame, path: str, name: str, folder: str) -> bool:
    spark = df.sparkSession
    df.write.parquet(f"{path}/{_DATA}/{folder}")
    files = [f"{folder}/{n}" for n in _names(spark, f"{path}/{_DATA}/{folder}") if n.endswith(".parquet")]
    return write_file(spark, f"{path}/{_LOG}", name, json.dumps({"files": files, "schema": df.schema.json()}))


def append_batch(df: DataFrame, path: str, batch_id: int) -> bool:
    """Adds a batch's rows to the table; False if the batch is there already."""
    spark, entries = df.sparkSession, _entries(df.sparkSession, path)
    if any(batch_id <= b if whole else batch_id == b for b, whole, _ in entries):
        return False
    return _commit(df, path, f"{batch_id:020d}.json", f"batch={batch_id}-{uuid.uuid4().hex[:12]}")


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches, as the log stands now."""
    entries = [_read_entry(spark, path, name) for _, _, name in _entries(spark, path)]
    if not entries:
        raise FileNotFoundError(f"no committed batch in {path}")
    files = [f"{path}/{_DATA}/{f}" for e in entries for f in e["files"]]
    schema = StructType.fromJson(json.loads(entries[-1]["schema"]))
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> int | None:
    """Writes all committed batches as one entry and returns its id (None
    where there is nothing to gather).  ``keep`` may reduce the rows, such as to
    the newest of each key; the old folders stay for their readers."""
    entries = _entries(spark, path)
    if not entries or (len(entries) == 1 and entries[0][1]):
        return None
    last = entries[-1][0]
    _commit(keep(read_committed(spark, path)), path, f"{last:020d}-compact.json", f"until={last}-{uuid.uuid4().hex[:12]}")
    return last


def remove_uncommitted(spark: SparkSession, path: str) -> list[str]:
    """Deletes the data folders that no entry in force names (attempts that
    failed, batches that were compacted).  For times without a writer and with
    no reader of an older state of the log."""
    named = {f.partition("/")[0] for _, _, name in _entries(spark, path) for f in _read_entry(spark, path, name)["files"]}
    spare = [n for n in _names(spark, f"{path}/{_DATA}") if n not in named]
    for name in spare:
        _fs(spark, path).delete(_path(spark, f"{path}/{_DATA}/{name}"), True)
    return spare


def commit_sink(path: str, sort_by: list[str] | None = None, compact_every: int | None = None) -> Callable:
    """foreachBatch writer of an append table with a commit log at
    ``path/table``; every ``compact_every``-th batch gathers the log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        from roadlens.streaming import _windows_to_ntz
        out = _windows_to_ntz(batch) if "window_start" in batch.columns else batch
        append_batch(out.sortWithinPartitions(*sort_by) if sort_by else out, f"{path}/table", batch_id)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, f"{path}/table")
    return write


def newest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` of every ``key``."""
    rest = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in rest])
    return best.select(*df.columns)
