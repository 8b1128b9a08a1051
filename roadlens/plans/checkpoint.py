"""Shared scratch space for streaming checkpoints and written tables: the
folder that ``spark.checkpoint.dir`` names, which all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or the context's checkpoint
    folder.  Without either, a run on one machine (``local[n]``, as in tests)
    gets a folder of its own; on a cluster this raises, for a folder of the
    local machine would be another one on every executor."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _LOCAL.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="roadlens-")
        _LOCAL[sc.applicationId] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/roadlens/{name}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: for a caller whose plan reads it
    in several branches.  It is computed once, and lost executors cost none of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made below the checkpoint root."""
    if "/roadlens/" not in path:
        raise ValueError(f"not a folder of this library: {path}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def finished_ids(spark: SparkSession, path: str, prefix: str = "batch_id=") -> list[int]:
    """Ids of the sub-folders ``<prefix><id>`` of ``path`` that a writer has
    finished (they hold its ``_SUCCESS`` mark), ascending."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    done = [n for n in names if n.startswith(prefix)
            and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix(prefix)) for n in done)
