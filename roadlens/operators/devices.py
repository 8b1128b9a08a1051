"""Device status from bitmaps kept by period (Q08).

The cameras that a monitor's readings came from are bits: camera ``c`` is bit
``c mod 64`` of word ``c div 64``, and a row holds one word of one monitor.
Words of several periods are merged by OR, so a new period is added by reading
its own readings alone, and the status of any set of periods is told without
the log.  Exact for all integer ids; dense ids take a row for 64 cameras.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens import schemas as S


def seen_bitmaps(log: DataFrame, monitor: str = S.MONITOR, camera: str = S.CAMERA) -> DataFrame:
    """``(monitor, word, bits)`` of the cameras seen; readings without a camera
    count for none.  Partial ORs are made before the shuffle."""
    if log.schema[camera].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"bitmaps need integer camera ids, not {log.schema[camera].dataType.simpleString()}")
    c = F.col(camera).cast("bigint")
    rows = log.where(c.isNotNull()).select(F.col(monitor), F.shiftright(c, 6).alias("word"),
                                           F.expr(f"shiftleft(1L, CAST(CAST(`{camera}` AS BIGINT) & 63 AS INT))").alias("bit"))
    return rows.groupBy(monitor, "word").agg(F.bit_or("bit").alias("bits"))


def merged(bitmaps: DataFrame, monitor: str = S.MONITOR) -> DataFrame:
    return bitmaps.groupBy(monitor, "word").agg(F.bit_or("bits").alias("bits"))


def add_period(path: str, period: int, log: DataFrame, monitor: str = S.MONITOR, camera: str = S.CAMERA) -> bool:
    """Adds the bitmaps of a period's readings to the table at ``path`` (with
    a commit log, so a period counts once); False if it is there already."""
    from roadlens.streaming.commits import append_batch

    return append_batch(seen_bitmaps(log, monitor, camera), path, period)


def kept_bitmaps(spark, path: str, monitor: str = S.MONITOR) -> DataFrame:
    """The merged bitmaps of all periods at ``path``."""
    from roadlens.streaming.commits import read_committed

    return merged(read_committed(spark, path), monitor)


def error_monitors_of_bitmaps(dim: DataFrame, bitmaps: DataFrame, mode: str = "size",
                              monitor: str = S.MONITOR, camera: str = S.CAMERA) -> DataFrame:
    """The answer of ``error_monitors`` from merged ``bitmaps``."""
    if mode not in ("content", "size"):
        raise ValueError(f"mode must be 'content' or 'size', not {mode!r}")
    declared = dim.where(F.col(camera).isNotNull())
    if mode == "size":
        n = declared.groupBy(F.col(monitor).alias("m")).agg(F.count(F.lit(1)).alias("n"))
        seen = bitmaps.groupBy(F.col(monitor).alias("s")).agg(F.sum(F.bit_count("bits")).alias("k"))
        wrong = n.join(seen, F.col("m").eqNullSafe(F.col("s")), "left").where(F.col("n") != F.coalesce("k", F.lit(0)))
    else:
        wrong = _silent_words(declared, bitmaps, monitor, camera).select("m").distinct()
    return wrong.select(F.col("m").alias(monitor)).orderBy(monitor)


def error_cameras_of_bitmaps(dim: DataFrame, bitmaps: DataFrame, monitor: str = S.MONITOR, camera: str = S.CAMERA) -> DataFrame:
    """The answer of ``error_cameras`` (content mode): the bits declared and not seen."""
    silent = _silent_words(dim.where(F.col(camera).isNotNull()), bitmaps, monitor, camera)
    bit = F.explode(F.expr("filter(sequence(0, 63), i -> getbit(silent, i) = 1)")).alias("i")
    kind = dim.schema[camera].dataType
    return (silent.select("m", "w", bit)
            .select(F.col("m").alias(monitor), (F.col("w") * 64 + F.col("i")).cast(kind).alias(camera)).orderBy(monitor, camera))


def _silent_words(declared: DataFrame, bitmaps: DataFrame, monitor: str, camera: str) -> DataFrame:
    """``(m, w, silent)``: words of declared bits that were not seen."""
    want = seen_bitmaps(declared, monitor, camera).select(F.col(monitor).alias("m"), F.col("word").alias("w"), F.col("bits").alias("d"))
    got = bitmaps.select(F.col(monitor).alias("s"), F.col("word").alias("v"), F.col("bits").alias("b"))
    met = want.join(got, F.col("m").eqNullSafe(F.col("s")) & (F.col("w") == F.col("v")), "left")
    silent = F.col("d").bitwiseAND(F.bitwise_not(F.coalesce("b", F.lit(0).cast("bigint"))))
    return met.select("m", "w", silent.alias("silent")).where("silent <> 0")
