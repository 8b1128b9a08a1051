"""Batch operators over the vehicle log (Q04-Q10).

Column roles are parameters; defaults are the vehicle-log names.  Every
top-k adds the key as the last sort column so ties are broken the same way
on any partitioning, and is planned as ``TakeOrderedAndProject`` (a top-k
per task, then one merge of k rows per task) after a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roadlens import schemas as S
from roadlens.functions import format_log_time, hour_of_text, hour_of_time, is_over
from roadlens.plans import bounded_broadcast, ordered_steps


#: Parts in which the cells of one row of the transition matrix meet their row sum.
ROW_PARTS = 16


def _topk(df: DataFrame, by, n: int) -> DataFrame:
    return df.orderBy(*by).limit(n)


def top_monitors(log: DataFrame, n: int = S.TOP_K, ascending: bool = False,
                 monitor: str = S.MONITOR) -> DataFrame:
    """``(monitor, vehicleNum)``: readings per monitor (vehicles are not
    de-duplicated), the ``n`` busiest (or, ``ascending``, the quietest)."""
    counts = log.groupBy(monitor).agg(F.count(F.lit(1)).alias("vehicleNum"))
    order = F.asc("vehicleNum") if ascending else F.desc("vehicleNum")
    return _topk(counts, [order, F.asc_nulls_first(monitor)], n)


def top_speed_readings(log: DataFrame, over: float = S.OVER_SPEED, n: int = S.TOP_K,
                       monitor: str = S.MONITOR, speed: str = S.SPEED,
                       tie: Sequence[str] = ()) -> DataFrame:
    """``(monitor, speed)`` of the ``n`` fastest single readings above
    ``over`` (strict); a monitor may appear more than once.  NaN is no speed."""
    fast = log.where(is_over(speed, over))
    by = [F.desc(speed), F.asc_nulls_first(monitor)] + [F.asc_nulls_first(t) for t in tie]
    return _topk(fast, by, n).select(monitor, speed)


def top_speeding_monitors(log: DataFrame, over: float = S.OVER_SPEED, n: int = S.TOP_K,
                          monitor: str = S.MONITOR, speed: str = S.SPEED) -> DataFrame:
    """``(monitor, vehicleNum)``: over-speed readings per monitor, top ``n``."""
    counts = (log.where(is_over(speed, over))
              .groupBy(monitor).agg(F.count(speed).alias("vehicleNum")))
    return _topk(counts, [F.desc("vehicleNum"), F.asc_nulls_first(monitor)], n)


def top_speeding_monitors_sql(log: DataFrame, over: float = S.OVER_SPEED, n: int = S.TOP_K,
                              monitor: str = S.MONITOR, speed: str = S.SPEED) -> DataFrame:
    """The same answer through SQL (the original's form).  The DataFrame is a
    parameter of the statement, so no view of the session is touched."""
    return log.sparkSession.sql(
        f"SELECT `{monitor}`, COUNT(`{speed}`) AS vehicleNum FROM {{log}} "
        f"WHERE `{speed}` > :over AND `{speed}` <> DOUBLE('NaN') GROUP BY `{monitor}` "
        f"ORDER BY vehicleNum DESC, `{monitor}` ASC NULLS FIRST LIMIT :n", {"over": over, "n": n}, log=log)


def busiest_hours(log: DataFrame, n: int = S.TOP_K, time: str = "event_time",
                  raw_text: bool = False) -> DataFrame:
    """``(hour, vehicleNum)``: readings per hour of day, top ``n``.  A missing
    or malformed time is the hour ``""`` and is kept as a group.  With
    ``raw_text`` the hour is cut from a ``dd/MM/yyyy HH:mm:ss`` text column
    without validation, as the original does."""
    hour = hour_of_text(time) if raw_text else hour_of_time(time)
    counts = log.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("vehicleNum"))
    return _topk(counts, [F.desc("vehicleNum"), F.asc("hour")], n)


# --------------------------------------------------------------------------
# device status (Q08): declared cameras vs cameras seen in the log
# --------------------------------------------------------------------------
def _declared_seen(dim: DataFrame, log: DataFrame, monitor: str, camera: str):
    declared = dim.select(monitor, camera).where(F.col(camera).isNotNull())
    seen = log.select(monitor, camera).where(F.col(camera).isNotNull()).distinct()
    return declared, seen


def _missing_pairs(declared: DataFrame, seen: DataFrame, monitor: str, camera: str) -> DataFrame:
    """Declared (monitor, camera) pairs that never reported."""
    d, s = declared.distinct().alias("d"), seen.alias("s")
    cond = (F.col(f"d.{monitor}").eqNullSafe(F.col(f"s.{monitor}"))
            & (F.col(f"d.{camera}") == F.col(f"s.{camera}")))
    return d.join(s, cond, "left_anti").select(F.col(f"d.{monitor}").alias(monitor),
                                              F.col(f"d.{camera}").alias(camera))


def _size_errors(declared: DataFrame, seen: DataFrame, monitor: str) -> DataFrame:
    """Monitors whose number of declared cameras (a list: duplicates count)
    differs from the number of distinct cameras seen (undeclared ones too)."""
    nd = declared.groupBy(monitor).agg(F.count(F.lit(1)).alias("_nd"))
    ns = seen.groupBy(monitor).agg(F.count(F.lit(1)).alias("_ns"))
    j = nd.alias("a").join(ns.alias("b"), F.col(f"a.{monitor}").eqNullSafe(F.col(f"b.{monitor}")), "left")
    return (j.where(F.col("_nd") != F.coalesce(F.col("_ns"), F.lit(0)))
            .select(F.col(f"a.{monitor}").alias(monitor)))


def error_monitors(dim: DataFrame, log: DataFrame, mode: str = "content",
                   monitor: str = S.MONITOR, camera: str = S.CAMERA) -> DataFrame:
    """``(monitor)`` of every declared monitor in error.  ``mode='content'``:
    some declared camera never reported; ``mode='size'``: the number of
    declared cameras differs from the number of distinct cameras seen (the
    original rule).  Monitors only present in the log are ignored."""
    declared, seen = _declared_seen(dim, log, monitor, camera)
    if mode == "size":
        return _size_errors(declared, seen, monitor).orderBy(monitor)
    if mode != "content":
        raise ValueError(f"mode must be 'content' or 'size', not {mode!r}")
    return _missing_pairs(declared, seen, monitor, camera).select(monitor).distinct().orderBy(monitor)


def error_cameras(dim: DataFrame, log: DataFrame, mode: str = "content",
                  monitor: str = S.MONITOR, camera: str = S.CAMERA) -> DataFrame:
    """``(monitor, camera)``: declared cameras of error monitors that never
    reported (all cameras of a silent monitor)."""
    declared, seen = _declared_seen(dim, log, monitor, camera)
    missing = _missing_pairs(declared, seen, monitor, camera)
    if mode == "size":
        errs = _size_errors(declared, seen, monitor)
        missing = missing.join(errs, missing[monitor].eqNullSafe(errs[monitor]), "left_semi")
    elif mode != "content":
        raise ValueError(f"mode must be 'content' or 'size', not {mode!r}")
    return missing.orderBy(monitor, camera)


def status_summary(dim: DataFrame, log: DataFrame, mode: str = "content",
                   monitor: str = S.MONITOR, camera: str = S.CAMERA) -> DataFrame:
    """One row ``(monitors, error_monitors, error_cameras, all_ok)``.

    Both sides are brought together once: a row per (monitor, camera) with how
    often it is declared and whether it was seen, added up per monitor, then
    over all monitors."""
    if mode not in ("content", "size"):
        raise ValueError(f"mode must be 'content' or 'size', not {mode!r}")
    sides = (dim.select(F.col(monitor).alias("m"), F.col(camera).alias("c"), F.lit(1).alias("d"), F.lit(0).alias("s"))
             .unionByName(log.select(F.col(monitor).alias("m"), F.col(camera).alias("c"), F.lit(0).alias("d"), F.lit(1).alias("s"))))
    # a monitor that is only declared with a missing camera is still a monitor
    pairs = sides.groupBy("m", "c").agg(F.sum("d").alias("d"), F.max("s").alias("s"))
    real = F.col("c").isNotNull()
    per = pairs.groupBy("m").agg(
        F.sum("d").alias("rows"), F.sum(F.when(real, F.col("d")).otherwise(0)).alias("declared"),
        F.count_if(real & (F.col("s") == 1)).alias("seen"), F.count_if(real & (F.col("d") > 0) & (F.col("s") == 0)).alias("silent"))
    wrong = (F.col("silent") > 0) if mode == "content" else (F.col("declared") > 0) & (F.col("declared") != F.col("seen"))
    return per.agg(F.count_if(F.col("rows") > 0).alias("monitors"), F.count_if(wrong).alias("error_monitors"),
                   F.coalesce(F.sum(F.when(wrong, F.col("silent"))), F.lit(0)).alias("error_cameras")) \
        .withColumn("all_ok", F.col("error_monitors") == 0)


# --------------------------------------------------------------------------
# sequences per vehicle (Q09, Q10)
# --------------------------------------------------------------------------
def _time_bucket(time: str, width: str) -> Column:
    """The part of a vehicle's trace that one task orders: readings of one
    ``width`` (``hour``, ``day``, ...) of the time column."""
    return F.date_trunc(width, F.col(time))


def _numeric_text(monitor: str) -> list[Column]:
    """Order of monitor ids: digit strings as numbers, other text after them."""
    return [F.col(monitor).try_cast("bigint").alias("_tie_number"), F.col(monitor).cast("string").alias("_tie_text")]


def _ordered_log(log: DataFrame, plate: str, monitor: str, time: str, tie: Sequence[str] | None):
    """The log's needed columns and its order: by time, then by ``tie``
    (default: the monitor, numerically)."""
    if tie is not None:
        return log.select(*dict.fromkeys([plate, time, monitor, *tie])), [time, *tie]
    return log.select(*dict.fromkeys([plate, time, monitor]), *_numeric_text(monitor)), [time, "_tie_number", "_tie_text"]


def conversion_rate(log: DataFrame, a, b, count_tail: bool = True,
                    plate: str = S.PLATE, monitor: str = S.MONITOR,
                    time: str = "event_time", tie: Sequence[str] | None = None,
                    bucket: str = "hour") -> DataFrame:
    """One row ``(a, b, a_total, ab_total, rate_pct)``: ``a_total`` readings
    at ``a``; ``ab_total`` times a vehicle's next reading after ``a`` is at
    ``b``; ``rate_pct`` = 100 * ab/a rounded to 5 places (NULL if a_total
    is 0).  ``count_tail=False`` does not count an a->b that ends a trace
    (the original's text-split rule); a reading without a monitor is a
    reading like any other.  Readings of one time are in the order of ``tie``
    (default: the monitor id as a number).  A vehicle's order is made per
    ``bucket`` of time (``ordered_steps``), so no task holds a whole trace."""
    rows, order = _ordered_log(log, plate, monitor, time, tie)
    seq = ordered_steps(rows, plate, order, [monitor], _time_bucket(time, bucket), lookahead=1 if count_tail else 2)
    is_a = F.col(monitor) == F.lit(a)
    hit = is_a & (F.col(f"next1_{monitor}") == F.lit(b))
    if not count_tail:
        hit = hit & F.col("next2")
    agg = seq.agg(F.count_if(is_a).alias("a_total"), F.count_if(hit).alias("ab_total"))
    return agg.select(F.lit(str(a)).alias("a"), F.lit(str(b)).alias("b"),
                      "a_total", "ab_total",
                      F.round(F.try_divide(F.col("ab_total") * 100.0, F.col("a_total")), 5)
                      .alias("rate_pct"))


def conversion_matrix(log: DataFrame, count_tail: bool = True, plate: str = S.PLATE, monitor: str = S.MONITOR,
                      time: str = "event_time", tie: Sequence[str] | None = None, bucket: str = "hour") -> DataFrame:
    """``(a, b, a_total, ab_total, rate_pct)`` for every two monitors that
    follow one another in some trace: the sparse transition matrix.  A row's
    (a, b) cell equals ``conversion_rate(log, a, b)``; ``a_total`` is the row
    sum with the traces that end at ``a``.  A reading without a monitor is
    the monitor NULL.

    One pass over the ordered log: cells are counted inside the tasks, a
    trace's end as a cell of its own, and the row sums come from the cells,
    not from the readings.  The sums of a monitor's cells are first made in
    parts, so a monitor that is followed by very many others is no single task."""
    rows, order = _ordered_log(log, plate, monitor, time, tie)
    seq = ordered_steps(rows, plate, order, [monitor], _time_bucket(time, bucket), lookahead=1 if count_tail else 2)
    cells = seq.groupBy(F.col(monitor).alias("a"), F.col(f"next1_{monitor}").alias("b"), F.col("next1").alias("_has")).agg(
        F.count(F.lit(1)).alias("_n"), (F.count(F.lit(1)) if count_tail else F.count_if("next2")).alias("ab_total"))
    part = F.pmod(F.xxhash64("b"), F.lit(ROW_PARTS)).cast("int")
    cells = cells.withColumn("_part", part)
    sums = cells.groupBy("a", "_part").agg(F.sum("_n").alias("_s")).groupBy("a").agg(F.sum("_s").alias("a_total"))
    sums = sums.select(F.col("a").alias("_a"), "a_total", F.explode(F.sequence(F.lit(0), F.lit(ROW_PARTS - 1))).alias("_p"))
    met = cells.where("_has").join(sums, F.col("a").eqNullSafe(F.col("_a")) & (F.col("_part") == F.col("_p")))
    rate = F.round(F.try_divide(F.col("ab_total") * 100.0, F.col("a_total")), 5)
    return met.where("ab_total > 0").select("a", "b", "a_total", "ab_total", rate.alias("rate_pct"))


def sample_vehicles(log: DataFrame, n: int = S.TOP_K, seed: int = 42,
                    plate: str = S.PLATE) -> DataFrame:
    """``(plate)``: ``n`` distinct vehicles drawn uniformly without
    replacement — ordered by ``md5(seed:plate)`` — deterministic for a seed
    and the same in any SQL engine with ``md5``."""
    d = log.select(plate).where(F.col(plate).isNotNull()).distinct()
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(plate).cast("string")))
    return d.orderBy(h, F.col(plate)).limit(n)


def sample_vehicles_of_many(log: DataFrame, n: int = S.TOP_K, seed: int = 42, plate: str = S.PLATE) -> DataFrame:
    """The answer of :func:`sample_vehicles` where there are very many
    vehicles: only readings whose hash is below a cut are looked at, which by
    the approximate number of vehicles lets about ``4 * n + 20`` through.  Runs
    two small jobs when called; should fewer than ``n`` vehicles pass, all are taken."""
    spark = log.sparkSession
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(plate).cast("string")))
    rows = log.select(plate, h.alias("_h")).where(F.col(plate).isNotNull())
    share = (4 * n + 20) / max(1, rows.agg(F.approx_count_distinct(plate)).first()[0])
    if share < 1:
        # the same order as by the text: a prefix of eight hexadecimal digits
        few = rows.where(F.col("_h") < f"{int(share * 2 ** 32):08x}").distinct().orderBy("_h", plate).limit(n)
        found = [(r[0],) for r in few.select(plate).collect()]  # at most n rows
        if len(found) == n:
            return spark.createDataFrame(found, log.select(plate).schema)
    return sample_vehicles(log, n, seed, plate)


def vehicle_trace(log: DataFrame, keys: DataFrame, key_bound: int | None = None,
                  segment_steps: int | None = None, plate: str = S.PLATE,
                  monitor: str = S.MONITOR, time: str = "event_time",
                  tie: Sequence[str] | None = None, bucket: str = "hour") -> DataFrame:
    """``(plate, trace)``: the readings of the vehicles in ``keys`` in time
    order as ``dd/MM/yyyy HH:mm:ss @ monitor->...``, one row and one text per
    vehicle; every reading is in it, a missing time or monitor as ``null``.

    A trace is one value, so a vehicle with very many readings makes a very
    long text.  ``segment_steps=n`` cuts it into rows of ``n`` readings, with
    a column ``segment`` (0, 1, ...; joined by ``->`` they give the trace).
    ``keys`` is broadcast only when ``key_bound`` proves it small."""
    rows, order = _ordered_log(log, plate, monitor, time, tie)
    rows = rows.join(bounded_broadcast(keys.select(plate), key_bound), plate, "left_semi")
    text = lambda c: F.coalesce(c, F.lit(S.TRACE_MISSING))
    point = F.concat(text(format_log_time(time)), F.lit(S.TRACE_POINT_SEP), text(F.col(monitor).cast("string")))
    if segment_steps is None:
        place = F.struct(*[F.col(o) for o in order], point.alias("p"))
        pts, by = rows.select(plate, place.alias("sp")), [plate]
    else:
        seq = ordered_steps(rows, plate, order, [monitor], _time_bucket(time, bucket), with_step=True)
        pts = seq.select(plate, F.expr(f"step div {int(segment_steps)}").alias("segment"),
                         F.struct(F.col("step"), point.alias("p")).alias("sp"))
        by = [plate, "segment"]
    # sort_array puts NULL first, as the order does
    return (pts.groupBy(*by)
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list("sp")), lambda x: x["p"]),
                              S.TRACE_STEP_SEP).alias("trace")))
