"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query binds an operator to the driver tables through the role
bindings of ``roadlens.sources`` and runs over whole tables.  Every oracle
SQL string computes the same columns (same names) from the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadlens import operators as O, schemas as S, streaming as ST
from roadlens.plans import scratch_path
from roadlens.sources import (
    document_lines, events_as_log, log_as_lines, order_cameras, parse_stream_log, parse_vehicle_log, part_ego_lists,
    read_stream, split_lines, vehicle_log,
)

# ---------------------------------------------------------------------------
# Binding parameters of the driver queries
# ---------------------------------------------------------------------------
WORD_NEEDLE = "the"              # Q01 keeps lines containing this text
SPEED_OVER = 50                  # Q05/Q06 threshold on events.value
SAMPLE_SEED, SAMPLE_N = 42, 10   # Q10 sample
CONVERT_A, CONVERT_B = "view", "purchase"   # Q09 over cameraId (event_type)
CONVERT_FROM, CONVERT_TO = 7, 8  # Q09 over the monitor itself
QUANTITY_OVER = 40               # Q05/Q06 second binding: l_quantity per l_suppkey
STREAM_WATERMARK = "1 hour"
TIE = ["event_id"]               # events has a unique id for readings of one time
TRACE_SEGMENT = 10               # readings per row of the segmented traces
ARRIVALS, SLOW_CAMERA = 4, "error"   # parts in which the log arrives; readings of this camera come one part later


def _log(spark, d):
    return vehicle_log(spark, d)


def _sample_keys(spark, d):
    return O.sample_vehicles(_log(spark, d), SAMPLE_N, SAMPLE_SEED)


def _latest(spark, d):
    return O.latest_speed_of_log(_log(spark, d))


def _conversion(spark, d, **options):
    return O.conversion_rate(_log(spark, d), CONVERT_A, CONVERT_B, monitor=S.CAMERA, tie=TIE, **options)


def _lineitem_log(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet")


# --- text lines: the log rendered as lines, and parsed again ----------------
def _vehicle_lines(spark, d):
    """Lines of the batch log, each followed by one that is no log line."""
    lines = log_as_lines(_log(spark, d), S.LOG_TIME_FORMAT)
    return lines.select(F.explode(F.array("value", F.lit(S.ILLEGAL_LOG))).alias("value"))


def _parsed_log(spark, d):
    return parse_vehicle_log(_vehicle_lines(spark, d)).select(
        "event_time", S.PLATE, S.SPEED, S.MONITOR, S.CAMERA)


def _rejected_lines(spark, d):
    """Lines of the log by outcome, from the two outputs of one pass."""
    records, rejected, _ = split_lines(_vehicle_lines(spark, d), S.VEHICLE_LOG, scratch_path(spark, "lines"))
    outcomes = rejected.select("reason").unionByName(records.select(F.lit("record").alias("reason")))
    return outcomes.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


# --- device status from bitmaps, kept by the year of the reading -------------
def _camera_bitmaps(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias(S.MONITOR), F.col("o_orderkey").alias(S.CAMERA))
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_shipdate", F.col("l_orderkey").alias(S.CAMERA))
    first, last = lines.agg(F.min(F.year("l_shipdate")), F.max(F.year("l_shipdate"))).first()
    path = scratch_path(spark, "bitmaps")
    O.add_period(path, 0, lines.where("l_shipdate IS NULL").join(orders, S.CAMERA))
    for year in range(first, last + 1) if first is not None else ():
        of_year = lines.where((F.col("l_shipdate") >= f"{year}-01-01") & (F.col("l_shipdate") < f"{year + 1}-01-01"))
        O.add_period(path, year, of_year.join(orders, S.CAMERA))
    return orders, O.kept_bitmaps(spark, path)


# --- streaming forms: the events table read by the file source --------------
def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    """``events.parquet`` as a stream, a file or a folder: the file source
    reads folders and globs, so its own folder is named, and a filter on the
    file's path leaves out the siblings."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return events_as_log(read_stream(spark, "parquet", schema=schema, path=f"{d}/events.parque[t]"))


def _line_stream(spark, d):
    lines = log_as_lines(_event_stream(spark, d), S.STREAM_TIME_FORMAT)
    lines = lines.select(F.explode(F.array("value", F.lit(S.ILLEGAL_LOG))).alias("value"))
    return parse_stream_log(lines)


def _table_of(spark, sdf, name, mode, sort_by=None):
    """Runs a stream over all that there is and reads its table."""
    if mode == "complete":
        base = ST.run_available_now(sdf, lambda p: ST.table_sink(p, mode, sort_by), name, mode, resumable=False)
        return ST.read_current(spark, f"{base}/table")
    base = ST.run_available_now(sdf, lambda p: ST.commit_sink(p, sort_by), name, mode, resumable=False)
    return ST.read_committed(spark, f"{base}/table")


def _stream_avg_speed(mode):
    return lambda s, d: _table_of(s, ST.stream_avg_speed(_event_stream(s, d), STREAM_WATERMARK), f"avg-speed-{mode}", mode)


def _stream_window_count(mode):
    return lambda s, d: _table_of(s, ST.stream_window_count(_event_stream(s, d), S.CAMERA, STREAM_WATERMARK),
                                  f"window-count-{mode}", mode, ["window_start", S.CAMERA])


def _stream_log_lines(spark, d):
    return _table_of(spark, ST.stream_avg_speed(_line_stream(spark, d), STREAM_WATERMARK), "log-lines", "append")


def _stream_congestion(sink, mode):
    def run(spark, d):
        monitors = _log(spark, d).select(S.MONITOR)
        sdf = ST.stream_avg_speed(_event_stream(spark, d), STREAM_WATERMARK)
        base = ST.run_available_now(sdf, lambda p: sink(p, monitors), f"congestion-{mode}", mode, resumable=False)
        return ST.latest_snapshot(spark, base)
    return run


def _stream_avg_speed_panes(spark, d):
    return _table_of(spark, ST.stream_avg_speed_panes(_event_stream(spark, d), STREAM_WATERMARK), "avg-speed-panes", "append")


def _stream_congestion_keyed(spark, d):
    changes = _table_of(spark, ST.stream_latest_speed(_event_stream(spark, d), STREAM_WATERMARK), "latest-speed", "append")
    latest = ST.newest_per_key(changes, S.MONITOR, "window_end")
    return O.congestion_status(_log(spark, d).select(S.MONITOR), latest)


def _stream_late_rows(spark, d):
    """The log arrives in parts, the readings of one camera a part too late;
    the stream runs after each, and its progress tells what came too late."""
    events = spark.read.parquet(f"{d}/events.parquet")
    ids = events.agg((F.max("event_id") + 1).alias("n")).scalar()
    part = F.floor(F.col("event_id") * ARRIVALS / ids) + F.when(F.col("event_type") == SLOW_CAMERA, 1).otherwise(0)
    dealt = events.withColumn("_part", F.least(part, F.lit(ARRIVALS - 1)))
    folder = scratch_path(spark, "arrivals")
    base = scratch_path(spark, "late-rows")
    for k in range(ARRIVALS):
        dealt.where(F.col("_part") == k).drop("_part").write.parquet(f"{folder}/{k}")
        log = events_as_log(read_stream(spark, "parquet", {"recursiveFileLookup": "true"}, events.schema, folder))
        ST.run_available_now(ST.stream_latest_speed(log, STREAM_WATERMARK), lambda p: ST.commit_sink(p), "late-rows",
                             "append", folder=base, progress=True)
    runs = ST.read_progress(spark, f"{base}/progress").groupBy("run_id").agg(
        F.min("batch_id").alias("_first"), F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))
    order = Window.orderBy("_first")  # one row a run
    return runs.select((F.row_number().over(order) - 1).alias("arrival"), "input_rows", "late_rows")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # text (Q01, Q01b, Q02)
    "word_count": lambda s, d: O.word_count(document_lines(s, d), " ", [WORD_NEEDLE]),
    "word_count_distinct": lambda s, d: O.word_count_distinct(document_lines(s, d), " ", [WORD_NEEDLE]),
    "remove_top_word": lambda s, d: O.remove_top_word(document_lines(s, d), " "),
    # relationship (Q03a-c)
    "relation_pairs": lambda s, d: O.relation_pairs(part_ego_lists(s, d)),
    "common_friend_weight": lambda s, d: O.pair_weights(part_ego_lists(s, d)),
    "recommend_friends": lambda s, d: O.recommend_friends(part_ego_lists(s, d)),
    # traffic top-k (Q04-Q07)
    "top_monitors": lambda s, d: O.top_monitors(_log(s, d)),
    "bottom_monitors": lambda s, d: O.top_monitors(_log(s, d), ascending=True),
    "top_monitors_lineitem": lambda s, d: O.top_monitors(_lineitem_log(s, d), monitor="l_suppkey"),
    "top_speed_readings": lambda s, d: O.top_speed_readings(_log(s, d), SPEED_OVER, tie=TIE),
    "top_speeding_monitors": lambda s, d: O.top_speeding_monitors(_log(s, d), SPEED_OVER),
    "top_speeding_monitors_sql": lambda s, d: O.top_speeding_monitors_sql(_log(s, d), SPEED_OVER),
    "top_speed_readings_lineitem": lambda s, d: O.top_speed_readings(
        _lineitem_log(s, d), QUANTITY_OVER, monitor="l_suppkey", speed="l_quantity"),
    "top_speeding_monitors_lineitem": lambda s, d: O.top_speeding_monitors(
        _lineitem_log(s, d), QUANTITY_OVER, monitor="l_suppkey", speed="l_quantity"),
    "busiest_hours": lambda s, d: O.busiest_hours(_log(s, d)),
    "busiest_hours_text": lambda s, d: O.busiest_hours(
        _log(s, d).select(F.date_format("event_time", S.LOG_TIME_FORMAT).alias(S.DATE_TIME)),
        time=S.DATE_TIME, raw_text=True),
    # device status (Q08a-c): declared cameras are orders, readings are line items
    "error_monitors": lambda s, d: O.error_monitors(*order_cameras(s, d)),
    "error_monitors_size": lambda s, d: O.error_monitors(*order_cameras(s, d), mode="size"),
    "error_cameras": lambda s, d: O.error_cameras(*order_cameras(s, d)),
    "error_cameras_size": lambda s, d: O.error_cameras(*order_cameras(s, d), mode="size"),
    "status_summary": lambda s, d: O.status_summary(*order_cameras(s, d)),
    "status_summary_size": lambda s, d: O.status_summary(*order_cameras(s, d), mode="size"),
    # sequences per vehicle (Q09, Q10)
    "conversion_rate": lambda s, d: _conversion(s, d),
    "conversion_rate_no_tail": lambda s, d: _conversion(s, d, count_tail=False),
    "conversion_rate_monitors": lambda s, d: O.conversion_rate(_log(s, d), CONVERT_FROM, CONVERT_TO),
    "sample_vehicles": lambda s, d: _sample_keys(s, d),
    "vehicle_trace": lambda s, d: O.vehicle_trace(_log(s, d), _sample_keys(s, d), key_bound=SAMPLE_N, tie=TIE),
    "vehicle_trace_segments": lambda s, d: O.vehicle_trace(
        _log(s, d), _sample_keys(s, d), key_bound=SAMPLE_N, tie=TIE, segment_steps=TRACE_SEGMENT),
    # text lines (S2, S4)
    "parsed_vehicle_log": _parsed_log,
    # windows and congestion (Q11-Q13), batch and streaming forms
    "windowed_avg_speed": lambda s, d: O.windowed_avg_speed(_log(s, d)),
    "windowed_count": lambda s, d: O.windowed_count(_log(s, d), S.CAMERA),
    "latest_per_monitor": _latest,
    "congestion_status": lambda s, d: O.congestion_status(_log(s, d), _latest(s, d)),
    "stream_avg_speed": _stream_avg_speed("complete"),
    "stream_window_count": _stream_window_count("complete"),
    "stream_congestion_snapshot": _stream_congestion(ST.snapshot_sink, "complete"),
    # the production form: append mode, windows leave the state when they close
    "stream_avg_speed_append": _stream_avg_speed("append"),
    "stream_window_count_append": _stream_window_count("append"),
    "stream_congestion_append": _stream_congestion(ST.snapshot_merge_sink, "append"),
    "stream_log_lines": _stream_log_lines,
    "stream_avg_speed_panes": _stream_avg_speed_panes,
    "stream_congestion_keyed": _stream_congestion_keyed,
    "stream_late_rows": _stream_late_rows,
    # the same answers where there are very many keys, or periods (Q02, Q04, Q06, Q08, Q10a), and rejected lines (S4)
    "top_words": lambda s, d: O.top_words(document_lines(s, d)),
    "top_monitors_of_many": lambda s, d: O.top_monitors_of_many(_lineitem_log(s, d), monitor="l_partkey"),
    "top_speeding_monitors_of_many": lambda s, d: O.top_speeding_monitors_of_many(
        _lineitem_log(s, d), QUANTITY_OVER, monitor="l_suppkey", speed="l_quantity"),
    "error_monitors_bitmaps": lambda s, d: O.error_monitors_of_bitmaps(*_camera_bitmaps(s, d)),
    "error_cameras_bitmaps": lambda s, d: O.error_cameras_of_bitmaps(*_camera_bitmaps(s, d)),
    "sample_vehicles_of_many": lambda s, d: O.sample_vehicles_of_many(_log(s, d), SAMPLE_N, SAMPLE_SEED),
    "rejected_lines": _rejected_lines,
    # the whole transition matrix (Q09b)
    "conversion_matrix": lambda s, d: O.conversion_matrix(_log(s, d), tie=TIE),
}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------
_LOG = """log AS (
  SELECT ts AS event_time, user_id AS vehiclePlate, value AS vehicleSpeed,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS monitorId,
         event_type AS cameraId, event_id
  FROM events)"""


def _jsplit(x: str, sep_sql: str) -> str:
    """Java String.split on a one-character separator in DuckDB."""
    return (f"CASE WHEN {x} <> '' AND rtrim({x}, {sep_sql}) = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({x}, {sep_sql}), {sep_sql}) END")


_LINES = f"lines AS (SELECT unnest({_jsplit('text', 'chr(10)')}) AS line FROM documents)"
_WORDS_ALL = f"w AS (SELECT unnest({_jsplit('line', chr(39) + ' ' + chr(39))}) AS word FROM lines)"
_WORDS_NEEDLE = (f"w AS (SELECT unnest({_jsplit('line', chr(39) + ' ' + chr(39))}) AS word "
                 f"FROM lines WHERE contains(line, '{WORD_NEEDLE}'))")

_EGO = """seq AS (
  SELECT l_partkey AS p,
         lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                               l_suppkey, l_quantity, l_extendedprice) AS q
  FROM lineitem),
edges AS (SELECT DISTINCT least(p, q) AS a, greatest(p, q) AS b FROM seq WHERE q IS NOT NULL AND q <> p),
ego AS (SELECT a AS head, b AS member FROM edges UNION ALL SELECT b, a FROM edges),
rp AS (
  SELECT a, b, tag, count(*) AS n FROM (
    SELECT least(head, member) AS a, greatest(head, member) AS b, 0 AS tag FROM ego
    UNION ALL
    SELECT x.member, y.member, 1 FROM ego x JOIN ego y ON x.head = y.head AND x.member < y.member
  ) GROUP BY a, b, tag),
cw AS (
  SELECT a, b, CAST(sum(CASE WHEN tag = 1 THEN n END) AS BIGINT) AS weight
  FROM rp GROUP BY a, b HAVING min(tag) = 1)"""

_DEVICES = """dim AS (SELECT o_custkey AS monitorId, o_orderkey AS cameraId FROM orders),
seen AS (SELECT DISTINCT o_custkey AS monitorId, o_orderkey AS cameraId FROM orders
         WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
missing AS (SELECT DISTINCT monitorId, cameraId FROM dim EXCEPT SELECT monitorId, cameraId FROM seen),
nd AS (SELECT monitorId, count(*) AS c FROM dim GROUP BY monitorId),
ns AS (SELECT monitorId, count(*) AS c FROM seen GROUP BY monitorId),
wrong AS (SELECT nd.monitorId FROM nd LEFT JOIN ns ON nd.monitorId = ns.monitorId WHERE nd.c <> coalesce(ns.c, 0))"""

_WINDOWED = """wa AS (
  SELECT window_start, window_start + INTERVAL 60 SECONDS AS window_end, monitorId,
         CAST(sum(CAST(trunc(vehicleSpeed) AS BIGINT)) AS BIGINT) AS speed_sum, count(*) AS n,
         CAST(sum(CAST(trunc(vehicleSpeed) AS BIGINT)) AS BIGINT) // count(*) AS avg_speed
  FROM (SELECT time_bucket(INTERVAL 5 SECONDS, event_time) - i * INTERVAL 5 SECONDS AS window_start,
               monitorId, vehicleSpeed
        FROM log, range(12) t(i)
        WHERE TRY_CAST(trunc(vehicleSpeed) AS BIGINT) IS NOT NULL AND event_time IS NOT NULL)
  GROUP BY window_start, monitorId)"""

_LATEST = """latest AS (
  SELECT monitorId, arg_max(avg_speed, window_end) AS avg_speed, max(window_end) AS window_end
  FROM wa WHERE window_end <= (SELECT max(window_start) + INTERVAL 5 SECONDS FROM wa)
  GROUP BY monitorId)"""

_CONGESTION = """WITH {log}, {windowed}, {with_latest},
m AS (SELECT DISTINCT monitorId FROM log)
SELECT m.monitorId, CAST(coalesce(l.avg_speed, 0) AS BIGINT) AS avg_speed,
       CASE WHEN coalesce(l.avg_speed, 0) <= 5 THEN 'jammed'
            WHEN coalesce(l.avg_speed, 0) <= 10 THEN 'severe'
            WHEN coalesce(l.avg_speed, 0) <= 30 THEN 'slow' ELSE 'normal' END AS level,
       l.avg_speed IS NOT NULL AS reported
FROM m LEFT JOIN {latest} l ON m.monitorId IS NOT DISTINCT FROM l.monitorId"""

_WINDOW_COUNT = f"""WITH {_LOG}
SELECT window_start, window_start + INTERVAL 15 SECONDS AS window_end, cameraId, count(*) AS n
FROM (SELECT time_bucket(INTERVAL 10 SECONDS, event_time) - i * INTERVAL 10 SECONDS AS window_start,
             event_time, cameraId
      FROM log, range(2) t(i) WHERE event_time IS NOT NULL)
WHERE event_time < window_start + INTERVAL 15 SECONDS
GROUP BY window_start, cameraId"""


def _conversion_sql(no_tail: bool) -> str:
    cond = f"m = '{CONVERT_A}' AND n1 = '{CONVERT_B}'" + (" AND has2" if no_tail else "")
    return f"""WITH {_LOG},
s AS (SELECT cameraId AS m, lead(cameraId) OVER w AS n1, lead(true, 2, false) OVER w AS has2
      FROM log WINDOW w AS (PARTITION BY vehiclePlate ORDER BY event_time, event_id)),
c AS (SELECT count(*) FILTER (WHERE m = '{CONVERT_A}') AS a_total,
             count(*) FILTER (WHERE {cond}) AS ab_total FROM s)
SELECT '{CONVERT_A}' AS a, '{CONVERT_B}' AS b, a_total, ab_total,
       CASE WHEN a_total = 0 THEN NULL
            ELSE round(CAST(ab_total AS DOUBLE) * 100.0 / a_total, 5) END AS rate_pct
FROM c"""


_SAMPLE = (f"k AS (SELECT DISTINCT vehiclePlate FROM log WHERE vehiclePlate IS NOT NULL "
           f"ORDER BY md5(concat('{SAMPLE_SEED}:', CAST(vehiclePlate AS VARCHAR))), vehiclePlate "
           f"LIMIT {SAMPLE_N})")

_POINTS = """r AS (
  SELECT vehiclePlate, row_number() OVER (PARTITION BY vehiclePlate ORDER BY event_time NULLS FIRST, event_id NULLS FIRST) - 1 AS step,
         coalesce(strftime(event_time, '%d/%m/%Y %H:%M:%S'), 'null') || ' @ ' || coalesce(CAST(monitorId AS VARCHAR), 'null') AS point
  FROM log WHERE vehiclePlate IN (SELECT vehiclePlate FROM k))"""

_SUMMARY = """WITH {devices}, errs AS ({errors})
SELECT (SELECT count(DISTINCT monitorId) FROM dim) AS monitors, (SELECT count(*) FROM errs) AS error_monitors,
       (SELECT count(*) FROM {cameras}) AS error_cameras, (SELECT count(*) FROM errs) = 0 AS all_ok"""

_TOPMON = """WITH {log}
SELECT monitorId, count(*) AS vehicleNum FROM log GROUP BY monitorId
ORDER BY vehicleNum {d}, monitorId ASC NULLS FIRST LIMIT 10"""

ORACLE_SQL: dict[str, str] = {
    "word_count": f"WITH {_LINES}, {_WORDS_NEEDLE} SELECT word, count(*) AS n FROM w GROUP BY word",
    "word_count_distinct": f"""WITH {_LINES}, {_WORDS_NEEDLE}
SELECT count(*) AS n_words FROM (SELECT word FROM w GROUP BY word)""",
    "remove_top_word": f"""WITH {_LINES}, {_WORDS_ALL},
c AS (SELECT word, count(*) AS n FROM w GROUP BY word),
r AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word ASC) AS place FROM c)
SELECT word, n FROM r WHERE place > 1""",
    "relation_pairs": f"WITH {_EGO} SELECT a, b, tag, n FROM rp",
    "common_friend_weight": f"WITH {_EGO} SELECT a, b, weight FROM cw",
    "recommend_friends": f"""WITH {_EGO},
bo AS (SELECT a AS "self", b AS other, weight FROM cw UNION ALL SELECT b, a, weight FROM cw),
r AS (SELECT "self", other, weight,
             CAST(row_number() OVER (PARTITION BY "self" ORDER BY weight DESC, other ASC) AS INTEGER) AS rn
      FROM bo)
SELECT "self", other, weight, rn FROM r WHERE rn <= 2""",
    "top_monitors": _TOPMON.format(log=_LOG, d="DESC"),
    "bottom_monitors": _TOPMON.format(log=_LOG, d="ASC"),
    "top_monitors_lineitem": """SELECT l_suppkey, count(*) AS vehicleNum FROM lineitem GROUP BY l_suppkey
ORDER BY vehicleNum DESC, l_suppkey ASC NULLS FIRST LIMIT 10""",
    "top_speed_readings": f"""WITH {_LOG}
SELECT monitorId, vehicleSpeed FROM log WHERE vehicleSpeed > {SPEED_OVER} AND NOT isnan(vehicleSpeed)
ORDER BY vehicleSpeed DESC, monitorId ASC NULLS FIRST, event_id ASC NULLS FIRST LIMIT 10""",
    "top_speeding_monitors": f"""WITH {_LOG}
SELECT monitorId, count(vehicleSpeed) AS vehicleNum FROM log WHERE vehicleSpeed > {SPEED_OVER} AND NOT isnan(vehicleSpeed)
GROUP BY monitorId ORDER BY vehicleNum DESC, monitorId ASC NULLS FIRST LIMIT 10""",
    "top_speed_readings_lineitem": f"""SELECT l_suppkey, l_quantity FROM lineitem WHERE l_quantity > {QUANTITY_OVER}
ORDER BY l_quantity DESC, l_suppkey ASC NULLS FIRST LIMIT 10""",
    "top_speeding_monitors_lineitem": f"""SELECT l_suppkey, count(l_quantity) AS vehicleNum FROM lineitem
WHERE l_quantity > {QUANTITY_OVER} GROUP BY l_suppkey ORDER BY vehicleNum DESC, l_suppkey ASC NULLS FIRST LIMIT 10""",
    "busiest_hours": f"""WITH {_LOG}
SELECT coalesce(strftime(event_time, '%H'), '') AS hour, count(*) AS vehicleNum FROM log
GROUP BY 1 ORDER BY vehicleNum DESC, hour ASC LIMIT 10""",
    "error_monitors": f"WITH {_DEVICES} SELECT DISTINCT monitorId FROM missing",
    "error_monitors_size": f"WITH {_DEVICES} SELECT monitorId FROM wrong",
    "error_cameras": f"WITH {_DEVICES} SELECT monitorId, cameraId FROM missing",
    "error_cameras_size": f"WITH {_DEVICES} SELECT monitorId, cameraId FROM missing WHERE monitorId IN (SELECT monitorId FROM wrong)",
    "status_summary": _SUMMARY.format(devices=_DEVICES, errors="SELECT DISTINCT monitorId FROM missing", cameras="missing"),
    "status_summary_size": _SUMMARY.format(
        devices=_DEVICES, errors="SELECT monitorId FROM wrong",
        cameras="(SELECT * FROM missing WHERE monitorId IN (SELECT monitorId FROM wrong))"),
    "conversion_rate": _conversion_sql(False),
    "conversion_rate_no_tail": _conversion_sql(True),
    "conversion_rate_monitors": f"""WITH {_LOG},
s AS (SELECT monitorId AS m, lead(monitorId) OVER w AS n1
      FROM log WINDOW w AS (PARTITION BY vehiclePlate ORDER BY event_time NULLS FIRST, monitorId NULLS FIRST)),
c AS (SELECT count(*) FILTER (WHERE m = {CONVERT_FROM}) AS a_total,
             count(*) FILTER (WHERE m = {CONVERT_FROM} AND n1 = {CONVERT_TO}) AS ab_total FROM s)
SELECT '{CONVERT_FROM}' AS a, '{CONVERT_TO}' AS b, a_total, ab_total,
       CASE WHEN a_total = 0 THEN NULL
            ELSE round(CAST(ab_total AS DOUBLE) * 100.0 / a_total, 5) END AS rate_pct
FROM c""",
    "sample_vehicles": f"WITH {_LOG}, {_SAMPLE} SELECT vehiclePlate FROM k",
    "vehicle_trace": f"""WITH {_LOG}, {_SAMPLE}, {_POINTS}
SELECT vehiclePlate, string_agg(point, '->' ORDER BY step) AS trace FROM r GROUP BY 1""",
    "vehicle_trace_segments": f"""WITH {_LOG}, {_SAMPLE}, {_POINTS}
SELECT vehiclePlate, step // {TRACE_SEGMENT} AS segment, string_agg(point, '->' ORDER BY step) AS trace FROM r GROUP BY 1, 2""",
    "parsed_vehicle_log": f"""WITH {_LOG}
SELECT date_trunc('second', event_time) AS event_time, coalesce(CAST(vehiclePlate AS VARCHAR), '') AS vehiclePlate,
       CAST(trunc(vehicleSpeed) AS INTEGER) AS vehicleSpeed, coalesce(CAST(monitorId AS VARCHAR), '') AS monitorId, cameraId
FROM log WHERE vehicleSpeed IS NOT NULL AND cameraId <> ''""",
    "windowed_avg_speed": f"WITH {_LOG}, {_WINDOWED} SELECT * FROM wa",
    "windowed_count": _WINDOW_COUNT,
    "latest_per_monitor": f"WITH {_LOG}, {_WINDOWED}, {_LATEST} SELECT * FROM latest",
    "congestion_status": _CONGESTION.format(log=_LOG, windowed=_WINDOWED, with_latest=_LATEST, latest="latest"),
    "busiest_hours_text": f"""WITH {_LOG}
SELECT coalesce(strftime(event_time, '%H'), '') AS hour, count(*) AS vehicleNum FROM log
GROUP BY 1 ORDER BY vehicleNum DESC, hour ASC LIMIT 10""",
}
ORACLE_SQL["top_speeding_monitors_sql"] = ORACLE_SQL["top_speeding_monitors"]
ORACLE_SQL["stream_avg_speed"] = ORACLE_SQL["windowed_avg_speed"]
ORACLE_SQL["stream_window_count"] = ORACLE_SQL["windowed_count"]
ORACLE_SQL["stream_congestion_snapshot"] = ORACLE_SQL["congestion_status"]

# append mode: a window is out when the watermark (newest time less the delay) has passed its end
_CLOSED = "window_end <= (SELECT max(event_time) FROM log) - INTERVAL 1 HOUR"
ORACLE_SQL["stream_avg_speed_append"] = f"WITH {_LOG}, {_WINDOWED} SELECT * FROM wa WHERE {_CLOSED}"
ORACLE_SQL["stream_window_count_append"] = f"SELECT w.* FROM ({_WINDOW_COUNT}) w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"
ORACLE_SQL["stream_congestion_append"] = _CONGESTION.format(
    log=_LOG, windowed=_WINDOWED, latest="closed",
    with_latest=f"""closed AS (SELECT monitorId, arg_max(avg_speed, window_end) AS avg_speed
                               FROM wa WHERE {_CLOSED} GROUP BY monitorId)""")
# lines carry whole seconds, and monitors as text
ORACLE_SQL["stream_log_lines"] = f"""WITH base AS (SELECT * FROM ({_LOG.removeprefix("log AS (").removesuffix(")")})),
log AS (SELECT date_trunc('second', event_time) AS event_time, vehicleSpeed,
               coalesce(CAST(monitorId AS VARCHAR), '') AS monitorId FROM base), {_WINDOWED}
SELECT * FROM wa WHERE window_end <= (SELECT max(event_time) FROM log WHERE vehicleSpeed IS NOT NULL) - INTERVAL 1 HOUR"""
ORACLE_SQL["stream_avg_speed_panes"] = ORACLE_SQL["stream_avg_speed_append"]
ORACLE_SQL["stream_congestion_keyed"] = ORACLE_SQL["stream_congestion_append"]
ORACLE_SQL["stream_late_rows"] = f"""WITH parts AS (
  SELECT ts, value, CAST(least({ARRIVALS - 1}, (event_id * {ARRIVALS}) // (SELECT max(event_id) + 1 FROM events)
                                              + CASE WHEN event_type = '{SLOW_CAMERA}' THEN 1 ELSE 0 END) AS INTEGER) AS arrival
  FROM events),
newest AS (SELECT arrival, max(ts) AS t FROM parts GROUP BY arrival),
marks AS (SELECT a.arrival, (SELECT date_trunc('milliseconds', max(b.t)) - INTERVAL 1 HOUR FROM newest b WHERE b.arrival < a.arrival) AS mark
          FROM newest a)
SELECT p.arrival, count(*) AS input_rows,
       count(*) FILTER (WHERE ts <= mark AND TRY_CAST(trunc(value) AS BIGINT) IS NOT NULL) AS late_rows
FROM parts p JOIN marks m ON p.arrival = m.arrival GROUP BY p.arrival"""
ORACLE_SQL["conversion_matrix"] = f"""WITH {_LOG},
s AS (SELECT monitorId AS a, lead(monitorId) OVER w AS b, lead(true, 1, false) OVER w AS has
      FROM log WINDOW w AS (PARTITION BY vehiclePlate ORDER BY event_time NULLS FIRST, event_id NULLS FIRST)),
t AS (SELECT a, count(*) AS a_total FROM s GROUP BY a),
c AS (SELECT a, b, count(*) AS ab_total FROM s WHERE has GROUP BY a, b)
SELECT c.a, c.b, t.a_total, c.ab_total, round(CAST(c.ab_total AS DOUBLE) * 100.0 / t.a_total, 5) AS rate_pct
FROM c JOIN t ON c.a IS NOT DISTINCT FROM t.a"""
ORACLE_SQL["top_words"] = f"""WITH {_LINES}, {_WORDS_ALL}
SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word ASC NULLS FIRST LIMIT 10"""
ORACLE_SQL["top_monitors_of_many"] = """SELECT l_partkey, count(*) AS vehicleNum FROM lineitem GROUP BY l_partkey
ORDER BY vehicleNum DESC, l_partkey ASC NULLS FIRST LIMIT 10"""
ORACLE_SQL["top_speeding_monitors_of_many"] = ORACLE_SQL["top_speeding_monitors_lineitem"]
ORACLE_SQL["error_monitors_bitmaps"] = ORACLE_SQL["error_monitors_size"]
ORACLE_SQL["error_cameras_bitmaps"] = ORACLE_SQL["error_cameras"]
ORACLE_SQL["sample_vehicles_of_many"] = ORACLE_SQL["sample_vehicles"]
# every reading is one line, followed by one that is none; an empty last field leaves five, an empty speed is no number
ORACLE_SQL["rejected_lines"] = f"""WITH {_LOG},
r AS (SELECT CASE WHEN coalesce(cameraId, '') = '' THEN 'fields'
                  WHEN TRY_CAST(trunc(vehicleSpeed) AS INTEGER) IS NULL THEN 'number' ELSE 'record' END AS reason FROM log
      UNION ALL SELECT 'fields' FROM log)
SELECT reason, count(*) AS lines FROM r GROUP BY reason"""
