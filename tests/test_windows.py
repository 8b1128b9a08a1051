"""Sliding-window speed, latest value per monitor and congestion levels
(batch forms) on the edge rows of SURVEY 2.6."""

from datetime import datetime

from pyspark.sql import functions as F

from roadlens import operators as O
from roadlens.sources import parse_stream_log
from tests.conftest import rows

SCHEMA = "event_time timestamp_ntz, monitorId string, vehicleSpeed int"


def test_latest_window_n21(spark):
    t = lambda s: datetime(2019, 1, 16, 10, 0, s)
    log = spark.createDataFrame([(t(0), "1", 100), (t(50), "1", 20), (t(0), "2", 30)], SCHEMA)
    w = O.windowed_avg_speed(log)
    latest = {r.monitorId: (r.avg_speed, r.window_end) for r in O.latest_speed(w).collect()}
    assert latest["1"] == (60, datetime(2019, 1, 16, 10, 0, 55))
    assert latest["2"][0] == 30


def test_no_average_above_max_speed_n11(spark):
    data = [(datetime(2019, 1, 16, 10, m, s), "m", v) for m in range(3) for s, v in ((1, 300), (31, 10))]
    w = O.windowed_avg_speed(spark.createDataFrame(data, SCHEMA))
    assert w.agg(F.max("avg_speed")).first()[0] <= 300
    assert w.where(F.col("n") == 0).count() == 0


def test_congestion_defaults_n12(spark):
    log = spark.createDataFrame([(datetime(2019, 1, 1, 0, 0, 1), "a", 40)], SCHEMA)
    monitors = spark.createDataFrame([("a",), ("b",)], "monitorId string")
    got = rows(O.congestion_status(monitors, O.latest_speed(O.windowed_avg_speed(log))))
    assert got == [("a", 40, "normal", True), ("b", 0, "jammed", False)]


def test_stream_line_parse_skips_dirty_rows(spark):
    lines = spark.createDataFrame([
        ("2019-01-16 10:00:01\tP1\t3\t10001\t20001\t40001",),
        ("ILLEGAL_LOG",),
        ("2019-01-16 10:00:02\tP2\t4\t10001\t20001\t40002",),
        ("2019-01-16 10:00:03\tP3\tx\t10001\t20001\t40002",)], "value string")
    log = parse_stream_log(lines)
    assert log.count() == 2
    w = O.windowed_avg_speed(log)
    assert {r.avg_speed for r in w.where(F.col("n") == 2).collect()} == {3}  # 7 div 2


def test_windowed_count(spark):
    t = lambda s: datetime(2019, 1, 16, 10, 0, s)
    df = spark.createDataFrame([(t(1), "x"), (t(12), "x"), (t(12), "y")], "event_time timestamp_ntz, value string")
    got = rows(O.windowed_count(df), "window_start", "value", "n")
    assert (t(0), "x", 2) in got and (t(10), "x", 1) in got and (t(10), "y", 1) in got
    assert all(n >= 1 for _, _, n in got) and len(got) == 5


def test_panes_equal_direct(spark):
    data = [(datetime(2019, 1, 16, 10, m, s), f"m{s % 3}", (m * 7 + s) % 300) for m in range(4) for s in range(0, 60, 3)]
    log = spark.createDataFrame(data, SCHEMA)
    a, b = O.windowed_avg_speed(log, panes=True), O.windowed_avg_speed(log, panes=False)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_stream_parse_processing_time_mode(spark):
    lines = spark.createDataFrame([("x\tP1\t3\t10001\t20001\t40001",)], "value string")
    log = parse_stream_log(lines, ingest_time=True)
    r = log.first()
    assert r.event_time is not None and r.vehicleSpeed == 3 and r.monitorId == "20001"


def test_windows_that_are_no_multiple_of_the_slide(spark):
    t = lambda s: datetime(2019, 1, 16, 10, 0, s)
    log = spark.createDataFrame([(t(1), "m", 10), (t(17), "m", 100)], SCHEMA)
    a = O.windowed_avg_speed(log, "15 seconds", "10 seconds")
    b = O.windowed_avg_speed(log, "15 seconds", "10 seconds", panes=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    first = a.where(F.col("window_start") == t(0)).first()
    assert (first.speed_sum, first.n, first.avg_speed) == (10, 1, 10)


def test_newest_window_without_building_windows(spark):
    import random
    random.seed(5)
    data = [(datetime(2019, 1, 16, 10, random.randint(0, 9), random.randint(0, 59)), random.choice(["a", "b", "c", None]),
             random.choice([None, 7, 120, 33])) for _ in range(120)] + [(None, "a", 5), (datetime(2019, 1, 16, 9, 0, 0), "old", 3)]
    log = spark.createDataFrame(data, SCHEMA)
    for window, slide in (("60 seconds", "5 seconds"), ("15 seconds", "10 seconds"), ("10 seconds", "10 seconds")):
        for as_of in (None, datetime(2019, 1, 16, 10, 5, 3), datetime(2019, 1, 16, 12, 0, 0)):
            w = O.windowed_avg_speed(log, window, slide)
            want = O.latest_speed(w, as_of if as_of else O.closing_time(log, slide), slide)
            got = O.latest_speed_of_log(log, as_of, window, slide).select(*want.columns)
            if window == "15 seconds":  # windows with gaps: a newest reading may lie in no closed window
                want = want.join(got.select("monitorId"), F.lit(True) & want.monitorId.eqNullSafe(got.monitorId), "left_semi")
                assert got.count() == want.count()
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_missing_monitor_has_its_reading(spark):
    log = spark.createDataFrame([(datetime(2019, 1, 1, 0, 0, 1), None, 40)], SCHEMA)
    got = rows(O.congestion_status(log.select("monitorId"), O.latest_speed_of_log(log)))
    assert got == [(None, 40, "normal", True)]


def test_short_stream_lines_are_no_error(spark):
    lines = spark.createDataFrame([("2019-01-16 10:00:01\tP1",), ("2019-01-16 10:00:01\tP1\t3\t10001\t20001",), ("",),
                                   ("2019-01-16 10:00:02\tP1\t4\t10001\t20001\t",), ("\t\t5",)], "value string")
    got = rows(parse_stream_log(lines), "vehicleSpeed", "monitorId", "cameraId")
    assert sorted(got, key=str) == sorted([(3, "20001", None), (4, "20001", None), (5, None, None)], key=str)
