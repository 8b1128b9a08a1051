"""Traffic operators on small fixtures built from the dimension rule and
the edge rows of SURVEY 2.6."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from roadlens import operators as O
from roadlens.schemas import CAMERA, PLATE
from tests.conftest import rows

LOG_SCHEMA = "event_time timestamp_ntz, vehiclePlate string, vehicleSpeed int, monitorId string, cameraId string, event_id long"


def _dimension(spark):
    """Road 10000+i has monitors 20000+2i-1 and 20000+2i; monitor 20000+j has
    cameras 40000+2j-1 and 40000+2j (60 roads, 120 monitors, 240 cameras)."""
    out = []
    for i in range(1, 61):
        for j in (2 * i - 1, 2 * i):
            for c in (2 * j - 1, 2 * j):
                out.append((str(10000 + i), str(20000 + j), str(40000 + c)))
    return spark.createDataFrame(out, "roadId string, monitorId string, cameraId string")


def _log(spark, recs):
    base = datetime(2019, 1, 16, 10, 0, 0)
    data = [(base + timedelta(seconds=s), p, v, m, c, i) for i, (s, p, v, m, c) in enumerate(recs)]
    return spark.createDataFrame(data, LOG_SCHEMA)


def test_monitor_status_fixture(spark):
    dim = _dimension(spark)
    silent = {"20010", "20078", "20094"}
    recs = [(k, "P1", 50, r.monitorId, r.cameraId) for k, r in enumerate(dim.collect())
            if r.monitorId not in silent]
    log = _log(spark, recs)
    assert rows(O.error_monitors(dim, log)) == [("20010",), ("20078",), ("20094",)]
    assert [c for _, c in rows(O.error_cameras(dim, log))] == [
        "40019", "40020", "40155", "40156", "40187", "40188"]
    s = O.status_summary(dim, log).first()
    assert (s.monitors, s.error_monitors, s.error_cameras, s.all_ok) == (120, 3, 6, False)
    assert rows(O.error_monitors(dim, log, mode="size")) == [("20010",), ("20078",), ("20094",)]


def test_status_modes_n9(spark):
    dup = spark.createDataFrame([("m", "c1"), ("m", "c1"), ("m", "c2")], "monitorId string, cameraId string")
    log_ok = _log(spark, [(0, "p", 1, "m", "c1"), (1, "p", 1, "m", "c2")])
    assert O.error_monitors(dup, log_ok, mode="size").count() == 1
    assert O.error_monitors(dup, log_ok, mode="content").count() == 0
    dim = spark.createDataFrame([("m", "c1"), ("m", "c2")], "monitorId string, cameraId string")
    extra = _log(spark, [(0, "p", 1, "m", "c1"), (1, "p", 1, "m", "c2"), (2, "p", 1, "m", "c9")])
    assert O.error_monitors(dim, extra, mode="size").count() == 1
    assert O.error_monitors(dim, extra, mode="content").count() == 0
    other = _log(spark, [(0, "p", 1, "m", "c1"), (1, "p", 1, "m", "c3")])
    assert O.error_monitors(dim, other, mode="size").count() == 0
    assert O.error_monitors(dim, other, mode="content").count() == 1
    s = O.status_summary(dim, log_ok).first()
    assert s.all_ok is True and s.error_cameras == 0


def test_top_monitors_and_ties(spark):
    log = _log(spark, [(i, "p", 10, m, "c") for i, m in enumerate("aabbbcd")])
    assert rows(O.top_monitors(log, 2)) == [("a", 2), ("b", 3)]
    assert [tuple(r) for r in O.top_monitors(log, 2, ascending=True).collect()] == [("c", 1), ("d", 1)]


def test_over_speed_is_strict_n15(spark):
    log = _log(spark, [(0, "p", 250, "m1", "c"), (1, "p", 251, "m2", "c"), (2, "q", 300, "m2", "c")])
    assert rows(O.top_speed_readings(log)) == [("m2", 251), ("m2", 300)]
    a = O.top_speeding_monitors(log)
    b = O.top_speeding_monitors_sql(log)
    assert rows(a) == rows(b) == [("m2", 2)]


def test_busiest_hours_keeps_missing_time(spark):
    data = [(None, "p", 1, "m", "c", 0), (datetime(2019, 1, 1, 3, 0), "p", 1, "m", "c", 1),
            (datetime(2019, 1, 1, 3, 5), "p", 1, "m", "c", 2)]
    log = spark.createDataFrame(data, LOG_SCHEMA)
    assert rows(O.busiest_hours(log)) == [("", 1), ("03", 2)]
    raw = spark.createDataFrame([("16/01/2019 10:20:30",), ("16/01/2019 10:20",), ("x",)], "dateTime string")
    assert rows(O.busiest_hours(raw, time="dateTime", raw_text=True)) == [("", 2), ("10", 1)]


def _trace(spark, plate, monitors, start=0):
    return [(start + i, plate, 10, m, "c") for i, m in enumerate(monitors)]


def test_conversion_rate_n3_n4(spark):
    log = _log(spark, _trace(spark, "p1", "ABAB") + _trace(spark, "p2", "ABABC", 100))
    r = O.conversion_rate(log, "A", "B").first()
    assert (r.a_total, r.ab_total) == (4, 4)
    r = O.conversion_rate(log, "A", "B", count_tail=False).first()
    assert (r.a_total, r.ab_total) == (4, 3)  # p1: 2 (tail off: 1); p2: 2 (tail off: 2)
    none = O.conversion_rate(_log(spark, _trace(spark, "p", "BCB")), "A", "B").first()
    assert none.a_total == 0 and none.rate_pct is None
    r = O.conversion_rate(_log(spark, _trace(spark, "p", "AB" + "A" * 682)), "A", "B").first()
    assert (r.a_total, r.ab_total, r.rate_pct) == (683, 1, round(100 / 683, 5))


def test_conversion_rate_partition_invariance_n6(spark):
    recs = []
    for p in range(30):
        recs += _trace(spark, f"p{p}", "ABCAB"[p % 3:] + "AB", p * 10)
    log = _log(spark, recs)
    a = O.conversion_rate(log.repartition(1), "A", "B").first()
    b = O.conversion_rate(log.repartition(7), "A", "B").first()
    c = O.conversion_rate(log.repartition(7), "A", "B", bucket="minute").first()
    d = O.conversion_rate(log, "A", "B", count_tail=False, bucket="second").first()
    e = O.conversion_rate(log, "A", "B", count_tail=False, bucket="year").first()
    assert a == b == c and d == e


def test_sample_and_trace_n14(spark):
    log = _log(spark, _trace(spark, "p1", ["20001", "20002"]) + _trace(spark, "p2", ["20003"], 10)
               + _trace(spark, "p3", ["20004"], 20) + _trace(spark, "p4", ["20005"], 30))
    keys = O.sample_vehicles(log, n=10)
    assert keys.count() == 4
    tr = {r.vehiclePlate: r.trace for r in O.vehicle_trace(log, keys, key_bound=10).collect()}
    assert tr["p1"] == "16/01/2019 10:00:00 @ 20001->16/01/2019 10:00:01 @ 20002"
    seg = O.vehicle_trace(log, keys, key_bound=10, segment_steps=1).where(F.col(PLATE) == "p1")
    assert rows(seg, "segment", "trace") == [(0, "16/01/2019 10:00:00 @ 20001"),
                                             (1, "16/01/2019 10:00:01 @ 20002")]


def test_trace_orders_by_real_time_n2(spark):
    data = [(datetime(2019, 2, 1, 0, 0), "p", 1, "B", "c", 0), (datetime(2019, 1, 31, 0, 0), "p", 1, "A", "c", 1)]
    log = spark.createDataFrame(data, LOG_SCHEMA)
    t = O.vehicle_trace(log, log.select(PLATE).distinct()).first().trace
    assert t.startswith("31/01/2019")


def test_monitor_status_partition_invariance_n6(spark):
    dim = _dimension(spark)
    recs = [(k, "P1", 50, r.monitorId, r.cameraId) for k, r in enumerate(dim.collect())
            if k % 7 != 3]
    log = _log(spark, recs)
    for f in (O.error_monitors, O.error_cameras, O.status_summary):
        a = f(dim.repartition(1), log.repartition(1))
        b = f(dim.repartition(7), log.repartition(7, F.col(CAMERA)))
        assert rows(a) == rows(b)


def test_monitors_only_in_the_log_are_ignored_n19(spark):
    dim = spark.createDataFrame([("m", "c1")], "monitorId string, cameraId string")
    log = _log(spark, [(0, "p", 1, "m", "c1"), (1, "p", 1, "x", "c7")])
    assert O.error_monitors(dim, log).count() == 0
    assert O.error_monitors(dim, log, mode="size").count() == 0
    assert O.status_summary(dim, log).first().monitors == 1


def test_same_monitor_twice_counts_every_step_n20(spark):
    log = _log(spark, _trace(spark, "p", "AAA"))
    r = O.conversion_rate(log, "A", "A").first()
    assert (r.a_total, r.ab_total) == (3, 2)


def test_status_size_mode_of_cameras_and_summary(spark):
    dim = spark.createDataFrame([("m", "c1"), ("m", "c2"), ("k", "c3"), ("k", "c4")], "monitorId string, cameraId string")
    log = _log(spark, [(0, "p", 1, "m", "c1"), (1, "p", 1, "k", "c3"), (2, "p", 1, "k", "c9")])
    assert rows(O.error_cameras(dim, log)) == [("k", "c4"), ("m", "c2")]
    assert rows(O.error_cameras(dim, log, mode="size")) == [("m", "c2")]
    s = O.status_summary(dim, log, mode="size").first()
    assert (s.monitors, s.error_monitors, s.error_cameras, s.all_ok) == (2, 1, 1, False)


def test_sequences_run_on_a_loaded_log(spark, tmp_path):
    """TSV lines with the log's own columns only; readings of one time go by
    the monitor as a number (9 before 10)."""
    lines = ["16/01/2019 10:00:00\tp\t50\t1\t10\t1", "16/01/2019 10:00:00\tp\t50\t1\t9\t1",
             "16/01/2019 10:00:05\tp\t50\t1\t9\t1", "17/01/2019 10:00:00\tp\t50\t1\t10\t1", "too\tshort"]
    (tmp_path / "log.tsv").write_text("\n".join(lines))
    from roadlens.sources import load_vehicle_log
    log = load_vehicle_log(spark, str(tmp_path / "log.tsv"), view=None)
    r = O.conversion_rate(log, "9", "10").first()
    assert (r.a_total, r.ab_total) == (2, 2)
    r = O.conversion_rate(log, "9", "10", count_tail=False).first()
    assert (r.a_total, r.ab_total) == (2, 1)
    t = O.vehicle_trace(log, log.select(PLATE)).first().trace
    assert t == ("16/01/2019 10:00:00 @ 9->16/01/2019 10:00:00 @ 10->16/01/2019 10:00:05 @ 9->17/01/2019 10:00:00 @ 10")


def test_trace_keeps_readings_without_time_or_monitor(spark):
    data = [(None, "p", 1, "A", "c", 0), (datetime(2019, 1, 31), "p", 1, None, "c", 1),
            (datetime(2019, 1, 31), "p", 1, "B", "c", 2), (datetime(2019, 2, 1), "p", 1, "C", "c", 3)]
    log = spark.createDataFrame(data, LOG_SCHEMA)
    want = "null @ A->31/01/2019 00:00:00 @ null->31/01/2019 00:00:00 @ B->01/02/2019 00:00:00 @ C"
    keys = log.select(PLATE).distinct()
    assert O.vehicle_trace(log, keys, tie=["event_id"]).first().trace == want
    assert O.vehicle_trace(log, keys).first().trace == want
    parts = O.vehicle_trace(log, keys, tie=["event_id"], segment_steps=3).orderBy("segment").collect()
    assert "->".join(r.trace for r in parts) == want and len(parts) == 2


def test_a_reading_without_monitor_is_no_end_of_a_trace(spark):
    log = _log(spark, _trace(spark, "p", ["A", "B", None]))
    r = O.conversion_rate(log, "A", "B", count_tail=False, tie=["event_id"]).first()
    assert (r.a_total, r.ab_total) == (1, 1)


def test_sql_form_leaves_the_session_alone(spark):
    before = {t.name for t in spark.catalog.listTables()}
    O.top_speeding_monitors_sql(_log(spark, [(1, "p", 251, "m2", "c")])).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_conversion_matrix_cells_equal_conversion_rates(spark):
    rnd = random.Random(4)
    t0 = datetime(2019, 1, 16, 10, 0, 0)
    data = [(t0 + timedelta(seconds=rnd.randrange(20_000)), f"P{rnd.randrange(12)}", rnd.choice(["1", "2", "3", None]))
            for _ in range(400)] + [(None, "P1", "2"), (t0, None, "1")]
    log = spark.createDataFrame(data, "event_time timestamp_ntz, vehiclePlate string, monitorId string")
    for tail in (True, False):
        got = {(r.a, r.b): (r.a_total, r.ab_total, r.rate_pct) for r in O.conversion_matrix(log, count_tail=tail).collect()}
        for a in "123":
            for b in "123":
                want = O.conversion_rate(log, a, b, count_tail=tail).first()
                assert got[a, b] == (want.a_total, want.ab_total, want.rate_pct)
        assert sum(n for _, n, _ in got.values()) <= len(data) and (None, None) in got
    assert O.conversion_matrix(log.limit(0)).collect() == []


def test_readings_that_are_no_number_are_no_speed(spark):
    t0 = datetime(2019, 1, 16, 10, 0, 0)
    data = [(t0 + timedelta(seconds=s), "P", v, "m") for s, v in [(0, 300.0), (1, float("nan")), (2, float("inf")), (3, None), (4, 10.0)]]
    log = spark.createDataFrame(data, "event_time timestamp_ntz, vehiclePlate string, vehicleSpeed double, monitorId string")
    assert {(r.speed_sum, r.n) for r in O.windowed_avg_speed(log).collect()} <= {(310, 2), (300, 1), (10, 1)}
    assert [r.avg_speed for r in O.latest_speed_of_log(log, t0 + timedelta(seconds=60)).collect()] == [155]
    assert [r.vehicleSpeed for r in O.top_speed_readings(log, 250).collect()] == [float("inf"), 300.0]
    for f in (O.top_speeding_monitors, O.top_speeding_monitors_sql):
        assert [r.vehicleNum for r in f(log, 250).collect()] == [2]
