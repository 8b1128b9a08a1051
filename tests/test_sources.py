"""Loaders in the original file layouts and the stream reader."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from roadlens import operators as O
from roadlens.sources import (
    ego_lists, load_relationship, load_text_lines, load_vehicle_log, parse_stream_log, read_stream,
)

LOG_LINES = [
    "16/01/2019 10:20:30\tSKJ28792C\t120\t10001\t20001\t40001",
    "16/01/2019 11:05:00\tSKJ28792C\t80\t10001\t20002\t40003",
    "16/01/2019 11:06:00\tSAB00001A\t300\t10002\t20003\t40005",
    "broken line without six fields",
]


def _write(lines, name):
    d = tempfile.mkdtemp(prefix="rl-src-")
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_load_vehicle_log_modes_and_view(spark):
    p = _write(LOG_LINES, "vehicle_log")
    log = load_vehicle_log(spark, p)
    assert log.count() == 3
    assert spark.table("t_vehicle_log").count() == 3
    assert log.where(F.col("event_time").isNull()).count() == 0
    assert {r.hour for r in O.busiest_hours(log).collect()} == {"10", "11"}
    raw = O.busiest_hours(log, time="dateTime", raw_text=True)
    assert {(r.hour, r.vehicleNum) for r in raw.collect()} == {("10", 1), ("11", 2)}
    with pytest.raises(Exception):
        load_vehicle_log(spark, p, mode="FAILFAST", view=None).count()


def test_load_relationship(spark):
    p = _write(["10001\t20001\t40001", "10001\t20001\t40002", "10001\t20002\t40003"], "rel")
    rel = load_relationship(spark, p)
    assert rel.columns == ["roadId", "monitorId", "cameraId"]
    assert spark.table("t_road_monitor_camera_relationship").count() == 3


def test_text_lines_and_ego_lists(spark):
    p = _write(["A B C", "B A", "", "C A"], "ego")
    ego = ego_lists(load_text_lines(spark, p))
    got = sorted((r.head, r.member) for r in ego.collect())
    assert got == [("A", "B"), ("A", "C"), ("B", "A"), ("C", "A")]


def test_read_stream_text_and_parse(spark):
    d = tempfile.mkdtemp(prefix="rl-stream-")
    with open(os.path.join(d, "part-0.txt"), "w") as f:
        f.write("2019-01-16 10:00:01\tP1\t3\t10001\t20001\t40001\nILLEGAL_LOG\n"
                "2019-01-16 10:00:02\tP2\t4\t10001\t20001\t40002\n")
    lines = read_stream(spark, "text", path=d)
    assert lines.isStreaming
    parsed = parse_stream_log(lines)
    q = (parsed.writeStream.format("memory").queryName("rl_parsed")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table("rl_parsed")
    assert got.count() == 2 and got.agg(F.sum("vehicleSpeed")).first()[0] == 7
