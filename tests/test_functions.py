from pyspark.sql import functions as F

from roadlens.functions import (
    congestion_level, hour_of_text, hour_of_time, java_split, truncating_average,
)


def test_java_split_rule_n1(spark):
    df = spark.createDataFrame([("",), ("-",), ("a--b--",), ("-a",), (None,)], "s string")
    got = {r.s: r.p for r in df.select("s", java_split("s", "-").alias("p")).collect()}
    assert got[""] == [""]
    assert got["-"] == []
    assert got["a--b--"] == ["a", "", "b"]
    assert got["-a"] == ["", "a"]
    assert got[None] is None


def test_java_split_multichar_and_regex_meta(spark):
    df = spark.createDataFrame([("a->b->",), ("x.y..",)], "s string")
    got = df.select(java_split("s", "->").alias("p"), java_split("s", ".").alias("q")).collect()
    assert got[0].p == ["a", "b"]
    assert got[1].q == ["x", "y"]


def test_hour_of_text_without_validation(spark):
    df = spark.createDataFrame(
        [(None,), ("x",), ("16/01/2019 10:20",), ("16/01/2019 10:20:30",), ("x 99:1:1",),
         ("01/01/2019 9:05:01",)], "t string")
    got = [r.h for r in df.select(hour_of_text("t").alias("h")).collect()]
    assert got == ["", "", "", "10", "99", "9"]


def test_hour_of_time_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "t timestamp_ntz")
    assert df.select(hour_of_time("t").alias("h")).first().h == ""


def test_truncating_average_and_levels(spark):
    df = spark.createDataFrame([(7, 2), (5, 0), (300, 60)], "s long, n long")
    got = [r.a for r in df.select(truncating_average("s", "n").alias("a")).collect()]
    assert got == [3, None, 5]
    lv = spark.createDataFrame([(0,), (5,), (6,), (10,), (11,), (30,), (31,)], "v int")
    assert [r.l for r in lv.select(congestion_level(F.col("v")).alias("l")).collect()] == [
        "jammed", "jammed", "severe", "severe", "slow", "slow", "normal"]
