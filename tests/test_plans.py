"""Small planning helpers: checked broadcast, explicit scan spreading, folders
of finished versions, and plans without an expansion."""

import pytest

from roadlens.operators import latest_speed_of_log
from roadlens.plans import bounded_broadcast, finished_ids, remove_folder
from roadlens.sources import document_lines


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_bounded_broadcast_only_under_the_bound(spark):
    df = spark.range(5)
    assert "broadcast" in _plan(bounded_broadcast(df, 5)).lower()
    assert "broadcast" not in _plan(bounded_broadcast(df, 10 ** 9)).lower()
    assert "broadcast" not in _plan(bounded_broadcast(df, None)).lower()


def test_scans_are_spread_only_when_asked(spark, tmp_path):
    spark.createDataFrame([("a b\nc",)], "text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert "Repartition" not in _plan(document_lines(spark, str(tmp_path)))
    assert document_lines(spark, str(tmp_path), partitions=3).rdd.getNumPartitions() == 3


def test_latest_speed_expands_nothing(spark):
    log = spark.createDataFrame([], "event_time timestamp_ntz, monitorId int, vehicleSpeed int")
    plan = latest_speed_of_log(log)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_finished_versions(spark, tmp_path):
    base = f"{tmp_path}/roadlens/t"
    assert finished_ids(spark, base) == []
    for i in (2, 10):
        spark.range(1).write.parquet(f"{base}/batch_id={i}")
    (tmp_path / "roadlens/t/batch_id=11").mkdir()
    assert finished_ids(spark, base) == [2, 10]
    remove_folder(spark, f"{base}/batch_id=2")
    assert finished_ids(spark, base) == [10]
    with pytest.raises(ValueError):
        remove_folder(spark, str(tmp_path))
