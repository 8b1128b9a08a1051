"""Forms for very many keys and for periods: the answers of the plain
operators, and what they read and shuffle on the way."""

import random

import pytest
from pyspark.sql import functions as F

from roadlens import operators as O, schemas as S
from roadlens.operators import frequent
from roadlens.sources import classify_tsv, parse_tsv, split_lines


def tuples(df):
    return [tuple(r) for r in df.collect()]


def zipf(spark, n=40_000, keys=9_000, seed=1):
    rnd = random.Random(seed)
    data = [(f"k{min(int(rnd.paretovariate(0.9)), keys)}", rnd.choice([100, 300])) for _ in range(n)]
    data += [(None, 300)] * 3_000 + [(f"once{i}", 300) for i in range(8_000)]
    return spark.createDataFrame(data, "monitorId string, vehicleSpeed int").repartition(5)


# --- sketches -------------------------------------------------------------------
def test_candidates_are_counted_and_the_answer_is_the_same(spark):
    log = zipf(spark)
    for tracked in (256, 2048, 65_536):
        assert tuples(frequent.frequent_keys(log, "monitorId", 5, tracked=tracked)) == \
            [tuple(r) for r in O.top_monitors(log, 5).collect()]
    found = frequent.candidates(log, "monitorId", 5, tracked=2048)
    assert found is not None and 5 <= len(found) < 100 and None in found
    assert tuples(O.top_monitors_of_many(log)) == tuples(O.top_monitors(log))
    assert tuples(O.top_speeding_monitors_of_many(log)) == tuples(O.top_speeding_monitors(log))


def test_keys_that_no_bound_separates_are_all_counted(spark):
    log = spark.range(20_000).select((F.col("id") % 5_000).alias("monitorId"))
    assert frequent.candidates(log, "monitorId", 10, tracked=256) is None
    assert tuples(frequent.frequent_keys(log, "monitorId", 10, "vehicleNum", tracked=256)) == tuples(O.top_monitors(log))


def test_few_and_no_rows(spark):
    log = spark.createDataFrame([("a",), ("a",), (None,)], "monitorId string")
    assert tuples(O.top_monitors_of_many(log)) == [("a", 2), (None, 1)]
    assert tuples(O.top_monitors_of_many(log.limit(0))) == []
    lines = spark.createDataFrame([("x y x",), ("",), (None,)], "value string")
    assert tuples(O.top_words(lines)) == [("x", 2), ("", 1), ("y", 1)]


def test_bounds_never_lose_a_key():
    """Any counts within the sketch's error, and any unlisted keys it allows."""
    rnd = random.Random(5)
    kept = 0
    for _ in range(400):
        true = {k: int(rnd.paretovariate(0.5)) for k in range(rnd.randrange(3, 60))}
        rows, n, tracked, most = sum(true.values()), 3, 512, 40
        error = frequent.largest_error(rows, tracked)
        bounds = {k: v + rnd.randrange(error + 1) for k, v in true.items()}
        listed = sorted((k for k in true if bounds[k] > 2 * error or rnd.random() < 0.5), key=lambda k: -bounds[k])[:most]
        found = frequent.separated([(k, bounds[k]) for k in listed], rows, n, tracked, most)
        if found is not None:
            kept += 1
            assert set(sorted(true, key=lambda k: (-true[k], k))[:n]) <= set(found)
    assert kept > 50


def test_only_candidates_are_shuffled(spark):
    log = zipf(spark)
    frequent_plan = O.top_monitors_of_many(log)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in frequent_plan and "Broadcast" in frequent_plan


# --- bitmaps --------------------------------------------------------------------
def devices(spark, seed=2):
    rnd = random.Random(seed)
    dim = [(m, c) for m in list(range(8)) + [None] for c in rnd.sample(range(-70, 200), 20)] + [(1, None), (50, 3), (50, 3)]
    log = [(m, c, rnd.randrange(3)) for m, c in dim if rnd.random() < 0.95 for _ in range(2)] + [(2, 9_000_000_000, 1), (77, 1, 2)]
    return (spark.createDataFrame(dim, "monitorId int, cameraId bigint"),
            spark.createDataFrame(log, "monitorId int, cameraId bigint, period int"))


def test_bitmaps_give_the_status_of_the_log(spark):
    for seed in (2, 3):
        dim, log = devices(spark, seed)
        seen = O.seen_bitmaps(log)
        for mode in ("size", "content"):
            assert tuples(O.error_monitors_of_bitmaps(dim, seen, mode)) == tuples(O.error_monitors(dim, log, mode))
        assert tuples(O.error_cameras_of_bitmaps(dim, seen)) == tuples(O.error_cameras(dim, log))
    with pytest.raises(TypeError):
        O.seen_bitmaps(log.withColumn("cameraId", F.lit("x")))


def test_a_new_period_reads_only_itself(spark, tmp_path):
    dim, log = devices(spark)
    path = f"{tmp_path}/status"
    parts = [log.where(F.col("period") == p) for p in range(3)]
    for p in (0, 1):
        assert O.add_period(path, p, parts[p])
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    assert O.add_period(path, 2, parts[2]) and not O.add_period(path, 1, parts[1])
    after = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) > len(before)
    kept = O.kept_bitmaps(spark, path)
    assert sorted(map(str, tuples(kept))) == sorted(map(str, tuples(O.seen_bitmaps(log))))
    assert tuples(O.error_monitors_of_bitmaps(dim, kept)) == tuples(O.error_monitors(dim, log, "size"))


# --- sample ---------------------------------------------------------------------
def test_sample_of_many_vehicles(spark):
    for keys in (3, 60, 30_000):
        log = spark.range(2 * keys).select((F.col("id") % keys).alias(S.PLATE)).unionByName(
            spark.createDataFrame([(None,)], f"{S.PLATE} bigint"))
        for seed in (1, 42):
            want = sorted(tuples(O.sample_vehicles(log, 10, seed)))
            assert sorted(tuples(O.sample_vehicles_of_many(log, 10, seed))) == want and len(want) == min(10, keys)
    assert tuples(O.sample_vehicles_of_many(log.limit(0))) == []


# --- rejected lines -------------------------------------------------------------
def test_both_outputs_hold_every_line(spark, tmp_path):
    good = "16/01/2019 10:20:30\tP\t120\t1\t2\t4"
    lines = [good, good, "bad", "", None, good.replace("120", "fast"), good + "\t", good + "\t\tx", "\t\t\t", good.replace("120", "")]
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    records, rejected, counts = split_lines(df, S.VEHICLE_LOG, f"{tmp_path}/out")
    assert sorted(tuples(records)) == sorted(tuples(parse_tsv(df, S.VEHICLE_LOG)))
    assert sorted(map(str, tuples(rejected))) == sorted(map(str, [
        ("bad", "fields"), ("", "fields"), (None, "null"), (lines[5], "number"), (lines[7], "fields"), ("\t\t\t", "fields"), (lines[9], "number")]))
    assert counts == {"lines": 10, "records": 3, "fields": 4, "number": 2, "null": 1}
    assert records.count() + rejected.count() == len(lines)
    empty = split_lines(df.limit(0), S.VEHICLE_LOG, f"{tmp_path}/none")
    assert empty[0].count() == empty[1].count() == 0 and empty[2]["lines"] == 0


def test_classified_lines_keep_their_text(spark):
    df = spark.createDataFrame([("1\tx",), ("y\tx",), ("1",)], "value string")
    got = sorted(tuples(classify_tsv(df, spark.createDataFrame([], "a int, b string").schema)))
    assert got == [("1", "fields", None, None), ("1\tx", None, 1, "x"), ("y\tx", "number", None, None)]
