"""Commit log, progress table, chained panes and keyed state."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadlens import operators as O, streaming as ST
from roadlens.plans import scratch_path
from roadlens.streaming import commits
from roadlens.streaming.keyed import _step

SCHEMA = "event_time timestamp_ntz, vehiclePlate string, vehicleSpeed double, monitorId string"
START = datetime(2019, 1, 16, 10, 0, 0)


def put(spark, folder, name, rows):
    data = [(START + timedelta(seconds=t), "p", v, m) for t, m, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def source(spark, folder):
    return (spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def run(spark, folder, make, base=None, progress=True):
    return ST.run_available_now(make(source(spark, folder)), lambda p: ST.commit_sink(p), "test-state", "append",
                                folder=base, progress=progress)


def table(spark, base):
    return ST.read_committed(spark, f"{base}/table")


def tuples(df):
    return sorted(map(tuple, df.collect()))


# --- commit log ---------------------------------------------------------------
def test_half_written_batches_and_replays_are_not_seen(spark, tmp_path):
    path = f"{tmp_path}/table"
    one, two = (spark.createDataFrame([(i, f"r{i}") for i in r], "id bigint, v string") for r in (range(3), range(3, 5)))
    with pytest.raises(FileNotFoundError):
        ST.read_committed(spark, path)
    assert ST.append_batch(one, path, 0)
    two.write.parquet(f"{path}/data/batch=1-half")            # written, not committed
    (tmp_path / "table/_commits/.00000000000000000001.json.half").write_text('{"files": ["batch=1-half"')
    assert tuples(ST.read_committed(spark, path)) == tuples(one)
    assert not ST.append_batch(one, path, 0)                  # replayed
    assert ST.append_batch(two, path, 1) and ST.append_batch(one.limit(0), path, 2)
    assert ST.committed_batches(spark, path) == [0, 1, 2]
    assert tuples(ST.read_committed(spark, path)) == tuples(one.union(two))
    assert ST.remove_uncommitted(spark, path) == ["batch=1-half"]
    assert ST.read_committed(spark, path).count() == 5


def test_a_second_writer_of_a_batch_does_not_replace_the_first(spark, tmp_path):
    assert commits.write_file(spark, str(tmp_path), "a.json", "first")
    assert not commits.write_file(spark, str(tmp_path), "a.json", "second")
    assert (tmp_path / "a.json").read_text() == "first"
    assert commits.write_file(spark, str(tmp_path), "a.json", "third", replace=True)
    assert (tmp_path / "a.json").read_text() == "third"
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]  # no temporary file stays


def test_compacted_log_gives_the_same_rows(spark, tmp_path):
    path = f"{tmp_path}/table"
    make = lambda i: spark.createDataFrame([(i % 2, i)], "k int, t int")
    for i in range(4):
        ST.append_batch(make(i), path, i)
    before = ST.read_committed(spark, path)
    assert ST.compact(spark, path) == 3 and ST.compact(spark, path) is None
    assert not ST.append_batch(make(9), path, 2)              # a batch inside the compacted ones
    ST.append_batch(make(4), path, 4)
    assert ST.committed_batches(spark, path) == [3, 4]
    assert tuples(before) == [(i % 2, i) for i in (0, 2)] + [(1, 1), (1, 3)]  # an older reader still reads its files
    assert tuples(ST.read_committed(spark, path)) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3)]
    ST.compact(spark, path, lambda df: ST.newest_per_key(df, "k", "t"))
    ST.remove_uncommitted(spark, path)
    assert tuples(ST.read_committed(spark, path)) == [(0, 4), (1, 3)]


# --- progress -----------------------------------------------------------------
def test_late_rows_are_counted(spark, tmp_path):
    src = f"{tmp_path}/src"
    make = lambda s: ST.stream_latest_speed(s, "10 seconds")
    put(spark, src, "a", [(0, "m", 10.0), (100, "m", 20.0)])
    base = run(spark, src, make)
    put(spark, src, "b", [(89, "m", 1.0), (90, "x", 1.0), (91, "x", 1.0), (30, None, 5.0), (30, "m", float("nan")), (200, "m", 1.0)])
    run(spark, src, make, base)
    put(spark, src, "c", [(300, "m", 1.0)])
    run(spark, src, make, base)
    rows = ST.read_progress(spark, f"{base}/progress").groupBy("run_id").agg(
        F.min("batch_id").alias("b"), F.sum("input_rows").alias("n"), F.sum("late_rows").alias("late")).orderBy("b").collect()
    assert [(r.n, r.late) for r in rows] == [(2, 0), (6, 3), (1, 0)]


def test_progress_without_state_and_of_other_queries(spark, tmp_path):
    put(spark, f"{tmp_path}/src", "a", [(0, "m", 10.0)])
    base = run(spark, f"{tmp_path}/src", lambda s: s)
    other = run(spark, f"{tmp_path}/src", lambda s: s, progress=False)
    got = ST.read_progress(spark, f"{base}/progress").collect()
    assert sum(r.input_rows for r in got) == 1 and all(r.operator is None and r.late_rows is None for r in got)
    assert table(spark, other).count() == 1


# --- panes --------------------------------------------------------------------
def readings(seed=3, n=300, span=6000, monitors=6):
    rnd = random.Random(seed)
    return [(rnd.randrange(span), f"m{rnd.randrange(monitors)}", float(rnd.randrange(-50, 300))) for _ in range(n)]


def test_chained_panes_give_the_same_windows_with_a_twelfth_of_the_state(spark, tmp_path):
    src, rows = f"{tmp_path}/src", sorted(readings())
    for i in range(3):
        put(spark, src, str(i), rows[100 * i:100 * i + 100])
    bases = [run(spark, src, lambda s, f=f: f(s, "10 seconds")) for f in (ST.stream_avg_speed, ST.stream_avg_speed_panes)]
    one, two = (table(spark, b) for b in bases)
    assert tuples(one) == tuples(two.select(one.columns)) and one.count() > 1000
    log = spark.read.option("recursiveFileLookup", "true").parquet(src)
    closed = O.windowed_avg_speed(log).where(F.col("window_end") <= F.lit(START + timedelta(seconds=rows[-1][0] - 10)).cast("timestamp_ntz"))
    assert tuples(closed.select(one.columns)) == tuples(one)


def test_the_state_of_chained_panes_is_a_twelfth(spark, tmp_path):
    """Readings of a monitor more than a window apart: each makes 12 windows."""
    src, rows = f"{tmp_path}/src", [(70 * i + k, f"m{k}", 1.0) for i in range(60) for k in range(5)]
    for i in range(2):
        put(spark, src, str(i), rows[150 * i:150 * i + 150])
    most = []
    for f in (ST.stream_avg_speed, ST.stream_avg_speed_panes):
        base = run(spark, src, lambda s, f=f: f(s, "1 hour"))
        batches = ST.read_progress(spark, f"{base}/progress").groupBy("batch_id").agg(F.sum("state_rows").alias("n"))
        most.append(batches.agg(F.max("n")).first()[0])
    assert most == [12 * 300, 300]


# --- keyed state --------------------------------------------------------------
def latest(spark, base):
    return ST.newest_per_key(table(spark, base), "monitorId", "window_end")


def expected(spark, folder, last, delay):
    log = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    return O.latest_speed(O.windowed_avg_speed(log), START + timedelta(seconds=last - delay))


def test_keyed_state_equals_the_closed_windows_over_batches_and_a_restart(spark, tmp_path):
    src, rows = f"{tmp_path}/src", sorted(readings(5)) + [(8000, None, 7.0), (9000, "m1", 3.0)]
    make = lambda s: ST.stream_latest_speed(s, "10 seconds")
    base = None
    for i, to in enumerate((120, 240, 300, 301, 302)):
        put(spark, src, str(i), rows[(0, 120, 240, 300, 301)[i]:to])
        base = run(spark, src, make, base)                    # resumes from the checkpoint
        want = expected(spark, src, rows[to - 1][0], 10)
        assert tuples_of_state(latest(spark, base)) == tuples_of_state(want)
    progress = ST.read_progress(spark, f"{base}/progress").orderBy("batch_id").collect()
    # the batch of one reading touches that monitor and those whose windows it closes, not all seven
    assert [r.updated_rows for r in progress if r.input_rows == 1][-1] == 1


def tuples_of_state(df):
    return sorted(((r.monitorId is not None, r.monitorId or ""), r.avg_speed, str(r.window_end)) for r in df.collect())


def test_steps_of_the_state_against_all_windows():
    rnd = random.Random(8)
    for window, slide, pane in ((60, 5, 5), (15, 10, 5), (10, 10, 10), (5, 10, 5)):
        panes, every, end, avg = {}, {}, 0, None
        mark = 0
        for _ in range(60):
            for _ in range(rnd.randrange(4)):
                p = (mark + rnd.randrange(1, 120)) // pane * pane
                if p + pane > mark:
                    for d in (panes, every):
                        s, n = d.get(p, (0, 0))
                        d[p] = (s + 7, n + 1)
            old, mark = mark, mark + rnd.randrange(0, 40)
            end, new, panes, timer = _step(dict(panes), end, mark, window, slide)
            avg = avg if new is None else new
            closed = [s for s in range(-(window // slide + 1) * slide, mark, slide) if s + window <= mark
                      and any(s <= p < s + window for p in every)]
            assert end == (max(closed) + window if closed else 0)
            assert timer is None or timer > mark
            assert timer is not None or all(p < (mark - window) // slide * slide + slide for p in every)
