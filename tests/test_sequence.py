"""The two-level ordered sequence equals the plain window form, with one key
holding 40% of the rows, NULL keys and times, and buckets of any width."""

import random

import pytest
from pyspark.sql import Window, functions as F

from roadlens.plans import ordered_steps


def _data(spark):
    random.seed(1)
    data = []
    for i in range(3000):
        r = random.random()
        k = 7 if r < 0.4 else (None if r < 0.42 else random.randint(0, 300))
        t = None if r > 0.99 else random.randint(0, 10 ** 6)
        data.append((k, t, i, random.choice(["a", "b", None]), random.randint(0, 9)))
    return spark.createDataFrame(data, "k int, t long, id long, s string, m int")


@pytest.mark.parametrize("width,lookahead", [(1, 2), (1000, 2), (50_000, 1), (50_000, 3), (10 ** 7, 2)])
def test_ordered_steps_equals_window(spark, width, lookahead):
    df = _data(spark)
    bucket = F.floor(F.col("t") / width)
    w = Window.partitionBy("k").orderBy("t", "id")
    nexts = [c for i in range(1, lookahead + 1) for c in (
        F.lead("s", i).over(w).alias(f"next{i}_s"), F.lead("m", i).over(w).alias(f"next{i}_m"),
        F.lead(F.lit(True), i, False).over(w).alias(f"next{i}"))]
    exp = df.select("k", "t", "id", "s", "m", *nexts, (F.row_number().over(w) - 1).cast("bigint").alias("step"))
    with_step = ordered_steps(df, "k", ["t", "id"], ["s", "m"], bucket, lookahead, with_step=True).select(*exp.columns)
    assert with_step.count() == 3000
    assert with_step.exceptAll(exp).count() == 0 and exp.exceptAll(with_step).count() == 0
    plain = ordered_steps(df, "k", ["t", "id"], ["s", "m"], bucket, lookahead)
    exp = exp.drop("step")
    assert plain.select(*exp.columns).exceptAll(exp).count() == 0 and plain.count() == 3000


def test_nothing_runs_while_the_plan_is_built(spark):
    df = spark.range(3).select(F.raise_error(F.lit("ran")).cast("int").alias("k"), F.col("id").alias("t"))
    ordered_steps(df, "k", ["t"], ["t"], F.col("t"), with_step=True)


def test_checkpoint_root_from_session_setting(spark):
    from roadlens.plans import checkpoint_root, scratch_path
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root + "/roadlens/x-")


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    from types import SimpleNamespace

    from roadlens.plans import checkpoint_root
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", applicationId="x")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        checkpoint_root(session)
    context.master = "local[2]"
    assert checkpoint_root(session) == checkpoint_root(session)
