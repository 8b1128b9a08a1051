"""Top-k counts over very many keys (Q02, Q04, Q06) without shuffling every key.

A first pass fills Spark's frequent-items sketches, one per task, merged in
two levels.  The sketch bounds every count from both sides.  If the bound
separates the top ``n`` from all keys that are no candidates, a second pass
counts the few candidates exactly; otherwise every key is counted, as the
plain operators do.  The answer is the same in both cases.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from roadlens import schemas as S
from roadlens.functions import is_over
from roadlens.plans import bounded_broadcast

#: Keys that a sketch tracks, and candidates that are counted exactly at most.
TRACKED, CANDIDATES = 16_384, 4_096
#: Tasks in which the tasks' sketches are merged before the last merge.
MERGE_TASKS = 64


def largest_error(rows: int, tracked: int) -> int:
    """How far a sketch's count may be above the truth: 3.5 rows in every slot
    of its table (a fixed value of the sketch; the table is three quarters full)."""
    return ceil(3.5 * rows / 2 ** ceil(log2(ceil(tracked / 0.75))))


def separated(top: list[tuple[object, int]], rows: int, n: int, tracked: int, most: int) -> list | None:
    """The keys that may be among the top ``n``, given the sketch's ``top``
    (key, upper bound) and the number of rows; None if keys outside of the list
    may be, too."""
    error = largest_error(rows, tracked)
    bounds = sorted((c for _, c in top), reverse=True)
    if len(bounds) < n:
        return None
    sure = bounds[n - 1] - error                 # the n-th key has at least so many rows
    # a key that is not listed: below the list's end, or not known to the sketch for sure
    beyond = max(2 * error, bounds[-1] if len(bounds) >= most else 0)
    return [k for k, c in top if c >= sure] if sure > beyond else None


def candidates(rows: DataFrame, key: str, n: int, tracked: int = TRACKED, most: int = CANDIDATES) -> list | None:
    """Runs the sketch pass over ``key``; see :func:`separated`."""
    most = min(most, tracked)
    dealt = rows.select(F.col(key).alias("k"), F.pmod(F.spark_partition_id(), F.lit(MERGE_TASKS)).alias("p"))
    parts = dealt.groupBy("p").agg(F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("s"), F.count(F.lit(1)).alias("c"))
    # grouped by a constant: without rows there is no sketch to be merged
    whole = parts.withColumn("g", F.lit(0)).groupBy("g").agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"), F.sum("c").alias("c"))
    found = whole.select(F.expr(f"approx_top_k_estimate(s, {most})").alias("top"), "c").first()
    return found and separated([(r["item"], r["count"]) for r in found["top"]], found["c"], n, tracked, most)


def frequent_keys(rows: DataFrame, key: str, n: int = S.TOP_K, count: str = "n", tracked: int = TRACKED,
                  most: int = CANDIDATES) -> DataFrame:
    """``(key, count)`` of the ``n`` most frequent keys (NULL is a key), ties by
    key.  Runs the sketch pass when called; with candidates the shuffle holds at
    most ``most`` keys a task."""
    found = candidates(rows, key, n, tracked, most)
    kept = rows.select(key)
    if found is not None:
        schema = StructType([StructField("_k", rows.schema[key].dataType)])
        few = bounded_broadcast(rows.sparkSession.createDataFrame([(k,) for k in found], schema), len(found))
        kept = kept.join(few, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    counts = kept.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.desc(count), F.asc_nulls_first(key)).limit(n)


def top_monitors_of_many(log: DataFrame, n: int = S.TOP_K, monitor: str = S.MONITOR) -> DataFrame:
    """The answer of ``top_monitors`` where there are very many monitors."""
    return frequent_keys(log, monitor, n, "vehicleNum")


def top_speeding_monitors_of_many(log: DataFrame, over: float = S.OVER_SPEED, n: int = S.TOP_K,
                                  monitor: str = S.MONITOR, speed: str = S.SPEED) -> DataFrame:
    """The answer of ``top_speeding_monitors`` where there are very many monitors."""
    return frequent_keys(log.where(is_over(speed, over)), monitor, n, "vehicleNum")


def top_words(lines: DataFrame, sep: str = " ", n: int = S.TOP_K, text_col: str = "value") -> DataFrame:
    """``(word, n)``: the ``n`` most frequent words of ``word_count``."""
    from roadlens.operators.text import words

    return frequent_keys(words(lines, sep, None, text_col), "word", n)
