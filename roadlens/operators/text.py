"""Word counts over text lines (Q01, Q01b, Q02).

Counting is ``explode`` + ``groupBy().agg(count)``: a partial aggregate in
every map task before the shuffle, so a very frequent word costs one row
per task, not one row per occurrence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from roadlens.functions import java_split
from roadlens.plans import bounded_broadcast


def words(lines: DataFrame, sep: str, needles: Sequence[str] | None = None,
          text_col: str = "value") -> DataFrame:
    """One row per word occurrence, column ``word``.  With ``needles`` only
    lines containing at least one needle are split.  Splitting follows Java
    ``String.split`` (an empty line yields one empty word)."""
    line = F.col(text_col)
    if needles:
        cond = None
        for nd in needles:
            c = line.contains(nd)
            cond = c if cond is None else (cond | c)
        lines = lines.where(cond)
    return lines.select(F.explode(java_split(line, sep)).alias("word"))


def _counts(lines: DataFrame, sep: str, needles, text_col: str) -> DataFrame:
    return words(lines, sep, needles, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count(lines: DataFrame, sep: str = "\t", needles: Sequence[str] | None = None,
               text_col: str = "value") -> DataFrame:
    """``(word, n)`` ordered by ``n`` descending, then word."""
    return _counts(lines, sep, needles, text_col).orderBy(F.desc("n"), F.asc("word"))


def word_count_distinct(lines: DataFrame, sep: str = "\t", needles: Sequence[str] | None = None,
                        text_col: str = "value") -> DataFrame:
    """One row: ``n_words`` = number of rows of :func:`word_count`."""
    return _counts(lines, sep, needles, text_col).agg(F.count(F.lit(1)).alias("n_words"))


def remove_top_word(lines: DataFrame, sep: str = " ", text_col: str = "value") -> DataFrame:
    """Counts of all words except the single most frequent one (a tie goes to
    the smallest word), ordered by ``n`` descending, then word.  The top
    word is found by a top-1 sort (no collect) and removed by an anti join
    against that one row, which is broadcast.  The join is on ``(word, n)``:
    ``n`` only exists after the aggregate, so the join cannot be pushed below
    it and both branches share one aggregation (one reused exchange)."""
    counts = _counts(lines, sep, None, text_col)
    top = counts.orderBy(F.desc("n"), F.asc("word")).limit(1)
    return (counts.join(bounded_broadcast(top, 1), ["word", "n"], "left_anti")
            .orderBy(F.desc("n"), F.asc("word")))
