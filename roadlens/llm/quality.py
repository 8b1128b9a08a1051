"""Quality rules as a learned decision list over document statistics (operator 8).

Everything that touches documents is DataFrame expressions.  The learner sees
a bounded sample of labelled statistics (numbers only) and returns an ordered
list of threshold conjunctions, which become one ``CASE WHEN`` column.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from roadlens.llm.common import BLANK_RE

#: Symbols, window length, and the base rule's limits.
SYMBOL_RE = r"[^#*$%&|<>]+"
WINDOW = 5
MIN_WORDS, REPEAT_PERCENT = 10, 20

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the learner chooses from; ratios, so that rules hold at every length.
FEATURES = ("words", "word_length", "symbols_per_word", "dup_lines_per_line", "repeat_share", "upper_share",
            "marks_per_word")
#: Bound of the labelled sample, thresholds tried per feature, and rule limits.
MAX_LABELLED, CUTS, MAX_RULES, MAX_CONDITIONS = 20_000, 32, 12, 4
MIN_PRECISION, MIN_COVER = 0.98, 8

P = "_quality_"


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus its statistics, as columns with the prefix ``_quality_``.

    Every step is one array expression over the words of a text: the words'
    hashes, the hashes of all five-word windows, and (only in texts where a
    window repeats) the sorted windows that tell which words are covered.
    Each step is a projection of its own, so nothing is computed twice.
    A null text has no words."""
    c = lambda name: F.col(P + name)
    n5 = F.greatest(F.size(c("h")) - (WINDOW - 1), F.lit(0))
    text_ = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn(P + "words", F.filter(F.split(text_, BLANK_RE), lambda w: w != ""))
    d = d.withColumns({
        P + "h": F.transform(c("words"), lambda w: F.xxhash64(w)),
        P + "word_chars": F.length(F.concat_ws("", c("words"))).cast("bigint"),
        P + "n_symbols": F.length(F.regexp_replace(text_, SYMBOL_RE, "")).cast("bigint"),
        P + "n_upper": F.length(F.regexp_replace(text_, r"[^\p{Lu}]+", "")).cast("bigint"),
        P + "n_marks": F.length(F.regexp_replace(text_, r"[^!?]+", "")).cast("bigint"),
        P + "lines": F.filter(F.split(text_, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))),
    }).drop(P + "words")
    d = d.withColumns({
        P + "n_words": F.size(c("h")).cast("bigint"),
        P + "n_lines": F.size(c("lines")).cast("bigint"),
        P + "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("bigint"),
        P + "win": F.transform(F.arrays_zip(*[F.slice(c("h"), i + 1, n5) for i in range(WINDOW)]),
                               lambda z: F.xxhash64(*[z[str(i)] for i in range(WINDOW)])),
    }).drop(P + "h", P + "lines")
    d = d.withColumn(P + "repeats", F.size(F.array_distinct(c("win"))) < F.size(c("win")))
    d = d.withColumn(P + "sorted", F.when(c("repeats"), F.sort_array(F.transform(
        c("win"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop(P + "win")
    d = d.withColumn(P + "same", F.zip_with(
        c("sorted"), F.slice(c("sorted"), 2, F.greatest(F.size(c("sorted")), F.lit(1))),
        lambda a, b: F.coalesce(a["x"] == b["x"], F.lit(False))))
    d = d.withColumn(P + "at", F.sort_array(F.filter(F.zip_with(
        c("sorted"), F.zip_with(c("same"), F.concat(F.array(F.lit(False)), c("same")),
                                lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))),
        lambda s, f: F.when(f, s["i"])), lambda i: i.isNotNull()))).drop(P + "sorted", P + "same")
    covered = F.aggregate(
        F.zip_with(c("at"), F.slice(c("at"), 2, F.greatest(F.size(c("at")), F.lit(1))),
                   lambda p, q: F.least(F.lit(WINDOW), F.coalesce(q - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    # the row number is there so that a later filter on the statistics stays
    # above them: pushed down, it would compute them again inside the filter
    return d.withColumns({P + "n_repeat_words": F.when(c("repeats"), covered).otherwise(F.lit(0)).cast("bigint"),
                          P + "row": F.monotonically_increasing_id()}).drop(P + "repeats", P + "at")


def features() -> dict[str, Column]:
    """The learner's features from the columns of ``with_stats`` (0 for empty texts)."""
    c = lambda name: F.col(P + name).cast("double")
    ratio = lambda a, b: F.coalesce(F.try_divide(c(a), c(b)), F.lit(0.0))
    made = (c("n_words"), ratio("word_chars", "n_words"), ratio("n_symbols", "n_words"),
            ratio("n_dup_lines", "n_lines"), ratio("n_repeat_words", "n_words"), ratio("n_upper", "word_chars"),
            ratio("n_marks", "n_words"))
    return dict(zip(FEATURES, made))


def base_failed() -> Column:
    c = lambda name: F.col(P + name)
    return (c("row") >= 0) & ((c("n_words") < MIN_WORDS) | (c("n_repeat_words") * 100 > c("n_words") * REPEAT_PERCENT))


@dataclass(frozen=True)
class Rule:
    """Reject when all conditions ``(feature, is_at_least, threshold)`` hold."""
    conditions: tuple[tuple[str, bool, float], ...]

    def covers(self, row: dict) -> bool:
        return all(row[f] >= t if up else row[f] <= t for f, up, t in self.conditions)

    def column(self, cols: dict[str, Column]) -> Column:
        out = F.lit(True)
        for f, up, t in self.conditions:
            out = out & (cols[f] >= t if up else cols[f] <= t)
        return out


def _cuts(values: list[float]) -> list[float]:
    """Midpoints between neighbouring different values, ``CUTS`` quantiles of them."""
    v = sorted(set(values))
    mids = [(a + b) / 2 for a, b in zip(v, v[1:])]
    return mids if len(mids) <= CUTS else [mids[i * len(mids) // CUTS] for i in range(CUTS)]


def _grow(bad: list[dict], good: list[dict]) -> list[tuple[str, bool, float]]:
    """Adds the condition with the best information gain until no good row is left."""
    conditions = []
    while good and bad and len(conditions) < MAX_CONDITIONS:
        before, best = math.log2(len(bad) / (len(bad) + len(good))), None
        for f in FEATURES:
            xs, ys = sorted(r[f] for r in bad), sorted(r[f] for r in good)
            for t in _cuts(xs + ys):
                for up in (True, False):
                    p = len(xs) - bisect.bisect_left(xs, t) if up else bisect.bisect_right(xs, t)
                    n = len(ys) - bisect.bisect_left(ys, t) if up else bisect.bisect_right(ys, t)
                    if p:
                        gain = p * (math.log2(p / (p + n)) - before)
                        if best is None or gain > best[0]:
                            best = gain, (f, up, t)
        if best is None or best[0] <= 1e-9:
            break
        conditions.append(best[1])
        one = Rule((best[1],))
        bad, good = [r for r in bad if one.covers(r)], [r for r in good if one.covers(r)]
    return conditions


def _worth(rule: Rule, bad: list[dict], good: list[dict]) -> tuple[float, int]:
    p, n = sum(map(rule.covers, bad)), sum(map(rule.covers, good))
    return ((p - n) / (p + n) if p + n else -1.0), p


def learn_rules(rows: list[tuple[dict, int]]) -> list[Rule]:
    """Sequential covering of the rows labelled 0 (bad): each rule is grown on
    two thirds of the rows left and pruned (last conditions dropped) on the
    rest; it is kept while its precision there is ``MIN_PRECISION`` and it
    covers ``MIN_COVER`` bad rows of all that are left.  The order of ``rows``
    decides the split; no bad or no good rows: no rule."""
    bad, good = [r for r, y in rows if y == 0], [r for r, y in rows if y != 0]
    rules: list[Rule] = []
    part = lambda xs, keep: [x for i, x in enumerate(xs) if (i % 3 == 2) != keep]
    while bad and good and len(rules) < MAX_RULES:
        grown = _grow(part(bad, True), part(good, True))
        if not grown:
            break
        held_bad, held_good = part(bad, False), part(good, False)
        rule = max((Rule(tuple(grown[:k])) for k in range(len(grown), 0, -1)),
                   key=lambda r: _worth(r, held_bad, held_good)[0])
        p, n = sum(map(rule.covers, bad)), sum(map(rule.covers, good))
        if p < MIN_COVER or p / (p + n) < MIN_PRECISION or _worth(rule, held_bad, held_good)[0] < 2 * MIN_PRECISION - 1:
            break
        rules.append(rule)
        bad, good = [r for r in bad if not rule.covers(r)], [r for r in good if not rule.covers(r)]
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED, doc_id: str = "doc_id",
              text: str = "text", quality: str = "quality") -> list[Rule]:
    """Rules learned from about ``max_rows`` labelled documents (all of them
    where there are fewer), chosen by a hash of the id.  Only rows that the
    base rule passes are learned from.  A document with several labels counts
    as its lowest, an id with several texts as its smallest text; null ids and
    labels are left out."""
    known = (labels.select(F.col(doc_id).alias(P + "id"), F.col(quality).alias(P + "y")).dropna()
             .groupBy(P + "id").agg(F.min(P + "y").alias(P + "y")))
    n = known.count()
    place = F.pmod(F.xxhash64(F.lit("rules"), P + "id"), F.lit(max(n, 1)))
    # bounded by max_rows (in expectation), so the hint is safe
    chosen = F.broadcast(known.where(place < max_rows))
    # one row an id, so that the rows collected are bounded as the ids are
    rows = (docs.select(F.col(doc_id).alias(P + "id"), F.col(text).alias(P + "text")).join(chosen, P + "id")
            .groupBy(P + "id", P + "y").agg(F.min(P + "text").alias(P + "text")))
    stats = with_stats(rows, P + "text")
    found = (stats.select(base_failed().alias("failed"), F.xxhash64(F.lit("order"), P + "id").alias("o"),
                          F.col(P + "id").alias("id"), F.col(P + "y").alias("y"),
                          *[v.alias(k) for k, v in features().items()]).collect())
    found = [r for r in found if not r["failed"]]
    found.sort(key=lambda r: (r["o"], str(r["id"]), tuple(r[f] for f in FEATURES)))
    return learn_rules([({f: r[f] for f in FEATURES}, r["y"]) for r in found])


def first_rule(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that rejects a row of
    ``with_stats``, in the list's order; null if none does."""
    cols, out = features(), None
    for i, rule in enumerate(rules, 1):
        cond = rule.column(cols)
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, rule, kept)``.  A null or empty
    text has no words and fails the base rule; null and repeated ids and rows
    are kept row by row; other columns are ignored; an empty table gives an
    empty result.  One projection over the scan, no shuffle, no Python."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias(P + "text"))
    d = with_stats(src, P + "text").withColumns({"base_failed": base_failed(), "rule": first_rule(rules)})
    return d.select("doc_id", *[F.col(P + s).alias(s) for s in STATS], "base_failed", "rule",
                    (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge`` keeps.  The
    columns travel under numbers, so their names meet no name used here."""
    names = {c: f"{P}c{i}" for i, c in enumerate(docs.columns)}
    d = with_stats(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names[text])
    return d.where(~base_failed() & first_rule(rules).isNull()).select(*[F.col(n).alias(c) for c, n in names.items()])
