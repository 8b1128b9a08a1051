"""Mixing against a plain iteration of the target rule and word accounting."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from roadlens.llm import mixing
from tests.llm.edges import edge_docs, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), passes=3):
    """The rule as written: share by weight, cut what is above, share again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left, rest = total - sum(passes * sizes[s] for s in full), sum(w[s] for s in order if s not in full)
        out = {s: float(passes * sizes[s]) if s in full else left * w[s] / rest for s in order}
        above = {s for s in order if s not in full and out[s] > passes * sizes[s]}
        if not above:
            return out
        full |= above


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def many(spark):
    rows, i = [], 0
    for source, n, words in (("a", 3, 40), ("b", 300, 60), (None, 200, 30), ("c", 2, 5), ("é", 150, 44), ("z", 1, 2000)):
        for _ in range(n):
            rows.append((i, " ".join(f"w{i}x{k}" for k in range(words + i % 7)), source))
            i += 1
    return rows


def test_targets_follow_the_rule(spark):
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, None: 10, "c": 0}, {"a": 0}, {"x": 7},
                  {"a": 5, "b": 6, "c": 7, "d": 10_000, "e": 2, "f": 3, "g": 9}):
        sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
        got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
        want = targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want), (got, want)


def test_taken_words_come_near_the_targets(spark):
    rows = many(spark)
    out = mixing.mixed_sizes(docs_of(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes, taken = Counter(), Counter()
    by_id = {i: (t, s) for i, t, s in rows}
    for i, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    want = targets(sizes)
    for r in out:
        t, s = by_id[r.doc_id]
        assert r.size == len(WORD.findall(t)) and r.source_size == sizes[s] and 0 <= r.taken <= 3 * r.size
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        taken[s] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= max(2 * mixing.BLOCK, 0.02 * want[s]), s
    again = docs_of(spark, rows[::-1]).repartition(5)
    assert sorted(map(tuple, mixing.mixed_sizes(again).collect())) == sorted(map(tuple, out))


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 7, 8, 9, 64, 100, 1023, 1025, 4096):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3).cast("bigint")).alias("p"))
        assert sorted(r.p for r in got.collect()) == list(range(n))


def test_shard_counts_are_draws(spark):
    wanted = mixing.written(spark.createDataFrame([(0, 100_000, 60_000), (1, 100_000, 30_000), (2, 100_000, 10_000)],
                                                  "sid bigint, n_blocks bigint, slots bigint"), "t")
    slots = mixing.draw_slots(wanted).collect()
    per = defaultdict(list)
    for r in slots:
        per[r.sid].append(r.k)
    assert {s: sorted(k) == list(range(len(k))) and len(k) for s, k in per.items()} == {0: 60_000, 1: 30_000, 2: 10_000}
    first = Counter(r.sid for r in slots if r.shard == 0)
    assert sum(first.values()) == mixing.SHARD and abs(first[0] - 614) < 90


def test_mixed_documents_hold_the_taken_words(spark):
    rows = many(spark)
    docs = docs_of(spark, rows).withColumn("n_chars", F.length("text")).withColumn("row", F.lit("x"))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got, text = Counter(), {i: t for i, t, _ in rows}
    for r in out.collect():
        words = WORD.findall(r.text)
        assert r.n_chars == len(r.text) and set(words) <= set(WORD.findall(text[r.doc_id]))
        assert len(words) == len(set(words))
        got[r.doc_id] += len(words)
    taken = {r.doc_id: r.taken for r in mixing.mixed_sizes(docs).collect()}
    total = sum(taken.values())
    assert abs(sum(got.values()) - total) <= 0.02 * total
    assert all(n <= 3 * len(WORD.findall(text[i])) for i, n in got.items())


def test_edges(spark):
    out = mixing.mixed_sizes(edge_docs(spark)).collect()
    assert len(out) == edge_docs(spark).count()
    assert all(r.taken <= 3 * r.size for r in out) and all(r.taken == 0 for r in out if r.size == 0)
    assert mixing.mixed_sizes(empty_docs(spark)).count() == 0
    assert mixing.mixed_documents(empty_docs(spark)).count() == 0
    assert mixing.mixed_documents(edge_docs(spark)).columns == edge_docs(spark).columns
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id bigint, text string, source string")
    assert [tuple(r)[1:] for r in mixing.mixed_sizes(blank).collect()] == [(0, 0, 0.0, 0)] * 2
