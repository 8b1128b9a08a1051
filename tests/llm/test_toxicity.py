"""Toxicity: accuracy on held-out rows, pairs of terms, and edge rows."""

import itertools
import random
import zlib

import numpy as np

from roadlens.llm import toxicity as T
from tests.llm.edges import edge_docs, empty_docs

LABELS = "doc_id bigint, toxic int, quality int, score string, text string"


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in T.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
               for i, r in got.items())
    held = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([p for y, p in held if y == 1]) > 0.9 and np.mean([p for y, p in held if y == 0]) < 0.01


def test_held_out_labels_change_nothing(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    flipped = spark.createDataFrame([(r.doc_id, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.toxic, 0, "", "")
                                     for r in labels.collect()], LABELS)
    scores = [{r.doc_id: r.score for r in T.toxicity(docs.repartition(k), x).collect()} for k, x in ((1, labels), (6, flipped))]
    assert scores[0] == scores[1]


def test_pairs_that_additive_weights_miss():
    """Toxic: an insult with a group; an insult alone, a group alone and
    neither are not, in shares that leave each term alone undecided."""
    rnd = random.Random(4)
    kinds = [(1, "fool groupx")] * 4 + [(0, "fool")] * 4 + [(0, "groupx")] * 4 + [(1, "")] * 4
    rows = [(y, T.terms(" ".join([words, *(f"noise{rnd.randrange(60)}" for _ in range(6))]))) for y, words in kinds * 60]
    rnd.shuffle(rows)
    learned = T.fit(rows[200:])
    additive = T.ToxicityModel(learned.grams, learned.bias, learned.weights, np.zeros_like(learned.factors))
    y = np.array([label for label, _ in rows[:200]])
    right = lambda m: ((T._scores(m, [r for _, r in rows[:200]]) >= 0) == (y == 1)).mean()
    assert right(learned) > 0.95 > 0.8 > right(additive)


def test_score_equals_the_sum_over_pairs():
    rnd = np.random.default_rng(1)
    model = T.ToxicityModel(np.sort(rnd.choice(1 << T.SPACE_BITS, 50, False)), -0.3, rnd.normal(size=50), rnd.normal(size=(50, 3)))
    rows = [np.sort(rnd.choice(model.grams, n, False)).astype(np.int32) for n in (0, 1, 2, 17)] + [np.array([3], np.int32)]
    for row, got in zip(rows, T._scores(model, rows)):
        at = [int(i) for i in np.flatnonzero(np.isin(model.grams, row))]
        want = model.bias + sum(model.weights[i] for i in at) + sum(
            model.factors[i] @ model.factors[j] for i, j in itertools.combinations(at, 2))
        assert abs(got - want) < 1e-9


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0, "", "")] * 30 + [(5, 0, 0, "", ""), (5, 1, 1, "", ""), (6, None, 0, "", ""),
                                                              (None, 1, 0, "", ""), (7, 0, 0, "", ""), (99, 1, 0, "", "")], LABELS)
    none = labels.where("false")
    for marks in (labels, none):
        got = T.toxicity(edge_docs(spark), marks).collect()
        assert len(got) == edge_docs(spark).count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == 0 for r in got)
    assert T.labelled_sample(edge_docs(spark).select("doc_id", "text"), labels.select("doc_id", "toxic")).count() <= 4
    assert T.toxicity(empty_docs(spark), labels).collect() == []
