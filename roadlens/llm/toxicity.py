"""Toxicity scores by a factorization machine over hashed terms (operator 12).

A text is the set of its words and of the first letters of its longer words,
hashed.  Its score is the logistic value of a bias, one weight for every term
and the inner products of the factors of every two terms, so that a pair (an
insult together with the mention of a group) can weigh what neither of its
terms weighs alone.  Terms are those of the labelled sample that tell the
labels apart best; a term counts once and texts are not scaled by their length,
so a few strong terms are not thinned out in a very long text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.llm.common import map_batches
from roadlens.plans import bounded_broadcast

#: Hashed term space; letters of a word's beginning.
SPACE_BITS, PREFIX = 18, 4
#: Terms kept: at most so many that are in ``MIN_DOCS`` documents of the sample and tell the labels apart by
#: ``MIN_SURE`` standard errors, and those of the ``COMMON`` most frequent ones that do so in a pair only.
TERMS, MIN_DOCS, MIN_SURE, COMMON = 2048, 4, 3.0, 512
#: The fit reads at most so many labelled documents of each label.
SAMPLE = {1: 2000, 0: 4000}
FACTORS, STEPS, BATCH, RATE, RIDGE = 8, 2000, 64, 0.1, 1e-3
_WORD = re.compile(r"[^\W\d_]+")


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def terms(text: str) -> np.ndarray:
    """The distinct hashed terms of a text, ascending."""
    words = set(_WORD.findall(text.lower()))
    words |= {"^" + w[:PREFIX] for w in words if len(w) > PREFIX}
    found = {zlib.crc32(w.encode("utf-8", "surrogatepass")) >> (32 - SPACE_BITS) for w in words}
    return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass(frozen=True)
class ToxicityModel:
    """``grams``: the terms, ascending; ``weights`` and ``factors`` by their place."""
    grams: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _sureness(a: np.ndarray, b: np.ndarray, na: float, nb: float) -> np.ndarray:
    """By how many standard errors log odds differ that are met in ``a`` of ``na`` and ``b`` of ``nb`` documents."""
    odds = np.log((a + 0.5) / (na - a + 0.5)) - np.log((b + 0.5) / (nb - b + 0.5))
    error = np.sqrt(1 / (a + 0.5) + 1 / (na - a + 0.5) + 1 / (b + 0.5) + 1 / (nb - b + 0.5))
    return np.where(a + b >= MIN_DOCS, np.abs(odds) / error, 0.0)


def _pooled(a: np.ndarray, b: np.ndarray, na: float, nb: float) -> np.ndarray:
    """The same for the difference of the shares, also where one of them is 0."""
    p = (a + b) / (na + nb)
    return np.abs(a / na - b / nb) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / na + 1 / nb))


def _chosen(rows: list[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` terms that tell the labels apart most surely, and frequent
    terms that do so together: a pair that is surer than both of its terms."""
    sets = lambda label: np.bincount(np.concatenate([r for r, one in zip(rows, y) if one == label]),
                                     minlength=1 << SPACE_BITS).astype(float)
    a, b, na, nb = sets(1), sets(0), float((y == 1).sum()), float((y == 0).sum())
    z = _sureness(a, b, na, nb)
    sure = np.argsort(-z, kind="stable")[:most]
    common = np.sort(np.argsort(-(a + b), kind="stable")[:COMMON])
    met = np.zeros((len(rows), len(common)), np.float32)
    for i, r in enumerate(rows):
        met[i, _places(common, r)] = 1
    together = _pooled(*[(met[y == label].T @ met[y == label]).astype(float) for label in (1, 0)], na, nb)
    alone = np.maximum(np.diagonal(together)[:, None], np.diagonal(together)[None, :])
    pairs = (together >= 2 * MIN_SURE) & (together >= alone + MIN_SURE)
    return np.union1d(sure[z[sure] >= MIN_SURE], common[pairs.any(axis=1)])


def _places(grams: np.ndarray, row: np.ndarray) -> np.ndarray:
    at = np.searchsorted(grams, row)
    at[at == len(grams)] = 0
    return at[grams[at] == row] if len(grams) else at[:0]


def _scores(model: ToxicityModel, rows: list[np.ndarray]) -> np.ndarray:
    """Bias, weights and pair products of every row's known terms."""
    place = [_places(model.grams, r) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(p) for p in place])
    at = np.concatenate([np.empty(0, np.int64), *place]).astype(np.int64)
    v = model.factors[at]
    total, squares = np.zeros((len(rows), v.shape[1])), np.zeros((len(rows), v.shape[1]))
    np.add.at(total, row, v)
    np.add.at(squares, row, v * v)
    return model.bias + np.bincount(row, model.weights[at], len(rows)) + 0.5 * (total * total - squares).sum(1)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(sample: list[tuple[int, np.ndarray]], most: int = TERMS, factors: int = FACTORS, steps: int = STEPS) -> ToxicityModel:
    """About ``steps`` adaptive gradient steps over ``(label, terms)`` rows; both
    labels weigh alike.  The same rows in the same order give the same model.  Without rows
    of both labels no term is learned and the bias is far on the known side
    (towards 0 without any)."""
    y, rows = np.array([label for label, _ in sample], np.int64), [r for _, r in sample]
    if len(set(y.tolist())) < 2:
        return ToxicityModel(np.empty(0, np.int64), 5.0 if 1 in y else -5.0, np.zeros(0), np.zeros((0, factors)))
    rng = np.random.default_rng(12)
    grams = _chosen(rows, y, most)
    w, v, bias = np.zeros(len(grams)), rng.normal(0, 0.05, (len(grams), factors)), 0.0
    gw, gv, gb = np.full(len(w), 1e-8), np.full(v.shape, 1e-8), 1e-8
    share = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    place = [_places(grams, r) for r in rows]
    for _ in range(max(1, round(steps * BATCH / len(rows)))):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            some = order[i:i + BATCH]
            row = np.repeat(np.arange(len(some)), [len(place[j]) for j in some])
            at = np.concatenate([place[j] for j in some])
            held = v[at]
            total, squares = np.zeros((len(some), factors)), np.zeros((len(some), factors))
            np.add.at(total, row, held)
            np.add.at(squares, row, held * held)
            z = bias + np.bincount(row, w[at], len(some)) + 0.5 * (total * total - squares).sum(1)
            g = (_logistic(z) - y[some]) * share[some]
            used, inv = np.unique(at, return_inverse=True)
            dw = np.bincount(inv, g[row], len(used)) / len(some) + RIDGE * w[used]
            dv = np.zeros((len(used), factors))
            np.add.at(dv, inv, g[row, None] * (total[row] - held))
            dv = dv / len(some) + RIDGE * v[used]
            gw[used] += dw * dw
            w[used] -= RATE * dw / np.sqrt(gw[used])
            gv[used] += dv * dv
            v[used] -= 0.3 * RATE * dv / np.sqrt(gv[used])
            gb += g.mean() ** 2
            bias -= RATE * g.mean() / np.sqrt(gb)
    return ToxicityModel(grams, float(bias), w, v)


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: dict[int, int] = SAMPLE) -> DataFrame:
    """``(doc_id, label, text)`` of at most ``bound[label]`` labelled documents
    that are not held out, the first by a hash of the id.  An id that is
    labelled several times is toxic if any row says so; of a repeated document
    the smallest text counts.  Ids alone are ranked."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("label")))
    known = docs.where(F.col("text").isNotNull())
    marks = marks.join(known.select("doc_id"), "doc_id", "left_semi")
    place = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sizes = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    most = F.when(F.col("label") == 1, bound[1]).otherwise(bound[0])
    # the share that the hash lets through is near the bound already: no more rows are ranked at any size
    share = {k: 1.2 * bound[k] / sizes.get(k, 1) + 40 / sizes.get(k, 1) for k in bound}
    near = marks.where(place < F.when(F.col("label") == 1, share[1]).otherwise(share[0])).select("doc_id", "label", place.alias("_place"))
    first = Window.partitionBy("label").orderBy("_place", "doc_id")
    chosen = near.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= most).select("doc_id", "label")
    return (known.join(bounded_broadcast(chosen, sum(bound.values())), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")))


def train(docs: DataFrame, labels: DataFrame, bound: dict[int, int] = SAMPLE) -> ToxicityModel:
    """The model of ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.  The
    fit is bounded by ``bound``; its terms are taken from whole texts on the
    executors."""
    def run(batch: pa.RecordBatch):
        return batch.column(0), batch.column(1), [terms(t) for t in batch.column(2).to_pylist()]

    sample = labelled_sample(docs, labels, bound)
    kind = sample.schema["doc_id"].dataType.simpleString()
    found = map_batches(sample, run, f"doc_id {kind}, label int, grams array<int>").toArrow()
    ids, label, grams = found["doc_id"].to_pylist(), found["label"].to_pylist(), found["grams"].combine_chunks()
    at, values = np.asarray(grams.offsets), np.asarray(grams.values)
    order = sorted(range(len(ids)), key=lambda i: (str(ids[i])[::-1], label[i]))
    return fit([(label[i], values[at[i]:at[i + 1]]) for i in order])


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row; only the text is looked at.  A null
    text, an empty one and one without a known term have the score of the bias."""
    def run(batch: pa.RecordBatch):
        return batch.column(0), _logistic(_scores(model, [terms(t or "") for t in batch.column(1).to_pylist()]))

    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double", 256)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, held_out, score, predicted)``,
    trained on the labelled rows that are not held out.

    Ids may be null or repeated (a row without an id is scored, never learned
    from), texts null, empty or of any length, labels null, repeated or of
    ids that no document has; other columns are ignored.  An empty table
    gives no rows; without labels every score is near 0."""
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marks = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{toxic}`").alias("toxic"))
    out = score(src, train(src, marks))
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
