"""Language identification with string kernels (operator 1).

The kernel of two texts is the number of character n-grams (1 to 3 letters
long, "blended spectrum") that both contain, divided by the geometric mean of
their own numbers.  A bounded labelled sample gives Nystroem landmarks and
one ridge regression per language in the landmarks' feature space.  Presence
vectors enter the kernel linearly, so landmarks, whitening and ridge weights
fold into one (n-gram x language) matrix and a batch of documents is scored
by one matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.llm.common import map_batches, process_cache

#: n-gram lengths, hashed n-gram space, labelled rows and landmarks per language, ridge.
LENGTHS, SPACE_BITS = (1, 2, 3), 20
SAMPLE_PER_LANG, LANDMARKS_PER_LANG, RIDGE = 400, 48, 1e-2
#: Text is read in chunks of this many code points (n-grams across the cut included).
CHUNK = 1 << 20
UNKNOWN = "und"


def _letter_table() -> np.ndarray:
    """1 for code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def ngrams(text: str, scratch: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The distinct hashed n-grams of a text (lower case; every run of other
    characters is one blank); empty without a letter.  ``scratch`` is an
    int32 array over the n-gram space."""
    seen = np.empty(0, np.uint32)
    for at in range(0, max(len(text), 1), CHUNK):
        c = _codes(text[max(0, at - 2 * max(LENGTHS)):at + CHUNK].lower())
        is_letter = letters[np.minimum(c, 0x10FFFF)]
        if not is_letter.any():
            continue
        c = np.where(is_letter, c, 32).astype(np.uint32)
        c = np.concatenate(([np.uint32(32)], c, [np.uint32(32)]))
        c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
        h, found = np.zeros(len(c), np.uint32), [seen]
        for n in LENGTHS:
            if len(c) >= n:
                h = (h[: len(c) - n + 1] * np.uint32(0x9E3779B1)) + c[n - 1:] * np.uint32(0x85EBCA77) + np.uint32(n)
                m = h ^ (h >> np.uint32(15))
                found.append((m * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - SPACE_BITS))
        x = np.concatenate(found)
        order = np.arange(len(x), dtype=np.int32)
        scratch[x] = order  # the last writer of each n-gram keeps it
        seen = x[scratch[x] == order]
    return seen


def _tools():
    return process_cache("ngram letters", lambda: (np.zeros(1 << SPACE_BITS, np.int32), _letter_table()))


def presence(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, grams)`` of ``(doc_id, lang, text)``: distinct hashed n-grams."""
    def run(batch: pa.RecordBatch):
        return batch.column(0), batch.column(1), [ngrams(t or "", *_tools()).astype(np.int32)
                                                  for t in batch.column(2).to_pylist()]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, run, f"doc_id {kind}, lang string, grams array<int>")


@dataclass(frozen=True)
class LanguageModel:
    """``rows``: n-gram -> row of ``weights`` (0: no landmark has it)."""
    langs: tuple[str, ...]
    grams: np.ndarray
    weights: np.ndarray


def fit(sample: list[tuple[str, np.ndarray]], landmarks_per_lang: int = LANDMARKS_PER_LANG,
        ridge: float = RIDGE) -> LanguageModel:
    """Nystroem landmarks (the first of each language) and one-versus-rest
    kernel ridge regression on ``(lang, distinct n-grams)`` rows."""
    sample = [(lang, g) for lang, g in sample if len(g)]
    langs = tuple(sorted({lang for lang, _ in sample}))
    if not langs:
        return LanguageModel((), np.empty(0, np.int32), np.zeros((1, 0), np.float32))
    seen: dict[str, int] = {}
    marks = []
    for i, (lang, _) in enumerate(sample):
        if seen.setdefault(lang, 0) < landmarks_per_lang:
            seen[lang] += 1
            marks.append(i)
    grams = np.unique(np.concatenate([sample[i][1] for i in marks]))

    def rows(items):
        x = np.zeros((len(items), len(grams)), np.float32)
        for r, g in enumerate(items):
            at = np.searchsorted(grams, g)
            at[at == len(grams)] = 0
            x[r, at[grams[at] == g]] = 1
        return x

    norm = np.sqrt(np.array([len(g) for _, g in sample], np.float64))
    land = rows([sample[i][1] for i in marks])                                # landmarks x n-grams
    kmm = (land @ land.T).astype(np.float64) / np.outer(norm[marks], norm[marks])
    values, vectors = np.linalg.eigh(kmm)
    good = values > 1e-8 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])                         # landmarks x features
    knm = np.concatenate([rows([g for _, g in sample[i:i + 256]]) @ land.T for i in range(0, len(sample), 256)])
    phi = (knm / np.outer(norm, norm[marks])) @ whiten
    y = np.array([[1.0 if lang == one else -1.0 for one in langs] for lang, _ in sample])
    share = np.array([1.0 / sum(s == lang for s, _ in sample) for lang, _ in sample])[:, None]  # languages weigh alike
    coef = np.linalg.solve(phi.T @ (phi * share) + ridge * len(langs) * np.eye(phi.shape[1]) / len(phi),
                           phi.T @ (y * share))
    weights = land.T.astype(np.float64) @ ((whiten @ coef) / norm[marks][:, None])  # n-grams x languages
    return LanguageModel(langs, grams.astype(np.int32),
                         np.concatenate([np.zeros((1, len(langs))), weights]).astype(np.float32))


def labelled_sample(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """``(doc_id, lang, text)`` of at most ``per_lang`` labelled, not held-out
    documents of each language, the first by a hash of the id (of a repeated
    id the smallest text).  Ids alone are ranked; texts are read for the
    chosen ones, a set bounded by ``per_lang`` rows a language."""
    known = docs.where(F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id")) & F.col("text").isNotNull()
                       & F.col("doc_id").isNotNull())
    ids = known.select("doc_id", "lang").distinct()
    counts = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # the share of a language's ids that the hash lets through is near the bound already
    near = ids.join(counts, "lang").where(place * F.col("_n") < 2 * per_lang + 20).select("doc_id", "lang", place.alias("_place"))
    first = Window.partitionBy("lang").orderBy("_place", "doc_id")
    chosen = near.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= per_lang).select("doc_id", "lang")
    return known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> LanguageModel:
    """The model of ``(doc_id, lang, text)`` rows.  The sample holds at most
    ``per_lang`` documents a language (documented bound); their n-grams are
    taken on the executors from whole texts."""
    found = presence(labelled_sample(docs, per_lang)).collect()
    found = sorted(((r["lang"], np.array(r["grams"], np.int64), str(r["doc_id"])) for r in found),
                   key=lambda x: (x[2][::-1], x[0], len(x[1])))
    return fit([(lang, grams) for lang, grams, _ in found])


def predict(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, lang_pred, score)``; only the
    text is looked at.  A null text, one without a letter, or an untrained
    model gives ``und`` with score 0.  Ties go to the first language by name.
    Texts of any length are read whole; ids may be null or repeated, other
    columns are ignored, an empty table gives an empty result."""
    langs, weights, grams = model.langs, model.weights, model.grams

    def lookup():
        table = np.zeros(1 << SPACE_BITS, np.int32)
        table[grams] = np.arange(1, len(grams) + 1)
        return table

    def run(batch: pa.RecordBatch):
        names, scores = [], []
        texts = batch.column(1).to_pylist()
        table = lookup()
        for at in range(0, len(texts), 64):
            some = [ngrams(t or "", *_tools()) for t in texts[at:at + 64]]
            x = np.zeros((len(some), len(weights)), np.float32)
            for i, g in enumerate(some):
                x[i, table[g]] = 1
            x[:, 0] = 0
            f = (x @ weights) / np.sqrt(np.maximum([[len(g)] for g in some], 1))
            for g, row in zip(some, f):
                if not len(g) or not langs:
                    names.append(UNKNOWN), scores.append(0.0)
                else:
                    best = int(np.argmax(row))
                    e = np.exp(4.0 * (row.astype(np.float64) - row[best]))
                    names.append(langs[best]), scores.append(float(e[best] / e.sum()))
        return batch.column(0), names, scores

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, lang_pred string, score double", 1024)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Trains on the rows that are not held out and predicts all rows:
    ``(doc_id, held_out, lang_pred, score)``."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    out = predict(src, train(src))
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
