"""Language-model scoring by masked pseudo-likelihood (operator 2).

A small network predicts every token from its neighbours on both sides: each
place of the window has an embedding table, their sum goes through tanh, and
two softmaxes over the hidden state give the token.  The most frequent words
are classes of their own; any other word has a class by its ending, length and
kind, and a part of it by its beginning: ``p(word) = p(class | both sides) *
p(part | class, both sides) * p(word | part)``, the last by the true counts of
all documents.  As a neighbour, each of the ``OWN`` most frequent words has an
embedding of its own, and any other word that of its class, part and hash.
The sum of the tokens' conditional log-probabilities scores a document.

The vocabulary is every word of all documents with its true count, so it
grows with the input.  The counts of a bounded number of frequent words go
with the tasks; those of all other words stay a table and are joined to the
words that the tasks could not look up.  Texts are cut into words and looked
up once; training and scoring read the places of the words.  The network is
trained in numpy on the executors, in one pass over all documents.  Texts are dealt by a hash to
training streams, whose number follows from the tokens and not from the
cluster, and are ordered inside a stream; a stream goes over its texts from
the round's weights, and Spark averages the streams' weights in several
levels, weighted by tokens.  So the scores do not depend on how the input is cut.
What is counted, trained on and averaged grows with the input.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadlens.llm.common import drop_written, map_batches, process_cache, written

#: Words with a class of their own, classes of the others, parts of a class.
WORDS, SHAPES, PARTS = 64, 64, 64
#: Words with an embedding of their own, embeddings of a part, places on each side, hidden units.
OWN, FINE, SIDE, HIDDEN = 4096, 2, 2, 16
#: Rounds of averaging, each over its share of all documents; tokens a step; rate.
ROUNDS, BATCH, RATE = 2, 2048, 1.5
#: Tokens of a training stream on average, and streams of a task where there are many.
STREAM_TOKENS, TASK_STREAMS = 750_000, 20
#: Rows of an embedding's step that are added one after the other.
LEVELS = 8
#: Letters of the texts that a stream reads before it takes its steps, and weights of a stored row.
LETTERS, WEIGHTS_ROW = 250_000, 16_384
#: Different words that a task counts before it hands them on.
HELD_WORDS = 400_000
#: Words whose counts go with the tasks (93% of all occurrences at 0.1 GB).
KNOWN_WORDS = 300_000
CLASSES, LEAVES = WORDS + SHAPES, SHAPES * PARTS
EDGE = LEAVES * FINE  # the place beyond both ends of a text
ROWS = EDGE + 1 + OWN  # embeddings of a window place


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          ["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update((text or "").lower().split())
            if len(held) > HELD_WORDS:
                yield out()
                held.clear()
    yield out()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` over all documents; counted per task first."""
    return (docs.select(F.col(text).alias("text")).mapInArrow(_count, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _shape(word: str) -> int:
    """A word's class among those by shape: ending and length of a plain word,
    of a word with a mark behind it, of one with digits, and of any other."""
    n, last = len(word), ord(word[-1])
    if word.isalpha():
        return (0 if n < 4 else 8 if n < 7 else 16 if n < 10 else 24) + last % 8
    if word[:-1].isalpha():
        return 32 + (0 if n < 6 else 8) + last % 8
    return (48 if any(map(str.isdigit, word)) else 56) + (0 if n < 6 else 4) + last % 4


def _leaf(word: str) -> int:
    """A word's class by shape, and its part of it by the first two letters."""
    return _shape(word) * PARTS + crc32(word[:2].encode()) % PARTS


def _fine(word: str) -> int:
    return _leaf(word) * FINE + (crc32(word.encode()) >> 7) % FINE


class Vocabulary(tuple):
    """The most frequent words in rank order: the first ``WORDS`` are classes
    of their own, the first ``OWN`` have embeddings of their own.

    ``counts``: how often they occur; ``known`` and ``known_counts``: further
    words, joined by blanks, and theirs; ``totals``: occurrences per leaf of
    all words without a class of their own; ``rest``: the ``(word, n)`` table
    of the words that are none of these and occur more than once, or None where
    there are none; ``tokens``: occurrences of all words."""
    counts, known, known_counts, totals, rest, tokens = np.zeros(0), "", np.zeros(0), np.zeros(LEAVES), None, 0

    @classmethod
    def of(cls, top, counts, known, known_counts, totals, rest):
        self = cls(top)
        self.counts, self.known, self.known_counts, self.totals, self.rest = counts, known, known_counts, totals, rest
        self.tokens = int(totals.sum() + counts[:WORDS].sum())
        return self


@dataclass(frozen=True)
class MaskedModel:
    """``words``: the vocabulary; ``weights``: the flat parameters."""
    words: Vocabulary
    weights: np.ndarray


class Tokens(NamedTuple):
    """Per place of joined texts: the embedding, the class (-1 for an edge) and
    the part of the class (-1 where the class is the word)."""
    rows: np.ndarray
    classes: np.ndarray
    parts: np.ndarray


class _Places(dict):
    """Word -> its place in ``rows``, ``classes``, ``parts`` and ``logs`` (the
    log share of its leaf; a word that was never counted has that of one that
    occurs once).  Words that it has not are noted in ``others`` and have the
    place of their leaf and hash; these places and the edge come first."""

    def __init__(self, vocab: Vocabulary):
        names = [*vocab, *vocab.known.split()]
        counts = np.concatenate([vocab.counts, vocab.known_counts])
        fine = np.concatenate([np.arange(EDGE + 1), np.fromiter(map(_fine, names), np.int64, len(names))])
        leaf, first = fine // FINE, EDGE + 1
        self.rows = fine.astype(np.uint16)
        own = min(OWN, len(vocab))
        self.rows[first:first + own] = np.arange(own) + EDGE + 1
        self.classes = (WORDS + leaf // PARTS).astype(np.int32)
        self.parts = (leaf % PARTS).astype(np.int32)
        self.logs = -np.log(np.append(vocab.totals, 0.0) + 1.0)[leaf]
        self.logs[first:] += np.log(counts)
        alone = min(WORDS, len(vocab))
        self.classes[first:first + alone], self.parts[first:first + alone] = np.arange(alone), -1
        self.classes[EDGE] = self.parts[EDGE] = -1
        self.logs[EDGE] = self.logs[first:first + alone] = 0.0
        super().__init__(zip(names, range(first, first + len(names))))
        self.others: list[str] = []

    def __missing__(self, word):
        self.others.append(word)
        return _fine(word)

    def noted(self) -> list[str]:
        out, self.others = self.others, []
        return out

    def tokens(self, places: np.ndarray) -> Tokens:
        return Tokens(self.rows.take(places), self.classes.take(places), self.parts.take(places))


def _place_ids(text: str, known: _Places) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(known.__getitem__, words), np.int32, len(words))


def _low(n: int) -> int:
    """The least count of the stretch that ``n`` is in (eight to an octave)."""
    s = max(0, n.bit_length() - 4)
    return n >> s << s


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences per leaf, and words per stretch of counts (as ``-low``)."""
    sums = Counter()
    for batch in batches:
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[_leaf(word)] += n
            sums[-_low(n)] += 1
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], ["at", "n"])


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The vocabulary of a ``(word, n)`` table; at most ``OWN`` and
    ``KNOWN_WORDS`` words and a few thousand sums are collected."""
    top = [(r["word"], r["n"]) for r in counted.orderBy(F.desc("n"), "word").limit(max(OWN, WORDS)).collect()]
    sums = (counted.select("word", "n").mapInArrow(_sums, "at bigint, n bigint")
            .groupBy("at").agg(F.sum("n").alias("n")).collect())
    totals = np.zeros(LEAVES)
    number = {-r["at"]: r["n"] for r in sums if r["at"] < 0}
    for r in sums:
        if r["at"] >= 0:
            totals[r["at"]] = r["n"]
    for word, n in top[:WORDS]:
        totals[_leaf(word)] -= n
    # a word that occurs once has the share of an unseen one and need not be known
    least, held = 1 + max(number, default=1), 0
    for low in sorted(number, reverse=True):
        held += number[low]
        if low < 2 or held > KNOWN_WORDS:
            break
        least = low
    first = {w for w, _ in top}
    frequent = counted.where(F.col("n") >= least).select("word", "n").toArrow().to_pydict()
    # by frequency: what is looked up often lies side by side in a task's memory
    keep = sorted(((w, n) for w, n in zip(frequent["word"], frequent["n"]) if w not in first), key=lambda x: (-x[1], x[0]))
    # the most frequent words are all words down to the last of them, in the order of the words
    last, last_n = top[-1] if top else ("", 0)
    behind = (F.col("n") < last_n) | ((F.col("n") == last_n) & (F.col("word") > last))
    rest = counted.where((F.col("n") >= 2) & (F.col("n") < least) & behind) if any(2 <= low < least for low in number) else None
    return Vocabulary.of([w for w, _ in top], np.array([n for _, n in top], float), " ".join(w for w, _ in keep),
                         np.array([n for _, n in keep], float), totals, rest)


def _sizes() -> list[tuple[int, ...]]:
    """Embeddings of each window place; vectors and biases of the classes;
    vectors of the parts, and their biases in each class."""
    return [(2 * SIDE, ROWS, HIDDEN), (HIDDEN, CLASSES), (CLASSES,), (HIDDEN, PARTS), (SHAPES, PARTS)]


def unflatten(flat: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for shape in _sizes():
        n = int(np.prod(shape))
        out.append(flat[at:at + n].reshape(shape))
        at += n
    return out


def start_weights(vocab: Vocabulary) -> np.ndarray:
    """Small vectors, and log frequencies as biases."""
    rng = np.random.default_rng(3)
    small = [(rng.standard_normal(int(np.prod(s))) * 0.1) for s in _sizes()]
    leaves = vocab.totals.reshape(SHAPES, PARTS) + 1.0
    classes = np.concatenate([np.ones(WORDS), leaves.sum(1)])
    alone = vocab.counts[:WORDS]
    classes[:len(alone)] += alone
    small[2] = np.log(classes / classes.sum())
    small[4] = np.log(leaves / leaves.sum(1)[:, None]).ravel()
    return np.concatenate(small).astype(np.float32)


def _near(rows: np.ndarray, here: np.ndarray) -> list[np.ndarray]:
    """The embeddings of the neighbours of the places ``here``, by distance."""
    return [rows.take(here + p) for p in range(-SIDE, SIDE + 1) if p]


def _hidden(near: list[np.ndarray], emb: np.ndarray) -> np.ndarray:
    h = emb[0].take(near[0], 0)
    for e, c in zip(emb[1:], near[1:]):
        h += e.take(c, 0)
    return np.tanh(h, out=h)


def _exp_logits(z: np.ndarray, own: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """exp of the logits less a shift per row, and the logits of ``own`` less
    the same shift; logits within ``bound`` of 0 need none above 60."""
    if bound > 60:
        z -= z.max(1)[:, None]
    picked = z[np.arange(len(z)), own]
    return np.exp(z, out=z), picked


def _row_sums(z: np.ndarray) -> np.ndarray:
    return z @ np.ones(z.shape[1], z.dtype)


def _bounds(weights: list[np.ndarray]) -> tuple[float, float]:
    """No logit of the classes and of the parts is further from 0 (the hidden
    state lies within -1 and 1)."""
    _, out, bias, part, shift = weights
    return float((np.abs(out).sum(0) + np.abs(bias)).max()), float(np.abs(part).sum(0).max() + np.abs(shift).max())


class _Room:
    """Arrays for ``n`` tokens at a time, made once: the hidden state and a 1
    behind it, the logits of the classes, and those of the parts."""

    def __init__(self, n: int, kind: np.dtype):
        self.hidden = np.ones((n, HIDDEN + 1), kind)
        self.classes, self.parts = np.empty((n, CLASSES), kind), np.empty((n, PARTS), kind)


class _Step(NamedTuple):
    """The network over some tokens in the order of their classes: their places
    (in ``near`` their neighbours'), where those with a part begin, the parts,
    and of classes and parts the exps of the logits, the own logits, and the
    sums of the exps (see ``_exp_logits``)."""
    here: np.ndarray
    classes: np.ndarray
    near: list[np.ndarray]
    hidden: np.ndarray
    first: int
    parts: np.ndarray
    z: np.ndarray
    own: np.ndarray
    z_sums: np.ndarray
    y: np.ndarray
    inner: np.ndarray
    y_sums: np.ndarray


def _step(tokens: Tokens, here: np.ndarray, weights: list[np.ndarray], bounds: tuple[float, float], room: _Room) -> _Step:
    emb, out, bias, part, shift = weights
    cls = tokens.classes.take(here)
    order = np.argsort(cls.astype(np.uint16), kind="stable")
    here, cls = here.take(order), cls.take(order)
    first = int(np.searchsorted(cls, WORDS))
    near, h = _near(tokens.rows, here), room.hidden[:len(here)]
    h[:, :HIDDEN] = _hidden(near, emb)
    z, own = _exp_logits(np.matmul(h, np.vstack((out, bias)), out=room.classes[:len(here)]), cls, bounds[0])
    y, sub = np.matmul(h[first:, :HIDDEN], part, out=room.parts[:len(here) - first]), tokens.parts.take(here[first:])
    y += shift.take(cls[first:] - WORDS, 0)
    if len(y):
        y, inner = _exp_logits(y, sub, bounds[1])
    else:
        inner = np.empty(0, y.dtype)
    return _Step(here, cls, near, h, first, sub, z, own, _row_sums(z), y, inner, _row_sums(y))


def log_probs(tokens: Tokens, weights: list[np.ndarray], chunk: int = 2048) -> np.ndarray:
    """Log-probability of every token's class and part given both sides, by
    place; 0 at the edges.  Texts have ``SIDE`` edges before and behind."""
    got = np.zeros(len(tokens.rows), np.float32)
    words = np.flatnonzero(tokens.classes >= 0)
    bounds, room = _bounds(weights), _Room(min(chunk, len(words)), weights[1].dtype)
    for at in range(0, len(words), chunk):
        s = _step(tokens, words[at:at + chunk], weights, bounds, room)
        total = s.own - np.log(s.z_sums)
        total[s.first:] += s.inner - np.log(s.y_sums)
        got[s.here] = total
    return got


def _group_sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, most frequent first, and the sums and numbers of
    their rows of ``values`` (which start again where there are more keys than
    rows).  Most keys come once or a few times: the first rows of all are added
    one after the other, and what is left of the frequent ones at once."""
    order = np.argsort(keys, kind="stable")
    keys = keys.take(order)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    n = np.diff(np.append(starts, len(keys)))
    by = np.argsort(-np.minimum(n, LEVELS + 1).astype(np.int16), kind="stable")
    starts, n = starts.take(by), n.take(by)
    sums = values.take(order.take(starts), 0, mode="wrap")
    for j in range(1, LEVELS):
        more = int(np.count_nonzero(n > j))
        sums[:more] += values.take(order.take(starts[:more] + j), 0, mode="wrap")
    more = int(np.count_nonzero(n > LEVELS))
    if more:
        left = n[:more] - LEVELS
        begin = np.cumsum(left) - left
        at = np.arange(left.sum()) + np.repeat(starts[:more] + LEVELS - begin, left)
        sums[:more] += np.add.reduceat(values.take(order.take(at), 0, mode="wrap"), begin, 0)
    return keys.take(starts), sums, n


def gradients(tokens: Tokens, here: np.ndarray, weights: list[np.ndarray], bounds: tuple[float, float] = (np.inf, np.inf),
              room: _Room | None = None) -> tuple:
    """Slopes of the mean negative log-probability of the tokens ``here``:
    ``(near, back, out, bias, part, shift classes, shift)``, where ``back`` is
    that of every token's summed embeddings; both in the order of classes."""
    emb, out, bias, part, shift = weights
    s = _step(tokens, here, weights, bounds, room or _Room(len(here), out.dtype))
    # the sums stand in for the 1 of the own class: what is narrow is divided by them
    s.z[np.arange(len(here)), s.classes] -= s.z_sums
    share = (1 / (s.z_sums * len(here)))[:, None]
    back, d_out = s.z @ out.T, (s.hidden * share).T @ s.z
    back *= share
    d_part, shapes, d_shift = None, None, None
    if s.first < len(here):
        y, shape, inside = s.y, s.classes[s.first:] - WORDS, s.hidden[s.first:, :HIDDEN]
        y[np.arange(len(y)), s.parts] -= s.y_sums
        share = 1 / (s.y_sums * len(here))
        back[s.first:] += (y @ part.T) * share[:, None]
        d_part = (inside * share[:, None]).T @ y
        starts = np.flatnonzero(np.append(True, shape[1:] != shape[:-1]))
        shapes, ends = shape.take(starts), np.append(starts[1:], len(y))
        d_shift = np.empty((len(starts), PARTS), y.dtype)
        for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            np.dot(share[a:b], y[a:b], out=d_shift[i])
    h = s.hidden[:, :HIDDEN]
    back *= 1 - h * h
    return s.near, back, d_out[:HIDDEN], d_out[HIDDEN], d_part, shapes, d_shift


def train_pass(tokens: Tokens, flat: np.ndarray, rate: float = RATE, batch: int = BATCH) -> None:
    """One pass of gradient steps over joined texts, in place.  An embedding's
    step is divided by the root of its share of the batch, so that those of
    rare words move too."""
    weights = unflatten(flat)
    emb, out, bias, part, shift = weights
    every = emb.reshape(-1, HIDDEN)  # a view: the embeddings of all window places under numbers of their own
    words = np.flatnonzero(tokens.classes >= 0)
    room = _Room(min(batch, len(words)), flat.dtype)
    for at in np.random.default_rng(5).permutation(np.arange(0, len(words), batch)):
        here = words[at:at + batch]
        near, back, d_out, d_bias, d_part, shapes, d_shift = gradients(tokens, here, weights, _bounds(weights), room)
        out -= rate * d_out
        bias -= rate * d_bias
        if d_part is not None:
            part -= rate * d_part
            shift[shapes] -= rate * d_shift
        rows, step, n = _group_sums(np.concatenate([c + np.uint16(i * ROWS) for i, c in enumerate(near)]), back)
        step *= (rate * np.sqrt(len(here) / n)).astype(step.dtype)[:, None]
        every[rows] = every.take(rows, 0) - step
    np.clip(flat, -12, 12, out=flat)


def _between(each: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """Edge-padded places of several texts, edges between them, and their lengths."""
    edge = np.full(SIDE, EDGE, np.int32)
    return np.concatenate([edge] + [x for ids in each for x in (ids, edge)]), [len(ids) for ids in each]


def _joined(texts: list[str], known: _Places) -> tuple[np.ndarray, list[int]]:
    return _between([_place_ids(t, known) for t in texts])


def placed(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``docs`` with ``(letters, places, others)`` for ``text``: the length
    (null for a null text), the places of all its words as 32-bit numbers, and,
    where the vocabulary has a ``rest``, the words that the tasks could not look
    up.  Texts are cut and looked up here alone; training and scoring read this."""
    places, open_words = _places(vocab), vocab.rest is not None
    src = docs.select(*(c for c in docs.columns if c != "text"), "text")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]

    def run(batch: pa.RecordBatch):
        known, ids, others = places(), [], []
        texts = batch.column(len(kept)).to_pylist()
        known.noted()
        for text in texts:
            ids.append(_place_ids(text or "", known).tobytes())
            noted = known.noted()
            others.append(noted if open_words else [])
        return *batch.columns[:-1], [None if t is None else len(t) for t in texts], ids, others

    return map_batches(src, run, ", ".join([*kept, "letters bigint", "places binary", "others array<string>"]), 256)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("key", F.xxhash64("text", F.col("doc_id").cast("string")))


def train(docs: DataFrame, every: int = 1, rounds: int = ROUNDS) -> MaskedModel:
    """The model of ``(doc_id, text)`` rows: counts over all of them, and one
    pass of training over all of them, null ids too.  With ``every`` above 1,
    only those with ``crc32(doc_id) mod every = 0`` train (all, where none of
    them has words), so that tests can hold documents out.  The same rows give
    the same model whatever their order and partitions (up to the rounding of
    sums); rows with equal id and text are in one stream."""
    counted = written(word_counts(docs), "words")
    vocab = vocabulary(counted)
    share = docs.where(F.col("text").isNotNull())
    if every > 1:
        held = share.where(F.crc32(F.col("doc_id").cast("string")) % every == 0)
        if held.where(F.col("text").rlike(r"\S")).limit(1).count():
            share = held
    return _fit(_keyed(share).select("text", "key"), vocab, rounds)


def _fit(keyed: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> MaskedModel:
    """One pass of training over the rows, which hold a ``text`` or are ``placed``."""
    streams = max(1, math.ceil(vocab.tokens / rounds / STREAM_TOKENS))
    keyed = keyed.withColumn("stream", F.pmod(F.shiftright("key", 8), F.lit(streams)))
    model = MaskedModel(vocab, start_weights(vocab))
    for r in range(rounds):
        turn = keyed.where(F.pmod("key", F.lit(rounds)) == r)
        model = MaskedModel(vocab, _round(turn, streams, model, RATE / (1 + r)))
    return model


def _places(vocab: Vocabulary) -> Callable[[], _Places]:
    """What a task needs to look words up, without the table of the rest."""
    mine = Vocabulary.of(vocab, vocab.counts, vocab.known, vocab.known_counts, vocab.totals, None)
    parts = tuple(vocab), mine.counts, mine.known, mine.known_counts, mine.totals
    key = "masked", parts[0], parts[2], *(parts[i].tobytes() for i in (1, 3, 4))
    return lambda: process_cache(key, lambda: _Places(Vocabulary.of(*parts, None)))


def _stream_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], bool]]:
    """``(stream, places of texts, whether the stream ends)``: stretches of a
    stream of about ``LETTERS`` letters, the same however the rows are cut into
    batches."""
    stream, texts, letters = None, [], 0
    for batch in batches:
        for places, n, of in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if stream is not None and of != stream:
                yield stream, texts, True
                texts, letters = [], 0
            elif letters >= LETTERS:
                yield stream, texts, False
                texts, letters = [], 0
            stream = of
            texts.append(np.frombuffer(places, np.int32))
            letters += n
    if stream is not None:
        yield stream, texts, True


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of ``(at, seen, weights)`` rows with equal ``at``."""
    seen, sums = Counter(), {}
    for batch in batches:
        for at, n, w in zip(*(c.to_pylist() for c in batch.columns)):
            seen[at] += n
            sums[at] = sums.get(at, 0.0) + np.frombuffer(w, np.float64)
    yield _weight_rows((at, seen[at], sums[at]) for at in sums)


WEIGHT_ROWS = "at bigint, seen bigint, weights binary"


def _weight_rows(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2].tobytes() for r in rows], pa.binary())], ["at", "seen", "weights"])


def _round(turn: DataFrame, streams: int, model: MaskedModel, rate: float) -> np.ndarray:
    """The mean of the streams' weights by tokens; the model's own where there
    are no tokens.  Every task adds up the streams it trains, and the tasks'
    sums meet in about the root of their number of tasks and then once more."""
    flat, places = model.weights, _places(model.words)
    start = flat.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, weight = places(), 0, np.zeros(len(start) // 4)
        own, seen = np.frombuffer(start, np.float32).copy(), 0
        for _, texts, ends in _stream_texts(batches):
            tokens = known.tokens(_between(texts)[0])
            seen += int((tokens.classes >= 0).sum())
            train_pass(tokens, own, rate)
            if ends:
                total, weight = total + seen, weight + own.astype(np.float64) * seen
                own, seen = np.frombuffer(start, np.float32).copy(), 0
        if total:
            yield _weight_rows((at, total, weight[at:at + WEIGHTS_ROW]) for at in range(0, len(weight), WEIGHTS_ROW))

    spread = int(turn.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(streams, max(spread, math.ceil(streams / TASK_STREAMS)))
    read = turn if "places" in turn.columns else placed(turn, model.words)
    dealt = (read.select("places", "letters", "stream", "key").repartitionById(tasks, F.pmod("stream", F.lit(tasks)).cast("int"))
             .sortWithinPartitions("stream", "key", "places"))
    trained = written(dealt.mapInArrow(run, WEIGHT_ROWS).withColumn("task", F.spark_partition_id()), "weights")
    some = math.isqrt(tasks) + 1
    sums = written(trained.repartition(tasks, F.pmod("task", F.lit(some)), "at").drop("task").mapInArrow(_added, WEIGHT_ROWS), "sums")
    mean = sums.repartition(some, "at").mapInArrow(_added, WEIGHT_ROWS).orderBy("at").collect()
    drop_written(trained)
    drop_written(sums)
    return np.concatenate([np.frombuffer(r["weights"], np.float64) / r["seen"] for r in mean]).astype(np.float32) if mean else flat


def score(docs: DataFrame, model: MaskedModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_tokens, log_prob,
    mean_log_prob)``: the sum over all tokens of a text's conditional
    log-probabilities, and its mean.  A word that the vocabulary has not is
    scored like one that it has seen once.  A null, empty or blank text has no
    tokens, sum 0 and mean null.  Whole texts are scored; ids may be null or
    repeated, other columns are ignored, an empty table gives an empty
    result."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    read = placed(src, model.words)
    return _scored(read if model.words.rest is None else written(read, "placed"), model)


def _scored(read: DataFrame, model: MaskedModel) -> DataFrame:
    """``score`` of ``placed`` rows with a ``row`` number; a table where the vocabulary has a ``rest``."""
    flat, places, rest = model.weights, _places(model.words), model.words.rest

    def run(batch: pa.RecordBatch):
        known, weights = places(), unflatten(flat)
        texts = [np.frombuffer(p, np.int32) for p in batch.column(2).to_pylist()]
        n, total = [], []
        for at in range(0, len(texts), 32):
            ids, lengths = _between(texts[at:at + 32])
            got = log_probs(known.tokens(ids), weights).astype(np.float64)
            got += known.logs.take(ids)
            ends = np.cumsum([SIDE] + [m + SIDE for m in lengths])
            total += np.add.reduceat(got, ends[:-1]).tolist()  # edges count 0
            n += lengths
        total = [s if m else 0.0 for s, m in zip(total, n)]
        return batch.column(0), batch.column(1), n, total, [s / m if m else None for s, m in zip(total, n)]

    kind = read.schema["doc_id"].dataType.simpleString()
    rows = map_batches(read.select("doc_id", "row", "places"), run,
                       f"doc_id {kind}, row bigint, n_tokens bigint, log_prob double, mean_log_prob double", 256)
    if rest is None:
        return rows.drop("row")
    rows = written(rows, "scored")
    # a word that occurs n times has n times the share of one that occurs once
    more = (read.select("row", F.explode("others").alias("word")).join(rest, "word")
            .groupBy("row").agg(F.sum(F.log("n")).alias("more")))
    total = F.col("log_prob") + F.coalesce("more", F.lit(0.0))
    return rows.join(more, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_prob"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob"))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Trains on ``docs`` and scores all of them, from one table of their places."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    vocab = vocabulary(written(word_counts(src), "words"))
    read = written(placed(_keyed(src).withColumn("row", F.monotonically_increasing_id()), vocab), "placed")
    return _scored(read, _fit(read.where("letters is not null"), vocab))
