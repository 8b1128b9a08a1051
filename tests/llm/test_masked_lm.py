"""Masked scoring: the network's probabilities spelled out, and what it learns."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from roadlens.llm import masked_lm as lm
from tests.llm.edges import edge_docs, edge_rows, empty_docs

SF = "/root/testdata/sf0.001"
ODD = ["w1 w2 w3 w4", "w1", "", None, " \n", "unknown Words 12 w3, W4", "w5 " * 300, "a, b. c? é ß 漢字 \U0001f600 - 7x x7"]


def counted_vocabulary(texts):
    """The vocabulary of a few texts, counted by hand."""
    top = sorted(Counter(w for t in texts for w in (t or "").lower().split()).items(), key=lambda x: (-x[1], x[0]))
    totals = np.zeros(lm.LEAVES)
    for w, n in top[lm.WORDS:]:
        totals[lm._leaf(w)] += n
    own, known = top[:lm.OWN], top[lm.OWN:]
    return lm.Vocabulary.of([w for w, _ in own], np.array([n for _, n in own], float), " ".join(w for w, _ in known),
                            np.array([n for _, n in known], float), totals, None)


def some_weights():
    return (np.random.default_rng(1).standard_normal(sum(int(np.prod(s)) for s in lm._sizes())) * 0.5).astype(np.float32)


def plain_score(text, vocab, flat):
    """The sum of the words' log-probabilities, one word at a time."""
    emb, out, bias, part, shift = (x.astype(float) for x in lm.unflatten(flat))
    ranks = {w: i for i, w in enumerate(vocab)}
    counts = dict(zip([*vocab, *vocab.known.split()], [*vocab.counts, *vocab.known_counts]))
    words = (text or "").lower().split()

    def row(w):
        return lm.EDGE if w is None else lm.EDGE + 1 + ranks[w] if ranks.get(w, lm.OWN) < lm.OWN else lm._fine(w)

    total = 0.0
    padded = [None] * lm.SIDE + words + [None] * lm.SIDE
    for t, w in enumerate(words, lm.SIDE):
        near = [padded[t + d] for d in range(-lm.SIDE, lm.SIDE + 1) if d]
        h = np.tanh(sum(e[row(x)] for e, x in zip(emb, near)))
        z = h @ out + bias
        if ranks.get(w, lm.WORDS) < lm.WORDS:
            total += z[ranks[w]] - np.log(np.exp(z).sum())
            continue
        shape, at = divmod(lm._leaf(w), lm.PARTS)
        y = h @ part + shift[shape]
        total += z[lm.WORDS + shape] - np.log(np.exp(z).sum()) + y[at] - np.log(np.exp(y).sum())
        total += np.log(counts.get(w, 1)) - np.log(vocab.totals[lm._leaf(w)] + 1)
    return total


def test_scores_are_summed_conditional_log_probabilities(spark, monkeypatch):
    monkeypatch.setattr(lm, "WORDS", 3)
    monkeypatch.setattr(lm, "CLASSES", 3 + lm.SHAPES)
    model = lm.MaskedModel(counted_vocabulary(ODD), some_weights())
    docs = spark.createDataFrame(list(enumerate(ODD + ["never seen"])), "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm.score(docs, model).collect()}
    for i, t in enumerate(ODD + ["never seen"]):
        n, want = len((t or "").split()), plain_score(t, model.words, model.weights)
        assert got[i].n_tokens == n
        if n:
            assert abs(got[i].log_prob - want) < 1e-3 * max(1, abs(want))
            assert abs(got[i].mean_log_prob - got[i].log_prob / n) < 1e-9
        else:
            assert got[i].log_prob == 0 and got[i].mean_log_prob is None


def test_probabilities_of_a_place_sum_to_one():
    """Over all counted words, and one never seen in each leaf."""
    words = [f"{a}{b}{c}" for a in ("", "x", "yy,", "1") for b in "abcdefg" for c in ("", "ing", "tion", "9")]
    vocab = counted_vocabulary([" ".join(w for i, w in enumerate(words, 1) for _ in range(i % 7 + 1))])
    places, total = lm._Places(vocab), 0.0
    names = [*vocab, *vocab.known.split()]
    weights = lm.unflatten(some_weights())
    left, right = lm._place_ids("a new", places), lm._place_ids("word here", places)
    edge = np.full(lm.SIDE, lm.EDGE, np.int32)
    middles = [places[w] for w in names] + [leaf * lm.FINE for leaf in range(lm.LEAVES)]
    for at in middles:
        tokens = places.tokens(np.concatenate([edge, left, [at], right, edge]).astype(np.int32))
        total += np.exp(float(lm.log_probs(tokens, weights)[lm.SIDE + 2]) + places.logs[at])
    assert abs(total - 1) < 1e-3


def test_word_counts_cover_everything(spark, monkeypatch):
    monkeypatch.setattr(lm, "HELD_WORDS", 3)
    docs = spark.createDataFrame([(1, "a b B c"), (2, None), (3, "a  a\nd")], "doc_id bigint, text string")
    assert {r.word: r.n for r in lm.word_counts(docs).collect()} == {"a": 3, "b": 2, "c": 1, "d": 1}


def test_trained_network_tells_text_from_shuffled_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = lm.train(docs, every=2, rounds=2)
    rows = [r for r in docs.collect() if r.text]
    held = [r.text for r in rows if zlib.crc32(str(r.doc_id).encode()) % 2][:60]
    random.seed(2)
    mixed = [" ".join(random.sample(t.split(), len(t.split()))) for t in held]
    kept = spark.createDataFrame(list(enumerate(held)), "doc_id bigint, text string")
    stirred = spark.createDataFrame(list(enumerate(mixed)), "doc_id bigint, text string")
    total = lambda df, m: sum(r.log_prob for r in lm.score(df, m).collect())
    assert total(kept, model) > total(stirred, model)
    assert total(kept, model) > total(kept, lm.MaskedModel(model.words, lm.start_weights(model.words)))


def test_rare_words_of_a_class_are_not_one_word(spark, monkeypatch):
    """Words of one class by shape that change places change the score, and
    so does a word of the same leaf."""
    monkeypatch.setattr(lm, "OWN", lm.WORDS)
    vocab = counted_vocabulary([" ".join(f"w{i}" for i in range(lm.WORDS)) * 5, "gather lather", "lateral latter"])
    assert lm._shape("gather") == lm._shape("lather") and lm._leaf("gather") != lm._leaf("lather")
    other = next(w for w in (f"la{a}{b}er" for a in "tbcdfg" for b in "hklmn")
                 if lm._leaf(w) == lm._leaf("lather") and lm._fine(w) != lm._fine("lather"))
    model = lm.MaskedModel(vocab, some_weights())
    texts = ["w1 gather w2 w3 lather w4", "w1 lather w2 w3 gather w4", f"w1 {other} w2 w3 gather w4"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(r.log_prob for r in lm.score(docs, model).collect())
    assert got[1] - got[0] > 1e-3 and got[2] - got[1] > 1e-3


def test_the_model_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "LETTERS", 5_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    scores = []
    for parts in (1, 8):
        dealt = docs.repartition(parts) if parts > 1 else docs.orderBy("text").coalesce(1)
        scores.append({r.doc_id: r.log_prob for r in lm.score_documents(dealt).collect()})
    assert scores[0].keys() == scores[1].keys()
    assert all(scores[1][i] == pytest.approx(s, rel=1e-5) for i, s in scores[0].items())


def test_edges(spark):
    rows = lm.score_documents(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    assert all(r.n_tokens == 0 and r.log_prob == 0 and r.mean_log_prob is None for r in rows if r.doc_id in (2, 3, 4))
    assert lm.score_documents(empty_docs(spark)).count() == 0


def test_every_counted_word_has_its_own_probability(spark, monkeypatch):
    monkeypatch.setattr(lm, "OWN", lm.WORDS)
    frequent = [f"w{i}" for i in range(lm.WORDS)]
    texts = [" ".join(frequent * 9), "lather " * 5 + "latter " * 3 + "laster " * 2 + "laxer", "lather latter", "laster laxer", "lauder", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = {"lather": 6, "latter": 4, "laster": 3, "laxer": 2}
    assert len({lm._leaf(w) for w in ("lather", "latter", "laster", "lauder")}) == 1
    want_vocab = counted_vocabulary(texts)
    got = []
    for known in (lm.KNOWN_WORDS, lm.WORDS + 1, 0):  # all words go with the tasks, some, none
        monkeypatch.setattr(lm, "KNOWN_WORDS", known)
        vocab = lm.vocabulary(lm.word_counts(docs))
        assert (vocab.rest is None) == (known == 300_000)
        assert tuple(vocab) == tuple(want_vocab) and vocab.tokens == 9 * lm.WORDS + sum(counts.values()) + 1
        assert (vocab.totals == want_vocab.totals).all()
        model = lm.MaskedModel(vocab, some_weights())
        rows = {r.doc_id: r for r in lm.score(docs, model).collect()}
        for i, t in enumerate(texts):
            want = plain_score(t, want_vocab, model.weights)
            assert rows[i].n_tokens == len((t or "").split())
            assert abs(rows[i].log_prob - want) < 1e-3 * max(1, abs(want))
            assert (rows[i].mean_log_prob is None) == (not t)
        got.append(rows[2].log_prob)
    assert max(got) - min(got) < 1e-6


def test_all_documents_train_once(spark, monkeypatch):
    seen = []

    def noted(turn, streams, model, rate):
        seen.extend(r.text for r in turn.collect())
        return model.weights

    monkeypatch.setattr(lm, "_round", noted)
    rows = [(i if i % 3 else None, f"text number {i}") for i in range(60)] + [(7, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lm.train(docs)
    assert sorted(seen) == sorted(t for _, t in rows if t)
    seen.clear()
    lm.train(docs.where("doc_id is null"), every=5)  # no id in the class: all train
    assert len(seen) == 20


def test_streams_grow_with_the_tokens(spark, monkeypatch):
    got = []

    def noted(turn, streams, model, rate):
        got.append((streams, turn.select("stream").distinct().count()))
        return model.weights

    monkeypatch.setattr(lm, "_round", noted)
    monkeypatch.setattr(lm, "STREAM_TOKENS", 10)
    docs = spark.createDataFrame([(i, "same text again") for i in range(400)], "doc_id bigint, text string")
    lm.train(docs)
    assert [s for s, _ in got] == [60, 60] and min(n for _, n in got) > 40  # copies are spread


def test_small_tables_and_null_ids_are_learned(spark):
    docs = spark.createDataFrame([(None, f"one two three four five {i}") for i in range(40)], "doc_id bigint, text string")
    model = lm.train(docs)
    assert not np.allclose(model.weights, lm.start_weights(model.words))


def test_gradients_are_the_slope():
    vocab = counted_vocabulary([" ".join(f"w{i}" for i in range(lm.WORDS)) * 3, "gather lather rather"])
    places = lm._Places(vocab)
    tokens = places.tokens(lm._joined(["w1 gather w2", "w3 rather unseen w1 lather w2 w2"] * 20, places)[0])
    flat = some_weights().astype(np.float64)
    here = np.flatnonzero(tokens.classes >= 0)
    loss = lambda w: -float(lm.log_probs(tokens, lm.unflatten(w))[here].astype(float).mean())
    near, back, d_out, d_bias, d_part, shapes, d_shift = lm.gradients(tokens, here, lm.unflatten(flat))
    slope = [np.zeros(s) for s in lm._sizes()]
    for e, c in zip(slope[0], near):
        np.add.at(e, c, back)
    slope[1][:], slope[2][:], slope[3][:], slope[4][shapes] = d_out, d_bias, d_part, d_shift
    slope = np.concatenate([x.ravel() for x in slope])
    starts = np.cumsum([0] + [int(np.prod(s)) for s in lm._sizes()])
    for a, b in zip(starts, starts[1:]):
        for at in a + np.argsort(-np.abs(slope[a:b]))[:3]:
            up, down = flat.copy(), flat.copy()
            up[at] += 0.05
            down[at] -= 0.05
            assert abs((loss(up) - loss(down)) / 0.1 - slope[at]) < 1e-3 + 0.02 * abs(slope[at])


def test_words_are_looked_up_once(spark, monkeypatch):
    """Training and scoring of a table read the same places, and give what
    training and scoring of the texts give."""
    seen, plain = [], lm._round

    def noted(turn, streams, model, rate):
        seen.append(set(turn.columns))
        return plain(turn, streams, model, rate)

    monkeypatch.setattr(lm, "_round", noted)
    rows = [(i % 50 or None, f"one two, thrée {i % 7} four{i}") for i in range(90)] + [(7, None), (7, None), (8, " \n"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    rank = lambda df: sorted(((r.doc_id or 0, r.n_tokens, r.log_prob) for r in df.collect()))
    for known in (lm.KNOWN_WORDS, 0):  # without and with words that are joined
        monkeypatch.setattr(lm, "KNOWN_WORDS", known)
        monkeypatch.setattr(lm, "OWN", lm.WORDS)
        seen.clear()
        got = rank(lm.score_documents(docs))
        assert len(seen) == lm.ROUNDS and all("places" in c and "text" not in c for c in seen)
        want = rank(lm.score(docs, lm.train(docs)))
        assert len(got) == len(rows) and [g[:2] for g in got] == [w[:2] for w in want]
        assert all(g[2] == pytest.approx(w[2], rel=1e-5) for g, w in zip(got, want))


def test_group_sums_are_plain_sums():
    rng = np.random.default_rng(4)
    for n, most in ((1, 1), (50, 400), (300, 40), (2000, 90), (400, 1)):
        keys = (rng.random(4 * n) ** 3 * most).astype(np.uint16)  # more keys than rows
        values = rng.standard_normal((n, 3))
        want = np.zeros((most, 3))
        np.add.at(want, keys, np.concatenate([values] * 4))
        got, sums, numbers = lm._group_sums(keys, values)
        assert sorted(got) == sorted(set(keys)) and (numbers == np.bincount(keys, minlength=most)[got]).all()
        assert np.allclose(sums, want[got])


def test_a_used_room_changes_nothing():
    vocab = counted_vocabulary([" ".join(f"w{i}" for i in range(lm.WORDS)) * 3, "gather lather rather"])
    places, weights = lm._Places(vocab), lm.unflatten(some_weights())
    tokens = places.tokens(lm._joined(["w1 gather w2", "w3 rather unseen w1 lather w2 w2"] * 9, places)[0])
    words = np.flatnonzero(tokens.classes >= 0)
    room = lm._Room(len(words), np.float32)
    for here in (words, words[:5], words[::3], words[tokens.parts[words] < 0]):  # the last: no word with a part
        for a, b in zip(lm.gradients(tokens, here, weights), lm.gradients(tokens, here, weights, room=room)):
            assert (a is None) == (b is None) and (a is None or np.array_equal(a, b))
