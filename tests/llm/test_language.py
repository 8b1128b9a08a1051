"""Language identification: kernels by hand, and held-out accuracy."""

import numpy as np

from roadlens.llm import language
from tests.llm.edges import edge_docs, edge_rows, empty_docs

SF = "/root/testdata/sf0.001"


def plain_grams(text):
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    if not any(c.isalpha() for c in low):
        return set()
    low = " " + " ".join(low.split()) + " "
    low = low if not text.lower()[:1].isspace() else low
    return {low[i:i + n] for n in language.LENGTHS for i in range(len(low) - n + 1)}


def test_ngrams_are_the_distinct_ones():
    scratch, letters = language._tools()
    for t in ("Hello, World!", "aaa", "Ünï  cödé 漢字", "x", "a-b_c1d", "word " * 50):
        got = language.ngrams(t, scratch, letters)
        assert len(set(got.tolist())) == len(got) == len(plain_grams(t)), t
    for t in ("", " ", "123 !?", "\n"):
        assert len(language.ngrams(t, scratch, letters)) == 0


def test_chunks_change_nothing(monkeypatch):
    scratch, letters = language._tools()
    t = "some words of a longer text, with 12 numbers and ünïcödé " * 20
    whole = set(language.ngrams(t, scratch, letters).tolist())
    monkeypatch.setattr(language, "CHUNK", 37)
    parts = set(language.ngrams(t, scratch, letters).tolist())
    assert whole <= parts


def test_folded_weights_equal_the_kernel_form():
    scratch, letters = language._tools()
    texts = {"en": ["the cat and the dog", "this is the house of that man", "where are the others"],
             "de": ["der hund und die katze", "das ist das haus von dem mann", "wo sind die anderen"]}
    sample = [(lang, language.ngrams(t, scratch, letters).astype(np.int64)) for lang, ts in texts.items() for t in ts]
    model = language.fit(sample, landmarks_per_lang=2, ridge=0.1)
    marks = [0, 1, 3, 4]
    k = lambda a, b: len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b))
    kmm = np.array([[k(sample[i][1], sample[j][1]) for j in marks] for i in marks])
    knm = np.array([[k(s, sample[j][1]) for j in marks] for _, s in sample])
    values, vectors = np.linalg.eigh(kmm)
    phi = knm @ (vectors / np.sqrt(values))
    y = np.array([[1.0 if lang == x else -1.0 for x in model.langs] for lang, _ in sample])
    coef = np.linalg.solve(phi.T @ phi / 3 + 0.1 * 2 * np.eye(4) / 6, phi.T @ y / 3)
    row = {g: i + 1 for i, g in enumerate(model.grams.tolist())}
    for (_, s), want in zip(sample, phi @ coef):
        got = sum(model.weights[row[g]].astype(float) for g in s.tolist() if g in row) / np.sqrt(len(s))
        assert np.allclose(got, want, atol=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if got[r.doc_id].held_out and r.lang and r.text]
    assert len(held) > 30
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    import zlib
    assert all(g.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= g.score <= 1 for i, g in got.items())


def test_only_training_rows_teach(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lied = docs.withColumn("lang", language.F.when(language.is_held_out(language.F.col("doc_id")), "xx")
                           .otherwise(language.F.col("lang")))
    a, b = language.train(docs), language.train(lied)
    assert a.langs == b.langs and np.array_equal(a.weights, b.weights)


def test_edges(spark):
    rows = language.identify(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    none = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert [r.lang_pred for r in none] == ["und"] * 3 and all(r.score == 0 for r in none)
    assert language.identify(empty_docs(spark)).count() == 0
    unlabelled = edge_docs(spark).withColumn("lang", language.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
