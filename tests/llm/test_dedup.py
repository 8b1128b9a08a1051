"""Near-duplicates against all pairs, and the sketch itself."""

import random
import re

import numpy as np
import pytest

from roadlens.llm import dedup
from roadlens.llm.components import components
from tests.llm.edges import edge_docs, edge_rows, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, words):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()


def plain_components(rows, words, percent=80):
    sets = [(i, plain_set(t, words)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in parent}


def corpus(seed, groups=12, size=9, length=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for g in range(groups):
        words = rng.choices(vocab, k=length + g)
        for _ in range(size):
            rows.append((i, " ".join(words)))
            i += 1
            words = list(words)  # chains: every text is near its predecessor only
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
    shared = " ".join(rng.choices(vocab, k=30))
    for _ in range(40):
        rows.append((i, shared + " " + " ".join(rng.choices(vocab, k=rng.randint(3, 25)))))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,seed", [(4, 1), (5, 2)])
def test_components_equal_all_pairs(spark, words, seed):
    rows = corpus(seed)
    got = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words).collect()
    want, text = plain_components(rows, words), dict(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(plain_set(text[r.doc_id], words)) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_last_round_alone_is_enough(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PARTNER_ROUNDS", 0)
    rows = corpus(3, groups=6)
    got = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components(rows, 4)


def test_sketch_fills_and_concentrates():
    rng = random.Random(7)
    with np.errstate(over="ignore"):
        for n in (1, 2, 3, 10, 100, 2000):
            x = dedup.shingles(" ".join(f"{rng.random()}" for _ in range(n + 3)), 4)
            s = dedup.sketch(x)
            assert len(x) == n and s.max() != dedup._NONE and np.array_equal(s, dedup.sketch(x[::-1].copy()))
        errors = []
        for _ in range(100):
            w = [f"w{rng.random()}" for _ in range(120)]
            v = list(w)
            for _ in range(4):
                v[rng.randrange(120)] = "other"
            a, b = dedup.shingles(" ".join(w), 4), dedup.shingles(" ".join(v), 4)
            similar = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((dedup.sketch(a) == dedup.sketch(b)).mean() - similar)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_sketch_equals_its_definition():
    """One round after the other, until all bins are filled, then one round per empty bin."""
    def plain(x, size):
        out = [None] * size
        for r in range(2 * size):
            for e in x.tolist():
                h = int(dedup._thrown(np.array([e], np.uint64), np.array([r], np.uint64))[0, 0])
                at = (h >> 40) % size if r < size else r - size
                if out[at] is None or out[at] > (h & 0xFFFFFFFFFF | r << 40):
                    if out[at] is None or out[at] >> 40 == r:
                        out[at] = h & 0xFFFFFFFFFF | r << 40
            if r < size and None not in out:
                break
        return out

    with np.errstate(over="ignore"):
        for n, size in ((1, 4), (1, 16), (3, 16), (5, 64), (200, 16)):
            x = dedup.shingles(" ".join(f"w{i}-{n}-{size}" for i in range(n + 3)), 4)
            assert dedup.sketch(x, size).tolist() == plain(x, size)


def test_chunks_of_a_text_change_nothing(monkeypatch):
    texts = ["some words of a text  that is\tcut " * 30, "x" * 100, " " * 90 + "tail", "a " * 40 + "b" * 50 + " c", "é" * 60]
    with np.errstate(over="ignore"):
        whole = [dedup.shingles(t, 4) for t in texts]
        for size in (7, 16, 33):
            monkeypatch.setattr(dedup, "CHUNK", size)
            assert all(np.array_equal(dedup.shingles(t, 4), x) for t, x in zip(texts, whole))


def test_edges(spark):
    got = dedup.near_duplicates(edge_docs(spark), 5).collect()
    assert len(got) == len(edge_rows())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[6] == [(1, 6, True)] and by[7] == [(1, 6, False)] * 2
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert sorted(by[None]) == [(0, None, True), (len(plain_set(edge_rows()[8][1], 5)), None, True)]
    assert dedup.near_duplicates(empty_docs(spark)).count() == 0
    kept = dedup.drop_near_duplicates(edge_docs(spark), 5)
    assert kept.columns == edge_docs(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, None, None, 9], key=str)
    same = spark.createDataFrame([(3, "a b c d e f"), (3, "g h i j k l"), (4, "a b c d e f"), (5, "g h i j k l"), (6, "q")],
                                 "doc_id bigint, text string")
    assert sorted((r.doc_id, r.component_id) for r in dedup.near_duplicates(same).collect()) == \
        [(3, 3), (3, 3), (4, 3), (5, 3), (6, 6)]


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 75), (200, 200), (301, 300), (302, 301)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 50, 50: 50, 75: 50, 200: 200, 300: 300, 301: 300, 302: 300}


def test_only_linked_or_equal_rows_are_dropped(spark):
    one, two, three = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(1, one, "x"), (1, two, "x"), (2, two, "y"), (None, three, "x"), (None, three, "y"), (None, one, "x"),
            (5, "", "x"), (5, "", "x"), (5, "", "y"), (5, None, "x"), (None, None, "x"), (None, None, "x"), (6, three + " v w", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
    want = [(1, one, "x"), (1, two, "x"), (5, "", "x"), (5, "", "y"), (5, None, "x"), (None, None, "x"), (6, three + " v w", "x")]
    for parts in (1, 5):
        got = list(map(tuple, dedup.drop_near_duplicates(docs.repartition(parts), 5).collect()))
        # of the rows without an id the group of ``three`` keeps one
        assert sorted((r for r in got if r[1] != three), key=repr) == sorted(want, key=repr)
        assert len({r for r in got if r[1] == three}) == sum(r[1] == three for r in got) == 1


def test_shared_counts_and_new_links():
    rng = np.random.default_rng(2)
    for m, words, size in ((1, 5, 3), (40, 30, 12), (70, 400, 40), (60, 25, 20)):
        sets = [np.unique(rng.integers(0, words, rng.integers(0, size + 1)).astype(np.uint64)) for _ in range(m)]
        want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
        assert (np.triu(dedup._shared(sets), 1) == np.triu(want, 1)).all()
        for blocks in (np.zeros(m), rng.integers(0, 2, m)):
            comp = rng.integers(0, max(1, m // 2), m)
            near = {(a, b) for a in range(m) for b in range(a + 1, m) if (blocks.max() == blocks.min() or blocks[a] != blocks[b])
                    and want[a, b] and 100 * want[a, b] >= 60 * (len(sets[a]) + len(sets[b]) - want[a, b])}
            got = dedup._new_links(sets, blocks, comp, 60)
            assert set(got) <= near and all(comp[a] != comp[b] for a, b in got) and len(got) < max(1, len(set(comp)))

            def labels(pairs):
                root = {c: c for c in comp}
                for a, b in pairs:
                    x, y = root[comp[a]], root[comp[b]]
                    root = {k: x if v == y else v for k, v in root.items()}
                return [root[c] for c in comp]
            one, two = labels(got), labels(near)
            assert len(set(zip(one, two))) == len(set(one)) == len(set(two))


@pytest.mark.parametrize("block,wide", [(4, 32), (4, 1), (1024, 32)])
def test_blocks_of_any_size_give_the_same(spark, monkeypatch, block, wide):
    monkeypatch.setattr(dedup, "PARTNER_ROUNDS", 1)
    monkeypatch.setattr(dedup, "BLOCK", block)
    monkeypatch.setattr(dedup, "MAX_BLOCKS", wide)
    rows = corpus(6, groups=5)
    got = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components(rows, 4)


def test_words_that_a_polynomial_confuses(spark):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    got = dedup.near_duplicates(spark.createDataFrame([(1, a), (2, b), (3, a + " "), (4, "a b"), (5, "ab")], "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
