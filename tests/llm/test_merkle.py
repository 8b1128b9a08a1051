"""The Merkle manifest against a plain tree, and its proofs against changes."""

import hashlib
import zlib

import pytest

from roadlens.llm import merkle
from tests.llm.edges import edge_docs, empty_docs

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain(rows, fan=8):
    """The rows of ``checked``, one tree level after the other."""
    found, path = [], {}

    def climb(nodes):
        while len(nodes) > 1:
            runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
            for run in runs:
                for j, (_, members) in enumerate(run):
                    for m in members:
                        path[m].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1:])))
            nodes = [(digest(*[h for h, _ in run]), [m for _, members in run for m in members]) for run in runs]
        return nodes[0]

    subroots = []
    for lang in sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode())):
        some = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r["text"], r)
                       for r in rows if r["lang"] == lang), key=lambda x: x[:3])
        nodes = []
        for _, _, leaf, text, r in some:
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = text.translate(LOWER)
            path[len(found)] = []
            nodes.append((leaf, [len(found)]))
            found.append([r["doc_id"], leaf, None, plain_leaf(r, text)])
        subroots.append(climb(nodes))
        for m in subroots[-1][1]:
            found[m][2] = subroots[-1][0]
    if not found:
        return []
    root, out = climb(subroots)[0], []
    for m, (doc_id, leaf, subroot, changed) in enumerate(found):
        for before, after in path[m]:
            changed = digest(before, changed, after)
        out.append((doc_id, leaf, subroot, root, digest(*[b + a for b, a in path[m]]), changed, changed == root))
    return out


def agrees(docs):
    got = [tuple(r) for r in merkle.checked(merkle.build(docs)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain([r.asDict() for r in docs.collect()])))
    return got


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9, None: 1}, {"en": 70, "de": 8, "": 3, None: 2}])
def test_trees_of_any_size(spark, sizes):
    rows = [(1000 * k + i, "s", lang, i, f"Text {i} of {lang}") for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    got = agrees(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert len(got) == sum(sizes.values())


def test_many_languages(spark):
    agrees(spark.createDataFrame([(i, "s", f"l{i % 90}", i, f"T{i}") for i in range(200)], SCHEMA))


def test_deep_tree_and_a_changed_row(spark):
    rows = [(i, "s", "en", i, f"UPPER {i}") for i in range(700)]
    got = agrees(spark.createDataFrame(rows, SCHEMA))
    assert all(ok == (zlib.crc32(str(i).encode()) % 3 != 0) for i, *_, ok in got)
    other = spark.createDataFrame([(*r[:4], "changed") if r[0] == 5 else r for r in rows], SCHEMA)
    assert merkle.build(other).root != got[0][3]


def test_partitions_and_repeated_rows_change_nothing(spark):
    rows = [(i // 3, "s", "en", 1, "same") for i in range(60)] + [(None, None, None, None, None)] * 30
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(repr, agrees(docs.repartition(7)))) == sorted(map(repr, agrees(docs.coalesce(1))))


def test_edge_rows(spark):
    assert len(agrees(edge_docs(spark))) == edge_docs(spark).count()
    assert merkle.checked(merkle.build(empty_docs(spark))).collect() == []
