"""Registered queries against their SQL, and the pipeline stage by stage."""

import re

import duckdb
import pytest

import corpus_pipeline
from roadlens.llm import queries
from tests.llm import test_dedup, test_quality, test_secrets

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 0


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline") == list(range(1, 14))


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, rows = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == cols
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        rows.append(docs.collect())
    start, good, unique, clean, mixed, packed = rows
    rejected = {r.doc_id for r in start} - {r.doc_id for r in good}
    assert all(test_quality.plain(r.text)[-1] is False for r in good)
    assert {r.doc_id for r in start if test_quality.plain(r.text)[-1]} <= rejected
    groups = test_dedup.plain_components([(r.doc_id, r.text) for r in good], 5)
    assert sorted(r.doc_id for r in unique) == sorted(set(groups.values()))
    before = {r.doc_id: r for r in unique}
    assert sorted(before) == sorted(r.doc_id for r in clean)
    for r in clean:
        assert test_secrets.plain_base(r.text) == "" and r.n_chars == len(r.text)
        if not test_secrets.plain_base(before[r.doc_id].text):
            assert r.text == before[r.doc_id].text
    words = {r.doc_id: set(WORD.findall(r.text)) for r in clean}
    assert all(set(WORD.findall(r.text)) <= words[r.doc_id] and WORD.search(r.text) for r in mixed)
    size = sum(len(WORD.findall(r.text)) for r in clean)
    assert abs(sum(len(WORD.findall(r.text)) for r in mixed) - size) < 0.05 * size
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(r.doc_id for r in mixed)


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0


def test_stages_stand_clashing_names_and_maps(spark):
    from tests.llm.edges import clashing_docs
    docs = clashing_docs(spark)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes)
        rows = got.collect()
        assert 0 < len(rows) <= (4 * n if name == "source_mix" else n)
        assert all(r["_quality_words"] == "is _quality_words" and r["a.b"] == "is a.b" and r["_parts"] == "is _parts"
                   and r["tags"] == {"k": r["doc_id"]} for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= n


def test_repeated_labelled_ids_are_one_row(spark, monkeypatch):
    from roadlens.llm import quality
    seen = []
    monkeypatch.setattr(quality, "learn_rules", lambda rows: seen.append(len(rows)) or [])
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text)] * 2000 + [(2, text + " end")], "doc_id bigint, text string")
    quality.fit_rules(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, quality int"))
    assert seen == [2]
