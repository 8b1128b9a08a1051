"""Statistics against plain Python, the learner, and the judged rows."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from roadlens.llm import quality
from tests.llm.edges import edge_docs, edge_rows, empty_docs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(map((text or "").count, "#*$%&|<>")), dup, len(covered), failed


def test_statistics(spark):
    random.seed(8)
    texts = [" ".join(random.choices("ab", k=random.randint(0, 40))) for _ in range(150)]
    texts += ["".join(random.choices("ab# |\n\t\x0b\x1c é😀", k=random.randint(0, 60))) for _ in range(300)]
    texts += ["x y z w v " * 3, "a b c d e f a b c d e", "a a a a a", "a a a a a a", None, "", "\n\n", "l\nl\n l\nl", "😀# 漢|字"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string"), []).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(t), repr(t)
        assert r.kept == (not r.base_failed) and r.rule is None


def test_filters_stay_above_the_statistics(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "doc_id bigint, text string")
    plan = quality.judge(docs, []).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2


def test_learner_finds_planted_rules():
    random.seed(4)
    rows = []
    for i in range(900):
        f = {k: random.random() for k in quality.FEATURES}
        bad = f["symbols_per_word"] > 0.8 or (f["upper_share"] > 0.6 and f["word_length"] < 0.4)
        rows.append((f, 0 if bad else 1))
    rules = quality.learn_rules(rows)
    hit = [any(r.covers(f) for r in rules) for f, _ in rows]
    bad = [y == 0 for _, y in rows]
    assert sum(h and not b for h, b in zip(hit, bad)) <= 0.02 * sum(hit)
    assert sum(h and b for h, b in zip(hit, bad)) >= 0.85 * sum(bad)
    assert quality.learn_rules([]) == [] and quality.learn_rules([(rows[0][0], 1)]) == []


def test_rules_become_expressions_in_order(spark):
    rules = [quality.Rule((("symbols_per_word", True, 0.5),)), quality.Rule((("upper_share", True, 0.5), ("words", False, 20.0)))]
    words = " ".join(f"word{i}" for i in range(12))
    docs = spark.createDataFrame([(1, words), (2, words.replace("word", "##")), (3, words.upper()),
                                  (4, (words + " more words here to see that it is longer now").upper())], "doc_id bigint, text string")
    got = {r.doc_id: (r.rule, r.kept) for r in quality.judge(docs, rules).collect()}
    assert got == {1: (None, True), 2: (1, False), 3: (2, False), 4: (None, True)}


def test_learned_list_keeps_clean_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality.fit_rules(docs, labels)
    got = {r.doc_id: r for r in quality.judge(docs, rules).collect()}
    for r in labels.collect():
        if r.quality == 1 and not got[r.doc_id].base_failed:
            assert got[r.doc_id].kept
    assert quality.fit_rules(docs, labels) == rules
    kept = quality.keep_good(docs, rules)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)


def test_edges(spark):
    rows = quality.judge(edge_docs(spark), []).collect()
    assert Counter((r.doc_id, r.n_words, r.n_repeat_words) for r in rows) == Counter(
        (i, plain(t)[0], plain(t)[4]) for i, t, *_ in edge_rows())
    assert quality.keep_good(edge_docs(spark), []).columns == edge_docs(spark).columns
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (5, None), (7, 1)], "doc_id bigint, quality int")
    assert quality.fit_rules(edge_docs(spark), labels) == []
    none = quality.fit_rules(empty_docs(spark), labels.limit(0))
    assert none == [] and quality.judge(empty_docs(spark), none).count() == 0
    assert quality.judge(edge_docs(spark).withColumn("text", F.lit(None).cast("string")), []).where("kept").count() == 0
