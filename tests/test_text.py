"""Goldens computed from the original programs' shipped text inputs."""

from roadlens.operators import remove_top_word, word_count, word_count_distinct

# The tab-separated word-count input (24 lines)
WORD_COUNT_LINES = """Hello	Hongten	40001
Hello	20001	40002
Hello	20002	40003
Hello	20002	40004
Hello	20003	40005
Hello	20003	40006
Hello	20004	40007
Hello	20004	40008
Hello	20005	word
Hello	20005	40010
Hello	20006	40011
Hello	20006	40012
Hello1	20007	40013
Hello1	20007	40014
Hello1	20008	40015
Hello1	20008	40016
Hello	20009	test
Hello	20009	40018
HellA	20010	data
Hello	20010	this
Hello	20011	is
Hello	20011	data
Hello	20012	40023
Hello	20012	40024""".split("\n")

# The blank-separated input of the top-word removal (7 lines)
REMOVE_MAX_LINES = """Hongten this is a test message
He is a boy
Apache Spark is a unified analytics engine for large-scale data processing
Apache Spark achieves high performance for both batch and streaming data
using a state-of-the-art DAG scheduler
a query optimizer
and a physica execution engine""".split("\n")


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_word_count_golden(spark):
    df = word_count(_lines(spark, WORD_COUNT_LINES), "\t", ["Hello"])
    got = {r.word: r.n for r in df.collect()}
    assert len(got) == 38 and sum(got.values()) == 69
    assert got["Hello"] == 19 and got["Hello1"] == 4
    for w in "20002 20003 20004 20005 20006 20007 20008 20009 20011 20012".split():
        assert got[w] == 2
    ones = ("20001 20010 40001 40002 40003 40004 40005 40006 40007 40008 40010 40011 40012 40013 "
            "40014 40015 40016 40018 40023 40024 Hongten data is test this word").split()
    assert all(got[w] == 1 for w in ones) and len(ones) == 26
    # ordered by count descending
    ns = [r.n for r in df.collect()]
    assert ns == sorted(ns, reverse=True)
    assert word_count_distinct(_lines(spark, WORD_COUNT_LINES), "\t", ["Hello"]).first().n_words == 38


def test_remove_top_word_golden(spark):
    df = remove_top_word(_lines(spark, REMOVE_MAX_LINES), " ")
    got = {r.word: r.n for r in df.collect()}
    assert "a" not in got and len(got) == 31
    assert got["is"] == 3
    assert {w for w, n in got.items() if n == 2} == {"Apache", "Spark", "and", "data", "engine", "for"}
    assert sum(1 for n in got.values() if n == 1) == 24


def test_remove_top_word_edges_n13(spark):
    assert remove_top_word(spark.createDataFrame([], "value string")).count() == 0
    got = {r.word: r.n for r in remove_top_word(_lines(spark, ["b a", "a b", "c"])).collect()}
    assert got == {"b": 2, "c": 1}  # tie a/b at 2: only the smaller word goes


def test_empty_line_is_one_empty_word_n16(spark):
    got = {r.word: r.n for r in word_count(_lines(spark, ["", "x"]), " ").collect()}
    assert got == {"": 1, "x": 1}
