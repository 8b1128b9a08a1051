"""Rows that every operator must stand: nulls, empty, blank and very long
texts, ties, repeated rows, and further columns with clashing names."""

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, rule string, "
          "size string, row string, score string, spans string, component_id string, piece string, `offset` string")
LONG = "very long text with many many words and a repeated tail " * 4000


def edge_rows():
    base = [(1, "plain words of a first document that is long enough to stay here", "en", "b"),
            (2, None, "en", "a"), (3, "", "fr", None), (4, "  \n\t ", None, "a"), (5, LONG, "en", "b"),
            (6, "one", "de", None), (7, "one", "de", None), (7, "one", "de", None),
            (None, "no id but some text, password=abcdefgh12345678 in it", "en", "c"), (None, None, None, None),
            (9, "ünï cödé 漢字 😀 <|endoftext|> \x1c \u00a0 done", "es", "z")]
    return [(i, t, lang, s, None if t is None else len(t), True, "r", "s", "x", "y", "q", "c", "p", "o") for i, t, lang, s in base]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing_docs(spark):
    """The edge rows with columns named as the operators name theirs inside, a
    dotted one, and a map."""
    from pyspark.sql import functions as F

    names = ["_quality_words", "_quality_row", "_quality_all", "_quality_text", "_parts", "_n", "_mark", "_mark2", "_key", "_key2", "_all",
             "_text", "_pieces", "_id", "_doc_row", "_b", "a.b"]
    return edge_docs(spark).withColumns({n: F.lit(f"is {n}") for n in names} | {"tags": F.create_map(F.lit("k"), F.col("doc_id"))})
