"""Small tables of documents with the hard cases, shared by the tests of the operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


def frame(spark, texts):
    """Documents with further columns."""
    return spark.createDataFrame([(i, t, None, "a", None, -1.0) for i, t in texts], SCHEMA)


#: Null and empty texts, white space, ties, repeated rows, null ids, a very long text.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "A b\nC"), (5, "a B \n c"), (6, "Ab c"), (6, "Ab c"), (None, "x y z"), (7, "word " * 30000), (8, "only\n\nlines\n")]
