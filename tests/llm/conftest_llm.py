"""Rows that the tests of this folder share."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("copy", T.StringType()),
])

WORDS = "the quick brown fox jumps over a lazy dog while seven bright owls watch from an old stone bridge near town".split()


def doc(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "w")
