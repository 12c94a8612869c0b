"""Rows under one id are told apart by their text when one of each group stays."""

from conftest_llm import WORDS, doc
from tideline.llm import simhash


def test_repeated_id_in_two_groups(spark):
    one, two = " ".join(WORDS), " ".join(reversed(WORDS))
    rows = [(1, one), (2, one), (2, two), (3, two), (3, two), (5, "a b c"), (6, "some other text"), (6, "yet one more of them")]
    docs = spark.createDataFrame([doc(i, t)[:5] for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect())
    assert got == [(1, one), (2, two), (5, "a b c"), (6, "some other text"), (6, "yet one more of them")]
