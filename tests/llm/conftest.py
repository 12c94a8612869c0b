import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import DOC, WORDS, doc  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows, odd characters, clashing extra columns."""
    line = " ".join(WORDS)
    rows = [
        doc(1, line), doc(2, line), doc(2, line), doc(3, line + " end"), doc(4, None), doc(5, ""), doc(6, " \n\t "),
        doc(7, None, None, None), doc(None, line.upper(), None, None), doc(None, "12 34 !!"), doc(8, "12 34 !!", "de"),
        doc(9, "\n".join([line] * 4), "fr", "src0"), doc(10, (line + "\n") * 3000, "en", "src0"), doc(11, "x" * 200_000),
        doc(12, "日本語 Σας <|endoftext|> 'S don't a\x1cb c ½ é é"), doc(13, " ".join(reversed(WORDS)), "es", ""),
        doc(100, "## $$ %% " * 30), doc(101, " ".join(WORDS[k % 7] + str(k) for k in range(400))),
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
