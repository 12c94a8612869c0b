"""From documents to token ids: quality rules, language, near-duplicates, mixing, encoding.

Every stage works on all rows that the one before kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, language, mixing, nearcopies, rules
from tideline.llm.common import fold, table
from tideline.session import stage

SEED = 17
#: Target shares of characters: one source that has most of them is held to a fifth, the others share alike.
WEIGHTS: dict[str | None, float] = {"src0": 0.2, **{f"src{k}": 0.04 for k in range(1, 20)}, None: 0.04}
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    return rules.filtered(
        docs.select(*COLUMNS), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose n-grams are usual in the language they are told to be in; gibberish and texts without a letter go."""
    model = language.fit(docs, fold(F.col("doc_id")) != 0)
    told = language.predict(docs, model, list(COLUMNS))
    return told.where((F.col("lang_pred") != language.UNKNOWN) & F.col("usual")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: texts of a five-word Jaccard similarity of 0.8, transitively.

    Bands of MinHash values give the first candidates; SimHash fingerprints of the shingles, in the index of deletion
    variants, give those between groups not yet connected. At this similarity most pairs differ in more bits than it bridges.
    """
    return nearcopies.keep_one(docs.select(*COLUMNS))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated so that the sources have their target shares, shuffled."""
    return mixing.mixed(docs, WEIGHTS, seed=SEED).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, its number of tokens and the text they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    done = bpe.encode(docs.select("doc_id", "source", "text"), path, decoded_col="decoded")
    return done.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing_sources),
    ("encoding", encoding),
]

#: The rules' tokenisers, the language model and the encoder have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
