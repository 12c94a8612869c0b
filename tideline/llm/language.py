"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import below_share, modest, slices

BUCKETS = 1 << 15
CHARS_AT_ONCE = 1 << 18
#: Languages that are learned at most, the commonest; so many rows of counts come to the driver.
MOST_LANGS = 256
#: Letters from which a text tells how usual its n-grams are, and how far below the usual a text may lie: so many
#: spreads, and more for a text that is short beside ``USUAL_LETTERS``.
LEAST_LETTERS, SPREADS, USUAL_LETTERS = 40, 6.0, 400
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities: one row per n-gram bucket (a last one of zeros for what is no n-gram)."""

    langs: tuple[str, ...]
    prior: np.ndarray
    logs: np.ndarray
    usual: np.ndarray  # per language: mean and spread, over its texts, of the log likelihood a letter


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all lower-cased texts, each text closed by a zero, other than letters zero; text starts."""
    lower = [(t or "").lower() for t in texts]
    starts = np.cumsum([0, *(len(t) + 1 for t in lower)])
    points = np.frombuffer("\0".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letter_table()[points], points, np.uint32(0)), starts


def _buckets(points: np.ndarray) -> np.ndarray:
    """Bucket of the 1-, 2- and 3-gram at each place but the last two; ``BUCKETS`` where there is none.

    A bigram has a letter, a trigram a letter in its middle, so none reaches from one text into the next.
    """
    a, b, c = points[:-2], points[1:-1], points[2:]
    none = np.uint32(BUCKETS)
    shift = np.uint32(17)
    one = np.where(a > 0, (a * np.uint32(0x9E3779B1)) >> shift, none)
    two_hash = (a * np.uint32(0x85EBCA77)) ^ (b * np.uint32(0xC2B2AE3D)) ^ np.uint32(0x27D4EB2F)
    two = np.where((a > 0) | (b > 0), (two_hash * np.uint32(0x165667B1)) >> shift, none)
    three_hash = (two_hash ^ (c * np.uint32(0x7FEB352D))) * np.uint32(0x846CA68B)
    three = np.where(b > 0, three_hash >> shift, none)
    return np.stack([one, two, three])


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, first place of each text in them, text numbers), over bounded stretches of all texts."""
    points, starts = _characters(texts)
    padded = np.concatenate([[np.uint32(0)], points, np.zeros(2, np.uint32)])
    for at in range(0, len(points), CHARS_AT_ONCE):
        end = min(at + CHARS_AT_ONCE, len(points))
        first = int(np.searchsorted(starts, at, side="right")) - 1
        last = int(np.searchsorted(starts, end, side="left"))
        numbers = np.arange(first, last)
        yield _buckets(padded[at : end + 2]), np.maximum(starts[first:last] - at, 0), numbers


def log_scores(texts: list[str | None], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods (texts x langs, with prior) and the number of letters of each text."""
    sums = np.tile(model.prior.astype(np.float64), (len(texts), 1))
    letters = np.zeros(len(texts), np.int64)
    for buckets, places, numbers in _pieces(texts):
        met = model.logs[buckets[0]] + model.logs[buckets[1]]
        met += model.logs[buckets[2]]
        sums[numbers] += np.add.reduceat(met, places, axis=0)
        letters[numbers] += np.add.reduceat((buckets[0] < BUCKETS).astype(np.int64), places)
    return sums, letters


def fit(
    docs: DataFrame,
    trainable: Column,
    per_lang: int = 2_000,
    smoothing: float = 0.5,
    text_col: str = "text",
    lang_col: str = "lang",
    key_col: str = "doc_id",
    most_langs: int = MOST_LANGS,
) -> LanguageModel:
    """Counts of hashed n-grams by language, from about ``per_lang`` texts of each.

    Rows without text or language, and those for which ``trainable`` is not true, are left out. The bounds
    are parameters: every language keeps its rows by a hash of their key, all of them if it has fewer than
    ``per_lang``, and the ``most_langs`` commonest languages are learned (by name at equal numbers). Only one count per
    language and bucket comes to the driver. A second pass over the same texts learns what log likelihood a letter
    is usual in each language. Without rows there is no language.
    """
    rows = docs.where(trainable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(key_col).alias("key"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    common = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs)
    sizes = {r["lang"]: r["n"] for r in common.collect()}
    langs = tuple(sorted(sizes))
    if not langs:
        return LanguageModel((), np.zeros(0), np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((0, 2)))
    known = docs.sparkSession.createDataFrame([(x, min(1.0, per_lang / sizes[x])) for x in langs], "lang string, share double")
    number = {lang: k for k, lang in enumerate(langs)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(langs) * (BUCKETS + 1), np.int64)
        for batch in slices(batches):
            of_text = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for buckets, places, numbers in _pieces(batch.column(1).to_pylist()):
                sizes_here = np.diff([*places, buckets.shape[1]])
                rows_here = np.repeat(of_text[numbers], sizes_here) * (BUCKETS + 1)
                for row in buckets:
                    met, n = np.unique(rows_here + row, return_counts=True)
                    total[met] += n
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    chosen = rows.join(F.broadcast(known), "lang").where(below_share(F.col("key"), "language", F.col("share"))).select("lang", "text")
    counted = chosen.repartition(8).mapInArrow(count, "cell long, n long")
    cells = counted.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), BUCKETS + 1))
    counts.ravel()[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy()
    counts = counts[:, :BUCKETS] + smoothing
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    shares = np.array([sizes[lang] for lang in langs], float)
    table = np.vstack([logs.T, np.zeros(len(langs))]).astype(np.float32)
    flat = LanguageModel(langs, np.zeros(len(langs)), table, np.zeros((len(langs), 2)))

    def usual(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            sums, letters = log_scores(batch.column(1).to_pylist(), flat)
            some = letters >= LEAST_LETTERS
            each = sums[np.arange(len(own)), own][some] / letters[some]
            yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(each), pa.array(each * each)], names=["lang", "x", "xx"])

    measured = chosen.mapInArrow(usual, "lang long, x double, xx double").groupBy("lang").agg(F.avg("x").alias("x"), F.avg("xx").alias("xx"))
    bands = np.full((len(langs), 2), [-np.inf, 0.0])
    for r in measured.collect():
        bands[r["lang"]] = r["x"], max(r["xx"] - r["x"] ** 2, 0.0) ** 0.5
    return LanguageModel(langs, np.log(shares / shares.sum()), table, bands)


def predict(docs: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` with ``lang_pred``, ``score``, the posterior probability of that language, and ``usual``.

    ``usual`` tells whether the n-grams of the text are as likely, a letter, as in other texts of that language: the
    mean log likelihood is at most ``SPREADS`` spreads below the usual, wider for short texts. Unlike the score it does
    not grow with the length of a text, so gibberish is not usual, however long. It is false where there is no language.

    Null texts, texts without a letter, and all texts if no language was learned, are ``und`` with score 0.
    Every character of a text counts. Equal probabilities go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[f"`{c}`" for c in keep])
    schema = kept.schema.add("lang_pred", "string").add("score", "double").add("usual", "boolean")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.langs, UNKNOWN], object)
        for batch in slices(batches):
            sums, letters = log_scores(batch.column(len(keep)).to_pylist(), known)
            best = np.full(len(sums), len(known.langs))
            score, usual = np.zeros(len(sums)), np.zeros(len(sums), bool)
            if known.langs:
                some = letters > 0
                best[some] = sums[some].argmax(axis=1)
                score[some] = 1 / np.exp(sums[some] - sums[some].max(axis=1, keepdims=True)).sum(axis=1)
                each = (sums[some, best[some]] - known.prior[best[some]]) / letters[some]
                middle, spread = known.usual[best[some]].T
                usual[some] = each >= middle - SPREADS * spread * np.sqrt(1 + USUAL_LETTERS / letters[some])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best], pa.string()), pa.array(np.round(score, 6)), pa.array(usual)],
                names=[*keep, "lang_pred", "score", "usual"],
            )

    text = modest(docs)[f"`{text_col}`"].alias("__text")
    return docs.select(*[docs[f"`{c}`"] for c in keep], text).mapInArrow(run, schema)
