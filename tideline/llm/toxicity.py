"""Toxicity: logistic regression over hashed words, word pairs and skip-grams, fitted by FTRL-proximal.

Every coordinate has its own learning rate, and the L1 term keeps all weights at zero whose gradients do not add up,
so what is left is a short list of buckets and weights.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Memory, below_share, fold, held, slices

BITS = 20
SKIP = 3  # a skip-gram is two words with one or two between them
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 or c == 39 else 32 for c in range(256))
_TURN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ToxicityModel:
    """Buckets whose weight is not zero, ascending, their weights, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float64)
        out[self.buckets] = self.weights
        return out


def features(text: str | None) -> np.ndarray:
    """Distinct buckets of a whole text: its words, its pairs of neighbours, and its skip-grams; sorted."""
    words = (text or "").encode().translate(_PLAIN).split()
    if not words:
        return np.zeros(0, np.uint32)
    memory = held("toxicity", lambda: Memory(xxhash.xxh64_intdigest, 400_000, 64))
    marks = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
    parts = [marks]
    for gap in range(1, SKIP + 1):
        if len(marks) > gap:
            parts.append((marks[:-gap] * _TURN + marks[gap:]) * np.uint64(2 * gap + 1))
    every = np.concatenate(parts) * _TURN >> np.uint64(64 - BITS)
    seen = np.unique(every) if len(every) < 1 << 16 else np.flatnonzero(np.bincount(every.astype(np.int64), minlength=1 << BITS))
    return seen.astype(np.uint32)


def train(
    rows: list[np.ndarray],
    labels: np.ndarray,
    epochs: int = 12,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 20.0,
    l2: float = 1.0,
    seed: int = 1,
    least_rows: int = 3,
) -> ToxicityModel:
    """FTRL-proximal over the rows in shuffled order; both labels have equal total weight.

    Coordinate ``k`` moves at ``alpha / (beta + sqrt(n_k))``, ``n_k`` the sum of its squared gradients; its weight is
    zero while ``|z_k| <= l1``. Buckets of fewer than ``least_rows`` rows are left out. The intercept has no penalty. The
    same input gives the same model. Without rows, or with one label only, there are no weights and the intercept says
    the share of label 1 (a half without rows).
    """
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    if len(set(labels.tolist())) < 2:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    met = np.zeros(1 << BITS, np.int64)
    for row in rows:
        met[row] += 1
    rows = [row[met[row] >= least_rows] for row in rows]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = 0.0
    pull = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    rng = np.random.default_rng(seed)

    def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at = rows[k]
            w, w0 = weight(z[at], n[at]), -z0 * alpha / (beta + np.sqrt(n0))
            p = 1 / (1 + np.exp(-np.clip(w.sum() + w0, -35, 35)))
            g = (p - labels[k]) * pull[int(labels[k])]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
            z0 += g - (np.sqrt(n0 + g * g) - np.sqrt(n0)) / alpha * w0
            n0 += g * g
    every = weight(z, n)
    some = np.flatnonzero(every)
    return ToxicityModel(some, every[some], float(-z0 * alpha / (beta + np.sqrt(n0))))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", bound: int = 4_000) -> ToxicityModel:
    """Train on at most ``bound`` labelled rows outside the held-out fold, whole texts, chosen by a hash of their id.

    About half of the bound goes to each label; a label with fewer rows gives all. Rows without a label of 0 or 1,
    without an id or without text are left out. An id with both labels counts with each; of repeated rows each
    counts, and where ids repeat so often that the bound is passed, rows go by a hash of id and text. Executors
    hash the texts; only sets of buckets come to the driver, at most ``bound`` of at most ``1 << BITS`` each.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & (fold(F.col("doc_id")) != 0)).select("doc_id", F.col(label_col).alias("label")).distinct()
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, bound / 2 / n)).otherwise(share)
    chosen = known.where(below_share(F.col("doc_id"), "toxicity", share))
    joined = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    joined = joined.select("doc_id", "label", "text", F.xxhash64("doc_id", "text").alias("at"))
    rows = joined.orderBy("at", "label").limit(bound)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            sets = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sets, pa.binary())], names=["label", "at", "buckets"])

    made = rows.select("label", "text", "at").mapInArrow(run, "label int, at long, buckets binary").toPandas()
    made = made.sort_values(["at", "label"], kind="stable")
    return train([np.frombuffer(b, np.uint32) for b in made["buckets"]], made["label"].to_numpy(int))


def probabilities(texts: list[str | None], table: np.ndarray, intercept: float) -> np.ndarray:
    """One probability per whole text; null and empty texts get that of the intercept."""
    sums = np.array([table[features(t)].sum() for t in texts]) + intercept
    return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, from its whole text.

    Repeated rows give one row each; an empty table gives none; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.table()
        for batch in slices(batches, 500):
            prob = np.round(probabilities(batch.column(1).to_pylist(), table, shared.value.intercept), 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prob)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
