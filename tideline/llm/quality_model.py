"""Quality classifier: a small byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Each byte has a learned vector; learned filters of six bytes stand every three
bytes; their activations are max-pooled over chunks of 384 bytes that overlap by half and cover the whole
text; a hidden layer looks at each chunk; the largest and the mean hidden activation over all chunks give
one probability.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import below_share, fold, slices, text_bytes

STEP = 3  # bytes between two filter places; a filter spans two steps
PLACES = 64  # filter places per block; a chunk is two neighbouring blocks
BLOCK = STEP * PLACES
DIM, FILTERS, HIDDEN = 8, 24, 12
BLOCKS_AT_ONCE = 1_024
NAMES = ("embed", "filters", "bias", "dense", "dense_bias", "out", "out_bias")


@dataclass(frozen=True)
class QualityModel:
    """Arrays by name (see ``NAMES``)."""

    params: dict[str, np.ndarray]


def start(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {
        "embed": ((256, DIM), 0.5),
        "filters": ((STEP * DIM, 2 * FILTERS), 0.2),
        "bias": ((FILTERS,), 0.0),
        "dense": ((FILTERS, HIDDEN), 0.3),
        "dense_bias": ((HIDDEN,), 0.0),
        "out": ((2 * HIDDEN,), 0.3),
        "out_bias": ((1,), 0.0),
    }
    return {n: (rng.standard_normal(s) * w).astype(np.float32) for n, (s, w) in shapes.items()}


def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each padded with zeros to whole blocks (one step at least); first block of each text."""
    sizes = np.diff(offsets)
    blocks = (sizes + STEP + BLOCK - 1) // BLOCK
    first = np.concatenate([[0], np.cumsum(blocks)])
    padded = np.zeros(int(first[-1]) * BLOCK, np.uint8)
    padded[np.repeat(first[:-1] * BLOCK - offsets[:-1], sizes) + np.arange(offsets[-1])] = data
    return padded, first


def block_maxima(p: dict, padded: np.ndarray, first: np.ndarray, places: bool = False):
    """Largest activation of every filter in every block, and where it was if asked for."""
    n_blocks = len(padded) // BLOCK
    top = np.empty((n_blocks, FILTERS), np.float32)
    where = np.empty((n_blocks, FILTERS), np.int64) if places else None
    last = np.zeros(n_blocks + 1, bool)
    last[first[1:]] = True  # block k is followed by another text
    after_end = np.tile(p["embed"][0], STEP) @ p["filters"][:, FILTERS:]
    for at in range(0, n_blocks, BLOCKS_AT_ONCE):
        end = min(at + BLOCKS_AT_ONCE, n_blocks)
        stretch = padded[at * BLOCK : (end * BLOCK) + STEP]
        if end == n_blocks:
            stretch = np.concatenate([stretch, np.zeros(STEP, np.uint8)])
        both = p["embed"][stretch].reshape(-1, STEP * DIM) @ p["filters"]
        here, following = both[:-1, :FILTERS], both[1:, FILTERS:].copy()
        following[PLACES - 1 :: PLACES][last[at + 1 : end + 1]] = after_end
        shaped = (here + following).reshape(-1, PLACES, FILTERS)
        if places:
            found = shaped.argmax(axis=1)
            where[at:end] = found + np.arange(at, end)[:, None] * PLACES
        top[at:end] = shaped.max(axis=1)
    return top, where


def forward(p: dict, top: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """From block maxima to one probability per text; a chunk is a block and the next one of its text."""
    n = len(top)
    final = np.zeros(n, bool)
    final[first[1:] - 1] = True
    partner = np.where(final, np.arange(n), np.arange(1, n + 1))
    take_next = top[partner] > top
    chunk = np.where(take_next, top[partner], top) + p["bias"]
    act = np.maximum(chunk, 0)
    hidden = np.maximum(act @ p["dense"] + p["dense_bias"], 0)
    sizes = np.diff(first)
    most = np.maximum.reduceat(hidden, first[:-1], axis=0)
    mean = np.add.reduceat(hidden, first[:-1], axis=0) / sizes[:, None]
    both = np.concatenate([most, mean], axis=1)
    logit = both @ p["out"] + p["out_bias"]
    prob = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return {
        "take_next": take_next, "partner": partner, "chunk": chunk, "act": act, "hidden": hidden,
        "sizes": sizes, "most": most, "both": both, "prob": prob,
    }


def gradients(p: dict, padded, first, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted log loss of one batch."""
    top, where = block_maxima(p, padded, first, places=True)
    f = forward(p, top, first)
    g: dict[str, np.ndarray] = {}
    d_logit = ((f["prob"] - labels) * weights / weights.sum()).astype(np.float32)
    g["out"], g["out_bias"] = f["both"].T @ d_logit, d_logit.sum(keepdims=True)
    d_both = d_logit[:, None] * p["out"]
    text = np.repeat(np.arange(len(labels)), f["sizes"])
    d_hidden = d_both[text, HIDDEN:] / f["sizes"][text][:, None]
    is_top = f["hidden"] == f["most"][text]
    ties = np.add.reduceat(is_top.astype(np.float32), first[:-1], axis=0)
    d_hidden += is_top * (d_both[:, :HIDDEN] / ties)[text]
    d_hidden *= f["hidden"] > 0
    g["dense"], g["dense_bias"] = f["act"].T @ d_hidden, d_hidden.sum(axis=0)
    d_chunk = (d_hidden @ p["dense"].T) * (f["chunk"] > 0)
    g["bias"] = d_chunk.sum(axis=0)
    place = np.where(f["take_next"], where[f["partner"]], where)
    rows, cols = np.nonzero(d_chunk)
    d, at = d_chunk[rows, cols], place[rows, cols] * STEP
    span = at[:, None] + np.arange(2 * STEP)
    bytes_met = np.where(span < len(padded), padded[np.minimum(span, len(padded) - 1)], 0)
    kernel = np.concatenate([p["filters"][:, :FILTERS], p["filters"][:, FILTERS:]]).T.reshape(FILTERS, 2 * STEP, DIM)
    met = p["embed"][bytes_met]
    d_kernel = np.zeros_like(kernel)
    for c in range(FILTERS):
        own = cols == c
        d_kernel[c] = np.tensordot(d[own], met[own], axes=(0, 0))
    flat = d_kernel.reshape(FILTERS, -1).T
    g["filters"] = np.concatenate([flat[: STEP * DIM], flat[STEP * DIM :]], axis=1)
    d_met = (d[:, None, None] * kernel[cols]).reshape(-1, DIM)
    one_hot = bytes_met.ravel()
    g["embed"] = np.stack([np.bincount(one_hot, d_met[:, k], 256) for k in range(DIM)], axis=1).astype(np.float32)
    return g


def train(
    texts: list[str],
    labels: np.ndarray,
    epochs: int = 8,
    batch: int = 64,
    rate: float = 0.01,
    seed: int = 1,
    least_steps: int = 250,
) -> QualityModel:
    """Adam on the log loss, both labels with equal total weight; the same input gives the same model.

    Small samples are passed over more often than ``epochs``, until there are ``least_steps`` steps.
    """
    p = start(seed)
    if len(texts) == 0 or len(set(labels.tolist())) < 2:
        # Nothing to tell apart: every text gets the share of label 1 (a half without labels).
        share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
        p["out"][:] = 0
        p["out_bias"][:] = np.log(share / (1 - share))
        return QualityModel(p)
    weights = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean()).astype(np.float32)
    rng = np.random.default_rng(seed)
    m = {n: np.zeros_like(v) for n, v in p.items()}
    v2 = {n: np.zeros_like(v) for n, v in p.items()}
    batches = -(-len(texts) // batch)
    epochs = max(epochs, -(-least_steps // batches))
    t, total = 0, epochs * batches
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            data, offsets = text_bytes(pa.array([texts[k] for k in chosen], pa.large_string()))
            padded, first = laid_out(data, offsets)
            g = gradients(p, padded, first, labels[chosen].astype(np.float32), weights[chosen])
            t += 1
            step = rate * (1 - t / (total + 1))
            for n in NAMES:
                m[n] = 0.9 * m[n] + 0.1 * g[n]
                v2[n] = 0.99 * v2[n] + 0.01 * g[n] ** 2
                p[n] = (p[n] - step * (m[n] / (1 - 0.9**t)) / (np.sqrt(v2[n] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
    return QualityModel(p)


def probabilities(model: QualityModel, column: pa.Array) -> np.ndarray:
    """One probability per text of a string column, nulls as empty texts."""
    data, offsets = text_bytes(column)
    padded, first = laid_out(data, offsets)
    top, _ = block_maxima(model.params, padded, first)
    return forward(model.params, top, first)["prob"]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", bound: int = 2_000, most_chars: int = 40_000_000) -> QualityModel:
    """Train on about ``bound`` labelled rows outside the held-out fold, chosen by a hash of their id.

    Half of the bound goes to each label. A row without a label of 0 or 1, without an id or without text is left out;
    an id with several labels counts once per label. Texts are whole, in training as in scoring. Where ids repeat,
    no more than ``bound`` rows are taken, in the order of a hash of id and text, and of these as many as hold
    ``most_chars`` characters together: what comes to the driver is bounded, whatever the input.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & (fold(F.col("doc_id")) != 0)).select("doc_id", F.col(label_col).alias("label")).distinct()
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, bound / 2 / n)).otherwise(share)
    chosen = known.where(below_share(F.col("doc_id"), "quality", share))
    joined = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    first = joined.withColumn("at", F.xxhash64("doc_id", "text")).orderBy("at", "label").limit(bound)
    upto = F.sum(F.char_length("text")).over(Window.orderBy("at", "label").rowsBetween(Window.unboundedPreceding, 0))
    rows = first.withColumn("upto", upto).where(F.col("upto") <= most_chars).select("doc_id", "label", "text").toPandas()
    rows = rows.sort_values(["doc_id", "label", "text"])
    return train(rows["text"].tolist(), rows["label"].to_numpy(int))


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, from all bytes of its text.

    Null and empty texts get the score of an empty text. Repeated rows give one row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            prob = np.round(probabilities(shared.value, batch.column(1)).astype(float), 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prob)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    held = (fold(F.col("doc_id")) == 0).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
