"""Boosted trees grown round by round from histograms of binned windows.

The windows are binned once and written; every round reads them, adds what the trees so far predict, and sums the
gradients per (leaf, feature, bin) in Spark. Only these sums, whose number depends on the trees and not on the rows,
come to the driver, which picks the splits. A round costs each of its levels one pass, also where the leaf of most gain
is split first; the error on the validation rows comes with the first pass of the next round, and a fit can be
continued where another one ended.

Sums are made of integers (gradients in fixed point), so they do not depend on the order of the tasks: the same
table, parameters and seed give the same trees on any cluster.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import drop_staged, stage

MOST_BINS = 254
#: Rows that one task reads in a pass; fewer rows are dealt to fewer tasks.
ROWS_PER_TASK = 100_000
#: Bytes of a block of rows, as which passes read them, and rows that a task handles at once.
BLOCK_BYTES, ROWS_AT_ONCE = 8192, 16_384
#: Rounds after which the predictions so far are written with the rows.
ROUNDS_PER_STAGE = 8
#: Sums of all tasks of a pass up to which the driver adds them up itself, without a shuffle.
SUMS_ADDED = 1 << 20
#: Levels that all rows walk together; below, only those that are not in a leaf yet.
LEVELS_TOGETHER = 6
#: Bits of a residual that one counting pass of a median tells apart, and values below which they are fetched.
MEDIAN_BITS, MEDIAN_VALUES = 12, 64


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has feature -1. A row goes left if its bin is at most ``bin`` (0: missing)."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int((self.feature < 0).sum())

    @cached_property
    def _steps(self) -> tuple[np.ndarray, np.ndarray, int]:
        """The feature that each node looks at, the node behind each (node, bin), and the levels; a leaf leads to itself."""
        own = np.arange(256)
        inner = (self.feature >= 0)[:, None]
        go_left = np.where(own == 0, self.missing_left[:, None], own <= self.bin[:, None])
        onward = np.where(inner, np.where(go_left, self.left[:, None], self.right[:, None]), np.arange(len(self.feature))[:, None])
        levels, level = 0, np.array([0])
        while len(level := level[self.feature[level] >= 0]):
            levels, level = levels + 1, np.concatenate([self.left[level], self.right[level]])
        return np.maximum(self.feature, 0).astype(np.intp), onward.astype(np.intp).ravel(), levels

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of binned features."""
        looked_at, onward, levels = self._steps
        cells, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        node = np.zeros(len(bins), np.intp)
        for _ in range(min(levels, LEVELS_TOGETHER)):
            node = onward.take((node << 8) + cells.take(first + looked_at.take(node)))
        rows = np.arange(len(bins)) if levels > LEVELS_TOGETHER else first[:0]
        while len(rows := rows[self.feature[node[rows]] >= 0]):
            at = node[rows]
            node[rows] = onward.take((at << 8) + cells.take(first[rows] + looked_at.take(at)))
        return node


@dataclass(frozen=True)
class BoostedModel:
    """Trees over named inputs: prediction is ``base`` plus the values of a row's leaves."""

    names: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    base: float
    trees: tuple[Tree, ...]
    loss: str
    flat: bool = False

    def predicted(self, values: np.ndarray) -> np.ndarray:
        """Predictions of rows of raw features; NaN is missing."""
        bins = binned_values(values, self.cuts)
        out = np.full(len(values), self.base)
        for tree in self.trees:
            out += tree.value[tree.places(bins)]
        return out

    def transform(self, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
        """``df`` with the prediction of every row."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        if self.flat:

            @F.pandas_udf("double")
            def predict_flat(x: pd.Series) -> pd.Series:
                rows = [[np.nan if v is None else v for v in r] for r in x]
                return pd.Series(shared.value.predicted(np.array(rows, float).reshape(len(x), -1)))

            return df.withColumn(prediction_col, predict_flat("x"))

        @F.pandas_udf("double")
        def predict_named(*columns: pd.Series) -> pd.Series:
            return pd.Series(shared.value.predicted(np.column_stack([c.to_numpy(float) for c in columns])))

        return df.withColumn(prediction_col, predict_named(*[F.col(f"`{n}`").cast("double") for n in self.names]))

    def importances(self) -> list[float]:
        """Share of each input in the gains of all splits; zeros without a split."""
        total = np.zeros(len(self.names))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return (total / total.sum() if total.sum() else total).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node in ``trees``, everything else in ``settings``."""
        rows = [
            (t, k, int(tree.feature[k]), int(tree.bin[k]), bool(tree.missing_left[k]), int(tree.left[k]), int(tree.right[k]),
             float(tree.value[k]), float(tree.gain[k]))
            for t, tree in enumerate(self.trees) for k in range(len(tree.feature))
        ]
        spark.createDataFrame(rows, _NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        settings = {"names": self.names, "cuts": self.cuts, "base": self.base, "loss": self.loss, "flat": self.flat, "trees": len(self.trees)}
        text = spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1)
        text.write.mode("overwrite").text(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedModel":
        known = json.loads(spark.read.text(f"{path}/settings").first()[0])
        nodes = spark.read.schema(_NODES).parquet(f"{path}/trees").orderBy("tree", "node").toPandas()
        trees = []
        for _, rows in nodes.groupby("tree", sort=True):
            trees.append(Tree(*[rows[c].to_numpy() for c in ("feature", "bin", "missing_left", "left", "right", "value", "gain")]))
        cuts = tuple(tuple(c) for c in known["cuts"])
        return BoostedModel(tuple(known["names"]), cuts, known["base"], tuple(trees[: known["trees"]]), known["loss"], known["flat"])


_NODES = "tree int, node int, feature int, bin int, missing_left boolean, left int, right int, value double, gain double"


def binned_values(values: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins of raw features: 0 for a missing value, else 1 and the number of cuts below it."""
    out = np.zeros(values.shape, np.uint8)
    for f, own in enumerate(cuts):
        known = ~np.isnan(values[:, f])
        out[known, f] = 1 + np.searchsorted(np.asarray(own), values[known, f], side="left")
    return out


@dataclass(frozen=True)
class Binned:
    """Written rows ``(part, row, y, bins)`` of training (0) and validation (1) windows, and what their bins mean."""

    table: DataFrame
    names: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    flat: bool
    passes: list[str] = field(default_factory=list)


def _inputs(windows: DataFrame, names: Sequence[str], flat: bool) -> list[Column]:
    raw = [F.col("x")[k] for k in range(len(names))] if flat else [F.col(f"`{n}`").cast("double") for n in names]
    return [F.when(~F.isnan(c), c) for c in raw]


def feature_cuts(train: DataFrame, names: Sequence[str], max_bins: int, flat: bool) -> tuple[tuple[float, ...], ...]:
    """Cuts between the bins of every feature: its quantiles in one pass; all values of a feature that has few."""
    levels = [k / max_bins for k in range(max_bins + 1)]
    columns = [F.percentile_approx(c, levels, 100 * max_bins).alias(f"q{k}") for k, c in enumerate(_inputs(train, names, flat))]
    row = train.agg(*columns).first()
    return tuple(tuple(float(v) for v in sorted(set(row[k] or []))[:-1]) for k in range(len(names)))


def bin_windows(windows: DataFrame, names: Sequence[str], max_bins: int = 64, flat: bool = False) -> Binned:
    """Windows of the splits ``train`` and ``val`` with one byte per feature, written once.

    The bins rest on the training windows. A missing value has a bin of its own; ``y`` is the array of targets.
    """
    if not 2 <= max_bins <= MOST_BINS:
        raise ValueError(f"max_bins must lie between 2 and {MOST_BINS}")
    cuts = feature_cuts(windows.where(F.col("split") == "train"), names, max_bins, flat)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat_values = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(float)
            bins = binned_values(flat_values.reshape(batch.num_rows, len(names)), cuts)
            blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(max(len(names), 1)), len(bins), [None, pa.py_buffer(_wide(bins).tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], blob.cast(pa.binary())], names=["part", "row", "y", "bins"])

    values = F.array(*_inputs(windows, names, flat)).cast("array<double>") if names else F.array().cast("array<double>")
    chosen = windows.where(F.col("split").isin("train", "val"))
    part = (F.col("split") == "val").cast("int").alias("part")
    tasks = max(1, -(-chosen.count() // ROWS_PER_TASK))
    rows = chosen.coalesce(tasks).select(part, F.monotonically_increasing_id().alias("row"), F.col("y").cast("array<double>").alias("y"), values.alias("v"))
    table = stage(rows.mapInArrow(run, "part int, row long, y array<double>, bins binary"), "binned")
    return Binned(table, tuple(names), cuts, flat)


def _wide(bins: np.ndarray) -> np.ndarray:
    return bins if bins.shape[1] else np.zeros((len(bins), 1), np.uint8)


_BLOCKS = "part int, row binary, y binary, pred binary, bins binary"


def _blocks(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The rows of ``values`` in blocks, each a binary value; ``ends`` has the first row of each block and the end of the last."""
    offsets = (ends * (values.nbytes // max(len(values), 1))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _numbers(blocks: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all blocks one after the other, and how many each block has."""
    _, offsets, data = blocks.buffers()
    at = np.frombuffer(offsets, np.int32)[blocks.offset : blocks.offset + len(blocks) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind), np.diff(at) // np.dtype(kind).itemsize


def in_blocks(rows: DataFrame, width: int) -> DataFrame:
    """Rows ``(part, row, y, bins)`` of ``width`` bins in written blocks of one part each, so that a pass moves few values.

    ``pred`` is null as long as all rows have the same prediction.
    """
    most = max(1, BLOCK_BYTES // (width + 24))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, row, y = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            bins = _numbers(batch.column(3), np.uint8)[0].reshape(len(part), width) if len(part) else None
            for own in np.unique(part):
                held = np.flatnonzero(part == own)
                ends = np.append(np.arange(0, len(held), most), len(held))
                cells = [_blocks(v[held], ends) for v in (row.astype(np.int64), y.astype(float), bins)]
                whole = pa.array(np.full(len(ends) - 1, own, np.int32))
                yield pa.RecordBatch.from_arrays([whole, *cells[:2], pa.nulls(len(whole), pa.binary()), cells[2]], names=["part", "row", "y", "pred", "bins"])

    return stage(rows.select("part", "row", "y", "bins").mapInArrow(run, _BLOCKS), "blocks")


def shrunk(total: np.ndarray, alpha: float) -> np.ndarray:
    """Sums of gradients after the L1 penalty: moved towards zero by ``alpha``."""
    return np.sign(total) * np.maximum(np.abs(total) - alpha, 0)


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool
    left: tuple[float, int]
    right: tuple[float, int]


def best_split(grad: np.ndarray, count: np.ndarray, p: dict[str, Any], allowed: np.ndarray) -> Split | None:
    """The split of most gain of a leaf from its sums (features x bins); ties go to the first feature, cut and side.

    Gains are those of the penalized squared loss: ``shrunk(G)**2 / (n + lambda)`` of both sides less that of the leaf.
    A missing value goes to the side where it gains more, to the right without any.
    """
    alpha, lam, least = p["reg_alpha"], p["reg_lambda"], p["min_child_weight"]
    total, n = grad[0].sum(), count[0].sum()
    worth = lambda g, c: shrunk(g, alpha) ** 2 / np.maximum(c + lam, 1e-300)
    left_g, left_n = np.cumsum(grad[:, 1:], axis=1)[:, :-1], np.cumsum(count[:, 1:], axis=1)[:, :-1]
    best: Split | None = None
    options = []
    for missing_left in (False, True):
        g = left_g + grad[:, :1] * missing_left
        c = left_n + count[:, :1] * missing_left
        gain = worth(g, c) + worth(total - g, n - c) - worth(total, n)
        fits = (c >= max(least, 1)) & (n - c >= max(least, 1)) & allowed[:, None]
        if missing_left:
            fits &= count[:, :1] > 0
        options.append((np.where(fits, gain, -np.inf), g, c))
    for missing_left, (gain, g, c) in enumerate(options):
        if gain.size == 0:
            continue
        f, t = np.unravel_index(int(gain.argmax()), gain.shape)
        if gain[f, t] > 1e-12 * max(float(worth(total, n)), 1e-12) and (best is None or gain[f, t] > best.gain):
            sums = float(g[f, t]), int(c[f, t])
            best = Split(float(gain[f, t]), int(f), int(t) + 1, bool(missing_left), sums, (float(total) - sums[0], int(n) - sums[1]))
    return best


@dataclass
class _Node:
    path: str
    grad: float
    count: int
    sums: tuple[np.ndarray, np.ndarray] | None = None
    split: Split | None = None
    left: int = -1
    right: int = -1
    taken: bool = False

    @property
    def depth(self) -> int:
        return len(self.path)


class _Growing:
    """One tree while it grows: nodes, and which of their splits are taken."""

    def __init__(self, root: _Node):
        self.nodes = [root]

    def frozen(self, only_taken: bool, leaf: dict[int, float] | None = None) -> Tree:
        """Arrays of the tree with the splits known so far, or with those taken; ``leaf`` has values by node."""
        nodes = self.nodes
        use = [n.left >= 0 and (n.taken or not only_taken) for n in nodes]
        return Tree(
            np.array([n.split.feature if u else -1 for n, u in zip(nodes, use)], np.int32),
            np.array([n.split.bin if u else 0 for n, u in zip(nodes, use)], np.int32),
            np.array([bool(u and n.split.missing_left) for n, u in zip(nodes, use)]),
            np.array([n.left for n in nodes], np.int32),
            np.array([n.right for n in nodes], np.int32),
            np.array([(leaf or {}).get(k, 0.0) for k in range(len(nodes))]),
            np.array([n.split.gain if u else 0.0 for n, u in zip(nodes, use)]),
        )

    def compact(self, leaf: dict[int, float]) -> Tree:
        """The tree of the taken splits alone, in preorder."""
        order: list[int] = []

        def visit(k: int) -> None:
            order.append(k)
            if self.nodes[k].taken:
                visit(self.nodes[k].left)
                visit(self.nodes[k].right)

        visit(0)
        number = {k: i for i, k in enumerate(order)}
        whole = self.frozen(True, leaf)
        taken = np.array([self.nodes[k].taken for k in order])
        child = lambda side: np.array([number[getattr(self.nodes[k], side)] if self.nodes[k].taken else -1 for k in order], np.int32)
        pick = np.array(order)
        return Tree(
            np.where(taken, whole.feature[pick], -1), whole.bin[pick], whole.missing_left[pick], child("left"), child("right"),
            whole.value[pick], whole.gain[pick],
        )

    def in_reach(self, ready: list[int], n: int) -> list[int]:
        """Nodes without children that may be among the next ``n`` splits, so that one pass can sum the children of all.

        A node waits for those above it, so its turn comes by the least gain on the way from an open leaf. With ``n``
        known nodes before it, it is never reached, for nodes not known yet only come in between.
        """
        known, todo = [], [(self.nodes[k].split.gain, 0, k) for k in ready]
        while todo:
            gain, above, k = todo.pop()
            node = self.nodes[k]
            known.append((-gain, above, node.path, k))
            for child in (node.left, node.right) if node.left >= 0 and above + 1 < n else ():
                if split := self.nodes[child].split:
                    todo.append((min(gain, split.gain), above + 1, child))
        return [k for *_, k in sorted(known)[:n] if self.nodes[k].left < 0]

    def leaves(self) -> list[int]:
        """Nodes that rows of the taken tree end in."""
        out, todo = [], [0]
        while todo:
            k = todo.pop()
            if self.nodes[k].taken:
                todo += [self.nodes[k].right, self.nodes[k].left]
            else:
                out.append(k)
        return out


def _spread(row: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-random 64-bit numbers of rows."""
    with np.errstate(over="ignore"):
        z = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _sortable(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of doubles."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits | np.int64(-(1 << 63))).view(np.uint64)


def _unsorted(keys: np.ndarray) -> np.ndarray:
    """The doubles of ``_sortable``."""
    bits = keys.view(np.int64)
    return np.where(bits < 0, bits & np.int64((1 << 63) - 1), ~bits).view(np.float64)


class Booster:
    """Grows trees on one target of a binned table; see the module."""

    def __init__(self, binned: Binned, step: int, loss: str, params: dict[str, Any], seed: int, use_val: bool = True, start: BoostedModel | None = None):
        self.binned, self.loss, self.seed = binned, loss, seed
        self.p = {"reg_alpha": 0.0, "reg_lambda": 0.0, "min_child_weight": 1, "subsample": 1.0, "colsample_bytree": 1.0, "colsample_bylevel": 1.0, **params}
        self.n_features = len(binned.names)
        self.width = max((len(c) for c in binned.cuts), default=0) + 2
        y = F.col("y")[step - 1].alias("y")
        rows = binned.table.where(F.lit(use_val) | (F.col("part") == 0)).select("part", "row", y, "bins")
        rows = rows.where("y is not null and not isnan(y)")
        known = {r["part"]: r for r in rows.groupBy("part").agg(F.count("y").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi")).collect()}
        if 0 not in known:
            raise ValueError("no training rows")
        self.n_val = known[1]["n"] if 1 in known else 0
        lo, hi = min(r["lo"] for r in known.values()), max(r["hi"] for r in known.values())
        span = max(hi - lo, abs(hi), abs(lo), 1e-300) * 4
        n = max(r["n"] for r in known.values())
        bits = 60 - math.ceil(math.log2(n + 1))
        self.limit = span
        self.scale = 2.0 ** (bits - math.ceil(math.log2(span))) if loss == "squared" else 1.0
        self.error_scale = 2.0 ** (bits - math.ceil(math.log2(span)))
        self.square_scale = 2.0 ** (bits - math.ceil(2 * math.log2(span)))
        self.trees: list[Tree] = list(start.trees) if start else []
        self.staged = 0
        self.state = in_blocks(rows, max(self.n_features, 1))
        self.n_tasks = self.state.rdd.getNumPartitions()
        if start:
            self.base = start.base
        else:
            self.base = 0.0
            self.base = self._mean(rows, known[0]["n"]) if loss == "squared" else self._medians(Tree(*_stump()), [0], {0: known[0]["n"]}, whole=True)[0]

    # ---- passes over the rows ----

    def _mean(self, rows: DataFrame, n: int) -> float:
        """Of the training targets, by a sum in fixed point."""
        whole = F.round(F.col("y") * self.error_scale).cast("long")
        return rows.where("part = 0").agg(F.sum(whole).alias("s")).first()["s"] / self.error_scale / n

    def _read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        bins = _numbers(batch.column(4), np.uint8)[0].reshape(-1, max(self.n_features, 1))
        y, rows = _numbers(batch.column(2), np.float64)
        pred = np.full(len(y), float(self.base)) if batch.column(3).null_count else _numbers(batch.column(3), np.float64)[0]
        return np.repeat(batch.column(0).to_numpy(), rows), _numbers(batch.column(1), np.int64)[0], y, pred, bins

    def _rows(self, recent: Sequence[Tree], wanted: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None):
        """A function from batches to (part, row, residual, prediction, bins) with the predictions of the recent trees in.

        ``wanted`` tells from part and row which rows to return; without it, all.
        """

        def read(batches: Iterable[pa.RecordBatch]):
            for batch in batches:
                if batch.num_rows:
                    whole = self._read(batch)
                    for first in range(0, len(whole[0]), ROWS_AT_ONCE):
                        part, row, y, pred, bins = (v[first : first + ROWS_AT_ONCE] for v in whole)
                        if wanted is not None:
                            held = wanted(part, row)
                            part, row, y, pred, bins = part[held], row[held], y[held], pred[held], bins[held]
                        now = pred.copy()
                        for tree in recent:
                            now += tree.value[tree.places(bins)]
                        yield part, row, y - now, now, bins

        return read

    def _shared(self, value: Any):
        return self.state.sparkSession.sparkContext.broadcast(value)

    def _plain(self) -> "Booster":
        """What tasks need: this object without frames."""
        small = object.__new__(Booster)
        small.__dict__ = {k: v for k, v in self.__dict__.items() if k not in ("binned", "state", "trees")}
        return small

    def _in_sample(self, part: np.ndarray, row: np.ndarray, turn: int) -> np.ndarray:
        chosen = part == 0
        if self.p["subsample"] < 1:
            chosen &= _spread(row, self.seed * 1_000_003 + turn) < np.uint64(int(self.p["subsample"] * (1 << 63)) * 2)
        return chosen

    def _sums(self, tree: Tree, nodes: list[int], with_error: bool) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], tuple[float, float]]:
        """Sums of gradients and counts of the nodes (features x bins), and the errors on the validation rows."""
        own, recent, turn = self._plain(), self.trees[self.staged :], len(self.trees)
        shared = self._shared((own, recent, tree, nodes, with_error, turn))
        schema = "cell long, g long, n long"

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, recent, tree, nodes, with_error, turn = shared.value
            shape = (max(own.n_features, 1), len(nodes), own.width)
            grad, count = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
            size = len(nodes) * own.width
            error = np.zeros(2, np.int64)
            place_of = np.full(len(tree.feature), -1, np.int64)
            place_of[nodes] = np.arange(len(nodes))
            wanted = lambda part, row: own._in_sample(part, row, turn) | (with_error & (part == 1))
            for part, _, left, _, bins in own._rows(recent, wanted)(batches):
                if with_error:
                    off = np.minimum(np.abs(left[part == 1]), own.limit)
                    error += [np.rint(off * own.error_scale).astype(np.int64).sum(), np.rint(off * off * own.square_scale).astype(np.int64).sum()]
                    bins, left = bins[part == 0], left[part == 0]
                at = place_of[tree.places(bins)]
                held = at >= 0
                columns, left, first = np.ascontiguousarray(bins[held].T), left[held], at[held] * own.width
                if own.loss == "squared":
                    g = np.rint(np.clip(left, -own.limit, own.limit) * own.scale).astype(np.int64)
                else:
                    g = np.sign(left).astype(np.int64)
                # Two halves keep the sums of doubles inside bincount exact.
                high = g >> 26
                low, high = (g - (high << 26)).astype(float), high.astype(float)
                for f, column in enumerate(columns):
                    index = first + column
                    count[f] += np.bincount(index, minlength=size).reshape(shape[1:])
                    grad[f] += (np.bincount(index, high, size).astype(np.int64) << 26).reshape(shape[1:])
                    grad[f] += np.bincount(index, low, size).astype(np.int64).reshape(shape[1:])
            grad, count = grad.transpose(1, 0, 2).ravel(), count.transpose(1, 0, 2).ravel()
            some = np.flatnonzero(count)
            cell = np.concatenate([some, [-1, -2]]) if with_error else some
            g = np.concatenate([grad[some], error]) if with_error else grad[some]
            n = np.concatenate([count[some], [0, 0]]) if with_error else count[some]
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(g), pa.array(n)], names=["cell", "g", "n"])

        self.binned.passes.append("sums")
        added = (self.state if with_error else self.state.where("part = 0")).mapInArrow(run, schema)
        cells = max(self.n_features, 1) * self.width
        if self.n_tasks * len(nodes) * cells > SUMS_ADDED:
            added = added.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        added = added.toArrow()
        # The errors have the cells -1 and -2, which are the last two.
        grad, count = np.zeros(len(nodes) * cells + 2, np.int64), np.zeros(len(nodes) * cells + 2, np.int64)
        cell, g, n = (added.column(c).to_numpy() for c in ("cell", "g", "n"))
        np.add.at(grad, cell, g)
        np.add.at(count, cell, n)
        shape = (max(self.n_features, 1), self.width)
        sums = {
            node: (grad[k * cells : (k + 1) * cells].reshape(shape) / self.scale, count[k * cells : (k + 1) * cells].reshape(shape))
            for k, node in enumerate(nodes)
        }
        return sums, (int(grad[-1]) / self.error_scale, int(grad[-2]) / self.square_scale)

    def _medians(self, tree: Tree, leaves: list[int], counts: dict[int, int], whole: bool = False) -> list[float]:
        """Exact medians of what is left in each leaf, the mean of the two middle ones of an even number.

        Doubles are taken as integers of the same order; each pass counts the next ``MEDIAN_BITS`` bits behind
        the prefix that is known to hold a wanted rank, until few values are left, and these are fetched.
        """
        own, recent, turn = self._plain(), [] if whole else self.trees[self.staged :], len(self.trees)
        own.p = {**own.p, "subsample": 1.0} if whole else own.p
        wanted = [(leaf, rank) for leaf in leaves for rank in sorted({(counts[leaf] - 1) // 2, counts[leaf] // 2}) if counts[leaf]]
        # Of each wanted value: its leaf, its rank among the values that share the prefix, the prefix and how many share it.
        state = {w: [w[1], 0, counts[w[0]]] for w in wanted}
        found: dict[tuple[int, int], float] = {}
        shift = 64
        while len(found) < len(wanted):
            todo = [w for w in wanted if w not in found]
            groups = sorted({(w[0], state[w][1]) for w in todo})
            fetch = all(state[w][2] <= MEDIAN_VALUES for w in todo) or shift == 0
            low = max(shift - MEDIAN_BITS, 0)
            shared = self._shared((own, recent, tree, turn, groups, shift, 0 if fetch else low))

            def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                own, recent, tree, turn, groups, shift, low = shared.value
                tally: dict[tuple[int, int], int] = {}
                for part, row, left, _, bins in own._rows(recent)(batches):
                    chosen = own._in_sample(part, row, turn)
                    at, keys = tree.places(bins[chosen]), _sortable(left[chosen])
                    for k, (leaf, prefix) in enumerate(groups):
                        mine = at == leaf
                        if shift < 64:
                            mine &= (keys >> np.uint64(shift)) == np.uint64(prefix)
                        values, n = np.unique(keys[mine] >> np.uint64(low), return_counts=True)
                        for v, c in zip(values.tolist(), n.tolist()):
                            tally[k, v] = tally.get((k, v), 0) + c
                group, value = [k for k, _ in tally], np.array([v for _, v in tally], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group, pa.int32()), pa.array(value), pa.array(list(tally.values()), pa.int64())], names=["k", "v", "n"]
                )

            self.binned.passes.append("median")
            rows = self.state.where("part = 0").mapInArrow(run, "k int, v long, n long")
            if self.n_tasks > 1:
                rows = rows.groupBy("k", "v").agg(F.sum("n").alias("n"))
            rows = rows.toPandas()
            rows["v"] = rows["v"].to_numpy(np.int64).view(np.uint64)
            for k, group in enumerate(groups):
                mine = rows[rows["k"] == k].sort_values("v")
                upto = np.cumsum(mine["n"].to_numpy(np.int64))
                for w in todo:
                    if (w[0], state[w][1]) == group:
                        at = int(np.searchsorted(upto, state[w][0], side="right"))
                        value = int(mine["v"].iloc[at])
                        if fetch or low == 0:
                            found[w] = float(_unsorted(np.array([value], np.uint64))[0])
                        else:
                            state[w] = [state[w][0] - (int(upto[at - 1]) if at else 0), value, int(mine["n"].iloc[at])]
            shift = low
        middle = lambda leaf: [found[leaf, r] for r in sorted({(counts[leaf] - 1) // 2, counts[leaf] // 2})]
        return [float(np.mean(middle(leaf))) if counts[leaf] else 0.0 for leaf in leaves]

    # ---- one round ----

    def _columns(self, turn: int) -> np.ndarray:
        """Features of one tree."""
        rng = np.random.default_rng([self.seed, turn])
        chosen = np.zeros(max(self.n_features, 1), bool)
        if self.n_features:
            n = max(1, int(self.n_features * self.p["colsample_bytree"] + 1e-9))
            chosen[rng.permutation(self.n_features)[:n]] = True
        return chosen

    def _of_level(self, columns: np.ndarray, turn: int, depth: int) -> np.ndarray:
        if self.p["colsample_bylevel"] >= 1 or not columns.any():
            return columns
        rng = np.random.default_rng([self.seed, turn, depth + 1])
        own = np.flatnonzero(columns)
        out = np.zeros_like(columns)
        out[rng.permutation(own)[: max(1, int(len(own) * self.p["colsample_bylevel"] + 1e-9))]] = True
        return out

    def _expand(self, growing: _Growing, ids: list[int], columns: np.ndarray, turn: int) -> None:
        """Give the nodes their children, with sums where a child may be split again: one pass for all."""
        deepest = self.p.get("max_depth")
        pairs = []
        for k in ids:
            node = growing.nodes[k]
            node.left, node.right = len(growing.nodes), len(growing.nodes) + 1
            for side, (grad, count) in (("L", node.split.left), ("R", node.split.right)):
                growing.nodes.append(_Node(node.path + side, grad, count))
            least = 2 * max(self.p["min_child_weight"], 1)
            if (deepest is None or deepest < 0 or node.depth + 1 < deepest) and max(node.split.left[1], node.split.right[1]) >= least:
                small, large = (node.left, node.right) if node.split.left[1] <= node.split.right[1] else (node.right, node.left)
                pairs.append((k, small, large))
        if pairs:
            sums, _ = self._sums(growing.frozen(False), [small for _, small, _ in pairs], False)
            for k, small, large in pairs:
                whole = growing.nodes[k].sums
                growing.nodes[small].sums = sums[small]
                growing.nodes[large].sums = (whole[0] - sums[small][0], whole[1] - sums[small][1])
                for child in (small, large):
                    node = growing.nodes[child]
                    node.split = best_split(*node.sums, self.p, self._of_level(columns, turn, node.depth))
        for k in ids:
            growing.nodes[k].sums = None

    def _grown(self, sums: tuple[np.ndarray, np.ndarray]) -> _Growing:
        """A tree from the sums of its root: all leaves of a level at once, or the leaf of most gain first."""
        turn = len(self.trees)
        columns = self._columns(turn)
        root = _Node("", float(sums[0][0].sum()), int(sums[1][0].sum()), sums)
        growing = _Growing(root)
        if self.p.get("max_depth") == 0 or not self.n_features:
            return growing
        root.split = best_split(*sums, self.p, self._of_level(columns, turn, 0))
        most = self.p.get("num_leaves") or 0
        open_nodes, n_leaves = [0], 1
        while True:
            ready = [k for k in open_nodes if growing.nodes[k].split]
            if not most:
                if not ready:
                    return growing
                self._expand(growing, ready, columns, turn)
                open_nodes = []
                for k in ready:
                    growing.nodes[k].taken = True
                    open_nodes += [growing.nodes[k].left, growing.nodes[k].right]
                continue
            order = lambda k: (-growing.nodes[k].split.gain, growing.nodes[k].path)
            while n_leaves < most:
                ready = [k for k in open_nodes if growing.nodes[k].split]
                best = min(ready, key=order, default=None)
                if best is None or growing.nodes[best].left < 0:
                    break
                growing.nodes[best].taken = True
                open_nodes.remove(best)
                open_nodes += [growing.nodes[best].left, growing.nodes[best].right]
                n_leaves += 1
            if n_leaves >= most or best is None:
                return growing
            self._expand(growing, growing.in_reach(ready, most - n_leaves), columns, turn)

    def _round(self, sums: tuple[np.ndarray, np.ndarray]) -> Tree:
        growing = self._grown(sums)
        leaves = growing.leaves()
        rate = self.p["learning_rate"]
        if self.loss == "squared":
            worth = lambda n: float(shrunk(np.array(n.grad), self.p["reg_alpha"])) / max(n.count + self.p["reg_lambda"], 1e-300)
            values = {k: rate * worth(growing.nodes[k]) if growing.nodes[k].count else 0.0 for k in leaves}
        else:
            middle = self._medians(growing.frozen(True), leaves, {k: growing.nodes[k].count for k in leaves})
            values = {k: rate * v for k, v in zip(leaves, middle)}
        return growing.compact(values)

    def _stage(self) -> None:
        """Write the rows with the predictions so far, so that a round never adds up more than a few trees."""
        shared = self._shared((self._plain(), self.trees[self.staged :]))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, recent = shared.value
            for batch in batches:
                if batch.num_rows:
                    now = np.concatenate([now for _, _, _, now, _ in own._rows(recent)([batch])])
                    ends = np.append(0, np.cumsum(_numbers(batch.column(2), np.float64)[1]))
                    yield batch.set_column(3, "pred", _blocks(now, ends))

        following = stage(self.state.mapInArrow(run, _BLOCKS), "boosted")
        drop_staged(self.state)
        self.state, self.staged = following, len(self.trees)
        self.n_tasks = following.rdd.getNumPartitions()

    def fit(self, metric: str = "absolute", root_metric: bool = False) -> tuple[BoostedModel, list[float], int | None]:
        """Rounds up to the limit, or until ``early_stopping_rounds`` bring no better validation error.

        Returns the trees up to the best round (all without validation rows or patience), the validation error
        after every round fitted, and the best round.
        """
        limit, patience = int(self.p["n_estimators"]), self.p.get("early_stopping_rounds")
        before, history, best, best_score = len(self.trees), [], 0, math.inf
        stump = Tree(*_stump())
        while True:
            if len(self.trees) - self.staged >= ROUNDS_PER_STAGE:
                self._stage()
            done = len(self.trees) - before
            ended = done >= limit
            if ended and not self.n_val:
                break
            sums, (off, square) = self._sums(stump, [0], bool(self.n_val))
            if self.n_val and done:
                score = (off if metric == "absolute" else square) / self.n_val
                history.append(math.sqrt(score) if root_metric else score)
                if history[-1] < best_score:
                    best, best_score = done, history[-1]
                if patience and done - best >= patience:
                    break
            if ended:
                break
            self.trees.append(self._round(sums[0]))
        drop_staged(self.state)
        kept = max(best, 1) if self.n_val and patience else len(self.trees) - before
        model = BoostedModel(self.binned.names, self.binned.cuts, float(self.base), tuple(self.trees[: before + kept]), self.loss, self.binned.flat)
        return model, history, (max(best, 1) if self.n_val else None)


def _stump() -> tuple[np.ndarray, ...]:
    one = np.zeros(1)
    return np.array([-1], np.int32), one.astype(np.int32), one.astype(bool), np.array([-1], np.int32), np.array([-1], np.int32), one, one
