"""Near-duplicate vectors by a tiled comparison in the order of principal components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import join_hot, slices
from tideline.llm.components import connected_components, forest
from tideline.session import stage

TILE = 1_024
GROUP = 8_192
#: So many groups at least, of a few tiles each, so that small tables are compared side by side, too.
LEAST_GROUPS, SMALL_GROUP = 6, 1_024
STAGES = (8, 16, 32)
MARGIN = 1e-9


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the usable rows (same length, finite, not zero) in double precision, and which rows they are."""
    rows, places = [], []
    for k, value in enumerate(column.to_pylist()):
        if not value or any(x is None for x in value):
            continue
        vector = np.array(value, np.float64)
        if np.isfinite(vector).all() and vector.any():
            rows.append(vector)
            places.append(k)
    width = max(map(len, rows), default=0)
    same = [k for k, r in enumerate(rows) if len(r) == width]
    matrix = np.array([rows[k] / np.abs(rows[k]).max() for k in same]).reshape(len(same), width)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True)), np.array(places, np.int64)[same]


def unit_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """``(vec_id, unit, same)``: unit vectors of ``dims`` components as bytes and a digest of those bytes; null if unusable."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            unit = np.full(batch.num_rows, None, object)
            kept = [v if v is not None and len(v) == dims else None for v in batch.column(1).to_pylist()]
            matrix, places = _matrix(pa.array(kept, pa.list_(pa.float64())))
            for k, row in zip(places, matrix + 0.0):
                unit[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(unit, pa.binary())], names=["vec_id", "unit"])

    made = vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, unit binary")
    return made.withColumn("same", F.sha2("unit", 256))


def components_of(units: DataFrame, dims: int) -> np.ndarray:
    """Principal directions, largest variance first; only sums of products per task come to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((dims, dims)), 0
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float64).reshape(-1, dims)
            total += x.T @ x
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["cell", "s"])

    cells = units.select("unit").mapInArrow(run, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).toPandas()
    total = np.zeros(dims * dims)
    total[cells["cell"].to_numpy(np.int64)] = cells["s"].to_numpy()
    # Directions of the second moments: products, not deviations from the mean, are what is bounded.
    values, directions = np.linalg.eigh(total.reshape(dims, dims))
    return directions[:, np.argsort(-values, kind="stable")]


def _cuts(dims: int) -> list[int]:
    return [c for c in STAGES if c < dims]


def near_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of two tiles of rotated unit vectors with a product of ``threshold``, or less by rounding at most.

    Rotation rounds, so what is met has to be verified on the unrotated vectors.

    The leading components of all pairs are multiplied first; what the others can add is at most the product
    of the norms of the two rests, so a pair is dropped as soon as that is too little. Few pairs are left after
    the first cuts; theirs are continued one by one, cut by cut, to the whole product.
    """
    dims, least = a.shape[1], threshold - MARGIN
    cuts = _cuts(dims)
    if not cuts:
        return np.nonzero(a @ b.T >= least)
    rests = [(np.sqrt((a[:, c:] ** 2).sum(axis=1)), np.sqrt((b[:, c:] ** 2).sum(axis=1))) for c in cuts]
    first = cuts[0]
    lead = np.column_stack([a[:, :first], rests[0][0]]) @ np.column_stack([b[:, :first], rests[0][1]]).T
    i, j = np.nonzero(lead >= least)
    for at in range(0, len(i), 1 << 18):
        p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
        done, product = 0, np.zeros(len(p))
        for c, (ra, rb) in zip([*cuts, dims], [*rests, (None, None)]):
            product = product + np.einsum("nd,nd->n", a[p, done:c], b[q, done:c])
            reach = product + (ra[p] * rb[q] if ra is not None else 0.0)
            alive = reach >= least
            p, q, product, done = p[alive], q[alive], product[alive], c
        yield_p, yield_q = p, q
        i[at : at + len(p)], j[at : at + len(q)] = yield_p, yield_q
        i[at + len(p) : at + (1 << 18)] = -1
    alive = i >= 0
    return i[alive], j[alive]


def compare(x: np.ndarray, y: np.ndarray, threshold: float, same: bool, plain_x: np.ndarray, plain_y: np.ndarray):
    """Pairs between the rows of two groups, tile by tile; with ``same``, each pair of one group once.

    Rows come ordered by their first component; two tiles whose first components are too far apart to
    reach the threshold are passed over. Pairs met are verified on the unrotated vectors.
    """
    gap = np.sqrt(2 - 2 * threshold) + MARGIN
    for s in range(0, len(x), TILE):
        for t in range(s if same else 0, len(y), TILE):
            a, b = x[s : s + TILE], y[t : t + TILE]
            if a[0, 0] - b[-1, 0] > gap or b[0, 0] - a[-1, 0] > gap:
                continue
            i, j = near_pairs(a, b, threshold)
            i, j = i + s, j + t
            if same:
                i, j = i[i < j], j[i < j]
            exact = np.zeros(len(i), bool)
            for at in range(0, len(i), 1 << 18):
                part = slice(at, at + (1 << 18))
                exact[part] = np.einsum("nd,nd->n", plain_x[i[part]], plain_y[j[part]]) >= threshold
            yield i[exact], j[exact]


def _dealt(classes: DataFrame, directions: np.ndarray, threshold: float, n_classes: int) -> DataFrame:
    """``(node, n, unit, own, pair)``: every class once for each group that its own group has to be compared with."""
    wanted = max(-(-n_classes // GROUP), min(LEAST_GROUPS, -(-n_classes // SMALL_GROUP)))
    lead = classes.select("node", "unit").mapInArrow(_leads(directions), "node long, lead double")
    levels = [k / wanted for k in range(1, wanted)]
    found = lead.agg(F.percentile_approx("lead", levels, 10 * wanted + 100).alias("q")).first()["q"] if levels else []
    bounds = np.unique(np.array(found, float))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _leads(directions)(batches):
            at = np.searchsorted(bounds, batch.column(1).to_numpy(), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), batch.column(1)], names=["range", "lead"])

    spans = classes.select("node", "unit").mapInArrow(place, "range long, lead double")
    spans = spans.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("lo"), F.max("lead").alias("hi"))
    spans = spans.orderBy("range").toPandas()
    salts = np.ceil(spans["n"].to_numpy() / (2 * GROUP)).astype(np.int64)
    offset = np.concatenate([[0], np.cumsum(salts)])
    gap = np.sqrt(2 - 2 * threshold) + MARGIN
    first = np.searchsorted(spans["hi"].to_numpy(), spans["lo"].to_numpy() - gap, side="left")
    last = np.searchsorted(spans["lo"].to_numpy(), spans["hi"].to_numpy() + gap, side="right")
    order = {int(r): k for k, r in enumerate(spans["range"])}

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(batch.num_rows, -1)
            at = np.array([order[int(r)] for r in np.searchsorted(bounds, matrix @ directions[:, 0], side="left")], np.int64)
            node = batch.column(0).to_numpy().view(np.uint64)
            own = offset[at] + (node % salts[at].astype(np.uint64)).astype(np.int64)
            made = [pa.array(own), pa.array(offset[first[at]]), pa.array(offset[last[at]] - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=["node", "n", "unit", "own", "first", "last"])

    rows = classes.select("node", "n", "unit").mapInArrow(deal, "node long, n long, unit binary, own long, first long, last long")
    partner = F.explode(F.sequence("first", "last")).alias("other")
    pair = F.struct(F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).alias("pair")
    return rows.select("node", "n", "unit", "own", partner).select("node", "n", "unit", "own", pair)


def _leads(directions: np.ndarray):
    """A function from batches (node, unit) to (node, first component)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(matrix @ directions[:, 0])], names=["node", "lead"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors``.

    Equal unit vectors are one class, counted by size, so copies make no pairs. Classes are dealt into groups of
    about ``GROUP`` by ranges of their first principal component (a range that holds more is dealt on by hash);
    two groups are compared, in one task of bounded memory, only if their ranges are near enough to hold a pair. A
    task gives back the number of links per class and few links that connect the same classes, never all pairs.
    Vectors that are null, empty, zero, not finite, of a null component or of another length than most
    link with nothing. Repeated rows are copies of each other; a null vec_id links like any other.
    """
    sizes = vectors.where("embedding is not null").groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    widest = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    dims = widest["dims"] if widest is not None else 0
    units = stage(unit_vectors(vectors, dims), "units")
    usable = units.where("unit is not null")
    ids = F.coalesce(F.min("vec_id"), F.lit(0))
    classes = usable.groupBy("same").agg(ids.alias("rep"), F.count(F.lit(1)).alias("n"), F.min("unit").alias("unit"))
    classes = stage(classes.withColumn("node", F.xxhash64("same")), "classes")
    n_classes = classes.count()
    directions = components_of(classes, dims) if n_classes and dims else np.zeros((dims, dims))
    dealt = _dealt(classes, directions, threshold, n_classes) if n_classes and dims else classes.where("false").select(
        "node", "n", "unit", F.lit(0).cast("long").alias("own"), F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")).alias("pair")
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        plain = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(-1, dims)
        rotated = plain @ directions
        order = np.argsort(rotated[:, 0], kind="stable")
        low, high = rows["pair"].iloc[0]["low"], rows["pair"].iloc[0]["high"]
        own = rows["own"].to_numpy()
        left, right = order[own[order] == low], order[own[order] == high]
        size, node = rows["n"].to_numpy(np.int64), rows["node"].to_numpy(np.int64)
        count = np.zeros(len(rows), np.int64)
        ends_a, ends_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(left) and len(right):
            for i, j in compare(rotated[left], rotated[right], threshold, low == high, plain[left], plain[right]):
                p, q = left[i], right[j]
                np.add.at(count, p, size[q])
                np.add.at(count, q, size[p])
                a, b = forest(node[p], node[q])
                ends_a.append(a)
                ends_b.append(b)
        a, b = forest(np.concatenate(ends_a), np.concatenate(ends_b))
        some = np.flatnonzero(count)
        return pd.DataFrame({
            "node": np.concatenate([node[some], a]),
            "links": np.concatenate([count[some], np.zeros(len(a), np.int64)]),
            "other": pd.array([None] * len(some) + b.tolist(), "Int64"),
        })

    tasks = dealt.groupBy("pair").applyInPandas(run, "node long, links long, other long")
    found = stage(tasks, "near")
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("other is not null"), "node", "other")
    named = classes.select("same", "node", "rep", "n").join(counts, "node", "left").join(groups, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    named = stage(named, "named")
    lowest = stage(named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n_classes")), "lowest")
    links = (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    roots = stage(join_hot(named, lowest, "component", "n_classes").select("same", links, "component_id", "n"), "roots")
    linked = join_hot(usable.select("vec_id", "same"), roots, "same", "n").select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    alone = units.where("unit is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
