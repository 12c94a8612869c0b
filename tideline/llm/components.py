"""Connected components of a link table by alternating stars, all in DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import stage


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node) that connect what the links ``a``-``b`` connect, at most one per node."""
    if len(a) == 0:
        return a[:0], b[:0]
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        node, low = forest(batch["u"].to_numpy(), batch["v"].to_numpy())
        yield pd.DataFrame({"u": node, "v": low})


def _star(links: DataFrame, small: bool) -> DataFrame:
    """One star step on links ``u > v``: neighbours move to the smallest one they share."""
    if small:
        sides = links
    else:
        sides = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = sides.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
    met = sides.join(low, "u")
    if small:
        moved = met.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v"))
        )
    else:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.where("u > v").distinct()


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` of every node that has a link to another; component is the smallest node reached.

    Large and small stars alternate until the links are stars themselves; every step is written to the
    shared folder, so lineage stays short and a lost executor costs one step. A link with a null end or
    of a node to itself is no link. No links give an empty table. Nodes are 64-bit integers.
    """
    u, v = F.greatest(left, right).cast("long"), F.least(left, right).cast("long")
    clean = links.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    now = stage(
        clean.select(u.alias("u"), v.alias("v")).mapInPandas(_local, "u long, v long").distinct(), "links"
    )
    mark = None
    while True:
        step = stage(_star(_star(now, small=False), small=True), "stars")
        new = tuple(step.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if new == mark:
            break
        now, mark = step, new
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
