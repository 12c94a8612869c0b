"""SimHash fingerprints and their near-duplicate groups by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import join_hot, slices
from tideline.llm.components import connected_components
from tideline.session import stage

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
TO_LOWER = bytes.maketrans(UPPER, LOWER)
ROWS_PER_STEP = 4_096


def fingerprint(text: str | None, size: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the ``size``-word shingles; 0 if there is no word."""
    words = (text or "").encode().translate(TO_LOWER).split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-size] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())), np.uint64, len(starts)
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), ROWS_PER_STEP):
        part = hashes[at : at + ROWS_PER_STEP].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` holds the 64 bits as a signed integer."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bits = [fingerprint(t, size) for t in batch.column(1).to_pylist()]
            signed = np.array(bits, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of so few segments that ``distance`` flips leave one with at most one of them."""
    count = distance // 2 + 1
    edges = [round(64 * k / count) for k in range(count + 1)]
    return list(zip(edges, np.diff(edges).tolist()))


def _mask(bits: int, without: int | None = None) -> Column:
    """The lowest ``bits`` bits set but for one, as a signed 64-bit literal."""
    value = ((1 << bits) - 1) & ~(0 if without is None else 1 << without)
    return F.lit(value - (1 << 64) if value >> 63 else value)


def _segment(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(_mask(bits))


def fingerprint_links(fps: DataFrame, distance: int = 4, group_col: str | None = None) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints of at most ``distance`` differing bits, each once.

    ``fps`` has one row per fingerprint in column ``fp``. Two linked fingerprints have a segment in which
    they differ by nothing (they meet under that segment's exact key) or in one bit (they meet under the
    key of the segment with this bit as wildcard, one with the bit unset, one with it set). Both joins are
    equality joins; a met pair is verified on all 64 bits and kept by its first such segment only. They are
    merge joins at any size: the planner takes the exploded index for as small as ``fps`` and would broadcast it.
    With ``group_col`` only links between different groups are given, and keys met by one group alone take no part.
    """
    cut = segments(distance)
    fp = F.col("fp")
    exact, wild = [], []
    for s, (first, bits) in enumerate(cut):
        part = _segment(fp, first, bits)
        exact.append(F.struct(F.lit(s * 65).alias("kind"), part.alias("rest"), F.lit(2).alias("bit")))
        for j in range(bits):
            bit = F.shiftrightunsigned(fp, first + j).bitwiseAND(F.lit(1)).cast("int")
            rest = part.bitwiseAND(_mask(bits, j))
            wild.append(F.struct(F.lit(s * 65 + 1 + j).alias("kind"), rest.alias("rest"), bit.alias("bit")))
    group = F.lit(0) if group_col is None else F.col(group_col)
    index = fps.select("fp", group.alias("group"), F.explode(F.array(*exact, *wild)).alias("key")).select("fp", "group", "key.*")
    if group_col is not None:
        met = Window.partitionBy("kind", "rest")
        index = index.withColumns({"lo": F.min("group").over(met), "hi": F.max("group").over(met)}).where("lo < hi")
    a = index.where("bit != 1").select("kind", "rest", "group", F.col("fp").alias("a"))
    b = index.where("bit != 0").select("kind", "rest", "group", F.col("fp").alias("b"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    here = F.floor(F.col("l.kind") / 65)
    first_met = F.lit(len(cut))
    for s in reversed(range(len(cut))):
        first_met = F.when(F.bit_count(_segment(apart, *cut[s])) <= 1, s).otherwise(first_met)
    ordered = (F.col("l.kind") % 65 != 0) | (F.col("a") < F.col("b"))
    if group_col is not None:
        ordered = ordered & (F.col("l.group") != F.col("r.group"))
    return (
        a.alias("l")
        .join(
            b.alias("r").hint("merge"),
            (F.col("l.kind") == F.col("r.kind"))
            & (F.col("l.rest") == F.col("r.rest"))
            & (F.bit_count(apart) <= distance)
            & ordered
            & (first_met == here),
        )
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, distance: int = 4, size: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row: documents linked by near fingerprints, transitively.

    Rows of equal fingerprint are one class (its smallest id stands for it), so copies never make pairs.
    Null and empty texts have fingerprint zero and link like any other; a null id stays a row, never names
    a component unless all its members are null; repeated ids give one row each. Other columns are ignored.
    Fingerprints and components that hold much of the table are joined by broadcast, see ``join_hot``.
    """
    marks = stage(with_fingerprint(docs, size, id_col, text_col), "fingerprints")
    n_rows = F.count(F.lit(1))
    classes = stage(marks.groupBy("fp").agg(F.min(id_col).alias("rep"), n_rows.alias("n")), "classes")
    links = fingerprint_links(classes.select("fp"), distance)
    groups = connected_components(links, "a", "b")
    named = classes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", "n", F.coalesce("component", "fp").alias("component")
    )
    named = stage(named, "named")
    lowest = stage(named.groupBy("component").agg(F.min("rep").alias("component_id"), n_rows.alias("n_fps")), "lowest")
    roots = stage(join_hot(named, lowest, "component", "n_fps").select("fp", "component_id", "n"), "roots")
    return join_hot(marks, roots, "fp", "n").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
