"""Vector codes: product quantization in integers by Lloyd rounds that compare moved entries only.

A vector is cut into equal parts, and every part position has a codebook of few entries. In each round a part whose
assigned entry did not move still knows its exact distance, and every entry that did not move is as far as before, so
only the moved entries are compared with the stored distance. Parts whose entry moved are compared with all entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import join_hot, slices
from tideline.session import drop_staged, stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Components from here on would pass 64 bits once squared and added up.
MOST = 2.0**14
STATE = "vec_id long, label string, whole binary, codes binary, distances binary"


@dataclass(frozen=True)
class Codebooks:
    """Entries as integers, ``entries[p]`` (entry, place in part) for part ``p``; bounds of the parts in a vector."""

    entries: tuple[np.ndarray, ...]
    cuts: tuple[int, ...]

    def digest(self) -> str:
        """Hex SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
        flat = (str(x) for part in self.entries for x in part.ravel().tolist())
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def part_bounds(dims: int, parts: int) -> tuple[int, ...]:
    """Bounds of consecutive parts; equal ones if ``parts`` divides ``dims``."""
    return tuple(dims * p // parts for p in range(parts + 1))


def whole_numbers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """``floor(4096 * x)`` of the usable rows of a list column, and which rows they are."""
    places, rows = [], []
    for k, value in enumerate(column.to_pylist()):
        if value is None or len(value) != dims or any(x is None for x in value):
            continue
        vector = np.array(value, np.float64)
        if np.isfinite(vector).all():
            places.append(k)
            rows.append(vector)
    matrix = np.array(rows, np.float64).reshape(len(rows), dims)
    if matrix.size and np.abs(matrix).max() >= MOST:
        raise ValueError(f"a component of a vector is not below {MOST:.0f} in size")
    return np.floor(matrix * SCALE).astype(np.int32), np.array(places, np.int64)


def distances_to(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances (rows x entries), exact in 64 bits."""
    out = np.empty((len(part), len(entries)), np.int64)
    for k, entry in enumerate(entries):
        apart = part - entry
        out[:, k] = (apart * apart).sum(axis=1)
    return out


def rescanned(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row, the lowest index among equals, and its distance."""
    every = distances_to(part, entries)
    code = every.argmin(axis=1)
    return code, every[np.arange(len(part)), code]


def reassigned(part: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray):
    """Nearest entries after a round in which the entries ``moved`` (indexes) changed, from those before it.

    A row whose entry stayed compares its stored distance with the moved entries; at equal distance the lower
    index wins, and no entry that stayed can win over the one it lost to before. The others are scanned anew.
    """
    code, distance = code.copy(), distance.copy()
    lost = np.isin(code, moved)
    if lost.any():
        code[lost], distance[lost] = rescanned(part[lost], entries)
    stayed = np.flatnonzero(~lost)
    if len(stayed) and len(moved):
        every = distances_to(part[stayed], entries[moved])
        best = every.argmin(axis=1)
        near, index = every[np.arange(len(stayed)), best], moved[best]
        old, old_index = distance[stayed], code[stayed]
        wins = (near < old) | ((near == old) & (index < old_index))
        code[stayed[wins]], distance[stayed[wins]] = index[wins], near[wins]
    return code, distance


def _fixed(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _blobs(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix)
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def _assigned(state: DataFrame, books: Codebooks, moved: list[np.ndarray] | None) -> DataFrame:
    """The state with new codes and distances; ``moved`` has the moved entries of each part, None at first."""
    shared = state.sparkSession.sparkContext.broadcast((books, moved))
    dims, parts = books.cuts[-1], len(books.entries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, moves = shared.value
        for batch in slices(batches, 4_096):
            whole = _fixed(batch.column(2), np.int32, dims).astype(np.int64)
            codes, distances = np.empty((len(whole), parts), np.uint8), np.empty((len(whole), parts), np.int64)
            if moves is not None:
                codes[:], distances[:] = _fixed(batch.column(3), np.uint8, parts), _fixed(batch.column(4), np.int64, parts)
            for p, entries in enumerate(known.entries):
                part = whole[:, known.cuts[p] : known.cuts[p + 1]]
                if moves is None:
                    codes[:, p], distances[:, p] = rescanned(part, entries)
                else:
                    codes[:, p], distances[:, p] = reassigned(part, entries, moves[p], codes[:, p].astype(np.int64), distances[:, p])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _blobs(codes), _blobs(distances)], names=["vec_id", "label", "whole", "codes", "distances"]
            )

    return state.mapInArrow(run, STATE)


def _averaged(state: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floored mean of its parts; entries without parts stay.

    Tasks add up their own parts; one sum per entry and place is what comes to the driver, whatever the table's size.
    """
    dims, parts, cuts = books.cuts[-1], len(books.entries), books.cuts
    n_entries = len(books.entries[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((n_entries, dims), np.int64), np.zeros((n_entries, parts), np.int64)
        for batch in slices(batches, 4_096):
            whole, codes = _fixed(batch.column(0), np.int32, dims), _fixed(batch.column(1), np.uint8, parts)
            for p in range(parts):
                counts[:, p] += np.bincount(codes[:, p], minlength=n_entries)
                for e in range(n_entries):
                    sums[e, cuts[p] : cuts[p + 1]] += whole[codes[:, p] == e, cuts[p] : cuts[p + 1]].sum(axis=0, dtype=np.int64)
        cells = np.concatenate([sums.ravel(), counts.ravel()])
        some = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(cells[some])], names=["cell", "s"])

    added = state.select("whole", "codes").mapInArrow(run, "cell long, s long").groupBy("cell").agg(F.sum("s").alias("s")).toPandas()
    cells = np.zeros(n_entries * (dims + parts), np.int64)
    cells[added["cell"].to_numpy(np.int64)] = added["s"].to_numpy(np.int64)
    sums, counts = cells[: n_entries * dims].reshape(n_entries, dims), cells[n_entries * dims :].reshape(n_entries, parts)
    new = []
    for p, entries in enumerate(books.entries):
        n = counts[:, p : p + 1]
        new.append(np.where(n > 0, sums[:, cuts[p] : cuts[p + 1]] // np.maximum(n, 1), entries))
    return Codebooks(tuple(new), cuts)


def fitted(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, DataFrame]:
    """Codebooks after ``rounds`` rounds and the state of every usable row: its integers, codes and distances.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``. Rows whose vector is null, holds null or non-finite
    components, or has another length than most usable rows (the longer at a tie) are not in the state. The first
    codebooks are the parts of the rows of the smallest ids (equal ids by their integers, null ids last); of fewer
    rows than ``entries`` there are so many entries. Only one state is kept: each round writes the next and
    removes the one before.
    """
    widths = vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    widths = widths.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    widest = widths.orderBy(F.desc("n"), F.desc("dims")).first()
    dims = widest["dims"] if widest is not None else 0
    cuts = part_bounds(dims, parts)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4_096):
            whole, places = whole_numbers(batch.column(2), dims)
            kept = batch.select([0, 1]).take(pa.array(places))
            none = pa.nulls(len(places), pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, _blobs(whole), none, none], names=["vec_id", "label", "whole", "codes", "distances"])

    given = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>").alias("embedding"))
    state = stage(given.mapInArrow(read, STATE), "codes")
    named = state.select("vec_id").where("vec_id is not null").orderBy("vec_id").limit(entries)
    last = named.agg(F.max("vec_id").alias("top"), F.count("vec_id").alias("n")).first()
    low = state.where(F.col("vec_id") <= last["top"]) if last["n"] == entries else state
    rows = low.select("vec_id", _numbers(F.col("whole"), dims).alias("numbers")).orderBy(F.asc_nulls_last("vec_id"), "numbers").limit(entries).collect()
    start = np.array([r["numbers"] for r in rows], np.int64)
    start = start.reshape(len(start), dims)
    books = Codebooks(tuple(start[:, cuts[p] : cuts[p + 1]] for p in range(parts)), cuts)
    if len(start) == 0 or dims == 0:
        return books, state
    moved = None
    for k in range(rounds + 1):
        following = stage(_assigned(state, books, moved), "codes")
        drop_staged(state)
        state = following
        if k < rounds:
            new = _averaged(state, books)
            moved = [np.flatnonzero((a != b).any(axis=1)) for a, b in zip(books.entries, new.entries)]
            books = new
    return books, state


def _numbers(whole, dims: int):
    """The integers in a binary column of little-endian 32-bit integers, as an array that sorts by number."""
    if dims == 0:
        return F.array().cast("array<long>")
    at = F.sequence(F.lit(0), F.lit(dims - 1))
    byte = lambda k, j: F.conv(F.hex(F.substring(whole, k * 4 + j + 1, F.lit(1))), 16, 10).cast("long")
    unsigned = lambda k: byte(k, 0) + byte(k, 1) * 256 + byte(k, 2) * 65536 + byte(k, 3) * 16777216
    return F.transform(at, lambda k: F.when(unsigned(k) >= 1 << 31, unsigned(k) - (1 << 32)).otherwise(unsigned(k)))


def encoded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every usable row; see ``fitted``.

    ``code`` has two hex digits a part, ``error`` the squared distances of its parts to their entries, added up, and
    ``label_error`` the errors of all rows of its label, null labels together. Repeated rows give one row each.
    An empty table, or one without usable rows, gives no rows. Other columns are ignored.
    """
    books, state = fitted(vectors, parts, entries, rounds)
    dims = books.cuts[-1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4_096):
            code = pa.array([c.hex() for c in batch.column(2).to_pylist()], pa.string())
            error = pa.array(_fixed(batch.column(3), np.int64, parts).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code, error], names=["vec_id", "mark", "code", "error"])

    empty = len(books.entries[0]) == 0
    mark = F.when(F.col("label").isNotNull(), F.concat(F.lit("="), F.col("label"))).otherwise(F.lit("null")).alias("mark")
    source = state.where(F.lit(not empty)).select("vec_id", mark, "codes", "distances")
    rows = source.mapInArrow(run, "vec_id long, mark string, code string, error long")
    if dims == 0 and not empty:
        rows = source.select("vec_id", "mark", F.lit("00" * parts).alias("code"), F.lit(0).cast("long").alias("error"))
    sums = stage(rows.groupBy("mark").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "labels")
    out = join_hot(rows, sums, "mark", "n")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
