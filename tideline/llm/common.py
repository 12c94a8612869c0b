"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import stage

BROADCAST_ROWS = 1_000_000
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """``crc32(doc_id as text) mod 5``; rows of fold 0, and rows without an id, are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def below_share(key: Column, salt: str, share: Column | float) -> Column:
    """True for a fixed pseudo-random ``share`` of the rows, chosen by their key alone."""
    unit = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 40)) / float(1 << 40)
    return unit < share


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[where[0] : where[-1]], where - where[0]


def modest(df: DataFrame) -> DataFrame:
    """``df``, after its session hands at most 8 MB and 2,000 rows at a time to Python, unless other bounds than Spark's were set.

    Texts and sets may be long, and Spark's own bounds are 64 MB on either side of every task. For the same reason
    files are read 512 rows at a time: a column of 4,096 texts is one large array of the heap, made anew as it grows.
    """
    conf = df.sparkSession.conf
    if conf.get(READ_ROWS, "4096") == "4096":
        conf.set(READ_ROWS, "512")
    for name, given, wanted in (("maxBytesPerBatch", "67108864b", "8m"), ("maxRecordsPerBatch", "10000", "2000")):
        if conf.get(f"spark.sql.execution.arrow.{name}", given) == given:
            conf.set(f"spark.sql.execution.arrow.{name}", wanted)
    return df


def give_back() -> None:
    """Hands memory that is free but kept for later back to the system; Spark keeps idle workers, which need it no more."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than GNU's
        pass


def slices(batches: Iterable[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that Python holds few whole texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def join_hot(rows: DataFrame, small: DataFrame, key: str, count_col: str, share: int = 1_000) -> DataFrame:
    """Inner join of ``rows`` with ``small``, which has each key once and the number of its ``rows`` in ``count_col``.

    Keys that hold more than one in ``share`` of all rows are fewer than ``share``: they are broadcast, so that
    their rows stay where they are. All other rows are joined by a shuffle. ``count_col`` is not in the result.
    """
    total = small.agg(F.sum(count_col)).first()[0] or 0
    hot = small.where(F.col(count_col) * share > total).drop(count_col)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(small.drop(count_col), key))


def text_class(text_col: str) -> Column:
    """A class of equal texts, as 64 bits; a null is an empty text."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def one_of_each(docs: DataFrame, node: Column, named: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` that stay; ``named`` has the component of linked nodes."""
    marks = docs.select(F.col(f"`{id_col}`").alias("id"), node.alias("node"))
    marks = stage(marks.where("id is not null").groupBy("id", "node").agg(F.count(F.lit(1)).alias("n")), "marks")
    lowest = marks.groupBy("node").agg(F.min("id").alias("id")).join(named, "node", "left")
    lowest = lowest.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min(F.struct("id", "node")).alias("first"))
    first = stage(lowest.select("first.*"), "first")
    repeated = stage(marks.where("n > 1").join(first, ["id", "node"], "left_semi").select("id", "node"), "repeated")
    gone = stage(marks.join(first, ["id", "node"], "left_anti").select("id", "node").unionByName(repeated), "gone")
    small = gone.count() <= BROADCAST_ROWS
    side = F.broadcast(gone) if small else gone
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("__row"), F.col(f"`{id_col}`").alias("id"), node.alias("node"))
    one = rows.join(F.broadcast(repeated) if small else repeated, ["id", "node"], "left_semi")
    one = one.groupBy("id", "node").agg(F.min("__row").alias("__row")).select("__row.*")
    return rows.join(side, ["id", "node"], "left_anti").select("__row.*").unionByName(one)


def crc_fold(doc_id: int | None) -> int:
    """``fold`` of one id, for tests."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


class Memory(dict):
    """Answers given so far; it starts anew when it holds ``most``, and never keeps keys over ``longest``."""

    def __init__(self, answer: Callable, most: int, longest: int | None = None):
        super().__init__()
        self.answer, self.most, self.longest = answer, most, longest

    def __missing__(self, key):
        value = self.answer(key)
        if self.longest is None or len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


_held: dict = {}


def held(mark, build: Callable):
    """The object of this mark, built once per Python worker; a worker holds one at a time, whatever task it runs."""
    if mark not in _held:
        _held.clear()
        give_back()
        _held[mark] = build()
    return _held[mark]
