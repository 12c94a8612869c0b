"""Rolling statistics put together from blocks are those of sliding frames, and lags are the cells of flat windows."""

import re

import pytest
from pyspark.sql import functions as F

from tideline.operators import windows
from tideline.operators.order import chronological_split, with_position
from tideline.operators.windows import build_windows
from tideline.spec import SeriesSpec, WindowSpec

SPEC = SeriesSpec(order_by=("t",), target="OT", sensors=("A", "B"), series_keys=("s",))


@pytest.fixture(scope="module")
def split(spark):
    """Three series of different lengths with gaps, an offset far from zero and repeated values."""
    rows = spark.range(900).select(
        (F.col("id") % 3).alias("s"), F.col("id").alias("t"),
        F.when(F.rand(1) < 0.97, 1e6 + F.randn(2)).alias("A"), F.floor(F.rand(3) * 4).cast("double").alias("B"), F.rand(4).alias("OT"),
    ).where("s > 0 or t < 120")
    return chronological_split(with_position(rows, SPEC, "ranged")).cache()


@pytest.mark.parametrize("size", [2, 3, 7, 50, 64])
@pytest.mark.parametrize("strategy, chunk", [("single", None), ("ranged", 40), ("ranged", None)])
def test_blocks_equal_frames(split, monkeypatch, size, strategy, chunk):
    def rows(blocks_from):
        monkeypatch.setattr(windows, "BLOCKS_FROM", blocks_from)
        made = build_windows(split, SPEC, WindowSpec(size, 2, 3), strategy, chunk, include_future=True)
        return made.orderBy("s", "split", "idx").collect()

    blocks, frames = rows(2), rows(10**9)
    assert len(blocks) == len(frames) and blocks[0].__fields__ == frames[0].__fields__ if frames else not blocks
    for one, two in zip(blocks, frames):
        for name in one.__fields__:
            if name.endswith(("mean", "std")) and two[name] is not None:
                assert one[name] == pytest.approx(two[name], rel=1e-9, abs=1e-6)
            else:
                assert one[name] == two[name], name


def test_whole_table_without_split(spark, monkeypatch):
    frame = spark.range(300).select(F.lit(1).alias("s"), F.col("id").alias("t"), F.rand(1).alias("A"), F.rand(2).alias("B"), F.rand(3).alias("OT"))
    frame = with_position(frame, SPEC, "ranged")
    found = []
    for blocks_from in (2, 10**9):
        monkeypatch.setattr(windows, "BLOCKS_FROM", blocks_from)
        found.append(build_windows(frame, SPEC, WindowSpec(60), "single").orderBy("idx").select("A_max", "A_min", "A_t-1", F.round("B_mean", 9), F.round("B_std", 9)).collect())
    assert found[0] == found[1] and len(found[0]) == 240


FLAT = SeriesSpec(order_by=("t",), target="OT", sensors=("A", "B", "C"), series_keys=("s",))


@pytest.fixture(scope="module")
def flat_split(spark):
    """Series of 9,000 rows, more than a window buffers in memory, of 30 rows, too short for a window, and without a key; with gaps."""
    rows = spark.range(10_000).select(
        F.when(F.col("id") < 9000, 1).when(F.col("id") < 9030, 2).cast("int").alias("s"), F.col("id").alias("t"),
        F.when(F.rand(1) < 0.9, F.randn(2)).alias("A"), F.floor(F.rand(3) * 4).cast("int").alias("B"), F.lit(None).cast("double").alias("C"), F.rand(4).alias("OT"),
    )
    return chronological_split(with_position(rows, FLAT, "single")).cache()


@pytest.mark.parametrize("size", [1, 24])
@pytest.mark.parametrize("strategy, chunk", [("single", None), ("ranged", 40)])
def test_lags_equal_collected_cells(flat_split, monkeypatch, size, strategy, chunk):
    def made(most):
        monkeypatch.setattr(windows, "MOST_LAGS", most)
        return build_windows(flat_split, FLAT, WindowSpec(size, 2, 3, feature_mode="flat"), strategy, chunk, include_future=True)

    lags, collected = made(512), made(0)
    assert lags.dtypes == collected.dtypes and lags.count() == collected.count() > 2000
    assert lags.exceptAll(collected).isEmpty()
    assert lags.where(F.size("x") != 3 * size).isEmpty() and not lags.where("s is null").isEmpty()


def test_cells_are_read_by_compiled_code(spark, flat_split):
    """The JVM interprets methods of more than 8,000 bytes, so the code that reads all cells of a window must stay below."""
    frame = build_windows(flat_split, FLAT, WindowSpec(24, feature_mode="flat"), "single")
    cells = frame.select("s", "split", "idx", *[F.col("x")[k].alias(f"x_{k}") for k in range(72)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(cells._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000, sizes
