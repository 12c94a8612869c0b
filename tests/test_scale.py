"""What must hold for large and skewed input: equal paths, whole results, sound plans."""

from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.operators import order as order_module
from tideline.operators.clean import clean, drop_duplicates
from tideline.operators.features import FeatureModel
from tideline.operators.order import choose_strategy, chronological_split, series_sizes, with_position
from tideline.operators.scale import Scaler
from tideline.operators.windows import build_windows
from tideline.plans.training import clean_series, prepare_split
from tideline.session import new_path, staging
from tideline.sources.tables import read_csv
from tideline.spec import RunConfig, SeriesSpec, WindowSpec

SPEC = SeriesSpec(order_by=("t", "k"), target="y", sensors=("a", "y"), series_keys=("s",))


@pytest.fixture(scope="module")
def skewed(spark):
    """One series holds half of all rows; one key is NULL; the rows come unordered."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).when(F.col("id") % 31 == 1, F.lit(None)).otherwise(F.col("id") % 7 + 1).alias("s"),
        (F.col("id") * 7919 % 1009).alias("t"),
        F.col("id").alias("k"),
        F.rand(1).alias("a"),
        F.round(F.rand(2) * 100, 2).alias("y"),
    )
    return base.orderBy(F.rand(5)).cache()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_ranged_positions_equal_single(skewed):
    columns = ("s", "t", "k", "idx", "n_rows")
    single = rows(with_position(skewed, SPEC, "single"), *columns)
    assert single == rows(with_position(skewed, SPEC, "ranged", long_rows=0), *columns)
    assert len(single) == 3000


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    size=st.integers(2, 30), horizon=st.integers(1, 5), step=st.integers(1, 7), chunk=st.integers(1, 400),
    mode=st.sampled_from(["absolute", "delta"]), split=st.booleans(),
)
def test_ranged_windows_equal_single(skewed, size, horizon, step, chunk, mode, split):
    window = WindowSpec(size, horizon, step, mode)
    placed = with_position(skewed, SPEC, "single")
    placed = chronological_split(placed) if split else placed
    columns = ["s", "idx", "a_max", "a_min", "a_t", "`a_t-1`", "baseline", "y"] + (["split"] if split else [])
    rounded = [F.round(f"{c}_{k}", 9).alias(f"{c}{k}") for c in ("a", "y") for k in ("mean", "std")]
    single = rows(build_windows(placed, SPEC, window, "single"), *columns, *rounded)
    assert single == rows(build_windows(placed, SPEC, window, "ranged", chunk), *columns, *rounded)
    labels = ["s", "split"] if split else ["s"]
    lengths = [r["count"] for r in placed.groupBy(*labels).count().collect()]
    assert len(single) == sum(max(0, (n - size - horizon) // step + 1) for n in lengths)


def test_auto_weighs_the_longest_series(skewed, monkeypatch):
    assert series_sizes(skewed, ("s",)) == (1500, 3000) and series_sizes(skewed, ()) == (3000, 3000)
    assert choose_strategy(skewed, SPEC) == "single"
    monkeypatch.setattr(order_module, "SMALL_SERIES_ROWS", 1499)
    assert choose_strategy(skewed, SPEC) == "ranged"  # half of the table in one series
    monkeypatch.setattr(order_module, "BALANCE", 2)
    assert choose_strategy(skewed, SPEC) == "single"
    monkeypatch.setattr(order_module, "SINGLE_TASK_ROWS", 1499)
    assert choose_strategy(skewed, SPEC) == "ranged"
    with pytest.raises(ValueError):
        choose_strategy(skewed, SPEC, "fast")


def test_the_ranged_path_never_gathers_a_series(skewed):
    """No frame is grouped by the series alone, and nothing big goes to one partition."""
    placed = chronological_split(with_position(skewed, SPEC, "ranged", long_rows=0))
    text = plan(build_windows(placed, SPEC, WindowSpec(5), "ranged", chunk_rows=50))
    assert "Exchange SinglePartition" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    exchanges = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 1 and "_chunk" in exchanges[0]


def test_one_shuffle_from_cleaning_to_windows(skewed):
    strategy = "single"
    cleaned = clean_series(skewed, SPEC, strategy)
    windows = build_windows(chronological_split(with_position(cleaned, SPEC, strategy)), SPEC, WindowSpec(5), strategy)
    main = plan(windows).split("===== Subqueries =====")[0]
    exchanges = [line for line in main.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 1, exchanges


def test_hot_copies_collapse_before_the_shuffle(spark):
    copies = spark.range(1000).select(F.lit(1).alias("x"), F.lit("same").alias("s"))
    other = spark.range(500).select(F.col("id").cast("int").alias("x"), F.lit("own").alias("s"))
    out = drop_duplicates(copies.union(other))
    assert out.count() == 501
    assert plan(out).count("HashAggregate (") >= 2  # partial, then final


def test_cleaning_twice_changes_nothing(skewed):
    once = clean(skewed, exclude=SPEC.reserved)
    assert rows(once, "s", "k", "a", "y") == rows(clean(once, exclude=SPEC.reserved), "s", "k", "a", "y")


def test_row_order_of_the_input_does_not_matter(skewed):
    other = skewed.orderBy("a").repartition(3)
    columns = ("s", "k", "split", "pos")
    assert rows(chronological_split(with_position(skewed, SPEC)), *columns) == rows(
        chronological_split(with_position(other, SPEC)), *columns
    )


def test_test_rows_do_not_reach_the_parameters(skewed):
    split = chronological_split(with_position(skewed, SPEC)).cache()
    shifted = split.withColumn("a", F.when(F.col("split") == "test", F.col("a") + 1000).otherwise(F.col("a")))
    train = F.col("split") == "train"
    first, second = FeatureModel.fit(split.where(train), SPEC), FeatureModel.fit(shifted.where(train), SPEC)
    for column, fitted in first.scaler.values.items():
        assert second.scaler.values[column] == pytest.approx(fitted)


def test_parameters_per_series(skewed):
    scaler = Scaler.fit(skewed, ["a", "y"], by=["s"])
    stats = scaler.transform(skewed).groupBy("s").agg(
        F.avg("a").alias("m"), F.stddev_pop("a").alias("d"), F.count("*").alias("n")
    )
    found = stats.collect()
    assert sum(r["n"] for r in found) == 3000 and len(found) == 9
    for r in found:
        assert (r["m"], r["d"]) == (pytest.approx(0, abs=1e-9), pytest.approx(1))


def test_split_table_is_pruned_and_filtered_at_the_scan(skewed):
    split = prepare_split(skewed, RunConfig(SPEC), "single")
    text = plan(split.where(F.col("split") == "train").agg(F.avg("a")))
    assert "PushedFilters: [IsNotNull(split), EqualTo(split,train)]" in text
    assert "ReadSchema: struct<a:double,split:string>" in text


def test_row_steps_work_on_a_stream(spark, skewed, tmp_path):
    """Scaling and calendar columns are row-wise, so a stream can pass through them."""
    spec = SeriesSpec(order_by=("ts",), target="y", sensors=("a",), time_col="ts")
    with_ts = skewed.withColumn("ts", F.timestamp_seconds("k").cast("timestamp_ntz")).select("ts", "a", "y")
    model = FeatureModel.fit(with_ts, spec)
    with_ts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(with_ts.schema).parquet(str(tmp_path / "in"))
    query = (
        model.transform(stream).writeStream.format("memory").queryName("scaled").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.awaitTermination(60)
    columns = ("a", "y", "hour_sin", "day_of_week")
    assert rows(spark.table("scaled"), *columns) == rows(model.transform(with_ts), *columns)


def test_long_series_alone_are_sorted_by_range(skewed):
    """One series of half the rows takes the ranged path, the others (one of them without a key) one shuffle."""
    placed = with_position(skewed, SPEC, "ranged", long_rows=1000)
    columns = ("s", "t", "k", "idx", "n_rows")
    assert rows(placed, *columns) == rows(with_position(skewed, SPEC, "single"), *columns)
    text = plan(placed)
    assert "hashpartitioning" not in text and "Window" not in text  # both parts are written


def test_building_a_plan_starts_no_job(spark, skewed):
    placed = chronological_split(with_position(skewed, SPEC, "single"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    try:
        build_windows(placed, SPEC, WindowSpec(5))
        assert len(tracker.getJobIdsForGroup("plan-only")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_staged_tables_are_removed(spark, skewed):
    with staging(spark) as folder:
        n = with_position(skewed, SPEC, "ranged", long_rows=1000).count()
        assert n == 3000 and Path(folder.removeprefix("file:")).is_dir()
    assert not Path(folder.removeprefix("file:")).exists()
    assert folder not in new_path(spark, "next")


def test_csv_as_it_stands(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.csv").write_text('k,note,ok\n2,"one\ntwo",True\n1," x ",false\n')
    (path / "b.csv").write_text("k,note,ok\n0,z,TRUE\n")
    found = read_csv(spark, str(path), multiline=True, file_order="place").orderBy("place")
    assert [tuple(r)[:3] for r in found.collect()] == [(2, "one\ntwo", True), (1, " x ", False), (0, "z", True)]
    (path / "b.csv").write_text("note,k,ok\nz,0,TRUE\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), found.drop("place").schema, multiline=True).collect()
    (path / "b.csv").write_text("k,note,ok\n0,z\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(path), found.drop("place").schema, multiline=True).collect()
