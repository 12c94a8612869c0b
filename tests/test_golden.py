"""Small inputs with values worked out independently."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.functions.metrics import format_metrics, metrics_long, prediction_summary, regression_metrics
from tideline.operators.clean import clean, drop_duplicates, impute_mean
from tideline.operators.encode import OneHot
from tideline.operators.features import FeatureModel, feature_pipeline
from tideline.operators.order import chronological_split, with_position
from tideline.operators.profile import (
    corr_matrix, corr_with_target, describe, duplicate_count, exact_quantiles, head, histogram, info, missing_report,
)
from tideline.operators.scale import Scaler, scaler_table
from tideline.operators.select import add_time_features, select_existing, split_xy
from tideline.operators.windows import build_windows, industrial_names
from tideline.spec import SeriesSpec, SplitSpec, WindowSpec

SPEC = SeriesSpec(order_by=("date",), target="OT", sensors=("A", "B"), time_col="date")
NAN = float("nan")


def values(df, *columns, order="date"):
    return [tuple(r[c] for c in columns) for r in df.orderBy(order).collect()]


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean(raw, exclude=("date",))


@pytest.fixture(scope="module")
def split(cleaned):
    return chronological_split(with_position(cleaned, SPEC))


def test_clean(raw, cleaned):
    assert drop_duplicates(raw).count() == 8
    a = [v[0] for v in values(cleaned, "A")]
    assert len(a) == 8
    assert a[2] == pytest.approx(33 / 7)


def test_nan_is_missing_and_an_empty_column_stays_empty(spark):
    df = spark.createDataFrame([(1.0, None, 1), (NAN, None, 2), (3.0, None, 3)], "x double, y double, k int")
    out = impute_mean(df, exclude=("k",)).orderBy("k").collect()
    assert [r.x for r in out] == [1.0, 2.0, 3.0]
    assert [r.y for r in out] == [None] * 3
    assert [r.k for r in out] == [1, 2, 3]


def test_means_per_group_and_from_chosen_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), ("b", 1, 5.0), ("b", 2, 7.0), ("b", 3, None), (None, 1, None), (None, 2, 9.0)],
        "k string, t int, x double",
    )
    by_group = {(r.k, r.t): r.x for r in impute_mean(df, ["x"], by=["k"]).collect()}
    assert by_group == {("a", 1): 1, ("a", 2): 1, ("b", 1): 5, ("b", 2): 7, ("b", 3): 6, (None, 1): 9, (None, 2): 9}
    first = {(r.k, r.t): r.x for r in impute_mean(df, ["x"], fit_on=F.col("t") == 1).collect()}
    assert first["b", 3] == 3.0


def test_split_of_the_small_table(split):
    assert values(split, "split", order="idx") == [("train",)] * 5 + [("val",)] + [("test",)] * 2
    assert values(split, "pos", "split_rows", order="idx") == (
        [(i, 5) for i in range(5)] + [(0, 1)] + [(0, 2), (1, 2)]
    )


@pytest.mark.parametrize("n, ends", [(90, (62, 76)), (170, (118, 144)), (180, (125, 153)), (17420, (12194, 14807))])
def test_split_ends_are_truncated_doubles(spark, n, ends):
    df = spark.range(n).select(F.col("id").alias("date"), F.col("id").alias("idx"), F.lit(n).cast("long").alias("n_rows"))
    counts = {r["split"]: r["count"] for r in chronological_split(df).groupBy("split").count().collect()}
    assert (counts["train"], counts["train"] + counts["val"]) == ends
    assert sum(counts.values()) == n


def test_split_ratios_must_add_up():
    with pytest.raises(ValueError):
        SplitSpec(0.7, 0.2, 0.2)


def test_calendar(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz '2016-07-01 00:00:00'), (timestamp_ntz '2016-07-02 06:00:00'),"
        " (timestamp_ntz '2016-07-03 18:00:00'), (timestamp_ntz '2016-12-05 12:00:00') as t(date)"
    )
    out = add_time_features(df, "date", keep=True)
    got = values(out, "day_of_week", "is_weekend", "hour_sin", "hour_cos", "month_sin", "month_cos")
    want = [
        (4, 0, 0, 1, -0.5, -0.866025), (5, 1, 1, 0, -0.5, -0.866025),
        (6, 1, -1, 0, -0.5, -0.866025), (0, 0, 0, -1, 0, 1),
    ]
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=1e-6)
    assert "date" not in add_time_features(df, "date").columns
    assert add_time_features(df, "absent").columns == df.columns


def test_projections(raw):
    x, y = split_xy(raw, "OT")
    assert x.columns == ["date", "A", "B"] and y.columns == ["OT"]
    with pytest.raises(KeyError):
        split_xy(raw, "absent")
    with pytest.warns(UserWarning):
        assert select_existing(raw, ["B", "absent", "A"]).columns == ["B", "A"]


def test_scaler(split):
    fitted = {r["column"]: r for r in scaler_table(split.where("split = 'train'"), ["A", "B", "OT"]).collect()}
    assert fitted["A"]["mean"] == pytest.approx(3.342857, abs=1e-6)
    assert fitted["A"]["scale"] == pytest.approx(1.571688, abs=1e-6)
    assert (fitted["B"]["mean"], fitted["OT"]["mean"]) == (18.0, 7.0)
    assert fitted["B"]["scale"] == pytest.approx(7.483315, abs=1e-6)
    assert fitted["OT"]["scale"] == pytest.approx(1.414214, abs=1e-6)


def test_scaler_traps(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0.1), (2.0, 5.0, 0.1), (4.0, 5.0, 0.1)], "x double, c double, d double")
    scaler = Scaler.fit(df)
    assert scaler.values["x"][1] == pytest.approx(1.247219, abs=1e-6)
    assert scaler.values["c"] == (5.0, 1.0)
    assert scaler.values["d"][1] == 1.0
    out = scaler.transform(df).collect()
    assert [r.c for r in out] == [0.0] * 3
    assert np.mean([r.x for r in out]) == pytest.approx(0) and np.std([r.x for r in out]) == pytest.approx(1)


def test_feature_model_restores_the_target(split):
    model = FeatureModel.fit(split.where("split = 'train'"), SPEC)
    scaled = model.transform(split)
    back = model.inverse_target(scaled, {"again": "OT"})
    assert [v[0] for v in values(back, "again", order="idx")] == pytest.approx([5, 6, 8, 7, 9, 10, 8, 11])
    plain = FeatureModel.fit(split, SPEC, scale_target=False)
    with pytest.raises(RuntimeError):
        plain.inverse_target(scaled, {"again": "OT"})


def test_feature_pipeline_flags(raw):
    fitted, scaler, encoder = feature_pipeline(raw, "date", ("A", "B"))
    assert encoder is None and fitted.columns[:3] == ["A", "B", "OT"]
    again, _, _ = feature_pipeline(raw, "date", ("A", "B"), scaler=scaler, fit_scaler=False)
    assert sorted(map(str, again.collect())) == sorted(map(str, fitted.collect()))
    with pytest.raises(ValueError):
        feature_pipeline(raw, "date", ("A",), fit_scaler=False)


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b", 10), (2, "a", 9), (3, "c", 100)], "k int, s string, n int")
    encoder = OneHot.fit(df, ["s", "n", "absent"])
    assert encoder.output_columns == ["s_b", "s_c", "n_10", "n_100"]
    out = encoder.transform(df)
    assert out.columns == ["k", "s_b", "s_c", "n_10", "n_100"]
    assert values(out, "s_b", "s_c", "n_10", "n_100", order="k") == [(1, 0, 1, 0), (0, 0, 0, 0), (0, 1, 0, 1)]


def test_one_hot_unseen_and_missing(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    other = spark.createDataFrame([("z",)], "s string")
    assert OneHot.fit(train, ["s"]).output_columns == ["s_b", "s_nan"]
    with pytest.raises(Exception, match="unseen category in s: z"):
        OneHot.fit(train, ["s"]).transform(other).collect()
    ignored = OneHot.fit(train, ["s"], unseen="ignore").transform(other).first()
    assert tuple(ignored) == (0.0, 0.0)


GOLDEN_WINDOWS = [
    # A_mean, A_std, A_max, A_min, A_t-1, A_t, y absolute, y delta, baseline
    (2.571429, 1.569263, 4.714286, 1, 2, 4.714286, 7, -1, 8),
    (3.571429, 1.148794, 4.714286, 2, 4.714286, 4, 9, 2, 7),
    (4.571429, 0.420560, 5, 4, 4, 5, 10, 1, 9),
    (5.000000, 0.816497, 6, 4, 5, 6, 8, -2, 10),
    (6.000000, 0.816497, 7, 5, 6, 7, 11, 3, 8),
]
FEATURES = ("A_mean", "A_std", "A_max", "A_min", "A_t-1", "A_t")


@pytest.mark.parametrize("strategy, chunk", [("single", None), ("ranged", 2), ("ranged", 3), ("ranged", 100)])
@pytest.mark.parametrize("mode", ["absolute", "delta"])
def test_industrial_windows(cleaned, strategy, chunk, mode):
    placed = with_position(cleaned, SPEC, strategy)
    out = build_windows(placed, SPEC, WindowSpec(3, 1, 1, mode), strategy, chunk_rows=chunk)
    rows = out.orderBy("idx").collect()
    assert [r["idx"] for r in rows] == [2, 3, 4, 5, 6]
    for row, want in zip(rows, GOLDEN_WINDOWS):
        assert [row[f] for f in FEATURES] == pytest.approx(want[:6], abs=1e-6)
        assert row["y"] == pytest.approx([want[7] if mode == "delta" else want[6]])
        assert row["baseline"] == want[8]


@pytest.mark.parametrize("strategy, chunk", [("single", None), ("ranged", 3)])
def test_horizon_and_step(cleaned, strategy, chunk):
    placed = with_position(cleaned, SPEC, strategy)
    two = build_windows(placed, SPEC, WindowSpec(3, 2), strategy, chunk_rows=chunk).orderBy("idx").collect()
    assert [(r["y"], r["baseline"]) for r in two] == [([-1, 1], 8), ([2, 3], 7), ([1, -1], 9), ([-2, 1], 10)]
    stepped = build_windows(placed, SPEC, WindowSpec(3, 1, 2), strategy, chunk_rows=chunk)
    assert [r["idx"] for r in stepped.orderBy("idx").collect()] == [2, 4, 6]


@pytest.mark.parametrize("strategy, chunk", [("single", None), ("ranged", 3)])
def test_flat_windows(cleaned, strategy, chunk):
    placed = with_position(cleaned, SPEC, strategy)
    window = WindowSpec(3, feature_mode="flat", target_mode="absolute")
    rows = build_windows(placed, SPEC, window, strategy, chunk_rows=chunk).orderBy("idx").collect()
    assert len(rows) == 5
    assert rows[0]["x"] == pytest.approx([1, 10, 2, 20, 33 / 7, 10])
    assert rows[4]["x"] == pytest.approx([5, 20, 6, 10, 7, 40])


@pytest.mark.parametrize("strategy, chunk", [("single", None), ("ranged", 3)])
def test_future_windows(cleaned, strategy, chunk):
    placed = with_position(cleaned, SPEC, strategy)
    rows = build_windows(placed, SPEC, WindowSpec(3), strategy, chunk, include_future=True).orderBy("idx").collect()
    assert [r["idx"] for r in rows] == [2, 3, 4, 5, 6, 7]
    assert rows[-1]["y"] == [None] and rows[-1]["baseline"] == 11


def test_window_edges(cleaned, raw):
    placed = with_position(cleaned, SPEC)
    assert build_windows(placed, SPEC, WindowSpec(8, 1)).count() == 0
    with pytest.raises(ValueError):
        WindowSpec(target_mode="ratio")
    with pytest.raises(ValueError):
        WindowSpec(feature_mode="wide")
    with pytest.raises(ValueError):
        WindowSpec(size=1)
    with pytest.raises(KeyError):
        build_windows(placed.drop("A"), SPEC, WindowSpec(3))
    gap = build_windows(with_position(drop_duplicates(raw), SPEC), SPEC, WindowSpec(3)).orderBy("idx").collect()
    assert gap[0]["A_mean"] is None and gap[3]["A_mean"] == pytest.approx(5)


def test_feature_names_are_in_code_point_order():
    names = industrial_names(("HUFL",), ("hour_sin", "day_of_week"))
    assert names == ["HUFL_max", "HUFL_mean", "HUFL_min", "HUFL_std", "HUFL_t", "HUFL_t-1", "day_of_week", "hour_sin"]
    assert len(industrial_names([f"s{i}" for i in range(6)], SPEC.time_columns)) == 42


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.5), (2.0, 1.0), (4.0, 5.0)], "y double, p double")
    m = regression_metrics(df, "y", "p").first()
    want = {"MSE": 0.5625, "RMSE": 0.75, "MAE": 0.625, "R2": 0.742857, "MAPE": 41.666667, "SMAPE": 42.962963}
    for name, value in want.items():
        assert m[name] == pytest.approx(value, abs=1e-6)
    assert m["n_samples"] == 4
    texts = format_metrics(regression_metrics(df, "y", "p")).first()
    assert texts["MSE"] == "0.5625" and texts["MAPE"] == "41.6667"
    long = {r["metric"]: r["value"] for r in metrics_long(regression_metrics(df, "y", "p")).collect()}
    assert set(long) == set(want)


@pytest.mark.parametrize(
    "pairs, r2", [([(3.0, 3.0), (3.0, 3.0)], 1.0), ([(3.0, 3.0), (3.0, 4.0)], 0.0), ([(3.0, 3.0)], NAN)]
)
def test_r2_of_constant_actuals(spark, pairs, r2):
    m = regression_metrics(spark.createDataFrame(pairs, "y double, p double"), "y", "p").first()
    assert m["R2"] == r2 or (math.isnan(r2) and math.isnan(m["R2"]))


def test_percentages_without_a_usable_row(spark):
    zeros = regression_metrics(spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "y double, p double"), "y", "p")
    row = zeros.first()
    assert math.isnan(row["MAPE"]) and math.isnan(row["SMAPE"])
    assert format_metrics(zeros).first()["MAPE"] == "N/A"


def test_prediction_summary(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "p double")
    row = prediction_summary(df, "p").first()
    assert (row["mean"], row["min"], row["max"]) == (pytest.approx(7 / 3), 1.0, 4.0)
    assert row["std"] == pytest.approx(1.247219, abs=1e-6)


@pytest.mark.parametrize("method", ["single", "narrowing"])
def test_describe(spark, method):
    df = spark.createDataFrame([(float(v), None) for v in (1, 2, 3, 4, 10)], "x double, e double")
    x, empty = describe(df, method=method).orderBy(F.desc("column")).collect()
    assert (x["count"], x["mean"], x["min"], x["q25"], x["q50"], x["q75"], x["max"]) == (5, 4, 1, 2, 3, 4, 10)
    assert x["std"] == pytest.approx(3.535534, abs=1e-6)
    assert empty["count"] == 0 and empty["q50"] is None


def test_quantiles_against_numpy(spark):
    rng = np.random.default_rng(7)
    data = np.concatenate([rng.lognormal(0, 4, 3000), np.full(2000, 1.5), [0.0, -1e300, 1e300, 5e-324]])
    df = spark.createDataFrame([(float(v),) for v in data], "x double")
    probabilities = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, ["x"], probabilities)["x"]
    ordered = np.sort(data)
    for p, q in zip(probabilities, got):
        at = p * (len(data) - 1)
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(data) - 1)]
        assert q == low + (high - low) * (at - int(at))


def test_quantiles_with_infinite_ends(spark):
    df = spark.createDataFrame([(v,) for v in (-math.inf, 1.0, 2.0, 3.0, math.inf)], "x double")
    assert exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"] == [1.0, 2.0, 3.0]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v), 7.0, None) for v in (1, 2, 2, 3, 10)] + [(None, 7.0, None)], "x double, c double, e double")
    rows = histogram(df, bins=3).orderBy("column", "bin").collect()
    by_column = {c: [(r["lower"], r["upper"], r["count"]) for r in rows if r["column"] == c] for c in ("x", "c", "e")}
    assert by_column["x"] == [(1, 4, 4), (4, 7, 0), (7, 10, 1)]
    assert [n for _, _, n in by_column["c"]] == [0, 6, 0]
    assert by_column["c"][0][0] == 6.5 and by_column["c"][2][1] == 7.5
    assert by_column["e"] == []


def test_profiles(spark, raw):
    counts = {r["column"]: (r["dtype"], r["non_null"], r["n_rows"]) for r in info(raw).collect()}
    assert counts["A"] == ("double", 8, 9) and counts["date"] == ("timestamp_ntz", 9, 9)
    assert [tuple(r) for r in missing_report(raw).collect()] == [("A", 1, pytest.approx(100 / 9))]
    assert duplicate_count(raw).first()["duplicates"] == 1
    assert [r["B"] for r in head(raw, ["date"], 2).collect()] == [10.0, 20.0]


def test_correlation_of_many_columns(spark):
    def made(n):
        return spark.range(40).select(*[((F.col("id") * (k + 3) % 17) + F.rand(k)).alias(f"c{k}") for k in range(n)])

    wide = made(60)
    assert corr_matrix(made(150)).count() == 22_500
    frame = wide.toPandas().corr()
    found = corr_matrix(wide).collect()
    assert len(found) == 3600
    assert all(p["r"] == pytest.approx(frame.loc[p["a"], p["b"]], abs=1e-9) for p in found)
    by_target = {p["column"]: p["abs_r"] for p in corr_with_target(wide, "c9").collect()}
    assert by_target == {c: pytest.approx(abs(frame.loc[c, "c9"]), abs=1e-9) for c in frame.columns if c != "c9"}


def test_correlations(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=50)
    y = x + rng.normal(size=50)
    rows = [(float(a), float(b) if i % 5 else None, 1.0) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, c double")
    keep = np.arange(50) % 5 != 0
    want = np.corrcoef(x[keep], y[keep])[0, 1]
    r = {(p["a"], p["b"]): p["r"] for p in corr_matrix(df).collect()}
    assert r["x", "y"] == pytest.approx(want) and r["y", "x"] == pytest.approx(want) and r["x", "x"] == pytest.approx(1)
    assert r["x", "c"] is None
    ranked = [(p["column"], p["abs_r"]) for p in corr_with_target(df, "x").collect()]
    assert ranked == [("y", pytest.approx(abs(want))), ("c", None)]


def test_missing_flat_readings_are_nan_for_the_trees(spark):
    from tideline.operators.models import FEATURES, as_vectors

    frame = spark.createDataFrame([([1.0, None, 3.0],), ([None, None, None],)], "x array<double>")
    first, second = (r[FEATURES].toArray() for r in as_vectors(frame, None).collect())
    assert first[0] == 1.0 and math.isnan(first[1]) and all(map(math.isnan, second))


def test_unknown_model_parameters_are_an_error():
    from tideline.operators.models import DEFAULTS, merged_params

    assert merged_params("xgboost", {"max_depth": 3})["max_depth"] == 3
    assert DEFAULTS["gbt_absolute"]["colsample_bylevel"] == 0.8
    with pytest.raises(ValueError, match="learning_rat"):
        merged_params("xgboost", {"learning_rat": 0.5})


def test_text_cells_keep_their_blanks(spark, tmp_path):
    from tideline.sources.tables import read_csv

    (tmp_path / "a.csv").write_text('name,k\n" a", 1\n  ,2\n"NA ",3\nb ,4\n')
    rows = {r["k"]: r["name"] for r in read_csv(spark, str(tmp_path)).collect()}
    assert rows[1] == " a" and rows[2] is None and rows[3] is None


def test_many_categories_have_places_without_a_cap(spark):
    from tideline.operators.encode import OneHot, category_places, with_place

    frame = spark.range(6_000).selectExpr("case when id = 5999 then null else concat('c', lpad(id, 5, '0')) end as c")
    assert len(OneHot.fit(frame, ["c"]).output_columns) == 5_999
    places = {r["c"]: r["place"] for r in with_place(frame, "c", category_places(frame, "c")).collect()}
    assert places["c00000"] == 0 and places["c05998"] == 5_998 and places[None] == 5_999
    other = spark.createDataFrame([("new",)], "c string")
    assert with_place(other, "c", category_places(frame, "c"), unseen="ignore").first()["place"] is None
    with pytest.raises(Exception, match="unseen category"):
        with_place(other, "c", category_places(frame, "c")).collect()
