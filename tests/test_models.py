"""Training, storage, scoring, search and reports."""

import math

import pytest
from pyspark.sql import functions as F

from tideline.operators import models
from tideline.operators.models import (
    best_round, feature_importance, fit_step, make_estimator, merged_params, model_kind, with_label,
)
from tideline.plans import reports, tuning
from tideline.plans.scoring import evaluate, persistence, predict
from tideline.plans.training import load_run, prepare_samples, prepare_split, run_training, train_samples
from tideline.sources.artifacts import save_models
from tideline.sources.runs import history_table, importance_table, metrics_table, read_runs, run_frame, trials_only
from tideline.sources.tables import read_csv, series_schema, write_csv
from tideline.functions.metrics import METRICS, regression_metrics
from tideline.spec import RunConfig, SeriesSpec, WindowSpec

SPEC = SeriesSpec(order_by=("date",), target="OT", sensors=("A", "B"), time_col="date")
SMALL = {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 4, "min_child_weight": 1, "reg_alpha": 0, "reg_lambda": 0}


@pytest.fixture(scope="module")
def seasonal(spark):
    """400 hours of a daily cycle seen through two sensors."""
    hour = F.col("id").cast("int")
    angle = F.col("id") * (2 * math.pi / 24)
    return spark.range(400).select(
        (F.lit("2016-07-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)).alias("date"),
        F.sin(angle).alias("A"),
        (F.cos(angle) + F.rand(1) * 0.05).alias("B"),
        (20 + 8 * F.sin(angle + 0.4) + F.rand(2) * 0.3).alias("OT"),
    ).cache()


@pytest.fixture(scope="module")
def config():
    return RunConfig(SPEC, WindowSpec(size=6), model_kind="gbt_squared", model_params=SMALL)


@pytest.fixture(scope="module")
def stored(spark, seasonal, config, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    runs = str(tmp_path_factory.mktemp("runs") / "table")
    return run_training(spark, seasonal, config, "first", f"{folder}/run", runs), f"{folder}/run", runs


def test_kinds_and_parameters(spark):
    assert model_kind("xgboost") == "boosted_absolute" and model_kind("lightgbm") == "boosted_squared"
    with pytest.raises(ValueError):
        model_kind("forest")
    merged = merged_params("lightgbm", {"max_depth": 7})
    assert merged["max_depth"] == 7 and merged["n_estimators"] == 1000 and merged["num_leaves"] == 31
    with pytest.warns(UserWarning, match="reg_alpha"):
        estimator = make_estimator("gbt_absolute", {"reg_alpha": 0.5})
    assert (estimator.getLossType(), estimator.getMaxIter(), estimator.getStepSize()) == ("absolute", 1000, 0.01)
    assert (estimator.getMaxDepth(), estimator.getSubsamplingRate(), estimator.getMinInstancesPerNode()) == (5, 0.7, 5)
    assert make_estimator("gbt_squared", {"max_depth": 8, "num_leaves": 15}).getMaxDepth() == 4


@pytest.mark.parametrize(
    "history, patience, want",
    [([3, 2, 1], 2, (3, 3)), ([3, 1, 2, 2, 0], 2, (2, 4)), ([3, 1, 2, 2, 0], None, (5, 5)), ([1, 1, 1], 5, (1, 3)), ([2], 1, (1, 1))],
)
def test_best_round(history, patience, want):
    assert best_round(history, patience) == want


def test_training_beats_persistence(spark, seasonal, config, stored):
    run, _, _ = stored
    samples = prepare_samples(seasonal, config)
    same = regression_metrics(
        run.features.inverse_target(persistence(samples.windows), {"prediction": "prediction", "actual": "actual"}),
        "actual", "prediction", ["split"],
    ).collect()
    for row in same:
        assert run.record["samples"][row["split"]] == row["n_samples"]
        assert run.record["metrics"][row["split"]]["RMSE"] < row["RMSE"]
    assert run.record["feature_count"] == len(run.names) == 6 * 2 + 6
    assert run.record["rows"] == {"train": 280, "val": 60, "test": 60}
    assert run.record["eval_metric"] == "mae" and len(run.record["eval_history"][0]) <= 6
    assert sum(run.record["importances"].values()) == pytest.approx(1)


def test_early_stopping_keeps_the_best_prefix(spark, seasonal, config):
    samples = prepare_samples(seasonal, config)
    train = with_label(samples.windows.where("split = 'train'"), 1)
    val = with_label(samples.windows.where("split = 'val'"), 1)
    params = {**SMALL, "learning_rate": 1.0, "n_estimators": 8, "early_stopping_rounds": 1}
    fitted = fit_step(train, val, samples.names, "gbt_squared", params)
    assert fitted.best_round == fitted.trees.getNumTrees
    assert fitted.history[fitted.best_round - 1] == min(fitted.history)
    free = fit_step(train, None, samples.names, "gbt_squared", params)
    assert free.best_round is None and free.trees.getNumTrees == 8
    texts = [[t.toDebugString.split("depth=", 1)[1] for t in m.trees.trees] for m in (free, fitted)]
    assert texts[0][: fitted.best_round] == texts[1]


def test_early_stopping_stops(spark, seasonal, config, monkeypatch):
    """Blocks of rounds are fitted until the stop lies inside, far from the limit, with the result of one long fit."""
    samples = prepare_samples(seasonal, config)
    train = with_label(samples.windows.where("split = 'train'"), 1)
    val = with_label(samples.windows.where("split = 'val'"), 1)
    params = {**SMALL, "learning_rate": 1.0, "n_estimators": 40, "early_stopping_rounds": 2}
    whole = fit_step(train, val, samples.names, "gbt_squared", params)
    fits = []
    make = models.make_estimator

    def counted(*args):
        estimator = make(*args)
        copy = estimator.copy
        estimator.copy = lambda extra: fits.append(extra[estimator.maxIter]) or copy(extra)
        return estimator

    monkeypatch.setattr(models, "make_estimator", counted)
    monkeypatch.setattr(models, "FIRST_ROUNDS", 2)
    fitted = fit_step(train, val, samples.names, "gbt_squared", params)
    assert (fitted.best_round, fitted.history) == (whole.best_round, whole.history)
    assert fits[0] == 2 and all(b == 2 * a for a, b in zip(fits[:-2], fits[1:-1]))
    assert sum(fits) <= 4 * (fitted.best_round + 2) + fitted.best_round < 40


def test_rounds_are_compared_by_the_named_error(spark, seasonal, config):
    samples = prepare_samples(seasonal, config)
    train = with_label(samples.windows.where("split = 'train'"), 1)
    val = with_label(samples.windows.where("split = 'val'"), 1)
    params = {**SMALL, "n_estimators": 3, "early_stopping_rounds": 0}
    mse, rmse = (fit_step(train, val, samples.names, "gbt_squared", {**params, "eval_metric": m}).history for m in ("mse", "rmse"))
    assert [x**0.5 for x in mse] == pytest.approx(rmse) and len(mse) == 3
    with pytest.raises(ValueError, match="eval_metric"):
        merged_params("lightgbm", {"eval_metric": "auc"})


def test_stored_run_predicts_the_same(spark, seasonal, stored):
    run, path, _ = stored
    again = load_run(spark, path)
    assert again.config == run.config and again.names == run.names
    first, second = (predict(seasonal, r).orderBy("idx").collect() for r in (run, again))
    assert first == second and len(first) == 400 - 6
    actual = [r["OT"] for r in seasonal.orderBy("date").collect()]
    assert [r["actual"] for r in first] == pytest.approx(actual[6:])
    future = predict(seasonal, run, include_future=True).orderBy("idx").collect()
    assert len(future) == 395 and future[-1]["actual"] is None and future[-1]["prediction"] is not None


def test_evaluation_is_recorded(spark, seasonal, stored):
    run, _, runs = stored
    metrics = evaluate(spark, seasonal, run, "check", runs).first()
    assert metrics["n_samples"] == 394
    found = {r["run_name"]: r for r in read_runs(spark, runs).collect()}
    assert found["check"]["metrics"]["all"]["RMSE"] == pytest.approx(metrics["RMSE"])
    assert found["first"]["status"] == "success" and found["first"]["created_at"] is not None
    assert set(found["first"]["metrics"]) == {"train", "val", "test"}


def test_two_steps_ahead_flat_and_absolute(spark, seasonal):
    window = WindowSpec(4, 2, feature_mode="flat", target_mode="absolute")
    config = RunConfig(SPEC, window, model_kind="gbt_absolute", model_params={**SMALL, "n_estimators": 2})
    run = run_training(spark, seasonal, config, "flat")
    assert len(run.models) == 2 and run.record["feature_count"] == 4 * 8
    rows = predict(seasonal, run).orderBy("idx", "step").collect()
    assert len(rows) == 2 * (400 - 4 - 1)
    actual = [r["OT"] for r in seasonal.orderBy("date").collect()]
    assert [r["actual"] for r in rows if r["step"] == 2] == pytest.approx(actual[5:])
    dates = [r["date"] for r in seasonal.orderBy("date").collect()]
    assert [r["target_time"] for r in rows if r["step"] == 2] == dates[5:]


def test_per_series_parameters_in_a_run(spark, seasonal, tmp_path):
    both = seasonal.withColumn("s", F.lit(1)).union(
        seasonal.select("date", "A", "B", (F.col("OT") * 100).alias("OT"), F.lit(2).alias("s"))
    )
    spec = SeriesSpec(order_by=("date",), target="OT", sensors=("A", "B"), series_keys=("s",), time_col="date")
    config = RunConfig(spec, WindowSpec(6), model_kind="gbt_squared", model_params=SMALL, per_series=True)
    run = run_training(spark, both, config, "two", str(tmp_path / "run"))
    rows = predict(both, load_run(spark, str(tmp_path / "run"))).groupBy("s").agg(F.avg("actual").alias("m"), F.count("*").alias("n"))
    means = {r["s"]: (r["m"], r["n"]) for r in rows.collect()}
    assert means[1][1] == means[2][1] == 394
    assert means[2][0] == pytest.approx(100 * means[1][0])
    assert run.record["samples"]["train"] == 2 * (280 - 6)


def test_gaps_filled_from_training_rows_only(spark, seasonal):
    late = seasonal.withColumn("A", F.when(F.col("date") < "2016-07-02", F.col("A") * 0 + 1).when(F.col("A") > 0.9, F.col("A") * 100))
    config = RunConfig(SPEC, WindowSpec(6), impute_on="train")
    split = prepare_split(late, config, "single")
    train = split.where("split = 'train'").join(late.select("date", F.col("A").alias("given")), "date")
    mean = train.agg(F.avg("given")).first()[0]
    filled = split.join(late.where("A is null").select("date"), "date").select("A").distinct().collect()
    assert [r["A"] for r in filled] == [pytest.approx(mean)]
    assert split.count() == 400
    with pytest.raises(ValueError):
        RunConfig(SPEC, impute_on="test")


def test_no_validation_rows_no_early_stopping(spark, seasonal, config):
    from tideline.spec import SplitSpec

    bare = RunConfig(SPEC, WindowSpec(6), SplitSpec(0.8, 0.0, 0.2), "gbt_squared", {**SMALL, "n_estimators": 2})
    run = run_training(spark, seasonal, bare, "bare")
    assert run.record["eval_history"] is None and set(run.record["metrics"]) == {"train", "test"}


def test_too_few_rows_is_a_clear_error(spark, seasonal, config):
    with pytest.raises(ValueError, match="no training windows"):
        run_training(spark, seasonal.where("date < timestamp_ntz '2016-07-01 05:00:00'"), config, "short")


def test_unfitted_is_an_error(spark):
    with pytest.raises(RuntimeError):
        feature_importance(spark, None, [])
    with pytest.raises(RuntimeError):
        save_models([], "unused")


def test_grid_table(spark):
    grid = tuning.grid_table(spark, tuning.GRIDS["gbt_absolute"]).orderBy("run_idx").collect()
    assert len(grid) == 64 and [r["run_idx"] for r in grid] == list(range(64))
    assert grid[0]["run_name"] == "grid_000_lr001_d3_mcw3_ne500_ra01_rl10"
    assert (grid[1]["reg_lambda"], grid[0]["reg_lambda"], grid[32]["max_depth"]) == (5.0, 1.0, 5)
    assert tuning.grid_table(spark, tuning.GRIDS["gbt_squared"]).count() == 256
    assert tuning.grid_table(spark, tuning.GRIDS["gbt_squared"], max_trials=10).count() == 10
    small = tuning.grid_table(spark, {"learning_rate": [0.0001, 2.0]}).orderBy("run_idx").collect()
    assert [r["run_name"] for r in small] == ["grid_000_lr00001", "grid_001_lr20"]


def test_random_table(spark):
    ranges = tuning.RANGES["gbt_absolute"]
    first, again = (tuning.random_table(spark, ranges, 200, seed=3).orderBy("run_idx").collect() for _ in range(2))
    assert first == again and len(first) == 200
    for name, spec in ranges.items():
        drawn = [r[name] for r in first]
        assert spec["low"] <= min(drawn) and max(drawn) <= spec["high"]
        if spec["type"] == "int" and spec["high"] < 20:
            assert set(drawn) == set(range(spec["low"], spec["high"] + 1))
    assert tuning.random_table(spark, ranges, 200, seed=4).orderBy("run_idx").collect() != first
    with pytest.raises(ValueError):
        tuning.random_table(spark, {"x": {"type": "text", "low": 0, "high": 1}}, 1)


def test_trials_comparison_and_reports(spark, seasonal, config, tmp_path):
    samples = prepare_samples(seasonal, config)
    trials = tuning.grid_table(spark, {"n_estimators": [2, 6], "max_depth": [4, -1]})
    runs = tuning.run_trials(spark, samples, trials, runs_path=str(tmp_path / "runs"))
    rows = {r["run_idx"]: r for r in runs.collect()}
    assert [rows[i]["status"] for i in range(4)] == ["success", "failed", "success", "failed"]
    assert rows[1]["error"] and rows[1]["metrics"] is None

    stored_runs = read_runs(spark, str(tmp_path / "runs"))
    assert trials_only(stored_runs).count() == 2
    values = {i: rows[i]["metrics"]["val"]["RMSE"] for i in (0, 2)}
    best = min(values, key=values.get)
    assert tuning.best_run(stored_runs).first()["run_idx"] == best
    summary = tuning.compare(stored_runs).first()
    assert summary["best_run"] == rows[best]["run_name"]
    assert summary["best_metric_value"] == pytest.approx(values[best])
    assert (summary["total_trials"], summary["completed_trials"], summary["failed_trials"]) == (4, 2, 2)
    _, direct = train_samples(samples, {"n_estimators": 2, "max_depth": 4})
    assert direct["metrics"]["val"]["RMSE"] == pytest.approx(values[0])

    ranked = reports.with_rank(reports.rank_trials(metrics_table(stored_runs), "RMSE", "val"), "RMSE").orderBy("rank")
    assert [r["run_name"] for r in ranked.collect()][0] == rows[best]["run_name"]
    matrix = reports.comparison_matrix(metrics_table(stored_runs))
    assert matrix.columns == ["run_name", *METRICS] and matrix.count() == 2
    assert reports.comparison_matrix(metrics_table(stored_runs), names=reports.COMPARED).columns[1:] == list(reports.COMPARED)
    points = reports.param_points(trials_only(stored_runs), params=["n_estimators"]).collect()
    assert sorted(p["setting"] for p in points) == ["2", "6"]
    history = history_table(stored_runs)
    assert history.where("run_name like '%ne6'").count() == 6
    rounds = {r["run_name"]: r["best_round"] for r in reports.best_rounds(history).collect()}
    assert rounds[rows[2]["run_name"]] == rows[2]["best_rounds"][0]
    top = reports.top_features(importance_table(stored_runs.where(F.col("run_idx") == 2)), 3).collect()
    assert len(top) == 3 and top[0]["importance"] >= top[1]["importance"]


def test_trials_of_equal_effect_are_fitted_once_and_the_best_one_predicts(spark, seasonal, config, tmp_path, monkeypatch):
    fits = []
    monkeypatch.setattr(tuning, "train_samples", lambda *a: fits.append(a) or train_samples(*a))
    samples = prepare_samples(seasonal, config)
    trials = tuning.grid_table(spark, {"n_estimators": [2, 3], "reg_lambda": [0.0, 1.0]})
    runs_path, models_dir = str(tmp_path / "runs"), str(tmp_path / "models")
    rows = tuning.run_trials(spark, samples, trials, runs_path=runs_path, models_dir=models_dir).collect()
    assert len(fits) == 2 and [r["run_idx"] for r in rows] == [0, 1, 2, 3]
    assert sorted((r["params"]["n_estimators"], r["params"]["reg_lambda"]) for r in rows) == [
        ("2", "0.0"), ("2", "1.0"), ("3", "0.0"), ("3", "1.0")
    ]
    stored_runs = read_runs(spark, runs_path)
    assert stored_runs.count() == 4
    best = load_run(spark, f"{models_dir}/{tuning.best_run(stored_runs).first()['run_name']}")
    assert predict(seasonal, best).where("prediction is not null").count() > 0


def test_validation_stands_in_for_a_missing_test_metric(spark):
    given = [("a", "test", "RMSE", 2.0), ("a", "val", "RMSE", 1.0), ("b", "val", "RMSE", 1.5), ("c", "train", "RMSE", 0.1)]
    long = spark.createDataFrame(given, "run_name string, split string, metric string, value double")
    ranked = reports.rank_trials(reports.test_or_val(long), "RMSE").collect()
    assert [tuple(r) for r in ranked] == [("b", 1.5), ("a", 2.0)]


def test_comparison_without_a_usable_run(spark):
    runs = run_frame(spark, [{"run_name": "grid_000", "run_idx": 0, "status": "failed", "error": "x"}])
    row = tuning.compare(runs).first()
    assert row["best_run"] is None and row["failed_trials"] == 1


def test_csv_with_missing_cells(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("extra,OT,date,A,B\nx,1.5,2016-07-01 00:00:00,NA,2\ny,nan,2016-07-01 01:00:00,3,\n")
    rows = read_csv(spark, str(folder), series_schema(SPEC)).orderBy("date").collect()
    assert [tuple(r)[1:] for r in rows] == [(None, 2.0, 1.5), (3.0, None, None)]
    inferred = read_csv(spark, str(folder)).orderBy("date")
    assert dict(inferred.dtypes) == {"extra": "string", "OT": "double", "date": "string", "A": "double", "B": "double"}
    assert [r["A"] for r in inferred.collect()] == [None, 3.0]
    (folder / "a.csv").write_text("k,x\n1,2.5\n2,-3\n")
    whole = read_csv(spark, str(folder))
    assert dict(whole.dtypes) == {"k": "bigint", "x": "double"} and whole.agg(F.sum("k")).first()[0] == 3
    (folder / "a.csv").write_text("date,A,B,OT\n2016-07-01 00:00:00,abc,2,3\n")
    with pytest.raises(Exception, match="abc"):
        read_csv(spark, str(folder), series_schema(SPEC)).collect()
    with pytest.raises(KeyError):
        read_csv(spark, str(folder), series_schema(SeriesSpec(("date",), "OT", ("A", "Z"), time_col="date")))
    back = read_csv(spark, str(folder))
    write_csv(back, str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out")).collect() == back.collect()
