"""Trees grown round by round against brute force in plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.operators import boosting
from tideline.operators.boosting import Binned, BoostedModel, Booster, bin_windows, binned_values
from tideline.operators.models import fit_boosted, merged_params
from tideline.plans.scoring import predict
from tideline.plans.training import load_run, prepare_samples, run_training
from tideline.plans import tuning
from tideline.sources.runs import run_frame, step_importance_table
from tideline.spec import RunConfig, SeriesSpec, WindowSpec

PLAIN = {
    "max_depth": 3, "learning_rate": 0.3, "n_estimators": 4, "min_child_weight": 1, "subsample": 1.0, "colsample_bytree": 1.0,
    "colsample_bylevel": 1.0, "reg_alpha": 0.0, "reg_lambda": 0.0, "early_stopping_rounds": 0, "num_leaves": None,
}


def made_up(n=400, seed=1, gaps=True):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.random(n) < 0.3]).astype(float)
    y = 2 * (x[:, 0] > 0.3) + x[:, 1] * x[:, 2] + 0.1 * rng.normal(size=n)
    if gaps:
        x[rng.random(x.shape) < 0.1] = np.nan
    return x, y


def windows_of(spark, x, y, n_val=80):
    rows = [
        ("val" if k < n_val else "train", [float(v)], *[None if math.isnan(u) else float(u) for u in r])
        for k, (r, v) in enumerate(zip(x, y))
    ]
    return spark.createDataFrame(rows, "split string, y array<double>, a double, b double, c double")


@pytest.fixture(scope="module")
def binned(spark):
    x, y = made_up()
    return bin_windows(windows_of(spark, x, y), ("a", "b", "c"), 16), x, y


def soft(g, alpha):
    return math.copysign(max(abs(g) - alpha, 0.0), g)


class SlowTree:
    """A tree by trying every split of every leaf, rows as index arrays."""

    def __init__(self, bins, grad, left, p, loss):
        self.splits = {}
        worth = lambda ix: soft(grad[ix].sum(), p["reg_alpha"]) ** 2 / (len(ix) + p["reg_lambda"])

        def best(ix):
            out = None
            for missing_left in (False, True):
                for f in range(bins.shape[1]):
                    for cut in range(1, int(bins[:, f].max()) + 1):
                        go = np.where(bins[ix, f] == 0, missing_left, bins[ix, f] <= cut)
                        l, r = ix[go], ix[~go]
                        if min(len(l), len(r)) < p["min_child_weight"] or (missing_left and not (bins[ix, f] == 0).any()):
                            continue
                        gain = worth(l) + worth(r) - worth(ix)
                        if gain > 1e-9 and (out is None or gain > out[0] + 1e-9):
                            out = (gain, l, r)
            return out

        leaves = {"": np.arange(len(bins))}
        most, deep = p.get("num_leaves") or 10**9, p["max_depth"]
        while len(leaves) < most:
            options = [(best(ix), path) for path, ix in leaves.items() if deep < 0 or len(path) < deep]
            options = sorted((-o[0], path, o) for o, path in options if o)
            if not options:
                break
            for _, path, (_, l, r) in options[: 1 if p.get("num_leaves") else None]:
                del leaves[path]
                leaves[path + "L"], leaves[path + "R"] = l, r
        self.n_leaves = len(leaves)
        self.add = np.zeros(len(bins))
        for ix in leaves.values():
            value = soft(grad[ix].sum(), p["reg_alpha"]) / (len(ix) + p["reg_lambda"]) if loss == "squared" else np.median(left[ix])
            self.add[ix] = p["learning_rate"] * value


def slow_fit(bins, y, p, loss, rounds):
    now = np.full(len(y), y.mean() if loss == "squared" else np.median(y))
    leaves = []
    for _ in range(rounds):
        left = y - now
        tree = SlowTree(bins, left if loss == "squared" else np.sign(left), left, p, loss)
        now = now + tree.add
        leaves.append(tree.n_leaves)
    return now, leaves


@pytest.mark.parametrize("loss", ["squared", "absolute"])
@pytest.mark.parametrize("changes", [{}, {"reg_alpha": 3.0, "reg_lambda": 5.0, "min_child_weight": 7}, {"num_leaves": 6, "max_depth": -1}, {"max_depth": 1}, {"max_depth": 0}])
def test_trees_equal_brute_force(spark, binned, loss, changes):
    table, x, y = binned
    p = {**PLAIN, **changes}
    model, history, best = Booster(table, 1, loss, p, 7, use_val=False).fit()
    bins = binned_values(x[80:], table.cuts)
    want, leaves = slow_fit(bins, y[80:], p, loss, 4)
    assert [t.n_leaves for t in model.trees] == leaves and (history, best) == ([], None)
    assert np.allclose(model.predicted(x[80:]), want, atol=1e-6)
    if p["num_leaves"]:
        assert all(t.n_leaves == 6 for t in model.trees)


def test_frame_predictions_and_store(spark, binned, tmp_path):
    table, x, y = binned
    model, _, _ = Booster(table, 1, "squared", PLAIN, 7).fit()
    frame = windows_of(spark, x, y)
    rows = [r["prediction"] for r in model.transform(frame).collect()]
    assert np.allclose(rows, model.predicted(x))
    model.save(spark, str(tmp_path / "m"))
    again = BoostedModel.load(spark, str(tmp_path / "m"))
    assert np.array_equal(again.predicted(x), model.predicted(x)) and again.importances() == model.importances()
    assert sum(model.importances()) == pytest.approx(1)


def test_early_stopping_fits_every_round_once(spark, binned):
    """Rounds fitted are the best one and the patience; the history is that of a fit without a stop."""
    table, x, y = binned
    p = {**PLAIN, "n_estimators": 60, "learning_rate": 0.9, "early_stopping_rounds": 4}
    counted = Binned(table.table, table.names, table.cuts, table.flat)
    booster = Booster(counted, 1, "squared", p, 7)
    model, history, best = booster.fit("absolute")
    assert len(booster.trees) == len(history) == best + 4 < 60 and len(model.trees) == best
    assert best == int(np.argmin(history)) + 1
    assert len(counted.passes) <= (best + 4) * 3 + 1  # three levels a round, and the last error
    free, whole, _ = Booster(table, 1, "squared", {**p, "early_stopping_rounds": 0, "n_estimators": best + 4}, 7).fit("absolute")
    assert whole == history
    assert history[-1] == pytest.approx(np.abs(free.predicted(x[:80]) - y[:80]).mean(), abs=1e-6)
    squares, rooted = (Booster(table, 1, "squared", {**p, "n_estimators": 3}, 7).fit("squared", r)[1] for r in (False, True))
    assert [math.sqrt(s) for s in squares] == pytest.approx(rooted)


@pytest.mark.parametrize("deep, num_leaves", [(5, 31), (4, 6), (-1, 12)])
def test_best_leaf_first_takes_a_pass_a_level(spark, binned, deep, num_leaves):
    """One pass sums the children of all leaves that may still be split, also of those whose parents wait for their turn."""
    table, x, y = binned
    p = {**PLAIN, "max_depth": deep, "num_leaves": num_leaves, "n_estimators": 3}
    counted = Binned(table.table, table.names, table.cuts, table.flat)
    model, _, _ = Booster(counted, 1, "squared", p, 7, use_val=False).fit()
    levels = lambda t, k=0: 0 if t.feature[k] < 0 else 1 + max(levels(t, t.left[k]), levels(t, t.right[k]))
    assert len(counted.passes) <= sum(levels(t) + 1 for t in model.trees)
    now, leaves = slow_fit(binned_values(x[80:], table.cuts), y[80:], p, "squared", 3)
    assert [t.n_leaves for t in model.trees] == leaves and np.allclose(model.predicted(x[80:]), now, atol=1e-6)


def test_places_at_any_depth():
    """A chain that is far deeper than the levels that all rows walk together, with missing values on either side."""
    n = 3 * boosting.LEVELS_TOGETHER
    feature, left, right = np.full(2 * n + 1, -1, np.int32), np.full(2 * n + 1, -1, np.int32), np.full(2 * n + 1, -1, np.int32)
    cut, missing_left = np.zeros(2 * n + 1, np.int32), np.zeros(2 * n + 1, bool)
    for k in range(n):
        feature[2 * k], cut[2 * k], missing_left[2 * k] = k % 3, 3 * (k + 1) + 2, k == n // 2
        left[2 * k], right[2 * k] = (2 * k + 1, 2 * k + 2)
    tree = boosting.Tree(feature, cut, missing_left, left, right, np.zeros(2 * n + 1), np.zeros(2 * n + 1))
    bins = np.random.default_rng(3).integers(0, 3 * n + 8, (500, 3)).astype(np.uint8)
    bins[:50] = 0
    want = []
    for row in bins:
        at = 0
        while feature[at] >= 0:
            own = row[feature[at]]
            at = left[at] if (missing_left[at] if own == 0 else own <= cut[at]) else right[at]
        want.append(at)
    assert tree.places(bins).tolist() == want and len(set(want)) > boosting.LEVELS_TOGETHER
    assert tree.places(bins[:0]).tolist() == []


def test_same_trees_by_blocks_of_any_size(spark, binned, monkeypatch):
    """Blocks, rows at once, rounds between writes and who adds up the tasks' sums change no tree."""
    table, x, _ = binned
    dealt = Binned(table.table.repartition(3), table.names, table.cuts, table.flat)
    for loss in ("squared", "absolute"):
        p = {**PLAIN, "n_estimators": 6, "subsample": 0.6, "num_leaves": 6 if loss == "squared" else None}
        whole, errors, _ = Booster(table, 1, loss, p, 3).fit()
        with monkeypatch.context() as m:
            for name, value in (("BLOCK_BYTES", 70), ("ROWS_AT_ONCE", 7), ("ROUNDS_PER_STAGE", 2), ("SUMS_ADDED", 0)):
                m.setattr(boosting, name, value)
            booster = Booster(dealt, 1, loss, p, 3)
            assert booster.state.where("length(y) > 16 or y is null").isEmpty()
            other, again, _ = booster.fit()
        assert errors == again and np.array_equal(whole.predicted(x), other.predicted(x))


def test_a_fit_is_continued(spark, binned, monkeypatch):
    monkeypatch.setattr(boosting, "ROUNDS_PER_STAGE", 3)
    table, x, _ = binned
    p = {**PLAIN, "n_estimators": 8, "subsample": 0.6, "colsample_bytree": 0.7, "colsample_bylevel": 0.7}
    whole, _, _ = Booster(table, 1, "squared", p, 7).fit()
    first, _, _ = Booster(table, 1, "squared", {**p, "n_estimators": 5}, 7).fit()
    more, _, _ = Booster(table, 1, "squared", {**p, "n_estimators": 3}, 7, start=first).fit()
    assert len(more.trees) == 8 and np.array_equal(more.predicted(x), whole.predicted(x))


@pytest.mark.parametrize("partitions", [1, 5])
def test_same_trees_on_any_partitioning(spark, binned, partitions):
    table, x, _ = binned
    dealt = Binned(table.table.repartition(partitions), table.names, table.cuts, table.flat)
    p = {**PLAIN, "subsample": 0.5, "colsample_bytree": 0.7}
    for loss in ("squared", "absolute"):
        one, two = (Booster(t, 1, loss, p, 3).fit()[0] for t in (table, dealt))
        assert np.array_equal(one.predicted(x), two.predicted(x))


def test_medians_are_exact(spark):
    rng = np.random.default_rng(5)
    for values in ([1.0], [1.0, 2.0], [-3.5, -3.5, 7.0, 1e300], [0.0, -0.0, 5e-324, -1.0], rng.normal(size=5001) ** 5, np.repeat([2.0, 9.0], 500), rng.integers(0, 3, 1000) * 1.0):
        y = np.asarray(values, float)
        frame = windows_of(spark, np.zeros((len(y), 3)), y, n_val=0)
        booster = Booster(bin_windows(frame, ("a", "b", "c")), 1, "absolute", PLAIN, 1)
        assert booster.base == np.median(y)


def test_edge_cases(spark):
    x, y = made_up(30)
    for changed in (np.full((30, 3), np.nan), np.ones((30, 3))):
        model, _, _ = Booster(bin_windows(windows_of(spark, changed, y, 0), ("a", "b", "c")), 1, "squared", PLAIN, 1).fit()
        assert np.allclose(model.predicted(changed), y.mean()) and sum(model.importances()) == 0
    none = bin_windows(windows_of(spark, x, y, 30), ("a", "b", "c"))
    with pytest.raises(ValueError, match="no training rows"):
        Booster(none, 1, "squared", PLAIN, 1)
    with pytest.raises(ValueError, match="max_bins"):
        bin_windows(windows_of(spark, x, y), ("a", "b", "c"), 300)


SPEC = SeriesSpec(order_by=("date",), target="OT", sensors=("A", "B"), time_col="date")


@pytest.fixture(scope="module")
def seasonal(spark):
    hour, angle = F.col("id").cast("int"), F.col("id") * (2 * math.pi / 24)
    return spark.range(400).select(
        (F.lit("2016-07-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)).alias("date"), F.sin(angle).alias("A"),
        (F.cos(angle) + F.rand(1) * 0.05).alias("B"), (20 + 8 * F.sin(angle + 0.4) + F.rand(2) * 0.3).alias("OT"),
    ).cache()


@pytest.mark.parametrize("kind, mode", [("xgboost", "industrial"), ("lightgbm", "flat")])
def test_runs_by_other_names(spark, seasonal, tmp_path, kind, mode):
    """The whole path from table to stored run and predictions, two steps ahead, under the names users know."""
    window = WindowSpec(6, 2, feature_mode=mode)
    config = RunConfig(SPEC, window, model_kind=kind, model_params={"n_estimators": 25, "learning_rate": 0.3})
    run = run_training(spark, seasonal, config, "own", str(tmp_path / "run"))
    assert run.record["model_kind"] == merged_kind(kind) and run.record["metrics"]["test"]["R2"] > 0.8
    assert run.record["params"]["reg_lambda"] == "2.0"
    first, second = (predict(seasonal, r).orderBy("idx", "step").collect() for r in (run, load_run(spark, str(tmp_path / "run"))))
    assert first == second and len(first) == 2 * (400 - 6 - 1)
    steps = step_importance_table(run_frame(spark, [run.record])).groupBy("step").agg(F.sum("importance").alias("s"), F.count("*").alias("n")).collect()
    assert {(r["step"], round(r["s"], 6), r["n"]) for r in steps} == {(1, 1.0, len(run.names)), (2, 1.0, len(run.names))}


def merged_kind(kind):
    return {"xgboost": "boosted_absolute", "lightgbm": "boosted_squared"}[kind]


def test_trials_share_one_binned_table(spark, seasonal):
    config = RunConfig(SPEC, WindowSpec(6), model_kind="lightgbm", model_params={"n_estimators": 2, "learning_rate": 0.5})
    samples = prepare_samples(seasonal, config)
    trials = tuning.grid_table(spark, {"reg_lambda": [0.0, 50.0], "num_leaves": [2, 8]})
    runs = tuning.run_trials(spark, samples, trials).collect()
    assert [r["status"] for r in runs] == ["success"] * 4 and len(samples._bins) == 1
    assert len({r["metrics"]["val"]["RMSE"] for r in runs}) == 4  # penalties and leaves have an effect
    assert merged_params("lightgbm")["reg_alpha"] == 0.5


def test_fit_boosted_uses_defaults(binned):
    fitted = fit_boosted(binned[0], 1, "lightgbm", {"n_estimators": 3, "early_stopping_rounds": None})
    assert len(fitted.model.trees) == 3 and all(t.n_leaves <= 31 for t in fitted.model.trees) and len(fitted.history) == 3
