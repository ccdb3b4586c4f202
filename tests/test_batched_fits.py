"""Fits of many settings and folds in shared passes, against plain loops and MLlib."""

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators import batch_fit, boost
from tidemark.operators import train as tr
from tidemark.plans import churn
from tidemark.roles import ORDERS360 as R
from tidemark.sources.customer360 import customer360

SF = "/root/testdata/sf0.001"
COLUMNS = {"numeric": ["tenure", "recency", "monthly"], "categorical": ["contract"]}
SCHEMA = "fold int, name string, y double, weight double, held boolean, x array<double>"


@pytest.fixture(scope="module")
def customers(spark):
    df = customer360(spark, SF)
    return spark.createDataFrame([tuple(r) for r in df.collect()], df.schema)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 6)).round(3)
    x[:, 4], x[:, 5] = x[:, 4] > 1, 3.0
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * x[:, 4] + rng.normal(size=240) * 0.4 > 0.2).astype(float)
    return x, y, np.where(y > 0, 1.5, 0.75)


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, w = data
    cells = [(f, str(i), float(y[i]), float(w[i]), i % 2 == f, x[i].tolist()) for i in range(len(x)) for f in range(2)]
    return spark.createDataFrame(cells, SCHEMA).repartition(3)


def plain(x, y, w, held, setting, edges):
    """Boosting row by row and node by node, without subsampling."""
    own = ~held
    rate = (w[own] * y[own]).sum() / w[own].sum()
    margin = np.full(len(y), np.log(rate / (1 - rate)))
    soft = lambda g: np.sign(g) * max(abs(g) - setting.reg_alpha, 0)
    size = lambda g, h: soft(g) ** 2 / (h + setting.reg_lambda)

    def sums(at):
        p = 1 / (1 + np.exp(-margin[at]))
        return ((p - y[at]) * w[at]).sum(), (p * (1 - p) * w[at]).sum()

    def gain(left, right, least):
        if min(left.sum(), right.sum()) < least:
            return -np.inf
        return (size(*sums(left)) + size(*sums(right)) - size(*sums(left | right))) / 2

    def conditions():
        best = []
        for c, cuts in enumerate(edges):
            found = [(gain(own & (x[:, c] <= t), own & (x[:, c] > t), setting.min_child_samples), -k, c, t) for k, t in enumerate(cuts)]
            if found:
                best.append(max(found))
        best = [b for b in sorted(best, key=lambda b: (-b[0], b[2])) if b[0] > setting.gamma][: setting.max_depth]
        return [(c, t) for _, _, c, t in best]

    now = conditions()
    for _ in range(setting.n_estimators):
        cell = np.zeros(len(y), int)
        for i, (c, t) in enumerate(now):
            cell += (x[:, c] > t).astype(int) << i
        g, h = sums(own)
        step = np.full(len(y), -soft(g) / (h + setting.reg_lambda))
        for level in range(len(now)):
            mask, changed = (1 << level) - 1, step.copy()
            for node in range(1 << level):
                inside = own & (cell & mask == node)
                low, high = inside & (cell >> level & 1 == 0), inside & (cell >> level & 1 == 1)
                if gain(low, high, setting.min_child_samples) > setting.gamma:
                    for side, bit in ((low, 0), (high, 1)):
                        g, h = sums(side)
                        changed[(cell & mask == node) & (cell >> level & 1 == bit)] = -soft(g) / (h + setting.reg_lambda)
            step = changed
        later = conditions()
        margin = margin + setting.learning_rate * step
        now = later
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("tasks, replay", [(100_000, 8), (40, 1), (40, 3)])
def test_boosting_equals_plain_loops(rows, data, monkeypatch, tasks, replay):
    monkeypatch.setattr(boost, "TASK_ROWS", tasks)
    monkeypatch.setattr(boost, "REPLAY", replay)
    x, y, w = data
    settings = [boost.Setting(6, 3, 0.3, min_child_samples=9, reg_lambda=0.5, reg_alpha=0.2), boost.Setting(4, 2, 0.1, gamma=0.3)]
    boosting = boost.Boosting(rows, settings)
    boosting.run(2, [0, 1])
    boosting.run(6, [0, 1])
    assert {p: len(t) for p, t in boosting.trees.items()} == {(f, i): n for f in (0, 1) for i, n in ((0, 6), (1, 4))}
    got = {(r.setting, r.name): r.p for r in boosting.held_scores([0, 1]).collect()}
    assert len(got) == 2 * len(x)
    for f in (0, 1):
        held = np.arange(len(x)) % 2 == f
        for i, s in enumerate(settings):
            want = plain(x, y, w, held, s, boosting.edges[f])
            assert [got[i, str(k)] for k in np.flatnonzero(held)] == pytest.approx(want[held].tolist(), abs=1e-9)


def test_draws_do_not_depend_on_tasks(rows, monkeypatch):
    setting = boost.Setting(5, 3, 0.3, subsample=0.6, colsample_bytree=0.5)
    found = []
    for tasks in (100_000, 40):
        monkeypatch.setattr(boost, "TASK_ROWS", tasks)
        boosting = boost.Boosting(rows, [setting])
        boosting.run(5, [0])
        found.append({r.name: round(r.p, 10) for r in boosting.held_scores([0]).collect()})
        assert all(len(t.columns) <= 3 for t in boosting.trees[0, 0])
    assert found[0] == found[1]


def test_a_stage_scores_like_the_margins(spark, rows, data, tmp_path):
    x, _, _ = data
    boosting = boost.Boosting(rows, [boost.Setting(4, 3, 0.3)])
    boosting.run(4, [0])
    held = {r.name: r.p for r in boosting.held_scores([0]).where("fold = 1").collect()}
    model = boosting.model(1, 0)
    model.save(str(tmp_path / "stage"))
    vectors = rows.where("fold = 1 AND held").select("name", array_to_vector("x").alias("features"))
    for stage in (model, boost.BoostedTrees.load(str(tmp_path / "stage"))):
        assert {r.name: r.probability[1] for r in stage.transform(vectors).collect()} == pytest.approx(held)
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares[5] == 0


def test_no_rows_of_a_class_is_an_error(spark):
    one = spark.createDataFrame([(0, "a", 1.0, 1.0, False, [1.0]), (0, "b", 1.0, 1.0, False, [2.0])], SCHEMA)
    for fit in (lambda: boost.Boosting(one, [boost.Setting()]), lambda: batch_fit.LogisticBatch(one, [batch_fit.Penalty()])):
        with pytest.raises(ValueError):
            fit()


@pytest.mark.parametrize("tasks", [100_000, 40])
def test_logistic_batch_equals_mllib(rows, data, monkeypatch, tasks):
    monkeypatch.setattr(batch_fit, "TASK_ROWS", tasks)
    penalties = [batch_fit.Penalty(a, b) for a, b in ((0.01, 0.0), (0.05, 0.5), (0.2, 1.0), (0.002, 0.3))]
    batch = batch_fit.LogisticBatch(rows, penalties, 400, 1e-9).fit()
    scores = {(r.setting, r.name): r.p for r in batch.held_scores().collect()}
    assert len(scores) == 4 * 240 and batch.passes < 200
    for f in (0, 1):
        ready = rows.where(f"fold = {f} AND NOT held").select(array_to_vector("x").alias("features"), F.col("y").alias("label"), "weight")
        weights, intercept = batch.coefficients(f)
        for j, p in enumerate(penalties):
            model = LogisticRegression(maxIter=500, tol=1e-12, regParam=p.reg_lambda, elasticNetParam=p.reg_alpha, weightCol="weight").fit(ready)
            assert weights[:, j] == pytest.approx(model.coefficients.toArray(), abs=1e-5)
            assert intercept[j] == pytest.approx(model.intercept, abs=1e-5)
    x, _, _ = data
    weights, intercept = batch.coefficients(0)
    assert scores[1, "2"] == pytest.approx(1 / (1 + np.exp(-(x[2] @ weights[:, 1] + intercept[1]))))


@pytest.mark.parametrize("algorithm", ["boosted", "logistic_regression"])
def test_folds_and_plan(customers, algorithm, tmp_path):
    spec = tr.ModelSpec(algorithm, {"n_estimators": 4, "max_depth": 3, "max_iter": 30, "reg_lambda": 0.1}, weighted=True)
    oof = tr.out_of_fold(customers, R, spec, 3, **COLUMNS)
    assert oof.schema[R.key].dataType == customers.schema[R.key].dataType
    assert oof.count() == oof.select(R.key).distinct().count() == customers.count()
    assert oof.where("p BETWEEN 0 AND 1").count() == customers.count()
    model = churn.train_and_evaluate(customers, R, spec, k=2, **COLUMNS)
    model.save(str(tmp_path))
    ours, theirs = (sorted(map(tuple, churn.score_batch(customers, m).collect())) for m in (model, tr.ChurnModel.load(str(tmp_path))))
    assert ours == theirs and len(ours) == customers.count()
    assert tr.importances(model, customers).count() > 3


def test_resampled_folds(customers):
    spec = tr.ModelSpec("boosted", {"n_estimators": 2, "max_depth": 2}, resample=True, engineered=False)
    assert tr.out_of_fold(customers, R, spec, 2, numeric=["tenure", "recency"], categorical=[]).count() == customers.count()


def test_search_halves_its_trials(customers):
    spec = tr.ModelSpec("boosted", engineered=False)
    space = {**tr.SEARCH_SPACE, "n_estimators": tr.Range(3, 8, "whole"), "max_depth": tr.Range(2, 4, "whole"), "min_child_samples": tr.Range(2, 9, "whole")}
    found = tr.search(customers, R, spec, space, n_trials=9, k=2, rungs=(1, 2), **COLUMNS)
    trials = found.trials.orderBy("number").collect()
    assert [t.number for t in trials] == list(range(9)) and {len(t.params) for t in trials} == {9}
    assert sorted(t.state for t in trials) == ["COMPLETE"] + ["PRUNED"] * 8
    kept = next(t for t in trials if t.state == "COMPLETE")
    assert (found.best_value, found.best_threshold) == (kept.value, kept.threshold)
    assert tr.best_per_algorithm(found.trials).first().number == kept.number
    # the trial that went on has the value of its own fit
    alone = tr.out_of_fold(customers, R, replace(spec, params=found.best_spec.params), 2, **COLUMNS)
    value = tr.objectives(alone, ["model"], "f1", True).first().value
    assert value == pytest.approx(found.best_value)
    model = tr.refit(customers, R, found, **COLUMNS)
    assert len(model.pipeline.stages[-1].parts()["trees"]) == kept.params["n_estimators"]


def test_search_over_several_algorithms(customers):
    spec = tr.ModelSpec("boosted", {"n_estimators": 2, "max_depth": 2}, engineered=False)
    space = {"learning_rate": tr.Range(0.1, 0.3, "log"), "reg_lambda": tr.Range(0.01, 1.0)}
    found = tr.search(customers, R, spec, space, n_trials=8, k=2, metric="roc_auc", optimise_threshold=False, patience=1, algorithms=["boosted", "logistic_regression", "random_forest"], **COLUMNS)
    trials = found.trials.collect()
    assert {t.algorithm for t in trials} == {"boosted", "logistic_regression", "random_forest"}
    assert {t.threshold for t in trials} == {0.5} and all(0 <= t.value <= 1 for t in trials)
    assert found.best_value == max(t.value for t in trials if t.state == "COMPLETE")


@pytest.mark.parametrize("models", [1, boost.FEW + 1])
def test_sums_by_bin_against_plain_loops(models):
    rng = np.random.default_rng(3)
    widths = np.array([5, 1, 2, 9])
    bins = np.stack([rng.integers(0, w, 300) for w in widths], axis=1).astype(np.uint8)
    parts = rng.normal(size=(3, 300, models))
    want = [[parts[:, bins[:, c] == b, :].sum(axis=1).T for b in range(w)] for c, w in enumerate(widths)]
    assert np.allclose(boost._histograms(np.asfortranarray(bins), widths, parts), np.concatenate([np.stack(w) for w in want]))


def test_binary_columns_are_read_from_a_slice():
    column = pa.array([bytes([i, i + 1]) for i in range(9)], pa.binary())
    assert boost._plain(column.slice(3, 2), np.uint8).tolist() == [3, 4, 4, 5]
    assert boost._plain(pa.array([b"", b""], pa.binary()), np.uint8).tolist() == []


def test_passes_leave_out_held_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 2))
    rows = [(0, str(i), float(x[i, 0] > 0), 1.0, i % 4 == 0, x[i].tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "fold int, name string, y double, weight double, held boolean, x array<double>")
    boosting = boost.Boosting(df, [boost.Setting(n_estimators=1, max_depth=1)])
    assert boosting.tasks == 1
    seen = spark.sparkContext.accumulator(0)
    plain = boost._pass

    def counted(batches, plan):
        def through():
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return plain(through(), plan)

    monkeypatch.setattr(boost, "_pass", counted)
    boosting.run(1, [0])
    assert seen.value == 2 * 150
