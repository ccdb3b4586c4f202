import itertools
from dataclasses import replace
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.stage import spread
from tidemark.operators import explain as ex
from tidemark.operators import train as tr
from tidemark.operators import trees
from tidemark.plans import churn
from tidemark.sources.customer360 import customer360
from tidemark.roles import ORDERS360 as R

SF = "/root/testdata/sf0.001"
SPEC = tr.ModelSpec("gbt", {"n_estimators": 3, "max_depth": 3}, engineered=False)
COLUMNS = {"numeric": ["tenure", "recency", "monthly"], "categorical": ["contract"]}


@pytest.fixture(scope="module")
def customers(spark):
    df = customer360(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    return spark.createDataFrame(rows, df.schema)


@pytest.fixture(scope="module")
def model(customers):
    return tr.fit_model(customers, R, SPEC, **COLUMNS)


def test_registry():
    made = tr.create_model("gbt", {"n_estimators": 7, "subsample": 0.5, "unheard_of": 1})
    assert (made.getMaxIter(), made.getSubsamplingRate()) == (7, 0.5)
    with pytest.raises(ValueError):
        tr.create_model("nothing", {})


def test_preprocessor(customers):
    prepared = tr.fit_preprocessor(customers, ["tenure"], ["contract"], scaler="minmax").transform(customers)
    names = tr.feature_names(prepared)
    assert names[0] == "num__tenure" and names[1:] == sorted(names[1:]) and len(names) == 6
    x = np.array([r[0] for r in prepared.select(vector_to_array("features")).collect()])
    assert x[:, 0].min() == 0 and x[:, 0].max() == 1 and (x[:, 1:].sum(axis=1) == 1).all()
    odd = customers.limit(1).withColumn("contract", F.lit("new")).withColumn("tenure", F.lit(None).cast("int"))
    fitted = tr.fit_preprocessor(customers, ["tenure"], ["contract"], scaler=None)
    row = fitted.transform(odd).select(vector_to_array("features")).first()[0]
    assert row[0] > 0 and sum(row[1:]) == 0
    cut = tr.fit_preprocessor(customers, ["tenure"], ["contract"], drop_first=True).transform(customers)
    assert len(tr.feature_names(cut)) == 5
    more = tr.fit_preprocessor(customers, ["tenure"], [], passthrough=["recency"]).transform(customers)
    assert tr.feature_names(more) == ["num__tenure", "recency"]
    for bad in (dict(numeric=[], categorical=[]), dict(numeric=["tenure"], categorical=[], scaler="x")):
        with pytest.raises(ValueError):
            tr.fit_preprocessor(customers, **bad)
    with pytest.raises(TypeError):
        tr.fit_preprocessor(customers, "tenure", [])


def test_tree_parts_add_up(spark, customers, model):
    wide = trees.tree_parts(model, customers)
    fitted = model.pipeline.stages[-1]
    raw = fitted.transform(model.prepared(customers)).select(R.key, vector_to_array("rawPrediction")[1].alias("margin"))
    sums = ex.row_totals(wide, [R.key, "base_value"]).join(raw, R.key).collect()
    assert len(sums) == customers.count()
    for r in sums:
        assert r.base_value + r.total_attribution == pytest.approx(r.margin)


@pytest.mark.parametrize("algorithm", ["gbt", "boosted"])
def test_tree_parts_against_subsets(spark, customers, model, algorithm):
    """Shapley values by full enumeration of the columns the trees use."""
    if algorithm == "boosted":
        model = tr.fit_model(customers, R, replace(SPEC, algorithm="boosted"), **COLUMNS)
    table = trees.paths(spark, model.pipeline.stages[-1])
    x = np.array([r[0] for r in model.prepared(customers).select(vector_to_array("features")).limit(5).collect()])
    used = sorted({int(s) for p in table for s in np.unique(p.slot[p.share < 1])})
    assert 1 < len(used) <= 10

    def value(known, row):
        total = 0.0
        for p in table:
            on = p.passes(row[None])[0]
            inside = np.isin(p.slot, list(known))
            total += (p.value * np.where(inside, on, p.share).prod(axis=1)).sum()
        return total

    phi = trees.attribute(x, table)
    n = len(used)
    for row, got in zip(x, phi):
        for i in used:
            rest = [u for u in used if u != i]
            want = sum(
                factorial(len(s)) * factorial(n - 1 - len(s)) / factorial(n) * (value({*s, i}, row) - value(set(s), row))
                for size in range(n)
                for s in itertools.combinations(rest, size)
            )
            assert got[i] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("depth", [1, 2, 7, 10])
def test_deep_paths_add_up(depth):
    """Shares and passes of a random full tree: attributions are the output less the expectation."""
    rng = np.random.default_rng(depth)
    cells = 1 << depth
    tree = {"columns": rng.permutation(12)[:depth].tolist(), "cuts": rng.normal(size=depth).tolist(), "leaves": rng.normal(size=cells).tolist(), "cover": rng.integers(0, 9, cells).tolist()}
    p = trees._boosted_paths(tree)
    x = rng.normal(size=(40, 12))
    on = p.passes(x).all(axis=2)
    assert (on.sum(axis=1) == 1).all()
    assert trees.attribute(x, [p]).sum(axis=1) == pytest.approx(on @ p.value - p.base)


def test_boosted_parts_add_up(spark, customers):
    boosted = tr.fit_model(customers, R, replace(SPEC, algorithm="boosted"), **COLUMNS)
    raw = boosted.pipeline.stages[-1].transform(boosted.prepared(customers)).select(R.key, vector_to_array("rawPrediction")[1].alias("margin"))
    for r in ex.row_totals(trees.tree_parts(boosted, customers), [R.key, "base_value"]).join(raw, R.key).collect():
        assert r.base_value + r.total_attribution == pytest.approx(r.margin)


def test_forest_parts_give_the_probability(spark, customers):
    forest = tr.fit_model(customers, R, replace(SPEC, algorithm="random_forest"), **COLUMNS)
    sums = ex.row_totals(trees.tree_parts(forest, customers), [R.key, "base_value"])
    joined = sums.join(forest.score(customers), R.key).collect()
    for r in joined:
        assert r.base_value + r.total_attribution == pytest.approx(r.p)


def test_importances(customers, model):
    rows = tr.importances(model, customers).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1) and rows[0]["rank"] == 1
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_plan_saves_and_loads(spark, customers, tmp_path):
    spec = tr.ModelSpec("logistic_regression", {"max_iter": 20}, weighted=True, scaler="standard")
    model = churn.train_and_evaluate(customers, R, spec, k=2, **COLUMNS)
    assert 0 < model.threshold < 1
    assert set(model.cv_metrics) == {"cv_f1_mean", "cv_f1_std", "cv_roc_auc_mean", "cv_roc_auc_std"}
    assert 0 <= model.cv_metrics["cv_roc_auc_mean"] <= 1 and model.test_metrics["threshold"] == model.threshold
    model.save(str(tmp_path))
    back = tr.ChurnModel.load(str(tmp_path))
    assert (back.threshold, back.roles, back.cv_metrics) == (model.threshold, model.roles, model.cv_metrics)
    ours, theirs = (sorted(map(tuple, churn.score_batch(customers, m).collect())) for m in (model, back))
    assert ours == theirs


def test_out_of_fold_covers_every_row_once(customers):
    oof = tr.out_of_fold(customers, R, SPEC, 3, **COLUMNS)
    assert oof.count() == oof.select(R.key).distinct().count() == customers.count()
    assert {r["count"] for r in oof.groupBy("fold").count().collect()} <= {49, 50, 51, 52}


def test_resampled_fit(customers):
    spec = replace(SPEC, resample=True)
    scored = tr.fit_model(customers, R, spec, numeric=["tenure", "recency"], categorical=["contract"]).score(customers)
    assert scored.where("p BETWEEN 0 AND 1").count() == customers.count()


def test_search(customers):
    space = {"max_depth": tr.Range(2, 3, "whole"), "learning_rate": tr.Range(0.1, 0.3, "log"), "n_estimators": tr.Range(2, 3, "whole"), "reg_lambda": tr.Range(0.0, 1.0)}
    found = tr.search(customers, R, SPEC, space, n_trials=2, k=2, **COLUMNS)
    rows = found.trials.collect()
    assert [r.number for r in rows] == [0, 1] and found.best_value == max(r.value for r in rows)
    assert set(rows[0].params) == {"max_depth", "learning_rate", "n_estimators"}
    assert tr.best_per_algorithm(found.trials).count() == 1
    assert tr.refit(customers, R, found, **COLUMNS).threshold == found.best_threshold


def test_contributors(spark):
    parts = [("a", 1.0, 0.5), ("b", 1.0, -0.9), ("c", 1.0, 0.7), ("d", 1.0, 0.0)]
    wide = spark.createDataFrame(
        [(1, [dict(zip(("feature", "value", "attribution"), p)) for p in parts])],
        "k int, parts array<struct<feature:string,value:double,attribution:double>>",
    )
    got = [tuple(r)[1:4] for r in ex.top_contributors(wide, "k", 1).collect()]
    assert got == [("raises", 1, "c"), ("lowers", 1, "b")]
    assert [r.feature for r in ex.top_by_size(wide, "k", 2).collect()] == ["b", "c"]


def test_attributions_of_many_rows_work_out_each_pattern_once(monkeypatch):
    rng = np.random.default_rng(5)
    steps = {s: (float(rng.uniform(0.2, 0.8)), float(rng.normal()), np.inf, -1) for s in range(3)}
    p = trees._padded([(1.5, steps), (-0.5, {1: (0.4, -np.inf, 0.1, -1), 3: (0.5, -np.inf, np.inf, 5)})])
    x = np.column_stack([rng.normal(size=(700, 3)), rng.integers(0, 3, 700)])
    plain = np.concatenate([trees.attribute(row[None], [p]) for row in x])
    asked, given = [], trees._given
    monkeypatch.setattr(trees, "_given", lambda p, z: asked.append(len(z)) or given(p, z))
    assert trees.attribute(x, [p]) == pytest.approx(plain)
    assert sum(asked) <= 1 << 3


def test_fits_use_every_core(spark):
    assert spread(spark.range(200_000).coalesce(1), 200_000).rdd.getNumPartitions() == 3 * spark.sparkContext.defaultParallelism
    assert spread(spark.range(9).repartition(4), 9).rdd.getNumPartitions() == 1
