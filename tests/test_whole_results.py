"""Nothing is cut, rounded away or dropped: long statuses, small shares, missing labels and scores."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.draw import with_part
from tidemark.operators import evaluate as ev
from tidemark.operators import prep
from tidemark.operators import train as tr
from tidemark.operators.profile import missing_profile
from tidemark.sources.customer360 import customer360
from tidemark.sources.tables import table

NAN = float("nan")


def test_status_and_order_of_day_survive(spark, tmp_path):
    day = lambda n, hour=0: dt.datetime(2020, 1, 1) + dt.timedelta(days=n, hours=hour)
    orders = [
        (5, 1, "FULFILLED", 10.0, day(10, 9), "1-URGENT"),
        (4, 1, "PENDING", 10.0, day(10, 17), "5-LOW"),
        (2**48 + 1, 2, "OPEN", 5.0, day(20), "5-LOW"),
        (3, 2, "FAILED", 5.0, day(19), "5-LOW"),
        (6, 3, "OPEN", 1.0, dt.datetime(2200, 1, 1), "5-LOW"),
        (7, 3, "SHIPPED", 1.0, dt.datetime(2190, 1, 1), "5-LOW"),
    ]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(5, "R")], "l_orderkey long, l_returnflag string"),
        "customer": ([(1, 0, 1.0, "A"), (2, 0, NAN, "B"), (3, 0, 1.0, "B")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = {r.customer_key: r for r in customer360(spark, str(tmp_path)).collect()}
    assert {k: r.payment for k, r in found.items()} == {1: "PENDING", 2: "OPEN", 3: "SHIPPED"}
    assert found[2].balance is None
    assert table(spark, str(tmp_path), "customer").where("c_acctbal IS NULL").count() == 1
    spark.createDataFrame([(9,)], "other int").write.mode("overwrite").parquet(f"{tmp_path}/region.parquet")
    assert table(spark, str(tmp_path), "region").columns == ["other"]


def test_small_test_share(spark):
    rows = spark.range(10_000).select("id", F.lit(1).alias("y"))
    assert prep.stratified_split(rows, "id", "y", 0.0004).where("split = 'test'").count() == 4


def test_rows_without_label_are_split_too(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") < 50, 1).alias("y"))
    counts = {(r.y, r.part): r["count"] for r in with_part(rows, "id", "y", [(1, 5)], 1, "part").groupBy("y", "part").count().collect()}
    assert counts == {(1, 0): 10, (1, 1): 40, (None, 0): 10, (None, 1): 40}


def test_nan_is_no_score(spark):
    scores = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.2), ("m", 1, 0.8), ("m", 0, NAN), ("m", None, 0.9)], "model string, y int, p double")
    row = ev.evaluate(scores).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.precision, row.roc_auc) == (2, 0, 0, 1, 1.0, 1.0)
    assert ev.confusion_matrix(scores).agg(F.sum("n")).first()[0] == 3
    bands = {r.p: (r.prediction, r.risk) for r in ev.risk_bands(scores.where("y = 0")).collect()}
    assert bands == {0.2: (0, "LOW"), None: (0, "LOW")}
    summary = ev.score_summary(scores.withColumn("k", F.monotonically_increasing_id()), "k").first()
    assert summary.total == 5 and summary.high_risk == 3


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (None, "b")], "x double, t string")
    assert {r.column_name: r.nulls for r in missing_profile(df).collect()} == {"x": 2, "t": 1}


def test_unlabelled_rows_are_left_out_of_training(spark, eight, roles):
    rows = eight.unionByName(eight.withColumn("Churn", F.lit(None).cast("string")).withColumn("customerID", F.concat("customerID", F.lit("x"))))
    done = tr.prepare(rows, roles, tr.ModelSpec("logistic_regression", {}, engineered=False), numeric=["tenure"], categorical=[])
    assert done.ready.count() == 8
    folds = tr.prepare_folds(rows, roles, tr.ModelSpec("logistic_regression", {}, engineered=False), 2, numeric=["tenure"], categorical=[])
    assert sum(f.held.count() for f in folds) == 8


def test_search_prepares_each_fold_once(spark, eight, roles, monkeypatch):
    seen = []
    real = tr.prepare
    monkeypatch.setattr(tr, "prepare", lambda *a, **b: seen.append(1) or real(*a, **b))
    spec = tr.ModelSpec("logistic_regression", {"max_iter": 3}, engineered=False)
    found = tr.search(eight, roles, spec, {"reg_lambda": tr.Range(0.0, 1.0)}, n_trials=3, k=2, numeric=["tenure"], categorical=[])
    assert len(seen) == 2 and found.trials.count() == 3
    assert [round(r.params["reg_lambda"], 12) for r in found.trials.orderBy("number").collect()] == [round(tr.draw(42, i, "reg_lambda"), 12) for i in range(3)]


@pytest.mark.parametrize("kind", ["whole", "even", "log"])
def test_ranges(kind):
    span = tr.Range(2, 9, kind)
    values = [span.at(u / 100) for u in range(100)]
    assert min(values) == 2 and max(values) <= 9 and values == sorted(values)
    assert kind != "whole" or set(values) == set(range(2, 10))
