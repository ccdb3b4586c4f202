"""Quantiles by bracketing against sorting, and what their plans move."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions import brackets
from tidemark.operators import features, profile

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _frame(spark, columns, parts=4):
    rows = [(name, float(v)) for name, values in columns.items() for v in values]
    return spark.createDataFrame(rows, "feature string, value double").repartition(parts)


def _check(cells, columns, probs=PROBS, **how):
    ledger = brackets.rank_ledger(cells, probs, "value", ["feature"], **how)
    found = {(r.feature, r.q): r.quantile for r in brackets.quantiles(ledger, probs, "value", ["feature"]).collect()}
    for name, values in columns.items():
        for q in probs:
            assert found[name, q] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12), (name, q)
    return ledger


def _columns(n):
    rng = np.random.default_rng(n)
    return {
        "normal": rng.normal(size=n),
        "heavy": np.exp(rng.normal(size=n) * 20) * rng.choice([-1, 1], n),
        "few": rng.choice([0.0, 1.0, 7.0], n),
        "same": np.full(n, 3.25),
        "third": np.where(rng.random(n) < 0.34, 5.0, rng.normal(size=n)),
    }


@pytest.mark.parametrize("n", [1, 2, 3, 7, 60, 4000])
def test_small_and_middling(spark, n):
    columns = _columns(n)
    _check(_frame(spark, columns), columns)


def test_brackets_are_narrowed_until_they_are_small(spark):
    columns = _columns(30_000)
    cells = _frame(spark, columns).persist()
    ledger = _check(cells, columns, accuracy=200, crowd=400)
    held = {r.feature: r["count"] for r in ledger.groupBy("feature").count().collect()}
    assert max(held.values()) < len(PROBS) * 400 and held["same"] <= 3
    wide = brackets.rank_ledger(cells, PROBS, "value", ["feature"], accuracy=200, crowd=10**9)
    assert wide.where("feature = 'normal'").count() > 3 * held["normal"]


def test_without_groups_and_without_rows(spark):
    cells = spark.createDataFrame([(v,) for v in [3.0, 1.0, None, float("nan"), 2.0]], "x double")
    assert [r.quantile for r in brackets.exact_quantiles(cells, [0.5], "x").collect()] == [2.0]
    assert brackets.exact_quantiles(cells.where("x > 9 AND NOT isnan(x)"), [0.5], "x").collect() == []
    none = brackets.exact_quantile_columns(_frame(spark, {"a": []}), {"m": 0.5}, "value", ["feature"])
    assert none.columns == ["feature", "m"] and none.collect() == []


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), st.floats(0, 1))
def test_any_share(spark, values, q):
    found = brackets.exact_quantiles(_frame(spark, {"a": values}, 2), [q], "value", ["feature"]).first().quantile
    assert found == pytest.approx(np.quantile(values, q), rel=1e-9, abs=1e-9)


def test_no_exchange_carries_a_row_per_value(spark):
    cells = _frame(spark, {"a": np.random.default_rng(1).normal(size=40_000)})
    counted = brackets.rank_ledger(cells, [0.25, 0.75], "value", ["feature"])
    assert counted.count() < 2_000 and counted.agg({"n": "sum"}).first()[0] == 40_000


def test_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    rows = {r.feature: r for r in profile.describe_numeric(df, ["a", "b"]).collect()}
    assert (rows["a"].q50, rows["b"]["count"], rows["b"].q50) == (1.5, 0, None)
    assert features.open_edges([]) == [float("-inf"), float("inf")]
