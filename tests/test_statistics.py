"""Ledger, profiling and information value against pandas and numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.draw import with_part
from tidemark.functions.ledger import quantiles, ranked, value_ledger
from tidemark.operators import iv, profile


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50).map(lambda i: i / 4), min_size=1, max_size=60), st.sampled_from([1, 8]))
def test_quantiles_and_sums(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "value double").repartition(parts)
    ledger = value_ledger(df, "value", {"n": F.count("*")})
    got = {r.q: r["quantile"] for r in quantiles(ledger, [0, 0.1, 0.25, 0.5, 0.99, 1], "value").collect()}
    for q, v in got.items():
        assert v == pytest.approx(np.quantile(values, q), abs=1e-9)
    rows = ledger.orderBy("value").collect()
    counts = pd.Series(values).value_counts().sort_index()
    assert [r.cum_n for r in rows] == list(counts.cumsum()) and {r.tot_n for r in rows} == {len(values)}


def test_ledger_over_many_slabs(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 4001).cast("double").alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ledger = value_ledger(df, "value", {"n": F.count("*")}, ["g"]).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for _, part in ledger.sort_values("value").groupby("g"):
        assert (part.n.cumsum() == part.cum_n).all() and part.tot_n.nunique() == 1


def test_exact_ranks(spark):
    df = spark.createDataFrame([(0.5, "b"), (0.5, "a"), (0.9, "c")], "r double, name string")
    placed = ranked(df.withColumn("f", -F.col("r")), ["f", "name"], "place").collect()
    assert {(r.name, r.place) for r in placed} == {("c", 1), ("a", 2), ("b", 3)}


@pytest.mark.parametrize("parts", [1, 8])
def test_exact_split_counts(spark, parts):
    df = spark.range(997).select("id", (F.col("id") % 5 == 0).cast("int").alias("y")).repartition(parts)
    split = with_part(df, "id", "y", [(1, 4), (1, 2), (3, 4)], 7, "part").toPandas()
    for y, n in ((0, 797), (1, 200)):
        sizes = split[split.y == y].part.value_counts().sort_index().tolist()
        cuts = [math.floor(n * i / 4) for i in range(5)]
        assert sizes == [b - a for a, b in zip(cuts, cuts[1:])]
    again = with_part(df.repartition(3), "id", "y", [(1, 4), (1, 2), (3, 4)], 7, "part").toPandas()
    assert dict(zip(split.id, split.part)) == dict(zip(again.id, again.part))


def test_describe_against_pandas(spark):
    x = [1.0, 2.0, 2.0, 9.0, None, 4.5]
    df = spark.createDataFrame([(v, None if v is None else f"s{int(v)}") for v in x], "x double, s string")
    want = pd.Series(x, dtype=float).describe()
    got = profile.describe_numeric(df, ["x"]).first()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert got[ours] == pytest.approx(want[theirs])
    text = profile.describe_text(df, ["s"]).first()
    assert tuple(text[1:]) == (5, 4, "s2", 2)
    missing = {r.column_name: (r.nulls, r.pct) for r in profile.missing_profile(df).collect()}
    assert missing == {"x": (1, 16.67), "s": (1, 16.67)}


def test_outliers(spark):
    clean = spark.createDataFrame([(float(v),) for v in range(1, 6)], "x double")
    dirty = clean.union(spark.createDataFrame([(100.0,)], "x double"))
    assert profile.iqr_bounds(clean, ["x"]).first().total_outliers == 0
    assert profile.iqr_bounds(dirty, ["x"]).first().outliers_upper == 1
    assert [r.x for r in profile.outliers_iqr(dirty, "x").where("is_outlier = 1").collect()] == [100.0]
    assert [r.x for r in profile.outliers_mad(dirty, "x").where("is_outlier = 1").collect()] == [100.0]
    flat = spark.createDataFrame([(5.0,)] * 6, "x double")
    row = profile.mad_stats(flat, ["x"]).first()
    assert (row.mad, row.outliers) == (0.0, 0)
    assert profile.outliers_mad(flat, "x").where("is_outlier = 1").count() == 0


def test_histogram_keeps_every_row(spark):
    df = spark.createDataFrame([(float(v), v % 2) for v in range(11)], "x double, y int")
    bins = profile.histogram_by_class(df, "x", "y", 5).groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").collect()
    assert [r.n for r in bins] == list(np.histogram(range(11), 5)[0])
    flat = spark.createDataFrame([(3.0, 1)] * 4, "x double, y int")
    assert profile.histogram_by_class(flat, "x", "y", 5).first().n == 4


def _woe_iv(table, s=0.5):
    e, n = table["e"], table["t"] - table["e"]
    de, dn = (e + s) / (e.sum() + s * len(table)), (n + s) / (n.sum() + s * len(table))
    return float(((de - dn) * np.log(de / dn)).sum())


def test_iv_categorical(spark):
    df = spark.createDataFrame(list(zip("AAABBBCCCC", [1, 1, 0, 0, 0, 1, 0, 0, 0, 1])), "c string, y int")
    want = _woe_iv(pd.DataFrame({"e": [2, 1, 1], "t": [3, 3, 4]}))
    assert iv.iv_categorical(df, ["c"], "y").first().iv == pytest.approx(want)
    declared = spark.createDataFrame([("c", v) for v in "ABCD"], "feature string, value string")
    want = _woe_iv(pd.DataFrame({"e": [2, 1, 1, 0], "t": [3, 3, 4, 0]}))
    assert iv.iv_categorical(df, ["c"], "y", declared=declared).first().iv == pytest.approx(want)
    perfect = spark.createDataFrame([("A", 1)] * 50 + [("B", 0)] * 50, "c string, y int")
    assert iv.iv_categorical(perfect, ["c"], "y").first().iv > 1


def test_iv_numeric_against_pandas(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 500)
    x = np.where(y == 1, rng.normal(5, 1, 500), rng.normal(3, 1, 500)).round(1)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)] + [(None, 1)], "x double, y int")
    data = pd.DataFrame({"x": x, "y": y})
    lo, hi = data.x.quantile([0.01, 0.99])
    data = data[(data.x >= lo) & (data.x <= hi)]
    table = data.groupby(pd.qcut(data.x, 10, duplicates="drop"), observed=True).y.agg(e="sum", t="count")
    table = table[table.t / table.t.sum() >= 0.05]
    assert iv.iv_numeric(df, ["x"], "y").first().iv == pytest.approx(_woe_iv(table))
    flat = spark.createDataFrame([(1.0, 0), (1.0, 1)], "x double, y int")
    assert iv.iv_numeric(flat, ["x"], "y").collect() == []


def test_drop_below_iv(spark):
    df = spark.createDataFrame([("A", "k", 1.0, 1)] * 30 + [("B", "k", 2.0, 0)] * 30, "good string, flat string, x double, y int")
    ranking = iv.iv_rank(df, ["good", "flat"], ["x"], "y")
    assert "flat" not in iv.drop_below_iv(df, ranking).columns and "good" in iv.drop_below_iv(df, ranking).columns
