"""Tables of many columns and categories."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import comoments, prep, profile


def _brute(x):
    out = np.full((x.shape[1], x.shape[1]), np.nan)
    for i in range(x.shape[1]):
        for j in range(x.shape[1]):
            both = np.isfinite(x[:, i]) & np.isfinite(x[:, j])
            a, b = x[both, i], x[both, j]
            if len(a) > 1 and np.ptp(a) > 0 and np.ptp(b) > 0:
                out[i, j] = np.corrcoef(a, b)[0, 1]
    return out


@pytest.mark.parametrize("block, parts", [(256, 1), (2, 5), (3, 2)])
def test_correlations_of_incomplete_columns(spark, block, parts):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 7)) * [1, 1e6, 1e-6, 1, 1, 1, 1] + [0, 1e9, 0, 5, 0, 0, 0]
    x[:, 3] = 0.1
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = np.nan
    x[1:, 6] = np.nan
    names = [f"x{i}" for i in range(7)]
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts)
    got = np.full((7, 7), np.nan)
    found = comoments.correlation_pairs(df, names, block).collect()
    assert len(found) == 49
    for r in found:
        got[names.index(r.feature_a), names.index(r.feature_b)] = np.nan if r["corr"] is None else r["corr"]
    want = _brute(x)
    assert (np.isnan(got) == np.isnan(want)).all()
    assert np.nan_to_num(got) == pytest.approx(np.nan_to_num(want), abs=1e-9)


def test_a_thousand_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8)) @ rng.normal(size=(8, 1000))
    names = [f"c{i}" for i in range(1000)]
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").select(*[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    found = profile.corr_matrix(df, names)
    assert found.count() == 1_000_000
    some = {(r.feature_a, r.feature_b): r["corr"] for r in found.where("feature_a IN ('c0', 'c999', 'c300')").collect()}
    want = np.corrcoef(x.T)
    for (a, b), r in some.items():
        assert r == pytest.approx(want[int(a[1:]), int(b[1:])], abs=1e-9)


def _decoded(row, names):
    return {names[i]: v for i, v in zip(row.encoded["indices"], row.encoded["values"])}


@pytest.mark.parametrize("drop_first", [False, True])
def test_sparse_encoding_equals_columns(spark, drop_first):
    rows = [(1, "b", "u"), (2, "a", "v"), (3, None, "u"), (4, "c", None), (5, "a", "w")]
    df = spark.createDataFrame(rows, "k long, x string, y string")
    codes = prep.code_table(df, ["y", "x"], drop_first)
    names = {r.slot: f"{r.feature}_{r.category}" for r in codes.collect()}
    assert sorted(names) == list(range(len(names)))
    wide = prep.one_hot(df, ["y", "x"], prep.known_categories(df, ["y", "x"]), drop_first)
    assert [names[i] for i in sorted(names)] == [c for c in wide.columns if c != "k"]
    encoded = {r.k: r for r in prep.one_hot_sparse(df, ["y", "x"], codes).collect()}
    for r in wide.collect():
        assert encoded[r.k].encoded["size"] == len(names)
        assert _decoded(encoded[r.k], names) == {c: 1.0 for c in wide.columns if c != "k" and r[c]}


def test_unknown_categories(spark):
    codes = prep.code_table(spark.createDataFrame([("a",)], "x string"), ["x"])
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "k long, x string")
    assert {r.k: r.encoded["indices"] for r in prep.one_hot_sparse(new, ["x"], codes).collect()} == {1: [0], 2: [], 3: []}
    assert prep.one_hot_sparse(new.where("k <> 2"), ["x"], codes, "error").count() == 2
    with pytest.raises(Exception, match="unknown value in x: z"):
        prep.one_hot_sparse(new, ["x"], codes, "error").collect()
    assert prep.code_table(new.where("k = 3"), ["x"]).collect() == []


def test_many_categories(spark):
    df = spark.range(100_000).select("id", F.format_string("v%06d", F.col("id")).alias("x"), (F.col("id") % 7).alias("y"))
    codes = prep.code_table(df, ["x", "y"])
    assert codes.agg(F.count("*"), F.countDistinct("slot"), F.min("slot"), F.max("slot"), F.max("width")).first() == (100_007, 100_007, 0, 100_006, 100_007)
    encoded = prep.one_hot_sparse(df, ["x", "y"], codes)
    assert encoded.where("size(encoded.indices) <> 2 OR encoded.indices[0] <> id OR encoded.indices[1] <> 100000 + id % 7").count() == 0
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 50_000
