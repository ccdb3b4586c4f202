"""Neighbours from hash tables: recall against all pairs, work, blocks, ties, and resampling with them."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.stage import shared_folder
from tidemark.operators import balance, buckets
from tidemark.operators.neighbours import nearest_neighbours


def _frame(spark, x, parts=4):
    return spark.createDataFrame([(i, r.tolist(), int(i % 5 == 0)) for i, r in enumerate(x)], "id long, vec array<double>, y int").repartition(parts)


def _brute(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    return {i: set(np.lexsort((np.arange(len(x)), row))[:k].tolist()) for i, row in enumerate(d)}


def _groups(n, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 40, width)) * 3
    return centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, width))


@pytest.mark.parametrize("width", [4, 16, 48])
def test_recall(spark, width):
    x = _groups(2500, width, width)
    true = _brute(x, 5)
    found = {}
    for r in buckets.bucketed_neighbours(_frame(spark, x), "id", "vec", 5).collect():
        found.setdefault(r.id, set()).add(r.neighbour)
        assert r.distance == pytest.approx(np.linalg.norm(x[r.id] - x[r.neighbour]))
    hits = sum(len(true[i] & found.get(i, set())) for i in true)
    assert hits / (5 * len(x)) >= 0.9


def test_work_grows_with_the_rows(spark):
    per_row = [buckets.comparisons(_frame(spark, _groups(n, 16, 3)), "id", "vec") / n for n in (2_000, 8_000, 32_000)]
    assert max(per_row) < 1.5 * min(per_row)
    assert per_row[-1] < 32_000 / 8


def test_few_rows_are_all_compared(spark):
    x = _groups(60, 5, 1)[:30]
    exact = nearest_neighbours(_frame(spark, x), "id", "vec", 3)
    same = buckets.bucketed_neighbours(_frame(spark, x), "id", "vec", 3)
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, same.collect()))
    assert buckets.bucketed_neighbours(_frame(spark, x).where("id < 0"), "id", "vec", 3).collect() == []
    assert buckets.bucketed_neighbours(_frame(spark, x).where("id = 1"), "id", "vec", 3).collect() == []


@pytest.mark.parametrize("block", [3, 11])
def test_crowded_cells_in_blocks(spark, block):
    x = np.concatenate([_groups(300, 6, 2), np.tile(np.arange(6.0), (90, 1)), np.arange(6.0) + np.random.default_rng(1).normal(size=(60, 6)) * 1e-3])
    whole = buckets.bucketed_neighbours(_frame(spark, x), "id", "vec", 4)
    cut = buckets.bucketed_neighbours(_frame(spark, x, 7), "id", "vec", 4, block=block)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))
    copies = [r for r in whole.collect() if 300 <= r.id < 390]
    assert {r.distance for r in copies} == {0.0} and {r.neighbour for r in copies} <= set(range(300, 305))


def test_text_keys(spark):
    rows = spark.createDataFrame([(f"k{i}", [float(i), 0.0]) for i in range(9)], "id string, vec array<double>")
    found = {(r.id, r["rank"]): r.neighbour for r in buckets.bucketed_neighbours(rows, "id", "vec", 2).collect()}
    assert found["k4", 1] == "k3" and found["k4", 2] == "k5"


def test_resampling_by_buckets(spark):
    x = _groups(900, 8, 5)
    df = _frame(spark, x)
    made = balance.smote(df, "id", "vec", "y", search="bucketed").collect()
    assert len(made) == (df.where("y = 0").count() - df.where("y = 1").count())
    for r in made[:50]:
        assert r.vec == pytest.approx((x[r.parent] + (x[r.neighbour] - x[r.parent]) * r.gap).tolist())
    exact = {tuple(r) for r in balance.tomek_links(df, "id", "vec", "y").collect()}
    found = {tuple(r) for r in balance.tomek_links(df, "id", "vec", "y", search="bucketed").collect()}
    assert len(exact & found) >= 0.9 * len(exact)
    assert balance.smote_tomek(df, "id", "vec", "y", search="bucketed").count() > 900


def _written(spark):
    folder = f"{shared_folder(spark)}/tidemark-{spark.sparkContext.applicationId}"
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}


def test_tables_on_the_way_hold_a_row_once(spark):
    x = _groups(1500, 32, 4).astype(np.float32).astype(float)
    before = _written(spark)
    assert buckets.bucketed_neighbours(_frame(spark, x), "id", "vec", 5).count() == 7500
    # the vectors, and beside them the sums of the cells' projections (576 bytes); not the 72 rows that are searched
    assert sum(n for f, n in _written(spark).items() if f not in before) < 1500 * (2 * 32 * 8 + 576)


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_cells_cut_in_a_task_or_as_tables(spark, kind):
    rng = np.random.default_rng(7)
    x = np.concatenate([_groups(500, 12, 6), np.arange(12.0) + rng.normal(size=(400, 12)) * 1e-3, np.tile(np.arange(12.0), (30, 1))]).astype(kind).astype(float)
    df = _frame(spark, x).select(F.concat(F.lit("k"), "id").alias("id"), "vec")
    whole = sorted(map(tuple, buckets.bucketed_neighbours(df, "id", "vec", 4, bucket=8).collect()))
    for crowd, block in ((0, 2000), (200, 50)):
        assert whole == sorted(map(tuple, buckets.bucketed_neighbours(df, "id", "vec", 4, block=block, bucket=8, crowd=crowd).collect()))


def test_whole_coordinates_are_those_of_the_table(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(200, 4)), (rng.integers(-50, 50, size=(200, 4)) + 0.5) / 1e6, [[0.49999999999999994e-6, -0.0, 0.1234565, -2.5e-6]]])
    rounded = F.transform("vec", lambda v: F.round(v * 1_000_000).cast("long"))
    there = {r.id: r.w for r in _frame(spark, x).select("id", rounded.alias("w")).collect()}
    assert buckets._further(x, np.eye(4), 1_000_000).tolist() == [there[i] for i in range(len(x))]
