import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import balance, neighbours, prep


def _vectors(spark, x, y=None):
    rows = [(i, [float(v) for v in r], 0 if y is None else int(y[i])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "k long, vec array<double>, y int")


def _brute(x, k):
    out = {}
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        out[i] = list(np.lexsort((np.arange(len(x)), d))[:k])
    return out


@pytest.mark.parametrize("kind", ["spread", "ties", "copies"])
def test_neighbours_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "_CELL", 40)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(260, 3)).round(2)
    if kind == "ties":
        x = x.round(0)
    if kind == "copies":
        x[:90] = x[0]
    got = {}
    for r in neighbours.nearest_neighbours(_vectors(spark, x), "k", "vec", 3, block=60).collect():
        got.setdefault(r.k, []).append((r["rank"], r.neighbour))
    assert {i: [n for _, n in sorted(v)] for i, v in got.items()} == _brute(x, 3)


def test_search_writes_no_row_per_cell(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_CELL", 40)
    written, staged = {}, neighbours.staged

    def counted(df, label):
        done = staged(df, label)
        written[label] = done.count()
        return done

    monkeypatch.setattr(neighbours, "staged", counted)
    x = np.random.default_rng(4).normal(size=(1200, 24))
    got = neighbours.nearest_neighbours(_vectors(spark, x), "k", "vec", 1, block=60).collect()
    assert {r.k: [r.neighbour] for r in got} == _brute(x, 1)
    assert max(written.values()) <= len(x)


def test_coordinates_that_are_no_numbers(spark):
    x = np.array([[0.0, 1.0], [0.0, 1.5], [float("nan"), 1.0], [float("inf"), 1.0], [1e200, 1.0]])
    got = neighbours.nearest_neighbours(_vectors(spark, x), "k", "vec", 1).collect()
    assert {(r.k, r.neighbour) for r in got} == {(0, 1), (1, 0)}


def test_few_points(spark):
    assert neighbours.nearest_neighbours(_vectors(spark, np.zeros((1, 2))), "k", "vec", 3).collect() == []
    got = neighbours.nearest_neighbours(_vectors(spark, np.array([[0.0], [1.0], [3.0]])), "k", "vec", 5)
    assert got.count() == 6


def test_smote_balances_on_segments(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(140, 2)), np.array([1] * 30 + [0] * 110)
    rows = _vectors(spark, x, y)
    made = balance.smote(rows, "k", "vec", "y").collect()
    assert len(made) == 80 and {r.y for r in made} == {1}
    near = _brute(x[:30], 5)
    for r in made:
        assert r.neighbour in near[r.parent] and 0 <= r.gap < 1
        assert np.allclose(r.vec, x[r.parent] + (x[r.neighbour] - x[r.parent]) * r.gap)
    per = np.bincount([r.parent for r in made])
    assert set(per) == {2, 3}
    again = balance.smote(rows.repartition(5), "k", "vec", "y").collect()
    assert sorted(map(str, made)) == sorted(map(str, again))
    assert balance.smote(_vectors(spark, x[:60], [0, 1] * 30), "k", "vec", "y").count() == 0


def test_tomek_links(spark):
    x = np.array([[0.0], [0.1], [5.0], [5.2], [9.0], [9.3], [9.5]])
    y = [0, 1, 1, 1, 0, 0, 1]
    rows = _vectors(spark, x, y)
    assert [tuple(r) for r in sorted(balance.tomek_links(rows, "k", "vec", "y").collect())] == [(0, 1), (5, 6)]
    assert sorted(r.k for r in balance.drop_tomek(rows, "k", "vec", "y").collect()) == [2, 3, 4]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "y int")
    table = {r.y: (r.balanced, r.pos_weight) for r in balance.class_weights(df, "y").collect()}
    assert table == {1: (2.0, 3.0), 0: (8 / 12, 1.0)}
    assert balance.with_weights(df, "y").agg(F.sum("weight")).first()[0] == pytest.approx(8)


def test_split_and_folds(spark):
    df = spark.range(100).select("id", (F.col("id") < 30).cast("int").alias("y"))
    sizes = {(r.y, r.split): r["count"] for r in prep.stratified_split(df, "id", "y").groupBy("y", "split").count().collect()}
    assert sizes == {(0, "test"): 14, (0, "train"): 56, (1, "test"): 6, (1, "train"): 24}
    folds = prep.assign_folds(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds if r.y == 1} == {6} and len(folds) == 10


def test_fills_and_scales(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (2.0, None), (None, "a"), (7.0, "b")], "x double, c string")
    assert prep.numeric_fills(df, ["x"], "mean") == {"x": 3.0}
    assert prep.numeric_fills(df, ["x"], "median") == {"x": 2.0}
    assert prep.numeric_fills(df, ["x"], "most_frequent") == {"x": 2.0}
    assert prep.categorical_fills(df, ["c"], "most_frequent") == {"c": "a"}
    assert prep.categorical_fills(df, ["c"]) == {"c": "missing"}
    filled = np.array([1, 2, 2, 2, 7.0])
    fills = {"x": 2.0}
    s = prep.scales(df, ["x"], "standard", fills)["x"]
    assert (s.centre, s.spread) == pytest.approx((filled.mean(), filled.std()))
    s = prep.scales(df, ["x"], "minmax", fills)["x"]
    assert (s.centre, s.spread) == (1.0, 6.0)
    s = prep.scales(df, ["x"], "robust", fills)["x"]
    assert (s.centre, s.spread) == (2.0, 1.0)
    assert prep.scales(df, ["x"], None, fills) == {}
    for bad in (lambda: prep.scales(df, ["x"], "other", fills), lambda: prep.numeric_fills(df, ["x"], "other")):
        with pytest.raises(ValueError):
            bad()


def test_encodings(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "c string")
    test = spark.createDataFrame([("c",), ("z",), (None,)], "c string")
    known = prep.known_categories(train, ["c"])
    assert known == {"c": ["a", "b", "c"]}
    assert [tuple(r) for r in prep.one_hot(test, ["c"], known).collect()] == [(0, 0, 1), (0, 0, 0), (0, 0, 0)]
    assert prep.one_hot(test, ["c"], known, drop_first=True).columns == ["c_b", "c_c"]
    with pytest.raises(Exception, match="unknown value"):
        prep.one_hot(test, ["c"], known, unknown="error").collect()
    codes = prep.category_codes(train, ["c"])
    assert sorted(r.c for r in prep.with_codes(test, codes, ["c"]).collect()) == [-1, -1, 2]
    assert prep.one_hot_long(train.withColumn("id", F.lit(1)), "id", ["c"]).count() == 3


@pytest.mark.parametrize("kind", ["spread", "ties", "alike", "mixed", "small"])
def test_blocks_that_meet_find_what_each_side_finds(kind):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 5))
    if kind == "ties":
        x = rng.integers(0, 3, (1500, 5)).astype(float)
    if kind == "alike":
        x = 1 + 1e-9 * x
    if kind == "mixed":
        x = x * 10.0 ** rng.integers(-6, 6, (1500, 1))
    if kind == "small":
        x = x * 1e-160
    a, b, names_a, names_b = x[:300], x[300:], np.arange(300), np.arange(250, 1450)
    for k in (1, 4):
        open_a, open_b = np.full(len(a), np.inf), np.full(len(b), np.inf)
        balls = [np.zeros(len(v)) for v in (a, b)]
        for ball, (v, names, wide) in zip(balls, ((a, names_a, open_a), (b, names_b, open_b))):
            row, _, d = neighbours._closer(v, wide, names, v, names, k)
            np.maximum.at(ball, row, d)
        met = neighbours._meet(a, balls[0], names_a, b, balls[1], names_b, k)
        each = [neighbours._closer(a, balls[0], names_a, b, names_b, k), neighbours._closer(b, balls[1], names_b, a, names_a, k)]
        for ball, got, want in zip(balls, met, each):
            within = [[tuple(v) for v in zip(*found) if v[2] <= ball[v[0]]] for found in (got, want)]
            assert within[0] == within[1] and within[0]


def test_a_pair_of_blocks_is_multiplied_once(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_CELL", 40)

    def refused(*given):
        if given[0] is not given[3]:
            raise ValueError("two blocks searched one way at a time")
        return closer(*given)

    closer = neighbours._closer
    monkeypatch.setattr(neighbours, "_closer", refused)
    x = np.random.default_rng(4).normal(size=(1200, 24))
    got = neighbours.nearest_neighbours(_vectors(spark, x), "k", "vec", 1, block=60).collect()
    assert {r.k: [r.neighbour] for r in got} == _brute(x, 1)
