"""Quantiles and sums of many columns from sorted or joined columns, against the ledgers and plain loops."""

import numpy as np
import pytest

from tidemark.functions import points
from tidemark.functions.brackets import exact_quantile_columns, numeric_cells
from tidemark.operators import boost, prep

PROBS = {"p0": 0.0, "p1": 0.25, "p2": 0.5, "p3": 0.75, "p4": 1.0, "p5": 0.013}
SCHEMA = "fold int, name string, y double, weight double, held boolean, x array<double>"


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(1)
    rows = [
        (float(rng.normal()), float(rng.integers(0, 3)), None, str(i % 900 / 7) if i % 3 else "x", float("nan") if i % 3 else float(i), 5, 0.0 if i % 2 else -0.0, float("inf") if i == 7 else float(i % 11))
        for i in range(1500)
    ]
    return spark.createDataFrame(rows, "a double, b double, c double, d string, e double, f int, g double, h double").repartition(4)


@pytest.mark.parametrize("most, size", [(10_000, 32 << 20), (7, 1), (2, 9000)])
def test_quantiles_equal_the_ledger(odd, monkeypatch, most, size):
    monkeypatch.setattr(points, "POINTS", most)
    monkeypatch.setattr(points, "SORTED", size)
    ledger = exact_quantile_columns(numeric_cells(odd, odd.columns), PROBS, "value", ["feature"]).collect()
    want = {r.feature: {q: str(r[name]) for name, q in PROBS.items()} for r in ledger}
    got = points.column_quantiles(odd, odd.columns, list(PROBS.values()))
    assert {c: {q: str(v) for q, v in found.items()} for c, found in got.items()} == want and "c" not in got


def test_fills_and_scales_make_no_row_of_a_cell(odd, monkeypatch):
    def refused(*_):
        raise AssertionError("cells listed as rows")

    monkeypatch.setattr(type(odd), "unpivot", refused)
    fills = prep.numeric_fills(odd, odd.columns)
    assert fills["f"] == 5 and "c" not in fills
    assert prep.scales(odd, ["e", "f"], "robust", fills)["f"] == prep.Scale(5.0, 1.0)


def test_bins_follow_the_edges(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)).round(2)
    x[::7, 1], x[:, 2] = np.nan, 4.0
    rows = [(i % 2, str(i), float(i % 3 == 0), 1.0, i % 5 == 0, x[i].tolist()) for i in range(400)]
    boosting = boost.Boosting(spark.createDataFrame(rows, SCHEMA).repartition(3), [boost.Setting()])
    seen = {r.name: (r.fold, list(r.bins), np.frombuffer(r.margins)) for r in boosting.state.collect()}
    assert len(seen) == 400
    for i in range(400):
        fold, bins, margins = seen[str(i)]
        edges = boosting.edges[fold]
        assert bins == [0 if np.isnan(v) else int((e < v).sum()) for e, v in zip(edges, x[i])]
        assert margins.tolist() == [boosting.base[fold]]
    known = np.sort(x[[i for i in range(400) if i % 2 == 0 and i % 5], 0])
    wanted = np.unique([known[int(np.ceil(len(known) * k / 32)) - 1] for k in range(1, 32)])
    assert boosting.edges[0][0].tolist() == wanted.tolist() and len(boosting.edges[0][2]) == 0


def test_columns_share_cells():
    widths = np.array([32, 2, 32, 1, 8, 2, 2, 32])
    groups = boost.shared_cells(widths, boost.CELLS)
    assert sorted(c for g in groups for c in g) == list(range(8)) and len(groups) == 3
    assert all(widths[g].prod() <= boost.CELLS for g in groups)
    assert len(boost.shared_cells(widths, boost.BINS)) == 5


def test_passes_read_no_names_and_sums_may_meet_on_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3))
    rows = spark.createDataFrame([(i % 2, str(i), float(x[i, 0] > 0), 1.0, i % 4 == 0, x[i].tolist()) for i in range(200)], SCHEMA)
    plain, found = boost._pass, []

    def checked(batches, plan):
        def through():
            for batch in batches:
                if "name" in batch.schema.names:
                    raise ValueError("a pass reads names")
                yield batch

        return plain(through(), plan)

    monkeypatch.setattr(boost, "_pass", checked)
    for sent in (0, 1 << 20):
        monkeypatch.setattr(boost, "SENT", sent)
        boosting = boost.Boosting(rows, [boost.Setting(3, 2, 0.3), boost.Setting(3, 3, 0.1)])
        boosting.run(3, [0, 1])
        found.append([(p, t.columns.tolist(), t.cuts.tolist(), t.leaves.round(9).tolist()) for p, own in boosting.trees.items() for t in own])
    assert found[0] == found[1] and len(found[0]) == 12
