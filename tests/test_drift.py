import math

import numpy as np
import pytest

from tidemark.operators import drift, reference
from tidemark.roles import DRIFT_ADVICE


def _frame(spark, **columns):
    names = list(columns)
    kinds = ["double" if isinstance(columns[c][0], float) else "string" for c in names]
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _psi(ref, cur, bins=10):
    _, edges = np.histogram(ref, bins)
    e = np.clip(np.histogram(ref, edges)[0] / len(ref), 1e-6, 1)
    a = np.clip(np.histogram(cur, edges)[0] / len(cur), 1e-6, 1)
    return float(((a - e) * np.log(a / e)).sum())


@pytest.mark.parametrize("shift", [0.0, 3.0])
def test_numeric_psi_against_numpy(spark, shift):
    rng = np.random.default_rng(3)
    ref, cur = rng.normal(0, 1, 600).round(2), (rng.normal(0, 1, 300) + shift).round(2)
    got = drift.psi_numeric(_frame(spark, x=ref.tolist()), _frame(spark, x=cur.tolist()), ["x"]).first().psi
    assert got == pytest.approx(_psi(ref, cur))
    assert drift.psi_numeric(_frame(spark, x=ref.tolist()), _frame(spark, x=ref.tolist()), ["x"]).first().psi == 0


def test_small_pair_and_constant(spark):
    ref, cur = [1.0, 2.0, 3.0, 4.0, 5.0], [2.0, 3.0, 4.0, 5.0, 6.0]
    assert drift.psi_numeric(_frame(spark, x=ref), _frame(spark, x=cur), ["x"]).first().psi == pytest.approx(_psi(ref, cur))
    flat = [7.0] * 5
    assert drift.psi_numeric(_frame(spark, x=flat), _frame(spark, x=cur), ["x"]).first().psi == pytest.approx(_psi(flat, cur))


def test_categorical_psi(spark):
    ref, cur = ["a"] * 6 + ["b"] * 4, ["a"] * 3 + ["c"] * 7
    want = 0.0
    for c in "abc":
        e, a = max(ref.count(c) / 10, 1e-6), max(cur.count(c) / 10, 1e-6)
        want += (a - e) * math.log(a / e)
    assert drift.psi_categorical(_frame(spark, x=ref), _frame(spark, x=cur), ["x"]).first().psi == pytest.approx(want)


def _ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    return max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)


def test_ks_against_enumeration(spark):
    rng = np.random.default_rng(4)
    ref, cur = rng.normal(0, 1, 300).round(1), rng.normal(1.0, 1, 200).round(1)
    row = drift.ks_numeric(_frame(spark, x=ref.tolist()), _frame(spark, x=cur.tolist()), ["x"]).first()
    assert row.ks == pytest.approx(_ks(ref, cur)) and 0 <= row.ks_pvalue < 0.05
    same = drift.ks_numeric(_frame(spark, x=ref.tolist()), _frame(spark, x=ref.tolist()), ["x"]).first()
    assert (same.ks, same.ks_pvalue) == (0.0, 1.0)
    r, c = np.array(list("aabbc")), np.array(list("abccc"))
    codes = {"a": 0, "b": 1, "c": 2}
    got = drift.ks_categorical(_frame(spark, x=r.tolist()), _frame(spark, x=c.tolist()), ["x"]).first().ks
    assert got == pytest.approx(_ks(np.vectorize(codes.get)(r), np.vectorize(codes.get)(c)))


def test_report_and_summary(spark):
    rng = np.random.default_rng(6)
    ref = _frame(spark, a=rng.normal(0, 1, 400).tolist(), b=rng.normal(0, 1, 400).tolist(), c=["u", "v"] * 200)
    cur = _frame(spark, a=rng.normal(3, 1, 200).tolist(), b=rng.normal(0, 1, 200).tolist(), c=["u"] * 199 + ["w"])
    report = drift.drift_report(ref, cur, ["a", "b", "missing"], ["c"])
    rows = {r.feature: r for r in report.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].severity, rows["a"].has_drift, rows["a"].ks_significant) == ("high", 1, 1)
    summary = drift.drift_overall(report).first()
    assert summary.overall_severity == "high" and summary.features_checked == 3
    assert summary.recommendation == DRIFT_ADVICE["high"]
    calm = drift.drift_overall(drift.drift_report(ref, ref, ["a", "b"])).first()
    assert (calm.overall_severity, calm.drift_percentage, calm.features_with_drift) == ("none", 0.0, 0)


def test_levels(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.2,), (0.25,)], "psi double")
    assert [r[0] for r in df.select(drift.drift_severity(df.psi)).collect()] == ["none", "low", "moderate", "high"]


def test_windows_equal_pairwise_psi(spark):
    """A window's PSI equals the two-table PSI, also with absent and new categories."""
    ref = _frame(spark, x=[float(v) for v in range(40)], c=list("aabb") * 10)
    cur = [(f"2024-01-0{1 + i % 2} 10:00:00", float(i * 3 % 55), "ax"[i % 2]) for i in range(31)]
    stream = spark.createDataFrame(cur, "t string, x double, c string").selectExpr("CAST(t AS timestamp) AS ts", "x", "c")
    got = {(r.window_start.day, r.feature): r.psi for r in drift.drift_by_window(ref, stream, "ts", ["x"], ["c"]).collect()}
    for day in (1, 2):
        part = stream.where(f"day(ts) = {day}")
        assert got[(day, "x")] == pytest.approx(drift.psi_numeric(ref, part, ["x"]).first().psi)
        assert got[(day, "c")] == pytest.approx(drift.psi_categorical(ref, part, ["c"]).first().psi)


def _by_orderings(steps, n, m):
    """Share of all orderings of n and m rows with a gap of at least steps / (n m)."""
    from itertools import combinations

    hits = total = 0
    for chosen in combinations(range(n + m), n):
        i = j = worst = 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in chosen else (i, j + 1)
            worst = max(worst, abs(i * m - j * n))
        hits += worst >= steps
        total += 1
    return hits / total


@pytest.mark.parametrize("n, m", [(1, 1), (2, 3), (4, 4), (5, 3), (6, 4)])
def test_exact_p_counts_orderings(n, m):
    for steps in range(n * m + 2):
        assert drift.exact_p(steps, n, m) == pytest.approx(_by_orderings(steps, n, m), abs=1e-12)


def test_exact_p_of_a_frame(spark):
    ref, cur = _frame(spark, x=[1.0, 2.0, 3.0, 4.0]), _frame(spark, x=[5.0, 6.0, 7.0, 8.0])
    apart = drift.ks_numeric(ref, cur, ["x"], exact=True).first()
    # 2 of 70 orderings keep four and four apart
    assert (apart.ks, apart.ks_pvalue) == (1.0, pytest.approx(2 / 70))
    rng = np.random.default_rng(1)
    many = [_frame(spark, x=rng.normal(0, 1, 400).tolist()), _frame(spark, x=rng.normal(0.1, 1, 300).tolist())]
    exact, limit = (drift.ks_numeric(*many, ["x"], exact=e).first().ks_pvalue for e in (True, False))
    assert exact == pytest.approx(limit, abs=0.03)
    assert drift.drift_report(ref, cur, ["x"], exact=True).first().ks_pvalue == pytest.approx(0.0286)


@pytest.mark.parametrize("slab", [7, 100_000])
def test_stored_reference_equals_two_tables(spark, tmp_path, monkeypatch, slab):
    monkeypatch.setattr(reference, "SLAB", slab)
    rng = np.random.default_rng(8)
    letters = lambda n: rng.choice(list("abcde"), n).tolist()
    ref = _frame(spark, a=rng.normal(0, 1, 500).round(1).tolist(), b=rng.normal(0, 1, 500).tolist(), c=letters(500), d=["x"] * 500)
    more = _frame(spark, a=rng.normal(1, 3, 90).round(1).tolist(), b=rng.normal(0, 1, 90).tolist(), c=letters(90), d=["y"] * 90)
    batches = [
        _frame(spark, a=rng.normal(0.5, 2, 200).round(1).tolist(), b=rng.normal(0, 1, 200).tolist(), c=letters(200), d=["x", "z"] * 100),
        _frame(spark, a=[99.0, -99.0, 0.0], b=[0.5, 0.5, 0.5], c=["q", "q", "a"], d=["x", "x", "x"]),
        _frame(spark, a=[50.0, 50.0], b=[-50.0, 0.1], c=["a", "b"], d=["x", "x"]),
    ]
    names = (["a", "b"], ["c", "d"])
    ref.write.parquet(str(tmp_path / "rows"))
    stored = reference.store_reference(spark.read.parquet(str(tmp_path / "rows")), *names, str(tmp_path / "store"))
    import os

    for name in os.listdir(tmp_path / "rows"):  # the rows themselves are not read again
        os.truncate(tmp_path / "rows" / name, 0)
    both = stored.merged(more, str(tmp_path / "merged"))
    pairs = [(ref, stored, b) for b in (batches if slab == 7 else batches[:1])] + [(ref.unionByName(more), both, batches[0])]
    for old, store, batch in pairs:
        want = sorted(map(tuple, drift.drift_report(old, batch, *names).collect()))
        assert sorted(map(tuple, store.report(batch).collect())) == want
    only = stored.report(batches[0].select("b")).collect()
    assert [r.feature for r in only] == ["b"]
    with pytest.raises(ValueError):
        stored.report(batches[0].selectExpr("a AS other"))
