"""Score metrics against plain enumeration of pairs and thresholds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluate as ev


def _scores(spark, y, p, model="m"):
    return spark.createDataFrame([(i, model, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "id long, model string, y int, p double")


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 400)
    p = np.clip(np.round(0.3 * y + rng.random(400) * 0.7, 2), 0, 1)
    return y, p


@pytest.fixture(scope="module")
def ledger(spark, sample):
    return ev.score_ledger(_scores(spark, *sample))


def _counts(y, p, t):
    hit = p >= t
    return int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()), int((~hit & (y == 1)).sum())


def test_auc_is_the_share_of_ordered_pairs(ledger, sample):
    y, p = sample
    a, b = p[y == 1][:, None], p[y == 0][None, :]
    assert ev.roc_auc(ledger).first().roc_auc == pytest.approx(((a > b) + 0.5 * (a == b)).mean())


def test_auc_of_reversed_scores(spark, sample, ledger):
    y, p = sample
    back = ev.roc_auc(ev.score_ledger(_scores(spark, y, 1 - p))).first().roc_auc
    assert back + ev.roc_auc(ledger).first().roc_auc == pytest.approx(1)


def test_areas_under_pr(ledger, sample):
    y, p = sample
    points = []
    for t in sorted(set(p)):
        tp, fp, fn = _counts(y, p, t)
        points.append((tp / (tp + fn), tp / (tp + fp)))
    points.append((0.0, 1.0))
    step = sum((r - r2) * pr for (r, pr), (r2, _) in zip(points, points[1:]))
    trap = sum((r - r2) * (pr + pr2) / 2 for (r, pr), (r2, pr2) in zip(points, points[1:]))
    assert ev.average_precision(ledger).first().auprc == pytest.approx(step)
    assert ev.pr_auc_trapezoid(ledger).first().pr_auc == pytest.approx(trap)
    curve = ev.pr_curve(ledger).orderBy(F.asc_nulls_last("threshold")).collect()
    assert np.allclose([(c.recall, c.precision) for c in curve], points)


def test_curve_is_the_same_for_any_partitioning(spark, sample):
    one = ev.roc_curve(ev.score_ledger(_scores(spark, *sample).repartition(1)))
    many = ev.roc_curve(ev.score_ledger(_scores(spark, *sample).repartition(8)))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_thresholds(ledger, sample):
    y, p = sample

    def f(t, b):
        tp, fp, fn = _counts(y, p, t)
        pr, rc = tp / (tp + fp), tp / (tp + fn)
        return (1 + b * b) * pr * rc / (b * b * pr + rc + 1e-10)

    ts = sorted(set(p))
    best = ev.best_threshold(ledger).first()
    assert best.threshold == max(ts, key=lambda t: (f(t, 1.0), -t)) and best.score == pytest.approx(f(best.threshold, 1.0))
    assert ev.best_threshold(ledger, "recall").first().threshold == ts[0]
    for r in ev.fbeta_thresholds(ledger).collect():
        assert r.threshold == max(ts, key=lambda t: (f(t, r.beta), -t))


def test_money(spark, ledger, sample):
    y, p = sample
    terms = spark.createDataFrame([(600.0, 30.0, 0.3)], "value double, cost double, success double")

    def loss(t):
        tp, fp, fn = _counts(y, p, t)
        return fn * 600 + tp * 0.7 * 600 + (tp + fp) * 30

    best = ev.business_threshold(ledger, terms).first()
    assert best.loss == pytest.approx(min(loss(t) for t in set(p)))
    sweep = ev.loss_sweep(_scores(spark, *sample), terms).orderBy("threshold").collect()
    assert len(sweep) == 200 and sweep[0].threshold == 0.1 and sweep[-1].threshold == pytest.approx(0.9)
    assert [r.net_loss for r in sweep] == pytest.approx([loss(r.threshold) for r in sweep])
    plan = spark.createDataFrame([("m", "a", 0.5), ("m", "b", 0.9)], "model string, strategy string, threshold double")
    impact = {r.strategy: r for r in ev.financial_impact(_scores(spark, *sample), plan, terms).collect()}
    assert impact["a"].net_loss == pytest.approx(loss(0.5))
    assert impact["a"].savings == pytest.approx(y.sum() * 600 - loss(0.5))


def test_confusion_and_report(spark):
    scores = _scores(spark, [1, 1, 1, 0, 0, 0], [0.9, 0.8, 0.1, 0.7, 0.2, 0.3])
    row = ev.evaluate(scores).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 2)
    assert (row.accuracy, row.precision, row.recall, row.f1_score, row.specificity) == pytest.approx([2 / 3] * 5)
    report = {r.label: r for r in ev.class_report(scores).collect()}
    assert report["0"].support == 3 and report["weighted avg"].f1_score == pytest.approx(2 / 3)
    cells = {(r.y, r.pred): r.share for r in ev.confusion_matrix(scores).collect()}
    assert cells[(1, 1)] == pytest.approx(2 / 3)


def test_nothing_flagged_gives_zero(spark):
    row = ev.evaluate(_scores(spark, [1, 0], [0.1, 0.2])).first()
    assert (row.precision, row.recall, row.f1_score) == (0.0, 0.0, 0.0)
    only = ev.evaluate(_scores(spark, [0, 0], [0.1, 0.2])).first()
    assert only.recall == 0.0 and only.roc_auc is None


def test_model_choice(spark):
    rows = [("a", 0.60, 0.80, 0.50, 0.9), ("b", 0.62, 0.85, None, 0.7), ("c", 0.50, 0.70, 0.40, 0.9)]
    table = spark.createDataFrame(rows, "model string, f1_score double, roc_auc double, auprc double, recall double")
    got = {r.model: (r.wins, r.best) for r in ev.best_model_wins(table).collect()}
    # a: auprc, recall (first name on a tie); b: f1, auc; the tie goes to the higher F1
    assert got == {"a": (2, 0), "b": (2, 1), "c": (0, 0)}
    assert [r.model for r in ev.model_ranking(table).orderBy("rank").collect()] == ["b", "a", "c"]
    delta = {r.metric: r.delta for r in ev.metric_delta(table, "b", "a").collect()}
    assert delta["roc_auc"] == pytest.approx(0.05) and delta["auprc"] is None


def test_risk_bands(spark):
    rows = ev.risk_bands(_scores(spark, [0] * 5, [0.7, 0.69999, 0.4, 0.39, 1.0])).orderBy("id").collect()
    assert [r.risk for r in rows] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "HIGH"]
    assert [r.prediction for r in rows] == [1, 1, 0, 0, 1]
    assert rows[4].confidence == 1.0 and rows[1].p == 0.7
    summary = ev.score_summary(_scores(spark, [0] * 3, [0.7, 0.9, 0.1]), "id").first()
    assert tuple(summary) == (3, 2, 1, 2)


def test_no_raw_rows_in_one_task(spark, sample):
    """Raw scores are only exchanged by hash or range, never to a single partition."""
    plan = ev.roc_auc(ev.score_ledger(_scores(spark, *sample)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
