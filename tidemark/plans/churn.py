"""The three jobs a churn team runs: train, score, watch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.operators import evaluate as ev
from tidemark.operators import train as tr
from tidemark.operators.clean import binary_target, conform, drop_null_target
from tidemark.operators.drift import drift_overall, drift_report
from tidemark.operators.prep import stratified_split
from tidemark.roles import Roles


def train_and_evaluate(
    customers: DataFrame, roles: Roles, spec: tr.ModelSpec, k: int = 5, test_size: float = 0.2, **columns
) -> tr.ChurnModel:
    """Split, cross-validate on the training part, fit, pick the threshold on
    out-of-fold scores, and measure on the test part."""
    clean = binary_target(drop_null_target(customers, roles.target), roles.target, roles.positive)
    rows = staged(stratified_split(clean, roles.key, roles.target, test_size, spec.seed), "split")
    train, test = (rows.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    oof = tr.out_of_fold(train, roles, spec, k, **columns)
    model = tr.fit_model(train, roles, spec, **columns)
    model.threshold = float(ev.best_threshold(ev.score_ledger(oof)).first().threshold)
    model.cv_metrics = tr.cross_validate(oof)
    scored = staged(model.scores(test), "scores")
    row = ev.evaluate(scored, model.threshold).drop("model").first().asDict()
    model.test_metrics = {name: float(v) for name, v in row.items()}
    return model


def score_batch(customers: DataFrame, model: tr.ChurnModel, expected: Sequence[str] | None = None) -> DataFrame:
    """Contract check, then (key, p, prediction, risk, confidence)."""
    rows = conform(customers, list(expected), strict=False) if expected else customers
    return ev.risk_bands(model.score(rows), "p", model.threshold)


def watch(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(report per column, one-row summary)."""
    report = staged(drift_report(reference, current, numeric, categorical), "drift")
    return report, drift_overall(report)
