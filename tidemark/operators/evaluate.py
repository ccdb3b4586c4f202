"""Exact evaluation of score tables (y in 0/1, probability p), per model.

Everything that needs an order by score reads one ledger: positives and
negatives per distinct score with their running sums. A row then knows the
whole confusion matrix at its own score as threshold, and at the next higher
one, so curves need no lag and areas are plain sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.ledger import value_ledger
from tidemark.functions.shape import rows_of, share
from tidemark.functions.stage import staged
from tidemark.roles import RISK_BAND_HIGH, RISK_BAND_MEDIUM

EPS = 1e-10


def usable(scores: DataFrame) -> DataFrame:
    """Rows with a label and a score; NaN is no score. Every operator of this module starts here."""
    return scores.where(F.col("y").isNotNull() & F.col("p").isNotNull() & ~F.isnan("p"))


def score_ledger(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by, p, pos, neg) per distinct score with running sums."""
    y = F.col("y").cast("long")
    return value_ledger(usable(scores), "p", {"pos": F.sum(y), "neg": F.sum(1 - y)}, by)


def threshold_counts(ledger: DataFrame) -> DataFrame:
    """Add tp, fp, fn, tn of the rule ``score >= p`` to each ledger row."""
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    return ledger.select(
        "*",
        tp.alias("tp"),
        fp.alias("fp"),
        (F.col("tot_pos") - tp).alias("fn"),
        (F.col("tot_neg") - fp).alias("tn"),
    )


def _precision() -> Column:
    return share(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return share(F.col("tp"), F.col("tot_pos"))


def roc_auc(ledger: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties one half."""
    above = (F.col("tot_pos") - F.col("cum_pos")) * 2 + F.col("pos")
    pairs = F.sum(F.col("neg").cast("double") * above)
    whole = F.max(F.col("tot_pos").cast("double") * F.col("tot_neg") * 2)
    return ledger.groupBy(*by).agg(F.try_divide(pairs, whole).alias("roc_auc"))


def average_precision(ledger: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Sum of recall steps times precision over the distinct scores."""
    step = share(F.col("pos"), F.col("tot_pos")) * _precision()
    return threshold_counts(ledger).groupBy(*by).agg(F.sum(step).alias("auprc"))


def roc_curve(ledger: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; the origin has no threshold."""
    points = threshold_counts(ledger).select(
        *by,
        F.col("p").alias("threshold"),
        share(F.col("fp"), F.col("tot_neg")).alias("fpr"),
        _recall().alias("tpr"),
    )
    origin = (
        ledger.groupBy(*by)
        .agg(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
        .withColumn("threshold", F.lit(None).cast("double"))
    )
    return points.unionByName(origin)


def pr_curve(ledger: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, and the end point (1, 0)."""
    points = threshold_counts(ledger).select(
        *by, F.col("p").alias("threshold"), _precision().alias("precision"), _recall().alias("recall")
    )
    end = (
        ledger.groupBy(*by)
        .agg(F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
        .withColumn("threshold", F.lit(None).cast("double"))
    )
    return points.unionByName(end)


def pr_auc_trapezoid(ledger: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Area under the PR curve by trapezoids, each row paired with the next higher score."""
    tp2 = F.col("tot_pos") - F.col("cum_pos")
    fp2 = F.col("tot_neg") - F.col("cum_neg")
    next_precision = F.when(tp2 + fp2 == 0, F.lit(1.0)).otherwise(share(tp2, tp2 + fp2))
    width = share(F.col("pos"), F.col("tot_pos"))
    area = width * (_precision() + next_precision) / 2
    return threshold_counts(ledger).groupBy(*by).agg(F.sum(area).alias("pr_auc"))


def confusion_counts(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",)) -> DataFrame:
    """tp, fp, fn, tn of ``p >= threshold`` in one aggregate."""
    hit, pos = F.col("p") >= F.lit(float(threshold)), F.col("y") == 1
    return usable(scores).groupBy(*by).agg(
        F.count_if(hit & pos).alias("tp"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(~hit & ~pos).alias("tn"),
    )


def ledger_counts(ledger: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",)) -> DataFrame:
    """The counts of ``confusion_counts`` from a ledger."""
    flagged = F.col("p") >= F.lit(float(threshold))
    counts = {"tp": (flagged, "pos"), "fp": (flagged, "neg"), "fn": (~flagged, "pos"), "tn": (~flagged, "neg")}
    return ledger.groupBy(*by).agg(*[F.sum(F.when(on, F.col(n)).otherwise(0)).alias(c) for c, (on, n) in counts.items()])


def confusion_matrix(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",)) -> DataFrame:
    """Rows per (y, pred) and their share of the actual class."""
    pred = (F.col("p") >= F.lit(float(threshold))).cast("int")
    counts = (
        usable(scores)
        .groupBy(*by, "y", pred.alias("pred"))
        .agg(F.count("*").alias("n"))
    )
    # two rows per actual class
    whole = F.sum("n").over(Window.partitionBy(*by, "y"))
    return counts.select(*by, "y", "pred", "n", (F.col("n") / whole).alias("share"))


def _f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def metrics_from_counts(counts: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """accuracy, precision, recall, f1, specificity; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p, r = share(tp, tp + fp), share(tp, tp + fn)
    return counts.select(
        *by,
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        p.alias("precision"),
        r.alias("recall"),
        _f1(p, r).alias("f1_score"),
        share(tn, tn + fp).alias("specificity"),
        "tp",
        "fp",
        "fn",
        "tn",
    )


def evaluate(
    scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",), ledger: DataFrame | None = None
) -> DataFrame:
    """All metrics per model at one threshold, with both areas, from one scan of the scores."""
    ledger = staged(score_ledger(scores, by), "ledger") if ledger is None else ledger
    # one row per model in each table
    return (
        metrics_from_counts(ledger_counts(ledger, threshold, by), by)
        .join(roc_auc(ledger, by), list(by))
        .join(average_precision(ledger, by), list(by))
        .withColumn("threshold", F.lit(float(threshold)))
    )


def class_report(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",)) -> DataFrame:
    """precision, recall, f1, support per class, and their macro and weighted means."""
    c = {k: F.col(k) for k in ("tp", "fp", "fn", "tn")}
    p1, r1 = share(c["tp"], c["tp"] + c["fp"]), share(c["tp"], c["tp"] + c["fn"])
    p0, r0 = share(c["tn"], c["tn"] + c["fn"]), share(c["tn"], c["tn"] + c["fp"])
    n1, n0 = c["tp"] + c["fn"], c["tn"] + c["fp"]
    per = {"precision": (p0, p1), "recall": (r0, r1), "f1_score": (_f1(p0, r0), _f1(p1, r1))}
    keys = {b: F.col(b) for b in by}

    def record(label: str, pick, support: Column) -> dict[str, Column]:
        return {**keys, "label": F.lit(label), **{m: pick(*v) for m, v in per.items()}, "support": support}

    return rows_of(
        confusion_counts(scores, threshold, by),
        [
            record("0", lambda a, b: a, n0),
            record("1", lambda a, b: b, n1),
            record("macro avg", lambda a, b: (a + b) / 2, n0 + n1),
            record("weighted avg", lambda a, b: F.try_divide(a * n0 + b * n1, (n0 + n1)), n0 + n1),
        ],
    )


# ---------------------------------------------------------------- thresholds


def fbeta(beta: float) -> Column:
    p, r, b2 = _precision(), _recall(), beta * beta
    return (1 + b2) * (p * r) / (b2 * p + r + EPS)


def _criterion(metric: str) -> Column:
    choices = {
        "f1": 2 * (_precision() * _recall()) / (_precision() + _recall() + EPS),
        "precision": _precision(),
        "recall": _recall(),
    }
    return choices[metric]


def best_threshold(ledger: DataFrame, metric: str = "f1", by: Sequence[str] = ("model",)) -> DataFrame:
    """Score with the best metric as threshold; ties take the lowest."""
    scored = threshold_counts(ledger).withColumn("_s", _criterion(metric))
    return scored.groupBy(*by).agg(
        F.max_by("p", F.struct(F.col("_s"), -F.col("p"))).alias("threshold"), F.max("_s").alias("score")
    )


def fbeta_thresholds(
    ledger: DataFrame, betas: Sequence[float] = (1.0, 2.0, 0.5), by: Sequence[str] = ("model",)
) -> DataFrame:
    """Best threshold per model and beta, all in one aggregate."""
    scored = threshold_counts(ledger).select(*by, "p", *[fbeta(b).alias(f"_s{i}") for i, b in enumerate(betas)])
    best = scored.groupBy(*by).agg(
        *[F.max_by("p", F.struct(F.col(f"_s{i}"), -F.col("p"))).alias(f"_t{i}") for i in range(len(betas))],
        *[F.max(f"_s{i}").alias(f"_m{i}") for i in range(len(betas))],
    )
    return rows_of(
        best,
        [
            {
                **{k: F.col(k) for k in by},
                "beta": F.lit(float(b)),
                "threshold": F.col(f"_t{i}"),
                "score": F.col(f"_m{i}"),
            }
            for i, b in enumerate(betas)
        ],
    )


def business_terms(df: DataFrame, monthly: str) -> DataFrame:
    """One row: yearly value of a customer, campaign cost, retention success rate."""
    mean = F.avg(monthly)
    return df.agg(
        F.round(mean * 12, 2).alias("value"),
        F.round(mean * 0.20 * 3, 2).alias("cost"),
        F.lit(0.30).alias("success"),
    )


def _net_loss(tp: Column, fp: Column, fn: Column, terms: Mapping[str, Column]) -> Column:
    """Lost customers, detected but not retained ones, and the campaign."""
    return fn * terms["value"] + tp * (1 - terms["success"]) * terms["value"] + (tp + fp) * terms["cost"]


def business_threshold(ledger: DataFrame, terms: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Score whose use as threshold loses least; ties take the lowest."""
    t = terms.select(F.struct("value", "cost", "success")).scalar()
    loss = _net_loss(F.col("tp"), F.col("fp"), F.col("fn"), {k: t[k] for k in ("value", "cost", "success")})
    scored = threshold_counts(ledger).withColumn("_l", loss)
    return scored.groupBy(*by).agg(
        F.min_by("p", F.struct("_l", "p")).alias("threshold"), F.min("_l").alias("loss")
    )


def financial_impact(
    scores: DataFrame, thresholds: DataFrame, terms: DataFrame, by: Sequence[str] = ("model",)
) -> DataFrame:
    """Money per strategy on scored rows; ``thresholds`` is (by, strategy, threshold).

    The strategies of a model travel as one small array, so each score row
    counts itself into all of them without a join that multiplies rows.
    """
    plan = thresholds.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("strategy", "threshold"))).alias("_plan")
    )
    per_score = usable(scores).groupBy(*by, "p").agg(
        F.sum(F.col("y").cast("long")).alias("pos"), F.sum(1 - F.col("y").cast("long")).alias("neg")
    )
    # one row per model
    cells = per_score.join(F.broadcast(plan), list(by)).select(*by, "p", "pos", "neg", F.explode("_plan").alias("_s"))
    hit = F.col("p") >= F.col("_s.threshold")
    counts = cells.groupBy(*by, F.col("_s.strategy").alias("strategy"), F.col("_s.threshold").alias("threshold")).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"),
    )
    t = terms.select(F.struct("value", "cost", "success")).scalar()
    priced = counts.withColumns({"_v": t["value"], "_c": t["cost"], "_r": t["success"]})
    tp, fp, fn, v, c, r = (F.col(x) for x in ("tp", "fp", "fn", "_v", "_c", "_r"))
    saved, campaign = tp * r * v, (tp + fp) * c
    loss = _net_loss(tp, fp, fn, {"value": v, "cost": c, "success": r})
    return priced.select(
        *by,
        "strategy",
        "threshold",
        "tp",
        "fp",
        "fn",
        "tn",
        saved.alias("saved_revenue"),
        (fn * v).alias("missed_loss"),
        (tp * (1 - r) * v).alias("unretained_loss"),
        campaign.alias("campaign_cost"),
        loss.alias("net_loss"),
        ((tp + fn) * v).alias("loss_without_model"),
        ((tp + fn) * v - loss).alias("savings"),
        F.when(campaign > 0, (saved - campaign) / campaign).otherwise(0.0).alias("roi"),
    )


def loss_sweep(
    scores: DataFrame,
    terms: DataFrame,
    low: float = 0.1,
    high: float = 0.9,
    steps: int = 200,
    by: Sequence[str] = ("model",),
) -> DataFrame:
    """Net loss at a grid of thresholds.

    Each distinct score is put behind the last grid point it reaches; the sums
    per grid point (steps + 1 rows per model) are accumulated from the top.
    """
    step = (high - low) / (steps - 1)
    grid = F.array(*[F.lit(low + i * step) for i in range(steps)])
    y = F.col("y").cast("long")
    per_score = usable(scores).groupBy(*by, "p").agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )
    placed = per_score.withColumn("_reached", F.size(F.filter(grid, lambda g: g <= F.col("p"))))
    sums = placed.groupBy(*by, "_reached").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    every = (
        sums.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("_reached"))
    )
    filled = (
        every.select(*by, "_reached", F.lit(0).alias("pos"), F.lit(0).alias("neg"))
        .unionByName(sums)
        .groupBy(*by, "_reached")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    whole = Window.partitionBy(*by)
    from_top = whole.orderBy(F.desc("_reached")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = filled.select(
        *by,
        "_reached",
        F.sum("pos").over(from_top).alias("tp"),
        F.sum("neg").over(from_top).alias("fp"),
        (F.sum("pos").over(whole) - F.sum("pos").over(from_top)).alias("fn"),
    ).where("_reached > 0")
    t = terms.select(F.struct("value", "cost", "success")).scalar()
    priced = counts.withColumns({"_v": t["value"], "_c": t["cost"], "_r": t["success"]})
    loss = _net_loss(
        F.col("tp"), F.col("fp"), F.col("fn"), {"value": F.col("_v"), "cost": F.col("_c"), "success": F.col("_r")}
    )
    return priced.select(
        *by, F.element_at(grid, F.col("_reached")).alias("threshold"), "tp", "fp", "fn", loss.alias("net_loss")
    )


# ---------------------------------------------------------------- model choice

RANKED_METRICS = ("f1_score", "roc_auc", "auprc", "recall")


def long_metrics(metrics: DataFrame, names: Sequence[str] = RANKED_METRICS) -> DataFrame:
    return metrics.select("model", *[F.col(m).cast("double") for m in names]).unpivot(
        ["model"], list(names), "metric", "value"
    )


def model_ranking(metrics: DataFrame) -> DataFrame:
    """Models by F1, best first (a row per model)."""
    place = F.row_number().over(Window.orderBy(F.desc("f1_score"), F.asc("model")))
    return metrics.select("model", *RANKED_METRICS, place.alias("rank"))


def best_model_wins(metrics: DataFrame, names: Sequence[str] = RANKED_METRICS) -> DataFrame:
    """One win per metric maximum (nulls ignored, first name on a tie); the best
    model has most wins, ties go to the higher F1."""
    cells = long_metrics(metrics, names).where("value is not null")
    winners = cells.groupBy("metric").agg(F.min_by("model", F.struct(-F.col("value"), F.col("model"))).alias("model"))
    wins = winners.groupBy("model").agg(F.count("*").alias("wins"))
    table = metrics.select("model", "f1_score").join(wins, "model", "left").withColumn(
        "wins", F.coalesce("wins", F.lit(0))
    )
    order = Window.orderBy(F.desc("wins"), F.desc_nulls_last("f1_score"), F.asc("model"))
    return table.select("model", "wins", "f1_score", (F.row_number().over(order) == 1).cast("int").alias("best"))


def metric_delta(metrics: DataFrame, model: str, baseline: str, names: Sequence[str] = RANKED_METRICS) -> DataFrame:
    """Each metric of a model against a baseline."""
    cells = long_metrics(metrics, names)
    pick = lambda m: F.max(F.when(F.col("model") == m, F.col("value")))
    return cells.groupBy("metric").agg(
        pick(baseline).alias("baseline"), pick(model).alias("value"), (pick(model) - pick(baseline)).alias("delta")
    )


def generalisation_gap(cv: DataFrame, test: DataFrame, metric: str = "auprc") -> DataFrame:
    """Metric on cross-validation rows minus test rows, and in percent of the former."""
    return (
        cv.select("model", F.col(metric).alias("cv"))
        .join(test.select("model", F.col(metric).alias("test")), "model")
        .select(
            "model",
            "cv",
            "test",
            (F.col("cv") - F.col("test")).alias("gap"),
            F.try_divide(F.abs(F.col("cv") - F.col("test")) * 100, F.col("cv")).alias("gap_pct"),
        )
    )


# ---------------------------------------------------------------- reading scores


def risk_bands(scored: DataFrame, p: str = "p", threshold: float = 0.5) -> DataFrame:
    """Add the label, risk band and confidence of each score (4 digits).

    A row without a score (null or NaN) is not flagged: label 0, band LOW, no confidence.
    """
    x = F.when(~F.isnan(F.col(p)), F.col(p))
    band = F.when(x >= RISK_BAND_HIGH, "HIGH").when(x >= RISK_BAND_MEDIUM, "MEDIUM").otherwise("LOW")
    return scored.withColumns(
        {
            "prediction": F.coalesce((x >= F.lit(float(threshold))).cast("int"), F.lit(0)),
            "risk": band,
            "confidence": F.round(F.abs(x - 0.5) * 2, 4),
            p: F.round(x, 4),
        }
    )


def score_summary(scored: DataFrame, key: str, p: str = "p") -> DataFrame:
    """Rows, high-risk rows, and the highest and lowest scored key (ties: lowest key; NaN is no score)."""
    x = F.when(~F.isnan(F.col(p)), F.col(p))
    return scored.agg(
        F.count("*").alias("total"),
        F.count_if(x >= RISK_BAND_HIGH).alias("high_risk"),
        F.min_by(key, F.when(x.isNotNull(), F.struct(-x, F.col(key)))).alias("highest"),
        F.min_by(key, F.when(x.isNotNull(), F.struct(x, F.col(key)))).alias("lowest"),
    )


def revenue_at_risk(scored: DataFrame, amount: str, threshold: float = 0.5) -> DataFrame:
    """Amount over customers that left and were flagged."""
    caught = (F.col("y") == 1) & (F.col("p") >= F.lit(float(threshold)))
    return usable(scored).agg(
        F.count_if(caught).alias("customers"), F.coalesce(F.sum(F.when(caught, F.col(amount))), F.lit(0.0)).alias("revenue")
    )
