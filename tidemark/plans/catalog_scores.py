"""Evaluation, thresholds and model choice on four scores of the customer view.

The scores are plain formulas, so both engines agree on them: the rule-based
risk score, and monotone curves of tenure, recency and total amount.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.draw import with_part
from tidemark.functions.shape import rounded
from tidemark.functions.stage import staged
from tidemark.operators import evaluate as ev
from tidemark.operators.features import risk_score
from tidemark.plans.catalog_features import ALL, one
from tidemark.plans.registry import Registry
from tidemark.plans.sqltext import big, r
from tidemark.roles import ORDERS360 as R
from tidemark.sources.customer360 import customer360
from tidemark.sources.tables import table

REGISTRY = Registry()
query = REGISTRY.query


def _models():
    return {
        "risk": risk_score(R) / 8,
        "tenure": F.lit(1.0) / (1 + F.col("tenure")),
        "recency": F.col("recency") / (F.col("recency") + 12),
        "amount": F.col("total") / (F.col("total") + 1e6),
    }


def scores_of(customers, *extra):
    """(customer_key, y, extra, model, p): one row per customer and model."""
    models = _models()
    wide = customers.select(
        R.key, F.col("target").alias("y"), *extra, *[p.cast("double").alias(m) for m, p in models.items()]
    )
    return wide.unpivot([R.key, "y", *extra], list(models), "model", "p")


def _scores(spark, sf, *extra):
    return scores_of(customer360(spark, sf), *extra)


def _parted(spark, sf):
    base = staged(customer360(spark, sf), "c360")
    return scores_of(with_part(base, R.key, R.target, [(2, 10)], 42, "part"), "part")


SCORES = ALL.rstrip() + """,
scores AS (
  SELECT customer_key, part, target AS y, monthly, 'risk' AS model, risk / 8 AS p FROM scored
  UNION ALL SELECT customer_key, part, target, monthly, 'tenure', 1 / (1 + tenure)::DOUBLE FROM scored
  UNION ALL SELECT customer_key, part, target, monthly, 'recency', recency / (recency + 12)::DOUBLE FROM scored
  UNION ALL SELECT customer_key, part, target, monthly, 'amount', total / (total + 1e6) FROM scored)"""


def curve_sql(source: str = "scores", name: str = "curve") -> str:
    """CTE of tp, fp, fn, tn at every distinct score, by window sums."""
    return f""",
{name}_d AS (SELECT model, p, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY 1, 2),
{name}_c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS np,
  sum(neg) OVER (PARTITION BY model) AS nn FROM {name}_d
  WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name} AS (SELECT *, np - tp AS fn, nn - fp AS tn, tp / (tp + fp)::DOUBLE AS pr, tp / np::DOUBLE AS rc FROM {name}_c)"""


CURVE = SCORES + curve_sql()


def _metrics_sql(source: str, name: str) -> str:
    """CTE of all metrics per model at threshold one half."""
    return curve_sql(source, f"{name}_k") + f""",
{name}_n AS (SELECT model, sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN p >= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN p < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN p < 0.5 AND y = 0 THEN 1 ELSE 0 END) AS tn FROM {source} GROUP BY 1),
{name}_a AS (SELECT model AS m2, sum(neg * (2 * (tp - pos) + pos)) / (2 * max(np) * max(nn))::DOUBLE AS auc,
  sum(pos / np::DOUBLE * pr) AS ap FROM {name}_k GROUP BY 1),
{name} AS (SELECT model, tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn)::DOUBLE AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS prec,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS rec,
  CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp)::DOUBLE END AS spec,
  CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f1, auc, ap
  FROM {name}_n JOIN {name}_a ON model = m2)"""


@query("confusion", SCORES + f""" SELECT model, {big('y')} AS y, {one('p >= 0.5')} AS pred, count(*) AS n,
{r('count(*) / (sum(count(*)) OVER (PARTITION BY model, y))::DOUBLE')} AS share FROM scores GROUP BY model, y, p >= 0.5""")
def confusion(spark, sf):
    return rounded(ev.confusion_matrix(_scores(spark, sf)))


_METRIC_COLUMNS = f"""model, {r('accuracy')} AS accuracy, {r('prec')} AS "precision", {r('rec')} AS recall,
{r('f1')} AS f1_score, {r('spec')} AS specificity, {big('tp')} AS tp, {big('fp')} AS fp, {big('fn')} AS fn,
{big('tn')} AS tn, {r('auc')} AS roc_auc, {r('ap')} AS auprc, 0.5::DOUBLE AS threshold"""


@query("class_metrics", SCORES + _metrics_sql("scores", "met") + f" SELECT {_METRIC_COLUMNS} FROM met")
def class_metrics(spark, sf):
    return rounded(ev.evaluate(staged(_scores(spark, sf), "scores")))


def _report_sql() -> str:
    p0, r0 = "CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn)::DOUBLE END", "spec"
    f0 = "CASE WHEN tn = 0 THEN 0 ELSE 2 * tn / (2 * tn + fp + fn)::DOUBLE END"
    ctes = f""", rep AS (SELECT model, {p0} AS p0, {r0} AS r0, {f0} AS f0, prec AS p1, rec AS r1, f1, tn + fp AS n0,
    tp + fn AS n1 FROM met)"""
    parts = [
        ("0", "{}0", "n0"),
        ("1", "{}1", "n1"),
        ("macro avg", "({0}0 + {0}1) / 2", "n0 + n1"),
        ("weighted avg", "({0}0 * n0 + {0}1 * n1) / (n0 + n1)::DOUBLE", "n0 + n1"),
    ]
    rows = [
        f"""SELECT model, '{label}' AS label, {r(e.format('p'))} AS "precision", {r(e.format('r'))} AS recall,
        {r(e.format('f'))} AS f1_score, {big(n)} AS support FROM rep"""
        for label, e, n in parts
    ]
    return SCORES + _metrics_sql("scores", "met") + ctes + " " + " UNION ALL ".join(rows)


@query("class_report", _report_sql())
def class_report(spark, sf):
    return rounded(ev.class_report(_scores(spark, sf)))


@query("roc_auc", CURVE + f""" SELECT model,
{r('sum(neg * (2 * (tp - pos) + pos)) / (2 * max(np) * max(nn))::DOUBLE')} AS roc_auc FROM curve GROUP BY 1""")
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(ev.score_ledger(_scores(spark, sf))))


@query("avg_precision", CURVE + f" SELECT model, {r('sum(pos / np::DOUBLE * pr)')} AS auprc FROM curve GROUP BY 1")
def avg_precision(spark, sf):
    return rounded(ev.average_precision(ev.score_ledger(_scores(spark, sf))))


@query("roc_curve", CURVE + f""" SELECT model, {r('p', 9)} AS threshold, {r('fp / nn::DOUBLE')} AS fpr,
{r('tp / np::DOUBLE')} AS tpr FROM curve UNION ALL SELECT DISTINCT model, NULL, 0::DOUBLE, 0::DOUBLE FROM scores""")
def roc_curve(spark, sf):
    curve = ev.roc_curve(ev.score_ledger(_scores(spark, sf)))
    return rounded(curve.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")}), 9)


@query("pr_curve", CURVE + f""" SELECT model, {r('p', 9)} AS threshold, {r('pr')} AS "precision", {r('rc')} AS recall
FROM curve UNION ALL SELECT DISTINCT model, NULL, 1::DOUBLE, 0::DOUBLE FROM scores""")
def pr_curve(spark, sf):
    curve = ev.pr_curve(ev.score_ledger(_scores(spark, sf)))
    return rounded(curve.withColumns({c: F.round(c, 6) for c in ("precision", "recall")}), 9)


@query("pr_auc_trapz", CURVE + f""",
step AS (SELECT model, rc, pr, coalesce(lead(rc) OVER w, 0) AS rc2, coalesce(lead(pr) OVER w, 1) AS pr2 FROM curve
  WINDOW w AS (PARTITION BY model ORDER BY p))
SELECT model, {r('sum((rc - rc2) * (pr + pr2) / 2)')} AS pr_auc FROM step GROUP BY 1""")
def pr_auc_trapz(spark, sf):
    return rounded(ev.pr_auc_trapezoid(ev.score_ledger(_scores(spark, sf))))


@query("best_threshold", CURVE + ",\n" + ",\n".join(
    f"""b_{m} AS (SELECT model, '{m}' AS metric, p AS threshold, s AS score FROM (SELECT *, row_number() OVER
    (PARTITION BY model ORDER BY s DESC, p) AS rn FROM (SELECT *, {e} AS s FROM curve)) WHERE rn = 1)"""
    for m, e in (("f1", "2 * (pr * rc) / (pr + rc + 1e-10)"), ("precision", "pr"), ("recall", "rc")))
    + f" SELECT model, metric, {r('threshold', 9)} AS threshold, {r('score', 9)} AS score FROM "
    "(SELECT * FROM b_f1 UNION ALL SELECT * FROM b_precision UNION ALL SELECT * FROM b_recall)")
def best_threshold(spark, sf):
    ledger = staged(ev.score_ledger(_scores(spark, sf)), "ledger")
    parts = [ev.best_threshold(ledger, m).withColumn("metric", F.lit(m)) for m in ("f1", "precision", "recall")]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 9)


_BETAS = (1.0, 2.0, 0.5)


def _fbeta_sql(source: str, name: str = "fb") -> str:
    rows = " UNION ALL ".join(
        f"SELECT model, {b!r}::DOUBLE AS beta, p, {1 + b * b!r}::DOUBLE * (pr * rc) / ({b * b!r}::DOUBLE * pr + rc + 1e-10) AS s FROM {source}"
        for b in _BETAS
    )
    return f""",
{name} AS (SELECT model, beta, p AS threshold, s AS score FROM (SELECT *, row_number() OVER
  (PARTITION BY model, beta ORDER BY s DESC, p) AS rn FROM ({rows})) WHERE rn = 1)"""


@query("fbeta_thresholds", SCORES + ", tr AS (SELECT * FROM scores WHERE part = 1)" + curve_sql("tr") + _fbeta_sql("curve")
       + f" SELECT model, beta, {r('threshold', 9)} AS threshold, {r('score', 9)} AS score FROM fb")
def fbeta_thresholds(spark, sf):
    train = _parted(spark, sf).where("part = 1")
    return rounded(ev.fbeta_thresholds(ev.score_ledger(train), _BETAS), 9)


TERMS = """, terms AS (SELECT round(avg(monthly) * 12, 2) AS v, round(avg(monthly) * 0.20::DOUBLE * 3, 2) AS c,
0.30::DOUBLE AS s FROM c360)"""


def _loss(v="v", c="c", s="s") -> str:
    return f"fn * {v} + tp * (1 - {s}) * {v} + (tp + fp) * {c}"


def _business_sql(source: str) -> str:
    return f""",
biz AS (SELECT model, p AS threshold, l AS loss FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY l, p) AS rn
  FROM (SELECT *, {_loss()} AS l FROM {source}, terms)) WHERE rn = 1)"""


def _terms(spark, sf):
    return ev.business_terms(customer360(spark, sf), "monthly")


@query("business_threshold", SCORES + TERMS + ", tr AS (SELECT * FROM scores WHERE part = 1)" + curve_sql("tr")
       + _business_sql("curve") + f" SELECT model, {r('threshold', 9)} AS threshold, {r('loss', 4)} AS loss FROM biz")
def business_threshold(spark, sf):
    train = _parted(spark, sf).where("part = 1")
    best = ev.business_threshold(ev.score_ledger(train), _terms(spark, sf))
    return rounded(best.withColumn("loss", F.round("loss", 4)), 9)


_IMPACT = {
    "saved_revenue": "tp * s * v",
    "missed_loss": "fn * v",
    "unretained_loss": "tp * (1 - s) * v",
    "campaign_cost": "(tp + fp) * c",
    "net_loss": _loss(),
    "loss_without_model": "(tp + fn) * v",
    "savings": f"(tp + fn) * v - ({_loss()})",
}


@query("financial_impact", SCORES + TERMS + ", tr AS (SELECT * FROM scores WHERE part = 1)" + curve_sql("tr")
       + _fbeta_sql("curve") + _business_sql("curve") + f""",
plan AS (SELECT model AS m, CASE beta WHEN 1 THEN 'max_f1' WHEN 2 THEN 'max_recall_f2' ELSE 'max_precision_f05' END
  AS strategy, threshold FROM fb UNION ALL SELECT model, 'business', threshold FROM biz),
cnt AS (SELECT model, strategy, threshold, sum(CASE WHEN p >= threshold AND y = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN p >= threshold AND y = 0 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN p < threshold AND y = 1 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN p < threshold AND y = 0 THEN 1 ELSE 0 END) AS tn
  FROM scores JOIN plan ON model = m WHERE part = 0 GROUP BY 1, 2, 3)
SELECT model, strategy, {r('threshold', 9)} AS threshold, {big('tp')} AS tp, {big('fp')} AS fp, {big('fn')} AS fn,
{big('tn')} AS tn, {', '.join(f'{r(e, 4)} AS {n}' for n, e in _IMPACT.items())},
{r('CASE WHEN (tp + fp) * c > 0 THEN (tp * s * v - (tp + fp) * c) / ((tp + fp) * c) ELSE 0 END')} AS roi FROM cnt, terms""")
def financial_impact(spark, sf):
    base = staged(customer360(spark, sf), "c360")
    scores = scores_of(with_part(base, R.key, R.target, [(2, 10)], 42, "part"), "part")
    terms = ev.business_terms(base, "monthly")
    ledger = staged(ev.score_ledger(scores.where("part = 1")), "ledger")
    names = F.create_map(F.lit(1.0), F.lit("max_f1"), F.lit(2.0), F.lit("max_recall_f2"), F.lit(0.5), F.lit("max_precision_f05"))
    plan = (
        ev.fbeta_thresholds(ledger, _BETAS)
        .select("model", names[F.col("beta")].alias("strategy"), "threshold")
        .unionByName(ev.business_threshold(ledger, terms).select("model", F.lit("business").alias("strategy"), "threshold"))
    )
    impact = ev.financial_impact(scores.where("part = 0"), plan, terms)
    return rounded(
        impact.withColumns({**{c: F.round(c, 4) for c in _IMPACT}, "roi": F.round("roi", 6)}), 9
    )


@query("loss_sweep", SCORES + TERMS + f""",
grid AS (SELECT 0.1::DOUBLE + i * (0.8::DOUBLE / 199) AS threshold FROM range(200) t(i)),
cnt AS (SELECT model, threshold, sum(CASE WHEN p >= threshold THEN y ELSE 0 END) AS tp,
  sum(CASE WHEN p >= threshold THEN 1 - y ELSE 0 END) AS fp, sum(CASE WHEN p < threshold THEN y ELSE 0 END) AS fn
  FROM scores, grid GROUP BY 1, 2)
SELECT model, {r('threshold')} AS threshold, {big('tp')} AS tp, {big('fp')} AS fp, {big('fn')} AS fn,
{r(_loss(), 4)} AS net_loss FROM cnt, terms""")
def loss_sweep(spark, sf):
    base = staged(customer360(spark, sf), "c360")
    table = ev.loss_sweep(scores_of(base), ev.business_terms(base, "monthly"))
    return rounded(table.withColumn("net_loss", F.round("net_loss", 4)))


TEST = ", te AS (SELECT * FROM scores WHERE part = 0)"


@query("model_ranking", SCORES + TEST + _metrics_sql("te", "met") + f""" SELECT model, {r('f1')} AS f1_score,
{r('auc')} AS roc_auc, {r('ap')} AS auprc, {r('rec')} AS recall, row_number() OVER (ORDER BY f1 DESC, model) AS rank FROM met""")
def model_ranking(spark, sf):
    test = staged(_parted(spark, sf).where("part = 0"), "scores")
    return rounded(ev.model_ranking(ev.evaluate(test)))


_WINS = """,
cells AS (SELECT model, 'f1' AS metric, f1 AS x FROM met UNION ALL SELECT model, 'auc', auc FROM met
  UNION ALL SELECT model, 'ap', ap FROM met UNION ALL SELECT model, 'rec', rec FROM met),
firsts AS (SELECT model AS wm, count(*) AS wins FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY x DESC, model)
  AS rn FROM cells) WHERE rn = 1 GROUP BY 1),
wins AS (SELECT model, coalesce(wins, 0) AS wins, f1,
  row_number() OVER (ORDER BY coalesce(wins, 0) DESC, f1 DESC, model) AS place FROM met LEFT JOIN firsts ON model = wm)"""


@query("best_model_wins", SCORES + TEST + _metrics_sql("te", "met") + _WINS
       + f" SELECT model, wins, {r('f1')} AS f1_score, {one('place = 1')} AS best FROM wins")
def best_model_wins(spark, sf):
    test = staged(_parted(spark, sf).where("part = 0"), "scores")
    return rounded(ev.best_model_wins(staged(ev.evaluate(test), "metrics")))


@query("metric_delta", SCORES + TEST + _metrics_sql("te", "met") + ",\n" + """cells AS (
SELECT model, 'f1_score' AS metric, f1 AS x FROM met UNION ALL SELECT model, 'roc_auc', auc FROM met
UNION ALL SELECT model, 'auprc', ap FROM met UNION ALL SELECT model, 'recall', rec FROM met)""" + f"""
SELECT metric, {r("max(CASE WHEN model = 'tenure' THEN x END)")} AS baseline,
{r("max(CASE WHEN model = 'recency' THEN x END)")} AS value,
{r("max(CASE WHEN model = 'recency' THEN x END) - max(CASE WHEN model = 'tenure' THEN x END)")} AS delta FROM cells GROUP BY 1""")
def metric_delta(spark, sf):
    test = staged(_parted(spark, sf).where("part = 0"), "scores")
    return rounded(ev.metric_delta(ev.evaluate(test), "recency", "tenure"))


@query("generalisation_gap", SCORES + TEST + ", tr AS (SELECT * FROM scores WHERE part = 1)" + _metrics_sql("te", "met")
       + _metrics_sql("tr", "cvm") + f""" SELECT met.model, {r('cvm.ap')} AS cv, {r('met.ap')} AS test,
{r('cvm.ap - met.ap')} AS gap, {r('abs(cvm.ap - met.ap) * 100 / cvm.ap')} AS gap_pct FROM met JOIN cvm ON met.model = cvm.model""")
def generalisation_gap(spark, sf):
    parted = staged(_parted(spark, sf), "scores")
    by = ["part", "model"]
    ap = ev.average_precision(ev.score_ledger(parted, by), by)
    return rounded(ev.generalisation_gap(ap.where("part = 1"), ap.where("part = 0")))


@query("risk_band", SCORES + f""" SELECT customer_key, {r('p', 4)} AS p, {one('p >= 0.5')} AS prediction,
CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk, {r('abs(p - 0.5) * 2', 4)} AS confidence
FROM scores WHERE model = 'recency'""")
def risk_band(spark, sf):
    scored = customer360(spark, sf).select(R.key, _models()["recency"].alias("p"))
    return rounded(ev.risk_bands(scored))


@query("score_summary", SCORES + f""" SELECT count(*) AS total, {big('sum(CASE WHEN p >= 0.7 THEN 1 ELSE 0 END)')} AS high_risk,
(SELECT customer_key FROM scores WHERE model = 'recency' ORDER BY p DESC, customer_key LIMIT 1) AS highest,
(SELECT customer_key FROM scores WHERE model = 'recency' ORDER BY p, customer_key LIMIT 1) AS lowest
FROM scores WHERE model = 'recency'""")
def score_summary(spark, sf):
    scored = customer360(spark, sf).select(R.key, _models()["recency"].alias("p"))
    return rounded(ev.score_summary(scored, R.key))


@query("revenue_at_risk", SCORES + f""" SELECT {big('sum(CASE WHEN y = 1 AND p >= 0.5 THEN 1 ELSE 0 END)')} AS customers,
{r('coalesce(sum(CASE WHEN y = 1 AND p >= 0.5 THEN monthly END), 0)', 2)} AS revenue FROM scores WHERE model = 'recency'""")
def revenue_at_risk(spark, sf):
    scored = customer360(spark, sf).select(F.col("target").alias("y"), "monthly", _models()["recency"].alias("p"))
    return rounded(ev.revenue_at_risk(scored, "monthly"), 2)


@query("label_metrics", f"""WITH scores AS (SELECT 'labels' AS model, 1 - quality AS y, toxic::DOUBLE AS p FROM labels)
{_metrics_sql("scores", "met")} SELECT {_METRIC_COLUMNS} FROM met""")
def label_metrics(spark, sf):
    """Toxic mark as a rule for low quality, on the labelled documents."""
    labels = table(spark, sf, "labels")
    pairs = labels.select(
        F.lit("labels").alias("model"), (1 - F.col("quality")).alias("y"), F.col("toxic").cast("double").alias("p")
    )
    return rounded(ev.evaluate(pairs))
