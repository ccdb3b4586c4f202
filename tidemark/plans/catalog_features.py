"""Fitted statistics and derived columns on the customer view.

Statistics are learned on the training part of a seeded stratified split and
applied to every customer.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.functions.draw import with_part
from tidemark.functions.shape import rounded
from tidemark.functions.stage import staged
from tidemark.operators import features as fe
from tidemark.operators import profile
from tidemark.plans.registry import Registry
from tidemark.plans.sqltext import C360, big, quantile, r, with_
from tidemark.roles import ORDERS360
from tidemark.sources.customer360 import customer360

R = ORDERS360
RECENCY = replace(R, tenure="recency")
REGISTRY = Registry()
query = REGISTRY.query


SPLIT = """
drawn AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat(customer_key, '-42'))) AS rn,
  count(*) OVER (PARTITION BY target) AS cn FROM c360),
split AS (SELECT *, CASE WHEN rn <= floor(cn * 2 / 10::DOUBLE) THEN 0 ELSE 1 END AS part FROM drawn),
train AS (SELECT *, CASE WHEN tenure > 0 THEN total / tenure ELSE 0 END AS avg_charge FROM split WHERE part = 1)
"""
_FIVE = ", ".join(quantile("a", q) for q in (0.0, 0.25, 0.5, 0.75, 1.0))
STATS = f"""
amounts AS (SELECT list(monthly ORDER BY monthly) AS a, list(avg_charge ORDER BY avg_charge) AS b FROM train),
edge_list AS (SELECT list_sort(list_distinct([{_FIVE}])) AS e FROM amounts),
five AS (SELECT CASE WHEN len(e) < 5 THEN list_transform(range(5), lambda i :
  e[1] + i * ((e[len(e)] - e[1]) / 4)) ELSE e END AS e FROM edge_list),
med AS (SELECT {quantile('a', 0.5)} AS m_monthly, {quantile('b', 0.5)} AS m_avg FROM amounts),
overall AS (SELECT avg(tenure) AS g_tenure, avg(target) AS g_rate FROM train),
cat_cells AS (SELECT 'contract' AS feature, contract AS category, target, tenure FROM train
  UNION ALL SELECT 'internet', internet, target, tenure FROM train
  UNION ALL SELECT 'payment', payment, target, tenure FROM train),
cats AS (SELECT feature, category, count(*) AS n, avg(target) AS rate, avg(tenure) AS tenure_mean FROM cat_cells
  WHERE category IS NOT NULL GROUP BY 1, 2),
coded AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY rate DESC, category) - 1 AS ordinal FROM cats)
"""


def _count(cols):
    return " + ".join(f"CASE WHEN {c} IN ('No', 'AFRICA') THEN 0 ELSE 1 END" for c in cols)


FEATS = f"""
base AS (SELECT s.*, CASE WHEN tenure > 0 THEN total / tenure ELSE 0 END AS avg_charge,
  {_count(R.services)} AS services, {_count(R.streaming)} AS streams, {_count(R.security)} AS guards,
  c.tenure_mean AS seg, c.rate AS c_rate, c.ordinal AS c_ord, i.rate AS i_rate, p.rate AS p_rate,
  (SELECT avg(rate) FROM coded WHERE feature = 'internet') AS i_mean,
  (SELECT avg(rate) FROM coded WHERE feature = 'payment') AS p_mean,
  g_tenure, g_rate, m_monthly, m_avg, five.e AS e
  FROM split s CROSS JOIN overall CROSS JOIN med CROSS JOIN five
  LEFT JOIN coded c ON c.feature = 'contract' AND c.category = s.contract
  LEFT JOIN coded i ON i.feature = 'internet' AND i.category = s.internet
  LEFT JOIN coded p ON p.feature = 'payment' AND p.category = s.payment),
scored AS (SELECT *, (CASE WHEN contract = 'BUILDING' THEN 2.0 ELSE 0 END + CASE WHEN tenure < 12 THEN 2.0 ELSE 0 END
  + CASE WHEN internet = 'ASIA' AND guards = 0 THEN 1.5 ELSE 0 END + CASE WHEN services <= 2 THEN 1.0 ELSE 0 END
  + CASE WHEN paperless = 'Yes' THEN 0.5 ELSE 0 END + CASE WHEN payment = 'P' THEN 1.0 ELSE 0 END)::DOUBLE AS risk
  FROM base)
"""
PLAIN = with_(C360, SPLIT)
FITTED = with_(C360, SPLIT, STATS)
ALL = with_(C360, SPLIT, STATS, FEATS)


def one(condition: str) -> str:
    return big(f"CASE WHEN {condition} THEN 1 ELSE 0 END")


def _train_and_all(spark, sf):
    base = staged(customer360(spark, sf), "c360")
    parted = with_part(base, R.key, R.target, [(2, 10)], 42, "_part")
    return parted.where("_part = 1").drop("_part"), base


def _fitted(spark, sf):
    train, base = _train_and_all(spark, sf)
    return fe.fit(train, R), base


def _group(spark, sf, build, lookups=(), needs_fit=True):
    """Key plus one group of derived columns for every customer."""
    if needs_fit:
        stats, base = _fitted(spark, sf)
        rows = fe.with_lookups(base, R, stats, lookups)
        return fe.select_features(rows, build(stats), [R.key])
    return fe.select_features(customer360(spark, sf), build(), [R.key])


@query("monthly_bin_edges", FITTED + f"""SELECT {big('i - 1')} AS edge_id, CASE WHEN i = 1 THEN '-inf'::DOUBLE
WHEN i = len(e) THEN 'inf'::DOUBLE ELSE {r('e[i]')} END AS edge FROM five, range(1, len(e) + 1) t(i)""")
def monthly_bin_edges(spark, sf):
    train, _ = _train_and_all(spark, sf)
    five = fe.amount_quartiles(fe.amount_cells(train, R)).where("feature = 'monthly'").collect()
    edges = fe.open_edges([row["quantile"] for row in five])
    return rounded(spark.createDataFrame(list(enumerate(edges)), "edge_id long, edge double"))


@query("fit_medians", FITTED + f"""SELECT 'monthly' AS feature, {r('m_monthly')} AS median FROM med
UNION ALL SELECT 'avg_charge', {r('m_avg')} FROM med""")
def fit_medians(spark, sf):
    train, _ = _train_and_all(spark, sf)
    return rounded(fe.amount_medians(fe.amount_cells(train, R)))


@query("category_mean", PLAIN + f"""SELECT contract AS category, count(tenure) AS n, {r('avg(tenure)')} AS mean,
{r('(SELECT avg(tenure) FROM train)')} AS global_mean FROM train GROUP BY 1""")
def category_mean(spark, sf):
    train, _ = _train_and_all(spark, sf)
    means = fe.category_means(train, R.contract, R.tenure)
    return rounded(means.withColumn("global_mean", train.agg(F.avg(R.tenure)).scalar()))


@query("supervised_encoding", FITTED + f"""SELECT feature, category, n, {r('rate')} AS rate, ordinal
FROM coded WHERE feature = 'contract'""")
def supervised_encoding(spark, sf):
    train, _ = _train_and_all(spark, sf)
    return rounded(fe.supervised_encoding(train, [R.contract], R.target))


@query("category_risk", FITTED + f"""SELECT feature, category, n, {r('rate')} AS rate FROM coded
WHERE feature IN ('internet', 'payment')""")
def category_risk(spark, sf):
    train, _ = _train_and_all(spark, sf)
    return rounded(fe.category_rates(train, [R.internet, R.payment], R.target))


@query("f_tenure", PLAIN + f"""SELECT customer_key, {one('recency = 0')} AS new_customer_flag,
CASE WHEN recency < 0 THEN NULL WHEN recency <= 6 THEN '0-6m' WHEN recency <= 12 THEN '7-12m'
WHEN recency <= 24 THEN '1-2a' WHEN recency <= 48 THEN '2-4a' WHEN recency <= 72 THEN '4-6a' END AS tenure_group
FROM c360""")
def f_tenure(spark, sf):
    return rounded(fe.select_features(customer360(spark, sf), fe.tenure_features(RECENCY), [R.key]))


@query("f_charges", PLAIN + f"""SELECT customer_key, {r('CASE WHEN recency > 0 THEN total / recency ELSE 0 END')}
AS avg_monthly_charge, {one('abs(total - monthly * recency) / (total + 1e-6) > 0.3')} AS charges_mismatch_flag
FROM c360""")
def f_charges(spark, sf):
    return rounded(fe.select_features(customer360(spark, sf), fe.charge_features(RECENCY), [R.key]))


@query("f_contract", PLAIN + f"""SELECT customer_key, {one("contract = 'BUILDING'")} AS is_monthly_contract,
{one("contract IN ('FURNITURE', 'MACHINERY')")} AS long_term_contract FROM c360""")
def f_contract(spark, sf):
    return rounded(_group(spark, sf, lambda: fe.contract_features(R), needs_fit=False))


@query("f_monthly_bin", ALL + """SELECT customer_key, CASE WHEN monthly <= e[2] THEN 'muito_baixo'
WHEN monthly <= e[3] THEN 'baixo' WHEN monthly <= e[4] THEN 'medio' ELSE 'alto' END AS monthly_binned FROM base""")
def f_monthly_bin(spark, sf):
    return _group(spark, sf, lambda s: fe.amount_bin(R, s))


@query("f_price", ALL + f"""SELECT customer_key, {one('avg_charge > m_avg')} AS is_high_monthly,
{one("contract = 'BUILDING' AND monthly > m_monthly")} AS price_sensitive_contract FROM base""")
def f_price(spark, sf):
    return rounded(_group(spark, sf, lambda s: fe.price_features(R, s)))


@query("f_behaviour", PLAIN + f"""SELECT customer_key, {one("contract = 'BUILDING' AND recency < 12")}
AS early_churn_risk FROM c360""")
def f_behaviour(spark, sf):
    return rounded(fe.select_features(customer360(spark, sf), fe.behaviour_features(RECENCY), [R.key]))


@query("f_segment", ALL + f"""SELECT customer_key, {r('''tenure / CASE WHEN coalesce(seg, g_tenure) = 0 THEN 1
ELSE coalesce(seg, g_tenure) END''')} AS tenure_vs_contract_avg FROM base""")
def f_segment(spark, sf):
    return rounded(_group(spark, sf, lambda s: fe.segment_features(R, s), [R.contract]))


@query("f_encoded", ALL + f"""SELECT customer_key, {big('coalesce(c_ord, 0)')} AS contract_risk_ordinal,
{r('coalesce(c_rate, g_rate)')} AS contract_churn_rate FROM base""")
def f_encoded(spark, sf):
    return rounded(_group(spark, sf, lambda s: fe.encoded_features(R, s), [R.contract]))


_AMOUNT = "(CASE WHEN tenure > 0 THEN total / tenure ELSE 0 END)"


@query("f_nonlinear", PLAIN + "SELECT customer_key, " + ", ".join(
    f"{r(f'ln(1 + greatest({x}, 0))')} AS {n}_log, {r(f'{x} * {x}', -2)} AS {n}_squared"
    for n, x in (("monthly", "monthly"), ("total", "total"), ("avg_monthly_charge", _AMOUNT))) + " FROM c360")
def f_nonlinear(spark, sf):
    wide = _group(spark, sf, lambda: fe.nonlinear_features(R), needs_fit=False)
    squares = [c for c in wide.columns if c.endswith("_squared")]
    return rounded(wide.withColumns({c: F.round(c, -2) for c in squares}))


@query("f_services", ALL + f"""SELECT customer_key, {big('services')} AS total_services,
{r('services / 6::DOUBLE')} AS service_density, {big('streams')} AS streaming_services,
{one('streams > 0')} AS has_streaming, {big('guards')} AS security_services, {one('guards > 0')} AS has_security
FROM base""")
def f_services(spark, sf):
    return rounded(_group(spark, sf, lambda: fe.service_features(R), needs_fit=False))


@query("f_engagement", ALL + f"""SELECT customer_key, {one('services <= 2')} AS low_engagement,
{one('services >= 5')} AS high_engagement,
{one("paperless = 'Yes' AND regexp_matches(payment, '(?i)^[op]$')")} AS digital_only,
{one("partner = 'Yes' OR dependents = 'Yes'")} AS family_account,
{one("partner = 'Yes' AND dependents = 'Yes'")} AS family_stability FROM base""")
def f_engagement(spark, sf):
    return rounded(_group(spark, sf, lambda: fe.engagement_features(R), needs_fit=False))


@query("f_interactions", ALL + f"""SELECT customer_key, {one("internet = 'ASIA' AND guards = 0")} AS fiber_no_security,
{one("coalesce(internet <> 'AFRICA', true) AND streams > 0 AND guards = 0")} AS streamer_unprotected,
{one("senior = 1 AND contract = 'BUILDING'")} AS senior_monthly,
{one('tenure = 0 AND monthly > m_monthly')} AS new_high_value FROM base""")
def f_interactions(spark, sf):
    return rounded(_group(spark, sf, lambda s: fe.interaction_features(R, s)))


@query("f_risk", ALL + f"""SELECT customer_key, {r('risk')} AS churn_risk_score, {one('risk >= 4')} AS high_risk_flag,
{one('risk >= 6')} AS very_high_risk_flag, {r('coalesce(i_rate, i_mean)')} AS internet_risk,
{r('coalesce(p_rate, p_mean)')} AS payment_risk FROM scored""")
def f_risk(spark, sf):
    return rounded(_group(spark, sf, lambda s: fe.risk_features(R, s), [R.internet, R.payment]))


@query("f_lifecycle", PLAIN + f"""SELECT customer_key, {one('recency <= 3')} AS lifecycle_new,
{one('recency > 3 AND recency <= 12')} AS lifecycle_early, {one('recency > 12 AND recency <= 36')} AS lifecycle_mid,
{one('recency > 36')} AS lifecycle_mature, {r('recency / 12::DOUBLE')} AS tenure_years,
{r('sqrt(recency)')} AS tenure_sqrt FROM c360""")
def f_lifecycle(spark, sf):
    return rounded(fe.select_features(customer360(spark, sf), fe.lifecycle_features(RECENCY), [R.key]))


@query("f_value", ALL + f"""SELECT customer_key, {r('monthly * tenure')} AS estimated_clv,
{r('CASE WHEN tenure > 0 THEN total / tenure ELSE monthly END', 8)} AS value_per_month,
{r('CASE WHEN services > 0 THEN monthly / services ELSE monthly END', 8)} AS cost_per_service FROM base""")
def f_value(spark, sf):
    wide = _group(spark, sf, lambda: fe.value_features(R), needs_fit=False)
    return rounded(wide.withColumn("estimated_clv", F.round("estimated_clv", 6)), 8)


@query("f_segment_window", PLAIN + f"""SELECT customer_key, {one("contract = 'BUILDING' AND tenure < 12")} AS early_churn_risk,
{one("contract = 'BUILDING' AND monthly > (SELECT quantile_cont(monthly, 0.5) FROM c360)")} AS price_sensitive_contract,
{r('tenure / avg(tenure) OVER (PARTITION BY contract)')} AS tenure_vs_contract_avg FROM c360""")
def f_segment_window(spark, sf):
    base = staged(customer360(spark, sf), "c360")
    wide = fe.population_features(base, R)
    return rounded(
        wide.select(R.key, "early_churn_risk", "price_sensitive_contract", "tenure_vs_contract_avg")
    )


_SQUARES = {n: x for n, x in (("monthly", "monthly"), ("total", "total"), ("avg_monthly_charge", "avg_charge"))}
_DERIVED = {
    "new_customer_flag": one("tenure = 0"),
    "tenure_group": """CASE WHEN tenure < 0 THEN NULL WHEN tenure <= 6 THEN '0-6m' WHEN tenure <= 12 THEN '7-12m'
WHEN tenure <= 24 THEN '1-2a' WHEN tenure <= 48 THEN '2-4a' WHEN tenure <= 72 THEN '4-6a' END""",
    "avg_monthly_charge": r("avg_charge", 8),
    "charges_mismatch_flag": one("abs(total - monthly * tenure) / (total + 1e-6) > 0.3"),
    "is_monthly_contract": one("contract = 'BUILDING'"),
    "long_term_contract": one("contract IN ('FURNITURE', 'MACHINERY')"),
    "monthly_binned": """CASE WHEN monthly <= e[2] THEN 'muito_baixo' WHEN monthly <= e[3] THEN 'baixo'
WHEN monthly <= e[4] THEN 'medio' ELSE 'alto' END""",
    "is_high_monthly": one("avg_charge > m_avg"),
    "price_sensitive_contract": one("contract = 'BUILDING' AND monthly > m_monthly"),
    "early_churn_risk": one("contract = 'BUILDING' AND tenure < 12"),
    "tenure_vs_contract_avg": r("tenure / CASE WHEN coalesce(seg, g_tenure) = 0 THEN 1 ELSE coalesce(seg, g_tenure) END"),
    "contract_risk_ordinal": big("coalesce(c_ord, 0)"),
    "contract_churn_rate": r("coalesce(c_rate, g_rate)"),
    **{f"{n}_log": r(f"ln(1 + greatest({x}, 0))") for n, x in _SQUARES.items()},
    **{f"{n}_squared": r(f"{x} * {x}", -2) for n, x in _SQUARES.items()},
    "total_services": big("services"),
    "service_density": r("services / 6::DOUBLE"),
    "streaming_services": big("streams"),
    "has_streaming": one("streams > 0"),
    "security_services": big("guards"),
    "has_security": one("guards > 0"),
    "low_engagement": one("services <= 2"),
    "high_engagement": one("services >= 5"),
    "digital_only": one("paperless = 'Yes' AND regexp_matches(payment, '(?i)^[op]$')"),
    "family_account": one("partner = 'Yes' OR dependents = 'Yes'"),
    "family_stability": one("partner = 'Yes' AND dependents = 'Yes'"),
    "fiber_no_security": one("internet = 'ASIA' AND guards = 0"),
    "streamer_unprotected": one("coalesce(internet <> 'AFRICA', true) AND streams > 0 AND guards = 0"),
    "senior_monthly": one("senior = 1 AND contract = 'BUILDING'"),
    "new_high_value": one("tenure = 0 AND monthly > m_monthly"),
    "churn_risk_score": r("risk"),
    "high_risk_flag": one("risk >= 4"),
    "very_high_risk_flag": one("risk >= 6"),
    "internet_risk": r("coalesce(i_rate, i_mean)"),
    "payment_risk": r("coalesce(p_rate, p_mean)"),
    "lifecycle_new": one("tenure <= 3"),
    "lifecycle_early": one("tenure > 3 AND tenure <= 12"),
    "lifecycle_mid": one("tenure > 12 AND tenure <= 36"),
    "lifecycle_mature": one("tenure > 36"),
    "tenure_years": r("tenure / 12::DOUBLE"),
    "tenure_sqrt": r("sqrt(tenure)"),
    "estimated_clv": r("monthly * tenure"),
    "value_per_month": r("CASE WHEN tenure > 0 THEN total / tenure ELSE monthly END", 8),
    "cost_per_service": r("CASE WHEN services > 0 THEN monthly / services ELSE monthly END", 8),
}


@query("feature_table", ALL + f"SELECT customer_key, {big('part')} AS part, " + ", ".join(f"{x} AS {n}" for n, x in _DERIVED.items()) + " FROM scored")
def feature_table(spark, sf):
    """All 48 derived columns in one transform."""
    base = staged(customer360(spark, sf), "c360")
    parted = with_part(base, R.key, R.target, [(2, 10)], 42, "part")
    stats = fe.fit(parted.where("part = 1").drop("part"), R)
    wide = fe.transform(parted, R, stats)
    # quotients of money end in halves at six digits, where engines round apart
    fine = ("avg_monthly_charge", "value_per_month", "cost_per_service")
    digits = {c: -2 if c.endswith("_squared") else 6 for c, kind in wide.dtypes if kind == "double" and c in _DERIVED and c not in fine}
    return rounded(wide.withColumns({c: F.round(c, d) for c, d in digits.items()}).select(R.key, "part", *_DERIVED), 8)


_FLAGS = ["is_monthly_contract", "early_churn_risk", "price_sensitive_contract", "long_term_contract",
          "new_customer_flag", "charges_mismatch_flag"]
_FLAG_SQL = """flagged AS (SELECT target, CASE WHEN contract = 'BUILDING' THEN 1 ELSE 0 END AS is_monthly_contract,
CASE WHEN contract = 'BUILDING' AND recency < 12 THEN 1 ELSE 0 END AS early_churn_risk,
CASE WHEN contract = 'BUILDING' AND monthly > (SELECT quantile_cont(monthly, 0.5) FROM c360) THEN 1 ELSE 0 END AS price_sensitive_contract,
CASE WHEN contract IN ('FURNITURE', 'MACHINERY') THEN 1 ELSE 0 END AS long_term_contract,
CASE WHEN recency = 0 THEN 1 ELSE 0 END AS new_customer_flag,
CASE WHEN abs(total - monthly * recency) / (total + 1e-6) > 0.3 THEN 1 ELSE 0 END AS charges_mismatch_flag FROM c360)"""


@query("flag_impact", with_(C360, _FLAG_SQL) + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {r(f'avg({c})')} AS prevalence, {r(f'avg(CASE WHEN {c} = 1 THEN target END)')} AS rate_when_1,
    {r(f'(avg(CASE WHEN {c} = 1 THEN target END) - avg(target)) * 100')} AS delta_pp FROM flagged""" for c in _FLAGS))
def flag_impact(spark, sf):
    base = staged(customer360(spark, sf), "c360")
    wide = fe.population_features(base, RECENCY)
    flags = {**fe.contract_features(RECENCY), "new_customer_flag": fe.tenure_features(RECENCY)["new_customer_flag"],
             "charges_mismatch_flag": fe.charge_features(RECENCY)["charges_mismatch_flag"]}
    table = fe.select_features(wide, flags, ["target", "early_churn_risk", "price_sensitive_contract"])
    return rounded(profile.flag_impact(table, _FLAGS, "target"))
