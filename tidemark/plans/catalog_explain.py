"""Attributions of a linear score of the customer view.

Each weight is the column's correlation with the target over its standard
deviation, so both engines can derive the same score from the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.shape import rounded, rows_of
from tidemark.functions.stage import staged
from tidemark.operators import explain as ex
from tidemark.plans.registry import Registry
from tidemark.plans.sqltext import C360, big, r, with_
from tidemark.sources.customer360 import customer360

REGISTRY = Registry()
query = REGISTRY.query


COLUMNS = ["tenure", "recency", "monthly", "total", "balance", "senior"]



def _customers(spark, sf):
    return staged(customer360(spark, sf).select("customer_key", "target", *COLUMNS), "c360")


def _weights(base):
    """One row of structs (weight, mean, importance) per column."""
    return base.agg(
        *[
            F.struct(
                (F.corr(c, "target") / F.stddev_samp(c)).alias("weight"),
                F.avg(c).alias("mean"),
                F.abs(F.corr(c, "target")).alias("importance"),
            ).alias(c)
            for c in COLUMNS
        ]
    )


def _parts(spark, sf):
    base = _customers(spark, sf)
    stats = _weights(base).select(F.struct(*COLUMNS)).scalar()
    return ex.linear_parts(
        base,
        ["customer_key", "target"],
        {c: stats[c]["weight"] for c in COLUMNS},
        {c: stats[c]["mean"] for c in COLUMNS},
    )


STATS = "stats AS (SELECT " + ", ".join(
    f"corr({c}, target) / stddev_samp({c}) AS w_{c}, avg({c}) AS m_{c}, abs(corr({c}, target)) AS i_{c}" for c in COLUMNS
) + " FROM c360)"
PARTS = "parts AS (" + " UNION ALL ".join(
    f"SELECT customer_key, target, '{c}' AS feature, {c}::DOUBLE AS value, w_{c} * ({c} - m_{c}) AS attribution FROM c360, stats"
    for c in COLUMNS
) + "),\nmeans AS (SELECT feature, avg(abs(attribution)) AS mean_abs, avg(attribution) AS mean_signed FROM parts GROUP BY 1)"
BASE = with_(C360, STATS, PARTS)


@query("linear_attribution", BASE + f"""SELECT customer_key, feature, {r('value')} AS value, {r('attribution')} AS attribution,
{r('(SELECT avg(target) FROM c360)')} AS base_value FROM parts""")
def linear_attribution(spark, sf):
    wide = _parts(spark, sf)
    base = wide.agg(F.avg("target")).scalar()
    return rounded(ex.long_parts(wide).drop("target").withColumn("base_value", base))


@query("top_contributors", BASE + f"""SELECT customer_key, direction, rank, feature, {r('attribution')} AS attribution FROM (
SELECT *, row_number() OVER (PARTITION BY customer_key, direction ORDER BY abs(attribution) DESC, feature) AS rank FROM (
SELECT *, CASE WHEN attribution > 0 THEN 'raises' ELSE 'lowers' END AS direction FROM parts WHERE attribution <> 0)) WHERE rank <= 5""")
def top_contributors(spark, sf):
    return rounded(ex.top_contributors(_parts(spark, sf), "customer_key", 5))


@query("top_by_size", BASE + f"""SELECT customer_key, rank, feature, {r('attribution')} AS attribution,
CASE WHEN attribution > 0 THEN 'raises' ELSE 'lowers' END AS direction FROM (SELECT *, row_number() OVER
(PARTITION BY customer_key ORDER BY abs(attribution) DESC, feature) AS rank FROM parts) WHERE rank <= 3""")
def top_by_size(spark, sf):
    return rounded(ex.top_by_size(_parts(spark, sf), "customer_key", 3))


@query("global_attribution", BASE + f"""SELECT feature, {r('mean_abs')} AS mean_abs,
row_number() OVER (ORDER BY mean_abs DESC, feature) AS rank FROM means""")
def global_attribution(spark, sf):
    return rounded(ex.global_attribution(ex.mean_parts(_parts(spark, sf))))


@query("importance_share", BASE + f"""SELECT feature, {r('mean_abs')} AS mean_abs,
{r('mean_abs / (SELECT sum(mean_abs) FROM means) * 100')} AS pct, {r('''sum(mean_abs / (SELECT sum(mean_abs) FROM means) * 100)
OVER (ORDER BY mean_abs DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''')} AS cumulative_pct,
row_number() OVER (ORDER BY mean_abs DESC, feature) AS rank FROM means""")
def importance_share(spark, sf):
    return rounded(ex.importance_share(ex.mean_parts(_parts(spark, sf))))


_STAYED = "stayed AS (SELECT " + ", ".join(f"avg({c}) AS s_{c}" for c in COLUMNS) + " FROM c360 WHERE target = 0)"
_FROM_STAYED = "moved AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(w_{c} * ({c} - s_{c})) AS m FROM c360, stats, stayed" for c in COLUMNS
) + ")"


@query("direction_lists", with_(C360, STATS, _STAYED, _FROM_STAYED).rstrip() + f""",
sided AS (SELECT *, CASE WHEN m > 0 THEN 'raises' ELSE 'lowers' END AS direction FROM moved WHERE m <> 0)
SELECT direction, rank, feature, {r('m')} AS mean_signed FROM (SELECT *, row_number() OVER (PARTITION BY direction
ORDER BY abs(m) DESC, feature) AS rank FROM sided) WHERE rank <= 5""")
def direction_lists(spark, sf):
    """Mean attribution over all customers, measured from the mean customer that stayed."""
    base = _customers(spark, sf)
    stats = _weights(base).select(F.struct(*COLUMNS)).scalar()
    stayed = base.where("target = 0").agg(*[F.avg(c).alias(c) for c in COLUMNS]).select(F.struct(*COLUMNS)).scalar()
    parts = ex.linear_parts(
        base, ["customer_key", "target"], {c: stats[c]["weight"] for c in COLUMNS}, {c: stayed[c] for c in COLUMNS}
    )
    return rounded(ex.direction_lists(ex.mean_parts(parts)))


_NATIVE = "native AS (" + " UNION ALL ".join(f"SELECT '{c}' AS nf, i_{c} AS importance FROM stats" for c in COLUMNS) + ")"


@query("rank_agreement", with_(C360, STATS, PARTS, _NATIVE) .rstrip() + f""",
a AS (SELECT feature, row_number() OVER (ORDER BY mean_abs DESC, feature) AS ra FROM means),
b AS (SELECT nf, row_number() OVER (ORDER BY importance DESC, nf) AS rb FROM native),
j AS (SELECT feature, ra, rb FROM a LEFT JOIN b ON feature = nf)
SELECT feature, ra AS rank_attribution, rb AS rank_native, rb - ra AS delta, {r('(SELECT corr(ra, rb) FROM j)')} AS spearman
FROM j WHERE ra <= 15""")
def rank_agreement(spark, sf):
    base = _customers(spark, sf)
    row = _weights(base)
    stats = row.select(F.struct(*COLUMNS)).scalar()
    wide = ex.linear_parts(
        base, ["customer_key"], {c: stats[c]["weight"] for c in COLUMNS}, {c: stats[c]["mean"] for c in COLUMNS}
    )
    native = rows_of(row, [{"feature": F.lit(c), "importance": F.col(f"{c}.importance")} for c in COLUMNS])
    return rounded(ex.rank_agreement(ex.mean_parts(wide), native))


TOTALS = ", totals AS (SELECT customer_key, target, sum(attribution) AS t FROM parts GROUP BY 1, 2)"


@query("attribution_by_class", BASE.rstrip() + TOTALS + f""" SELECT {big('target')} AS target, count(*) AS n, {r('avg(t)')} AS mean,
{r('stddev_samp(t)')} AS std, {r('min(t)')} AS min, {r('max(t)')} AS max FROM totals GROUP BY 1""")
def attribution_by_class(spark, sf):
    return rounded(ex.attribution_by_class(_parts(spark, sf), "target"))


@query("top_features_by_class", BASE.rstrip() + f""", best AS (SELECT feature AS bf FROM means ORDER BY mean_abs DESC, feature LIMIT 5)
SELECT feature, {big('target')} AS target, {r('avg(attribution)')} AS mean_attribution FROM parts JOIN best ON feature = bf
GROUP BY 1, 2""")
def top_features_by_class(spark, sf):
    return rounded(ex.top_features_by_class(_parts(spark, sf), "target"))


@query("overlap_zone", BASE.rstrip() + TOTALS + f""", q AS (SELECT quantile_cont(t, 0.25) AS q1 FROM totals WHERE target = 1)
SELECT {r('sum(CASE WHEN target = 0 AND t > q1 THEN 1 ELSE 0 END) / sum(1 - target)::DOUBLE')} AS overlap, {r('max(q1)')} AS q1,
{r('avg(CASE WHEN target = 0 THEN t END)')} AS mean_0, {r('avg(CASE WHEN target = 1 THEN t END)')} AS mean_1,
{r('avg(CASE WHEN target = 1 THEN t END) - avg(CASE WHEN target = 0 THEN t END)')} AS gap FROM totals, q""")
def overlap_zone(spark, sf):
    return rounded(ex.overlap_zone(_parts(spark, sf), "target"))


@query("dependence", BASE + f"""SELECT customer_key, feature, {r('value')} AS value, {r('attribution')} AS attribution FROM parts
WHERE feature = (SELECT feature FROM means ORDER BY mean_abs DESC, feature LIMIT 1)""")
def dependence(spark, sf):
    return rounded(ex.dependence(_parts(spark, sf), "customer_key"))
