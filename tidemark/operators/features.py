"""Feature statistics learned on training rows, and the 48 derived columns.

``fit`` reads the training rows and leaves a small state: named numbers, bin
edges, and one row per category. ``transform`` is a lookup join per category
column and a single ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.brackets import exact_quantiles, numeric_cells, rank_ledger
from tidemark.functions.ledger import quantiles, ranked
from tidemark.functions.points import column_quantiles
from tidemark.functions.shape import flag, number, sql_name, sql_text, total
from tidemark.functions.stage import staged
from tidemark.operators.clean import binary_target, fix_total
from tidemark.roles import (
    AMOUNT_LABELS,
    CHARGES_DIVERGENCE,
    EARLY_CHURN_TENURE,
    HIGH_ENGAGEMENT_MIN,
    LIFECYCLE_EARLY_MAX,
    LIFECYCLE_MID_MAX,
    LIFECYCLE_NEW_MAX,
    LOW_ENGAGEMENT_MAX,
    RISK_SCORE_HIGH,
    RISK_SCORE_VERY_HIGH,
    RISK_WEIGHTS,
    TENURE_BINS,
    TENURE_LABELS,
    Roles,
)

# ---------------------------------------------------------------- statistics


def charge_per_month(roles: Roles) -> Column:
    """Total over tenure, 0 for customers without a full month."""
    tenure = F.col(roles.tenure)
    return F.when(tenure > 0, F.col(roles.total) / tenure).otherwise(F.lit(0.0))


#: Shares of the quantiles that features are cut at.
QUARTERS = (0.0, 0.25, 0.5, 0.75, 1.0)


def amounts(train: DataFrame, roles: Roles) -> DataFrame:
    return train.select(F.col(roles.monthly).alias("monthly"), charge_per_month(roles).alias("avg_charge"))


def amount_cells(train: DataFrame, roles: Roles) -> DataFrame:
    return rank_ledger(numeric_cells(amounts(train, roles), ["monthly", "avg_charge"]), QUARTERS, "value", ["feature"])


def amount_quartiles(cells: DataFrame) -> DataFrame:
    """(feature, q, quantile) of the monthly amount and of the charge per month."""
    return quantiles(cells, QUARTERS, "value", ["feature"])


def open_edges(quartiles: Sequence[float]) -> list[float]:
    """Distinct quartiles, or five equal-width edges when some coincide; ends open. A column without values is one open bin."""
    edges = sorted(set(quartiles))
    if not edges:
        return [float("-inf"), float("inf")]
    if len(edges) < 5:
        low, high = edges[0], edges[-1]
        edges = [low + i * ((high - low) / 4) for i in range(5)]
    return [float("-inf"), *edges[1:-1], float("inf")]


def amount_medians(cells: DataFrame) -> DataFrame:
    """(feature, median) of the monthly amount and of the charge per month."""
    return quantiles(cells, [0.5], "value", ["feature"]).select("feature", F.col("quantile").alias("median"))


def category_means(train: DataFrame, column: str, value: str) -> DataFrame:
    """(category, n, mean) of a measure per category."""
    return (
        train.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("category"))
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    )


def category_rates(train: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, category, n, rate): mean target per category of several columns, one pass."""
    cells = train.select(target, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [target], list(columns), "feature", "category"
    )
    return (
        cells.where("category is not null")
        .groupBy("feature", "category")
        .agg(F.count(target).alias("n"), F.avg(target).alias("rate"))
    )


def supervised_encoding(train: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Rates with their ordinal 0..k-1, highest rate first, ties by name."""
    rates = category_rates(train, columns, target).withColumn("_falling", -F.col("rate"))
    order = ranked(rates, ["_falling", "category"], "_place", ["feature"])
    return order.select("feature", "category", "n", "rate", (F.col("_place") - 1).alias("ordinal"))


@dataclass
class FeatureStats:
    """Fitted state; ``categories`` is (feature, category, n, rate, ordinal, tenure_mean)."""

    scalars: dict[str, float | None]
    edges: list[float]
    categories: DataFrame | None = field(default=None, repr=False)

    @property
    def supervised(self) -> bool:
        return self.scalars.get("global_rate") is not None

    def save(self, spark: SparkSession, folder: str) -> None:
        rows = [(k, None if v is None else float(v)) for k, v in sorted(self.scalars.items())]
        spark.createDataFrame(rows, "name string, value double").write.mode("overwrite").parquet(f"{folder}/scalars")
        spark.createDataFrame([(self.edges,)], "edges array<double>").write.mode("overwrite").parquet(f"{folder}/edges")
        self.categories.write.mode("overwrite").parquet(f"{folder}/categories")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> FeatureStats:
        scalars = {r.name: r.value for r in spark.read.parquet(f"{folder}/scalars").collect()}
        edges = spark.read.parquet(f"{folder}/edges").first().edges
        return cls(scalars, list(edges), spark.read.parquet(f"{folder}/categories"))


def fit(train: DataFrame, roles: Roles, supervised: bool = True) -> FeatureStats:
    """Learn edges, medians, segment means and target rates from training rows."""
    train = fix_total(train, roles)
    supervised = supervised and roles.target in train.columns
    if supervised:
        train = binary_target(train, roles.target, roles.positive)
    five = column_quantiles(amounts(train, roles), ["monthly", "avg_charge"], QUARTERS)
    edges = open_edges(list(five.get("monthly", {}).values()))
    # a column without values has no median: comparisons with it are null
    scalars = {"median_monthly": None, "median_avg_charge": None} | {f"median_{c}": found[0.5] for c, found in five.items()}
    y = F.col(roles.target) if supervised else F.lit(None).cast("double")
    scalars["global_tenure"], scalars["global_rate"] = train.agg(F.avg(roles.tenure), F.avg(y)).first()
    means = category_means(train, roles.contract, roles.tenure).select(
        F.lit(roles.contract).alias("feature"), "category", F.col("mean").alias("tenure_mean")
    )
    if supervised:
        coded = supervised_encoding(train, [roles.contract, roles.internet, roles.payment], roles.target)
        table = coded.join(means, ["feature", "category"], "left")
    else:
        blank = F.lit(None)
        table = means.select(
            "feature",
            "category",
            blank.cast("long").alias("n"),
            blank.cast("double").alias("rate"),
            blank.cast("long").alias("ordinal"),
            "tenure_mean",
        )
    table = staged(table, "categories")
    for r in table.groupBy("feature").agg(F.avg("rate").alias("m")).collect():
        scalars[f"mean_rate_{r.feature}"] = r.m
    return FeatureStats(scalars, edges, table)


# ---------------------------------------------------------------- transforms


def with_lookups(df: DataFrame, roles: Roles, stats: FeatureStats, columns: Sequence[str]) -> DataFrame:
    """Left-join the category rows of each column as ``_<column>_<measure>``."""
    for c in columns:
        side = stats.categories.where(F.col("feature") == c).select(
            F.col("category").alias(f"_{c}_key"),
            F.col("rate").alias(f"_{c}_rate"),
            F.col("ordinal").alias(f"_{c}_ordinal"),
            F.col("tenure_mean").alias(f"_{c}_tenure"),
        )
        df = df.join(side, F.col(c).cast("string") == F.col(f"_{c}_key"), "left")
    return df


def _active_count(columns: Sequence[str], roles: Roles) -> Column:
    """Services that are on: all whose value does not say off, so null counts.

    One SQL text, as the same sums go into many derived columns.
    """
    if not columns:
        return F.lit(0)
    off = ", ".join(sql_text(v) for v in roles.inactive_values)
    return F.expr(" + ".join(f"(1 - CAST(coalesce({sql_name(c)} IN ({off}), false) AS INT))" for c in columns))


def tenure_features(roles: Roles) -> dict[str, Column]:
    t = F.col(roles.tenure)
    group = F.when(t < TENURE_BINS[0], F.lit(None).cast("string"))
    for top, label in zip(TENURE_BINS[1:], TENURE_LABELS):
        group = group.when(t <= top, label)
    return {"new_customer_flag": flag(t == 0), "tenure_group": group}


def charge_features(roles: Roles) -> dict[str, Column]:
    paid = F.col(roles.total)
    gap = F.abs(paid - F.col(roles.monthly) * F.col(roles.tenure))
    return {
        "avg_monthly_charge": charge_per_month(roles),
        "charges_mismatch_flag": flag(F.try_divide(gap, paid + 1e-6) > CHARGES_DIVERGENCE),
    }


def contract_features(roles: Roles) -> dict[str, Column]:
    c = F.col(roles.contract)
    return {
        "is_monthly_contract": flag(c == roles.monthly_contract),
        "long_term_contract": flag(c.isin(*roles.long_contracts)),
    }


def amount_bin(roles: Roles, stats: FeatureStats) -> dict[str, Column]:
    x = F.col(roles.monthly)
    labels = AMOUNT_LABELS[: len(stats.edges) - 1]
    band = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(stats.edges[1:], labels):
        band = band.when(x <= F.lit(edge), label)
    return {f"{roles.monthly}_binned": band}


def price_features(roles: Roles, stats: FeatureStats) -> dict[str, Column]:
    over = F.col(roles.monthly) > F.lit(stats.scalars["median_monthly"])
    return {
        f"is_high_{roles.monthly}": flag(charge_per_month(roles) > F.lit(stats.scalars["median_avg_charge"])),
        "price_sensitive_contract": flag((F.col(roles.contract) == roles.monthly_contract) & over),
    }


def behaviour_features(roles: Roles) -> dict[str, Column]:
    monthly = F.col(roles.contract) == roles.monthly_contract
    return {"early_churn_risk": flag(monthly & (F.col(roles.tenure) < EARLY_CHURN_TENURE))}


def segment_features(roles: Roles, stats: FeatureStats) -> dict[str, Column]:
    fallback = stats.scalars.get("global_tenure")
    mean = F.coalesce(F.col(f"_{roles.contract}_tenure"), F.lit(1.0 if fallback is None else fallback))
    return {"tenure_vs_contract_avg": F.col(roles.tenure) / F.when(mean == 0, 1.0).otherwise(mean)}


def encoded_features(roles: Roles, stats: FeatureStats) -> dict[str, Column]:
    if not stats.supervised:
        return {}
    c = roles.contract
    return {
        "contract_risk_ordinal": F.coalesce(F.col(f"_{c}_ordinal"), F.lit(0)).cast("int"),
        "contract_churn_rate": F.coalesce(F.col(f"_{c}_rate"), F.lit(stats.scalars["global_rate"])),
    }


def nonlinear_features(roles: Roles) -> dict[str, Column]:
    out = {}
    sources = {
        roles.monthly: F.col(roles.monthly),
        roles.total: F.col(roles.total),
        "avg_monthly_charge": charge_per_month(roles),
    }
    for name, x in sources.items():
        out[f"{name}_log"] = F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))
        out[f"{name}_squared"] = x * x
    return out


def service_features(roles: Roles) -> dict[str, Column]:
    count = _active_count(roles.services, roles)
    streams = _active_count(roles.streaming, roles)
    guards = _active_count(roles.security, roles)
    return {
        "total_services": count,
        "service_density": F.try_divide(count.cast("double"), F.lit(len(roles.services))),
        "streaming_services": streams,
        "has_streaming": (streams > 0).cast("int"),
        "security_services": guards,
        "has_security": (guards > 0).cast("int"),
    }


def engagement_features(roles: Roles) -> dict[str, Column]:
    count = _active_count(roles.services, roles)
    partner, family = F.col(roles.partner) == "Yes", F.col(roles.dependents) == "Yes"
    return {
        "low_engagement": (count <= LOW_ENGAGEMENT_MAX).cast("int"),
        "high_engagement": (count >= HIGH_ENGAGEMENT_MIN).cast("int"),
        "digital_only": flag((F.col(roles.paperless) == "Yes") & F.col(roles.payment).rlike(roles.digital_pattern)),
        "family_account": flag(partner | family),
        "family_stability": flag(partner & family),
    }


def interaction_features(roles: Roles, stats: FeatureStats) -> dict[str, Column]:
    net = F.col(roles.internet)
    unguarded = _active_count(roles.security, roles) == 0
    streams = _active_count(roles.streaming, roles) > 0
    online = ~F.coalesce(net == roles.no_internet, F.lit(False))
    median = stats.scalars.get("median_monthly")
    rich = F.lit(False) if median is None else F.col(roles.monthly) > F.lit(median)
    return {
        "fiber_no_security": flag((net == roles.fibre) & unguarded),
        "streamer_unprotected": flag(online & streams & unguarded),
        "senior_monthly": flag((F.col(roles.senior) == 1) & (F.col(roles.contract) == roles.monthly_contract)),
        "new_high_value": flag((F.col(roles.tenure) == 0) & rich),
    }


def risk_score(roles: Roles) -> Column:
    """Weighted sum of six warning signs, 0 to 8."""
    unguarded = _active_count(roles.security, roles) == 0
    signs = {
        "monthly_contract": flag(F.col(roles.contract) == roles.monthly_contract),
        "short_tenure": flag(F.col(roles.tenure) < EARLY_CHURN_TENURE),
        "fiber_no_security": flag((F.col(roles.internet) == roles.fibre) & unguarded),
        "low_engagement": flag(_active_count(roles.services, roles) <= LOW_ENGAGEMENT_MAX),
        "paperless_billing": flag(F.col(roles.paperless) == "Yes"),
        "electronic_check": flag(F.col(roles.payment) == roles.electronic_check),
    }
    return total([signs[name] * F.lit(weight) for name, weight in RISK_WEIGHTS.items()])


def risk_features(roles: Roles, stats: FeatureStats) -> dict[str, Column]:
    score = risk_score(roles)
    out = {
        "churn_risk_score": score,
        "high_risk_flag": (score >= RISK_SCORE_HIGH).cast("int"),
        "very_high_risk_flag": (score >= RISK_SCORE_VERY_HIGH).cast("int"),
    }
    if stats.supervised:
        for name, c in (("internet_risk", roles.internet), ("payment_risk", roles.payment)):
            out[name] = F.coalesce(F.col(f"_{c}_rate"), F.lit(stats.scalars.get(f"mean_rate_{c}")))
    return out


def lifecycle_features(roles: Roles) -> dict[str, Column]:
    t = F.col(roles.tenure)
    return {
        "lifecycle_new": flag(t <= LIFECYCLE_NEW_MAX),
        "lifecycle_early": flag((t > LIFECYCLE_NEW_MAX) & (t <= LIFECYCLE_EARLY_MAX)),
        "lifecycle_mid": flag((t > LIFECYCLE_EARLY_MAX) & (t <= LIFECYCLE_MID_MAX)),
        "lifecycle_mature": flag(t > LIFECYCLE_MID_MAX),
        "tenure_years": t / 12,
        "tenure_sqrt": F.sqrt(t),
    }


def value_features(roles: Roles) -> dict[str, Column]:
    t, monthly = F.col(roles.tenure), F.col(roles.monthly)
    count = _active_count(roles.services, roles)
    return {
        "estimated_clv": monthly * t,
        "value_per_month": F.when(t > 0, F.col(roles.total) / t).otherwise(monthly),
        "cost_per_service": F.when(count > 0, F.try_divide(monthly, count)).otherwise(monthly),
    }


def all_features(roles: Roles, stats: FeatureStats) -> dict[str, Column]:
    return {
        **tenure_features(roles),
        **charge_features(roles),
        **contract_features(roles),
        **amount_bin(roles, stats),
        **price_features(roles, stats),
        **behaviour_features(roles),
        **segment_features(roles, stats),
        **encoded_features(roles, stats),
        **nonlinear_features(roles),
        **service_features(roles),
        **engagement_features(roles),
        **interaction_features(roles, stats),
        **risk_features(roles, stats),
        **lifecycle_features(roles),
        **value_features(roles),
    }


def select_features(df: DataFrame, features: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[c.alias(n) for n, c in features.items()])


def transform(df: DataFrame, roles: Roles, stats: FeatureStats) -> DataFrame:
    """The input columns with all derived columns, in one select."""
    roles = roles.present(df.columns)
    fixed = fix_total(df, roles)
    looked = with_lookups(fixed, roles, stats, [roles.contract, roles.internet, roles.payment])
    return select_features(looked, all_features(roles, stats), df.columns)


def population_features(df: DataFrame, roles: Roles) -> DataFrame:
    """Variant without a fit: medians and segment means of the data itself.

    The segment mean is a small grouped table joined back; a window over the
    segment would bring each segment into one task.
    """
    base = number(F.col(roles.monthly))
    cells = staged(df.select(base.alias("value")), "amounts")
    median = exact_quantiles(cells, [0.5]).select("quantile").scalar()
    means = staged(category_means(df, roles.contract, roles.tenure), "segments").select("category", "mean")
    over = F.col(roles.monthly) > median
    return df.join(means, F.col(roles.contract).cast("string") == F.col("category"), "left").select(
        *df.columns,
        behaviour_features(roles)["early_churn_risk"].alias("early_churn_risk"),
        flag((F.col(roles.contract) == roles.monthly_contract) & over).alias("price_sensitive_contract"),
        F.try_divide(F.col(roles.tenure), F.col("mean")).alias("tenure_vs_contract_avg"),
    )
