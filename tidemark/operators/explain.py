"""Attributions: how much each column moves a row's score.

The wide form keeps one array of (feature, value, attribution) per row, so
per-row rankings need no shuffle; the long form is its ``inline``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.brackets import exact_quantiles
from tidemark.functions.shape import number, per_feature
from tidemark.functions.stage import staged


def background_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of every column."""
    return df.agg(*[F.avg(number(F.col(c))).alias(c) for c in columns])


def linear_parts(
    df: DataFrame, keep: Sequence[str], weights: Mapping[str, Column], means: Mapping[str, Column]
) -> DataFrame:
    """Keep columns and ``parts``: weight times distance from the background mean."""
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            number(F.col(c)).alias("value"),
            (w * (number(F.col(c)) - means[c])).alias("attribution"),
        )
        for c, w in weights.items()
    ]
    return df.select(*keep, F.array(*cells).alias("parts"))


def long_parts(wide: DataFrame) -> DataFrame:
    return wide.select(*[c for c in wide.columns if c != "parts"], F.inline("parts"))


def top_contributors(wide: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Per row the n most positive and the n most negative parts, strongest first."""

    def pick(sign: int) -> Column:
        strong = F.filter("parts", lambda p: p["attribution"] * sign > 0)
        order = F.array_sort(
            F.transform(
                strong,
                lambda p: F.struct(
                    (p["attribution"] * -sign).alias("o"), p["feature"].alias("feature"), p["attribution"].alias("attribution")
                ),
            )
        )
        side = F.lit("raises" if sign > 0 else "lowers")
        return F.transform(
            F.slice(order, 1, n),
            lambda p, i: F.struct(
                side.alias("direction"), (i + 1).alias("rank"), p["feature"].alias("feature"), p["attribution"].alias("attribution")
            ),
        )

    return wide.select(key, F.inline(F.concat(pick(1), pick(-1))))


def top_by_size(wide: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Per row the n parts of greatest absolute size with their direction."""
    order = F.array_sort(
        F.transform(
            "parts",
            lambda p: F.struct(
                (-F.abs(p["attribution"])).alias("o"), p["feature"].alias("feature"), p["attribution"].alias("attribution")
            ),
        )
    )
    ranked = F.transform(
        F.slice(order, 1, n),
        lambda p, i: F.struct(
            (i + 1).alias("rank"),
            p["feature"].alias("feature"),
            p["attribution"].alias("attribution"),
            F.when(p["attribution"] > 0, "raises").otherwise("lowers").alias("direction"),
        ),
    )
    return wide.select(key, F.inline(ranked))


# Tables below hold one row per column of the schema, so their windows are small.


def mean_parts(wide: DataFrame) -> DataFrame:
    """(feature, mean_abs, mean_signed) over all rows."""
    return (
        long_parts(wide)
        .groupBy("feature")
        .agg(F.avg(F.abs("attribution")).alias("mean_abs"), F.avg("attribution").alias("mean_signed"))
    )


def global_attribution(means: DataFrame, top: int = 20) -> DataFrame:
    place = F.row_number().over(Window.orderBy(F.desc("mean_abs"), F.asc("feature")))
    return means.select("feature", "mean_abs", place.alias("rank")).where(F.col("rank") <= top)


def importance_share(means: DataFrame) -> DataFrame:
    """Share of the total mean absolute attribution and its running sum, in percent."""
    order = Window.orderBy(F.desc("mean_abs"), F.asc("feature"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pct = F.col("mean_abs") / F.sum("mean_abs").over(Window.partitionBy()) * 100
    table = means.withColumn("pct", pct)
    return table.select(
        "feature",
        "mean_abs",
        "pct",
        F.sum("pct").over(upto).alias("cumulative_pct"),
        F.row_number().over(order).alias("rank"),
    )


def direction_lists(means: DataFrame, n: int = 5) -> DataFrame:
    """Columns that raise and columns that lower the score most on average."""
    side = F.when(F.col("mean_signed") > 0, "raises").when(F.col("mean_signed") < 0, "lowers")
    signed = means.withColumn("direction", side).where("direction is not null")
    order = Window.partitionBy("direction").orderBy(F.desc(F.abs("mean_signed")), F.asc("feature"))
    return signed.select(
        "direction", F.row_number().over(order).alias("rank"), "feature", "mean_signed"
    ).where(F.col("rank") <= n)


def rank_agreement(means: DataFrame, native: DataFrame, top: int = 15) -> DataFrame:
    """Attribution rank against the model's own importance rank, with Spearman's rho.

    ``native`` is (feature, importance).
    """
    ours = means.select(
        "feature", F.row_number().over(Window.orderBy(F.desc("mean_abs"), F.asc("feature"))).alias("rank_attribution")
    )
    theirs = native.select(
        "feature", F.row_number().over(Window.orderBy(F.desc("importance"), F.asc("feature"))).alias("rank_native")
    )
    both = ours.join(theirs, "feature", "left")
    rho = both.dropna().agg(F.corr("rank_attribution", "rank_native")).scalar()
    return both.where(F.col("rank_attribution") <= top).select(
        "feature",
        "rank_attribution",
        "rank_native",
        (F.col("rank_native") - F.col("rank_attribution")).alias("delta"),
        rho.alias("spearman"),
    )


def row_totals(wide: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Sum of the parts of each row."""
    added = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["attribution"])
    return wide.select(*keep, added.alias("total_attribution"))


def attribution_by_class(wide: DataFrame, label: str) -> DataFrame:
    """mean, std, min, max of the row totals per actual class."""
    x = F.col("total_attribution")
    return (
        row_totals(wide, [label])
        .groupBy(label)
        .agg(
            F.count("*").alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
    )


def top_features_by_class(wide: DataFrame, label: str, top: int = 5) -> DataFrame:
    """Mean part per class of the columns with the highest mean absolute part."""
    chosen = global_attribution(mean_parts(wide), top).select("feature")
    return (
        long_parts(wide)
        .groupBy("feature", label)
        .agg(F.avg("attribution").alias("mean_attribution"))
        .join(per_feature(chosen), "feature")
    )


def overlap_zone(wide: DataFrame, label: str) -> DataFrame:
    """Share of class 0 above the first quartile of class 1, and the gap of the means."""
    totals = row_totals(wide, [label])
    x, zero, one = F.col("total_attribution"), F.col(label) == 0, F.col(label) == 1
    totals = staged(totals, "totals")
    q1 = exact_quantiles(totals.where(one), [0.25], "total_attribution").select("quantile").scalar()
    sums = totals.withColumn("_q1", q1).agg(
        F.count_if(zero & (x > F.col("_q1"))).alias("above"),
        F.count_if(zero).alias("n0"),
        F.count_if(one).alias("n1"),
        F.sum(F.when(zero, x)).alias("s0"),
        F.sum(F.when(one, x)).alias("s1"),
        F.max("_q1").alias("q1"),
    )
    mean0, mean1 = F.try_divide(F.col("s0"), F.col("n0")), F.try_divide(F.col("s1"), F.col("n1"))
    return sums.select(
        F.try_divide(F.col("above").cast("double"), F.col("n0")).alias("overlap"),
        "q1",
        mean0.alias("mean_0"),
        mean1.alias("mean_1"),
        (mean1 - mean0).alias("gap"),
    )


def dependence(wide: DataFrame, key: str) -> DataFrame:
    """(key, feature, value, attribution) of the column with the highest mean absolute part."""
    top = mean_parts(wide).agg(F.min_by("feature", F.struct(-F.col("mean_abs"), F.col("feature")))).scalar()
    return long_parts(wide).where(F.col("feature") == top).select(key, "feature", "value", "attribution")
