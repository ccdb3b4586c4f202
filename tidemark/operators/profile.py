"""Profiling: one aggregate per table, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.brackets import exact_quantile_columns, numeric_cells
from tidemark.functions.shape import (
    equal_width_bin,
    long_text,
    number,
    per_feature,
    rows_of,
)
from tidemark.functions.stage import staged
from tidemark.operators.comoments import correlation_pairs

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing cells (null, or NaN in a fraction) and their percentage (2 digits) for columns that have any."""
    names = list(columns or df.columns)
    fractions = {name for name, kind in df.dtypes if kind in ("float", "double")}
    missing = {c: F.col(c).isNull() | F.isnan(c) if c in fractions else F.col(c).isNull() for c in names}
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(m).alias(f"_{c}") for c, m in missing.items()])
    table = rows_of(
        counts,
        [
            {
                "column_name": F.lit(c),
                "nulls": F.col(f"_{c}"),
                "pct": F.round(F.col(f"_{c}") / F.col("_rows") * 100, 2),
            }
            for c in names
        ],
    )
    return table.where("nulls > 0")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column."""
    cells = numeric_cells(df, columns)
    stats = cells.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    quarts = exact_quantile_columns(cells, QUARTILES, "value", ["feature"])
    named = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    table = per_feature(named).join(stats.join(per_feature(quarts), "feature"), "feature", "left")
    return table.withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct, most frequent value (ties: smallest) and its count."""
    counts = long_text(df, columns).dropna().groupBy("feature", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("feature").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def value_counts(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Most frequent values with their share of the non-null rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    rows = df.agg(F.count(column)).scalar()
    return (
        counts.orderBy(F.desc("n"), F.asc(column))
        .limit(top)
        .select(F.col(column).cast("string").alias("value"), "n", (F.col("n") / rows).alias("share"))
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))
    rows = df.agg(F.count(target)).scalar()
    return counts.select(target, "n", (F.col("n") / rows * 100).alias("pct"))


def rate_by_category(df: DataFrame, column: str, target: str) -> DataFrame:
    """Mean target per category, highest first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"), F.avg(target).alias("rate"))
        .orderBy(F.desc("rate"), F.asc(column))
    )


def share_within(df: DataFrame, column: str, target: str) -> DataFrame:
    """Rows per (column, target) and their percentage of the column value."""
    counts = df.dropna(subset=[column, target]).groupBy(column, target).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(column))
    return counts.select(column, target, "n", (F.col("n") / whole * 100).alias("pct"))


def group_mean_compare(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Mean per class and the difference in percent of the class-0 mean."""

    def mean(c: str, y: int) -> Column:
        return F.avg(F.when(F.col(target) == y, number(F.col(c))))

    means = df.agg(
        *[mean(c, 0).alias(f"{c}_0") for c in columns], *[mean(c, 1).alias(f"{c}_1") for c in columns]
    )
    return rows_of(
        means,
        [
            {
                "feature": F.lit(c),
                "mean_0": F.col(f"{c}_0"),
                "mean_1": F.col(f"{c}_1"),
                "diff_pct": F.round(
                    F.try_divide(F.col(f"{c}_1") - F.col(f"{c}_0"), F.col(f"{c}_0")) * 100, 1
                ),
            }
            for c in columns
        ],
    )


def flag_impact(df: DataFrame, flags: Sequence[str], target: str) -> DataFrame:
    """Prevalence of each 0/1 flag, target rate when set, difference to base in pp."""
    stats = df.agg(
        F.avg(target).alias("_base"),
        *[F.avg(F.when(F.col(c) == 1, 1.0).otherwise(0.0)).alias(f"{c}_p") for c in flags],
        *[F.avg(F.when(F.col(c) == 1, F.col(target))).alias(f"{c}_r") for c in flags],
    )
    return rows_of(
        stats,
        [
            {
                "feature": F.lit(c),
                "prevalence": F.col(f"{c}_p"),
                "rate_when_1": F.col(f"{c}_r"),
                "delta_pp": (F.col(f"{c}_r") - F.col("_base")) * 100,
            }
            for c in flags
        ],
    ).orderBy(F.desc_nulls_last("delta_pp"), "feature")


def histogram_by_class(df: DataFrame, column: str, target: str, bins: int = 30) -> DataFrame:
    """Counts per equal-width bin and class; edges span the whole column."""
    x = number(F.col(column))
    span = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high"))).scalar()
    return (
        df.select(F.col(target), x.alias("_x"))
        .where("_x is not null")
        .select(target, equal_width_bin(F.col("_x"), span["low"], span["high"], bins).alias("bin"))
        .groupBy(target, "bin")
        .agg(F.count("*").alias("n"))
    )


def box_by_class(df: DataFrame, column: str, target: str) -> DataFrame:
    """Quartiles and Tukey whiskers (last value within 1.5 IQR) per class."""
    cells = staged(df.select(F.col(target), number(F.col(column)).alias("value")).dropna(), "cells")
    boxes = staged(exact_quantile_columns(cells, QUARTILES, "value", [target]), "boxes")
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = (F.col("value") >= F.col("q25") - reach) & (F.col("value") <= F.col("q75") + reach)
    kept = F.when(inside, F.col("value"))
    return (
        cells.join(boxes, target)
        .groupBy(target)
        .agg(
            *[F.max(q).alias(q) for q in QUARTILES],
            F.min(kept).alias("whisker_low"),
            F.max(kept).alias("whisker_high"),
        )
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every pair of columns."""
    return correlation_pairs(df, columns)


def leakage_screen(df: DataFrame, columns: Sequence[str], target: str, limit: float = 0.95) -> DataFrame:
    """Correlation with the target, nulls read as 0, constant columns left out."""
    y = F.col(target).cast("double")
    stats = df.agg(
        *[F.corr(F.coalesce(number(F.col(c)), F.lit(0.0)), y).alias(f"{c}_r") for c in columns],
        *[(F.max(number(F.col(c))) > F.min(number(F.col(c)))).alias(f"{c}_v") for c in columns],
    )
    table = rows_of(
        stats,
        [{"feature": F.lit(c), "corr": F.col(f"{c}_r"), "_varies": F.col(f"{c}_v")} for c in columns],
    )
    return (
        table.where("_varies")
        .select("feature", "corr", (F.abs("corr") > limit).cast("int").alias("suspect"))
        .orderBy(F.desc(F.abs("corr")), "feature")
    )


def iqr_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fences 1.5 IQR outside the exact quartiles, with outlier counts, per column."""
    cells = numeric_cells(df, columns)
    quarts = exact_quantile_columns(cells, {"q25": 0.25, "q75": 0.75}, "value", ["feature"])
    reach = (F.col("q75") - F.col("q25")) * 1.5
    fences = quarts.select(
        "feature", (F.col("q25") - reach).alias("lower_bound"), (F.col("q75") + reach).alias("upper_bound")
    )
    return (
        cells.join(per_feature(fences), "feature")
        .groupBy("feature")
        .agg(
            F.max("lower_bound").alias("lower_bound"),
            F.max("upper_bound").alias("upper_bound"),
            F.count_if(F.col("value") < F.col("lower_bound")).alias("outliers_lower"),
            F.count_if(F.col("value") > F.col("upper_bound")).alias("outliers_upper"),
        )
        .withColumn("total_outliers", F.col("outliers_lower") + F.col("outliers_upper"))
    )


def outliers_iqr(df: DataFrame, column: str, name: str = "is_outlier") -> DataFrame:
    """Mask of values strictly outside the fences."""
    fence = iqr_bounds(df, [column]).agg(
        F.struct(F.max("lower_bound").alias("low"), F.max("upper_bound").alias("high"))
    ).scalar()
    x = number(F.col(column))
    return df.withColumn(name, F.coalesce((x < fence["low"]) | (x > fence["high"]), F.lit(False)).cast("int"))


def mad_stats(df: DataFrame, columns: Sequence[str], threshold: float = 3.5) -> DataFrame:
    """Median, median absolute deviation and count of values beyond the threshold."""
    cells = numeric_cells(df, columns)
    medians = per_feature(staged(exact_quantile_columns(cells, {"median": 0.5}, "value", ["feature"]), "medians"))
    off = cells.join(medians, "feature").select("feature", "value", "median", F.abs(F.col("value") - F.col("median")).alias("dev"))
    mads = per_feature(exact_quantile_columns(off, {"mad": 0.5}, "dev", ["feature"]))
    score = F.when(F.col("mad") == 0, 0.0).otherwise(
        F.try_divide(F.lit(0.6745) * (F.col("value") - F.col("median")), F.col("mad"))
    )
    return (
        off.join(mads, "feature")
        .groupBy("feature")
        .agg(
            F.max("median").alias("median"),
            F.max("mad").alias("mad"),
            F.count_if(F.abs(score) > threshold).alias("outliers"),
        )
    )


def outliers_mad(df: DataFrame, column: str, threshold: float = 3.5, name: str = "is_outlier") -> DataFrame:
    """Mask of values whose modified z-score is beyond the threshold."""
    s = mad_stats(df, [column], threshold).agg(
        F.struct(F.max("median").alias("median"), F.max("mad").alias("mad"))
    ).scalar()
    score = F.try_divide(F.lit(0.6745) * (number(F.col(column)) - s["median"]), F.nullif(s["mad"], F.lit(0.0)))
    return df.withColumn(name, F.coalesce(F.abs(score) > threshold, F.lit(False)).cast("int"))


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """Positive rate, weight (1-p)/p and negatives per positive."""
    p, pos = F.avg(target), F.count_if(F.col(target) == 1)
    return df.agg(
        p.alias("positive_rate"),
        F.try_divide(1 - p, p).alias("pos_weight"),
        F.try_divide(F.count_if(F.col(target) == 0).cast("double"), pos.cast("double")).alias("neg_per_pos"),
    )
