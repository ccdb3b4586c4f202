"""Information value of many columns at once.

Each cell becomes (feature, value); counting them is the only pass over the
data. What follows works on the distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.brackets import exact_quantiles, numeric_cells
from tidemark.functions.shape import long_text, per_feature
from tidemark.functions.stage import staged
from tidemark.roles import IV_LABELS, IV_TOP_LABEL


def _smoothed_iv(bins: DataFrame, smoothing: float) -> DataFrame:
    """Bins (feature, event, total) to one IV per feature."""
    sums = per_feature(
        bins.groupBy("feature").agg(
            F.sum("event").alias("_events"),
            F.sum(F.col("total") - F.col("event")).alias("_others"),
            F.count("*").alias("_k"),
        )
    )
    extra = F.col("_k") * smoothing
    e = (F.col("event") + smoothing) / (F.col("_events") + extra)
    ne = (F.col("total") - F.col("event") + smoothing) / (F.col("_others") + extra)
    return (
        bins.join(sums, "feature")
        .select("feature", ((e - ne) * F.ln(e / ne)).alias("part"))
        .groupBy("feature")
        .agg(F.sum("part").alias("iv"))
    )


def iv_categorical(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    smoothing: float = 0.5,
    declared: DataFrame | None = None,
) -> DataFrame:
    """(feature, iv); null values are left out.

    ``declared`` (feature, value) lists labels of ordered bins that count even
    when no row has them.
    """
    cells = long_text(df, columns, [target]).where("value is not null")
    measures = [F.sum(target).cast("double").alias("event"), F.count(target).alias("total")]
    bins = cells.groupBy("feature", "value").agg(*measures)
    if declared is not None:
        empty = declared.select("feature", "value", F.lit(0.0).alias("event"), F.lit(0).cast("long").alias("total"))
        bins = (
            bins.unionByName(empty)
            .groupBy("feature", "value")
            .agg(F.sum("event").alias("event"), F.sum("total").alias("total"))
        )
    return _smoothed_iv(bins, smoothing)


def numeric_bins(
    df: DataFrame, columns: Sequence[str], target: str, bins: int = 10, trim: tuple[float, float] = (0.01, 0.99)
) -> DataFrame:
    """(feature, bin, event, total) over quantile bins of the trimmed values.

    Trim bounds and bin edges are ranks found in brackets; the bins are counted in one partial aggregate of the cells.
    """
    cells = numeric_cells(df.where(F.col(target).isNotNull()), columns, [target])
    ends = exact_quantiles(cells, trim, "value", ["feature"]).groupBy("feature").agg(
        F.min("quantile").alias("_low"), F.max("quantile").alias("_high")
    )
    bounded = cells.join(per_feature(staged(ends, "ends")), "feature")
    trimmed = bounded.where(F.col("value").between(F.col("_low"), F.col("_high"))).select("feature", "value", target)
    edges = (
        exact_quantiles(trimmed, [i / bins for i in range(bins + 1)], "value", ["feature"])
        .groupBy("feature")
        .agg(F.array_sort(F.collect_set("quantile")).alias("_edges"))
    )
    below = F.size(F.filter("_edges", lambda e: e < F.col("value")))
    return (
        trimmed.join(per_feature(staged(edges, "edges")), "feature")
        .withColumn("bin", F.greatest(F.lit(1), below))
        .where(F.col("bin") < F.size("_edges"))
        .groupBy("feature", "bin")
        .agg(F.sum(target).cast("double").alias("event"), F.count(F.lit(1)).alias("total"))
    )


def iv_numeric(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    bins: int = 10,
    min_bin_size: float = 0.05,
    smoothing: float = 0.5,
) -> DataFrame:
    """(feature, iv); bins under ``min_bin_size`` of the rows go before totals are taken."""
    counted = numeric_bins(df, columns, target, bins)
    # at most `bins` rows per feature
    rows = F.sum("total").over(Window.partitionBy("feature"))
    kept = counted.withColumn("_rows", rows).where(F.col("total") / F.col("_rows") >= min_bin_size)
    return _smoothed_iv(kept.drop("_rows"), smoothing)


def iv_rank(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], target: str
) -> DataFrame:
    """All columns by IV, highest first, with the strength label."""
    both = (
        iv_categorical(df, categorical, target)
        .withColumn("kind", F.lit("categorical"))
        .unionByName(iv_numeric(df, numeric, target).withColumn("kind", F.lit("numeric")))
    )
    label = F.lit(IV_TOP_LABEL)
    for limit, name in reversed(IV_LABELS):
        label = F.when(F.col("iv") < limit, name).otherwise(label)
    # one row per column of the schema
    place = F.row_number().over(Window.orderBy(F.desc("iv"), F.asc("feature")))
    return both.select("feature", "kind", "iv", label.alias("strength"), place.alias("rank"))


def iv_select(ranking: DataFrame, min_iv: float = 0.02) -> DataFrame:
    """Columns kept (1) or dropped (0) at a minimum IV."""
    return ranking.select("feature", "iv", (F.col("iv") >= min_iv).cast("int").alias("kept"))


def drop_below_iv(df: DataFrame, ranking: DataFrame, min_iv: float = 0.02) -> DataFrame:
    """The table without its weak columns (one name per column reaches the driver)."""
    weak = [r.feature for r in iv_select(ranking, min_iv).where("kept = 0").collect()]
    return df.drop(*weak)


def feature_schema(df: DataFrame, ranking: DataFrame, selected: Sequence[str]) -> DataFrame:
    """(feature, type, iv) of the selected columns; iv null where none was taken."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    spark = df.sparkSession
    wanted = spark.createDataFrame([(c, types[c]) for c in selected], "feature string, type string")
    return wanted.join(ranking.select("feature", "iv"), "feature", "left")
