"""Drift of many columns between a reference and a current table.

Each cell becomes (feature, value, n_ref, n_cur). One grouping of those cells
serves both tests: PSI sums them per bin or category, KS reads their running
sums in value order.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ledger import running_sums
from tidemark.functions.shape import equal_width_bin, long_numeric, long_text, per_feature
from tidemark.functions.stage import staged
from tidemark.roles import (
    DRIFT_ADVICE,
    DRIFT_ESCALATION_COUNT,
    PSI_BINS,
    PSI_FLOOR,
    PSI_LEVELS,
    PSI_TOP_LEVEL,
)

# tasks get these functions by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---------------------------------------------------------------- cells


def side_cells(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], numeric: bool, grouped: bool = True
) -> DataFrame:
    """(feature, value, n_ref, n_cur); one row per distinct value when grouped."""
    make = long_numeric if numeric else long_text
    present = [c for c in columns if c in reference.columns and c in current.columns]
    if not present:
        raise ValueError(f"none of {list(columns)} is in both tables")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    cells = (
        make(reference, present)
        .select("feature", "value", one.alias("n_ref"), zero.alias("n_cur"))
        .unionByName(make(current, present).select("feature", "value", zero.alias("n_ref"), one.alias("n_cur")))
        .where("value is not null")
    )
    if not grouped:
        return cells
    return cells.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def reference_spans(cells: DataFrame) -> DataFrame:
    """(feature, low, high) of the reference values."""
    seen = cells.where("n_ref > 0")
    return seen.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))


def label_numeric(cells: DataFrame, spans: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """Add ``label``: the equal-width bin of the reference span, null outside it."""
    return cells.join(per_feature(spans), "feature").withColumn(
        "label", equal_width_bin(F.col("value"), F.col("low"), F.col("high"), bins).cast("string")
    )


# ---------------------------------------------------------------- PSI


def _floored(part: Column, whole: Column) -> Column:
    return F.least(F.greatest(F.try_divide(part.cast("double"), whole), F.lit(PSI_FLOOR)), F.lit(1.0))


def _term(expected: Column, actual: Column) -> Column:
    return (actual - expected) * F.ln(actual / expected)


def psi_from_labels(labelled: DataFrame) -> DataFrame:
    """(feature, psi) from (feature, label, n_ref, n_cur).

    Rows without a label (outside the reference span) count in the size of
    their side only. A side without rows gives 0.
    """
    counts = labelled.groupBy("feature", "label").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    sizes = counts.groupBy("feature").agg(F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"))
    term = _term(_floored(F.col("n_ref"), F.col("_ref")), _floored(F.col("n_cur"), F.col("_cur")))
    usable = F.col("label").isNotNull() & (F.col("_ref") > 0) & (F.col("_cur") > 0)
    return (
        counts.join(per_feature(sizes), "feature")
        .groupBy("feature")
        .agg(F.sum(F.when(usable, term).otherwise(0.0)).alias("psi"))
    )


def psi_numeric(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = PSI_BINS
) -> DataFrame:
    """PSI over equal-width bins; what is shuffled is one count per feature and bin."""
    cells = side_cells(reference, current, columns, numeric=True, grouped=False)
    return psi_from_labels(label_numeric(cells, reference_spans(cells), bins))


def psi_categorical(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PSI over the union of categories."""
    cells = side_cells(reference, current, columns, numeric=False, grouped=False)
    return psi_from_labels(cells.withColumnRenamed("value", "label"))


def drift_severity(psi: Column) -> Column:
    level = F.lit(PSI_TOP_LEVEL)
    for limit, name in reversed(PSI_LEVELS):
        level = F.when(psi < limit, name).otherwise(level)
    return level


# ---------------------------------------------------------------- KS


def kolmogorov_p(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value; 1 where the series converges too slowly to matter."""
    n, m = n.cast("double"), m.cast("double")
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def exact_p(steps: int, n: int, m: int) -> float:
    """Share of the orderings of n and m rows whose largest gap is at least ``steps`` / (n m).

    Orderings are lattice paths from (0, 0) to (n, m); those that stay closer to the diagonal are counted row by row, as
    shares of all paths, so nothing overflows. Work grows with n times m.
    """
    if n < 1 or m < 1 or steps <= 0:
        return 1.0
    at = np.arange(m + 1)
    paths = (at * n < steps).astype(float)  # row 0: one path to each place inside
    for i in range(1, n + 1):
        inside = np.abs(i * m - at * n) < steps
        # a path enters row i at some k <= j and goes right; whatever lies before the band cannot
        low = int(inside.argmax()) if inside.any() else m + 1
        fresh = np.where(at >= low, paths, 0.0)
        paths = np.where(inside, np.cumsum(fresh), 0.0) * (i / (i + m))
    return float(min(max(1.0 - paths[m], 0.0), 1.0))


def _p_value(ks: Column, n: Column, m: Column, exact: bool) -> Column:
    """One number per column of a report."""
    if not exact:
        return kolmogorov_p(ks, n, m)

    @F.pandas_udf("double")
    def counted(steps: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([exact_p(round(s), int(a), int(b)) for s, a, b in zip(steps, n, m)], dtype="float64")

    return counted(F.round(ks * n.cast("double") * m.cast("double")), n, m)


def ks_from_ledger(ledger: DataFrame, exact: bool = False) -> DataFrame:
    """(feature, ks, ks_pvalue): largest gap between the two cumulative shares.

    The p-value is the asymptotic one, or with ``exact`` the share of all orderings of the two sides, which takes work
    in proportion to the product of their rows.
    """
    gap = F.abs(
        F.try_divide(F.col("cum_n_ref").cast("double"), F.col("tot_n_ref"))
        - F.try_divide(F.col("cum_n_cur").cast("double"), F.col("tot_n_cur"))
    )
    table = ledger.groupBy("feature").agg(
        F.max(gap).alias("ks"), F.max("tot_n_ref").alias("_n"), F.max("tot_n_cur").alias("_m")
    )
    return table.where("_n > 0 and _m > 0").select("feature", "ks", _p_value(F.col("ks"), F.col("_n"), F.col("_m"), exact).alias("ks_pvalue"))


def side_ledger(reference: DataFrame, current: DataFrame, columns: Sequence[str], numeric: bool) -> DataFrame:
    cells = side_cells(reference, current, columns, numeric)
    return running_sums(cells, ["value"], ["n_ref", "n_cur"], ["feature"])


def ks_numeric(reference: DataFrame, current: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    return ks_from_ledger(side_ledger(reference, current, columns, numeric=True), exact)


def ks_categorical(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """KS over categories in sorted order; their codes need not be made."""
    return ks_from_ledger(side_ledger(reference, current, columns, numeric=False))


# ---------------------------------------------------------------- reports


def drift_report(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), exact: bool = False
) -> DataFrame:
    """(feature, kind, psi, ks_statistic, ks_pvalue, severity, has_drift, ks_significant).

    Both tables are read once per kind; empty columns are left out. ``exact`` is that of ``ks_from_ledger``.
    """
    parts = []
    if numeric:
        ledger = staged(side_ledger(reference, current, numeric, numeric=True), "cells")
        psi = psi_from_labels(label_numeric(ledger, reference_spans(ledger)))
        parts.append(psi.join(ks_from_ledger(ledger, exact), "feature").withColumn("kind", F.lit("numeric")))
    if categorical:
        ledger = staged(side_ledger(reference, current, categorical, numeric=False), "cells")
        psi = psi_from_labels(ledger.withColumn("label", F.col("value")))
        parts.append(psi.join(ks_from_ledger(ledger, exact), "feature").withColumn("kind", F.lit("categorical")))
    return _report(parts)


def _report(parts: Sequence[DataFrame]) -> DataFrame:
    """The report from (feature, psi, ks, ks_pvalue, kind) of each kind of columns."""
    severity = drift_severity(F.col("psi"))
    return reduce(DataFrame.unionByName, parts).select(
        "feature",
        "kind",
        F.round("psi", 4).alias("psi"),
        F.round("ks", 4).alias("ks_statistic"),
        F.round("ks_pvalue", 4).alias("ks_pvalue"),
        severity.alias("severity"),
        severity.isin("moderate", "high").cast("int").alias("has_drift"),
        (F.col("ks_pvalue") < 0.05).cast("int").alias("ks_significant"),
    ).orderBy(F.desc("psi"), "feature")


def drift_overall(report: DataFrame) -> DataFrame:
    """One row: counts per level, overall severity, share of columns with any drift, advice."""
    levels = [name for _, name in PSI_LEVELS] + [PSI_TOP_LEVEL]
    counts = report.agg(
        F.count("*").alias("features_checked"),
        F.count_if(F.col("severity") != "none").alias("features_with_drift"),
        *[F.count_if(F.col("severity") == level).alias(f"n_{level}") for level in levels],
    )
    overall = (
        F.when(F.col("n_high") >= DRIFT_ESCALATION_COUNT, "high")
        .when((F.col("n_high") > 0) | (F.col("n_moderate") >= DRIFT_ESCALATION_COUNT), "moderate")
        .when((F.col("n_moderate") > 0) | (F.col("n_low") > 0), "low")
        .otherwise("none")
    )
    advice = F.create_map(*[F.lit(x) for pair in DRIFT_ADVICE.items() for x in pair])
    pct = F.try_divide(F.col("features_with_drift").cast("double") * 100, F.col("features_checked"))
    return counts.withColumn("overall_severity", overall).withColumns(
        {
            "drift_percentage": F.round(F.coalesce(pct, F.lit(0.0)), 2),
            "recommendation": advice[F.col("overall_severity")],
        }
    )


def distribution_compare(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    top: int = 6,
    bins: int = PSI_BINS,
) -> DataFrame:
    """(feature, source, label, share, density) of the columns with the highest PSI.

    Numeric columns are binned over both sides; density is share over width.
    """
    num = staged(side_cells(reference, current, numeric, numeric=True), "cells")
    cat = staged(side_cells(reference, current, categorical, numeric=False), "cells")
    spans = per_feature(num.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high")))
    binned = num.join(spans, "feature").select(
        "feature",
        equal_width_bin(F.col("value"), F.col("low"), F.col("high"), bins).cast("string").alias("label"),
        ((F.col("high") - F.col("low")) / bins).alias("width"),
        "n_ref",
        "n_cur",
    )
    texts = cat.select("feature", F.col("value").alias("label"), F.lit(None).cast("double").alias("width"), "n_ref", "n_cur")
    counts = (
        binned.unionByName(texts)
        .groupBy("feature", "label", "width")
        .agg(F.sum("n_ref").alias("reference"), F.sum("n_cur").alias("current"))
    )
    # one row per column of the schema
    psi = psi_from_labels(label_numeric(num, reference_spans(num), bins)).unionByName(
        psi_from_labels(cat.withColumnRenamed("value", "label"))
    )
    chosen = psi.orderBy(F.desc("psi"), "feature").limit(top).select("feature")
    kept = counts.join(per_feature(chosen), "feature")
    sizes = per_feature(
        kept.groupBy("feature").agg(F.sum("reference").alias("_ref"), F.sum("current").alias("_cur"))
    )
    stacked = (
        kept.join(sizes, "feature")
        .select(
            "feature",
            "label",
            "width",
            F.try_divide(F.col("reference").cast("double"), F.col("_ref")).alias("reference"),
            F.try_divide(F.col("current").cast("double"), F.col("_cur")).alias("current"),
        )
        .unpivot(["feature", "label", "width"], ["reference", "current"], "source", "share")
    )
    return stacked.where("share > 0").select(
        "feature", "source", "label", "share", F.try_divide(F.col("share"), F.col("width")).alias("density")
    )


# ---------------------------------------------------------------- fixed reference, many windows


def reference_profile(
    reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = PSI_BINS
) -> tuple[DataFrame, DataFrame]:
    """(spans, counts) of a reference, written once and kept: the spans of numeric
    columns, and (feature, label, n_ref, ref_size) for bins and categories."""
    cells = long_numeric(reference, numeric).where("value is not null").withColumn("n_ref", F.lit(1).cast("long"))
    spans = staged(reference_spans(cells), "spans")
    labelled = label_numeric(cells, spans, bins).select("feature", "label")
    if categorical:
        texts = long_text(reference, categorical).where("value is not null")
        labelled = labelled.unionByName(texts.select("feature", F.col("value").alias("label")))
    counts = labelled.groupBy("feature", "label").agg(F.count("*").alias("n_ref"))
    sizes = per_feature(counts.groupBy("feature").agg(F.sum("n_ref").alias("ref_size")))
    return spans, staged(counts.join(sizes, "feature"), "profile")


def window_labels(
    current: DataFrame,
    spans: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    window: str,
    bins: int = PSI_BINS,
) -> DataFrame:
    """(window, feature, label) per cell of a batch or stream, labelled like the profile."""
    num = label_numeric(long_numeric(current, numeric, [window]).where("value is not null"), spans, bins)
    out = num.select(window, "feature", "label")
    if categorical:
        cat = long_text(current, categorical, [window]).where("value is not null")
        out = out.unionByName(cat.select(window, "feature", F.col("value").alias("label")))
    return out


def windowed_psi(counts: DataFrame, profile: DataFrame, window: str) -> DataFrame:
    """(window, feature, psi, severity) from (window, feature, label, n) and a profile.

    Labels of the profile that a window lacks still add their term at the floor;
    that sum is taken over the whole profile, less the labels the window has.
    """
    floor = F.lit(PSI_FLOOR)
    expected = _floored(F.col("n_ref"), F.col("ref_size"))
    known = profile.where("label is not null").select(
        "feature", "label", expected.alias("_e"), _term(expected, floor).alias("_absent")
    )
    absent = known.groupBy("feature").agg(F.sum("_absent").alias("_all_absent"))
    sizes = counts.groupBy(window, "feature").agg(F.sum("n").alias("_size"))
    actual = counts.join(sizes, [window, "feature"]).withColumn("_a", _floored(F.col("n"), F.col("_size")))
    terms = actual.join(known, ["feature", "label"], "left")
    term = F.when(F.col("label").isNotNull(), _term(F.coalesce(F.col("_e"), floor), F.col("_a"))).otherwise(0.0)
    return (
        terms.groupBy(window, "feature")
        .agg(F.sum(term - F.coalesce(F.col("_absent"), F.lit(0.0))).alias("_p"))
        .join(per_feature(absent), "feature", "left")
        .select(window, "feature", (F.col("_p") + F.coalesce("_all_absent", F.lit(0.0))).alias("psi"))
        .withColumn("severity", drift_severity(F.col("psi")))
    )


def drift_by_window(
    reference: DataFrame,
    current: DataFrame,
    time: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    width: str = "1 day",
) -> DataFrame:
    """PSI of every tumbling window of the current rows against one reference."""
    spans, profile = reference_profile(reference, numeric, categorical)
    tagged = current.withColumn("window_start", F.window(time, width)["start"])
    labels = window_labels(tagged, spans, numeric, categorical, "window_start")
    counts = labels.groupBy("window_start", "feature", "label").agg(F.count("*").alias("n"))
    return windowed_psi(counts, profile, "window_start")
