"""Exact ranks, running sums and quantiles without a one-task sort.

``Window.orderBy`` without a partition, and ``percentile``, both bring a whole
column (or a whole group) into one task. Here the column is first reduced to
its distinct values (partial aggregation on the map side), range-partitioned,
and written with the number of its slab; running sums are taken inside each
slab and shifted by the totals of the slabs before it. The totals are one row
per (group, slab) touched, so at most groups + slabs rows.

The slab number is read back from the written table: range bounds are sampled,
and a second evaluation may draw others. Adaptive execution merges small slabs,
so a column with few distinct values is one slab, one file, and needs no shift.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.stage import staged

_SLAB = "_slab"


def running_sums(
    df: DataFrame, order: Sequence[str], sums: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<s>`` (inclusive, ascending) and ``tot_<s>`` per group.

    ``df`` holds one row per (groups, order).
    """
    groups, order = list(groups), list(order)
    slabs = staged(
        df.repartitionByRange(*groups, *order).withColumn(_SLAB, F.spark_partition_id()),
        "ledger",
    )
    whole = Window.partitionBy(*groups)
    here = [*groups, _SLAB]
    upto = (
        Window.partitionBy(*here)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = whole.orderBy(_SLAB).rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        slabs.groupBy(*here)
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            *here,
            *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_off_{s}") for s in sums],
            *[F.sum(s).over(whole).alias(f"tot_{s}") for s in sums],
        )
    )
    inside = slabs.select("*", *[F.sum(s).over(upto).alias(f"_in_{s}") for s in sums])
    joined = inside.join(shift, here)
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"tot_{s}" for s in sums],
    )


def value_ledger(
    df: DataFrame, value: str, sums: Mapping[str, Column], groups: Sequence[str] = ()
) -> DataFrame:
    """Distinct values of a column with summed measures and their running sums."""
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(*[expr.alias(name) for name, expr in sums.items()])
    )
    return running_sums(counted, [value], list(sums), groups)


def ranked(df: DataFrame, order: Sequence[str], rank: str, groups: Sequence[str] = ()) -> DataFrame:
    """Exact row number of each row of a table with unique (groups, order)."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    out = running_sums(one, order, ["_one"], groups)
    return out.withColumn(rank, F.col("cum__one")).drop("_one", "cum__one", "tot__one")


def quantiles(
    ledger: DataFrame, probs: Sequence[float], value: str, groups: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles from a ledger that carries counts as ``n``.

    One row per (groups, q) with the quantile in column ``quantile``.
    """
    below, upto = F.col("cum_n") - F.col("n"), F.col("cum_n")
    points = F.array(
        *[F.struct(F.lit(float(q)).alias("q"), ((F.col("tot_n") - 1) * F.lit(float(q))).alias("h")) for q in probs]
    )
    touched = F.filter(points, lambda p: (F.floor(p["h"]) < upto) & (F.ceil(p["h"]) >= below))
    # a plain condition first: only rows that hold a wanted rank reach the arrays
    wanted = [(F.col("tot_n") - 1) * F.lit(float(q)) for q in probs]
    holds = reduce(or_, [(F.floor(h) < upto) & (F.ceil(h) >= below) for h in wanted])
    hits = ledger.where(holds).select(
        *groups, F.col(value).alias("_v"), below.alias("_b"), upto.alias("_u"), F.explode(touched).alias("_p")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_b")) & (rank < F.col("_u")), F.col("_v")))

    h = F.col("_p.h")
    return (
        hits.groupBy(*groups, F.col("_p.q").alias("q"))
        .agg(at(F.floor(h)).alias("_lo"), at(F.ceil(h)).alias("_hi"), F.max(h - F.floor(h)).alias("_frac"))
        .select(
            *groups,
            "q",
            (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("quantile"),
        )
    )


def quantile_columns(
    ledger: DataFrame, probs: Mapping[str, float], value: str, groups: Sequence[str] = ()
) -> DataFrame:
    """One row per group with one named column per quantile."""
    table = quantiles(ledger, list(probs.values()), value, groups)
    return table.groupBy(*groups).agg(
        *[F.max(F.when(F.col("q") == F.lit(float(q)), F.col("quantile"))).alias(name) for name, q in probs.items()]
    )
