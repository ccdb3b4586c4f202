"""Exact quantiles by bracketing ranks: no exchange carries a row per distinct value.

A sketch of each group (merged on the map side) gives values known to lie on either side of every wanted rank. Then one
partial aggregate counts the rows: those outside all brackets become one row per stretch between brackets, those inside are
counted by value. Running counts over these few rows are exact, so the wanted ranks are read off as from a full ledger.
Where a bracket would still hold many rows, it is sketched again on its own rows first, which narrows it by the sketch's
accuracy each time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.ledger import quantile_columns, quantiles
from tidemark.functions.shape import number
from tidemark.functions.stage import staged

#: Relative rank error of a sketch is 1 / ACCURACY; rows that a bracket may hold when its values are counted.
ACCURACY, CROWD = 10_000, 200_000
_GRID = [i / 64 for i in range(1, 64)]


def numeric_cells(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, feature, value): the cells of the numeric columns that hold a number, from a table written once."""
    wide = staged(df.select(*ids, *[number(F.col(c)).alias(c) for c in columns]), "numbers")
    return wide.unpivot(list(ids), list(columns), "feature", "value").where("value IS NOT NULL")


def _sketch(cells: DataFrame, value: str, shares: Sequence[float], groups: Sequence[str], accuracy: int) -> DataFrame:
    """(groups, n, low, high, at): the ends, and the values about each share, of every group."""
    grid = F.array(*[F.lit(s) for s in shares])
    return cells.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.percentile_approx(value, grid, accuracy).alias("at")
    )


def _enclosed(rank: tuple[Column, Column], n: Column, shares: Sequence[float], accuracy: int) -> tuple[Column, Column, Column]:
    """(low, high, rows at most) of the tightest grid values that surely enclose ranks ``rank`` (first, last, from 0)."""
    slack = n * (2.0 / accuracy) + 2
    points = F.arrays_zip(F.array(*[F.lit(s) for s in shares]).alias("s"), F.col("at").alias("v"))
    below = F.filter(points, lambda p: p["s"] * n + slack <= rank[0])
    above = F.filter(points, lambda p: p["s"] * n - slack >= rank[1] + 1)
    low = F.when(F.size(below) > 0, F.struct(F.element_at(below, -1)["v"].alias("v"), F.element_at(below, -1)["s"].alias("s"))).otherwise(F.struct(F.col("low").alias("v"), F.lit(0.0).alias("s")))
    high = F.when(F.size(above) > 0, F.struct(F.element_at(above, 1)["v"].alias("v"), F.element_at(above, 1)["s"].alias("s"))).otherwise(F.struct(F.col("high").alias("v"), F.lit(1.0).alias("s")))
    return low["v"], high["v"], (high["s"] - low["s"]) * n + 2 * slack


def _key(groups: Sequence[str]) -> list[Column]:
    return [F.col(g) for g in groups]


def _joined(cells: DataFrame, table: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Cells with their group's brackets: one row per group, as many as a schema has columns or a label classes."""
    small = F.broadcast(table)
    return cells.join(small, list(groups)) if groups else cells.crossJoin(small)


def rank_ledger(cells: DataFrame, probs: Sequence[float], value: str = "value", groups: Sequence[str] = (), accuracy: int = ACCURACY, crowd: int = CROWD) -> DataFrame:
    """A ledger (groups, value, n, cum_n, tot_n) that is exact at the ranks ``probs`` ask for.

    It holds every value of the brackets about these ranks, and one row for all values of a stretch between them.
    ``groups`` are few (columns of a schema, classes of a label) and not null; null values are left out, as are NaN. The
    table ``cells`` is read several times: write it first if it is dear.
    """
    groups, probs = list(groups), sorted(set(map(float, probs)))
    cells = cells.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*groups, F.col(value).cast("double").alias("value"))
    width = 4.0 / accuracy
    shares = sorted({s for q in probs for s in (q - width, q + width) if 0 < s < 1} | set(_GRID))
    n = F.col("n")
    ranks = {i: (F.floor((n - 1) * q), F.ceil((n - 1) * q)) for i, q in enumerate(probs)}
    found = {i: _enclosed(r, n, shares, accuracy) for i, r in ranks.items()}
    table = staged(
        _sketch(cells, "value", shares, groups, accuracy).select(
            *groups, "n", *[c.alias(f"{name}{i}") for i, each in found.items() for name, c in zip(("lo", "hi", "most"), each)], *[r.alias(f"r{name}{i}") for i, each in ranks.items() for name, r in zip("ab", each)]
        ),
        "brackets",
    )
    while True:
        most = table.agg(F.max(F.greatest(*[F.when(F.col(f"lo{i}") < F.col(f"hi{i}"), F.col(f"most{i}")).otherwise(0) for i in found], F.lit(0)))).first()[0]
        if most is None or most <= crowd:
            break
        table, before = _narrowed(cells, table, len(probs), groups, accuracy), most
        after = table.agg(F.max(F.greatest(*[F.when(F.col(f"lo{i}") < F.col(f"hi{i}"), F.col(f"most{i}")).otherwise(0) for i in found], F.lit(0)))).first()[0]
        if after >= before:
            break
    return staged(_counted(cells, table, len(probs), groups), "ranks")


def _narrowed(cells: DataFrame, table: DataFrame, k: int, groups: Sequence[str], accuracy: int) -> DataFrame:
    """The brackets sketched again, each on its own rows; ranks inside are those of the group less the rows below."""
    shares = [i / (accuracy // 8) for i in range(1, accuracy // 8)]
    inside = [F.when(F.col("value").between(F.col(f"lo{i}"), F.col(f"hi{i}")), F.lit(i)) for i in range(k)]
    joined = _joined(cells, table, groups)
    below = joined.groupBy(*groups).agg(*[F.count_if(F.col("value") < F.col(f"lo{i}")).alias(f"below{i}") for i in range(k)])
    each = joined.select(*groups, "value", F.explode(F.array_compact(F.array(*inside))).alias("bracket"))
    sketch = _sketch(each, "value", shares, [*groups, "bracket"], accuracy)
    ranks = _joined(sketch.withColumnRenamed("n", "held"), table.join(below, list(groups)) if groups else table.crossJoin(below), groups)
    pick = lambda name: F.element_at(F.array(*[F.col(f"{name}{i}") for i in range(k)]), F.col("bracket") + 1)
    low, high, most = _enclosed((pick("ra") - pick("below"), pick("rb") - pick("below")), F.col("held"), shares, accuracy)
    new = ranks.select(*groups, "bracket", low.alias("lo"), high.alias("hi"), F.least(most, F.col("held").cast("double")).alias("most"))
    wide = new.groupBy(*groups).agg(*[F.max(F.when(F.col("bracket") == i, F.col(c))).alias(f"{c}{i}") for i in range(k) for c in ("lo", "hi", "most")])
    old = table.select(*groups, "n", *[f"r{c}{i}" for i in range(k) for c in "ab"])
    return staged(old.join(wide, list(groups)) if groups else old.crossJoin(wide), "brackets")


def _counted(cells: DataFrame, table: DataFrame, k: int, groups: Sequence[str]) -> DataFrame:
    """Values inside brackets with their counts, stretches outside as one row each, and running counts."""
    joined = _joined(cells, table.select(*groups, F.col("n").alias("tot_n"), *[f"{c}{i}" for i in range(k) for c in ("lo", "hi")]), groups)
    x = F.col("value")
    inside = reduce(or_, [x.between(F.col(f"lo{i}"), F.col(f"hi{i}")) for i in range(k)])
    # brackets a value lies beyond: values of one stretch have the same number
    beyond = sum([(x > F.col(f"hi{i}")).cast("int") for i in range(k)], F.lit(0))
    counted = joined.groupBy(*groups, F.when(inside, x).alias("_v"), F.when(~inside, beyond).alias("_s"), "tot_n").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))
    # few rows per group: what the brackets hold
    upto = Window.partitionBy(*groups).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.select(*groups, "value", "n", F.sum("n").over(upto).alias("cum_n"), "tot_n")


def exact_quantiles(cells: DataFrame, probs: Sequence[float], value: str = "value", groups: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles: one row per (groups, q) with the quantile in column ``quantile``."""
    return quantiles(rank_ledger(cells, probs, value, groups), probs, "value", groups)


def exact_quantile_columns(cells: DataFrame, probs: Mapping[str, float], value: str = "value", groups: Sequence[str] = ()) -> DataFrame:
    """One row per group with one named column per quantile."""
    return quantile_columns(rank_ledger(cells, list(probs.values()), value, groups), probs, "value", groups)
