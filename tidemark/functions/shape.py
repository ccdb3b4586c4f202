"""Small column helpers used by every operator."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """0/1 with an unknown condition counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def share(part: Column, whole: Column) -> Column:
    """Quotient with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def total(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


def number(column: Column) -> Column:
    """Text or number as double; unreadable text and NaN become null."""
    parsed = column.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def sql_name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def long_numeric(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, feature, value double): one row per cell of the numeric columns."""
    cast = df.select(*ids, *[number(F.col(c)).alias(c) for c in columns])
    return cast.unpivot(list(ids), list(columns), "feature", "value")


def long_text(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, feature, value string): one row per cell of the categorical columns."""
    cast = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    return cast.unpivot(list(ids), list(columns), "feature", "value")


def per_feature(table: DataFrame) -> DataFrame:
    """Mark a table with one row per column of a schema as broadcast side.

    Its size is bounded by the number of columns of the wide table, not by data.
    """
    return F.broadcast(table)


def equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin 0..bins-1 of equal-width edges from low to high, last bin closed.

    Values outside give null; a constant range is widened by one half each way.
    """
    start = F.when(high > low, low).otherwise(low - 0.5)
    stop = F.when(high > low, high).otherwise(high + 0.5)
    step = (stop - start) / F.lit(bins)
    inner = total([(x >= F.lit(i) * step + start).cast("int") for i in range(1, bins)])
    return F.when((x >= start) & (x <= stop), inner)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles (and fold -0.0 into 0.0); widen integers to long."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("double", "float"):
            out.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        elif kind in ("int", "smallint", "tinyint"):
            out.append(F.col(f.name).cast("long").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def rows_of(one_row: DataFrame, records: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a wide one-row aggregate into one row per record."""
    structs = [F.struct(*[c.alias(name) for name, c in r.items()]) for r in records]
    return one_row.select(F.inline(F.array(*structs)))
