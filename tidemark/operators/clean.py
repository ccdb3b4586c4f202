"""Input contract, cleaning and row selection."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.draw import draw_order
from tidemark.functions.shape import number
from tidemark.roles import Roles


def column_gaps(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Names (missing, extra) against the expected input columns."""
    present = set(df.columns)
    return [c for c in expected if c not in present], [c for c in df.columns if c not in set(expected)]


def conform(df: DataFrame, expected: Sequence[str], strict: bool = True) -> DataFrame:
    """Expected columns in the expected order; extras are refused when strict."""
    missing, extra = column_gaps(df, expected)
    if missing or (strict and extra):
        raise ValueError(f"missing columns: {missing}; unexpected columns: {extra}")
    return df.select(*expected)


def row_violations(df: DataFrame, roles: Roles) -> DataFrame:
    """(key, column_name, rule) for every broken range, value list or required cell."""
    checks = []
    for c, (low, high) in roles.numeric_ranges.items():
        x = number(F.col(c))
        checks += [(c, "required", x.isNull()), (c, "min", x < F.lit(low)), (c, "max", x > F.lit(high))]
    for c, values in roles.valid_values.items():
        checks += [(c, "required", F.col(c).isNull()), (c, "valid", ~F.col(c).isin(*values))]
    found = F.array(
        *[
            F.when(broken, F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule")))
            for c, rule, broken in checks
        ]
    )
    return df.select(F.col(roles.key), F.inline(F.filter(found, lambda v: v.isNotNull())))


def batch_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack batches by column name; row identity travels in the key column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fix_total(df: DataFrame, roles: Roles) -> DataFrame:
    """Total as a number; an unreadable total of a new customer is 0, others stay null."""
    parsed = number(F.col(roles.total))
    new = (F.col(roles.tenure) == 0) & parsed.isNull()
    return df.withColumn(roles.total, F.when(new, F.lit(0.0)).otherwise(parsed))


def blank_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.when(~F.col(f.name).rlike(r"^\s*$"), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def complete_cases(df: DataFrame) -> DataFrame:
    """Blanks become null, then rows with any null are left out."""
    return blank_to_null(df).dropna()


def binary_target(df: DataFrame, target: str, positive: str = "Yes", check: bool = False) -> DataFrame:
    """Target as 0/1: numbers pass, text matches ``positive`` in any case, null text is 0."""
    kind = df.schema[target].dataType
    if isinstance(kind, T.NumericType):
        return df.withColumn(target, F.col(target).cast("int"))
    if not isinstance(kind, T.StringType):
        raise ValueError(f"unsupported target type {kind.simpleString()}")
    text = F.lower(F.col(target))
    if check and df.select(text.alias("c")).dropna().distinct().limit(3).count() > 2:
        warnings.warn(f"{target} has more than two classes; all but {positive!r} become 0", stacklevel=2)
    return df.withColumn(target, F.coalesce((text == F.lit(positive.lower())).cast("int"), F.lit(0)))


def validate_target(df: DataFrame, target: str) -> bool:
    """Raise unless every non-null target is 0 or 1."""
    bad = df.where(~F.col(target).isin(0, 1)).select(target).limit(1).collect()
    if bad:
        raise ValueError(f"{target} must hold only 0 and 1, found {bad[0][0]!r}")
    return True


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.dropna(subset=[target])


def non_numeric_audit(df: DataFrame, column: str, by: str) -> DataFrame:
    """Raw texts that do not parse as a number, counted by value and by ``by``."""
    return (
        df.where(F.col(column).isNotNull() & number(F.col(column)).isNull())
        .groupBy(F.col(column).alias("raw_value"), F.col(by))
        .agg(F.count("*").alias("n"))
    )


def sample_complete(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` complete rows in seeded order (a top-n, not a sort)."""
    return complete_cases(df).orderBy(draw_order(key, seed)).limit(n)


def drop_weak(df: DataFrame, weak: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*[c for c in weak if c in df.columns])
