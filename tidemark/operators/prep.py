"""Splits, folds, imputation, scaling and encoding.

Statistics are learned on training rows in one aggregate over all columns and
applied as column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.draw import with_part
from tidemark.functions.ledger import ranked
from tidemark.functions.points import column_quantiles
from tidemark.functions.shape import long_numeric, long_text, number
from tidemark.functions.stage import staged
from tidemark.roles import MISSING_CATEGORY

SCALERS = ("standard", "minmax", "robust", None)
NUMERIC_FILLS = ("mean", "median", "most_frequent")
CATEGORICAL_FILLS = ("constant", "most_frequent")


def stratified_split(
    df: DataFrame, key: str, target: str | None, test_size: float = 0.2, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Add 'test' for floor(n * test_size) rows of each class, 'train' for the rest."""
    f = Fraction(str(test_size))
    parted = with_part(df, key, target, [(f.numerator, f.denominator)], seed, name)
    return parted.withColumn(name, F.when(F.col(name) == 0, "test").otherwise("train"))


def assign_folds(df: DataFrame, key: str, target: str | None, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold 0..k-1 with each class spread evenly."""
    return with_part(df, key, target, [(i, k) for i in range(1, k)], seed, name)


# ---------------------------------------------------------------- fitted numbers


def modes(train: DataFrame, columns: Sequence[str], numeric: bool) -> DataFrame:
    """(feature, mode): most frequent value per column, ties to the smallest."""
    make = long_numeric if numeric else long_text
    counts = make(train, columns).where("value is not null").groupBy("feature", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def numeric_fills(train: DataFrame, columns: Sequence[str], strategy: str = "median") -> dict[str, float]:
    """Fill value per numeric column."""
    if strategy not in NUMERIC_FILLS:
        raise ValueError(f"numeric fill must be one of {NUMERIC_FILLS}")
    if strategy == "mean":
        row = train.agg(*[F.avg(number(F.col(c))).alias(c) for c in columns]).first()
        return row.asDict()
    if strategy == "median":
        return {c: found[0.5] for c, found in column_quantiles(train, columns, [0.5]).items()}
    return {r.feature: r["mode"] for r in modes(train, columns, numeric=True).collect()}


def categorical_fills(
    train: DataFrame, columns: Sequence[str], strategy: str = "constant", value: str = MISSING_CATEGORY
) -> dict[str, str]:
    """Fill value per categorical column."""
    if strategy not in CATEGORICAL_FILLS:
        raise ValueError(f"categorical fill must be one of {CATEGORICAL_FILLS}")
    if strategy == "constant":
        return dict.fromkeys(columns, value)
    return {r.feature: r["mode"] for r in modes(train, columns, numeric=False).collect()}


def filled_number(column: str, fills: dict[str, float]) -> Column:
    return F.coalesce(number(F.col(column)), F.lit(fills.get(column)).cast("double"))


def filled_text(column: str, fills: dict[str, str]) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(fills.get(column)))


@dataclass(frozen=True)
class Scale:
    """x becomes (x - centre) / spread."""

    centre: float
    spread: float

    def apply(self, x: Column) -> Column:
        return (x - F.lit(self.centre)) / F.lit(self.spread)


def scales(train: DataFrame, columns: Sequence[str], kind: str | None, fills: dict[str, float]) -> dict[str, Scale]:
    """Centre and spread per column: mean and population deviation, minimum and
    range, or median and quartile distance; a spread of 0 is read as 1."""
    if kind not in SCALERS:
        raise ValueError(f"scaler must be one of {SCALERS}")
    if kind is None:
        return {}
    filled = train.select(*[filled_number(c, fills).alias(c) for c in columns])
    if kind == "robust":
        found = {c: (q[0.5], q[0.75] - q[0.25]) for c, q in column_quantiles(filled, columns, [0.25, 0.5, 0.75]).items()}
    else:
        pairs = {
            "standard": lambda c: (F.avg(c), F.stddev_pop(c)),
            "minmax": lambda c: (F.min(c), F.max(c) - F.min(c)),
        }[kind]
        row = filled.agg(*[F.array(*pairs(c)).alias(c) for c in columns]).first()
        found = {c: tuple(row[c]) for c in columns}
    return {c: Scale(centre, spread or 1.0) for c, (centre, spread) in found.items()}


def impute_numeric(df: DataFrame, columns: Sequence[str], fills: dict[str, float]) -> DataFrame:
    return df.withColumns({c: filled_number(c, fills) for c in columns})


def impute_categorical(df: DataFrame, columns: Sequence[str], fills: dict[str, str]) -> DataFrame:
    return df.withColumns({c: filled_text(c, fills) for c in columns})


def scale(df: DataFrame, fitted: dict[str, Scale]) -> DataFrame:
    return df.withColumns({c: s.apply(number(F.col(c))) for c, s in fitted.items()})


# ---------------------------------------------------------------- categories


def category_codes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, code): codes 0.. in sorted order per column."""
    seen = long_text(train, columns).where("value is not null").distinct().withColumnRenamed("value", "category")
    return ranked(seen, ["category"], "code", ["feature"]).withColumn("code", F.col("code") - 1)


def with_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by its code; unseen and null become -1."""
    codes = staged(codes, "codes")
    for c in columns:
        side = codes.where(F.col("feature") == c).select(F.col("category").alias("_cat"), F.col("code").alias("_code"))
        df = df.join(side, F.col(c).cast("string") == F.col("_cat"), "left").select(
            *[
                F.coalesce("_code", F.lit(-1).cast("long")).alias(c) if name == c else F.col(name)
                for name in df.columns
            ]
        )
    return df


def one_hot(
    df: DataFrame, columns: Sequence[str], categories: dict[str, Sequence[str]], drop_first: bool = False, unknown: str = "ignore"
) -> DataFrame:
    """0/1 columns ``<column>_<category>`` in sorted order.

    Unknown values give all zeros, or raise when the rows are read if
    ``unknown='error'``. For columns with very many categories use
    ``one_hot_sparse`` or ``one_hot_long``, whose width does not grow.
    """
    out = {}
    for c in columns:
        known = sorted(categories[c])
        text = F.col(c).cast("string")
        if unknown == "error":
            text = F.when(text.isin(*known), text).otherwise(
                F.raise_error(F.concat(F.lit(f"unknown value in {c}: "), F.coalesce(text, F.lit("null")))).cast("string")
            )
        for v in known[1:] if drop_first else known:
            out[f"{c}_{v}"] = F.coalesce((text == F.lit(v)).cast("int"), F.lit(0))
    return df.select(*[n for n in df.columns if n not in set(columns)], *[e.alias(n) for n, e in out.items()])


def one_hot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, feature, category): the ones of the encoding as rows."""
    return long_text(df, columns, [key]).where("value is not null").withColumnRenamed("value", "category")


def code_table(train: DataFrame, columns: Sequence[str], drop_first: bool = False) -> DataFrame:
    """(feature, category, slot, width): a slot of one wide vector for each category, columns in the order given.

    Categories of a column are numbered in sorted order by ranges of them, so a column may have any number; only the
    sizes of the columns are added up in one place. ``width`` is the number of slots.
    """
    seen = staged(long_text(train, columns).where("value IS NOT NULL").distinct(), "categories")
    placed = ranked(seen, ["value"], "place", ["feature"]).where("place > 1" if drop_first else "true")
    first = 2 if drop_first else 1
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    sizes = placed.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).withColumn("at", place)
    before = F.coalesce(F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("feature", before.alias("start"), F.sum("n").over(Window.partitionBy()).alias("width"))  # one row per column
    slot = (F.col("start") + F.col("place") - first).cast("int")
    return placed.join(F.broadcast(starts), "feature").select("feature", F.col("value").alias("category"), slot.alias("slot"), F.col("width").cast("int").alias("width"))


def one_hot_sparse(df: DataFrame, columns: Sequence[str], codes: DataFrame, unknown: str = "ignore", name: str = "encoded") -> DataFrame:
    """``df`` with a struct (size, indices, values) in place of the columns: a 1 at the slot of each category.

    ``codes`` is a code table, better a written one: Catalyst broadcasts it when it is small and shuffles it when not, and
    neither the plan nor the driver grows with the number of categories. Null has no slot; an unknown category has none
    either, or raises when the rows are read if ``unknown='error'``.
    """
    out, slots = df, []
    for i, c in enumerate(columns):
        own = codes.where(F.col("feature") == c).select(F.col("category").alias(f"_category{i}"), F.col("slot").alias(f"_slot{i}"))
        out = out.join(own, F.col(f"`{c}`").cast("string") == F.col(f"_category{i}"), "left")
        slot = F.col(f"_slot{i}")
        if unknown == "error":
            lost = slot.isNull() & F.col(f"`{c}`").isNotNull()
            slot = F.when(lost, F.raise_error(F.concat(F.lit(f"unknown value in {c}: "), F.col(f"`{c}`").cast("string"))).cast("int")).otherwise(slot)
        slots.append(slot)
    width = codes.agg(F.coalesce(F.max("width"), F.lit(0))).scalar()
    indices = F.array_sort(F.array_compact(F.array(*slots)))
    ones = F.transform(indices, lambda _: F.lit(1.0))
    encoded = F.struct(width.alias("size"), indices.alias("indices"), ones.alias("values"))
    return out.select(*[F.col(f"`{n}`") for n in df.columns if n not in set(columns)], encoded.alias(name))


def known_categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories per column, for encodings that make a column of each.

    The caller asks for a table that wide, so the names come to the driver as
    its schema does; ``one_hot_long`` and the vector encoding need no names.
    """
    seen = long_text(train, columns).where("value is not null").distinct().collect()
    out = {c: [] for c in columns}
    for r in seen:
        out[r.feature].append(r.value)
    return {c: sorted(v) for c, v in out.items()}
