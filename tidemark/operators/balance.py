"""Class weights, synthetic minority rows, and removal of Tomek links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.draw import class_cuts, draw_order
from tidemark.functions.stage import staged
from tidemark.operators.buckets import bucketed_neighbours
from tidemark.operators.neighbours import nearest_neighbours

#: Neighbour searches by name: all true neighbours, or those that hash tables find in work that grows with the rows.
SEARCHES = {"exact": nearest_neighbours, "bucketed": bucketed_neighbours}


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """(target, n, weight): balanced weight n / (classes * n_class), and (1-p)/p for class 1."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))
    sums = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.select(
        target,
        "n",
        (sums["n"] / (sums["k"] * F.col("n"))).alias("balanced"),
        F.when(F.col(target) == 1, (sums["n"] - F.col("n")) / F.col("n")).otherwise(1.0).alias("pos_weight"),
    )


def with_weights(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """Add the balanced weight of each row's class (two numbers reach the driver)."""
    table = {r[target]: r.balanced for r in class_weights(df, target).collect()}
    return df.withColumn(name, F.when(F.col(target) == 1, table.get(1, 1.0)).otherwise(table.get(0, 1.0)))


def minority(df: DataFrame, target: str) -> tuple[int, int]:
    """(label of the smaller class, rows it lacks); ties pick label 1."""
    counts = {0: 0, 1: 0}
    counts.update({r[target]: r.n for r in df.groupBy(target).agg(F.count("*").alias("n")).collect()})
    small = 1 if counts[1] <= counts[0] else 0
    return small, counts[1 - small] - counts[small]


def smote(
    df: DataFrame, key: str, vec: str, target: str, k: int = 5, seed: int = 42, block: int = 2000, search: str = "exact"
) -> DataFrame:
    """(parent, neighbour, gap, copy, vec, target): synthetic rows that balance the classes.

    The missing rows are spread evenly over the minority rows, the remainder to
    the first in seeded order. Each lies between its parent and one of the
    parent's k nearest minority rows, chosen by hash; with the 'bucketed' search,
    of those found in hash tables. A row without any neighbour found has no copies.
    """
    label, missing = minority(df, target)
    small = staged(
        df.where(F.col(target) == label).select(key, F.col(vec).cast("array<double>").alias("vec")), "minority"
    )
    size = small.count()
    if size < 2 or missing <= 0:
        return small.limit(0).select(
            F.col(key).alias("parent"),
            F.col(key).alias("neighbour"),
            F.lit(0.0).alias("gap"),
            F.lit(0).alias("copy"),
            "vec",
            F.lit(label).alias(target),
        )
    each, left = divmod(missing, size)
    near = SEARCHES[search](small, key, "vec", k, block)
    listed = near.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "neighbour"))), lambda x: x["neighbour"]).alias("near")
    )
    # hash of the last row that gets one more: an exact count without a sort
    last = class_cuts(small, key, None, [(left, size)], seed).select("_cut0").scalar()
    extra = F.when(draw_order(key, seed) <= last, 1).otherwise(0) if left else F.lit(0)
    copies = (
        small.join(listed, key)
        .withColumn("_m", extra + F.lit(each))
        .where("_m > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    )
    # digits of an md5, so that any engine draws the same neighbour and gap
    drawn_hash = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.col("copy").cast("string"), F.lit(str(seed))))
    digits = lambda start, n: F.conv(F.substring(drawn_hash, start, n), 16, 10).cast("long")
    pick = F.pmod(digits(1, 8), F.size("near")).cast("int")
    gap = digits(9, 12) / F.lit(float(1 << 48))
    drawn = copies.select(
        F.col(key).alias("parent"), F.element_at("near", pick + 1).alias("neighbour"), gap.alias("gap"), "copy", "vec"
    )
    other = small.select(F.col(key).alias("neighbour"), F.col("vec").alias("_to"))
    return drawn.join(other, "neighbour").select(
        "parent",
        "neighbour",
        "gap",
        "copy",
        F.zip_with("vec", "_to", lambda a, b: a + (b - a) * F.col("gap")).alias("vec"),
        F.lit(label).alias(target),
    )


def tomek_links(df: DataFrame, key: str, vec: str, target: str, block: int = 2000, search: str = "exact") -> DataFrame:
    """(low_key, high_key): pairs of opposite class that are each other's nearest row.

    Each row names its pair; a pair named twice is mutual, so no self-join is needed.
    """
    near = SEARCHES[search](df, key, vec, 1, block).join(df.select(key, target), key)
    named = near.select(
        F.least(key, "neighbour").alias("low_key"), F.greatest(key, "neighbour").alias("high_key"), target
    )
    pairs = named.groupBy("low_key", "high_key").agg(
        F.count("*").alias("_n"), F.min(target).alias("_a"), F.max(target).alias("_b")
    )
    return pairs.where("_n = 2 and _a <> _b").select("low_key", "high_key")


def drop_tomek(df: DataFrame, key: str, vec: str, target: str, block: int = 2000, search: str = "exact") -> DataFrame:
    """The table without both members of every Tomek link."""
    links = tomek_links(df, key, vec, target, block, search)
    members = links.select(F.explode(F.array("low_key", "high_key")).alias(key))
    return df.join(members, key, "left_anti")


def smote_tomek(
    df: DataFrame, key: str, vec: str, target: str, k: int = 5, seed: int = 42, block: int = 2000, search: str = "exact"
) -> DataFrame:
    """(key text, vec, target): real and synthetic rows, cleaned of Tomek links."""
    real = df.select(F.col(key).cast("string").alias(key), F.col(vec).cast("array<double>").alias("vec"), target)
    made = smote(df, key, vec, target, k, seed, block, search).select(
        F.concat_ws("~", F.col("parent").cast("string"), F.col("copy").cast("string")).alias(key), "vec", target
    )
    both = staged(real.unionByName(made), "resampled")
    return drop_tomek(both, key, "vec", target, block, search)
