"""Seeded draws that give the same rows on any cluster.

Rows are ordered by ``md5(key-seed)``. A share of each class is cut off at an
exact count without sorting the class: hashes are counted by their first four
hex digits (at most 65,536 counts per class), the digit group that holds the
cut is found from running counts, and only that group is ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.stage import staged


def draw_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def class_cuts(df: DataFrame, key: str, label: str | None, parts: Sequence[tuple[int, int]], seed: int) -> DataFrame:
    """Hash of the last row of each leading part of each class.

    ``parts`` holds fractions (a, b): part p ends after floor(rows * a / b).
    Returns one row per class with a hash ``_cut<i>`` per part, '' for an empty
    one; rows without a label are a class of their own. Keys must be unique, and
    the label a class label (few values): the cut points, classes x parts rows,
    are broadcast.
    """
    cls = F.col(label) if label else F.lit(0)
    drawn = df.select(cls.alias("_c"), draw_order(key, seed).alias("_h"))
    counts = drawn.groupBy("_c", F.substring("_h", 1, 4).alias("_g")).agg(F.count("*").alias("_n"))
    by_group = Window.partitionBy("_c").orderBy("_g")
    upto = F.sum("_n").over(by_group.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    size = F.sum("_n").over(Window.partitionBy("_c"))
    wanted = F.array(
        *[F.struct(F.lit(i).alias("part"), ((size * a - size * a % b) / b).cast("long").alias("rank")) for i, (a, b) in enumerate(parts)]
    )
    located = (
        counts.select("_c", "_g", (upto - F.col("_n")).alias("_before"), upto.alias("_upto"), wanted.alias("_w"))
        .select(
            "_c",
            "_g",
            "_before",
            F.explode(
                F.filter("_w", lambda w: (w["rank"] > F.col("_before")) & (w["rank"] <= F.col("_upto")))
            ).alias("_w"),
        )
        .select("_c", "_g", (F.col("_w.rank") - F.col("_before")).alias("_k"), F.col("_w.part").alias("part"))
    )
    # one digit group per class and part; all other rows are dropped before any shuffle
    located = located.withColumnsRenamed({"_c": "_lc", "_g": "_lg"})
    same = F.col("_c").eqNullSafe(F.col("_lc")) & (F.col("_g") == F.col("_lg"))
    near = drawn.withColumn("_g", F.substring("_h", 1, 4)).join(F.broadcast(located), same)
    place = F.row_number().over(Window.partitionBy("_c", "_g", "part").orderBy("_h"))
    found = near.withColumn("_r", place).where("_r = _k").select("_c", "part", F.col("_h").alias("cut"))
    return found.groupBy("_c").agg(
        *[F.coalesce(F.max(F.when(F.col("part") == i, F.col("cut"))), F.lit("")).alias(f"_cut{i}") for i in range(len(parts))]
    )


def with_part(df: DataFrame, key: str, label: str | None, parts: Sequence[tuple[int, int]], seed: int, name: str) -> DataFrame:
    """Add the number of leading parts each row lies behind (0 = in the first)."""
    cuts = staged(class_cuts(df, key, label, parts, seed).withColumnRenamed("_c", "_class"), "cuts")
    behind = sum(
        (F.coalesce(F.col("_h") > F.col(f"_cut{i}"), F.lit(True))).cast("int") for i in range(len(parts))
    )
    cls = F.col(label) if label else F.lit(0)
    return (
        df.withColumn("_h", draw_order(key, seed))
        .withColumn("_c", cls)
        .join(cuts, F.col("_c").eqNullSafe(F.col("_class")), "left")
        .select(*df.columns, behind.alias(name))
    )
