"""Gapless numbers inside groups of any size, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ledger import running_sums
from tidemark.functions.stage import staged

#: Equal rows that are written out from one row of the job.
TOGETHER = 100_000


def numbered(counted: DataFrame, groups: Sequence[str], order: Sequence[str], n: str, number: str, together: int = TOGETHER) -> DataFrame:
    """Each row of ``counted`` as often as its count ``n`` says, with ``number`` from 0 in its group by ``order``.

    ``counted`` holds one row per (groups, order), and groups are not null; equal rows, pre-aggregated to a count, take
    neighbouring numbers. Rows are dealt out by ranges of (groups, order) and numbers shifted by the totals of earlier
    ranges, so a hot group is spread over tasks; a row that stands for many is cut into stretches before it is repeated.
    """
    once = staged(counted.select(*groups, *order, n), "counted")  # range bounds are drawn from a table that stays
    ends = running_sums(once, list(order), [n], list(groups))
    last = F.col(f"cum_{n}") - 1
    stretches = ends.select(*groups, *order, last.alias("_last"), F.explode(F.sequence(F.col(f"cum_{n}") - F.col(n), last, F.lit(together).cast("long"))).alias("_from"))
    spread = stretches.repartition(*groups, *order, "_from")
    each = F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + (together - 1), F.col("_last"))))
    return spread.select(*groups, *order, each.alias(number))
