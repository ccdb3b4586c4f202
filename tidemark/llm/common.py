"""Helpers that several operators of this package share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once_per_worker(key: str, build: Callable[[], Any]) -> Any:
    """What ``build`` returns, made once in each Python worker and kept between tasks."""
    store = sys.modules.setdefault("tidemark_task_cache", types.ModuleType("tidemark_task_cache")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def map_rows(df: DataFrame, each: Callable[[dict[str, list]], dict[str, Any]], schema: str) -> DataFrame:
    """Run ``each`` over the columns of every Arrow batch (as lists); it returns columns of the new schema."""

    def batches(it: Iterator[pa.RecordBatch], names=tuple(c.split(" ")[0] for c in schema.split(", "))) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = each(batch.to_pydict())
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in map(out.get, names)], names=list(names))

    return df.mapInArrow(batches, schema)


def bounded_sample(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of ``columns``, so the same in every run; all, if there are no more.

    Rows equal in these columns are chosen together and taken once, so neither a repeated row nor one value that many rows
    share (with different others) makes the sample larger.
    """
    total = df.count()
    if total <= rows:
        return df
    chosen = df.where(F.pmod(F.xxhash64(*columns, F.lit("sample")), F.lit(1 << 40)) < int(rows / total * (1 << 40)))
    return chosen.dropDuplicates(list(columns))
