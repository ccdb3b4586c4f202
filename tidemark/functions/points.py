"""Exact quantiles of many columns at once, from sorted batches.

A task sorts some rows of every column at a time and keeps values at even ranks, with the rows each stands for. Of all
these points together it is known how many rows lie below at least and at most, so each wanted rank lies between two of
them. A second pass counts the rows below and lists the values between, which are few. No cell becomes a row of its own.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shape import number
from tidemark.functions.stage import staged

# tasks get these functions by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Values that stand for a column of the rows sorted at a time, and bytes of these rows.
POINTS, SORTED = 10_000, 32 << 20


def points(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Values with the rows each stands for, NaN left out: all there are, or ``most`` at even ranks and so the largest."""
    v = np.sort(v[~np.isnan(v)])
    ends = np.flatnonzero(np.append(v[1:] != v[:-1], True)) + 1 if len(v) else np.empty(0, np.int64)
    if len(ends) > most:
        ends = np.unique(-(-np.arange(1, most + 1) * len(v) // most))
    return v[ends - 1], np.diff(ends, prepend=0)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """(column, row) of some rows at a time; null is NaN."""
    kept: list[np.ndarray] = []
    for batch in batches:
        kept.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) + 0.0)  # -0.0 is 0.0
        if sum(x.nbytes for x in kept) >= SORTED:
            yield np.concatenate(kept, axis=1)
            kept = []
    if kept:
        yield np.concatenate(kept, axis=1)


def _batch(*columns: Sequence, types: Sequence[pa.DataType], names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


def _plain(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()])


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float]]:
    """Linear-interpolated quantiles of each column that holds a number; as many numbers reach the driver."""
    probs, most = [float(q) for q in probs], POINTS
    wide = staged(df.select(*[number(F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)]), "numbers")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _matrices(batches):
            found = [points(v, most) for v in x]
            # of a stretch between two points only the rows in it are known, less the point itself
            unsure = [0 if len(v) < most else int(n.max()) - 1 for v, n in found]
            yield _batch(range(len(x)), [v.tobytes() for v, _ in found], [n.astype(np.int64).tobytes() for _, n in found], unsure, types=[pa.int32(), pa.binary(), pa.binary(), pa.int64()], names=["column", "v", "n", "unsure"])

    def brackets(table: pa.Table) -> pa.Table:
        v, n = _plain(table, "v", np.float64), _plain(table, "n", np.int64)
        unsure = sum(table.column("unsure").to_pylist())
        v, place = np.unique(v, return_inverse=True)
        upto = np.cumsum(np.bincount(place, n, len(v)).astype(np.int64)) if len(v) else n
        low, high = [], []
        for q in probs if len(v) else ():
            h = (int(upto[-1]) - 1) * q
            # surely no more rows lie below the lower end than the rank, and as many lie up to the upper end
            sure = np.flatnonzero(upto[:-1] + unsure <= math.floor(h))
            low.append(float(v[sure[-1] + 1]) if len(sure) else -math.inf)
            high.append(float(v[np.searchsorted(upto, math.ceil(h) + 1)]))
        rows = int(upto[-1]) if len(v) else 0
        return pa.table({"column": table.column("column")[:1], "rows": pa.array([rows], pa.int64()), "low": pa.array([low], pa.list_(pa.float64())), "high": pa.array([high], pa.list_(pa.float64()))})

    found = wide.mapInArrow(sketch, "column int, v binary, n binary, unsure long")
    ends = {r.column: r for r in found.groupBy("column").applyInArrow(brackets, "column int, rows long, low array<double>, high array<double>").collect() if r.rows}
    near = {c: list(zip(r.low, r.high)) for c, r in ends.items()}
    rows = {c: r.rows for c, r in ends.items()}

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _matrices(batches):
            out: list[tuple] = []
            for c, pairs in near.items():
                v = np.sort(x[c][~np.isnan(x[c])])
                for i, (low, high) in enumerate(pairs):
                    first, last = np.searchsorted(v, low), np.searchsorted(v, high, side="right")
                    each, n = np.unique(v[first:last], return_counts=True)
                    out.append((c, i, int(first), each.tobytes(), n.astype(np.int64).tobytes()))
            if out:
                yield _batch(*zip(*out), types=[pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()], names=["column", "prob", "below", "v", "n"])

    def read(table: pa.Table) -> pa.Table:
        c, i = table.column("column")[0].as_py(), table.column("prob")[0].as_py()
        v, place = np.unique(_plain(table, "v", np.float64), return_inverse=True)
        upto = sum(table.column("below").to_pylist()) + np.cumsum(np.bincount(place, _plain(table, "n", np.int64), len(v)).astype(np.int64))
        h = (rows[c] - 1) * probs[i]
        a, b = (float(v[np.searchsorted(upto, rank, side="right")]) for rank in (math.floor(h), math.ceil(h)))
        return pa.table({"column": table.column("column")[:1], "prob": table.column("prob")[:1], "quantile": pa.array([a + (b - a) * (h - math.floor(h))])})

    out: dict[str, dict[float, float]] = {}
    exact = wide.mapInArrow(inside, "column int, prob int, below long, v binary, n binary").groupBy("column", "prob").applyInArrow(read, "column int, prob int, quantile double")
    for r in sorted(exact.collect()) if near else ():
        out.setdefault(columns[r.column], {})[probs[r.prob]] = r.quantile
    return out
