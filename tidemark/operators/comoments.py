"""Correlations of many columns from blocked co-moment matrices.

A plan with one expression per pair of columns grows with the square of their number. Here a task turns its rows into
matrices and adds up, for every pair of columns, the rows that hold both, their sums, squares and products: matrix products
of the values and of the masks that say where a value is. Matrices are kept, shuffled and finished in blocks of columns, and
merge by addition, as all tasks measure from the same point. The plan has one row of expressions per column, not per pair.
"""

from __future__ import annotations

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

#: Columns of a block, and rows multiplied at a time.
BLOCK, SLICE = 256, 2048
_SCHEMA = "first int, second int, sums binary"


def block_sums(x: np.ndarray, held: np.ndarray, i: int, j: int, block: int) -> np.ndarray:
    """(n, sum of first, sum of second, squares of both, products) over rows that hold both, per pair of columns."""
    a, b = slice(i * block, (i + 1) * block), slice(j * block, (j + 1) * block)
    xa, xb, ma, mb = x[:, a], x[:, b], held[:, a], held[:, b]
    return np.stack([ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb])


def correlations(sums: np.ndarray) -> np.ndarray:
    """Pearson correlations; NaN where a side does not vary over the rows that hold both."""
    n, sa, sb, qa, qb, p = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        va, vb, c = qa - sa * sa / n, qb - sb * sb / n, p - sa * sb / n
        va = np.where(va <= 1e-13 * qa, 0.0, va)
        vb = np.where(vb <= 1e-13 * qb, 0.0, vb)
        r = c / np.sqrt(va * vb)
    return np.where((n > 1) & (va > 0) & (vb > 0), np.clip(r, -1.0, 1.0), np.nan)


def correlation_pairs(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(feature_a, feature_b, corr) of every ordered pair of columns, over the rows that hold both.

    Null where fewer than two rows hold both, or a column does not vary there. Unreadable text and NaN are missing.
    """
    names = list(columns)
    numbers = staged(df.select(*[number(F.col(c)).alias(f"c{i}") for i, c in enumerate(names)]), "numbers")
    row = numbers.agg(*[F.array(F.avg(f"c{i}"), F.min(f"c{i}"), F.max(f"c{i}")).alias(f"c{i}") for i in range(len(names))]).first()
    # a column that never varies is measured from its value, so that its deviations are exactly nothing
    centre = np.array([0.0 if r[0] is None else r[1] if r[1] == r[2] or not np.isfinite(r[0]) else r[0] for r in row])
    blocks = -(-len(names) // block)
    pairs = [(i, j) for i in range(blocks) for j in range(i, blocks)]
    cells = numbers.select(F.array(*[f"c{i}" for i in range(len(names))]).alias("x"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.column("x").slice(at, SLICE)
                values = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1) - centre
                held = np.isfinite(values)
                values, held = np.where(held, values, 0.0), held.astype(float)
                for pair in pairs:
                    found[pair] = found.get(pair, 0.0) + block_sums(values, held, *pair, block)
        for (i, j), sums in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["first", "second", "sums"])

    def finish(table: pa.Table) -> pa.Table:
        i, j = table.column("first")[0].as_py(), table.column("second")[0].as_py()
        a, b = names[i * block : (i + 1) * block], names[j * block : (j + 1) * block]
        sums = sum(np.frombuffer(s) for s in table.column("sums").to_pylist()).reshape(6, len(a), len(b))
        r = correlations(sums)
        rows = [np.repeat(a, len(b)), np.tile(b, len(a)), r.ravel()]
        if i != j:
            rows = [np.concatenate(pair) for pair in zip(rows, [rows[1], rows[0], rows[2]])]
        corr = pa.array(rows[2], pa.float64(), from_pandas=True)  # NaN is null
        return pa.table({"feature_a": pa.array(rows[0].tolist(), pa.string()), "feature_b": pa.array(rows[1].tolist(), pa.string()), "corr": corr})

    sums = cells.mapInArrow(partial, _SCHEMA)
    return sums.groupBy("first", "second").applyInArrow(finish, "feature_a string, feature_b string, corr double")
