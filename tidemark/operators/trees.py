"""Additive attributions of tree models, row by row.

A leaf's output is shared among the columns on its path by Shapley values, with the training cover of a branch as its share
when the column is unknown. With shares r and passes z (0 or 1) of the path's columns, column i gets

    value * (z_i - r_i) * integral over t in [0, 1] of prod_{j != i} (r_j (1 - t) + z_j t)

as the weights of subsets are the moments of t. The integrand is a polynomial of one degree less than the path is long, so a
few Gauss points give the integral exactly; at each point the product over the whole path is taken once, and one factor is
divided out per column (no factor is zero inside the interval). A leaf gives the same to all rows that pass the same of its
steps: where a path is short, that is worked out once for every pattern and looked up by row. Paths are built in tasks, one tree each; like the model itself, which MLlib holds and ships whole, they must fit in memory.
"""

from __future__ import annotations

import io
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.stage import shared_folder
from tidemark.operators.boost import BoostedTrees
from tidemark.operators.train import ChurnModel, feature_names

# tasks get these functions by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells (rows x leaves x path) worked on at a time, longest path whose patterns are listed, and rows looked up at a time.
CELLS, LISTED, ROWS = 1_000_000, 8, 16_384


def _inside(v: np.ndarray, low: np.ndarray, high: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether values lie in (low, high], or have their bit set in the codes."""
    coded = codes >= 0
    inside = (v > low) & (v <= high)
    if not coded.any():
        return inside
    bit = np.clip(np.where(coded, v, 0), 0, 62).astype(np.int64)
    return np.where(coded, np.where(coded, codes, 0) >> bit & 1 == 1, inside)


@dataclass(frozen=True)
class Paths:
    """The leaves of one tree. A column on a path is passed by numbers in (low, high], or by codes whose bit is set.

    Paths are filled up with steps that every row passes and that have the whole cover.
    """

    value: np.ndarray  # (leaf)
    slot: np.ndarray  # (leaf, step)
    share: np.ndarray
    low: np.ndarray
    high: np.ndarray
    codes: np.ndarray  # bits of the codes that pass; -1 for numbers

    def passes(self, x: np.ndarray) -> np.ndarray:
        """(row, leaf, step): whether the row passes the step."""
        return _inside(x[:, self.slot], self.low, self.high, self.codes)

    @property
    def base(self) -> float:
        """The expected output: every leaf by its cover."""
        return float((self.value * self.share.prod(axis=1)).sum())

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f.name: getattr(self, f.name) for f in fields(self)})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Paths:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**{f.name: arrays[f.name] for f in fields(cls)})


_ALL = (1.0, -np.inf, np.inf, -1)  # share, low, high, codes of a step that all pass


def _padded(found: list[tuple[float, dict[int, tuple]]]) -> Paths:
    """Paths from (value, slot -> (share, low, high, codes)) of every leaf."""
    width = max((len(path) for _, path in found), default=0) or 1
    slot = np.zeros((len(found), width), np.int64)
    rest = np.empty((4, len(found), width))
    rest[:] = np.array(_ALL)[:, None, None]
    codes = np.full((len(found), width), -1, np.int64)
    for i, (_, path) in enumerate(found):
        for k, (s, (share, low, high, code)) in enumerate(path.items()):
            slot[i, k], rest[0, i, k], rest[1, i, k], rest[2, i, k], codes[i, k] = s, share, low, high, code
    return Paths(np.array([v for v, _ in found]), slot, rest[0], rest[1], rest[2], codes)


def _tree_paths(table: pa.Table, boosted: bool) -> Paths:
    """The paths of one tree of MLlib from its node rows."""
    nodes = {n["id"]: n for n in table.to_pylist()}
    found: list[tuple[float, dict[int, tuple]]] = []
    todo: list[tuple[dict, dict[int, tuple]]] = [(nodes[0], {})]
    while todo:
        node, path = todo.pop()
        if node["leftChild"] < 0:
            stats = node["impurityStats"]
            found.append((node["prediction"] if boosted else stats[1] / sum(stats), path))
            continue
        rule = node["split"]
        slot, arity, values = rule["featureIndex"], rule["numCategories"], rule["leftCategoriesOrThreshold"]
        for child, left in ((nodes[node["leftChild"]], True), (nodes[node["rightChild"]], False)):
            share, low, high, codes = path.get(slot, _ALL)
            if arity >= 0:
                bits = sum(1 << int(v) for v in values)
                every = (1 << arity) - 1
                codes = (every if codes < 0 else int(codes)) & (bits if left else every & ~bits)
            elif left:
                high = min(high, values[0])
            else:
                low = max(low, values[0])
            todo.append((child, {**path, slot: (share * child["rawCount"] / node["rawCount"], low, high, codes)}))
    return _padded(found)


def _boosted_paths(tree: dict) -> Paths:
    """The cells of a tree of own boosting; a cell's cover is smoothed by half a row, so that none is nothing."""
    columns, cuts, cover = tree["columns"], tree["cuts"], np.array(tree["cover"], float)
    found = []
    for cell, value in enumerate(tree["leaves"]):
        path: dict[int, tuple] = {}
        for i, (slot, cut) in enumerate(zip(columns, cuts)):
            above = bool(cell >> i & 1)
            same = (np.arange(len(cover)) & (1 << i) - 1) == (cell & (1 << i) - 1)
            side = same & ((np.arange(len(cover)) >> i & 1) == above)
            share = (cover[side].sum() + 0.5) / (cover[same].sum() + 1)
            path[slot] = (share, cut, np.inf, -1) if above else (share, -np.inf, cut, -1)
        found.append((value, path))
    return _padded(found)


def paths(spark: SparkSession, fitted) -> list[Paths]:
    """The paths of every tree, outputs weighted: boosted trees explain the margin, forests the mean probability of class 1."""
    if isinstance(fitted, BoostedTrees):
        return [_boosted_paths(t) for t in fitted.parts()["trees"]]
    boosted = isinstance(fitted, GBTClassificationModel)
    path = f"{shared_folder(spark)}/tidemark-{spark.sparkContext.applicationId}/trees-{uuid.uuid4().hex}"
    fitted.write().save(path)
    saved = spark.read.parquet(f"{path}/data").toDF("tree", "node").select("tree", "node.*")

    def one(table: pa.Table) -> pa.Table:
        return pa.table({"tree": table.column("tree").slice(0, 1), "paths": pa.array([_tree_paths(table, boosted).pack()], pa.binary())})

    weights = fitted.treeWeights
    found = []
    for r in saved.groupBy("tree").applyInArrow(one, "tree int, paths binary").sort("tree").collect():  # one row per tree
        p = Paths.unpack(r.paths)
        found.append(Paths(p.value * (weights[r.tree] if boosted else 1.0 / len(weights)), p.slot, p.share, p.low, p.high, p.codes))
    return found


def base_value(fitted, trees: list[Paths]) -> float:
    start = fitted.parts()["base"] if isinstance(fitted, BoostedTrees) else 0.0
    return start + sum(p.base for p in trees)


def _given(p: Paths, z: np.ndarray) -> np.ndarray:
    """(row, leaf, step): what each step gets where z (0 or 1) says whether the row passes it."""
    at, weight = np.polynomial.legendre.leggauss((p.share.shape[1] + 1) // 2)
    at, weight = (at + 1) / 2, weight / 2
    total = np.zeros(z.shape)
    for t, w in zip(at, weight):
        factor = p.share * (1 - t) + z * t
        total += (w * factor.prod(axis=2))[:, :, None] / factor
    return total * (z - p.share) * p.value[None, :, None]


def _looked_up(out: np.ndarray, x: np.ndarray, p: Paths) -> None:
    """Add one tree's attributions to ``out`` (slot, row), from those of every pattern of passed steps. ``x`` is (slot, row)."""
    n, width = p.share.shape
    # each different step is tried once, whatever number of leaves it leads to
    steps, which = np.unique(np.stack([p.slot, p.low, p.high, p.codes]).reshape(4, -1), axis=1, return_inverse=True)
    which = which.reshape(n, width)
    slot, low, high, codes = steps[:, :, None]
    z = _inside(x[slot[:, 0].astype(np.int64)], low, high, codes.astype(np.int64)).astype(np.uint8)
    patterns = (np.arange(1 << width)[:, None] >> np.arange(width) & 1).astype(float)
    table = np.ascontiguousarray(_given(p, np.broadcast_to(patterns[:, None], (1 << width, n, width))).transpose(1, 2, 0))
    for leaf in range(n):
        code = np.zeros(x.shape[1], np.uint8)
        for k in range(width):
            code |= z[which[leaf, k]] << np.uint8(k)
        code = code.astype(np.intp)
        for k in np.flatnonzero(table[leaf].any(axis=1)):
            out[p.slot[leaf, k]] += table[leaf, k].take(code)


def attribute(x: np.ndarray, trees: list[Paths]) -> np.ndarray:
    """Shapley values of every row and slot."""
    out, by_slot = np.zeros((x.shape[1], len(x))), np.ascontiguousarray(x.T)
    for p in trees:
        n, width = p.share.shape
        listed = width <= LISTED and 1 << width < len(x)
        step = ROWS if listed else max(1, CELLS // (n * width))
        for i in range(0, len(x), step):
            rows = slice(i, i + step)
            if listed:
                _looked_up(out[:, rows], by_slot[:, rows], p)
                continue
            flat, part = p.slot.ravel(), _given(p, p.passes(x[rows]).astype(float)).reshape(len(x[rows]), -1)
            order = np.argsort(flat, kind="stable")
            heads = np.flatnonzero(np.diff(flat[order], prepend=-1))
            out[flat[order][heads], rows] += np.add.reduceat(part[:, order], heads, axis=1).T
    return np.ascontiguousarray(out.T)


def tree_parts(model: ChurnModel, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, keep, base_value, parts): attributions of the trained tree model.

    base_value plus the parts of a row is its margin (boosted trees) or its
    probability (forest).
    """
    spark = df.sparkSession
    prepared = model.prepared(df)
    names = feature_names(prepared)
    fitted = model.pipeline.stages[-1]
    trees = paths(spark, fitted)
    shared = spark.sparkContext.broadcast(trees)
    ids = [model.roles.key, *keep]
    # a written table has as many parts as its writer had, which may be fewer than there are cores
    rows = prepared.select(*ids, vector_to_array("features").alias("_x")).repartition(3 * spark.sparkContext.defaultParallelism)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                phi = attribute(x, shared.value)
                offsets = pa.array(np.arange(0, phi.size + 1, phi.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(phi.ravel()))], names=[*batch.schema.names, "_phi"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    done = rows.mapInArrow(explain, f"{schema}, `_phi` array<double>")
    label = F.array(*[F.lit(n) for n in names])
    parts = F.transform(
        F.arrays_zip(label.alias("feature"), F.col("_x").alias("value"), F.col("_phi").alias("attribution")),
        lambda p: F.struct(p["feature"].alias("feature"), p["value"].alias("value"), p["attribution"].alias("attribution")),
    )
    return done.select(*ids, F.lit(base_value(fitted, trees)).alias("base_value"), parts.alias("parts"))
