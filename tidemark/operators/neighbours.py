"""Exact nearest neighbours of every row; ``buckets.py`` finds most of them without comparing all pairs.

Equal vectors are collapsed first, so a vector held by a third of the rows is
searched once. The distinct vectors are put into cells around pivots, and cells
into blocks of bounded bytes, a crowded cell into several. Each vector is
searched in its own block, which bounds how far its neighbours can be; by the
triangle inequality only blocks reaching into that ball can hold closer ones,
and only such pairs of blocks meet next, each pair in one task that searches
both ways. A task holds two blocks and keeps k rows per vector.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.stage import staged

# tasks get these functions by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a block's vectors, least rows of a block, blocks aimed at while they hold fewer bytes, and distances of a tile.
_BLOCK_BYTES, _CELL, _BLOCKS, _TILE = 32 << 20, 500, 16, 1 << 21
_SLACK = 1e-9


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices, by plain differences."""
    out = np.empty((len(a), len(b)))
    for i, row in enumerate(a):
        out[i] = np.sqrt(((b - row) ** 2).sum(axis=1))
    return out


def _exact(a: np.ndarray, b: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Euclidean distances of listed pairs, by plain differences, some pairs at a time."""
    out = np.empty(len(rows))
    step = max(1, _TILE // max(1, a.shape[1]))
    for i in range(0, len(rows), step):
        out[i : i + step] = np.sqrt(((b[at[i : i + step]] - a[rows[i : i + step]]) ** 2).sum(axis=1))
    return out


def _closer(a: np.ndarray, balls: np.ndarray, names: np.ndarray, b: np.ndarray, others: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance): the best k rows of b within each row's ball, ties to the lower row; no row meets its own name.

    A matrix product finds which pairs can be meant; these are measured by differences.
    """
    centre = b.mean(axis=0)
    near_a, near_b = a - centre, b - centre
    norm_a, norm_b = (near_a**2).sum(axis=1), (near_b**2).sum(axis=1)
    plain = not (np.isfinite(norm_a).all() and np.isfinite(norm_b).all())
    unsure = 8 * (a.shape[1] + 8) * np.finfo(float).eps * (norm_a + norm_b.max())
    order = np.argsort(others, kind="stable")
    first, last = np.searchsorted(others[order], names), np.searchsorted(others[order], names, side="right")
    found = []
    step = max(1, _TILE // len(b))
    for i in range(0, len(a), step):
        part = slice(i, i + step)
        if plain:
            squares, off = _distances(a[part], b) ** 2, np.zeros(len(a[part]))
        else:
            squares, off = near_a[part] @ near_b.T, unsure[part]
            squares *= -2
            squares += norm_a[part, None]
            squares += norm_b
        for row in np.flatnonzero(last[part] > first[part]):
            squares[row, order[first[i + row] : last[i + row]]] = np.inf
        limit = (balls[part] * (1 + _SLACK)) ** 2
        open_ = np.flatnonzero(~np.isfinite(limit))
        if len(open_):
            limit[open_] = np.partition(squares[open_], min(k, len(b)) - 1, axis=1)[:, min(k, len(b)) - 1]
        rows, at = np.nonzero((squares <= (limit + 2 * off)[:, None]) & np.isfinite(squares))
        rows = rows + i
        d = _exact(a, b, rows, at)
        rank = np.lexsort((at, d, rows))
        rows, at, d = rows[rank], at[rank], d[rank]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = (place < k) & np.isfinite(d)
        found.append((rows[keep], at[keep], d[keep]))
    return tuple(np.concatenate(c) for c in zip(*found))


#: Rows of a tile of two blocks, and share of its pairs up to which single precision tells them apart well enough.
_SIDE, _FEW = 1024, 1 / 64


def _trimmed(rows: np.ndarray, at: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k closest of each row, ties to the lower place."""
    rank = np.lexsort((at, d, rows))
    rows, at, d = rows[rank], at[rank], d[rank]
    keep = (np.arange(len(rows)) - np.searchsorted(rows, rows) < k) & np.isfinite(d)
    return rows[keep], at[keep], d[keep]


def _squares(a: np.ndarray, b: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Factors whose product holds the squared distances of all pairs, how far it may be off by row of each, and its scale."""
    centre = (a.mean(axis=0) + b.mean(axis=0)) / 2
    near = [a - centre, b - centre]
    norms = [(x**2).sum(axis=1) for x in near]
    scale = max(float(n.max()) for n in norms) or 1.0
    near, norms = [x / math.sqrt(scale) for x in near], [n / scale for n in norms]
    left = np.column_stack([-2 * near[0], norms[0], np.ones(len(a))]).astype(kind)
    right = np.column_stack([near[1], np.ones(len(b)), norms[1]]).astype(kind)
    share = 4 * (a.shape[1] + 8) * np.finfo(kind).eps
    return left, right, share * (norms[0] + norms[1].max()), share * (norms[1] + norms[0].max()), scale


def _meet(a: np.ndarray, balls_a: np.ndarray, names_a: np.ndarray, b: np.ndarray, balls_b: np.ndarray, names_b: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``_closer`` of a in b and of b in a, each pair multiplied once. Single precision finds which pairs can be meant; these
    are measured by differences, as are all where balls are open or numbers too large or small."""
    singles = _squares(a, b, np.float32)
    if not (np.isfinite(balls_a).all() and np.isfinite(balls_b).all() and 1e-200 < singles[4] < float("inf")):
        return [_closer(a, balls_a, names_a, b, names_b, k), _closer(b, balls_b, names_b, a, names_a, k)]
    doubles = None

    def limits(made: tuple) -> list[np.ndarray]:
        return [((balls * (1 + _SLACK)) ** 2 / made[4] + 2 * off).astype(made[0].dtype) for balls, off in ((balls_a, made[2]), (balls_b, made[3]))]

    most, more = limits(singles), None
    found: list[list[tuple]] = [[], []]
    held = [0, 0]
    for i in range(0, len(a), _SIDE):
        for j in range(0, len(b), 2 * _SIDE):
            rows, at = slice(i, i + _SIDE), slice(j, j + 2 * _SIDE)
            squares = singles[0][rows] @ singles[1][at].T
            hits = [np.flatnonzero(squares <= most[0][rows, None]), np.flatnonzero(squares <= most[1][at])]
            if max(len(h) for h in hits) > max(_FEW * squares.size, 64):
                # rows too much alike for single precision
                if doubles is None:
                    doubles = _squares(a, b, np.float64)
                    more = limits(doubles)
                squares = doubles[0][rows] @ doubles[1][at].T
                hits = [np.flatnonzero(squares <= more[0][rows, None]), np.flatnonzero(squares <= more[1][at])]
            for side, hit in enumerate(hits):
                x, y = np.divmod(hit, squares.shape[1])
                x, y = x + i, y + j
                other = names_a[x] != names_b[y]
                x, y = x[other], y[other]
                d = _exact(a, b, x, y)
                found[side].append((x, y, d) if side == 0 else (y, x, d))
                held[side] += len(x)
                if held[side] > 4 * k * (len(b) if side else len(a)) + _TILE:
                    found[side] = [_trimmed(*[np.concatenate(c) for c in zip(*found[side])], k)]
                    held[side] = len(found[side][0][0])
    out = []
    for side in (0, 1):
        out.append(_trimmed(*[np.concatenate(c) for c in zip(*found[side])], k))
    return out


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("vec").combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _sorted(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table.column("id")))


def _listed(asking: pa.Table, points: pa.Table, rows: np.ndarray, at: np.ndarray, d: np.ndarray) -> pa.Table:
    return pa.table({"id": asking.column("id").take(pa.array(rows)), "other": points.column("id").take(pa.array(at)), "distance": pa.array(d, pa.float64())})


def _names(*tables: pa.Table) -> list[np.ndarray]:
    """Whole numbers for the ids, alike where ids are."""
    ids = pa.chunked_array([c for t in tables for c in t.column("id").chunks], tables[0].column("id").type)
    numbers = pc.fill_null(ids.combine_chunks().dictionary_encode(null_encoding="encode").indices, -1).to_numpy(zero_copy_only=False)
    return np.split(numbers, np.cumsum([t.num_rows for t in tables])[:-1])


def _own(cells: DataFrame, kind: str, k: int) -> DataFrame:
    """(id, other, distance): k best rows of each row's own block."""

    def best(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        vectors, (names,) = _matrix(table), _names(table)
        return _listed(table, table, *_closer(vectors, np.full(len(vectors), np.inf), names, vectors, names, k))

    return cells.groupBy("block").applyInArrow(best, f"id {kind}, other {kind}, distance double")


def _reach_out(cells: DataFrame, own: DataFrame, parts: list[tuple[int, int]], radii: np.ndarray, pivots, kind: str, k: int) -> DataFrame:
    """Candidates from every other block that can hold a closer point. ``parts`` are the cell of each block and its number there."""
    bound = own.groupBy("id").agg(F.count("*").alias("held"), F.max("distance").alias("ball"))
    ball = F.when(F.col("held") >= k, F.col("ball")).otherwise(float("inf")).alias("ball")
    held = staged(cells.join(bound, "id", "left").select("id", "vec", "block", ball), "held")
    spark = cells.sparkSession
    cell = np.array([c for c, _ in parts])
    far = np.zeros(len(parts))
    for r in held.groupBy("block").agg(F.max("ball").alias("far")).collect():  # one row per block
        far[r.block] = r.far
    units: list[list[tuple[int, int]]] = [[] for _ in parts]
    number = 0
    for i in range(len(parts)):
        gap = _distances(pivots.value[cell[i]][None], pivots.value[cell])[0] - radii[cell[i]] - radii[cell]
        reach = np.maximum(far[i], far) * (1 + _SLACK) + _SLACK
        for j in np.flatnonzero(~(gap > reach)).tolist():
            if j > i:
                units[i].append((number, 0))
                units[j].append((number, 1))
                number += 1
    plan = spark.createDataFrame(list(enumerate(units)), "block int, units array<struct<unit: int, side: int>>")
    met = held.join(F.broadcast(plan), "block").select("id", "vec", "block", "ball", F.inline("units"))
    shape = spark.sparkContext.broadcast((cell, radii))

    def best(table: pa.Table) -> pa.Table:
        cells_, radius = shape.value
        sides = [_sorted(table.filter(pc.equal(table.column("side"), s))) for s in (0, 1)]
        if not all(t.num_rows for t in sides):
            return _listed(sides[0], sides[1], *[np.empty(0, np.int64)] * 2, np.empty(0))
        vectors, names = [_matrix(t) for t in sides], _names(*sides)
        out, asks, balls = [], [], [t.column("ball").to_numpy() for t in sides]
        for s, o in ((0, 1), (1, 0)):
            there = cells_[sides[o].column("block")[0].as_py()]
            gap = _distances(pivots.value[there][None], vectors[s])[0] - radius[there]
            asks.append(np.flatnonzero(~(gap > balls[s] * (1 + _SLACK) + _SLACK)))
        (n, m), (p, q) = (len(x) for x in vectors), (len(x) for x in asks)
        if 2 * (p * m + q * n) > n * m:
            # one product serves both; a row that need not ask finds nothing within its ball
            met = _meet(vectors[0], balls[0], names[0], vectors[1], balls[1], names[1], k)
            for s, o in ((0, 1), (1, 0)):
                out.append(_listed(sides[s], sides[o], *met[s]))
            return pa.concat_tables(out)
        for s, o in ((0, 1), (1, 0)):
            if len(ask := asks[s]):
                rows, at, d = _closer(vectors[s][ask], balls[s][ask], names[s][ask], vectors[o], names[o], k)
                out.append(_listed(sides[s], sides[o], ask[rows], at, d))
        return pa.concat_tables(out) if out else _listed(sides[0], sides[1], *[np.empty(0, np.int64)] * 2, np.empty(0))

    return own.unionByName(met.groupBy("unit").applyInArrow(best, f"id {kind}, other {kind}, distance double"))


def _closest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy("distance", "other")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def collapsed(points: DataFrame, key: str, vec: str, k: int) -> tuple[DataFrame, int, int]:
    """(id, vec, mates) per distinct vector with its lowest k + 1 keys, the number of vectors, and their length."""
    base = points.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    # the k + 1 lowest keys of each distinct vector; the limit is applied before the shuffle
    low = Window.partitionBy("vec").orderBy("id")
    firsts = base.withColumn("_r", F.row_number().over(low)).where(F.col("_r") <= k + 1)
    distinct = staged(
        firsts.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("mates")).select(
            F.col("mates")[0].alias("id"), "vec", "mates"
        ),
        "vectors",
    )
    size, width = distinct.agg(F.count("*"), F.max(F.size("vec"))).first()
    return distinct, size, width or 0


def expanded(points: DataFrame, key: str, vec: str, k: int, distinct: DataFrame, near: DataFrame) -> DataFrame:
    """From neighbours (id, other, distance) of distinct vectors back to all rows: own mates first, then the others' mates."""
    base = points.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    mates = distinct.select(F.col("id").alias("other"), "mates")
    listed = near.join(mates, "other").groupBy("id").agg(
        F.flatten(
            F.collect_list(
                F.transform("mates", lambda m: F.struct(F.col("distance").alias("distance"), m.alias("neighbour")))
            )
        ).alias("others")
    )
    own_mates = F.transform("mates", lambda m: F.struct(F.lit(0.0).alias("distance"), m.alias("neighbour")))
    nothing = F.filter(own_mates, lambda m: F.lit(False))
    ready = distinct.join(listed, "id", "left").select(
        "vec", F.array_sort(F.concat(own_mates, F.coalesce("others", nothing))).alias("ready")
    )
    kept = F.slice(F.filter("ready", lambda m: m["neighbour"] != F.col("id")), 1, k)
    # a key named "id" must not be taken for an alias of this select
    listed_rows = base.join(ready, "vec").select(F.col("id").alias("_k"), kept.alias("_kept"))
    return listed_rows.select(F.col("_k").alias(key), F.posexplode("_kept").alias("_p", "_m")).select(
        key, F.col("_m.neighbour").alias("neighbour"), F.col("_m.distance").alias("distance"), (F.col("_p") + 1).alias("rank")
    )


def nearest_neighbours(points: DataFrame, key: str, vec: str, k: int, block: int = 2000) -> DataFrame:
    """(key, neighbour, distance, rank): the k nearest other rows, ties to the lower key.

    ``vec`` is an array of doubles of one length; keys are unique.
    """
    spark = points.sparkSession
    distinct, size, width = collapsed(points, key, vec, k)
    if not size:
        kind = points.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"{key} {kind}, neighbour {kind}, distance double, rank int")
    count = max(1, math.ceil(8 * width * size / _BLOCK_BYTES), min(size // _CELL, math.ceil(size / block), _BLOCKS))
    # a row with a missing or infinite coordinate is at no distance from any other
    whole = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    chosen = distinct.where(whole).orderBy(F.md5(F.col("id").cast("string"))).limit(count).select("vec").collect()
    pivots = spark.sparkContext.broadcast(np.array([r.vec for r in chosen], float))
    kind = distinct.schema["id"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                rows = pa.Table.from_batches([batch.slice(i, 1000)])
                d = _distances(_matrix(rows), pivots.value)
                yield from rows.append_column("cell", pa.array(d.argmin(axis=1), pa.int32())).append_column("reach", pa.array(d.min(axis=1))).to_batches()

    cells = staged(
        distinct.where(whole).select("id", "vec").mapInArrow(place, f"id {kind}, vec array<double>, cell int, reach double"), "cells"
    )
    summary = sorted(tuple(r) for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("radius")).collect())
    radii = np.zeros(len(chosen))
    most = math.ceil(size / count)
    parts, first = [], []
    for cell, n, radius in summary:
        radii[cell] = radius
        first.append((cell, len(parts), math.ceil(n / most)))
        parts += [(cell, i) for i in range(math.ceil(n / most))]
    shape = spark.createDataFrame(first, "cell int, first int, parts int")
    block_of = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("block")
    blocks = cells.join(F.broadcast(shape), "cell").select("id", "vec", block_of)  # one row per cell in the lookup

    own = staged(_closest(_own(blocks, kind, k), k), "own")
    near = own if len(parts) < 2 else _closest(_reach_out(blocks, own, parts, radii, pivots, kind, k), k)

    return expanded(points, key, vec, k, distinct, near)
