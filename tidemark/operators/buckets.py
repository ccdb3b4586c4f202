"""Near neighbours from hash tables of random projections, without comparing all pairs.

Each table cuts the space by as many projections as leave about ``bucket`` rows in a cell: signs from an md5, so any engine
draws the same ones, and each projection is cut at its median, so that halves are equal. A row is compared with its own cell
and with the cells beyond its ``probes`` nearest cuts. A cell that holds more rows than meant, as about a dense group, is cut
again by further projections, at the means of its own rows. Coordinates are whole multiples of 1 / ``unit``, which makes sums
of them exact and cells the same everywhere. Work grows with rows x tables x probes x bucket.

A row goes once to every cell it lies in or looks at, in one shuffle; the task that gets a cell cuts it again and keeps the best
k of each of its rows. Cells of over ``crowd`` rows are known from counts beforehand: they are cut again as tables, and what
is still crowded is cut into blocks, each pair of blocks a unit of work.

The neighbours are true rows at true distances; a nearer one may be missed if no table puts it near. ``neighbours.py`` is the
exact search.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.brackets import exact_quantiles
from tidemark.functions.stage import staged
from tidemark.operators.neighbours import collapsed, expanded

# tasks get these functions by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tables, rows a cell is meant for, cells tried beyond the own one, rows of a block, and parts of a coordinate's unit.
TABLES, BUCKET, PROBES, BLOCK, UNIT = 12, 32, 4, 2000, 1_000_000
#: Further cuts that a crowded cell may have, and cells tried beyond them.
MORE, MORE_PROBES = 16, 1
#: Rows, and bytes of vectors, of a cell that one task takes whole; rows answered before they are handed on.
CROWD, CROWD_BYTES, ANSWERED = 20_000, 32 << 20, 20_000
#: What a unit of work is called: a cell, its part (-1: not cut yet) and the pair of blocks.
_UNIT = ["cell", "part", "pair"]


def sign(seed: int, table: int, cut: int, column: int) -> int:
    """+1 or -1 from the first hex digit of an md5."""
    return 1 if int(md5(f"{seed}-{table}-{cut}-{column}".encode()).hexdigest()[0], 16) % 2 else -1


def cuts_for(rows: int, bucket: int) -> int:
    """Projections of a table that leave about ``bucket`` rows in a cell."""
    return max(0, math.ceil(math.log2(rows / bucket))) if rows else 0


def _numbers(column: pa.Array, *shape: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(shape)


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def _signs(seed: int, tables: int, first: int, last: int, width: int) -> np.ndarray:
    """Signs of the cuts ``first`` to ``last`` of every table, by table, cut and column."""
    return np.array([[[sign(seed, t, j, i) for i in range(width)] for j in range(first, last)] for t in range(tables)], float).reshape(tables, last - first, width)


def _element(distinct: DataFrame) -> str:
    """float if the coordinates lose nothing by it, as numbers that were stored so, else double."""
    narrow = F.coalesce(F.forall("vec", lambda x: x.cast("float").cast("double").eqNullSafe(x)), F.lit(True))
    return "float" if distinct.agg(F.coalesce(F.bool_and(narrow), F.lit(False))).first()[0] else "double"


def _projected(distinct: DataFrame, width: int, tables: int, cuts: int, seed: int, unit: int) -> DataFrame:
    """(id, vec, at): the sums of the projections of the cells, table by table."""
    # sums of whole numbers within 2^53 are exact, whatever their order
    signs = _signs(seed, tables, 0, cuts, width).reshape(tables * cuts, width)
    kind, element = distinct.schema["id"].dataType.simpleString(), _element(distinct)
    whole = distinct.select("id", F.col("vec").cast(f"array<{element}>").alias("vec"), F.transform("vec", lambda x: F.round(x * unit).cast("long")).alias("whole"))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (_numbers(batch.column("whole"), batch.num_rows, width).astype(float) @ signs.T).astype(np.int64)
            at = _lists(at) if cuts else pa.array([[]] * batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), at], names=["id", "vec", "at"])

    return staged(whole.mapInArrow(project, f"id {kind}, vec array<{element}>, at array<long>"), "projected")


def _further(vectors: np.ndarray, signs: np.ndarray, unit: int) -> np.ndarray:
    """The sums of the further projections; whole coordinates are rounded half away from zero."""
    at = vectors * unit
    whole = np.trunc(at)
    whole += np.sign(at) * (np.abs(at - whole) >= 0.5)
    return (whole @ signs.T).astype(np.int64)


def _medians(projected: DataFrame, tables: int, cuts: int) -> np.ndarray:
    """The median of each projection of the cells."""
    medians = np.zeros((tables, cuts))
    if cuts:
        each = projected.select(F.posexplode("at").alias("cut", "value"))
        for r in exact_quantiles(each, [0.5], "value", ["cut"]).collect():  # one row per projection
            medians[divmod(r.cut, cuts)] = r.quantile
    return medians


def _beyond(off: np.ndarray, cuts: np.ndarray | int, probes: int) -> np.ndarray:
    """Codes of cells from the distances to their cuts (last axis): the own one, then those beyond the nearest cuts."""
    used = np.arange(off.shape[-1]) < np.asarray(cuts)[..., None]
    code = (((off > 0) & used).astype(np.int64) << np.arange(off.shape[-1])).sum(axis=-1)
    near = np.argsort(np.where(used, np.abs(off), np.inf), axis=-1, kind="stable")[..., :probes]
    flipped = code[..., None] ^ np.where(np.take_along_axis(np.broadcast_to(used, off.shape), near, -1), np.int64(1) << near, 0)
    return np.concatenate([code[..., None], flipped], axis=-1)


def _tried(projected: DataFrame, tables: int, cuts: int, probes: int) -> Callable[[pa.Array], np.ndarray]:
    """The cells of a batch, from its projections: by row and table the own one, then the probed ones."""
    medians = _medians(projected, tables, cuts)

    def tried(at: pa.Array) -> np.ndarray:
        off = _numbers(at, len(at), tables, cuts) - medians
        return _beyond(off, cuts, probes) * tables + np.arange(tables)[None, :, None]

    return tried


def _cells(projected: DataFrame, width: int, tables: int, probes: int, tried: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """(cell, side, id, vec): each row once for every cell it has to do with: its own ones (side 0), where it is a point and a
    query, and the probed ones (side 2), where it is a query."""
    vec, kind = projected.schema["vec"].dataType.simpleString(), projected.schema["id"].dataType.simpleString()
    step = max(1, min(500, (1 << 26) // (8 * max(1, width) * tables * (1 + probes))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                cell = tried(batch.column("at"))
                n, _, k = cell.shape
                rows = pa.array(np.repeat(np.arange(n), tables * k))
                side = np.tile([0] + [2] * (k - 1), n * tables)
                yield pa.RecordBatch.from_arrays([pa.array(cell.ravel()), pa.array(side, pa.int32()), batch.column("id").take(rows), batch.column("vec").take(rows)], names=["cell", "side", "id", "vec"])

    return projected.mapInArrow(place, f"cell long, side int, id {kind}, vec {vec}")


def _crowded(projected: DataFrame, crowd: int, tried: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """(cell, points): cells that more than ``crowd`` rows have to do with."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = tried(batch.column("at"))
            names, at = np.unique(cell, return_inverse=True)
            points = np.bincount(at.reshape(cell.shape)[:, :, 0].ravel(), minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(points), pa.array(np.bincount(at.ravel(), minlength=len(names)))], names=["cell", "points", "n"])

    counted = projected.select("at").mapInArrow(tally, "cell long, points long, n long").groupBy("cell").agg(F.sum("points").alias("points"), F.sum("n").alias("n"))
    return staged(counted.where(F.col("n") > crowd).select("cell", "points"), "crowded")


def _split(cells: DataFrame, width: int, tables: int, cuts: int, bucket: int, seed: int, unit: int) -> DataFrame:
    """(cell, part, side, id, vec): cells cut again, at the means of their points' further projections. A point (side 1) lies in
    one part; a query (side 2) tries its own part and the one beyond its nearest cut."""
    signs = _signs(seed, tables, cuts, cuts + MORE, width)
    vec, kind = cells.schema["vec"].dataType.simpleString(), cells.schema["id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors, table = _numbers(batch.column("vec"), n, width).astype(float), batch.column("cell").to_numpy() % tables
            more = np.empty((n, MORE), np.int64)
            for t in np.unique(table):
                more[table == t] = _further(vectors[table == t], signs[t], unit)
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(more)], names=[*batch.schema.names, "more"])

    cells = staged(cells.mapInArrow(project, f"cell long, side int, id {kind}, vec {vec}, more array<long>"), "cells")
    means = [F.sum(F.get("more", F.lit(i))).alias(f"m{i}") for i in range(MORE)]
    held = cells.where("side = 0").groupBy("cell").agg(F.count(F.lit(1)).alias("points"), *means)
    held = held.select("cell", F.transform(F.array(*[f"m{i}" for i in range(MORE)]), lambda m: m / F.col("points")).alias("means"), F.least(F.lit(MORE), F.greatest(F.lit(0), F.ceil(F.log2(F.col("points") / (2 * bucket))))).cast("int").alias("cuts"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            off = _numbers(batch.column("more"), n, MORE) - _numbers(batch.column("means"), n, MORE)
            cuts, side = batch.column("cuts").to_numpy(), batch.column("side").to_numpy()
            code = _beyond(off, cuts, MORE_PROBES)
            # a query that has no cut to look beyond tries no part twice
            code = np.concatenate([code[:, :1], code], axis=1)
            tried = np.ones(code.shape, bool)
            tried[:, 0] = side == 0
            tried[:, 2:] = (cuts > 0)[:, None] & (code[:, 2:] != code[:, :1])
            rows, at = np.nonzero(tried)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cell").take(take), pa.array(code[rows, at]), pa.array(np.where(at == 0, 1, 2), pa.int32()), batch.column("id").take(take), batch.column("vec").take(take)],
                names=["cell", "part", "side", "id", "vec"],
            )

    joined = cells.join(held, "cell").select("cell", "side", "id", "vec", "more", "means", "cuts")
    return staged(joined.mapInArrow(place, f"cell long, part long, side int, id {kind}, vec {vec}"), "split")


def _units(parts: DataFrame, block: int) -> DataFrame:
    """(cell, part, pair, side, id, vec): points and queries of a part in blocks, every block of one side with every block of
    the other."""
    sizes = parts.groupBy("cell", "part").agg(
        F.ceil(F.count_if(F.col("side") == 1) / block).alias("points"), F.ceil(F.count_if(F.col("side") == 2) / block).alias("queries")
    ).where("points > 0 AND queries > 0")
    hashed = F.xxhash64("id")
    mine = F.when(F.col("side") == 1, F.pmod(hashed, "points")).otherwise(F.pmod(hashed, "queries"))
    others = F.when(F.col("side") == 1, F.col("queries")).otherwise(F.col("points"))
    paired = parts.join(sizes, ["cell", "part"]).select("cell", "part", "side", "id", "vec", "queries", mine.alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("other"))
    number = F.when(F.col("side") == 1, F.col("mine") * F.col("queries") + F.col("other")).otherwise(F.col("other") * F.col("queries") + F.col("mine"))
    return paired.select("cell", "part", number.alias("pair"), "side", "id", "vec")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices, from differences, some rows at a time."""
    out = np.empty((len(a), len(b)))
    step = max(1, 2_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        off = a[i : i + step, None, :] - b[None]
        out[i : i + step] = np.sqrt((off * off).sum(axis=2))
    return out


def _best(points: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance): the best k points of each query, ties to the lower place; ``own`` is a query's place among the
    points, or -1, and no query finds itself."""
    found = []
    step = max(1, 2_000_000 // len(points))
    for i in range(0, len(queries), step):
        d = distances(queries[i : i + step], points)
        at_home = np.flatnonzero(own[i : i + step] >= 0)
        d[at_home, own[i : i + step][at_home]] = np.inf
        near = np.argsort(d, axis=1, kind="stable")[:, :k]
        best = np.take_along_axis(d, near, axis=1)
        rows, at = np.nonzero(np.isfinite(best))
        found.append((rows + i, near[rows, at], best[rows, at]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _answered(ids: pa.Array, vectors: np.ndarray, side: np.ndarray, signs: np.ndarray | None, bucket: int, k: int, unit: int) -> tuple[pa.Array, pa.Array, np.ndarray] | None:
    """Ids of queries, of their best k points and the distances in one unit, whose points come first, by id. With ``signs`` a
    crowded cell is cut again, as ``_split`` does it."""
    n = int((side < 2).sum())
    asking = np.flatnonzero(side != 1)
    if not n or not len(asking):
        return None
    own = pc.fill_null(pc.index_in(ids.take(pa.array(asking)), value_set=ids.slice(0, n)), -1).to_numpy(zero_copy_only=False)
    cuts = 0 if signs is None else min(MORE, max(0, math.ceil(math.log2(n / (2 * bucket)))))
    if not cuts:
        rows, at, d = _best(vectors[:n], vectors[asking], own, k)
    else:
        more = _further(vectors, signs, unit)
        code = _beyond(more - more[:n].sum(axis=0) / n, cuts, MORE_PROBES)
        home = np.argsort(code[:n, 0], kind="stable")
        row, _ = np.nonzero(np.ones((len(asking), code.shape[1])))
        part = code[asking].ravel()
        order = np.argsort(part, kind="stable")
        row, part = row[order], part[order]
        names, first = np.unique(code[home, 0], return_index=True)
        found = []
        for name, members in zip(names, np.split(home, first[1:])):
            q = row[np.searchsorted(part, name) : np.searchsorted(part, name, side="right")]
            place = np.full(n + 1, -1)
            place[members] = np.arange(len(members))
            r, a, d = _best(vectors[members], vectors[asking[q]], place[own[q]], k)
            found.append((q[r], members[a], d))
        rows, at, d = (np.concatenate(c) for c in zip(*found))
        rank = np.lexsort((at, d, rows))
        rows, at, d = rows[rank], at[rank], d[rank]
        keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        rows, at, d = rows[keep], at[keep], d[keep]
    return ids.take(pa.array(asking[rows])), ids.take(pa.array(at)), d


def candidates(distinct: DataFrame, size: int, width: int, k: int, tables: int, bucket: int, probes: int, block: int, seed: int, unit: int, crowd: int) -> DataFrame:
    """(id, other, distance): the best k of every unit for each of its rows."""
    cuts = cuts_for(size, bucket)
    projected = _projected(distinct, width, tables, cuts, seed, unit)
    tried = _tried(projected, tables, cuts, probes)
    cells = _cells(projected, width, tables, probes, tried)
    crowded = _crowded(projected, min(crowd, max(block, CROWD_BYTES // (8 * max(1, width)))), tried)
    whole = F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("pair")
    if crowded.isEmpty():
        units = cells.select("cell", *whole, "side", "id", "vec")
    else:
        parts = _split(cells.join(crowded.where("points > 0"), "cell", "left_semi"), width, tables, cuts, bucket, seed, unit)
        units = cells.join(crowded, "cell", "left_anti").select("cell", *whole, "side", "id", "vec").unionByName(_units(parts, block))
    kind = distinct.schema["id"].dataType.simpleString()
    signs = _signs(seed, tables, cuts, cuts + MORE, width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready, n = None, [], [], 0

        def answer() -> int:
            if not held:
                return 0
            ids, vectors, side = zip(*held)
            got = _answered(pa.concat_arrays(ids), np.concatenate(vectors), np.concatenate(side), signs[now[0] % tables] if now[1] < 0 else None, bucket, k, unit)
            held.clear()
            if got is None:
                return 0
            ready.append(got)
            return len(got[2])

        def handed() -> pa.RecordBatch:
            ids, others, d = zip(*ready)
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(others), pa.array(np.concatenate(d))], names=["id", "other", "distance"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy() for c in _UNIT])
            ids, side = batch.column("id"), batch.column("side").to_numpy()
            vectors = _numbers(batch.column("vec"), batch.num_rows, width).astype(float)
            heads = [0, *(1 + np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0))).tolist()]
            for i, j in zip(heads, [*heads[1:], batch.num_rows]):
                name = tuple(names[:, i].tolist())
                if name != now:
                    n += answer()
                    now = name
                    if n > ANSWERED:
                        yield handed()
                        n = 0
                held.append((ids.slice(i, j - i), vectors[i:j], side[i:j]))
        answer()
        if ready:
            yield handed()

    return units.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "side", "id").mapInArrow(search, f"id {kind}, other {kind}, distance double")


def bucketed_neighbours(
    points: DataFrame, key: str, vec: str, k: int, block: int = BLOCK, tables: int = TABLES, bucket: int = BUCKET, probes: int = PROBES, seed: int = 42, unit: int = UNIT,
    crowd: int = CROWD,
) -> DataFrame:
    """(key, neighbour, distance, rank): the k nearest rows found in the tables, ties to the lower key.

    ``vec`` is an array of doubles of one length; keys are unique. Equal vectors are searched once. A row has fewer
    neighbours than k if its cells hold fewer other rows. Coordinates times ``unit`` must stay within 2^53 / length.
    """
    distinct, size, width = collapsed(points, key, vec, k)
    if not size:
        kind = points.schema[key].dataType.simpleString()
        return points.sparkSession.createDataFrame([], f"{key} {kind}, neighbour {kind}, distance double, rank int")
    found = candidates(distinct, size, width, k, tables, bucket, probes, block, seed, unit, crowd)
    # the same pair comes from several tables, at one distance
    merged = found.groupBy("id").agg(F.slice(F.array_sort(F.collect_set(F.struct("distance", "other"))), 1, k).alias("best"))
    near = merged.select("id", F.explode("best").alias("b")).select("id", F.col("b.other").alias("other"), F.col("b.distance").alias("distance"))
    return expanded(points, key, vec, k, distinct, near)


def comparisons(points: DataFrame, key: str, vec: str, k: int = 1, tables: int = TABLES, bucket: int = BUCKET, probes: int = PROBES, seed: int = 42, unit: int = UNIT) -> int:
    """Pairs of rows that ``bucketed_neighbours`` compares."""
    distinct, size, width = collapsed(points, key, vec, k)
    cuts = cuts_for(size, bucket)
    projected = _projected(distinct, width, tables, cuts, seed, unit)
    parts = _split(_cells(projected, width, tables, probes, _tried(projected, tables, cuts, probes)), width, tables, cuts, bucket, seed, unit)
    each = parts.groupBy("cell", "part").agg((F.count_if(F.col("side") == 1) * F.count_if(F.col("side") == 2)).alias("n"))
    return int(each.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
