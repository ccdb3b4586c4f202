"""Near-duplicate vectors by a forest of random-projection trees with spill (operator 3)."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.llm import links
from tidemark.llm.common import bounded_sample
from tidemark.llm.links import partial_links

THRESHOLD = 0.93
#: Trees, the share of a node's rows on each side of its median that go to both children, rows of a leaf aimed at,
#: rows of the sample that the splits are fitted on, the smallest leaf of the sample, and rows of a block in a leaf.
TREES, SPILL, LEAF, SAMPLE, LEAST_LEAF, BLOCK = 8, 0.05, 512, 20_000, 8, 512
#: A sample row with this share of a leaf of the sample linked to it (three rows at least) is in a dense group.
DENSE, LEAST_DENSE = 1 / 8, 3
#: A leaf of more than so many times the rows aimed at is split again, by a sample of so many of its own rows.
CROWDED, OWN_SAMPLE = 4, 4096


@dataclass
class Tree:
    """Inner nodes in arrays: direction, the two borders of the overlap, children (negative: leaf number - 1)."""

    direction: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that a row reaches; a row in the overlap goes both ways."""
        row, at = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        if not len(self.low):
            return row, at
        done_row, done_leaf = [], []
        while len(row):
            p = np.einsum("ij,ij->i", vectors[row], self.direction[at])
            left, right = p <= self.high[at], p >= self.low[at]
            row = np.concatenate([row[left], row[right]])
            at = np.concatenate([self.child[at[left], 0], self.child[at[right], 1]])
            end = at < 0
            done_row.append(row[end])
            done_leaf.append(-1 - at[end])
            row, at = row[~end], at[~end]
        return np.concatenate(done_row), np.concatenate(done_leaf)


def grow(sample: np.ndarray, leaf_rows: int, spill: float, seed: int) -> Tree:
    """Split at random directions until a node holds ``leaf_rows`` of the sample or nothing can be told apart."""
    rng = np.random.default_rng(seed)
    direction, low, high, child = [], [], [], []
    n_leaves = 0

    def place(rows: np.ndarray) -> int:
        nonlocal n_leaves
        split = None
        if len(rows) > leaf_rows:
            d = rng.standard_normal(sample.shape[1])
            p = sample[rows] @ d
            a, b = np.quantile(p, [0.5 - spill, 0.5 + spill])
            left, right = rows[p <= b], rows[p >= a]
            if max(len(left), len(right)) < len(rows):
                split = d, a, b, left, right
        if split is None:
            n_leaves += 1
            return -n_leaves
        k = len(low)
        direction.append(split[0]), low.append(split[1]), high.append(split[2]), child.append([0, 0])
        child[k] = [place(split[3]), place(split[4])]
        return k

    place(np.arange(len(sample)))
    return Tree(np.array(direction, np.float64).reshape(-1, sample.shape[1]), np.array(low), np.array(high), np.array(child, np.int64).reshape(-1, 2))


def centres_of(sample: np.ndarray, threshold: float, least: int) -> np.ndarray:
    """Rows, densest first, such that each row of the sample with ``least`` others linked to it is linked to one of them."""
    near = [(sample[i : i + 256] @ sample.T >= threshold).sum(axis=1) - 1 for i in range(0, len(sample), 256)]
    near = np.concatenate([np.zeros(0, np.int64), *near])
    todo = np.argsort(-near, kind="stable")[: np.count_nonzero(near >= least)]
    found = []
    while len(todo):
        found.append(todo[0])
        todo = todo[1:][sample[todo[1:]] @ sample[todo[0]] < threshold]
    return sample[found]


def cells(vectors: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, centre) for every cell that a row goes to, and whether a row is covered: all its links are within its cells.

    A row belongs to the first centre it is linked to. What is linked to it is at most twice the link angle from that
    centre, so a cell takes all rows as near as that; rows that belong to an earlier centre meet its rows there.
    """
    reach = (2 * threshold * threshold - 1 if threshold > 0 else -1) - 1e-9
    rows, at, covered = [], [], []
    for i in range(0, len(vectors), 1024):
        cosine = vectors[i : i + 1024] @ centres.T
        linked = cosine >= threshold
        covered.append(linked.any(axis=1))
        own = np.where(covered[-1], linked.argmax(axis=1), len(centres))
        row, cell = np.nonzero((cosine >= reach) & (np.arange(len(centres)) <= own[:, None]))
        rows.append(row + i)
        at.append(cell)
    return np.concatenate(rows), np.concatenate(at), np.concatenate(covered)


def unit(vector: list | None) -> np.ndarray | None:
    """The vector in double precision at length one; None if it has no direction."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()
    return v / np.sqrt(v @ v)


def _fitted(sample: np.ndarray, aim: int, threshold: float, spill: float, seed: int) -> tuple[np.ndarray, Tree]:
    """The centres of dense groups in a sample, and a tree over the rest."""
    centres = centres_of(sample, threshold, max(LEAST_DENSE, int(aim * DENSE)))
    rest = sample[~cells(sample, centres, threshold)[2]] if len(centres) else sample
    return centres, grow(rest, aim, spill, seed)


def _parts(vectors: np.ndarray, centres: np.ndarray, tree: Tree, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, part): cells about the centres first, then the leaves of the tree, for the rows that no cell covers."""
    left, rows, parts = np.arange(len(vectors)), [], []
    if len(centres):
        r, k, covered = cells(vectors, centres, threshold)
        rows.append(r)
        parts.append(k)
        left = np.flatnonzero(~covered)
    r, k = tree.leaves(vectors[left])
    return np.concatenate([*rows, left[r]]), np.concatenate([*parts, k + len(centres)])


_PLACED = "node binary, label string, width int, place long, done boolean"


def _split_again(placed: DataFrame, nodes: DataFrame, leaf: int, threshold: float, spill: float, own_sample: int) -> DataFrame:
    """Leaves that hold too many rows are split by trees fitted on their own rows, until none does or nothing splits.

    Trees are fitted in tasks, one leaf each, on a sample of bounded size; a leaf's tree meets the leaf's rows by streaming
    past them, so neither the driver nor a broadcast holds the second level, whose size grows with the table.
    """
    key = ["place", "label", "width"]
    while True:
        sizes = placed.where("NOT done").groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CROWDED * leaf)
        sizes = staged(sizes.withColumn("grp", F.xxhash64(*key)), "crowded")
        if sizes.isEmpty():
            return placed
        rows = placed.where("NOT done").join(sizes, key).join(nodes.select("node", "label", "data"), ["node", "label"])
        rows = staged(rows.select("grp", "size", *key, "node", "data"), "crowded-rows")
        chance = F.pmod(F.xxhash64("node", "grp"), F.lit(1 << 40)) / float(1 << 40)
        sample = rows.where(chance < F.lit(float(own_sample)) / F.col("size")).select("grp", "size", "data")

        def fit(table: pa.Table) -> dict[str, list]:
            own = np.stack([np.frombuffer(d) for d in table.column("data").to_pylist()])
            grp, size = table.column("grp")[0].as_py(), table.column("size")[0].as_py()
            aim = max(LEAST_LEAF, int(leaf * len(own) / size))
            centres, tree = _fitted(own, aim, threshold, spill, grp & 0x7FFFFFFF)
            return {"grp": [grp], "tree": [pickle.dumps((centres, astuple(tree)))]}

        trees = staged(links.map_groups(sample, "grp", fit, "grp long, tree binary"), "own-trees")
        none = [F.lit(None).cast(t).alias(c) for c, t in (("place", "long"), ("label", "string"), ("width", "int"), ("node", "binary"), ("data", "binary"))]
        both = trees.select("grp", F.lit(0).alias("turn"), "tree", *none).unionByName(rows.select("grp", F.lit(1).alias("turn"), F.lit(None).cast("binary").alias("tree"), *key, "node", "data"))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, centres, tree = None, None, None
            for batch in batches:
                grps, turns = batch.column("grp").to_numpy(), batch.column("turn").to_numpy()
                cuts = np.flatnonzero(np.append(True, (grps[1:] != grps[:-1]) | (turns[1:] != turns[:-1]))) if len(grps) else []
                for a, b in zip(cuts, [*cuts[1:], len(grps)]):
                    if turns[a] == 0:
                        now = grps[a]
                        centres, arrays = pickle.loads(batch.column("tree")[int(a)].as_py())
                        tree = Tree(*arrays)
                        continue
                    part = batch.slice(int(a), int(b - a))
                    if now == grps[a]:
                        r, k = _parts(np.stack([np.frombuffer(d) for d in part.column("data").to_pylist()]), centres, tree, threshold)
                        one = len(centres) == 0 and len(tree.low) == 0
                    else:  # no row of this leaf came into the sample
                        r, k, one = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64), True
                    take = pa.array(r)
                    cell = pa.array(k < (0 if now != grps[a] else len(centres))) if not one else pa.array(np.ones(len(k), bool))
                    yield pa.RecordBatch.from_arrays([*[part.column(c).take(take) for c in ("node", "label", "width", "place")], pa.array(k), cell], names=["node", "label", "width", "place", "part", "done"])

        routed = both.repartition("grp").sortWithinPartitions("grp", "turn").mapInArrow(route, "node binary, label string, width int, place long, part long, done boolean")
        again = routed.select("node", "label", "width", F.xxhash64("place", "part").alias("place"), "done")
        placed = staged(placed.join(sizes.select(*key), key, "left_anti").select("node", "label", "width", "place", "done").unionByName(again), "placed")


def forest_links(vectors: DataFrame, item: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, trees: int = TREES, spill: float = SPILL, leaf: int = LEAF, sample_rows: int = SAMPLE, block: int = BLOCK, own_sample: int = OWN_SAMPLE) -> DataFrame:
    """(item, n_links, component_id, kept): links are pairs of equal non-null label with cosine at or above the threshold.

    Dense groups are found in a sample of at most about ``sample_rows`` rows and kept whole: a row linked to the centre
    of one finds all its links in cells about the centres. Every other row goes through every tree as well, whose splits
    are fitted on such rows of the sample; a leaf that holds over ``CROWDED`` times the rows aimed at is split again by
    trees fitted on its own rows, so that leaves do not grow with the table. Cells and leaves are compared within equal labels and lengths; one of more
    than ``block`` such rows is compared block by block, none of its rows left out. A pair that meets in several cells
    or leaves is counted in the first only, so counts need no set of pairs. Equal vectors of a label are one node and count as linked to each other. A vector
    that is null, empty, zero or holds a null or non-finite component, or has no label, links with nothing. Rows with
    equal ids count one by one; a null id is its own class; extra columns are ignored; an empty table gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [unit(v) for v in batch.column(1).to_pylist()]
            data = [None if u is None or k is None else u.tobytes() for u, k in zip(units, batch.column(2).to_pylist())]
            node = [None if d is None else hashlib.md5(f"{k}|".encode() + d).digest() for d, k in zip(data, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.binary()), pa.array(data, pa.binary()), batch.column(2)], names=["item", "node", "data", "label"])

    slim = vectors.select(F.col(item).cast("long").alias("item"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label"))
    members = staged(slim.mapInArrow(read, "item long, node binary, data binary, label string"), "vectors")
    nodes = members.where("node IS NOT NULL").groupBy("node", "label").agg(F.first("data").alias("data"), F.count(F.lit(1)).alias("copies"))
    nodes = staged(nodes, "nodes")
    total = nodes.count()
    sample = [(r["label"], np.frombuffer(r["data"])) for r in bounded_sample(nodes, sample_rows, "node").select("label", "data").collect()]
    width = max((len(v) for _, v in sample), default=1)
    aim = max(LEAST_LEAF, int(leaf * len(sample) / max(1, total)))
    alike: dict[tuple[str, int], list[np.ndarray]] = {}
    for key, v in sample:
        alike.setdefault((key, len(v)), []).append(v)
    centres, sparse, n_centres = {}, [], 0
    for key, own in alike.items():
        own = np.stack(own)
        dense = centres_of(own, threshold, max(LEAST_DENSE, int(aim * DENSE)))
        if len(dense):
            centres[key] = n_centres, dense
            n_centres += len(dense)
            own = own[~cells(own, dense, threshold)[2]]
        sparse.append(np.pad(own, ((0, 0), (0, width - key[1]))))
    fitted = np.concatenate([np.zeros((0, width)), *sparse])
    forest = nodes.sparkSession.sparkContext.broadcast(([astuple(grow(fitted, aim, spill, seed)) for seed in range(trees)], centres))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.frombuffer(d) for d in batch.column("data").to_pylist()]
            padded = np.zeros((len(data), width))
            for row, v in zip(padded, data):
                row[: min(width, len(v))] = v[:width]
            grown, centres = forest.value
            rows, tree_no, leaf_no = [], [], []
            left = np.ones(len(data), bool)
            alike: dict[tuple[str, int], list[int]] = {}
            for i, (key, v) in enumerate(zip(batch.column("label").to_pylist(), data)):
                if (key, len(v)) in centres:
                    alike.setdefault((key, len(v)), []).append(i)
            for key, own in alike.items():
                first, dense = centres[key]
                r, k, covered = cells(np.stack([data[i] for i in own]), dense, threshold)
                own = np.array(own)
                left[own[covered]] = False
                rows.append(own[r])
                leaf_no.append(first + k)
                tree_no.append(np.zeros(len(r), np.int64))
            left = np.flatnonzero(left)
            for t, tree in enumerate(grown):
                r, k = Tree(*tree).leaves(padded[left])
                rows.append(left[r])
                leaf_no.append(k)
                tree_no.append(np.full(len(r), t + 1))
            row, tree, leaves = map(np.concatenate, (rows, tree_no, leaf_no))
            order = np.lexsort((leaves, tree, row))
            row, place = row[order], (tree[order] << 32) | leaves[order]
            starts = np.searchsorted(row, np.arange(len(data) + 1))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("label"), batch.column("copies"), batch.column("data"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(place, pa.int64()))], names=["node", "label", "copies", "data", "places"])

    routed = staged(nodes.mapInArrow(route, "node binary, label string, copies long, data binary, places array<long>"), "routed")
    at_once = routed.select("node", "label", F.octet_length("data").alias("width"), F.explode("places").alias("place"))
    # cells of dense groups (tree 0) stay whole
    first = at_once.withColumn("done", F.shiftright("place", 32) == 0)
    split = _split_again(first, nodes, leaf, threshold, spill, own_sample)
    group = F.xxhash64("place", "label", "width").alias("grp")
    if split is first:
        placed = routed.withColumn("width", F.octet_length("data")).withColumn("place", F.explode("places"))
    else:
        lists = split.groupBy("node", "label").agg(F.collect_set("place").alias("places"))
        placed = nodes.join(lists, ["node", "label"]).withColumn("width", F.octet_length("data")).withColumn("place", F.explode("places"))
    sizes = placed.groupBy(group).agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumn("n_blocks", F.ceil(F.col("size") / block).cast("int"))
    rows = placed.select("node", "copies", "data", "places", "place", group).join(sizes, "grp")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    rows = rows.select("grp", "node", "copies", "data", "places", "place", "own", other)
    pair = F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")).alias("pair")
    rows = rows.select(pair, (F.col("own") > F.col("other")).cast("int").alias("side"), (F.col("own") == F.col("other")).alias("alone"), "node", "copies", "data", "places", "place")

    def compare(table: pa.Table) -> dict[str, list] | None:
        sides = np.array(table.column("side").to_pylist())
        data = [np.frombuffer(d) for d in table.column("data").to_pylist()]
        vectors = np.stack(data)
        first, second = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        if table.column("alone")[0].as_py():
            left, right = np.nonzero(np.triu(vectors @ vectors.T >= threshold, 1))
        else:
            i, j = np.nonzero(vectors[first] @ vectors[second].T >= threshold)
            left, right = first[i], second[j]
        if not len(left):
            return None
        place = table.column("place")[0].as_py()
        before = [{p for p in own if p < place} for own in table.column("places").to_pylist()]
        here = np.fromiter((before[a].isdisjoint(before[b]) for a, b in zip(left.tolist(), right.tolist())), bool, len(left))
        return partial_links(table.column("node").to_pylist(), table.column("copies").to_numpy(), left[here], right[here])

    linked = staged(links.map_groups(rows, "pair", compare, "node binary, n_links long, root binary"), "linked")
    found = links.classes(members.select(F.col("item").alias(item), "node"), item, linked)
    return found.withColumnRenamed("component", "component_id")
