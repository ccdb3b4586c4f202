"""Groups of linked items: connected components, and comparing the members of blocks pair by pair of blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the undirected edges (a, b).

    Alternates the two star steps of Kiveris and others: each links a node's larger (then smaller) neighbours to its
    smallest one. A node's neighbours are never gathered: the minimum is a partial aggregate, joined back to the edges.
    Each round is written, so lost executors repeat one round at most; rounds grow with the logarithm of the diameter.
    """
    a, b = F.col("a"), F.col("b")
    now = staged(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = staged(small.distinct(), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    stars = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def local_components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the edges, for each of n items."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        unequal = label[left] != label[right]
        left, right = left[unequal], right[unequal]
    while (label[label] != label).any():
        label = label[label]
    return label


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows with equal key from a partition that is sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0]
        for a, b in zip(cuts, cuts[1:]):
            if held and a == 0 and held[-1].column(key)[0].as_py() != keys[0] or held and a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def map_groups(df: DataFrame, key: str, each: Callable[[pa.Table], dict[str, list] | None], schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Run ``each`` on the rows of each key. A task goes through its keys one by one, without Spark's cost per group."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, key):
            out = each(table)
            if out:
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in map(out.get, names)], names=names)

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def block_of(node: Column, size: Column, most: int) -> Column:
    """Which block of its group a member goes to; groups of up to ``most`` are one block."""
    return F.pmod(F.xxhash64(node), F.ceil(size / most)).cast("int")


def partial_links(nodes: list, copies: np.ndarray, left: np.ndarray, right: np.ndarray) -> dict[str, list] | None:
    """For the linked pairs of one task: (node, n_links, root), where root is the smallest node linked to it here."""
    if not len(left):
        return None
    order = np.array(sorted(range(len(nodes)), key=nodes.__getitem__))
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    root = order[local_components(len(nodes), rank[left], rank[right])[rank]]
    counts = np.zeros(len(nodes), np.int64)
    np.add.at(counts, left, copies[right])
    np.add.at(counts, right, copies[left])
    some = np.flatnonzero(counts)
    return {"node": [nodes[i] for i in some], "n_links": counts[some], "root": [nodes[root[i]] for i in some]}


def classes(members: DataFrame, item: str, linked: DataFrame) -> DataFrame:
    """(item, n_links, component, kept) for ``members`` (item, node) from the partial links of nodes.

    Members of one node are equal; they count as linked to each other. The component is named by its smallest item.
    A null node is linked to nothing.
    """
    nodes = members.where("node IS NOT NULL").groupBy("node").agg(F.min(item).alias("first"), F.count(F.lit(1)).alias("copies"))
    counts = linked.groupBy("node").agg(F.sum("n_links").alias("others"))
    parts = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.join(counts, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = staged(named, "named")
    smallest = named.groupBy("component").agg(F.min("first").alias("least"))
    found = named.join(smallest, "component").select("node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("least").alias("component"))
    joined = members.select(item, "node").join(found, "node", "left")
    component = F.coalesce("component", item)
    return joined.select(item, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"), (component == F.col(item)).alias("kept"))
