"""Components, Jaccard join and tree forest against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.llm import tree_forest
from tidemark.llm.jaccard_join import bands_for, jaccard_links
from tidemark.llm.links import components
from tidemark.llm.tree_forest import forest_links


def reach(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components_paths_stars_and_loops(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(7, 7), (300, 301), (301, 300), (300, 301)]
    edges += [tuple(map(int, rng.integers(400, 500, 2))) for _ in range(70)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    edges = [(a, b) for a, b in edges if a != b]
    assert found == reach({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_jaccard(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    edges, counts = [], [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                edges.append((j, i))
                counts[i] += 1
                counts[j] += 1
    label = reach(range(len(rows)), edges)
    least = {}
    for k, part in label.items():
        least[part] = min(least.get(part, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], counts[k], least[label[k]]) for k in range(len(rows)))


def texts(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        words = list(rng.choice(vocabulary, int(rng.integers(6, 160))))
        for copy in range(int(rng.integers(1, 9))):
            own = list(words)
            for _ in range(copy % 4):
                own[int(rng.integers(len(own)))] = str(rng.choice(vocabulary))
            rows.append(" ".join(own))
    rows += ["", None, " \n ", "a b", "a  b", "a b c d e", "é ü 東京", "é ü 東京"]
    hot = list(rng.choice(vocabulary, 60))
    for i in range(70):
        rows.append(" ".join([*hot[:-1], f"tail{i}"]))
    rows.append(" ".join(rng.choice(vocabulary, 30_000)))
    rows.append(rows[-1] + " more")
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [16, 512])
def test_jaccard_equals_brute_force(spark, block):
    rows = texts(np.random.default_rng(11))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS bands").repartition(4)
    found = jaccard_links(df, block=block).collect()
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in found) == brute_jaccard(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in found)


def test_jaccard_repeated_ids_null_ids_and_no_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words in this text here"), (None, "a b c d e f"), (None, None)]
    found = jaccard_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_links) for r in found) == [(0, 0), (0, 2), (1, 0), (1, 2), (1, 2)]
    assert jaccard_links(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands_reach_the_recall():
    for rows in (3, 5, 8):
        b = bands_for(0.8, rows, 0.9999)
        assert 1 - (1 - 0.8**rows) ** b >= 0.9999 > 1 - (1 - 0.8**rows) ** (b - 1)


def vectors(rng, n, labels, dims=16):
    out = []
    for i in range(n):
        v = rng.standard_normal(dims)
        if i % 3 == 1:
            v = np.array(out[-1][1]) + rng.standard_normal(dims) * 0.08
        out.append((i, [float(x) for x in v], int(rng.integers(labels))))
        if i % 3 == 1:
            out[-1] = (i, out[-1][1], out[-2][2])
    return out


def brute_vectors(rows, threshold=0.93):
    units = []
    for _, v, label in rows:
        ok = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v) / np.linalg.norm(v) if ok else None)
    edges, counts = [], [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                edges.append((j, i))
                counts[i] += 1
                counts[j] += 1
    return edges, counts


@pytest.mark.parametrize("block", [8, 512])
def test_forest_single_leaf_equals_brute_force(spark, block):
    rows = vectors(np.random.default_rng(5), 150, 3)
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, [float("nan")] + [1.0] * 15, 1), (905, rows[0][1], None), (906, rows[0][1], rows[0][2]), (907, rows[0][1], rows[0][2]), (908, [1.0, 2.0], 1), (909, [2.0, 4.0], 1), (910, [1e300] * 16, 1)]
    edges, counts = brute_vectors(rows)
    label = reach(range(len(rows)), edges)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "0 AS node", "0 AS data")
    found = forest_links(df, block=block).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == sorted((rows[k][0], counts[k], rows[label[k]][0], k == label[k]) for k in range(len(rows)))


def test_forest_recall_with_many_leaves(spark):
    rows = vectors(np.random.default_rng(6), 1500, 2, dims=24)
    _, counts = brute_vectors(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in forest_links(df, leaf=64, sample_rows=600).collect()}
    assert all(found[rows[k][0]] <= counts[k] for k in range(len(rows)))
    assert sum(found.values()) >= 0.97 * sum(counts)
    assert forest_links(df.where("vec_id < 0")).count() == 0


def test_forest_keeps_a_dense_group_whole(spark):
    rng = np.random.default_rng(8)
    middle = rng.standard_normal(64)
    rows = []
    for i in range(1800):
        v = middle / np.linalg.norm(middle) + rng.standard_normal(64) * 0.23 / 8 if i % 3 == 0 else rng.standard_normal(64)
        rows.append((i, [float(x) for x in v], 0 if i % 3 == 0 else i % 2))
    units = np.array([v for _, v, _ in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    labels = np.array([k for _, _, k in rows])
    counts = ((units @ units.T >= 0.93) & (labels[:, None] == labels)).sum(axis=1) - 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in forest_links(df, leaf=8).collect()}  # leaves of 8 sample rows, as for millions
    assert counts.sum() > 300_000 and [found[i] for i in range(len(rows))] == counts.tolist()


def _links_of(units, labels):
    return ((units @ units.T >= 0.93) & (labels[:, None] == labels)).sum(axis=1) - 1


def _copies(rng, n, dims, labels):
    """Vectors of which a third are near-copies of the one before, and a tenth belong to groups of thirty."""
    out = []
    for i in range(n):
        v = rng.standard_normal(dims)
        if i % 3 == 1:
            v = out[-1][1] + rng.standard_normal(dims) * 0.2
        elif i % 10 == 9:
            v = np.random.default_rng(i // 300).standard_normal(dims) + rng.standard_normal(dims) * 0.15
        out.append((i, v, out[-1][2] if i % 3 == 1 else i // 300 % labels if i % 10 == 9 else int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("third", [False, True])
def test_crowded_leaves_are_split_again(spark, monkeypatch, third):
    seen = []
    real = tree_forest._split_again
    monkeypatch.setattr(tree_forest, "_split_again", lambda *a: seen.append(real(*a)) or seen[-1])
    per_node = []
    for n in (3000, 9000):
        rng = np.random.default_rng(n)
        rows = _copies(rng, n, 32, 2)
        if third:
            middle = rng.standard_normal(32)
            rows = [(i, middle + rng.standard_normal(32) * 0.12 if i % 3 == 2 else v, 1 if i % 3 == 2 else k) for i, v, k in rows]
        units = np.array([v / np.linalg.norm(v) for _, v, _ in rows])
        counts = _links_of(units, np.array([k for _, _, k in rows]))
        df = spark.createDataFrame([(i, v.tolist(), k) for i, v, k in rows], "vec_id long, embedding array<double>, label int")
        found = {r.vec_id: r.n_links for r in tree_forest.forest_links(df, leaf=24, sample_rows=250, own_sample=400).collect()}
        assert all(found[i] <= counts[i] for i in range(n)) and sum(found.values()) >= 0.97 * counts.sum()
        placed = seen[-1].groupBy("place", "label").agg(F.count("*").alias("n"), F.max("done").alias("done"))
        assert placed.where("NOT done").agg(F.max("n")).first()[0] <= 4 * 24
        open_ = seen[-1].where("NOT done").groupBy("node").count().agg(F.avg("count")).first()[0]
        per_node.append(open_)
    assert per_node[1] < 2 * per_node[0]
