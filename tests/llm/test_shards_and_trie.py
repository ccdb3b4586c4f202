"""Sharding and the prefix trie against brute force and SQL."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import numbering, prefix_trie, sharding


def walk(key: int, shards: int) -> int:
    """Jump consistent hashing, one key."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.integers(1, 60))
def test_jumps(keys, shards):
    now, grown = sharding.jumps(np.array(keys, np.uint64), shards)
    assert now.tolist() == [walk(k, shards) for k in keys] and grown.tolist() == [walk(k, shards + 1) for k in keys]
    assert all(g in (n, shards) for n, g in zip(now.tolist(), grown.tolist()))


def test_shares_and_moves():
    keys = np.random.default_rng(1).integers(0, 2**63, 100_000).astype(np.uint64)
    now, grown = sharding.jumps(keys, 16)
    assert np.bincount(now).max() / np.bincount(now).min() < 1.1
    assert abs((now != grown).mean() - 1 / 17) < 0.005


ROWS = [(1, "a"), (1, "a"), (1, "b"), (2, None), (2, ""), (None, "x"), (None, "x"), (None, None), (3, "é" * 9000), (-4, "a")]


def _docs(spark, rows, parts=4):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def _check(rows, out):
    expected = []
    for i, text in rows:
        key = int(hashlib.md5((str(i) if i is not None else "").encode()).hexdigest()[:16], 16)
        raw = (text or "").encode()
        expected.append((i, len(raw) + 1, zlib.crc32(raw), "key", walk(key, 16), walk(key, 17)))
    assert sorted([(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in out], key=str) == sorted(expected, key=str)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots(spark, monkeypatch):
    out = sharding.shard_slots(_docs(spark, ROWS)).collect()
    _check(ROWS, out)
    assert sorted(map(str, out)) == sorted(map(str, sharding.shard_slots(_docs(spark, ROWS[::-1], 1)).collect()))
    monkeypatch.setattr(numbering.numbered, "__defaults__", (7,))
    hot = ROWS + [(9, "same")] * 100 + [(9, f"other {i}") for i in range(50)]
    _check(hot, sharding.shard_slots(_docs(spark, hot)).collect())


def test_slots_of_none_and_other_columns(spark):
    assert sharding.shard_slots(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    extra = spark.createDataFrame([(1, "a", 7, 8, 9, "z")], "doc_id long, text string, shard int, n int, slot int, key string")
    _check([(1, "a")], sharding.shard_slots(extra).collect())
    kept = sharding.assign_shards(extra)
    assert kept.columns == ["doc_id", "text", "n", "slot", "key", "shard", "grown_shard"] and kept.first().key == "z"
    with pytest.raises(ValueError):
        sharding.assign_shards(extra, 0)


def test_files_by_shard(spark, tmp_path):
    docs = spark.range(300).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    sharding.write_shards(docs, f"{tmp_path}/out", 5)
    back = spark.read.parquet(f"{tmp_path}/out")
    placed = {r.doc_id: r.shard for r in back.collect()}
    assert placed == {r.doc_id: r.shard for r in sharding.assign_shards(docs, 5).collect()} and len(placed) == 300
    moved = sharding.moved_rows(docs, 5).collect()
    assert 0 < len(moved) < 120 and {r.grown_shard for r in moved} == {5}


def test_slots_equal_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(25)
    rows = [tuple(r) for r in docs.collect()] + ROWS
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(map(tuple, sharding.shard_slots(_docs(spark, rows)).collect()), key=str) == sorted(con.execute(sharding.ORACLE).fetchall(), key=str)


def trie(rows):
    """The contract over (conv_id, turn, role, text), turns that tie by their digest."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, f"{digest}:{len(text)}", role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _trie(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    return sorted((tuple(r)[:8] for r in prefix_trie.conversation_trie(frame).collect()), key=str)


def _conversations(seed, n, most):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(400, n, replace=False).tolist():
        for t in range(int(rng.integers(0, most))):
            rows.append((c, t, ["user", "assistant", None][int(rng.integers(0, 3))], [None, "", "ä", "hello"][int(rng.integers(0, 4))]))
    return rows


@pytest.mark.parametrize("seed, most", [(1, 6), (2, 12), (3, 40)])
def test_trie_against_brute_force(spark, seed, most):
    rows = _conversations(seed, 60, most)
    assert _trie(spark, rows) == trie(rows)


def test_trie_of_odd_rows(spark):
    long = [(100, t, "user", "same") for t in range(70)]
    rows = [*long, *[(101, t, "user", "same") for t in range(70)], *[(102, t, "user", "same") for t in range(64)]]
    rows += [(5, None, "b", "late"), (5, None, "a", "late"), (5, 1, None, None), (5, 1, "", ""), (5, 1, "", ""), (None, 0, "user", "lost"), (-7, 0, "user", "x"), (-7, 3, "u", "y" * 50_000)]
    rows += [(200, 0, "user", "only")] * 3 + [(c, 0, "user", "short") for c in range(300, 320)]
    assert _trie(spark, rows) == trie(rows)
    assert any(r[1] == 0 and r[7] != prefix_trie.EMPTY_SHA for r in trie(rows))


def test_trie_of_none_and_of_turnless_conversations(spark):
    assert _trie(spark, []) == []
    rows = [(c, 0, "user", "x") for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6]
    assert _trie(spark, rows) == trie(rows) and len(trie(rows)) == 1


def test_trie_ignores_other_columns_and_names_its_turns(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (100, 101, 102) for t in range(10)]
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, block int, key string")
    nodes = prefix_trie.conversation_trie(frame)
    assert sorted((tuple(r)[:8] for r in nodes.collect()), key=str) == trie(rows)
    named = nodes.join(prefix_trie.turn_texts(frame), "turn_id")
    assert {(r.depth, r.text) for r in named.collect()} == {(d, f"turn {d - 1}") for d in range(1, 11)}


def test_trie_equals_sql(spark):
    rows = _conversations(7, 80, 20) + [(None, 1, "user", "x")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(con.execute(prefix_trie.ORACLE).fetchall(), key=str)
    assert sorted((tuple(r)[:8] for r in found.collect()), key=str) == trie(rows)
