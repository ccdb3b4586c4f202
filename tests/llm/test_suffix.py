"""Repeats of byte strings against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.suffix_dedup import intervals, removed_repeats, repeat_groups


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (doc_id, _), r in zip(rows, raws):
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(gone.astype(int)) == 1).sum() + gone[0])
        left = bytes(b for b, g in zip(r, gone) if not g)
        out.append((doc_id, len(r), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def brute_passages(rows, length, words, across=True):
    """Texts without the runs of repeated strings that hold so many whole words; rows differ in doc_id or text."""
    space = b" \t\n\x0b\x0c\r"
    raws = [(t or "").encode() for _, t in rows]
    seen = {}
    for row, r in zip(rows, raws):
        for i in range(len(r) - length + 1):
            seen.setdefault(r[i : i + length], []).append(row)
    left = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            held = seen[r[i : i + length]]
            if len(set(held) if across else held) > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0)).reshape(-1, 2).tolist()
        out, at = b"", 0
        for a, b in edges:
            if words and a and r[a - 1] not in space:
                while a < b and r[a] not in space:
                    a += 1
            if words and b < len(r) and r[b] not in space:
                while b > a and r[b - 1] not in space:
                    b -= 1
            if len(r[a:b].split()) >= words:
                out, at = out + r[at:a], b
        left.append((out + r[at:]).decode("utf-8", "ignore"))
    return left


def corpus(rng, length):
    letters = list("abcdéß \n")
    text = lambda n: "".join(rng.choice(letters, n))
    shared = [text(length * 2), text(length + 3), text(length), text(length - 1)]
    rows = []
    for i in range(60):
        parts = [text(int(rng.integers(0, 3 * length)))]
        for _ in range(int(rng.integers(0, 4))):
            s = shared[int(rng.integers(len(shared)))]
            a = int(rng.integers(0, 5))
            parts += [s[a : len(s) - int(rng.integers(0, 4))], text(int(rng.integers(0, length)))]
        rows.append("".join(parts))
    rows += [rows[3], rows[3], "x" * (3 * length), "ab" * length, "x" * (length + 5), "y" * length, "y" * length, "z" * (length - 1), "z" * (length - 1), "", None]
    rows += [rows[5][: len(rows[5]) // 2] + "!" + rows[5][len(rows[5]) // 2 :]]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("length", "gram", "crowd"), [(40, 12, 4096), (40, 12, 2), (24, 24, 4096), (400, 128, 4096)])
def test_removal_equals_brute_force(spark, length, gram, crowd):
    rows = corpus(np.random.default_rng(length + crowd), length)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS gram", "3 AS n_bytes").repartition(3)
    found = sorted((tuple(r) for r in removed_repeats(df, length, gram, crowd).collect()), key=str)
    assert found == brute(rows, length)


@pytest.mark.parametrize("crowd", [4096, 2])
def test_equal_rows_and_null_ids_come_out_once(spark, crowd):
    rows = [t for _, t in corpus(np.random.default_rng(7), 40)]
    rows = [(i, t) for i, t in enumerate(rows)] + [(2, rows[2])] * 4 + [(None, rows[4])] * 3 + [(70 + i, rows[2]) for i in range(2)] + [(None, "n" * 41 + "m" * 30)] * 2 + [(90, rows[1]), (90, rows[6]), (90, rows[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in removed_repeats(df, 40, 12, crowd).collect()), key=str) == brute(rows, 40)
    assert sorted(str(r.doc_id) for r in removed_repeats(df, 40, 12, crowd, keep_text=True).collect()) == sorted(str(i) for i, _ in rows)


def test_kept_text_and_columns(spark):
    shared = "".join(np.random.default_rng(1).choice(list("abcd "), 90))
    rows = [(1, "é" + shared + "tail", "a"), (2, "head" + shared, "b"), (3, None, "c"), (None, "short", None), (1, "other", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = removed_repeats(df, 40, 12, keep_text=True)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "étail", "a"), (2, "head", "b"), (3, None, "c"), (None, "short", None), (1, "other", "d")], key=str)
    assert removed_repeats(df.where("doc_id > 9"), 40, 12).count() == 0


@pytest.mark.parametrize(("crowd", "across", "words"), [(4096, True, 0), (2, True, 0), (4096, True, 9), (2, True, 9), (4096, False, 9)])
def test_passages_across_documents(spark, crowd, across, words):
    rows = [t for _, t in corpus(np.random.default_rng(11), 40)]
    rows = [(i, t) for i, t in enumerate(rows)] + [(2, rows[2])] * 3 + [(None, rows[4])] * 3 + [(300, "own words here " * 9), (301, ("shared by two " * 4) * 2), (302, "x " + ("shared by two " * 4) * 2 + "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = removed_repeats(df, 40, 12, crowd, keep_text=True, across=across, words=words)
    expected = [(i, t if t is None else e) for (i, t), e in zip(rows, brute_passages(rows, 40, words, across))]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(expected, key=str)
    if across and words:
        assert (300, "own words here " * 9) in expected and (302, "xy") in expected


def test_columns_of_clashing_names(spark):
    names = ["left_text", "_node", "node", "n_bytes", "_n_bytes", "raw", "row", "spans", "a.b"]
    rows = [(i, "q" * i + "same" * 30, *[f"{n}{i}" for n in names]) for i in range(2)] + [(5, None, *names)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    kept = removed_repeats(spark.createDataFrame(rows, schema), 40, 12, keep_text=True)
    assert kept.columns == ["doc_id", "text", *names]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(0, "", *rows[0][2:]), (1, "q", *rows[1][2:]), rows[2]], key=str)


def test_intervals_and_groups():
    assert list(intervals([2, 1, 0, 3])) == [(2, 0, 1), (1, 0, 2), (3, 3, 4), (0, 0, 4)]
    words = [b"xabcab", b"yabcad", b"xabc", b"zq"]
    groups = {(left, right, tuple(sorted(m))) for left, right, m in repeat_groups([w[:1] for w in words], [w[1:] for w in words], 0)}
    assert (0, 3, (0, 1, 2)) in groups and (1, 3, (0, 2)) in groups and (0, 4, (0, 1)) in groups
