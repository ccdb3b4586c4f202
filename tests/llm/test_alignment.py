"""Cross-tokenizer alignment against a plain version over the tokenizers' own libraries."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import alignment, bpe
from tidemark.llm.pieces import default_model

FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _tokens(text):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = bpe._byte_of_letter()
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    return a, b


def brute(rows):
    """The contract, row by row."""
    groups_of, held = [], defaultdict(set)
    for row, (_, text) in enumerate(rows):
        a, b = _tokens(text) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a, b = [], []
        ends = [set(np.cumsum([len(t) for _, t in side]).tolist()) if side else set() for side in (a, b)]
        both, groups = sorted(ends[0] & ends[1]), []
        for side in (a, b):
            at, cut = 0, [[] for _ in both]
            for i, t in side:
                at += len(t)
                cut[next(k for k, e in enumerate(both) if at <= e)].append(i)
            groups.append(cut)
        groups_of.append((len(a), len(b), list(zip(*groups))))
        for x, y in groups_of[-1][2]:
            for i in x:
                for j in y:
                    held[i, j].add(row)
    count = {p: len(r) for p, r in held.items()}
    highest = defaultdict(int)
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    out = []
    for (doc_id, _), (n_a, n_b, groups) in zip(rows, groups_of):
        pairs = [(i, j) for x, y in groups for i in x for j in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, len(groups), len(pairs), sum(count[p] == highest[p[0]] for p in pairs), sum(count[p] for p in pairs), sha))
    return sorted(out, key=str)


ROWS = [
    (1, "the cat sat on the mat, the cat sat"),
    (2, "the cat <s> sat </s> <|endoftext|> <unk>"),
    (3, "naïve façade 東京 ☃ zażółć \t two\n\nlines  and   spaces "),
    (4, "a literal ▁ mark"),
    (5, ""),
    (6, None),
    (7, " "),
    (7, "the cat sat on the mat, the cat sat"),
    (None, "the cat"),
    (None, "the cat"),
    (8, "0x 12345678901234567890 \u0000     é"),
    (9, "   leading, and the cat " * 30),
    (10, "𐍈𐍈𐍈𐍈 \U0001f600\U0001f600 ab﻿cd"),
]


def _frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def test_against_brute_force(spark):
    got = alignment.alignment_scores(_frame(spark, ROWS))
    assert got.columns == FIELDS
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_real_texts_by_small_slices_and_spans(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.orderBy("doc_id").collect()][:60]
    monkeypatch.setattr(alignment, "SLICE_CHARS", 700)
    monkeypatch.setattr(alignment, "SLICE_PAIRS", 300)
    monkeypatch.setattr(alignment, "ENTRIES", 900)
    path = bpe.default_path(), default_model()
    writer = alignment.Writer(0, alignment.vocabularies(*path))
    batches = [b for row in rows for b in writer.add(*row)] + list(writer.flush())
    table = pa.Table.from_batches(batches)
    documents = [r for r in table.to_pylist() if r["ordinal"] is not None]
    expected = {r[0]: r for r in brute(rows)}
    for r in documents:
        assert tuple(r[c] for c in FIELDS[:5]) == expected[r["doc_id"]][:5] and r["groups_sha256"] == expected[r["doc_id"]][7]
    assert len({r["span"] for r in documents}) > 3
    # the same postings, whatever the slices
    whole = {(p.first_id, p.second_id): (p.documents, p.links) for p in alignment.align(spark.createDataFrame(rows, "doc_id long, text string")).pairs().collect()}
    cut: Counter = Counter()
    times: Counter = Counter()
    for r in table.to_pylist():
        if r["pair"] is not None:
            pair = r["pair"] >> 20, r["pair"] & (1 << 20) - 1
            cut[pair] += r["documents"]
            times[pair] += r["links"]
            sets = [set(alignment.members(p).tolist()) for p in r["planes"]]
            assert len(set().union(*sets)) == r["documents"] and sum(len(s) << k for k, s in enumerate(sets)) == r["links"]
    assert whole == {p: (cut[p], times[p]) for p in cut}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 65535), st.integers(1, 9)), min_size=1, max_size=300))
def test_planes_hold_the_multiplicities(entries):
    counts = Counter()
    for pair, ordinal, times in entries:
        counts[pair, ordinal] += times
    keys = np.array(sorted(p << 16 | o for p, o in counts), np.int64)
    times = np.array([counts[k >> 16, k & 65535] for k in keys.tolist()], np.int64)
    pairs, documents, planes = alignment.planes_of(keys, times)
    for pair, n, held in zip(pairs.tolist(), documents.tolist(), planes.to_pylist()):
        back: Counter = Counter()
        for k, plane in enumerate(held):
            for o in alignment.members(plane).tolist():
                back[o] += 1 << k
        assert back == {o: t for (p, o), t in counts.items() if p == pair} and len(back) == n


def test_a_dense_plane_is_a_bitmap():
    keys = np.arange(60_000, dtype=np.int64)
    _, documents, planes = alignment.planes_of(np.append(keys, (1 << 16) + 3), np.append(np.full(60_000, 3), 2))
    first, second = planes.to_pylist()
    assert documents.tolist() == [60_000, 1] and [len(p) for p in first] == [8192, 8192] and [len(p) for p in second] == [0, 2]
    assert (alignment.members(first[1]) == keys).all()


@pytest.mark.parametrize("text", ["word " * 4000, "x" * 3000 + " y" * 900, "a  b   c \n d " * 500])
def test_parts_of_a_long_text_encode_like_the_whole(text):
    pair = alignment.vocabularies(bpe.default_path(), default_model())
    parts = list(alignment.slices(text, 1000))
    assert len(parts) > 1
    for vocabulary in (pair.first, pair.second):
        assert sum((list(vocabulary.encode(p)) for p in parts), []) == list(vocabulary.encode(text))


def test_a_group_without_borders_in_bounded_rounds(spark, monkeypatch):
    rows = [(1, "☃" * 40 + "é" * 30), (2, "☃" * 40 + "é" * 30 + "x")]
    monkeypatch.setattr(alignment, "SLICE_PAIRS", 3)
    pair = alignment.vocabularies(bpe.default_path(), default_model())
    small = alignment.align_parts([(i, a, b) for i, (_, t) in enumerate(rows) for a, b in alignment.encoded(t, pair)], pair)
    monkeypatch.undo()
    large = alignment.align_parts([(i, a, b) for i, (_, t) in enumerate(rows) for a, b in alignment.encoded(t, pair)], pair)
    assert dict(zip(small.keys.tolist(), small.times.tolist())) == dict(zip(large.keys.tolist(), large.times.tolist()))
    assert small.times.sum() == small.n_links.sum()


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment_scores(empty).collect() == []
    extra = spark.createDataFrame([(1, "the cat", 5, "q")], "doc_id long, text string, span int, planes string")
    assert sorted(map(tuple, alignment.alignment_scores(extra).collect())) == brute([(1, "the cat")])
    nothing = alignment.alignment_scores(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"))
    assert sorted(map(tuple, nothing.collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
