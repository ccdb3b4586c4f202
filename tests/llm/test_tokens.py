"""Packing and token counts against plain encoding by the tokenizers library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import pack
from tidemark.llm.token_counts import EDITS, CountTree, count_edited, quarter_revisions, revise, usable_edits, with_edits

WORDS = "Le été naïf, don't  stop; 12345 \n\n x=1\t\tend. They're 東京 🙂   \x1c q "


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, (WORDS * (i * 7 % 40))[: i * 97 + 3], "s") for i in range(60)]
    rows += [(100, None, None), (101, "", "s"), (102, WORDS * 400, "s"), (103, "a" * 9000, "s"), (None, "no id", "s"), (5, rows[5][1], "s"), (104, " <|endoftext|> x", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def check_pieces(pieces, texts, plain, size):
    rows = [r.asDict() for r in pieces.collect()]
    held, seqs = {}, {}
    for r in rows:
        held.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    assert set(held) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*plain(text), 1], "<u4")
        own = sorted(held[doc_id], key=lambda r: r["start"])
        copies = sum(r["start"] == 0 for r in own)
        assert sum(r["length"] for r in own) == copies * len(ids)
        for r in own:
            assert r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    waste = 0
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        waste += 0 if at & (at - 1) == 0 else size - at
    assert waste <= 0.02 * sum(r["length"] for r in rows)


@pytest.mark.parametrize(("open_windows", "fan_in"), [(16, 32), (2, 2)])
def test_pack_holds_each_id_once(docs, plain, open_windows, fan_in):
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_pieces(pack(docs, open_windows=open_windows, fan_in=fan_in), texts, plain, 2048)


def test_pack_small_windows_keep_ids(docs, plain):
    rows = pack(docs.where("doc_id = 102"), size=64, keep_ids=True).orderBy("start").collect()
    assert np.frombuffer(b"".join(r.ids for r in rows), "<u4").tolist() == [*plain(WORDS * 400), 1]


def test_pack_empty_table_and_clashing_columns(spark, docs):
    assert pack(docs.where("doc_id < -1")).count() == 0
    extra = docs.where("doc_id = 3").selectExpr("*", "1 AS start", "2 AS ids", "3 AS left_by")
    assert pack(extra).count() >= 1


def test_counts_after_edits_equal_full_encoding(spark, docs, plain):
    revised = quarter_revisions(docs.where("doc_id IS NOT NULL")).collect()
    found = {r.doc_id: r for r in count_edited(quarter_revisions(docs), leaf_chars=20).collect()}
    for r in revised:
        text = r.text or ""
        assert found[r.doc_id].n_tokens_before == len(plain(text))
        assert found[r.doc_id].n_tokens_after == len(plain(edited(text, usable_edits([e.asDict() for e in r.edits], len(text)))))
    assert found[102].n_chars_again < 300


def edited(text, edits):
    for start, stop, new in reversed(edits):
        text = text[:start] + new + text[stop:]
    return text


def test_counts_random_edits(spark, plain):
    rng = np.random.default_rng(5)
    docs, edits = [], []
    for i in range(60):
        text = "".join(rng.choice(list(WORDS), 200))
        docs.append((i, text))
        for _ in range(4):
            a = int(rng.integers(-2, 205))
            edits.append((i, a, a + int(rng.integers(0, 9)), "".join(rng.choice(list(WORDS + "    "), 5))))
    edits += [(0, None, 3, "x"), (7, 1, 2, None)]
    df = with_edits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(edits, "doc_id long, start long, stop long, text string"))
    found = {r.doc_id: r for r in count_edited(df, leaf_chars=6).collect()}
    for i, text in docs:
        own = usable_edits([dict(start=e[1], stop=e[2], text=e[3]) for e in edits if e[0] == i], len(text))
        assert found[i].n_edits == len(own)
        assert found[i].n_tokens_after == len(plain(edited(text, own)))


def test_revisions_in_a_row_encode_only_what_they_touch(spark, plain):
    rng = np.random.default_rng(6)
    texts = {i: "".join(rng.choice(list(WORDS), int(rng.integers(0, 1500)))) for i in range(30)}
    state = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for revision in range(4):
        edits = {}
        for i, text in texts.items():
            edits[i] = []
            for _ in range(2):
                a = int(rng.integers(0, len(text) + 1))
                new = "".join(rng.choice(list(WORDS + "     "), int(rng.integers(0, 90))))
                edits[i].append((a, a + int(rng.integers(0, 60)), new))
        if revision == 2:  # all of a text goes, and one grows from nothing
            edits[0], edits[1] = [(0, len(texts[0]), "")], [(0, len(texts[1]), WORDS * 20)]
        column = spark.createDataFrame([(i, e) for i, e in edits.items()], f"doc_id long, edits {EDITS}")
        found = revise(state.join(column, "doc_id"), leaf_chars=16)
        rows = {r.doc_id: r for r in found.collect()}
        for i, text in texts.items():
            own = usable_edits([dict(start=a, stop=b, text=t) for a, b, t in edits[i]], len(text))
            after, r = edited(text, own), rows[i]
            assert (r.n_tokens_before, r.n_tokens_after, r.text) == (len(plain(text)), len(plain(after)), after)
            assert sum(x.tokens for x in r.leaves) == r.n_tokens_after and sum(x.chars for x in r.leaves) == len(after)
            assert r.n_chars_encoded == r.n_chars_again + (len(text) if revision == 0 else 0)
            texts[i] = after
        long = [r for i, r in rows.items() if len(texts[i]) > 1000 and revision != 2]
        assert all(r.n_chars_again < 600 for r in long)
        state = spark.createDataFrame([(i, r.text, [tuple(x) for x in r.leaves]) for i, r in rows.items()], "doc_id long, text string, leaves array<struct<chars:int,tokens:int>>")


def test_leaves_that_do_not_fit_are_built_anew(spark, plain):
    rows = [(1, "some words", [(3, 1)], None), (2, None, None, None), (3, "more words", [(10, None)], [(0, 4, "less")])]
    df = spark.createDataFrame(rows, f"doc_id long, text string, leaves array<struct<chars:int,tokens:int>>, edits {EDITS}")
    found = {r.doc_id: r for r in revise(df).collect()}
    assert (found[1].n_tokens_after, found[1].n_chars_encoded, found[2].n_tokens_after) == (len(plain("some words")), 10, 0)
    assert (found[3].text, found[3].n_tokens_after) == ("less words", len(plain("less words")))
    assert revise(df.where("doc_id > 9")).collect() == []


def test_sums_of_subtrees(plain):
    from tidemark.llm import bpe

    tree = CountTree(bpe.default_path(), WORDS * 30, 8)
    counts = [n for _, n in tree.leaves]
    assert [tree.tokens_before(i) for i in range(len(counts))] == [sum(counts[:i]) for i in range(len(counts))]
    tree.apply([(5, 6, "x")])
    counts = [n for _, n in tree.leaves]
    assert [tree.tokens_before(i) for i in range(len(counts))] == [sum(counts[:i]) for i in range(len(counts))] and tree.total == len(plain(tree.text))
