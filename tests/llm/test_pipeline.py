"""Each pipeline stage against its operator's rules on a small corpus, and the whole run."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline as pipeline
from test_suffix import brute_passages
from tidemark.llm.pii import find_spans, redacted

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in ("ala", "eno", "iru", "usa") for c in ("mos", "tik", "ran", "vel")]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    passage = text(120)
    rows, marks = [], []
    for i in range(160):
        body = text(int(rng.integers(30, 200)))
        if i % 8 == 0:
            body += " wretch " + text(5) + " wretch " + text(3)
        if i % 10 == 1:
            body = text(60) + " " + passage + " " + text(60)
        if i % 9 == 2:
            body += " mail ann@example.org or bob (at) example (dot) net"
        rows.append((i, body, "en", "s", len(body)))
        marks.append((i, 1, int(i % 8 == 0)))
    rows += [(200 + k, rows[3][1] + f" end{k}", "en", "s", 0) for k in range(5)] + [(300, rows[3][1], "en", "s", 0), (301, "", None, None, 0), (302, None, None, None, None)]
    out = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = pipeline.toxicity(spark, docs, folder)
    assert clean.columns == COLUMNS
    assert {r.doc_id for r in clean.collect()} == {i for i in texts if not (i < 160 and i % 8 == 0)}

    once = pipeline.near_duplicates(spark, clean, folder)
    assert once.columns == COLUMNS
    kept = {r.doc_id: r.text for r in once.collect()}
    assert set(kept) == {i for i in texts if not (i < 160 and i % 8 == 0)} - {200, 201, 202, 203, 204, 300}

    cut = pipeline.suffix_dedup(spark, once, folder)
    assert cut.columns == COLUMNS
    expected = dict(zip(kept, brute_passages(list(kept.items()), pipeline.PASSAGE_BYTES, pipeline.PASSAGE_WORDS)))
    for r in cut.collect():
        assert (r.text or "") == expected[r.doc_id]
        assert r.text is None or r.n_chars == len(r.text)
    assert sum(len(kept[i] or "") > len(e) for i, e in expected.items()) > 5

    masked = pipeline.pii(spark, cut, folder)
    assert masked.columns == COLUMNS
    before = {r.doc_id: r.text for r in cut.collect()}
    for r in masked.collect():
        spans = [dict(kind=k, start=a, stop=b) for k, a, b, _ in find_spans(before[r.doc_id])]
        assert r.text == redacted(before[r.doc_id], spans)
    assert any("[EMAIL]" in (r.text or "") for r in masked.collect())


def test_repeated_rows_leave_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id IN (1, 2)")
    left = pipeline.near_duplicates(spark, docs.unionByName(docs), folder)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2]


def test_ids_that_repeat_lose_only_copies(spark):
    x, y, z, n, m = (f"{w} one two three four five six seven" for w in "xyznm")
    rows = [(1, x), (1, y), (0, y), (2, z), (2, m), (2, m), (None, n), (None, n), (None, z), (3, ""), (3, " "), (None, ""), (None, None)]
    left = pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert left.columns == ["doc_id", "text"]
    found = sorted((str(r.doc_id), (r.text or "").strip()) for r in left.collect())
    assert found == sorted([("1", x), ("0", y), ("2", z), ("2", m), ("None", n), ("3", ""), ("3", ""), ("None", ""), ("None", "")])


def test_columns_of_clashing_names_and_no_rows(spark, folder):
    names = ["left_text", "_node", "first", "own", "_text", "_words", "row", "h", "id", "none", "node", "spans", "pii", "a.b"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 40 OR doc_id >= 200")
    wide = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    for stage in (pipeline.toxicity, pipeline.near_duplicates, pipeline.suffix_dedup, pipeline.pii):
        plain, more = stage(spark, docs, folder), stage(spark, wide, folder)
        assert more.columns == wide.columns
        assert sorted(map(tuple, more.select(docs.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        assert all(r[f"{n}"] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in more.collect() for n in names)
        assert stage(spark, docs.where("doc_id > 999"), folder).collect() == []
    assert pipeline.packing(spark, docs.where("doc_id > 999"), folder).collect() == []


def test_a_third_of_the_rows_with_one_id(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(60)]
    rows = [(7, t) for t in texts] + [(7, texts[0])] * 20 + [(100 + i, t + " more") for i, t in enumerate(texts[:30])] + [(1, texts[5])]
    left = pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "")
    assert sorted(map(tuple, left.collect())) == sorted([(7, t) for i, t in enumerate(texts) if i != 5] + [(1, texts[5])])


def test_run(spark, folder):
    pieces = pipeline.run(spark, folder).collect()
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(pieces[0].asDict())
    assert len({r.doc_id for r in pieces}) == 168 - 20 - 6
