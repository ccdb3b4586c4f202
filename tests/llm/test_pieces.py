"""Sampled SentencePiece segmentations: lossless, reproducible, drawn with the right probabilities."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tidemark.llm.pieces import decode, default_model, encode_sampled, pieces_of, sample

NASTY = ["", " ", "   ", "a", " a  b ", "naïve\n\n x", "▁ ▁x▁", "東京 🙂\x00\x1f", "<s> </s> <unk> <0x41>", "\n", "tab\tcr\r\nend ", "x" * 3000, "été " * 500, "▁", "a b"]


@pytest.fixture(scope="module")
def model():
    return pieces_of(default_model())


def test_round_trip_and_reproducibility(spark):
    rows = list(enumerate(NASTY)) + [(100, None), (None, "null id"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n_pieces")
    one = encode_sampled(df.repartition(5))
    back = {(r.doc_id, r.text) for r in decode(one).collect()}
    assert back == {(i, t or "") for i, t in rows}
    again = {(r.doc_id, bytes(r.ids)) for r in encode_sampled(df.coalesce(1)).collect()}
    assert again == {(r.doc_id, bytes(r.ids)) for r in one.collect()}
    assert {(r.doc_id, bytes(r.ids)) for r in encode_sampled(df, seed=1).collect()} != again
    assert encode_sampled(df.where("doc_id < -1")).count() == 0


def all_ways(text, model, alpha):
    table = {}
    for i, raw in enumerate(model.raw):
        if raw and i not in set(model.byte_ids.tolist()):
            table[raw.decode()] = i
    out = {}

    def walk(at, ids, weight):
        if at == len(text):
            out[ids] = weight
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in table:
                k = table[text[at:end]]
                walk(end, (*ids, k), weight + alpha * model.log_weight[k])

    walk(0, (), 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {ids: float(np.exp(w - total)) for ids, w in out.items()}


@pytest.mark.parametrize("alpha", [0.2, 0.6])
def test_draws_follow_the_lattice(model, alpha):
    exact = all_ways(" there", model, alpha)
    n = 40_000
    drawn = Counter(tuple(x.tolist()) for x in sample(["there"] * n, np.arange(n, dtype=np.uint64) * np.uint64(977), model, alpha))
    assert set(drawn) <= set(exact)
    for ids, p in exact.items():
        assert abs(drawn[ids] / n - p) < 0.012
