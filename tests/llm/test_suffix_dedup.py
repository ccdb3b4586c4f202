"""Texts and spans reach Python objects a few rows at a time."""

from __future__ import annotations

import pyarrow as pa

from tidemark.llm import suffix_dedup
from tidemark.llm.suffix_dedup import removed_repeats


def test_batches_are_handled_in_slices():
    batch = pa.record_batch({"x": list(range(700))})
    parts = list(suffix_dedup._few([batch, batch.slice(0, 0), batch.slice(0, 3)]))
    assert max(p.num_rows for p in parts) <= 256
    assert [v for p in parts for v in p.column("x").to_pylist()] == [*range(700), 0, 1, 2]


def test_more_texts_than_a_slice_share_a_passage(spark):
    passage = "".join(chr(97 + i * i % 23) for i in range(90))
    docs = spark.createDataFrame([(i, f"{i:04d}{passage}{9999 - i}") for i in range(600)], "doc_id long, text string").coalesce(1)
    found = removed_repeats(docs, length=60, gram=16).collect()
    assert len(found) == 600 and {(r.n_bytes, r.n_removed >= 90, r.n_spans) for r in found} == {(98, True, 1)}
