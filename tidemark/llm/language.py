"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 5)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, held_out, once_per_worker

BUCKETS, GRAMS, SMOOTHING = 1 << 16, (2, 3), 0.5
#: About so many labelled rows at most are learned from, chosen by a hash of doc_id and text; languages
#: that a model holds at most, those with the most rows of the sample (a row of the matrix is BUCKETS numbers).
TRAIN_ROWS, MOST_LANGUAGES = 40_000, 256
_CHUNK = 500_000


def _letters() -> np.ndarray:
    """Code point -> itself if a letter, else a space."""
    return once_per_worker("letters", lambda: np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x110000)), np.uint32, 0x110000))


def grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n the buckets of the n-grams within each text, one text after the other, and where each text's begin."""
    padded = [f" {t.lower()}  " for t in texts]
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    codes = _letters()[np.frombuffer("".join(padded).encode("utf-32-le"), "<u4")]
    stops = np.cumsum(lengths)
    out = []
    for n in GRAMS:
        h = np.full(len(codes) - n + 1, n, np.uint32)
        for k in range(n):
            h = (h ^ codes[k : len(codes) - n + 1 + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        within = np.ones(len(codes), bool)
        for k in range(1, n):
            within[stops - k] = False  # would go on into the next text
        h = h[within[: len(h)]]
        out.append((((h * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64), stops - lengths - np.arange(len(texts)) * (n - 1)))
    return out


@dataclass
class Model:
    langs: list[str]
    log_prob: np.ndarray  # bucket x language
    log_prior: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        """Log joint probability, text x language."""
        out = np.tile(self.log_prior, (len(texts), 1))
        for h, starts in grams(texts):
            out += np.add.reduceat(self.log_prob[h], starts, axis=0)
        return out


def _slices(lengths: list[int]) -> list[slice]:
    cuts, held = [0], 0
    for i, n in enumerate(lengths):
        if held and held + n > _CHUNK:
            cuts.append(i)
            held = 0
        held += n
    return [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(lengths)])]


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from (text, lang) of rows that are not held out. Each task sends one count vector per language it saw."""
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # the sample is dealt out by doc_id and text already, as equal rows are taken once
    rows = bounded_sample(labelled.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string")), train_rows, "doc_id", "text").select("text", "lang")
    most = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    rows = rows.where(F.col("lang").isin([r.lang for r in most.collect()]))

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in batches:
            texts, langs = (c.to_pylist() for c in batch.columns)
            for text, lang in zip(texts, langs):
                held = counts.setdefault(lang, np.zeros(BUCKETS, "<i8"))
                n_docs[lang] = n_docs.get(lang, 0) + 1
                for h, _ in grams([text]):
                    held += np.bincount(h, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([n_docs[x] for x in counts], pa.int64()), pa.array([x.tobytes() for x in counts.values()], pa.binary())], names=["lang", "n_docs", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<i8") for x in table["counts"])
        return pa.table({"lang": table["lang"][:1], "n_docs": [sum(table["n_docs"].to_pylist())], "counts": [total.tobytes()]})

    schema = "lang string, n_docs long, counts binary"
    found = rows.mapInArrow(count, schema).groupBy("lang").applyInArrow(add, schema).orderBy("lang").collect()  # one row per language
    if not found:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    counts = np.array([np.frombuffer(r["counts"], "<i8") for r in found], float) + SMOOTHING
    n_docs = np.array([r["n_docs"] for r in found], float)
    return Model([r["lang"] for r in found], np.log(counts / counts.sum(1, keepdims=True)).T.astype(np.float32).copy(), np.log(n_docs / n_docs.sum()))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior of the prediction).

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned; ties go to the first language by
    name. Whole texts are read; equal rows are scored alike; extra columns are ignored; an empty table gives no rows.
    The broadcast matrix has ``BUCKETS`` rows and a column per language.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.log_prob, model.log_prior))

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        model = Model(*shared.value)
        values = ["" if t is None else t for t in texts]
        lang, score = ["und"] * len(values), np.zeros(len(values))
        some = [i for i, t in enumerate(values) if model.langs and any(map(str.isalpha, t))]
        for part in _slices([len(values[i]) for i in some]) if some else []:
            log = model.score([values[i] for i in some[part]])
            best = log.argmax(1)
            posterior = 1 / np.exp(log - log.max(1, keepdims=True)).sum(1)
            for i, b, p in zip(some[part], best.tolist(), posterior.tolist()):
                lang[i], score[i] = model.langs[b], p
        return pd.DataFrame({"lang_pred": lang, "score": score})

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), guess(F.col("text").cast("string")).alias("g"))
    return scored.select("doc_id", "held_out", "g.lang_pred", "g.score")


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    return predict(docs, fit(docs, train_rows))
