"""Toxicity by a weighted finite-state pattern grammar over clauses (operator 7)."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.llm.common import bounded_sample, held_out

#: About so many labelled rows at most are learned from, chosen by a hash of doc_id and text.
TRAIN_ROWS, TRAIN_TASKS, THRESHOLD = 20_000, 16, 0.3
#: An insult stem needs so many toxic documents (and so many in a thousand of them), so much more weight (log odds) in
#: toxic documents than in others, and different words before it in most documents: copied texts repeat theirs.
LEAST_DOCS, LEAST_PER_MILLE, LEAST_ODDS = 3, 15, 4.0
CONTEXTS, CONTEXT_SHARE = 16, 0.6
#: A longer stem replaces a shorter one if its log odds are so much better.
BETTER_BY = 1.0
PREFIXES = (4, 5, 6)
WINDOW = 4

# Function words of the grammar in English, German, French and Spanish.
TARGETS = "you your u ur yourself du dich dir dein deine ihr euch tu te toi ton ta vous votre usted ustedes tú vos eres".split()
NEGATIONS = "not no never isn aren wasn don doesn nicht kein keine nie pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says say called calls wrote writes claimed claims quoted quote sagte sagt nannte schrieb dit appelle écrit dijo dice llamó escribió".split()
THREATS = "kill hurt destroy beat shoot stab strangle murder töten umbringen verprügeln tuer frapper détruire matar golpear destruir".split()

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;\n]+")
#: What a matched clause can be; the weights before any row is seen, and how many rows they count for.
EVENTS = ("insult", "aimed", "negated", "reported", "threat")
PRIOR_WEIGHT, PRIOR_ROWS = np.array([-3.0, 4.0, 5.0, 0.5, 1.0, 4.0]), 0.5


class Transducer:
    """A deterministic transducer: ``step[state, symbol]`` is (state, output); a symbol not named keeps the state."""

    def __init__(self, step: dict[tuple, tuple], idle: dict | None = None) -> None:
        self.step, self.idle = step, idle or {}

    def move(self, state, symbol):
        return self.step.get((state, symbol)) or (self.idle.get(state, state), None)


def near(mark: str, window: int) -> Transducer:
    """Outputs ``mark`` on an insult or threat that follows a ``mark`` symbol within ``window`` words."""
    step = {(d, mark): (window, None) for d in range(window + 1)}
    step |= {(d, s): (d - 1, mark) for d in range(1, window + 1) for s in ("insult", "threat")}
    return Transducer(step, {d: max(0, d - 1) for d in range(window + 1)})


def since(mark: str) -> Transducer:
    """Outputs ``mark`` on an insult or threat anywhere after a ``mark`` symbol of the clause."""
    return Transducer({(0, mark): (1, None)} | {(1, s): (1, mark) for s in ("insult", "threat")})


class Grammar:
    """The composition of the four context transducers: one state for all, one table of moves, built as it is needed."""

    def __init__(self) -> None:
        self.parts = (near("target", WINDOW), near("negation", WINDOW - 1), since("report"))
        self.moves: dict[tuple, tuple] = {}

    def move(self, state: tuple, symbol: str) -> tuple[tuple, frozenset]:
        if (state, symbol) not in self.moves:
            got = [p.move(s, symbol) for p, s in zip(self.parts, state)]
            self.moves[state, symbol] = tuple(s for s, _ in got), frozenset(o for _, o in got if o)
        return self.moves[state, symbol]

    def clause(self, symbols: list[str]) -> list[tuple[int, str]]:
        """(place, event) for each insult and threat; a target may also follow within the window."""
        state, out = (0, 0, 0), []
        for at, symbol in enumerate(symbols):
            state, marks = self.move(state, symbol)
            if symbol not in ("insult", "threat"):
                continue
            aimed = "target" in marks or "target" in symbols[at + 1 : at + 1 + WINDOW]
            if "report" in marks:
                out.append((at, "reported"))
            elif "negation" in marks:
                out.append((at, "negated"))
            elif symbol == "threat":
                out += [(at, "threat")] * aimed
            else:
                out.append((at, "aimed" if aimed else "insult"))
        return out


@dataclass
class Model:
    stems: dict[str, float]  # word or prefix* -> log odds
    weights: np.ndarray = field(default_factory=lambda: PRIOR_WEIGHT.copy())  # bias, then EVENTS

    def __post_init__(self) -> None:
        self.symbols = {w: "threat" for w in THREATS} | {w: "report" for w in REPORTS} | {w: "negation" for w in NEGATIONS} | {w: "target" for w in TARGETS}
        self.words = {s for s in self.stems if not s.endswith("*")}
        self.prefixes = {s[:-1] for s in self.stems if s.endswith("*")}
        self.lengths = sorted({len(s) for s in self.prefixes})
        self.grammar = Grammar()

    def insult(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.prefixes for n in self.lengths)

    def symbol(self, word: str) -> str:
        return "insult" if self.insult(word) else self.symbols.get(word, "")

    def has_hit(self, words: list[str]) -> bool:
        own = set(words)
        if not own.isdisjoint(self.words) or not own.isdisjoint(THREATS):
            return True
        return any(not self.prefixes.isdisjoint([w[:n] for w in own]) for n in self.lengths)

    def events(self, text: str) -> np.ndarray:
        """Square roots of how many clauses have each event: many matches add less and less."""
        low = text.lower()
        counts = Counter()
        if self.has_hit(_WORD.findall(low)):
            for clause in _CLAUSE.split(low):
                words = _WORD.findall(clause)
                if self.has_hit(words):
                    counts.update({event for _, event in self.grammar.clause([self.symbol(w) for w in words])})
        return np.sqrt([counts[e] for e in EVENTS])

    def scores(self, events: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weights[0] + events @ self.weights[1:])))


def _features(text: str) -> dict[str, set[str]]:
    """Whole words and word beginnings of a text, each with the words before it."""
    out: dict[str, set[str]] = {}
    before = ""
    for w in _WORD.findall(text.lower()):
        if len(w) >= PREFIXES[0]:
            for f in (w, *(f"{w[:n]}*" for n in PREFIXES if len(w) > n)):
                out.setdefault(f, set()).add(before)
        before = w
    return out


def _learn_stems(rows: DataFrame) -> dict[str, float]:
    """Insult stems by log odds of documents. Stems known from few contexts, such as words of copied texts, are left out."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def toxic(batches):
        docs, contexts = Counter(), {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for f, before in _features(text).items():
                    docs[f] += 1
                    held = contexts.setdefault(f, set())
                    if len(held) < CONTEXTS:
                        held.add(min(before))
        yield pa.RecordBatch.from_arrays([pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64()), pa.array([sorted(contexts[f]) for f in docs], pa.list_(pa.string()))], names=["stem", "n", "before"])

    least = max(LEAST_DOCS, n_toxic * LEAST_PER_MILLE / 1000)
    found = (
        rows.where("toxic = 1").select("text").mapInArrow(toxic, "stem string, n long, before array<string>")
        .groupBy("stem").agg(F.sum("n").alias("n"), F.size(F.array_distinct(F.flatten(F.collect_list("before")))).alias("contexts"))
        .where((F.col("n") >= least) & (F.col("contexts") >= CONTEXT_SHARE * F.least("n", F.lit(CONTEXTS)))).select("stem", "n")
    )
    candidates = {r["stem"]: r["n"] for r in found.collect()}  # from a sample of bounded size
    shared = rows.sparkSession.sparkContext.broadcast(set(candidates))

    def clean(batches):
        docs = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                docs.update(shared.value.intersection(_features(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64())], names=["stem", "n"])

    counted = rows.where("toxic = 0").select("text").mapInArrow(clean, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))
    in_clean = {r["stem"]: r["n"] for r in counted.collect()}
    odds = {s: float(np.log((n + 0.5) / (n_toxic + 1)) - np.log((in_clean.get(s, 0) + 0.5) / (n_clean + 1))) for s, n in candidates.items()}
    strong = {s: o for s, o in odds.items() if o >= LEAST_ODDS}
    for stem in sorted(strong, key=len, reverse=True):  # of stems that begin alike, keep the ones that tell most
        own = strong.get(stem)
        shorter = [f for n in PREFIXES if (f := f"{stem[:n]}*") in strong and f != stem and n < len(stem.rstrip("*"))]
        if own is not None and shorter:
            if own >= max(strong[f] for f in shorter) + BETTER_BY:
                for f in shorter:
                    del strong[f]
            else:
                del strong[stem]
    return strong


def _learn_weights(events: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Logistic weights of the events, drawn towards the grammar's own, by Newton's method."""
    x = np.hstack([np.ones((len(events), 1)), events])
    w = PRIOR_WEIGHT.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (n * (toxic - p)) - PRIOR_ROWS * (w - PRIOR_WEIGHT)
        hessian = (x.T * (n * p * (1 - p))) @ x + PRIOR_ROWS * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    return w


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn insult stems and event weights from labelled rows that are not held out (a sample of bounded size)."""
    marks = labels.where("toxic IN (0, 1)").groupBy(F.col("doc_id").alias("label_doc")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = bounded_sample(marks.where(~held_out(F.col("label_doc"))), train_rows, "label_doc")  # then rows: a doc_id may have many
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    marked = staged(texts.join(marks, F.col("doc_id") == F.col("label_doc")).select("doc_id", "text", "toxic"), "toxic-marked")
    rows = staged(bounded_sample(marked, train_rows, "doc_id", "text").select("text", "toxic").repartition(TRAIN_TASKS, F.xxhash64("text")), "toxic-train")
    model = Model(_learn_stems(rows))
    shared = rows.sparkSession.sparkContext.broadcast((model.stems, model.weights))

    def events(batches):
        counts, model = Counter(), Model(*shared.value)
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                counts[(toxic, *model.events(text).tolist())] += 1
        yield pa.RecordBatch.from_arrays([pa.array([int(k[0]) for k in counts], pa.int32()), pa.array([list(k[1:]) for k in counts], pa.list_(pa.float64())), pa.array(list(counts.values()), pa.int64())], names=["toxic", "events", "n"])

    seen = rows.select("text", "toxic").mapInArrow(events, "toxic int, events array<double>, n long").collect()  # at most one per sampled row
    if seen:
        model.weights = _learn_weights(np.array([r["events"] for r in seen]), np.array([r["toxic"] for r in seen]), np.array([r["n"] for r in seen], float))
    return model


def scorer(spark, model: Model):
    """Column function: the toxicity score of a text; a null text is empty."""
    shared = spark.sparkContext.broadcast((model.stems, model.weights))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = Model(*shared.value)
        return pd.Series(model.scores(np.array([model.events(t or "") for t in texts]).reshape(-1, len(EVENTS))))

    return score


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted. A null or empty text has no clause and gets the score of no match; so does every text
    if nothing could be learned and no threat matches. Equal rows score alike; extra columns are ignored; an empty table gives no rows."""
    score = scorer(docs.sparkSession, model)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text").cast("string")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
