"""The trained text models against plain loops: naive Bayes gram by gram, the clause grammar word by word."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import exp, log, sqrt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import language, toxicity
from test_text_rules import held_out as held_out_id  # noqa: E402


def _buckets(text):
    codes = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()}  "]
    for n in language.GRAMS:
        for i in range(len(codes) - n + 1):
            h = n
            for c in codes[i : i + n]:
                h = (h ^ c) * 0x01000193 & 0xFFFFFFFF
                h ^= h >> 15
            yield (h * 0x9E3779B1 & 0xFFFFFFFF) >> 16


def _bayes(rows):
    counts, docs = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if lang is not None and text is not None and not held_out_id(i):
            docs[lang] += 1
            counts[lang].update(_buckets(text))
    out = {}
    for i, text, _ in rows:
        if not text or not any(map(str.isalpha, text)):
            out[i] = "und", 0.0
            continue
        joint = {}
        for lang in sorted(docs):
            whole = sum(counts[lang].values()) + language.SMOOTHING * language.BUCKETS
            joint[lang] = log(docs[lang] / sum(docs.values())) + sum(log((counts[lang][b] + language.SMOOTHING) / whole) for b in _buckets(text))
        best = max(joint, key=lambda k: (joint[k], [-ord(c) for c in k]))
        out[i] = best, 1 / sum(exp(v - joint[best]) for v in joint.values())
    return out


def test_language_equals_counting_grams(spark):
    rng = np.random.default_rng(4)
    words = {"aa": "the cat sat on a mat and ran".split(), "bb": "der hund läuft über die straße".split(), "cc": "le chien mange une pomme rouge".split()}
    rows = []
    for i in range(90):
        lang = list(words)[i % 3]
        own = words[lang] + words[list(words)[(i + 1) % 3]][:2]
        rows.append((i, " ".join(rng.choice(own, int(rng.integers(1, 12)))), None if i % 10 == 9 else lang))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 34 !", "cc"), (203, "ÄÖ straße!", None)]
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    want = _bayes(rows)
    for i, (lang, score) in want.items():
        assert found[i].lang_pred == lang and found[i].score == pytest.approx(score, abs=1e-4)


def test_ties_go_to_the_first_language(spark):
    learned = [i for i in range(40) if not held_out_id(i)][:2]
    rows = [(learned[0], "same words", "zz"), (learned[1], "same words", "aa"), (100, "same words", None)]
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert {r.lang_pred for r in found.values()} == {"aa"} and found[100].score == pytest.approx(0.5)


def _naive(symbols):
    """(place, event) by looking around each word."""
    out = []
    for i, s in enumerate(symbols):
        if s not in ("insult", "threat"):
            continue
        back = lambda mark, n: mark in symbols[max(0, i - n) : i]  # noqa: E731, B023
        aimed = back("target", toxicity.WINDOW) or "target" in symbols[i + 1 : i + 1 + toxicity.WINDOW]
        if "report" in symbols[:i]:
            out.append((i, "reported"))
        elif back("negation", toxicity.WINDOW - 1):
            out.append((i, "negated"))
        elif s == "insult":
            out.append((i, "aimed" if aimed else "insult"))
        elif aimed:
            out.append((i, "threat"))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["", "", "", "insult", "threat", "target", "negation", "report"]), max_size=25))
def test_the_grammar_equals_looking_around(symbols):
    assert toxicity.Grammar().clause(symbols) == _naive(symbols)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["you", "not", "said", "kill", "idiot", "Scumbag", "tree", ".", "!", "\n", ",", "the", "DU"]), max_size=40))
def test_events_equal_reading_word_by_word(pieces):
    text = " ".join(pieces)
    model = toxicity.Model({"idiot": 5.0, "scum*": 5.0})
    kind = {"you": "target", "du": "target", "not": "negation", "said": "report", "kill": "threat", "idiot": "insult", "scumbag": "insult"}
    counts = Counter()
    for clause in re.split(r"[.!?;\n]+", text.lower()):
        counts.update({e for _, e in _naive([kind.get(w, "") for w in re.findall(r"[a-z]+", clause)])})
    assert model.events(text).tolist() == pytest.approx([sqrt(counts[e]) for e in toxicity.EVENTS])


def test_scores_of_documents_equal_the_model_row_by_row(spark):
    model = toxicity.Model({"idiot": 5.0, "scum*": 5.0})
    texts = ["you idiot", "he said you idiot", "not an idiot", "I will kill you", "kill the lights", "", None, "scumbags! all of you", "long " * 30_000 + "you idiot"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score_documents(df.selectExpr("*", "1 AS score", "2 AS events"), model).collect():
        margin = model.weights[0] + model.events(texts[r.doc_id] or "") @ model.weights[1:]
        assert r.score == pytest.approx(1 / (1 + exp(-margin))) and r.predicted == int(r.score >= 0.3)
