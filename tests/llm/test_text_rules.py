"""Line rules, language, personal data and toxicity."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language, line_rules, pii, toxicity
from tidemark.llm.language import identify

SF = "/root/testdata/sf0.01"


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


# ---------------------------------------------------------------- lines


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute_counts(text):
    text = text or ""
    own = words(text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def normal(text):
    found = [re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]", "0", x.lower())).strip(" ") for x in (text or "").split("\n")]
    return {x for x in found if x}


def brute_lines(rows, most, mille, left):
    held, sizes = Counter(), Counter()
    for _, text, host in rows:
        sizes[host] += 1
        held.update((host, x) for x in normal(text))
    out = []
    for doc_id, text, host in rows:
        n_words, chars, symbols, dups, repeats = brute_counts(text)
        gone = {x for x in normal(text) if held[host, x] > most and held[host, x] * 1000 > sizes[host] * mille}
        total = sum(len(x.split(" ")) for x in normal(text))
        removed = sum(len(x.split(" ")) for x in gone)
        failed = n_words < 50 or 100 * repeats > 50 * n_words
        kept = not failed and 100 * (total - removed) >= left * total
        out.append((doc_id, n_words, chars, symbols, dups, repeats, failed, kept, total, removed))
    return sorted(out, key=str)


def line_rows():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "<b>", "#1", "x\ty"]
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choice(vocabulary, int(rng.integers(1, 14)))) for _ in range(int(rng.integers(1, 12)))]
        if i % 2:
            lines += ["Read more   at page %d" % i, "all rights reserved by the whole of us and them too and more " * 2]
        rows.append((i, "\n".join(lines), ["a", "b", None][i % 3]))
    rows += [(500, None, "a"), (501, "", "a"), (502, "\n \n", None), (None, rows[3][1], "a"), (504, "a b c " * 40, "b"), (505, "one line " * 3, "b"), (506, "a b c a b c\r\nd", "b")]
    return rows


def test_line_rules_equal_brute_force(spark):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS key", "2 AS counts").repartition(4)
    found = line_rules.judge_lines(df, most_docs=5, most_per_mille=50, least_left_percent=60)
    assert sorted(map(tuple, found.collect()), key=str) == brute_lines(rows, 5, 50, 60)
    assert any(r.kept for r in found.collect()) and any(not r.kept and not r.base_failed for r in found.collect())
    assert line_rules.judge_lines(df.where("doc_id < 0")).count() == 0


def test_rows_of_one_id_are_judged_each_by_itself(spark):
    rows = line_rows()
    boiler = "all rights reserved by the whole of us and them too and more " * 5
    rows += [(7, boiler, "a"), (7, rows[0][1] + " " + " ".join(f"own{i}" for i in range(60)), "a"), (7, boiler, "b"), (None, boiler, "a"), (None, "x " * 70, "a")]
    rows += [(20, rows[20][1], rows[20][2])] * 3 + [(900 + i, boiler, "a") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = line_rules.judge_lines(df, most_docs=5, most_per_mille=50, least_left_percent=60)
    assert sorted(map(tuple, found.collect()), key=str) == brute_lines(rows, 5, 50, 60)
    assert {r.kept for r in found.where("doc_id = 7").collect()} == {True, False}


def test_very_long_text_in_line_rules(spark):
    rows = [(1, "one line of words\n" * 20_000 + "w " * 50_000, "a"), (2, "a b c", "a")]
    found = line_rules.judge_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), most_docs=0, most_per_mille=0, least_left_percent=30)
    assert sorted(map(tuple, found.collect()), key=str) == brute_lines(rows, 0, 0, 30)


def test_line_rules_clean_text(spark):
    rows = [(i, f"own line {i}{chr(97 + i)}\n Same  LINE 1\nother {i}", "h") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = line_rules.judge_lines(df, most_docs=3, most_per_mille=0, clean_text=True).collect()
    assert {r.clean_text for r in out if r.doc_id == 2} == {"own line 2c"}


# ---------------------------------------------------------------- language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 for i, r in found.items())
    apart = [i for i, r in found.items() if r.held_out]
    assert sum(found[i].lang_pred == truth[i] for i in apart) >= 0.98 * len(apart)


def test_language_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    log_prob = np.log(rng.random((language.BUCKETS, 3))).astype(np.float32)
    model = language.Model(["a", "b", "c"], log_prob, np.log(np.full(3, 1 / 3)))
    texts = ["one", "yes no", "é", "東京", "", "der Hund", "zeta"]
    alone = np.concatenate([model.score([t]) for t in texts])
    assert (model.score(texts) == alone).all()
    assert (model.score(texts[::-1]) == alone[::-1]).all()


def test_language_edges(spark):
    rows = [(i, "the cat sat on the mat and then it ran" if i % 2 else "der hund lief über die straße und bellte", ["de", "en"][i % 2]) for i in range(40)]
    rows += [(100, None, "en"), (101, "12 34 !!", "en"), (102, "", None), (103, "über die " * 30_000, None), (None, "the mat", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS held_out", "2 AS score")
    found = {r.doc_id: r for r in identify(df).collect()}
    assert [found[i].lang_pred for i in (100, 101, 102, 103, None)] == ["und", "und", "und", "de", "en"]
    assert {r.lang_pred for r in identify(df.where("lang IS NULL")).collect()} == {"und"}
    assert identify(df.where("doc_id < 0")).count() == 0


# ---------------------------------------------------------------- personal data


def slow_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in (int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1]))) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_plain_patterns():
    rng = np.random.default_rng(4)
    for alphabet in ("a@.-1 2", "0123456789. -", "+(12) .-9", "ab@c.d%+_ é\n", "4111 1111-1111 1111 "):
        for _ in range(1500):
            text = "".join(rng.choice(list(alphabet), int(rng.integers(0, 60))))
            assert pii.plain_spans(text) == slow_base(text), repr(text)
    assert pii.plain_spans("x" * 200_000 + "@" + "1" * 200_000) == []


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to jane (at) mail [dot] example (dot) org now", "email", "jane (at) mail [dot] example (dot) org"),
        ("é jane.doe at example dot com.", "email", "jane.doe at example dot com"),
        ("at jоhn@exаmple.com it", "email", "jоhn@exаmple.com"),
        ("ip １９２.168.0.1 here", "ip", "１９２.168.0.1"),
        ("call plus four nine three zero one two three four five six now", "phone", "plus four nine three zero one two three four five six"),
        ("call +1 five five five 0 one two three four ok", "phone", "+1 five five five 0 one two three four"),
        ("card ４539 1488 0343 6467 end", "card", "４539 1488 0343 6467"),
    ],
)
def test_disguises_map_back(text, kind, found):
    spans = [s for s in pii.find_spans(text) if not s[3]]
    assert [(k, text[a:b]) for k, a, b, _ in spans if k == kind] == [(kind, found)]


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail bob ( at ) example ( dot ) com now", "email", "bob ( at ) example ( dot ) com"),
        ("mail bob [ at ] example [ dot ] com now", "email", "bob [ at ] example [ dot ] com"),
        ("mail bob ( @ ) example.com now", "email", "bob ( @ ) example.com"),
        ("mail bob (ät) example ( . ) com now", "email", "bob (ät) example ( . ) com"),
        ("mail bob { ÄT } example <  PUNKT > com now", "email", "bob { ÄT } example <  PUNKT > com"),
        ("mail jane AT example DOT com now", "email", "jane AT example DOT com"),
        ("mail jane At mail Dot example dOT org", "email", "jane At mail Dot example dOT org"),
        ("call plus nine nine nine nine nine nine nine nine now", "phone", "plus nine nine nine nine nine nine nine nine"),
        ("call +33 un un un un un un un un now", "phone", "+33 un un un un un un un un"),
        ("call plus oh oh oh oh oh oh oh oh now", "phone", "plus oh oh oh oh oh oh oh oh"),
        ("CALL PLUS NİNE FIVE NİNE FIVE NİNE FIVE NİNE FIVE", "phone", "PLUS NİNE FIVE NİNE FIVE NİNE FIVE NİNE FIVE"),
    ],
)
def test_gates_let_every_disguise_through(text, kind, found):
    test_disguises_map_back(text, kind, found)
    assert pii.redacted(text, [dict(kind=k, start=a, stop=b) for k, a, b, _ in pii.find_spans(text)]) == text.replace(found, f"[{kind.upper()}]")


def test_prose_has_no_added_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    added = pii.find_pii(docs).selectExpr("doc_id", "filter(pii, s -> NOT s.base) AS added").where("size(added) > 0")
    assert added.count() == 0


def test_pii_rows_and_redaction(spark):
    rows = [(1, "a@b.co and +1 234 567 8901"), (1, "a@b.co and +1 234 567 8901"), (2, None), (3, ""), (None, "10.0.0.1"), (4, "x (at) y (dot) z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS pii", "'k' AS kind")
    found = pii.find_pii(df).collect()
    assert sorted((r.doc_id or 0, len(r.pii)) for r in found) == [(0, 1), (1, 2), (1, 2), (2, 0), (3, 0), (4, 1)]
    kept = pii.redact(df)
    assert kept.columns == df.columns
    assert sorted(str(r.text) for r in kept.collect()) == sorted(["[EMAIL] and [PHONE]"] * 2 + ["None", "", "[IP]", "[EMAIL]"])


def test_pii_query_columns(spark):
    from tidemark.llm.catalog import REGISTRY

    row = REGISTRY.queries["op6_pii"](spark, SF).where("n_email > 0").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    base = ",".join(f"{k}:{a}:{b}" for kind in pii.KINDS for k, a, b in slow_base(text) if k == kind)
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and row.spans == base


# ---------------------------------------------------------------- toxicity


def test_grammar_contexts():
    model = toxicity.Model({"idiot": 5.0, "scum*": 5.0})
    event = lambda text: dict(zip(toxicity.EVENTS, model.events(text)))
    assert event("some idiot here")["insult"] == 1
    assert event("you are an idiot")["aimed"] == 1 and event("idiot, that is you")["aimed"] == 1
    assert event("he is not an idiot")["negated"] == 1
    assert event("she said that the man was a scumbag")["reported"] == 1
    assert event("I will kill you")["threat"] == 1 and event("they kill time")["threat"] == 0
    assert event("you went home. An idiot came")["insult"] == 1
    assert event("idiot. idiot. idiot. idiot")["insult"] == 2
    assert model.scores(model.events("you idiot")[None])[0] > model.scores(model.events("not an idiot")[None])[0]


def test_toxicity_learned_from_labels(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfg" for b in ("ala", "eno", "iru") for c in ("mos", "tik", "ran")]
    docs, labels = [], []
    for i in range(400):
        own = list(rng.choice(vocabulary, 40))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                own.insert(int(rng.integers(40)), f"zorka{rng.choice(list('abcdef'))}" if i % 2 else "wretch")
        docs.append((i, " ".join(own)))
        labels.append((i, 0, int(toxic)))
    docs += [(900, None), (901, ""), (None, "wretch wretch"), (902, "bala " * 60_000 + "wretch")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS toxic", "2 AS score")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.score_documents(df, toxicity.fit(df.drop("toxic"), marks)).collect()}
    assert all(found[i].held_out == held_out(i) for i in range(400))
    assert sum(found[i].predicted == (i % 5 == 0) for i in range(400) if held_out(i)) >= 0.98 * sum(map(held_out, range(400)))
    assert [found[i].predicted for i in (900, 901, None, 902)] == [0, 0, 1, 1]
    none = toxicity.score_documents(df, toxicity.fit(df.drop("toxic"), marks.where("doc_id < 0"))).collect()
    assert all(0 <= r.score <= 1 for r in none)
    assert toxicity.score_documents(df.where("doc_id < 0"), toxicity.Model({})).count() == 0


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to ann   (at)   example   (dot)   com now", "email", "ann   (at)   example   (dot)   com"),
        ("write to " + "n" * 90 + " at example dot com.", "email", "n" * 90 + " at example dot com"),
        ("host 192 dot 168 dot 1 dot 20 is up", "ip", "192 dot 168 dot 1 dot 20"),
        ("bob [ \t\n at ]example{dot}co{dot}uk", "email", "bob [ \t\n at ]example{dot}co{dot}uk"),
        ("a at b dot c dot d dot e dot f dot g", "email", "a at b dot c dot d dot e dot f dot g"),
    ],
)
def test_disguises_of_any_length(text, kind, found):
    spans = [(k, text[a:b]) for k, a, b, base in pii.find_spans(text) if not base]
    assert (kind, found) in spans


def test_disguises_take_time_in_proportion():
    import time

    for text in ("(" + " " * 200_000, " " * 200_000 + "(at)", "a(at) " * 30_000, "x at y" * 30_000 + " dot ", "1 dot " * 50_000):
        start = time.perf_counter()
        pii.find_spans(text)
        assert time.perf_counter() - start < 20


def test_samples_stay_small(spark):
    from tidemark.llm.common import bounded_sample

    rows = [(7, f"text {i}") for i in range(3000)] + [(8, "same")] * 3000 + [(None, f"t {i}") for i in range(1500)] + [(i, "x") for i in range(100, 1600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    some = bounded_sample(df, 900, "doc_id", "text")
    assert 300 < some.count() < 1000
    assert sorted(map(str, some.collect())) == sorted(map(str, bounded_sample(df.repartition(2), 900, "doc_id", "text").collect()))
    assert bounded_sample(df, 10_000, "doc_id", "text").count() == 9000


def test_languages_beyond_the_most(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    rows = [(i, f"{w} words of {w}{i}", w) for i, w in enumerate(["aa"] * 9 + ["bb"] * 8 + ["cc"] * 2)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in found.collect()} <= {"aa", "bb"}
