"""Personal data by offset-preserving deobfuscation (operator 6)."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,stop:int,base:boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters of other scripts that look like a Latin letter, and the words for the digits 0 to 9.
LOOKALIKES = dict(zip("аеорсухіјѕԁһкмтвнАВЕКМНОРСТУХІЈЅαορνικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhkmtbhABEKMHOPCTYXIJSaopvikABEZHIKMNOPTYX"))
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
)
_VALUE = {w: str(i) for words in DIGIT_WORDS for i, w in enumerate(words)} | {"oh": "0"}
_LEAST_SPELLED = 3
_WORDS = "|".join(sorted(_VALUE, key=len, reverse=True))
_SPELLED = re.compile(rf"(?<!\w)(?:{_WORDS}|[0-9]+)(?:[\s,-]{{1,3}}(?:{_WORDS}|[0-9]+))+(?!\w)", re.I)
#: In small letters: in any run of spelled digits, one is followed by another or by figures.
_SPELLED_GATE = re.compile(rf"(?:{_WORDS})[\s,-]{{1,3}}(?:{_WORDS}|[0-9])")
_WORD = re.compile(rf"{_WORDS}|[0-9]+", re.I)
_PLUS = re.compile(r"(?<!\w)plus\s{1,3}(?=[+0-9(])", re.I)
# White space of any length may stand about and inside the brackets; that before them is taken in afterwards, in one step.
_AT = re.compile(r"[(\[{<]\s*+(?:at|ät|arroba|chez|@)\s*+[)\]}>]\s*+", re.I)
_DOT = re.compile(r"[(\[{<]\s*+(?:dot|punkt|point|punto|\.)\s*+[)\]}>]\s*+", re.I)
#: What a text must hold for a disguise in brackets; each begins with the bracket, which is quick to look for.
_AT_GATE = re.compile(r"[(\[{<]\s*+(?:at|ät|arroba|chez|@)", re.I)
_DOT_GATE = re.compile(r"[(\[{<]\s*+(?:dot|punkt|point|punto|\.)", re.I)
#: Without brackets both words must appear: name at host dot end.
_BARE = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]++( [Aa][Tt] )[A-Za-z0-9-]++((?: [Dd][Oo][Tt] [A-Za-z0-9-]++)+)(?!\w)")
#: Four figures with the word between them.
_BARE_IP = re.compile(r"(?<![\w.])[0-9]+(?: dot [0-9]+){3}(?![\w.])", re.I)
_BARE_DOT = re.compile(" dot ", re.I)
_FOREIGN = re.compile("[ɐ-\U0010ffff]")


def _low(text: str) -> str:
    """Small letters, also for the letters that patterns without case take for i and s."""
    return (text if text.isascii() else text.replace("İ", "i").replace("ı", "i").replace("ſ", "s")).lower()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ with the longest name left of it and a domain right of it; linear in the text."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return out


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """The base rules on a text: leftmost matches of each kind that do not overlap; failing ones are dropped."""
    out = [("email", *s) for s in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return out


@dataclass
class Mapped:
    """A normalised text with, for each of its characters, where in the source it came from and whether it was changed."""

    text: str
    start: np.ndarray
    stop: np.ndarray
    changed: np.ndarray

    @classmethod
    def of(cls, text: str) -> Mapped:
        at = np.arange(len(text) + 1)
        return cls(text, at[:-1], at[1:], np.zeros(len(text), bool))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace spans of this text; each new character stands for the whole span it replaces."""
        if not edits:
            return self
        texts, starts, stops, changed, at = [], [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a] if b > a else 0)]
            stops += [self.stop[at:a], np.full(len(new), self.stop[b - 1] if b > a else 0)]
            changed += [self.changed[at:a], np.ones(len(new), bool)]
            at = b
        return Mapped("".join(texts), np.concatenate(starts), np.concatenate(stops), np.concatenate(changed))


def _letter_edits(text: str) -> list[tuple[int, int, str]]:
    """Homoglyphs: look-alikes of other scripts, and compatibility forms of one ASCII character."""
    out = []
    for m in _FOREIGN.finditer(text):
        new = LOOKALIKES.get(m[0])
        if new is None:
            flat = unicodedata.normalize("NFKC", m[0])
            new = flat if len(flat) == 1 and flat.isascii() and flat.isprintable() and flat != " " else None
            if new is None and m[0].isdecimal():
                new = str(unicodedata.digit(m[0]))
        if new:
            out.append((*m.span(), new))
    return out


def _digit_edits(text: str) -> list[tuple[int, int, str]]:
    """Runs of spelled digits, perhaps among figures, word for word; the gaps inside a run go."""
    if not _SPELLED_GATE.search(_low(text)):
        return []
    out = []
    for run in _SPELLED.finditer(text):
        words = list(_WORD.finditer(text, *run.span()))
        if sum(not m[0][0].isdigit() for m in words) < _LEAST_SPELLED:
            continue
        for m, after in zip(words, [*words[1:], None]):
            out.append((m.start(), after.start() if after else m.end(), _VALUE.get(_low(m[0]), m[0])))
    return out


def _before_space(text: str, at: int) -> int:
    """Where the white space that ends at a place begins."""
    while at and text[at - 1].isspace():
        at -= 1
    return at


def _sign_edits(text: str) -> list[tuple[int, int, str]]:
    low = _low(text)
    out = [(*m.span(), "+") for m in _PLUS.finditer(text)] if "plus" in low else []
    for pattern, gate, new in ((_AT, _AT_GATE, "@"), (_DOT, _DOT_GATE, ".")):
        out += [(_before_space(text, m.start()), m.end(), new) for m in pattern.finditer(text)] if gate.search(text) else []
    if " dot " in low:
        dots = lambda found, at: [(at + d.start(), at + d.end(), ".") for d in _BARE_DOT.finditer(found)]
        for m in _BARE.finditer(text) if " at " in low else ():
            out += [(*m.span(1), "@"), *dots(m[2], m.start(2))]
        for m in _BARE_IP.finditer(text):
            out += dots(m[0], m.start())
    kept, last = [], 0
    for a, b, new in sorted(out):
        if a >= last:
            kept.append((a, b, new))
            last = b
    return kept


def find_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, stop, base), by kind and start. Added spans touch a rewritten place and no base span of their kind."""
    text = text or ""
    base = plain_spans(text)
    mapped = None
    for edits_of in (_letter_edits if not text.isascii() else None, _digit_edits, _sign_edits):
        if edits_of is None:
            continue
        edits = edits_of(mapped.text if mapped else text)
        if edits:
            mapped = (mapped or Mapped.of(text)).rewrite(edits)
    spans = [(*s, True) for s in base]
    if mapped:
        taken = {k: [(a, b) for kind, a, b in base if kind == k] for k in KINDS}
        for kind, a, b in plain_spans(mapped.text):
            start, stop = int(mapped.start[a]), int(mapped.stop[b - 1])
            if mapped.changed[a:b].any() and all(stop <= x or y <= start for x, y in taken[kind]):
                spans.append((kind, start, stop, False))
                taken[kind].append((start, stop))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def _spans_of(texts: pd.Series) -> pd.Series:
    return pd.Series([[dict(kind=k, start=a, stop=b, base=own) for k, a, b, own in find_spans(t)] for t in texts], dtype=object)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and ``pii``, an array of (kind, start, stop, base) in code points, by kind and start.

    Whole texts are read, each character a bounded number of times. A null text is empty and has none; spans of one
    kind never overlap, those of different kinds may; equal rows are read alike; extra columns are ignored; an empty
    table gives no rows.
    """
    return docs.select("doc_id", F.pandas_udf(_spans_of, SPANS)(F.col("text").cast("string")).alias("pii"))


def redacted(text: str | None, spans) -> str | None:
    """The text with a mark such as [EMAIL] for each span; a span that overlaps the one before it joins its mark."""
    if text is None or spans is None or not len(spans):
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["stop"])
    return "".join([*out, text[at:]])


def _redacted_texts(texts: pd.Series) -> pd.Series:
    return pd.Series([redacted(t, [dict(kind=k, start=a, stop=b) for k, a, b, _ in find_spans(t)]) for t in texts], dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every found span replaced by its mark; a null text stays null, other columns stay as they are."""
    return docs.withColumn("text", F.pandas_udf(_redacted_texts, "string")(F.col("text").cast("string")))


def of_kind(kind: str):
    return lambda span: span["kind"] == kind


def span_text(spans: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
