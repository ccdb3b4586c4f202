"""Edit-aware token counts (operator 4)."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.common import map_rows

LEAF_CHARS = 256
EDITS = "array<struct<start:int,stop:int,text:string>>"


class CountTree:
    """Token counts of a document's leaves (runs of whole pre-tokens) under a binary tree of sums.

    ``leaves`` are (characters, tokens) of the leaves as an earlier tree of the same text gave them; without them the
    whole text is encoded once.
    """

    def __init__(self, path: str, text: str, leaf_chars: int, leaves: list[tuple[int, int]] | None = None) -> None:
        self.path, self.text, self.leaf_chars, self.encoded = path, text, leaf_chars, 0
        known = leaves and sum(n for n, _ in leaves) == len(text)
        self._grow(list(leaves) if known else self._encoded(text))

    def _encoded(self, text: str) -> list[tuple[int, int]]:
        """Leaves of a text, or of a region between two borders, counted anew."""
        self.encoded += len(text)
        cuts = [*bpe.safe_cuts(text, self.leaf_chars), len(text)]
        return [(b - a, bpe.count(self.path, text[a:b])) for a, b in zip(cuts, cuts[1:])]

    def _grow(self, leaves: list[tuple[int, int]]) -> None:
        self.leaves = leaves
        self.cuts = [0, *accumulate(n for n, _ in leaves)]
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.sums = [0] * self.width + [n for _, n in leaves] + [0] * (self.width - len(leaves))
        for i in range(self.width - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def total(self) -> int:
        return self.sums[1]

    def _set(self, leaf: int, tokens: int) -> None:
        """Change a leaf's count and the sums above it."""
        i = self.width + leaf
        change = tokens - self.sums[i]
        while i and change:
            self.sums[i] += change
            i //= 2

    def tokens_before(self, leaf: int) -> int:
        """Tokens in the leaves before this one, from the sums of subtrees."""
        i, total = self.width + leaf, 0
        while i > 1:
            if i & 1:
                total += self.sums[i - 1]
            i //= 2
        return total

    def apply(self, edits: list[tuple[int, int, str]]) -> int:
        """Edit the text and encode again what the edits touch; returns the number of characters encoded again.

        The leaves from the one before an edit's first character to the one of the character after it are touched:
        their outer borders then keep both neighbours, so they stay borders of pre-tokens. Where a region is still one
        leaf, only the sums above it change; where it grows or loses leaves, the sums are added up anew, from counts.
        """
        groups: list[list] = []
        for start, stop, text in edits:
            low = max(0, bisect_right(self.cuts, max(0, start - 1)) - 1)
            high = min(len(self.leaves) - 1, bisect_right(self.cuts, stop) - 1)
            low = min(low, high)
            if groups and low <= groups[-1][1]:
                groups[-1][1] = max(high, groups[-1][1])
                groups[-1][2].append((start, stop, text))
            else:
                groups.append([low, high, [(start, stop, text)]])
        before, leaves, texts, at, same = self.encoded, [], [], 0, True
        for low, high, own in groups:
            parts, place = [], self.cuts[low]
            for start, stop, text in own:
                parts += [self.text[place:start], text]
                place = stop
            region = "".join([*parts, self.text[place : self.cuts[high + 1]]])
            fresh = [leaf for leaf in self._encoded(region) if leaf[0]]
            same = same and len(fresh) == 1 and low == high
            leaves += [*self.leaves[at:low], *fresh]
            texts += [self.text[self.cuts[at] : self.cuts[low]], region]
            if same:
                self._set(low, fresh[0][1])
            at = high + 1
        self.text = "".join([*texts, self.text[self.cuts[at] :]])
        leaves += self.leaves[at:]
        if same:
            self.leaves, self.cuts = leaves, [0, *accumulate(n for n, _ in leaves)]
        else:
            self._grow(leaves or [(0, 0)])
        return self.encoded - before


def usable_edits(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits in order of start, clipped to the text; null bounds or one that begins before the last kept one ends are left out."""
    kept: list[tuple[int, int, str]] = []
    rows = [e for e in edits or [] if e and e["start"] is not None and e["stop"] is not None]
    for e in sorted(rows, key=lambda e: (e["start"], e["stop"], e["text"] or "")):
        start = min(max(0, e["start"]), length)
        stop = min(max(start, e["stop"]), length)
        if not kept or start >= kept[-1][1]:
            kept.append((start, stop, e["text"] or ""))
    return kept


_COUNTS = ["doc_id", "n_chars_before", "n_tokens_before", "n_tokens_after", "n_edits", "n_leaves", "n_chars_again"]
LEAVES = "array<struct<chars:int,tokens:int>>"


def revise(docs: DataFrame, vocabulary: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id, text after the edits, leaves, n_chars_before, n_tokens_before, n_tokens_after, n_edits, n_leaves, n_chars_again, n_chars_encoded.

    ``edits`` is an array of (start, stop, text): the code points from start to stop of the text as it stands become
    ``text``. ``leaves`` (characters and tokens of each leaf) is the document's tree as a column: written with the text and
    handed in with the next edits, it saves encoding the text again, so that a revision encodes what its edits touch
    (``n_chars_again``; ``n_chars_encoded`` counts the first encoding, too). Without the column, or where it does not
    fit the text, the tree is built. A null text is empty; null edits are none; edits out of range are clipped, overlapping
    ones left out (see ``usable_edits``); equal rows are counted each for itself; other columns are ignored; an empty table
    gives no rows. Memory: one document's leaves.
    """
    path = vocabulary or bpe.default_path()

    def each(batch: dict[str, list]) -> dict[str, list]:
        rows = []
        for doc_id, text, edits, leaves in zip(batch["doc_id"], batch["text"], batch["edits"], batch["leaves"]):
            held = [(x["chars"], x["tokens"]) for x in leaves] if leaves and all(x and None not in x.values() for x in leaves) else None
            tree = CountTree(path, text or "", leaf_chars, held)
            before, todo, n_leaves = tree.total, usable_edits(edits, len(text or "")), len(tree.leaves)
            again = tree.apply(todo)
            grown = [dict(chars=n, tokens=k) for n, k in tree.leaves]
            rows.append((doc_id, len(text or ""), before, tree.total, len(todo), n_leaves, again, tree.text, grown, tree.encoded))
        columns = list(zip(*rows)) if rows else [()] * len(names)
        types = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.struct([("chars", pa.int32()), ("tokens", pa.int32())])), pa.int64()]
        return {n: pa.array(c, t) for n, c, t in zip(names, columns, types)}

    names = [*_COUNTS, "text", "leaves", "n_chars_encoded"]
    leaves = F.col("leaves").cast(LEAVES) if "leaves" in docs.columns else F.lit(None).cast(LEAVES).alias("leaves")
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("edits").cast(EDITS), leaves)
    return map_rows(slim, each, ", ".join(f"{n} long" for n in _COUNTS) + f", text string, leaves {LEAVES}, n_chars_encoded long")


def count_edited(docs: DataFrame, vocabulary: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """The counts of ``revise``."""
    return revise(docs, vocabulary, leaf_chars).select(_COUNTS)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Attach (doc_id, start, stop, text) rows to their documents. Only edits are gathered; a text meets its own edits."""
    gathered = edits.groupBy(F.col("doc_id").alias("edit_doc")).agg(
        F.collect_list(F.struct(F.col("start").cast("int"), F.col("stop").cast("int"), F.col("text"))).cast(EDITS).alias("edits")
    )
    slim = docs.select("doc_id", "text")
    return slim.join(gathered, slim["doc_id"] == gathered["edit_doc"], "left").drop("edit_doc")


def quarter_revisions(docs: DataFrame) -> DataFrame:
    """A revision of every document: seven characters go at a quarter, the source's name comes in at the half, five characters are masked at three quarters."""
    n = F.length("text")
    at = lambda k: F.floor(n * k / 4).cast("int")
    edit = lambda start, stop, text: F.struct(start.alias("start"), stop.alias("stop"), text.alias("text"))
    return docs.withColumn(
        "edits",
        F.array(
            edit(at(1), at(1) + 7, F.lit("")),
            edit(at(2), at(2), F.concat(F.lit(" "), F.coalesce(F.col("source"), F.lit("")), F.lit(" "))),
            edit(at(3), at(3) + 5, F.lit("[mask]")),
        ).cast(EDITS),
    )
