"""Near-duplicate join on word n-grams by MinHash banding (operator 9)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.llm import links
from tidemark.llm.common import once_per_worker
from tidemark.llm.links import partial_links

WORDS, THRESHOLD = 5, 0.8
#: Rows of a band, the share of pairs at the threshold that must meet in a bucket, members of a block and their shingles.
ROWS, RECALL, BLOCK, SHINGLES = 5, 0.9999, 512, 1_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_COLUMNS, _CHUNK = 8192, 1 << 19


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Fewest bands of so many rows that let a pair at the threshold meet with at least this probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def build(size: int) -> tuple[np.ndarray, np.ndarray]:
        base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, x, np.uint64)])) for x in (base, inverse))

    return once_per_worker("powers", lambda: build(_CHUNK * 2)) if n <= _CHUNK * 2 else build(n)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (run of bytes other than ASCII white space) and where it starts."""
    data = np.frombuffer(raw, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _powers(len(data))
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])
    return _mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The set of hashes of the word n-grams of each text, sorted; a text with fewer words is one shingle, one without is none."""
    out: list[np.ndarray] = []
    part: list[bytes] = []

    def flush() -> None:
        sizes = np.array([len(t) + 1 for t in part])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        h, starts = word_hashes(b"\n".join([*part, b""]))
        cuts = np.searchsorted(starts, bounds)
        n = max(len(h) - words + 1, 0)
        grams = np.full(n, np.uint64(words))
        for k in range(words):
            grams = _mix(grams * np.uint64(_BASE) + h[k : n + k])
        for a, b in zip(cuts, cuts[1:]):
            if b - a >= words:
                out.append(np.unique(grams[a : b - words + 1]))
            else:
                short = np.full(1, np.uint64(b - a))
                for k in range(a, b):
                    short = _mix(short * np.uint64(_BASE) + h[k : k + 1])
                out.append(short if b > a else np.empty(0, np.uint64))
        part.clear()

    held = 0
    for text in texts:
        part.append((text or "").encode())
        held += len(part[-1])
        if held > _CHUNK // 2:
            flush()
            held = 0
    if part:
        flush()
    return out


def _digest(grams: np.ndarray) -> bytes | None:
    return hashlib.md5(grams.tobytes()).digest() if len(grams) else None


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def band_keys(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band: a hash of the band's number and its least shingle under each of its rows' permutations."""
    by, plus = once_per_worker(f"permutations:{bands * rows}", lambda: _permutations(bands * rows))
    least = np.full(bands * rows, np.iinfo(np.uint64).max)
    for at in range(0, len(grams), 2048):
        least = np.minimum(least, (grams[at : at + 2048, None] * by + plus).min(axis=0))
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = _mix(key * np.uint64(_BASE) + least.reshape(bands, rows)[:, r])
    return key.view(np.int64)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right`` (itself, if None), by products of 0/1 slices."""
    sets = left + (right or [])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    often = np.bincount(column) > 1
    keep = often[column]
    row, column = row[keep], (np.cumsum(often) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n, out = len(left), np.zeros((len(left), len(right) if right is not None else len(left)), np.float32)
    for at in range(0, int(often.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [at, at + _COLUMNS])
        dense = np.zeros((len(sets), min(_COLUMNS, int(often.sum()) - at)), np.float32)
        dense[row[a:b], column[a:b] - at] = 1
        out += dense[:n] @ (dense[n:] if right is not None else dense).T
    return out.astype(np.int64)


def _candidates(nodes: DataFrame, block: int, shingles: int) -> DataFrame:
    """(node, pairs): which pairs of blocks each node that shares a bucket belongs to.

    Two nodes of a bucket always lie in a common pair of blocks. A block is a group of nodes that lead to the same
    smallest node in at most two steps over buckets, dealt into blocks of about ``block`` members or ``shingles`` shingles,
    whichever are more blocks, so nodes alike mostly share one block and long texts share it with few.
    """
    rows = staged(nodes.select("node", "n_grams", F.explode("bands").alias("key")), "bands")
    leaders = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1").select("key", "leader")
    member = staged(rows.join(leaders, "key").select("key", "node", "n_grams", "leader"), "members")
    near = member.groupBy("node").agg(F.min("leader").alias("near"))
    further = member.join(near, "node").groupBy("key").agg(F.min("near").alias("far"))
    groups = member.select("key", "node", "n_grams").join(further, "key").groupBy("node").agg(F.min("far").alias("grp"), F.max("n_grams").alias("n_grams"))
    sizes = groups.groupBy("grp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n_grams") / shingles)).alias("blocks"))
    blocks = groups.join(sizes, "grp").select("node", F.xxhash64("grp", F.pmod(F.xxhash64("node"), "blocks")).alias("block"))
    blocks = staged(blocks, "blocks")
    met = member.select("key", "node").join(blocks, "node").select("key", "block").distinct()
    left, right = met.select("key", F.col("block").alias("x")), met.select("key", F.col("block").alias("y"))
    pairs = left.join(right, "key").where("x <= y").select("x", "y").distinct()
    pair = F.xxhash64("x", "y").alias("pair")
    sides = pairs.select(F.col("x").alias("block"), pair, F.lit(0).alias("side")).unionByName(pairs.where("x < y").select(F.col("y").alias("block"), pair, F.lit(1).alias("side")))
    sides = sides.groupBy("block").agg(F.collect_list(F.struct("pair", "side")).alias("pairs"))
    return blocks.join(sides, "block").select("node", "pairs")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and what names a text: two hashes and the length in bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.hash(text).alias("g"), F.octet_length(text).alias("b"))


def _signed_links(docs: DataFrame, words: int, threshold: float, rows: int, recall: float, block: int, shingles: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, g, b, node) of every row, and the partial links of the nodes: texts with equal shingle sets."""
    bands = bands_for(threshold, rows, recall)
    exact = Fraction(str(threshold))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            keys = [band_keys(s, bands, rows) if len(s) else None for s in sets]
            own = [batch.column(c) for c in ("doc_id", "h", "g", "b")]
            made = [pa.array(list(map(_digest, sets)), pa.binary()), pa.array(list(map(len, sets)), pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*own, *made], names=["doc_id", "h", "g", "b", "node", "n_grams", "bands"])

    texts = _keyed(docs)
    signed = staged(texts.mapInArrow(sign, "doc_id long, h long, g int, b int, node binary, n_grams long, bands array<long>"), "signed")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"), F.first("n_grams").alias("n_grams"), F.min(F.struct("h", "g", "b")).alias("text"), F.count(F.lit(1)).alias("copies"))
    nodes = staged(nodes, "nodes")
    chosen = nodes.select("node", "copies", "text.*").join(_candidates(nodes, block, shingles), "node")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for text, node, copies, pairs in zip(*(batch.column(c).to_pylist() for c in ("text", "node", "copies", "pairs"))):
                grams = shingle_sets([text], words)[0]
                if _digest(grams) == node:  # else another text of these hashes
                    data = grams.tobytes()
                    out += [(p["pair"], p["side"], node, copies, data) for p in pairs]
                    held += len(data) * len(pairs)
                if held > 1 << 24:
                    yield _spread_batch(out)
                    out, held = [], 0
            yield _spread_batch(out)

    def compare(table: pa.Table) -> dict[str, list] | None:
        found = {}
        for side, node, copies, data in zip(*(table.column(c).to_pylist() for c in ("side", "node", "copies", "grams"))):
            found[side, node] = copies, data
        rows_of = [[k for k in found if k[0] == side] for side in (0, 1)]
        sets = [[np.frombuffer(found[k][1], np.uint64) for k in r] for r in rows_of]
        sizes = [np.array(list(map(len, s)), np.int64) for s in sets]
        if not sets[0] or len(found) < 2:
            return None
        if sets[1]:
            shared = shared_counts(sets[0], sets[1])
            union = sizes[0][:, None] + sizes[1] - shared
        else:
            shared = np.triu(shared_counts(sets[0], None), 1)
            union = sizes[0][:, None] + sizes[0] - shared
        left, right = np.nonzero((shared * exact.denominator >= exact.numerator * union) & (shared > 0))
        if sets[1]:
            right = right + len(sets[0])
        keys = rows_of[0] + rows_of[1]
        return partial_links([k[1] for k in keys], np.array([found[k][0] for k in keys]), left, right)

    # copies of a text are one row before it is joined
    once = texts.groupBy("h", "g", "b").agg(F.first("text").alias("text"))
    spreads = once.join(chosen, ["h", "g", "b"]).select("text", "node", "copies", "pairs").mapInArrow(spread, "pair long, side int, node binary, copies long, grams binary")
    return signed.drop("bands", "n_grams"), staged(links.map_groups(spreads, "pair", compare, "node binary, n_links long, root binary"), "linked")


def jaccard_links(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL, block: int = BLOCK, shingles: int = SHINGLES) -> DataFrame:
    """doc_id, n_links (documents at or above the threshold), class_id (smallest doc_id of the class), kept (doc_id = class_id).

    Words are runs of characters other than ASCII white space, as they stand; a text of fewer words than ``words`` is one
    shingle; null, empty and blank texts link with nothing. Texts with equal shingle sets are one node, collapsed before
    anything is compared; they count as linked to each other. Candidates share a band; every pair of blocks in which
    candidates meet is compared in full on the whole shingle sets, each pair of nodes in one task only, so links found
    are exact. A task sees two blocks at most, bounded by members and by shingles; m different near-copies of one text are
    compared in (m / block)^2 / 2 pairs of blocks, as exact counts need. Rows with equal doc_id count one by one; a null
    doc_id is its own class and not kept (null). Extra columns are ignored; an empty table gives no rows.
    """
    signed, linked = _signed_links(docs, words, threshold, rows, recall, block, shingles)
    return links.classes(signed.select("doc_id", "node"), "doc_id", linked).withColumnRenamed("component", "class_id")


def keep_one(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL, block: int = BLOCK, shingles: int = SHINGLES) -> DataFrame:
    """The rows of ``docs`` with one row of each class of linked texts: that with the smallest doc_id, of the smallest text key.

    A row is known by doc_id and text, so a doc_id that repeats loses only copies. A row without doc_id stays if its class
    has no other; of equal rows one stays. Texts without words are in no class: all such rows stay. All columns are kept,
    whatever their names; an empty table gives no rows.
    """
    signed, linked = _signed_links(docs, words, threshold, rows, recall, block, shingles)
    number = F.coalesce("doc_id", F.lit(0).cast("long"))
    item = F.struct(F.col("doc_id").isNull().alias("none"), number.alias("id"), "h", "g", "b").alias("item")
    members = signed.where("node IS NOT NULL").select(item, "node").distinct()
    best = links.classes(members, "item", linked).where("kept").select("item.*")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows_ = docs.select(
        row.alias("row"), F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"),
        F.xxhash64(text).alias("h"), F.hash(text).alias("g"), F.octet_length(text).alias("b"), text.rlike(r"[^ \t\n\x0B\f\r]").alias("worded"),
    )
    key = ["none", "id", "h", "g", "b"]
    kept = rows_.where("worded").join(best, key, "left_semi").groupBy(*key).agg(F.first("row").alias("row")).select("row")
    return kept.unionByName(rows_.where("NOT worded").select("row")).select(*[F.col(f"row.`{c}`") for c in docs.columns])


def _spread_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["pair", "side", "node", "copies", "grams"])
