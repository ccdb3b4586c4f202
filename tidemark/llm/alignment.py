"""Alignment of two tokenizers by inverted pair bitmaps (operator 13).

Tokens of both vocabularies cut the same bytes; where tokens of both end, a group ends. A token of one vocabulary is linked
to the tokens of the other in its group. The links of a corpus are kept inverted: documents of a task get ordinals, and each
pair of ids holds the set of ordinals it occurs in. A pair's multiplicities are bit planes: plane k holds the documents whose
count has bit k, so the OR of the planes is the pair's document bitmap, its popcount the document count, and the popcounts
weighted by 2^k the links. A plane is stored compressed: as ordinals of two bytes, or as a bitmap where that is smaller.
Document counts add up over tasks; the postings then carry each pair's scores back to its documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.llm import bpe, links
from tidemark.llm.common import once_per_worker
from tidemark.llm.pieces import default_model

#: Documents of a bitmap, (pair, document) entries after which a task writes its bitmaps, characters and pairs worked on at a time.
SPAN, ENTRIES, SLICE_CHARS, SLICE_PAIRS = 1 << 16, 2_000_000, 500_000, 2_000_000
_ID_BITS = 20
_ID = (1 << _ID_BITS) - 1


@dataclass
class Vocabulary:
    """Bytes and byte lengths by id, and the ids of a text."""

    raw: list[bytes]
    sizes: np.ndarray
    encode: object


def _bytes_first(path: str) -> Vocabulary:
    coder = bpe.encoder(path)
    raw = [b""] * (coder.max_token_value + 1)
    for token in coder.token_byte_values():
        raw[coder.encode_single_token(token)] = token
    return Vocabulary(raw, np.array([len(r) for r in raw]), lambda text: coder.encode_ordinary(" " + text))


def _pieces_second(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    raw = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    return Vocabulary(raw, np.array([len(r) for r in raw]), lambda text: model.encode(text, num_threads=1))


@dataclass
class Pair:
    """Both vocabularies, and the text of each id with the separator that may follow it."""

    first: Vocabulary
    second: Vocabulary
    shown: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n, m = len(self.first.raw), len(self.second.raw)
        texts = [b"%d%c" % (i, c) for count, seps in ((n, b",|"), (m, b",;")) for c in seps for i in range(count)]
        self.shown = np.array(texts, object)


def vocabularies(first: str, second: str) -> Pair:
    return once_per_worker(f"alignment:{first}:{second}", lambda: Pair(_bytes_first(first), _pieces_second(second)))


def slices(text: str, every: int) -> Iterator[str]:
    """Parts of a text that both tokenizers encode apart; the space each later part begins with is left to them.

    No token of either holds a space after another character, so both end a token at such a cut.
    """
    cuts = [c for c in bpe.safe_cuts(text, every) if c and c + 1 < len(text)]
    for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(text)]):
        yield text[a:b]


def encoded(text: str | None, pair: Pair) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids of both vocabularies by part; nothing if either does not give back the bytes of space and text."""
    out = []
    for part in slices(text, SLICE_CHARS) if text else ():
        a, b = pair.first.encode(part), pair.second.encode(part)
        want = b" " + part.encode()
        if b"".join(map(pair.first.raw.__getitem__, a)) != want or b"".join(map(pair.second.raw.__getitem__, b)) != want:
            return []
        out.append((np.array(a, np.int64), np.array(b, np.int64)))
    return out


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    return np.unique(keys, return_counts=True)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


@dataclass
class Aligned:
    """The parts of some documents, aligned: per part its groups, links and text of groups, and linked pairs by document."""

    n_groups: np.ndarray
    n_links: np.ndarray
    texts: list[bytes]
    keys: np.ndarray  # pair of ids << 16 | ordinal of the document, sorted
    times: np.ndarray


def align_parts(parts: list[tuple[int, np.ndarray, np.ndarray]], pair: Pair) -> Aligned:
    """Align (ordinal, first ids, second ids); the bytes of both sides of a part are the same."""
    a, b = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    ends_a, ends_b = np.cumsum(pair.first.sizes[a]), np.cumsum(pair.second.sizes[b])
    borders = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(borders, ends_a), np.searchsorted(borders, ends_b)
    n_a, n_b = np.bincount(group_a, minlength=len(borders)), np.bincount(group_b, minlength=len(borders))
    last = np.cumsum([len(p[1]) for p in parts]) - 1
    part_of = np.searchsorted(ends_a[last], borders)
    stops = np.cumsum(np.bincount(part_of, minlength=len(parts)))
    links_upto = np.append(0, np.cumsum(n_a * n_b))
    starts = stops - np.diff(stops, prepend=0)
    n_links = links_upto[stops] - links_upto[starts]

    # both sides side by side: a group's first ids, then its second ids, each with the separator that follows
    upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
    ends_group_a, ends_group_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
    n, m = len(pair.first.raw), len(pair.second.raw)
    shown = np.empty(len(a) + len(b), np.int64)
    shown[np.arange(len(a)) + (upto_b - n_b)[group_a]] = a + n * ends_group_a
    shown[np.arange(len(b)) + upto_a[group_b]] = b + 2 * n + m * ends_group_b
    strings = pair.shown[shown].tolist()
    sizes = np.cumsum([len(p[1]) + len(p[2]) for p in parts]).tolist()
    texts = [b"".join(strings[s:e]) for s, e in zip([0, *sizes], sizes)]

    ordinals = np.array([p[0] for p in parts], np.int64)
    keys_a, count_a = _counts(group_a << _ID_BITS | a)
    keys_b, count_b = _counts(group_b << _ID_BITS | b)
    id_a, in_a, id_b = keys_a & _ID, keys_a >> _ID_BITS, keys_b & _ID
    per_group = np.bincount(keys_b >> _ID_BITS, minlength=len(borders))
    first_b = np.cumsum(per_group) - per_group
    times_pairs = per_group[in_a]
    rounds = int(times_pairs.sum()) // SLICE_PAIRS + 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for r in range(rounds):  # ids of the first side by turns, so that a pair lies in one round
        at = np.flatnonzero(id_a % rounds == r) if rounds > 1 else np.arange(len(id_a))
        repeats = times_pairs[at]
        left = np.repeat(at, repeats)
        right = first_b[in_a[left]] + np.arange(len(left)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        keys = (id_a[left] << _ID_BITS | id_b[right]) << 16 | ordinals[part_of[in_a[left]]]
        found.append(_summed(keys, count_a[left] * count_b[right]))
    keys, times = (np.concatenate(c) for c in zip(*found))
    return Aligned(stops - starts, n_links, texts, keys, times)


def planes_of(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(pair, documents, planes) from sorted (pair << 16 | ordinal) and multiplicities."""
    pairs = keys >> 16
    heads = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    documents = np.diff(np.append(heads, len(keys)))
    index = np.repeat(np.arange(len(heads)), documents)
    n_planes = np.array([int(t).bit_length() for t in np.maximum.reduceat(times, heads)])
    base = np.cumsum(n_planes) - n_planes
    slot, ordinal = [], []
    for k in range(int(n_planes.max())):
        on = np.flatnonzero(times >> k & 1)
        slot.append(base[index[on]] + k)
        ordinal.append((keys[on] & (SPAN - 1)).astype("<u2"))
    slot_, ordinal_ = np.concatenate(slot), np.concatenate(ordinal)
    order = np.argsort(slot_, kind="stable")
    slot_, ordinal_ = slot_[order], ordinal_[order]
    sizes = np.bincount(slot_, minlength=int(n_planes.sum()))
    stops = np.cumsum(sizes)
    dense = np.flatnonzero(sizes * 2 >= SPAN // 8)
    chunks: list[bytes] = []
    at = 0
    for p in dense.tolist():
        low, high = int(stops[p] - sizes[p]), int(stops[p])
        bits = np.zeros(SPAN, np.uint8)
        bits[ordinal_[low:high]] = 1
        chunks += [ordinal_[at:low].tobytes(), np.packbits(bits).tobytes()]
        at = high
    chunks.append(ordinal_[at:].tobytes())
    widths = sizes * 2
    widths[dense] = SPAN // 8
    offsets = np.append(0, np.cumsum(widths)).astype(np.int32)
    planes = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(chunks))])
    return pairs[heads], documents, pa.ListArray.from_arrays(pa.array(np.append(base, len(sizes)), pa.int32()), planes)


def members(plane: bytes) -> np.ndarray:
    """Ordinals in a plane."""
    if len(plane) == SPAN // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(plane, np.uint8)))
    return np.frombuffer(plane, "<u2").astype(np.int64)


_SCHEMA = "span long, ordinal int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, documents long, links long, planes array<binary>"
_NAMES = [c.split(" ")[0] for c in _SCHEMA.split(", ")]
_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), *[pa.int64()] * 3, pa.list_(pa.binary())]


class Writer:
    """The documents of one task: collects parts to align, and holds the entries of the bitmaps not yet written."""

    def __init__(self, task: int, pair: Pair) -> None:
        self.pair, self.span = pair, task << 32
        self.docs: list[dict] = []
        self.parts: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.waiting = self.entries = 0
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, text: str | None) -> Iterator[pa.RecordBatch]:
        doc = dict(doc_id=doc_id, n_a=0, n_b=0, n_groups=0, n_links=0, sha=None)
        self.docs.append(doc)
        for a, b in encoded(text, self.pair):
            doc["n_a"] += len(a)
            doc["n_b"] += len(b)
            doc["sha"] = doc["sha"] or hashlib.sha256()
            self.parts.append((len(self.docs) - 1, a, b))
            self.waiting += len(a) + len(b)
            if self.waiting >= SLICE_CHARS:
                self.work()
        if self.entries >= ENTRIES or len(self.docs) == SPAN:
            yield from self.flush()

    def work(self) -> None:
        """Align what waits."""
        if not self.parts:
            return
        done = align_parts(self.parts, self.pair)
        for (ordinal, _, _), groups, n_links, text in zip(self.parts, done.n_groups.tolist(), done.n_links.tolist(), done.texts):
            doc = self.docs[ordinal]
            doc["sha"].update((b";" if doc["n_groups"] else b"") + text[:-1])
            doc["n_groups"] += groups
            doc["n_links"] += n_links
        self.held.append((done.keys, done.times))
        self.entries += len(done.keys)
        self.parts, self.waiting = [], 0
        if self.entries >= ENTRIES and len(self.held) > 1:
            self.merge()

    def merge(self) -> None:
        """OR the bitmaps held; a document in several of them has its multiplicities added."""
        self.held = [_summed(*(np.concatenate(c) for c in zip(*self.held)))]
        self.entries = len(self.held[0][0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.work()
        if self.docs:
            columns = [[d[c] for d in self.docs] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield self.batch(len(self.docs), ordinal=np.arange(len(self.docs)), **dict(zip(("doc_id", "n_a", "n_b", "n_groups", "n_links"), columns)), groups_sha256=[d["sha"].hexdigest() if d["sha"] else "" for d in self.docs])
        if self.entries:
            self.merge()
            keys, times = self.held[0]
            pairs, documents, planes = planes_of(keys, times)
            heads = np.flatnonzero(np.append(True, np.diff(keys >> 16) != 0))
            whole = self.batch(len(pairs), pair=pairs, documents=documents, links=np.add.reduceat(times, heads), planes=planes)
            yield from (whole.slice(i, 20_000) for i in range(0, len(pairs), 20_000))
        self.docs, self.held, self.entries, self.span = [], [], 0, self.span + 1

    def batch(self, n: int, **columns) -> pa.RecordBatch:
        columns["span"] = np.full(n, self.span)
        return pa.RecordBatch.from_arrays([c if isinstance(c := columns.get(name), pa.Array) else pa.nulls(n, t) if c is None else pa.array(c, t) for name, t in zip(_NAMES, _TYPES)], names=_NAMES)


@dataclass
class Alignment:
    """``documents``: one row per document (span, ordinal, doc_id, counts, groups_sha256); ``postings``: (span, pair, documents, links, planes)."""

    documents: DataFrame
    postings: DataFrame

    def pairs(self) -> DataFrame:
        """first_id, second_id, documents, links of every linked pair of ids, over all documents."""
        found = self.postings.groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
        return found.select(F.shiftright("pair", _ID_BITS).alias("first_id"), F.col("pair").bitwiseAND(_ID).alias("second_id"), "documents", "links")


def align(docs: DataFrame, first: str | None = None, second: str | None = None) -> Alignment:
    """Encode and align every text by a byte-level vocabulary and a model of pieces; the written result is read by all later steps."""
    from_path, to_path = first or bpe.default_path(), second or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(TaskContext.get().partitionId(), vocabularies(from_path, to_path))
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from writer.add(doc_id, text.as_py())
        yield from writer.flush()

    rows = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA), "aligned")
    documents = rows.where("ordinal IS NOT NULL").select("span", "ordinal", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return Alignment(documents, rows.where("pair IS NOT NULL").select("span", "pair", "documents", "links", "planes"))


def _returned(table: pa.Table) -> dict[str, list] | None:
    """The scores of the pairs of one span, added up for its documents."""
    n_best, count_sum = np.zeros(SPAN, np.int64), np.zeros(SPAN, np.int64)
    planes, counts, best = table.column("planes").combine_chunks(), table.column("count").to_numpy(), table.column("best").to_numpy()
    stops = np.diff(planes.offsets.to_numpy())
    which, plane_no = np.repeat(np.arange(len(counts)), stops), np.arange(stops.sum()) - np.repeat(np.cumsum(stops) - stops, stops)
    flat = planes.flatten()
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
    widths = np.diff(offsets)
    held, owner = [], []
    for i in np.flatnonzero(widths == SPAN // 8).tolist():
        held.append(members(flat[i].as_py()))
        owner.append(np.full(len(held[-1]), i))
    sparse = np.flatnonzero((widths > 0) & (widths != SPAN // 8))
    data = np.frombuffer(flat.buffers()[2], np.uint8)
    if len(sparse):
        lengths = widths[sparse] // 2
        at = np.repeat(offsets[sparse] - 2 * (np.cumsum(lengths) - lengths), lengths) + 2 * np.arange(lengths.sum())
        held.append(data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8)
        owner.append(np.repeat(sparse, lengths))
    ordinal, plane = np.concatenate(held), np.concatenate(owner)
    times = np.int64(1) << plane_no[plane]
    np.add.at(count_sum, ordinal, times * counts[which[plane]])
    np.add.at(n_best, ordinal, times * best[which[plane]])
    some = np.flatnonzero(count_sum)
    return {"span": np.full(len(some), table.column("span")[0].as_py()), "ordinal": some.astype(np.int32), "n_best": n_best[some], "count_sum": count_sum[some]}


def alignment_scores(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document.

    A pair's count is the number of documents (rows) that hold it linked. A null or empty text, or one whose tokens do not
    spell it, has zeros and an empty string. Repeated rows and null doc_ids are documents of their own. A very long text is
    encoded in parts that both tokenizers encode apart; a group without common borders is paired by its distinct ids, some
    at a time. A task holds the entries of one bitmap span at a time; extra columns are ignored; an empty table gives no rows.
    """
    aligned = align(docs, first, second)
    counts = aligned.postings.groupBy("pair").agg(F.sum("documents").alias("count"))
    counts = staged(counts.withColumn("first", F.shiftright("pair", _ID_BITS)), "pairs")
    highest = counts.groupBy(F.col("first").alias("highest_of")).agg(F.max("count").alias("highest"))
    scores = counts.join(highest, F.col("first") == F.col("highest_of")).select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    scored = aligned.postings.select("span", "pair", "planes").join(scores, "pair")
    back = links.map_groups(scored.select("span", "planes", "count", "best"), "span", _returned, "span long, ordinal int, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    joined = aligned.documents.join(back, ["span", "ordinal"], "left")
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
