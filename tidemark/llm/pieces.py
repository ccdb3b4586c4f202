"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding (operator 8)."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import once_per_worker

DEFAULT_MODEL = "piece_bpe_32k.model"
#: Exponent on piece probabilities (0: all segmentations alike, 1: as the model says) and characters sampled at a time.
ALPHA, CHUNK_CHARS = 0.5, 1_500_000
_DECODED = 500
#: No piece holds a space after another character, nor a line end, so the lattice falls apart into such parts.
_PARTS = re.compile(r" *[^ \n]+|\n| +")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_MODEL)


@dataclass
class Pieces:
    """Ordinary pieces as a trie in sorted arrays, byte pieces, and what each id decodes to."""

    keys: np.ndarray  # node << 21 | character, sorted
    nodes: np.ndarray  # the child node of each key
    ends: np.ndarray  # node -> piece id or -1
    log_weight: np.ndarray  # id -> log probability
    byte_ids: np.ndarray
    raw: list[bytes]


def _raw_pieces(path: str) -> list[bytes]:
    """What each id decodes to: a byte, nothing for control pieces, else the piece with spaces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    raw = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            raw.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            raw.append(piece.replace("▁", " ").encode())
    return raw


def _read(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    raw, byte_ids = _raw_pieces(path), np.full(256, -1, np.int64)
    for i in range(model.vocab_size()):
        if model.is_byte(i):
            byte_ids[raw[i][0]] = i
    ordinary = [(r.decode(), i) for i, r in enumerate(raw) if r and not model.is_byte(i)]
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces, so decoding could lose characters")
    scores = np.array([model.get_score(i) for i in range(model.vocab_size())])
    ranks = np.argsort(np.argsort(-scores[[i for _, i in ordinary]], kind="stable"), kind="stable")
    log_weight = np.zeros(len(scores))
    if scores[[i for _, i in ordinary]].min() < -1000:  # merge ranks: probabilities by Zipf's law
        log_weight[[i for _, i in ordinary]] = -np.log(ranks + 2.7) - np.log(np.log(len(ranks)))
    else:
        log_weight = scores.copy()
    children: dict[int, int] = {}
    ends = [-1]
    for piece, i in ordinary:
        node = 0
        for c in map(ord, piece):
            key = node << 21 | c
            if key not in children:
                children[key] = len(ends)
                ends.append(-1)
            node = children[key]
        ends[node] = i
    keys = np.fromiter(children, np.int64, len(children))
    order = np.argsort(keys)
    return Pieces(keys[order], np.array(list(children.values()), np.int64)[order], np.array(ends, np.int64), log_weight, byte_ids, raw)


def pieces_of(path: str) -> Pieces:
    return once_per_worker(f"pieces:{path}", lambda: _read(path))


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finish: well mixed 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Lattice:
    """Edges of the lattices of many parts, sorted by where they end, with what backward sampling needs."""

    starts: np.ndarray  # part -> its first character
    stops: np.ndarray  # part -> one past its last
    first: np.ndarray  # character border -> its first incoming edge
    source: np.ndarray  # edge -> border it leaves
    piece: np.ndarray  # edge -> piece id, or -1 - code point
    upto: np.ndarray  # edge -> probability of the edges of its border up to it


def lattice(parts: list[str], model: Pieces, alpha: float) -> Lattice:
    """Forward filtering: for each border the summed weight of all ways to reach it, in logs, shortest first."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    stops = np.cumsum(lengths)
    starts = stops - lengths
    # Borders are numbered so that each part has its own first border: part k's character i leaves border i + k.
    chars = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
    part = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
    limit = stops[part].astype(np.int32)
    at = np.arange(len(chars), dtype=np.int32)
    node = np.zeros(len(chars), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    single = np.zeros(len(chars), bool)
    length = 0
    while len(at):
        key = node << 21 | chars[at + length]
        k = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        hit = model.keys[k] == key
        at, node = at[hit], model.nodes[k[hit]]
        length += 1
        ends = model.ends[node]
        whole = ends >= 0
        found.append((at[whole], at[whole] + length, ends[whole]))
        if length == 1:
            single[at[whole]] = True
        more = at + length < limit[at]
        at, node = at[more], node[more]
    lone = np.flatnonzero(~single)
    found.append((lone, lone + 1, -1 - chars[lone]))
    source, target, piece = (np.concatenate(x).astype(np.int32) for x in zip(*found))
    del found, node, limit
    # Each length gave its edges in order, so sorting by target merges a few runs; sorting by depth keeps that order.
    order = np.argsort(target, kind="stable")
    source, target, piece = source[order], target[order], piece[order]
    own = part[source]
    depth = target - starts.astype(np.int32)[own]
    source, target = source + own, target + own
    log_weight = np.where(piece >= 0, (alpha * model.log_weight)[np.maximum(piece, 0)], 0.0)
    borders = len(chars) + len(parts)
    order = np.argsort(depth.astype(np.int16) if lengths.max() < 1 << 15 else depth, kind="stable")
    forward = np.full(borders, -np.inf)
    forward[starts + np.arange(len(parts))] = 0.0
    cuts = np.flatnonzero(np.diff(depth[order], prepend=0, append=-1))
    for a, b in zip(cuts, cuts[1:]):
        e = order[a:b]
        value = forward[source[e]] + log_weight[e]
        heads = np.flatnonzero(np.diff(target[e], prepend=-1))
        top = np.maximum.reduceat(value, heads)
        sums = np.add.reduceat(np.exp(value - np.repeat(top, np.diff(heads, append=len(e)))), heads)
        forward[target[e[heads]]] = top + np.log(sums)
    del order, depth, own
    upto = np.cumsum(np.exp(forward[source] + log_weight - forward[target]))
    first = np.searchsorted(target, np.arange(borders))
    upto -= np.concatenate([[0.0], upto])[first[target]]
    last = np.flatnonzero(np.diff(target, append=-1))
    upto[last] = 2.0  # above every draw
    return Lattice(starts + np.arange(len(parts)), stops + np.arange(len(parts)), first, source, piece, upto)


def sample(texts: list[str], keys: np.ndarray, model: Pieces, alpha: float) -> list[np.ndarray]:
    """Ids of each text, drawn backwards through its lattice; draws depend on the text's key and place alone."""
    code: dict[str, int] = {}
    each, counts = [], []
    for text in texts:
        found = _PARTS.findall(" " + text) if text else []
        counts.append(len(found))
        each += [code.setdefault(p, len(code)) for p in found]
    if not each:
        return [np.empty(0, "<u4") for _ in texts]
    net = lattice(list(code), model, alpha)
    which = np.array(each)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    state = _mix(keys[owner] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    border, floor = net.stops[which], net.starts[which]
    active, drawn, n_drawn = np.arange(len(which)), [], np.zeros(len(which), np.int64)
    while len(active):
        state = _mix(state + np.uint64(0x9E3779B97F4A7C15))
        u = (state >> np.uint64(11)).astype(np.float64) * 2.0**-53
        edge = net.first[border]
        low = np.flatnonzero(net.upto[edge] <= u)
        while len(low):
            edge[low] += 1
            low = low[net.upto[edge[low]] <= u[low]]
        drawn.append((active, edge))
        n_drawn[active] += 1
        border = net.source[edge]
        go = border > floor
        active, border, floor, state = active[go], border[go], floor[go], state[go]
    ends = np.cumsum(n_drawn)
    edges = np.empty(ends[-1], np.int64)
    for step, (who, edge) in enumerate(drawn):
        edges[ends[who] - 1 - step] = edge
    ids = net.piece[edges]
    per_text = np.bincount(np.repeat(owner, n_drawn), minlength=len(texts))
    out = np.split(ids, np.cumsum(per_text)[:-1])
    return [(_with_bytes(x, model) if (x < 0).any() else x).astype("<u4") for x in out]


def _with_bytes(ids: np.ndarray, model: Pieces) -> np.ndarray:
    """Characters without a piece, held as -1 - code point, become the pieces of their UTF-8 bytes."""
    at = np.flatnonzero(ids < 0)
    raw = [chr(-1 - x).encode() for x in ids[at].tolist()]
    sizes = np.ones(len(ids), np.int64)
    sizes[at] = [len(r) for r in raw]
    out = np.repeat(ids, sizes)
    out[np.repeat(ids < 0, sizes)] = model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out


def _chunks(lengths: list[int | None], most: int) -> Iterator[slice]:
    start = held = 0
    for i, length in enumerate(lengths):
        if held and held + (length or 0) > most:
            yield slice(start, i)
            start, held = i, 0
        held += length or 0
    if lengths:
        yield slice(start, len(lengths))


def encode_sampled(docs: DataFrame, model: str | None = None, alpha: float = ALPHA, seed: int = 0) -> DataFrame:
    """(doc_id, ids binary: little-endian 32-bit, n_pieces, text_crc32): one sampled segmentation of each text.

    The draw for a row depends on its doc_id and the seed alone, whatever the partitioning; rows with equal doc_id and
    text are cut alike. A literal U+2581 and every character without a piece go through byte pieces. A null or empty
    text has no pieces; a null doc_id is a key of its own; other columns are ignored; an empty table gives no rows.
    Memory: the lattices of about ``CHUNK_CHARS`` characters (or of one text).
    """
    path = model or default_model()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = pieces_of(path)
        for batch in batches:
            for rows in _chunks(pc.utf8_length(batch.column("text")).to_pylist(), CHUNK_CHARS):
                ids, texts = (c.slice(rows.start, rows.stop - rows.start).to_pylist() for c in batch.columns)
                keys = _mix(np.array([-1 if i is None else i for i in ids], np.int64).view(np.uint64) + np.uint64(seed * 2 + 1))
                drawn = sample([t or "" for t in texts], keys, loaded, alpha)
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array([x.tobytes() for x in drawn], pa.binary()),
                    pa.array(list(map(len, drawn)), pa.int64()),
                    pa.array([zlib.crc32((t or "").encode()) for t in texts], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_pieces", "text_crc32"])

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(each, "doc_id long, ids binary, n_pieces long, text_crc32 long")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """Adds ``text``, what the ids spell; without ids (null or empty) the text is empty. Works on sampled and best segmentations alike."""
    path = model or default_model()
    columns = [c for c in encoded.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "text") + ", text string"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = once_per_worker(f"raw:{path}", lambda: _raw_pieces(path))
        for batch in batches:
            for at in range(0, batch.num_rows, _DECODED):
                part = batch.slice(at, _DECODED)
                spelled = [b"".join(map(raw.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x[1:].decode() for x in spelled], pa.string())], names=[*columns, "text"])

    return encoded.drop("text").mapInArrow(each, schema)
