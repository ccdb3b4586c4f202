"""Bounded-space online packing of documents into fixed windows (operator 10)."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.llm import bpe

SEQUENCE, END_ID = 2048, 1
#: Windows that a task keeps open, tasks whose leftovers meet in one, and the shortest piece cut to fill a gap.
OPEN_WINDOWS, FAN_IN, LEAST_CUT = 16, 32, 16
_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_PIECES = f"{_COLUMNS}, left_by long"
_ARROW = pa.schema([(c.split(" ")[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in _PIECES.split(", ")])


class Windows:
    """Open windows of one task, best fit by their gaps. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int, most: int, least_cut: int, first_id: int) -> None:
        self.size, self.most, self.least_cut, self.next_id = size, most, least_cut, first_id
        self.gaps: list[tuple[int, int]] = []  # (gap, window), smallest first
        self.held: dict[int, list[tuple]] = {}
        self.made = 0
        self.full: list[list[tuple]] = []

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        whole = len(ids) - len(ids) % self.size
        for at in range(0, whole, self.size):
            self.full.append([(doc_id, start + at, ids[at : at + self.size], doc_tokens)])
        start, ids = start + whole, ids[whole:]
        while len(ids):
            k = bisect_left(self.gaps, (len(ids), -1))
            if k < len(self.gaps):
                self._put(k, (doc_id, start, ids, doc_tokens))
                return
            if len(self.gaps) < self.most:
                self.made += 1
                self.held[self.made] = [(doc_id, start, ids, doc_tokens)]
                insort(self.gaps, (self.size - len(ids), self.made))
                return
            gap = self.gaps[0][0]
            if gap < self.least_cut:
                self.full.append(self.held.pop(self.gaps.pop(0)[1]))
            else:
                self._put(0, (doc_id, start, ids[:gap], doc_tokens))
                start, ids = start + gap, ids[gap:]

    def _put(self, k: int, piece: tuple) -> None:
        gap, window = self.gaps.pop(k)
        self.held[window].append(piece)
        if gap == len(piece[2]):
            self.full.append(self.held.pop(window))
        else:
            insort(self.gaps, (gap - len(piece[2]), window))

    def rows(self, windows: list[list[tuple]], keep_ids: bool, left_by: int | None = None) -> Iterator[tuple]:
        for window in windows:
            offset = 0
            for doc_id, start, ids, doc_tokens in window:
                data = ids.tobytes()
                yield doc_id, start, len(ids), zlib.crc32(data), doc_tokens, self.next_id, offset, data if keep_ids or left_by is not None else None, left_by
                offset += len(ids)
            self.next_id += 1


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_ARROW), _ARROW)], schema=_ARROW)


def _first_id(round_: int, task: int) -> int:
    return (round_ << 56) | (task << 28)


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE, open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN, least_cut: int = LEAST_CUT, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Each task keeps ``open_windows`` windows. Whole windows are cut off a long document; its rest goes to the window it
    fits best. If it fits nowhere, the fullest window is topped up with its head (when the gap is worth a cut) and
    emitted. The windows open at the end are merged ``fan_in`` tasks at a time, filling each window by cutting; what
    remains of the last merge is cut into lengths that are powers of two, so it needs no padding.

    A null or empty text is only the end id; a null doc_id stays null; equal rows are packed each for itself; other
    columns are ignored; an empty table gives no rows. A task that runs again packs alike; the first pass is written
    once, so ids of sequences never mix two runs.
    """
    path = vocabulary or bpe.default_path()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        windows = Windows(size, open_windows, least_cut, _first_id(0, task))
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(bpe.ids(path, text.as_py()), np.uint32(END_ID)).astype("<u4")
                windows.add(doc_id, 0, ids, len(ids))
            yield _frame(list(windows.rows(windows.full, keep_ids)))
            windows.full = []
        yield _frame(list(windows.rows(list(windows.held.values()), keep_ids, left_by=task)))

    def merge(round_: int, last: bool):
        def one(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: (r["sequence_id"], r["offset"]))
            group = rows[0]["left_by"] // fan_in
            windows = Windows(size, 1, 1, _first_id(round_, group))
            for r in rows:
                windows.add(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
            rest = [piece for window in windows.held.values() for piece in window]
            out = list(windows.rows(windows.full, keep_ids))
            if last:
                out += windows.rows(_by_powers(rest), keep_ids)
            elif rest:
                out += windows.rows([rest], keep_ids, left_by=group)
            return pa.Table.from_batches([_frame(out)])

        return one

    pieces = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(first, _PIECES), "packed")
    done, round_ = [pieces.where("left_by IS NULL")], 1
    left = pieces.where("left_by IS NOT NULL")
    tasks = (left.agg(F.max("left_by")).first()[0] or 0) + 1
    while True:
        tasks = -(-tasks // fan_in)
        merged = staged(left.withColumn("met", F.floor(F.col("left_by") / fan_in)).groupBy("met").applyInArrow(merge(round_, tasks == 1), _PIECES), "merged")
        done.append(merged.where("left_by IS NULL"))
        left, round_ = merged.where("left_by IS NOT NULL"), round_ + 1
        if tasks == 1:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("left_by") if keep_ids else out.drop("left_by", "ids")


def _by_powers(pieces: list[tuple]) -> list[list[tuple]]:
    """Cut what is left into windows whose lengths are powers of two, longest first."""
    total = sum(len(p[2]) for p in pieces)
    out: list[list[tuple]] = []
    queue = list(pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        window: list[tuple] = []
        while room:
            doc_id, start, ids, doc_tokens = queue.pop(0)
            window.append((doc_id, start, ids[:room], doc_tokens))
            if len(ids) > room:
                queue.insert(0, (doc_id, start + room, ids[room:], doc_tokens))
            room -= len(window[-1][2])
        out.append(window)
    return out
