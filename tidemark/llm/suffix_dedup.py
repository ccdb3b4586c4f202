"""Exact repeats of long byte strings by a sparse enhanced suffix array (operator 1).

A repeated string of ``length`` bytes cannot be found by looking at every suffix of a corpus at once. Two steps make it
a join. (1) Each window of ``length`` bytes has an anchor: the leftmost place whose next ``gram`` bytes hash lowest.
The anchor depends on the window's bytes alone, so equal windows have equal grams at equal places; windows whose gram
occurs once cannot repeat. (2) The windows that share an anchor form a run, and the bytes of the run are the anchor's
context. Among the contexts of one gram, the suffixes that follow the gram are sorted into a suffix array; a stack scan
over its common-prefix array gives the interval tree; in each interval the bytes before the gram are sorted and scanned
alike, which splits it by left extension. Each pair of intervals that is long enough is a maximal repeat group with all
its occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.llm import links
from tidemark.llm.common import once_per_worker

#: Bytes of a repeat, bytes hashed at an anchor, and contexts of a gram beyond which its windows are counted one by one.
LENGTH, GRAM, CROWD = 400, 128, 4096
_SLICE = 1 << 18
_BASE = 0xD1342543DE82EF95
_PLACE = np.uint64((1 << 24) - 1)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    def build() -> tuple[np.ndarray, ...]:
        each = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(_SLICE + 4096, x, np.uint64)])) for x in each)

    return once_per_worker("suffix-powers", build)


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers()[0][: len(data)], out=out[1:])
    return out


def _stretch(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return _mix((sums[stop] - sums[start]) * _powers()[1][start] + (stop - start).astype(np.uint64))


def runs(data: np.ndarray, stops: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, place of the gram, first and last window start) of the runs of joined texts.

    ``stops`` says where the text of each byte ends; windows that cross a border are left out.
    """
    width = length - gram + 1
    sums = _sums(data)
    starts = np.arange(len(data) - gram + 1)
    hashes = _stretch(sums, starts, starts + gram)
    least = (hashes & ~_PLACE) | starts.astype(np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    inside = np.flatnonzero(starts[: len(least)] + length <= stops[: len(least)])
    place = (least[inside] & _PLACE).astype(np.int64)
    heads = np.flatnonzero(np.diff(place, prepend=-1))
    first, last = inside[heads], inside[np.append(heads[1:], len(inside)) - 1]
    place = place[heads]
    shape = (place - first).astype(np.uint64) << np.uint64(20) | (last - first).astype(np.uint64)
    context = _mix(_stretch(sums, first, last + length) + _mix(shape))
    return hashes[place].view(np.int64), context.view(np.int64), place, first, last


def joined_texts(raws: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, stop of each byte's text, number of each byte's text, place of the first byte in it) in bounded pieces.

    Short texts are joined; a long one comes in slices that overlap by a window less one byte.
    """
    held: list[int] = []

    def piece() -> tuple[np.ndarray, ...]:
        sizes = np.array([len(raws[i]) for i in held])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join([raws[i] for i in held]), np.uint8)
        return data, np.repeat(ends, sizes), np.repeat(held, sizes), np.repeat(ends - sizes, sizes)

    size = 0
    for i, raw in enumerate(raws):
        if len(raw) > _SLICE:
            for at in range(0, len(raw) - length + 1, _SLICE):
                part = np.frombuffer(raw[at : at + _SLICE + length - 1], np.uint8)
                yield part, np.full(len(part), len(part)), np.full(len(part), i), np.full(len(part), -at)
            continue
        if held and size + len(raw) > _SLICE // 2:
            yield piece()
            held, size = [], 0
        held.append(i)
        size += len(raw)
    if held:
        yield piece()


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of a common-prefix array, children before parents; ``lcp[i]`` is of items i and i+1."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeat_groups(lefts: list[bytes], rights: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of every maximal group with left + right >= least; ``lefts`` are read backwards."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    most_left = max(map(len, lefts))
    for right, i, j in intervals([common(rights[a], rights[b]) for a, b in zip(order, order[1:])]):
        if right + most_left < least:
            continue
        members = sorted(order[i : j + 1], key=lefts.__getitem__)
        for left, p, q in intervals([common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]):
            if left + right >= least:
                yield left, right, members[p : q + 1]


def scan(table: pa.Table, length: int, gram: int, across: bool) -> dict[str, list] | None:
    """For the contexts of one gram: the stretches, relative to the gram, that maximal repeat groups cover.

    With ``across`` only groups count that occur in two documents; ``only`` names a context's document if it has one.
    """
    rows = {c: (l, r, o) for c, l, r, o in zip(*(table.column(n).to_pylist() for n in ("ctx", "left", "right", "only")))}
    if len(rows) < 2:
        return None
    keys = list(rows)
    owners = [rows[c][2] for c in keys]
    reach = length - gram
    cover = np.zeros((len(keys), 2 * reach + gram + 1), np.int32)
    for left, right, members in repeat_groups([rows[c][0] for c in keys], [rows[c][1] for c in keys], reach):
        if across and None not in (held := {owners[m] for m in members}) and len(held) == 1:
            continue
        cover[members, reach - left] += 1
        cover[members, reach + gram + right] -= 1
    out: dict[str, list] = {"gram": [], "ctx": [], "spans": []}
    on = np.cumsum(cover, axis=1) > 0
    for k in np.flatnonzero(on.any(axis=1)):
        edges = np.flatnonzero(np.diff(on[k].astype(np.int8), prepend=0, append=0)).reshape(-1, 2) - reach
        out["gram"].append(table.column("gram")[0].as_py())
        out["ctx"].append(keys[k])
        out["spans"].append([dict(lo=a, hi=b) for a, b in edges.tolist()])
    return out | {"spans": pa.array(out["spans"], pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))} if out["ctx"] else None


_SPANS = "gram long, ctx long, spans array<struct<lo:long,hi:long>>"


def _spans_by_text(long: DataFrame, length: int, gram: int, crowd: int, across: bool) -> tuple[DataFrame, DataFrame]:
    """(node, n_bytes, raw) of each text that shares a gram, and (node, n_bytes, spans) with the byte stretches to remove."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "node", "n_bytes", "gram", "ctx", "pos", "lo", "hi"]
        for batch in _few(batches):
            same = [batch.column(c) for c in names[:3]]
            for data, stops, number, origin in joined_texts(batch.column("raw").to_pylist(), length):
                grams, contexts, place, first, last = runs(data, stops, length, gram)
                own = [c.take(pa.array(number[place])) for c in same]
                cells = [grams, contexts, place - origin[place], first - place, last - place]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, cells)], names=names)

    schema = ", ".join(f"{c} long" for c in ("doc_id", "node", "n_bytes", "gram", "ctx", "pos", "lo", "hi"))
    found = long.mapInArrow(find, schema)
    # written first, so that adaptive execution can split a gram that many places share
    often = staged(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "often")
    shared = staged(found.join(often, "gram", "left_semi"), "shared")
    place = F.struct("doc_id", "node", "n_bytes", "pos", "lo", "hi")
    doc = F.struct("doc_id", "node", "n_bytes")
    contexts = shared.groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("rep"), F.max(doc).alias("far"))
    # the one document a context occurs in; null if it occurs in several
    one_doc = F.struct("rep.doc_id", "rep.node", "rep.n_bytes").eqNullSafe(F.col("far"))
    only = F.when(one_doc, F.concat_ws("/", "far.doc_id", "far.node", "far.n_bytes"))
    contexts = contexts.withColumn("only", only).withColumn("repeats", (F.col("n") > 1) & (F.col("only").isNull() if across else F.lit(True)))
    contexts = staged(contexts.drop("far"), "contexts")
    # A context that occurs twice repeats as a whole: it is a leaf of its own, however many copies it has.
    whole = contexts.where("repeats").select("gram", "ctx", F.array(F.struct(F.col("rep.lo").alias("lo"), (F.col("rep.hi") + length).alias("hi"))).alias("spans"))
    sizes = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("n_contexts"), F.bool_and("repeats").alias("done")).where("n_contexts > 1 AND NOT done")
    todo = contexts.join(sizes, "gram").select("gram", "ctx", "n", "only", (F.col("n_contexts") > crowd).alias("crowded"), "rep.*")
    wanted = todo.groupBy("node", "n_bytes", "doc_id").agg(F.collect_list(F.struct("gram", "ctx", "n", "only", "crowded", "pos", "lo", "hi")).alias("wanted"))
    firsts = shared.groupBy("node", "n_bytes").agg(F.min(F.struct("doc_id")).alias("first")).select("node", "n_bytes", F.col("first.doc_id").alias("doc"))
    # The smallest doc_id of a text stands for its copies, in its contexts as well.
    firsts = firsts.join(wanted.select("node", "n_bytes", "wanted"), ["node", "n_bytes"], "left")
    texts = long.join(firsts, ["node", "n_bytes"]).where(F.col("doc_id").eqNullSafe(F.col("doc")))
    # several rows may have that doc_id, or all of them none
    texts = staged(texts.select("node", "n_bytes", "raw", "wanted").dropDuplicates(["node", "n_bytes"]), "texts")

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            raws, wants = batch.column("raw"), batch.column("wanted").to_pylist()
            for raw, want in zip(raws, wants):
                data = raw.as_py()
                rows = [w for w in want or [] if not w["crowded"]]
                if rows:
                    cuts = [(w["pos"], w["pos"] + w["lo"], w["pos"] + w["hi"] + length) for w in rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w["gram"] for w in rows], pa.int64()), pa.array([w["ctx"] for w in rows], pa.int64()), pa.array([data[a:p][::-1] for p, a, _ in cuts], pa.binary()), pa.array([data[p + gram : b] for p, _, b in cuts], pa.binary()), pa.array([w["only"] for w in rows], pa.string())],
                        names=["gram", "ctx", "left", "right", "only"],
                    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            for raw, want in zip(batch.column("raw"), batch.column("wanted").to_pylist()):
                for w in want or []:
                    if w["crowded"]:
                        first, last = w["pos"] + w["lo"], w["pos"] + w["hi"]
                        sums = _sums(np.frombuffer(raw.as_py()[first : last + length], np.uint8))
                        at = np.arange(last - first + 1)
                        same = [pa.repeat(pa.scalar(w[c], pa.int64()), len(at)) for c in ("gram", "ctx", "n")]
                        yield pa.RecordBatch.from_arrays([*same, pa.repeat(pa.scalar(w["only"], pa.string()), len(at)), pa.array(_stretch(sums, at, at + length).view(np.int64)), pa.array(at + w["lo"])], names=["gram", "ctx", "n", "only", "window", "at"])

    cut = texts.mapInArrow(_together(contents), "gram long, ctx long, left binary, right binary, only string")
    scanned = links.map_groups(cut, "gram", lambda table: scan(table, length, gram, across), _SPANS)
    one_by_one = texts.where(F.exists("wanted", lambda w: w["crowded"])).mapInArrow(_together(windows), "gram long, ctx long, n long, only string, window long, at long")
    counted = one_by_one.groupBy("gram", "window").agg(F.sum("n").alias("times"), F.bool_or(F.col("only").isNull()).alias("several"), F.min("only").alias("least"), F.max("only").alias("most"))
    twice = counted.where("several OR least < most" if across else "times > 1").select("gram", "window")
    span = F.struct(F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))
    crowded = one_by_one.join(twice, ["gram", "window"]).groupBy("gram", "ctx").agg(F.collect_set(span).alias("spans"))
    spans = staged(whole.unionByName(scanned).unionByName(crowded), "spans")
    placed = shared.select("gram", "ctx", "node", "n_bytes", "pos").join(spans, ["gram", "ctx"])
    absolute = F.transform("spans", lambda s: F.struct((s["lo"] + F.col("pos")).alias("lo"), (s["hi"] + F.col("pos")).alias("hi")))
    by_text = placed.select("node", "n_bytes", F.explode(absolute).alias("span")).groupBy("node", "n_bytes").agg(F.collect_set("span").alias("spans"))
    return texts.drop("wanted"), by_text


def _few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of the batches: texts and their lists of spans are many times as large as Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _together(fn, rows: int = 20_000, size: int = 8 << 20):
    """Join the small batches that ``fn`` yields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = n_bytes = 0
        for batch in fn(batches):
            held.append(batch)
            n += batch.num_rows
            n_bytes += batch.get_total_buffer_size()
            if n >= rows or n_bytes >= size:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n, n_bytes = [], 0, 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def merged(spans: list[dict]) -> np.ndarray:
    """Runs covered by the spans, in order."""
    pairs = np.array(sorted((s["lo"], s["hi"]) for s in spans), np.int64).reshape(-1, 2)
    top = np.maximum.accumulate(pairs[:, 1])
    new = np.flatnonzero(np.append(True, pairs[1:, 0] > top[:-1]))
    return np.stack([pairs[new, 0], top[np.append(new[1:], len(pairs)) - 1]], axis=1)


_SPACE = b" \t\n\x0b\x0c\r"


def whole_words(raw: bytes, runs: np.ndarray, least: int) -> np.ndarray:
    """The runs, cut back to whole words (ASCII white space between them), that hold ``least`` words."""
    out = []
    for a, b in runs.tolist():
        if a and raw[a - 1] not in _SPACE:
            while a < b and raw[a] not in _SPACE:
                a += 1
        if b < len(raw) and raw[b] not in _SPACE:
            while b > a and raw[b - 1] not in _SPACE:
                b -= 1
        if len(raw[a:b].split()) >= least:
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def removed_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, keep_text: bool = False, across: bool = False, words: int = 0
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and with ``keep_text`` all columns of ``docs``, text being what is left).

    Every byte covered by a string of ``length`` bytes that also starts elsewhere, in the same document or another, is
    removed, every occurrence alike; strings are judged on the input. With ``across`` a string counts only if it occurs in
    two documents (rows that differ in doc_id or text), and with ``words`` a maximal run only if it holds that many whole
    words, to which it is cut back. Texts are their UTF-8 bytes; null is empty; shorter texts lose nothing; kept text drops
    the remains of characters that were cut. Equal texts are one node (64-bit hash and length) after the first shuffle: a
    context and its copies meet as one row with a count, and one row of a text is cut, also where doc_ids repeat or are
    null; every row of ``docs`` comes out once. The contexts of a gram are one task's work up to ``crowd``;
    beyond that every window is counted on its own, with partial counts, so no group grows with the corpus. A text's
    spans are as many as its own windows at most. Extra columns, whatever their names, are carried by ``keep_text`` and
    else ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.cast("binary").alias("raw"))
    base = base.withColumn("n_bytes", F.length("raw").cast("long"))
    long = base.where(F.col("n_bytes") >= length).select("doc_id", "node", "n_bytes", "raw")
    texts, spans = _spans_by_text(long, length, gram, crowd, across)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            rows = []
            for node, n_bytes, raw, own in zip(*(batch.column(c).to_pylist() for c in ("node", "n_bytes", "raw", "spans"))):
                runs = merged(own)
                if words:
                    runs = whole_words(raw, runs, words)
                left = b"".join(raw[a:b] for a, b in zip([0, *runs[:, 1].tolist()], [*runs[:, 0].tolist(), len(raw)]))
                rows.append((node, n_bytes, int((runs[:, 1] - runs[:, 0]).sum()), len(runs), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if keep_text else None))
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["node", "n_bytes", "n_removed", "n_spans", "sha", "left_text"])

    schema = "node long, n_bytes long, n_removed long, n_spans long, sha string, left_text string"
    results = staged(texts.join(spans, ["node", "n_bytes"]).mapInArrow(cut, schema), "cut")
    if keep_text:
        joined = base.select("row", "node", "n_bytes").join(results.select("node", "n_bytes", "left_text"), ["node", "n_bytes"], "left")
        return joined.select(*[F.coalesce("left_text", "row.text").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
    plain = base.select("doc_id", "node", "n_bytes", F.sha2("raw", 256).alias("whole_sha"))
    joined = plain.join(results.drop("left_text"), ["node", "n_bytes"], "left")
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "whole_sha").alias("kept_sha256"))
