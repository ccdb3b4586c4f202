"""Shards by jump consistent hashing (operator 11).

The shard of a row follows from its key and the number of shards alone: a pseudo-random walk that starts at the key jumps
ahead through the shard numbers, and the last number below the number of shards is the row's shard. There is no ring
table. With one shard more only those walks change that would have landed on the new shard, so a row moves there or stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.numbering import numbered

#: Shards of the registered query.
SHARDS = 16
_STEP = np.uint64(2862933555777941757)


def jumps(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of every 64-bit key among ``shards``, and among one more."""
    state = keys.astype(np.uint64)
    now, grown = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    at, live = np.zeros(len(state), np.int64), np.arange(len(state))
    while len(live):
        state[live] = state[live] * _STEP + np.uint64(1)
        far = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        at[live] = ((at[live] + 1) * (float(1 << 31) / far)).astype(np.int64)
        grown[live[at[live] <= shards]] = at[live[at[live] <= shards]]
        live = live[at[live] < shards]
        now[live] = at[live]
    return now, grown


def stable_key(key: Column) -> Column:
    """The first 64 bits of the md5 of the key as text, signed; null counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 16), 16, -10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """A struct of the shard of a 64-bit key among ``shards`` (``now``) and among one more (``grown``)."""
    if shards < 1:
        raise ValueError("there must be a shard")

    @F.pandas_udf("now int, grown int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for keys in batches:
            now, grown = jumps(keys.to_numpy().view(np.uint64), shards)
            yield pd.DataFrame({"now": now.astype(np.int32), "grown": grown.astype(np.int32)})

    return place(key)


def assign_shards(df: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` and ``grown_shard`` (with one shard more); columns of these names are replaced.

    Equal keys share a shard, null keys too. Nothing is shuffled.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in ("shard", "grown_shard")]
    placed = df.select(*others, shard_of(stable_key(F.col(key)), shards).alias("_place"))
    return placed.select(*others, F.col("_place.now").alias("shard"), F.col("_place.grown").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id") -> None:
    """Write every row below ``path/shard=<number>``; a shard with a hot key is written by several tasks."""
    assign_shards(df, shards, key).drop("grown_shard").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def moved_rows(df: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """The rows that one more shard takes, with the shard they leave (``shard``) and the new one (``grown_shard``)."""
    return assign_shards(df, shards, key).where("shard <> grown_shard")


def shard_slots(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document.

    Size is the text's UTF-8 bytes plus 1 (null text: 1); the checksum of a null or empty text is 0. The law is ``key``.
    Slots of a shard run from 0 in the order of (hashed key, doc_id, size, checksum), so they are the same in every run and
    for every layout of the files. Rows equal in these columns (repeated rows, null doc_ids with equal texts) are counted
    on the map side and take neighbouring slots; different rows of one hot doc_id are spread by size and checksum, so no
    task holds a whole shard or key. Extra columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    counted = narrow.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")).withColumn("key", stable_key(F.col("doc_id")))
    counted = counted.withColumn("place", shard_of(F.col("key"), shards))
    counted = counted.select("*", F.col("place.now").alias("shard"), F.col("place.grown").alias("grown_shard"))
    slots = numbered(counted, ["shard"], ["key", "doc_id", "size", "text_crc32", "grown_shard"], "n", "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: The reversed polynomial of crc32 and the multiplier of the walk.
ORACLE = f"""WITH RECURSIVE entry AS (SELECT range AS i, list_reduce(list_prepend(range::BIGINT, range(8)), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256)),
code AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM entry),
texts AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
hexed AS (SELECT doc_id, octet_length(b) + 1 AS size, hex(b) AS h FROM texts),
bytes AS (SELECT doc_id, size, list_transform(range(size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM hexed),
summed AS (SELECT doc_id, size::BIGINT AS size, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])))::BIGINT AS text_crc32 FROM bytes, code),
keyed AS (SELECT DISTINCT doc_id, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:16])::UBIGINT AS key FROM documents),
walk AS (SELECT doc_id, key::HUGEINT AS state, 0::BIGINT AS place, 0::BIGINT AS shard, 0::BIGINT AS grown FROM keyed
UNION ALL SELECT doc_id, follow, land, CASE WHEN land < {SHARDS} THEN land ELSE shard END, CASE WHEN land <= {SHARDS} THEN land ELSE grown END FROM
(SELECT *, floor((place + 1) * (2147483648.0::DOUBLE / (follow // 8589934592 + 1)::DOUBLE))::BIGINT AS land FROM
(SELECT *, ((state // 4294967296 * 2862933555777941757 % 4294967296) * 4294967296 + state % 4294967296 * 2862933555777941757 + 1) % 18446744073709551616 AS follow FROM walk WHERE place < {SHARDS}))),
done AS (SELECT * FROM walk WHERE place >= {SHARDS}),
joined AS (SELECT s.doc_id, s.size, s.text_crc32, d.shard::INTEGER AS shard, d.grown::INTEGER AS grown_shard, k.key FROM summed s JOIN done d ON s.doc_id IS NOT DISTINCT FROM d.doc_id JOIN keyed k ON s.doc_id IS NOT DISTINCT FROM k.doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY CASE WHEN key >= 9223372036854775808 THEN key::HUGEINT - 18446744073709551616 ELSE key::HUGEINT END, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM joined"""
