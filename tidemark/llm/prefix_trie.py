"""The prefix trie of conversations by ROLLUP (operator 12).

A conversation is cut into blocks of ``WIDTH`` turns; a block's row holds its turn ids in positional columns and the node
its block begins at. One ``GROUP BY ..., ROLLUP(t0, t1, ...)`` over all blocks meets every prefix of every conversation;
grouping_id tells how many columns a row is grouped by, so its depth. A long conversation goes on in further blocks, keyed
by the node that the block before it ended at. That node's key is a sum of block digests, each with the block's number,
so all blocks get their keys from running sums at once and a conversation of any length takes no rounds.

Figures of a subtree are sums over conversations, so they roll up the same way: each node is counted by its smallest
member, which owns a stretch of nodes at the end of its own path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ledger import running_sums
from tidemark.functions.stage import staged
from tidemark.llm.numbering import numbered

#: Turns of a block; first turns that conversations of one hundred may share.
WIDTH, HEADS = 8, 5
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_LANES = [f"p{i}" for i in range(4)]
_TURNS = [f"t{i}" for i in range(WIDTH)]


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of the sha-256 of role and text (null: empty), and the text's length in code points."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.concat(F.substring(digest, 1, 32), F.lit(":"), F.length(text).cast("string"))


def turn_texts(conversations: DataFrame) -> DataFrame:
    """turn_id, role, text: what the ids in ``prefix_nodes`` stand for."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    return conversations.select(turn_id(F.col("role"), F.col("text")).alias("turn_id"), role, text).groupBy("turn_id").agg(F.first("role").alias("role"), F.first("text").alias("text"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), turn_id: turns by number, null first; turns of equal number by their digest.

    Repeated rows are turns of their own. Rows without conv_id belong to no conversation and are left out.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_id(F.col("role"), F.col("text")).alias("turn_id"))
    counted = rows.groupBy("conv_id", "turn", "turn_id").agg(F.count(F.lit(1)).alias("n"))
    return numbered(counted, ["conv_id"], ["turn", "turn_id"], "n", "place").drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, turn_id) of every conversation rebuilt on the first turns of its hundred's first, and (conv_id, n_turns)."""
    turns = staged(turns, "turns")
    sizes = staged(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")), "sizes")
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("shared")
    convs = sizes.select("conv_id", "own", shared, (F.col("conv_id") - F.col("conv_id") % 100).alias("first"))
    firsts = sizes.select(F.col("conv_id").alias("first"), F.col("own").alias("first_own"))
    taken = F.least("shared", F.coalesce("first_own", F.lit(0).cast("long")))
    convs = staged(convs.join(firsts, "first", "left").select("conv_id", "first", "own", "shared", taken.alias("taken")), "convs")
    heads = turns.where((F.col("place") < HEADS) & (F.col("conv_id") % 100 == 0)).withColumnRenamed("conv_id", "first")
    begun = convs.join(heads, "first").where("place < taken").select("conv_id", "place", "turn_id")
    kept = turns.join(convs.select("conv_id", "shared", "taken"), "conv_id").where("place >= shared")
    rest = kept.select("conv_id", (F.col("place") - F.col("shared") + F.col("taken")).alias("place"), "turn_id")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))).alias("n_turns"))
    return begun.unionByName(rest), lengths


def _lanes(turn_ids: Column) -> list[Column]:
    """Four summands of a node's key from a block's number and turn ids."""
    digest = F.sha2(F.concat_ws(",", F.col("block").cast("string"), turn_ids).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _key(turn_ids: Column) -> Column:
    """The node that lies ``turn_ids`` beyond the node the block begins at."""
    return F.concat_ws(".", *[F.col(p) + lane for p, lane in zip(_LANES, _lanes(turn_ids))])


def _begins() -> Column:
    return F.concat_ws(".", *_LANES)


ROOT = "0.0.0.0"


def _blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv_id, block, p0.. (the node the block begins at), t0.. (turn ids), long (whether the conversation has more blocks), last."""
    block, at = F.expr(f"place div {WIDTH}").alias("block"), F.col("place") % WIDTH
    rows = turns.groupBy("conv_id", block).agg(*[F.max(F.when(at == i, F.col("turn_id"))).alias(t) for i, t in enumerate(_TURNS)])
    ends = lengths.where("n_turns > 0").select("conv_id", F.expr(f"(n_turns - 1) div {WIDTH}").alias("end"))
    own = [lane.alias(f"own{i}") for i, lane in enumerate(_lanes(F.array_compact(F.array(*_TURNS))))]
    rows = staged(rows.join(ends, "conv_id").select("conv_id", "block", *_TURNS, (F.col("end") > 0).alias("long"), (F.col("block") == F.col("end")).alias("last"), *own), "rows")
    sums = running_sums(rows.where("long"), ["block"], [f"own{i}" for i in range(4)], ["conv_id"])
    later = sums.select("conv_id", "block", *[(F.col(f"cum_own{i}") - F.col(f"own{i}")).alias(p) for i, p in enumerate(_LANES)], *_TURNS, "long", "last")
    only = rows.where("NOT long").select("conv_id", "block", *[F.lit(0).cast("long").alias(p) for p in _LANES], *_TURNS, "long", "last")
    return staged(only.unionByName(later), "blocks")


def _rolled(blocks: DataFrame, figures: str) -> DataFrame:
    """One row per node: ``at`` (how many turns into its block), its turn ids (``ids``), where its block begins, and the figures."""
    name = {"blocks": blocks}
    keys, turns = ", ".join(["block", *_LANES]), ", ".join(_TURNS)
    rows = blocks.sparkSession.sql(f"SELECT {keys}, {turns}, {WIDTH} - bit_count(grouping_id()) AS at, {figures} FROM {{blocks}} GROUP BY {keys}, ROLLUP({turns})", **name)
    # nothing is known of the block's first node here, and a conversation that has ended is in no longer prefix
    return rows.withColumn("ids", F.array_compact(F.array(*_TURNS))).where("at > 0 AND size(ids) = at").drop(*_TURNS)


def _ends(blocks: DataFrame, lengths: DataFrame) -> DataFrame:
    """key, ends_sha256: the conversations that end at a node, ascending, comma-joined, hashed.

    Ids are joined 8,192 numbers at a time (no two conversations share an id) and the stretches of a node pass through the
    hash in order, so a task holds one stretch of a node at a time.
    """
    last = blocks.where("last").select(_key(F.array_compact(F.array(*_TURNS))).alias("key"), "conv_id")
    none = lengths.where("n_turns = 0").select(F.lit(ROOT).alias("key"), "conv_id")
    stretch = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    parts = last.unionByName(none).groupBy("key", F.shiftright("conv_id", 13).alias("part")).agg(stretch.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            out: list[tuple[str, str]] = []
            for now, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if now != key:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    return parts.repartition("key").sortWithinPartitions("key", "part").mapInArrow(hashed, "key string, ends_sha256 string")


def prefix_nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and turn_id of its last turn (root: null).

    ``turns`` holds (conv_id, place from 0, turn_id), ``lengths`` one row (conv_id, n_turns) per conversation, also for one
    without turns, which is a member of the root. conv_id is the smallest member and, with the depth, names the node.
    Without conversations there is no root and no row. Hot prefixes are aggregated partially before each shuffle.
    """
    blocks = _blocks(turns, lengths)
    one = F.lit(1).cast("long")
    rolled = _rolled(blocks, "count(1) AS n_convs, min(conv_id) AS conv_id")
    before = F.when(F.col("at") == 1, _begins()).otherwise(_key(F.slice("ids", 1, F.greatest(F.col("at") - 1, F.lit(1)))))
    chars = F.element_at(F.split(F.element_at("ids", -1), ":"), 2).cast("long")
    nodes = rolled.select(
        _key(F.col("ids")).alias("key"), before.alias("parent"), (F.col("block") * WIDTH + F.col("at")).cast("long").alias("depth"), "conv_id", "n_convs", chars.alias("chars"), F.element_at("ids", -1).alias("turn_id")
    )
    top = lengths.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    top = top.select(F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"), F.lit(None).cast("string").alias("turn_id"))
    nodes = staged(nodes.unionByName(top), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "counted")

    # what each conversation adds to the subtrees on its path: the weights of the nodes it owns, from the deepest up
    at, weight = (F.col("depth") - 1) % WIDTH, (F.col("n_convs") - 1) * F.col("chars")
    owned = nodes.where("depth > 0").groupBy("conv_id", F.expr(f"(depth - 1) div {WIDTH}").alias("block")).agg(
        *[F.sum(F.when(at == i, weight)).alias(f"w{i}") for i in range(WIDTH)], F.sum(weight).alias("weight"), F.sum(F.when(F.col("n_children") == 0, one)).alias("leaf")
    )
    owned = owned.select("conv_id", "block", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*[f"w{i}" for i in range(WIDTH)], "weight", "leaf")])
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in owned.columns[2:]]
    adding = staged(blocks.join(owned, ["conv_id", "block"], "left").select("conv_id", "block", *_LANES, *_TURNS, "long", *zero), "adding")
    only = adding.where("NOT long").select("*", F.col("weight").alias("below"), F.col("leaf").alias("leaves"))
    later = running_sums(adding.where("long"), ["block"], ["weight", "leaf"], ["conv_id"])
    later = later.select(*adding.columns, (F.col("tot_weight") - F.col("cum_weight") + F.col("weight")).alias("below"), F.col("tot_leaf").alias("leaves"))
    upto = [F.col("below") - sum([F.col(f"w{k}") for k in range(i)], F.lit(0)) for i in range(WIDTH)]
    adding = only.unionByName(later).where("below > 0 OR leaves > 0").select("block", *_LANES, *_TURNS, "leaves", *[u.cast("long").alias(f"s{i}") for i, u in enumerate(upto)])
    sums = _rolled(adding, f"sum(leaves) AS n_leaves, array({', '.join(f'sum(s{i})' for i in range(WIDTH))}) AS saved")
    subtrees = sums.select(_key(F.col("ids")).alias("key"), "n_leaves", F.element_at("saved", F.col("at").cast("int")).alias("saved_tokens"))
    whole = nodes.agg(F.sum(F.when(F.col("n_children") == 0, one)).alias("n_leaves"), F.sum(weight).alias("saved_tokens"))
    subtrees = subtrees.unionByName(whole.select(F.lit(ROOT).alias("key"), "n_leaves", "saved_tokens"))

    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(parents, "parent", "left").join(subtrees, "key", "left").join(_ends(blocks, lengths), "key", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), "turn_id",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of its hundred's first conversation.

    Null role or text is empty; equal turn numbers are ordered by digest; repeated rows are turns; rows without conv_id are
    left out; texts are never cut; extra columns are ignored; an empty table gives no rows.
    """
    return prefix_nodes(*rebuilt(ordered_turns(conversations)))


#: Fixed value: the reversed polynomial of crc32.
ORACLE = """WITH entry AS (SELECT range AS i, list_reduce(list_prepend(range::BIGINT, range(8)), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256)),
code AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM entry),
ids AS (SELECT conv_id, turn, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] || ':' || length(coalesce(text, '')) AS id FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids FROM ids GROUP BY conv_id),
hashed AS (SELECT conv_id, ids, conv_id - conv_id % 100 AS first, (xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 6)::BIGINT AS h FROM own, code),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(f.ids, [])[1:c.h], c.ids[c.h + 1:]) AS ids FROM hashed c LEFT JOIN own f ON f.conv_id = c.first),
members AS (SELECT conv_id, ids, len(ids) AS n, unnest(range(len(ids) + 1)) AS depth FROM rebuilt),
nodes AS (SELECT ids[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth) AS ends FROM members GROUP BY ALL),
child AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * split_part(prefix[depth], ':', 2)::BIGINT ELSE 0 END AS weight FROM nodes n LEFT JOIN child c USING (prefix)),
above AS (SELECT prefix, n_children, weight, unnest(range(depth + 1)) AS d FROM counted),
below AS (SELECT prefix[1:d] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(weight) AS saved FROM above GROUP BY 1)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256, n.prefix[n.depth] AS turn_id
FROM counted n JOIN below b ON n.prefix = b.prefix LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]"""
