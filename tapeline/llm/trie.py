"""The prefix trie of conversations by Spark SQL's ROLLUP over columns of turn ids, in blocks for long conversations."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialise, shuffle_partitions, small_batches, table
from .merkle import CRC_TABLE, crc_sql
from .running import running

#: Turns of one block: columns of the rollup, which makes so many rows and one more of each block row before it combines them.
BLOCK = 8

#: Conversations that share a start in the registered query, and the most turns they share.
FAMILY, HEADS = 20, 4

#: Ids of one run when the members that end at a node are hashed in order.
RUN_IDS = 4096

TURNS = [f"t{k}" for k in range(1, BLOCK + 1)]
PRIOR = [f"p{k}" for k in range(4)]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0, by turn, null first, then by id), id (SHA-256 of role and text) and words of every turn; texts are left behind.

    Rows without conv_id belong to no conversation and are left out. Null roles and texts are empty ones.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    return running(materialise(rows), "conv_id", [F.col("turn").asc_nulls_first(), F.col("id")], {"pos": F.lit(1).cast("long")})


def rebuilt(turns: DataFrame, base: Column, shared: Column) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) whose first `shared` turns are those of conversation `base`, both expressions over conv_id.

    turns: conv_id, pos, id, words; conversations: conv_id and size, turnless ones too. A conversation is the first turns of
    its base, all if it has fewer and none if there is no base, and then its own turns behind its first `shared`.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumn("base", base).withColumn("shared", shared.cast("long"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_size"))
    convs = convs.join(sizes, "base", "left").withColumn("head", F.least("shared", F.coalesce("base_size", F.lit(0).cast("long"))))
    convs = materialise(convs.select("conv_id", "base", "shared", "head", (F.col("head") + F.greatest(F.col("own") - F.col("shared"), F.lit(0).cast("long"))).alias("size")))
    first = turns.withColumnRenamed("conv_id", "base").join(convs.filter("head > 0").select("conv_id", "base", "head"), "base").filter("pos < head").select("conv_id", "pos", "id", "words")
    rest = turns.join(convs.select("conv_id", "shared", "head"), "conv_id").filter("pos >= shared").select("conv_id", (F.col("pos") - F.col("shared") + F.col("head")).alias("pos"), "id", "words")
    return first.unionByName(rest), convs.select("conv_id", "size")


def _node_key(turns: list[str]) -> Column:
    """The key of the node that a block row's prior node and these turns (null ones left out) lead to; all BLOCK turns lead to the next block's prior node."""
    inside = F.sha2(F.concat_ws("|", "block", *PRIOR, *[F.hex(t) for t in turns]), 256)
    if len(turns) < BLOCK:
        return inside
    return F.when(F.col(turns[-1]).isNotNull(), F.sha2(F.concat_ws("|", F.col("block") + 1, *[F.col(p) + _part(k) for k, p in enumerate(PRIOR)]), 256)).otherwise(inside)


def _part(k: int) -> Column:
    """32 bits of a hash of a full block and its place."""
    return F.xxhash64(F.lit(k), "block", *TURNS).bitwiseAND(0xFFFFFFFF)


def _of_long(rows: DataFrame, order: Column, sums: dict[str, Column]) -> DataFrame:
    """Running sums over the blocks of conversations that have more than one; the others have none before them."""
    short = rows.filter(F.col("size") <= BLOCK).select("*", *[F.lit(0).cast("long").alias(n) for n in sums])
    return short.unionByName(running(rows.filter(F.col("size") > BLOCK), "conv_id", [order], sums))


def block_rows(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and block of BLOCK turns: t1.. and w1.. (ids and words, null behind the end), size, and p0..p3, which name the node before the block.

    That node is the sum of hashes of the conversation's earlier blocks, 4 times 32 bits, so no block waits for another. Turnless conversations have one block without turns.
    """
    slot = F.col("pos") % BLOCK
    rows = turns.select("conv_id", F.floor(F.col("pos") / BLOCK).alias("block"), slot.alias("slot"), "id", "words", F.lit(None).cast("long").alias("size"))
    ends = convs.select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / BLOCK))).alias("block"), "size")
    rows = rows.unionByName(ends, allowMissingColumns=True)
    at = [F.col("slot") == k for k in range(BLOCK)]
    blocks = rows.groupBy("conv_id", "block").agg(
        F.max("size").alias("size"), *[F.max(F.when(at[k], F.col("id"))).alias(f"t{k + 1}") for k in range(BLOCK)], *[F.max(F.when(at[k], F.col("words"))).alias(f"w{k + 1}") for k in range(BLOCK)]
    )
    return _of_long(materialise(blocks), F.col("block"), {p: _part(k) for k, p in enumerate(PRIOR)})


def rolled(blocks: DataFrame, *measures: str) -> DataFrame:
    """ROLLUP over a block's turn columns: a row per node with block, PRIOR, TURNS, depth and the measures. A block's own prefix of no turns is a node in block 0 only: else it is the last of the block before."""
    by = ", ".join(["block", *PRIOR])
    found = blocks.sparkSession.sql(
        f"select {by}, {', '.join(TURNS)}, {BLOCK} - bit_count(grouping_id()) as inside, {', '.join(measures)} from {{blocks}} group by {by}, rollup({', '.join(TURNS)})", blocks=blocks
    )
    turns = sum((F.col(t).isNotNull().cast("int") for t in TURNS), F.lit(0))
    real = (turns == F.col("inside")) & ((F.col("inside") > 0) | (F.col("block") == 0))
    return found.filter(real).withColumn("depth", F.col("block") * BLOCK + F.col("inside"))


def _runs(batches):
    """Rows (node, conv_id) in order: runs of at most RUN_IDS ids of a node as (node, first id, ids with commas)."""
    now, ids = None, []
    for batch in batches:
        out = []
        for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != now or len(ids) >= RUN_IDS:
                if ids:
                    out.append((now, ids[0], ",".join(map(str, ids))))
                now, ids = node, []
            ids.append(conv)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["node", "first", "ids"])
    if ids:
        yield pa.RecordBatch.from_pydict({"node": pa.array([now]), "first": pa.array([ids[0]], pa.int64()), "ids": pa.array([",".join(map(str, ids))])})


def _hashed(batches):
    """Rows (node, first id, ids) in order: (node, SHA-256 of all its ids with commas). One running hash is held, no list."""
    now, sha = None, None
    for batch in batches:
        out = []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if node != now:
                if sha:
                    out.append((now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in (0, 1)], ["node", "ends_sha256"])
    if sha:
        yield pa.RecordBatch.from_pydict({"node": [now], "ends_sha256": [sha.hexdigest()]})


def end_hashes(blocks: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end. Ids are dealt by ranges of node and id and joined to runs; only runs meet in a node's task."""
    small_batches(blocks.sparkSession)
    last = blocks.filter(F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / BLOCK) == F.col("block"))
    ends = materialise(last.select(_node_key(TURNS).alias("node"), "conv_id"))
    parts = shuffle_partitions(blocks.sparkSession)
    runs = ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(_runs, "node string, first long, ids string")
    return runs.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the trie.

    turns and convs are as `rebuilt` returns them. A node is a distinct sequence of first turns; the root has none. A node belongs to its
    smallest member, so the nodes of a conversation are the last part of its path; what a subtree sums up is a sum over members of
    what they own from the node's depth on. So two rollups over all blocks at once suffice, however long a conversation is: the first tells who owns
    which node, the second adds up. Equal conversations and hot first turns are combined before they are shuffled. Empty tables give no rows.
    """
    blocks = materialise(block_rows(turns, convs))
    nodes = rolled(blocks, "min(conv_id) as conv_id", "count(*) as n_convs", "max(size) as longest")
    spread = [F.max(F.when(F.col("inside") == k, F.col("n_convs") - 1)).alias(f"n{k}") for k in range(1, BLOCK + 1)]
    owned = nodes.groupBy("conv_id", "block").agg(F.max(F.when(F.col("longest") == F.col("depth"), F.col("inside"))).alias("leaf"), *spread)
    valued = blocks.join(owned, ["conv_id", "block"], "left")
    zero = F.lit(0).cast("long")
    saved = [zero, *[F.coalesce(F.col(f"n{k}") * F.col(f"w{k}"), zero) for k in range(1, BLOCK + 1)]]
    behind = [sum(saved[k:], zero) for k in range(BLOCK + 1)]
    valued = valued.select("conv_id", "block", "size", *PRIOR, *TURNS, *[b.alias(f"s{k}") for k, b in enumerate(behind)], F.coalesce("leaf", F.lit(-1)).alias("leaf"))
    valued = _of_long(materialise(valued), F.col("block").desc(), {"later": F.col("s0"), "later_leaves": (F.col("leaf") >= 0).cast("long")})
    sums = [f"sum(s{k} + later) as s{k}" for k in range(BLOCK + 1)] + [f"sum(if(leaf >= {k}, 1, 0) + later_leaves) as l{k}" for k in range(BLOCK + 1)]
    found = rolled(valued, "min(conv_id) as conv_id", "count(*) as n_convs", *sums)
    pick = {name: F.element_at(F.array(*[F.col(f"{c}{k}") for k in range(BLOCK + 1)]), F.col("inside") + 1) for name, c in (("saved_tokens", "s"), ("n_leaves", "l"))}
    above = F.coalesce(*[F.when(F.col("inside") == k, _node_key(TURNS[: k - 1])) for k in range(1, BLOCK + 1)])
    found = materialise(found.select("conv_id", "depth", "n_convs", pick["n_leaves"].alias("n_leaves"), pick["saved_tokens"].alias("saved_tokens"), _node_key(TURNS).alias("node"), above.alias("above")))
    children = found.filter("above is not null").groupBy(F.col("above").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = found.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    out = found.join(children, "node", "left").join(end_hashes(blocks), "node", "left").join(parents, "above", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """The trie of conversations rebuilt so that conversation c starts with the first crc32(c) % heads turns of conversation c - c % family.

    Null turns come first and turns of one number stand in the order of the hashes of their role and text; very long texts are hashed where they are read; columns other than conv_id, turn, role and text are ignored.
    """
    turns = materialise(turn_rows(conversations))
    conv = F.col("conv_id")
    return prefix_trie(*rebuilt(turns, conv - conv % family, F.crc32(conv.cast("string").cast("binary")) % heads))


def op12_conversation_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


ORACLE = rf"""
with {CRC_TABLE},
own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as turns
  from conversations where conv_id is not null group by conv_id),
made as (
  select o.conv_id, coalesce(b.turns[1:o.h], []) || o.turns[o.h + 1:] as turns
  from (select *, ({crc_sql("conv_id")} % {HEADS})::int as h from own, crc_table) o left join own b on b.conv_id = o.conv_id - o.conv_id % {FAMILY}),
prefixes as (select conv_id, len(turns) as size, d as depth, turns[1:d] as path from made, unnest(range(len(turns) + 1)) x(d)),
nodes as (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs, coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (size = depth), '') as ends,
    case when depth > 0 then (count(*) - 1) * len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) else 0 end as saved
  from prefixes group by path, depth),
linked as (select n.*, p.conv_id as parent_conv_id from nodes n left join nodes p on p.depth = n.depth - 1 and p.path = n.path[1:n.depth - 1]),
counted as (select l.*, (select count(*) from linked c where c.depth = l.depth + 1 and c.parent_conv_id = l.conv_id) as n_children from linked l),
below as (
  select a.conv_id, a.depth, count(*) filter (b.n_children = 0) as n_leaves, sum(b.saved) as saved_tokens
  from counted b, unnest(range(b.depth + 1)) x(d) join nodes a on a.depth = d and a.path = b.path[1:d] group by a.conv_id, a.depth)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::bigint as saved_tokens, sha256(ends) as ends_sha256 from counted join below using (conv_id, depth)
"""
