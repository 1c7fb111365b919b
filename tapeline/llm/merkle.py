"""A Merkle manifest of a table by slot pivots: leaves, subroots per source, one root, and proofs that are folded again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, table
from .running import running

#: Children of a node.
FANOUT = 16

#: Columns of `documents` that a leaf covers, in this order.
COVERED = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex of the SHA-256 of the parts one behind the other; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def encoded(value: Column) -> Column:
    """`-` for null, else the UTF-8 length, a colon and the value, so that no two rows of values read alike."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def parents(nodes: DataFrame) -> DataFrame:
    """The next level of (tree, place, n, h): a pivot of each parent's children into the columns c0, c1, .., hashed together.

    n is the number of the tree's nodes at the level; a tree of one node has no next level.
    """
    slot = F.col("place") % FANOUT
    spread = [F.max(F.when(slot == k, F.col("h"))).alias(f"c{k}") for k in range(FANOUT)]
    up = nodes.filter("n > 1").groupBy("tree", F.floor(F.col("place") / FANOUT).alias("place")).agg(F.ceil(F.max("n") / FANOUT).alias("n"), *spread)
    return up.withColumn("h", digest(*[F.col(f"c{k}") for k in range(FANOUT)]))


def levels(nodes: DataFrame) -> list[DataFrame]:
    """The stored level 0 and all levels above it, each a stored table a FANOUT-th as long as the one below."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(materialise(parents(out[-1])))
        most = -(-most // FANOUT)
    return out


def paths(found: list[DataFrame]) -> DataFrame:
    """Level 0 with `path`: for each level up to its tree's top the siblings before and behind, which are the parent's columns but the own one."""
    below = None
    for level in reversed(found):
        if below is None:
            below = level.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
            continue
        slot, column = F.col("low.place") % FANOUT, [F.col(f"up.c{k}") for k in range(FANOUT)]
        left = F.concat_ws("", *[F.when(slot > k, column[k]) for k in range(FANOUT - 1)])
        right = F.concat_ws("", *[F.when(slot < k, column[k]) for k in range(1, FANOUT)])
        step = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("up.path"))
        over = (F.col("low.tree") == F.col("up.tree")) & (F.floor(F.col("low.place") / FANOUT) == F.col("up.place"))
        below = level.alias("low").join(below.alias("up"), over, "left").select("low.*", F.when(F.col("up.path").isNull(), F.array()).otherwise(step).alias("path"))
    return below


def folded(path: Column, start: Column) -> Column:
    """The top that a path gives for a leaf."""
    return F.aggregate(path, start, lambda h, step: digest(step["left"], h, step["right"]))


def siblings(path: Column) -> Column:
    return F.aggregate(path, F.lit(""), lambda done, step: F.concat(done, step["left"], step["right"]))


def merkle_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, source_key (null first, then by bytes), leaf, and told: the leaf that the row would have with `tampered` as its text."""
    values = [encoded(F.col(c)) for c in COVERED]
    told = digest(*values[:-1], encoded(tampered))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return docs.select(F.col("doc_id"), key.alias("source_key"), digest(*values).alias("leaf"), told.alias("told"))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified; one row per input row.

    Leaves of a source ascend by doc_id (null first) and are its tree's level 0; subroots, null source first and then by
    bytes, are the level 0 of the tree on top. `tampered`, an expression over docs, is the text that is checked against the manifest; without
    it, the text itself. folded_root is what the leaf of that text gives with the original siblings, level by level.

    Whole texts are hashed in one pass, however long, and not moved. A hot source is spread over ranges of its doc_ids. Null values are
    covered as such and differ from empty ones. Rows that repeat a doc_id are leaves of their own, in the order of their hashes, and
    equal rows in any order, since they have equal leaves. Extra columns are neither covered nor returned. An empty table gives no rows.
    """
    leaves = materialise(merkle_leaves(docs, F.col("text") if tampered is None else tampered))
    rows = running(leaves, "source_key", [F.col("doc_id"), F.col("leaf"), F.col("told")], {"place": F.lit(1).cast("long")})
    sources = rows.groupBy("source_key").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0))
    sources = materialise(running(sources, "all", [F.col("source_key")], {"tree": F.lit(1).cast("long")}).select("source_key", "tree", "n"))
    rows = materialise(rows.join(sources, "source_key").select("doc_id", "told", "tree", "place", "n", F.col("leaf").alias("h")))
    trees = levels(rows)
    tops = trees[0].filter("n = 1").select("tree", "h")
    for level in trees[1:]:
        tops = tops.unionByName(level.filter("n = 1").select("tree", "h"))
    count = sources.count()
    subroots = materialise(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(count).cast("long").alias("n"), "h"))
    over = levels(subroots)
    root = over[-1].select(F.col("h").alias("root"))  # one row
    above = paths(over).select(F.col("place").alias("tree"), F.col("h").alias("subroot"), F.col("path").alias("above"))
    found = paths(trees).join(above, "tree").crossJoin(F.broadcast(root))
    out = found.select(
        "doc_id", F.col("h").alias("leaf"), "subroot", "root", F.sha2(F.concat(siblings(F.col("path")), siblings(F.col("above"))), 256).alias("proof_sha256"),
        folded(F.col("above"), folded(F.col("path"), F.col("told"))).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark, sf_dir):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(table(spark, sf_dir, "documents"), F.when(chosen, F.translate("text", UPPER, LOWER)).otherwise(F.col("text")))


#: SQL of the unsigned CRC-32 of a decimal number: the table of a byte's remainders, and a fold over the digits.
CRC_TABLE = """crc_table as (select list(r order by b) as t from (select b, list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as r from range(256) x(b)))"""


def crc_sql(number: str) -> str:
    digits = f"list_transform(string_split({number}::varchar, ''), lambda d: ascii(d)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {digits}), lambda c, d: xor(c >> 8, t[(xor(c, d) & 255) + 1])), 4294967295)"


def _enc(column: str) -> str:
    return f"case when {column} is null then '-' else strlen(({column})::varchar) || ':' || ({column})::varchar end"


_HEAD = " || ".join(_enc(c) for c in COVERED[:-1])

ORACLE = f"""
with recursive {CRC_TABLE},
leaves as (
  select doc_id, source, sha256({_HEAD} || {_enc("text")}) as leaf,
    case when {crc_sql("doc_id")} % 5 = 0 then sha256({_HEAD} || {_enc(f"translate(text, '{UPPER}', '{LOWER}')")}) else sha256({_HEAD} || {_enc("text")}) end as told
  from documents, crc_table),
ranked as (select *, row_number() over (order by source nulls first, doc_id) as id, dense_rank() over (order by source nulls first) as tree from leaves),
placed as (select *, row_number() over (partition by tree order by id) - 1 as place, count(*) over (partition by tree) as n from ranked),
nodes as (
  select tree, 0 as level, place, n, leaf as h from placed
  union all
  select tree, level + 1, place // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' order by place)) from nodes where n > 1 group by tree, level, place // {FANOUT}, n),
tops as (
  select 0 as level, tree - 1 as place, count(*) over () as n, h from nodes where n = 1
  union all
  select level + 1, place // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' order by place)) from tops where n > 1 group by level, place // {FANOUT}, n),
every as (
  select tree, level, place, n, h from nodes
  union all
  select 0, level, place, n, h from tops),
beside as (
  select tree, level, place, n,
    coalesce(string_agg(h, '') over (partition by tree, level, place // {FANOUT} order by place rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '') over (partition by tree, level, place // {FANOUT} order by place rows between 1 following and unbounded following), '') as r
  from every),
walk as (
  select id, tree, tree as own, 0 as level, place, n, told as h, '' as proof from placed
  union all
  select w.id, case when w.n > 1 then w.tree else 0 end, own, case when w.n > 1 then w.level + 1 else 0 end,
    case when w.n > 1 then w.place // {FANOUT} else own - 1 end,
    case when w.n > 1 then (w.n + {FANOUT - 1}) // {FANOUT} else (select count(*) from nodes where n = 1) end,
    case when w.n > 1 then sha256(b.l || w.h || b.r) else w.h end, case when w.n > 1 then w.proof || b.l || b.r else w.proof end
  from walk w join beside b on b.tree = w.tree and b.level = w.level and b.place = w.place where w.n > 1 or w.tree > 0)
select p.doc_id, p.leaf, s.h as subroot, o.h as root, sha256(w.proof) as proof_sha256, w.h as folded_root, w.h = o.h as verified
from placed p join walk w on w.id = p.id and w.tree = 0 and w.n = 1 join nodes s on s.tree = p.tree and s.n = 1 cross join (select h from tops where n = 1) o
"""
