"""Exact dedup through an extendible-hash index in shared files."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import filter_of, without
from .common import materialise, shared_dir, shuffle_partitions, small_batches, table, text_or_empty, worker_memory

#: Keys that a bucket holds before it is split.
BUCKET_ROWS = 4096

#: Keys are counted this many levels below the one at which an average bucket would hold BUCKET_ROWS to 2 * BUCKET_ROWS.
FINER = 6


def _first_bits(depth: int):
    """The first `depth` bits of a key, as a number."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def _shift(kind: str, number, by):
    return F.call_function(kind, number, by.cast("int"))


def build_directory(keys: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[int, int, DataFrame]:
    """(least depth of a bucket, global depth, table of slot and bucket) for distinct 64-bit keys.

    A bucket starts with all keys; an overfull one is split by its next bit, and the directory doubles where a bucket
    gets as deep as it. All levels are told from one count of keys by their first bits, of which there are about
    2 ** FINER for every full bucket, so the directory grows with the keys; it is a table, as wide as that. A bucket is
    named by its depth and first bits. Keys that still share a bucket at the deepest level counted stay in it.
    """
    n = keys.count()
    deepest = min(62, max(0, n // bucket_rows).bit_length() + FINER) if n > bucket_rows else 0
    level = keys.groupBy(_first_bits(deepest).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    level = materialise(level.select(F.lit(deepest).alias("depth"), "prefix", "n"))
    counts = level.select(F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth"), "prefix", "n")
    counts = counts.select("depth", _shift("shiftright", F.col("prefix"), deepest - F.col("depth")).alias("prefix"), "n")
    counts = counts.groupBy("depth", "prefix").agg(F.sum("n").alias("n"))
    full = counts.filter((F.col("n") > bucket_rows) & (F.col("depth") < deepest)).select((F.col("depth") + 1).alias("depth"), "prefix")
    halves = full.select("depth", F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
    buckets = materialise(halves.unionByName(keys.sparkSession.range(1).select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))).join(full.select((F.col("depth") - 1).alias("depth"), "prefix"), ["depth", "prefix"], "left_anti"))
    least, depth = buckets.agg(F.min("depth"), F.max("depth")).first()
    by = depth - F.col("depth")
    first = _shift("shiftleft", F.col("prefix"), by)
    slots = F.explode(F.sequence(first, first + _shift("shiftleft", F.lit(1).cast("long"), by) - 1)).alias("slot_no")
    return least, depth, buckets.select(slots, F.concat_ws("/", F.col("depth"), F.col("prefix")).alias("bucket"))


def text_keys(docs: DataFrame) -> DataFrame:
    """doc_id, sha (hex of SHA-256) and the index key, a 64-bit hash of the text; texts themselves are left behind."""
    text = text_or_empty()
    return docs.select("doc_id", F.sha2(text, 256).alias("sha"), F.xxhash64(text).alias("key"))


ENTRY, KINDS = ["key", "sha", "text", "n", "top"], [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
LOW = -(2**63)


def _combine(repeated):
    """Over rows (doc_id, key, text): those whose key may be repeated. A task's copies become one: each text goes out once, where it is
    first met; what else is met of it is one row without the text at the end."""

    def run(batches):
        worker_memory("dedup")
        met: dict[bytes, list] = {}
        for batch in batches:
            batch = batch.filter(pa.array(repeated.value.has(batch.column(1).to_numpy().view(np.uint64))))
            out = []
            for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                doc_id, raw = LOW if doc_id is None else doc_id, text.as_buffer()
                sha = hashlib.sha256(raw.to_pybytes() if raw is not None else b"").hexdigest()
                if sha in met:
                    entry = met[sha]
                    entry[1:] = entry[1] + 1, max(entry[2], doc_id)
                else:
                    met[sha] = [key, 0, LOW]
                    out.append((key, sha, text.as_py(), 1, doc_id))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, KINDS)], ENTRY)
        rest = [(key, sha, None, n, top) for sha, (key, n, top) in met.items() if n]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rest) if rest else [[]] * 5, KINDS)], ENTRY)

    return run


def _own(batches):
    """Owner of whole key ranges, rows sorted by key, those with texts first: chains the texts of a key, comparing bytes, and emits an entry per text. A row without a text adds to the entry whose text its task sent."""
    now, chain = None, []
    names = ["key", "slot", "sha", "keep_id", "group_size"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        out = []
        texts = batch.column(2)
        for i, (key, sha, n, top) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4)))):
            if key != now:
                out += [(now, slot, *e[1:]) for slot, e in enumerate(chain)]
                now, chain = key, []
            sent = texts[i].as_buffer()
            text = sent.to_pybytes() if sent is not None else b"" if texts[i].is_valid else None
            for e in chain:
                if e[0] == text or text is None and e[1] == sha:
                    e[2], e[3] = max(e[2], top), e[3] + n
                    break
            else:
                chain.append([text, sha, top, n])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names)
    out = [(now, slot, *e[1:]) for slot, e in enumerate(chain)]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names)


def build_index(docs: DataFrame, place: str | None = None, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows, index). rows: doc_id, sha and key of every document. The index, Parquet files at `place` in the shared folder:
    bucket, key, slot in the key's chain, sha, keep_id, group_size.

    Keys are counted first. A key that one row has needs no text: its entry is that row. The texts of the others, which a filter
    tells, go once per task to the owner of their key range (whole buckets), which reads its rows in key order, holds one
    key's chain at a time and compares bytes. What the filter lets through of other keys is left out by a join without texts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = materialise(text_keys(docs))
    keys = materialise(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"), F.min("sha").alias("sha")))
    least, depth, directory = build_directory(keys, bucket_rows)
    once = keys.filter("n = 1").select("key", F.lit(0).alias("slot"), "sha", "keep_id", F.col("n").alias("group_size"))
    many = materialise(keys.filter("n > 1").select("key"))
    repeated = spark.sparkContext.broadcast(filter_of(many))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("key"), text_or_empty().alias("text"))
    entries = texts.mapInArrow(_combine(repeated), "key long, sha string, text string, n long, top long")
    owned = entries.repartition(shuffle_partitions(spark), _first_bits(least)).sortWithinPartitions("key", F.col("text").isNull())
    chained = owned.mapInArrow(_own, "key long, slot int, sha string, keep_id long, group_size long").join(many, "key", "left_semi")
    chained = chained.withColumn("keep_id", F.when(F.col("keep_id") != LOW, F.col("keep_id")))
    index = once.unionByName(chained).join(directory, _first_bits(depth) == F.col("slot_no")).select("bucket", "key", "slot", "sha", "keep_id", "group_size")
    index = materialise(index, place)
    repeated.destroy()
    return rows, index


def probe(rows: DataFrame, index: DataFrame) -> DataFrame:
    """rows (with key and sha) and what the stored index has of their texts: keep_id and group_size, null where a text isn't in it.

    Entries are looked up by key; in a key's chain the text is told by its SHA-256, which the owner stored after comparing bytes.
    """
    return rows.join(index.select("key", "sha", "keep_id", "group_size"), ["key", "sha"], "left")


def exact_groups(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, keep_id (largest doc_id of the equal texts), group_size, kept, text_sha256; one row per input row.

    Texts are equal when their bytes are; null counts as empty, so all null and empty texts are one group. A row
    without doc_id is counted but can't stay unless all of its group lack one (keep_id is then null and all are
    kept). Rows that repeat a doc_id and text are all marked kept when that doc_id is. Very long texts travel only if
    repeated, once per task. Extra columns are ignored; an empty table gives no rows.
    """
    rows, index = build_index(docs, shared_dir(docs.sparkSession), bucket_rows)
    found = probe(rows, index)  # Spark splits the partition of a hot text
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs without the rows whose text a row with a larger doc_id has; all columns stay.

    Rows that repeat both doc_id and text are equal to this rule and all stay, as do all rows of a group without ids.
    """
    away = materialise(exact_groups(docs, bucket_rows).filter("not kept").select("doc_id", "text_sha256"))
    return without(docs, away, [F.col("doc_id"), F.sha2(text_or_empty(), 256)])


def op7_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents) window w as (partition by t)
"""
