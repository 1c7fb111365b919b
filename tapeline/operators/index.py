"""A stored inverted index: postings by token in buckets, delta-coded by segment, and documents in shards; terms and substrings are looked up, not scanned."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.texts import char_grams
from .search import SEGMENT, tokens

#: Folders of the postings and of the documents: a token lies in one of the first, a document in one of the second.
BUCKETS, SHARDS = 64, 64

#: Characters of a gram of the substring index.
GRAM = 3

#: Stands behind the end of a text, so that its last characters begin grams too.
END = "\0"


def bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def grams(text: Column) -> Column:
    """Distinct grams of a text in lower case, those that reach over its end too."""
    return F.array_distinct(char_grams(F.lower(F.coalesce(text, F.lit(""))), GRAM, END))


def _places(batches):
    """Rows (token, segment, deltas): a row per document number."""
    for batch in batches:
        lists = batch.column(2)
        n = lists.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.cumsum(n)
        run = np.cumsum(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
        before = np.concatenate(([0], run))[ends - n]
        row = np.repeat(np.arange(len(n)), n)
        number = run - before[row] + batch.column(1).to_numpy().astype(np.int64)[row] * SEGMENT
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(number)], ["token", "number"])


@dataclass(frozen=True)
class StoredIndex:
    """An index at `place`: postings (token, segment, documents, deltas, bucket) and documents (`columns`: those stored, number, shard)."""

    spark: SparkSession
    place: str
    columns: StructType
    buckets: int = BUCKETS
    shards: int = SHARDS

    @staticmethod
    def write(events: DataFrame, found: Column, place: str, number: str = "doc_id", keep: list[str] | None = None, buckets: int = BUCKETS, shards: int = SHARDS) -> StoredIndex:
        """Stores the tokens that `found`, an array of distinct strings over events, has, and the columns `keep` of events (all by default). `number` tells events apart.

        A token's postings are a sorted list per SEGMENT numbers, stored as differences, in the one bucket of its hash, sorted by token; hot tokens
        have a row per segment, so no list outgrows its cell and no task holds a token.
        """
        rows = events.select(F.col(number).cast("long").alias("number"), F.explode(found).alias("token"))
        rows = rows.select("token", F.floor(F.col("number") / SEGMENT).alias("segment"), (F.col("number") % SEGMENT).cast("int").alias("at"))
        lists = rows.groupBy("token", "segment").agg(F.sort_array(F.collect_list("at")).alias("ids"))
        before = F.concat(F.array(F.lit(0)), F.slice("ids", 1, F.size("ids") - 1))
        lists = lists.select("token", "segment", F.size("ids").alias("documents"), F.zip_with("ids", before, lambda a, b: a - b).alias("deltas"), bucket(F.col("token"), buckets).alias("bucket"))
        lists.repartition(buckets, "bucket", F.pmod("segment", F.lit(16))).sortWithinPartitions("bucket", "token", "segment").write.mode("overwrite").partitionBy("bucket").parquet(f"{place}/postings")
        shard = F.pmod(F.col(number).cast("long"), F.lit(shards)).cast("int")
        kept = events.select(*(events.columns if keep is None else keep), F.col(number).cast("long").alias("number"), shard.alias("shard"))
        kept.repartition(shards, "shard").sortWithinPartitions("shard", "number").write.mode("overwrite").partitionBy("shard").parquet(f"{place}/documents")
        return StoredIndex(events.sparkSession, place, kept.schema, buckets, shards)

    def postings(self) -> DataFrame:
        return self.spark.read.schema("token string, segment long, documents int, deltas array<int>, bucket int").parquet(f"{self.place}/postings")

    def documents(self) -> DataFrame:
        return self.spark.read.schema(self.columns).parquet(f"{self.place}/documents")

    def lists(self, words: list[str]) -> DataFrame:
        """The stored lists of some tokens, from their buckets only."""
        one = self.spark.range(1).select(F.array(*[bucket(F.lit(w), self.buckets) for w in words]).alias("b")).first()["b"] if words else []
        return self.postings().filter(F.col("bucket").isin(*sorted(set(one))) & F.col("token").isin(*words))

    def rows(self, words: list[str]) -> DataFrame:
        """(token, number) of some tokens."""
        return self.lists(words).select("token", "segment", "deltas").mapInArrow(_places, "token string, number long")

    def counts(self, words: list[str]) -> dict[str, int]:
        """K3: documents of each token, without reading its lists."""
        found = self.lists(words).groupBy("token").agg(F.sum("documents").alias("n")).collect()  # a row per word asked for
        return {w: 0 for w in words} | {r["token"]: r["n"] for r in found}

    def term(self, word: str) -> DataFrame:
        """K4: numbers of the documents with a word."""
        return self.rows([word.lower()]).select("number")

    def any_of(self, *words: str) -> DataFrame:
        """K6"""
        return self.rows(list(dict.fromkeys(w.lower() for w in words))).select("number").distinct()

    def all_of(self, *words: str, most: int | None = None) -> DataFrame:
        """K5: the rarest word's documents, then those of them that the next rarest has, and so on, or the rarest `most` words; a word that no document has ends it at once."""
        counts = self.counts(list(dict.fromkeys(w.lower() for w in words)))
        order = sorted(counts, key=lambda w: (counts[w], w))
        if not order or not counts[order[0]]:
            return self.spark.createDataFrame([], "number long")
        return reduce(lambda found, w: found.join(self.term(w), "number", "left_semi"), order[1:most], self.term(order[0]))

    def none_of(self, found: DataFrame) -> DataFrame:
        """K7: numbers of all documents but those found; texts aren't read."""
        return self.documents().select("number").join(found, "number", "left_anti")

    def get(self, found: DataFrame) -> DataFrame:
        """The documents of some numbers: only the shards that hold them are read."""
        held = [r["shard"] for r in found.select(F.pmod("number", F.lit(self.shards)).cast("int").alias("shard")).distinct().collect()]  # at most one row per shard
        return self.documents().filter(F.col("shard").isin(*held)).join(found.distinct(), "number", "left_semi").drop("shard")


def write_words(events: DataFrame, place: str, *fields: str, **more) -> StoredIndex:
    """K2: the index of the words (see tokens) of some fields."""
    return StoredIndex.write(events, tokens(F.concat_ws(" ", *fields)), place, **more)


def write_grams(events: DataFrame, place: str, *fields: str, **more) -> StoredIndex:
    """The index of the grams of some fields, for substrings."""
    every = [grams(F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields]
    return StoredIndex.write(events, reduce(F.array_union, every), place, **more)


def with_text(index: StoredIndex, text: str, *fields: str) -> DataFrame:
    """Documents of a gram index with the text in any of the fields, case aside; equal to search.by_text.

    A text of GRAM characters or more has grams, and only documents that have the four rarest of them are read and looked through. A shorter
    one begins a gram wherever it stands: the tokens that begin with it are looked up in the postings, whose lists are read for these only. An empty text is in all documents.
    """
    low = text.lower()
    if not low:
        return index.documents().drop("shard")
    if len(low) >= GRAM:
        found = index.all_of(*[low[i : i + GRAM] for i in range(len(low) - GRAM + 1)], most=4)
    else:
        lists = index.postings().filter(F.col("token").startswith(low))
        found = lists.select("token", "segment", "deltas").mapInArrow(_places, "token string, number long").select("number").distinct()
    test = [F.lower(F.coalesce(F.col(f).cast("string"), F.lit(""))).contains(low) for f in fields]
    return index.get(found).filter(reduce(lambda a, b: a | b, test))
