"""Bloom filters of 64-bit keys, built by Spark in regions; they spare shuffles, and an exact join follows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, shuffle_partitions

#: Filters have at most 2 ** 29 bits (64 MB).
MOST_BITS = 29

_ODD = np.uint64(0xC2B2AE3D27D4EB4F)


def bucket_of(v: np.ndarray, buckets: int) -> np.ndarray:
    return (v >> np.uint64(32)) % np.uint64(buckets)


def _places(v: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    m = mix64(v)
    bits = np.uint64(64 * words)
    return m % bits, (m >> np.uint64(31) ^ m * _ODD >> np.uint64(7)) % bits


class Bloom:
    """A Bloom filter in regions by bucket, two bits for each number in the region of its bucket."""

    def __init__(self, regions: list[np.ndarray]):
        self.bits, self.words, self.buckets = np.concatenate(regions), len(regions[0]), len(regions)

    def has(self, v: np.ndarray) -> np.ndarray:
        base = (bucket_of(v, self.buckets) * self.words).astype(np.int64)
        ok = np.ones(len(v), bool)
        for p in _places(v, self.words):
            ok &= (self.bits[base + (p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return ok

    @staticmethod
    def region(v: np.ndarray, words: int) -> np.ndarray:
        """The region that holds the numbers of one bucket."""
        out = np.zeros(words, np.uint64)
        for p in _places(v, words):
            np.bitwise_or.at(out, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
        return out

    @classmethod
    def collected(cls, rows: DataFrame, buckets: int, words: int) -> Bloom:
        """From rows (bucket, region): the regions come to the driver, 64 MB in all at most."""
        out = [np.zeros(words, np.uint64)] * buckets
        for r in rows.collect():
            out[r["bucket"]] = np.frombuffer(r["region"], np.uint64)
        return cls(out)


def words_for(bits: int, buckets: int) -> int:
    return max(16, -(-min(1 << MOST_BITS, bits) // 64 // buckets))


def filter_of(keys: DataFrame) -> Bloom:
    """The filter of a stored table's one long column, 16 bits a row up to the bound. Repeated keys and nulls are allowed; nulls are in no filter."""
    (name,) = keys.columns
    keys = keys.filter(F.col(name).isNotNull())
    buckets = shuffle_partitions(keys.sparkSession)
    words = words_for(16 * max(keys.count(), 1), buckets)

    def own(batches):
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            v = batch.column(0).to_numpy().view(np.uint64)
            at = bucket_of(v, buckets).astype(np.int64)
            for c in np.unique(at).tolist():
                found.setdefault(c, []).append(v[at == c])
        for c, parts in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([Bloom.region(np.concatenate(parts), words).tobytes()], pa.binary())], ["bucket", "region"])

    bucket = F.pmod(F.shiftrightunsigned(name, 32), F.lit(buckets))
    return Bloom.collected(keys.repartition(buckets, bucket).select(name).mapInArrow(own, "bucket int, region binary"), buckets, words)


def without(docs: DataFrame, away: DataFrame, on: list[Column]) -> DataFrame:
    """docs but the rows that `away`, a stored table, has: its columns are held, nulls equal, against the expressions `on`, in order.

    A filter tells nearly all rows that stay; only the others may be shuffled with all their columns, for the exact join. docs is read twice.
    """
    names = [f"_away{k}" for k in range(len(on))]
    away = away.toDF(*names).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(filter_of(away.select(F.xxhash64(*names).alias("key"))))

    @F.pandas_udf("boolean")
    def maybe(key: pd.Series) -> pd.Series:
        return pd.Series(shared.value.has(key.to_numpy(np.int64).view(np.uint64)))

    marked = docs.withColumn("_maybe", maybe(F.xxhash64(*on)))
    met = F.lit(True)
    for c, n in zip(on, names):
        met = met & c.eqNullSafe(F.col(n))
    rest = marked.filter("_maybe").drop("_maybe").join(away, met, "left_anti")
    return marked.filter("not _maybe").drop("_maybe").unionByName(rest)
