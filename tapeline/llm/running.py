"""Running sums and places inside a key, along an order, without one task per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions


def running(df: DataFrame, key: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with, for each name in sums, the sum of its expression over the earlier rows of the row's key along `order`; 0 for the first.

    Rows are dealt by ranges of key and order and stored, so a key with a third of all rows lies over many ranges. A window
    sees the rows of one key in one range only; what a key has in earlier ranges is added from totals, which are made
    for the keys that begin a range: at most two rows per range. df is read twice, first to find the ranges. key isn't null. Equal rows share a range and follow each other in any order.
    """
    spark = df.sparkSession
    stored = materialise(df.repartitionByRange(shuffle_partitions(spark), F.col(key), *order).withColumn("_range", F.spark_partition_id()))
    begin = F.broadcast(stored.groupBy("_range").agg(F.min(key).alias(key)).select(key).distinct())  # a row per range
    totals = stored.join(begin, key, "left_semi").groupBy(key, "_range").agg(*[F.sum(v).alias(f"_earlier_{n}") for n, v in sums.items()])
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = F.broadcast(totals.select(key, "_range", *[F.sum(f"_earlier_{n}").over(earlier).alias(f"_earlier_{n}") for n in sums]))  # two rows per range
    inside = Window.partitionBy(key, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    out = stored.join(totals, [key, "_range"], "left")
    return out.select(*df.columns, *[(F.coalesce(F.sum(v).over(inside), zero) + F.coalesce(f"_earlier_{n}", zero)).alias(n) for n, v in sums.items()])
