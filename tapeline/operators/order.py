"""Places in a global order without a window over all rows or over a hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise

#: Bits of monotonically_increasing_id that count rows inside a partition.
INSIDE = 33


def numbered(df: DataFrame, *order: Column | str, name: str = "pos") -> DataFrame:
    """df with contiguous numbers from 0 along `order`, which should tell rows apart.

    Rows are dealt by ranges of the order and sorted there; only the ranges' counts, a row each, meet in one window.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stored = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", INSIDE)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    at = stored.join(F.broadcast(starts), part == F.col("_part"))  # a row per range
    return at.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << INSIDE) - 1)).drop("_at", "_part", "_before")
