"""Row and rolling indicators of bars (I1-I9): built-in expressions over one window per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the moving averages, support and resistance.
SPAN = 20


def by_date():
    return Window.partitionBy("symbol").orderBy("date")



def close_position(high="high", low="low", close="close") -> Column:
    """Where the close stands between low (0) and high (1); 0.5 on a bar without spread."""
    spread = F.col(high) - F.col(low)
    return F.when(spread == 0, F.lit(0.5)).otherwise(F.try_divide(F.col(close) - F.col(low), spread))


def price_trend(close: Column, mean: Column) -> Column:
    """I4"""
    return F.when(close > mean * 1.02, 2).when(close < mean * 0.98, -2).when(close > mean, 1).when(close < mean, -1).otherwise(0)


def effort_vs_result() -> Column:
    """What the volume of a bar achieved, against the bar before; needs prev_close and the raw previous volume and spread (null on the first bar)."""
    vr = F.try_divide(F.col("volume"), F.greatest(F.col("lag_volume"), F.lit(1.0)))
    pc = F.try_divide(F.col("close") - F.col("prev_close"), F.greatest(F.col("prev_close"), F.lit(0.001)))
    sr = F.try_divide(F.col("spread"), F.greatest(F.col("lag_spread"), F.lit(0.001)))
    cp = F.col("close_position")
    still = F.when(cp > 0.6, "Absorption_Bullish").when(cp < 0.4, "Absorption_Bearish").otherwise("Professional_Activity")
    busy = F.when(F.abs(pc) < 0.005, still).when(pc < -0.01, "Panic_Selling").when((pc > 0.01) & (sr < 0.8), "Hidden_Buying").when(pc > 0.01, "Genuine_Buying").otherwise("Normal_Activity")
    quiet = F.when(pc > 0.01, "No_Supply").when(pc < -0.01, "No_Demand").otherwise("Quiet_Market")
    return F.when(F.col("prev_close").isNull(), "Normal_Activity").when(vr > 1.5, busy).when(vr < 0.7, quiet).otherwise("Normal_Activity")


def with_indicators(bars: DataFrame) -> DataFrame:
    """I1-I9 as columns. Bars are unique per symbol and date; all windows share one partitioning and order, so Spark sorts once."""
    w = by_date()
    last = w.rowsBetween(1 - SPAN, 0)
    df = bars.withColumn("spread", F.col("high") - F.col("low")).withColumn("close_position", close_position())
    df = df.select(
        "*",
        F.avg("volume").over(last).alias("volume_ma"), F.avg("spread").over(last).alias("spread_ma"), F.avg("close").over(last).alias("close_ma"),
        F.min("low").over(last).alias("support"), F.max("high").over(last).alias("resistance"),
        F.lag("volume").over(w).alias("lag_volume"), F.lag("spread").over(w).alias("lag_spread"), F.lag("close").over(w).alias("prev_close"),
    )
    return df.select(
        "*",
        price_trend(F.col("close"), F.col("close_ma")).alias("price_trend"),
        (F.col("close") > F.col("open")).alias("is_up"), (F.col("close") < F.col("open")).alias("is_down"),
        (F.abs(F.col("close") - F.col("open")) <= 0.1 * F.col("spread")).alias("is_doji"),
        F.coalesce("lag_volume", "volume").alias("prev_volume"), F.coalesce("lag_spread", "spread").alias("prev_spread"),
        effort_vs_result().alias("effort"),
    ).select(
        "*",
        (100 * F.try_divide(F.col("volume") - F.col("prev_volume"), F.col("prev_volume"))).alias("vol_pct"),
        (100 * F.try_divide(F.col("spread") - F.col("prev_spread"), F.col("prev_spread"))).alias("spr_pct"),
    )
