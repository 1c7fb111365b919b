"""Week and month candles, two-bar classifiers and the consensus of timeframes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indicators import close_position

#: Bands of the close, labels by (gap, band) as the live filter and as the backtest reads them, weights of the timeframes.
LOWER, UPPER = 0.30, 0.70
LIVE_LABELS = {
    ("Gap-Up", "Strong"): ("Bullish Impulse Convergence", "Bullish"),
    ("Gap-Up", "Weak"): ("Contested Bullish Divergence", "Bullish"),
    ("Gap-Down", "Weak"): ("Bearish Impulse Convergence", "Bearish"),
    ("Gap-Down", "Strong"): ("Contested Bearish Divergence", "Bearish"),
}
BACKTEST_LABELS = LIVE_LABELS | {("Gap-Up", "Weak"): ("Contested Bullish Divergence", "Bearish"), ("Gap-Down", "Strong"): ("Contested Bearish Divergence", "Bullish")}
WEIGHTS = {"monthly": 40.0, "weekly": 35.0, "daily": 25.0}


def iso_week(day: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


PERIODS = {"daily": lambda d: F.date_format(d, "yyyy-MM-dd"), "weekly": iso_week, "monthly": month_key}


def _candle() -> list[Column]:
    return [F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "date").alias("close"), F.sum("volume").alias("volume")]


def candles(bars: DataFrame, timeframe: str, as_of: str) -> DataFrame:
    """T1, T2 (and days as they are): candles keyed by ISO week or month, with spread and close_position. The period of as_of, and later ones, stay out."""
    key = PERIODS[timeframe]
    now = key(F.lit(as_of).cast("date"))
    if timeframe == "daily":
        df = bars.select("symbol", key(F.col("date")).alias("period"), "open", "high", "low", "close", "volume")
    else:
        df = bars.groupBy("symbol", key(F.col("date")).alias("period")).agg(*_candle()).filter(F.col("period") < now)
    spread = F.col("high") - F.col("low")
    return df.withColumn("spread", spread).withColumn("close_position", F.when(F.col("spread") <= 0, F.lit(0.5)).otherwise(close_position())).withColumn("timeframe", F.lit(timeframe))


def all_candles(bars: DataFrame, as_of: str, names=tuple(PERIODS)) -> DataFrame:
    """The candles of several timeframes in one pass: a bar meets each of its periods where it is, so bars dealt by symbol are neither made nor dealt again for each."""
    day = F.lit(as_of).cast("date")
    each = F.array(*[F.struct(F.lit(t).alias("timeframe"), PERIODS[t](F.col("date")).alias("period"), PERIODS[t](day).alias("now")) for t in names])
    rows = bars.select("symbol", "date", "open", "high", "low", "close", "volume", F.inline(each)).filter("timeframe = 'daily' or period < now")
    df = rows.groupBy("symbol", "timeframe", "period").agg(*_candle())
    spread = F.col("high") - F.col("low")
    df = df.withColumn("spread", spread).withColumn("close_position", F.when(F.col("spread") <= 0, F.lit(0.5)).otherwise(close_position()))
    return df.select("symbol", "period", "open", "high", "low", "close", "volume", "spread", "close_position", "timeframe")


def end_labelled(bars: DataFrame, timeframe: str) -> DataFrame:
    """Candles labelled by the period's last day (Sunday, or the month's end), with the open period."""
    if timeframe == "daily":
        return bars.select("symbol", "date", "open", "high", "low", "close", "volume")
    end = F.date_add(F.date_trunc("week", "date").cast("date"), 6) if timeframe == "weekly" else F.last_day("date")
    return bars.groupBy("symbol", end.alias("ends")).agg(*_candle()).withColumnRenamed("ends", "date").select("symbol", "date", "open", "high", "low", "close", "volume")


def _label(labels: dict, at: int) -> Column:
    out = F.lit(None).cast("string")
    for (gap, band), names in labels.items():
        out = F.when((F.col("gap_direction") == gap) & (F.col("close_band") == band), names[at]).otherwise(out)
    return out


def eigen(frames: DataFrame, labels: dict = LIVE_LABELS, latest_only: bool = False) -> DataFrame:
    """Bars whose volume rose, that closed in an outer band and opened away from the last close in the close's direction.

    `frames` has candles of any timeframes; a window per symbol and timeframe. latest_only keeps the newest bar of each
    only, if it qualifies; otherwise all bars that do.
    """
    w = Window.partitionBy("symbol", "timeframe").orderBy("period")
    prev = [F.lag(c).over(w).alias(f"prev_{n}") for c, n in (("volume", "vol"), ("close", "close"), ("close_position", "cp"), ("period", "period"))]
    df = frames.select("*", *prev, *([F.lead("period").over(w).alias("next_period")] if latest_only else []))
    up = (F.col("open") > F.col("prev_close")) & (F.col("close_position") >= F.col("prev_cp"))
    down = (F.col("open") < F.col("prev_close")) & (F.col("close_position") <= F.col("prev_cp"))
    df = df.filter((F.col("prev_vol") > 0) & (F.col("volume") > F.col("prev_vol")) & ((F.col("close_position") <= LOWER) | (F.col("close_position") >= UPPER)))
    if latest_only:
        df = df.filter("next_period is null").drop("next_period")
    df = df.withColumn("gap_direction", F.when(up, "Gap-Up").when(down, "Gap-Down")).filter("gap_direction is not null")
    df = df.withColumn("close_band", F.when(F.col("close_position") >= UPPER, "Strong").otherwise("Weak"))
    return df.withColumn("label", _label(labels, 0)).withColumn("sentiment", _label(labels, 1)).withColumn("volume_surge_pct", (F.col("volume") - F.col("prev_vol")) / F.col("prev_vol") * 100)


def eigen_details(classified: DataFrame) -> DataFrame:
    """T7"""
    change = F.bround((F.col("volume") - F.col("prev_vol")) / F.greatest("prev_vol", F.lit(1.0)) * 100, 1)
    return classified.select("symbol", "timeframe", "period", "prev_period", "label", "sentiment", F.bround("close_position", 4).alias("t_cp"), F.bround("prev_cp", 4).alias("t1_cp"), F.bround(F.col("close_position") - F.col("prev_cp"), 4).alias("delta_cp"), change.alias("vol_delta_pct"))


def age_again(frames: DataFrame, latest_only: bool = False) -> DataFrame:
    """Volume up on a narrower spread (Absorption), or down on a wider one (Effort Without Result)."""
    w = Window.partitionBy("symbol", "timeframe").orderBy("period")
    df = frames.select("*", F.lag("volume").over(w).alias("prev_vol"), F.lag("spread").over(w).alias("prev_spread"), F.lead("period").over(w).alias("next_period"))
    if latest_only:
        df = df.filter("next_period is null")
    df = df.filter("prev_vol > 0 and prev_spread > 0")
    surge, drop = (F.col("volume") > F.col("prev_vol")) & (F.col("spread") < F.col("prev_spread")), (F.col("volume") < F.col("prev_vol")) & (F.col("spread") > F.col("prev_spread"))
    df = df.withColumn("scenario", F.when(surge, "Vol_Surge_Spread_Contraction").when(drop, "Vol_Drop_Spread_Expansion")).filter("scenario is not null")
    pct = lambda a, b: (F.col(a) - F.col(b)) / F.col(b) * 100
    df = df.withColumn("label", F.when(F.col("scenario").startswith("Vol_Surge"), "Absorption").otherwise("Effort Without Result")).withColumn("sentiment", F.when(F.col("scenario").startswith("Vol_Surge"), "Bullish").otherwise("Bearish"))
    return df.withColumn("volume_pct", pct("volume", "prev_vol")).withColumn("spread_pct", pct("spread", "prev_spread")).drop("next_period")


def consensus(classified: DataFrame, weights: dict = WEIGHTS) -> DataFrame:
    """One rating per symbol that any timeframe classified; `classified` has (symbol, timeframe, sentiment). Sort by score, then symbol, to list it."""
    df = classified.groupBy("symbol").pivot("timeframe", list(weights)).agg(F.first("sentiment"))
    points = lambda t: F.when(F.col(t) == "Bullish", weights[t]).when(F.col(t) == "Bearish", -weights[t]).otherwise(0.0)
    total = sum(weights.values())
    score = sum((points(t) for t in weights), F.lit(0.0)) / total * 100
    df = df.select("symbol", *[F.coalesce(t, F.lit("None")).alias(f"{t}_sentiment") for t in weights], *[points(t).alias(f"{t}_score") for t in weights], score.alias("score"))
    s = F.col("score")
    # The limits and names of the ratings.
    stars = F.when(s == 100, 5).when(s > 10, 4).when(s >= -10, 3).when(s > -100, 2).otherwise(1)
    names = F.when(s == 100, "Strong Buy").when(s > 10, "Cautious Bullish").when(s >= -10, "Mixed Trend").when(s > -100, "Cautious Bearish").otherwise("Strong Sell")
    return df.withColumn("stars", stars).withColumn("rating", names)


def consensus_distribution(ratings: DataFrame) -> DataFrame:
    """Symbols by stars and by daily sentiment, where anything but Bullish and Bearish is neutral."""
    mood = F.when(F.col("daily_sentiment").isin("Bullish", "Bearish"), F.col("daily_sentiment")).otherwise("Neutral")
    long = ratings.select(F.explode(F.array(F.struct(F.lit("stars").alias("kind"), F.col("stars").cast("string").alias("value")), F.struct(F.lit("daily").alias("kind"), mood.alias("value")))).alias("x"))
    return long.groupBy("x.kind", "x.value").agg(F.count(F.lit(1)).alias("symbols"))


def last_day(timeframe: Column | str, period: Column | str) -> Column:
    """The last day of a day, an ISO week (2024-W05) or a month (2024-02)."""
    timeframe, period = (F.col(c) if isinstance(c, str) else c for c in (timeframe, period))
    monday = F.to_date(F.date_trunc("week", F.make_date(F.substring(period, 1, 4).cast("int"), F.lit(1), F.lit(4))))
    week = F.date_add(monday, F.substring(period, 7, 2).try_cast("int") * 7 - 1)
    return F.when(timeframe == "weekly", week).when(timeframe == "monthly", F.last_day(F.try_to_date(F.concat(period, F.lit("-01"))))).otherwise(F.try_to_date(period))
