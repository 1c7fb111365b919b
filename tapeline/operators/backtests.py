"""Backtests over all bars: the four-stage gauntlet and the volume/spread trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indicators import close_position
from .timeframes import BACKTEST_LABELS, LOWER, UPPER, _label


def _unit(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def eigen_trades(bars: DataFrame, labels: dict = BACKTEST_LABELS) -> DataFrame:
    """Every bar that the classifier takes, with its scores, the gauntlet LVLS, HVHS, LVLS, HVHS over the next four bars, and the best close of the five after.

    `bars` has symbol, timeframe, date and prices; instruments of fewer than 5 bars have no trades. One window spec serves
    all looks back and ahead. start_date is the previous bar's.
    """
    whole = Window.partitionBy("symbol", "timeframe")
    w = whole.orderBy("date")
    df = bars.withColumn("spread", F.col("high") - F.col("low")).withColumn("cp", F.when(F.col("spread") > 0, close_position()).otherwise(0.5))
    prev = lambda c: F.lag(c).over(w)
    ahead = lambda c, k: F.lead(c, k).over(w)
    passed = F.lit(True)
    for k, sign in ((1, -1), (2, 1), (3, -1), (4, 1)):
        for c in ("volume", "spread"):
            before = ahead(c, k - 1) if k > 1 else F.col(c)
            passed = passed & ((ahead(c, k) < before) if sign < 0 else (ahead(c, k) > before))
    five = w.rowsBetween(5, 9)
    df = df.select(
        "*", F.count(F.lit(1)).over(whole).alias("n"), F.row_number().over(w).alias("rn"), F.avg("volume").over(w.rowsBetween(-20, -1)).alias("mean20"),
        *[prev(c).alias(f"prev_{c}") for c in ("date", "volume", "close", "cp", "high", "low", "spread")],
        F.coalesce(passed, F.lit(False)).alias("passed"), ahead("date", 4).alias("date4"), ahead("close", 4).alias("close4"), ahead("date", 9).alias("date9"),
        F.max("close").over(five).alias("best"), F.min("close").over(five).alias("worst"),
    )
    up = (F.col("open") > F.col("prev_close")) & (F.col("cp") >= F.col("prev_cp"))
    down = (F.col("open") < F.col("prev_close")) & (F.col("cp") <= F.col("prev_cp"))
    df = df.filter((F.col("n") >= 5) & (F.col("prev_volume") > 0) & (F.col("volume") > F.col("prev_volume")) & ((F.col("cp") <= LOWER) | (F.col("cp") >= UPPER)))
    df = df.withColumn("gap_direction", F.when(up, "Gap-Up").when(down, "Gap-Down")).filter("gap_direction is not null").withColumn("close_band", F.when(F.col("cp") >= UPPER, "Strong").otherwise("Weak"))
    rising = F.col("gap_direction") == "Gap-Up"
    side = lambda p: F.when(F.col(f"{p}spread") == 0, F.lit(0.5)).when(rising, F.try_divide(F.col(f"{p}close") - F.col(f"{p}low"), F.col(f"{p}spread"))).otherwise(F.try_divide(F.col(f"{p}high") - F.col(f"{p}close"), F.col(f"{p}spread")))
    vol = F.when((F.col("rn") <= 20) | F.col("mean20").isNull() | (F.col("mean20") == 0), F.lit(0.5)).otherwise(_unit(F.try_divide("volume", "mean20") - 1))
    df = df.withColumn("trigger", _label(labels, 0)).withColumn("sentiment", _label(labels, 1)).withColumn("vol_score", vol).withColumn("close_score", side("")).withColumn("drift_score", _unit(0.5 + (F.col("close_score") - side("prev_"))))
    done = F.col("passed") & F.col("date4").isNotNull()
    bull = F.col("sentiment") == "Bullish"
    move = F.when(done & F.col("date9").isNotNull(), (F.when(bull, F.col("best")).otherwise(F.col("worst")) - F.col("close4")) / F.col("close4"))
    df = df.withColumn("gauntlet_passed", done).withColumn("fwd_return_5b", move * 100)
    return df.select(
        "symbol", "timeframe", "date", F.col("prev_date").alias("start_date"), F.when(done, F.col("date4")).alias("completion_date"), "trigger", "sentiment",
        F.col("volume").alias("t_vol"), ((F.col("volume") / F.col("prev_volume") - 1) * 100).alias("vol_surge_pct"), "gauntlet_passed", "fwd_return_5b",
        F.when(bull, F.col("fwd_return_5b") > 0).otherwise(F.col("fwd_return_5b") < 0).alias("win"), "vol_score", "close_score", "drift_score",
        F.bround((F.col("vol_score") * 0.40 + F.col("close_score") * 0.40 + F.col("drift_score") * 0.20) * 100, 1).alias("confidence"),
    )


def eigen_metrics(trades: DataFrame) -> DataFrame:
    """Per timeframe, and over all (timeframe null): triggers, completions with an outcome, wins, failures, win rate."""
    decided = F.count("win")
    return trades.rollup("timeframe").agg(F.count(F.lit(1)).alias("triggers"), decided.alias("completed"), F.count_if("win").alias("wins"), F.count_if(~F.col("gauntlet_passed")).alias("failures"), F.coalesce(F.try_divide(F.count_if("win") * 100.0, decided), F.lit(0.0)).alias("win_rate"))


def winners(trades: DataFrame) -> DataFrame:
    """Completions that won, newest first when ordered by completion_date desc."""
    return trades.filter("gauntlet_passed and win").select("timeframe", "symbol", "start_date", "completion_date", "trigger", "sentiment", "fwd_return_5b", "confidence")


def spread_trades(bars: DataFrame, least_rows: int = 10) -> DataFrame:
    """Every bar but the first and last five whose volume and spread moved apart, with returns, wins and the best move of the next five bars."""
    w, whole = Window.partitionBy("symbol").orderBy("date"), Window.partitionBy("symbol")
    df = bars.withColumn("spread", F.col("high") - F.col("low")).withColumn("t_cp", F.when(F.col("spread") > 0, close_position()).otherwise(0.5))
    next5 = w.rowsBetween(1, 5)
    df = df.select("*", F.count(F.lit(1)).over(whole).alias("n"), F.lag("volume").over(w).alias("t1_vol"), F.lag("spread").over(w).alias("t1_spread"), *[F.lead("close", k).over(w).alias(f"c{k}") for k in (1, 3, 5)], F.max("high").over(next5).alias("top"), F.min("low").over(next5).alias("bottom"))
    df = df.filter((F.col("n") >= least_rows) & F.col("c5").isNotNull() & (F.least("volume", "t1_vol", "spread", "t1_spread") > 0) & F.col("t1_vol").isNotNull())
    surge, drop = (F.col("volume") > F.col("t1_vol")) & (F.col("spread") < F.col("t1_spread")), (F.col("volume") < F.col("t1_vol")) & (F.col("spread") > F.col("t1_spread"))
    df = df.withColumn("sentiment", F.when(surge, "Bullish").when(drop, "Bearish")).filter("sentiment is not null")
    bull = F.col("sentiment") == "Bullish"
    ret = {k: (F.col(f"c{k}") - F.col("close")) / F.col("close") for k in (1, 3, 5)}
    best = F.when(bull, (F.col("top") - F.col("close")) / F.col("close")).otherwise((F.col("close") - F.col("bottom")) / F.col("close"))
    return df.select(
        "symbol", "date", "sentiment", F.bround((F.col("volume") - F.col("t1_vol")) / F.col("t1_vol") * 100, 1).alias("vol_pct"), F.bround((F.col("spread") - F.col("t1_spread")) / F.col("t1_spread") * 100, 1).alias("spread_pct"), F.bround("t_cp", 4).alias("t_cp"),
        *[F.when(bull, r > 0).otherwise(r < 0).alias(f"win_{k}d") for k, r in ret.items()], *[F.bround(r * 100, 2).alias(f"ret_{k}d") for k, r in ret.items()], F.bround(best * 100, 2).alias("max_move_pct"),
    )


def spread_metrics(trades: DataFrame) -> DataFrame:
    """By sentiment: trades, instruments, win rates, mean returns and mean best move."""
    return trades.groupBy("sentiment").agg(F.count(F.lit(1)).alias("trades"), F.count_distinct("symbol").alias("symbols"), *[F.avg(F.col(f"win_{k}d").cast("int")).alias(f"win_rate_{k}d") for k in (1, 3, 5)], *[F.avg(f"ret_{k}d").alias(f"mean_ret_{k}d") for k in (1, 3, 5)], F.avg("max_move_pct").alias("mean_max_move"))


def context_splits(trades: DataFrame) -> DataFrame:
    """Five-bar win rate above and below the exact median volume and spread change, and at strong and weak closes, by sentiment."""
    volume = F.when(F.col("sentiment") == "Bearish", F.abs("vol_pct")).otherwise(F.col("vol_pct"))
    df = trades.withColumn("vol_size", volume)
    medians = df.groupBy("sentiment").agg(F.median("vol_size").alias("med_vol"), F.median("spread_pct").alias("med_spr"))  # two rows
    df = df.join(F.broadcast(medians), "sentiment")
    splits = F.array(
        F.struct(F.lit("volume").alias("split"), F.when(F.col("vol_size") > F.col("med_vol"), "above").otherwise("below").alias("side")),
        F.struct(F.lit("spread").alias("split"), F.when(F.when(F.col("sentiment") == "Bearish", F.col("spread_pct") > F.col("med_spr")).otherwise(F.col("spread_pct") >= F.col("med_spr")), "above").otherwise("below").alias("side")),
        F.struct(F.lit("close").alias("split"), F.when(F.col("t_cp") >= 0.70, "strong").otherwise("weak").alias("side")),
    )
    return df.withColumn("s", F.explode(splits)).groupBy("sentiment", "s.split", "s.side").agg(F.count(F.lit(1)).alias("trades"), F.avg(F.col("win_5d").cast("int")).alias("win_rate_5d"))


def completions_by_symbol(trades: DataFrame, top: int = 10) -> DataFrame:
    """Each symbol's newest `top` completions, with the symbol's newest date, its place in the list of symbols' groups, and how many remain."""
    done = trades.filter("gauntlet_passed")
    w = Window.partitionBy("symbol").orderBy(F.col("completion_date").desc(), F.col("date").desc(), "timeframe")
    whole = Window.partitionBy("symbol")
    df = done.select("symbol", "timeframe", "date", "completion_date", "trigger", F.row_number().over(w).alias("at"), F.max("completion_date").over(whole).alias("newest"), F.count(F.lit(1)).over(whole).alias("n"))
    return df.filter(F.col("at") <= top).withColumn("remaining", F.greatest(F.col("n") - top, F.lit(0))).drop("n")


def conviction_text(trades: DataFrame) -> DataFrame:
    """A sentence on the leading score (volume before close before drift) and one on the conviction (tiers 70 and 40)."""
    v, c, d, conf = F.col("vol_score") * 100, F.col("close_score") * 100, F.col("drift_score") * 100, F.col("confidence")
    # The sentences.
    pct = lambda x: F.floor(x + 0.5).cast("string")
    lead = (
        F.when((v >= c) & (v >= d), F.concat(F.lit("Volume surge of "), pct(v), F.lit("% vs the 20-period average is the primary driver.")))
        .when(c >= d, F.concat(F.lit("A close position score of "), pct(c), F.lit("% indicates price closed "), F.when(c >= 50, "near the favourable").otherwise("away from the favourable"), F.lit(" extreme.")))
        .otherwise(F.concat(F.lit("The drift score of "), pct(d), F.lit("% reflects "), F.when(d >= 50, "improving").otherwise("deteriorating"), F.lit(" close position versus the prior candle.")))
    )
    tail = (
        F.when(conf >= 70, F.concat(F.lit("Overall conviction for this "), F.col("sentiment"), F.lit(" "), F.col("trigger"), F.lit(" signal is strong.")))
        .when(conf >= 40, F.lit("Overall conviction is moderate — treat as a qualifying signal requiring confirmation."))
        .otherwise(F.lit("Overall conviction is low — this signal carries elevated uncertainty."))
    )
    return trades.select("symbol", "timeframe", "date", F.concat(lead, F.lit(" "), tail).alias("summary"))
