"""Bar patterns, their validation by later bars, statistics and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indicators import by_date

#: Thresholds against the moving averages, close bands, tolerance at support, bars looked ahead.
ULTRA, HIGH, LOW = 2.5, 1.5, 0.7
WIDE, NORMAL, NARROW = 2.0, 1.2, 0.8
WEAK, STRONG = 0.3, 0.7
SUPPORT = 0.05
LOOKAHEAD = 3

#: Pattern, sentiment, what the effort meant, confidence, description.
SELLING_CLIMAX = ("Selling Climax (Bullish Reversal)", "Bullish", "Absorption", 0.90, "Massive absorption of supply in downtrend.")
BUYING_CLIMAX = ("Buying Climax (Bearish Reversal)", "Bearish", "Effort without Result", 0.85, "Buying climax - exhausting demand at highs.")
UPTHRUST = ("Upthrust (Bearish)", "Bearish", "Supply Entering", 0.80, "High volume rejection at highs.")
NO_DEMAND = ("No Demand (Bearish Weakness)", "Bearish", "Lack of Demand", 0.70, "Up bar on low volume - lack of buying interest.")
STOPPING = ("Stopping Volume (Potential Reversal)", "Bullish", "Absorption", 0.75, "High volume absorption in narrow range.")
TEST = ("Test (Bullish)", "Bullish", "No Supply", 0.80, "Low volume test of supply.")
NOTHING = ("No Signal", None, "Neutral", 0.0, "No institutional signal detected.")


def _named(p: tuple) -> Column:
    return F.struct(F.lit(p[0]).alias("signal"), F.lit(p[1]).cast("string").alias("sentiment"), F.lit(p[2]).alias("meaning"), F.lit(p[3]).alias("confidence"), F.lit(p[4]).alias("description"))


def classic_pattern() -> Column:
    """The first pattern that fits a bar with indicators, as a struct."""
    vol, vma, spr, sma, cp, trend = (F.col(c) for c in ("volume", "volume_ma", "spread", "spread_ma", "close_position", "price_trend"))
    prev_up = F.coalesce(F.lag("is_up").over(by_date()), F.lit(False))
    climax = (vol > vma * ULTRA) & (spr > sma * WIDE)
    return (
        F.when(climax & (cp <= WEAK) & (trend <= 0), _named(SELLING_CLIMAX))
        .when(climax & (cp >= STRONG) & (trend >= 0), _named(BUYING_CLIMAX))
        .when((vol > vma * HIGH) & (spr > sma * NORMAL) & (cp <= WEAK) & (trend >= 0) & prev_up, _named(UPTHRUST))
        .when((vol < vma * LOW) & F.col("is_up") & (trend >= 0), _named(NO_DEMAND))
        .when((vol > vma * HIGH) & (spr < sma * NARROW) & cp.between(WEAK, STRONG), _named(STOPPING))
        .when((vol < vma * LOW) & F.col("is_down") & (F.col("low") <= F.col("support") * (1 + SUPPORT)), _named(TEST))
        .otherwise(_named(NOTHING))
    )


def anomaly_class() -> Column:
    """Two-bar class by the volume change; the first bar of a symbol is Neutral. From no volume to some counts as an endless rise."""
    o, c, before = F.col("open"), F.col("close"), F.col("prev_close")
    cp = F.when(F.col("spread") > 0, F.try_divide(c - F.col("low"), F.col("spread"))).otherwise(0.5)
    change = F.when((F.col("prev_volume") == 0) & (F.col("volume") > 0), F.lit(float("inf"))).otherwise(F.col("vol_pct"))
    return (
        F.when(before.isNull(), "Neutral")
        .when((change < -20) & (c < o) & (c < before), "Continuation Dump").when((change < -20) & (c > o) & (cp < 0.4), "Failed Rally")
        .when((change > 20) & (c > o) & (c > before) & (cp > 0.7), "Silent Accumulation").when((change > 20) & (c < o) & (cp > 0.6), "Bear Trap")
        .when(change < -5, "Neutral Contraction").otherwise("Neutral")
    )


def _met(step: int) -> Column:
    """Whether the bar `step` ahead confirms this bar's signal."""
    later = lambda c: F.lead(c, step).over(by_date())
    up, down, close, low, vol, vma = (later(c) for c in ("is_up", "is_down", "close", "low", "volume", "volume_ma"))
    signal = F.col("signal")
    return (
        F.when(signal == UPTHRUST[0], down & (vol >= F.col("volume") * 0.8))
        .when(signal == NO_DEMAND[0], F.lit(step <= 2) & (down | (up & (vol < vma * 0.8))))
        .when(signal == STOPPING[0], F.lit(step >= 2) & (close > F.col("close")) & (low >= F.col("low") * 0.99))
        .when(signal == SELLING_CLIMAX[0], up & (close > F.col("close")))
        .when(signal == BUYING_CLIMAX[0], down & (close < F.col("close")))
        .when(signal == TEST[0], close > F.col("close") * 1.02)
        .otherwise(F.lit(False))
    )


def with_signals(bars: DataFrame) -> DataFrame:
    """P1-P9 as columns of bars with indicators: signal, sentiment, meaning, confidence, description, anomaly, validation, fire.

    A bar whose third next bar isn't there yet is Pending even if an earlier bar confirms it.
    """
    df = bars.withColumn("_p", classic_pattern()).select("*", "_p.*").drop("_p").withColumn("anomaly", anomaly_class())
    met = F.lit(False)
    for step in range(1, LOOKAHEAD + 1):
        met = met | F.coalesce(_met(step), F.lit(False))
    validation = F.when(F.col("signal") == NOTHING[0], "N/A").when(F.lead("date", LOOKAHEAD).over(by_date()).isNull(), "Pending").when(met, "Confirmed").otherwise("Failed")
    fire = (F.col("volume") > F.col("volume_ma") * 2.0) & ~F.col("signal").contains("No")
    return df.withColumn("validation", validation).withColumn("fire", fire)


def signal_statistics(labelled: DataFrame) -> DataFrame:
    """P10: confirmed, failed, pending, fire and all signals per symbol, and over all (symbol null), in one pass."""
    found = F.col("validation") != "N/A"
    count = lambda v: F.count_if(F.col("validation") == v)
    df = labelled.rollup("symbol").agg(count("Confirmed").alias("confirmed"), count("Failed").alias("failed"), count("Pending").alias("pending"), F.count_if("fire").alias("fire"), F.count_if(found).alias("total"))
    return df.withColumn("confirmation_rate", F.coalesce(F.try_divide("confirmed", "total"), F.lit(0.0)))


def signal_histogram(labelled: DataFrame) -> DataFrame:
    """P11"""
    return labelled.groupBy("signal").agg(F.count(F.lit(1)).alias("bars"))


def win_rate_audit(labelled: DataFrame) -> DataFrame:
    """Per signal, wins over decided ones; pending apart."""
    won, lost = F.count_if(F.col("validation") == "Confirmed"), F.count_if(F.col("validation") == "Failed")
    return labelled.filter("validation <> 'N/A'").groupBy("signal").agg(won.alias("confirmed"), lost.alias("failed"), F.count_if(F.col("validation") == "Pending").alias("pending"), F.try_divide(won, won + lost).alias("win_rate"))


def latest_bars(labelled: DataFrame, n: int = 5) -> DataFrame:
    """The last n bars of each symbol, rn = 1 the newest."""
    newest = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return labelled.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= n)


ROUTES = ("trending", "effort", "ticker", "trigger", "anomaly")


def route_flags(labelled: DataFrame) -> DataFrame:
    """A row per symbol with its five route flags from the last five bars; missing history repeats the oldest bar there is."""
    last = latest_bars(labelled)
    at = lambda c, k: F.max(F.when(F.col("rn") == k, F.col(c)))
    low = F.col("effort").isin("No_Demand", "No_Supply")
    v, p1, p2, p3 = (F.col(f"v{k}") for k in range(1, 5))
    df = last.groupBy("symbol").agg(
        F.bool_or(F.col("validation") == "Confirmed").alias("trending"), F.bool_or(low).alias("effort"),
        F.bool_or((F.col("rn") == 1) & (F.col("signal") != NOTHING[0]) & low).alias("ticker"),
        *[at("volume", k).alias(f"v{k}") for k in range(1, 5)], at("spread", 1).alias("s1"), at("spread", 2).alias("s2"),
        at("vol_pct", 1).alias("vol_pct"), at("signal", 1).alias("signal"), at("confidence", 1).alias("confidence"),
    )
    p1, s2 = F.coalesce(p1, v), F.coalesce("s2", "s1")
    p2 = F.coalesce(p2, p1)
    p3 = F.coalesce(p3, p2)
    return df.select("symbol", "trending", "effort", "ticker", ((v < p1) & (F.col("s1") > s2)).alias("trigger"), ((v < p1) & (p1 > p2) & (p2 > p3)).alias("anomaly"), "vol_pct", "signal", "confidence")


def route_fan_out(flags: DataFrame) -> DataFrame:
    """(route, symbol) for every flag that is set."""
    long = flags.unpivot(["symbol"], list(ROUTES), "route", "on")
    return long.filter("on").select("route", "symbol")


def route_counts(flags: DataFrame) -> DataFrame:
    """Symbols per route. Their names are route_fan_out's rows, so that no cell grows with the symbols."""
    return route_fan_out(flags).groupBy("route").agg(F.count(F.lit(1)).alias("symbols"))


def _mood(pattern: Column) -> Column:
    return F.when(pattern.rlike("Accumulation|Absorption|Trap"), "Bullish").when(pattern.rlike("Dump|Failed"), "Bearish").otherwise("Neutral")


def ticker_cards(labelled: DataFrame) -> DataFrame:
    """A card per symbol from its latest bar: the signal's name and the words in its brackets, else the anomaly and its mood."""
    has = F.col("signal") != NOTHING[0]
    # Fixed value: the sentence on an anomaly.
    text = F.concat(F.lit("Advanced Anomaly Detected: "), F.col("anomaly"), F.lit(". Structural shifts observed in volume/price relationship."))
    return latest_bars(labelled, 1).select(
        "symbol",
        F.when(has, F.element_at(F.split("signal", r" \("), 1)).otherwise(F.col("anomaly")).alias("pattern"),
        F.when(has, F.regexp_extract("signal", r"\((.*)\)", 1)).otherwise(_mood(F.col("anomaly"))).alias("sentiment"),
        F.col("effort"), F.when(has, F.col("description")).otherwise(text).alias("description"),
        F.when(F.col("spread_ma") > 0, F.try_divide("spread", "spread_ma")).otherwise(1.0).alias("spread_ratio"),
        F.when(has, F.col("confidence")).otherwise(F.lit(0.70)).alias("confidence"),
    )


def trigger_rows(labelled: DataFrame) -> DataFrame:
    """Volume and spread of the latest bar against the one before."""
    return latest_bars(labelled, 1).select("symbol", F.col("prev_volume").cast("long").alias("prev_vol"), F.col("volume").cast("long").alias("curr_vol"), F.col("prev_spread").alias("prev_spr"), F.col("spread").alias("curr_spr"), "vol_pct", "spr_pct")


def anomaly_rows(labelled: DataFrame) -> DataFrame:
    """The latest bar's anomaly with its mood."""
    return latest_bars(labelled, 1).select("symbol", F.col("anomaly").alias("pattern"), F.col("prev_volume").cast("long").alias("prev_vol"), F.col("volume").cast("long").alias("curr_vol"), F.col("vol_pct").alias("drop_pct"), _mood(F.col("anomaly")).alias("sentiment"))
