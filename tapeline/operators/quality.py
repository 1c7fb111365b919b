"""Quality gate over bars: one verdict per symbol, the first failing check in a fixed order (Q1-Q8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED = ("date", "open", "high", "low", "close", "volume")
LEAST_ROWS = 5


def gate(bars: DataFrame, day: str = "date") -> DataFrame:
    """Q1-Q7: (symbol, rows, reason, passed). Rows with a null in a required column are dropped first and count for nothing.

    The reasons in order: MISSING_COLUMNS, DUPLICATE_DATES, INVALID_OHLC_PRICES, ZERO_TOTAL_VOLUME, INSUFFICIENT_DATA.
    One aggregation per symbol, so Spark combines before the shuffle; a symbol whose rows all went has 0 rows.
    """
    missing = [c for c in REQUIRED if c not in bars.columns]
    if missing:
        return bars.groupBy("symbol").agg(F.lit(0).cast("long").alias("rows"), F.lit("MISSING_COLUMNS").alias("reason"), F.lit(False).alias("passed"))
    full = F.lit(True)
    for c in REQUIRED:
        full = full & F.col(c).isNotNull()
    wrong = (F.col("high") < F.col("low")) | (F.least("open", "high", "low", "close") <= 0)
    stats = bars.groupBy("symbol").agg(
        F.count_if(full).alias("rows"), F.count_distinct(F.when(full, F.col(day))).alias("days"),
        F.count_if(full & wrong).alias("wrong"), F.coalesce(F.sum(F.when(full, F.col("volume"))), F.lit(0.0)).alias("volume"),
    )
    reason = (
        F.when(F.col("rows") != F.col("days"), "DUPLICATE_DATES").when(F.col("wrong") > 0, "INVALID_OHLC_PRICES")
        .when((F.col("rows") > 0) & (F.col("volume") == 0), "ZERO_TOTAL_VOLUME").when(F.col("rows") < LEAST_ROWS, "INSUFFICIENT_DATA")
    )
    return stats.select("symbol", "rows", reason.alias("reason"), reason.isNull().alias("passed"))


def split_by_gate(bars: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q7: (rows of symbols that passed, without incomplete ones; rows in quarantine)."""
    passed = verdicts.filter("passed").select("symbol")
    return bars.dropna(subset=list(REQUIRED)).join(passed, "symbol", "left_semi"), bars.join(passed, "symbol", "left_anti")


def reason_histogram(verdicts: DataFrame) -> DataFrame:
    """Q8: symbols and share of all symbols by reason (PASSED for those without one)."""
    by = verdicts.groupBy(F.coalesce("reason", F.lit("PASSED")).alias("reason")).agg(F.count(F.lit(1)).alias("symbols"))
    total = verdicts.agg(F.count(F.lit(1)).alias("total"), F.avg(F.col("passed").cast("int")).alias("pass_rate"))
    return by.crossJoin(F.broadcast(total)).select("reason", "symbols", (F.col("symbols") / F.col("total")).alias("share"), "pass_rate")


def require_passes(verdicts: DataFrame) -> DataFrame:
    """Q8: raises when no symbol passed."""
    if not verdicts.filter("passed").head(1):
        raise ValueError("no symbol passed the quality gate")
    return verdicts
