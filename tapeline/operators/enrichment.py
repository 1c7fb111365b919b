"""Enrichment of publications and event studies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keyword groups in the order of their priority: keywords, asset classes, sectors, horizon, category, severity, importance, confidence,
#: then words of a positive and of a negative direction, which of them is looked for first, and the direction when none occurs.
IMPACT_RULES = [
    (["repo rate", "policy rate", "mpc", "monetary policy committee"], ["Equity", "Bonds", "Currency"], ["Banking", "NBFC", "Realty", "Auto"], "1-5 days", "Monetary Policy", "Critical", 100, 95, ["cut"], ["hike"], "positive", "Neutral"),
    (["crr", "slr", "reserve ratio"], ["Equity", "Bonds"], ["Banking", "PSU Banks"], "Weekly", "Monetary Policy", "High", 85, 90, ["cut", "reduce"], ["hike", "increase"], "positive", "Neutral"),
    (["nbfc", "non-banking", "housing finance"], ["Equity"], ["NBFC", "Fintech"], "1-5 days", "Regulatory", "Medium", 60, 85, ["relax"], ["strict", "penalty", "curb"], "negative", "Neutral"),
    (["forex", "exchange rate", "usd", "rupee"], ["Currency", "Equity"], ["IT", "Pharma", "Auto"], "Intraday", "Forex", "Medium", 50, 80, [], [], "positive", "Mixed"),
    (["liquidity", "omo", "vrrr"], ["Bonds", "Equity"], ["Banking"], "1-5 days", "Liquidity", "Medium", 65, 85, ["inject"], ["absorb"], "positive", "Neutral"),
    (["gdp", "inflation", "cpi", "wpi"], ["Equity", "Bonds", "Currency"], ["All"], "Weekly", "Economic Data", "High", 80, 90, ["beat", "growth", "fall in inflation"], [], "positive", "Negative"),
    (["circular", "directive", "regulation", "guideline"], ["Equity"], ["Banking", "NBFC"], "Monthly", "Regulatory", "Low", 20, 75, [], [], "positive", "Neutral"),
]

#: Securities of a sector.
SECTOR_SECURITIES = {
    "Banking": ["HDFCBANK", "ICICIBANK", "SBIN", "AXISBANK", "KOTAKBANK"],
    "PSU Banks": ["SBIN", "PNB", "BOB", "CANBK", "UNIONBANK"],
    "NBFC": ["BAJFINANCE", "CHOLAFIN", "M&MFIN", "SHRIRAMFIN"],
    "Realty": ["DLF", "MACROTECH", "GODREJPROP", "OBEROIRLTY"],
    "Auto": ["TATAMOTORS", "M&M", "MARUTI", "BAJAJ-AUTO", "HEROMOTOCO"],
    "IT": ["TCS", "INFY", "HCLTECH", "WIPRO", "TECHM"],
    "Pharma": ["SUNPHARMA", "CIPLA", "DRREDDY", "DIVISLAB", "LUPIN"],
    "Fintech": ["PAYTM", "PBFINTECH"],
}

OFFSETS = (-5, -3, -1, 1, 3, 5, 10, 20)


def _any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def _words(xs: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")


def _impact(rule, direction, category) -> Column:
    return F.struct(
        _words(rule[1]).alias("asset_classes"), _words(rule[2]).alias("sectors"), F.lit(rule[3]).alias("horizon"), direction.alias("direction"), category.alias("category"),
        F.lit(rule[5]).alias("severity"), F.lit(rule[6]).alias("importance"), F.lit(rule[7]).alias("confidence"),
    )


def impact(events: DataFrame, rules=IMPACT_RULES) -> DataFrame:
    """Adds `impact` by the first rule that a keyword of title and content meets; else an informational default of the event's own category."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))))
    df = events.withColumn("_text", text)
    out = _impact(((), ["Equity"], ["All"], "1-5 days", "", "Informational", 10, 50), F.lit("Neutral"), F.coalesce("category", F.lit("")))
    for rule in reversed(rules):
        good, bad = F.when(_any(F.col("_text"), rule[8]), "Positive"), F.when(_any(F.col("_text"), rule[9]), "Negative")
        first, second = (good, bad) if rule[10] == "positive" else (bad, good)
        out = F.when(_any(F.col("_text"), rule[0]), _impact(rule, F.coalesce(first, second, F.lit(rule[11])), F.lit(rule[4]))).otherwise(out)
    return df.withColumn("impact", out).drop("_text")


def securities(events: DataFrame, sectors: Column, table: dict = SECTOR_SECURITIES) -> DataFrame:
    """Adds `securities`, sorted and each once, of an event's sectors; unknown sectors have none. The map is a parameter of a few entries."""
    lookup = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), _words(v))])
    found = F.flatten(F.transform(sectors, lambda s: F.coalesce(F.try_element_at(lookup, s), F.array().cast("array<string>"))))
    return events.withColumn("securities", F.array_sort(F.array_distinct(found)))


def event_study(events: DataFrame, prices: DataFrame, offsets=OFFSETS) -> DataFrame:
    """(event_id, symbol, day, t0, offset, ret): the close's change in percent between t0 and t0 + offset sessions, with the sign that a later price is higher.

    t0 is the first session on or after the event's day. It is told once per symbol and day: sessions and the events' distinct days are put
    in one order by date, so windows hold days, however many events there are. `events`: event_id, symbol, day.
    Offsets outside the data, and prices of 0 or less, give null.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    sessions = prices.select("symbol", F.col("date"), "close").withColumn("n", F.row_number().over(w))
    days = events.select("symbol", F.col("day").alias("date")).distinct()
    both = sessions.select("symbol", "date", F.lit(1).alias("kind"), "n").unionByName(days.select("symbol", "date", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("n")))
    from_behind = Window.partitionBy("symbol").orderBy(F.desc("date"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    first = both.withColumn("t0", F.last("n", ignorenulls=True).over(from_behind)).filter("kind = 0").select("symbol", F.col("date").alias("day"), "t0")
    at = events.select("event_id", "symbol", "day").join(first, ["symbol", "day"])
    wide = at.withColumn("offset", F.explode(F.array(*[F.lit(o) for o in offsets]))).withColumn("n", F.col("t0") + F.col("offset"))
    base = sessions.select(F.col("symbol").alias("s0"), F.col("n").alias("n0"), F.col("close").alias("c0"))
    then = sessions.select(F.col("symbol").alias("s1"), F.col("n").alias("n1"), F.col("close").alias("c1"))
    df = wide.join(base, (F.col("symbol") == F.col("s0")) & (F.col("t0") == F.col("n0")), "left").join(then, (F.col("symbol") == F.col("s1")) & (F.col("n") == F.col("n1")), "left")
    first, last = F.when(F.col("offset") < 0, F.col("c1")).otherwise(F.col("c0")), F.when(F.col("offset") < 0, F.col("c0")).otherwise(F.col("c1"))
    ret = F.when((first > 0) & (last > 0), F.bround((last - first) / first * 100, 2))
    return df.select("event_id", "symbol", "day", "t0", "offset", ret.alias("ret"))


def regimes(events: DataFrame, classified: DataFrame, frames=("daily", "weekly", "monthly")) -> DataFrame:
    """(event_id, symbol, day, timeframe, before, after): in each timeframe the sentiment last classified before the event's day and first after it; Neutral if none.

    `classified`: symbol, timeframe, date, sentiment; a week's or month's date is its last day, on which its class is known (timeframes.last_day).
    """
    days = events.select("symbol", F.col("day").alias("date")).distinct().withColumn("timeframe", F.explode(F.array(*map(F.lit, frames))))  # windows hold days, not events
    both = classified.select("symbol", "timeframe", "date", "sentiment", F.lit(False).alias("asked")).unionByName(days.select("symbol", "timeframe", "date", F.lit(None).cast("string").alias("sentiment"), F.lit(True).alias("asked")))
    day = F.datediff("date", F.lit("1970-01-01"))
    earlier, later = (Window.partitionBy("symbol", "timeframe").orderBy(d).rangeBetween(Window.unboundedPreceding, -1) for d in (day, -day))
    told = both.withColumn("before", F.last("sentiment", ignorenulls=True).over(earlier)).withColumn("after", F.last("sentiment", ignorenulls=True).over(later)).filter("asked")
    df = events.select("event_id", "symbol", "day").join(told.select("symbol", "timeframe", F.col("date").alias("day"), "before", "after"), ["symbol", "day"])
    return df.select("event_id", "symbol", "day", "timeframe", F.coalesce("before", F.lit("Neutral")).alias("before"), F.coalesce("after", F.lit("Neutral")).alias("after"))


def sanitise(text: Column, limit: int = 8000) -> Column:
    """No tags, no triple quotes, at most `limit` characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]+>", ""), r'"""|\'\'\'', ""), 1, limit)


#: Marks of a key sentence.
CUES = ("%", "INR", "Rs", "crore", "percent", "policy", "rate")
TEMPLATE = "This macroeconomic event covers: {}. It represents a key policy update or official announcement."
PADDING = ("Aims to ensure monetary stability and financial regulations.", "Provides guidance on macroeconomic trends and system liquidity.")


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _stop(c: Column) -> Column:
    return F.when(c.endswith("."), c).otherwise(F.concat(c, F.lit(".")))


def extractive_summary(events: DataFrame, cues=CUES, template: str = TEMPLATE, padding=PADDING) -> DataFrame:
    """Adds summary (first three sentences of over 15 characters in the first three paragraphs, else the template) and key_points (up to four sentences of over 20 with a digit or a cue; filled up if fewer than three; five at most)."""
    paragraphs = F.filter(F.transform(F.split(F.col("content"), "\n"), _strip), lambda p: p != "")
    sentences = lambda ps, n: F.filter(F.flatten(F.transform(ps, lambda p: F.transform(F.split(p, r"\. |\? |! "), _strip))), lambda s: F.length(s) > n)
    first = F.slice(sentences(F.slice(paragraphs, 1, 3), 15), 1, 3)
    head, tail = template.split("{}")
    summary = F.when(F.size(first) > 0, _stop(F.array_join(first, " "))).otherwise(F.concat(F.lit(head), F.col("title"), F.lit(tail)))
    cue = "|".join(c.replace("%", "[%]") for c in cues)
    points = F.transform(F.slice(F.array_distinct(F.filter(sentences(paragraphs, 20), lambda s: s.rlike(rf"[0-9]|{cue}"))), 1, 4), _stop)
    filler = F.array(F.concat(F.lit("Official announcement regarding "), F.col("title"), F.lit(".")), *[F.lit(p) for p in padding])
    points = F.slice(F.when(F.size(points) < 3, F.concat(points, filler)).otherwise(points), 1, 5)
    return events.withColumn("summary", summary).withColumn("key_points", points)


def add_snapshots(snapshots: DataFrame, fresh: DataFrame) -> DataFrame:
    """(event_id, version, summary, confidence) with fresh summaries as each event's next version. One version per event and call; a map-side maximum finds the last one."""
    last = snapshots.groupBy("event_id").agg(F.max("version").alias("last"))
    new = fresh.join(last, "event_id", "left").select("event_id", (F.coalesce("last", F.lit(0)) + 1).alias("version"), "summary", "confidence")
    return snapshots.select("event_id", "version", "summary", "confidence").unionByName(new)


def current_snapshot(snapshots: DataFrame) -> DataFrame:
    """Each event's latest snapshot."""
    return snapshots.groupBy("event_id").agg(F.max("version").alias("version"), F.max_by("summary", "version").alias("summary"), F.max_by("confidence", "version").alias("confidence"))


def event_cards(events: DataFrame) -> DataFrame:
    """The flat card of each event (with `impact` and `summary` columns), date as `dd MMM yyyy` or its first ten characters."""
    day = F.try_to_date(F.substring("publication_date", 1, 10), "yyyy-MM-dd")
    priority = F.coalesce("impact.severity", F.lit("Informational"))
    return events.select(
        "event_id", "title", F.col("publication_date").alias("published"), F.coalesce(F.date_format(day, "dd MMM yyyy"), F.substring("publication_date", 1, 10)).alias("display_date"), "category", priority.alias("priority"),
        F.coalesce("summary", "content", F.lit("")).alias("summary"), F.coalesce("impact.confidence", F.lit(0)).alias("confidence"), F.coalesce("impact.direction", F.lit("Neutral")).alias("impact"),
        F.col("pdf_url").alias("pdf"), F.concat_ws(",", "category", priority).alias("badges"), F.col("official_url").alias("url"),
    )
