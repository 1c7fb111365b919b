"""Bar sources: CSV files per instrument, vendor JSON, watchlists, and bars made from trades."""

from __future__ import annotations

import csv
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialise

BAR_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())] + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")]
)

#: Header names (lower case, single spaces) that stand for a canonical column, and the words that tell one where none of them occurs.
ALIASES = {
    "date": ("date",),
    "open": ("open", "open price"),
    "high": ("high", "high price"),
    "low": ("low", "low price"),
    "close": ("close", "close price"),
    "volume": ("volume", "total traded quantity", "qty", "tottrdqty", "trdqty"),
    "series": ("series",),
}
KEYWORDS = {"date": "date", "open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume"}
DATE_FORMATS = ("dd-MM-yyyy", "dd/MM/yyyy", "dd-MMM-yyyy", "dd MMM yyyy", "yyyy-MM-dd")


def clean_header(name: str) -> str:
    """One space for runs of white space and underscores, no quotes, no byte order mark, lower case."""
    return " ".join(name.replace("﻿", "").replace('"', "").replace("'", "").replace("_", " ").split()).lower()


def canonical_columns(columns: list[str], aliases=ALIASES, keywords=KEYWORDS, names: list[str] | None = None) -> dict[str, str]:
    """Canonical name -> the column that stands for it. The first match wins; a keyword serves where no alias is there. `names` are what columns are called, if not by themselves."""
    cleaned = [(clean_header(n), c) for n, c in zip(names or columns, columns)]
    found: dict[str, str] = {}
    for name, words in aliases.items():
        hit = next((raw for clean, raw in cleaned if clean in words), None)
        if hit is None and name in keywords:
            hit = next((raw for clean, raw in cleaned if keywords[name] in clean and raw not in found.values()), None)
        if hit is not None:
            found[name] = hit
    return found


def canonicalise(df: DataFrame, aliases=ALIASES) -> DataFrame:
    """Df with canonical column names; columns that stand for none are dropped, but for symbol."""
    names = canonical_columns(df.columns, aliases)
    keep = [F.col("symbol")] if "symbol" in df.columns else []
    return df.select(*keep, *[F.col(f"`{raw}`").alias(name) for name, raw in names.items() if name != "symbol"])


def only_series(df: DataFrame, series: str = "EQ", column: str = "series") -> DataFrame:
    """S3: rows of one series; tables without the column pass whole."""
    return df.filter(F.upper(F.trim(F.col(column))) == series) if column in df.columns else df


def to_number(c: Column) -> Column:
    """Thousands commas, quotes and white space go; what is no number is null."""
    return F.regexp_replace(c.cast("string"), r"[,\"'\s]", "").try_cast("double")


def to_day(c: Column, formats=DATE_FORMATS) -> Column:
    """Day-first dates; null if no format fits. Formats that can't fit by the characters behind the day aren't tried, since each failure is an exception."""
    text = F.trim(c.cast("string"))

    def tried(f: str) -> Column:
        day = F.try_to_date(text, f)
        if not re.fullmatch(r"dd[-/ .]M.*", f):
            return day
        digits = r"\d" if not f[3:].startswith("MMM") else r"\D"
        return F.when(text.rlike(rf"^.{{2}}{re.escape(f[2])}{digits}"), day)

    return F.coalesce(*[tried(f) for f in formats])


#: A file's stem.
STEM = r"([^/]+?)(?:\.[^./]*)?$"


def _places(headers: pd.Series) -> pd.DataFrame:
    """For header lines: their number of columns and, for each canonical name, the place (from 1) of the column that stands for it."""
    rows = []
    for line in headers:
        names = next(csv.reader([line.replace("\ufeff", "")]), [])
        found = canonical_columns(list(map(str, range(len(names)))), names=names)
        rows.append({"width": len(names), **{c: int(found[c]) + 1 if c in found else None for c in ALIASES}})
    return pd.DataFrame(rows, columns=["width", *ALIASES]).astype("Int64")


def read_bars(spark: SparkSession, paths: list[str], series: str | None = "EQ", symbol: str = STEM) -> DataFrame:
    """Bars from CSV files, one or more per instrument. `symbol` finds its name in a file's path: the stem, or another pattern's first group.

    Files are scanned as lines, and each line meets its file's header, which tells where each column is: the plan has one scan whatever headers there
    are, and no path or header comes to the driver but the most columns that one has. Lines equal to a header are headers. A
    required column that a file lacks is null there, which the quality gate reports. Files without a line, and empty lines, have no bars.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    tops = lines.filter("start = 0").withColumn("at", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    tops = materialise(tops.select("file", "header", F.regexp_extract("file", symbol, 1).alias("symbol")))
    told = F.pandas_udf(_places, ", ".join(f"{c} long" for c in ("width", *ALIASES)))
    headers = materialise(tops.select("header").distinct().withColumn("at", told("header")))
    width = headers.agg(F.max("at.width")).first()[0] or 1
    rows = lines.select("file", "value").join(tops, "file").join(headers, "header").filter("value <> header")
    fields = F.from_csv("value", ", ".join(f"c{k} string" for k in range(width)), {"mode": "PERMISSIVE"})
    cells = F.array(*[F.col(f"fields.c{k}") for k in range(width)])
    cell = lambda c: F.try_element_at(F.col("cells"), F.col(f"at.{c}").cast("int"))
    rows = rows.withColumn("fields", fields).withColumn("cells", cells)
    asked = F.col("at.series").isNull() | (F.upper(F.trim(cell("series"))) == series) if series else F.lit(True)
    bar = F.struct(asked.alias("asked"), to_day(cell("date")).alias("date"), *[to_number(cell(c)).alias(c) for c in BAR_SCHEMA.names[2:]])
    out = rows.select("symbol", F.inline(F.array(bar)))  # a generator, behind which filters stay, so that a line is parsed once
    return out.filter("asked").drop("asked").dropna(subset=["date", "close"])


CHART = "struct<chart:struct<result:array<struct<timestamp:array<bigint>,indicators:struct<quote:array<struct<open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<bigint>>>>>>>>"


def chart_bars(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(symbol, date, open .. volume) from a chart payload's parallel arrays: missing values are 0, short arrays are padded, bars without open and close go."""
    doc = F.from_json(payload, CHART).getField("chart").getField("result").getItem(0)
    quote = doc["indicators"]["quote"].getItem(0)
    fields = ["open", "high", "low", "close", "volume"]
    zipped = F.arrays_zip(doc["timestamp"].alias("ts"), *[quote[f].alias(f) for f in fields])
    rows = df.select("symbol", F.explode(zipped).alias("z")).filter("z.ts is not null")
    vals = [F.coalesce(F.col(f"z.{f}").cast("double"), F.lit(0.0)).alias(f) for f in fields]
    return rows.select("symbol", F.to_date(F.timestamp_seconds("z.ts")).alias("date"), *vals).filter("not (open = 0 and close = 0)")


def index_bars(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Bars from an index payload {"data": [{date, open, high, low, close, volume, turnover}]}; missing volume and turnover are 0, an empty payload raises."""
    item = "struct<date:string,open:double,high:double,low:double,close:double,volume:double,turnover:double>"
    data = F.from_json(payload, f"struct<data:array<{item}>>")["data"]
    checked = df.select("symbol", F.when(F.size(data) > 0, data).otherwise(F.raise_error(F.lit("empty index payload"))).alias("data"))
    rows = checked.select("symbol", F.inline("data"))
    return rows.select("symbol", to_day(F.col("date")).alias("date"), "open", "high", "low", "close", F.coalesce("volume", F.lit(0.0)).alias("volume"), F.coalesce("turnover", F.lit(0.0)).alias("turnover"))


def parse_watchlist(df: DataFrame, raw: str = "raw") -> DataFrame:
    """(list_id, symbol, valid, at): names split at commas and line ends, trimmed, in upper case; each name once, where it came first. Rejected names stay, with valid false."""
    parts = df.select("list_id", F.posexplode(F.split(raw, r"[,\n]+")).alias("at", "name")).select("list_id", F.upper(F.trim("name")).alias("symbol"), "at").filter("symbol <> ''")
    return parts.groupBy("list_id", "symbol").agg(F.min("at").alias("at")).select("list_id", "symbol", F.col("symbol").rlike(r"^[A-Z0-9_\-.& ]{1,30}$").alias("valid"), "at")


def newest_snapshot(df: DataFrame, key: str = "symbol", day: str = "snapshot_date") -> DataFrame:
    """The rows of each key's newest snapshot."""
    newest = df.groupBy(key).agg(F.max(day).alias("_day")).withColumnRenamed(key, "_key")
    return df.join(newest, (F.col(key) == F.col("_key")) & (F.col(day) == F.col("_day")), "left_semi")


def bars_from_trades(trades: DataFrame, by_symbol: bool = True, tasks: int | None = None) -> DataFrame:
    """Daily bars of the driver's `lineitem`: the symbol is l_suppkey, the price l_extendedprice / l_quantity, widened by tax and discount for high and low.

    Rows are dealt by symbol once; the day's aggregation and every window over a symbol reuse that partitioning. With by_symbol
    false, trades of a symbol and day are combined before they are dealt by both: for data with many trades a day or a hot symbol.
    `tasks` is the number of tasks that symbols are dealt to, by default the session's.
    """
    raw = ("l_extendedprice", "l_quantity", "l_tax", "l_discount", "l_orderkey", "l_linenumber", "l_partkey")
    rows = trades.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), F.to_date("l_shipdate").alias("date"), *raw)
    if by_symbol:  # what is computed from a trade's columns takes more room than they do, so it is computed behind the shuffle
        rows = rows.repartition(tasks, "symbol") if tasks else rows.repartition("symbol")
    price = F.try_divide("l_extendedprice", "l_quantity")
    rows = rows.select(
        "symbol", "date", price.alias("p"), "l_quantity", (price * (1 + F.col("l_tax"))).alias("up"), (price * (1 - F.col("l_discount"))).alias("down"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("tick"),
    )
    bars = rows.groupBy("symbol", "date").agg(
        F.min_by("p", "tick").alias("open"), F.max("up").alias("high"), F.min("down").alias("low"), F.max_by("p", "tick").alias("close"), F.sum("l_quantity").alias("volume")
    )
    return bars
