"""Sinks: partitioned tables, dated publishes, manifests and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_signals(labelled: DataFrame, path: str) -> None:
    """Bars by month of trade, not a file per symbol; rows of a month are brought together first, so that few files are written."""
    df = labelled.withColumn("trade_month", F.date_format("date", "yyyy-MM"))
    df.repartition("trade_month").write.mode("overwrite").partitionBy("trade_month").parquet(path)


def write_history(states: DataFrame, path: str) -> None:
    """By the first letter of the symbol. A letter's rows are brought together, in as many tasks as they need: most symbols may share one."""
    df = states.withColumn("bucket", F.upper(F.substring("symbol", 1, 1)))
    df.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def publish(df: DataFrame, path: str, run_date: str) -> None:
    """today's partition, in place of an earlier one of the same day; other days stay."""
    out = df.withColumn("run_date", F.lit(run_date))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def published_days(spark: SparkSession, path: str) -> DataFrame:
    """The days there are."""
    return spark.read.parquet(path).select(F.col("run_date").cast("string").alias("run_date")).distinct()


def published_on(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """A day's publish; the filter prunes partitions."""
    return spark.read.parquet(path).filter(F.col("run_date") == run_date)


def write_trades(trades: DataFrame, path: str) -> None:
    """A CSV log with a header."""
    trades.write.mode("overwrite").option("header", True).csv(path)


def publish_all(artifacts: dict[str, DataFrame], path: str, version: str) -> DataFrame:
    """Writes every artifact under path and returns the manifest (artifact, records, version); records are observed while writing, not counted again."""
    rows = []
    for name, df in artifacts.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("records")).write.mode("overwrite").parquet(f"{path}/{name}")
        rows.append((name, seen.get["records"], version))
    return next(iter(artifacts.values())).sparkSession.createDataFrame(rows, "artifact string, records long, version string")


def contract_violations(df: DataFrame, required: T.StructType, domains: dict[str, list] | None = None) -> list[str]:
    """What breaks the contract: missing fields, other types, nulls in fields that must not have any, values outside a domain. Nulls and domains are checked in one pass."""
    have = {f.name: f.dataType for f in df.schema.fields}
    found = [f"missing {f.name}" for f in required.fields if f.name not in have]
    found += [f"type of {f.name}: {have[f.name].simpleString()}" for f in required.fields if f.name in have and have[f.name] != f.dataType]
    checks = {f"null in {f.name}": F.count_if(F.col(f.name).isNull()) for f in required.fields if not f.nullable and f.name in have}
    checks |= {f"domain of {c}": F.count_if(~F.col(c).isin(values)) for c, values in (domains or {}).items() if c in have}
    if checks:
        row = df.agg(*[c.alias(f"c{k}") for k, c in enumerate(checks.values())]).first()
        found += [name for name, n in zip(checks, row) if n]
    return found


def require_contract(df: DataFrame, required: T.StructType, domains: dict[str, list] | None = None) -> DataFrame:
    """Df, or an error that lists what breaks the contract."""
    if found := contract_violations(df, required, domains):
        raise ValueError("; ".join(found))
    return df
