"""Metrics of publications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def events_per_day(events: DataFrame) -> DataFrame:
    """A1"""
    return events.groupBy(F.substring("publication_date", 1, 10).alias("day")).agg(F.count(F.lit(1)).alias("events")).orderBy("day")


def distribution(events: DataFrame, column: str) -> DataFrame:
    """A2"""
    return events.groupBy(column).agg(F.count(F.lit(1)).alias("events"))


def top(events: DataFrame, column: str, n: int = 10) -> DataFrame:
    """A5: the n most frequent values; equal counts in the values' order."""
    return distribution(events.filter(F.col(column).isNotNull()), column).orderBy(F.col("events").desc(), column).limit(n)


BUCKETS = ((20, "0-20"), (40, "21-40"), (60, "41-60"), (80, "61-80"), (100, "81-100"))


def confidence_histogram(events: DataFrame) -> DataFrame:
    """Events by bucket of the latest snapshot's confidence; empty buckets have no row."""
    bucket = F.lit(BUCKETS[-1][1])
    for limit, name in reversed(BUCKETS[:-1]):
        bucket = F.when(F.col("confidence") <= limit, name).otherwise(bucket)
    return events.filter("confidence is not null").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("events"))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def has(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")) != ""


def metrics(as_of: str) -> dict[str, dict[str, Column]]:
    """Metric groups by name; add a Column to a group to register a metric. All are aggregates of one pass."""
    n, ai = F.count(F.lit(1)), F.count_if(F.col("confidence").isNotNull())
    upcoming = F.try_to_date("effective_date", "yyyy-MM-dd") > F.lit(as_of).cast("date")
    pdf, attached = has("pdf_url"), F.col("attachments") > 0
    return {
        "business": {"high_priority": F.count_if(F.col("severity").isin("High", "Critical")), "upcoming_effective": F.count_if(F.coalesce(upcoming, F.lit(False))), "total_events": n},
        "ai": {"ai_events": ai, "ai_success_rate": _share(ai, n)},
        "quality": {
            "with_pdf": F.count_if(pdf), "missing_attachment": F.count_if(~pdf & ~attached), "missing_effective_date": F.count_if(~has("effective_date")),
            "ai_coverage": _share(ai, n), "mean_quality": _share(F.sum(F.when(F.col("confidence").isNotNull(), F.col("quality")).otherwise(0)), n),
        },
        "coverage": {
            "cover_ai": _share(ai, n), "cover_pdf": _share(F.count_if(pdf), n), "cover_attachments": _share(F.count_if(attached), n),
            "cover_effective_date": _share(F.count_if(has("effective_date")), n), "cover_relevance": _share(F.count_if(has("relevance")), n),
        },
    }


def evaluate(events: DataFrame, groups: dict[str, dict[str, Column]]) -> DataFrame:
    """One row with every metric of the groups, computed together."""
    return events.agg(*[c.alias(name) for group in groups.values() for name, c in group.items()])


def operational_rates(counters: DataFrame) -> DataFrame:
    """Rates over the runs' counters (collected, validation_failed, duplicates, saved), with defaults when nothing ran."""
    total = F.sum("collected")
    rate = lambda c, default: F.coalesce(F.try_divide(F.sum(c), total), F.lit(default))
    return counters.agg(rate("saved", 0.0).alias("save_rate"), rate("duplicates", 0.0).alias("duplicate_rate"), rate("validation_failed", 0.0).alias("failure_rate"), F.coalesce(1 - F.try_divide(F.sum("validation_failed"), total), F.lit(1.0)).alias("collector_success"))


def upsert_history(history: DataFrame, today: DataFrame, key: str = "run_date") -> DataFrame:
    """History with today's rows in place of those of the same key."""
    return history.join(today.select(key).distinct(), key, "left_anti").unionByName(today)


def freshness(published: DataFrame, as_of: Column, at: str = "generated_at", hours: int = 26) -> DataFrame:
    """Stale if published over 26 hours before as_of."""
    return published.withColumn("stale", F.coalesce(as_of - F.col(at) > F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0)), F.lit(True)))
