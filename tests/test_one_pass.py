"""Candles of all timeframes, triggers and steps come from one pass over bars; stored logs and history files."""

import glob
import os

from pyspark.sql import functions as F

from places import DATA

from tapeline.operators import sequences, timeframes
from tapeline.plans import bar_queries
from tapeline.sources import sinks
from tapeline.sources.shared import shared_dir, tasks_for


def rows(df):
    return sorted(map(str, df.collect()))


def test_all_candles_are_those_of_each_timeframe(spark):
    b = bar_queries.bars(spark, DATA)
    got = timeframes.all_candles(b, "1997-03-14")
    for t in timeframes.PERIODS:
        assert rows(got.filter(F.col("timeframe") == t)) == rows(timeframes.candles(b, t, "1997-03-14").select(*got.columns))


def test_the_log_deals_trades_once_and_joins_no_bars(spark):
    plan = bar_queries.log(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_walk_forward_equals_the_single_pass(spark):
    f = bar_queries.frames(spark, DATA)
    started = sequences.triggers(timeframes.eigen(f), sequences.sequence_config(spark))
    assert rows(sequences.walk_forward(f, started)) == rows(bar_queries.log(spark, DATA).select(*sequences.walk_forward(f, started).columns))


def test_larger_tables_are_dealt_to_more_tasks(spark):
    assert tasks_for(spark.range(100), 10) == 10 and tasks_for(spark.range(100), 100) is None


def test_resume_stores_the_hashed_log_once(spark):
    base = os.path.dirname(shared_dir(spark))
    before = set(os.listdir(base))
    bar_queries._resumed(spark, DATA)
    made = [d for d in set(os.listdir(base)) - before if glob.glob(f"{base}/{d}/*.parquet")]
    assert sum("hash" in spark.read.parquet(f"{base}/{d}").columns for d in made) == 1


def test_history_of_one_letter_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "100000")
    try:
        sinks.write_history(spark.range(0, 60000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("sequence_id"), F.lit("S1").alias("symbol"), F.lit("Failed").alias("state")), f"{tmp_path}/h")
    finally:
        spark.conf.unset(name)
    assert len(glob.glob(f"{tmp_path}/h/bucket=S/*.parquet")) > 1 and spark.read.parquet(f"{tmp_path}/h").count() == 60000


def test_tasks_are_kept_below_the_shuffle_partitions_too(spark):
    """Fewer tasks than shuffle partitions are a number as well, so that Spark doesn't merge them into larger ones, and no fewer than run at once."""
    assert tasks_for(spark.range(100), 50) == spark.sparkContext.defaultParallelism
