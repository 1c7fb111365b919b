"""Sequence states that resume: every cut, every grouping of parts, tampered events, increments and what a tail reads."""

import os

import pytest
from pyspark.sql import functions as F

from tapeline.operators import sequences
from tapeline.operators.order import numbered
from tapeline.plans import bar_queries
from tapeline.sources.shared import materialise, shared_dir

from places import DATA


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def whole(spark):
    """Hashed events of some hundred sequences, two of them tampered with: one in its first event, one later."""
    log = sequences.chain(bar_queries.log(spark, DATA))
    some = log.select("sequence_id").distinct().orderBy("sequence_id").limit(120)
    log = materialise(numbered(log.join(F.broadcast(some), "sequence_id"), "timestamp", "sequence_id", "stage_no", name="offset"))
    long = [r["sequence_id"] for r in log.filter("stage_no = 2").orderBy("sequence_id").limit(2).collect()]
    spoilt = (F.col("sequence_id") == long[0]) & (F.col("stage_no") == 0) | (F.col("sequence_id") == long[1]) & (F.col("stage_no") == 1)
    return materialise(log.withColumn("failure_reason", F.when(spoilt, "forged").otherwise(F.col("failure_reason"))).coalesce(2).sortWithinPartitions("offset"))


def test_states_of_all_cuts_merge_into_the_whole(spark, whole):
    want = rows(sequences.fold_states(sequences.verify_chain(whole)))
    assert sequences.states(sequences.fold_states(sequences.verify_chain(whole))).filter("state = 'Integrity_Failed'").count() == 2
    n = whole.count()
    for cut in (0, 1, n // 5, n // 2, n - 1, n):
        first = sequences.fold_states(sequences.verify_chain(whole.filter(F.col("offset") < cut)))
        second = sequences.fold_states(sequences.verify_chain(whole.filter(F.col("offset") >= cut), first))
        assert rows(sequences.merge_states(first, second)) == want


def test_merging_is_associative(spark, whole):
    checked = materialise(sequences.verify_chain(whole))
    n = whole.count()
    cuts = [0, n // 4, n // 2, 3 * n // 4, n]
    a, b, c, d = (sequences.fold_states(checked.filter(F.col("offset").between(x, y - 1))) for x, y in zip(cuts, cuts[1:]))
    merge = sequences.merge_states
    want = rows(sequences.fold_states(checked))
    assert rows(merge(a, b, c, d)) == rows(merge(merge(a, b), merge(c, d))) == rows(merge(a, merge(b, merge(c, d)))) == want


def test_checkpoints_resume(spark, whole):
    place, n = shared_dir(spark), whole.count()
    assert sequences.checkpointed(spark, place) is None and rows(sequences.resume(whole, place)) == rows(sequences.fold_states(sequences.verify_chain(whole)))
    assert sequences.checkpoint(whole.filter(F.col("offset") < n // 3), place) == n // 3 - 1
    assert sequences.checkpoint(whole.filter(F.col("offset") < n // 2), place) == n // 2 - 1
    assert sequences.checkpoint(whole.filter(F.col("offset") < n // 2), place) == n // 2 - 1  # nothing is new
    spark.range(1).selectExpr("'half' as sequence_id").write.parquet(f"{place}/upto={n - 1}/_temporary")  # a writer that was lost
    assert sequences.checkpointed(spark, place) == n // 2 - 1
    assert rows(sequences.resume(whole, place)) == rows(sequences.fold_states(sequences.verify_chain(whole)))
    small = shared_dir(spark)
    sequences.compact(spark, place, small)
    assert rows(sequences.stored_states(spark, small)) == rows(sequences.stored_states(spark, place))
    assert spark.read.parquet(small).count() < spark.read.parquet(place).count()


def test_a_tail_reads_only_what_is_behind_the_checkpoint(spark, whole):
    place, n = shared_dir(spark), whole.count()
    sequences.checkpoint(whole.filter(F.col("offset") < n // 2), place)
    plan = sequences.tail(whole, place)._jdf.queryExecution().toString()
    assert f"GreaterThan(offset,{n // 2 - 1})" in plan and sequences.tail(whole, place).count() == n - n // 2


def test_hashes_are_made_without_shuffling_events(spark):
    """The hashed walk is the chained one, row by row, and its only exchange is that of the trades; a stored table leaves no shuffle files."""
    log = bar_queries.log(spark, DATA, hashed=True)
    assert rows(log.select(sorted(log.columns))) == rows((made := sequences.chain(bar_queries.log(spark, DATA))).select(sorted(made.columns)))
    assert log._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    files = lambda: {f for top, _, names in os.walk(spark.conf.get("spark.local.dir")) for f in names if f.startswith("shuffle_")}
    before = files()
    materialise(log.groupBy("symbol").count())
    assert files() <= before
