"""The stored index: equal to scans, and what its lookups read."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tapeline.operators import index, search
from tapeline.sources.shared import shared_dir

WORDS = ["alpha", "beta", "gamma", "delta", "the", "rate", "Rates", "été", "q1x"]


@pytest.fixture(scope="module")
def events(spark):
    """Documents over three segments, some without text, and one word that nearly all have."""
    rnd = random.Random(2)
    rows = [(k * 997, f"e{k}", " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 6))) or None, rnd.choice([None, "", "x", "Ab\0c", "common word İ"])) for k in range(200)]
    return spark.createDataFrame(rows, "doc_id long, event_id string, title string, content string")


@pytest.fixture(scope="module")
def words(spark, events):
    return index.write_words(events, shared_dir(spark), "title", "content", buckets=7, shards=5)


@pytest.fixture(scope="module")
def by_gram(spark, events):
    return index.write_grams(events, shared_dir(spark), "title", "content", buckets=7, shards=5)


def ids(index_, found):
    return {r["event_id"] for r in index_.get(found).collect()}


def test_expressions_equal_the_scanning_ones(events, words):
    e = search.with_tokens(events, "title", "content")
    i = search.postings(e)
    want = lambda q: {r["event_id"] for r in q.of(e, i).collect()}
    assert ids(words, words.term("ALPHA")) == want(search.term("alpha")) and ids(words, words.any_of("beta", "q1x")) == want(search.any_of("beta", "q1x"))
    assert ids(words, words.all_of("alpha", "rates", "common")) == want(search.all_of("alpha", "rates", "common"))
    assert ids(words, words.none_of(words.term("alpha"))) == want(~search.term("alpha"))
    assert ids(words, words.all_of("alpha", "nowhere")) == ids(words, words.all_of()) == ids(words, words.any_of()) == set()
    assert words.counts(["alpha", "nowhere"]) == {"alpha": len(want(search.term("alpha"))), "nowhere": 0}
    assert words.postings().agg(F.max("segment")).first()[0] == 199 * 997 // search.SEGMENT > 1


@pytest.mark.parametrize("needle", ["a", "é", "ET", "alp", "pha be", "ab\0c", "gamma delta the", "no such text at all", "x", ""])
def test_substrings_equal_the_scanning_ones(events, by_gram, needle):
    got = sorted(tuple(r) for r in index.with_text(by_gram, needle, "title", "content").select("event_id", "doc_id").collect())
    assert got == sorted(tuple(r) for r in search.by_text(events, needle, "title", "content").select("event_id", "doc_id").collect())


def test_a_term_reads_one_bucket_and_a_needle_the_shards_of_its_candidates(words, by_gram):
    plan = words.lists(["alpha"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(\d\)|PartitionFilters: \[[^\]]*bucket#\d+ = \d", plan) and "EqualTo(token,alpha)" in plan
    one = by_gram.spark.createDataFrame([(997,)], "number long")
    plan = by_gram.get(one)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*shard#\d+ (IN \(2\)|= 2)", plan)


def test_an_empty_table(spark, events):
    for write in (index.write_words, index.write_grams):
        i = write(events.limit(0), shared_dir(spark), "title")
        assert i.term("alpha").count() == i.get(i.all_of("alpha", "beta")).count() == index.with_text(i, "al", "title").count() == index.with_text(i, "alpha", "title").count() == 0
