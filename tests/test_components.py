"""Star contraction: a long chain, a hub with half of all edges, strings, loops and nulls."""

import random

from pyspark.sql import functions as F

from tapeline.operators import components, graph


def found(df):
    return {r["node"]: r["component"] for r in components.connected_components(df).collect()}


def test_a_long_chain_takes_few_rounds(spark):
    ids = list(range(10_000))
    random.Random(1).shuffle(ids)
    edges, rounds = components.contracted(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long").repartition(4))
    assert rounds <= 16 and edges.count() == 9_999 and edges.agg(F.max("b")).first()[0] == 0


def test_a_hub_and_what_hangs_on_it(spark):
    hub = [(5000, k) for k in range(3000)]
    rest = [(k, k + 1) for k in range(10_000, 13_000, 3)] + [(7, 7), (None, 3), (20_000, None)]
    got = found(spark.createDataFrame(hub + rest, "a long, b long"))
    assert all(got[k] == 0 for k in (*range(3000), 5000)) and all(got[k] == got[k + 1] == k for k in range(10_000, 13_000, 3)) and 20_000 not in got


def test_strings_and_isolated_nodes(spark):
    links = spark.createDataFrame([("c", "b"), ("b", "d"), ("x", "y")], "source string, target string")
    nodes = spark.createDataFrame([(n,) for n in "abcdxyz"], "node string")
    got = {r["node"]: r["component"] for r in graph.components(nodes, links).collect()}
    assert got == {"a": "a", "b": "b", "c": "b", "d": "b", "x": "x", "y": "x", "z": "z"}
    assert graph.components(nodes, links.limit(0)).filter("node <> component").count() == 0
