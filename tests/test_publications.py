import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.operators import analytics, enrichment, events, graph, search
from tapeline.sources import publications, sinks

EVENT = "event_id string, title string, content string, category string, publication_date string, official_url string"


def test_two_layouts_and_corrupt_lines(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"event_id":"a","official_data":{"title":"New","publication_date":"2024-01-01"},"metadata":{"lifecycle_status":"ENRICHED"}}\n\n{"event_id":"b","title":"Old","published_at":"2023-01-01","url":"http://x","summary":"text","lifecycle":"NEW","status":"ACTIVE"}\n{broken\n')
    got = {r["event_id"]: r for r in publications.read_events(spark, str(tmp_path)).collect()}
    assert got["a"]["official_data"]["title"] == "New" and got["b"]["official_data"]["content"] == "text" and got["b"]["official_data"]["official_url"] == "http://x"
    assert got[None]["_corrupt_record"] == "{broken"


def test_archive_and_links(spark):
    html = '<a href="/x">no</a><td class="tableheader"><b>Jan 5, 2024</b></td><a href="/n?id=1">One <i>&amp; two</i></a><td class=tableheader><b> Feb  6, 2024 </b></td><a href="http://h/a.pdf">Doc</a><a href="/PDFs/b.pdf">B</a><a href="/accessibility.pdf">c</a>'
    pages = spark.createDataFrame([(1, "http://h.org/p", html), (2, "http://h.org/q", "none")], "page_id long, url string, html string")
    got = publications.archive_rows(pages).orderBy("block", "link").collect()
    assert [(str(r["day"]), r["link"], r["title"]) for r in got] == [("2024-01-05", "/n?id=1", "One & two"), ("2024-02-06", "/PDFs/b.pdf", "B"), ("2024-02-06", "/accessibility.pdf", "c"), ("2024-02-06", "http://h/a.pdf", "Doc")]
    assert {r["page_id"]: r["document"] for r in publications.best_document_link(pages).collect()} == {1: "http://h.org/PDFs/b.pdf", 2: None}


def test_validation_and_counters(spark):
    rows = [("a" * 16, "t", "c", "k", "2024-01-01", "http://x"), ("a" * 16, "t", "", "k", "2024-01-01", "http://x"), ("b", "", None, None, None, None)]
    df = spark.createDataFrame(rows, EVENT)
    got = events.validate(df).collect()
    assert [r["valid"] for r in got] == [True, True, False] and len(got[2]["reasons"]) == 5 and got[1]["warning"]
    assert tuple(events.run_counters(df, "event_id").first()) == (3, 1, 1, 1)


def test_first_by_key(spark):
    df = spark.createDataFrame([("x", 2), ("x", 1), (None, 3), ("y", 4)], "k string, at int")
    known = spark.createDataFrame([("y",)], "k string")
    assert sorted(r["at"] for r in events.first_by_key(df, "k", "at", known).collect()) == [1, 3]


def brute_greedy(ids, dup):
    kept = []
    for i in ids:
        if not any(dup(k, i) for k in kept):
            kept.append(i)
    return set(kept)


def test_greedy_keep_is_the_sequential_rule(spark):
    random.seed(1)
    pairs = {(i, j) for i in range(60) for j in range(i + 1, 60) if random.random() < 0.06}
    got = events.greedy_keep(spark.range(60).toDF("id"), spark.createDataFrame(sorted(pairs), "early long, late long"))
    assert {r["id"] for r in got.filter("keep").collect()} == brute_greedy(range(60), lambda a, b: (a, b) in pairs)


def test_greedy_keep_with_groups(spark):
    """A group's later ids go with its first kept one, also where the group's first id goes itself."""
    random.seed(4)
    pairs = {(i, j) for i in range(80) for j in range(i + 1, 80) if random.random() < 0.02}
    group = {i: f"g{i % 9}" for i in range(80) if i % 4}
    got = events.greedy_keep(spark.range(80).toDF("id"), spark.createDataFrame(sorted(pairs), "early long, late long"), spark.createDataFrame(list(group.items()), "id long, group string"))
    kept = {r["id"] for r in got.filter("keep").collect()}
    assert got.count() == 80 and kept == brute_greedy(range(80), lambda a, b: (a, b) in pairs or (a in group and group.get(a) == group.get(b)))


def test_headlines_equal_brute_force(spark):
    random.seed(2)
    words = ["bank", "rate", "policy", "gold", "bond", "loan", "credit", "note", "to", "rbi"]
    titles = [" ".join(random.sample(words, random.randint(1, 6))) for _ in range(80)] + ["to the", "", None, "to the"]
    rows = [(i, t) for i, t in enumerate(titles)]

    def clean(t):
        return {w for w in (t or "").lower().split() if w.isalnum() and w not in events.FILLERS}

    def dup(a, b):
        x, y = clean(titles[a]), clean(titles[b])
        return bool(x and y) and len(x & y) / min(len(x), len(y)) >= 0.7

    got = events.headlines(spark.createDataFrame(rows, "id long, title string"), "id")
    assert {r["id"] for r in got.filter("keep").collect()} == brute_greedy(range(len(titles)), dup)


def test_headlines_shuffle_no_pair_that_does_not_overlap(spark, monkeypatch):
    """Words meet in the join itself: no join behind it brings them to every pair that was tried."""
    seen = []
    monkeypatch.setattr(events, "greedy_keep", lambda nodes, pairs: seen.append(pairs) or nodes.withColumn("keep", F.lit(True)))
    events.headlines(spark.createDataFrame([(1, "gold rate"), (2, "gold bond rate")], "id long, title string"), "id")
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 3
    assert [tuple(r) for r in seen[0].collect()] == [(1, 2)]


def near_rows(n, seed):
    """Titles of all lengths in mixed case, edited copies, empty ones; contents and urls of all kinds."""
    rnd = random.Random(seed)
    base = ["The Central Bank issued a Circular on liquidity", "Inflation DATA for March was released today", "New rules for lenders take effect", "Rate", "ÉTÉ", "ab", "", "Q4 gdp out"]
    rows = []
    for i in range(n):
        t = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 3, 12]) if t else 0):
            t[rnd.randrange(len(t))] = rnd.choice("abcDEF ")
        t = "".join(t)
        t = rnd.choice([t, t.upper(), t.lower()])
        body = rnd.choice(["", t + " body " * rnd.randint(0, 3), t.swapcase() + " Body", "the same content for many of them"])
        rows.append((i, t, f"2024-01-0{rnd.randint(1, 2)}", rnd.choice(["", "", "", "http://x/" + str(i % 9), "HTTP://X/" + str(i % 9) + "/"]), body, rnd.randint(0, 2)))
    return rows


def near_score(a, b):
    """The rule itself, case aside."""
    url = lambda r: r[3].strip().lower().rstrip("/")
    if url(a) and url(a) == url(b):
        return 1.0
    s = 0.4 * SequenceMatcher(None, a[1].lower(), b[1].lower()).ratio() + 0.2 * (a[2] == b[2]) + 0.1 * (url(a) == url(b)) + 0.1 * (a[5] == b[5] > 0)
    return s + (0.2 * SequenceMatcher(None, a[4].lower(), b[4].lower()).ratio() if a[4] and b[4] else 0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = near_rows(60, seed)
    e = spark.createDataFrame(rows, "id long, title string, day string, url string, content string, attachments int")
    got = events.near_duplicates(e)
    assert {r["id"] for r in got.filter("keep").collect()} == brute_greedy(range(60), lambda a, b: near_score(rows[a], rows[b]) >= 0.85 - 1e-9)


def test_case_alone_makes_no_other_event(spark):
    rows = [(1, "Policy Rate Raised", "2024-01-01", "http://a/1", "The BANK raised it", 1), (2, "POLICY rate raised", "2024-01-01", "http://a/2", "the bank Raised IT", 1)]
    e = spark.createDataFrame(rows, "id long, title string, day string, url string, content string, attachments int")
    assert {r["id"]: r["keep"] for r in events.near_duplicates(e).collect()} == {1: True, 2: False}


def test_contents_are_compared_to_their_ends(spark):
    """Texts that begin alike for 10,000 characters and go on differently aren't duplicates; those that differ there and are alike behind are."""
    rnd = random.Random(4)
    some = lambda n: "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(n))
    head, rest = some(10_000), some(40_000)
    bodies = {1: head + some(40_000), 2: head + some(40_000), 3: some(10_000) + rest, 4: some(10_000) + rest}
    e = spark.createDataFrame([(i, "A title", f"2024-01-0{(i + 1) // 2}", "", body, 1) for i, body in bodies.items()], "id long, title string, day string, url string, content string, attachments int")
    assert {r["id"]: r["keep"] for r in events.near_duplicates(e).collect()} == {1: True, 2: True, 3: True, 4: False}


@pytest.mark.parametrize("ratio", [0.625, 0.875, 0.95])
def test_title_candidates_miss_no_pair_and_are_fewer(spark, ratio):
    """All pairs of a ratio or more are candidates; of titles that differ, far fewer than all pairs are."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    titles = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))) for _ in range(200)]
    for k in range(60):
        t = list(titles[rnd.randrange(200)] or "x")
        for _ in range(rnd.randint(0, 6)):
            t[rnd.randrange(len(t))] = rnd.choice("xyz ")
        titles.append("".join(t)[rnd.randint(0, 3) :])
    rows = [(i, "b", t) for i, t in enumerate(titles)]
    got = {(r["early"], r["late"]) for r in events.title_candidates(spark.createDataFrame(rows, "id long, block string, title string"), ratio).collect()}
    want = {(i, j) for j in range(len(titles)) for i in range(j) if SequenceMatcher(None, titles[i], titles[j]).ratio() >= ratio}
    assert want <= got and len(want) >= 50
    square = len(titles) * (len(titles) - 1) / 2
    assert len(got) < square * (0.05 if ratio > 0.8 else 0.9)


def test_stored_titles_are_not_gathered_in_the_driver(spark):
    """Six hundred titles of one day take some KB in Parquet; joined, they must not be broadcast, and a large block is dealt to several parts, each pair once."""
    rows = spark.range(600).select("id", F.lit("b").alias("block"), F.concat(F.lit("the same long words "), F.col("id").cast("string")).alias("title"))
    for ratio in (0.625, 0.875):
        assert "BroadcastHashJoin" not in events.title_candidates(rows, ratio)._jdf.queryExecution().executedPlan().toString()
    got = events.title_candidates(rows, 0.625)
    found = got.collect()
    assert len(found) == len(set(found)) == 600 * 599 // 2


def test_texts_are_read_once_for_relations(spark):
    """A graph's plan reads the stored table without texts, not the documents."""
    from places import DATA
    from tapeline.plans import event_queries as q

    assert "documents.parquet" not in " ".join(q.relations(spark, DATA)[1].inputFiles())


def test_texts_are_read_once_for_terms(spark):
    """A search of several terms reads the events' texts in one pass: its plan reads a stored table without texts."""
    from places import DATA
    from tapeline.plans import event_queries as q

    for df in (q._expression(spark, DATA), q._ranked(spark, DATA)):
        assert "documents.parquet" not in " ".join(df.inputFiles())


def test_new_since_falls_back(spark):
    df = spark.createDataFrame([(f"e{i}", f"2024-01-0{i}") for i in range(1, 6)], "event_id string, publication_date string")
    for day, want in (("2024-01-04", {"e5"}), ("2024-02-01", {"e3", "e4", "e5"})):
        got = events.new_since(df, spark.createDataFrame([(day,)], "session_date string"))
        assert {r["event_id"] for r in got.filter("is_new").collect()} == want


def test_impact_and_study(spark):
    rows = [("1", "Policy rate hike", "", "x", "", ""), ("2", "Liquidity", "inject funds", "x", "", ""), ("3", "Other", None, "own", "", "")]
    got = [(r["impact"]["direction"], r["impact"]["severity"], r["impact"]["category"]) for r in enrichment.impact(spark.createDataFrame(rows, EVENT)).orderBy("event_id").collect()]
    assert got == [("Negative", "Critical", "Monetary Policy"), ("Positive", "Medium", "Liquidity"), ("Neutral", "Informational", "own")]
    prices = spark.sql("select 'A' as symbol, date_add(date'2024-01-01', cast(id as int)) as date, 100.0D + id as close from range(30)")
    study = enrichment.event_study(spark.sql("select 'e' as event_id, 'A' as symbol, date'2024-01-11' as day"), prices)
    ret = {r["offset"]: r["ret"] for r in study.collect()}
    assert (ret[-5], ret[5], ret[20]) == (4.76, 4.55, None)


def test_snapshots_get_the_next_version(spark):
    old = spark.createDataFrame([("a", 1, "x", 5), ("a", 2, "y", 6)], "event_id string, version int, summary string, confidence int")
    new = spark.createDataFrame([("a", "z", 7), ("b", "n", 8)], "event_id string, summary string, confidence int")
    got = {r["event_id"]: tuple(r)[1:] for r in enrichment.current_snapshot(enrichment.add_snapshots(old, new)).collect()}
    assert got == {"a": (3, "z", 7), "b": (1, "n", 8)}


def test_metrics_on_empty_and_null_events(spark):
    schema = "event_id string, severity string, effective_date string, pdf_url string, attachments int, confidence int, quality int, relevance string"
    for rows in ([], [(None,) * 8]):
        r = analytics.evaluate(spark.createDataFrame(rows, schema), analytics.metrics("2024-01-01")).first()
        assert r["ai_success_rate"] == 0 and r["total_events"] == len(rows)


def test_search_expressions(spark):
    rows = [(f"d{i}", t, c) for i, (t, c) in enumerate([("alpha beta the", 10), ("alpha gamma", 50), ("beta gamma of", 90), (None, None)])]
    e = search.with_tokens(spark.createDataFrame(rows, "event_id string, title string, confidence int"), "title")
    i = search.postings(e)
    ids = lambda q: {r["event_id"] for r in q.of(e, i).collect()}
    a, b = search.term("Alpha"), search.term("beta")
    assert (ids(a & b), ids(a | b), ids(~a), ids(search.all_of("alpha", "gamma"))) == ({"d0"}, {"d0", "d1", "d2"}, {"d2", "d3"}, {"d1"})
    assert ids(search.field("confidence", "<=", 50)) == {"d0", "d1"}
    assert "the" not in {r["token"] for r in i.collect()}
    hits = search.rank(a | b, e, i).orderBy(F.col("score").desc(), "event_id").collect()
    assert [(r["event_id"], r["score"], r["total_hits"]) for r in hits] == [("d0", 0.7, 3), ("d1", 0.6, 3), ("d2", 0.6, 3)]
    for bad in (("nothing", ":", 1), ("category", ">", "x"), ("confidence", ">", "high")):
        with pytest.raises(ValueError):
            search.field(*bad)


def test_relations_and_graph(spark):
    rows = [("1", "A supersedes B", "", "N", "2024-01-02"), ("2", "B supersedes A", "", "N", "2024-01-02"), ("3", "amends", "modified amendment", "N", "2024-01-01"), ("4", "x", "", "O", "2024-01-01")]
    e = spark.createDataFrame(rows, "event_id string, title string, content string, category string, publication_date string").withColumn("keywords", F.array().cast("array<string>"))
    r = graph.resolve(graph.candidates(e), graph.rule_scores(e))
    got = {(x["source"], x["target"], x["type"], x["confidence"]) for x in r.collect()}
    assert got == {("1", "2", "SUPERSEDES", "HIGH"), ("1", "3", "SUPERSEDES", "HIGH"), ("2", "3", "SUPERSEDES", "HIGH"), ("3", "1", "AMENDS", "HIGH"), ("3", "2", "AMENDS", "HIGH")}
    why = {x["source"]: x["provenance"].asDict(True) for x in r.collect()}
    assert why["3"] == {"rule": "AmendsRule", "matched_terms": ["matched 'amends'", "matched 'modified'", "matched 'amendment'"], "signals": {"keyword_match": pytest.approx(1.2)}, "weights": {"generator": 0.5, "rule": 1.0}, "generator_signals": ["Same Category"]}
    assert why["1"]["rule"] == "SupersedesRule" and why["1"]["matched_terms"] == ["explicit keyword 'supersedes'"]
    links = graph.edges(r)
    comps = graph.components(e.select(F.col("event_id").alias("node")), links)
    assert {x["node"]: x["component"] for x in comps.collect()} == {"1": "1", "2": "1", "3": "1", "4": "4"}
    s = graph.statistics(e, links, comps).first()
    assert (s["nodes"], s["edges"], s["components"], s["mean_degree"]) == (4, 5, 2, 2.5)
    assert graph.related(links, "3").count() == 4


def test_large_categories_pair_neighbours_only(spark):
    e = spark.sql("select lpad(cast(id as string), 4, '0') as event_id, 'C' as category, cast(date_add(date'2024-01-01', cast(id as int)) as string) as publication_date from range(101)")
    assert graph.category_pairs(e).count() == 100


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("source"), F.lpad((F.col("id") + 1).cast("string"), 4, "0").alias("target"))
    assert {r["component"] for r in graph.components(links.select(F.col("source").alias("node")), links).collect()} == {"0000"}


def test_contract(spark):
    want = T.StructType([T.StructField("symbol", T.StringType(), False), T.StructField("stars", T.IntegerType()), T.StructField("gone", T.StringType())])
    df = spark.createDataFrame([(None, 7)], "symbol string, stars int")
    assert sinks.contract_violations(df, want, {"stars": [1, 2]}) == ["missing gone", "null in symbol", "domain of stars"]
    with pytest.raises(ValueError):
        sinks.require_contract(df, want)
