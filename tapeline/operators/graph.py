"""Relations between publications and their graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .components import connected_components
from .order import numbered

#: Events up to which a category is paired whole, events up to which a keyword pairs, scores of the two kinds of candidates.
WHOLE, KEYWORD = 100, 50
BY_CATEGORY, BY_KEYWORD = 0.5, 0.7

#: Relation types in order, their terms with scores, the bump of a match.
RULES = (
    ("SUPERSEDES", (("supersedes", 0.85), ("replaces", 0.75)), 0.1),
    ("AMENDS", (("amends", 0.4), ("modified", 0.4), ("substituted", 0.4), ("amendment", 0.4)), 0.2),
    ("WITHDRAWS", (("withdrawn", 0.6), ("rescinded", 0.6), ("stands cancelled", 0.6)), 0.2),
)
#: Names of the rules, how their matched terms are told, and how the kinds of candidates are.
RULE_NAMES = {"SUPERSEDES": "SupersedesRule", "AMENDS": "AmendsRule", "WITHDRAWS": "WithdrawsRule"}
EVIDENCE = {"SUPERSEDES": "explicit keyword '%s'", "AMENDS": "matched '%s'", "WITHDRAWS": "matched '%s'"}
SAME_CATEGORY, NEIGHBOURS, SAME_KEYWORD = "Same Category", "Same Category (Temporal Proximity)", "Shared Keyword: "
EDGE_WEIGHTS = {"HIGH": 1.0, "MEDIUM": 0.7, "LOW": 0.4}


def category_pairs(events: DataFrame) -> DataFrame:
    """G1: (a, b, signal) of the same category: all pairs of up to 100 events; of more, only neighbours by date. The bound keeps a hot category from growing by its square.

    Events are counted before they are joined, and neighbours are told by places in one order of all categories, so no task holds a category.
    """
    e = events.select("event_id", "category", "publication_date")
    counts = materialise(e.groupBy("category").agg(F.count(F.lit(1)).alias("n")))
    small = e.join(counts.filter(F.col("n") <= WHOLE).select("category"), "category", "left_semi")
    a, b = small.select(F.col("event_id").alias("a"), "category"), small.select(F.col("event_id").alias("b"), "category")
    every = a.join(b, "category").filter("a < b").select("a", "b", F.lit(SAME_CATEGORY).alias("signal"))
    large = materialise(numbered(e.join(counts.filter(F.col("n") > WHOLE).select("category"), "category", "left_semi"), "category", F.desc("publication_date"), "event_id"))
    after = large.select((F.col("pos") - 1).alias("pos"), F.col("category").alias("other_category"), F.col("event_id").alias("other"))
    next_ = large.join(after, "pos").filter("category = other_category")
    return every.unionByName(next_.select(F.least("event_id", "other").alias("a"), F.greatest("event_id", "other").alias("b"), F.lit(NEIGHBOURS).alias("signal"))).distinct()


def keyword_pairs(events: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b, keyword) that share a keyword of at most 50 events and aren't known pairs; the first keyword in order."""
    flat = events.select("event_id", F.explode("keywords").alias("keyword")).distinct()
    few = flat.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).filter(f"n between 2 and {KEYWORD}").select("keyword")
    flat = flat.join(few, "keyword", "left_semi")
    pairs = flat.select("keyword", F.col("event_id").alias("a")).join(flat.select("keyword", F.col("event_id").alias("b")), "keyword").filter("a < b")
    return pairs.groupBy("a", "b").agg(F.min("keyword").alias("keyword")).join(known.select("a", "b"), ["a", "b"], "left_anti")


def candidates(events: DataFrame) -> DataFrame:
    """(a, b, score, keyword, signal): pairs, what their kind counts for, and what tells them."""
    first = category_pairs(events)
    second = keyword_pairs(events, first).select("a", "b", F.lit(BY_KEYWORD).alias("score"), "keyword", F.concat(F.lit(SAME_KEYWORD), F.col("keyword")).alias("signal"))
    return first.select("a", "b", F.lit(BY_CATEGORY).alias("score"), F.lit(None).cast("string").alias("keyword"), "signal").unionByName(second)


def rules_met(rules=RULES) -> Column:
    """The rules that an event's own text meets: array of (order, type, score, match: its terms' sum, terms: those it has, in order)."""
    text = F.lower(F.concat_ws(" \n ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))))
    found = []
    for k, (name, terms, bump) in enumerate(rules):
        total = sum((F.when(text.contains(t), s).otherwise(0.0) for t, s in terms), F.lit(0.0))
        found.append(F.when(total > 0, F.struct(F.lit(k).alias("order"), F.lit(name).alias("type"), F.least(total + bump, F.lit(1.0)).alias("score"), total.alias("match"), F.array_compact(F.array(*[F.when(text.contains(t), F.lit(EVIDENCE[name] % t)) for t, _ in terms])).alias("terms"))))
    return F.array_compact(F.array(*found))


def rule_scores(events: DataFrame, rules=RULES) -> DataFrame:
    """Per event the rules that it meets (rules_met). Text is read once per event, not per pair."""
    return events.select("event_id", "publication_date", rules_met(rules).alias("rules"))


def without_texts(events: DataFrame, rules=RULES) -> DataFrame:
    """Events with their rules_met and without texts, stored: candidates, scores and nodes read this table again and again, and texts are read once."""
    return materialise(events.select("doc_id", "event_id", "category", "publication_date", "keywords", rules_met(rules).alias("rules")))


def confidence_level(score: Column) -> Column:
    return F.when(score >= 0.9, "HIGH").when(score >= 0.7, "MEDIUM").otherwise("LOW")


def resolve(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """(relation_id, source, target, type, score, confidence, provenance): both directions of each pair; a source's best rule (the earlier wins ties), where SUPERSEDES
    needs a source not older than its target; 0.5 and more; one relation per pair and type, forward first.

    provenance tells why: rule, matched_terms, signals (keyword_match, the terms' sum), weights (of the candidate's kind and of the rule) and generator_signals.
    """
    s = scores.filter(F.size("rules") > 0)
    way = lambda x, y, back: pairs.select(F.col(x).alias("source"), F.col(y).alias("target"), F.lit(back).alias("back"), F.col("score").alias("generator"), "signal")
    both = way("a", "b", 0).unionByName(way("b", "a", 1))
    j = both.join(s.withColumnRenamed("event_id", "source").withColumnRenamed("publication_date", "s_day"), "source").join(scores.select(F.col("event_id").alias("target"), F.col("publication_date").alias("t_day")), "target")
    able = F.filter("rules", lambda r: (r["type"] != "SUPERSEDES") | (F.col("s_day") >= F.col("t_day")))
    best = F.element_at(F.array_sort(F.transform(able, lambda r: F.struct((-r["score"]).alias("neg"), r["order"].alias("order"), r.alias("rule")))), 1)["rule"]
    j = j.filter(F.size(able) > 0).withColumn("r", best).filter("r.score >= 0.5")
    first = j.groupBy(F.least("source", "target").alias("lo"), F.greatest("source", "target").alias("hi"), F.col("r.type").alias("type")).agg(F.min_by(F.struct("source", "target", "generator", "signal", "r"), "back").alias("x"))
    out = first.select("type", "x.*").withColumn("score", F.col("r.score"))
    rid = F.substring(F.sha2(F.concat_ws(":", "source", "target", "type"), 256), 1, 16)
    name = F.element_at(F.create_map(*[F.lit(v) for pair in RULE_NAMES.items() for v in pair]), F.col("type"))
    why = F.struct(
        name.alias("rule"), F.col("r.terms").alias("matched_terms"), F.struct(F.col("r.match").alias("keyword_match")).alias("signals"),
        F.struct("generator", F.col("score").alias("rule")).alias("weights"), F.array("signal").alias("generator_signals"),
    )
    return out.select(rid.alias("relation_id"), "source", "target", "type", "score", confidence_level(F.col("score")).alias("confidence"), why.alias("provenance"))


def edges(relations: DataFrame) -> DataFrame:
    """G7"""
    weight = F.lit(None).cast("double")
    for name, w in EDGE_WEIGHTS.items():
        weight = F.when(F.col("confidence") == name, w).otherwise(weight)
    return relations.select(F.substring(F.sha2(F.concat(F.lit("edge:"), F.col("relation_id")), 256), 1, 16).alias("edge_id"), "source", "target", "type", weight.alias("weight"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, by star contraction. Isolated nodes are their own."""
    found = connected_components(links, "source", "target")
    return nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def statistics(nodes: DataFrame, links: DataFrame, comps: DataFrame) -> DataFrame:
    """One row: nodes, edges, components, mean degree; the distribution of types is distribution(links, 'type')."""
    n, e = nodes.agg(F.count(F.lit(1)).alias("nodes")), links.agg(F.count(F.lit(1)).alias("edges"))
    c = comps.agg(F.count_distinct("component").alias("components"))
    return n.crossJoin(e).crossJoin(c).withColumn("mean_degree", F.bround(F.coalesce(F.try_divide(2.0 * F.col("edges"), F.col("nodes")), F.lit(0.0)), 2))


def related(links: DataFrame, node: str | Column) -> DataFrame:
    """The other ends of a node's edges; the node is a name, or a column of links that tells it."""
    node = node if isinstance(node, Column) else F.lit(node)
    other = F.when(F.col("source") == node, F.col("target")).otherwise(F.col("source"))
    return links.filter((F.col("source") == node) | (F.col("target") == node)).select(other.alias("related"), "type", "weight", F.when(F.col("source") == node, "out").otherwise("in").alias("direction"))


def analogs(events: DataFrame, history: DataFrame, n: int = 3) -> DataFrame:
    """(event_id, analog_id, at): each event's newest n earlier events of the same category and direction.

    History is numbered along (category, direction, day, id), so an event's analogs are the last n numbers before its day. Which number that is
    is told per category, direction and day: windows hold days, not events, and a hot category makes no pairs beyond n per event.
    """
    group = ["category", "direction"]
    past = history.select(*group, F.col("publication_date").alias("day"), F.col("event_id").alias("analog_id")).filter("category is not null and direction is not null")
    past = materialise(numbered(past, *group, "day", F.desc("analog_id"), name="k"))
    tops = past.groupBy(*group, "day").agg(F.max("k").alias("top"))
    asked = events.select(*group, F.col("publication_date").alias("day")).distinct()
    w = Window.partitionBy(*group).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = asked.join(tops, [*group, "day"], "full").withColumn("last", F.max("top").over(w)).filter("last is not null").select(*group, "day", "last")
    asks = events.select("event_id", *group, F.col("publication_date").alias("day")).join(days, [*group, "day"])
    asks = asks.select("event_id", *group, "last", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("at")).withColumn("k", F.col("last") - F.col("at"))
    found = asks.join(past.select("k", F.col("category").alias("c"), F.col("direction").alias("d"), "analog_id"), "k").filter((F.col("category") == F.col("c")) & (F.col("direction") == F.col("d")))
    return found.select("event_id", "analog_id", (F.col("at") + 1).alias("at"))
