"""Search over documents: tokens, postings, set expressions, ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise

#: Stop words.
STOP = ("the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "from", "this", "that", "is", "are", "was", "were", "be", "been", "it", "as")

#: Weights of the parts of a hit's explanation.
PARTS = {"text_match": 0.4, "relationship_weight": 0.2, "graph_centrality": 0.15, "priority": 0.1, "recency": 0.1, "ai_confidence": 0.05}

#: Documents of one segment of the inverted index: bounds the length of its lists.
SEGMENT = 1 << 16


def tokens(text: Column, stop=STOP) -> Column:
    """K1: distinct lower-case words of ASCII letters and digits, of three characters and more, without stop words."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda t: t.rlike("^[a-z0-9]{3,}$"))
    return F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in stop]))


def with_tokens(events: DataFrame, *fields: str) -> DataFrame:
    return events.withColumn("tokens", tokens(F.concat_ws(" ", *fields)))


def postings(events: DataFrame, key: str = "event_id") -> DataFrame:
    """K2: (token, key), each once per event: the index as a table; sort or bucket it by token to keep it."""
    return events.select(key, F.explode("tokens").alias("token")).select("token", key)


def looked_up(events: DataFrame, words, fields: list[str], keep: list[str]) -> DataFrame:
    """Every event's columns `keep` and, as its tokens, those of `words` that it has; stored, so that a query of many terms reads and splits texts once. A search for other words needs another table."""
    asked = F.array(*[F.lit(w.lower()) for w in dict.fromkeys(words)])
    return materialise(with_tokens(events, *fields).select(*keep, F.array_intersect("tokens", asked).alias("tokens")))


def inverted_index(events: DataFrame, key: str = "event_id", number: str = "doc_id") -> DataFrame:
    """K2: (token, segment, ids): sorted ids of the events with the token, by segments of 65,536 document numbers, so that no list outgrows its cell. Events are there once each, as are their tokens."""
    rows = events.select(key, F.floor(F.col(number) / SEGMENT).alias("segment"), F.explode("tokens").alias("token"))
    return rows.groupBy("token", "segment").agg(F.sort_array(F.collect_list(key)).alias("ids"))


def term_frequency(index: DataFrame) -> DataFrame:
    """K3"""
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("documents"))


@dataclass(frozen=True)
class Term:
    """A set of events as an expression: combine with & (K5), | (K6) and ~ (K7), then apply .of()."""

    make: object
    words: tuple = ()

    def of(self, events: DataFrame, index: DataFrame, key: str = "event_id") -> DataFrame:
        return self.make(events, index, key)

    def __and__(self, other: Term) -> Term:
        return Term(lambda e, i, k: self.of(e, i, k).join(other.of(e, i, k), k, "left_semi"), self.words + other.words)

    def __or__(self, other: Term) -> Term:
        return Term(lambda e, i, k: self.of(e, i, k).unionByName(other.of(e, i, k)).distinct(), self.words + other.words)

    def __invert__(self) -> Term:
        return Term(lambda e, i, k: e.select(k).join(self.of(e, i, k), k, "left_anti"), ())


def term(word: str) -> Term:
    """K4"""
    return Term(lambda e, i, k: i.filter(F.col("token") == word.lower()).select(k), (word.lower(),))


def all_of(*words: str) -> Term:
    """K5 for many words in one pass over the postings."""
    ws = tuple(dict.fromkeys(w.lower() for w in words))
    return Term(lambda e, i, k: i.filter(F.col("token").isin(*ws)).groupBy(k).agg(F.count_distinct("token").alias("n")).filter(F.col("n") == len(ws)).select(k), ws)


def any_of(*words: str) -> Term:
    """K6"""
    ws = tuple(dict.fromkeys(w.lower() for w in words))
    return Term(lambda e, i, k: i.filter(F.col("token").isin(*ws)).select(k).distinct(), ws)


#: Fields, their types, and the comparisons each allows.
FIELDS = {"category": ("text", (":",)), "priority": ("text", (":",)), "source": ("text", (":",)), "confidence": ("number", (":", "=", ">", "<", ">=", "<=")), "date": ("date", (":", "=", ">", "<", ">=", "<="))}


def field(name: str, op: str, value) -> Term:
    """K8: a typed comparison of a field; text by case-insensitive equality. Unknown fields, operators and values of a wrong type raise."""
    if name not in FIELDS:
        raise ValueError(f"unknown field {name}")
    kind, ops = FIELDS[name]
    if op not in ops:
        raise ValueError(f"{name} can't be compared by {op}")
    if kind == "number":
        value = float(value)
    c = F.col("publication_date") if name == "date" else F.col(name)
    left, right = (F.lower(c), F.lit(str(value).lower())) if kind == "text" else (c.cast("double"), F.lit(value)) if kind == "number" else (F.to_date(c), F.to_date(F.lit(value)))
    test = {":": left == right, "=": left == right, ">": left > right, "<": left < right, ">=": left >= right, "<=": left <= right}[op]
    return Term(lambda e, i, k: e.filter(test).select(k))


def rank(query: Term, events: DataFrame, index: DataFrame, key: str = "event_id") -> DataFrame:
    """(key, matched terms, score, explanation parts, total_hits) of the query's hits: score = min(0.5 + 0.1 per matched term, 1).
    The parts are shares of that one score by fixed weights; none of them reads the graph, dates or confidences. List by score, then key."""
    hits = query.of(events, index, key)
    words = list(dict.fromkeys(query.words)) or [""]
    matched = index.filter(F.col("token").isin(*words)).join(hits, key, "left_semi").groupBy(key).agg(F.count_distinct("token").alias("terms"))
    out = hits.join(matched, key, "left").withColumn("terms", F.coalesce("terms", F.lit(0)))
    score = F.least(0.5 + F.col("terms") * 0.1, F.lit(1.0))
    total = hits.agg(F.count(F.lit(1)).alias("total_hits"))
    return out.select(key, "terms", F.round(score, 3).alias("score"), *[(score * w).alias(n) for n, w in PARTS.items()]).crossJoin(F.broadcast(total))


def latest(events: DataFrame, n: int) -> DataFrame:
    """K11"""
    return events.orderBy(F.col("publication_date").desc(), "event_id").limit(n)


def by_text(events: DataFrame, text: str, *fields: str) -> DataFrame:
    """Events with the text in any of the fields, case aside."""
    found = F.lit(False)
    for f in fields:
        found = found | F.lower(F.coalesce(f, F.lit(""))).contains(text.lower())
    return events.filter(found)


def timeline(events: DataFrame, text: str = "", category: str | None = None, newest_first: bool = True) -> DataFrame:
    """Events by free text over title, content, id and date, and by category, in order of date."""
    df = by_text(events, text, "title", "content", "event_id", "publication_date") if text else events
    df = df.filter(F.col("category") == category) if category else df
    return df.orderBy(F.col("publication_date").desc() if newest_first else "publication_date", "event_id")
