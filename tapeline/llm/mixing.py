"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, shuffle_partitions, table

#: Documents in a range of the order that is stored to find the cuts, about.
RANGE_ROWS = 32_768

#: Passes that fill what the sample's last document left over, at any size: what is left then is less than a document or two.
FILLS = 4


def source_targets(sizes: DataFrame, weights=(5.0, 2.0, 1.0), max_repeat: int = 3) -> DataFrame:
    """One row per source: its size, documents and target words.

    Sources in code point order, null last, weigh `weights`, repeating. Together the targets are all words;
    a target stops at `max_repeat` times its source, and the rest is shared by weight (the level at which the
    sources that are not capped stand is found in closed form, by sorting sources by cap over weight).
    The table has a row per source, so its windows are small.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("sid", F.row_number().over(order) - 1)
    per = per.withColumn("weight", F.element_at(cycle, F.col("sid") % len(weights) + 1)).withColumn("cap", F.col("source_size") * max_repeat)
    by = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    whole = Window.partitionBy(F.lit(0))
    per = (
        per.withColumn("all_words", F.sum("source_size").over(whole))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all_words") - F.col("capped")) / F.col("open_weight"))
        .withColumn("at", F.row_number().over(by))
    )
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("at"))
    per = per.withColumn("first_fit", F.min(fits).over(whole)).withColumn("level", F.max(F.when(F.col("at") == F.col("first_fit"), F.col("level"))).over(whole))
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return per.withColumn("copies", copies).withColumn("need", F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * F.col("source_size"))).select("source", "sid", "weight", "source_size", "source_docs", "target", "copies", "need")


def inclusion_rates(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with `rate`: a document's inclusion probability is least(1, rate * size), and the expected words are the need.

    Documents that rate * size would give more than 1 are certain; the rate of the others follows from the words that
    those leave. Documents are counted by source and size first, so a window has a row per distinct size of a source.
    """
    per = sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs"))
    per = per.join(goals.filter("need > 0").select(F.col("source").alias("goal"), "sid", "need"), F.col("source").eqNullSafe(F.col("goal")))
    by = Window.partitionBy("sid")
    larger = by.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    upto = by.orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    words, squares = (F.col("docs") * F.col("size")).cast("double"), F.col("docs").cast("double") * F.col("size") * F.col("size")
    per = per.withColumn("rate", (F.col("need") - F.coalesce(F.sum(words).over(larger), F.lit(0.0))) / F.sum(squares).over(upto))
    rates = per.filter(F.col("rate") * F.col("size") <= 1).groupBy("sid").agg(F.max_by("rate", "size").alias("rate"))
    return goals.join(rates, "sid", "left")


def mix_sources(docs: DataFrame, weights=(5.0, 2.0, 1.0), max_repeat: int = 3, with_text: bool = False, seed: str = "") -> DataFrame:
    """How often each document is taken, so that each source's words come near its target.

    Every document first gets the whole copies that are certain, floor(target / source size). What its source
    still needs is sampled by Pareto order sampling: document i has the inclusion probability p proportional to its
    size, capped at 1 (see inclusion_rates), and random odds u / (1 - u) with u a hash of doc_id and seed; documents are
    taken in the order of random odds over inclusion odds p / (1 - p), certain ones first, until the words needed are
    reached. Documents that fit what is left are then taken in the same order, and one more if that comes nearer.

    All documents of a source can fill, whatever its size. No window holds a source: ids and sizes are stored in ranges
    of the order, of about equal rows whatever the ratios; in each pass the ranges' sums tell the one with the cut, and
    only its rows are added up one by one.

    Columns: those of docs (text only if asked for), then size, source_size, target, copies (whole documents taken), taken (words).
    Null or empty texts have size 0 and take nothing; a null source is a source of its own, last; a null doc_id is
    hashed as an empty string; equal rows are sampled as separate documents in arbitrary order among themselves;
    an empty table gives an empty result. Extra columns are kept; columns named like the results are replaced.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    keep = [c for c in docs.columns if c not in made and (with_text or c != "text")]
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    x = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long")
    rows = docs.select(F.struct(*keep).alias("row"), "doc_id", "source", size.alias("size"), ((x + F.lit(0.5)) / F.lit(float(2**52))).alias("u"))
    rows = materialise(rows.withColumn("n", F.monotonically_increasing_id()))  # once stored, n tells equal rows apart
    goals = materialise(inclusion_rates(rows, source_targets(rows, weights, max_repeat)))

    p = F.least(F.lit(1.0), F.col("rate") * F.col("size"))
    joined = rows.alias("r").join(goals.withColumnRenamed("source", "goal").alias("g"), F.col("source").eqNullSafe(F.col("goal")), "left").drop("goal")
    joined = joined.withColumn("q", F.when((F.col("size") > 0) & (F.col("need") > 0), F.col("u") / (1 - F.col("u")) * (1 - p) / p))

    cuts = _cuts(joined.filter("q is not null").select("sid", "q", "doc_id", "size", "n"), goals.select("sid", "need"))
    joined = joined.join(cuts.withColumnRenamed("sid", "cut_sid"), F.col("sid") == F.col("cut_sid"), "left").drop("cut_sid")
    place = F.struct("q", "doc_id", "size", "n")
    taken = F.exists("passes", lambda p: (F.col("size") <= p["left"]) & (place <= p["last"])) | (F.col("n") == F.col("one_more"))
    extra = F.coalesce(F.when(F.col("q").isNotNull() & taken, F.lit(1)), F.lit(0))
    copies = F.when(F.col("size") > 0, F.col("copies") + extra).otherwise(F.lit(0)).cast("long")
    return joined.select("row.*", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def _cuts(keys: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source (sid): passes, the (left, last) of each pass, and one_more, the n of the document that comes nearer.

    A pass takes documents of up to `left` words, in order, to the place `last`. Places only grow and `left` only shrinks:
    what a pass goes by is taken or too large for all later ones.
    """
    ranges = max(shuffle_partitions(keys.sparkSession), -(-keys.count() // RANGE_ROWS))
    order = ["sid", "q", "doc_id", "size", "n"]
    keys = keys.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    keys = materialise(keys.withColumn("pos", F.monotonically_increasing_id()))  # grows along the order; its upper bits are the range
    part = F.shiftright("pos", 33)
    goals = goals.filter("need > 0")
    state = goals.withColumn("left", F.col("need")).withColumn("last", F.lit(-1).cast("long")).withColumn("passes", F.expr("cast(array() as array<struct<left:double,pos:bigint>>)"))
    by = Window.partitionBy("sid").orderBy("part")
    for k in range(1 + FILLS):
        fits = (F.col("pos") > F.col("last")) & (F.lit(k == 0) | (F.col("size") <= F.col("left")))
        able = keys.join(state.select("sid", "left", "last"), "sid").filter(fits).withColumn("part", part)
        sums = able.groupBy("sid", "part").agg(F.sum("size").alias("words"), F.max("pos").alias("top"), F.first("left").alias("left"))
        sums = sums.withColumn("before", F.sum("words").over(by) - F.col("words")).withColumn("before_top", F.max("top").over(by.rowsBetween(Window.unboundedPreceding, -1)))
        sums = materialise(sums)
        if not sums.head(1):  # no document fits, nor will one in later passes
            break
        cut = sums.filter(F.col("before") + F.col("words") > F.col("left")).groupBy("sid").agg(F.min("part").alias("part"), F.min_by("before", "part").alias("before"), F.min_by("before_top", "part").alias("before_top"))
        run = F.col("before") + F.sum("size").over(Window.partitionBy("sid", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
        inside = able.join(cut.drop("before_top"), ["sid", "part"]).withColumn("run", run).filter("run <= left").groupBy("sid").agg(F.max("run").alias("got"), F.max("pos").alias("to"))
        at_cut = cut.join(inside, "sid", "left").select("sid", F.coalesce("got", "before").alias("got"), F.coalesce("to", "before_top").alias("to"))
        all_fit = sums.join(cut, "sid", "left_anti").groupBy("sid").agg(F.sum("words").alias("got"), F.max("top").alias("to"))
        step = F.struct((F.lit(float("inf")) if k == 0 else F.col("left")).alias("left"), F.coalesce("to", "last").alias("pos"))
        state = state.join(at_cut.unionByName(all_fit), "sid", "left").withColumn("passes", F.concat("passes", F.array(step)))
        state = materialise(state.select("sid", (F.col("left") - F.coalesce("got", F.lit(0))).alias("left"), F.coalesce("to", "last").alias("last"), "passes"))

    free = keys.join(state.select("sid", "left", "passes"), "sid").filter((F.col("size") < 2 * F.col("left")) & ~F.exists("passes", lambda p: (F.col("size") <= p["left"]) & (F.col("pos") <= p["pos"])))
    more = free.groupBy("sid").agg(F.min_by("n", F.struct("size", "pos")).alias("one_more"))
    steps = state.select("sid", F.explode("passes").alias("p")).select("sid", "p.left", "p.pos").filter("pos >= 0")
    steps = steps.join(keys.select("pos", F.struct("q", "doc_id", "size", "n").alias("last")), "pos")
    found = steps.groupBy("sid").agg(F.collect_list(F.struct("left", "last")).alias("passes"))
    return materialise(state.select("sid").join(found, "sid", "left").join(more, "sid", "left"))


def op1_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def _fill_sql() -> str:
    steps = []
    for k in range(1 + FILLS):
        fits = "extra = 0" + ("" if k == 0 else " and size <= rest")
        steps.append(
            f"s{k}a as (select *, sum(case when {fits} then size else 0 end) over (partition by sid order by q, doc_id, size rows unbounded preceding) as run from s{k}),\n"
            f"s{k}b as (select *, case when {fits} and run <= rest then size else 0 end as got from s{k}a),\n"
            f"s{k + 1} as (select * exclude (run, got, extra, rest), case when got > 0 then 1 else extra end as extra, rest - sum(got) over (partition by sid) as rest from s{k}b)"
        )
    return ",\n".join(steps)


ORACLE = f"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
    (('0x' || substr(md5(doc_id::varchar), 1, 13))::bigint + 0.5::double) / 4503599627370496::double as u from documents),
s as (select source, sum(size)::bigint as source_size, count(*) as source_docs, row_number() over (order by source nulls last) - 1 as sid from d group by source),
w as (select *, [5.0::double, 2.0::double, 1.0::double][(sid % 3 + 1)::int] as weight, source_size * 3 as cap from s),
o as (select *, sum(source_size) over () as total, coalesce(sum(cap) over (order by cap / weight, sid rows between unbounded preceding and 1 preceding), 0) as capped,
    sum(weight) over (order by cap / weight, sid rows between current row and unbounded following) as open_weight, row_number() over (order by cap / weight, sid) as pos from w),
l as (select *, (total - capped)::double / open_weight as level from o),
m as (select arg_min(level, pos) as level from l where level <= cap / weight),
g as (select source, sid, source_size, source_docs, least(cap::double, m.level * weight) as target from l, m),
h as (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as copies from g),
n as (select *, greatest(0, target - copies * source_size)::double as need from h),
j as (select d.*, n.* exclude (source) from d join n on d.source is not distinct from n.source),
k as (select sid, size, any_value(need) as need, count(*)::double as docs from j where size > 0 and need > 0 group by sid, size),
i as (select sid, size, (need - coalesce(sum(docs * size) over (partition by sid order by size desc rows between unbounded preceding and 1 preceding), 0.0::double))
    / sum(docs * size * size) over (partition by sid order by size rows unbounded preceding) as rate from k),
p as (select sid, arg_max(rate, size) as rate from i where rate * size <= 1 group by sid),
r as (select j.*, case when size > 0 and need > 0 then u / (1 - u) * (1 - least(1.0::double, rate * size)) / least(1.0::double, rate * size) end as q from j left join p on j.sid = p.sid),
s0 as (select *, 0 as extra, need as rest from r where q is not null),
{_fill_sql()},
z as (select *, extra = 0 and size < 2 * rest as near from s{1 + FILLS}),
y as (select *, row_number() over (partition by sid order by case when near then 0 else 1 end, size, q, doc_id) as best from z),
f as (select doc_id, source, size, source_size, target, copies, case when near and best = 1 then 1 else extra end as extra from y
    union all select doc_id, source, size, source_size, target, copies, 0 as extra from r where q is null)
select doc_id, size, source_size, target, (size * (copies + extra))::bigint as taken, source, case when size > 0 then copies + extra else 0 end::bigint as copies from f
"""
