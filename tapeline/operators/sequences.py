"""Multi-bar sequences over an append-only event log: triggers, walk-forward, hash chains, folds that resume, and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import without_leftovers

#: The sequences looked for, scores of the trigger's sentiment.
SEQUENCES = [
    ("AVE_1", ["LVLS", "HVHS", "LVLS", "HVHS"], [], False),
    ("AVE_DAILY", ["LVLS", "HVHS", "LVLS", "HVHS"], ["daily"], True),
    ("AVE_WEEKLY", ["LVLS", "HVHS", "LVLS", "HVHS"], ["weekly"], True),
    ("AVE_MONTHLY", ["LVLS", "HVHS", "LVLS", "HVHS"], ["monthly"], True),
]
SCORES = {"Bullish": 0.8, "Neutral": 0.5, "Bearish": 0.2}

CLOSED = ("FAIL", "COMPLETE", "EXPIRE")


def sequence_config(spark: SparkSession, rows=SEQUENCES) -> DataFrame:
    return spark.createDataFrame(rows, "config_id string, rules array<string>, timeframes array<string>, enabled boolean")


def with_deltas(frames: DataFrame) -> DataFrame:
    """Volume and spread change in percent against the bar before, with floors of 1 and 0.01 below it. The first bar has none."""
    w = Window.partitionBy("symbol", "timeframe").orderBy("period")
    pv, ps = F.greatest(F.lag("volume").over(w), F.lit(1.0)), F.greatest(F.lag("spread").over(w), F.lit(0.01))
    has = F.lag("period").over(w).isNotNull()
    df = frames.withColumn("vol_delta_pct", F.when(has, (F.col("volume") - pv) / pv * 100)).withColumn("spread_delta_pct", F.when(has, (F.col("spread") - ps) / ps * 100))
    return df.withColumn("bar_count", F.count(F.lit(1)).over(Window.partitionBy("symbol", "timeframe")))


def rule_met(rule: Column, vol: Column, spread: Column) -> Column:
    """Strict signs; an unknown rule never matches."""
    return (
        F.when(rule == "HVHS", (vol > 0) & (spread > 0)).when(rule == "LVLS", (vol < 0) & (spread < 0))
        .when(rule == "HVLS", (vol > 0) & (spread < 0)).when(rule == "LVHS", (vol < 0) & (spread > 0)).otherwise(F.lit(False))
    )


def failure_reason(rule: Column, vol: Column, spread: Column) -> Column:
    """The volume is blamed first, then the spread; unknown rules blame nothing."""
    volume = F.when(rule.startswith("HV"), vol <= 0).otherwise(vol >= 0)
    known = rule.isin("HVHS", "LVLS", "HVLS", "LVHS")
    return F.when(~known | rule_met(rule, vol, spread), "None").when(volume, "Volume Mismatch").otherwise("Spread Mismatch")


def sequence_id(symbol="symbol", timeframe="timeframe", period="period", config="config_id") -> Column:
    return F.sha2(F.concat_ws("_", symbol, timeframe, period, config), 256)


def triggers(classified: DataFrame, config: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A sequence for each classified bar and enabled definition of its timeframe; ids that `known` has are no-ops. The definitions are a small table."""
    df = classified.join(F.broadcast(config.filter("enabled")), F.array_contains("timeframes", F.col("timeframe")))
    found = [c for c in AHEAD if c in classified.columns]
    df = df.select(sequence_id().alias("sequence_id"), "symbol", "timeframe", "config_id", "rules", F.col("period").alias("trigger_period"), "label", "sentiment", *found)
    return df.join(known.select("sequence_id"), "sequence_id", "left_anti") if known is not None else df


#: What with_steps adds to a bar.
AHEAD = ("alone", "steps")


def with_steps(frames: DataFrame, longest: int = 4) -> DataFrame:
    """Each bar with its next `longest` bars' changes as the array `steps`, and whether it is its instrument's only bar (`alone`). One window, that of the two-bar classifiers."""
    w = Window.partitionBy("symbol", "timeframe").orderBy("period")
    at = [{c: (F.lead(c, k).over(w) if k else F.col(c)) for c in ("period", "volume", "spread")} for k in range(longest + 1)]

    def change(k: int, c: str, floor: float) -> Column:
        before = F.greatest(at[k - 1][c], F.lit(floor))
        return (at[k][c] - before) / before * 100

    ahead = [
        F.struct(F.lit(k).alias("k"), at[k]["period"].alias("period"), change(k, "volume", 1.0).alias("vol"), change(k, "spread", 0.01).alias("spread"), at[k]["volume"].alias("raw_vol"), at[k]["spread"].alias("raw_spread"))
        for k in range(1, longest + 1)
    ]
    alone = F.lag("period").over(w).isNull() & F.lead("period").over(w).isNull()
    return frames.withColumns({"alone": alone, "steps": F.filter(F.array(*ahead), lambda s: s["period"].isNotNull())})


def walk_forward(frames: DataFrame, started: DataFrame, longest: int = 4) -> DataFrame:
    """The log of every started sequence: INIT, then one event per bar until a rule fails, all are met, or bars run out.

    Started sequences meet the bar that began them by an equi-join; walk takes those that carry it.
    """
    bars = with_steps(frames, longest).select("symbol", "timeframe", F.col("period").alias("trigger_period"), *AHEAD)
    return walk(started.drop(*AHEAD).join(bars, ["symbol", "timeframe", "trigger_period"]))


#: The fields of an event that its walk tells.
EVENT = ("stage_no", "period", "rule_evaluated", "matched", "action", "failure_reason", "metrics")


def walk(started: DataFrame, hashed: bool = False) -> DataFrame:
    """The log of sequences whose triggers come from bars with_steps, so that bars and triggers are one pass and nothing is joined.

    Bar T+k meets rules[k-1]. A sequence whose instrument has fewer than two bars pauses. If `hashed`, the log is as chain makes it, but hashes are
    made while a sequence's events are one row, so that no event is shuffled.
    """
    met = F.transform(F.slice("steps", 1, F.size("rules")), lambda s: rule_met(F.element_at("rules", s["k"]), s["vol"], s["spread"]))
    joined = started.withColumn("met", met)
    stop = F.array_position("met", F.lit(False))
    run = F.slice("steps", 1, F.when(stop > 0, stop).otherwise(F.size("met")).cast("int"))
    last = F.size("rules")
    events = F.transform(run, lambda s: F.struct(
        s["k"].alias("stage_no"), s["period"].alias("period"), F.element_at("rules", s["k"]).alias("rule_evaluated"), F.element_at("met", s["k"]).alias("matched"),
        F.when(~F.element_at("met", s["k"]), "FAIL").when(s["k"] == last, "COMPLETE").otherwise("ADVANCE").alias("action"),
        failure_reason(F.element_at("rules", s["k"]), s["vol"], s["spread"]).alias("failure_reason"),
        F.struct(s["vol"].alias("vol_delta_pct"), s["spread"].alias("spread_delta_pct"), s["raw_vol"].alias("raw_vol"), s["raw_spread"].alias("raw_spread")).alias("metrics"),
    ))
    none = F.lit(0.0)
    first = F.struct(F.lit(0).alias("stage_no"), F.col("trigger_period").alias("period"), F.concat(F.lit("EIGEN_TRIGGER_"), F.col("sentiment")).alias("rule_evaluated"), F.lit(True).alias("matched"), F.lit("INIT").alias("action"), F.lit("None").alias("failure_reason"), F.struct(none.alias("vol_delta_pct"), none.alias("spread_delta_pct"), none.alias("raw_vol"), none.alias("raw_spread")).alias("metrics"))
    pause = F.struct(F.lit(1).alias("stage_no"), F.col("trigger_period").alias("period"), F.element_at("rules", 1).alias("rule_evaluated"), F.lit(False).alias("matched"), F.lit("PAUSE").alias("action"), F.lit("Data Unavailable").alias("failure_reason"), first["metrics"].alias("metrics"))
    log = F.when(F.col("alone"), F.array(first, pause)).otherwise(F.concat(F.array(first), events))
    research = F.sha2(F.concat(F.lit("RESEARCH_"), F.col("sequence_id")), 256)

    def told(e: Column) -> Column:
        """An event with its time, stage and id."""
        timestamp = F.concat(e["period"], F.lit("T00:00:00Z"))
        stage = F.when(e["stage_no"] == 0, "T").otherwise(F.concat(F.lit("T+"), e["stage_no"].cast("string")))
        event_id = F.sha2(F.concat_ws("_", F.col("sequence_id"), timestamp, e["action"], stage), 256)
        return F.struct(*[e[c].alias(c) for c in EVENT], timestamp.alias("timestamp"), stage.alias("stage"), event_id.alias("event_id"))

    key = ["sequence_id", "symbol", "timeframe", "config_id"]
    if not hashed:
        return joined.select(*key, F.explode(log).alias("e")).select(*key, told(F.col("e")).alias("e")).select(*key, "e.*").withColumn("research_id", research)
    rows = joined.select(*key, F.transform(log, told).alias("events")).withColumn("h", _hashes("events", F.lit("")))
    rows = rows.select(*key, "h", F.posexplode("events").alias("at", "e"))
    return rows.select(*key, "e.*", research.alias("research_id"), F.element_at("h", F.col("at") + 1).alias("previous_hash"), F.element_at("h", F.col("at") + 2).alias("hash"))


def _payload(e: Column) -> Column:
    """The typed text that an event's hash covers."""
    return F.concat_ws("|", e["event_id"], e["stage"], e["action"], e["rule_evaluated"], e["matched"].cast("string"), e["failure_reason"], e["timestamp"])


def _hashes(events: str, link: Column) -> Column:
    """The hash that a sequence's events follow, and those of its events in their order."""
    step = lambda acc, e: F.concat(acc, F.array(F.sha2(F.concat_ws("|", F.element_at(acc, -1), _payload(e)), 256)))
    return F.aggregate(events, F.array(link), step)


def _after(rows: DataFrame, states: DataFrame | None) -> DataFrame:
    """rows with _link, the hash that a sequence's first row follows: the last one of its stored state, or nothing."""
    if states is None:
        return rows.withColumn("_link", F.lit(""))
    return rows.join(states.select("sequence_id", F.col("last_hash").alias("_link")), "sequence_id", "left").withColumn("_link", F.coalesce("_link", F.lit("")))


def chain(log: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """previous_hash and hash; each event's hash covers its content and the hash before it, sequence by sequence (a handful of events each).

    With the states of what went before (fold_states), a log's tail goes on from their last hashes.
    """
    cols = [c for c in log.columns if c not in ("hash", "previous_hash")]
    seqs = log.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("stage_no", *[c for c in cols if c not in ("stage_no", "sequence_id")]))).alias("events"))
    rows = _after(seqs, states).select("sequence_id", F.posexplode("events").alias("at", "e"), _hashes("events", F.col("_link")).alias("h"))
    return rows.select("sequence_id", "e.*", F.element_at("h", F.col("at") + 1).alias("previous_hash"), F.element_at("h", F.col("at") + 2).alias("hash")).select(*cols, "previous_hash", "hash")


def verify_chain(chained: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """Adds intact; false for an event whose hash or link doesn't hold. The next event is held against the stored hash, so one bad event spoils itself only.

    With the states of what went before, the first event of a tail must follow its sequence's last hash.
    """
    w = Window.partitionBy("sequence_id").orderBy("stage_no", "hash")
    link = F.coalesce(F.lag("hash").over(w), F.col("_link"))
    fields = F.struct("event_id", "stage", "action", "rule_evaluated", "matched", "failure_reason", "timestamp")
    again = F.sha2(F.concat_ws("|", "previous_hash", _payload(fields)), 256)
    own = chained.withColumn("_own", F.col("hash") == again)  # before rows are shuffled, so that what only the hash covers needn't be
    return _after(own, states).withColumn("intact", (F.col("previous_hash") == link) & F.col("_own")).drop("_link", "_own")


#: What fold_states keeps of a sequence: enough to go on from, and no event.
STATE = ("first_stage", "last_stage", "symbol", "timeframe", "config_id", "trigger_period", "advances", "last_action", "failures", "closed_at", "advance_metrics", "trigger_rule", "events", "bad_stage", "last_hash")


def fold_states(log: DataFrame) -> DataFrame:
    """A row per sequence of sequence_id and STATE, by conditional aggregates, so that parts of a sequence are combined before the shuffle.

    If the log carries `intact`, only a sequence's events up to the first bad one count, and that one only as an event. With `hash`, the last hash is kept.
    States of consecutive parts of a log merge into those of the whole (merge_states).
    """
    stage = F.col("stage_no")
    if "intact" in log.columns:
        bad = F.min(F.when(~F.col("intact"), stage)).over(Window.partitionBy("sequence_id"))
        log = log.withColumn("_bad", bad).filter(F.col("_bad").isNull() | (stage <= F.col("_bad")))
    else:
        log = log.withColumn("_bad", F.lit(None).cast(log.schema["stage_no"].dataType))
    if "hash" not in log.columns:
        log = log.withColumn("hash", F.lit(None).cast("string"))
    live = F.col("_bad").isNull() | (stage < F.col("_bad"))
    on = lambda a: live & (F.col("action") == a)
    return log.groupBy("sequence_id").agg(
        F.min(stage).alias("first_stage"), F.max(stage).alias("last_stage"), F.first("symbol").alias("symbol"), F.first("timeframe").alias("timeframe"), F.first("config_id").alias("config_id"),
        F.min(F.when(on("INIT"), F.col("period"))).alias("trigger_period"), F.count_if(on("ADVANCE")).alias("advances"),
        F.max_by(F.when(live, F.col("action")), F.when(live, stage)).alias("last_action"), F.count_if(on("FAIL")).alias("failures"),
        F.max(F.when(live & F.col("action").isin(*CLOSED), F.col("timestamp"))).alias("closed_at"),
        F.max_by("metrics", F.when(on("ADVANCE"), stage)).alias("advance_metrics"), F.min(F.when(on("INIT"), F.col("rule_evaluated"))).alias("trigger_rule"),
        F.count(F.lit(1)).alias("events"), F.max("_bad").alias("bad_stage"), F.max_by("hash", stage).alias("last_hash"),
    )


def merge_states(*parts: DataFrame) -> DataFrame:
    """The states of consecutive parts of a log as those of the whole: fold_states(a + b) is merge_states(fold_states(a), fold_states(b)), for any cut and any
    number of parts, in any grouping. A sequence has at most as many rows here as events; rows behind its bad event count for nothing."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    listed = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct(*STATE))).alias("parts"))

    def both(a, b):
        add = lambda f: (a[f] + b[f]).alias(f)
        old, new = (lambda f: F.coalesce(a[f], b[f]).alias(f)), (lambda f: F.coalesce(b[f], a[f]).alias(f))
        how = {"advances": add, "failures": add, "events": add, **dict.fromkeys(("last_stage", "last_action", "advance_metrics", "bad_stage", "last_hash"), new)}
        how["closed_at"] = lambda f: F.greatest(a[f], b[f]).alias(f)
        return F.when(a["bad_stage"].isNotNull(), a).otherwise(F.struct(*[how.get(f, old)(f) for f in STATE]))

    merged = F.aggregate(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), F.element_at("parts", 1), both)
    return listed.select("sequence_id", merged.alias("m")).select("sequence_id", *[f"m.{f}" for f in STATE])


def states(folded: DataFrame) -> DataFrame:
    """State, stage, confidence and dates of folded sequences. One with a bad event is Integrity_Failed."""
    score = F.lit(0.5)
    label = F.element_at(F.split("trigger_rule", "_"), -1)
    for name, value in SCORES.items():
        score = F.when(label == name, value).otherwise(score)
    part = lambda c: F.least(F.abs(c), F.lit(10.0)) / 10.0 * 0.40
    conf = F.bround((part(F.col("advance_metrics.vol_delta_pct")) + part(F.col("advance_metrics.spread_delta_pct")) + score * 0.20) * 100, 1)
    state = F.when(F.col("bad_stage").isNotNull(), "Integrity_Failed")
    for action, name in (("INIT", "Triggered"), ("ADVANCE", "Waiting"), ("FAIL", "Failed"), ("COMPLETE", "Completed"), ("PAUSE", "Paused"), ("EXPIRE", "Expired")):
        state = state.when(F.col("last_action") == action, name)
    return folded.select(
        "sequence_id", "symbol", "timeframe", "config_id", "trigger_period", state.alias("state"), F.col("advances").alias("stage_index"), F.when(F.col("advances") > 0, conf).otherwise(0.0).alias("confidence"),
        "failures", F.coalesce("closed_at", F.lit("")).alias("completed_at"), "events",
    )


def fold(log: DataFrame) -> DataFrame:
    """A row per sequence: state, stage, confidence and dates.

    If the log carries `intact`, a sequence with a bad event is INTEGRITY_FAILED and only the events before it count.
    """
    return states(fold_states(log))


def replay(log: DataFrame, day: str) -> DataFrame:
    """The states as they were at the end of `day`."""
    return fold(log.filter(F.col("timestamp") <= f"{day}T23:59:59Z"))


def checkpointed(spark: SparkSession, place: str) -> int | None:
    """The offset up to which the checkpoint at `place` has folded, told by the names of its increments; none if there is no checkpoint."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    done = [f.getPath() for f in files.listStatus(path) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return max((int(p.getName().split("=")[1]) for p in done if p.getName().startswith("upto=")), default=None)


def _increments(spark: SparkSession, place: str) -> DataFrame | None:
    """The states of a checkpoint's increments, of those that were written to their end."""
    upto = checkpointed(spark, place)
    return None if upto is None else spark.read.parquet(place).filter(F.col("upto") <= upto).drop("upto")


def stored_states(spark: SparkSession, place: str) -> DataFrame | None:
    """The merged states of a checkpoint's increments."""
    parts = _increments(spark, place)
    return None if parts is None else merge_states(parts)


def _links(parts: DataFrame | None) -> DataFrame | None:
    """sequence_id and last_hash of states, to verify what follows, without the rest of them. (Behind a bad event nothing counts, whatever it is held against.)"""
    return None if parts is None else parts.groupBy("sequence_id").agg(F.max_by("last_hash", "last_stage").alias("last_hash"))


def tail(log: DataFrame, place: str, offset: str = "offset") -> DataFrame:
    """The events behind a checkpoint; on a stored log the filter reaches the scan."""
    upto = checkpointed(log.sparkSession, place)
    return log if upto is None else log.filter(F.col(offset) > upto)


def resume(log: DataFrame, place: str, offset: str = "offset") -> DataFrame:
    """The folded states of a log, resumed from the checkpoint at `place`: its states merged with the fold of the events behind it. Nothing before is read again.

    `offset` numbers the log's events in the order they were appended. If events carry hashes, the tail must follow the stored last hashes.
    """
    spark = log.sparkSession
    parts, rest = _increments(spark, place), tail(log, place, offset)
    if "hash" in log.columns:
        rest = verify_chain(rest, _links(parts))
    return fold_states(rest) if parts is None else merge_states(parts, fold_states(rest))


def checkpoint(log: DataFrame, place: str, offset: str = "offset") -> int | None:
    """Adds to the checkpoint at `place` the fold of the events behind it, as an increment of its own, and returns the offset it then stands for.

    Only sequences with new events are written. An increment counts once it is whole, and written again after a failure it replaces itself. compact() merges increments.
    """
    spark = log.sparkSession
    upto = tail(log, place, offset).agg(F.max(offset)).first()[0]
    if upto is not None:
        rest, before = tail(log, place, offset).filter(F.col(offset) <= upto), _links(_increments(spark, place))
        with without_leftovers(spark):
            fold_states(verify_chain(rest, before) if "hash" in log.columns else rest).write.mode("overwrite").option("compression", "zstd").parquet(f"{place}/upto={upto}")
    return checkpointed(spark, place)


def compact(spark: SparkSession, place: str, to: str) -> None:
    """The checkpoint at `place` as one increment at `to`."""
    upto = checkpointed(spark, place)
    if upto is not None:
        stored_states(spark, place).write.mode("overwrite").parquet(f"{to}/upto={upto}")


ACTIVE = ("Triggered", "Waiting", "Paused")


def bucket(state: Column) -> Column:
    return F.when(state.isin(*ACTIVE), "active").when(state == "Completed", "completed").when(state.isin("Failed", "Expired"), "failed").otherwise("integrity_failed")


def summary(states: DataFrame) -> DataFrame:
    """Sequences by timeframe and bucket."""
    return states.groupBy("timeframe", bucket(F.col("state")).alias("bucket")).agg(F.count(F.lit(1)).alias("sequences"))


def health(states: DataFrame) -> DataFrame:
    """One row: counts, PASS or WARNING, mean confidence of the active, all events."""
    on = lambda b: F.count_if(bucket(F.col("state")) == b)
    bad = on("integrity_failed")
    mean = F.bround(F.coalesce(F.avg(F.when(F.col("state").isin(*ACTIVE), F.col("confidence"))), F.lit(0.0)), 2)
    return states.agg(on("active").alias("active"), on("completed").alias("completed"), on("failed").alias("failed"), bad.alias("hash_failures"), F.when(bad > 0, "WARNING").otherwise("PASS").alias("status"), mean.alias("mean_confidence"), F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"))


def board(states: DataFrame) -> DataFrame:
    """Each timeframe's columns T+0 .. T+3, Completed and Failed, newest trigger first, then by symbol; at is the place in the column."""
    column = F.when(F.col("state") == "Completed", "Completed").when(F.col("state").isin("Failed", "Expired", "Integrity_Failed"), "Failed").otherwise(F.concat(F.lit("T+"), F.least("stage_index", F.lit(3)).cast("string")))
    w = Window.partitionBy("timeframe", "column").orderBy(F.col("trigger_period").desc(), "symbol", "sequence_id")
    return states.withColumn("column", column).select("timeframe", "column", "symbol", "trigger_period", "sequence_id", F.row_number().over(w).alias("at"))


def drill_down(log: DataFrame, sequence: str | Column) -> DataFrame:
    """One sequence's events in order."""
    return log.filter(F.col("sequence_id") == sequence).orderBy("timestamp", "stage_no")
