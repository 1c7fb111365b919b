import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeline.functions.indicators import with_indicators
from tapeline.operators import backtests, patterns, quality, sequences, timeframes
from tapeline.sources import bars as sources

BAR = "symbol string, date date, open double, high double, low double, close double, volume double"


def bars(spark, rows, symbol="A", start=dt.date(2024, 1, 1)):
    return spark.createDataFrame([(symbol, start + dt.timedelta(days=i), *map(float, r)) for i, r in enumerate(rows)], BAR)


GOOD = [(10, 12, 9, 11, 100)] * 5


@pytest.mark.parametrize(
    "rows, reason",
    [(GOOD, None), ([(10, 8, 9, 11, 100)] + GOOD, "INVALID_OHLC_PRICES"), ([(10, 12, 9, 11, 0)] * 5, "ZERO_TOTAL_VOLUME"), (GOOD[:4], "INSUFFICIENT_DATA"), ([(0, 12, 9, 11, 5)] + GOOD, "INVALID_OHLC_PRICES")],
)
def test_gate_reasons(spark, rows, reason):
    r = quality.gate(bars(spark, rows)).first()
    assert (r["reason"], r["passed"]) == (reason, reason is None)


def test_gate_duplicates_nulls_and_missing_columns(spark):
    twice = bars(spark, GOOD).unionByName(bars(spark, GOOD[:1]))
    assert quality.gate(twice).first()["reason"] == "DUPLICATE_DATES"
    gap = bars(spark, GOOD).unionByName(spark.createDataFrame([("A", dt.date(2024, 1, 1), None, 1.0, 1.0, 1.0, 1.0)], BAR))
    assert quality.gate(gap).first()["passed"]
    assert quality.gate(bars(spark, GOOD).drop("volume")).first()["reason"] == "MISSING_COLUMNS"
    kept, held = quality.split_by_gate(gap, quality.gate(gap))
    assert (kept.count(), held.count()) == (5, 0)
    with pytest.raises(ValueError):
        quality.require_passes(quality.gate(twice))


def test_indicator_math(spark):
    r = with_indicators(bars(spark, [(105, 110, 100, 105, 10), (105, 110, 100, 105, 30), (100, 100, 100, 100, 0)])).orderBy("date").collect()
    assert [x["spread"] for x in r] == [10, 10, 0] and [x["close_position"] for x in r] == [0.5, 0.5, 0.5]
    assert [x["volume_ma"] for x in r] == [10, 20, 40 / 3]
    assert r[1]["vol_pct"] == 200 and r[0]["prev_volume"] == 10 and r[0]["effort"] == "Normal_Activity" and r[1]["effort"] == "Professional_Activity"


def test_patterns_and_pending(spark):
    calm = [(100, 101, 99, 100, 100)] * 20
    crash = [(110, 112, 90, 92, 1000)]
    after = [(92, 99, 91, 98, 100), (98, 101, 97, 100, 100), (100, 101, 99, 100, 100)]
    rows = calm + crash
    got = patterns.with_signals(with_indicators(bars(spark, rows))).orderBy(F.col("date").desc()).first()
    assert (got["signal"], got["validation"], got["fire"]) == ("Selling Climax (Bullish Reversal)", "Pending", True)
    got = patterns.with_signals(with_indicators(bars(spark, rows + after[:2]))).filter("signal like 'Selling%'").first()
    assert got["validation"] == "Pending"  # confirmed by the next bar already
    got = patterns.with_signals(with_indicators(bars(spark, rows + after))).filter("signal like 'Selling%'").first()
    assert got["validation"] == "Confirmed"


def test_anomaly_from_no_volume(spark):
    got = patterns.with_signals(with_indicators(bars(spark, [(10, 11, 9, 10, 0), (10, 13, 9, 12.9, 50)]))).orderBy("date").collect()
    assert [r["anomaly"] for r in got] == ["Neutral", "Silent Accumulation"]


def test_candles_leave_the_open_period_out(spark):
    df = bars(spark, [(i + 1, i + 2, i + 0.5, i + 1, 1) for i in range(21)])
    week = timeframes.candles(df, "weekly", "2024-01-17").orderBy("period").collect()
    assert [(r["period"], r["open"], r["close"], r["volume"]) for r in week] == [("2024-W01", 1, 7, 7), ("2024-W02", 8, 14, 7)]
    assert timeframes.candles(df, "monthly", "2024-01-31").count() == 0
    ends = timeframes.end_labelled(df, "weekly").orderBy("date").collect()
    assert [str(r["date"]) for r in ends] == ["2024-01-07", "2024-01-14", "2024-01-21"]


def test_consensus_weights(spark):
    rows = [("A", "daily", "Bullish"), ("A", "monthly", "Bearish"), ("B", "daily", "Bullish"), ("B", "weekly", "Bullish"), ("B", "monthly", "Bullish"), ("C", "daily", "Bearish"), ("C", "weekly", "Bearish"), ("C", "monthly", "Bearish")]
    got = {r["symbol"]: (r["score"], r["stars"], r["rating"], r["weekly_sentiment"]) for r in timeframes.consensus(spark.createDataFrame(rows, "symbol string, timeframe string, sentiment string")).collect()}
    assert got == {"A": (-15, 2, "Cautious Bearish", "None"), "B": (100, 5, "Strong Buy", "Bullish"), "C": (-100, 1, "Strong Sell", "Bearish")}


FRAME = "symbol string, timeframe string, period string, open double, high double, low double, close double, volume double, spread double, close_position double"


def frames(spark, bars_, tf="weekly"):
    return spark.createDataFrame([("A", tf, f"2026-W{20 + i}", o, h, lo, c, v, h - lo, (c - lo) / (h - lo)) for i, (o, h, lo, c, v) in enumerate([tuple(map(float, b)) for b in bars_])], FRAME)


CFG = [("X", ["HVHS", "LVLS"], ["weekly"], True), ("OFF", ["HVHS"], ["weekly"], False), ("OTHER", ["HVHS"], ["daily"], True)]
TRIGGER = [(10, 12, 9, 11, 100), (11.5, 14, 11, 13.9, 150)]


def run(spark, more, cfg=CFG):
    f = frames(spark, TRIGGER + more)
    started = sequences.triggers(timeframes.eigen(f).filter("period = '2026-W21'"), sequences.sequence_config(spark, cfg))
    return sequences.walk_forward(f, started)


@pytest.mark.parametrize(
    "more, actions, state",
    [
        ([], ["INIT"], "Triggered"),
        ([(13, 18, 12, 14, 200)], ["INIT", "ADVANCE"], "Waiting"),
        ([(13, 18, 12, 14, 200), (13, 14, 12, 13, 90)], ["INIT", "ADVANCE", "COMPLETE"], "Completed"),
        ([(13, 18, 12, 14, 200), (13, 20, 12, 13, 300)], ["INIT", "ADVANCE", "FAIL"], "Failed"),
        ([(13, 14, 13, 14, 50), (13, 18, 12, 14, 200)], ["INIT", "FAIL"], "Failed"),
    ],
)
def test_walk_forward(spark, more, actions, state):
    log = run(spark, more)
    assert [r["action"] for r in log.orderBy("stage_no").collect()] == actions
    s = sequences.fold(log).first()
    assert s["state"] == state and s["stage_index"] == actions.count("ADVANCE")


def test_unknown_rule_never_matches(spark):
    r = run(spark, [(13, 18, 12, 14, 200)], [("X", ["???"], ["weekly"], True)]).filter("stage_no = 1").first()
    assert (r["action"], r["failure_reason"]) == ("FAIL", "None")


def test_triggers_are_idempotent_and_tampering_shows(spark):
    f = frames(spark, TRIGGER + [(13, 18, 12, 14, 200), (13, 14, 12, 13, 90)])
    cfg = sequences.sequence_config(spark, CFG)
    first = sequences.triggers(timeframes.eigen(f), cfg)
    assert sequences.triggers(timeframes.eigen(f), cfg, known=first).count() == 0
    chained = sequences.chain(run(spark, [(13, 18, 12, 14, 200), (13, 14, 12, 13, 90)]))
    assert sequences.verify_chain(chained).filter("not intact").count() == 0
    bad = chained.withColumn("action", F.when(F.col("stage_no") == 1, "FAIL").otherwise(F.col("action")))
    checked = sequences.verify_chain(bad)
    assert [r["stage_no"] for r in checked.filter("not intact").collect()] == [1]
    s = sequences.fold(checked).first()
    assert (s["state"], s["stage_index"]) == ("Integrity_Failed", 0)
    assert sequences.health(sequences.fold(checked)).first()["status"] == "WARNING"


def test_replay_keeps_what_was_known(spark):
    log = run(spark, [(13, 18, 12, 14, 200), (13, 14, 12, 13, 90)]).withColumn("timestamp", F.concat(F.lit("2026-06-0"), (F.col("stage_no") + 1).cast("string"), F.lit("T00:00:00Z")))
    assert sequences.replay(log, "2026-06-02").first()["state"] == "Waiting"
    assert sequences.replay(log, "2026-06-30").first()["state"] == "Completed"


def test_gauntlet_equals_walk_forward(spark):
    """The backtest's completions are the sequence engine's: the floors play no part in these bars."""
    from places import DATA

    from tapeline.plans.bar_queries import bars as made

    df = made(spark, DATA)
    daily = timeframes.candles(df, "daily", "2030-01-01")
    started = sequences.triggers(timeframes.eigen(daily), sequences.sequence_config(spark))
    done = {(r["symbol"], r["trigger_period"]) for r in sequences.fold(sequences.walk_forward(daily, started)).filter("state = 'Completed'").collect()}
    trades = backtests.eigen_trades(df.withColumn("timeframe", F.lit("daily")))
    assert done == {(r["symbol"], str(r["date"])) for r in trades.filter("gauntlet_passed").collect()} and done
    m = backtests.eigen_metrics(trades).filter("timeframe is null").first()
    assert m["wins"] <= m["completed"] <= m["triggers"]


def test_sources(spark, tmp_path):
    (tmp_path / "AAA.csv").write_text('﻿" Date ",Series,Open_Price,HIGH,Low,close price,Total  Traded Quantity\n01-02-2024,EQ,"1,000.5",1100,990,1050,"12,345"\n02-02-2024,BE,1,1,1,1,1\nbad,EQ,1,1,1,1,1\n')
    (tmp_path / "BBB.csv").write_text("date,open,high,low,close,volume\n2024-02-03,1,2,0.5,x,5\n2024-02-04,1,2,0.5,1.5,5\n")
    got = sorted(map(tuple, sources.read_bars(spark, [str(tmp_path / "AAA.csv"), str(tmp_path / "BBB.csv")]).collect()))
    assert got == [("AAA", dt.date(2024, 2, 1), 1000.5, 1100, 990, 1050, 12345), ("BBB", dt.date(2024, 2, 4), 1, 2, 0.5, 1.5, 5)]
    chart = '{"chart":{"result":[{"timestamp":[1704067200,1704153600,1704240000],"indicators":{"quote":[{"open":[1,null,2],"high":[2,null],"low":[1,null,1],"close":[1.5,null,2],"volume":[10,null,5]}]}}]}}'
    rows = sources.chart_bars(spark.createDataFrame([("A", chart)], "symbol string, payload string")).orderBy("date").collect()
    assert [(str(r["date"]), r["high"], r["volume"]) for r in rows] == [("2024-01-01", 2, 10), ("2024-01-03", 0, 5)]
    with pytest.raises(Exception, match="empty index payload"):
        sources.index_bars(spark.createDataFrame([("A", '{"data":[]}')], "symbol string, payload string")).collect()
    w = sources.parse_watchlist(spark.createDataFrame([(1, "abc, Def\nABC,b@d,,M&M")], "list_id int, raw string")).orderBy("at").collect()
    assert [(r["symbol"], r["valid"]) for r in w] == [("ABC", True), ("DEF", True), ("B@D", False), ("M&M", True)]
