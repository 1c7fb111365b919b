"""Queries over bars made from `lineitem`, each with its SQL twin. Doubles are compared at six decimals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.indicators import with_indicators
from ..operators import backtests, patterns, quality, sequences, timeframes
from ..sources.bars import bars_from_trades
from ..sources.shared import materialise, shared_dir, tasks_for
from .compare import rounded, same_rounding

#: A day after the last trade: every period is closed.
AS_OF = "2002-01-01"




def bars(spark, d):
    trades = spark.read.parquet(f"{d}/lineitem.parquet")
    return bars_from_trades(trades, tasks=tasks_for(trades))


def labelled(spark, d):
    return patterns.with_signals(with_indicators(bars(spark, d)))


def frames(spark, d):
    return timeframes.all_candles(bars(spark, d), AS_OF)


def end_frames(spark, d):
    b = bars(spark, d)
    out = None
    for t in ("daily", "weekly", "monthly"):
        c = timeframes.end_labelled(b, t).withColumn("timeframe", F.lit(t))
        out = c if out is None else out.unionByName(c)
    return out


def log(spark, d, hashed=False):
    """Triggers and steps come from the same pass over the candles, so nothing is stored or joined."""
    f = sequences.with_steps(frames(spark, d))
    return sequences.walk(sequences.triggers(timeframes.eigen(f), sequences.sequence_config(spark)), hashed)


IND_COLS = ["spread", "close_position", "volume_ma", "spread_ma", "close_ma", "support", "resistance", "price_trend", "is_up", "is_down", "is_doji", "prev_volume", "prev_spread", "vol_pct", "spr_pct", "effort"]

BARS = """
t as (select 'S' || l_suppkey as symbol, l_shipdate::date as date, l_extendedprice / nullif(l_quantity, 0) as p, l_extendedprice / nullif(l_quantity, 0) * (1 + l_tax) as up,
    l_extendedprice / nullif(l_quantity, 0) * (1 - l_discount) as down, l_quantity as q, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) as tick from lineitem),
bars as (select symbol, date, arg_min(p, tick) as open, max(up) as high, min(down) as low, arg_max(p, tick) as close, sum(q) as volume from t group by symbol, date)"""

IND = BARS + """,
i0 as (select *, high - low as spread, case when high - low = 0 then 0.5 else (close - low) / (high - low) end as close_position from bars),
i1 as (select *, avg(volume) over m as volume_ma, avg(spread) over m as spread_ma, avg(close) over m as close_ma, min(low) over m as support, max(high) over m as resistance,
    lag(volume) over w as lag_volume, lag(spread) over w as lag_spread, lag(close) over w as prev_close from i0
    window w as (partition by symbol order by date), m as (partition by symbol order by date rows between 19 preceding and current row)),
i2 as (select *, case when close > close_ma * 1.02 then 2 when close < close_ma * 0.98 then -2 when close > close_ma then 1 when close < close_ma then -1 else 0 end as price_trend,
    close > open as is_up, close < open as is_down, abs(close - open) <= 0.1 * spread as is_doji, coalesce(lag_volume, volume) as prev_volume, coalesce(lag_spread, spread) as prev_spread,
    volume / greatest(lag_volume, 1) as vr, (close - prev_close) / greatest(prev_close, 0.001) as pc, spread / greatest(lag_spread, 0.001) as sr from i1),
ind as (select * exclude (vr, pc, sr), 100 * ((volume - prev_volume) / nullif(prev_volume, 0)) as vol_pct, 100 * ((spread - prev_spread) / nullif(prev_spread, 0)) as spr_pct,
    case when prev_close is null then 'Normal_Activity'
        when vr > 1.5 then case when abs(pc) < 0.005 then case when close_position > 0.6 then 'Absorption_Bullish' when close_position < 0.4 then 'Absorption_Bearish' else 'Professional_Activity' end
            when pc < -0.01 then 'Panic_Selling' when pc > 0.01 and sr < 0.8 then 'Hidden_Buying' when pc > 0.01 then 'Genuine_Buying' else 'Normal_Activity' end
        when vr < 0.7 then case when pc > 0.01 then 'No_Supply' when pc < -0.01 then 'No_Demand' else 'Quiet_Market' end
        else 'Normal_Activity' end as effort from i2)"""


def _case(kind: int) -> str:
    q = lambda v: "null" if v is None else str(v) if isinstance(v, float) else "'" + v + "'"
    p = [patterns.SELLING_CLIMAX, patterns.BUYING_CLIMAX, patterns.UPTHRUST, patterns.NO_DEMAND, patterns.STOPPING, patterns.TEST, patterns.NOTHING]
    return "case pat " + " ".join(f"when {k} then {q(x[kind])}" for k, x in enumerate(p)) + " end"


def _step(k: int) -> str:
    n = lambda c: f"lead({c}, {k}) over w"
    return f"""coalesce(case signal when '{patterns.UPTHRUST[0]}' then {n('is_down')} and {n('volume')} >= volume * 0.8
        when '{patterns.NO_DEMAND[0]}' then {str(k <= 2).lower()} and ({n('is_down')} or ({n('is_up')} and {n('volume')} < {n('volume_ma')} * 0.8))
        when '{patterns.STOPPING[0]}' then {str(k >= 2).lower()} and {n('close')} > close and {n('low')} >= low * 0.99
        when '{patterns.SELLING_CLIMAX[0]}' then {n('is_up')} and {n('close')} > close
        when '{patterns.BUYING_CLIMAX[0]}' then {n('is_down')} and {n('close')} < close
        when '{patterns.TEST[0]}' then {n('close')} > close * 1.02 else false end, false)"""


SIG = IND + f""",
p0 as (select *, case when volume > volume_ma * 2.5 and spread > spread_ma * 2.0 and close_position <= 0.3 and price_trend <= 0 then 0
        when volume > volume_ma * 2.5 and spread > spread_ma * 2.0 and close_position >= 0.7 and price_trend >= 0 then 1
        when volume > volume_ma * 1.5 and spread > spread_ma * 1.2 and close_position <= 0.3 and price_trend >= 0 and coalesce(lag(is_up) over (partition by symbol order by date), false) then 2
        when volume < volume_ma * 0.7 and is_up and price_trend >= 0 then 3
        when volume > volume_ma * 1.5 and spread < spread_ma * 0.8 and close_position between 0.3 and 0.7 then 4
        when volume < volume_ma * 0.7 and is_down and low <= support * 1.05 then 5 else 6 end as pat,
    case when prev_close is null then 'Neutral'
        when vol_pct < -20 and close < open and close < prev_close then 'Continuation Dump' when vol_pct < -20 and close > open and close_position < 0.4 then 'Failed Rally'
        when vol_pct > 20 and close > open and close > prev_close and close_position > 0.7 then 'Silent Accumulation' when vol_pct > 20 and close < open and close_position > 0.6 then 'Bear Trap'
        when vol_pct < -5 then 'Neutral Contraction' else 'Neutral' end as anomaly from ind),
p1 as (select * exclude (pat), {_case(0)} as signal, {_case(1)} as sentiment, {_case(2)} as meaning, {_case(3)} as confidence, {_case(4)} as description from p0),
sig as (select *, case when signal = 'No Signal' then 'N/A' when lead(date, 3) over w is null then 'Pending' when {_step(1)} or {_step(2)} or {_step(3)} then 'Confirmed' else 'Failed' end as validation,
    volume > volume_ma * 2.0 and not contains(signal, 'No') as fire from p1 window w as (partition by symbol order by date)),
newest as (select *, row_number() over (partition by symbol order by date desc) as rn from sig),
route as (select symbol, bool_or(validation = 'Confirmed') as trending, bool_or(effort in ('No_Demand', 'No_Supply')) as effort, bool_or(rn = 1 and signal <> 'No Signal' and effort in ('No_Demand', 'No_Supply')) as ticker,
    max(volume) filter (where rn = 1) as v, max(volume) filter (where rn = 2) as v1, max(volume) filter (where rn = 3) as v2, max(volume) filter (where rn = 4) as v3,
    max(spread) filter (where rn = 1) as s, max(spread) filter (where rn = 2) as s1, max(vol_pct) filter (where rn = 1) as vol_pct, max(signal) filter (where rn = 1) as signal, max(confidence) filter (where rn = 1) as confidence
    from newest where rn <= 5 group by symbol),
flags as (select symbol, trending, effort, ticker, v < coalesce(v1, v) and s > coalesce(s1, s) as trigger, v < coalesce(v1, v) and coalesce(v1, v) > coalesce(v2, v1, v) and coalesce(v2, v1, v) > coalesce(v3, v2, v1, v) as anomaly, vol_pct, signal, confidence from route)"""

MOOD = "case when regexp_matches(anomaly, 'Accumulation|Absorption|Trap') then 'Bullish' when regexp_matches(anomaly, 'Dump|Failed') then 'Bearish' else 'Neutral' end"

CANDLE = "arg_min(open, date) as open, max(high) as high, min(low) as low, arg_max(close, date) as close, sum(volume) as volume"


def _eigen(src: str, labels: dict) -> str:
    at = lambda k: "case " + " ".join(f"when gap_direction = '{g}' and close_band = '{b}' then '{v[k]}'" for (g, b), v in labels.items()) + " end"
    return f"""(select *, {at(0)} as label, {at(1)} as sentiment, (volume - prev_vol) / prev_vol * 100 as volume_surge_pct from
    (select *, case when open > prev_close and close_position >= prev_cp then 'Gap-Up' when open < prev_close and close_position <= prev_cp then 'Gap-Down' end as gap_direction, case when close_position >= 0.7 then 'Strong' else 'Weak' end as close_band from
    (select *, lag(volume) over w as prev_vol, lag(close) over w as prev_close, lag(close_position) over w as prev_cp, lag(period) over w as prev_period, lead(period) over w as next_period from {src} window w as (partition by symbol, timeframe order by period))
    where prev_vol > 0 and volume > prev_vol and (close_position <= 0.3 or close_position >= 0.7)) where gap_direction is not null)"""


FRAMES = BARS + f""",
c0 as (select symbol, strftime(date, '%Y-%m-%d') as period, open, high, low, close, volume, 'daily' as timeframe from bars
    union all select symbol, strftime(date, '%G-W%V') as period, {CANDLE}, 'weekly' from bars group by symbol, strftime(date, '%G-W%V') having strftime(date, '%G-W%V') < strftime(date '{AS_OF}', '%G-W%V')
    union all select symbol, strftime(date, '%Y-%m') as period, {CANDLE}, 'monthly' from bars group by symbol, strftime(date, '%Y-%m') having strftime(date, '%Y-%m') < strftime(date '{AS_OF}', '%Y-%m')),
frames as (select *, high - low as spread, case when high - low <= 0 then 0.5 else (close - low) / (high - low) end as close_position from c0),
eig as {_eigen("frames", timeframes.LIVE_LABELS)},
age as (select *, case when scenario like 'Vol_Surge%' then 'Absorption' else 'Effort Without Result' end as label, case when scenario like 'Vol_Surge%' then 'Bullish' else 'Bearish' end as sentiment,
    (volume - prev_vol) / prev_vol * 100 as volume_pct, (spread - prev_spread) / prev_spread * 100 as spread_pct from
    (select *, case when volume > prev_vol and spread < prev_spread then 'Vol_Surge_Spread_Contraction' when volume < prev_vol and spread > prev_spread then 'Vol_Drop_Spread_Expansion' end as scenario from
    (select *, lag(volume) over w as prev_vol, lag(spread) over w as prev_spread, lead(period) over w as next_period from frames window w as (partition by symbol, timeframe order by period)) where prev_vol > 0 and prev_spread > 0) where scenario is not null),
pv as (select symbol, max(sentiment) filter (where timeframe = 'monthly') as m, max(sentiment) filter (where timeframe = 'weekly') as w, max(sentiment) filter (where timeframe = 'daily') as d from eig where next_period is null group by symbol),
sc as (select symbol, coalesce(m, 'None') as monthly_sentiment, coalesce(w, 'None') as weekly_sentiment, coalesce(d, 'None') as daily_sentiment,
    case m when 'Bullish' then 40.0 when 'Bearish' then -40.0 else 0.0 end::double as monthly_score, case w when 'Bullish' then 35.0 when 'Bearish' then -35.0 else 0.0 end::double as weekly_score, case d when 'Bullish' then 25.0 when 'Bearish' then -25.0 else 0.0 end::double as daily_score from pv),
cons as (select *, case when score = 100 then 5 when score > 10 then 4 when score >= -10 then 3 when score > -100 then 2 else 1 end as stars,
    case when score = 100 then 'Strong Buy' when score > 10 then 'Cautious Bullish' when score >= -10 then 'Mixed Trend' when score > -100 then 'Cautious Bearish' else 'Strong Sell' end as rating
    from (select *, (monthly_score + weekly_score + daily_score) / 100.0 * 100 as score from sc))"""


def _rule(k: int) -> str:
    r, v, s = f"rules[{k}]", f"v{k}", f"s{k}"
    return f"(case {r} when 'HVHS' then {v} > 0 and {s} > 0 when 'LVLS' then {v} < 0 and {s} < 0 when 'HVLS' then {v} > 0 and {s} < 0 when 'LVHS' then {v} < 0 and {s} > 0 else false end)"


_STEPS = " union all ".join(
    f"""select sequence_id, symbol, timeframe, config_id, {k} as stage_no, p{k} as period, rules[{k}] as rule_evaluated, {_rule(k)} as matched,
    case when not {_rule(k)} then 'FAIL' when {k} = 4 then 'COMPLETE' else 'ADVANCE' end as action,
    case when {_rule(k)} then 'None' when case when starts_with(rules[{k}], 'HV') then v{k} <= 0 else v{k} >= 0 end then 'Volume Mismatch' else 'Spread Mismatch' end as failure_reason, v{k} as vol_delta_pct, s{k} as spread_delta_pct
    from st where p{k} is not null {''.join(f' and {_rule(j)}' for j in range(1, k))}"""
    for k in range(1, 5)
)

LOG = FRAMES + f""",
de as (select symbol, timeframe, period, case when pp is not null then (volume - greatest(pvol, 1)) / greatest(pvol, 1) * 100 end as dv, case when pp is not null then (spread - greatest(ps, 0.01)) / greatest(ps, 0.01) * 100 end as ds from
    (select *, lag(period) over w as pp, lag(volume) over w as pvol, lag(spread) over w as ps from frames window w as (partition by symbol, timeframe order by period))),
ld as (select *, {', '.join(f'lead(period, {k}) over w as p{k}, lead(dv, {k}) over w as v{k}, lead(ds, {k}) over w as s{k}' for k in range(1, 5))} from de window w as (partition by symbol, timeframe order by period)),
cfg(timeframe, config_id) as (values ('daily', 'AVE_DAILY'), ('weekly', 'AVE_WEEKLY'), ('monthly', 'AVE_MONTHLY')),
st as (select sha256(concat_ws('_', e.symbol, e.timeframe, e.period, config_id)) as sequence_id, e.symbol, e.timeframe, config_id, e.sentiment, e.label, e.period as trigger_period, ['LVLS', 'HVHS', 'LVLS', 'HVHS'] as rules, ld.* exclude (symbol, timeframe, period, dv, ds)
    from eig e join cfg using (timeframe) join ld on ld.symbol = e.symbol and ld.timeframe = e.timeframe and ld.period = e.period),
l0 as (select sequence_id, symbol, timeframe, config_id, 0 as stage_no, trigger_period as period, 'EIGEN_TRIGGER_' || sentiment as rule_evaluated, true as matched, 'INIT' as action, 'None' as failure_reason, 0.0::double as vol_delta_pct, 0.0::double as spread_delta_pct from st union all {_STEPS}),
l1 as (select *, period || 'T00:00:00Z' as timestamp, case when stage_no = 0 then 'T' else 'T+' || stage_no end as stage from l0),
log as (select *, sha256(concat_ws('_', sequence_id, timestamp, action, stage)) as event_id from l1),
states as (select sequence_id, any_value(symbol) as symbol, any_value(timeframe) as timeframe, any_value(config_id) as config_id, min(period) filter (where action = 'INIT') as trigger_period,
    case arg_max(action, stage_no) when 'INIT' then 'Triggered' when 'ADVANCE' then 'Waiting' when 'FAIL' then 'Failed' when 'COMPLETE' then 'Completed' end as state, count(*) filter (where action = 'ADVANCE') as stage_index,
    case when count(*) filter (where action = 'ADVANCE') > 0 then (least(abs(arg_max(vol_delta_pct, stage_no) filter (where action = 'ADVANCE')), 10.0) / 10.0 * 0.40 + least(abs(arg_max(spread_delta_pct, stage_no) filter (where action = 'ADVANCE')), 10.0) / 10.0 * 0.40
        + case split_part(min(rule_evaluated) filter (where action = 'INIT'), '_', 3) when 'Bullish' then 0.8 when 'Bearish' then 0.2 else 0.5 end * 0.20) * 100 else 0.0 end as raw_confidence,
    count(*) filter (where action = 'FAIL') as failures, coalesce(max(timestamp) filter (where action in ('FAIL', 'COMPLETE')), '') as completed_at, count(*) as events from log group by sequence_id)"""

BUCKET = "case when state in ('Triggered', 'Waiting', 'Paused') then 'active' when state = 'Completed' then 'completed' when state in ('Failed', 'Expired') then 'failed' else 'integrity_failed' end"

_UNIT = "least(greatest({0}, 0.0), 1.0)"


def _side(p: str) -> str:
    return f"case when {p}spread = 0 then 0.5 when gap_direction = 'Gap-Up' then ({p}close - {p}low) / {p}spread else ({p}high - {p}close) / {p}spread end"


_BL = lambda k: "case " + " ".join(f"when gap_direction = '{g}' and close_band = '{b}' then '{v[k]}'" for (g, b), v in timeframes.BACKTEST_LABELS.items()) + " end"
_PASS = " and ".join(f"lead({c}, {k}) over w {op} " + (f"lead({c}, {k - 1}) over w" if k > 1 else c) for k, op in ((1, "<"), (2, ">"), (3, "<"), (4, ">")) for c in ("volume", "spread"))

TRADES = BARS + f""",
ef as (select *, high - low as spread, case when high - low > 0 then (close - low) / (high - low) else 0.5 end as cp from
    (select symbol, date, open, high, low, close, volume, 'daily' as timeframe from bars
    union all select symbol, date_trunc('week', date)::date + 6 as date, {CANDLE.replace("(open, date)", "(open, bars.date)").replace("(close, date)", "(close, bars.date)")}, 'weekly' from bars group by symbol, date_trunc('week', date)::date + 6
    union all select symbol, last_day(date) as date, {CANDLE.replace("(open, date)", "(open, bars.date)").replace("(close, date)", "(close, bars.date)")}, 'monthly' from bars group by symbol, last_day(date))),
e1 as (select *, count(*) over (partition by symbol, timeframe) as n, row_number() over w as rn, avg(volume) over (partition by symbol, timeframe order by date rows between 20 preceding and 1 preceding) as mean20,
    {', '.join(f'lag({c}) over w as prev_{c}' for c in ('date', 'volume', 'close', 'cp', 'high', 'low', 'spread'))}, coalesce({_PASS}, false) as passed, lead(date, 4) over w as date4, lead(close, 4) over w as close4, lead(date, 9) over w as date9,
    max(close) over f as best, min(close) over f as worst from ef window w as (partition by symbol, timeframe order by date), f as (partition by symbol, timeframe order by date rows between 5 following and 9 following)),
e2 as (select *, case when open > prev_close and cp >= prev_cp then 'Gap-Up' when open < prev_close and cp <= prev_cp then 'Gap-Down' end as gap_direction, case when cp >= 0.7 then 'Strong' else 'Weak' end as close_band from e1
    where n >= 5 and prev_volume > 0 and volume > prev_volume and (cp <= 0.3 or cp >= 0.7)),
e3 as (select *, {_BL(0)} as trigger, {_BL(1)} as sentiment, case when rn <= 20 or coalesce(mean20, 0) = 0 then 0.5 else {_UNIT.format('volume / mean20 - 1')} end as vol_score, {_side('')} as close_score, {_side('prev_')} as prev_score, passed and date4 is not null as gauntlet_passed from e2 where gap_direction is not null),
e4 as (select *, {_UNIT.format('0.5 + (close_score - prev_score)')} as drift_score, case when gauntlet_passed and date9 is not null then (case when sentiment = 'Bullish' then best else worst end - close4) / close4 * 100 end as fwd_return_5b from e3),
trades as (select symbol, timeframe, date, prev_date as start_date, case when gauntlet_passed then date4 end as completion_date, trigger, sentiment, volume as t_vol, (volume / prev_volume - 1) * 100 as vol_surge_pct, gauntlet_passed, fwd_return_5b,
    case when sentiment = 'Bullish' then fwd_return_5b > 0 else fwd_return_5b < 0 end as win, vol_score, close_score, drift_score, (vol_score * 0.40 + close_score * 0.40 + drift_score * 0.20) * 100 as raw_confidence from e4)"""

SPREAD = BARS + """,
g0 as (select *, high - low as spread, case when high - low > 0 then (close - low) / (high - low) else 0.5 end as cp from bars),
g1 as (select *, count(*) over (partition by symbol) as n, lag(volume) over w as t1_vol, lag(spread) over w as t1_spread, lead(close, 1) over w as c1, lead(close, 3) over w as c3, lead(close, 5) over w as c5,
    max(high) over f as top, min(low) over f as bottom from g0 window w as (partition by symbol order by date), f as (partition by symbol order by date rows between 1 following and 5 following)),
g2 as (select *, case when volume > t1_vol and spread < t1_spread then 'Bullish' when volume < t1_vol and spread > t1_spread then 'Bearish' end as sentiment from g1 where n >= 10 and c5 is not null and t1_vol > 0 and volume > 0 and spread > 0 and t1_spread > 0),
sp as (select symbol, date, sentiment, round_even((volume - t1_vol) / t1_vol * 100, 1) as vol_pct, round_even((spread - t1_spread) / t1_spread * 100, 1) as spread_pct, round_even(cp, 4) as t_cp,
    case when sentiment = 'Bullish' then (c1 - close) / close > 0 else (c1 - close) / close < 0 end as win_1d, case when sentiment = 'Bullish' then (c3 - close) / close > 0 else (c3 - close) / close < 0 end as win_3d, case when sentiment = 'Bullish' then (c5 - close) / close > 0 else (c5 - close) / close < 0 end as win_5d,
    round_even((c1 - close) / close * 100, 2) as ret_1d, round_even((c3 - close) / close * 100, 2) as ret_3d, round_even((c5 - close) / close * 100, 2) as ret_5d,
    round_even(case when sentiment = 'Bullish' then (top - close) / close else (close - bottom) / close end * 100, 2) as max_move_pct from g2 where sentiment is not null)"""


def _r(cols: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in cols.split())


def spread_trades(spark, d):
    return backtests.spread_trades(bars(spark, d))


def trades(spark, d):
    return backtests.eigen_trades(end_frames(spark, d))


GATED = "case when rows <> days then 'DUPLICATE_DATES' when wrong > 0 then 'INVALID_OHLC_PRICES' when rows > 0 and volume = 0 then 'ZERO_TOTAL_VOLUME' when rows < 5 then 'INSUFFICIENT_DATA' end"
GATE = BARS + f""",
gs as (select symbol, count(*) as rows, count(distinct date) as days, count(*) filter (where high < low or least(open, high, low, close) <= 0) as wrong, sum(volume) as volume from bars group by symbol),
verdict as (select symbol, rows, {GATED} as reason, {GATED} is null as passed from gs)"""


def raw_gate_input(spark, d):
    """Single trades as bars, dates repeat: most symbols fail on them."""
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    p = F.try_divide("l_extendedprice", "l_quantity")
    few = F.col("l_suppkey").cast("string")
    return t.select(F.concat(F.lit("R"), few, F.lit("-"), F.col("l_returnflag"), F.lit("-"), F.date_format("l_shipdate", "yyyyMM")).alias("symbol"), F.to_date("l_shipdate").alias("date"), p.alias("open"), (p * (1 + F.col("l_tax"))).alias("high"), p.alias("low"), (p * (1 - F.col("l_discount") + F.col("l_tax"))).alias("close"), F.when(F.col("l_linestatus") == "O", 0.0).otherwise(F.col("l_quantity")).alias("volume"))


RAW_GATE = f"""
with bars as (select 'R' || l_suppkey || '-' || l_returnflag || '-' || strftime(l_shipdate, '%Y%m') as symbol, l_shipdate::date as date, p as open, p * (1 + l_tax) as high, p as low, p * (1 - l_discount + l_tax) as close, case when l_linestatus = 'O' then 0.0 else l_quantity end as volume
    from (select *, l_extendedprice / nullif(l_quantity, 0) as p from lineitem)),
gs as (select symbol, count(*) as rows, count(distinct date) as days, count(*) filter (where high < low or least(open, high, low, close) <= 0) as wrong, sum(volume) as volume from bars group by symbol),
verdict as (select symbol, rows, {GATED} as reason, {GATED} is null as passed from gs)"""

SEQ = "sequence_id, symbol, timeframe, config_id"
ROUTES_SQL = "select symbol, unnest(['trending', 'effort', 'ticker', 'trigger', 'anomaly']) as route, unnest([trending, effort, ticker, trigger, anomaly]) as flag from flags"

EIG = "symbol, timeframe, period, prev_period, gap_direction, close_band, label, sentiment"

#: name: (query, SQL)
_RAW = {
    "bars_from_trades": (lambda s, d: rounded(bars(s, d)), f"with {BARS} select symbol, date, {_r('open high low close volume')} from bars"),
    "quality_gate": (lambda s, d: quality.gate(bars(s, d)), f"with {GATE} select * from verdict"),
    "quality_gate_missing": (lambda s, d: quality.gate(bars(s, d).drop("volume")), f"with {BARS} select distinct symbol, 0::bigint as rows, 'MISSING_COLUMNS' as reason, false as passed from bars"),
    "quality_gate_raw": (lambda s, d: quality.gate(raw_gate_input(s, d)), f"{RAW_GATE} select * from verdict"),
    "quality_reasons": (lambda s, d: rounded(quality.reason_histogram(quality.gate(raw_gate_input(s, d)))), f"{RAW_GATE} select coalesce(reason, 'PASSED') as reason, count(*) as symbols, round(count(*) / any_value(total), 6) as share, round(any_value(rate), 6) as pass_rate from verdict, (select count(*) as total, avg(passed::int) as rate from verdict) group by coalesce(reason, 'PASSED')"),
    "quality_split": (lambda s, d: _split_counts(s, d), f"{RAW_GATE} select passed, count(*) as bars, round(sum(b.volume), 6) as volume from bars b join verdict v on b.symbol = v.symbol group by passed"),
    "indicators": (lambda s, d: rounded(with_indicators(bars(s, d)).select("symbol", "date", *IND_COLS)), f"with {IND} select symbol, date, {_r('spread close_position volume_ma spread_ma close_ma support resistance prev_volume prev_spread vol_pct spr_pct')}, price_trend, is_up, is_down, is_doji, effort from ind"),
    "signals": (lambda s, d: rounded(labelled(s, d).select("symbol", "date", "signal", "sentiment", "meaning", "confidence", "description", "anomaly", "validation", "fire")), f"with {SIG} select symbol, date, signal, sentiment, meaning, round(confidence::double, 6) as confidence, description, anomaly, validation, fire from sig"),
    "signal_statistics": (lambda s, d: rounded(patterns.signal_statistics(labelled(s, d))), f"with {SIG} select symbol, count(*) filter (where validation = 'Confirmed') as confirmed, count(*) filter (where validation = 'Failed') as failed, count(*) filter (where validation = 'Pending') as pending, count(*) filter (where fire) as fire, count(*) filter (where validation <> 'N/A') as total, round(coalesce(count(*) filter (where validation = 'Confirmed') / nullif(count(*) filter (where validation <> 'N/A'), 0), 0), 6) as confirmation_rate from sig group by rollup (symbol)"),
    "signal_histogram": (lambda s, d: patterns.signal_histogram(labelled(s, d)), f"with {SIG} select signal, count(*) as bars from sig group by signal"),
    "win_rate_audit": (lambda s, d: rounded(patterns.win_rate_audit(labelled(s, d))), f"with {SIG} select signal, count(*) filter (where validation = 'Confirmed') as confirmed, count(*) filter (where validation = 'Failed') as failed, count(*) filter (where validation = 'Pending') as pending, round(count(*) filter (where validation = 'Confirmed') / nullif(count(*) filter (where validation in ('Confirmed', 'Failed')), 0), 6) as win_rate from sig where validation <> 'N/A' group by signal"),
    "route_flags": (lambda s, d: rounded(patterns.route_flags(labelled(s, d))), f"with {SIG} select * replace (round(vol_pct, 6) as vol_pct, round(confidence::double, 6) as confidence) from flags"),
    "route_counts": (lambda s, d: patterns.route_counts(patterns.route_flags(labelled(s, d))), f"with {SIG} select route, count(*) as symbols from ({ROUTES_SQL}) where flag group by route"),
    "route_members": (lambda s, d: patterns.route_fan_out(patterns.route_flags(labelled(s, d))), f"with {SIG} select route, symbol from ({ROUTES_SQL}) where flag"),
    "ticker_cards": (lambda s, d: rounded(patterns.ticker_cards(labelled(s, d))), f"with {SIG} select symbol, case when signal <> 'No Signal' then split_part(signal, ' (', 1) else anomaly end as pattern, case when signal <> 'No Signal' then regexp_extract(signal, '\\((.*)\\)', 1) else {MOOD} end as sentiment, effort, case when signal <> 'No Signal' then description else 'Advanced Anomaly Detected: ' || anomaly || '. Structural shifts observed in volume/price relationship.' end as description, round(case when spread_ma > 0 then spread / spread_ma else 1.0 end, 6) as spread_ratio, round(case when signal <> 'No Signal' then confidence else 0.7 end::double, 6) as confidence from newest where rn = 1"),
    "trigger_rows": (lambda s, d: rounded(patterns.trigger_rows(labelled(s, d))), f"with {SIG} select symbol, prev_volume::bigint as prev_vol, volume::bigint as curr_vol, round(prev_spread, 6) as prev_spr, round(spread, 6) as curr_spr, round(vol_pct, 6) as vol_pct, round(spr_pct, 6) as spr_pct from newest where rn = 1"),
    "anomaly_rows": (lambda s, d: rounded(patterns.anomaly_rows(labelled(s, d))), f"with {SIG} select symbol, anomaly as pattern, prev_volume::bigint as prev_vol, volume::bigint as curr_vol, round(vol_pct, 6) as drop_pct, {MOOD} as sentiment from newest where rn = 1"),
    "candles": (lambda s, d: rounded(frames(s, d)), f"with {FRAMES} select symbol, timeframe, period, {_r('open high low close volume spread close_position')} from frames"),
    "candles_end_labelled": (lambda s, d: rounded(end_frames(s, d)), f"with {TRADES} select symbol, timeframe, date, {_r('open high low close volume')} from ef"),
    "eigen_all": (lambda s, d: rounded(timeframes.eigen(frames(s, d)).select(*EIG.split(", "), "volume_surge_pct")), f"with {FRAMES} select {EIG}, round(volume_surge_pct, 6) as volume_surge_pct from eig"),
    "eigen_latest": (lambda s, d: rounded(timeframes.eigen(frames(s, d), latest_only=True).select(*EIG.split(", "), "volume_surge_pct")), f"with {FRAMES} select {EIG}, round(volume_surge_pct, 6) as volume_surge_pct from eig where next_period is null"),
    "eigen_details": (lambda s, d: timeframes.eigen_details(timeframes.eigen(frames(s, d))), f"with {FRAMES} select symbol, timeframe, period, prev_period, label, sentiment, round_even(close_position, 4) as t_cp, round_even(prev_cp, 4) as t1_cp, round_even(close_position - prev_cp, 4) as delta_cp, round_even((volume - prev_vol) / greatest(prev_vol, 1) * 100, 1) as vol_delta_pct from eig"),
    "age_again": (lambda s, d: rounded(timeframes.age_again(frames(s, d)).select("symbol", "timeframe", "period", "scenario", "label", "sentiment", "volume_pct", "spread_pct")), f"with {FRAMES} select symbol, timeframe, period, scenario, label, sentiment, round(volume_pct, 6) as volume_pct, round(spread_pct, 6) as spread_pct from age"),
    "age_again_latest": (lambda s, d: rounded(timeframes.age_again(frames(s, d), latest_only=True).select("symbol", "timeframe", "scenario", "label", "sentiment", "volume_pct", "spread_pct")), f"with {FRAMES} select symbol, timeframe, scenario, label, sentiment, round(volume_pct, 6) as volume_pct, round(spread_pct, 6) as spread_pct from age where next_period is null"),
    "consensus": (lambda s, d: timeframes.consensus(timeframes.eigen(frames(s, d), latest_only=True)).orderBy(F.col("score").desc(), "symbol"), f"with {FRAMES} select * from cons"),
    "consensus_distribution": (lambda s, d: timeframes.consensus_distribution(timeframes.consensus(timeframes.eigen(frames(s, d), latest_only=True))), f"with {FRAMES} select 'stars' as kind, stars::varchar as value, count(*) as symbols from cons group by stars union all select 'daily', case when daily_sentiment in ('Bullish', 'Bearish') then daily_sentiment else 'Neutral' end, count(*) from cons group by 2"),
    "sequence_triggers": (lambda s, d: sequences.triggers(timeframes.eigen(frames(s, d)), sequences.sequence_config(s)).select(*SEQ.split(", "), "trigger_period", "label", "sentiment"), f"with {LOG} select {SEQ}, trigger_period, label, sentiment from st"),
    "transition_deltas": (lambda s, d: rounded(sequences.with_deltas(frames(s, d)).select("symbol", "timeframe", "period", "vol_delta_pct", "spread_delta_pct")), f"with {LOG} select symbol, timeframe, period, round(dv, 6) as vol_delta_pct, round(ds, 6) as spread_delta_pct from de"),
    "sequence_log": (lambda s, d: rounded(log(s, d).select(*SEQ.split(", "), "stage_no", "stage", "period", "rule_evaluated", "matched", "action", "failure_reason", "timestamp", "event_id", F.col("metrics.vol_delta_pct").alias("vol_delta_pct"), F.col("metrics.spread_delta_pct").alias("spread_delta_pct"))), f"with {LOG} select {SEQ}, stage_no, stage, period, rule_evaluated, matched, action, failure_reason, timestamp, event_id, round(vol_delta_pct, 6) as vol_delta_pct, round(spread_delta_pct, 6) as spread_delta_pct from log"),
    "sequence_chain": (lambda s, d: sequences.verify_chain(sequences.chain(log(s, d))).select("event_id", "previous_hash", "hash", "intact"), f"""with recursive {LOG},
        pl as (select sequence_id, stage_no, event_id, concat_ws('|', event_id, stage, action, rule_evaluated, matched::varchar, failure_reason, timestamp) as body from log),
        ch as (select sequence_id, stage_no, event_id, '' as previous_hash, sha256('|' || body) as hash from pl where stage_no = 0
            union all select pl.sequence_id, pl.stage_no, pl.event_id, ch.hash, sha256(ch.hash || '|' || pl.body) from ch join pl on pl.sequence_id = ch.sequence_id and pl.stage_no = ch.stage_no + 1)
        select event_id, previous_hash, hash, true as intact from ch"""),
    "sequence_states": (lambda s, d: sequences.fold(log(s, d)), f"with {LOG} select * exclude (raw_confidence), round_even(raw_confidence, 1) as confidence from states"),
    "sequence_replay": (lambda s, d: sequences.replay(log(s, d), "1995-06-30").select("sequence_id", "state", "stage_index", "events"), f"with {LOG}, part as (select * from log where timestamp <= '1995-06-30T23:59:59Z') select sequence_id, case arg_max(action, stage_no) when 'INIT' then 'Triggered' when 'ADVANCE' then 'Waiting' when 'FAIL' then 'Failed' when 'COMPLETE' then 'Completed' end as state, count(*) filter (where action = 'ADVANCE') as stage_index, count(*) as events from part group by sequence_id"),
    "sequence_resume": (lambda s, d: sequences.states(_resumed(s, d)), f"with {LOG} select * exclude (raw_confidence), round_even(raw_confidence, 1) as confidence from states"),
    "sequence_summary": (lambda s, d: sequences.summary(sequences.fold(log(s, d))), f"with {LOG} select timeframe, {BUCKET} as bucket, count(*) as sequences from states group by timeframe, {BUCKET}"),
    "sequence_health": (lambda s, d: sequences.health(sequences.fold(log(s, d))), f"with {LOG} select count(*) filter (where {BUCKET} = 'active') as active, count(*) filter (where {BUCKET} = 'completed') as completed, count(*) filter (where {BUCKET} = 'failed') as failed, 0::bigint as hash_failures, 'PASS' as status, round_even(coalesce(avg(round_even(raw_confidence, 1)) filter (where {BUCKET} = 'active'), 0), 2) as mean_confidence, sum(events)::bigint as total_events from states"),
    "sequence_board": (lambda s, d: sequences.board(sequences.fold(log(s, d))), f"""with {LOG} select timeframe, "column", symbol, trigger_period, sequence_id, row_number() over (partition by timeframe, "column" order by trigger_period desc, symbol, sequence_id) as at from (select *, case when state = 'Completed' then 'Completed' when state = 'Failed' then 'Failed' else 'T+' || least(stage_index, 3) end as "column" from states)"""),
    "sequence_drill_down": (lambda s, d: _drill(s, d), f"with {LOG} select sequence_id, stage, action, period, rule_evaluated from log where sequence_id = (select min(sequence_id) from log where action = 'COMPLETE')"),
    "eigen_backtest": (lambda s, d: rounded(trades(s, d)), f"with {TRADES} select * exclude (raw_confidence) replace ({_r('t_vol vol_surge_pct fwd_return_5b vol_score close_score drift_score')}), round(round_even(raw_confidence, 1), 6) as confidence from trades"),
    "eigen_backtest_metrics": (lambda s, d: rounded(backtests.eigen_metrics(trades(s, d))), f"with {TRADES} select timeframe, count(*) as triggers, count(win) as completed, count(*) filter (where win) as wins, count(*) filter (where not gauntlet_passed) as failures, round(coalesce(count(*) filter (where win) * 100.0::double / nullif(count(win), 0), 0), 6) as win_rate from trades group by rollup (timeframe)"),
    "eigen_backtest_winners": (lambda s, d: rounded(backtests.winners(trades(s, d))), f"with {TRADES} select timeframe, symbol, start_date, completion_date, trigger, sentiment, round(fwd_return_5b, 6) as fwd_return_5b, round_even(raw_confidence, 1) as confidence from trades where gauntlet_passed and win"),
    "spread_backtest": (spread_trades, f"with {SPREAD} select * from sp"),
    "spread_backtest_metrics": (lambda s, d: rounded(backtests.spread_metrics(spread_trades(s, d))), f"with {SPREAD} select sentiment, count(*) as trades, count(distinct symbol) as symbols, {', '.join(f'round(avg(win_{k}d::int), 6) as win_rate_{k}d, round(avg(ret_{k}d), 6) as mean_ret_{k}d' for k in (1, 3, 5))}, round(avg(max_move_pct), 6) as mean_max_move from sp group by sentiment"),
    "context_splits": (lambda s, d: rounded(backtests.context_splits(spread_trades(s, d))), f"""with {SPREAD}, v as (select *, case when sentiment = 'Bearish' then abs(vol_pct) else vol_pct end as vol_size from sp), md as (select sentiment, median(vol_size) as mv, median(spread_pct) as ms from v group by sentiment),
        x as (select v.*, mv, ms from v join md using (sentiment)), y as (select sentiment, win_5d, 'volume' as split, case when vol_size > mv then 'above' else 'below' end as side from x union all select sentiment, win_5d, 'spread', case when case when sentiment = 'Bearish' then spread_pct > ms else spread_pct >= ms end then 'above' else 'below' end from x union all select sentiment, win_5d, 'close', case when t_cp >= 0.7 then 'strong' else 'weak' end from x)
        select sentiment, split, side, count(*) as trades, round(avg(win_5d::int), 6) as win_rate_5d from y group by sentiment, split, side"""),
    "completions_by_symbol": (lambda s, d: backtests.completions_by_symbol(trades(s, d)), f"""with {TRADES} select symbol, timeframe, date, completion_date, trigger, "at", newest, greatest(n - 10, 0) as remaining from (select *, row_number() over (partition by symbol order by completion_date desc, date desc, timeframe) as "at", max(completion_date) over (partition by symbol) as newest, count(*) over (partition by symbol) as n from trades where gauntlet_passed) where "at" <= 10"""),
    "conviction_text": (lambda s, d: backtests.conviction_text(trades(s, d)), f"""with {TRADES}, cv as (select *, round_even(raw_confidence, 1) as conf, vol_score * 100 as v, close_score * 100 as c, drift_score * 100 as dr from trades) select symbol, timeframe, date,
        case when v >= c and v >= dr then 'Volume surge of ' || floor(v + 0.5)::bigint || '% vs the 20-period average is the primary driver.' when c >= dr then 'A close position score of ' || floor(c + 0.5)::bigint || '% indicates price closed ' || case when c >= 50 then 'near the favourable' else 'away from the favourable' end || ' extreme.' else 'The drift score of ' || floor(dr + 0.5)::bigint || '% reflects ' || case when dr >= 50 then 'improving' else 'deteriorating' end || ' close position versus the prior candle.' end || ' ' ||
        case when conf >= 70 then 'Overall conviction for this ' || sentiment || ' ' || trigger || ' signal is strong.' when conf >= 40 then 'Overall conviction is moderate — treat as a qualifying signal requiring confirmation.' else 'Overall conviction is low — this signal carries elevated uncertainty.' end as summary from cv"""),
}


def _split_counts(spark, d):
    raw = raw_gate_input(spark, d)
    kept, held = quality.split_by_gate(raw, quality.gate(raw))
    both = kept.withColumn("passed", F.lit(True)).unionByName(held.withColumn("passed", F.lit(False)))
    return rounded(both.groupBy("passed").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume")))


def _resumed(spark, d):
    """Three parts of the hashed log in the order of its events: two checkpointed one after the other, the last one resumed from there.

    Events of a timestamp are appended together: the offset is the number of events with earlier ones, told by a row per timestamp, so the log is stored once and not ordered.
    """
    stored = materialise(log(spark, d, hashed=True).drop("research_id"), codec="zstd")  # mostly hashes in hexadecimal digits, which take half of their room
    counts = stored.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("timestamp").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialise(counts.select("timestamp", "n", F.coalesce(before, F.lit(0)).alias("offset")))
    rows = offsets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    whole, place = stored.join(F.broadcast(offsets.drop("n")), "timestamp"), shared_dir(spark)  # a row per timestamp
    for cut in (rows // 3, 2 * rows // 3):
        sequences.checkpoint(whole.filter(F.col("offset") < cut), place)
    return sequences.resume(whole, place)


def _drill(spark, d):
    """The completed sequence with the least id, found by a scalar aggregate that joins back as one row."""
    whole = log(spark, d)
    one = whole.filter("action = 'COMPLETE'").agg(F.min("sequence_id").alias("_id"))
    return whole.join(F.broadcast(one), F.col("sequence_id") == F.col("_id"), "left_semi").select("sequence_id", "stage", "action", "period", "rule_evaluated")


BAR_QUERIES = {name: (query, same_rounding(sql)) for name, (query, sql) in _RAW.items()}
