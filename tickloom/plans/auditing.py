"""Queries of quality counters, duplicates, intervals and the loss audit."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import div, kst_minute, seconds_of
from tickloom.operators import audit as a
from tickloom.operators import dedup as dd
from tickloom.operators import intervals as iv
from tickloom.operators import quality as q
from tickloom.plans.decoding import KIS_QUOTE, _frames, _with
from tickloom.plans.registry import COUNTED, TICKS, register, table
from tickloom.sources.adapters import counted_ticks, live_ticks, ticks

_RAW = "case when seq % 37 <> 0 then symbol end as shcode, cast(price as string) as price_raw, cast(cvolume - 1 as string) as cvolume_raw, cast(volume - case when seq % 29 = 0 then 500 else 0 end as string) as volume_raw, cast(seq % 900 as string) as change_raw, case when seq % 2 = 0 then '2' else '5' end as sign, case when seq % 5 = 0 then '0.5' end as drate_raw, cast(cum as string) as mdchecnt_raw, '0' as mschecnt_raw, recv_wall_ns, conn_id, seq, dt, vendor, vendor <> 'toss' as cum_applicable"
_TICK_SQL = f"""with {COUNTED}, r as (select {_RAW} from live), t as (select *, cast(price_raw as double) as price, cast(cvolume_raw as bigint) as cvolume, cast(volume_raw as bigint) as volume, cast(change_raw as double) as change, cast(drate_raw as double) as drate, cast(mdchecnt_raw as bigint) as n from r),
u as (select *, shcode is null as bad, case when sign = '2' then price - change else price + change end as ref, price / (1 + drate / 100) as dref, lag(volume) over s as vp, lag(n) over s as np from t window s as (partition by shcode, conn_id order by recv_wall_ns, seq)),
f as (select *, coalesce(not bad and cvolume <= 0, false) as zero, coalesce(not bad and cum_applicable and ref > 0 and (price > ref * (1.0 + 0.30) or price < ref * (1.0 - 0.30)), false) as band, coalesce(not bad and cum_applicable and volume < vp, false) as regr,
  coalesce(not bad and cum_applicable and abs(ref - dref) > abs(dref) * 0.01, false) as disagree, coalesce(not bad and cum_applicable and cvolume > 0 and n - np <= 1 and volume - vp > cvolume, false) as loss from u),
s as (select {{keys}}, count(*) as rows, count(*) filter (bad) as decode_fail, count(*) filter (zero) as zero_volume, count(*) filter (band) as price_band_violation, count(*) filter (regr) as cum_volume_regression, count(*) filter (disagree) as schema_disagree, count(*) filter (loss) as tick_loss, cast(sum(case when loss then volume - vp - cvolume else 0 end) as bigint) as lost_volume from f group by {{keys}})"""


def _tick_flags(spark, sf_dir):
    return q.tick_flags(live_ticks(spark, sf_dir).selectExpr(*_split(_RAW)))


def _split(text: str) -> list[str]:
    """Select items of a list; commas inside parentheses don't split."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[last:i].strip())
            last = i + 1
    return [*out, text[last:].strip()]


@register("a1_tick_quality", _TICK_SQL.format(keys="vendor") + " select * from s")
def a1_tick_quality(spark, sf_dir):
    return q.tick_summary(_tick_flags(spark, sf_dir), "vendor")


@register("a2_tick_quality_by_day", _TICK_SQL.format(keys="dt") + " select * from s")
def a2_tick_quality_by_day(spark, sf_dir):
    return q.tick_summary(_tick_flags(spark, sf_dir), "dt")


_REASONS = ", ".join(f"case when {n} / rows > {0.001} then 'tick.{n}' end" for n in q.TICK_COUNTERS)


@register("a4_verdict", _TICK_SQL.format(keys="dt, vendor") + f", v as (select dt, vendor, list_filter([{_REASONS}], lambda x: x is not null) as reasons, {' + '.join(q.TICK_COUNTERS)} > 0 as noisy from s) select dt, vendor, reasons, case when len(reasons) > 0 then 'FAIL' when noisy then 'WARN' else 'PASS' end as status from v")
def a4_verdict(spark, sf_dir):
    return q.verdict(q.tick_summary(_tick_flags(spark, sf_dir), "dt", "vendor")).select("dt", "vendor", "reasons", "status")


@register("a4_skipped_rules", f"with {TICKS} select v.vendor, r as rule from (select distinct vendor from ticks) v, (select unnest({list(q.SKIPPED['toss'])}) as r) where v.vendor = 'toss'")
def a4_skipped_rules(spark, sf_dir):
    return q.skipped_rules(ticks(spark, sf_dir))


@register("a3_quote_quality", f"{_with(KIS_QUOTE)}, g as (select *, seq % 17 = 0 as bad, list_sum(list_transform(range(0, 10), lambda k: (seq + k) % 9)) as ar, list_sum(list_transform(range(10, 20), lambda k: (seq + k) % 9)) as br from f) select dt, count(*) as rows, count(*) filter (bad) as decode_fail, 0::bigint as ladder_disorder, 0::bigint as crossed_book, 0::bigint as negative_remain, count(*) filter (not bad and (40 < ar or 90 < br)) as total_remain_short from g group by dt")
def a3_quote_quality(spark, sf_dir):
    from tickloom.operators.decode import kis_quotes

    return q.quote_summary(q.quote_flags(kis_quotes(_frames(spark, sf_dir, KIS_QUOTE))), "dt")


_BOOK_SQL = "b as (select vec_id, label, list_transform(embedding[1:10], lambda x: cast(floor(x * 1000) as int)) as asks, list_transform(embedding[11:20], lambda x: cast(floor(x * 1000) as int)) as bids from embeddings)"


@register("a3_book_invariants", f"with {_BOOK_SQL} select label, count(*) as rows, count(*) filter (len(list_filter(range(1, 10), lambda i: (asks[i] > 0 and asks[i + 1] > 0 and asks[i] >= asks[i + 1]) or (bids[i] > 0 and bids[i + 1] > 0 and bids[i] <= bids[i + 1]))) > 0) as ladder_disorder, count(*) filter (bids[1] > 0 and asks[1] > 0 and bids[1] >= asks[1]) as crossed_book, count(*) filter (list_min(asks) < 0 or list_min(bids) < 0) as negative_remain from b group by label")
def a3_book_invariants(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    at = lambda k: F.floor(F.get("embedding", F.lit(k)) * 1000).cast("int")
    cols = {f"offerho{k + 1}": at(k) for k in range(10)} | {f"bidho{k + 1}": at(10 + k) for k in range(10)} | {f"offerrem{k + 1}": at(k) for k in range(10)} | {f"bidrem{k + 1}": at(10 + k) for k in range(10)}
    rows = e.withColumns(cols | {"shcode": F.lit("x"), "hotime": F.lit(100000), "totofferrem": F.lit(0), "totbidrem": F.lit(0)})
    return q.quote_summary(q.quote_flags(rows), "label").select("label", "rows", "ladder_disorder", "crossed_book", "negative_remain")


@register("a5_phase_counts", f"with {TICKS} select dt, count(*) as n, list_sort(list(distinct vendor)) as vendors from ticks group by dt")
def a5_phase_counts(spark, sf_dir):
    return ticks(spark, sf_dir).groupBy("dt").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("vendor")).alias("vendors"))


@register("a6_frame_counts", f"with {TICKS} select symbol, vendor, strftime(make_timestamp(recv_wall_ns // 1000) + interval 9 hour, '%Y-%m-%dT%H:%M') as minute_kst, count(*) as frames from ticks where symbol is not null group by all")
def a6_frame_counts(spark, sf_dir):
    return ticks(spark, sf_dir).where("symbol is not null").groupBy("symbol", "vendor", kst_minute(F.col("recv_wall_ns")).alias("minute_kst")).agg(F.count("*").alias("frames"))


_LINES = "l as (select l_orderkey, l_linenumber, l_partkey, cast(round(l_extendedprice * 100) as bigint) as cents, l_suppkey from lineitem)"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"), "l_suppkey")


@register("d1_first_of_key", f"with {_LINES} select * exclude (n) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, cents, l_suppkey) as n from l) where n = 1")
def d1_first_of_key(spark, sf_dir):
    return dd.first_of_key(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], ["l_partkey", "cents", "l_suppkey"])


@register("d2_payload_conflicts", f"with {_LINES} select l_orderkey, l_linenumber, count(*) as rows from l group by all having count(distinct cents) > 1")
def d2_payload_conflicts(spark, sf_dir):
    return dd.payload_conflicts(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], "cents")


@register("d1_dedup_frames", f"with {TICKS}, t as (select *, unnest([0, 1]) as copy from ticks) select conn_id, seq as conn_seq, symbol || ':' || price::varchar as raw, recv_wall_ns from t where copy = 0")
def d1_dedup_frames(spark, sf_dir):
    frames = ticks(spark, sf_dir).select("conn_id", F.col("seq").alias("conn_seq"), F.concat("symbol", F.lit(":"), F.col("price").cast("string")).alias("raw"), "recv_wall_ns", F.explode(F.array(F.lit(0), F.lit(1))).alias("file"))
    return dd.dedup_l0(frames, ["file"]).drop("file")


@register("d4_consecutive_duplicates", f"with {TICKS} select seq, coalesce(lag(vendor) over w = vendor and lag(conn_id) over w = conn_id, false) as is_duplicate from ticks window w as (partition by symbol order by recv_wall_ns, seq)")
def d4_consecutive_duplicates(spark, sf_dir):
    return dd.consecutive_duplicates(ticks(spark, sf_dir), ["symbol"], ["recv_wall_ns", "seq"], ["vendor", "conn_id"]).select("seq", "is_duplicate")


@register("d5_handover", f"with {TICKS} select seq from (select seq, conn_id, first_value(conn_id) over (partition by symbol, cvolume order by recv_wall_ns, seq) as owner from ticks) where owner = conn_id")
def d5_handover(spark, sf_dir):
    return dd.admit_handover(ticks(spark, sf_dir), ["symbol", "cvolume"], ["recv_wall_ns", "seq"]).select("seq")


@register("d6_duplicated_keys", f"with {_LINES} select * from l where (l_orderkey, l_linenumber) in (select (l_orderkey, l_linenumber) from l group by all having count(*) > 1)".replace("(select (l_orderkey, l_linenumber) from l group by all", "(select (l_orderkey, l_linenumber) from l group by l_orderkey, l_linenumber"))
def d6_duplicated_keys(spark, sf_dir):
    return dd.duplicated_keys(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@register("d8_effective_tiers", "with l as (select lpad(user_id::varchar, 6, '0') as symbol, case event_type when 'view' then 'A' when 'click' then 'B' when 'purchase' then 'C' else 'B' end as tier, case when event_type = 'error' then 'ack' else 'plan' end as source, event_id as seq from events) select symbol, tier, seq from (select *, row_number() over (partition by symbol order by case tier when 'A' then 3 when 'B' then 2 else 1 end desc, seq desc) as n from l where source <> 'ack') where n = 1")
def d8_effective_tiers(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    log = e.select(F.lpad(F.col("user_id").cast("string"), 6, "0").alias("symbol"), F.when(kind == "view", "A").when(kind == "purchase", "C").otherwise("B").alias("tier"), F.when(kind == "error", "ack").otherwise("plan").alias("source"), F.col("event_id").alias("seq"))
    rank = F.when(F.col("tier") == "A", 3).when(F.col("tier") == "B", 2).otherwise(1)
    return dd.effective_tiers(log, rank).select("symbol", "tier", "seq")


GAPS = f"""{COUNTED}, g0 as (select *, lag(cum) over w as cp, lag(volume) over w as vp, lag(hms) over w as hp, lag(recv_wall_ns) over w as rp, lag(conn_id) over w as np from live window w as (partition by symbol order by cum)),
gaps as (select symbol, case when volume - vp - cvolume > 0 then 'confirmed' else 'count_only' end as kind, cum - cp - 1 as missing_trades, greatest(0, volume - vp - cvolume) as volume_deficit, cp as cum_prev, cum as cum_next, hp as chetime_prev, hms as chetime_next, rp as recv_prev_ns, recv_wall_ns as recv_next_ns, conn_id <> np as conn_changed, vp as acml_prev, volume - cvolume as acml_next_before from g0 where cum - cp > 1)"""


@register("o2_counter_gaps", f"with {GAPS} select * from gaps")
def o2_counter_gaps(spark, sf_dir):
    return a.counter_gaps(live_ticks(spark, sf_dir))


#: Phases of a tick's day in the queries, and the ledger of each (day, symbol, phase).
_PHASE = "case when hms < '090000' then 'pre' when hms < '152000' then 'regular' else 'post' end"
PHASED = f"""{COUNTED}, ph as (select *, {_PHASE} as phase from live),
pg as (select *, lag(cum) over w as cp, lag(volume) over w as vp, lag(recv_wall_ns) over w as rp from ph window w as (partition by dt, symbol, phase order by cum)),
pgaps as (select dt, symbol, phase, case when volume - vp - cvolume > 0 then 'confirmed' else 'count_only' end as kind, cum - cp - 1 as missing_trades,
  greatest(0, volume - vp - cvolume) as volume_deficit, cp as cum_prev, cum as cum_next, rp as recv_prev_ns, recv_wall_ns as recv_next_ns from pg where cum - cp > 1),
pseg as (select dt, symbol, phase, count(*) as accepted, max(cum) - min(cum) + 1 as trades, min(cum) as least, max(cum) as most from ph group by all),
ploss as (select dt, symbol, cast(sum(missing_trades) as bigint) as missing, cast(coalesce(sum(missing_trades) filter (kind = 'confirmed'), 0) as bigint) as confirmed_missing,
  cast(coalesce(sum(missing_trades) filter (kind = 'count_only'), 0) as bigint) as count_only_missing, cast(sum(volume_deficit) as bigint) as volume_deficit from pgaps where phase = 'regular' group by all),
psum as (select dt, symbol, cast(sum(accepted) as bigint) as frames, cast(coalesce(sum(trades) filter (phase = 'regular'), 0) as bigint) as trades_observed,
  cast(coalesce(sum(trades - accepted) filter (phase = 'regular'), 0) as bigint) as net_missing, max(most) > min(least) as varied from pseg group by all),
ptotals as (select dt, symbol, case when frames > 1 and not varied then 'NO_COUNTER' else 'OK' end as status, frames, trades_observed, coalesce(missing, 0) as missing, coalesce(confirmed_missing, 0) as confirmed_missing,
  coalesce(count_only_missing, 0) as count_only_missing, coalesce(volume_deficit, 0) as volume_deficit, net_missing,
  case when trades_observed > 0 then coalesce(confirmed_missing, 0) / trades_observed::double else 0.0 end as loss_ratio from psum left join ploss using (dt, symbol))"""


def phased(live):
    return live.withColumn("phase", F.expr(_PHASE))


@register(
    "o2_counter_ledger",
    f"with {PHASED}, n as (select dt, symbol, phase, accepted from pseg) select dt, symbol, phase, kind, missing_trades, volume_deficit, cum_prev, cum_next, accepted, 0::bigint as resets from pgaps join n using (dt, symbol, phase) "
    "union all select dt, symbol, phase, null, null, null, null, null, accepted, 0 from n where (dt, symbol, phase) not in (select (dt, symbol, phase) from pgaps)",
)
def o2_counter_ledger(spark, sf_dir):
    return a.counter_ledger(phased(live_ticks(spark, sf_dir))).select("dt", "symbol", "phase", "kind", "missing_trades", "volume_deficit", "cum_prev", "cum_next", "accepted", "resets")


def late_and_repeated(live):
    """A feed in which every thirteenth frame comes after the one that follows it, and every thirty-first twice."""
    segment = Window.partitionBy("dt", "symbol", "phase").orderBy("cum")
    late = (F.col("seq") % 13 == 0) & F.lag("cum").over(segment).isNotNull() & F.lead("cum").over(segment).isNotNull()
    moved = live.withColumns({"_late": late, "_next": F.lead("recv_wall_ns").over(segment)}).withColumn("recv_wall_ns", F.when(F.col("_late"), F.col("_next") + 1).otherwise(F.col("recv_wall_ns")))
    twice = F.when((F.col("seq") % 31 == 0) & (F.col("seq") % 13 != 0), 2).otherwise(1)
    return moved.withColumn("_copy", F.explode(F.sequence(F.lit(1), twice))).drop("_late", "_next", "_copy")


@register("a10_ledger_totals", f"with {PHASED}, d as (select dt, symbol, count(*) filter (seq % 31 = 0 and seq % 13 <> 0) as duplicates from ph group by all) select *, 0::bigint as regressions, 0::bigint as resets from ptotals join d using (dt, symbol)")
def a10_ledger_totals(spark, sf_dir):
    return a.ledger_totals(a.counter_ledger(late_and_repeated(phased(live_ticks(spark, sf_dir))))).drop("intervals", "intervals_truncated")


TOTALS = f"""{GAPS}, seen as (select symbol, count(*) as frames, max(cum) - min(cum) + 1 as trades_observed from live group by 1),
lost as (select symbol, count(*) as intervals, cast(sum(missing_trades) as bigint) as missing, cast(coalesce(sum(missing_trades) filter (kind = 'confirmed'), 0) as bigint) as confirmed_missing,
  cast(coalesce(sum(missing_trades) filter (kind = 'count_only'), 0) as bigint) as count_only_missing, cast(sum(volume_deficit) as bigint) as volume_deficit from gaps group by 1),
totals as (select symbol, case when frames > 1 and trades_observed = 1 then 'NO_COUNTER' else 'OK' end as status, frames, trades_observed, coalesce(intervals, 0) as intervals, coalesce(missing, 0) as missing,
  coalesce(confirmed_missing, 0) as confirmed_missing, coalesce(count_only_missing, 0) as count_only_missing, coalesce(volume_deficit, 0) as volume_deficit, trades_observed - frames as net_missing,
  coalesce(confirmed_missing, 0) / trades_observed::double as loss_ratio from seen left join lost using (symbol))"""


def loss_totals(spark, sf_dir):
    live = live_ticks(spark, sf_dir)
    return a.loss_totals(live, a.counter_gaps(live))


register("a10_loss_totals", f"with {TOTALS} select * from totals")(loss_totals)

_SESSION = """se_tot as (select count(*) filter (status = 'OK') as symbols, count(*) filter (status = 'OK' and confirmed_missing + count_only_missing > 0) as symbols_with_loss, count(*) filter (status <> 'OK') as symbols_without_counter,
  cast(coalesce(sum(trades_observed) filter (status = 'OK'), 0) as bigint) as trades_observed, cast(coalesce(sum(confirmed_missing) filter (status = 'OK'), 0) as bigint) as confirmed_missing,
  cast(coalesce(sum(count_only_missing) filter (status = 'OK'), 0) as bigint) as count_only_missing, cast(coalesce(sum(volume_deficit) filter (status = 'OK'), 0) as bigint) as volume_deficit,
  cast(coalesce(sum(greatest(net_missing, 0)) filter (status = 'OK'), 0) as bigint) as net_missing_positive from totals)"""


@register("a10_session_totals", f"with {TOTALS}, {_SESSION} select *, confirmed_missing / trades_observed::double as loss_ratio from se_tot")
def a10_session_totals(spark, sf_dir):
    return a.session_totals(loss_totals(spark, sf_dir))


@register(
    "a14_gap_budget",
    f"""with {TOTALS}, ok as (select * from totals where status = 'OK'), s as (select cast(sum(confirmed_missing) as bigint) as confirmed, cast(sum(trades_observed) as bigint) as trades, sum(confirmed_missing) / sum(trades_observed)::double as loss_ratio from ok),
br as (select *, count(*) over () as n, row_number() over (order by loss_ratio desc, confirmed_missing desc, symbol) as k from ok where trades_observed >= 10 and loss_ratio > 0.05),
w as (select symbol, confirmed_missing as c, trades_observed as t, n from br where k = 1),
f as (select confirmed, trades, s.loss_ratio, coalesce(n, 0) as breaching, w.symbol as worst_symbol, list_filter([case when s.loss_ratio > 0.005 then 'trade_loss_exceeded:' || confirmed || '/' || trades end,
  case when n > 0 then 'symbol_loss_exceeded:' || w.symbol || ':' || c || '/' || t || case when n > 1 then '+' || (n - 1) else '' end end], lambda x: x is not null) as bad from s left join w on true)
select confirmed, trades, loss_ratio, breaching, worst_symbol, case when len(bad) = 0 and loss_ratio > 0.0001 then ['trade_loss_warn:' || confirmed || '/' || trades] else bad end as reasons, 'ledger' as basis,
  case when len(bad) > 0 then 'FAIL' when loss_ratio > 0.0001 then 'WARN' else 'PASS' end as status from f""",
)
def a14_gap_budget(spark, sf_dir):
    return a.gap_budget(loss_totals(spark, sf_dir), least_trades=10)


@register("t12_worst_symbol", f"with {TOTALS} select symbol, loss_ratio from totals where status = 'OK' order by loss_ratio desc, confirmed_missing desc, symbol limit 1")
def t12_worst_symbol(spark, sf_dir):
    worst = F.min(F.struct((-F.col("loss_ratio")).alias("r"), (-F.col("confirmed_missing")).alias("c"), "symbol")).alias("w")
    return loss_totals(spark, sf_dir).where("status = 'OK'").agg(worst).select("w.symbol", (-F.col("w.r")).alias("loss_ratio"))


@register("t9_top_intervals", f"with {GAPS} select symbol, missing_trades, recv_prev_ns, cast(n as int) as rank from (select *, row_number() over (partition by symbol order by missing_trades desc, recv_prev_ns) as n from gaps) where n <= 3")
def t9_top_intervals(spark, sf_dir):
    return a.top_intervals(a.counter_gaps(live_ticks(spark, sf_dir)), 3).select("symbol", "missing_trades", "recv_prev_ns", "rank")


_LAT = f"{TICKS}, lt as (select vendor as stream, strftime(make_timestamp(recv_wall_ns // 1000) + interval 9 hour, '%Y-%m-%dT%H:00') as minute_kst, conn_id, symbol, recv_wall_ns, (seq % 97) / 10.0::double as latency_s from ticks), lm as (select stream, minute_kst, conn_id, count(*) as count, quantile_disc(latency_s, 0.5) as p50_s, min(latency_s) as min_s, max(latency_s) as max_s, min(recv_wall_ns) as f, max(recv_wall_ns) as l, list(distinct symbol) as symbols from lt group by all)"


def _latency(spark, sf_dir):
    hour = F.concat(F.substring(kst_minute(F.col("recv_wall_ns")), 1, 14), F.lit("00"))
    rows = ticks(spark, sf_dir).withColumns({"stream": F.col("vendor"), "minute_kst": hour, "latency_s": (F.col("seq") % 97) / F.lit(10.0)})
    return a.latency_minutes(rows)


@register("a7_latency_minutes", f"with {_LAT} select stream, minute_kst, conn_id, count, p50_s, min_s, max_s from lm")
def a7_latency_minutes(spark, sf_dir):
    return _latency(spark, sf_dir).select("stream", "minute_kst", "conn_id", "count", "p50_s", "min_s", "max_s")


_MERGED = f"{_LAT}, tp as (select *, first_value(f) over w as tf, first_value(l) over w as tl, first_value(symbols) over w as ts, first_value(conn_id) over w as tc from lm window w as (partition by stream, minute_kst order by count desc, conn_id desc)), sc as (select *, conn_id <> tc and f <= tl and l >= tf and list_has_any(symbols, ts) as sec from tp), mg as (select stream, minute_kst, cast(sum(count) filter (not sec) as bigint) as count, max(p50_s) filter (conn_id = tc) as p50_s, max(max_s) filter (not sec) as max_s, min(min_s) filter (not sec) as min_s, cast(coalesce(sum(count) filter (sec), 0) as bigint) as secondary_count, max(max_s) filter (sec) as secondary_max_s from sc group by all)"


@register("a8_merge_connections", f"with {_MERGED} select * from mg")
def a8_merge_connections(spark, sf_dir):
    return a.merge_connections(_latency(spark, sf_dir))


@register("a9_latency_breaches", f"with {_MERGED} select stream, minute_kst, max_s from mg where substr(minute_kst, 12, 5) >= '09:00' and substr(minute_kst, 12, 5) < '15:00' and max_s > 8.0")
def a9_latency_breaches(spark, sf_dir):
    return a.latency_breaches(a.merge_connections(_latency(spark, sf_dir)), "09:00", "15:00", 8.0).select("stream", "minute_kst", "max_s")


_SEC = "(cast(substr(hms, 1, 2) as int) * 3600 + cast(substr(hms, 3, 2) as int) * 60 + cast(substr(hms, 5, 2) as int))"


@register("a11_tail_silence", f"with {TICKS}, m as (select dt, max({_SEC}) as second from ticks where hms < '152000' group by dt) select dt, greatest(0, 55200 - second) as tail_silence_s from m")
def a11_tail_silence(spark, sf_dir):
    last = ticks(spark, sf_dir).where("hms < '152000'").groupBy("dt").agg(F.max(seconds_of(F.col("hms"))).alias("second"))
    return a.tail_silence(last, 55200).select("dt", F.col("tail_silence_s").cast("int").alias("tail_silence_s"))


_HOLES = f"{TICKS}, se as (select distinct dt, {_SEC} as s from ticks where {_SEC} >= 32400 and {_SEC} < 55200), ed as (select dt, s from se union all select distinct dt, 32399 from se union all select distinct dt, 55200 from se), nx as (select dt, s, lead(s) over (partition by dt order by s) as n from ed), ho as (select dt, s + 1 as start, n as end_, n - s - 1 as seconds from nx where n - s - 1 >= 60)"


def _holes(spark, sf_dir):
    return iv.event_holes(ticks(spark, sf_dir).select("dt", seconds_of(F.col("hms")).cast("int").alias("second")), ["dt"], 32400, 55200, 60)


@register("o3_event_holes", f"with {_HOLES} select dt, start, end_ as \"end\", seconds from ho")
def o3_event_holes(spark, sf_dir):
    return _holes(spark, sf_dir)


@register("t10_longest_holes", f"with {_HOLES} select dt, start, seconds from (select *, row_number() over (partition by dt order by seconds desc, start) as n from ho) where n <= 2")
def t10_longest_holes(spark, sf_dir):
    return a.longest_holes(_holes(spark, sf_dir), ["dt"], 2).select("dt", "start", "seconds")


_SPANS = "sp as (select o_custkey % 100 as k, epoch_us(o_orderdate) // 86400000000 as lo, epoch_us(o_orderdate) // 86400000000 + o_orderkey % 6 as hi, o_orderkey as id from orders)"


def _spans(spark, sf_dir):
    day = div(F.unix_micros(F.col("o_orderdate").cast("timestamp")), 86_400_000_000).cast("long")
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("k"), day.alias("lo"), (day + F.col("o_orderkey") % 6).alias("hi"), F.col("o_orderkey").alias("id"))


def _merge_sql(rule: str) -> str:
    return f"with {_SPANS}, r as (select *, max(hi) over (partition by k order by lo, hi rows between unbounded preceding and 1 preceding) as reach from sp), i as (select *, sum(case when {rule} then 0 else 1 end) over (partition by k order by lo, hi rows unbounded preceding) as g from r), m as (select k, min(lo) as lo, max(hi) as hi, count(*) as n from i group by k, g) select * from m"


@register("o6_merge_touching", _merge_sql("lo <= reach"))
def o6_merge_touching(spark, sf_dir):
    return iv.merge_intervals(_spans(spark, sf_dir), ["k"])


@register("o6_merge_adjacent", _merge_sql("lo <= reach + 1"))
def o6_merge_adjacent(spark, sf_dir):
    return iv.merge_intervals(_spans(spark, sf_dir), ["k"], "adjacent")


@register("o6_merge_open", _merge_sql("lo < reach"))
def o6_merge_open(spark, sf_dir):
    return iv.merge_intervals(_spans(spark, sf_dir), ["k"], "open")


@register("o7_clipped_total", _merge_sql("lo <= reach").replace("from orders)", "from orders), raw_sp as (select * from sp)").replace("sp as (", "sp0 as (", 1).replace("raw_sp as (select * from sp)", "sp as (select k, greatest(lo, 9500) as lo, least(hi, 10500) as hi, id from sp0 where greatest(lo, 9500) < least(hi, 10500))").replace("select * from m", "select k, cast(sum(hi - lo) as bigint) as seconds, count(*) as spans from m group by k"))
def o7_clipped_total(spark, sf_dir):
    return iv.clip_and_total(_spans(spark, sf_dir), ["k"], 9500, 10500)


@register("o5_clusters", f"with {GAPS}, c as (select symbol, recv_prev_ns // 1000000000 as lo, recv_next_ns // 1000000000 + 7200 as hi, cum_prev, missing_trades from gaps), r as (select *, max(hi) over (partition by symbol order by lo, hi, cum_prev rows between unbounded preceding and 1 preceding) as reach from c), i as (select *, sum(case when lo <= reach then 0 else 1 end) over (partition by symbol order by lo, hi, cum_prev rows unbounded preceding) as g from r) select symbol, min(lo) as lo, max(hi) as hi, count(*) as members, cast(sum(missing_trades) as bigint) as missing from i group by symbol, g")
def o5_clusters(spark, sf_dir):
    gaps = a.counter_gaps(live_ticks(spark, sf_dir))
    spans = gaps.withColumns({"lo": div(F.col("recv_prev_ns"), 1_000_000_000), "hi": div(F.col("recv_next_ns"), 1_000_000_000) + 7200})
    return iv.island_ids(spans, ["symbol"], tie="cum_prev").groupBy("symbol", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("members"), F.sum("missing_trades").alias("missing")).drop("island")


@register("j7_trades_in_gaps", f"with {GAPS} select c.symbol, c.seq, g.cum_prev from counted c join gaps g on g.symbol = c.symbol and c.volume > g.acml_prev and c.volume <= g.acml_next_before")
def j7_trades_in_gaps(spark, sf_dir):
    gaps = a.counter_gaps(live_ticks(spark, sf_dir)).select("symbol", F.col("acml_prev").alias("lo"), F.col("acml_next_before").alias("hi"), "cum_prev")
    return iv.points_in(counted_ticks(spark, sf_dir).select("symbol", "seq", "volume"), gaps, ["symbol"], "volume", 1000).select("symbol", "seq", "cum_prev")


@register("j8_received_in_gaps", f"with {GAPS} select distinct c.symbol, c.seq from live c join gaps g on g.symbol = c.symbol and c.recv_wall_ns >= g.recv_prev_ns and c.recv_wall_ns <= g.recv_next_ns")
def j8_received_in_gaps(spark, sf_dir):
    live = live_ticks(spark, sf_dir)
    spans = iv.merge_intervals(a.counter_gaps(live).select("symbol", F.col("recv_prev_ns").alias("lo"), F.col("recv_next_ns").alias("hi")), ["symbol"])
    return iv.points_in(live.select("symbol", "seq", "recv_wall_ns"), spans, ["symbol"], "recv_wall_ns", 86_400_000_000_000, low_open=False).select("symbol", "seq")


@register("j9_counters_inside", f"with {GAPS} select c.symbol, c.seq from counted c join gaps g on g.symbol = c.symbol and c.cum > g.cum_prev and c.cum < g.cum_next")
def j9_counters_inside(spark, sf_dir):
    spans = iv.merge_intervals(a.counter_gaps(live_ticks(spark, sf_dir)).select("symbol", F.col("cum_prev").alias("lo"), F.col("cum_next").alias("hi")), ["symbol"], "open")
    return iv.points_in(counted_ticks(spark, sf_dir).select("symbol", "seq", "cum"), spans, ["symbol"], "cum", 1000, high_open=True).select("symbol", "seq")


@register("j10_multiset_minus", f"with {COUNTED}, l as (select symbol, dt, vendor, seq, row_number() over (partition by symbol, dt, conn_id order by seq) as n, conn_id from counted), h as (select symbol, dt, conn_id, count(*) as have from live group by all) select l.symbol, l.seq from l left join h using (symbol, dt, conn_id) where n > coalesce(have, 0)")
def j10_multiset_minus(spark, sf_dir):
    return dd.multiset_minus(counted_ticks(spark, sf_dir), live_ticks(spark, sf_dir), ["symbol", "dt", "conn_id"], ["seq"]).select("symbol", "seq")


@register("j17_multiset_overlap", f"with {COUNTED}, x as (select symbol, cvolume, count(*) filter (vendor = 'ls') as a, count(*) filter (vendor = 'kis') as b from counted where vendor in ('ls', 'kis') group by all) select symbol, cast(sum(a) as bigint) as left_rows, cast(sum(b) as bigint) as right_rows, cast(sum(least(a, b)) as bigint) as matched from x group by symbol")
def j17_multiset_overlap(spark, sf_dir):
    t = counted_ticks(spark, sf_dir)
    return dd.multiset_overlap(t.where("vendor = 'ls'"), t.where("vendor = 'kis'"), ["symbol"], ["cvolume"])


@register("j18_conflation", f"with {COUNTED}, r as (select distinct symbol, cvolume from counted where vendor = 'ls'), s as (select distinct symbol, cvolume, 1 as hit from counted where vendor = 'kis') select symbol, count(*) as reference, count(hit) as seen from r left join s using (symbol, cvolume) group by symbol")
def j18_conflation(spark, sf_dir):
    t = counted_ticks(spark, sf_dir)
    keys = lambda v: t.where(F.col("vendor") == v).select("symbol", "cvolume").distinct()
    return keys("ls").join(keys("kis").withColumn("hit", F.lit(1)), ["symbol", "cvolume"], "left").groupBy("symbol").agg(F.count("*").alias("reference"), F.count("hit").alias("seen"))


@register("j11_as_of_rate", "with s as (select o_orderstatus as market, o_orderdate as since, (o_orderkey % 30) as rate from (select *, row_number() over (partition by o_orderstatus, o_orderdate order by o_orderkey) as n from orders where o_orderkey % 50 = 0) where n = 1) select o.o_orderkey, s.rate from orders o asof left join s on o.o_orderstatus = s.market and o.o_orderdate >= s.since")
def j11_as_of_rate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("market"), "o_orderdate")
    # about a hundred days, in the unit of the column
    width = 100 if orders.schema["o_orderdate"].dataType.typeName() == "date" else 100 * 86_400_000_000
    marks = dd.first_of_key(orders.where("o_orderkey % 50 = 0"), ["market", "o_orderdate"], ["o_orderkey"]).select("market", F.col("o_orderdate").alias("since"), (F.col("o_orderkey") % 30).alias("rate"))
    return iv.as_of(orders, marks, ["market"], "o_orderdate", "since", width).select("o_orderkey", "rate")


@register("j13_outage_kinds", f"with {GAPS}, o as (select symbol, recv_wall_ns as s, recv_wall_ns + 3600000000000 as e, seq from counted) select o.seq, case when exists (select 1 from gaps g where g.symbol = o.symbol and o.s < g.recv_next_ns and g.recv_prev_ns < o.e) then 'loss' else 'silent' end as kind from o")
def j13_outage_kinds(spark, sf_dir):
    spans = iv.merge_intervals(a.counter_gaps(live_ticks(spark, sf_dir)).select("symbol", F.col("recv_prev_ns").alias("lo"), F.col("recv_next_ns").alias("hi")), ["symbol"])
    outages = counted_ticks(spark, sf_dir).select("symbol", "seq", F.col("recv_wall_ns").alias("start"), (F.col("recv_wall_ns") + 3_600_000_000_000).alias("end"))
    hit = iv.overlapping(outages, spans, ["symbol"], 6 * 3_600_000_000_000).select("seq", F.lit("loss").alias("kind"))
    return outages.select("seq").join(hit, "seq", "left").select("seq", F.coalesce("kind", F.lit("silent")).alias("kind"))
