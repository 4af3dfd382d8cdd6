"""Queries of gap filling, repaired ticks, feed selection and feed quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import div
from tickloom.operators import audit as a
from tickloom.operators import feeds as f
from tickloom.operators import repair as r
from tickloom.operators.digest import table_digest
from tickloom.operators.intervals import points_in
from tickloom.plans.auditing import GAPS, TOTALS, loss_totals
from tickloom.plans.registry import COUNTED, TICKS, register
from tickloom.sources.adapters import counted_ticks, live_ticks, ticks
from tickloom.sources.scratch import staged

#: Gaps numbered per symbol, on the scale of seconds.
_NUMBERED = f"{GAPS}, ng as (select *, cum_prev as interval_id, recv_prev_ns // 1000000000 as ts_prev, recv_next_ns // 1000000000 as ts_next from gaps)"


def _counted(spark, sf_dir):
    """Counted ticks, written once: gaps, fills, live feed and tape are all made of them."""
    return staged(counted_ticks(spark, sf_dir), "counted")


def _gaps(spark, sf_dir, counted=None):
    second = lambda c: div(F.col(c), 1_000_000_000)
    live = live_ticks(spark, sf_dir) if counted is None else counted.where("not lost")
    return a.counter_gaps(live).withColumns({"interval_id": F.col("cum_prev"), "ts_prev": second("recv_prev_ns"), "ts_next": second("recv_next_ns")})


def _trades(df):
    return df.select("symbol", div(F.col("recv_wall_ns"), 1_000_000_000).alias("ts"), "price", F.col("cvolume").alias("volume"), F.col("seq").alias("tape_seq"))


@register("o8_peer_fill", f"with {_NUMBERED} select c.symbol, g.interval_id, 1 as peer, c.volume as acml, c.price, c.cvolume as qty from counted c join ng g on c.symbol = g.symbol and c.volume > g.acml_prev and c.volume <= g.acml_next_before where c.lost")
def o8_peer_fill(spark, sf_dir):
    lost = counted_ticks(spark, sf_dir).where("lost").select("symbol", F.explode(F.array(F.lit(1), F.lit(2))).alias("peer"), F.col("volume").alias("acml"), "price", F.col("cvolume").alias("qty"))
    peers = lost.withColumn("conflated", F.col("peer") == 2)
    return r.peer_fill(_gaps(spark, sf_dir), peers)


_FILLED = f"{_NUMBERED}, filled as (select c.symbol, g.interval_id, c.recv_wall_ns // 1000000000 as ts, c.price, c.cvolume as volume, c.seq as tape_seq, c.cum from counted c join ng g on c.symbol = g.symbol and c.cum > g.cum_prev and c.cum < g.cum_next where c.lost)"


def _filled(spark, sf_dir):
    counted = _counted(spark, sf_dir)
    gaps = staged(_gaps(spark, sf_dir, counted), "gaps")
    return counted, gaps, r.tape_fill(gaps, _trades(counted), _trades(counted.where("not lost")))[0]


@register("o9_tape_fill", f"with {_FILLED} select symbol, interval_id, ts, price, volume, tape_seq from filled")
def o9_tape_fill(spark, sf_dir):
    return _filled(spark, sf_dir)[2]


#: Two tapes: the first lacks all trades of odd prices, so a cluster with only such is filled by the second. Of every gap with four or more lost trades the peers have recovered one.
_TWO = f"""{_NUMBERED}, tp as (select symbol, recv_wall_ns // 1000000000 as ts, price, cvolume as volume, seq as tape_seq, s as source from counted, (select unnest([0, 1]) as s) where lost and (s = 1 or price % 2 = 0)),
g2 as (select *, case when missing_trades >= 4 then 1 else 0 end as prior, missing_trades - case when missing_trades >= 4 then 1 else 0 end as miss from ng),
ro as (select *, max(ts_next) over (partition by symbol order by ts_prev, ts_next, interval_id rows between unbounded preceding and 1 preceding) as reach from g2),
cl as (select *, sum(case when ts_prev <= reach then 0 else 1 end) over (partition by symbol order by ts_prev, ts_next, interval_id rows unbounded preceding) as island from ro),
sp as (select symbol, island, min(ts_prev) as lo, max(ts_next) as hi from cl group by all),
pl as (select t.symbol, island, source, count(*) as pooled from tp t join sp on t.symbol = sp.symbol and t.ts > lo and t.ts < hi group by all),
ch as (select symbol, island, arg_min(pooled, source) as pooled, min(source) as source from pl group by all),
me as (select cl.*, coalesce(pooled, 0) as pooled, source, sum(miss) over (partition by cl.symbol, cl.island order by ts_prev, ts_next, interval_id rows unbounded preceding) - miss as fr, sum(miss) over (partition by cl.symbol, cl.island) as al, row_number() over (partition by cl.symbol, cl.island order by ts_prev desc, ts_next desc, interval_id desc) = 1 as la from cl left join ch using (symbol, island)),
oc as (select symbol, interval_id, miss + prior as missing_trades, prior + cast(greatest(0, least(miss, least(pooled, al) - fr)) as bigint) as recovered, cast(case when la then greatest(0, pooled - al) else 0 end as bigint) as surplus, prior as recovered_prior, source from me)"""


@register("o9_two_tapes", f"with {_TWO} select *, greatest(0, missing_trades - recovered) as residual, case when surplus > 0 then 'over' when recovered = 0 then 'none' when recovered < missing_trades then 'partial' else 'full' end as status from oc")
def o9_two_tapes(spark, sf_dir):
    counted = _counted(spark, sf_dir)
    prior = F.when(F.col("missing_trades") >= 4, 1).otherwise(0).cast("long")
    gaps = staged(_gaps(spark, sf_dir, counted).withColumns({"prior_recovered": prior, "missing_trades": F.col("missing_trades") - prior}), "gaps")
    tapes = _trades(counted.where("lost")).withColumn("source", F.explode(F.array(F.lit(0), F.lit(1)))).where("source = 1 or price % 2 = 0")
    return r.tape_fill(gaps, tapes)[1]


@register("o8_residual_gaps", f"with {_NUMBERED}, p as (select c.symbol, g.interval_id, count(*) as n, sum(c.cvolume) as q from counted c join ng g on c.symbol = g.symbol and c.volume > g.acml_prev and c.volume <= g.acml_next_before where c.lost and c.seq % 3 <> 0 group by all) select symbol, interval_id, coalesce(n, 0) as prior_recovered, greatest(0, missing_trades - coalesce(n, 0)) as missing_trades, cast(greatest(0, volume_deficit - coalesce(q, 0)) as bigint) as volume_deficit from ng left join p using (symbol, interval_id)")
def o8_residual_gaps(spark, sf_dir):
    counted = _counted(spark, sf_dir)
    gaps = staged(_gaps(spark, sf_dir, counted), "gaps")
    peers = counted.where("lost and seq % 3 <> 0").select("symbol", F.lit(1).alias("peer"), F.col("volume").alias("acml"), "price", F.col("cvolume").alias("qty"), F.lit(False).alias("conflated"))
    return r.residual_gaps(gaps, r.peer_fill(gaps, peers)).select("symbol", "interval_id", "prior_recovered", "missing_trades", "volume_deficit")


#: A tape that lacks every fifth trade and repeats every seventh, so clusters come out full, partial, empty or over.
_BROKEN = f"""{_NUMBERED}, tape as (select symbol, recv_wall_ns // 1000000000 as ts, price, cvolume as volume, seq * 10 + copy as tape_seq from counted, (select unnest([0, 1]) as copy) where lost and seq % 5 <> 0 and (copy = 0 or seq % 7 = 0)),
ro as (select *, max(ts_next) over (partition by symbol order by ts_prev, ts_next, interval_id rows between unbounded preceding and 1 preceding) as reach from ng),
cl as (select *, sum(case when ts_prev <= reach then 0 else 1 end) over (partition by symbol order by ts_prev, ts_next, interval_id rows unbounded preceding) as island from ro),
sp as (select symbol, island, min(ts_prev) as lo, max(ts_next) as hi, sum(missing_trades) as keep from cl group by all),
pl as (select t.symbol, island, count(*) as pooled from tape t join sp on t.symbol = sp.symbol and t.ts >= lo and t.ts <= hi group by all),
me as (select cl.*, coalesce(pooled, 0) as pooled, sum(missing_trades) over (partition by cl.symbol, cl.island order by ts_prev, ts_next, interval_id rows unbounded preceding) - missing_trades as fr, sum(missing_trades) over (partition by cl.symbol, cl.island) as al, row_number() over (partition by cl.symbol, cl.island order by ts_prev desc, ts_next desc, interval_id desc) = 1 as la from cl left join pl using (symbol, island)),
oc as (select symbol, interval_id, missing_trades, cast(greatest(0, least(missing_trades, least(pooled, al) - fr)) as bigint) as recovered, cast(case when la then greatest(0, pooled - al) else 0 end as bigint) as surplus from me)"""


def _broken(spark, sf_dir):
    lost = counted_ticks(spark, sf_dir).where("lost and seq % 5 <> 0").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).where("copy = 0 or seq % 7 = 0")
    return _trades(lost.withColumn("seq", F.col("seq") * 10 + F.col("copy")))


def _outcomes(spark, sf_dir):
    empty = _trades(live_ticks(spark, sf_dir))
    return r.tape_fill(_gaps(spark, sf_dir), _broken(spark, sf_dir), empty)[1]


@register("o9_fill_outcomes", f"with {_BROKEN} select *, missing_trades - recovered as residual, case when surplus > 0 then 'over' when recovered = 0 then 'none' when recovered < missing_trades then 'partial' else 'full' end as status from oc")
def o9_fill_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@register("a12_fill_summary", f"with {_BROKEN} select count(*) as intervals, cast(sum(missing_trades) as bigint) as missing_trades, cast(sum(recovered) as bigint) as recovered, cast(sum(missing_trades - recovered) as bigint) as residual from oc")
def a12_fill_summary(spark, sf_dir):
    return r.summarize_fill(_outcomes(spark, sf_dir))


_LEFT = f"with {TOTALS}, {_BROKEN.replace(GAPS + ', ', '')}, le as (select g.symbol, cast(sum(g.missing_trades - least(oc.recovered, g.missing_trades)) as bigint) as residual from ng g join oc using (symbol, interval_id) where g.kind = 'confirmed' group by 1), rl as (select symbol, status, trades_observed, missing, coalesce(residual, 0) as residual, coalesce(residual, 0) / trades_observed::double as residual_ratio from totals left join le using (symbol))"


@register("a13_repaired_loss", f"{_LEFT} select symbol, trades_observed, missing, residual, residual_ratio from rl")
def a13_repaired_loss(spark, sf_dir):
    return _repaired_loss(spark, sf_dir).drop("status")


def _repaired_loss(spark, sf_dir):
    return r.repaired_loss(_gaps(spark, sf_dir), _outcomes(spark, sf_dir), loss_totals(spark, sf_dir))


@register(
    "a13_repaired_verdict",
    f"""{_LEFT}, s as (select cast(sum(residual) as bigint) as residual, cast(sum(trades_observed) filter (status = 'OK') as bigint) as trades from rl),
br as (select *, count(*) over () as n, row_number() over (order by residual_ratio desc, residual desc, symbol) as k from rl where status = 'OK' and trades_observed >= 10 and residual_ratio > 0.05),
w as (select symbol, residual as c, trades_observed as t, n from br where k = 1),
f as (select s.residual, trades, s.residual / trades::double as loss_ratio, list_filter([case when s.residual / trades::double > 0.005 then 'residual_loss_exceeded:' || s.residual || '/' || trades end,
  case when n > 0 then 'residual_symbol_loss_exceeded:' || w.symbol || ':' || c || '/' || t || case when n > 1 then '+' || (n - 1) else '' end end], lambda x: x is not null) as bad from s left join w on true)
select residual, trades, loss_ratio, case when len(bad) = 0 and loss_ratio > 0.0001 then ['residual_loss_warn:' || residual || '/' || trades] else bad end as reasons,
  case when len(bad) > 0 then 'FAIL' when loss_ratio > 0.0001 then 'WARN' else 'PASS' end as status from f""",
)
def a13_repaired_verdict(spark, sf_dir):
    return r.repaired_verdict(_repaired_loss(spark, sf_dir), least_trades=10)


@register("o10_repaired_ticks", f"with {_FILLED} select symbol, cum, recv_wall_ns // 1000000000 as ts, price, cvolume as volume, 'live' as source, null::bigint as interval_id from live union all select symbol, cum, ts, price, volume, 'tape', interval_id from filled")
def o10_repaired_ticks(spark, sf_dir):
    counted, gaps, fills = _filled(spark, sf_dir)
    return r.repaired_ticks(_arrived(counted), fills, gaps).drop("recv_wall_ns")


def _arrived(counted):
    return counted.where("not lost").select("symbol", "cum", "price", F.col("cvolume").alias("volume"), div(F.col("recv_wall_ns"), 1_000_000_000).alias("ts"), "recv_wall_ns")


#: Gaps as they are, and one around each two that follow each other in a symbol. An inner fill takes the least free counter of its gap, so does an outer one, whose trades come later on the tape; there are two for every three lost trades.
_NESTED = f"""{_NUMBERED}, nu as (select *, row_number() over (partition by symbol order by cum_prev) as k from ng),
outer_ as (select a.symbol, -a.cum_prev as interval_id, a.cum_prev, b.cum_next from nu a join nu b on a.symbol = b.symbol and b.k = a.k + 1 where a.k % 2 = 1),
lostc as (select symbol, cum, row_number() over (partition by symbol order by cum) as i from counted where lost)"""


@register(
    "o10_nested_gaps",
    f"""with {_NESTED}, pr as (select o.symbol, o.interval_id, o.cum_prev, o.cum_next, count(l.cum) as size from outer_ o join lostc l on l.symbol = o.symbol and l.cum > o.cum_prev and l.cum < o.cum_next group by all)
select symbol, count(*) as gaps, cast(sum(size) as bigint) as placed, cast(sum(size) as bigint) as counters, cast(sum(2 * size) - sum(size) as bigint) as overfill from pr group by 1""",
)
def o10_nested_gaps(spark, sf_dir):
    """Every lost trade is offered twice, by its own gap and by one around it and its neighbour: each counter is given once, the rest is overfill."""
    counted = _counted(spark, sf_dir)
    inner = staged(_gaps(spark, sf_dir, counted), "gaps").select("symbol", "interval_id", "cum_prev", "cum_next")
    order = Window.partitionBy("symbol").orderBy("cum_prev")
    after = inner.withColumns({"k": F.row_number().over(order), "end": F.lead("cum_next").over(order), "id2": F.lead("interval_id").over(order)})
    pairs = staged(after.where("k % 2 = 1 and end is not null").select("symbol", "interval_id", "id2", "cum_prev", "cum_next", "end"), "pairs")
    outer = pairs.select("symbol", (-F.col("interval_id")).alias("interval_id"), "cum_prev", F.col("end").alias("cum_next"))
    used = inner.join(pairs.select("symbol", F.explode(F.array("interval_id", "id2")).alias("interval_id")), ["symbol", "interval_id"])
    gaps = used.unionByName(outer)
    lost = counted.where("lost").select("symbol", "cum", "price", F.col("cvolume").alias("volume"), div(F.col("recv_wall_ns"), 1_000_000_000).alias("ts"), F.col("seq").alias("tape_seq"))
    fills = points_in(lost, gaps.select("symbol", "interval_id", F.col("cum_prev").alias("lo"), F.col("cum_next").alias("hi")), ["symbol"], "cum", r.COUNTER_BIN, high_open=True)
    fills = fills.withColumn("ts", F.when(F.col("interval_id") < 0, F.col("ts") + 86_400_000).otherwise(F.col("ts"))).select("symbol", "interval_id", "ts", "price", "volume", "tape_seq")
    placed = r.place_fills(_arrived(counted), fills, gaps)
    sums = placed.groupBy("symbol").agg(F.count_if(F.col("fate") == "placed").alias("placed"), F.countDistinct("cum").alias("counters"), F.count_if(F.col("fate") == "overfill").alias("overfill"))
    return outer.groupBy("symbol").agg(F.count("*").alias("gaps")).join(sums, "symbol")


@register("o11_tape_topup")
def o11_tape_topup(spark, sf_dir):
    gaps = _gaps(spark, sf_dir)
    slots = gaps.select("symbol", F.explode(F.sequence(F.col("cum_prev") + 1, F.col("cum_next") - 1)).alias("cum"), F.col("ts_prev").alias("lo"), F.col("ts_next").alias("hi"))
    return r.tape_topup(slots, _broken(spark, sf_dir))


#: The text of a row of the gaps, and the digest of a table of at most 16 ** 3 blocks.
_GAP_TEXT = ", ".join(f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')" for c in ("cum_next", "cum_prev", "interval_id", "kind", "missing_trades", "symbol", "volume_deficit"))
_DIGEST = """hh as (select sha256(x) as h, count(*) as n from tx group by 1), dg as (select greatest(0, ceil(log(greatest(1.0, (select count(*) from hh) / 64.0)) / log(16.0)))::int as d),
l1 as (select substring(h, 1, d) as key, sha256(string_agg(h || ':' || n::varchar, ',' order by h || ':' || n::varchar)) as g, min(d) as d from hh, dg group by substring(h, 1, d)),
di as (select case when min(d) = 0 then min(g) else sha256(string_agg(key || ':' || g, ',' order by key || ':' || g)) end as digest from l1)"""


@register(
    "o12_row_check",
    f"""with {_FILLED}, tx as (select concat_ws(',', {_GAP_TEXT}) as x from ng), {_DIGEST}, pl as (select count(*) as n from filled where tape_seq % 4 <> 0),
c as (select (select count(*) from live) as live_rows, (select n from pl) as filled_rows, digest from di)
select 'same' as case_, live_rows + filled_rows as rows, live_rows, filled_rows, digest, []::varchar[] as against, true as valid from c
union all select 'audit changed', live_rows + filled_rows, live_rows, filled_rows, digest, ['audit'], false from c
union all select 'rows lost', live_rows + filled_rows - (select count(*) from live where seq % 7 = 0), live_rows, filled_rows, digest, ['rows'], false from c
union all select 'other audit', live_rows + filled_rows, live_rows, filled_rows, digest, ['status', 'live_rows'], false from c""".replace("case_", '"case"'),
)
def o12_row_check(spark, sf_dir):
    """A repair by a tape that lacks every fourth trade: valid as it is, and not with a changed audit, lost rows, or what the audit did not count."""
    counted, gaps, fills = _filled(spark, sf_dir)
    live = _arrived(counted)
    placed = staged(r.place_fills(live, fills.where("tape_seq % 4 <> 0"), gaps), "placed")
    repaired = r.with_fills(live, placed)
    audit = gaps.select("symbol", "interval_id", "kind", "missing_trades", "volume_deficit", "cum_prev", "cum_next")
    sums = placed.agg(F.count_if(F.col("fate") == "placed").alias("filled_rows")).join(live.agg(F.count("*").alias("live_rows"))).join(table_digest(audit, 64).select("digest"))
    one = staged(sums.select(F.lit("OK").alias("status"), "live_rows", "filled_rows", F.lit(0).alias("topup_rows"), F.col("live_rows").alias("audit_trades_received"), F.col("digest").alias("audit_digest")), "summary")
    changed = audit.withColumn("volume_deficit", F.when(F.col("cum_prev") == F.lit(1), F.col("volume_deficit") + 1).otherwise(F.col("volume_deficit") + 0))
    kept = repaired.join(counted.where("seq % 7 = 0 and not lost").select("symbol", "cum"), ["symbol", "cum"], "left_anti")
    cases = {"same": (repaired, one, audit), "audit changed": (repaired, one, changed), "rows lost": (kept, one, audit), "other audit": (repaired, one.withColumns({"status": F.lit("MISMATCH"), "audit_trades_received": F.col("live_rows") + 1}), audit)}
    out = None
    for name, (table, summary, now) in cases.items():
        row = r.repair_valid(table, summary, now, 64).join(summary.select(F.col("audit_digest").alias("digest"))).select(F.lit(name).alias("case"), "rows", "live_rows", "filled_rows", "digest", "against", "valid")
        out = row if out is None else out.unionByName(row)
    return out


@register("t11_trim_surplus", f"with {TICKS}, p as (select symbol, cvolume as volume, recv_wall_ns as ts, seq as tape_seq, count(*) over (partition by symbol) as size, sum(cvolume) over (partition by symbol) as total from ticks), q as (select *, size - case when symbol like '%1' then size - 1 else size // 2 end as dr, case when symbol like '%1' then total - (select min(cvolume) from ticks t where t.symbol = p.symbol) else 1 end as deficit from p), e as (select *, max((ts, tape_seq)) filter (dr = 1 and volume = total - deficit) over (partition by symbol) as gone, row_number() over (partition by symbol order by volume, ts desc, tape_seq desc) as sm from q) select symbol, tape_seq from e where case when gone is not null then (ts, tape_seq) <> gone else sm > dr end")
def t11_trim_surplus(spark, sf_dir):
    group = Window.partitionBy("symbol")
    pool = ticks(spark, sf_dir).select("symbol", F.col("cvolume").alias("volume"), F.col("recv_wall_ns").alias("ts"), F.col("seq").alias("tape_seq"))
    size, odd = F.count("*").over(group), F.col("symbol").like("%1")
    pool = pool.withColumns({"keep": F.when(odd, size - 1).otherwise(F.floor(size / 2)), "deficit": F.when(odd, F.sum("volume").over(group) - F.min("volume").over(group)).otherwise(1)})
    return r.trim_surplus(pool, ["symbol"]).select("symbol", "tape_seq")


@register("j4_tape_surplus", f"with {COUNTED}, t as (select symbol, cvolume, count(*) as n from counted group by all), l as (select symbol, cvolume, count(*) as have from live group by all) select symbol, cvolume, n, n - coalesce(have, 0) as surplus from t left join l using (symbol, cvolume) where n > coalesce(have, 0)")
def j4_tape_surplus(spark, sf_dir):
    keys = ["symbol", "cvolume"]
    return r.tape_surplus(live_ticks(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("have")), counted_ticks(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("n")), keys).drop("have")


_UNITS = f"{TICKS}, un as (select dt, vendor, count(*) as n, count(*) filter (lost) as missing from ticks group by all), us as (select *, n % 7 <> 0 as audited, n % 5 <> 0 as tape_done, n % 4 <> 0 as filled, n % 3 <> 0 as merged from un)"


@register("o13_day_repair", f"with {_UNITS} select dt, vendor, case when not audited then 'unaudited' when missing = 0 and n % 11 = 0 then 'clean' when not tape_done then 'tape_pending' when not filled then 'gapfill_pending' when not merged then 'merge_pending' else 'repaired' end as state from us")
def o13_day_repair(spark, sf_dir):
    n = F.col("n")
    units = ticks(spark, sf_dir).groupBy("dt", "vendor").agg(F.count("*").alias("n")).withColumns({"missing": (n % 11).cast("long"), "audited": n % 7 != 0, "tape_done": n % 5 != 0, "filled": n % 4 != 0, "merged": n % 3 != 0})
    units = units.withColumn("missing", F.when((F.col("missing") == 0) & (F.col("vendor") != "kiwoom"), 0).otherwise(1))
    return r.day_repair_state(units).select("dt", "vendor", "state")


_FR = f"{TICKS}, fr as (select symbol, dt as minute, vendor, count(*) as frames from ticks group by all)"


def _frames_by_day(spark, sf_dir):
    return ticks(spark, sf_dir).groupBy("symbol", F.col("dt").alias("minute"), "vendor").agg(F.count("*").alias("frames"))


_SELECT = f"""{_FR}, ks as (select symbol, minute, coalesce(max(frames) filter (vendor = 'ls'), 0) as fp, coalesce(count(*) filter (vendor not in ('kiwoom')), 0) > 0 as single, coalesce(count(*) filter (vendor not in ('toss', 'kiwoom')), 0) > 0 as clear_one from fr group by all),
se as (select fr.symbol, fr.minute, vendor, frames from fr join ks using (symbol, minute) where vendor <> 'ls' and (vendor <> 'kiwoom' or not single) and (vendor <> 'toss' or not (clear_one or (vendor = 'kiwoom' and not single)))),
be as (select symbol, minute, max(frames) as bf, min(vendor) as bv from (select *, row_number() over (partition by symbol, minute order by frames desc, vendor) as n from se) where n = 1 group by all),
dm as (select symbol, '2024-01-10' as demoted_at from ticks where symbol like '%4' group by 1),
de as (select symbol, minute, fp, bf, bv, coalesce(bv is not null and minute >= demoted_at and bf >= 1, false) as forced, coalesce(bf >= fp + 2, false) as better from ks left join be using (symbol, minute) left join dm using (symbol)),
sel as (select symbol, minute, case when forced or better then bv else 'ls' end as selected_vendor, 'ls' as primary_vendor, case when forced then 'demoted' when better and fp = 0 then 'secondary_only' when better then 'primary_gap' when fp >= 1 then 'primary_ok' else 'no_better_source' end as reason, fp as frames_primary, case when forced or better then bf else fp end as frames_selected, coalesce((forced or better) and bv = 'kiwoom', false) as mixed_venue from de)"""


def _selected(spark, sf_dir):
    frames = _frames_by_day(spark, sf_dir)
    demoted = frames.where(F.col("symbol").like("%4")).select("symbol").distinct().withColumn("demoted_at", F.lit("2024-01-10"))
    return r.select_minutes(frames, "ls", demoted, min_frames=1, advantage=2, conflated=("toss",), mixed=("kiwoom",))


@register("o15_select_minutes", f"with {_SELECT} select * from sel")
def o15_select_minutes(spark, sf_dir):
    return _selected(spark, sf_dir)


@register("o16_selection_summary", f"with {_SELECT} select selected_vendor, reason, count(*) as minutes, cast(sum(frames_selected) as bigint) as frames, count(distinct symbol) as symbols from sel group by all")
def o16_selection_summary(spark, sf_dir):
    return _selected(spark, sf_dir).groupBy("selected_vendor", "reason").agg(F.count("*").alias("minutes"), F.sum("frames_selected").alias("frames"), F.countDistinct("symbol").alias("symbols"))


#: A controller's log made of ticks: plans, demotions and admissions of four groups of symbols, which change from plan to plan.
_LOG = f"""{TICKS}, sy as (select distinct symbol from ticks),
lg as (select dt, seq, case when seq % 5 = 0 then 'group_plan' when seq % 29 = 1 then 'TRANSITION' when seq % 17 = 2 then 'ADMIT' else 'OTHER' end as kind, recv_wall_ns as wall, 'g' || (seq % 4)::varchar as "group", seq % 3 as turn,
  case when seq % 58 = 1 then 'DAY_DEMOTED' else 'RECOVERING' end as new, case when seq % 34 = 2 then 'active' else 'shadow' end as mode, case when seq % 7 = 0 then null else vendor || '-nxt:' || seq::varchar end as feed from ticks),
mem as (select "group", turn, s.symbol from (select distinct "group", turn from lg) join sy s on s.symbol::bigint % 4 = substr("group", 2)::bigint or s.symbol::bigint % 9 = turn),
pl as (select dt, "group", wall, seq, turn from lg where kind = 'group_plan'), tr as (select dt, "group", wall, seq from lg where kind = 'TRANSITION' and new = 'DAY_DEMOTED'),
pk as (select t.dt, t."group", t.wall, p.turn, row_number() over (partition by t.dt, t."group", t.seq order by p.wall <= t.wall desc, p.wall desc, p.seq) as k from tr t join pl p using (dt, "group")),
dem as (select dt, symbol, min(wall) as demoted_at from pk join mem using ("group", turn) where k = 1 group by all),
win as (select distinct l.dt, regexp_replace(split_part(feed, ':', 1), '-nxt$', '') as vendor, symbol, wall as start, epoch_ns(strptime(l.dt || ' 15:20', '%Y-%m-%d %H:%M')) as "end" from lg l join mem using ("group", turn) where kind = 'ADMIT' and mode = 'active' and feed is not null)"""


def _controller_log(spark, sf_dir):
    """The log with names of lists, the closes of its days, and the members of the lists."""
    rows, seq = ticks(spark, sf_dir), F.col("seq")
    named = rows.select("symbol").distinct().select("symbol", F.col("symbol").cast("long").alias("n"))
    name = lambda g, turn: F.concat_ws("/", g.cast("string"), turn.cast("string"))
    group, turn = seq % 4, seq % 3
    turns = rows.select(group.alias("g"), turn.alias("turn")).distinct()
    members = named.join(F.broadcast(turns), (F.col("n") % 4 == F.col("g")) | (F.col("n") % 9 == F.col("turn"))).select(name(F.col("g"), F.col("turn")).alias("list"), "symbol")
    kind = F.when(seq % 5 == 0, "group_plan").when(seq % 29 == 1, "TRANSITION").when(seq % 17 == 2, "ADMIT").otherwise("OTHER")
    log = rows.select("dt", "seq", kind.alias("kind"), F.col("recv_wall_ns").alias("wall"), F.concat(F.lit("g"), group.cast("string")).alias("group"), name(group, turn).alias("list"), F.when(seq % 58 == 1, "DAY_DEMOTED").otherwise("RECOVERING").alias("new"), F.when(seq % 34 == 2, "active").otherwise("shadow").alias("mode"), F.when(seq % 7 != 0, F.concat("vendor", F.lit("-nxt:"), seq.cast("string"))).alias("feed"))
    closes = rows.select("dt").distinct().withColumn("close_wall", F.unix_micros(F.to_timestamp(F.concat("dt", F.lit(" 15:20")))) * 1000)
    return log, closes, members


@register("o14_demotions", f"with {_LOG} select * from dem")
def o14_demotions(spark, sf_dir):
    return f.controller_windows(*_controller_log(spark, sf_dir))[0]


@register("o14_admission_windows", f"with {_LOG} select * from win")
def o14_admission_windows(spark, sf_dir):
    return f.controller_windows(*_controller_log(spark, sf_dir))[1]


#: Frames by hour on two venues and kinds; toss conflates, kiwoom mixes venues and has no books.
_FEEDS = f"""{_LOG}, mi as (select dt, substr(hms, 1, 2) as minute, epoch_ns(strptime(dt || ' ' || substr(hms, 1, 2), '%Y-%m-%d %H')) as moment, symbol, vendor, case when seq % 3 = 0 then 'nxt' else 'krx' end as venue, case when seq % 2 = 0 then 'book' else 'tick' end as kind from ticks),
fr as (select dt, venue, kind, symbol, minute, moment, vendor, count(*) as frames from mi where vendor <> 'kiwoom' group by all), un as (select dt, symbol, minute, moment, vendor, count(*) as frames from mi where vendor = 'kiwoom' group by all),
pr as (select * from (values ('krx', 'ls'), ('nxt', 'kis')) t(venue, primary_vendor)),
ca as (select * from fr union all select dt, venue, 'tick', symbol, minute, moment, vendor, frames from un, pr), ro as (select distinct dt, venue, kind from fr join pr using (venue) where vendor = primary_vendor),
rw as (select ca.*, primary_vendor, vendor = primary_vendor as own, (dt, vendor) not in (select (dt, vendor) from win) or exists (select 1 from win w where w.dt = ca.dt and w.vendor = ca.vendor and w.symbol = ca.symbol and ca.moment >= w.start and ca.moment < w."end") as inside from ca join pr using (venue) join ro using (dt, venue, kind)),
e1 as (select *, max((own or inside) and vendor <> 'kiwoom') over k as single from rw window k as (partition by dt, venue, kind, symbol, minute)), e2 as (select *, (own or inside) and (own or vendor <> 'kiwoom' or not single) as ok from e1),
e3 as (select *, max(ok and (kind <> 'tick' or vendor <> 'toss')) over k as lossless from e2 window k as (partition by dt, venue, kind, symbol, minute)),
e4 as (select *, ok and not own and (kind <> 'tick' or vendor <> 'toss' or not lossless) as can from e3),
be as (select dt, venue, kind, symbol, minute, min(moment) as moment, min(primary_vendor) as primary_vendor, coalesce(max(frames) filter (own), 0) as fp, max(frames) filter (can) as bf from e4 group by all),
bv as (select be.*, min(e4.vendor) as bv from be left join e4 on e4.dt = be.dt and e4.venue = be.venue and e4.kind = be.kind and e4.symbol = be.symbol and e4.minute = be.minute and can and frames = bf group by all),
de as (select bv.*, coalesce(bv is not null and moment >= demoted_at and bf >= 1, false) as forced, coalesce(bf >= fp + 2, false) as better from bv left join dem using (dt, symbol)),
sel as (select dt, venue, kind, symbol, minute, case when forced or better then bv else primary_vendor end as selected_vendor, primary_vendor, case when forced then 'demoted' when better and fp = 0 then 'secondary_only' when better then 'primary_gap' when fp >= 1 then 'primary_ok' else 'no_better_source' end as reason,
  fp as frames_primary, case when forced or better then bf else fp end as frames_selected, coalesce(kind = 'tick' and (forced or better) and bv = 'kiwoom', false) as mixed_venue from de)"""
_PRIMARY = {"krx": "ls", "nxt": "kis"}


def _feeds(spark, sf_dir):
    seq = F.col("seq")
    rows = ticks(spark, sf_dir).withColumns({"minute": F.substring("hms", 1, 2), "venue": F.when(seq % 3 == 0, "nxt").otherwise("krx"), "kind": F.when(seq % 2 == 0, "book").otherwise("tick")})
    rows = rows.withColumn("moment", F.unix_micros(F.to_timestamp(F.concat("dt", F.lit(" "), "minute"), "yyyy-MM-dd HH")) * 1000)
    count = F.count("*").alias("frames")
    log, closes, members = _controller_log(spark, sf_dir)
    frames = staged(rows.where("vendor <> 'kiwoom'").groupBy("dt", "venue", "kind", "symbol", "minute", "moment", "vendor").agg(count), "frames")
    unified = staged(rows.where("vendor = 'kiwoom'").groupBy("dt", "symbol", "minute", "moment", "vendor").agg(count), "unified")
    return frames, unified, f.feed_selection(frames, unified, log, closes, _PRIMARY, "moment", ("toss",), ("kiwoom",), 1, 2, members)


@register("o16_feed_selection", f"with {_FEEDS} select * from sel")
def o16_feed_selection(spark, sf_dir):
    return _feeds(spark, sf_dir)[2]


@register("o16_reasons", f"with {_FEEDS}, d as (select dt, count(*) as rows, count(distinct symbol) filter (reason <> 'primary_ok') as symbols_affected from sel group by 1) select dt, reason, count(*) as minutes, rows, symbols_affected from sel join d using (dt) group by all")
def o16_reasons(spark, sf_dir):
    return f.selection_summary(_feeds(spark, sf_dir)[2])


@register(
    "o16_vendor_stats",
    f"""with {_FEEDS}, b as (select dt, vendor, kind, minute, frames from fr union all select dt, vendor, 'tick', minute, frames from un), s as (select dt, selected_vendor as vendor, count(*) filter (kind = 'tick' and selected_vendor = 'toss') as c, count(*) filter (mixed_venue) as m from sel group by all)
select dt, vendor, cast(coalesce(sum(frames) filter (kind = 'tick'), 0) as bigint) as tick_frames, cast(coalesce(sum(frames) filter (kind = 'book'), 0) as bigint) as book_frames, count(distinct minute) as minutes_with_frames, coalesce(any_value(c), 0) as conflated_selected_minutes, coalesce(any_value(m), 0) as mixed_selected_minutes from b left join s using (dt, vendor) group by dt, vendor""",
)
def o16_vendor_stats(spark, sf_dir):
    frames, unified, selected = _feeds(spark, sf_dir)
    return f.vendor_stats(frames, unified, selected, ("toss",))


_AV = f"{TICKS}, av as (select dt, vendor, count(distinct substr(hms, 1, 4)) as minutes, count(*) filter (lost) as disconnects, max(cvolume) as lag_max from ticks group by all), fq as (select *, round_even(least(1.0, minutes / 90::double), 4) as availability from av)"


def _quality(spark, sf_dir):
    days = ticks(spark, sf_dir).groupBy("dt", "vendor").agg(F.countDistinct(F.substring("hms", 1, 4)).alias("minutes"), F.count_if("lost").alias("disconnects"), F.max("cvolume").alias("lag_max"))
    return r.feed_quality(days, 90)


@register("a20_feed_quality", f"with {_AV} select * from fq")
def a20_feed_quality(spark, sf_dir):
    return _quality(spark, sf_dir)


@register("a21_days_below", f"with {_AV}, nd as (select dt, row_number() over (order by dt desc) as d from (select distinct dt from av)), lo as (select vendor, d, row_number() over (partition by vendor order by d) as n from fq join nd using (dt) where availability < 0.8) select v.vendor, count(lo.n) as days_below from (select distinct vendor from fq) v left join lo on lo.vendor = v.vendor and lo.n = lo.d group by 1")
def a21_days_below(spark, sf_dir):
    quality = _quality(spark, sf_dir)
    return r.trailing_days_below(quality, quality, 0.8)


@register("j6_visible_from", f"with {TICKS}, v as (select symbol, case when symbol like '%2' then null else min(recv_wall_ns) + 86400000000000 end as visible_at from ticks group by symbol) select seq from (select seq, symbol, case when seq % 9 = 0 then null else recv_wall_ns end as moment from ticks) join v using (symbol) where visible_at is null or moment >= visible_at")
def j6_visible_from(spark, sf_dir):
    rows = ticks(spark, sf_dir)
    visibility = rows.groupBy("symbol").agg((F.min("recv_wall_ns") + 86_400_000_000_000).alias("v")).select("symbol", F.when(~F.col("symbol").like("%2"), F.col("v")).alias("visible_at"))
    return r.visible_from(rows.withColumn("at", F.when(F.col("seq") % 9 != 0, F.col("recv_wall_ns"))), visibility, "at").select("seq")


@register("w7_mixed_seconds", f"with {TICKS}, s as (select seq, symbol, case when seq % 11 <> 0 then dt end as second, vendor as venue from ticks) select seq, case when second is not null then min(venue) over (partition by symbol, second) <> max(venue) over (partition by symbol, second) end as mixed from s")
def w7_mixed_seconds(spark, sf_dir):
    return r.venue_mixed_seconds(ticks(spark, sf_dir).select("seq", "symbol", F.when(F.col("seq") % 11 != 0, F.col("dt")).alias("second"), F.col("vendor").alias("venue"))).select("seq", "mixed")


@register("a22_visibility", f"with {TICKS} select symbol, min(case when vendor <> 'toss' then recv_wall_ns end) as visible_at from ticks group by symbol")
def a22_visibility(spark, sf_dir):
    return ticks(spark, sf_dir).groupBy("symbol").agg(F.min(F.when(F.col("vendor") != "toss", F.col("recv_wall_ns"))).alias("visible_at"))
