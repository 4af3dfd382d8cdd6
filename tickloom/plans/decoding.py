"""Queries of the decoders, phases and row-level predicates; payloads are built from the tick adapter by the same text expression in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import scalars as s
from tickloom.functions.scalars import div
from tickloom.operators import decode as d
from tickloom.operators import phase as p
from tickloom.plans.registry import COUNTED, register
from tickloom.sources.adapters import counted_ticks


def _text(x: str) -> str:
    return f"cast({x} as string)"


#: Payload expressions that both engines read; every 17th is malformed.
_TOKENS = ["symbol", "hms", _text("price"), "case when seq % 2 = 0 then '2' else '5' end", "case when seq % 3 = 0 then '-' else '' end || " + _text("seq % 50"), "'1.25'", *["'0'"] * 6, _text("cvolume"), _text("volume"), "'0'", _text("cum"), _text("cum + 1"), *["''"] * 4, "case seq % 3 when 0 then '1' when 1 then '5' else '3' end", *["''"] * 12, "case when seq % 4 = 0 then '' else '20' end", "case when seq % 5 = 0 then 'Y' else 'N' end", *["''"] * 9, "case when seq % 6 = 0 then '0' else " + _text("price") + " end", "''"]
KIS_TICK = f"case when seq % 17 = 0 then 'a^b' else concat_ws('^', {', '.join(_TOKENS)}) end"
_ASK = [_text(f"price + {k + 1}") for k in range(10)]
_BID = [_text(f"price - {k}") for k in range(10)]
_REM = [_text(f"(seq + {k}) % 9") for k in range(20)]
_QUOTE = ["symbol", "hms", "case seq % 3 when 0 then 'C' when 1 then '0' else '' end", *_ASK, *_BID, *_REM, "'40'", "'90'", "''", "''", _text("price"), _text("seq % 7"), *["''"] * 14]
KIS_QUOTE = f"case when seq % 17 = 0 then 'a^b' else concat_ws('^', {', '.join(_QUOTE)}) end"


def _json(fields: dict[str, str]) -> str:
    inner = " || ',' || ".join(f"'\"{k}\":\"' || {v} || '\"'" for k, v in fields.items())
    return "'{\"header\":{\"tr_cd\":\"X\"},\"body\":{' || " + inner + " || '}}'"


_LS = {"shcode": "symbol", "price": _text("price"), "cvolume": _text("cvolume"), "volume": _text("volume"), "change": _text("seq % 50"), "sign": "'2'", "drate": "'0.5'", "chetime": "hms", "mdchecnt": _text("cum"), "mschecnt": "'1'", "cgubun": "case when seq % 2 = 0 then '+' else '-' end"}
LS_TICK = f"case when seq % 17 = 0 then '{{bad' else {_json(_LS)} end"
_DB = {"ShrnIscd": "symbol", "StckPrpr": _text("price"), "CntgVol": _text("cvolume"), "AcmlVol": _text("volume"), "PrdyVrss": "'-' || " + _text("seq % 50"), "PrdyVrsssign": "'5'", "PrdyCtrt": "'-0.5'", "SelnCntgcsnu": _text("cum"), "ShnuCntgcsnu": "'1'"}
DB_TICK = f"case when seq % 17 = 0 then '{{bad' else {_json(_DB)} end"
TOSS_TICK = "case when seq % 17 = 0 then 'x' else '{\"type\":\"message\",\"topic\":\"trade:kr:' || symbol || '\",\"data\":{\"price\":\"' || cast(price as string) || '\",\"volume\":\"' || cast(cvolume as string) || '\"}}' end"


def _frames(spark: SparkSession, sf_dir: str, raw: str) -> DataFrame:
    return counted_ticks(spark, sf_dir).withColumn("raw", F.expr(raw))


def _with(raw: str) -> str:
    return f"with {COUNTED}, f as (select *, {raw} as raw from counted)"


def _at(i: int, least: int = 17) -> str:
    return f"case when len(string_split(raw, '^')) >= {least} then string_split(raw, '^')[{i + 1}] end"


@register("p1_kis_ticks", f"{_with(KIS_TICK)} select seq, {', '.join((f'regexp_replace({_at(i)}, $$^-$$, $$$$)' if n == 'change_raw' else _at(i)) + f' as {n}' for n, i in d.KIS_TICK.items())} from f")
def p1_kis_ticks(spark, sf_dir):
    return d.kis_ticks(_frames(spark, sf_dir, KIS_TICK)).select("seq", *d.TICK_FIELDS)


def _quote_columns() -> str:
    cols = [f"{_at(0, 45)} as shcode"] + [f"try_cast({_at(d.KIS_QUOTE[n], 45)} as int) as {n}" for n in ("hotime", "totofferrem", "totbidrem")]
    cols += [f"try_cast({_at(d.KIS_QUOTE[q] + k - 1, 45)} as int) as {q}{k}" for q in ("offerho", "bidho", "offerrem", "bidrem") for k in range(1, 11)]
    return ", ".join(cols)


@register("p1_kis_quotes", f"{_with(KIS_QUOTE)} select seq, {_quote_columns()} from f")
def p1_kis_quotes(spark, sf_dir):
    return d.kis_quotes(_frames(spark, sf_dir, KIS_QUOTE)).select("seq", *d.QUOTE_FIELDS)


def _body(name: str) -> str:
    return f"case when json_valid(raw) then json_extract_string(raw, '$.body.{name}') end"


@register("p2_ls_ticks", f"{_with(LS_TICK)} select seq, {', '.join(f'{_body(v)} as {k}' for k, v in d.LS_TICK.items())} from f")
def p2_ls_ticks(spark, sf_dir):
    return d.ls_ticks(_frames(spark, sf_dir, LS_TICK)).select("seq", *d.TICK_FIELDS)


@register("p3_db_ticks", f"{_with(DB_TICK)} select seq, {', '.join((f'regexp_replace({_body(v)}, $$^-$$, $$$$)' if k == 'change_raw' else _body(v)) + f' as {k}' for k, v in d.DB_TICK.items())} from f")
def p3_db_ticks(spark, sf_dir):
    return d.db_ticks(_frames(spark, sf_dir, DB_TICK)).select("seq", *d.TICK_FIELDS)


@register("p4_toss_ticks", f"{_with(TOSS_TICK)} select seq, case when json_valid(raw) then nullif(regexp_extract(json_extract_string(raw, '$.topic'), '^trade:kr:(.+)$', 1), '') end as shcode, case when json_valid(raw) then json_extract_string(raw, '$.data.price') end as price_raw, case when json_valid(raw) then json_extract_string(raw, '$.data.volume') end as cvolume_raw from f")
def p4_toss_ticks(spark, sf_dir):
    return d.toss_ticks(_frames(spark, sf_dir, TOSS_TICK)).select("seq", "shcode", "price_raw", "cvolume_raw")


_BOOK = "case when seq % 17 = 0 then 'x' else '{\"topic\":\"orderbook:kr:' || symbol || '\",\"data\":{\"timestamp\":\"2024-03-05T0' || cast(seq % 10 as string) || ':15:30+09:00\",\"asks\":[{\"price\":\"' || cast(price as string) || '\",\"volume\":\"3\"}],\"bids\":[{\"price\":\"' || cast(price - 5 as string) || '\",\"volume\":\"' || cast(cvolume as string) || '\"},{\"price\":\"1\",\"volume\":\"2\"}]}}' end"


def _level(side: str, k: int, field: str) -> str:
    return f"case when json_valid(raw) then coalesce(try_cast(json_extract_string(raw, '$.data.{side}[{k}].{field}') as int), 0) end"


@register("p4_toss_quotes", f"{_with(_BOOK)} select seq, case when json_valid(raw) then nullif(regexp_extract(json_extract_string(raw, '$.topic'), '^orderbook:kr:(.+)$', 1), '') end as shcode, case when json_valid(raw) then cast((seq % 10) * 10000 + 1530 as int) end as hotime, {_level('asks', 0, 'price')} as offerho1, {_level('asks', 1, 'price')} as offerho2, {_level('bids', 1, 'volume')} as bidrem2, {_level('bids', 0, 'volume')} as bidrem1 from f")
def p4_toss_quotes(spark, sf_dir):
    return d.toss_quotes(_frames(spark, sf_dir, _BOOK)).select("seq", "shcode", "hotime", "offerho1", "offerho2", "bidrem2", "bidrem1")


_KIWOOM = "'{\"item\":\"' || symbol || '\",\"values\":{\"10\":\"-' || cast(price as string) || '\",\"15\":\"+' || cast(cvolume as string) || '\",\"13\":\"' || cast(volume as string) || '\",\"20\":\"' || hms || '\"}}'"
_ANY = f"case vendor when 'kis' then {KIS_TICK} when 'kiwoom' then {_KIWOOM} else {LS_TICK} end"


@register("p5_audit_body", f"{_with(_ANY)} select seq, vendor, case when bad then null else symbol end as shcode, case when bad then null else hms end as chetime, case when bad then null else price end as price, case when bad then null else cvolume end as cvolume, case when bad then null else volume end as volume from (select *, seq % 17 = 0 and vendor <> 'kiwoom' as bad from f)")
def p5_audit_body(spark, sf_dir):
    return d.audit_body(_frames(spark, sf_dir, _ANY)).select("seq", "vendor", "shcode", "chetime", "price", "cvolume", "volume")


_FOUR = f"case vendor when 'kis' then {KIS_TICK} when 'db' then {DB_TICK} when 'toss' then {TOSS_TICK} else {LS_TICK} end"


@register("p6_decode_by_vendor", f"{_with(_FOUR)} select case when vendor = 'kiwoom' then 'ls' else vendor end as vendor, count(*) as n, count(case when seq % 17 <> 0 then symbol end) as decoded, sum(case when seq % 17 <> 0 then price end)::bigint as price from f group by 1")
def p6_decode_by_vendor(spark, sf_dir):
    frames = _frames(spark, sf_dir, _FOUR).withColumn("vendor", F.when(F.col("vendor") == "kiwoom", None).otherwise(F.col("vendor")))
    return d.decode(frames).groupBy("vendor").agg(F.count("*").alias("n"), F.count("shcode").alias("decoded"), F.sum(F.col("price_raw").try_cast("long")).alias("price"))


_STREAM = "case seq % 4 when 0 then 'H0STCNT0' when 1 then 'H0NXCNT0' when 2 then 'H0STASP0' else 'OTHER' end"
_VENUE = "case seq % 2 when 0 then 'krx' else 'nxt' end"
_GIVEN = "case when seq % 5 = 0 then '' when seq % 7 = 0 then '256199' else hms end"
_TIME = "coalesce(nullif(given, ''), case when stream in ('H0STCNT0', 'H0NXCNT0') then regexp_extract(raw, '\"chetime\"\\s*:\\s*\"([^\"]*)\"', 1) when stream = 'H0STASP0' then regexp_extract(raw, '\"hotime\"\\s*:\\s*\"([^\"]*)\"', 1) end, '')"


def _phase_sql(windows) -> str:
    kinds = {"trade": "stream in ('H0STCNT0', 'H0NXCNT0')", None: "true"}
    cases = " ".join(f"when venue = '{v}' and {kinds[k]} and t >= '{a}' and t < '{b}' then '{name}'" for v, k, a, b, name in windows)
    return f"case when not regexp_matches(t, '^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]$') or stream = 'OTHER' then 'unclassified' {cases} else 'unclassified' end"


_PHASED = f"{_with(LS_TICK)}, g as (select seq, raw, {_STREAM} as stream, {_VENUE} as venue, {_GIVEN} as given from f), h as (select *, {_TIME} as t from g)"


def _phase_frames(spark, sf_dir):
    return _frames(spark, sf_dir, LS_TICK).withColumns({"stream": F.expr(_STREAM), "venue": F.expr(_VENUE), "exchange_event_time": F.expr(_GIVEN)})


@register("p7_event_time", f"{_PHASED} select seq, t as event_time from h")
def p7_event_time(spark, sf_dir):
    return _phase_frames(spark, sf_dir).select("seq", p.event_time(F.col("stream"), F.col("raw"), F.col("exchange_event_time")).alias("event_time"))


@register("p8_market_phase", f"{_PHASED} select seq, {_phase_sql(p.WINDOWS)} as market_phase from h")
def p8_market_phase(spark, sf_dir):
    return p.annotate_market_phase(_phase_frames(spark, sf_dir)).select("seq", "market_phase")


@register("p9_annotate_legacy", f"{_with(LS_TICK)}, h as (select seq, {_STREAM} as stream, 'krx' as venue, case when {_STREAM} in ('H0STCNT0', 'H0NXCNT0') and seq % 17 <> 0 then hms else '' end as t from f) select seq, t as exchange_event_time, {_phase_sql(p.WINDOWS)} as market_phase from h")
def p9_annotate_legacy(spark, sf_dir):
    return p.annotate_market_phase(_frames(spark, sf_dir, LS_TICK).withColumn("tr_id", F.expr(_STREAM))).select("seq", "exchange_event_time", "market_phase")


@register("p10_shifted_phase", f"{_PHASED} select seq, {_phase_sql((('krx', 'trade', '093000', '094000', 'pre_closing_price'), ('krx', None, '093000', '100000', 'opening_auction'), ('krx', None, '100000', '155000', 'regular'), ('krx', None, '155000', '161000', 'closing_auction'), ('krx', None, '161000', '163000', 'post_closing_price'), ('krx', None, '163000', '200000', 'aftermarket'), ('nxt', None, '090000', '095000', 'premarket'), ('nxt', None, '100000', '155000', 'regular'), ('nxt', None, '161000', '200000', 'aftermarket')))} as market_phase from h")
def p10_shifted_phase(spark, sf_dir):
    return p.annotate_market_phase(_phase_frames(spark, sf_dir), p.windows_for(3600, 1800)).select("seq", "market_phase")


@register("p11_microstructure", f"{_with(KIS_TICK)} select seq, case when bad then null when seq % 3 = 0 then 'buy' when seq % 3 = 1 then 'sell' end as initiator, case when not bad then seq % 5 = 0 end as trading_halted, case when not bad and seq % 4 <> 0 then '20' end as mkop_code, case when not bad and seq % 6 <> 0 and price > 0 then price end as vi_base_price from (select *, seq % 17 = 0 as bad from f)")
def p11_microstructure(spark, sf_dir):
    frames = _frames(spark, sf_dir, KIS_TICK).withColumns({"vendor": F.lit("kis"), "stream": F.lit("H0STCNT0")})
    return p.annotate_microstructure(frames).select("seq", "initiator", "trading_halted", "mkop_code", "vi_base_price")


@register("p11_microstructure_quotes", f"{_with(KIS_QUOTE)} select seq, case when not bad and seq % 3 <> 2 then case seq % 3 when 0 then 'C' else '0' end end as hour_cls_code, case when not bad then seq % 3 = 0 end as single_price, case when not bad then seq % 3 = 0 end as vi_active, case when not bad and price > 0 then price end as expected_price, case when not bad and seq % 7 > 0 then seq % 7 end as expected_qty from (select *, seq % 17 = 0 as bad from f)")
def p11_microstructure_quotes(spark, sf_dir):
    frames = _frames(spark, sf_dir, KIS_QUOTE).withColumns({"vendor": F.lit("kis"), "stream": F.lit("H0STASP0")})
    return p.annotate_microstructure(frames).select("seq", "hour_cls_code", "single_price", "vi_active", "expected_price", "expected_qty")


@register("p13_short_codes", f"with {COUNTED} select seq, seq % 3 <> 0 as ok from counted")
def p13_short_codes(spark, sf_dir):
    return counted_ticks(spark, sf_dir).select("seq", s.is_short_code(F.when(F.col("seq") % 3 == 0, F.concat("symbol", F.lit("-"))).otherwise(F.col("symbol"))).alias("ok"))


@register("p16_auction_exempt", f"with {COUNTED}, q as (select seq, case seq % 4 when 0 then 'opening_auction' when 1 then 'regular' when 2 then 'unclassified' end as phase, case when seq % 3 = 0 then '' else hms end as t, cast(hms as int) as hotime from counted) select seq, coalesce(phase = 'opening_auction', false) or ((phase is null or (phase = 'unclassified' and t = '')) and ((hotime >= 83000 and hotime < 90000) or (hotime >= 152000 and hotime < 153000))) as exempt from q")
def p16_auction_exempt(spark, sf_dir):
    rows = counted_ticks(spark, sf_dir).withColumns({"phase": F.expr("case seq % 4 when 0 then 'opening_auction' when 1 then 'regular' when 2 then 'unclassified' end"), "t": F.expr("case when seq % 3 = 0 then '' else hms end")})
    return rows.select("seq", p.auction_exempt(F.col("phase"), F.col("t"), F.col("hms").cast("int")).alias("exempt"))


@register("p18_delivery_lag", f"with {COUNTED}, q as (select seq, (recv_wall_ns // 1000000000 + 9 * 3600) % 86400 as r, cast(substr(hms, 1, 2) as int) * 3600 + cast(substr(hms, 3, 2) as int) * 60 + cast(substr(hms, 5, 2) as int) + 32400 - (seq % 200) as e from counted), l as (select seq, r - (e % 86400) as lag from q) select seq, cast(case when seq % 12 <> 0 and lag >= -60 then greatest(lag, 0) end as bigint) as lag_s from l")
def p18_delivery_lag(spark, sf_dir):
    event = s.hms_of((s.seconds_of(F.col("hms")) + 32400 - F.col("seq") % 200) % 86400)
    whole = div(F.col("recv_wall_ns"), 1_000_000_000) * 1_000_000_000
    # every third frame has no time of its own, so its payload's counts; every twelfth has none at all
    given = F.when(F.col("seq") % 3 != 0, event).otherwise(F.when(F.col("seq") % 2 == 0, ""))
    raw = F.when(F.col("seq") % 12 == 0, "{}").otherwise(F.concat(F.lit('{"body": {"chetime" : "'), event, F.lit('"}}')))
    return counted_ticks(spark, sf_dir).select("seq", p.delivery_lag(whole, p.event_stamp(given, raw)).cast("long").alias("lag_s"))


_STEPS = "case " + " ".join(f"when price >= {a} then {b}" for a, b in s.TICK_TABLE) + " end"


@register("p19_price_steps", f"with {COUNTED} select seq, case when price >= 1 then {_STEPS} end as step, coalesce(price >= 1 and price % ({_STEPS}) = 0, false) as aligned from (select seq, price * 37 as price from counted)")
def p19_price_steps(spark, sf_dir):
    price = F.col("price") * 37
    return counted_ticks(spark, sf_dir).select("seq", s.tick_of(price).alias("step"), s.is_tick_aligned(price).alias("aligned"))


@register("p20_envelopes", f"with {COUNTED}, g as (select seq, unnest(range(0, 1 + seq % 3)) as r, symbol, price from counted where seq % 11 <> 0) select seq, cast(r as int) as row, 'H0STCNT0' as tr_id, symbol || '^' || (price + r)::varchar as frame from g")
def p20_envelopes(spark, sf_dir):
    body = F.array_join(F.transform(F.sequence(F.lit(0), F.col("seq") % 3), lambda r: F.concat(F.col("symbol"), F.lit("^"), (F.col("price") + r).cast("string"))), "^")
    raw = F.concat(F.lit("0|H0STCNT0|"), F.when(F.col("seq") % 11 == 0, "9").otherwise((F.col("seq") % 3 + 1).cast("string")), F.lit("|"), body)
    return d.kis_envelope(counted_ticks(spark, sf_dir).withColumn("raw", raw), 2).select("seq", "row", "tr_id", "frame")


@register("f13_session_state", f"with {COUNTED} select seq, case when hms >= '200000' then 'closed' when hms >= '160000' then 'aftermarket' when hms >= '153000' then 'post_close' when hms >= '152000' then 'closing_auction' when hms >= '090000' then 'regular' when hms >= '085000' then 'pre_open' when hms >= '080000' then 'premarket' else 'closed' end as state from counted")
def f13_session_state(spark, sf_dir):
    return counted_ticks(spark, sf_dir).select("seq", p.session_state(F.col("hms")).alias("state"))
