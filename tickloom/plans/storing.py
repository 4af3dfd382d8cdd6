"""Queries of sources and sinks: tables are written to a scratch folder by the operators and read again."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import zfill
from tickloom.operators.dedup import first_of_key
from tickloom.plans.registry import BARS, TICKS, register, table
from tickloom.sources import l0, store
from tickloom.sources.adapters import daily_bars, ticks
from tickloom.sources.scratch import scratch, staged

_FRAMES = f"{TICKS}, fr as (select 'P' || price::varchar as raw, recv_wall_ns, recv_wall_ns as recv_mono_ns, conn_id, seq as conn_seq, vendor, case when seq % 4 = 0 then null else symbol end as symbol, case when vendor = 'toss' then 'nxt' else 'krx' end as venue, 'H0STCNT0' as stream, dt from ticks)"


def _frames(spark, sf_dir):
    none = F.lit(None).cast("string")
    return ticks(spark, sf_dir).select(F.concat(F.lit("P"), F.col("price").cast("string")).alias("raw"), F.col("recv_wall_ns").alias("recv_mono_ns"), "recv_wall_ns", "conn_id", F.col("seq").alias("conn_seq"), "vendor", F.lit("H0STCNT0").alias("tr_id"), none.alias("venue"), none.alias("session"), none.alias("stream"), F.when(F.col("seq") % 4 != 0, F.col("symbol")).alias("symbol"), none.alias("exchange_event_time"), "dt")


def _write_l0(spark, sf_dir) -> str:
    """Frames as line files under vendor/venue/session/stream/dt=..."""
    path = scratch(spark, "l0")
    rows = _frames(spark, sf_dir)
    for vendor in ("ls", "kis", "db", "toss", "kiwoom"):
        venue = "nxt" if vendor == "toss" else "krx"
        rows.where(F.col("vendor") == vendor).write.partitionBy("dt").option("compression", "gzip").json(f"{path}/{vendor}/{venue}/regular/H0STCNT0")
    return path


@register("s1_read_l0", f"with {_FRAMES} select raw, recv_wall_ns, conn_seq, vendor, venue, 'regular' as session, stream, coalesce(symbol, '') as symbol, '' as exchange_event_time from fr")
def s1_read_l0(spark, sf_dir):
    return l0.read_strict(spark, _write_l0(spark, sf_dir)).select("raw", "recv_wall_ns", "conn_seq", "vendor", "venue", "session", "stream", "symbol", "exchange_event_time")


@register("s4_routes", f"with {TICKS} select seq, case when seq % 3 > 0 then vendor end as vendor, case when seq % 3 = 0 then 'krx' else 'nxt' end as venue, case when seq % 3 = 0 then 'regular' else 'aftermarket' end as session, 'H0NXCNT0' as stream from ticks")
def s4_routes(spark, sf_dir):
    known = F.concat(F.lit("file:/x/"), "vendor", F.lit("/nxt/aftermarket/H0NXCNT0/dt="), "dt", F.lit("/09.jsonl"))
    legacy = F.concat(F.lit("file:/x/old/H0NXCNT0/dt="), "dt", F.lit("/09.jsonl"))
    path = F.when(F.col("seq") % 3 > 0, known).otherwise(legacy)
    r = l0.route(path)
    return ticks(spark, sf_dir).select("seq", *[r[n].alias(n) for n in ("vendor", "venue", "session", "stream")])


@register("s5_decode_envelopes", f"with {_FRAMES} select conn_seq, raw, recv_wall_ns from fr where conn_seq % 13 > 0 and conn_seq % 7 > 0")
def s5_decode_envelopes(spark, sf_dir):
    rows = _frames(spark, sf_dir)
    line = F.to_json(F.struct("raw", "recv_wall_ns", "conn_seq"))
    broken = F.when(F.col("conn_seq") % 13 == 0, F.lit('{"raw": ')).when(F.col("conn_seq") % 7 == 0, F.regexp_replace(line, '"recv_wall_ns":[0-9]+', '"recv_wall_ns":"x"')).otherwise(line)
    return l0.decode_envelopes(rows.select(broken.alias("value"))).select("conn_seq", "raw", "recv_wall_ns")


def _stored_bars(spark, sf_dir) -> tuple[str, T.StructType]:
    path = scratch(spark, "bars")
    rows = daily_bars(spark, sf_dir).select("date", "symbol", "close", "volume")
    store.write_months(rows, path)
    return path, rows.schema


@register("s6_scan_months", f"with {BARS} select date, symbol, close, volume from bars where date between date '1998-02-10' and date '1998-05-03'")
def s6_scan_months(spark, sf_dir):
    path, schema = _stored_bars(spark, sf_dir)
    return store.scan_months(spark, path, schema, "1998-02-10", "1998-05-03")


@register("s7_latest_date", f"with {BARS} select max(date) as latest from bars")
def s7_latest_date(spark, sf_dir):
    path, schema = _stored_bars(spark, sf_dir)
    return store.latest_date(spark, path, schema)


@register("s8_upsert", f"with {BARS} select date, symbol, close, case when day(date) % 4 = 0 then volume + 1 else volume end as volume from bars where day(date) % 2 = 0 or day(date) % 3 = 0")
def s8_upsert(spark, sf_dir):
    path = scratch(spark, "upsert")
    rows = daily_bars(spark, sf_dir).select("date", "symbol", "close", "volume")
    store.upsert_months(spark, path, rows.where("day(date) % 2 = 0"), ["date", "symbol"])
    new = rows.where("day(date) % 4 = 0 or day(date) % 3 = 0").withColumn("volume", F.when(F.expr("day(date) % 4 = 0"), F.col("volume") + 1).otherwise(F.col("volume")))
    store.upsert_months(spark, path, new, ["date", "symbol"])
    return store.scan_months(spark, path, rows.schema)


@register("s9_migrate", f"with {BARS} select count(*) as rows, 0::bigint as only_left, 0::bigint as only_right from bars")
def s9_migrate(spark, sf_dir):
    path, schema = _stored_bars(spark, sf_dir)
    legacy, moved = daily_bars(spark, sf_dir).select("date", "symbol", "close", "volume"), store.scan_months(spark, path, schema)
    keys = ["date", "symbol"]
    sides = [store.missing_keys(a, b, keys).agg(F.count("*").alias(n)) for a, b, n in ((legacy, moved, "only_left"), (moved, legacy, "only_right"))]
    return moved.agg(F.count("*").alias("rows")).join(sides[0]).join(sides[1])


@register("s14_footers", "select c as \"column\", 'ZSTD' as codec, c not in ('raw', 'exchange_event_time') as dictionary, 'v2' as encoding from (select unnest(['raw', 'exchange_event_time', 'vendor', 'conn_id']) as c)")
def s14_footers(spark, sf_dir):
    path = scratch(spark, "frames")
    frames = ticks(spark, sf_dir).select(F.to_json(F.struct("symbol", "price")).alias("raw"), F.col("hms").alias("exchange_event_time"), "vendor", "conn_id")
    store.write_frames(frames.repartition(2), path)
    return store.footers(spark, path).groupBy("column").agg(F.min("codec").alias("codec"), F.max("dictionary").alias("dictionary"), F.min("encoding").alias("encoding"))


@register("s15_reencode", f"with {TICKS}, n as (select count(*) as n from ticks where not lost) select 'first' as run, 3::bigint as rewritten, false as skipped, n as rows, 'reencoded' as status from n union all select 'second', 0, true, 0, 'already_v2' union all select 'one more', 1, true, n, 'reencoded' from n")
def s15_reencode(spark, sf_dir):
    """Three plain files are rewritten, a second run rewrites none of the new ones, and a plain file beside them alone."""
    plain, coded, again = (scratch(spark, n) for n in ("plain", "coded", "again"))
    rows = ticks(spark, sf_dir).where("not lost").withColumn("raw", F.to_json(F.struct("symbol", "price")))
    rows.repartition(3).write.parquet(plain)
    first = staged(store.reencode(spark, plain, coded), "first")
    second = store.reencode(spark, coded, again)
    rows.coalesce(1).write.mode("append").parquet(coded)
    runs = {"first": first, "second": second, "one more": store.reencode(spark, coded, again)}
    out = None
    for name, df in runs.items():
        row = df.select(F.lit(name).alias("run"), "rewritten", (F.col("already") > 0).alias("skipped"), "rows", "status")
        out = row if out is None else out.unionByName(row)
    return out


@register("s12_append_snapshot", "with c as (select conv_id, turn, role, length(text) as n, conv_id * 100 + turn as seq from conversations), s as (select *, 0 as o from c where turn % 2 = 0), b as (select conv_id, turn - turn % 2 as turn, role, n, seq, 1 as o from c where n >= 40), r as (select *, row_number() over (partition by conv_id, turn order by o, seq) as k from (select * from s union all select * from b)) select conv_id, turn, role, n, seq from r where k = 1")
def s12_append_snapshot(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"), (F.col("conv_id") * 100 + F.col("turn")).alias("seq"))
    batch = rows.withColumn("turn", F.col("turn") - F.col("turn") % 2)
    return store.append_snapshot(rows.where("turn % 2 = 0"), batch, ["conv_id", "turn"], F.col("n") < 40)


@register("s18_winning_run", f"with {TICKS}, n as (select symbol, vendor, count(*) as c from ticks group by all), w as (select symbol, vendor from (select *, row_number() over (partition by symbol order by c desc, vendor) as k from n) where k = 1) select t.symbol, t.vendor as run_id, t.seq from ticks t join w using (symbol, vendor)")
def s18_winning_run(spark, sf_dir):
    return store.winning_run(ticks(spark, sf_dir).select("symbol", F.col("vendor").alias("run_id"), "seq"))


@register("s19_ledger_attempts", f"with {TICKS} select symbol, dt as date, count(distinct vendor) as attempts from ticks group by all")
def s19_ledger_attempts(spark, sf_dir):
    path = scratch(spark, "ledger")
    rows = ticks(spark, sf_dir).select("symbol", F.col("dt").alias("date"), F.concat("vendor", F.lit("-"), F.col("seq").cast("string")).alias("run_id"))
    l0.json_lines(rows).write.text(path)
    # a file that ends within its only line
    spark.range(1).select(F.lit('{"symbol": "0000').alias("value")).write.mode("append").option("lineSep", " ").text(path)
    return store.ledger_attempts(l0.read_log(spark, path, "symbol string, date string, run_id string"))


@register("s20_trading_rows", "with p as (select p_partkey as k, p_size, cast(round(p_retailprice) as bigint) as price from part), c as (select k, price, case when p_size % 5 = 0 then 0 else p_size * 1000 end as volume from p) select lpad(k::varchar, 6, '0') as symbol, case when volume <> 0 then price - 10.0::double end as open, case when volume <> 0 then price + 20.0::double end as high, case when volume <> 0 then price - 20.0::double end as low, price::double as close, (price - (k % 9 - 4))::double as base_price, volume::bigint as volume, price * 1000 / 1e8::double as trade_value_100m, case when k % 3 = 0 then 'A' end as section from c")
def s20_trading_rows(spark, sf_dir):
    k, price = F.col("p_partkey"), F.round("p_retailprice").cast("long")
    text = lambda c: F.format_number(c, 0)
    symbol = zfill(k.cast("string"))
    part = table(spark, sf_dir, "part")
    rows = part.select(symbol.alias("symbol"), text(price - 10).alias("open"), text(price + 20).alias("high"), text(price - 20).alias("low"), text(price).alias("close"), (k % 9 - 4).cast("string").alias("diff"), text(F.when(F.col("p_size") % 5 == 0, 0).otherwise(F.col("p_size") * 1000)).alias("volume"), text(price * 1000).alias("value"))
    bars = store.trading_rows(rows, part.where("p_partkey % 3 = 0").select(symbol.alias("symbol"), F.lit("A").alias("section")))
    # keys of over six digits are cut in the result alone, so no two rows meet as one symbol
    return bars.withColumn("symbol", F.substring("symbol", 1, 6))


@register("s22_fallback_bars", f"with {BARS} select symbol, base_price, case when base_price = 0 then 0.0 else (close - base_price) * 100.0::double / base_price end as daily_change_pct from bars where date = date '1998-02-10'")
def s22_fallback_bars(spark, sf_dir):
    rows = daily_bars(spark, sf_dir).select("symbol", F.col("date").cast("string").alias("date"), "close", (F.col("close") - F.col("base_price")).alias("diff"))
    return store.fallback_bars(rows, "1998-02-10").select("symbol", "base_price", "daily_change_pct")


@register("s23_merge_news", "with m as (select max(page_id) as top from pages), p as (select page_id as news_id, (top - page_id) // 20 as page, (top - page_id) % 20 as pos, top from pages, m), st as (select news_id from p where 5 * news_id < 2 * top), k as (select min(page) as stop from p join st using (news_id)) select news_id, page, pos from p, k where news_id not in (select news_id from st) and (stop is null or page <= stop)")
def s23_merge_news(spark, sf_dir):
    n, ids = F.col("page_id"), table(spark, sf_dir, "pages").select("page_id")
    top = ids.agg(F.coalesce(F.max("page_id"), F.lit(0)).alias("top")).first().top
    pages = ids.select(n.alias("news_id"), F.floor((top - n) / 20).alias("page"), ((top - n) % 20).alias("pos"))
    return store.merge_news(pages.where(5 * F.col("news_id") < 2 * top).select("news_id"), pages)


_PATHS = f"{TICKS}, li as (select 'l0/' || vendor || '/dt=' || dt || '/' || substr(hms, 1, 2) || '.jsonl' as path, price * 997 as bytes from ticks)"


@register("s21_catalog", f"with {_PATHS}, t as (select regexp_replace(regexp_replace(path, 'dt=[^/]*', 'dt=*'), '/[0-9]{{2}}\\.', '/{{hh}}.') as template, bytes, nullif(regexp_extract(path, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), '') as d from li) select template, count(*) as files, cast(sum(bytes) as bigint) as bytes, count(*) filter (bytes < 65536) as small_files, min(d) as first_date, max(d) as last_date from t group by 1")
def s21_catalog(spark, sf_dir):
    path = F.concat(F.lit("l0/"), "vendor", F.lit("/dt="), "dt", F.lit("/"), F.substring("hms", 1, 2), F.lit(".jsonl"))
    return store.catalog(ticks(spark, sf_dir).select(path.alias("path"), (F.col("price") * 997).alias("bytes")))


@register("s21_duplicate_names", f"with {TICKS} select hms as name, count(*) as copies, case when count(distinct (vendor, conn_id)) = 1 then 'identical' else 'conflicting' end as kind from ticks group by hms having count(*) > 1")
def s21_duplicate_names(spark, sf_dir):
    return store.duplicate_names(ticks(spark, sf_dir).select(F.col("hms").alias("name"), F.col("vendor").alias("bytes"), F.col("conn_id").alias("md5")))


@register("s24_health_log", f"with {TICKS} select vendor, cast(sum(cvolume) as bigint) as frames from ticks where dt = '2024-01-05' group by vendor")
def s24_health_log(spark, sf_dir):
    path = scratch(spark, "health")
    lines = l0.json_lines(ticks(spark, sf_dir).select("vendor", "cvolume", "dt"))
    lines.unionByName(spark.range(3).select(F.lit("{bad").alias("value"))).write.text(path)
    return l0.read_log(spark, path, "vendor string, cvolume long, dt string", strict=False).where("dt = '2024-01-05'").groupBy("vendor").agg(F.sum("cvolume").alias("frames"))


@register("j1_new_keys", f"with {BARS} select date, symbol from bars where volume % 3 = 0 and not (volume % 2 = 0)")
def j1_new_keys(spark, sf_dir):
    b = daily_bars(spark, sf_dir).select("date", "symbol", "volume")
    return b.where("volume % 3 = 0").select("date", "symbol").join(b.where("volume % 2 = 0").select("date", "symbol"), ["date", "symbol"], "left_anti")


@register("j2_missing_keys", f"with {TICKS}, a as (select distinct case when seq % 9 > 0 then symbol end as symbol, vendor from ticks), b as (select distinct case when seq % 11 > 0 then symbol end as symbol, vendor from ticks where lost) select a.symbol, a.vendor from a where not exists (select 1 from b where b.symbol is not distinct from a.symbol and b.vendor = a.vendor)")
def j2_missing_keys(spark, sf_dir):
    t = ticks(spark, sf_dir)
    side = lambda rows, n: rows.select(F.when(F.col("seq") % n > 0, F.col("symbol")).alias("symbol"), "vendor")
    return store.missing_keys(side(t, 9), side(t.where("lost"), 11), ["symbol", "vendor"])


@register("d7_best_row", "with l as (select l_suppkey as symbol, l_partkey as seq, cast(round(l_extendedprice * 100) as bigint) as v from lineitem) select symbol, seq, v from (select *, row_number() over (partition by symbol order by v desc, seq) as n from l) where n = 1")
def d7_best_row(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.col("l_partkey").alias("seq"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"))
    return first_of_key(rows, ["symbol"], [F.col("v").desc(), "seq"])
