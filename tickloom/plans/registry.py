"""Where queries over the driver's tables are registered, each with its SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name``."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The adapters of ``sources.adapters`` in SQL.
TICKS = """
ticks as (select case when length(user_id::varchar) < 6 then lpad(user_id::varchar, 6, '0') else user_id::varchar end as symbol,
  case event_type when 'view' then 'ls' when 'click' then 'kis' when 'purchase' then 'db' when 'signup' then 'toss' else 'kiwoom' end as vendor,
  event_type = 'error' as lost, epoch_us(ts) * 1000 as recv_wall_ns, strftime(ts, '%H%M%S') as hms, strftime(ts, '%Y-%m-%d') as dt,
  cast(round(value * 100) as bigint) as price, cast(json_extract_string(props, '$.k') as bigint) + 1 as cvolume, event_id as seq,
  'c' || (event_id % 3)::varchar as conn_id from events)
"""
COUNTED = (
    TICKS
    + """,
counted as (select *, row_number() over (partition by symbol order by recv_wall_ns, seq) as cum,
  cast(sum(cvolume) over (partition by symbol order by recv_wall_ns, seq rows unbounded preceding) as bigint) as volume from ticks),
live as (select * from counted where not lost)
"""
)
BARS = """
sums as (select case when length(l_suppkey::varchar) < 6 then lpad(l_suppkey::varchar, 6, '0') else l_suppkey::varchar end as symbol, cast(l_shipdate as date) as date,
  cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents, cast(sum(cast(l_quantity as bigint)) as bigint) as volume,
  max(cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint)) as high, min(cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint)) as low,
  cast(count(*) as bigint) as n from lineitem group by all),
closes as (select *, (2 * cents + volume) // (2 * volume) as close_i from sums),
bars as (select symbol, date, cast(close_i as double) as close, cast(greatest(high, close_i) as double) as high, cast(least(low, close_i) as double) as low,
  cast(coalesce(lag(close_i) over (partition by symbol order by date), close_i) as double) as base_price, volume, cents / 1000000.0::double as trade_value_100m,
  ((close_i - coalesce(lag(close_i) over (partition by symbol order by date), close_i)) * 10000 // coalesce(lag(close_i) over (partition by symbol order by date), close_i)) / 100.0::double as daily_change_pct,
  n from closes)
"""
