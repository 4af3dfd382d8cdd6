"""The driver's tables as market data: events as ticks, lineitem as daily bars, orders as sessions. All exact in integers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import zfill

#: Fixed: which event stands for which vendor.
VENDOR_OF = {"view": "ls", "click": "kis", "purchase": "db", "signup": "toss", "error": "kiwoom"}


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as they were received; ``lost`` marks those that the live feed misses."""
    vendor = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in VENDOR_OF.items()], F.lit("kiwoom"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        zfill(F.col("user_id").cast("string")).alias("symbol"),
        vendor.alias("vendor"),
        (F.col("event_type") == "error").alias("lost"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("recv_wall_ns"),
        F.date_format("ts", "HHmmss").alias("hms"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.round(F.col("value") * 100).cast("long").alias("price"),
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("cvolume"),
        F.col("event_id").alias("seq"),
        F.concat(F.lit("c"), (F.col("event_id") % 3).cast("string")).alias("conn_id"),
    )


def counted_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with the venue's counter (``cum``) and cumulative volume, which count lost trades too."""
    order = Window.partitionBy("symbol").orderBy("recv_wall_ns", "seq")
    return ticks(spark, sf_dir).withColumns({"cum": F.row_number().over(order).cast("long"), "volume": F.sum("cvolume").over(order.rowsBetween(Window.unboundedPreceding, 0))})


def live_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_ticks(spark, sf_dir).where("not lost")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars by supplier and ship date; prices are whole hundredths, so every engine gets the same."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        zfill(F.col("l_suppkey").cast("string")).alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        F.col("l_quantity").cast("long").alias("qty"),
    )
    sums = rows.groupBy("symbol", "date").agg(F.sum("cents").alias("cents"), F.sum("qty").alias("volume"), F.max(F.expr("cents div qty")).alias("high"), F.min(F.expr("cents div qty")).alias("low"), F.count("*").alias("n"))
    closes = sums.withColumn("close_i", F.expr("(2 * cents + volume) div (2 * volume)"))
    base = F.coalesce(F.lag("close_i").over(Window.partitionBy("symbol").orderBy("date")), F.col("close_i"))
    return closes.withColumn("base_i", base).select(
        "symbol",
        "date",
        F.col("close_i").cast("double").alias("close"),
        F.greatest("high", "close_i").cast("double").alias("high"),
        F.least("low", "close_i").cast("double").alias("low"),
        F.col("base_i").cast("double").alias("base_price"),
        "volume",
        (F.col("cents") / F.lit(1000000.0)).alias("trade_value_100m"),
        (F.expr("(close_i - base_i) * 10000 div base_i") / F.lit(100.0)).alias("daily_change_pct"),
        "n",
    )
