"""Late data: a stream's windows are closed by its watermark; rows that come behind it are kept, and only what they touch is computed again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Aggregate = Callable[[DataFrame], DataFrame]


def closed_windows(frames: DataFrame, keys: list[str], width: str, delay: str, *sums) -> DataFrame:
    """Sums of tumbling windows of ``ts`` by ``keys``, each told once the watermark has passed its end; rows behind it are dropped."""
    rows = frames.withWatermark("ts", delay).groupBy(F.window("ts", width), *keys).agg(*sums)
    return rows.select(*keys, F.col("window.start").alias("start"), *[c for c in rows.columns if c not in ("window", *keys)])


def keep_frames(stream: DataFrame, path: str, width_us: int, delay_us: int) -> DataFrame:
    """Run a stream of frames (``ts``, ...) into a table with ``start``, its window, and ``late``: whether the window was closed before it came.

    The watermark before a trigger is the largest time of all triggers before it less the delay, as the engine has it. A
    trigger has folders of its own, which it replaces if it runs again after a failure.
    """
    spark = stream.sparkSession
    spark.createDataFrame([(-(1 << 62),)], "high long").write.mode("overwrite").parquet(f"{path}/high/batch=-1")

    def put(batch: DataFrame, number: int) -> None:
        high = spark.read.schema("high long, batch long").parquet(f"{path}/high").where(F.col("batch") < number).agg(F.max("high")).first()[0]
        at = F.unix_micros("ts")
        start = F.expr(f"(unix_micros(ts) - pmod(unix_micros(ts), {width_us}))")
        batch.withColumns({"start": F.timestamp_micros(start), "late": start + width_us <= F.lit(max(high - delay_us, -(1 << 62)))}).write.mode("overwrite").parquet(f"{path}/frames/batch={number}")
        batch.agg(F.coalesce(F.max(at), F.lit(-(1 << 62))).alias("high")).write.mode("overwrite").parquet(f"{path}/high/batch={number}")

    query = stream.writeStream.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/frames").drop("batch")


def repaired_windows(windows: DataFrame, frames: DataFrame, again: Aggregate, until=None) -> tuple[DataFrame, DataFrame]:
    """(windows, touched): the stream's closed windows with those that late rows touch computed again from all stored frames.

    ``windows`` has ``start``; ``frames`` those of :func:`keep_frames`; ``again`` computes windows from frames. ``touched`` has
    the starts of the windows with late rows; only their frames are read for it, the others stay as the stream told them.
    Windows that are not closed yet (``start`` not before ``until``) are left to the stream.
    """
    touched = frames.where("late").select("start").distinct()
    if until is not None:
        touched = touched.where(F.col("start") < until)
    fresh = again(frames.join(touched, "start", "left_semi"))
    return windows.join(touched, "start", "left_anti").select(*fresh.columns).unionByName(fresh), touched
