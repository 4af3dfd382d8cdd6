"""A stream and the repair of what late rows touch equal the table computed at once."""

import random

from pyspark.sql import functions as F

from tickloom.streaming.late import closed_windows, keep_frames, repaired_windows
from tickloom.streaming.monitors import run_available

MIN = 60_000_000


def test_stream_and_repair_equal_the_table(spark, tmp_path):
    rnd = random.Random(3)
    rows = [("ab"[i % 2], i * 7_000_000 + rnd.randrange(7_000_000), i) for i in range(1200)]
    late = set(rnd.sample(range(900), 40))
    first = [r for r in rows if r[2] not in late]
    files = [first[i : i + 232] for i in range(0, len(first), 232)]
    files[-1] += [r for r in rows if r[2] in late]
    for n, part in enumerate(files):
        df = spark.createDataFrame(part, "feed string, at long, n long").withColumn("ts", F.timestamp_micros("at"))
        df.coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    schema = df.schema

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))

    sums = (F.count("*").alias("frames"), F.sum("n").alias("total"))
    told = run_available(closed_windows(stream(), ["feed"], "10 minutes", "15 minutes", *sums), str(tmp_path / "windows"))
    frames = keep_frames(stream(), str(tmp_path / "kept"), 10 * MIN, 15 * MIN)
    assert frames.count() == len(rows)

    def again(df):
        return df.groupBy("feed", "start").agg(*sums)

    as_set = lambda df: {tuple(r) for r in df.select("feed", "start", "frames", "total").collect()}
    closed = told.agg(F.max("start")).first()[0]
    whole = as_set(again(frames).where(F.col("start") <= closed))
    assert as_set(told) != whole  # the stream alone has lost the late rows
    repaired, touched = repaired_windows(told, frames, again)
    assert as_set(repaired) == whole and repaired.count() == len(whole)
    starts = {r.start for r in touched.collect()}
    assert 0 < len(starts) < len({r[1] for r in whole})
    assert {r.n for r in frames.where("late").collect()} <= late
