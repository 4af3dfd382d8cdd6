"""Interval algebra: merging by three rules, clipping, gaps, holes, and points in intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import div

#: How two intervals in order join: they touch, are adjacent whole numbers, or overlap inside.
RULES = {"touch": lambda lo, hi: lo <= hi, "adjacent": lambda lo, hi: lo <= hi + 1, "open": lambda lo, hi: lo < hi}


def island_ids(df: DataFrame, keys: list[str], rule: str = "touch", lo: str = "lo", hi: str = "hi", tie: str | None = None) -> DataFrame:
    """``island`` numbers the merged groups of intervals of a key."""
    order = Window.partitionBy(*keys).orderBy(lo, hi, *([tie] if tie else []))
    reach = F.max(hi).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.coalesce(RULES[rule](F.col(lo), reach), F.lit(False)), 0).otherwise(1)
    return df.withColumn("_starts", starts).withColumn("island", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_starts")


def merge_intervals(df: DataFrame, keys: list[str], rule: str = "touch", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Disjoint unions of the intervals of a key, with how many went in."""
    return island_ids(df, keys, rule, lo, hi).groupBy(*keys, "island").agg(F.min(lo).alias(lo), F.max(hi).alias(hi), F.count("*").alias("n")).drop("island")


def clip_and_total(df: DataFrame, keys: list[str], start, end) -> DataFrame:
    """Length of the union of a key's intervals inside [start, end]."""
    clipped = df.withColumns({"lo": F.greatest("lo", F.lit(start)), "hi": F.least("hi", F.lit(end))}).where("lo < hi")
    return merge_intervals(clipped, keys).groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo")).alias("seconds"), F.count("*").alias("spans"))


def event_holes(seconds: DataFrame, keys: list[str], start: int, end: int, least: int) -> DataFrame:
    """Runs of at least ``least`` seconds without events in [start, end), edges included; a key without events has none."""
    inside = seconds.where((F.col("second") >= start) & (F.col("second") < end)).select(*keys, "second").distinct()
    edges = inside.select(*keys).distinct().withColumn("second", F.explode(F.array(F.lit(start - 1), F.lit(end)).cast(T.ArrayType(inside.schema["second"].dataType))))
    after = F.lead("second").over(Window.partitionBy(*keys).orderBy("second"))
    gaps = inside.unionByName(edges).withColumn("next", after)
    return gaps.select(*keys, (F.col("second") + 1).alias("start"), F.col("next").alias("end"), (F.col("next") - F.col("second") - 1).alias("seconds")).where(F.col("seconds") >= least)


def points_in(points: DataFrame, spans: DataFrame, keys: list[str], at: str, width: int, low_open: bool = True, high_open: bool = False) -> DataFrame:
    """Points joined with the spans (lo, hi) of their key that hold them.

    Both sides are cut into bins of ``width``, a span standing in each bin it touches, so the join is on key and bin: a
    key with many points or spans spreads over tasks, and a point meets only the spans of its bin.
    """
    binned = spans.withColumn("_bin", F.explode(F.sequence(div(F.col("lo"), width), div(F.col("hi"), width))))
    above = F.col(at) > F.col("lo") if low_open else F.col(at) >= F.col("lo")
    below = F.col(at) < F.col("hi") if high_open else F.col(at) <= F.col("hi")
    return points.withColumn("_bin", div(F.col(at), width)).join(binned, [*keys, "_bin"]).where(above & below).drop("_bin")


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], width: int, start: str = "start", end: str = "end") -> DataFrame:
    """Rows of ``left`` (start, end) that share more than a point with a span (lo, hi) of their key; equal rows come once.

    Both sides are cut into bins of ``width`` and meet only in these, so a key with many rows or spans spreads over tasks.
    """
    bins = lambda a, b: F.explode(F.sequence(div(F.col(a), width), div(F.col(b), width)))
    named = left.withColumn("_row", F.struct(*left.columns)).withColumn("_bin", bins(start, end)).select(*keys, "_bin", "_row", F.col(start).alias("_a"), F.col(end).alias("_b"))
    spans = right.select(*keys, "lo", "hi").withColumn("_bin", bins("lo", "hi"))
    return named.join(spans, [*keys, "_bin"]).where("_a < hi and lo < _b").select("_row.*").distinct()


def with_previous(df: DataFrame, keys: list[str], at: str, fields: list[str], width: int, tie: str | None = None, name: str = "previous") -> DataFrame:
    """``name`` holds the fields of the row before in the order of ``at`` within a key.

    A key is cut into bins of ``width``, so one with a third of all rows is the work of many tasks: the first row of a bin
    gets the last one of the bin before, from a table with a row per bin.
    """
    order = [at, *([tie] if tie else [])]
    row = F.struct(*fields)
    binned = df.withColumn("_bin", div(F.col(at), width))
    ends = binned.groupBy(*keys, "_bin").agg(F.max_by(row, F.struct(*order)).alias("_end"))
    carried = ends.withColumn("_carry", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_bin"))).drop("_end")
    inside = F.lag(row).over(Window.partitionBy(*keys, "_bin").orderBy(*order))
    names = {k: f"_k{i}" for i, k in enumerate([*keys, "_bin"])}
    carried = carried.withColumnsRenamed(names)
    same = None
    for k, n in names.items():
        equal = F.col(k).eqNullSafe(F.col(n))
        same = equal if same is None else same & equal
    joined = binned.withColumn("_inside", inside).join(carried, same, "left")
    return joined.select(*df.columns, F.coalesce("_inside", "_carry").alias(name))


def numbered(df: DataFrame, keys: list[str], at: str, width: int, tie: str, name: str = "n") -> DataFrame:
    """``name`` is the place of a row in the order of ``at`` and ``tie`` within its key, from 1.

    A key is cut into bins of ``width``; a row counts those of its bin and, from a table with a row per bin, all before it.
    """
    binned = df.withColumn("_bin", div(F.col(at), width))
    sizes = binned.groupBy(*keys, "_bin").agg(F.count("*").alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))).drop("_size")
    inside = F.row_number().over(Window.partitionBy(*keys, "_bin").orderBy(at, tie))
    return binned.withColumn("_inside", inside).join(before, [*keys, "_bin"]).select(*df.columns, (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(name))


def as_of(left: DataFrame, schedule: DataFrame, keys: list[str], at: str, since: str, width: int | None = None) -> DataFrame:
    """Rows of ``left`` with the latest schedule row of their key at or before ``at``; none gives nulls, of equal times the greatest row counts.

    Rows and schedule are put in one order and the last schedule row is carried on. With ``width`` (days of a date,
    microseconds of a timestamp, else units of the number) a key is cut into bins of time, each the work of one task; what
    a bin begins with comes from a table with a row per bin.
    """
    values = [c for c in schedule.columns if c not in keys]
    kind = left.schema[at].dataType
    number = {"date": F.unix_date, "timestamp": F.unix_micros, "timestamp_ntz": lambda c: F.unix_date(c.cast("date")).cast("long") * 86_400_000_000}.get(kind.typeName(), lambda c: c.cast("long"))
    bin_of = lambda c: div(number(c).cast("long"), width) if width else F.lit(0).cast("long")
    marks = schedule.where(F.col(since).isNotNull()).dropna(subset=keys).select(*keys, F.col(since).cast(kind).alias("_at"), F.lit(0).alias("_side"), F.struct(*values).alias("_row"))
    rows = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    both = marks.unionByName(rows, allowMissingColumns=True).withColumn("_bin", bin_of(F.col("_at")))
    inside = Window.partitionBy(*keys, "_bin").orderBy("_at", "_side", "_row").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("_held", F.last("_row", ignorenulls=True).over(inside)).where("_side = 1")
    if width:
        ends = both.groupBy(*keys, "_bin").agg(F.max(F.when(F.col("_side") == 0, F.struct("_at", "_row"))).alias("_end"))
        carry = F.last("_end", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
        names = {k: f"_k{n}" for n, k in enumerate([*keys, "_bin"])}
        carried = ends.withColumn("_carry", carry).drop("_end").where("_carry is not null").withColumnsRenamed(names)
        same = [F.col(k) == F.col(n) for k, n in names.items()]
        held = held.join(carried, same, "left").withColumn("_held", F.coalesce("_held", "_carry._row"))
    return held.select("_left.*", *[F.col(f"_held.{v}").alias(v) for v in values if v not in left.columns])
