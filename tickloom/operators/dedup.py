"""Duplicates and conflicts: which row of a key is kept, and where two rows of a key disagree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import require


def first_of_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order; rows have none of their own."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def payload_conflicts(df: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Keys whose rows carry different payloads."""
    groups = df.groupBy(*keys).agg(F.min(payload).alias("_least"), F.max(payload).alias("_most"), F.count("*").alias("rows"))
    return groups.where("_least <> _most").drop("_least", "_most")


def dedup_l0(df: DataFrame, order: list, strict: bool = True) -> DataFrame:
    """One row per (conn_id, conn_seq), the earliest stored. With ``strict`` a key with two payloads fails the query."""
    window = Window.partitionBy("conn_id", "conn_seq")
    if strict:
        marked = df.withColumn("_two", F.min("raw").over(window) != F.max("raw").over(window))
        df = require(marked, F.col("_two"), F.concat(F.lit("two payloads for "), "conn_id", F.lit(" "), F.col("conn_seq").cast("string"))).drop("_two")
    return first_of_key(df, ["conn_id", "conn_seq"], order)


def consecutive_duplicates(df: DataFrame, keys: list[str], order: list, fields: list[str]) -> DataFrame:
    """``is_duplicate`` marks rows equal in all fields to the row before; nulls are equal."""
    window = Window.partitionBy(*keys).orderBy(*order)
    same = F.lag(F.lit(True)).over(window)
    for f in fields:
        same = same & F.lag(f).over(window).eqNullSafe(F.col(f))
    return df.withColumn("is_duplicate", F.coalesce(same, F.lit(False)))


def admit_handover(df: DataFrame, keys: list[str], order: list, conn: str = "conn_id") -> DataFrame:
    """Rows of a payload by the connection that sent it first; copies over another connection are dropped, its own repeats stay."""
    owner = F.first(conn).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn("_owner", owner).where(F.col("_owner") == F.col(conn)).drop("_owner")


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n > 1").drop("_n")


def effective_tiers(log: DataFrame, rank: Column, order: str = "seq") -> DataFrame:
    """Per symbol the latest row of the best tier seen; acknowledgements count for nothing."""
    rows = log.where("source <> 'ack'").withColumn("_rank", rank)
    return first_of_key(rows, ["symbol"], [F.col("_rank").desc(), F.col(order).desc()]).drop("_rank")


def multiset_minus(left: DataFrame, right: DataFrame, keys: list[str], order: list, apart: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``left`` beyond as many of ``right`` with the same key; the later ones stay. Each value of ``apart`` is compared by itself."""
    n = F.row_number().over(Window.partitionBy(*apart, *keys).orderBy(*order))
    have = right.groupBy(*keys).agg(F.count("*").alias("_have"))
    return left.withColumn("_n", n).join(have, keys, "left").where(F.col("_n") > F.coalesce("_have", F.lit(0))).drop("_n", "_have")


def multiset_overlap(left: DataFrame, right: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """By group: rows of either side and how many match one to one."""
    by = [*group, *keys]
    a, b = left.groupBy(*by).agg(F.count("*").alias("a")), right.groupBy(*by).agg(F.count("*").alias("b"))
    zero = F.lit(0)
    both = a.join(b, by, "full").select(*group, F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b"))
    return both.groupBy(*group).agg(F.sum("a").alias("left_rows"), F.sum("b").alias("right_rows"), F.sum(F.least("a", "b")).alias("matched"))
