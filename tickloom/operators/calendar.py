"""Trading calendar: expiries, rebalance days, settlement and the dated sell tax, and job schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.intervals import as_of

#: Fixed: months of quadruple expiry and of the index rebalance, days to settlement, and the sell tax by date.
QUAD_MONTHS, REBALANCE_MONTHS, SETTLEMENT_DAYS = (3, 6, 9, 12), (6, 12), 2
SELL_TAX = (
    ("2023-01-01", "KOSPI", 5, 15),
    ("2023-01-01", "KOSDAQ", 20, 0),
    ("2023-01-01", "ETF", 0, 0),
    ("2024-01-01", "KOSPI", 3, 15),
    ("2024-01-01", "KOSDAQ", 18, 0),
    ("2024-01-01", "ETF", 0, 0),
    ("2025-01-01", "KOSPI", 0, 15),
    ("2025-01-01", "KOSDAQ", 15, 0),
    ("2025-01-01", "ETF", 0, 0),
    ("2026-01-01", "KOSPI", 5, 15),
    ("2026-01-01", "KOSDAQ", 20, 0),
    ("2026-01-01", "ETF", 0, 0),
)


def sell_tax_schedule(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(SELL_TAX, "effective_from string, market string, transaction_bps int, rural_bps int")
    return rows.withColumn("effective_from", F.to_date("effective_from")).withColumn("total_bps", F.col("transaction_bps") + F.col("rural_bps"))


def expiry_days(sessions: DataFrame) -> DataFrame:
    """(date) of each month's derivatives expiry: the second Thursday, or the last session before it in the month."""
    second = F.date_add(F.next_day(F.date_sub(F.trunc("date", "MM"), 1), "THU"), 7)
    return sessions.where(F.col("date") <= second).groupBy(F.trunc("date", "MM").alias("month")).agg(F.max("date").alias("date")).select("date")


def calendar_tags(sessions: DataFrame) -> DataFrame:
    """Each session with its expiry, quadruple-expiry and rebalance tags; the rebalance holds on the session after an expiry in its months."""
    marked = sessions.select("date").distinct().join(expiry_days(sessions).withColumn("_e", F.lit(True)), "date", "left").withColumn("is_derivatives_expiry", F.coalesce("_e", F.lit(False)))
    order = Window.orderBy("date")
    month, before = F.month("date"), F.lag("is_derivatives_expiry").over(order)
    after = before & month.isin(*REBALANCE_MONTHS) & F.month(F.lag("date").over(order)).isin(*REBALANCE_MONTHS)
    return marked.withColumns({"is_quad_witching": F.col("is_derivatives_expiry") & month.isin(*QUAD_MONTHS), "is_rebalance_effective": F.coalesce(after, F.lit(False))}).drop("_e")


def settlement_days(sessions: DataFrame) -> DataFrame:
    """(date, settles): the session two later, null past the calendar's end."""
    return sessions.select("date").distinct().withColumn("settles", F.lead("date", SETTLEMENT_DAYS).over(Window.orderBy("date")))


def sell_tax(trades: DataFrame, sessions: DataFrame, schedule: DataFrame) -> DataFrame:
    """Trades (date, market) with their settlement and the total rate in force then."""
    settled = trades.join(F.broadcast(settlement_days(sessions)), "date")
    return as_of(settled, schedule.select("market", "effective_from", "total_bps"), ["market"], "settles", "effective_from")


def due_jobs(jobs: DataFrame, now_s: int) -> DataFrame:
    """Job times (job, start_s, end_s, every_s, inclusive) laid out with the time each must not run after, and whether due, expired or later."""
    last = F.when(F.col("inclusive"), F.col("end_s")).otherwise(F.col("end_s") - 1)
    times = jobs.where(F.col("start_s") <= last).withColumn("due_s", F.explode(F.sequence(F.col("start_s"), last, F.col("every_s"))))
    times = times.withColumn("not_after_s", F.coalesce(F.lead("due_s").over(Window.partitionBy("job").orderBy("due_s")), F.col("end_s")))
    state = F.when(F.col("due_s") > now_s, "later").when(F.col("not_after_s") <= now_s, "expired").otherwise("due")
    return times.select("job", "due_s", "not_after_s", state.alias("state"))
