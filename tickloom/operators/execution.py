"""Orders and positions: pre-trade checks, order states, paper fills, the ledger's ordered fold, and reconciliation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import first_case, is_tick_aligned, tick_of

#: Fixed: the allowed moves between order states.
TRANSITIONS = {
    "PENDING_SUBMIT": ("ACCEPTED", "REJECTED", "UNKNOWN"),
    "UNKNOWN": ("ACCEPTED", "PARTIALLY_FILLED", "FILLED", "CANCELLED", "REJECTED"),
    "ACCEPTED": ("PARTIALLY_FILLED", "FILLED", "CANCELLED", "REJECTED"),
    "PARTIALLY_FILLED": ("FILLED", "CANCELLED"),
}


def reject_code(limits: dict[str, int], ref: Column) -> Column:
    """The first violated pre-trade rule of an intent joined with its quote and context, null if none."""
    c = F.col
    buy, limit_order = c("side") == "BUY", c("order_type") == "LIMIT"
    notional = c("qty") * ref
    return first_case(
        [
            (c("kill_switch"), F.lit("KILL_SWITCH")),
            (c("submit_block_reason").isNotNull(), F.lit("ACCOUNT_MISMATCH")),
            (c("unknown_pending"), F.lit("UNKNOWN_PENDING")),
            (~c("symbol_allowed"), F.lit("SYMBOL_NOT_ALLOWED")),
            (c("qty") < 1, F.lit("QTY_INVALID")),
            (limit_order == c("limit_price").isNull(), F.lit("PRICE_INVALID")),
            (c("halted"), F.lit("TRADING_HALTED")),
            ((c("last") >= 1) & (tick_of(c("last")) != c("tick")), F.lit("TICK_TABLE_MISMATCH")),
            (limit_order & ~is_tick_aligned(c("limit_price")), F.lit("PRICE_OFF_TICK")),
            (limit_order & ~c("limit_price").between(c("lower_limit"), c("upper_limit")), F.lit("PRICE_OUT_OF_BAND")),
            (c("orders_last_minute") >= limits["orders_per_minute"], F.lit("ORDER_RATE_LIMIT")),
            (buy & (c("realized_pnl_krw") <= -limits["daily_loss"]), F.lit("DAILY_LOSS_LIMIT")),
            (notional > limits["order_notional"], F.lit("NOTIONAL_LIMIT")),
            (buy & ((c("position_qty") + c("open_buy_qty") + c("qty")) * ref > limits["position_notional"]), F.lit("POSITION_LIMIT")),
            (buy & (notional + c("est_commission_krw") > c("orderable_cash_krw")), F.lit("INSUFFICIENT_CASH")),
            ((c("side") == "SELL") & (c("qty") > c("position_qty") - c("open_sell_qty")), F.lit("INSUFFICIENT_POSITION")),
        ]
    )


def orders_in_last_minute(intents: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Orders of the key in the 60 seconds up to each one, without itself; ``at`` is in seconds."""
    window = Window.partitionBy(*keys).orderBy(at).rangeBetween(-60, 0)
    return intents.withColumn("orders_last_minute", F.count("*").over(window) - 1)


def paper_fills(intents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, filled, amount) of intents (side, qty, limit_price) swept over ``levels``, an array of (price, size), best first.

    Levels beyond the limit end the sweep; each level gives what the ones before left open.
    """
    rows = intents.select(*keys, "side", "qty", "limit_price", F.posexplode("levels").alias("k", "level"))
    crossed = F.col("limit_price").isNotNull() & F.when(F.col("side") == "BUY", F.col("level.price") > F.col("limit_price")).otherwise(F.col("level.price") < F.col("limit_price"))
    order = Window.partitionBy(*keys).orderBy("k")
    rows = rows.withColumn("_stop", F.max(crossed).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_size", F.when(F.col("_stop"), 0).otherwise(F.col("level.size")))
    before = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_take", F.greatest(F.lit(0), F.least(F.col("_size"), F.col("qty") - before)))
    return rows.groupBy(*keys).agg(F.sum("_take").alias("filled"), F.sum(F.col("_take") * F.col("level.price")).alias("amount"))


LEDGER_SCHEMA = "symbol string, seq long, qty long, cost_krw long, pnl_krw long, cash_krw long"


def position_ledger(fills: DataFrame, commission_bps: int, sell_tax_bps: int) -> DataFrame:
    """Position, cost basis, realised profit and cash change after each fill (symbol, seq, side, fill_qty, amount_krw) of a symbol.

    Whole-won floors of partial sells depend on the path, so it is an ordered fold per symbol; a sale beyond the
    position is refused: it changes nothing and has a null profit.
    """

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        qty = cost = 0
        out = []
        for f in rows.sort_values("seq").itertuples():
            fee = f.amount_krw * commission_bps // 10_000
            pnl, cash = 0, 0
            if f.side == "BUY":
                qty, cost, cash = qty + f.fill_qty, cost + f.amount_krw + fee, -(f.amount_krw + fee)
            elif f.fill_qty > qty:
                pnl = None
            else:
                gone = cost * f.fill_qty // qty
                cash = f.amount_krw - fee - f.amount_krw * sell_tax_bps // 10_000
                qty, cost, pnl = qty - f.fill_qty, cost - gone, cash - gone
            out.append((f.symbol, f.seq, qty, cost, pnl, cash))
        return pd.DataFrame(out, columns=["symbol", "seq", "qty", "cost_krw", "pnl_krw", "cash_krw"]).astype({"pnl_krw": "Int64"})

    return fills.groupBy("symbol").applyInPandas(fold, LEDGER_SCHEMA)


def reconcile(ledger: DataFrame, broker: DataFrame) -> DataFrame:
    """Symbols whose quantity differs between two books; a missing one holds none."""
    a, b = ledger.select("symbol", F.col("qty").alias("ledger_qty")), broker.select("symbol", F.col("qty").alias("broker_qty"))
    zero = F.lit(0)
    both = a.join(b, "symbol", "full").select("symbol", F.coalesce("ledger_qty", zero).alias("ledger_qty"), F.coalesce("broker_qty", zero).alias("broker_qty"))
    return both.where("ledger_qty <> broker_qty")


def order_status() -> Column:
    """State of a broker's row (ordered_qty, filled_qty, remaining_qty, rejected_qty, cancelled)."""
    c = F.col
    ended = c("cancelled") | (c("rejected_qty") > 0) | (c("remaining_qty") == 0)
    return first_case(
        [
            ((c("filled_qty") < 0) | (c("filled_qty") > c("ordered_qty")), F.lit("INVALID")),
            (c("filled_qty") == c("ordered_qty"), F.lit("FILLED")),
            (ended & (c("filled_qty") == 0) & (c("rejected_qty") > 0) & ~c("cancelled"), F.lit("REJECTED")),
            (ended, F.lit("CANCELLED")),
            (c("filled_qty") > 0, F.lit("PARTIALLY_FILLED")),
        ],
        "ACCEPTED",
    )


def transition_allowed(current: Column, new: Column) -> Column:
    """Whether an order may move from one state to another; staying is allowed."""
    moves = [((current == a) & new.isin(*bs), F.lit(True)) for a, bs in TRANSITIONS.items()]
    return first_case([(current == new, F.lit(True)), *moves], False)
