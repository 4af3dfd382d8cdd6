"""Column functions used throughout; each is a composition of built-ins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed: floors of the price steps, highest first.
TICK_TABLE = ((500_000, 1_000), (200_000, 500), (50_000, 100), (20_000, 50), (5_000, 10), (2_000, 5), (0, 1))


def div(c: Column, n: int) -> Column:
    """Whole-number division of longs; a double would lose nanoseconds."""
    return F.call_function("div", c, F.lit(n))


def zfill(c: Column, width: int = 6) -> Column:
    """Zeros on the left up to ``width``; longer texts stay whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def product_error(a: Column, b: Column, product: Column) -> Column:
    """What the double ``product`` of two doubles lacks of their exact product, from their halves of 26 bits."""

    def halves(c: Column) -> tuple[Column, Column]:
        scaled = c * F.lit(134217729.0)
        high = scaled - (scaled - c)
        return high, c - high

    (ah, al), (bh, bl) = halves(a), halves(b)
    return al * bl - (((product - ah * bh) - al * bh) - ah * bl)


def two_sum(a: Column, b: Column) -> Column:
    """The exact sum of ``a`` and a far smaller ``b`` as the nearest double (``high``) and what it lacks (``low``); such pairs are in the order of the sums."""
    return F.struct((a + b).alias("high"), (b - ((a + b) - a)).alias("low"))


def first_case(cases: list[tuple[Column, object]], default=None) -> Column:
    """The value of the first condition that holds; a null condition doesn't hold."""
    out = F.lit(default)
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def reasons(cases: list[tuple[str, Column]]) -> Column:
    """Names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in cases]))


def valid_hms(c: Column) -> Column:
    """Whether a text is a time of day as HHMMSS."""
    return F.coalesce(c.rlike("^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]$"), F.lit(False))


def seconds_of(hms: Column) -> Column:
    """Seconds of the day of an HHMMSS text, null unless valid."""
    part = [F.substring(hms, 1 + 2 * k, 2).try_cast("long") for k in range(3)]
    return F.when(valid_hms(hms), part[0] * 3600 + part[1] * 60 + part[2])


def hms_of(seconds: Column) -> Column:
    """HHMMSS of seconds of the day."""
    return F.concat(*[zfill(v.cast("string"), 2) for v in (F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)])


def kst_minute(ns: Column) -> Column:
    """Korean wall-clock minute of an epoch in nanoseconds."""
    return F.date_format(F.timestamp_seconds(div(ns, 60_000_000_000) * 60 + 9 * 3600), "yyyy-MM-dd'T'HH:mm")


def tick_of(price: Column) -> Column:
    """The price step of a price, null below 1."""
    return F.when(price >= 1, first_case([(price >= floor, F.lit(step)) for floor, step in TICK_TABLE]))


def is_tick_aligned(price: Column) -> Column:
    return F.coalesce((price >= 1) & (price % tick_of(price) == 0), F.lit(False))


def is_short_code(c: Column) -> Column:
    """Six letters or digits."""
    return F.coalesce(c.rlike("^[0-9A-Za-z]{6}$"), F.lit(False))


def require(df: DataFrame, bad: Column, message) -> DataFrame:
    """The rows of ``df``, failing the query where ``bad`` holds. It is a filter, so it stays whichever columns are read."""
    text = message if isinstance(message, Column) else F.lit(message)
    return df.where(F.when(bad, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
