"""Market phases by the exchange's event time, session anchors, and microstructure fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import first_case, seconds_of, valid_hms

#: Fixed: streams by kind, and the phase windows as (venue, kind or None, start, end, phase), the first match counts.
TRADE_STREAMS, QUOTE_STREAMS = ("H0STCNT0", "H0NXCNT0"), ("H0STASP0", "H0NXASP0")
WINDOWS = (
    ("krx", "trade", "083000", "084000", "pre_closing_price"),
    ("krx", None, "083000", "090000", "opening_auction"),
    ("krx", None, "090000", "152000", "regular"),
    ("krx", None, "152000", "154000", "closing_auction"),
    ("krx", None, "154000", "160000", "post_closing_price"),
    ("krx", None, "160000", "200000", "aftermarket"),
    ("nxt", None, "080000", "085000", "premarket"),
    ("nxt", None, "090000", "152000", "regular"),
    ("nxt", None, "154000", "200000", "aftermarket"),
)
AUCTION_PHASES = ("opening_auction", "closing_auction")
LEGACY_AUCTIONS = ((83000, 90000), (152000, 153000))
MAX_SHIFT = 3 * 3600


def _shifted(hms: str, seconds: int) -> str:
    total = int(hms[:2]) * 3600 + int(hms[2:4]) * 60 + int(hms[4:]) + seconds
    if not 0 <= total < 86400:
        raise ValueError(f"{hms} shifted by {seconds} s leaves the day")
    return f"{total // 3600:02d}{total // 60 % 60:02d}{total % 60:02d}"


def windows_for(open_shift: int = 0, close_shift: int = 0) -> tuple:
    """The windows of a day whose open and close are moved: bounds up to the open follow one shift, the others the other; the end of the day stays."""
    if max(abs(open_shift), abs(close_shift)) > MAX_SHIFT:
        raise ValueError("shift beyond three hours")

    def move(t: str) -> str:
        return t if t == "200000" else _shifted(t, open_shift if t <= "090000" else close_shift)

    return tuple((v, k, move(a), move(b), p) for v, k, a, b, p in WINDOWS)


def event_time(stream: Column, raw: Column, given: Column) -> Column:
    """The given event time, else the one in the payload that belongs to the stream's kind, else an empty text."""
    found = F.when(stream.isin(*TRADE_STREAMS), F.regexp_extract(raw, '"chetime"\\s*:\\s*"([^"]*)"', 1)).when(stream.isin(*QUOTE_STREAMS), F.regexp_extract(raw, '"hotime"\\s*:\\s*"([^"]*)"', 1))
    return F.coalesce(F.nullif(given, F.lit("")), found, F.lit(""))


def market_phase(venue: Column, stream: Column, time: Column, windows=WINDOWS) -> Column:
    """The first window that holds the time, or ``unclassified``."""
    kinds = {"trade": stream.isin(*TRADE_STREAMS), "quote": stream.isin(*QUOTE_STREAMS), None: F.lit(True)}
    valid = valid_hms(time) & stream.isin(*TRADE_STREAMS, *QUOTE_STREAMS)
    return first_case([(valid & (venue == v) & kinds[k] & (time >= a) & (time < b), F.lit(p)) for v, k, a, b, p in windows], "unclassified")


def annotate_market_phase(df: DataFrame, windows=WINDOWS) -> DataFrame:
    """Fill missing venue, stream and event time as older frames lack them, then add ``market_phase``."""
    have = set(df.columns)
    if "stream" not in have and "tr_id" not in have:
        raise ValueError("neither stream nor tr_id")
    defaults = {"venue": F.lit("krx"), "exchange_event_time": F.lit("")} | ({"stream": F.col("tr_id")} if "tr_id" in have else {})
    out = df.withColumns({n: c for n, c in defaults.items() if n not in have})
    out = out.withColumn("exchange_event_time", event_time(F.col("stream"), F.col("raw"), F.col("exchange_event_time")))
    return out.withColumn("market_phase", market_phase(F.col("venue"), F.col("stream"), F.col("exchange_event_time"), windows))


def auction_exempt(phase: Column, time: Column, hotime: Column) -> Column:
    """Whether a crossed book is legal: a known phase decides, clock windows only where the time is unknown."""
    legacy = F.lit(False)
    for lo, hi in LEGACY_AUCTIONS:
        legacy = legacy | ((hotime >= lo) & (hotime < hi))
    unknown = phase.isNull() | ((phase == "unclassified") & ~valid_hms(time))
    return F.coalesce(phase.isin(*AUCTION_PHASES), F.lit(False)) | F.coalesce(unknown & legacy, F.lit(False))


#: Fixed: token counts and positions of the microstructure fields, and their codes.
TRADE_TOKENS, QUOTE_TOKENS = 47, 63


def annotate_microstructure(df: DataFrame) -> DataFrame:
    """Nine fields of the payload; null for other vendors or streams, or another number of tokens."""
    parts = F.split("raw", "\\^")
    token = lambda i: F.get(parts, F.lit(i))
    trade = (F.col("vendor") == "kis") & (F.col("stream") == "H0STCNT0") & (F.size(parts) == TRADE_TOKENS)
    quote = (F.col("vendor") == "kis") & (F.col("stream") == "H0STASP0") & (F.size(parts) == QUOTE_TOKENS)
    ls_trade = (F.col("vendor") == "ls") & (F.col("stream") == "H0STCNT0")
    ls_quote = (F.col("vendor") == "ls") & (F.col("stream") == "H0STASP0")
    side, hour = F.get_json_object("raw", "$.body.cgubun"), token(2)
    positive = lambda c: F.when(c.try_cast("long") > 0, c.try_cast("long"))
    return df.withColumns(
        {
            "initiator": F.when(trade, F.when(token(21) == "1", "buy").when(token(21) == "5", "sell")).when(ls_trade, F.when(side == "+", "buy").when(side == "-", "sell")),
            "trading_halted": F.when(trade, token(35) == "Y"),
            "mkop_code": F.when(trade, F.nullif(token(34), F.lit(""))),
            "vi_base_price": F.when(trade, positive(token(45))),
            "hour_cls_code": F.when(quote, F.nullif(hour, F.lit(""))),
            "single_price": F.when(quote, hour.isin("A", "B", "C", "D")).when(ls_quote, F.get_json_object("raw", "$.body.donsigubun") == "3"),
            "vi_active": F.when(quote, hour == "C"),
            "expected_price": F.when(quote, positive(token(47))),
            "expected_qty": F.when(quote, positive(token(48))),
        }
    )


#: Fixed: session states of a day by start; the last holds to the end of the day.
STATES = (("000000", "closed"), ("080000", "premarket"), ("085000", "pre_open"), ("090000", "regular"), ("152000", "closing_auction"), ("153000", "post_close"), ("160000", "aftermarket"), ("200000", "closed"))


def session_state(time: Column) -> Column:
    """The schedule's state at a time of day; ``unknown`` if it is none."""
    return F.when(valid_hms(time), first_case([(time >= start, F.lit(name)) for start, name in reversed(STATES)])).otherwise("unknown")


def event_stamp(given: Column, raw: Column) -> Column:
    """The event time of a frame as HHMMSS: what the frame says, or, where that has no six digits, the trade or book time inside its payload; else null."""
    inside = F.regexp_extract(raw, '"(?:chetime|hotime)"\\s*:\\s*"([0-9]{6})"', 1)
    return F.when(given.rlike("^[0-9]{6}$"), given).otherwise(F.nullif(inside, F.lit("")))


def delivery_lag(recv_wall_ns: Column, hms: Column) -> Column:
    """Receive minus event time in seconds, on the receive day in Korea: under -60 is no lag, other negatives are 0."""
    lag = (recv_wall_ns / 1e9 + 9 * 3600) % 86400 - seconds_of(hms)
    return F.when(lag >= -60, F.greatest(lag, F.lit(0.0)))
