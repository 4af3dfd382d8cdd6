"""Vendor payloads decoded to typed columns. A malformed payload gives a row of nulls, never a missing row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TICK_FIELDS = ("shcode", "price_raw", "cvolume_raw", "volume_raw", "change_raw", "sign", "drate_raw", "mdchecnt_raw", "mschecnt_raw")
LEVELS = 10
QUOTE_FIELDS = ("shcode", "hotime", "totofferrem", "totbidrem", *[f"{p}{k}" for p in ("offerho", "bidho", "offerrem", "bidrem") for k in range(1, LEVELS + 1)])
#: Fixed: positions of the caret-separated payloads, and the fewest fields they have.
KIS_TICK = {"shcode": 0, "price_raw": 2, "sign": 3, "change_raw": 4, "drate_raw": 5, "cvolume_raw": 12, "volume_raw": 13, "mdchecnt_raw": 15, "mschecnt_raw": 16}
KIS_QUOTE = {"shcode": 0, "hotime": 1, "offerho": 3, "bidho": 13, "offerrem": 23, "bidrem": 33, "totofferrem": 43, "totbidrem": 44}
KIS_TICK_LEAST, KIS_QUOTE_LEAST = 17, 45
#: Fixed: field names of the two JSON dialects with the common names.
LS_TICK = {"shcode": "shcode", "price_raw": "price", "cvolume_raw": "cvolume", "volume_raw": "volume", "change_raw": "change", "sign": "sign", "drate_raw": "drate", "mdchecnt_raw": "mdchecnt", "mschecnt_raw": "mschecnt"}
DB_TICK = {"shcode": "ShrnIscd", "price_raw": "StckPrpr", "cvolume_raw": "CntgVol", "volume_raw": "AcmlVol", "change_raw": "PrdyVrss", "sign": "PrdyVrsssign", "drate_raw": "PrdyCtrt", "mdchecnt_raw": "SelnCntgcsnu", "mschecnt_raw": "ShnuCntgcsnu"}
DB_QUOTE = {"shcode": "ShrnIscd", "hotime": "BsopHour", "totofferrem": "TotalAskprsqn", "totbidrem": "TotalBidprsqn", "offerho": "Askp", "bidho": "Bidp", "offerrem": "AskpRsqn", "bidrem": "BidpRsqn"}


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _body(raw: Column, names) -> Column:
    """The body object of a JSON payload; null fields where the payload is malformed."""
    schema = T.StructType([T.StructField("body", _strings(names))])
    return F.from_json(raw, schema)["body"]


def _unsigned(c: Column) -> Column:
    """Without one leading minus."""
    return F.regexp_replace(c, "^-", "")


def _with_parts(df: DataFrame, least: int) -> DataFrame:
    """``_parts``: the caret-separated fields of a payload, null if too few. A column of its own, so a row is split once for all its fields."""
    parts = F.split("raw", "\\^")
    return df.withColumn("_parts", F.when(F.size(parts) >= least, parts))


def kis_ticks(df: DataFrame) -> DataFrame:
    """Caret-separated trades; too few fields give nulls; one minus is taken off the change."""
    fields = {n: F.get("_parts", F.lit(i)) for n, i in KIS_TICK.items()}
    fields["change_raw"] = _unsigned(fields["change_raw"])
    return _with_parts(df, KIS_TICK_LEAST).withColumns({n: fields[n] for n in TICK_FIELDS}).drop("_parts")


def kis_quotes(df: DataFrame) -> DataFrame:
    """Caret-separated books; too few fields give nulls, as a field that is no whole number does."""

    def at(i: int) -> Column:
        return F.get("_parts", F.lit(i))

    out = {"shcode": at(0)} | {n: at(KIS_QUOTE[n]).try_cast("int") for n in ("hotime", "totofferrem", "totbidrem")}
    out |= {f"{p}{k}": at(KIS_QUOTE[p] + k - 1).try_cast("int") for p in ("offerho", "bidho", "offerrem", "bidrem") for k in range(1, LEVELS + 1)}
    return _with_parts(df, KIS_QUOTE_LEAST).withColumns({n: out[n] for n in QUOTE_FIELDS}).drop("_parts")


def ls_ticks(df: DataFrame) -> DataFrame:
    return _json_ticks(df, LS_TICK)


def db_ticks(df: DataFrame) -> DataFrame:
    out = _json_ticks(df, DB_TICK)
    return out.withColumn("change_raw", _unsigned(F.col("change_raw")))


def _json_ticks(df: DataFrame, names: dict[str, str]) -> DataFrame:
    with_body = df.withColumn("_body", _body(F.col("raw"), list(names.values())))
    return with_body.withColumns({n: F.col(f"_body.{names[n]}") for n in TICK_FIELDS}).drop("_body")


def ls_quotes(df: DataFrame) -> DataFrame:
    with_body = df.withColumn("_body", _body(F.col("raw"), QUOTE_FIELDS))
    return with_body.withColumns({n: F.col("_body.shcode") if n == "shcode" else F.col(f"_body.{n}").try_cast("int") for n in QUOTE_FIELDS}).drop("_body")


def db_quotes(df: DataFrame) -> DataFrame:
    """All fields must be there, or the whole row is null."""
    source = {n: DB_QUOTE[n] for n in ("shcode", "hotime", "totofferrem", "totbidrem")} | {f"{p}{k}": f"{DB_QUOTE[p]}{k}" for p in ("offerho", "bidho", "offerrem", "bidrem") for k in range(1, LEVELS + 1)}
    with_body = df.withColumn("_body", _body(F.col("raw"), list(source.values())))
    whole = F.array_compact(F.array(*[F.col(f"_body.{s}") for s in source.values()]))
    kept = with_body.withColumn("_body", F.when(F.size(whole) == len(source), F.col("_body")))
    return kept.withColumns({n: F.col(f"_body.{source[n]}") if n == "shcode" else F.col(f"_body.{source[n]}").try_cast("int") for n in QUOTE_FIELDS}).drop("_body")


_TOSS_LEVEL = T.ArrayType(_strings(("price", "volume")))
_TOSS = T.StructType([T.StructField("topic", T.StringType()), T.StructField("data", T.StructType([*_strings(("price", "volume", "timestamp")).fields, T.StructField("asks", _TOSS_LEVEL), T.StructField("bids", _TOSS_LEVEL)]))])


def _toss_symbol(topic: Column, kind: str) -> Column:
    return F.nullif(F.regexp_extract(topic, f"^{kind}:kr:(.+)$", 1), F.lit(""))


def toss_ticks(df: DataFrame) -> DataFrame:
    """Trades without cumulative fields: these are null."""
    m = df.withColumn("_m", F.from_json("raw", _TOSS))
    have = {"shcode": _toss_symbol(F.col("_m.topic"), "trade"), "price_raw": F.col("_m.data.price"), "cvolume_raw": F.col("_m.data.volume")}
    return m.withColumns({n: have.get(n, F.lit(None).cast("string")) for n in TICK_FIELDS}).drop("_m")


def toss_quotes(df: DataFrame) -> DataFrame:
    """Books with as many levels as sent: the rest are 0; the ISO time becomes Korean HHMMSS as a number."""
    m = df.withColumn("_m", F.from_json("raw", _TOSS))
    good = F.col("_m.data.asks").isNotNull() & F.col("_m.data.bids").isNotNull()
    kst = F.from_utc_timestamp(F.try_to_timestamp(F.col("_m.data.timestamp")), "Asia/Seoul")
    out = {"shcode": F.when(good, _toss_symbol(F.col("_m.topic"), "orderbook")), "hotime": F.when(good, F.hour(kst) * 10000 + F.minute(kst) * 100 + F.second(kst)), "totofferrem": F.lit(None).cast("int"), "totbidrem": F.lit(None).cast("int")}
    for p, side, field in (("offerho", "asks", "price"), ("bidho", "bids", "price"), ("offerrem", "asks", "volume"), ("bidrem", "bids", "volume")):
        for k in range(LEVELS):
            value = F.get(F.col(f"_m.data.{side}"), F.lit(k))[field]
            out[f"{p}{k + 1}"] = F.when(good, F.coalesce(value.try_cast("int"), F.lit(0)))
    return m.withColumns({n: out[n] for n in QUOTE_FIELDS}).drop("_m")


#: Decoders by vendor; add to it to read another dialect.
TICK_DECODERS = {"kis": kis_ticks, "ls": ls_ticks, "db": db_ticks, "toss": toss_ticks}
QUOTE_DECODERS = {"kis": kis_quotes, "ls": ls_quotes, "db": db_quotes, "toss": toss_quotes}
#: Vendors without cumulative or reference fields: rules on these are skipped, not passed.
NO_CUMULATIVE = ("toss",)


def decode(df: DataFrame, decoders=None) -> DataFrame:
    """Rows of all vendors through their decoders, in one pass; a null vendor is ``ls``; an unknown one fails the query.

    Each decoder sees the payloads of its own vendor and nulls for the others, and a row takes the fields of its vendor's.
    """
    decoders = decoders or TICK_DECODERS
    vendor = F.coalesce("vendor", F.lit("ls"))
    rows = df.withColumns({"vendor": F.when(vendor.isin(*decoders), vendor).otherwise(F.raise_error(F.concat(F.lit("unsupported vendor "), vendor))), "_raw": F.col("raw")})
    fields: list[str] = []
    for name, f in decoders.items():
        had = rows.columns
        out = f(rows.withColumn("raw", F.when(F.col("vendor") == name, F.col("_raw"))))
        own = [c for c in out.columns if c not in had]
        fields += [c for c in own if c not in fields]
        rows = out.select(*had, F.struct(*own).alias(f"_of_{name}"))
    picked = {c: F.coalesce(*[F.when(F.col("vendor") == n, F.col(f"_of_{n}.{c}")) for n in decoders]) for c in fields}
    kept = {c: F.col("_raw") if c == "raw" else F.col(c) for c in df.columns}
    return rows.select(*[v.alias(c) for c, v in kept.items()], *[v.alias(c) for c, v in picked.items()], (~F.col("vendor").isin(*NO_CUMULATIVE)).alias("cum_applicable"))


def kis_envelope(df: DataFrame, fields: int) -> DataFrame:
    """`flag|tr_id|count|body` with ``count`` rows of ``fields`` fields: one row each; a wrong count gives none."""
    parts = F.split("raw", "\\|")
    values = F.split(F.get(parts, F.lit(3)), "\\^")
    count = F.get(parts, F.lit(2)).try_cast("int")
    good = (F.size(parts) == 4) & (count >= 1) & (F.size(values) == count * fields)
    rows = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.array_join(F.slice(values, i * fields + 1, fields), "^"))
    return df.withColumns({"tr_id": F.get(parts, F.lit(1)), "_rows": F.when(good, rows)}).select("*", F.posexplode("_rows").alias("row", "frame")).drop("_rows")


def audit_body(df: DataFrame) -> DataFrame:
    """Common counters of kis, ls and kiwoom trades; signs are taken off kiwoom's price and volume."""
    parts = F.split("raw", "\\^")
    ls = _body(F.col("raw"), ("shcode", "price", "cvolume", "volume", "chetime"))
    kw = F.from_json("raw", T.StructType([T.StructField("item", T.StringType()), T.StructField("values", _strings(("10", "15", "13", "20")))]))
    size_ok = F.size(parts) >= KIS_TICK_LEAST

    def pick(i: int, name: str, kiwoom: Column) -> Column:
        return F.when(F.col("vendor") == "kis", F.when(size_ok, F.get(parts, F.lit(i)))).when(F.col("vendor") == "kiwoom", kiwoom).otherwise(ls[name])

    bare = lambda c: F.ltrim(c, F.lit("+-"))
    return df.withColumns(
        {
            "shcode": pick(0, "shcode", kw["item"]),
            "chetime": pick(1, "chetime", kw["values"]["20"]),
            "price": pick(2, "price", bare(kw["values"]["10"])).try_cast("long"),
            "cvolume": pick(12, "cvolume", bare(kw["values"]["15"])).try_cast("long"),
            "volume": pick(13, "volume", kw["values"]["13"]).try_cast("long"),
        }
    )
