"""Raw frames on storage: line files of compressed JSON envelopes, read strictly or up to a tear, with the route in the path."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import any_of, require

#: The envelope; vendor numbers stay text until decoded.
_LONGS = ("recv_mono_ns", "recv_wall_ns", "conn_seq")
_NAMES = ("raw", "recv_mono_ns", "recv_wall_ns", "conn_id", "conn_seq", "vendor", "tr_id", "venue", "session", "stream", "symbol", "exchange_event_time")
SCHEMA = T.StructType([T.StructField(n, T.LongType() if n in _LONGS else T.StringType()) for n in _NAMES])
REQUIRED = ("raw", "recv_mono_ns", "recv_wall_ns", "conn_id", "conn_seq", "vendor", "tr_id")
#: Fixed: sessions a path may name.
SESSIONS = ("regular", "premarket", "aftermarket")


def _folders(path):
    """The four folders above the first `dt=...` that has as many. The pattern starts where a folder's name does: tried from
    every character it takes time with the square of the path's length."""
    return F.split(F.regexp_extract(path, "(?<![^/])([^/]+/[^/]+/[^/]+/[^/]+)/dt=[^/]+/", 1), "/")


def route(path, folders=None):
    """(vendor, venue, session, stream) of `vendor/venue/session/stream/dt=...`; without a known session it is krx and regular."""
    folders = _folders(path) if folders is None else folders
    part = lambda i: F.get(folders, F.lit(i - 1))
    known = part(3).isin(*SESSIONS)
    legacy = F.regexp_extract(path, "(?<![^/])([^/]+)/dt=[^/]+/", 1)
    return {"vendor": F.when(known, part(1)), "venue": F.when(known, part(2)).otherwise("krx"), "session": F.when(known, part(3)).otherwise("regular"), "stream": F.when(known, part(4)).otherwise(F.nullif(legacy, F.lit("")))}


def fill_defaults(df: DataFrame, path) -> DataFrame:
    """Missing route fields from the path, other missing texts as empty; a null in a required column fails the query."""
    checked = require(df, any_of([F.col(n).isNull() for n in REQUIRED]), "null in a required column")
    # a column of its own, so a row's path is matched once for all fields
    placed, r = checked.withColumn("_folders", _folders(path)), route(path, F.col("_folders"))
    return placed.withColumns({"venue": F.coalesce("venue", r["venue"]), "session": F.coalesce("session", r["session"]), "stream": F.coalesce("stream", "tr_id", r["stream"]), "symbol": F.coalesce("symbol", F.lit("")), "exchange_event_time": F.coalesce("exchange_event_time", F.lit(""))}).drop("_folders")


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """Frames of a folder of line files; a malformed line fails the query. Files of many compressed frames are read whole."""
    df = spark.read.schema(SCHEMA).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)
    return fill_defaults(df, F.col("_metadata.file_path"))


def decode_envelopes(lines: DataFrame) -> DataFrame:
    """Typed envelopes of text lines (value); a line whose payload isn't text or whose receive time isn't a number is dropped."""
    return lines.withColumn("e", F.from_json("value", SCHEMA)).where("e.raw is not null and e.recv_wall_ns is not null").select(*[c for c in lines.columns if c != "value"], "e.*")


def read_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """(file, value, truncated): the lines of zstd files up to where each is torn; ``truncated`` marks every line of a torn file."""

    def lines(batches):
        import zstandard

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data, out, torn = content.as_py(), [], False
                while data:
                    frame = zstandard.ZstdDecompressor().decompressobj()
                    try:
                        out.append(frame.decompress(data))
                    except zstandard.ZstdError:
                        torn = True
                        break
                    if not frame.eof:
                        torn = True
                        break
                    data = frame.unused_data
                text = b"".join(out)
                complete = text[: text.rfind(b"\n") + 1]
                torn = torn or len(complete) < len(text)
                rows = complete.decode("utf-8", "replace").splitlines()
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(rows, pa.string()), pa.array([torn] * len(rows), pa.bool_())], ["file", "value", "truncated"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zst").load(path).select("path", "content")
    return files.mapInArrow(lines, "file string, value string, truncated boolean")


def json_lines(df: DataFrame) -> DataFrame:
    """Rows as text lines of JSON, to be written with a text writer."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def read_log(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """An append log of JSON lines; blank lines and values that are no objects are left out.

    A malformed line is left out only if a write was torn there: it is the last of its file and no line feed follows. Any
    other one raises, after a pass over the files that gives a row per file with such a line. Without ``strict`` all
    malformed lines are left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    bad = (F.trim("value") != "") & F.try_parse_json("value").isNull()
    if strict:
        placed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
        files = placed.groupBy("file", "size").agg(F.count_if(bad).alias("bad"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.max_by(bad, F.struct("block", "at")).alias("last_bad"))
        torn = F.when(F.col("last_bad") & (F.col("bytes") > F.col("size")), 1).otherwise(0)
        if (first := files.where(F.col("bad") > torn).first()) is not None:
            raise ValueError(f"malformed line in {first.file}")
    rows = lines.where(~bad & F.ltrim("value").startswith("{"))
    return rows.select(F.from_json("value", T.StructType.fromDDL(schema)).alias("e")).select("e.*")


def write_zstd_frames(path: str, groups: list[list[dict]], tear: int = 0) -> None:
    """A small fixture file: one compressed frame per group of rows, with ``tear`` bytes cut off its end."""
    import zstandard

    raw = b"".join(zstandard.ZstdCompressor().compress("".join(json.dumps(r) + "\n" for r in g).encode()) for g in groups)
    with open(path, "wb") as f:
        f.write(raw[: len(raw) - tear] if tear else raw)
