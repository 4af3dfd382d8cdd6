"""Tables on storage: month-partitioned bars with keyed upserts, daily snapshots with first-wins keys, rewrites that verify."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.digest import table_digest
from tickloom.sources.scratch import staged

MONTH = "month"
#: Writer options of columnar frames: strong compression, dictionaries but for payloads, delta-packed integers.
FRAME_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20), "parquet.enable.dictionary#raw": "false", "parquet.enable.dictionary#exchange_event_time": "false", "parquet.writer.version": "PARQUET_2_0"}


#: Where a frame file says how it was written: metadata of its first column, which the footer keeps.
ENCODING_KEY, ENCODING = "frame_encoding", "v2"


def write_frames(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write frames with ``FRAME_OPTIONS`` and the mark of their encoding."""
    first, *rest = df.columns
    df.select(F.col(f"`{first}`").alias(first, metadata={ENCODING_KEY: ENCODING}), *[F.col(f"`{c}`") for c in rest]).write.mode(mode).options(**FRAME_OPTIONS).parquet(path)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """A row per Parquet file under ``path`` and column: file, rows, row_groups, encoding (its mark, null without), column, codec, dictionary.

    Footers are read in tasks, a file each; files are read as Spark's binary source does, so one is to be below 2 GB.
    """
    fields = "file string, rows long, row_groups long, encoding string, column string, codec string, dictionary boolean"

    def read(batches):
        import io
        import json

        import pyarrow as pa
        import pyarrow.parquet as pq

        names = [f.split()[0] for f in fields.split(", ")]
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                meta = pq.ParquetFile(io.BytesIO(content.as_py())).metadata
                kept = json.loads((meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b'{"fields": []}'))["fields"]
                mark = next((f["metadata"].get(ENCODING_KEY) for f in kept[:1]), None)
                chunks = [meta.row_group(g).column(c) for g in range(meta.num_row_groups) for c in range(meta.num_columns)]
                seen: dict[str, list] = {meta.schema.column(c).path: ["", False] for c in range(meta.num_columns)}
                for chunk in chunks:
                    seen[chunk.path_in_schema] = [chunk.compression, seen[chunk.path_in_schema][1] or chunk.has_dictionary_page]
                rows = [(file, meta.num_rows, meta.num_row_groups, mark, c, codec, used) for c, (codec, used) in seen.items()]
                yield pa.RecordBatch.from_arrays([pa.array(x) if n != "encoding" else pa.array(x, pa.string()) for n, x in zip(names, zip(*rows, strict=True), strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(read, fields)


def reencode(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Write the frames of all files under ``path`` that are not marked to ``target``; one row: files, already, rewritten, rows, status.

    Files with the mark are skipped, so a second run rewrites none. The new files are read again and must hold the same rows,
    by the digest of both tables, else the status is verify_failed; it is already_v2 where nothing was to do.
    """
    seen = footers(spark, path).select("file", F.col("encoding").eqNullSafe(ENCODING).alias("marked")).distinct().collect()  # a row per file, as a listing has
    todo = sorted(r.file for r in seen if not r.marked)
    facts = {"files": len(seen), "already": len(seen) - len(todo), "rewritten": len(todo)}
    one = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in facts.items()])
    if not todo:
        return one.select("*", F.lit(0).cast("long").alias("rows"), F.lit("already_v2").alias("status"))
    old = spark.read.parquet(*todo)
    write_frames(old, target, "append")
    new = table_digest(spark.read.schema(old.schema).parquet(target))
    both = table_digest(old).join(new.withColumnsRenamed({"rows": "_rows", "digest": "_digest"}))
    return one.join(both).select(*facts, "rows", F.when(F.col("digest") == F.col("_digest"), "reencoded").otherwise("verify_failed").alias("status"))


def with_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumn(MONTH, F.date_format(date_col, "yyyy-MM"))


def write_months(df: DataFrame, path: str, date_col: str = "date", order=("date", "symbol")) -> None:
    """Write a table by month, replacing only the months it has."""
    # ranges, so a month with most of the rows is written by several tasks
    rows = with_month(df, date_col).repartitionByRange(MONTH, *order).sortWithinPartitions(MONTH, *order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def scan_months(spark: SparkSession, path: str, schema: T.StructType, first: str | None = None, last: str | None = None, date_col: str = "date") -> DataFrame:
    """Rows between two dates; months outside are never listed, as the month is a partition and is bounded with the date."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])).parquet(path)
    if first:
        df = df.where((F.col(MONTH) >= first[:7]) & (F.col(date_col) >= F.lit(first).cast("date")))
    if last:
        df = df.where((F.col(MONTH) <= last[:7]) & (F.col(date_col) <= F.lit(last).cast("date")))
    return df.drop(MONTH)


def latest_date(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "date") -> DataFrame:
    """The largest date, read from the newest month alone."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])).parquet(path)
    newest = df.agg(F.max(MONTH).alias("m")).first().m
    return df.where(F.col(MONTH) == newest).agg(F.max(date_col).alias("latest"))


def upsert_months(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], date_col: str = "date") -> int:
    """Replace stored rows of the given keys and add the others, rewriting only the months touched; returns the number of new keys."""
    fields = T.StructType(rows.schema.fields)
    rows = staged(rows, "upsert-rows")
    # months are few, a row each
    months = [r[MONTH] for r in with_month(rows, date_col).select(MONTH).distinct().collect()]
    try:
        stored = spark.read.schema(T.StructType([*fields, T.StructField(MONTH, T.StringType())])).parquet(path).where(F.col(MONTH).isin(months)).drop(MONTH)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], fields)
    # the old rows are read while their folders are replaced: what is to be stored is a table of its own first, so a lost
    # executor or a failed write takes nothing with it
    new_keys = rows.select(*keys).distinct().join(stored.select(*keys), keys, "left_anti").count()
    kept = stored.join(rows.select(*keys), keys, "left_anti")
    write_months(staged(kept.unionByName(rows), "upsert-merged"), path, date_col)
    return new_keys


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many rows each table has beyond the other, counted with multiplicity."""
    left, right = a.exceptAll(b).agg(F.count("*").alias("only_left")), b.exceptAll(a).agg(F.count("*").alias("only_right"))
    return left.join(right)


def missing_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks; null parts of a key are equal."""
    left, right = a.select(*keys).distinct().alias("l"), b.select(*keys).distinct().alias("r")
    on = None
    for k in keys:
        same = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        on = same if on is None else on & same
    return left.join(right, on, "left_anti")


def append_snapshot(stored: DataFrame, batch: DataFrame, keys: list[str], violation, order: str = "seq") -> DataFrame:
    """A day's snapshot with a batch added: violating rows go, stored rows win over the batch, the batch's first over its later ones."""
    if set(stored.columns) != set(batch.columns):
        raise ValueError("the batch must have the snapshot's columns")
    both = stored.withColumn("_origin", F.lit(0)).unionByName(batch.where(~violation).withColumn("_origin", F.lit(1)))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("_origin", order))
    return both.withColumn("_n", first).where("_n = 1").drop("_n", "_origin")


def winning_run(tape: DataFrame) -> DataFrame:
    """All rows of each symbol's run with the most rows, the smallest run_id of equals."""
    sizes = tape.groupBy("symbol", "run_id").agg(F.count("*").alias("_rows"))
    best = sizes.withColumn("_n", F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("_rows").desc(), "run_id"))).where("_n = 1").select("symbol", "run_id")
    return tape.join(best, ["symbol", "run_id"], "left_semi")


def ledger_attempts(ledger: DataFrame) -> DataFrame:
    """Attempts of each (symbol, date): distinct runs, a run's numbered parts being one."""
    return ledger.groupBy("symbol", "date").agg(F.countDistinct(F.regexp_replace("run_id", "-\\d+$", "")).alias("attempts"))


def merge_news(stored: DataFrame, pages: DataFrame, key: str = "news_id") -> DataFrame:
    """New items of fetched pages (page, pos), in the order fetched, up to the page that first shows a stored item."""
    known = pages.join(stored.select(key).withColumn("_known", F.lit(True)), key, "left")
    stop = known.where("_known").agg(F.min("page").alias("_stop"))
    rows = known.join(F.broadcast(stop)).where("_known is null and (_stop is null or page <= _stop)")
    first = F.row_number().over(Window.partitionBy(key).orderBy("page", "pos"))
    return rows.withColumn("_n", first).where("_n = 1").select(*pages.columns)


#: Fixed: partition keys whose values are dropped, the rules that turn the parts of a name into templates, in order, and the
#: size below which an object is small.
PARTITION_KEY = "^(dt|date|day|session|year|month)=([0-9A-Za-z_-]+)(\\..+)?$"
TEMPLATE_RULES = (
    ("(?<!\\d)(\\d{4})-(\\d{2})-(\\d{2})(?!\\d)", "*"),
    ("(?<!\\d)((?:19|20)\\d{2})(0[1-9]|1[0-2])(0[1-9]|[12]\\d|3[01])(?!\\d)", "*"),
    ("(?<![\\d-])(\\d{4})-(0[1-9]|1[0-2])(?![\\d-])", "*"),
    ("^((?:19|20)\\d{2})(0[1-9]|1[0-2])(?=\\.)", "*"),
    ("(?<![A-Za-z0-9])[A-Z0-9]{2,}USDT(?![A-Za-z0-9])", "{sym}"),
    ("(?<![A-Za-z0-9])\\d{5}[0-9A-Z](?![A-Za-z0-9])", "{sym}"),
    ("(?<![0-9a-z])(?=[0-9a-f]*[a-f])[0-9a-f]{6,}(?![0-9a-z])", "*"),
    ("^\\d{2}(?=(?:\\.s\\d+)?\\.)", "{hh}"),
)
SMALL_BYTES = 64 * 1024
#: Rules that are dates; the first that a part has is its date.
_DATE_RULES = TEMPLATE_RULES[:4]


def _part_template(part):
    out = part
    for pattern, to in TEMPLATE_RULES:
        out = F.regexp_replace(out, pattern, to)
    return F.when(part.rlike(PARTITION_KEY), F.regexp_replace(part, PARTITION_KEY, "$1=*$3")).otherwise(out)


def _part_date(part):
    value = F.nullif(F.regexp_extract(part, PARTITION_KEY, 2), F.lit(""))
    found, rest = [], part
    for number, (pattern, to) in enumerate(_DATE_RULES):
        groups = 3 if number < 2 else 2
        texts = [F.regexp_extract(rest, pattern, k) for k in range(1, groups + 1)]
        found.append(F.when(texts[0] != "", F.concat_ws("-", *texts)))
        rest = F.regexp_replace(rest, pattern, to)
    return F.when(value.isNotNull(), F.when(value.rlike("^\\d{4}-\\d{2}(-\\d{2})?$"), value)).otherwise(F.coalesce(*found))


def path_template(path):
    """A path whose dates, symbols, hours and hashes are replaced, part by part."""
    return F.array_join(F.transform(F.split(path, "/"), _part_template), "/")


def path_date(path):
    """The first date that a path's parts carry, as YYYY-MM or YYYY-MM-DD."""
    return F.get(F.array_compact(F.transform(F.split(path, "/"), _part_date)), F.lit(0))


def catalog(listing: DataFrame, small: int = SMALL_BYTES) -> DataFrame:
    """Files, bytes, small files and dates by template of a listing (path, bytes)."""
    return listing.withColumns({"template": path_template(F.col("path")), "_day": path_date(F.col("path"))}).groupBy("template").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.count_if(F.col("bytes") < small).alias("small_files"), F.min("_day").alias("first_date"), F.max("_day").alias("last_date"))


def duplicate_names(listing: DataFrame) -> DataFrame:
    """Names that occur more than once (name, bytes, md5): identical if all have one size and one hash, which is known, else conflicting."""
    groups = listing.groupBy("name").agg(F.count("*").alias("copies"), F.countDistinct(F.struct("bytes", "md5")).alias("versions"), F.count_if(F.col("md5").isNull()).alias("unknown"))
    return groups.where("copies > 1").select("name", "copies", F.when((F.col("versions") == 1) & (F.col("unknown") == 0), "identical").otherwise("conflicting").alias("kind"))


def trading_rows(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Vendor rows (symbol, open, high, low, close, diff, volume, value as text) as bars: no prices but the close without trade, the base from the change, the value in hundred millions, with the listing class."""
    number = lambda n: F.regexp_replace(n, ",", "").try_cast("double")
    volume = F.regexp_replace("volume", ",", "").try_cast("long")
    prices = {n: F.when(volume != 0, number(n)) for n in ("open", "high", "low")}
    bars = rows.select("symbol", *[c.alias(n) for n, c in prices.items()], number("close").alias("close"), (number("close") - number("diff")).alias("base_price"), volume.alias("volume"), (number("value") / 1e8).alias("trade_value_100m"))
    return bars.join(classes, "symbol", "left")


def fallback_bars(rows: DataFrame, day: str) -> DataFrame:
    """Quotes (symbol, date, close, diff) as bars of one day: base = close - diff, change in percent, 0 where the base is 0."""
    base = F.col("close") - F.col("diff")
    return rows.where(F.col("date") == day).withColumns({"base_price": base, "daily_change_pct": F.coalesce(F.try_divide(F.col("diff") * 100.0, base), F.lit(0.0))})


def append_bars(spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType, keys=("date", "symbol")) -> DataFrame:
    """Bars added to a month store: cast to the schema with missing optional columns as nulls, bad rows left out, days of implausible height refused.

    Returns (date, rows, reference, plausible) of the days offered; only plausible ones are stored.
    """
    from tickloom.operators.validation import plausible_height, split_invalid

    have = set(rows.columns)
    cast = rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    valid, _ = split_invalid(cast)
    try:
        stored = scan_months(spark, path, schema).groupBy("date").agg(F.count("*").alias("rows"))
        stored.schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], "date date, rows long")
    offered = valid.groupBy("date").agg(F.count("*").alias("rows"))
    days = staged(plausible_height(stored.join(offered.select("date"), "date", "left_anti"), offered), "append-days")
    upsert_months(spark, path, valid.join(days.where("plausible").select("date"), "date", "left_semi").select(*schema.names), list(keys))
    return days


def retention(partitions: DataFrame, cutoff, verified: DataFrame, held: DataFrame) -> DataFrame:
    """``action`` for partitions (path, bytes, dt): deletable if past the cutoff, verified remotely by path and size, and not held."""
    rows = partitions.join(verified.select("path", "bytes").distinct().withColumn("_verified", F.lit(True)), ["path", "bytes"], "left").join(held.select("path").distinct().withColumn("_held", F.lit(True)), "path", "left")
    action = F.when(F.col("dt") >= F.lit(cutoff), "keep").when(F.col("_verified").isNull(), "unverified").when(F.col("_held").isNotNull(), "held").otherwise("delete")
    return rows.select("path", action.alias("action"))
