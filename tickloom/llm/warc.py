"""WARC archives written and read by Spark, with records found by verifying the chain of their boundaries.

The reader splits files at the magic, so tasks read byte ranges of any file. Each piece is a candidate record with a
successor offset; pointer jumping from the start of each file keeps the records that the chain reaches. A magic inside a
payload is a candidate that nothing true points at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import BROADCAST_ROWS, new_path, stage

#: Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are always stored.
LEAST = 1000
#: Bytes of a file in which pieces are matched with the records they may belong to.
BIN = 1 << 18


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row, a file per task.

    Of equal payloads of at least ``LEAST`` bytes the largest id is a response and the rest revisit it. The table of
    repeated payloads is broadcast under ``BROADCAST_ROWS`` rows; above, the join is shuffled and a hot payload's rows
    can be split by adaptive execution. A null text is an empty payload; rows repeated with the largest id are all
    responses; a row with a null id is never the one referred to.
    """
    payload = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.col("bytes") >= LEAST)
    repeated = stage(large.groupBy("digest", "bytes").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"), "repeated")
    few = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(repeated) if few else repeated, ["digest", "bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))

    def field(name: str, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20]+", "")
    head = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))),
        field("WARC-Date", F.lit(date)),
        F.when(uri != "", field("WARC-Target-URI", uri)).otherwise(""),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit(REVISIT_PROFILE)), field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))))).otherwise(""),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("X-Payload-Length", F.col("bytes").cast("string")),
        field("Content-Type", F.lit("text/html")),
        field("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"),
    )
    record = F.concat(F.encode(head, "UTF-8"), F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload")))
    joined.select(record.cast("string").alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Every piece between magics, with its file, split and order in the split."""
    read = spark.read.option("lineSep", MAGIC).option("pathGlobFilter", "part-*").text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("mid"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate records: file, split, place in the split, offset, header fields and the successor's offset."""
    break_at = F.locate(END, F.col("value"))
    head = F.when(break_at > 0, F.concat(F.lit("\r\n"), F.substring(F.col("value"), F.lit(1), break_at - 1), F.lit("\r\n")))

    def field(name: str, pattern: str):
        return F.nullif(F.regexp_extract(F.col("head"), f"\r\n{name}: {pattern}\r\n", 1), F.lit(""))

    rows = _pieces(spark, path).withColumn("head", head).withColumn("size", F.octet_length("value").cast("long"))
    rows = rows.withColumn("body_at", F.octet_length("head").cast("long")).withColumn("length", field("Content-Length", "(\\d{1,18})").cast("long"))
    whole = F.col("body_at") + F.col("length") <= F.col("size")
    body = F.substring(F.col("value").cast("binary"), (F.col("body_at") + 1).cast("int"), F.col("length").cast("int"))
    narrow = rows.select(
        "file", "file_size", "split", "mid", "size", "body_at", "length",
        field("WARC-Type", "(\\S+)").alias("type"),
        field("WARC-Record-ID", "<urn:page:([^>]*)>").alias("id"),
        field("WARC-Refers-To", "<urn:page:([^>]*)>").alias("refers"),
        field("WARC-Payload-Digest", "sha1:(\\w+)").alias("digest"),
        field("X-Payload-Length", "(\\d{1,18})").cast("long").alias("payload_length"),
        F.when(whole, F.sha1(body)).alias("body_digest"),
    )
    narrow = stage(narrow, "warc-pieces")
    taken = F.col("size") + len(MAGIC)
    per_split = narrow.groupBy("file", "split").agg(F.sum(taken).alias("n"), F.min("mid").alias("first"))
    up = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, 0)
    bases = per_split.select("file", "split", "first", (F.sum("n").over(up) - F.col("n")).alias("base"))
    inside = Window.partitionBy("file", "split").orderBy("mid").rowsBetween(Window.unboundedPreceding, 0)
    placed = narrow.withColumn("upto", F.sum(taken).over(inside)).join(bases, ["file", "split"])
    text_at = F.col("base") + F.col("upto") - taken
    found = placed.withColumn("place", F.col("mid") - F.col("first")).withColumn("offset", text_at - len(MAGIC)).where("offset >= 0")
    follows = F.col("offset") + len(MAGIC) + F.col("body_at") + F.col("length") + len(END)
    return stage(found.select("file", "file_size", "split", "place", "offset", "size", "body_at", "length", "type", "id", "refers", "digest", "payload_length", "body_digest", follows.alias("next")), "warc-candidates")


def reachable(found: DataFrame) -> DataFrame:
    """The candidates on the chain from offset 0 of their file.

    Candidates that simply follow each other within a split are one run; runs also begin where any other link points.
    Pointer jumping then works on runs, in rounds that double the distance; each round is a written table.
    """
    order = Window.partitionBy("file", "split").orderBy("place")
    linked = found.withColumn("chained", F.coalesce(F.lag("next").over(order) == F.col("offset"), F.lit(False))).withColumn("leads", F.coalesce(F.lead("offset").over(order) == F.col("next"), F.lit(False)))
    targets = linked.where(~F.col("leads") & F.col("next").isNotNull()).select("file", F.col("next").alias("offset"), F.lit(True).alias("target")).distinct()
    headed = linked.join(targets, ["file", "offset"], "left").withColumn("head", ~F.col("chained") | F.coalesce("target", F.lit(False)))
    runs = stage(headed.withColumn("run", F.max(F.when(F.col("head"), F.col("offset"))).over(order.rowsBetween(Window.unboundedPreceding, 0))), "warc-runs")
    jump = stage(runs.groupBy("file", F.col("run").alias("at")).agg(F.max_by("next", "offset").alias("to")), "warc-jumps")
    heads = jump.select("file", F.col("at").alias("to"))
    reach = stage(jump.where("at = 0").select("file", "at"), "warc-reach")
    count = reach.count()
    while True:
        step = reach.join(jump, ["file", "at"]).select("file", "to").join(heads, ["file", "to"]).select("file", F.col("to").alias("at"))
        reach = stage(reach.unionByName(step).distinct(), "warc-reach")
        if (now := reach.count()) == count:
            break
        count = now
        jump = stage(jump.join(jump.select("file", F.col("at").alias("to"), F.col("to").alias("then")), ["file", "to"]).select("file", "at", F.col("then").alias("to")), "warc-jumps")
    return runs.join(reach.select("file", F.col("at").alias("run")), ["file", "run"], "left_semi")


def _joined_payloads(spark: SparkSession, path: str, broken: DataFrame, found: DataFrame) -> DataFrame:
    """(file, offset, body_digest) of records whose payload holds the magic: their pieces are put together again."""
    # both sides are cut into bins of the file, so a record meets only pieces near it
    spans = broken.select("file", "offset", "body_at", "length", "next", F.explode(F.sequence(F.expr(f"offset div {BIN}"), F.expr(f"next div {BIN}"))).alias("bin"))
    pieces = found.select("file", "split", "place", F.col("offset").alias("piece"), F.col("size").alias("piece_size"), F.expr(f"offset div {BIN}").alias("bin"))
    parts = pieces.join(spans, ["file", "bin"]).where((F.col("piece") >= F.col("offset")) & (F.col("piece") < F.col("next") - len(END))).drop("bin")
    splits = parts.select("file", "split").distinct()
    texts = _pieces(spark, path).join(splits, ["file", "split"], "left_semi").select("file", "split", "mid", "value")
    texts = texts.withColumn("place", F.row_number().over(Window.partitionBy("file", "split").orderBy("mid")).cast("long") - 1).drop("mid")
    whole = parts.join(texts, ["file", "split", "place"]).groupBy("file", "offset", "body_at", "length").agg(F.array_sort(F.collect_list(F.struct("piece", F.col("value").cast("binary").alias("value")))).alias("parts"))
    text = F.aggregate("parts", F.lit("").cast("binary"), lambda acc, x: F.concat(acc, F.lit(MAGIC).cast("binary"), x["value"]))
    return whole.select("file", "offset", F.sha1(F.substring(text, (F.col("body_at") + 1 + len(MAGIC)).cast("int"), F.col("length").cast("int"))).alias("joined_digest"))


def read_warc(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, and whether the header's digest holds."""
    found = candidates(spark, path)
    kept = reachable(found)
    broken = stage(kept.where("body_digest is null").select("file", "offset", "body_at", "length", "next"), "warc-broken")
    if not broken.isEmpty():
        kept = kept.join(_joined_payloads(spark, path, broken, found), ["file", "offset"], "left").withColumn("body_digest", F.coalesce("body_digest", "joined_digest"))
    revisit = F.col("type") == "revisit"
    digest = F.when(revisit, F.col("digest")).otherwise(F.col("body_digest"))
    return kept.select(
        F.col("id").try_cast(id_type).alias("page_id"),
        F.when(revisit, F.col("payload_length")).otherwise(F.col("length")).alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers").try_cast(id_type).alias("refers_to"),
        (digest == F.col("digest")).alias("digest_holds"),
    )


def archived_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and read them back; an empty table gives no rows, other columns are ignored."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path, pages.schema["page_id"].dataType.simpleString())
