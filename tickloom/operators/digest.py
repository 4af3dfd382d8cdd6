"""A digest of a table that depends on its rows only, not on their order or on how they are dealt over files and tasks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose hashes are put together in one text.
BLOCK_ROWS = 4096


def row_text(df: DataFrame):
    """A row as text that no other row has: values by name of column, each with its length, a null as a dash."""
    one = lambda c: F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.concat_ws(",", *[one(F.col(f"`{c}`").cast("string")) for c in sorted(df.columns)])


def _hashed(batches):
    """The hash of the blocks' hashes in order; one block is its own."""
    import hashlib

    text, only = hashlib.sha256(), None
    for rows in batches:
        for digits, key, one in zip(rows["digits"], rows["key"], rows["hash"]):
            text.update(f"{'' if only is None else ','}{key}:{one}".encode())
            only = one if not digits else ""
    if only is not None:
        yield pd.DataFrame({"entry": [only or text.hexdigest()]})


def table_digest(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: ``rows`` and ``digest``, SHA-256 in hex of the table's rows as a multiset.

    Rows are hashed; equal ones are counted, so copies are one entry. Hashes are dealt by their first digits, as many as give
    blocks of about ``block_rows``, sorted and hashed again; the hashes of the blocks, in order, are hashed once more as they
    pass, so no task holds more than a block or a batch. How many digits follows from the number of different rows, so equal
    tables have equal digests. An empty table has the hash of the empty text. Columns must have a text form (no maps).
    """
    counted = df.select(F.sha2(row_text(df), 256).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    facts = counted.agg(F.count("*").alias("different"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.greatest(F.lit(1.0), F.col("different") / F.lit(float(block_rows)))))).cast("int")
    sized = facts.select("rows", digits.alias("digits"))
    entries = counted.join(F.broadcast(sized)).select("digits", F.expr("substring(h, 1, digits)").alias("key"), F.concat_ws(":", "h", F.col("n").cast("string")).alias("entry"))
    blocks = entries.groupBy("digits", "key").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("entry")), ","), 256).alias("hash"))
    whole = blocks.repartition(1).sortWithinPartitions("key").mapInPandas(_hashed, "entry string")
    return sized.join(F.broadcast(whole), how="left").select("rows", F.coalesce("entry", F.sha2(F.lit(""), 256)).alias("digest"))
