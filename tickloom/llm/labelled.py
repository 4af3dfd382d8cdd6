"""The bounded sample of labelled documents that the classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import crc_text

#: Bounds of the sample: documents of a label, characters of their texts, and documents of all labels.
PER_LABEL, LABEL_CHARS, MOST = 1500, 4 << 20, 6000
#: Characters of a slice of a long text.
SLICE = 512


def sliced(text, size, share):
    """``text`` where it is no longer than ``share``, else slices spread evenly over all of it that have about so many characters."""
    n = F.greatest(F.lit(1), F.floor(share / SLICE))
    at = lambda i: F.floor(i * (size - SLICE) / F.greatest(F.lit(1), n - 1)).cast("int") + 1
    parts = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.substring(text, at(i), F.lit(SLICE)))
    return F.when(size <= F.greatest(share, F.lit(SLICE)), text).otherwise(F.array_join(parts, "\n"))


def sample_of(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, per_label: int = PER_LABEL, label_chars: int = LABEL_CHARS, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y): labelled documents outside the held-out fold, drawn by a hash of the id.

    Drawn are rows that have a text, whatever their length, so a sample is full as long as there are such rows: of each label
    up to ``per_label`` documents, of all labels up to ``most``, an equal number of each. Where the texts of a label are
    longer than ``label_chars`` together, the longest give slices spread over the whole text instead, as long as fit for
    all; the shorter ones stay whole. Rows with a null id, label or text are left out; of repeated label rows the largest
    label counts, of several texts of one id the least; the held-out fold is where crc32 of the id as text leaves ``held``
    modulo ``folds``. Empty tables give an empty sample. Only ids and sizes are shuffled; the ids drawn, ``most`` at the most,
    are broadcast to the texts.
    """
    rows = labels.select(F.col(id_col).alias("i"), F.col(label).alias("y")).where("i is not null and y is not null").groupBy("i").agg(F.max("y").alias("y"))
    rows = rows.where(crc_text("i") % folds != held)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text")).where("i is not null and text is not null")
    sizes = texts.select("i", F.length("text").cast("long").alias("size")).groupBy("i").agg(F.max("size").alias("size"))
    drawn = rows.join(sizes, "i").withColumn("h", F.xxhash64("i")).withColumn("n", F.row_number().over(Window.partitionBy("y").orderBy("h", "i"))).where(F.col("n") <= per_label)
    # the share of a long text: what is left for it when all shorter ones stay whole
    up, all_ = Window.partitionBy("y").orderBy("size", "i"), Window.partitionBy("y")
    left = label_chars - (F.sum("size").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    share = F.floor(left / (F.count("*").over(all_) - F.row_number().over(up) + 1))
    fit = drawn.withColumn("_share", share).withColumn("share", F.coalesce(F.min(F.when(F.col("size") > F.col("_share"), F.struct("size", "i", "_share"))).over(all_)["_share"], F.lit(label_chars)))
    chosen = fit.orderBy("n", "y").limit(most).select("i", "y", "share")
    found = texts.join(F.broadcast(chosen), "i").groupBy("i").agg(F.first("y").alias("y"), F.first("share").alias("share"), F.min("text").alias("text"))
    return found.select(sliced(F.col("text"), F.length("text").cast("long"), F.col("share")).alias("text"), "y")
