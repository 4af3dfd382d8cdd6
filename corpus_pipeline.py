"""The corpus pipeline: quality, toxicity, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the columns of
``documents``. ``run`` writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tickloom.llm.common import stage
from tickloom.llm.decontaminate import decontaminate
from tickloom.llm.packing import packed_sequences
from tickloom.llm.quality import keep_good
from tickloom.llm.simhash import near_duplicates
from tickloom.llm.toxicity import keep_clean


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a good grade is at least a half."""
    return keep_good(docs, _labels(spark, sf_dir))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return keep_clean(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar texts; rows without an id belong to none and stay.

    Rows with one id are one document: that with the least text stays, a null being the greatest, of equal texts the
    row with the least other columns.
    """
    kept = near_duplicates(docs, wide=True).where("doc_id = component_id").select("doc_id").distinct()
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and isinstance(f.dataType, AtomicType)]
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), *others))
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn("_row_of_id", first).where("_row_of_id = 1")
    return named.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark; a hit in any row of an id removes the id."""
    hit = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").select(F.col("doc_id").alias("_hit_doc_id")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit_doc_id"]), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    import public_tokenizers

    return packed_sequences(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: SQL can't train the classifiers or run the tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
