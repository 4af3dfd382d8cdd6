"""The pipeline's stages on a small table, each against what its operator says of its own input."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as p
from tests.oracle import DATA
from tickloom.llm.common import stage
from tickloom.llm.decontaminate import decontaminate
from tickloom.llm.simhash import near_duplicates


def test_stages(spark):
    sf = str(DATA / "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = docs.count()
    for name, apply in p.STAGES[:-1]:
        out = stage(apply(spark, docs, sf), name)
        assert out.columns == columns
        if name == "near_dedup":
            groups = near_duplicates(docs, wide=True).toPandas()
            assert sorted(r.doc_id for r in out.collect()) == sorted(groups.component_id.unique())
        if name == "decontamination":
            clean = {r.doc_id for r in decontaminate(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).where("not contaminated").collect()}
            assert {r.doc_id for r in out.collect()} == clean
        now = out.count()
        assert 0 < now < seen
        docs, seen = out, now
    pieces = p.packing(spark, docs, sf)
    assert pieces.select("doc_id").distinct().count() == seen
    assert pieces.groupBy("sequence_id").agg({"length": "sum"}).agg({"sum(length)": "max"}).first()[0] <= 2048
