"""Token counts: batches balanced by bytes are encoded in an Arrow function that returns lengths only."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import spread
from tickloom.llm.tokens import pieces, text_groups


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, and whether the tokens exceed ``limit``.

    Map only over the splits of the input, which are balanced by bytes (a small input of few splits is dealt over the
    cores): a hot source or repeated rows change nothing; every input row gives one row, an empty table none. A null or
    empty text has 0 bytes and 0 tokens; a null id stays null. Long texts are cut where no token can cross. Other columns
    are ignored.
    """

    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    size = F.coalesce(F.octet_length("t"), F.lit(0)).cast("long")
    id_type = source.schema["i"].dataType.simpleString()

    def run(batches):
        table = pieces(tokenizer)
        for batch in batches:
            for part, texts in text_groups(batch, "t"):
                yield pa.RecordBatch.from_arrays([part.column("i"), part.column("b"), pa.array(table.counts(texts), pa.int64())], ["i", "b", "n"])

    counted = source.withColumn("b", size).mapInArrow(run, f"i {id_type}, b long, n long")
    return counted.select(F.col("i").alias("doc_id"), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))
