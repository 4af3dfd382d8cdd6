"""Token-id files of patched frame-of-reference blocks: written and read by Spark in document order.

A file is a run of segments, each followed by a line feed. A segment is, little-endian: the magic, the file number, the
segment's number, documents, ids and blocks (32 bit each but the ids, 64), then document ids (64), their validity (8),
their lengths (64), the index of block starts in the packed words (64), block minima (32), block widths (8), exceptions
by block (8), the packed words (64), exception positions (8) and exception values (32).

A block is 128 ids less their minimum, packed at the width that covers a chosen share of them; the low bits of larger
ones are packed too, and their high bits stand in the block's exception list.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import new_path, stage
from tickloom.llm.tokens import pieces, text_groups

MAGIC = b"PFR1"
BLOCK = 128
HEAD = struct.Struct("<4sIIIQI")
#: Ids of a segment; one document is never split over two.
SEGMENT_IDS = 1 << 21


def encode_blocks(ids: np.ndarray, share: float = 0.9) -> tuple[np.ndarray, ...]:
    """(index, minima, widths, exceptions by block, words, positions, values) of 32-bit ids."""
    n = -(-len(ids) // BLOCK)
    padded = np.full(n * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(n, BLOCK)
    low = rows.min(axis=1) if n else np.zeros(0, np.uint32)
    diff = rows - low[:, None]
    at = min(BLOCK - 1, int(share * BLOCK))
    pivot = np.partition(diff, at, axis=1)[:, at] if n else low
    widths = np.ceil(np.log2(pivot.astype(np.float64) + 1)).astype(np.int64)
    index = np.concatenate([[0], np.cumsum(2 * widths)]).astype(np.uint64)
    words = np.zeros(int(index[-1]), np.uint64)
    over = (diff >> np.minimum(widths, 31)[:, None].astype(np.uint32)) > 0
    over &= (widths < 32)[:, None]
    for w in np.unique(widths[widths > 0]).tolist():
        chosen = np.flatnonzero(widths == w)
        values = (diff[chosen] & np.uint32((1 << w) - 1)).T.astype(np.uint64)
        packed = np.zeros((2 * w, len(chosen)), np.uint64)
        for j in range(BLOCK):
            word, bit = divmod(j * w, 64)
            packed[word] |= values[j] << np.uint64(bit)
            if bit + w > 64:
                packed[word + 1] |= values[j] >> np.uint64(64 - bit)
        words[(index[chosen].astype(np.int64)[:, None] + np.arange(2 * w)).ravel()] = packed.T.ravel()
    row, position = np.nonzero(over)
    return index, low, widths.astype(np.uint8), over.sum(axis=1).astype(np.uint8), words, position.astype(np.uint8), (diff[row, position] >> widths[row].astype(np.uint32)).astype(np.uint32)


def decode_blocks(index, low, widths, exceptions, words, position, values, n_ids: int) -> np.ndarray:
    """The ids of :func:`encode_blocks`."""
    n = len(low)
    diff = np.zeros((n, BLOCK), np.uint32)
    wide = widths.astype(np.int64)
    for w in np.unique(wide[wide > 0]).tolist():
        chosen = np.flatnonzero(wide == w)
        packed = words[index[chosen].astype(np.int64)[:, None] + np.arange(2 * w)].T.copy()
        mask, out = np.uint64((1 << w) - 1), np.zeros((BLOCK, len(chosen)), np.uint32)
        for j in range(BLOCK):
            word, bit = divmod(j * w, 64)
            value = packed[word] >> np.uint64(bit)
            if bit + w > 64:
                value = value | (packed[word + 1] << np.uint64(64 - bit))
            out[j] = (value & mask).astype(np.uint32)
        diff[chosen] = out.T
    row = np.repeat(np.arange(n), exceptions)
    diff[row, position] |= values << wide[row].astype(np.uint32)
    return (diff + low[:, None]).ravel()[:n_ids]


def write_segment(file: int, number: int, doc_ids: np.ndarray, valid: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    index, low, widths, exceptions, words, position, values = encode_blocks(ids)
    parts = [doc_ids.astype("<i8"), valid.astype("u1"), sizes.astype("<u8"), index.astype("<u8"), low.astype("<u4"), widths, exceptions, words.astype("<u8"), position, values.astype("<u4")]
    return HEAD.pack(MAGIC, file, number, len(doc_ids), len(ids), len(low)) + b"".join(x.tobytes() for x in parts)


def read_segments(content: bytes):
    """(file, number, doc_ids, valid, sizes, ids) of each segment of a file."""
    at = 0
    while at < len(content):
        magic, file, number, docs, n_ids, blocks = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        doc_ids, valid, sizes, index, low, widths, exceptions = take("<i8", docs), take("u1", docs), take("<u8", docs), take("<u8", blocks + 1), take("<u4", blocks), take("u1", blocks), take("u1", blocks)
        words = take("<u8", int(index[-1]))
        count = int(exceptions.sum())
        position, values = take("u1", count), take("<u4", count)
        yield file, number, doc_ids, valid.astype(bool), sizes.astype(np.int64), decode_blocks(index, low, widths, exceptions, words, position, values, n_ids)
        at += 1


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents under ``path``, in ascending order of the id over the files and in each.

    Rows are dealt by ranges of the id, so a hot source spreads; a null id comes first; repeated ids stay in one range.
    Ids are whole numbers, as the format keeps them in 64 bits. Without ``files`` there are as many as splits of the
    input, so their size stays that of a split however large the corpus is.
    """
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"token files need whole numbers as ids, not {kind.simpleString()}")

    def encode(batches):
        from pyspark import TaskContext

        table, file, number = pieces(tokenizer), TaskContext.get().partitionId(), 0
        keys, flats, sizes, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, held
            key = pa.concat_arrays(keys).cast(pa.int64())
            image = write_segment(file, number, key.fill_null(0).to_numpy(zero_copy_only=False), key.is_valid().to_numpy(zero_copy_only=False), np.concatenate(sizes), np.concatenate(flats))
            number += 1
            keys.clear(), flats.clear(), sizes.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array([image], pa.binary())], ["image"])

        for batch in batches:
            for part, texts in text_groups(batch, "t"):
                flat, size = table.encode(texts)
                flats.append(np.insert(flat, np.cumsum(size), end_id))
                sizes.append(size + 1)
                keys.append(part.column("i"))
                held += len(flats[-1])
                if held >= SEGMENT_IDS:
                    yield close()
        if held:
            yield close()

    source = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    dealt = source.repartitionByRange(files or max(source.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism), "i")
    images = dealt.sortWithinPartitions("i", "t").mapInArrow(encode, "image binary")
    images.select(F.col("image").cast("string").alias("value")).write.text(path)


def read_token_files(spark, path: str) -> DataFrame:
    """Per document: file, place in it, doc_id, ids before it in its file, n_tokens and the crc32 of its ids."""

    def decode(batches):
        for batch in batches:
            for content in batch.column("content"):
                before, place = 0, 0
                for file, _, doc_ids, valid, sizes, ids in read_segments(content.as_py()):
                    ends = np.cumsum(sizes)
                    raw = ids.astype("<u4")
                    crc = [zlib.crc32(raw[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                    n = len(doc_ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, file), pa.int64()), pa.array(place + np.arange(n), pa.int64()), pa.array(doc_ids, pa.int64(), mask=~valid), pa.array(before + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                        ["file", "place", "doc_id", "before", "n_tokens", "ids_crc32"],
                    )
                    before += int(ends[-1]) if n else 0
                    place += n

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(decode, "file long, place long, doc_id long, before long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None, files: int | None = None) -> DataFrame:
    """Write token files, read them back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A null or empty text is the end id alone; a null id is kept and comes first; rows of one id follow each other in the order
    of their texts, a null first; long texts are cut where no token reaches across; other
    columns are ignored; an empty table gives no rows. Only one row per file is ordered over all files.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "ids")
    write_token_files(docs, path, tokenizer, end_id, files)
    read = stage(read_token_files(spark, path), "ids-read")
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    starts = totals.select("file", (F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    return read.join(starts, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
