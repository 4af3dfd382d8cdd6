"""Helpers shared by the operators: shared folder, staged tables, Arrow text access, word hashing."""

from __future__ import annotations

import atexit
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows up to which a side of a join is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 100_000
#: Bytes of text hashed at once inside a task.
SEGMENT = 1 << 21


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where it is unset, a local session, as in tests, gets one of its own; on a cluster that folder would be another one on
    every machine, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm"


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder in the shared one; removed when the driver ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may already be gone; the folder is scratch
        return


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: lineage is cut, a lost executor loses nothing."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, times: int = 4) -> DataFrame:
    """``df`` dealt over the cores, ``times`` parts each, where its input is in fewer splits than cores, as one small file is; else as it is.

    Splits of a large input are balanced by bytes already, so it is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(times * cores)


def crc_text(col):
    """crc32 of an id as text."""
    from pyspark.sql import functions as F

    return F.crc32(F.col(col).cast("string").cast("binary"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(off) else np.zeros(0, np.uint8)
    return raw, off - off[0]


def byte_chunks(batch: pa.RecordBatch, name: str, limit: int = 8 << 20):
    """Slices of a batch with at most ``limit`` bytes of text, or one row."""
    column = batch.column(name)
    _, off = text_bytes(column)
    lo = 0
    while lo < len(batch):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_groups_of(batch: pa.RecordBatch, id_name: str, name: str, limit: int = 2 << 20):
    """(ids, texts) of a batch in groups of about ``limit`` bytes of text."""
    for part in byte_chunks(batch, name, limit):
        yield part.column(id_name).to_pylist(), part.column(name).to_pylist()


_HELD: dict = {}


def hold(key, make=lambda: None):
    """What a worker keeps from task to task under ``key``. It keeps one thing only: an operator that starts frees the one before."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, SEGMENT + 4096)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 2 * SEGMENT:
            _POWERS[int(base)] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
#: Bytes of words `[^\x20\x09-\x0D]+`.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, a-z and all of non-ASCII.
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False


def word_spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row): runs of bytes in ``inside``, never across rows."""
    heads = off[:-1][np.diff(off) > 0]
    starts, ends = [], []
    for lo in range(0, len(data), SEGMENT):  # masks are held for a segment of a long text only
        hi = min(len(data), lo + SEGMENT)
        m = inside[data[max(0, lo - 1) : hi + 1]]
        own = m[1:] if lo else m
        own, first = own[: hi - lo], np.ones(hi - lo, bool)
        before = m[: hi - lo] if lo else np.concatenate([[False], m[: hi - 1]])
        np.logical_not(before, out=first)
        here = heads[np.searchsorted(heads, lo) : np.searchsorted(heads, hi)] - lo
        first[here] = True
        starts.append(np.flatnonzero(own & first) + lo)
        last = np.ones(hi - lo, bool)
        after = m[2 if lo else 1 :]
        last[: len(after)] = ~after
        cut = heads[np.searchsorted(heads, lo, "right") : np.searchsorted(heads, hi, "right")] - lo - 1
        last[cut] = True
        ends.append(np.flatnonzero(own & last) + lo + 1)
    starts, ends = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (starts, ends))
    return starts, ends, np.searchsorted(starts, off)


def span_totals(flag, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bytes of each span that ``flag`` (a table of bytes, or a function of a segment's bounds) marks; spans are in order and don't overlap.

    Sums run over a segment at a time, so a long text needs no array of its own size.
    """
    out = np.zeros(len(starts), np.int64)
    for lo in range(0, len(data), SEGMENT):
        hi = min(len(data), lo + SEGMENT)
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi)
        if a < b:
            sums = np.zeros(hi - lo + 1, np.int32)
            np.cumsum(flag(lo, hi) if callable(flag) else flag[data[lo:hi]], out=sums[1:])
            out[a:b] += sums[np.clip(ends[a:b] - lo, 0, hi - lo)] - sums[np.clip(starts[a:b] - lo, 0, hi - lo)]
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word, its bytes mapped by ``table``; hashed in segments, so memory is bounded for long texts."""
    values = _BYTE if table is None else _BYTE[table]
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SEGMENT)))
        lo, hi = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[data[lo:hi]] * _powers(_P, hi - lo)[: hi - lo], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[b] - sums[a]) * _powers(_P_INV, hi - lo)[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def hash_of(word: bytes) -> int:
    """The hash of one word, as a signed long."""
    data = np.frombuffer(word, np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(word)])).view(np.int64)[0])


def column(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind)
