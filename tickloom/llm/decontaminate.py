"""Benchmark decontamination by winnowing: equal windows share their smallest k-gram hash, so a join finds them all."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ALNUM, BROADCAST_ROWS, LOWER, byte_chunks, hold, mix, stage, text_bytes, word_hashes, word_spans

#: Words of a window, of a k-gram, and k-grams of a window.
WINDOW, GRAM = 10, 5
SPAN = WINDOW - GRAM + 1
#: Words kept around a k-gram: every window that holds it lies in them.
SIDE = WINDOW - GRAM
WIDTH = 2 * SIDE + GRAM
#: Bits of the filter of benchmark fingerprints; its size doesn't grow with the benchmark.
FILTER_BITS = 22
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) for i in range(WINDOW)], np.uint64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` words."""
    count = max(0, len(words) - n + 1)
    out = np.full(count, n, np.uint64)
    for j in range(n):
        out = out + mix(words[j : j + count] * _MULTIPLIERS[j])
    return mix(out)


def winnowed(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Places of the k-grams that are the smallest (the last of equals) of some window within one row."""
    grams = gram_hashes(words, GRAM)
    starts = np.flatnonzero(_room(before, len(words)) >= WINDOW)
    if not len(starts):
        return np.zeros(0, np.int64)
    best, place = grams[starts], starts.copy()
    for j in range(1, SPAN):
        other = grams[starts + j]
        take = other <= best
        best = np.where(take, other, best)
        place = np.where(take, starts + j, place)
    return np.unique(place)


def _room(before: np.ndarray, n: int) -> np.ndarray:
    """Words from each word to the end of its row."""
    return np.repeat(before[1:], np.diff(before)) - np.arange(n)


def contexts(words: np.ndarray, before: np.ndarray, row: np.ndarray, place: np.ndarray, pad: int) -> np.ndarray:
    """The words around each k-gram, ``pad`` where its row has none."""
    at = place[:, None] + np.arange(-SIDE, GRAM + SIDE)
    inside = (at >= before[row][:, None]) & (at < before[row + 1][:, None])
    return np.where(inside, words[np.clip(at, 0, max(0, len(words) - 1))], np.uint64(pad))


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, off = text_bytes(batch.column("t"))
    data = LOWER[data]
    starts, ends, before = word_spans(data, off, ALNUM)
    return word_hashes(data, starts, ends), before


def _candidates(words: np.ndarray, before: np.ndarray, short: list[int], pad: int, keep=None, items: bool = False):
    """(row, place in the row, length, fingerprint, context) of k-grams and of the short runs asked for."""
    row_of = np.repeat(np.arange(len(before) - 1), np.diff(before))
    room, sizes = _room(before, len(words)), np.diff(before)
    found = []
    place = winnowed(words, before)
    if len(words) >= GRAM:
        found.append((place, GRAM, gram_hashes(words, GRAM)[place]))
    for n in short:
        here = np.flatnonzero(room >= n)
        if items:
            here = here[(sizes[row_of[here]] == n)]
        found.append((here, n, gram_hashes(words, n)[here] ^ np.uint64(0x5BD1E995) if len(here) else np.zeros(0, np.uint64)))
    out = []
    for place, n, prints in found:
        if keep is not None:
            hit = keep[prints >> np.uint64(64 - FILTER_BITS)]
            place, prints = place[hit], prints[hit]
        row = row_of[place]
        out.append((row, place - before[row], np.full(len(place), n), prints, contexts(words, before, row, place, pad)))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64), np.zeros((0, WIDTH), np.uint64)]


def _binary(context: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH * 8), len(context), [None, pa.py_buffer(np.ascontiguousarray(context).tobytes())]).cast(pa.binary())


def benchmark_prints(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, place, length, print, context) of the benchmark; an item under ``WINDOW`` words is one run of its own length."""

    def run(batches):
        for batch in batches:
            words, before = _words(batch)
            short = sorted(set(np.diff(before).tolist()) & set(range(1, WINDOW)))
            row, place, length, prints, context = _candidates(words, before, short, 1, items=True)
            whole = np.diff(before)[row] < WINDOW
            yield pa.RecordBatch.from_arrays([batch.column("i").take(pa.array(row)), pa.array(place), pa.array(length), pa.array(whole), pa.array(prints.view(np.int64)), _binary(context)], ["item_id", "item_place", "length", "whole", "print", "item_words"])

    source = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return source.mapInArrow(run, f"item_id {source.schema['i'].dataType.simpleString()}, item_place long, length long, whole boolean, print long, item_words binary")


def _extend(batches):
    """Hits of at least a window around equal k-grams, or whole short items."""
    for batch in batches:
        n = len(batch)
        mine = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.uint64).reshape(n, WIDTH)
        other = np.frombuffer(b"".join(batch.column("item_words").to_pylist()), np.uint64).reshape(n, WIDTH)
        length, place, whole = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("length", "place", "whole"))
        same = mine == other
        left = np.cumprod(same[:, SIDE - 1 :: -1], axis=1).sum(axis=1)
        right = np.cumprod(same[:, SIDE + GRAM :], axis=1).sum(axis=1)
        core = same[:, SIDE : SIDE + GRAM].all(axis=1)
        whole = whole.astype(bool)
        begin = np.where(whole, place, place - left)
        end = np.where(whole, place + length, place + GRAM + right)
        # the words of a short item that stand in the context are compared as well
        at = np.arange(WIDTH) - SIDE
        equal = (same | (at < 0) | (at >= length[:, None])).all(axis=1)
        good = np.where(whole, equal, core & (end - begin >= WINDOW))
        kept = np.flatnonzero(good)
        yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(kept)), batch.column("item_id").take(pa.array(kept)), pa.array(begin[kept], pa.int64()), pa.array(end[kept], pa.int64())], ["key", "item_id", "begin", "end"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    One pass over the texts keeps the k-grams that pass a filter of fixed size; only these are joined with the
    benchmark's, broadcast under ``BROADCAST_ROWS`` prints and shuffled above, where a hot print's rows can be split.
    A null or empty text has no words; a null or wordless item has no window; repeated rows count each for itself, rows
    with the same item id are one item; other columns are ignored; with no items nothing is hit.
    """
    prints = stage(benchmark_prints(items, item_id, item_text), "prints")
    facts = prints.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("whole"), F.col("length"))).alias("short")).first()
    short = sorted(facts["short"])
    slots = prints.select(F.shiftrightunsigned("print", 64 - FILTER_BITS).alias("s")).distinct().toArrow().column("s").to_numpy()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[slots] = True
    packed = np.packbits(bits)

    def scan(batches):
        from pyspark import TaskContext

        hold("decontaminate")
        keep, key = np.unpackbits(packed).astype(bool), TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in byte_chunks(whole, "t", 2 << 20):
                words, before = _words(batch)
                row, place, length, prints, context = _candidates(words, before, short, 2, keep)
                order = np.argsort(row, kind="stable")
                ends = np.searchsorted(row[order], np.arange(len(batch) + 1))
                fields = [pa.array(place[order], pa.int64()), pa.array(length[order], pa.int64()), pa.array(prints[order].view(np.int64)), _binary(context[order])]
                hits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["place", "length", "print", "words"]))
                yield pa.RecordBatch.from_arrays([pa.array(key + np.arange(len(batch))), batch.column("i"), pa.array(np.diff(before), pa.int64()), hits], ["key", "doc_id", "n_words", "hits"])
                key += len(batch)

    source = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    kind = source.schema["i"].dataType.simpleString()
    scanned = stage(source.mapInArrow(scan, f"key long, doc_id {kind}, n_words long, hits array<struct<place:long,length:long,print:long,words:binary>>"), "scanned")
    hits = scanned.where(F.size("hits") > 0).select("key", F.inline("hits"))
    small = F.broadcast(prints) if facts["n"] <= BROADCAST_ROWS else prints
    item_kind = prints.schema["item_id"].dataType.simpleString()
    found = hits.join(small, ["print", "length"]).mapInArrow(_extend, f"key long, item_id {item_kind}, begin long, end long")
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(-1).cast("long").alias("upto"))
    union = F.aggregate(
        F.array_sort(F.collect_set(F.struct("begin", "end"))),
        start,
        lambda acc, x: F.struct((acc["hit"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["begin"], acc["upto"]))).alias("hit"), F.greatest(acc["upto"], x["end"]).alias("upto")),
        lambda acc: acc["hit"],
    )
    names = F.array_sort(F.transform(F.collect_set("item_id"), lambda x: x.cast("string")))
    per_doc = found.groupBy("key").agg(union.alias("n_hit"), names.alias("items"))
    joined = scanned.select("key", "doc_id", "n_words").join(per_doc, "key", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
