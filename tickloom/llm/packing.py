"""Packing of token ids into sequences, balanced by attention cost."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import spread
from tickloom.llm.tokens import pieces, text_groups

#: Ids after which a task packs what it has gathered: bounds its memory and the padding, at most one sequence a block.
BLOCK_IDS = 1 << 20
SCHEMA = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cost(length: int, linear: float = 1.0, quadratic: float = 1.0 / 1024) -> float:
    """Estimated attention cost of a piece: a linear and a quadratic part."""
    return linear * length + quadratic * length * length


def pack(sizes: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with ``sizes`` tokens.

    Whole sequences are cut from documents longer than one. The rest go, in descending order, to the sequence of lowest
    cost with room for them; what fits nowhere whole is cut to fill the room that is left. As many sequences are used as
    the tokens need, so padding is under one sequence. Ties go to the earlier document and the earlier sequence.
    """
    out, rest, sequences = [], [], 0
    for d, n in enumerate(sizes.tolist()):
        at = 0
        while n - at >= capacity:
            out.append((d, at, capacity, sequences, 0))
            sequences += 1
            at += capacity
        if n > at:
            rest.append((n - at, d, at))
    rest.sort(key=lambda x: (-x[0], x[1]))
    bins = -(-sum(x[0] for x in rest) // capacity)
    used = [0] * bins
    heap = [(0.0, b) for b in range(bins)]
    left = []
    for n, d, at in rest:
        aside = []
        while heap and used[heap[0][1]] + n > capacity:
            aside.append(heapq.heappop(heap))
        if heap:
            c, b = heapq.heappop(heap)
            out.append((d, at, n, sequences + b, used[b]))
            used[b] += n
            if used[b] < capacity:
                heapq.heappush(heap, (c + cost(n), b))
        else:
            left.append((n, d, at))
        # pieces come in descending order: a sequence without room now may have room for a later, smaller one
        for x in aside:
            heapq.heappush(heap, x)
    rooms = [(capacity - u, b) for b, u in enumerate(used) if u < capacity]
    rooms.sort(key=lambda x: (-x[0], x[1]))
    k = 0
    for n, d, at in left:
        while n:
            room, b = rooms[k]
            take = min(room, n)
            out.append((d, at, take, sequences + b, used[b]))
            used[b] += take
            n, at = n - take, at + take
            rooms[k] = (room - take, b)
            k += room == take
    return out


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids if asked for).

    Each task packs blocks of about ``block_ids`` ids of the rows it reads: only an input of few splits is shuffled, memory
    is a block, and padding under one sequence a block, of which the last of a task may be small. A null or empty text is the end id alone. Repeated rows are documents of their
    own. Sequence ids are unique in a result: the task's number and the sequence's number in that task. Other columns
    are ignored; an empty table gives no rows.
    """

    def run(batches):
        from pyspark import TaskContext

        table, base, number = pieces(tokenizer), TaskContext.get().partitionId() << 36, 0
        ids, flats, sizes, held = [], [], [], 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]

        def close():
            nonlocal number, held
            flat, size = np.concatenate(flats), np.concatenate(sizes)
            before = np.cumsum(size) - size
            found = pack(size, capacity)
            doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*found, strict=True))
            cuts = [flat[a : a + n] for a, n in zip((before[doc] + start).tolist(), length.tolist(), strict=True)]
            columns = [pa.concat_arrays(ids).take(pa.array(doc)), start, length, [zlib.crc32(x.tobytes()) for x in cuts], size[doc], base + number + sequence, offset]
            if with_ids:
                columns.append(pa.array([x.astype(np.int64) for x in cuts], pa.list_(pa.int64())))
            number += int(sequence.max()) + 1
            ids.clear(), flats.clear(), sizes.clear()
            held = 0
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns], names)

        for batch in batches:
            for part, texts in text_groups(batch, "t"):
                flat, size = table.encode(texts)
                ends = np.cumsum(size)
                flat = np.insert(flat.astype("<u4"), ends, end_id)
                ids.append(part.column("i"))
                flats.append(flat)
                sizes.append(size + 1)
                held += len(flat)
                if held >= block_ids:
                    yield close()
        if held:
            yield close()

    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), 1)
    return source.mapInArrow(run, SCHEMA.format(id=source.schema["i"].dataType.simpleString()) + (", ids array<long>" if with_ids else ""))
