"""Spelling variants: words one edit apart, found by two-dimensional range reporting over wavelet trees, and their roots.

Two words are near if one inserted, deleted or replaced code point makes one of the other. For each place of the edit the
near words are those that begin with what stands before it, an interval of the words in order, and end with what stands
after it, an interval of the words in order from the end. A word is a point (place in the one order, place in the other),
so near words are the points of a rectangle, which a wavelet tree over the one order's places in the other reports.

The words are dealt over tasks by what an edit leaves as it is: words of one length that have a half in common meet for the
edits of the other half. A group of more than ``HOT_GROUP`` rows is cut in two, each half of its edited part being fixed in
turn, down to parts of one code point, where a group is no larger than the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import BROADCAST_ROWS, LOWER, hold, spread, stage, text_groups_of

#: Rows of a group above which it is cut in two.
HOT_GROUP = 1 << 15
#: Rows of the groups that are searched together, and code points of their edited parts.
CHUNK_ROWS, CHUNK_CELLS = 1 << 16, 1 << 22
#: Rectangles searched at once.
SEARCHED = 1 << 18
#: Distinct words that a task adds up before it hands them on.
COUNTED = 300_000
#: Characters of a long text that are split into words at once.
PART = 1 << 20
_RUN = re.compile("[a-zÀ-ÿ]+")
_OTHER = re.compile("[^a-zÀ-ÿ]")
_TO_LOWER = bytes(LOWER)
_KEY = ("m", "a", "b", "pre", "post")


def _parts(text: str):
    """Parts of a text that no word crosses."""
    lo = 0
    while len(text) - lo > PART:
        cut = _OTHER.search(text, lo + PART)
        if not cut:
            break
        yield text[lo : cut.start()]
        lo = cut.start()
    yield text[lo:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spoilt: int = 97, shortest: int = 5) -> DataFrame:
    """(word, n): how often each word occurs in all texts, those of under ``shortest`` code points left out.

    Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z in lower case. With h the crc32 of ``<id>:<word>``, a word
    whose h ``spoilt`` divides loses the code point h % length. A null id is the empty text there, a null text has no words.
    Tasks add up their words before these are shuffled, so a frequent word is a few rows.
    """
    source = spread(docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")))

    def run(batches):
        hold("words")
        total: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for ids, texts in text_groups_of(batch, "i", "t"):
                for i, text in zip(ids, texts, strict=True):
                    if not text:
                        continue
                    start = zlib.crc32(f"{i}:".encode())
                    for part in _parts(text.encode().translate(_TO_LOWER).decode()):
                        for word, n in Counter(_RUN.findall(part)).items():
                            if len(word) >= shortest:
                                h = zlib.crc32(word.encode(), start)
                                if h % spoilt == 0:
                                    at = h % len(word)
                                    word = word[:at] + word[at + 1 :]
                                    if len(word) < shortest:
                                        continue
                                total[word] += n
                if len(total) >= COUNTED:
                    yield batch_of()
        yield batch_of()

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _halves(words: DataFrame) -> DataFrame:
    """Each word in the groups where its near words of the same length, or of one code point more, can be.

    ``point`` rows are words of length ``m``; other rows are words of one less, which an insertion may turn into such. The
    edit is at one of the places from ``a`` to ``b``; ``pre`` and ``post`` are what the word has around, ``part`` inside.
    """
    size, text = F.length("word"), F.col("word")
    sub = lambda a, b: F.substring(text, a + F.lit(1), F.greatest(b - a, F.lit(0)))

    def row(point: bool, first: bool):
        m = size if point else size + 1
        mid = F.floor(m / 2).cast("int")
        less = F.lit(0 if point else 1)
        zero = F.lit(0)
        if first:
            fields = (zero, mid, F.lit(""), sub(mid - less, size), sub(zero, mid - less))
        else:
            fields = (mid, m, sub(zero, mid), F.lit(""), sub(mid, size))
        return F.struct(m.alias("m"), F.lit(point).alias("point"), *[x.alias(n) for x, n in zip(fields, ("a", "b", "pre", "post", "part"), strict=True)])

    return words.select("n", F.explode(F.array(*[row(p, f) for p in (True, False) for f in (True, False)])).alias("r")).select("n", "r.*")


def _cut(rows: DataFrame) -> DataFrame:
    """The same rows with each edited part in two."""
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    less = F.when(F.col("point"), 0).otherwise(1)
    ahead = mid - F.col("a")
    left = lambda k: F.substring("part", F.lit(1), F.greatest(k, F.lit(0)))
    after = lambda k: F.substring("part", k + 1, F.length("part"))
    first = (F.col("a"), mid, F.col("pre"), F.concat(after(ahead - less), F.col("post")), left(ahead - less))
    second = (mid, F.col("b"), F.concat(F.col("pre"), left(ahead)), F.col("post"), after(ahead))
    both = [F.struct(*[x.alias(n) for x, n in zip(fields, ("a", "b", "pre", "post", "part"), strict=True)]) for fields in (first, second)]
    return rows.select("n", "m", "point", F.explode(F.array(*both)).alias("r")).select("n", "m", "point", "r.*")


def grouped(words: DataFrame, hot: int = HOT_GROUP) -> DataFrame:
    """:func:`_halves` with ``k``, the hash of what is fixed, and groups of over ``hot`` rows cut until they are not or have one place."""
    keyed = lambda df: df.withColumn("k", F.xxhash64(*_KEY))
    todo, done = keyed(_halves(words)), None
    while True:
        todo = stage(todo, "spelling")
        large = stage(todo.where("b - a > 1").groupBy("k").count().where(F.col("count") > hot).select("k"), "spelling-hot")
        n = large.count()
        if not n:
            return todo if done is None else done.unionByName(todo)
        large = F.broadcast(large) if n <= BROADCAST_ROWS else large
        rest = todo.join(large, "k", "left_anti").unionByName(todo.where("b - a = 1").join(large, "k", "left_semi"))
        done = rest if done is None else done.unionByName(rest)
        todo = keyed(_cut(todo.where("b - a > 1").join(large, "k", "left_semi")))


class WaveletTree:
    """A sequence of different numbers below its length; reports those at places [a, b) with values in [lo, hi)."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []  # by level, zeros before each place
        for level in range(self.bits - 1, -1, -1):
            ones = (values >> level & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[~ones], values[ones]])

    def report(self, a, b, lo, hi) -> tuple[np.ndarray, np.ndarray]:
        """(rectangle, value) of all points of the rectangles; work grows with the points and, by level, with the rectangles."""
        q, v = np.arange(len(a)), np.zeros(len(a), np.int64)
        for depth, before in enumerate(self.zeros):
            width = 1 << (self.bits - 1 - depth)
            a0, b0 = before[a], before[b]
            a1, b1 = before[-1] + a - a0, before[-1] + b - b0
            middle = v + width
            zero, one = (a0 < b0) & (lo[q] < middle) & (hi[q] > v), (a1 < b1) & (hi[q] > middle) & (lo[q] < middle + width)
            q, v = np.concatenate([q[zero], q[one]]), np.concatenate([v[zero], middle[one]])
            a, b = np.concatenate([a0[zero], a1[one]]), np.concatenate([b0[zero], b1[one]])
        return q, v


def _intervals(key: np.ndarray, parts: np.ndarray, point: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, first and last + 1 point of each row's interval by the number of code points that are given)."""
    n, width = parts.shape
    order = np.lexsort((*parts.T[::-1], key))
    same = np.concatenate([[False], key[order[1:]] == key[order[:-1]]])
    points = np.concatenate([[0], np.cumsum(point[order])])
    first, last = np.empty((width + 1, n), np.int32), np.empty((width + 1, n), np.int32)
    at = np.arange(n)
    for given in range(width + 1):
        if given:
            column = parts[order, given - 1]
            same[1:] &= column[1:] == column[:-1]
        head = np.maximum.accumulate(np.where(same, 0, at))
        tail = n - 1 - np.maximum.accumulate(np.where(np.concatenate([same[1:], [False]])[::-1], 0, at))[::-1]
        first[given, order], last[given, order] = points[head], points[tail + 1]
    return order[point[order]], first, last


def near_rows(key: np.ndarray, parts: list[bytes], point: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, point row, place) of all rows that an edit at ``place`` of their part turns into a point of their key.

    A point is turned into others by a replacement, other rows by an insertion.
    """
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    width = int(sizes.max(initial=0))
    table = np.zeros((2, len(parts), width), np.uint8)
    for n in range(2):
        joined = np.frombuffer(b"".join(x[::-1] if n else x for x in parts), np.uint8)
        row = np.repeat(np.arange(len(parts)), sizes)
        table[n, row, np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = joined
    forward, first, last = _intervals(key, table[0], point)
    reverse, low, high = _intervals(key, table[1], point)
    if not len(forward):
        return (np.zeros(0, np.int64),) * 3
    place = np.empty(len(parts), np.int64)
    place[reverse] = np.arange(len(reverse))
    tree = WaveletTree(place[forward])
    out = []
    for given in range(width + 1):
        rows = np.flatnonzero(np.where(point, sizes > given, sizes >= given))
        after = sizes[rows] - given - point[rows]
        a, b, lo, hi = first[given, rows], last[given, rows], low[after, rows], high[after, rows]
        other = np.where(point[rows], 2, 1)  # a point is in its own rectangle
        full = np.flatnonzero((b - a >= other) & (hi - lo >= other))
        for s in range(0, len(full), SEARCHED):
            some = full[s : s + SEARCHED]
            q, v = tree.report(a[some].astype(np.int64), b[some].astype(np.int64), lo[some], hi[some])
            found, hit = rows[some[q]], reverse[v]
            real = found != hit
            out.append((found[real], hit[real], np.full(int(real.sum()), given)))
    return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ((),) * 3))


def _best(rows: list, key: np.ndarray, point: np.ndarray, n: np.ndarray, parts: list[bytes]) -> pa.RecordBatch:
    """Per row with near rows: its word, how many they are, and the most frequent of them."""
    pre, post, spans = rows
    row, hit, place = near_rows(key, parts, point)
    keep = []
    for i, j, q in zip(row.tolist(), hit.tolist(), place.tolist(), strict=True):
        real = pre[i] == pre[j] and post[i] == post[j] and spans[i] == spans[j]  # not only hashes of them
        if real and not point[i]:  # of places in a run of one code point only the first counts
            x = pre[j] + parts[j]
            at = len(pre[j]) + q
            real = at == 0 or x[at] != x[at - 1]
        keep.append(real)
    keep = np.array(keep, bool)
    row, hit = row[keep], hit[keep]
    back = ~point[row]  # an insertion seen from the longer word
    row, hit = np.concatenate([row, hit[back]]), np.concatenate([hit, row[back]])
    used, at = np.unique(np.concatenate([row, hit]), return_inverse=True)
    words = np.array([(pre[i] + parts[i] + post[i]).decode("latin-1") for i in used.tolist()], object)
    rank = np.empty(len(used), np.int64)
    rank[np.argsort(words, kind="stable")] = np.arange(len(used))
    mine, other = at[: len(row)], at[len(row) :]
    order = np.lexsort((rank[other], -n[hit], mine))
    mine, other = mine[order], other[order]
    heads = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]])) if len(mine) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([heads, [len(mine)]]))
    best = other[heads]
    return pa.RecordBatch.from_arrays(
        [pa.array(words[mine[heads]], pa.string()), pa.array(counts, pa.int64()), pa.array(n[used[best]], pa.int64()), pa.array(words[best], pa.string())], ["word", "n_near", "best_n", "best"]
    )


def near_words(words: DataFrame, hot: int = HOT_GROUP) -> DataFrame:
    """(word, n_near, best_n, best) of words with near words: how many, and the one of largest ``n``, of equal ones the least in code-point order.

    ``words`` has each word (code points below 256) once with its ``n``. No link is left out: a group's rectangles are all searched.
    """
    rows = grouped(words, hot)
    plain = [F.encode(c, "ISO-8859-1").alias(c) for c in ("pre", "post", "part")]
    dealt = rows.repartition("k").sortWithinPartitions("m", "k").select("k", "m", "a", "b", "point", "n", *plain)

    def run(batches):
        hold("spelling")
        held: list[pa.RecordBatch] = []
        many, cells = 0, 0

        def search(upto: pa.Table):
            upto = upto.combine_chunks()
            key = upto.column("k").to_numpy()
            m = upto.column("m").to_numpy()
            change = np.concatenate([[True], (key[1:] != key[:-1]) | (m[1:] != m[:-1])])
            group = np.cumsum(change) - 1
            more = np.flatnonzero(np.bincount(group)[group] > 1)  # a row alone has no near one
            if len(more):
                some = upto.take(pa.array(more))
                point = np.array(some.column("point").to_pylist(), bool)
                spans = list(zip(*[some.column(c).to_pylist() for c in ("m", "a", "b")], strict=True))
                yield _best([some.column("pre").to_pylist(), some.column("post").to_pylist(), spans], group[more], point, some.column("n").to_numpy(), some.column("part").to_pylist())

        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            many += len(batch)
            cells += int(pc.sum(pc.binary_length(batch.column("part"))).as_py() or 0)
            if many < CHUNK_ROWS and cells < CHUNK_CELLS:
                continue
            table = pa.Table.from_batches(held)
            key, m = table.column("k").to_numpy(), table.column("m").to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]) | (m[1:] != m[:-1])) + 1
            if not len(ends):
                continue
            # whole groups, in chunks of a bounded size; the last group may go on
            wide = np.concatenate([[0], np.cumsum(pc.binary_length(table.column("part")).to_numpy())])
            lo = 0
            for at, end in enumerate(ends.tolist()):
                after = int(ends[at + 1]) if at + 1 < len(ends) else len(table)
                if after - lo > CHUNK_ROWS or wide[after] - wide[lo] > CHUNK_CELLS or at + 1 == len(ends):
                    yield from search(table.slice(lo, end - lo))
                    lo = end
            rest = table.slice(lo)
            held, many, cells = rest.to_batches(), len(rest), int(wide[-1] - wide[lo])
        if held:
            yield from search(pa.Table.from_batches(held))

    found = dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last word that forms lead to. Each round doubles the steps; forms must not go round in a circle."""
    steps = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stage(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 3, shortest: int = 5, spoilt: int = 97, hot: int = HOT_GROUP) -> DataFrame:
    """Per word of at least ``least`` occurrences (see :func:`word_counts`): its near words, its form, and its root.

    ``form`` is the near word of largest n, the least in code-point order of equals, if that n is at least twice the word's
    own; ``root`` follows forms to the last and is the word itself if it has none. Nulls, empty texts and texts without
    words add nothing, an empty table gives no rows, repeated rows count each time. Very long texts are split between
    words; a long run of letters is one word. Other columns are ignored, so their names can't clash.
    """
    words = stage(word_counts(docs, id_col, text_col, spoilt, shortest).where(F.col("n") >= least), "words")
    near = near_words(words, hot)
    double = F.col("best_n") >= 2 * F.col("n")
    linked = stage(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(double, F.col("best")).alias("form"), F.when(double, F.col("best_n")).alias("form_n")), "spelling-forms")
    led = roots(linked.where("form is not null").select("word", "form"))
    return linked.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
