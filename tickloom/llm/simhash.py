"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, verified Hamming links, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import BROADCAST_ROWS, LOWER, NON_SPACE, byte_chunks, hold, mix, spread, stage, text_bytes, word_hashes, word_spans
from tickloom.llm.components import connected_components
from tickloom.llm.decontaminate import gram_hashes

#: Shingles whose bits are counted at once.
COUNTED = 1 << 15
#: Six blocks of the 64 bits; pairs within 3 bits agree on at least three of them.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
DISTANCE = 3
#: Fingerprints of a block that one task verifies; larger blocks are split again, each time by a quarter of the bits that they
#: have not in common: pairs within ``DISTANCE`` agree on one of the quarters.
HOT_RUN, SPLITS = 1 << 14, 3
#: The similarity search of ``wide``: words of a shingle, and the Jaccard similarity of shingle sets that links (over five).
#: Candidates share a band of so many minima: at a similarity of 0.8 one of the bands with a chance of 0.998 by formula.
WIDE_SHINGLE, SIMILAR_FIFTHS, BANDS, BAND = 5, 4, 16, 5
#: 64-bit words of the wide fingerprint. Sets with a similarity of 0.8 differ in 0.15 of the bits, by about 0.013 more or less:
#: candidates further apart than ``WIDE_SHARE`` are not compared. In long runs those within ``SURE_SHARE`` are linked first.
WIDE_LANES, SURE_SHARE, WIDE_SHARE = 12, 0.115, 0.25
#: Rows of a run that meet in one task when what the first links left apart is compared; longer runs are dealt in pairs of such parts.
RUN_PART = 1 << 13
#: Fixed: the seed of the shingle hash.
SEED = 42
_TO_LOWER = bytes(LOWER)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a whole text; a text without words has fingerprint zero."""
    import xxhash

    words = (text or "").encode().translate(_TO_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, COUNTED):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[i : i + COUNTED], ends[i : i + COUNTED], strict=True)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, print) of each row, the print as a signed long."""

    def run(batches):
        hold("simhash")
        for whole in batches:
            for batch in byte_chunks(whole, "t", 2 << 20):
                prints = np.array([fingerprint(t, shingle) for t in batch.column("t").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    return source.mapInArrow(run, f"doc_id {source.schema['i'].dataType.simpleString()}, print long")


def block_links(key: np.ndarray, prints: np.ndarray, distance: int, sure: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places whose prints (rows of 64-bit words) are within ``distance``, connecting all that such pairs connect in each run of equal keys.

    Short runs give every pair; in long ones a breadth-first walk gives a spanning forest, so pairs stay below rows and
    memory at the run. With ``sure``, where links are confirmed and the rest is searched later, the forest is of pairs within
    ``sure``.
    """
    out = []

    def close(a, b, limit=distance):
        return np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64) <= limit

    cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
    sizes = ends - starts
    left = np.repeat(ends, sizes) - np.arange(len(key))
    small = np.repeat(sizes <= 8, sizes)
    for shift in range(1, 8):
        at = np.flatnonzero(small & (left > shift))
        if not len(at):
            break
        at = at[close(at, at + shift)]
        out.append((at, at + shift))
    for a, b in zip(starts[sizes > 8].tolist(), ends[sizes > 8].tolist(), strict=True):
        rest = np.arange(a, b)
        while len(rest):
            frontier, rest = [rest[0]], rest[1:]
            while frontier and len(rest):
                one = frontier.pop()
                near = close(rest, [one], distance if sure is None else sure)
                if near.any():
                    found = rest[near]
                    rest = rest[~near]
                    out.append((np.full(len(found), one), found))
                    frontier.extend(found)
    return out


def _verify(rows: DataFrame, distance: int, sure: int | None = None) -> DataFrame:
    """Links (a, b) of nodes that share a block and are within ``distance`` bits; ``rows``: block, node, bits.

    Rows are dealt and sorted by block; a run that reaches the end of a batch waits for the next.
    """

    def links(key, prints, nodes):
        found = block_links(key, prints, distance, sure) if len(key) > 1 else []
        if found:
            a, b = (nodes[np.concatenate(x)] for x in zip(*found, strict=True))
            for i in range(0, len(a), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(a[i : i + (1 << 16)]), pa.array(b[i : i + (1 << 16)])], ["a", "b"])

    def run(batches):
        held, last = [], None
        for batch in batches:
            if not len(batch):
                continue
            prints = np.frombuffer(b"".join(batch.column("bits").to_pylist()), ">u8").reshape(len(batch), -1)
            now = [batch.column("block").to_numpy(), prints, batch.column("node").to_numpy()]
            if held and now[0][-1] == last:
                held.append(now)
                continue
            last = now[0][-1]
            whole = int(np.searchsorted(now[0], last))
            yield from links(*(np.concatenate(x) for x in zip(*held, [x[:whole] for x in now], strict=True)))
            held = [[x[whole:] for x in now]]
        if held:
            yield from links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a long, b long")


def _bits(value, start: int, width: int):
    """``width`` bits of a column from bit ``start``, the lowest being 0."""
    return F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << width) - 1))


def _joined(fields: list, value):
    """(bits of several (start, width) fields of a column side by side, their number)."""
    out = F.lit(0).cast("long")
    for start, width in fields:
        out = F.shiftleft(out, width).bitwiseOR(_bits(value, start, width))
    return out, sum(width for _, width in fields)


def split_hot(keyed: DataFrame, width: int, splits: int = SPLITS) -> DataFrame:
    """(block, node) in which blocks of over ``HOT_RUN`` rows are split so that pairs within ``DISTANCE`` still meet.

    ``rest`` has the ``width`` bits in which the rows of a block may differ. Hot blocks are joined by broadcast where they
    are few, so that their own rows are not gathered to find them.
    """
    hot = stage(keyed.groupBy("block").count().where(F.col("count") > HOT_RUN).select("block"), "hot-blocks")
    n = hot.limit(BROADCAST_ROWS + 1).count()
    if not n or not splits or width <= DISTANCE:
        return keyed.select("block", "node")
    small = F.broadcast(hot) if n <= BROADCAST_ROWS else hot
    cuts = [width * k // (DISTANCE + 1) for k in range(DISTANCE + 2)]
    parts = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        rest, _ = _joined([(lo, hi - lo) for lo, hi in ((b, width), (0, a)) if hi > lo], F.col("rest"))
        parts.append(F.struct(F.xxhash64("block", F.lit(k), _bits(F.col("rest"), a, b - a)).alias("block"), rest.alias("rest")))
    # the quarters differ in width by one bit, so what is left is read at the greatest
    again = keyed.join(small, "block", "left_semi").select(F.explode(F.array(*parts)).alias("p"), "node").select("p.block", "node", "p.rest")
    left = width - min(b - a for a, b in zip(cuts, cuts[1:]))
    return keyed.join(small, "block", "left_anti").select("block", "node").unionByName(split_hot(again, left, splits - 1))


def print_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) of distinct fingerprints within ``DISTANCE`` bits, enough to connect all that are linked."""
    fields = [(64 - start - width, width) for start, width in BLOCKS]
    blocks, widest = [], 0
    for number, chosen in enumerate(combinations(range(len(fields)), len(fields) - DISTANCE)):
        key, _ = _joined([fields[i] for i in chosen], F.col("print"))
        rest, width = _joined([f for i, f in enumerate(fields) if i not in chosen], F.col("print"))
        blocks.append(F.struct(F.shiftleft(F.lit(number).cast("long"), 40).bitwiseOR(key).alias("block"), rest.alias("rest")))
        widest = max(widest, width)
    keyed = prints.select(F.explode(F.array(*blocks)).alias("b"), F.col("print").alias("node")).select("b.block", "node", "b.rest")
    bits = F.unhex(F.lpad(F.hex("node"), 16, "0"))
    return _verify(split_hot(keyed, widest).withColumn("bits", bits), DISTANCE)


def shingle_sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of ``WIDE_SHINGLE`` words; a shorter text is one run."""
    data, off = text_bytes(batch.column("t"))
    data = LOWER[data]
    starts, ends, before = word_spans(data, off, NON_SPACE)
    words = word_hashes(data, starts, ends)
    grams = gram_hashes(words, WIDE_SHINGLE)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        own = grams[a : b - WIDE_SHINGLE + 1] if b - a >= WIDE_SHINGLE else gram_hashes(words[a:b], max(1, b - a))
        out.append(np.unique(own))
    return out


_SALTS = np.arange(1, WIDE_LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
#: Odd factors: hashes are mixed already, so products with them order the shingles anew.
_FACTORS = mix(np.arange(1, BANDS * BAND + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def wide_print(own: np.ndarray) -> np.ndarray:
    """The wide fingerprint of a set of shingle hashes."""
    ones = np.zeros(64 * WIDE_LANES, np.int64)
    for j in range(0, len(own), COUNTED >> 3):
        part = mix(own[j : j + (COUNTED >> 3), None] ^ _SALTS)
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(len(part), -1), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits((2 * ones > len(own)).reshape(WIDE_LANES, 64), axis=1).view(">u8").ravel()


def band_keys(own: np.ndarray) -> np.ndarray:
    """A key for each band of minima of a set of shingle hashes, which is not empty."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for j in range(0, len(own), COUNTED >> 3):
        np.minimum(least, (own[j : j + (COUNTED >> 3), None] * _FACTORS).min(axis=0), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND).T:
        key = mix(key ^ column) + column
    return key


def similar_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print, node, bits, bands, grams) of each row: equal sets of shingles are one node, a text without words is 0; the print is the first of the wide fingerprint's words."""

    def run(batches):
        hold("simhash")
        for whole in batches:
            for batch in byte_chunks(whole, "t", 2 << 20):
                sets = shingle_sets(batch)
                nodes = np.array([int(mix(mix(x) ^ np.uint64(len(x))).sum(dtype=np.uint64)) for x in sets], np.uint64)
                wide = [wide_print(x) if len(x) else np.zeros(0, np.uint64) for x in sets]
                prints = np.array([int(x[0]) if len(x) else 0 for x in wide], np.uint64)
                bits = [x.astype(">u8").tobytes() for x in wide]
                bands = [band_keys(x).view(np.int64) if len(x) else [] for x in sets]
                grams = [(x >> np.uint64(32)).astype(np.uint32).view(np.int32) for x in sets]
                fields = [batch.column("i"), pa.array(prints.view(np.int64)), pa.array(nodes.view(np.int64)), pa.array(bits, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(grams, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(fields, ["doc_id", "print", "node", "bits", "bands", "grams"])

    source = spread(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")))
    return source.mapInArrow(run, f"doc_id {source.schema['i'].dataType.simpleString()}, print long, node long, bits binary, bands array<long>, grams array<int>")


def cross_links(prints: np.ndarray, sets: list[np.ndarray], label: np.ndarray, part: np.ndarray) -> list[tuple[int, int]]:
    """Links (places) between rows of a run that are not connected yet, enough to connect all whose sets are similar.

    ``label`` names what is connected already; with two ``part`` numbers only rows of different parts are compared, as those
    of one part meet elsewhere. Sets are compared themselves where their fingerprints are not too far apart.
    """
    label, two = label.copy(), part.min() != part.max()
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    far, out = int(WIDE_SHARE * 64 * WIDE_LANES), []
    for i in range(len(sets)):
        apart = label[i + 1 :] != label[i]
        if two:
            apart &= part[i + 1 :] != part[i]
        rest = np.flatnonzero(apart) + i + 1
        # sets of which one is less than four fifths of the other can't be similar
        rest = rest[5 * np.minimum(sizes[rest], sizes[i]) >= SIMILAR_FIFTHS * np.maximum(sizes[rest], sizes[i])]
        rest = rest[np.bitwise_count(prints[rest] ^ prints[i]).sum(axis=1, dtype=np.int64) <= far]
        for lo in range(0, len(rest), 512):
            some = rest[lo : lo + 512]
            if not sizes[i]:
                break
            flat = np.concatenate([sets[j] for j in some])
            at = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
            common = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes[some])[:-1]]))
            for j in some[5 * common >= SIMILAR_FIFTHS * (sizes[i] + sizes[some] - common)].tolist():
                if label[j] != label[i]:
                    out.append((i, j))
                    label[label == label[j]] = label[i]
    return out


def _cross(rows: DataFrame) -> DataFrame:
    """:func:`cross_links` of each run; ``rows``: run, part, node, root, bits, grams."""

    def links(held):
        run = [np.concatenate(x) for x in zip(*[h[:4] for h in held], strict=True)]
        sets = [s for h in held for s in h[4]]
        cuts = np.flatnonzero(np.diff(run[0])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sets)]):
            if b - a > 1:
                found = cross_links(run[3][a:b], sets[a:b], np.unique(run[2][a:b], return_inverse=True)[1], run[1][a:b])
                if found:
                    i, j = (run[2][a:b][list(x)] for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j)], ["a", "b"])

    def search(batches):
        held = []
        for batch in batches:
            if not len(batch):
                continue
            grams = batch.column("grams")
            flat, ends = grams.flatten().to_numpy().view(np.uint32), grams.offsets.to_numpy() - grams.offsets[0].as_py()
            sets = [np.sort(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            now = [batch.column("run").to_numpy(), batch.column("part").to_numpy(), batch.column("root").to_numpy(), np.frombuffer(b"".join(batch.column("bits").to_pylist()), ">u8").reshape(len(batch), -1), sets]
            whole = int(np.searchsorted(now[0], now[0][-1]))
            if held and held[-1][0][-1] != now[0][-1]:
                yield from links([*held, [x[:whole] for x in now]])
                held = [[x[whole:] for x in now]]
            elif held:
                held.append(now)
            else:
                if whole:
                    yield from links([[x[:whole] for x in now]])
                held = [[x[whole:] for x in now]]
        if held:
            yield from links(held)

    return rows.repartition("run").sortWithinPartitions("run", "node").mapInArrow(search, "a long, b long")


def similar_roots(nodes: DataFrame) -> DataFrame:
    """(node, root) of nodes linked by a Jaccard similarity of sets of at least ``SIMILAR_FIFTHS`` fifths; ``nodes``: node, bits, bands, grams.

    Candidates share a band. First the links of a forest of close fingerprints in each run of a band are confirmed on the
    sets, joined by node; these connect most copies. Then runs that still hold nodes of different components get the sets
    and compare, in the task, whatever is not connected yet, so no link is lost by the length of a run.
    """
    keyed = nodes.select(F.explode("bands").alias("block"), "node", "bits")
    found = _verify(keyed, int(WIDE_SHARE * 64 * WIDE_LANES), int(SURE_SHARE * 64 * WIDE_LANES))
    pairs = stage(found.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "similar-pairs")
    sets = nodes.select("node", "grams")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    roots = connected_components(both.where(5 * common >= SIMILAR_FIFTHS * (F.size("x") + F.size("y") - common)).select("a", "b"))

    # what is left: runs of several components, a component of which may stand in several
    rooted = keyed.select("block", "node").join(roots, "node", "left").select("block", "node", F.coalesce("root", "node").alias("root"))
    mixed = stage(rooted.groupBy("block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("block", F.expr(f"(n - 1) div {RUN_PART} + 1").alias("parts")), "similar-runs")
    dealt = rooted.join(mixed, "block").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    other = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda q: F.struct(F.least("part", q).alias("p"), F.greatest("part", q).alias("q"))))
    runs = dealt.withColumn("pair", other).select(F.xxhash64("block", "pair").alias("run"), "part", "node", "root")
    more = _cross(runs.join(nodes.select("node", "bits", "grams"), "node"))
    # links between components; a component is its root
    joined = connected_components(stage(more, "similar-more"))
    merged = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = joined.join(roots.select("node"), "node", "left_anti")
    return stage(merged.unionByName(alone), "similar-roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, wide: bool = False) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id linked over any number of steps).

    Fingerprints link at ``DISTANCE`` bits. With ``wide``, texts link by the similarity of their sets of five-word
    shingles instead, which finds copies with more changes and leaves alone those that share a repeated passage only; the
    fingerprint is then one of these sets.

    Equal texts share a node, so copies add no pairs. A row without words has fingerprint zero
    and is linked like any other. A null id is no smallest id; a component of null ids only has a null one. Repeated
    rows give a row each; other columns are ignored; an empty table gives no rows.
    """
    if wide:
        rows = stage(similar_rows(docs, id_col, text_col), "simhash")
        of_node = [F.first(c).alias(c) for c in ("bits", "bands", "grams")]
    else:
        rows = stage(fingerprints(docs, id_col, text_col, shingle), "simhash").withColumn("node", F.col("print"))
        of_node = []
    nodes = stage(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), *of_node), "simhash-nodes")
    roots = similar_roots(nodes) if wide else connected_components(print_links(nodes.select(F.col("node").alias("print"))))
    rooted = nodes.select("node", "least", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = stage(rooted.join(least, "root").select("node", "n", "component_id"), "simhash-components")
    # a node with over a 200th of the rows is hot: there are fewer than 200 of them
    hot = by_node.where(F.col("n") > max(1000, rows.count() // 200)).select("node", F.col("component_id").alias("hot_id"), F.lit(True).alias("hot"))
    marked = rows.select("doc_id", "print", "node").join(F.broadcast(hot), "node", "left")
    cold = marked.where(F.col("hot").isNull()).join(by_node.select("node", "component_id"), "node").select("doc_id", "print", "component_id")
    warm = marked.where("hot").select("doc_id", "print", F.col("hot_id").alias("component_id"))
    return cold.unionByName(warm).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
