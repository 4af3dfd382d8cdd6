"""Prefix trie of conversations by partition refinement.

All conversations begin as one class. Each turn splits a class into those that have the same turn next; a class of one
conversation is retired, its remaining turns being a chain of nodes with one child each. A round refines the active classes
by several turns, twice as many as the round before, so that rounds grow with the logarithm of the longest shared prefix.
What subtrees add up to is then folded back from the last turn to the first.

A conversation's turns are rows, not a list, and classes are rows (conversation, depth, class): a class of a third of all
conversations is added up by tasks before it is shuffled.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import crc_text, stage

#: Turns of the first round.
FIRST_ROUND = 4
#: Bytes of the list of conversations that end at a node, written as one row.
LIST_PART = 1 << 16
#: Fixed: what the contract takes the remainder of.
GROUP, MOST_SHARED = 5, 9


def numbered(rows: DataFrame, key: str, order: list, keep: list, tag: str) -> DataFrame:
    """``keep`` columns with ``key`` and ``k``, the place of a row in the order of its key, from 1.

    Rows are dealt by ranges of key and order, so a key with any share of the rows is the work of many tasks; a range that
    goes on with the key of the one before starts from that one's count. At most one key a range does so, so the table of
    these is no larger than the number of ranges, and is broadcast.
    """
    kept = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order).select(key, *keep)

    def run(batches):
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(0)
            heads = [0, *(pc.indices_nonzero(pc.not_equal(keys[1:], keys[:-1])).to_numpy() + 1).tolist(), len(batch)]
            places: list[int] = []
            for a, b in zip(heads, heads[1:]):
                n = n if keys[a] == last else 0
                places += range(n + 1, n + b - a + 1)
                last, n = keys[a], n + b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(batch), pa.int32()), pa.array(places, pa.int64())], [*batch.schema.names, "_part", "_place"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    placed = stage(kept.mapInArrow(run, f"{fields}, _part int, _place long"), tag)
    ends = placed.groupBy(key, "_part").agg(F.max("_place").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    went_on = ends.withColumn("_before", before).where("_before is not null").select(key, "_part", "_before")
    return placed.join(F.broadcast(went_on), [key, "_part"], "left").select(key, *kept.columns[1:], (F.col("_place") + F.coalesce("_before", F.lit(0))).alias("k"))


def turn_digest(role, text):
    """32 bytes that differ for different turns."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns: c, depth, digest, size; all: c) of the rebuilt conversations; a conversation may have no turns.

    Conversation c has the first h turns of c - c % 5 (all if that has fewer, none if it is absent), then its own after its
    first h; h is the crc32 of c in decimal, modulo 9; remainders have the sign of c. Turns are in order of ``turn``, a null
    first, and of role and text where turns are equal. A null role or text is empty; rows with a null id are no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"digest": turn_digest(F.col("role"), F.col("text")), "size": F.octet_length("text").cast("long")})
    turns = stage(numbered(rows, "c", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ["digest", "size"], "turns-placed"), "turns")
    shared = (crc_text("c") % MOST_SHARED).cast("long")
    every = stage(turns.where("k = 1").select("c", (F.col("c") - F.col("c") % GROUP).alias("base"), shared.alias("h")), "convs")
    # the base's first turns, eight at the most
    heads = turns.where(F.col("k") < MOST_SHARED).select(F.col("c").alias("base"), F.col("k").alias("depth"), "digest", "size")
    lent = every.join(heads, "base").where("depth <= h").select("c", "depth", "digest", "size")
    held = every.join(heads.groupBy("base").agg(F.count("*").alias("n")), "base", "left").select("c", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken"))
    own = turns.join(held, "c").where("k > h").select("c", (F.col("k") - F.col("h") + F.col("taken")).alias("depth"), "digest", "size")
    return stage(lent.unionByName(own), "rebuilt"), every.select("c")


def refined(turns: DataFrame, every: DataFrame) -> DataFrame:
    """(c, depth, top, n): the class, named by its smallest conversation, of each conversation at each depth at which its class has two or more.

    At depth 0 all are of one class; a single conversation has no row.
    """
    whole = every.agg(F.min("c").alias("top"), F.count("*").alias("n")).where("n > 1")
    found = stage(every.join(F.broadcast(whole)).select("c", F.lit(0).cast("long").alias("depth"), "top", "n"), "classes")
    active, depth, width = found.select("c", "top"), 0, FIRST_ROUND
    while True:
        ahead = turns.where((F.col("depth") > depth) & (F.col("depth") <= depth + width)).join(active, "c")
        # two conversations of a class are together as long as all their turns of this round are the same: what is compared
        # is the sum, without carries, of hashes of turns and their places
        so_far = Window.partitionBy("c").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
        marks = {f"_h{n}": F.bit_xor(F.xxhash64(F.lit(n), "depth", "digest")).over(so_far) for n in (1, 2)}
        keys = ["top", "depth", *marks]
        split = stage(ahead.withColumns(marks).select("c", *keys), "split")
        classes = split.groupBy(*keys).agg(F.min("c").alias("_first"), F.count("*").alias("n")).where("n > 1")
        here = stage(split.join(classes, keys).select("c", "depth", F.col("_first").alias("top"), "n"), "classes")
        if here.isEmpty():
            return found
        found = found.unionByName(here)
        depth += width
        width *= 2
        active = here.where(F.col("depth") == depth).select("c", "top")


def end_lists(ends: DataFrame) -> DataFrame:
    """(top, depth, ends_sha256) of rows (top, depth, c): SHA-256 of a node's ``c`` in decimal, ascending, comma-joined.

    Ranges of the rows write parts of the lists, so a node at which a third of all conversations end is the work of many
    tasks; the parts of a list are then hashed in order.
    """
    names = ["top", "depth", "c"]

    def parts(batches):
        node, first, text, size = None, None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for top, depth, c in zip(*[batch.column(x).to_pylist() for x in names], strict=True):
                if (top, depth) != node or size > LIST_PART:
                    if text:
                        out.append((*node, first, ",".join(text)))
                    node, first, text, size = (top, depth), c, [], 0
                text.append(str(c))
                size += len(text[-1]) + 1
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip((*names, "part"), x, strict=True)) for x in out], schema=kind)
                out = []
        if text:
            yield pa.RecordBatch.from_pylist([dict(zip((*names, "part"), (*node, first, ",".join(text)), strict=True))], schema=kind)

    kind = pa.schema([("top", pa.int64()), ("depth", pa.int64()), ("c", pa.int64()), ("part", pa.string())])

    def digests(batches):
        node, sha = None, None
        for batch in batches:
            out = []
            for top, depth, part in zip(*[batch.column(x).to_pylist() for x in ("top", "depth", "part")], strict=True):
                if (top, depth) != node:
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (top, depth), hashlib.sha256(part.encode())
                else:
                    sha.update(f",{part}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["top", "depth", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], ["top", "depth", "ends_sha256"])

    listed = ends.repartitionByRange(*names).sortWithinPartitions(*names).mapInArrow(parts, "top long, depth long, c long, part string")
    return listed.repartition("top", "depth").sortWithinPartitions(*names).select("top", "depth", "part").mapInArrow(digests, "top long, depth long, ends_sha256 string")


def turn_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (see :func:`rebuilt_turns`).

    A node stands for a distinct sequence of turns, the root for none; it has the rebuilt conversations that start so as
    members, and is named by the smallest of them and its depth. ``n_leaves`` and ``saved_tokens`` (bytes of the node's last
    text for every member but one) are summed over its subtree, itself included; ``ends_sha256`` is of the members that end
    there. An empty table has no nodes. Repeated rows are turns of their own; columns other than conv_id, turn, role and text
    are ignored, so their names can't clash. Whole texts count, however long.
    """
    turns, every = rebuilt_turns(conversations.select("conv_id", "turn", "role", "text"))
    classes = refined(turns, every)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    long = lambda x: F.lit(x).cast("long")
    # how long a conversation is, and until which depth it shares its class; beyond that it is a chain
    length = every.join(turns.groupBy("c").agg(F.max("depth").alias("len")), "c", "left").select("c", F.coalesce("len", long(0)).alias("len"))
    last = classes.groupBy("c").agg(F.max("depth").alias("shared"), F.max_by("top", "depth").alias("last_top"))
    state = stage(length.join(last, "c", "left").select("c", "len", F.coalesce("shared", long(-1)).alias("shared"), F.coalesce("last_top", "c").alias("last_top")), "states")

    # shared nodes with their parents and bytes; every depth of a node's own conversation that it shares has a row in classes
    own = classes.where("c = top").select("top", "depth", "n")
    above = classes.select(F.col("c").alias("top"), (F.col("depth") + 1).alias("depth"), F.col("top").alias("parent"))
    texts = turns.select(F.col("c").alias("top"), "depth", "size")
    nodes = stage(own.join(above, ["top", "depth"], "left").join(texts, ["top", "depth"], "left").select("top", "depth", "parent", "n", ((F.col("n") - 1) * F.coalesce("size", long(0))).alias("saved")), "nodes")

    # chains: the turns after the last shared depth; a lone conversation has the root as well
    tails = turns.join(state, "c").where("depth > shared").select("c", "depth", F.when(F.col("depth") == F.col("shared") + 1, F.col("last_top")).otherwise(F.col("c")).alias("parent"), "len")
    alone = state.where("shared = -1").select("c", long(0).alias("depth"), F.lit(None).cast("long").alias("parent"), "len")
    chains = tails.unionByName(alone)

    # children of shared nodes: shared ones, and the heads of chains
    heads = state.where("len > shared and shared >= 0").select(F.col("last_top").alias("top"), F.col("shared").alias("depth"))
    children = nodes.where("parent is not null").select(F.col("parent").alias("top"), (F.col("depth") - 1).alias("depth")).unionByName(heads).groupBy("top", "depth").agg(F.count("*").alias("n_children"))
    known = stage(nodes.join(children, ["top", "depth"], "left").withColumn("n_children", F.coalesce("n_children", long(0))), "nodes")

    # folded back: what the nodes of a conversation add is summed from its last depth to its first, then by class
    leaves = known.select(F.col("top").alias("c"), "depth", F.when(F.col("n_children") == 0, long(1)).otherwise(long(0)).alias("leaves"), "saved")
    ended = state.where("len > shared and shared >= 0").select("c", F.col("shared").alias("depth"), long(1).alias("leaves"), long(0).alias("saved"))
    adds = leaves.where("leaves > 0 or saved > 0").unionByName(ended).groupBy("c", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    lines = classes.select("c", "depth", "top").join(adds.select("c").distinct(), "c", "left_semi").join(adds, ["c", "depth"], "left")
    below = Window.partitionBy("c").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = lines.select("top", "depth", *[F.coalesce(F.sum(x).over(below), long(0)).alias(x) for x in ("leaves", "saved")])
    folded = summed.groupBy("top", "depth").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    ends = end_lists(state.where("len = shared").select(F.col("last_top").alias("top"), F.col("len").alias("depth"), "c"))
    inner = known.join(folded, ["top", "depth"], "left").join(ends, ["top", "depth"], "left").select(
        F.col("top").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", F.coalesce("n_leaves", long(0)).alias("n_leaves"), F.coalesce("saved_tokens", long(0)).alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
    at_end = F.col("depth") == F.col("len")
    outer = chains.select(
        F.col("c").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), long(1).alias("n_convs"), F.when(at_end, long(0)).otherwise(long(1)).alias("n_children"), long(1).alias("n_leaves"), long(0).alias("saved_tokens"), F.when(at_end, F.sha2(F.col("c").cast("string"), 256)).otherwise(none).alias("ends_sha256")
    )
    return inner.unionByName(outer)
