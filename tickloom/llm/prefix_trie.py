"""Trie of conversation prefixes: which conversations share their first turns, and what sharing saves.

Every prefix of a conversation has a 128-bit digest, the exclusive or of the hashes of its turns with
their places, so digests of parts combine and a long conversation can be cut. A count-min sketch
of two rows counts all prefix digests, saturating at two: an estimate of one proves that no
other conversation has this prefix, nor any longer one of it. Such tails are nodes of one conversation
and are emitted where they are; only prefixes that may be shared are shuffled and grouped
exactly. Different prefixes share a digest with a chance of 2**-128 per pair, which is accepted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tickloom.llm import bloom
from tickloom.llm.batches import bound_batches
from tickloom.session import partitions_for, store

WORD = r"[^\x20\x09-\x0D]+"
# Turns of one conversation that a window takes; longer ones are cut into blocks of so many.
BLOCK_TURNS = 4096
# Cells of a sketch row: twice the prefixes, and at most 2**26 (64 MB in a task, 8 MB broadcast).
LEAST_BITS, MOST_BITS = 16, 26
# Conversations whose ids one piece of a node's list of ends joins.
PIECE_IDS = 10_000

KEY = ["depth", "k1", "k2"]


def place_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, place (from 1), two hashes of role and text, and words of every turn.

    Turns are ordered by their number, null first, then role and text; a null role or text is empty. A repeated
    turn is a turn of its own. Rows with a null conv_id are in no conversation. Rows are dealt out by
    ranges of their whole order, so a conversation of any length spans several tasks, and
    places are numbered on from part to part.
    """
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("role") + 16), F.lit(0))).first()[0]
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    ordered = rows.repartitionByRange(partitions_for(spark, size), *order).sortWithinPartitions(*order)
    turns = store(
        ordered.select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64(F.lit(1), "role", "text").alias("h1"),
            F.xxhash64(F.lit(2), "text", "role").alias("h2"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        ),
        "trie-turns",
    )
    parts = turns.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    parts = parts.select("conv_id", "part", (F.col("first") - before - 1).alias("base"))
    placed = turns.join(parts, ["conv_id", "part"])
    return placed.select("conv_id", (F.col("at") - F.col("base")).alias("place"), "h1", "h2", "words")


def conversation_lengths(placed: DataFrame) -> DataFrame:
    """conv_id and length, the number of turns."""
    return placed.groupBy("conv_id").agg(F.count("*").alias("length"))


def rebuild(placed: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first one of their family; turns and lengths.

    Conversation c takes the first h = crc32(c as text) mod ``most`` turns of conversation c - c mod ``family``
    (all, if it has fewer; none, if there is no such one), then its own turns after its first h. A
    conversation may end up without turns; its length is then 0.
    """
    own_root = F.col("conv_id") - F.col("conv_id") % family
    known = conversation_lengths(placed).select(
        "conv_id", "length", own_root.alias("root"), (F.crc32(F.col("conv_id").cast("string")) % most).alias("h")
    )
    roots = known.where("conv_id = root").select("root", F.col("length").alias("root_length"))
    taken = F.least("h", F.coalesce("root_length", F.lit(0)))
    plan = known.join(roots, "root", "left").select(
        "conv_id", "root", "h", taken.alias("taken"), (taken + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length")
    )
    plan = store(plan, "trie-conversations")
    own = placed.join(plan.select("conv_id", "h", "taken"), "conv_id").where("place > h")
    own = own.select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("place"), "h1", "h2", "words")
    heads = placed.where((F.col("conv_id") == own_root) & (F.col("place") < most)).withColumnRenamed("conv_id", "root")
    borrowed = heads.join(plan.select("conv_id", "root", "h"), "root").where("place <= h")
    return own.unionByName(borrowed.select(own.columns)), plan.select("conv_id", "length")


def _xor(x: Column, y: Column) -> Column:
    return x.bitwiseXOR(y)


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per conversation and prefix: its digest (k1, k2), that without its last turn (p1, p2), the words of
    the last turn and of all before it, and the conversation's length. Depth 0 is the empty prefix."""
    block = F.floor(F.col("depth") / BLOCK_TURNS)
    terms = turns.join(lengths, "conv_id").select(
        "conv_id", F.col("place").alias("depth"), "length", "words",
        F.xxhash64("h1", "h2", "place").alias("t1"), F.xxhash64("place", "h2", "h1").alias("t2"),
    )
    zero = F.lit(0).cast("long")
    top = lengths.select("conv_id", zero.alias("depth"), "length", zero.alias("words"), zero.alias("t1"), zero.alias("t2"))
    rows = terms.unionByName(top).withColumn("block", block)
    whole = F.expr("bit_xor(t1)"), F.expr("bit_xor(t2)"), F.sum("words")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({name: value.over(inside) for name, value in zip(("x1", "x2", "through"), whole)})
    # One row per block of the conversations that have more than one.
    totals = terms.where(F.col("length") >= BLOCK_TURNS).withColumn("block", block).groupBy("conv_id", "block")
    totals = totals.agg(*[value.alias(name) for name, value in zip(("t1", "t2", "words"), whole)])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "block", *[v.over(earlier).alias(n) for n, v in zip(("o1", "o2", "o"), whole)])
    joined = rows.join(offsets, ["conv_id", "block"], "left")
    keys = [_xor(F.col(x), F.coalesce(o, zero)) for x, o in (("x1", "o1"), ("x2", "o2"))]
    return joined.select(
        "conv_id", "depth", keys[0].alias("k1"), keys[1].alias("k2"),
        _xor(keys[0], F.col("t1")).alias("p1"), _xor(keys[1], F.col("t2")).alias("p2"),
        "words", (F.col("through") + F.coalesce("o", zero) - F.col("words")).alias("before"), "length",
    )


def _gather(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = bloom.Gathered(bits)
        for batch in batches:
            found.add(batch.column(0).to_numpy().view(np.uint64))
        yield from found.blocks()

    return run


def count_min(rows: DataFrame, most_bits: int = MOST_BITS) -> list[np.ndarray]:
    """For each row of the sketch, packed bits of the cells that count two or more.

    The width follows the number of prefixes up to 2**most_bits cells. Beyond that fewer singletons are
    proved, so more prefixes are grouped exactly, with the same results.
    """
    bits = min(max((2 * rows.count()).bit_length(), LEAST_BITS), most_bits)
    return [bloom.build(rows.select(k).mapInArrow(_gather(bits), bloom.SCHEMA), bits)[1] for k in ("k1", "k2")]


def _screen(sketch):
    """Flags the rows of proven singletons and of the prefixes behind them, and the first row of each such tail.

    Rows of a conversation come in order. Where a file is cut between them the tail may start anew: its
    rows are then proved by their own estimates, or grouped exactly like all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None, False)
        for batch in batches:
            ids, depths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            n = len(ids)
            if not n:
                continue
            k1, k2 = (batch.column(i).to_numpy().view(np.uint64) for i in (2, 3))
            alone = (depths > 0) & (~bloom.passes(sketch.value[0], k1) | ~bloom.passes(sketch.value[1], k2))
            follows = np.zeros(n, dtype=bool)
            follows[1:] = (ids[1:] == ids[:-1]) & (depths[1:] == depths[:-1] + 1)
            follows[0] = bool(ids[0] == last[0] and depths[0] == last[1] + 1) if last[0] is not None else False
            alone[0] |= follows[0] and last[2]
            place = np.arange(n)
            start = np.maximum.accumulate(np.where(follows, 0, place))
            tail = np.maximum.accumulate(np.where(alone, place, -1)) >= start
            head = tail & ~(follows & np.concatenate([[last[2]], tail[:-1]]))
            last = (ids[-1], depths[-1], bool(tail[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tail), pa.array(head)], names=[*batch.schema.names, "tail", "head"])

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined ids of the conversations that end at a node, in pieces."""
    for batch in batches:
        ids = batch.column(3).to_numpy()
        keys = [batch.column(i).to_numpy() for i in range(3)]
        fresh = np.ones(len(ids), dtype=bool)
        fresh[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0) if len(ids) else []
        starts = np.unique(np.concatenate([np.flatnonzero(fresh), np.arange(0, len(ids), PIECE_IDS)]))
        bounds = [*starts.tolist(), len(ids)]
        joined = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(bounds[:-1], bounds[1:])]
        columns = [pa.array(k[starts]) for k in keys] + [pa.array(ids[starts]), pa.array(joined, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*KEY, "first", "joined"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces in order, holding one piece at a time."""
    now, digest = None, None

    def done(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*KEY, "ends_sha256"])

    for batch in batches:
        rows = []
        for *key, joined in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if key == now:
                digest.update(b",")
            else:
                if now is not None:
                    rows.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
            digest.update(joined.encode())
        if rows:
            yield done(rows)
    if now is not None:
        yield done([(*now, digest.hexdigest())])


def _ends(shared: DataFrame) -> DataFrame:
    """Digest of the conversations that end at each shared node, by ascending id.

    Lists are joined piece by piece over ranges of node and id, so a node with a third of all conversations
    leaves one row for ten thousand of them to the task that digests its list.
    """
    ending = shared.where("depth = length").select(*KEY, "conv_id")
    parts = partitions_for(shared.sparkSession, 32 * ending.count())
    ranged = ending.repartitionByRange(parts, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = store(ranged.mapInArrow(_pieces, "depth long, k1 long, k2 long, first long, joined string"), "trie-ends")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        _digests, "depth long, k1 long, k2 long, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, lengths: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, place, h1, h2, words) with ``lengths`` (conv_id, length).

    conv_id is the node's smallest member, parent_conv_id that of its parent (null at the root); n_convs its members,
    n_children its children, n_leaves the childless nodes of its subtree, saved_tokens the words of
    the last turns in its subtree, each as often as its node has members beyond the first, and ends_sha256
    the digest of the members that end there. Without conversations there is no node.

    Sums over subtrees take no recursion: the nodes whose smallest member is c are c's prefixes from
    some depth on, so the words that c saves below a node are those of its prefixes up to that depth,
    and each childless node is counted by its smallest member.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    rows = store(prefixes(turns, lengths), "trie-prefixes")
    sketch = spark.sparkContext.broadcast(count_min(rows.where("depth > 0"), most_bits))
    schema = StructType(list(rows.schema.fields)).add("tail", "boolean").add("head", "boolean")
    rows = store(rows.mapInArrow(_screen(sketch), schema), "trie-screened")
    shared, alone = rows.where("NOT tail").drop("tail", "head"), rows.where("tail")

    first = shared.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.max("length").alias("longest"))
    owned = first.groupBy("conv_id").agg(F.count("*").alias("owned"), F.max(F.col("longest") == F.col("depth")).alias("leaf"))
    members = shared.groupBy("conv_id").agg(
        F.count("*").alias("m"), F.max(F.col("depth")).alias("deepest"), F.first("length").alias("length")
    )
    members = members.join(owned, "conv_id", "left").select(
        "conv_id",
        (F.col("m") - F.coalesce("owned", F.lit(0))).alias("own_from"),
        (F.coalesce("leaf", F.lit(False)) | (F.col("deepest") < F.col("length"))).cast("long").alias("leaf"),
    )
    members = store(members, "trie-members")
    known = shared.join(members, "conv_id")
    given_away = F.sum(F.when(F.col("depth") < F.col("own_from"), F.col("words"))).alias("given")
    known = known.join(known.groupBy("conv_id").agg(given_away), "conv_id")
    saved = F.when(F.col("depth") < F.col("own_from"), F.col("given") - F.col("before")).otherwise(0)
    nodes = known.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens"),
    )
    nodes = store(nodes, "trie-nodes")

    def above(df: DataFrame) -> DataFrame:
        return df.withColumns({"depth": F.col("depth") - 1, "k1": F.col("p1"), "k2": F.col("p2")})

    heads = alone.where("head").select("conv_id", *KEY, "p1", "p2")
    below = nodes.where("depth > 0").select(heads.columns).unionByName(heads)
    children = above(below).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parents = above(below.withColumns({"own1": F.col("k1"), "own2": F.col("k2")})).join(
        nodes.select(*KEY, F.col("conv_id").alias("parent_conv_id")), KEY
    )
    parents = parents.select((F.col("depth") + 1).alias("depth"), F.col("own1").alias("k1"), F.col("own2").alias("k2"), "parent_conv_id")
    nothing = F.sha2(F.lit(""), 256)
    full = nodes.join(children, KEY, "left").join(_ends(shared), KEY, "left")
    grouped = full.select(
        *KEY, "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    at_end = F.col("depth") == F.col("length")
    one = F.lit(1).cast("long")
    tails = alone.select(
        *KEY, "conv_id", one.alias("n_convs"), F.when(at_end, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(at_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"), "head",
    )
    # Within a tail the parent is the same conversation's, so only the first row of each looks for it.
    looking = grouped.unionByName(tails.where("head").drop("head")).join(parents, KEY, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    columns = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    looked = looking.select("conv_id", "depth", parent.alias("parent_conv_id"), *columns)
    inner = tails.where("NOT head").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *columns)
    return looked.unionByName(inner)
