"""Prefix trie of conversations without a tree walk: whole sequences are collapsed first, then their prefixes are summed.

A sequence is known by the exclusive or of 120-bit digests of its turns, each taken with its place, so that prefixes
are running values, blocks of a long conversation add up, and no text moves. Identical conversations become one
sequence with a weight and a list of ends; sequences that are proper prefixes of others leave by anti-join, what is
left are the leaves. Every remaining step is a sum over the prefixes of the distinct sequences, which grows with the
number of turns.

Texts shared in a subtree are counted once through owners: a node belongs to the smallest conversation through it, and
what a conversation owns is the end of its own path. So the sum over a subtree needs one number per sequence, the
depth from which it owns its path, and no list of pairs of nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageloom.llm.words import batches, rows
from pageloom.session import ensure_checkpoint_dir

#: Turns or ids in one block: a longer conversation or list is spread over several keys.
BLOCK = 4096
#: A node: depth and digest of the turns down to it.
NODE = ["depth", "hi", "lo"]


def _halves(digest: str, *names: str) -> list:
    """Two 60-bit numbers of a hexadecimal MD5 digest."""
    return [F.expr(f"cast(conv(substr({digest}, {at}, 15), 16, 10) as long)").alias(name) for at, name in zip((1, 17), names)]


def _dealt(frame: DataFrame, *order) -> DataFrame:
    """Rows in range partitions of an order, with the partition as ``part``; kept, so that a repeated task sees the same."""
    ensure_checkpoint_dir(frame.sparkSession)
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()).checkpoint()


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows ``(conv_id, place, digest, chars)``: every turn with its place in its conversation, from 0.

    Turns stand in the order of ``turn``, nulls first; equal turns in the order of the digest of role and text. A null
    role or text is empty. Rows without a conversation are left out. Repeated rows are turns of their own. A
    conversation may be as long as it likes: it is cut where the ranges of the order are cut, and counted on.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    )
    dealt = _dealt(slim, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"))
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("part", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    placed = dealt.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["part", "conv_id"])
    return placed.select("conv_id", (F.col("before") + F.col("at")).alias("place"), "digest", "chars")


def rebuild(turns: DataFrame, family: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of the first of their family: ``(conv_id, length)`` and ``(conv_id, place, digest, chars)``.

    ``turns`` are those of ``ordered_turns``. Conversation c takes the first h turns of c - c % ``family`` (all if that
    has fewer, none if it is absent), h = crc32(c) % (``most`` + 1), then its own turns after its first h.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    # at most `most` turns of each donor
    donors = (
        turns.where((F.col("conv_id") % family == 0) & (F.col("place") < most))
        .groupBy(F.col("conv_id").alias("donor"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("heads"))
    )
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("h", head)
    convs = (
        sizes.withColumn("donor", F.col("conv_id") - F.col("conv_id") % family)
        .join(donors, "donor", "left")
        .select("conv_id", "own", "h", F.expr("coalesce(slice(heads, 1, cast(h as int)), array())").alias("heads"))
        .withColumn("taken", F.size("heads"))
        .withColumn("length", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).cast("long"))
        .checkpoint()
    )
    blocks = convs.select("conv_id", "taken", F.explode(F.expr(f"sequence(0L, (own - 1) div {BLOCK})")).alias("block"))
    rest = turns.withColumn("h", head).where("place >= h").withColumn("block", F.expr(f"place div {BLOCK}"))
    tails = rest.join(blocks, ["conv_id", "block"]).select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "chars")
    heads = convs.select("conv_id", F.explode("heads").alias("t")).select("conv_id", "t.place", "t.digest", "t.chars")
    return convs.select("conv_id", "length"), tails.unionByName(heads)


def ends(sequences: DataFrame) -> DataFrame:
    """Rows ``(depth, hi, lo, ends_sha256)``: SHA-256 of the ids ``conv_id`` of each sequence, ascending, joined by commas.

    Ids are packed into blocks of text where their ranges lie; one task then runs over the blocks of a sequence in
    order, a block at a time, since the digest has to see them one after the other.
    """
    dealt = _dealt(sequences.select(*NODE, "conv_id"), *NODE, "conv_id")
    number = F.row_number().over(W.partitionBy("part", *NODE).orderBy("conv_id"))
    packed = (
        dealt.withColumn("block", F.floor((number - 1) / BLOCK))
        .groupBy("part", *NODE, "block")
        .agg(F.min("conv_id").alias("least"), F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )
    out = pa.schema([("depth", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("ends_sha256", pa.string())])

    def run(found):
        def records():
            node, state = None, None
            for batch in found:
                for *key, ids in rows(batch, *NODE, "ids"):
                    if key != node:
                        if node:
                            yield *node, state.hexdigest()
                        node, state = key, hashlib.sha256(ids.encode())
                    else:
                        state.update(b"," + ids.encode())
            if node:
                yield *node, state.hexdigest()

        yield from batches(records(), out)

    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.repartition(parts, *NODE).sortWithinPartitions(*NODE, "least").select(*NODE, "ids").mapInArrow(run, "depth long, hi long, lo long, ends_sha256 string")


def prefix_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``(conv_id, length)`` with ``turns`` ``(conv_id, place, digest, chars)``.

    Columns, all long but the last: ``conv_id``, the smallest member; ``depth``; ``parent_conv_id``, that of the parent
    (root: null); ``n_convs``; ``n_children``; ``n_leaves``, childless nodes of the subtree; ``saved_tokens``, the sum
    over the subtree of (members - 1) times the characters of the node's last text; ``ends_sha256`` of the members that
    end at the node. The subtree includes its top, the root has no text. No conversations give no rows; a
    conversation without turns ends at the root.
    """
    ensure_checkpoint_dir(convs.sparkSession)
    named = turns.withColumn("_d", F.md5(F.concat_ws(":", F.col("place").cast("string"), "digest").cast("binary"))).select(
        "conv_id", "place", "chars", *_halves("_d", "hi", "lo")
    )
    named = named.checkpoint()
    summed = named.groupBy("conv_id").agg(F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"), F.sum("chars").alias("total"))
    whole = convs.join(summed, "conv_id", "left").select(
        "conv_id", F.col("length").alias("depth"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("hi", "lo", "total")]
    )
    whole = whole.checkpoint()
    # identical conversations become one sequence, known by its smallest conversation
    sequences = whole.groupBy(*NODE).agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"), F.min("total").alias("total")).checkpoint()

    paths = _paths(sequences, named).checkpoint()
    proper = paths.where("depth < length").select(*NODE).distinct()
    some = sequences.where("depth > 0").limit(1).select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("lo"))
    leaves = sequences.join(proper.unionByName(some), NODE, "left_anti").select("rep", F.lit(1).alias("leaf"))
    # the depth from which a sequence owns its path, and the characters from there on
    owned = (
        paths.groupBy(*NODE)
        .agg(F.min(F.struct("rep", "rest")).alias("o"))
        .groupBy(F.col("o.rep").alias("rep"))
        .agg(F.min(F.struct("depth", F.col("o.rest").alias("rest"))).alias("from"))
    )
    facts = sequences.select("rep", "weight", "total", F.col("depth").alias("length")).join(leaves, "rep", "left").join(owned, "rep", "left").na.fill(0, ["leaf"]).checkpoint()

    at_node = paths.join(_blocks(facts, "length"), ["rep", "block"]).select(
        *NODE, "rep", "weight", "leaf", "parent_hi", "parent_lo", F.expr("weight * rest - coalesce(if(depth >= from.depth, rest, from.rest), 0)").alias("saved")
    )
    totals = [F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")]
    deep = at_node.groupBy(*NODE).agg(*totals, F.min("parent_hi").alias("parent_hi"), F.min("parent_lo").alias("parent_lo"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    top = facts.select("rep", "weight", "leaf", F.expr("weight * total - coalesce(from.rest, 0)").alias("saved")).agg(*totals).where("conv_id is not null")
    top = top.select(zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), "conv_id", "n_convs", "n_leaves", "saved_tokens", none.alias("parent_hi"), none.alias("parent_lo"))
    nodes = deep.unionByName(top).checkpoint()

    up = [(F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(parents, ["depth", "parent_hi", "parent_lo"], "left")
        .join(children, NODE, "left")
        .join(ends(whole), NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("n_leaves").cast("long").alias("n_leaves"),
            F.col("saved_tokens").cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )


def _blocks(facts: DataFrame, length: str) -> DataFrame:
    """The rows once for each block of turns of their sequences."""
    return facts.where(F.col(length) > 0).withColumn("block", F.explode(F.expr(f"sequence(0L, ({length} - 1) div {BLOCK})")))


def _paths(sequences: DataFrame, turns: DataFrame) -> DataFrame:
    """Rows for each prefix of each sequence: ``rep``, ``block``, node, digest of the parent, ``rest`` (characters from its last turn on), ``length``."""
    wanted = _blocks(sequences.select("rep", "total", F.col("depth").alias("length")), "length")
    mine = turns.withColumnRenamed("conv_id", "rep").withColumn("block", F.expr(f"place div {BLOCK}")).join(wanted, ["rep", "block"])
    sums = mine.groupBy("rep", "block").agg(F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"), F.sum("chars").alias("chars"))
    earlier = W.partitionBy("rep").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(
        "rep",
        "block",
        F.coalesce(F.bit_xor("hi").over(earlier), F.lit(0)).alias("b_hi"),
        F.coalesce(F.bit_xor("lo").over(earlier), F.lit(0)).alias("b_lo"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("b_chars"),
    )
    running = W.partitionBy("rep", "block").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = mine.select(
        "*", F.bit_xor("hi").over(running).alias("r_hi"), F.bit_xor("lo").over(running).alias("r_lo"), F.sum("chars").over(running).alias("r_chars")
    ).join(before, ["rep", "block"])
    return run.selectExpr(
        "rep",
        "block",
        "place + 1 as depth",
        "r_hi ^ b_hi as hi",
        "r_lo ^ b_lo as lo",
        "r_hi ^ b_hi ^ hi as parent_hi",
        "r_lo ^ b_lo ^ lo as parent_lo",
        "total - b_chars - r_chars + chars as rest",
        "length",
    )


def conversation_trie(turns: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """Nodes (``prefix_nodes``) of the conversations rebuilt (``rebuild``) from a table of turns (``ordered_turns``)."""
    ordered = ordered_turns(turns).checkpoint()
    return prefix_nodes(*rebuild(ordered, family, most))
