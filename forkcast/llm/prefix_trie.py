"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns.  Every distinct sequence of its first d
turns is a node of depth d.  The trie is built by halves instead of turn by
turn, so the number of rounds is the logarithm of the longest conversation:

1. Blocks of 1, 2, 4, ... turns are named from the names of their two halves
   (``_blocks``).  A name is 16 bytes of SHA-256, so no dictionary is needed.
2. Sequences of height 2h are cut at h; the cut prefix is named from its root
   and the block above the cut.  What lies above all cuts is the upper trie,
   what lies below a cut its lower forest.  All of them are problems of height
   h, and every round works on all of them at once, keeping one
   representative of those that agree (``_cut``).  At height 1 they are edges.
3. Totals are grafted: a first sweep adds the lower forests' totals to the
   roots they hang under, height by height; a second one hands every cut the
   totals of what lies deeper (``_graft``).

Every round is a join on (conversation, block) or on a node's name, and a
grouped sum combined before the shuffle; every round is written to the shared
checkpoint folder.  No task gets a conversation, a node's members or its
children as a group.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forkcast.operators.ranks import with_position
from forkcast.session import materialize


def _root() -> Column:
    """The name of the node without turns."""
    return F.unhex(F.lit("00" * 16))


def _name(kind: str, *parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(F.lit(kind).cast("binary"), *parts), 256)), 1, 16)


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, position, name, bytes): every turn, numbered from 0 in its
    conversation, with a name of what it says and the bytes of its text.

    By turn, null first; equal turns go by their names, so repeated rows are
    all there and in a fixed order.  Null roles and texts count as empty, rows
    with a null conv_id belong to no conversation and are left out; other
    columns are ignored.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary"))
    rows = conversations.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), _name("", said).alias("name"), F.octet_length(text).cast("long").alias("bytes"))
    return with_position(rows.where("conv_id is not null"), ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("name")]).select("conv_id", "position", "name", "bytes")


def _blocks(said: DataFrame, longest: int) -> list[DataFrame]:
    """Per level j the (conv_id, at, name) of all whole blocks of 2**j turns."""
    level = said.select("conv_id", F.col("position").alias("at"), "name")
    out = [level]
    while 2 ** len(out) <= longest:
        half = F.col("at") % 2
        pairs = level.groupBy("conv_id", F.shiftright("at", 1).alias("at")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("left"), F.max(F.when(half == 1, F.col("name"))).alias("right"))
        level = materialize(pairs.where("right is not null").select("conv_id", "at", _name("b", F.col("left"), F.col("right")).alias("name")), "blocks")
        out.append(level)
    return out


def _ends(lengths: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """(conv_id, n, end): the node at which every conversation ends, named
    from its blocks in falling size, as the cuts name it too."""
    bits = F.expr(f"filter(sequence(0, {len(blocks) - 1}), j -> shiftright(n, j) % 2 = 1)")
    wanted = lengths.select("conv_id", F.explode(bits).alias("level"), "n").select("conv_id", "level", F.expr("shiftright(n, level) - 1").alias("at"))
    every = None
    for j, level in enumerate(blocks):
        rows = level.withColumn("level", F.lit(j))
        every = rows if every is None else every.unionAll(rows)
    parts = wanted.join(every, ["conv_id", "level", "at"]).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("level")).alias("o"), "name"))).alias("parts"))
    end = F.aggregate(F.coalesce("parts", F.array()), _root(), lambda node, part: _name("n", node, part["name"]))
    return lengths.join(parts, "conv_id", "left").select("conv_id", "n", end.alias("end"))


def _cut(problems: DataFrame, blocks: DataFrame, half: int) -> DataFrame:
    """Problems of height 2 * half into those of height half.

    A problem is what one or more conversations say below a root: (root, at:
    the root's depth over the height, end: the node where it reaches its full
    height, else null, left: turns in it, conv_id: the smallest conversation
    of these, n_convs).
    """
    upper = blocks.where("at % 2 = 0").select("conv_id", F.shiftright("at", 1).alias("at"), F.col("name").alias("upper"))
    x = problems.join(upper, ["conv_id", "at"], "left")
    cut = F.when(F.col("upper").isNotNull(), _name("n", F.col("root"), F.col("upper")))
    x = x.withColumn("cut", cut)
    piece = lambda at, root, end, left: F.struct(at.alias("at"), root.alias("root"), end.alias("end"), left.cast("long").alias("left"))
    above = piece(F.col("at") * 2, F.col("root"), F.col("cut"), F.least("left", F.lit(half)))
    below = piece(F.col("at") * 2 + 1, F.col("cut"), F.col("end"), F.col("left") - half)
    pieces = x.select("conv_id", "n_convs", F.explode(F.when(F.col("left") > half, F.array(above, below)).otherwise(F.array(above))).alias("p")).select("conv_id", "n_convs", "p.*")
    alone = F.when(F.col("end").isNull(), F.col("conv_id"))
    return pieces.groupBy("root", "at", "end", "left", alone.alias("alone")).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs")).drop("alone")


def _sum(rows: DataFrame) -> DataFrame:
    return rows.groupBy("node").agg(F.max("depth").alias("depth"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _graft(own: DataFrame, problems: list[DataFrame]) -> DataFrame:
    """(node, leaves, saved) summed over subtrees, from each node's ``own``
    (node, depth, leaves, saved) and the problems of every height 2**j."""
    sums = [own]  # sums[j]: nodes at multiples of 2**j, over their problem of that height
    for j, level in enumerate(problems[:-1]):
        under = level.where("end is not null and at % 2 = 0").select(F.col("end").alias("node"), "root", (F.col("at") * 2 ** j).alias("root_depth"))
        moved = sums[-1].join(under, "node", "left").select(F.coalesce("root", "node").alias("node"), F.coalesce("root_depth", "depth").alias("depth"), "leaves", "saved")
        sums.append(materialize(_sum(moved), "sums"))
    done = [sums[-1]]
    for j in range(len(problems) - 2, -1, -1):
        fresh = sums[j].where(F.col("depth") % 2 ** (j + 1) != 0)
        deeper = problems[j].where("end is not null and at % 2 = 1").select(F.col("end").alias("node"), "root", (F.col("at") * 2 ** j).alias("root_depth"))
        known = done[0]
        for part in done[1:]:
            known = known.unionAll(part)
        handed = deeper.join(known.select("node", "leaves", "saved"), "node").select(F.col("root").alias("node"), F.col("root_depth").alias("depth"), "leaves", "saved")
        done.append(materialize(_sum(fresh.unionAll(handed)), "totals"))
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out.select("node", "leaves", "saved")


def build(said: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of ``said`` (as from ``turns``, positions
    without gaps) over all ``conversations`` (conv_id; those without turns
    are members of the root only).

    nodes: node (a 16-byte name), depth, conv_id (smallest member),
    parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens; ends: conv_id, n (its turns), end (the node's name).  No
    conversations give no rows in either.
    """
    said = materialize(said, "turns")
    sizes = said.groupBy("conv_id").agg(F.count("*").alias("n"))
    lengths = materialize(conversations.select("conv_id").where("conv_id is not null").distinct().join(sizes, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0)).alias("n")), "lengths")
    longest = lengths.agg(F.max("n")).first()[0] or 0
    blocks = _blocks(said, longest)
    ends = materialize(_ends(lengths, blocks), "ends")
    levels = max(longest.bit_length(), 1)
    level = materialize(ends.where("n > 0").groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n").alias("left"))
                        .select("conv_id", F.lit(0).cast("long").alias("at"), _root().alias("root"), F.lit(None).cast("binary").alias("end"), "left", "n_convs"), "problems")
    problems = [level]
    empty = blocks[0].limit(0)
    for j in range(levels - 1, -1, -1):
        level = materialize(_cut(level, blocks[j] if j < len(blocks) else empty, 2 ** j), "problems")
        problems.insert(0, level)
    edges = problems[0].join(said.select("conv_id", F.col("position").alias("at"), "bytes"), ["conv_id", "at"])
    edges = edges.select(F.col("end").alias("node"), F.col("root").alias("parent"), (F.col("at") + 1).alias("depth"), "conv_id", "n_convs", "bytes")
    top = ends.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(_root().alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes"))
    children = edges.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = materialize(edges.unionAll(top).join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    own = nodes.select("node", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    totals = _graft(own, problems)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, "node").join(parents, "parent", "left")
    return out.select("node", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), ends


def _joined(batches):
    """Ordered (node, conv_id) rows to (node, first, ids): the ids of each
    stretch of equal nodes in a batch, comma-joined."""
    for batch in batches:
        node, ids = batch.column(0), batch.column(1)
        if not len(ids):
            continue
        new = pc.not_equal(node.slice(1), node.slice(0, len(node) - 1)).to_numpy(zero_copy_only=False)
        starts = [0, *(new.nonzero()[0] + 1).tolist()]
        texts = ids.cast(pa.string()).to_pylist()
        joined = [",".join(texts[a:b]) for a, b in zip(starts, [*starts[1:], len(texts)])]
        yield pa.RecordBatch.from_arrays([node.take(pa.array(starts)), ids.take(pa.array(starts)), pa.array(joined, pa.string())], ["node", "first", "ids"])


def _hashed(batches):
    """Ordered (node, ids) pieces to (node, SHA-256 of the pieces, comma-joined)."""
    node, digest = None, None
    for batch in batches:
        done = []
        for at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], ["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["node", "ends_sha256"])


def ends_sha256(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end: SHA-256 of
    their ids in rising order, comma-joined.

    Ids are dealt by ranges of (node, id) and joined to pieces there; the hash
    runs over a node's pieces in order and holds one at a time.
    """
    pieces = ends.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id").mapInArrow(_joined, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(_hashed, "node binary, ends_sha256 string")


def share_heads(said: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations as if grown from a shared start: (turns, conversations).

    Conversation c gets the first h turns of conversation c - c % group (all
    if it has fewer, none if there is none), then its own turns after the
    first h; h is the unsigned crc32 of c in decimal, modulo ``most``.
    """
    said = materialize(said, "own")
    sizes = said.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = sizes.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    convs = materialize(convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
                        .select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "heads")
    heads = said.where(F.col("position") < most - 1).withColumnRenamed("conv_id", "base").join(convs, "base").where("position < h")
    tails = said.join(convs, "conv_id").where("position >= h")
    return heads.select("conv_id", "position", "name", "bytes").unionAll(tails.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "name", "bytes")), convs.select("conv_id")


def digests(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes by smallest member and depth, with their ends' digest."""
    none = hashlib.sha256(b"").hexdigest()
    rows = nodes.join(ends_sha256(ends), "node", "left")
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
