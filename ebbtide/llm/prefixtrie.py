"""Prefix tries of conversations, with subtree totals by parallel tree contraction.

A node of the trie is a distinct sequence of first turns; the conversations that
start with it are its members. Nodes are named by (smallest member, depth), which
is unique. Prefixes are compared by two 64-bit hashes: the exclusive or of a hash
of each turn at its position, so prefix hashes are running sums that can be cut
anywhere, and a conversation of any length is spread over tasks.

Subtree totals come from contraction in join rounds. A round

- rakes: the leaves add what they hold to their parents and go, and
- compresses: of a chain of nodes with one child each, those go whose mark is set
  while their parent's is not, so no two neighbours go at once; a node that goes
  leaves what it holds on the edge above its child. Marks are the bits of the
  depth, lowest first, which halves a chain in each round; after these, coins.

Then the rounds are undone in reverse: the total of a node that was compressed
is its child's plus what was left between them. The number of rounds grows with
the logarithm of the nodes, and each works on what the rounds before left. Every
round is a written table, so a lost executor costs one round at most.

Defined results: turns are ordered by turn, NULL first, and equal turns by role
and text; a NULL role or text is empty; rows with a NULL conversation are left
out; repeated rows are turns of their own; no conversations give no nodes. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored

#: Turns of one conversation that a task sums up, and members that one row spells.
_BLOCK, _SPELLED = 4096, 1024
_NODE = ["conv_id", "depth"]


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, n_bytes) for rows of (conv_id, turn, role, text): places from 0, hashes of a turn.

    Rows are range-sorted; a place is that in the range plus the turns that the
    same conversation has in earlier ranges.
    """
    shape = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranges = stored(
        shape.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64("role", "text").alias("t1"),
            F.xxhash64(F.lit("text"), "text", "role").alias("t2"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        ),
        "trie-turns",
    )
    pieces = ranges.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return ranges.join(pieces, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") + F.col("shift")).alias("pos"), "t1", "t2", "n_bytes"
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """Adds (a, b), the hash of each turn's prefix, and (before_a, before_b) of the one before, to ordered turns."""
    at = turns.select(
        "conv_id",
        "pos",
        "n_bytes",
        F.xxhash64("pos", "t1", "t2").alias("h1"),
        F.xxhash64("t2", "pos", "t1").alias("h2"),
        F.floor(F.col("pos") / _BLOCK).alias("block"),
    )
    blocks = at.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("c1"), F.bit_xor("h2").alias("c2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "conv_id", "block", F.bit_xor("c1").over(before).alias("c1"), F.bit_xor("c2").over(before).alias("c2")
    ).where("block > 0")
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = at.withColumns({"x1": F.bit_xor("h1").over(inside), "x2": F.bit_xor("h2").over(inside)})
    a, b = (F.col(f"x{i}").bitwiseXOR(F.coalesce(F.col(f"c{i}"), F.lit(0))) for i in (1, 2))
    return (
        summed.join(carried, ["conv_id", "block"], "left")
        .withColumns({"a": a, "b": b})
        .select(
            "conv_id",
            (F.col("pos") + 1).alias("depth"),
            "n_bytes",
            "a",
            "b",
            F.col("a").bitwiseXOR(F.col("h1")).alias("before_a"),
            F.col("b").bitwiseXOR(F.col("h2")).alias("before_b"),
        )
    )


def trie(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of ordered turns; ``conversations`` holds every conv_id, turnless ones too.

    Nodes are (conv_id, depth, parent_conv_id, n_convs, n_children, own), where own
    is (n_convs - 1) times the bytes of the node's last text; ends are (conv_id,
    depth, member) for the node at which each member ends.
    """
    named = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"))
    convs = stored(named.distinct(), "trie-convs")
    least, count = convs.agg(F.min("conv_id"), F.count("*")).first()
    rows = stored(prefixes(turns), "trie-prefixes")
    found = stored(
        rows.groupBy("depth", "a", "b").agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.max("n_bytes").alias("n_bytes"),
            F.min("before_a").alias("before_a"),
            F.min("before_b").alias("before_b"),
        ),
        "trie-nodes",
    )
    # Every node of depth 1 hangs from the root, which needs no join.
    deep = found.where("depth > 1").withColumn("up", F.col("depth") - 1)
    parents = found.select(
        F.col("depth").alias("up"), F.col("a").alias("before_a"), F.col("b").alias("before_b"), F.col("conv_id").alias("parent_conv_id")
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_convs") - 1).alias("m"), "n_bytes"]
    below = deep.join(parents, ["up", "before_a", "before_b"]).select(*columns)
    first = found.where("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("long")).select(*columns)
    root = convs.where(F.col("conv_id") == least).select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(count).cast("long").alias("n_convs"),
        F.lit(count - 1).cast("long").alias("m"),
        F.lit(0).cast("long").alias("n_bytes"),
    )
    nodes = stored(below.unionByName(first).unionByName(root).withColumn("own", F.expr("m * n_bytes")).drop("m", "n_bytes"), "trie-named")
    children = nodes.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))

    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("depth", "a", "b"), "depth").alias("at")).select(
        F.col("conv_id").alias("member"), "at.*"
    )
    inner = last.join(found.select("depth", "a", "b", "conv_id"), ["depth", "a", "b"]).select("conv_id", "depth", "member")
    turnless = convs.join(last, F.col("conv_id") == F.col("member"), "left_anti").select(
        F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member")
    )
    return stored(nodes, "trie-nodes"), inner.unionByName(turnless)


def _mark(conv_id: Column, depth: Column, round_number: int) -> Column:
    """Whether a node may leave its chain in a round, from its name alone."""
    if round_number < 24:
        return F.shiftright(depth, round_number).bitwiseAND(1) == 1
    return F.xxhash64(conv_id, depth, F.lit(round_number)).bitwiseAND(1) == 1


def _raked(alive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(what is left once the leaves have gone into their parents, the leaves)."""
    leaf = (F.col("children") == 0) & F.col("up_depth").isNotNull()
    leaves = alive.where(leaf)
    given = leaves.groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth")).agg(
        F.count("*").alias("gone"),
        F.sum(F.expr("leaves + edge_leaves")).alias("more_leaves"),
        F.sum(F.expr("saved + edge_saved")).alias("more_saved"),
    )
    gained = {
        "children": F.col("children") - F.coalesce("gone", F.lit(0)),
        "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
        "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
    }
    left = alive.where(~leaf).join(given, _NODE, "left").withColumns(gained).select(*alive.columns)
    return left, leaves


def _compressed(alive: DataFrame, round_number: int) -> DataFrame:
    """Rows of all nodes, with what a node that leaves its chain hands to its only child.

    Only children are told by counting, before rows move, and meet their parents by
    their own name, so a node with very many children is one row for each task.
    """
    goes = (
        (F.col("children") == 1)
        & F.col("up_depth").isNotNull()
        & _mark(F.col("conv_id"), F.col("depth"), round_number)
        & ~_mark(F.col("up_conv"), F.col("up_depth"), round_number)
    )
    marked = alive.withColumn("goes", F.coalesce(goes, F.lit(False)))
    only = (
        alive.where("up_depth IS NOT NULL")
        .groupBy("up_conv", "up_depth")
        .agg(F.count("*").alias("n"), F.min("conv_id").alias("child_conv"), F.min("depth").alias("child_depth"))
        .where("n = 1")
        .select(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth"), "child_conv", "child_depth")
    )
    gone = marked.where("goes").join(only, _NODE).select(
        F.col("child_conv").alias("conv_id"),
        F.col("child_depth").alias("depth"),
        F.col("up_conv").alias("new_conv"),
        F.col("up_depth").alias("new_depth"),
        F.expr("leaves + edge_leaves").alias("more_leaves"),
        F.expr("saved + edge_saved").alias("more_saved"),
        F.col("leaves").alias("of_leaves"),
        F.col("saved").alias("of_saved"),
    )
    return marked.join(gone, _NODE, "left")


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens): sums over the subtree of each node of ``trie``."""
    names = [*_NODE, "up_conv", "up_depth", "children", "leaves", "saved", "edge_leaves", "edge_saved"]
    zero = F.lit(0).cast("long")
    alive = nodes.select(
        *_NODE,
        F.col("parent_conv_id").alias("up_conv"),
        F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_depth"),
        F.col("n_children").alias("children"),
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        F.col("own").alias("saved"),
        zero.alias("edge_leaves"),
        zero.alias("edge_saved"),
    )
    removed: list[tuple[DataFrame, DataFrame]] = []
    while True:
        left, leaves = _raked(alive)
        rows = stored(_compressed(left, len(removed)), "trie-round")
        # Taken out by the child's row: what its total lacks to be that of the node that goes.
        spliced = rows.where("new_conv IS NOT NULL").select(
            F.col("up_conv").alias("conv_id"),
            F.col("up_depth").alias("depth"),
            F.col("conv_id").alias("child_conv"),
            F.col("depth").alias("child_depth"),
            F.expr("edge_leaves + of_leaves").alias("more_leaves"),
            F.expr("edge_saved + of_saved").alias("more_saved"),
        )
        totals = leaves.select(*_NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
        removed.append((totals, spliced))
        moved = {
            "up_conv": F.coalesce("new_conv", "up_conv"),
            "up_depth": F.coalesce("new_depth", "up_depth"),
            "edge_leaves": F.col("edge_leaves") + F.coalesce("more_leaves", zero),
            "edge_saved": F.col("edge_saved") + F.coalesce("more_saved", zero),
        }
        alive = rows.where("NOT goes").select(*(moved.get(c, F.col(c)).alias(c) for c in names))
        if not alive.where("up_depth IS NOT NULL").head(1):
            break
    known = alive.select(*_NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    for totals, spliced in reversed(removed):
        children = known.select(
            F.col("conv_id").alias("child_conv"), F.col("depth").alias("child_depth"), "n_leaves", "saved_tokens"
        )
        again = spliced.join(children, ["child_conv", "child_depth"]).select(
            *_NODE,
            (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
            (F.col("saved_tokens") + F.col("more_saved")).alias("saved_tokens"),
        )
        known = stored(known.unionByName(again).unionByName(totals), "trie-totals")
    return known


def ends_digest(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): digest of the members that end at a node, ascending, comma-joined.

    Members are spelled in runs of ids side by side; a task then reads a node's
    runs in order and keeps nothing but the state of its digest.
    """
    runs = ends.groupBy(*_NODE, F.floor(F.col("member") / _SPELLED).alias("run")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for conv, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if node != (conv, depth):
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            columns = zip(*done, strict=True) if done else ([], [], [])
            types = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*_NODE, "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_pydict({"conv_id": [node[0]], "depth": [node[1]], "ends_sha256": [state.hexdigest()]})

    dealt = runs.repartition(*_NODE).sortWithinPartitions(*_NODE, "run")
    return dealt.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def describe(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of ordered turns, with its subtree's totals and its ends' digest."""
    nodes, ends = trie(turns, conversations)
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.drop("own")
        .join(subtree_totals(nodes), _NODE)
        .join(ends_digest(ends), _NODE, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
    )


def branched(turns: DataFrame, group: int = 5, spread: int = 9) -> DataFrame:
    """Ordered turns rebuilt: the first h of conversation c - c % group, then c's own after its first h.

    h is the CRC-32 of c in decimal, modulo ``spread``. Conversations that end up
    without turns have no rows.
    """
    turns = stored(turns, "trie-ordered")
    base = F.col("conv_id") - F.col("conv_id") % group
    convs = turns.select("conv_id").distinct().select(
        "conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string")) % spread).alias("h")
    )
    heads = turns.where(F.col("pos") < spread - 1).withColumnRenamed("conv_id", "base")
    taken = heads.join(convs, "base").where("pos < h").select(*turns.columns)
    lengths = heads.groupBy("base").agg(F.count("*").alias("n"))
    # Own turns move up by what the other conversation lacks.
    shifts = convs.join(lengths, "base", "left").select(
        "conv_id", "h", (F.least("h", F.coalesce("n", F.lit(0))) - F.col("h")).alias("shift")
    )
    kept = turns.join(shifts, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") + F.col("shift"))
    return taken.unionByName(kept.select(*turns.columns))
