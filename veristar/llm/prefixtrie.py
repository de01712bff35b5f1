"""Conversation prefix trie by the Euler-tour technique.

Conversations are rebuilt (some open with another conversation's turns), and every distinct sequence of first turns is a
node. A node is named by its smallest member and its depth, so the nodes of one smallest member are a path down the trie.

*Tour.* Every node has an enter arc and an exit arc. Siblings are visited by smallest member, so a node's first child is
the one on its own path and comes right after its enter arc. Hence the enter arcs of a path are one run of the tour, and its
exit arcs are runs between the nodes where other paths branch off. The linked list that is ranked holds one element for each
run (its weight: its arcs), at most three for each path whatever its length, not one for each turn.

*Ranking.* Pointer jumping: in each round every element that has not reached the end of the tour adds what its successor
knows and takes over the successor's pointer. Every element is the successor of one other, so no join key is hot; after log2(elements)
rounds each knows how many arcs follow. Each round is written to the shared folder.

*Sums.* Arcs get their positions from their run's. Prefix sums over the positions, blocks of ``BLOCK`` at a time, of leaves and of
saved tokens (both counted at the enter arc) give a subtree as exit minus enter.

*Nothing grows with a hot key.* Turns are ordered within a conversation, children below a parent, and members that end at a
node by dealing sorted ranges over the tasks; a row that needs its neighbour in the next range takes it from a table of one row
for each range. A conversation of any length is cut into blocks of ``BLOCK`` turns. Prefixes are compared by 128-bit
xor sums of (position, turn) hashes, which blocks add up like prefix sums. Texts are read once, for digest and length, and never
shuffled. The hash of the members that end at a node needs them in one order: blocks of ids are put into strings apart, and one task streams a
node's strings, not its rows.

Defined results: a null role or text is empty; null turns come first; turns that tie go by the digest of (role, text); rows that
repeat are turns of their own; rows without conv_id take no part; an empty table has no conversation and no root; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Turns, arcs or ids that one window or string holds at most.
BLOCK = 4096
#: Conversations open with turns of the first of their group of GROUP ids, fewer than HEADS of them.
GROUP, HEADS = 5, 9

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_ENTER, _EXIT, _BORDER = 0, 1, 2


def block_of(number: str, first: int = 0) -> Column:
    return F.expr(f"({number} - {first}) div {BLOCK}")


def blocks_of(low: Column, high: Column, first: int = 0) -> Column:
    """A row for each block from that of ``low`` to that of ``high``."""
    return F.explode(F.sequence(*[F.floor((x - first) / BLOCK).cast("long") for x in (low, high)]))


def in_ranges(df: DataFrame, order: list[Column], purpose: str) -> DataFrame:
    """``df`` dealt in ranges of ``order`` and written, with the range's number as ``range_id`` (the ranges are in order)."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(partitions, *order).withColumn("range_id", F.spark_partition_id()), purpose)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest, n_bytes of every turn in its conversation's order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("tie"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    dealt = in_ranges(turns, order, "trie-turns")
    here = Window.partitionBy("conv_id", "range_id").orderBy(*order[1:])
    earlier = Window.partitionBy("conv_id").orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    ahead = dealt.groupBy("conv_id", "range_id").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "ahead", F.sum("n").over(earlier)).where("ahead > 0").drop("n")
    return dealt.withColumn("pos", F.row_number().over(here).cast("long")).join(ahead, ["conv_id", "range_id"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("ahead", F.lit(0))).alias("pos"), "digest", "n_bytes")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, depth, digest, n_bytes, ends), and (conv_id, length).

    ``ends``: the turn is the conversation's last.
    """
    turns = written(ordered_turns(conversations), "trie-ordered")
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    lengths = counts.withColumns({"base": base, "h": heads}).join(
        counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left").withColumn(
        "k", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn(
        "length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    lengths = written(lengths.select("conv_id", "base", "h", "k", "n", "length"), "trie-lengths")
    # Own turns meet their conversation's numbers a block at a time.
    blocks = lengths.select("conv_id", "h", "k", "length", blocks_of(F.lit(1), F.col("n"), 1).alias("block"))
    own = turns.withColumn("block", block_of("pos", 1)).join(
        blocks, ["conv_id", "block"]).where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "digest", "n_bytes", "length")
    openings = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "base")
    opened = lengths.where("k > 0").select("conv_id", "base", "k", "length").join(openings, "base").where("pos <= k").select(
        "conv_id", F.col("pos").alias("depth"), "digest", "n_bytes", "length")
    rows = own.unionByName(opened)
    return rows.select("conv_id", "depth", "digest", "n_bytes", (F.col("depth") == F.col("length")).alias("ends")), \
        lengths.select("conv_id", "length")


def prefixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv_id, depth, the prefix's key (k1, k2), its parent's (p1, p2), n_bytes, ends; depth 0 for the root."""
    z = {name: F.xxhash64(F.lit(seed), "depth", "digest") for name, seed in (("z1", 1), ("z2", 2))}
    hashed = rows.withColumns({**z, "block": block_of("depth", 1)}).drop("digest")
    here = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = hashed.groupBy("conv_id", "block").agg(*[F.bit_xor(c).alias(c) for c in z]).select(
        "conv_id", "block", *[F.bit_xor(c).over(earlier).alias(f"b{c[1]}") for c in z]).where("block > 0")
    keyed = hashed.withColumns({f"k{i}": F.bit_xor(f"z{i}").over(here) for i in (1, 2)}).join(
        before, ["conv_id", "block"], "left").withColumns(
        {f"k{i}": F.col(f"k{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)})
    nodes = keyed.select("conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("z1")).alias("p1"),
                         F.col("k2").bitwiseXOR(F.col("z2")).alias("p2"), "n_bytes", "ends")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = lengths.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"),
                          none.alias("p2"), zero.alias("n_bytes"), (F.col("length") == 0).alias("ends"))
    return nodes.unionByName(root)


def ends_hash(ends: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256: the hash of the members that end at each node, ascending."""
    key = ["depth", "k1", "k2"]
    dealt = in_ranges(ends.select(*key, "conv_id"), [F.col(c) for c in [*key, "conv_id"]], "trie-ends")
    here = Window.partitionBy(*key, "range_id").orderBy("conv_id")
    pieces = dealt.withColumn("block", F.floor((F.row_number().over(here) - 1) / BLOCK)).groupBy(*key, "range_id", "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    dealt = pieces.repartition(*key).sortWithinPartitions(*key, "range_id", "block").select(*key, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def close(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64() if i < 3 else pa.string()) for i, c in enumerate(columns)], names=[*key, "ends_sha256"])

        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                here, ids = tuple(batch.column(c)[i].as_py() for c in range(3)), batch.column(3)[i].as_py().encode()
                if here == node:
                    state.update(b"," + ids)
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = here, hashlib.sha256(ids)
            yield close(done)
        yield close([(*node, state.hexdigest())] if node is not None else [])

    return dealt.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def family(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parents and siblings from one sorted pass over nodes and, below each, the tops of the paths that branch off it.

    ``nodes``: conv_id, depth, k1, k2, p1, p2 and ``top`` (the node is its path's first). Returns (conv_id, depth, first_side), the
    first branching child of each node, and (conv_id, parent_conv_id, next_side) of each top.
    """
    parents = nodes.select("depth", "k1", "k2", F.lit(0).alias("kind"), "conv_id")
    tops = nodes.where("top and depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(1).alias("kind"), "conv_id")
    order = ["depth", "k1", "k2", "kind", "conv_id"]
    dealt = in_ranges(parents.unionByName(tops), [F.col(c) for c in order], "trie-family")
    here = Window.partitionBy("range_id").orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    is_node = F.col("kind") == 0
    seen = dealt.withColumns({
        "parent": F.last(F.when(is_node, F.col("conv_id")), True).over(so_far),
        "next_kind": F.lead("kind").over(here), "next_conv": F.lead("conv_id").over(here)})
    # One row for each range: its first row, and the last node up to its end.
    edges = dealt.groupBy("range_id").agg(
        F.min(F.struct(*order)).alias("head"), F.max(F.when(is_node, F.struct(*order))).alias("node"))
    by_range = Window.orderBy("range_id")
    edges = edges.select(
        "range_id", F.lead("head").over(by_range).alias("head"),
        F.last("node", True).over(by_range.rowsBetween(Window.unboundedPreceding, -1)).alias("node")).select(
        "range_id", F.col("head.kind").alias("head_kind"), F.col("head.conv_id").alias("head_conv"),
        F.col("node.conv_id").alias("node_conv"))
    known = seen.join(F.broadcast(edges), "range_id").select(
        "depth", "conv_id", "kind", F.coalesce("parent", "node_conv").alias("parent_conv_id"),
        F.when(F.coalesce("next_kind", "head_kind") == 1, F.coalesce("next_conv", "head_conv")).alias("after"))
    known = written(known, "trie-kin")
    return known.where("kind = 0").select("conv_id", "depth", F.col("after").alias("first_side")), \
        known.where("kind = 1").select("conv_id", "parent_conv_id", F.col("after").alias("next_side"))


def tour_runs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tour's linked list of runs, and for each node where its arcs stand in their runs.

    ``nodes``: conv_id, depth, first_side, and of its path top_depth, bottom_depth, parent_conv_id, next_side. Returns
    (id, next, arcs) with ids (conv_id, depth, kind), and (conv_id, depth, enter_run, enter_at, exit_run, exit_at).
    """
    spans = nodes.withColumn("block", block_of("depth")).withColumns({
        "low": F.greatest("top_depth", F.col("block") * BLOCK),
        "high": F.least("bottom_depth", F.col("block") * BLOCK + BLOCK - 1)})
    branch = F.when(F.col("first_side").isNotNull(), F.col("depth"))
    path = Window.partitionBy("conv_id", "block")
    above = path.orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    below = path.orderBy("depth").rowsBetween(0, Window.unboundedFollowing)
    spans = spans.withColumns({
        "above": F.max(branch).over(above), "above_side": F.last("first_side", True).over(above),
        "exit_high": F.coalesce(F.min(branch).over(below), F.col("high")),
        "end_side": F.max(F.when(F.col("depth") == F.col("high"), F.col("first_side"))).over(path)})

    def key(conv: Column, depth: Column, kind: int) -> Column:
        return F.struct(conv.alias("c"), depth.alias("d"), F.lit(kind).alias("k"))

    conv, depth, low, high = (F.col(c) for c in ("conv_id", "depth", "low", "high"))
    at_bottom = high == F.col("bottom_depth")

    def down(side: Column) -> Column:  # from the last enter arc, or back at a node: the next branch, else out
        return F.when(side.isNotNull(), key(side, high + 1, _ENTER)).otherwise(key(conv, high, _EXIT))

    enter = F.when(depth == low, F.struct(
        key(conv, low, _ENTER).alias("id"),
        F.when(at_bottom, down(F.col("end_side"))).otherwise(key(conv, high + 1, _ENTER)).alias("next"),
        (high - low + 1).alias("arcs")))
    last = F.coalesce(F.col("above") + 1, low)
    out = (
        F.when(F.col("above").isNotNull(), key(F.col("above_side"), last, _ENTER))
        .when(last > F.col("top_depth"), key(conv, last - 1, _BORDER))
        .when(F.col("next_side").isNotNull(), key(F.col("next_side"), last, _ENTER))
        .when(F.col("parent_conv_id").isNotNull(), key(F.col("parent_conv_id"), last - 1, _EXIT)))
    leave = F.when(depth == F.col("exit_high"), F.struct(
        key(conv, depth, _EXIT).alias("id"), out.alias("next"), (depth - last + 1).alias("arcs")))
    border = F.when((depth == high) & ~at_bottom, F.struct(
        key(conv, depth, _BORDER).alias("id"), down(F.col("first_side")).alias("next"), F.lit(0).cast("long").alias("arcs")))
    runs = spans.select(F.explode(F.filter(F.array(enter, leave, border), lambda x: x.isNotNull())).alias("run")).select("run.*")
    places = spans.select("conv_id", "depth", low.alias("enter_run"), (depth - low).alias("enter_at"),
                          F.col("exit_high").alias("exit_run"), (F.col("exit_high") - depth).alias("exit_at"))
    return runs, places


def ranked(runs: DataFrame) -> DataFrame:
    """(id, pos): how many arcs stand before each run, by pointer jumping."""
    state = written(runs.select("id", "next", F.col("arcs").alias("left")), "trie-rank")
    n, arcs = state.agg(F.count(F.lit(1)), F.sum("left")).first()
    for _ in range(max((n or 1) - 1, 0).bit_length()):
        succ = state.select(F.col("id").alias("at"), F.col("next").alias("jump"), F.col("left").alias("more"))
        moved = state.where("next is not null").join(succ, F.col("next") == F.col("at")).select(
            "id", F.col("jump").alias("next"), (F.col("left") + F.col("more")).alias("left"))
        state = written(moved.unionByName(state.where("next is null")), "trie-rank")
    return state.select("id", (F.lit(arcs) - F.col("left")).alias("pos"))


def subtree_sums(nodes: DataFrame, places: DataFrame, positions: DataFrame) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens from prefix sums at the arcs' positions.

    ``nodes``: conv_id, depth, leaf, saved.
    """
    at = positions.select(F.col("id.c").alias("conv_id"), F.col("id.d").alias("run"), F.col("id.k").alias("kind"), "pos")

    def of(kind: int, name: str) -> DataFrame:
        return at.where(F.col("kind") == kind).select("conv_id", F.col("run").alias(f"{name}_run"), F.col("pos").alias(f"{name}_pos"))

    found = nodes.join(places, ["conv_id", "depth"]).join(of(_ENTER, "enter"), ["conv_id", "enter_run"]).join(
        of(_EXIT, "exit"), ["conv_id", "exit_run"])
    zero = F.lit(0).cast("long")
    arcs = found.select("conv_id", "depth", F.explode(F.array(
        F.struct((F.col("enter_pos") + F.col("enter_at")).alias("pos"), F.lit(False).alias("out"), "leaf", "saved"),
        F.struct((F.col("exit_pos") + F.col("exit_at")).alias("pos"), F.lit(True).alias("out"),
                 zero.alias("leaf"), zero.alias("saved")))).alias("arc")).select("conv_id", "depth", "arc.*")
    arcs = arcs.withColumn("block", block_of("pos"))
    here = Window.partitionBy("block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = {c: F.sum(c).over(here) for c in ("leaf", "saved")}
    totals = arcs.groupBy("block").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    summed = arcs.select("conv_id", "depth", "out", "block", F.col("leaf").alias("own_leaf"), F.col("saved").alias("own_saved"),
                         *[s.alias(c) for c, s in sums.items()]).join(running(totals, "block", ["leaf", "saved"]), "block")

    def part(c: str) -> Column:
        upto = F.col(c) + F.col(f"before_{c}")
        return F.sum(F.when(F.col("out"), upto).otherwise(F.col(f"own_{c}") - upto))

    return summed.groupBy("conv_id", "depth").agg(part("leaf").alias("n_leaves"), part("saved").alias("saved_tokens"))


def running(totals: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key`` and the sums of all smaller keys, in two levels: keys within groups of ``BLOCK``, then the groups."""
    totals = totals.withColumn("group", block_of(key))
    within = Window.partitionBy("group").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)  # a row for each BLOCK keys
    groups = totals.groupBy("group").agg(*[F.sum(c).alias(c) for c in columns]).select(
        "group", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"group_{c}") for c in columns])
    near = totals.select(key, "group", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"near_{c}") for c in columns])
    return near.join(groups, "group").select(
        key, *[(F.col(f"near_{c}") + F.col(f"group_{c}")).alias(f"before_{c}") for c in columns])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    rows, lengths = rebuilt_turns(conversations)
    members = written(prefixes(rows, lengths), "trie-members")
    key = ["depth", "k1", "k2"]
    nodes = written(members.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2")), "trie-nodes")
    # The path of each smallest member, met by its nodes a block at a time.
    spans = nodes.groupBy("conv_id").agg(F.min("depth").alias("top_depth"), F.max("depth").alias("bottom_depth"))
    blocks, block = blocks_of(F.col("top_depth"), F.col("bottom_depth")), block_of("depth")
    placed = written(nodes.withColumn("block", block).join(spans.withColumn("block", blocks), ["conv_id", "block"]).withColumn(
        "top", F.col("depth") == F.col("top_depth")), "trie-paths")
    sides, tops = family(placed)
    kin = spans.join(tops, "conv_id", "left").withColumn("block", blocks).drop("top_depth", "bottom_depth")
    full = written(placed.join(kin, ["conv_id", "block"]).drop("block").join(sides, ["conv_id", "depth"]), "trie-kinship")
    runs, places = tour_runs(full)
    children = full.where("top and depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_sides"))
    below = (F.col("depth") < F.col("bottom_depth")).cast("long")
    weights = full.select("conv_id", "depth", ((below == 0) & F.col("first_side").isNull()).cast("long").alias("leaf"),
                          ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    sums = subtree_sums(weights, places, ranked(runs))
    ends = ends_hash(members.where("ends"))
    return full.join(sums, ["conv_id", "depth"]).join(children, ["conv_id", "depth"], "left").join(ends, key, "left").select(
        "conv_id", "depth",
        F.when(F.col("depth") > 0, F.when(F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id"))).alias("parent_conv_id"),
        "n_convs", (below + F.coalesce("n_sides", F.lit(0))).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
