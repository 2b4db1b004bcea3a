"""The trie of conversation prefixes, with sums over subtrees by the Euler-tour technique.

1. Turns are ordered and numbered per conversation: a range partitioning of all turns and the
   sizes of the parts, so that a conversation of any length spreads over tasks.
2. A prefix is told by its depth and two 64-bit names, each the exclusive-or of a hash of every
   (depth, role, text) so far: running values, joined over spans of SPAN depths.
3. Equal prefixes make a node. Nodes are numbered by (depth, parent, smallest member), so that
   siblings are neighbours, and a parent needs to know only its first child and their number.
4. The tour enters and leaves each node: entering leads to the first child, or else to leaving;
   leaving leads to entering the next sibling, or else to leaving the parent. ``list_rank`` finds
   the place of each of these arcs. Sums over subtrees are differences of prefix sums over the
   places of arcs, gathered in spans as well.
5. The digest of the members that end at a node runs over their sorted stream.

Scale: every shuffle is of fixed-width rows, but for the first, which orders the texts. Hot first
turns and hot conversations are combined before they are shuffled, or spread by range. What runs in
one task: sizes of range partitions, sums of spans, and the stream of the digest, whose memory is
bounded and which by nature is sequential for one node.

Defined results: null roles and texts are empty; a null turn comes first; rows of one turn are
ordered by role and text, and repeated rows are turns each; a null conversation is one like any
other that borrows nothing: it counts as a member, but it has no number, so it never is the
smallest unless it is alone, and the digest leaves it out; other columns are not read; an empty
table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.llm.list_rank import places
from tidegrid.llm.shipping import ship
from tidegrid.session import materialize

SPAN = 4096
PLACE_SPAN = 1 << 16
PART_BITS = 33  # documented layout of monotonically_increasing_id: the partition is above
FAMILY = 20
BORROWED = 4

_BEFORE = (Window.unboundedPreceding, -1)


def borrowed_turns(conversation: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.coalesce(F.crc32(conversation.cast("string").cast("binary")) % BORROWED, F.lit(0)).cast("long")


def numbered(df: DataFrame, order: list[str], keys: list[str], keep: list[Column], name: str) -> DataFrame:
    """The rows in the given order, numbered as ``place`` from 0 within equal ``keys`` (a prefix of
    the order); stored."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(ordered.select(*keep, F.monotonically_increasing_id().alias("_id")), name)
    part = F.shiftright("_id", PART_BITS)
    sizes = rows.groupBy(*keys, part.alias("_part")).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(*_BEFORE))
    bounds = materialize(sizes.select(
        *[F.col(k).alias(f"_{k}") for k in keys], "_part",
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift")), f"{name}-bounds")
    same = part == bounds["_part"]
    for k in keys:
        same = same & rows[k].eqNullSafe(bounds[f"_{k}"])
    return rows.join(bounds, same).select(
        *[rows[c] for c in rows.columns if c != "_id"], (F.col("_id") + F.col("_shift")).alias("place"))


def rebuilt(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, h1, h2, words) of every rebuilt turn, and (conv, size) of every conversation."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = df.select(F.col(f"`{conversation}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                     said[0].alias("role"), said[1].alias("text"))
    words = F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).cast("long")
    own = materialize(numbered(rows, ["conv", "turn", "role", "text"], ["conv"], [
        F.col("conv"), F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit(1), "text", "role").alias("h2"), words.alias("words")], "trie-turns"), "trie-placed")
    sizes = own.groupBy("conv").agg(F.count("*").alias("n"))
    first = F.col("conv") % FAMILY
    donors = sizes.where(first == 0).select(F.col("conv").alias("donor"), F.col("n").alias("lent"))
    sizes = sizes.withColumns({"h": borrowed_turns(F.col("conv")), "donor": F.col("conv") - first})
    taken = F.least("h", F.coalesce("lent", F.lit(0)))
    sizes = materialize(sizes.join(donors, "donor", "left").select(
        "conv", "donor", taken.alias("taken"), (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + taken).alias("size")),
        "trie-sizes")
    lent = own.where((first == 0) & (F.col("place") < BORROWED)).select(
        F.col("conv").alias("donor"), "place", "h1", "h2", "words")
    head = sizes.where("taken > 0").join(lent, "donor").where("place < taken").select(
        "conv", (F.col("place") + 1).alias("depth"), "h1", "h2", "words")
    told = sizes.select(F.col("conv").alias("_conv"), "taken")
    tail = own.where(F.col("place") >= borrowed_turns(F.col("conv"))).join(
        told, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        "conv", (F.col("place") - borrowed_turns(F.col("conv")) + F.col("taken") + 1).alias("depth"),
        "h1", "h2", "words")
    return head.unionByName(tail), sizes.select("conv", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, p1, p2, up1, up2, words): the names of each prefix and of the one above it."""
    g = [F.xxhash64("depth", "h1", "h2"), F.xxhash64(F.lit(1), "h2", "depth", "h1")]
    turns = materialize(turns.select("conv", "depth", F.floor(F.col("depth") / SPAN).alias("span"),
                                     g[0].alias("g1"), g[1].alias("g2"), "words"), "trie-rebuilt")
    inside = Window.partitionBy("conv", "span").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    here = turns.withColumns({f"p{i}": F.bit_xor(f"g{i}").over(inside) for i in (1, 2)})
    # Only conversations that reach beyond the first span have anything to carry.
    long = turns.where(F.col("span") > 0).select("conv").distinct().select(F.col("conv").alias("_conv"))
    sums = turns.join(long, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi").groupBy("conv", "span").agg(
        F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"))
    upto = Window.partitionBy("conv").orderBy("span").rowsBetween(*_BEFORE)
    carried = materialize(sums.select(
        F.col("conv").alias("_conv"), F.col("span").alias("_span"),
        *[F.bit_xor(f"s{i}").over(upto).alias(f"c{i}") for i in (1, 2)]), "trie-carried").where("_span > 0")
    far = here.where("span > 0").join(
        carried, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("span") == F.col("_span"))).select(
        "conv", "depth", *[F.col(f"p{i}").bitwiseXOR(F.col(f"c{i}")).alias(f"p{i}") for i in (1, 2)],
        "g1", "g2", "words")
    found = here.where("span = 0").select("conv", "depth", "p1", "p2", "g1", "g2", "words").unionByName(far)
    return found.select("conv", "depth", "p1", "p2", "words",
                        *[F.col(f"p{i}").bitwiseXOR(F.col(f"g{i}")).alias(f"up{i}") for i in (1, 2)])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's comma-joined conversations, from a stream sorted by both."""
    name, state, done = None, None, []

    def out(finished: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([n[0] for n, _ in finished], pa.int64()), pa.array([n[1] for n, _ in finished], pa.int64()),
            pa.array([n[2] for n, _ in finished], pa.int64()), pa.array([d for _, d in finished], pa.string())],
            names=["depth", "p1", "p2", "ends_sha256"])

    for batch in batches:
        for *node, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "conv"))):
            if node != name:
                if state is not None:
                    done.append((name, state.hexdigest()))
                name, state = node, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        if done:
            yield out(done)
            done = []
    if state is not None:
        yield out([(name, state.hexdigest())])


def trie_nodes(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Numbered nodes with their parents' names, and the digest of the members that end at a node."""
    turns, sizes = rebuilt(df, conversation, turn, role, text)
    found = materialize(prefixes(turns), "trie-prefixes")
    zero = F.lit(0).cast("long")
    nodes = found.groupBy("depth", "p1", "p2").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.min("up1").alias("up1"), F.min("up2").alias("up2"))
    root = sizes.groupBy().agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "n_convs > 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs",
                              zero.alias("words"), *[F.lit(None).cast("long").alias(c) for c in ("up1", "up2")])
    nodes = materialize(nodes.unionByName(root), "trie-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"),
                         F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(above, ["depth", "up1", "up2"], "left")
    order = ["depth", "up1", "up2", "conv_id", "p1", "p2"]
    nodes = numbered(nodes, order, [], [F.col(c) for c in (
        *order, "n_convs", "words", "parent_conv_id")], "trie-numbered")
    size = F.col("size")
    ends = found.join(sizes.select(F.col("conv").alias("_conv"), "size"),
                      F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("depth") == size)).select(
        "depth", "p1", "p2", "conv").unionByName(sizes.where(size == 0).select(
            zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv")).where("conv IS NOT NULL")
    sums = ends.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "conv").mapInArrow(
        _digests, "depth long, p1 long, p2 long, ends_sha256 string")
    return materialize(nodes.withColumnRenamed("place", "no"), "trie-nodes"), sums


def tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The Euler tour as a linked list of arcs, entering (2 no) and leaving (2 no + 1) each node;
    and the nodes with their number of children."""
    kids = nodes.where("depth > 0").groupBy("depth", "up1", "up2").agg(
        F.min("no").alias("first"), F.count("*").alias("n")).select(
        (F.col("depth") - 1).alias("depth"), F.col("up1").alias("p1"), F.col("up2").alias("p2"), "first", "n")
    nodes = materialize(nodes.join(kids, ["depth", "p1", "p2"], "left").withColumn(
        "n_children", F.coalesce("n", F.lit(0).cast("long"))), "trie-children")
    place = [F.coalesce("conv_id", F.lit(0)).alias("a"), F.col("depth").alias("b")]
    enters, leaves = (F.col("no") * 2).alias("element"), (F.col("no") * 2 + 1).alias("element")
    down = nodes.select(enters, F.coalesce(F.col("first") * 2, F.col("no") * 2 + 1).alias("next"), *place)
    last = nodes.where("n_children > 0").select(
        (F.col("first") + F.col("n") - 1).alias("no"), (F.col("no") * 2 + 1).alias("up"))
    beyond = F.coalesce("up", F.when(F.col("depth") == 0, F.lit(-1)).otherwise(F.col("no") * 2 + 2))
    up = nodes.join(last, "no", "left").select(leaves, beyond.cast("long").alias("next"), *place)
    return down.unionByName(up), nodes


def subtree_sums(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """(no, n_leaves, saved_tokens) from prefix sums of the arcs' weights at their places."""
    weights = nodes.select(
        (F.col("no") * 2).alias("element"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    arcs = placed.join(weights, "element", "left").select(
        "element", "place", F.floor(F.col("place") / PLACE_SPAN).alias("span"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("leaf", "saved")])
    arcs = materialize(arcs, "trie-arcs")
    before = Window.orderBy("span").rowsBetween(*_BEFORE)
    carried = materialize(arcs.groupBy("span").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s")).select(
        "span", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"c{c}") for c in ("l", "s")]), "trie-spans")
    # Up to an arc, itself left out: leaving a node minus entering it is its subtree, its top included.
    inside = Window.partitionBy("span").orderBy("place").rowsBetween(*_BEFORE)
    sums = arcs.select("element", "span", *[
        F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in ("leaf", "saved")]).join(carried, "span")
    entering = F.col("element") % 2 == 0

    def change(total: Column) -> Column:
        return F.sum(F.when(entering, -total).otherwise(total))

    return sums.groupBy(F.shiftright("element", 1).alias("no")).agg(
        change(F.col("leaf") + F.col("cl")).alias("n_leaves"),
        change(F.col("saved") + F.col("cs")).alias("saved_tokens"))


def prefix_trie(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of
    every node of the trie of rebuilt conversations."""
    ship(df.sparkSession)
    nodes, ends = trie_nodes(df, conversation, turn, role, text)
    arcs, nodes = tour(nodes)
    sums = subtree_sums(nodes, places(arcs))
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.join(sums, "no").join(ends, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
