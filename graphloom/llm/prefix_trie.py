"""Conversation prefix trie by SQL ROLLUP over positional turn-id columns.

A conversation is cut into blocks of ``BLOCK`` turns, one row each, whose turns stand in positional columns
t0, t1, ...  ``GROUP BY block, prior node, ROLLUP (t0, t1, ...)`` then aggregates every prefix of every conversation at
once, and ``grouping_id()`` tells the length of each.  A block's prior node is named by the exclusive-or of 128-bit
hashes of (position, turn) before it: that is associative, so all blocks of a long conversation are keyed in one pass
and no job waits for the block before.

Sums over subtrees need no walk of the trie either.  The members of a node shrink with depth, so once a conversation is
the smallest member of a node it stays so to its own end: the trie falls into one path for each conversation, the
nodes it owns.  A node's subtree is what its members own, but for what its own smallest member owns above it.  So each
conversation's total goes into a second ROLLUP, and one running sum along the owned paths is taken off.
Only nodes with two members or more need this.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import in_small_batches
from graphloom.session import cut, discard

#: turns in a row of positional columns
BLOCK = 8
#: rows of one key that a window takes together; longer runs are added up from the totals of such pieces
PIECE = 4096
#: bits of a conversation's number that one list of ids spans
LIST_BITS = 12


def _exclusive(rows: DataFrame, key: str, order: str, values: dict[str, str], total: str) -> DataFrame:
    """Running ``total`` (sum or bit_xor) of each of ``values`` (source -> result) over earlier rows of the same key.

    ``order`` counts up from 0.  A key's rows are taken ``PIECE`` at a time; totals of the pieces run on their own.
    """
    add = getattr(F, total)

    def plus(a: Column, b: Column) -> Column:
        return a + b if total == "sum" else a.bitwiseXOR(b)

    nothing = F.lit(0).cast("bigint")
    rows = rows.withColumn("_piece", F.floor(F.col(order) / PIECE))
    pieces = rows.groupBy(key, "_piece").agg(*[add(s).alias(f"_t_{s}") for s in values])
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select(key, "_piece", *[add(f"_t_{s}").over(earlier).alias(f"_b_{s}") for s in values]).filter("_piece > 0")
    inside = Window.partitionBy(key, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    for source in values:
        rows = rows.withColumn(f"_i_{source}", F.coalesce(add(source).over(inside), nothing))
    rows = rows.join(before, [key, "_piece"], "left")
    for source, result in values.items():
        rows = rows.withColumn(result, plus(F.col(f"_i_{source}"), F.coalesce(f"_b_{source}", nothing)))
    return rows.drop("_piece", *[f"_{x}_{s}" for s in values for x in "ib"])


def ordered_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, a, b, size): every turn at its position from 0, its role and text as a 128-bit hash, its code points.

    Turns are ordered by number, null first; equal numbers by role, length and hash of the text.  A null role or text is an
    empty one.  Rows without a conversation belong to none and go.  Turns are sorted over all tasks, so a
    conversation may hold any share of the rows.
    """
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256)
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "size", "a", "b", "row"]
    narrow = turns.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), who.alias("role"),
        F.length(what).cast("bigint").alias("size"), digest.alias("digest"), F.monotonically_increasing_id().alias("row"),
    ).select("conv_id", "turn", "role", "size", F.xxhash64("digest").alias("a"), F.xxhash64(F.lit(1), "digest").alias("b"), "row")
    placed = cut(narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv_id", "a", "b", "size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    parts = placed.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # conversations that go on from one sorted part to the next: at most one for each part
    going_on = parts.withColumn("before", F.sum("n").over(earlier)).filter(F.col("before").isNotNull()).drop("n")
    rank = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("place"))
    return placed.withColumn("rank", rank).join(F.broadcast(going_on), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("rank") - 1 + F.coalesce("before", F.lit(0))).cast("bigint").alias("pos"), "a", "b", "size")


def share_heads(turns: DataFrame, group: int = 100, longest: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that start like the first one of their group: (conv_id, pos, a, b, size) and (conv_id, length).

    Conversation c takes the first h turns of conversation c - c % group, h = crc32(c) % longest (all if it has fewer, none
    if it is not there), and goes on with its own turns after its first h.  ``turns`` is what ``ordered_turns`` gives.
    """
    turns = cut(turns)
    h = (F.crc32(F.col("conv_id").cast("string")) % longest).alias("h")
    whole = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    heads = (
        turns.filter((F.col("conv_id") % group == 0) & (F.col("pos") < longest - 1))
        .groupBy(F.col("conv_id").alias("first"))  # fewer than ``longest`` rows each
        .agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("head"))
    )
    plans = whole.select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % group).alias("first")).join(heads, "first", "left").select(
        "conv_id", "n", "h", F.expr("coalesce(slice(head, 1, cast(h as int)), array())").alias("head"))
    plans = cut(plans.withColumn("length", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    # a conversation's own turns meet its plan a piece at a time, so a long one spreads over the tasks
    pieces = plans.select("conv_id", "h", F.size("head").alias("shift"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / PIECE))).alias("piece"))
    own = turns.withColumn("piece", F.floor(F.col("pos") / PIECE)).join(pieces, ["conv_id", "piece"]).filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("shift")).alias("pos"), "a", "b", "size")
    taken = plans.select("conv_id", F.inline("head")).select("conv_id", "pos", "a", "b", "size")
    return own.unionByName(taken), plans.select("conv_id", "length")


def _lanes(position: Column | str, a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """Two 64-bit hashes of a turn at a position."""
    return F.xxhash64(position, a, b), F.xxhash64(b, F.lit(7), a, position)


def _blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row for every block of a conversation: its turns in columns, the prior node's key, its own part of the key."""
    x, y = _lanes("pos", "a", "b")
    parts = turns.withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumn("x", x).withColumn("y", y).groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("pos") % BLOCK == i, F.struct("a", "b", "size"))).alias(f"t{i}") for i in range(BLOCK)],
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), (F.max("pos") + 1).alias("upto"))
    parts = _exclusive(parts, "conv_id", "block", {"x": "p", "y": "q"}, "bit_xor")
    zero = F.lit(0).cast("bigint")
    bare = lengths.filter("length = 0").select(
        "conv_id", zero.alias("block"), *[F.lit(None).cast("struct<a:bigint,b:bigint,size:bigint>").alias(f"t{i}") for i in range(BLOCK)],
        zero.alias("x"), zero.alias("y"), zero.alias("upto"), zero.alias("p"), zero.alias("q"))
    return parts.unionByName(bare)


def _prefixes(blocks: DataFrame, aggregates: str, least: int = 1) -> DataFrame:
    """All prefixes of all conversations with the given aggregates: depth, key (x, y), parent's key (px, py), size of the last text."""
    names = [f"t{i}" for i in range(BLOCK)]
    rolled = blocks.sparkSession.sql(
        f"SELECT block, p, q, {', '.join(names)}, {BLOCK} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{blocks}} GROUP BY block, p, q, ROLLUP ({', '.join(names)}) HAVING count(*) >= {least}", blocks=blocks)
    level, x, y, px, py = F.col("level"), F.col("p"), F.col("q"), F.col("p"), F.col("q")
    zero, last = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    for i, name in enumerate(names):
        u, v = _lanes(F.col("block") * BLOCK + i, F.col(f"{name}.a"), F.col(f"{name}.b"))
        x, y = x.bitwiseXOR(F.when(level > i, u).otherwise(zero)), y.bitwiseXOR(F.when(level > i, v).otherwise(zero))
        px, py = px.bitwiseXOR(F.when(level > i + 1, u).otherwise(zero)), py.bitwiseXOR(F.when(level > i + 1, v).otherwise(zero))
        last = F.when(level == i + 1, F.col(f"{name}.size")).otherwise(last)
    # level 0 of a later block is the last node of the block before; a level without a turn lies behind the end
    there = last.isNotNull() | ((level == 0) & (F.col("block") == 0))
    return rolled.filter(there).select(
        (F.col("block") * BLOCK + level).alias("depth"), x.alias("x"), y.alias("y"), px.alias("px"), py.alias("py"),
        F.coalesce(last, zero).alias("size"), *[F.col(a.rsplit(" ", 1)[1]) for a in aggregates.split(", ")])


def _list_digests(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256): digest of the ascending conv_ids of every key, in one stream of lists of bounded length each."""
    schema = "x bigint, y bigint, ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for x, y, ids in zip(*[batch.column(c).to_pylist() for c in ("x", "y", "ids")], strict=True):
                if key == (x, y):
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (x, y), hashlib.sha256(ids.encode())
            if done:
                yield pa.record_batch([pa.array(c) for c in zip(*done, strict=True)], names=["x", "y", "ends_sha256"])
        if state is not None:
            yield pa.record_batch([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])], names=["x", "y", "ends_sha256"])

    span = F.shiftright("conv_id", LIST_BITS).alias("span")
    lists = ends.groupBy("x", "y", span).agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids"))
    return in_small_batches(lists).repartition("x", "y").sortWithinPartitions("x", "y", "span").select("x", "y", "ids").mapInArrow(run, schema)


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row for every prefix of a conversation: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has (conv_id, pos, a, b, size), positions from 0 without gaps, ``lengths`` (conv_id, length) for every
    conversation, those without a turn included: these end at the root.  No conversation gives no node.
    """
    blocks = cut(_blocks(turns, lengths))
    found = cut(_prefixes(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id"))
    parents = found.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"))
    children = found.filter("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    # a node may have any number of children: the side of the parents is a written table, so Spark may split the other
    nodes = cut(found.join(parents, ["px", "py", "depth"], "left").join(children, ["x", "y"], "left"))
    discard([found])
    return _with_subtrees(blocks, nodes, lengths)


def _with_subtrees(blocks: DataFrame, nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    weight = (F.col("n_convs") - 1) * F.col("size")
    shared = nodes.filter("n_convs > 1")
    owned = nodes.groupBy("conv_id").agg(F.sum(weight).alias("owned"), F.sum(F.col("n_children").isNull().cast("bigint")).alias("leaves"))
    above = _exclusive(
        shared.select("conv_id", "depth", "x", "y", weight.alias("weight")), "conv_id", "depth", {"weight": "above"}, "sum",
    ).select("x", "y", "above")
    # blocks whose first turn is shared, and the rows that stand for the root
    first = _lanes(F.col("block") * BLOCK, "t0.a", "t0.b")
    keyed = blocks.withColumn("fx", F.col("p").bitwiseXOR(first[0])).withColumn("fy", F.col("q").bitwiseXOR(first[1]))
    open_ = shared.filter(F.col("depth") % BLOCK == 1).select(F.col("x").alias("fx"), F.col("y").alias("fy"))
    inner = keyed.filter("block > 0").join(open_, ["fx", "fy"], "left_semi").unionByName(keyed.filter("block = 0")).drop("fx", "fy")
    totals = _prefixes(inner.join(owned, "conv_id", "left").withColumn("owned", F.coalesce("owned", F.lit(0))).withColumn("leaves", F.coalesce("leaves", F.lit(0))),
                       "sum(owned) AS owned, sum(leaves) AS leaves", least=2).select("x", "y", "owned", "leaves")
    ended = blocks.join(lengths, "conv_id").filter("upto = length").select(
        F.col("p").bitwiseXOR(F.col("x")).alias("x"), F.col("q").bitwiseXOR(F.col("y")).alias("y"), "conv_id")
    facts = totals.join(above, ["x", "y"])
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(facts, ["x", "y"], "left").join(_list_digests(ended), ["x", "y"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
            F.when(F.col("n_convs") > 1, F.col("leaves")).otherwise(1).cast("bigint").alias("n_leaves"),
            F.when(F.col("n_convs") > 1, F.col("owned") - F.col("above")).otherwise(0).cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    )


def conversation_trie(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of conversations as they are: see ``ordered_turns`` for their rows and ``trie`` for the result.

    Repeated rows are repeated turns.  An empty table gives an empty trie.  Only the four named columns are read.
    """
    placed = cut(ordered_turns(turns, conversation, turn, role, text))
    return trie(placed, cut(placed.groupBy("conv_id").agg(F.count("*").alias("length"))))


def shared_head_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations that start like the first of their group (``share_heads``); edge cases as in ``conversation_trie``."""
    return trie(*share_heads(ordered_turns(turns)))
