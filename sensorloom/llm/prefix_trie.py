"""Prefix trie of conversations; subtree totals by time-forward processing in reverse level order."""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import staged
from sensorloom.operators.ordering import row_number

FAMILY = 100  # conversations c - c % FAMILY and on share their first turns
HEADS = 6  # at most HEADS - 1 turns are shared
BLOCK_BITS = 10  # turns of a conversation whose prefixes one window computes, as a power of two
LIGHT = 16384  # turns at or below a node, up to which its whole subtree is one shard
BAND = 1024  # levels of the nodes above that are one shard
QUEUE_MESSAGES = 200_000  # in memory; more are spilled in sorted runs
ID_BITS = 12  # ids of a piece of an end list, as a power of two

KEY = ["k1", "k2"]
PARENT = ["p1", "p2"]


class SpillingQueue:
    """A priority queue of tuples of five 64-bit integers that keeps a bounded number of them in memory.

    A full heap becomes a sorted run in an unnamed file, scratch of the task like Spark's own sort spills: it
    goes with the task, and no other task reads it. The least of the heap and of the runs' heads comes first.
    """

    _item = struct.Struct("<5q")
    _read = 4096  # messages of a run that are read at a time

    def __init__(self, limit: int = QUEUE_MESSAGES) -> None:
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, item)

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for item in sorted(self.heap):
            file.write(self._item.pack(*item))
        file.seek(0)
        self.heap = []
        self.runs.append(self._items(file))
        self._next(len(self.runs) - 1)

    def _items(self, file) -> Iterator[tuple]:
        with file:
            while data := file.read(self._item.size * self._read):
                yield from self._item.iter_unpack(data)

    def _next(self, run: int) -> None:
        if (item := next(self.runs[run], None)) is not None:
            heapq.heappush(self.heads, (item, run))

    def pop_for(self, address: tuple) -> Iterator[tuple]:
        """All messages whose first three fields are ``address``, which must be the least ones of the queue."""
        while self.heap and self.heap[0][:3] == address:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][:3] == address:
            item, run = heapq.heappop(self.heads)
            self._next(run)
            yield item


TOTALS = "k1 bigint, k2 bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of all nodes of the partition's shards, which come by falling depth and rising key.

    A node takes the messages that its children have sent ahead, adds them to its own values, and sends the
    sum to its parent, unless it is the top of its shard.
    """
    queue = SpillingQueue()
    names = ["depth", *KEY, *PARENT, "top", "n_children", "n_leaves", "saved_tokens"]
    for batch in batches:
        found = []
        for depth, k1, k2, p1, p2, top, children, leaves, tokens in zip(
                *(batch.column(name).to_pylist() for name in names), strict=True):
            for *_, more_leaves, more_tokens in queue.pop_for((-depth, k1, k2)):
                children += 1
                leaves += more_leaves
                tokens += more_tokens
            if not children:
                leaves = 1
            if not top:
                queue.push((1 - depth, p1, p2, leaves, tokens))
            found.append((children, leaves, tokens))
        totals = [pa.array(column, pa.int64()) for column in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), *totals],
                                         names=[*KEY, "n_children", "n_leaves", "saved_tokens"])


def _pass(nodes: DataFrame, shard: list[str]) -> DataFrame:
    """One pass in each shard of ``nodes``: Spark sorts them, outside memory if need be."""
    dealt = nodes.repartition(*shard) if shard else nodes.repartition(1)
    ordered = dealt.sortWithinPartitions(F.desc("depth"), *KEY)
    return ordered.select("depth", *KEY, *PARENT, "top", "n_children", "n_leaves", "saved_tokens").mapInArrow(_forward, TOTALS)


def _received(sent: DataFrame) -> DataFrame:
    """What each parent outside the shard gets in sum."""
    return sent.groupBy(*PARENT).agg(
        F.count("*").alias("_children"), F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_tokens")
    ).select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "_children", "_leaves", "_tokens")


def _add(nodes: DataFrame, received: DataFrame, children: bool = True) -> DataFrame:
    zero = F.lit(0)
    return nodes.join(received, KEY, "left").withColumns({
        "n_children": F.col("n_children") + (F.coalesce("_children", zero) if children else zero),
        "n_leaves": F.col("n_leaves") + F.coalesce("_leaves", zero),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("_tokens", zero),
    }).drop("_children", "_leaves", "_tokens")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, turns, c1, c2, n_chars): the turns of every rebuilt conversation, contents as 128-bit hashes.

    Turns are ordered by number, null first, ties by a hash of role and text; null role or text is empty. Rows
    without conv_id take no part. Conversation c has the first h turns of c - c % 100, h = crc32(c) % 6, and its
    own after its first h. Row 0 stands for the textless start, so that conversations without turns are there.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.xxhash64(role, text).alias("c1"),
        F.xxhash64(F.lit(1), role, text).alias("c2"), F.char_length(text).cast("bigint").alias("n_chars"),
        F.monotonically_increasing_id().alias("tie"))
    turns = staged(row_number(rows, ["conv_id"], ["turn", "c1", "c2", "tie"], "pos").drop("turn", "tie"), "turns")
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    base = F.col("conv_id") % FAMILY == 0
    first = sizes.where(base).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    convs = (
        sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", h).join(first, "base", "left")
        .withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
        .select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns"))
    )
    convs = staged(convs, "conversations")
    columns = ["conv_id", "depth", "turns", "c1", "c2", "n_chars"]
    own = turns.where(F.col("pos") > h).join(convs, "conv_id").withColumn("depth", F.col("m") + F.col("pos") - F.col("h"))
    heads = turns.where(base & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    shared = heads.join(convs, "base").where("pos <= h").withColumn("depth", F.col("pos"))
    zero = F.lit(0).cast("bigint")
    starts = convs.select("conv_id", zero.alias("depth"), "turns", zero.alias("c1"), zero.alias("c2"), zero.alias("n_chars"))
    return own.select(columns).union(shared.select(columns)).union(starts)


def paths(turns: DataFrame) -> DataFrame:
    """Each turn with the key of the prefix that it ends and of the one before it.

    A key is the exclusive or of 128-bit hashes of the turns with their places, so that blocks of a conversation
    are computed apart and then joined with what precedes them; the one of the empty prefix is 0.
    """
    hashed = turns.withColumns({
        "t1": F.when(F.col("depth") > 0, F.xxhash64("depth", "c1", "c2")).otherwise(F.lit(0)),
        "t2": F.when(F.col("depth") > 0, F.xxhash64("c2", "depth", "c1")).otherwise(F.lit(0)),
        "block": F.shiftright("depth", BLOCK_BITS),
    }).drop("c1", "c2")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.where(F.col("turns") >= 1 << BLOCK_BITS).groupBy("conv_id", "block")
        .agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"))
        .select("conv_id", "block", F.bit_xor("t1").over(before).alias("b1"), F.bit_xor("t2").over(before).alias("b2"))
        .where("block > 0")
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def key(i: int) -> Column:
        return F.col(f"i{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0)))

    return (
        hashed.withColumns({"i1": F.bit_xor("t1").over(inside), "i2": F.bit_xor("t2").over(inside)})
        .join(starts, ["conv_id", "block"], "left")
        .select("conv_id", "depth", "turns", "n_chars", key(1).alias("k1"), key(2).alias("k2"),
                key(1).bitwiseXOR(F.col("t1")).alias("p1"), key(2).bitwiseXOR(F.col("t2")).alias("p2"))
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each key, which come in order; no list is held as a whole."""
    current, state = None, None
    out: list[tuple] = []
    for batch in batches:
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
            if (k1, k2) == current:
                state.update(b"," + ids.encode())
                continue
            if current is not None:
                out.append((*current, state.hexdigest()))
            current, state = (k1, k2), hashlib.sha256(ids.encode())
        if out:
            yield _digest_batch(out)
            out = []
    if current is not None:
        yield _digest_batch([(*current, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    k1, k2, digest = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(digest, pa.string())],
                                      names=[*KEY, "ends_sha256"])


def end_digests(path: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of every node where conversations end: their ids, ascending, joined by commas.

    Pieces of up to 4,096 ids are sorted and joined in parallel; then one pass hashes the pieces of a node in
    order, which SHA-256 leaves no other way to do, and holds one piece at a time.
    """
    pieces = (
        path.where("depth = turns").groupBy(*KEY, F.shiftright("conv_id", ID_BITS).alias("piece"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    )
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
    return ordered.mapInArrow(_digests, "k1 bigint, k2 bigint, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations (see ``rebuilt``), the textless root included.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256,
    and last_chars, the code points of the node's last text. An empty table has no node.

    Nodes are dealt to shards: a subtree with up to LIGHT turns at or below its top is one shard, and its totals
    are final after one pass. The few nodes above get the shards' totals, summed up by parent, and are shards by
    band of levels; where there is more than one band, the bands' tops are passed in turn and their totals enter
    a second pass. A shard sorts its nodes by falling depth and hands totals to parents through a SpillingQueue.
    """
    path = staged(paths(rebuilt(conversations)), "paths")
    nodes = path.groupBy(*KEY).agg(
        F.max("depth").alias("depth"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("n_chars").alias("last_chars"),
        F.sum(F.col("turns") - F.col("depth") + 1).alias("weight"))
    nodes = staged(nodes, "nodes")
    zero = F.lit(0).cast("bigint")
    valued = nodes.select("conv_id", "depth", *KEY, *PARENT, "weight", zero.alias("n_children"), zero.alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("last_chars")).alias("saved_tokens"))
    heavy = staged(valued.where(F.col("weight") > LIGHT).drop("weight"), "upper-nodes")

    cut = path.join(heavy.select(*KEY), KEY).groupBy("conv_id").agg((F.max("depth") + 1).alias("cut"))
    tops = (
        path.join(cut, "conv_id", "left").where(F.col("depth") == F.coalesce("cut", F.lit(0)))
        .select("conv_id", F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    )
    light = staged(valued.where(F.col("weight") <= LIGHT).drop("weight").join(tops, "conv_id")
                   .withColumn("top", (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2"))), "shards")
    light_totals = staged(_pass(light, ["s1", "s2"]), "shard-totals")
    sent = light.where("top").select(*KEY, *PARENT).join(light_totals, KEY)
    upper_totals = _upper(path, _add(heavy, _received(sent)))

    totals = light_totals.unionByName(upper_totals)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256().hexdigest()
    return (
        nodes.join(totals, KEY).join(end_digests(path), KEY, "left").join(parents, PARENT)  # the root's key is its own parent's
        .select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
                "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
                "last_chars")
    )


def _upper(path: DataFrame, heavy: DataFrame) -> DataFrame:
    """The totals of the nodes above the light shards."""
    band = F.floor(F.col("depth") / BAND)
    marks = path.where(F.col("depth") % BAND == 0).select("conv_id", band.alias("band"), F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    banded = heavy.withColumn("band", band).join(marks, ["conv_id", "band"]).withColumn("top", F.col("depth") % BAND == 0)
    banded = staged(banded, "bands")
    tops = banded.where("top and depth > 0")
    banded = _add(banded, _received(tops.select(*PARENT, F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"))))
    totals = staged(_pass(banded, ["s1", "s2"]), "band-totals")
    if tops.isEmpty():
        return totals
    above = marks.withColumn("band", F.col("band") + 1).select("conv_id", "band", F.col("s1").alias("a1"), F.col("s2").alias("a2"))
    own = totals.select(*KEY, "n_leaves", "saved_tokens")
    # The tops of the bands are a tree of their own, as deep as there are bands; 1 child keeps them from being leaves.
    contracted = (
        banded.where("top").select("conv_id", "band", *KEY).join(own, KEY).join(above, ["conv_id", "band"], "left")
        .select(F.col("band").alias("depth"), *KEY, F.coalesce("a1", F.lit(0)).alias("p1"), F.coalesce("a2", F.lit(0)).alias("p2"),
                (F.col("band") == 0).alias("top"), F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens")
    )
    across = staged(_pass(contracted, []), "top-totals")
    sent = tops.select(*KEY, *PARENT).join(across.select(*KEY, "n_leaves", "saved_tokens"), KEY)
    return _pass(_add(banded, _received(sent), children=False), ["s1", "s2"])
