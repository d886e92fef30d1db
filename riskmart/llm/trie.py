"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns, named by its smallest conversation and its depth. Nodes are sorted externally
in reverse level order; each takes the totals its children have sent through a spilling priority queue and sends its own
to its parent. A subtree below one first turn is a shard. Very large ones are cut into paths of nodes with one smallest
conversation, whose totals are passed from path to path first.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .hotjoin import BROADCAST, join_unique

BAND = 65_536  # turns of one conversation that are handled in one task
SHARD_NODES = 16_384  # larger subtrees below one first turn are cut into paths
FINISH = 4096  # paths that are left for the last round, in one task
QUEUE = 100_000  # totals a task keeps in memory; more are spilled
GROUP, SHARED = 20, 4  # conversations of a group share up to SHARED - 1 first turns of their group's first one
PIECE = 65_536  # characters of ids that are hashed as one row
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "k1", "k2"]


def _ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with ``pos`` from 1 in the order of turn, role and text (null turns first)."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    counts = materialise(turns.groupBy("conv_id").count(), "trie-counts")
    long = materialise(counts.filter(F.col("count") > BAND).select("conv_id"), "trie-long")
    if long.isEmpty():
        return turns.withColumn("pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    short = turns.join(long, "conv_id", "left_anti")
    short = short.withColumn("pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    # A conversation too long for one task: equal turns become one row, ranges of the order are ranked apart.
    rows = turns.join(long, "conv_id", "left_semi").groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    keys = ["conv_id", F.col("turn").asc_nulls_first(), F.substring("role", 1, 16), F.substring("text", 1, 64)]
    parts = 1 + counts.filter(F.col("count") > BAND).agg(F.sum("count")).first()[0] // BAND
    pieces = materialise(rows.repartitionByRange(parts, *keys).withColumn("piece", F.spark_partition_id()), "trie-pieces")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.groupBy("conv_id", "piece").agg(F.sum("n").alias("own")).withColumn("before", F.coalesce(F.sum("own").over(before), F.lit(0)))
    inside = Window.partitionBy("conv_id", "piece").orderBy(*order)
    ranked = pieces.withColumn("last", F.sum("n").over(inside)).join(offsets.drop("own"), ["conv_id", "piece"])
    blocks = ranked.withColumn("first", F.col("before") + F.col("last") - F.col("n") + 1).withColumn("last", F.col("before") + F.col("last"))
    blocks = blocks.withColumn("block", F.explode(F.sequence("first", "last", F.lit(4096).cast("long"))))
    copies = F.explode(F.sequence("block", F.least(F.col("block") + 4095, "last"))).alias("pos")
    return short.unionByName(blocks.select("conv_id", "turn", "role", "text", copies))


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, depth, words, own and parent key, first-turn key, last) and conversations (conv_id, length).

    Keys are sums of 128-bit hashes of the turns and their depths, so they can be added up band by band.
    """
    picked = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    given = materialise(
        _ordered(picked).select(
            "conv_id", "pos", F.xxhash64("role", "text").alias("c1"), F.xxhash64(F.lit(1), "text", "role").alias("c2"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        ),
        "trie-turns",
    )
    sizes = given.groupBy("conv_id").agg(F.max("pos").alias("n"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    convs = sizes.select("conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("group"))
    firsts = sizes.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("group"), F.col("n").alias("found"))
    convs = convs.join(firsts, "group", "left").withColumn("taken", F.least("h", F.coalesce("found", F.lit(0).cast("long"))))
    convs = materialise(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))), "trie-conversations")

    heads = given.filter((F.col("conv_id") % GROUP == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv_id", "group")
    zero = F.lit(0).cast("long")
    taken = convs.filter("taken > 0").join(heads, "group").filter("pos <= taken").select(
        "conv_id", zero.alias("band"), F.col("pos").alias("depth"), "c1", "c2", "words", "n", "length"
    )
    bands = convs.withColumn("band", F.explode(F.sequence(zero, F.floor((F.col("n") - 1) / BAND))))
    own = given.withColumn("band", F.floor((F.col("pos") - 1) / BAND)).join(bands, ["conv_id", "band"]).filter("pos > h")
    own = own.select("conv_id", "band", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "c1", "c2", "words", "n", "length")

    lanes = ["a", "b", "c", "d"]
    rows = taken.unionByName(own)
    rows = rows.withColumn("t1", F.xxhash64("depth", "c1", "c2")).withColumn("t2", F.xxhash64("c2", "depth", "c1")).drop("c1", "c2")
    low = F.lit(0xFFFFFFFF).cast("long")
    halves = [F.shiftrightunsigned("t1", 32), F.col("t1").bitwiseAND(low), F.shiftrightunsigned("t2", 32), F.col("t2").bitwiseAND(low)]
    rows = rows.select("*", *(half.alias(f"own_{lane}") for lane, half in zip(lanes, halves)))
    running = Window.partitionBy("conv_id", "band").orderBy("depth")
    rows = rows.select("*", *(F.sum(f"own_{lane}").over(running).alias(lane) for lane in lanes))

    def key(one: Column, two: Column) -> Column:
        return F.shiftleft(one, 32).bitwiseOR(two.bitwiseAND(low))

    first = F.when(F.col("depth") == 1, F.struct("t1", "t2"))
    rows = rows.withColumn("first", F.first(first, ignorenulls=True).over(running))
    if not convs.filter(F.col("n") > BAND).isEmpty():  # add what the bands before hold
        rows = materialise(rows, "trie-bands")
        totals = rows.filter(F.col("n") > BAND).groupBy("conv_id", "band").agg(
            *(F.max(lane).alias(lane) for lane in lanes), F.max("first").alias("first")
        )
        before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            "conv_id", "band", *(F.coalesce(F.sum(lane).over(before), zero).alias(f"more_{lane}") for lane in lanes),
            F.first("first", ignorenulls=True).over(before).alias("earlier"),
        )
        rows = rows.join(offsets, ["conv_id", "band"], "left")
        rows = rows.withColumns({lane: F.col(lane) + F.coalesce(f"more_{lane}", zero) for lane in lanes})
        rows = rows.withColumn("first", F.coalesce("earlier", "first"))
    previous = [F.col(lane) - F.col(f"own_{lane}") for lane in lanes]
    rebuilt = rows.select(
        "conv_id", "depth", "words", key(F.col("a"), F.col("b")).alias("k1"), key(F.col("c"), F.col("d")).alias("k2"),
        key(*previous[:2]).alias("p1"), key(*previous[2:]).alias("p2"), F.col("first.t1").alias("f1"), F.col("first.t2").alias("f2"),
        (F.col("depth") == F.col("length")).alias("last"),
    )
    return materialise(rebuilt, "trie-rebuilt"), convs.select("conv_id", "length")


class SpillingQueue:
    """Totals by target in the order (-depth, conv_id); beyond a number in memory they go to sorted runs in unnamed files.

    The files lie in the scratch folder Spark gives the worker, belong to this task alone and vanish with it.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap = limit, []
        self.runs: list[Iterator[tuple]] = []
        self.heads: list[tuple] = []

    def push(self, *entry: int) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self.heap.sort()
            run = self._written(np.array(self.heap, np.int64))
            self.heap = []
            self.runs.append(run)
            self._advance(len(self.runs) - 1)

    def _written(self, rows: np.ndarray) -> Iterator[tuple]:
        file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        file.write(rows.tobytes())
        file.seek(0)

        def read():
            with file:
                while data := file.read(4096 * rows.itemsize * rows.shape[1]):
                    yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, rows.shape[1]).tolist())

        return read()

    def _advance(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heads, (entry, run))

    def take(self, *target: int) -> tuple[int, int]:
        """Sum of the totals sent to a target; targets are asked in order."""
        one = two = 0
        while True:
            if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
                entry, run = self.heads[0]
                if entry[: len(target)] != target:
                    return one, two
                heapq.heappop(self.heads)
                self._advance(run)
            elif self.heap and self.heap[0][: len(target)] == target:
                entry = heapq.heappop(self.heap)
            else:
                return one, two
            one, two = one + entry[-2], two + entry[-1]


def _forward(limit: int):
    """Subtree totals of nodes sorted by shard, falling depth and conversation; ``send`` marks nodes whose parent is in the shard."""
    kept = [*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue = None, SpillingQueue(limit)
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            rows = zip(*(columns[n].to_pylist() for n in ("f1", "f2", "part", "depth", "conv_id", "parent_conv_id", "leaves", "saved", "send")))
            leaves, saved = [], []
            for f1, f2, part, depth, conv, parent, own_leaves, own_saved, send in rows:
                if (f1, f2, part) != shard:
                    shard, queue = (f1, f2, part), SpillingQueue(limit)
                more = queue.take(-depth, conv)
                leaves.append(own_leaves + more[0])
                saved.append(own_saved + more[1])
                if send:
                    queue.push(1 - depth, parent, leaves[-1], saved[-1])
            yield pa.RecordBatch.from_arrays(
                [*(columns[n] for n in kept), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], [*kept, "n_leaves", "saved_tokens"]
            )

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of the last few paths, deepest tops first."""
    waiting: dict[tuple, list[int]] = {}
    for batch in batches:
        columns = dict(zip(batch.schema.names, (c.to_pylist() for c in batch.columns)))
        for row, own in enumerate(zip(columns["conv_id"], columns["segment"])):
            more = waiting.pop(own, (0, 0))
            for name, value in zip(("leaves", "saved"), more):
                columns[name][row] += value
            target = waiting.setdefault((columns["to_conv"][row], columns["to_segment"][row]), [0, 0])
            target[0] += columns["leaves"][row]
            target[1] += columns["saved"][row]
        yield pa.RecordBatch.from_arrays([pa.array(columns[n], batch.schema.field(n).type) for n in batch.schema.names], batch.schema.names)


def _path_totals(nodes: DataFrame) -> DataFrame:
    """Totals that paths of cut subtrees send to the nodes they hang on: (conv_id, depth, more_leaves, more_saved).

    A path's own sums are added up at once. Then, round by round, all paths on which no other one hangs any more send
    their totals on; the last few are settled in one task.
    """
    segment = F.floor(F.col("depth") / BAND)
    paths = nodes.withColumn("segment", segment).groupBy("conv_id", "segment").agg(
        F.min("depth").alias("top"), F.min_by(F.when(F.col("depth") > 1, F.col("parent_conv_id")), "depth").alias("to_conv"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    paths = materialise(paths.withColumn("to_segment", F.floor((F.col("top") - 1) / BAND)), "trie-paths")
    names, done = paths.columns, []
    while paths.count() > FINISH:
        asked = paths.select(F.col("to_conv").alias("conv_id"), F.col("to_segment").alias("segment")).distinct().withColumn("asked", F.lit(True))
        marked = materialise(paths.join(asked, ["conv_id", "segment"], "left"), "trie-marked")
        ready = marked.filter("asked IS NULL").select(*names)
        sent = ready.groupBy(F.col("to_conv").alias("conv_id"), F.col("to_segment").alias("segment")).agg(
            F.sum("leaves").alias("l"), F.sum("saved").alias("s")
        )
        rest = marked.filter("asked").join(sent, ["conv_id", "segment"], "left")
        zero = F.lit(0).cast("long")
        rest = rest.withColumns({"leaves": F.col("leaves") + F.coalesce("l", zero), "saved": F.col("saved") + F.coalesce("s", zero)})
        done.append(ready)
        paths = materialise(rest.select(*names), "trie-paths")
    done.append(paths.coalesce(1).sortWithinPartitions(F.col("top").desc()).mapInArrow(_finish, paths.schema))
    together = done[0]
    for more in done[1:]:
        together = together.unionByName(more)
    return together.filter("top > 1").groupBy(F.col("to_conv").alias("conv_id"), (F.col("top") - 1).alias("depth")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted rows (node, conv_id) joined by commas, a row for a node's ids up to a length."""
    node, first, ids, size = None, None, [], 0

    def done():
        data = [*([x] for x in node), [first], [",".join(ids)]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in data], [*NODE, "first", "ids"])

    for batch in batches:
        for *own, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (own != node or size > PIECE):
                yield done()
                ids, size = [], 0
            if not ids:
                node, first = own, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield done()


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, in their order, joined by commas."""
    node, digest = None, None
    for batch in batches:
        out = []
        for *own, ids in zip(*(batch.column(n).to_pylist() for n in (0, 1, 2, 4))):
            if own != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], [*NODE, "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], [*NODE, "ends_sha256"])


def _ends(ends: DataFrame) -> DataFrame:
    """Digest of the conversations that end in each node; a node's ids may spread over many tasks until they are hashed."""
    keys = [*NODE, "conv_id"]
    kind = "depth bigint, k1 bigint, k2 bigint"
    pieces = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_join_ids, f"{kind}, first bigint, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_hash_ids, f"{kind}, ends_sha256 string")


def prefix_trie(turns: DataFrame, shard_nodes: int = SHARD_NODES, queue: int = QUEUE) -> DataFrame:
    """One row per trie node of the rebuilt conversations of ``turns`` (conv_id, turn, role, text; other columns are not read).

    Returns conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. A conversation c is rebuilt from the first h turns of conversation c - c % 20, where h is
    the CRC-32 of its decimal id modulo 4, and its own turns after its first h. Turns are ordered by turn (null first),
    then role, then text, so repeated turns and ties have one order; null role and text are empty; rows without a conv_id
    belong to no conversation. No row gives no node, not even a root.
    """
    rebuilt, convs = rebuild(turns)
    rows = rebuilt.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.min(x).alias(x) for x in ("p1", "p2", "f1", "f2", "words"))
    )
    nodes = materialise(rows, "trie-nodes")
    zero = F.lit(0).cast("long")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    named = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).first()
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    below = named.filter("depth > 1")
    named = join_unique(below, parents, ["depth", "p1", "p2"]).unionByName(
        named.filter("depth = 1").withColumn("parent_conv_id", F.lit(root.conv_id).cast("long"))
    )
    named = named.withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
    named = materialise(named.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-named")

    large = named.groupBy("f1", "f2").count().filter(F.col("count") > shard_nodes)
    large = materialise(large.select("f1", "f2", F.ceil(F.col("count") / shard_nodes).alias("parts")), "trie-large")
    n_large = large.count()
    if n_large:
        marked = named.join(F.broadcast(large) if n_large <= BROADCAST else large, ["f1", "f2"], "left")
        marked = materialise(marked, "trie-large-nodes")
        whole = marked.filter("parts IS NULL").withColumn("part", F.lit(-1).cast("long")).withColumn("send", F.col("depth") > 1)
        cut = marked.filter("parts IS NOT NULL")
        segment = F.floor(F.col("depth") / BAND)
        cut = cut.join(_path_totals(cut), ["conv_id", "depth"], "left").withColumns({
            "leaves": F.col("leaves") + F.coalesce("more_leaves", zero), "saved": F.col("saved") + F.coalesce("more_saved", zero),
            "part": F.pmod(F.xxhash64("conv_id", segment), F.col("parts")),
            "send": (F.col("parent_conv_id") == F.col("conv_id")) & (F.col("depth") > 1) & (F.col("depth") % BAND > 0),
        })
        shards = whole.drop("parts").unionByName(cut.drop("parts", "more_leaves", "more_saved"))
    else:
        shards = named.withColumn("part", F.lit(-1).cast("long")).withColumn("send", F.col("depth") > 1)
    shards = shards.select("f1", "f2", "part", *NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "leaves", "saved", "send")
    order = ["f1", "f2", "part", F.col("depth").desc(), "conv_id"]
    totals = shards.repartition("f1", "f2", "part").sortWithinPartitions(*order).mapInArrow(
        _forward(queue),
        "depth bigint, k1 bigint, k2 bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint",
    )
    totals = materialise(totals, "trie-totals")
    top = totals.filter("depth = 1").agg(
        F.count("*").alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1).cast("long")).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens")
    )
    root_row = top.select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(root.conv_id).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(root.n_convs).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
    ).filter("n_convs > 0")
    ends = rebuilt.filter("last").select(*NODE, "conv_id").unionByName(
        convs.filter("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    )
    found = totals.unionByName(root_row).join(_ends(ends), NODE, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
