"""Best-fit packing by hierarchical residual packing.

Every task packs the pieces of its own rows by best fit, longest first, and gives out the bins that are nearly full.
Underfull bins go up a tree as items: each round merges ``FAN_IN`` neighbours and packs the bins that reach it by best
fit again; the demanded fill falls from level to level. After any best-fit round at most one bin of a node is half full
or less, and two bins over half can never join. So what can still be merged is one small bin of each node, and it needs
one host at most: a node hands up its small bins and at most ``HOSTS`` of the bins over half, spread over their free
space, and gives out the others as they are. A node so receives ``FAN_IN * (HOSTS + 1)`` bins at most, whatever the
corpus holds.

No step gathers rows by a key of the data: a round is keyed by the number of the task the bins come from. A bin carries
its pieces (at most ``capacity`` of them), so offsets need no join afterwards.

Defined results: null text counts as empty; every document gets the closing id, so an empty one is a piece of one
token; pieces of exactly ``capacity`` are sequences of their own; repeated rows are packed once each; a null id stays
null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, small_batches, texts_of, written
from trailforge.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1
#: Children of a node of the tree.
FAN_IN = 8
#: Free tokens with which a bin counts as nearly full, by level; the last holds for all further levels.
SLACK = (8, 64, 512)
#: Bins over half full that a node hands up at most, as hosts of the small bins of other nodes.
HOSTS = 256
#: Sequences of the whole corpus' best fit are numbered from here, above those of all nodes.
SETTLED = 31 << 58
#: Pieces packed together inside a task at once: bounds its memory, and is far more than good fits need. What a block
#: would hand up is packed with the next block.
BLOCK = 200_000


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of the items of each bin: longest first, each to the fullest bin that takes it; ties to the older bin."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a bin with r free tokens exists
    for i in order:
        n = sizes[i]
        if fits := some >> n:
            room = n + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                some &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if room - n:
            free[room - n].append(b)
            some |= 1 << (room - n)
    return bins


@dataclass
class Plan:
    """Best fit of counted items. Runs of equal items by size and rank: items of a bin, first bin, offset in it; and runs of bins of one fill."""

    keys: np.ndarray  # (size << 48) + first rank, ascending
    per: np.ndarray
    first: np.ndarray
    base: np.ndarray
    starts: np.ndarray  # first bin of each run of bins, ascending
    fills: np.ndarray
    bins: int

    def places(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bin, offset, and fill of that bin, of each item."""
        key = (size << 48) + rank
        i = np.searchsorted(self.keys, key, "right") - 1
        nth = key - self.keys[i]
        bin_ = self.first[i] + nth // self.per[i]
        return bin_, self.base[i] + nth % self.per[i] * size, self.fills[np.searchsorted(self.starts, bin_, "right") - 1]


def planned(counts: dict[int, int], capacity: int) -> Plan:
    """``best_fit`` of counts[n] items of each size n; takes time by the number of sizes, not of items.

    Of equal items, the next one fits the bin that took the last one best, as long as it has room; so bins of one room
    take as many as they hold, one after the other, and stay a run of equal bins.
    """
    runs: list[tuple[int, int, int, int]] = []
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    some = made = 0
    for size in sorted(counts, reverse=True):
        at, total = 0, counts[size]
        while at < total:
            if fits := some >> size:
                room = size + (fits & -fits).bit_length() - 1
                first, n = free[room].pop()
                if not free[room]:
                    some &= ~(1 << room)
            else:
                room, first, n = capacity, made, -(-(total - at) // (capacity // size))
                made += n
            per = room // size
            full, extra = divmod(min(total - at, n * per), per)
            runs.append(((size << 48) + at, per, first, capacity - room))
            at += full * per + extra
            for start, m, left in ((first, full, room - per * size), (first + full, int(extra > 0), room - extra * size), (first + full + (extra > 0), n - full - (extra > 0), room)):
                if m:
                    free[left].append((start, m))
                    some |= 1 << left if left else 0
    ends = sorted((first, capacity - room) for room, found in enumerate(free) for first, _ in found)
    columns = np.array(sorted(runs), np.int64).reshape(-1, 4).T
    return Plan(*columns, *np.array(ends, np.int64).reshape(-1, 2).T, made)


def residue(fills: list[int], slack: int, capacity: int, hosts: int = HOSTS) -> set[int]:
    """Places of the bins that a node hands up: those half full or less, and some of those that could take one of them."""
    open_ = [i for i, n in enumerate(fills) if capacity - n > slack]
    small = [i for i in open_ if 2 * fills[i] <= capacity]
    over = sorted((i for i in open_ if 2 * fills[i] > capacity), key=lambda i: fills[i])
    if len(over) > hosts:
        over = [over[i * (len(over) - 1) // (hosts - 1)] for i in range(hosts)]
    return {*small, *over}


def _rows(bins: list[tuple[list[dict], int]], node: int, level: int, first: int, done: bool, id_type: pa.DataType) -> pa.RecordBatch:
    """bins: pieces and fill. seq numbers the bins of a node; done: the bins are given out at this level."""
    n = len(bins)
    piece = pa.struct([("id", id_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("offset", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([node] * n, pa.int64()),
            pa.array([(level << 58) + (node << 32) + first + i for i in range(n)], pa.int64()),
            pa.array([fill for _, fill in bins], pa.int64()),
            pa.array([done] * n, pa.bool_()),
            pa.array([p for p, _ in bins], pa.list_(piece)),
        ],
        names=["node", "seq", "fill", "done", "pieces"],
    )


_SCHEMA = "node long, seq long, fill long, done boolean, pieces array<struct<id:{kind},piece:int,start:long,length:long,crc:long,offset:long>>"


def _merged(items: list[tuple[list[dict], int]], capacity: int) -> list[tuple[list[dict], int]]:
    """Best fit of bins taken as items; their pieces follow one another."""
    out = []
    for members in best_fit([n for _, n in items], capacity):
        pieces, at = [], 0
        for i in members:
            pieces += [p | {"offset": p["offset"] + at} for p in items[i][0]]
            at += items[i][1]
        out.append((pieces, at))
    return out


class Node:
    """Best fit of the items that reach a node; what goes up stays until the end and is packed with later items."""

    def __init__(self, number: int, level: int, slack: int, capacity: int):
        self.number, self.level, self.slack, self.capacity = number, level, slack, capacity
        self.items: list[tuple[list[dict], int]] = []
        self.given = 0

    def _batches(self, bins: list, done: bool, id_type: pa.DataType) -> Batches:
        for i in range(0, len(bins), 2000):
            yield _rows(bins[i : i + 2000], self.number, self.level, self.given, done, id_type)
            self.given += len(bins[i : i + 2000])

    def flush(self, id_type: pa.DataType, last: bool = False) -> Batches:
        """Gives out the bins that no later item should join; at the last, also those that go up."""
        bins = _merged(self.items, self.capacity)
        up = residue([fill for _, fill in bins], self.slack, self.capacity) if self.slack < self.capacity else set()
        self.items = [bins[i] for i in sorted(up)]
        yield from self._batches([b for i, b in enumerate(bins) if i not in up], True, id_type)
        if last:
            yield from self._batches(self.items, False, id_type)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, fan_in: int = FAN_IN, slack: tuple[int, ...] = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset of every piece, and fill (tokens of its sequence)."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    tail = np.array([end_id], "<u4").tobytes()

    def local(batches: Batches) -> Batches:
        from pyspark import TaskContext

        node = Node(TaskContext.get().partitionId(), 0, slack[0], capacity)
        id_type = None
        for b in batches:
            id_type = b.schema.field(0).type
            for key, text in zip(b.column(0).to_pylist(), texts_of(b), strict=True):
                ids = encoder(tokenizer).ids(text) + tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    node.items.append(([{"id": key, "piece": piece, "start": at // 4, "length": len(part) // 4, "crc": zlib.crc32(part), "offset": 0}], len(part) // 4))
            if len(node.items) >= BLOCK:
                yield from node.flush(id_type)
        yield from node.flush(id_type, last=True)

    schema = _SCHEMA.format(kind=kind)
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    at = written(source.mapInArrow(local, schema), "packed-0")
    levels = [at.where("done")]
    rest = at.where("not done")
    nodes = (at.agg(F.max("node")).first()[0] or 0) + 1
    level = 0
    while True:
        level += 1
        nodes = -(-nodes // fan_in)
        final = nodes == 1
        allow = capacity if final else slack[min(level, len(slack) - 1)]
        merged = _round(rest.withColumn("node", F.floor(F.col("node") / fan_in)), nodes, level, allow, capacity, schema)
        if final:
            levels.append(written(merged, f"packed-{level}"))
            break
        at = written(merged, f"packed-{level}")
        levels.append(at.where("done"))
        rest = at.where("not done")
    bins = levels[0]
    for x in levels[1:]:
        bins = bins.unionByName(x)
    bins = settled(bins.select("seq", "fill", "pieces"), capacity)
    return bins.select(F.col("seq").alias("sequence_id"), "fill", F.explode("pieces").alias("p")).select(
        F.col("p.id").alias(id_col), "p.piece", "p.start", "p.length", F.col("p.crc").alias("ids_crc32"), "sequence_id", "p.offset", "fill"
    )


def _round(rest: DataFrame, nodes: int, level: int, slack: int, capacity: int, schema: str) -> DataFrame:
    """One level of the tree: each node packs the underfull bins below it as items."""

    def merge(batches: Batches) -> Batches:
        found: dict[int, Node] = {}
        id_type = None
        for b in batches:
            id_type = b.schema.field("pieces").type.value_type.field("id").type
            for number, fill, pieces in zip(*(b.column(b.schema.get_field_index(k)).to_pylist() for k in ("node", "fill", "pieces")), strict=True):
                if number not in found:
                    found[number] = Node(number, level, slack, capacity)
                found[number].items.append((pieces, fill))
        for node in found.values():
            yield from node.flush(id_type, last=True)

    return rest.repartition(nodes, "node").mapInArrow(merge, schema)


def settled(bins: DataFrame, capacity: int) -> DataFrame:
    """seq, fill, pieces of all bins, those with room packed once more over the whole corpus where that makes them fewer."""
    spark = bins.sparkSession
    open_ = bins.where(F.col("fill") < capacity)
    alone = F.transform("pieces", lambda p: p.withField("offset", F.lit(0).cast("long")))
    items = {
        "bins": open_.select(F.col("fill").alias("size"), "pieces"),
        "pieces": open_.select(F.explode(alone).alias("p")).select(F.col("p.length").alias("size"), F.array("p").alias("pieces")),
    }
    # Sizes are at most capacity many.
    count = {k: dict(x.groupBy("size").count().toLocalIterator()) for k, x in items.items()}
    plans = {k: planned(c, capacity) for k, c in count.items()}
    best = min(plans, key=lambda k: plans[k].bins)
    if plans[best].bins >= sum(count["bins"].values()):
        return bins
    plan = spark.sparkContext.broadcast(plans[best])

    def number(batches: Batches) -> Batches:
        """Each item's rank among those of its size in the task."""
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            size = b.column(0).to_numpy()
            order = np.argsort(size, kind="stable")
            _, start, n = np.unique(size[order], return_index=True, return_counts=True)
            nth = np.empty(len(size), np.int64)
            nth[order] = np.arange(len(size)) - np.repeat(start, n) + seen[size[order]]
            np.add.at(seen, size, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([task] * len(size), pa.int32()), pa.array(nth)], names=["size", "pieces", "task", "nth"])

    def place(batches: Batches) -> Batches:
        for b in batches:
            size, rank = (b.column(i).to_numpy() for i in (0, 2))
            seq, at, fill = plan.value.places(size, rank)
            yield pa.RecordBatch.from_arrays([pa.array(seq + SETTLED), pa.array(fill), pa.array(at), b.column(1)], names=["seq", "fill", "at", "pieces"])

    kind = bins.schema["pieces"].dataType.simpleString()
    ranked = written(items[best].mapInArrow(number, f"size long, pieces {kind}, task int, nth long"), "open")
    tasks = ranked.groupBy("size", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = tasks.select("size", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = ranked.join(first, ["size", "task"]).select("size", "pieces", (F.col("first") + F.col("nth")).alias("rank")).mapInArrow(place, f"seq long, fill long, at long, pieces {kind}")
    moved = F.transform("pieces", lambda p: p.withField("offset", p["offset"] + F.col("at")))
    return bins.where(F.col("fill") == capacity).unionByName(placed.select("seq", "fill", moved.alias("pieces")))
