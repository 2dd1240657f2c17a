"""Best-fit packing (operator 6) with several sequence lengths.

Documents are laid into bins (training sequences) whose capacity is one of ``CAPACITIES``.
Each task packs its share of the documents, longest first:

* a piece goes into the open bin that it fills best (least room left, older bin first);
* if none has room, the capacity with the least cost for each token that it can still hope
  to hold is opened: cost(c) / min(c, piece + the volume of later pieces that can go in);
* at the end every bin is downsized to the cheapest capacity that its contents need.

A capacity's cost is its slots and a share that grows with its square (attention), plus a
constant for each sequence. A document longer than the largest capacity is cut into pieces of
that capacity, and only its last piece shares a bin.

Documents are dealt to tasks by a hash of their id and length, so every task holds a bounded
share of narrow rows (an id and a length, ``TASK_ROWS`` on average at most) and never a text;
one source or one length with a third of all rows is spread like any other.

Defined cases: a null or empty text has length 1 (its end mark). Repeated rows are packed
each. A null id is packed like others. Ties go to the smaller id, then the smaller piece.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, shuffle_partitions

CAPACITIES = (256, 512, 1024, 2048, 4096, 8192)
TASK_ROWS = 500_000
PLACED = ("doc_id long, piece int, first long, length long, bin_id long, bin_first long, capacity long, bin_used long")


def cost(capacity: int) -> float:
    """Cost of one sequence: its slots, a tenth more at 8192 slots for attention, and a constant."""
    return capacity * (1 + capacity / 81_920) + 16


def length_in_words(text: Column) -> Column:
    """Number of words of a whole text, and one end mark."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).cast("long") + 1


class Packer:
    """Best fit over pieces in descending order of length."""

    def __init__(self, sizes: np.ndarray, capacities=CAPACITIES, price: Callable[[int], float] = cost):
        self.capacities = sorted(capacities)
        self.price = {c: price(c) for c in self.capacities}
        self.sizes, self.falling = sizes, -sizes  # descending sizes, and their negatives for searches
        self.volume = np.r_[np.cumsum(sizes[::-1])[::-1], 0]  # of this piece and all later ones
        self.room: list[int] = []  # sorted distinct free room of open bins
        self.bins: dict[int, list[int]] = {}  # room -> bins, the oldest last
        self.used: list[int] = []

    def opened(self, at: int) -> int:
        """The capacity to open for piece ``at``: the least cost for each token it may hold."""
        size, best = int(self.sizes[at]), None
        for c in self.capacities:
            if c >= size:
                later = np.searchsorted(self.falling, size - c)  # first piece small enough to join
                filled = min(c, size + int(self.volume[max(at + 1, later)]))
                rate = self.price[c] / filled
                if best is None or rate < best[0]:
                    best = (rate, c)
        return best[1]

    def place(self, at: int) -> int:
        """The bin of piece ``at``."""
        size = int(self.sizes[at])
        k = bisect_left(self.room, size)
        if k < len(self.room):
            room = self.room[k]
            number = self.bins[room].pop()
            if not self.bins[room]:
                del self.bins[room], self.room[k]
        else:
            room, number = self.opened(at), len(self.used)
            self.used.append(0)
        self.used[number] += size
        if room > size:
            left = room - size
            if left in self.bins:
                insort(self.bins[left], number, key=lambda b: -b)
            else:
                insort(self.room, left)
                self.bins[left] = [number]
        return number

    def downsized(self, used: int) -> int:
        """The cheapest capacity for the contents of a bin, of those that are large enough."""
        return min((c for c in self.capacities if c >= used), key=lambda c: (self.price[c], c))


def _pack(capacities: tuple[int, ...]):
    names = [f.split()[0] for f in PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        part = table.column("part")[0].as_py()
        sizes = table.column("length").to_numpy()
        packer = Packer(sizes, capacities)
        number = np.fromiter((packer.place(i) for i in range(len(sizes))), np.int64, len(sizes))
        order = np.argsort(number, kind="stable")  # pieces of a bin follow each other, longest first
        before = np.cumsum(sizes[order]) - sizes[order]
        starts = np.r_[True, number[order][1:] != number[order][:-1]]
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - np.repeat(before[starts], np.diff(np.r_[np.flatnonzero(starts), len(sizes)]))
        used = np.array(packer.used, np.int64)
        capacity = np.array([packer.downsized(u) for u in packer.used], np.int64)
        out = pa.table([table.column("doc_id"), table.column("piece"), table.column("first"), table.column("length"),
                        pa.array((np.int64(part) << np.int64(33)) + number), pa.array(offset), pa.array(capacity[number]),
                        pa.array(used[number])], names=names)
        yield from out.to_batches(max_chunksize=50_000)

    return run


def pack(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """Where every piece of every document lies; ``lengths``: doc_id, length (at least 1).

    ``first`` and ``length`` are the piece's place in its document, ``bin_first`` its place in
    its bin, ``capacity`` the downsized capacity of that bin and ``bin_used`` its contents.
    """
    top = max(capacities)
    pieces = lengths.select("doc_id", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / top))).alias("piece")).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * top).alias("first"),
        F.least(F.lit(top).cast("long"), F.col("length") - F.col("piece") * top).alias("length"))
    parts = max(shuffle_partitions(lengths.sparkSession), -(-lengths.count() // TASK_ROWS))
    dealt = (pieces.repartition(parts, F.xxhash64("doc_id", "length", "piece"))
             .sortWithinPartitions(F.desc("length"), "doc_id", "piece")
             .select(F.spark_partition_id().alias("part"), "doc_id", "piece", "first", "length"))
    return dealt.mapInArrow(_pack(tuple(capacities)), PLACED)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Packing of all ``documents``, whole texts measured in words and an end mark."""
    docs = read(spark, sf_dir, "documents")
    return pack(docs.select(F.col("doc_id").cast("long").alias("doc_id"), length_in_words(F.col("text")).alias("length")))


QUERIES = {"op6_best_fit_packing": op6_best_fit_packing}
