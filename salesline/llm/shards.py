"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups.

Documents of equal text make a group, which is never split. Groups sorted by size enter the bin with the tightest
remaining capacity that still holds them, found in a balanced tree of remaining capacities; a new bin opens only if none
does. With a fixed capacity this keeps the number of shards small. With a fixed number of shards, the smallest capacity at
which the packing needs no more bins is searched, so that sizes come out near equal. Groups as large as an even share of
what remains have a shard of their own, so that one huge group doesn't set the capacity of all others.

The driver packs a bounded number of items: a group of at least one ``ITEMS``-th of all bytes is an item by itself (there
are at most ``ITEMS``); smaller groups are dealt by hash into at most ``ITEMS`` parcels, each an item of its groups' total.
Which item a document belongs to follows from its text, so that documents are placed where they are read; only the
totals of groups are shuffled, added up before.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesline.llm.common import without
from salesline.operators.ordering import BLOCK, POS, range_blocks
from salesline.session import cut_lineage

ITEMS = 8192
EXTRA = 8
LEAF = 128
FINE = 4096  # steps of the search between the least and the first possible capacity


class CapacityTree:
    """A two-level B-tree of (remaining capacity, bin): full leaves are split, empty ones leave the directory."""

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = []
        self.tops: list[tuple[int, int]] = []  # the largest entry of each leaf

    def add(self, remaining: int, number: int) -> None:
        entry = (remaining, number)
        if not self.leaves:
            self.leaves, self.tops = [[entry]], [entry]
            return
        at = min(bisect_left(self.tops, entry), len(self.leaves) - 1)
        leaf = self.leaves[at]
        insort(leaf, entry)
        if len(leaf) > LEAF:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]
            self.tops[at : at + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self.tops[at] = leaf[-1]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the entry of least remaining capacity that holds ``size``, of equal ones the first bin."""
        at = bisect_left(self.tops, (size, -1))
        if at == len(self.leaves):
            return None
        leaf = self.leaves[at]
        entry = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.tops[at] = leaf[-1]
        else:
            del self.leaves[at], self.tops[at]
        return entry


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each size, given in descending order; None if more than ``most`` bins would be needed.

    A size above the capacity has a bin of its own.
    """
    tree, bins, count = CapacityTree(), [], 0
    for size in sizes:
        entry = tree.take_tightest(size)
        if entry is None:
            if count == most:
                return None
            entry, count = (max(capacity, size), count), count + 1
        bins.append(entry[1])
        tree.add(entry[0] - size, entry[1])
    return bins


def balanced(sizes: list[int], shards: int) -> list[int]:
    """The bin of each size, given in descending order, in ``shards`` bins whose totals are near equal."""
    rest, alone = sum(sizes), 0
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) >= rest:
        rest, alone = rest - sizes[alone], alone + 1
    left, bins = sizes[alone:], shards - alone
    if not left:
        return list(range(alone))
    low = max(left[0], -(-rest // bins))
    high, best = low, best_fit(left, low, bins)
    while best is None:
        high += max(1, rest // bins // 16)
        best = best_fit(left, high, bins)
    step = max(1, low // FINE)
    while high - low > step:
        middle = (low + high) // 2
        found = best_fit(left, middle, bins)
        low, high, best = (middle, high, best) if found is None else (low, middle, found)
    return [*range(alone), *(b + alone for b in best)]


def sized(documents: DataFrame, text: str) -> DataFrame:
    """The documents with their size and the key of their group; a null text counts as an empty one."""
    raw = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    documents = without(documents, ["size", "text_crc32", "shard", "slot", "_group"])
    return documents.select(
        "*",
        (F.octet_length(raw) + EXTRA).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("_group"),
    )


def place(documents: DataFrame, shards: int | None = 24, capacity: int | None = None, text: str = "text") -> DataFrame:
    """The documents with ``size`` (UTF-8 bytes and ``EXTRA``), ``text_crc32`` and the ``shard`` they are put into.

    Give a number of shards, which are made near equal, or (``shards=None``) a capacity, of which few shards are filled; a
    group above it has one of its own. Equal texts share a shard, so that a group larger than an even share makes a shard
    larger than the others; null and empty texts are one group. With fewer groups than shards, some stay empty. Rows are
    kept one by one, also repeated ones and those without an id; an empty table gives none. Columns of the added names
    are replaced.
    """
    rows = sized(documents, text)
    groups = cut_lineage(rows.groupBy("_group").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    items = ITEMS if shards else max(ITEMS, 64 * total // max(1, capacity))
    least = max(1, total // items)
    parcel = F.pmod(F.xxhash64("_group"), F.lit(items))
    own = groups.where(F.col("bytes") >= least).select("bytes", F.col("_group").alias("key"), F.lit(-1).cast("long").alias("parcel"))
    dealt = groups.where(F.col("bytes") < least).groupBy(parcel.alias("parcel")).agg(F.sum("bytes").alias("bytes"))
    packed = own.unionByName(dealt.select("bytes", F.lit(None).cast("binary").alias("key"), "parcel")).toArrow()
    order = packed.sort_by([("bytes", "descending"), ("parcel", "ascending"), ("key", "ascending")])
    sizes = order.column("bytes").to_pylist()
    bins = balanced(sizes, shards) if shards else best_fit(sizes, capacity)
    spark = documents.sparkSession
    found = list(zip(order.column("key").to_pylist(), order.column("parcel").to_pylist(), bins, strict=True))
    by_group = spark.createDataFrame([(k, b) for k, _, b in found if k is not None], "_group binary, _own int")
    by_parcel = spark.createDataFrame([(p, b) for k, p, b in found if k is None], "_parcel long, _dealt int")
    placed = rows.withColumn("_parcel", parcel).join(F.broadcast(by_group), "_group", "left")  # at most ``items`` rows each
    placed = placed.join(F.broadcast(by_parcel), "_parcel", "left")
    return placed.withColumn("shard", F.coalesce("_own", "_dealt")).drop("_parcel", "_own", "_dealt", "_group")


def with_slots(placed: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The placed documents with their ``slot``, counted from 0 within the shard, by id.

    The rows are sorted in ranges of (shard, id); a range holds few shards, whose first slots follow from the counts of
    the ranges before. Repeated ids and missing ones (first) are told apart by text and place, so that no range grows.
    """
    tie = F.monotonically_increasing_id()
    order = ["shard", doc, "text_crc32", "_tie"]
    rows = range_blocks(placed.withColumn("_tie", tie), order).drop("_tie")
    counts = rows.groupBy("shard", BLOCK).agg(F.min(POS).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = rows.join(F.broadcast(offsets), ["shard", BLOCK])  # a row for each range, and one more for each shard
    return joined.withColumn("slot", F.col(POS) - F.col("_first") + F.col("_before")).drop(BLOCK, POS, "_first", "_before")


def write_shards(placed: DataFrame, path: str, doc: str = "doc_id") -> None:
    """Write one folder for each shard; its files hold consecutive slots, in order, under names that sort alike."""
    slotted = with_slots(placed, doc)
    slotted.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_summary(placed: DataFrame) -> DataFrame:
    """Documents and bytes of each shard that has any."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("bytes"))

