"""Ordered work on tables of any length.

A window without a partition key, or over one very long series, would pull all its rows into a
single task. The functions here cut the ordered table into range blocks instead, reduce each block
to a summary row, carry values over the summary (at most one row per key and block), and finish
inside the blocks. The order given must be total, that is, it must end with a unique column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from salesline.session import cut_into_buckets, cut_lineage

BLOCK, POS = "_blk", "_pos"
ROWS_PER_BLOCK = 100_000


@dataclass(frozen=True)
class Series:
    """How rows form series.

    ``daily`` states that a series has one row per day, so its length is bounded by the calendar and
    one window task may hold it. Leave it off for tables with many rows per day.
    """

    keys: Sequence[str] = ("store_id", "product_id")
    order: Sequence[str] = ("date",)
    daily: bool = True
    blocks: int | None = field(default=None, compare=False)

    def parts(self) -> list[Column]:
        """What windows are partitioned by. Rows that lack a key belong to no series, however many they are: they
        are spread by their place in the order instead of meeting in one task."""
        keys = [F.col(k) for k in self.keys]
        if not keys:
            return [F.lit(0)]
        apart = F.concat(F.lit("\x00"), F.xxhash64(*self.order).cast("string"))
        return [F.when(self.key_present(), keys[0].cast("string")).otherwise(apart), *keys[1:]]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts()).orderBy(*self.order)

    def key_present(self) -> Column:
        """True where every key is known; rows without a key belong to no series."""
        cond = F.lit(True)
        for k in self.keys:
            cond = cond & F.col(k).isNotNull()
        return cond


def blocks_for(stored: DataFrame, rows: int) -> int:
    """How many blocks of so many rows a stored table fills; counting reads none of its columns."""
    return max(1, -(-stored.count() // rows))


def range_blocks(df: DataFrame, order: Sequence[str | Column], blocks: int | None = None) -> DataFrame:
    """Sort the table into consecutive blocks; adds the block number and the position in it.

    Unless their number is given, there is a block for about ``ROWS_PER_BLOCK`` rows, so that a task needs no more memory
    for a longer table. Rows are stored to be counted, and once more by block, as block bounds come from a sample and work
    inside the blocks is to shuffle no rows again.
    """
    if not blocks:
        df = cut_lineage(df)
        blocks = blocks_for(df, ROWS_PER_BLOCK)
    ordered = df.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return cut_into_buckets(ordered.withColumns({BLOCK: F.spark_partition_id(), POS: place}), BLOCK, blocks)


def _parts(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys] or [F.lit(0)]


def _spanning(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summary rows of keys found in several blocks. The blocks are ordered by key, so a block holds
    at most two such keys: its first and its last."""
    found = F.count(F.lit(1)).over(Window.partitionBy(*_parts(keys)))
    return summary.withColumn("_nb", found).where("_nb > 1").drop("_nb")


def _join_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach summary rows, at most two per block and so small; null keys meet null keys."""
    renamed = summary.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(BLOCK).alias("_kb"),
        *[c for c in summary.columns if c not in (*keys, BLOCK)],
    )
    cond = rows[BLOCK] == renamed["_kb"]
    for i, k in enumerate(keys):
        cond = cond & rows[k].eqNullSafe(renamed[f"_k{i}"])
    joined = rows.join(F.broadcast(renamed), cond, "left")
    return joined.drop("_kb", *[f"_k{i}" for i in range(len(keys))])


def carry(
    rows: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), forward: bool = True, prefix: str = "_c_"
) -> DataFrame:
    """Nearest known value at or before (``forward``) or at or after each row, per key.

    ``rows`` are range blocks whose order starts with the keys.
    """
    pick = F.max_by if forward else F.min_by
    summary = rows.groupBy(*keys, BLOCK).agg(
        *[pick(c, F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_s_{c}") for c in cols]
    )
    order = F.col(BLOCK).asc() if forward else F.col(BLOCK).desc()
    before = Window.partitionBy(*_parts(keys)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = _spanning(summary, keys).select(
        *keys, BLOCK, *[F.last(f"_s_{c}", ignorenulls=True).over(before).alias(f"_b_{c}") for c in cols]
    )
    joined = _join_summary(rows, carried, keys)
    pos = F.col(POS).asc() if forward else F.col(POS).desc()
    inside = Window.partitionBy(*keys, BLOCK).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    filled = {
        f"{prefix}{c}": F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_b_{c}")) for c in cols
    }
    return joined.withColumns(filled).drop(*[f"_b_{c}" for c in cols])


def running_sum(
    rows: DataFrame, sums: dict[str, str | Column], keys: Sequence[str] = (), totals: bool = False
) -> DataFrame:
    """Inclusive running sums in row order, per key; ``totals`` adds ``<name>_total`` of the key.

    ``rows`` are range blocks whose order starts with the keys.
    """
    held = rows.withColumns({f"_v_{n}": F.col(e) if isinstance(e, str) else e for n, e in sums.items()})
    summary = held.groupBy(*keys, BLOCK).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums])
    of_key = Window.partitionBy(*_parts(keys))
    before = of_key.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    outs = [F.sum(f"_s_{n}").over(before).alias(f"_b_{n}") for n in sums]
    if totals:
        outs += [F.sum(f"_s_{n}").over(of_key).alias(f"_w_{n}") for n in sums]
    joined = _join_summary(held, _spanning(summary, keys).select(*keys, BLOCK, *outs), keys)
    here = Window.partitionBy(*keys, BLOCK)
    inside = here.orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)
    new = {
        n: F.coalesce(F.sum(f"_v_{n}").over(inside), zero) + F.coalesce(F.col(f"_b_{n}"), zero) for n in sums
    }
    if totals:
        whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        new |= {f"{n}_total": F.coalesce(F.col(f"_w_{n}"), F.sum(f"_v_{n}").over(whole)) for n in sums}
    helpers = [f"_{p}_{n}" for n in sums for p in ("v", "b", "w")]
    return joined.withColumns(new).drop(*helpers)


def row_index(
    df: DataFrame,
    order: Sequence[str | Column],
    keys: Sequence[str] = (),
    name: str = "row_index",
    blocks: int | None = None,
) -> DataFrame:
    """Zero-based position of each row in the order, counted within the key."""
    rows = range_blocks(df, [*keys, *order], blocks)
    counted = running_sum(rows, {name: F.lit(1).cast("long")}, keys)
    return counted.withColumn(name, F.col(name) - 1).drop(BLOCK, POS)


def over_series(
    df: DataFrame,
    series: Series,
    reach: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Apply ``add(df, window)``, whose frames look back at most ``reach`` rows, to every series.

    Daily series use one window per series. Longer ones are cut into blocks of consecutive rows,
    and each block also gets the last ``reach`` rows before it.
    """
    if series.daily:
        return add(df, series.window())
    size = max(rows_per_block, reach)
    indexed = row_index(df, series.order, series.keys, "_t", series.blocks)
    home = F.floor(F.col("_t") / size).cast("long")
    copies = F.when(
        F.col("_t") % size >= size - reach,
        F.array(
            F.struct(home.alias("b"), F.lit(False).alias("copy")),
            F.struct((home + 1).alias("b"), F.lit(True).alias("copy")),
        ),
    ).otherwise(F.array(F.struct(home.alias("b"), F.lit(False).alias("copy"))))
    spread = indexed.withColumn("_home", F.explode(copies)).select("*", "_home.b", "_home.copy").drop("_home")
    window = Window.partitionBy(*series.keys, "b").orderBy("_t")
    return add(spread, window).where(~F.col("copy")).drop("b", "copy", "_t")
