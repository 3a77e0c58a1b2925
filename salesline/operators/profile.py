"""Profiles of tables and columns."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesline.operators.ordering import BLOCK, blocks_for, range_blocks, running_sum
from salesline.operators.quantiles import exact_quantiles, value_counts
from salesline.session import cut_lineage

# Fixed value: the distinct pairs of values a block of ``kendall`` holds.
PAIRS_PER_BLOCK = 200_000

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t.split("(")[0] in NUMERIC]


def value_hash(value: Column) -> Column:
    """128 bits that tell values apart."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """One row per column: type, known and unknown cells, share unknown, distinct values, an example.

    Distinct values are counted in a second pass, by hashes of 128 bits; ``approximate`` takes a sketch in the first one
    instead. Nested values, whose hashes pass over nulls, are counted as they are.
    """
    cols, types = list(cols or df.columns), dict(df.dtypes)
    nested = [types[c].startswith(("struct", "array", "map")) for c in cols]
    hashed = [] if approximate else [i for i, n in enumerate(nested) if not n]
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_n{i}") for i, c in enumerate(cols)],
        *[distinct(F.col(c)).alias(f"_u{i}") for i, c in enumerate(cols) if i not in hashed],
        *[F.min(F.col(c).cast("string")).alias(f"_e{i}") for i, c in enumerate(cols)],
    )
    if hashed:
        marks = [F.when(F.col(c).isNotNull(), value_hash(F.col(c))) for c in (cols[i] for i in hashed)]
        cells = df.select(F.posexplode(F.array(*marks)).alias("_p", "h")).where("h is not null")
        found = cells.select("_p", "h.a", "h.b").distinct()
        row = row.crossJoin(found.agg(*[F.count_if(F.col("_p") == at).alias(f"_u{i}") for at, i in enumerate(hashed)]))
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            F.col(f"_n{i}").alias("known"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("unknown"),
            F.round(F.try_divide(F.col("_rows") - F.col(f"_n{i}"), F.col("_rows")) * 100, 1).alias("unknown_pct"),
            F.col(f"_u{i}").alias("distinct"),
            F.col(f"_e{i}").alias("example"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*entries)))


def moments(x: Column) -> dict[str, Column]:
    """Skewness and excess kurtosis, corrected for the sample size."""
    n = F.count(x).cast("double")
    g1, g2 = F.skewness(x), F.kurtosis(x)
    skew = F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * g1)
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return {"skew": skew, "kurtosis": kurt}


def describe(df: DataFrame, cols: Sequence[str] | None = None, blocks: int | None = None) -> DataFrame:
    """One row per numeric column: count, mean, deviation, extremes, quartiles, skewness, kurtosis."""
    cols = list(cols or numeric_columns(df))
    long = melt(df, cols, name="column", value="_x")
    x = F.col("_x")
    stats = long.groupBy("column").agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        *[c.alias(k) for k, c in moments(x).items()],
    )
    parts = exact_quantiles(long, "_x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ("column",), blocks)
    return stats.join(parts, "column", "left")


def box_numbers(df: DataFrame, value: str, keys: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Smallest, quartiles and largest value, per group if keys are given."""
    levels = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return exact_quantiles(df, value, levels, keys, blocks)


def melt(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (), name: str = "variable", value: str = "value"):
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return doubles.unpivot(list(ids), list(cols), name, value)


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with unknown cells, most first, and the share of all cells as ``(all)``."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0.0)) / len(df.columns)
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("share")) for c in df.columns]
    entries.append(F.struct(F.lit("(all)").alias("column"), total.alias("share")))
    out = row.select(F.inline(F.array(*entries))).withColumn("unknown_pct", F.col("share") * 100).drop("share")
    return out.where((F.col("unknown_pct") > 0) | (F.col("column") == "(all)")).orderBy(F.col("unknown_pct").desc(), "column")


def outlier_counts(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 3.0) -> DataFrame:
    """Outliers of every numeric column, and their sum as ``(all)``."""
    cols = list(cols or numeric_columns(df))
    both = [f(F.col(c).cast("double")).alias(f"{p}_{c}") for c in cols for p, f in (("m", F.avg), ("s", F.stddev_samp))]
    stats = df.agg(*both).select(F.struct("*")).scalar()
    marks = []
    for c in cols:
        mean, std = stats[f"m_{c}"], stats[f"s_{c}"]
        far = F.abs(F.col(c) - mean) / F.when(std > 0, std) > threshold
        marks.append(F.count_if(far).alias(c))
    row = df.agg(*marks)
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("outliers")) for c in cols]
    total = sum((F.col(c) for c in cols), F.lit(0).cast("long"))
    entries.append(F.struct(F.lit("(all)").alias("column"), total.alias("outliers")))
    return row.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Equal-width bins from smallest to largest value; empty bins are kept."""
    if not 10 <= bins <= 100:
        raise ValueError("between 10 and 100 bins")
    span = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    ends = span.select(F.struct("lo", "hi")).scalar()
    lo, hi = ends["lo"], ends["hi"]
    x = F.col(value).cast("double")
    place = F.when(hi > lo, F.least(F.floor((x - lo) / ((hi - lo) / bins)), F.lit(bins - 1))).otherwise(0)
    counts = df.where(F.col(value).isNotNull()).groupBy(place.cast("int").alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    edges = span.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return edges.join(counts, F.col("bin") == F.col("_bin"), "left").select(
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("low"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


# -------------------------------------------------------------------------------------- correlations


def pearson_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(left, right, corr)`` for every ordered pair, from one pass; unknown cells drop out pairwise."""
    cols = list(cols or numeric_columns(df))
    pairs = list(combinations_with_replacement(cols, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(left).alias("left"), F.lit(right).alias("right"), F.col(f"r{i}").alias("corr")))
    return row.select(F.inline(F.array(*entries)))


def top_correlations(df: DataFrame, target: str, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """The features that move most with the target, by absolute correlation."""
    y = F.col(target).cast("double")
    row = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in cols])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in cols]
    out = row.select(F.inline(F.array(*entries))).where("corr is not null and not isnan(corr)")
    ordered = out.orderBy(F.abs("corr").desc(), "feature")
    return ordered.limit(top) if top else ordered


def _pair_counts(df: DataFrame, x: str, y: str) -> DataFrame:
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return df.select(a.alias("_x"), b.alias("_y")).where("_x is not null and _y is not null").groupBy("_x", "_y").agg(
        F.count(F.lit(1)).alias("_w")
    )


def average_ranks(df: DataFrame, col: str, blocks: int | None = None) -> DataFrame:
    """``(_value, _rank)``: rank of each value, equal values sharing the mean of theirs."""
    counts = range_blocks(value_counts(df, col), ["_value"], blocks)
    rows = running_sum(counts, {"_end": "_n"})
    return rows.select("_value", (F.col("_end") - F.col("_n") + (F.col("_n") + 1) / 2).alias("_rank"))


def spearman(df: DataFrame, x: str, y: str, blocks: int | None = None) -> DataFrame:
    """Correlation of the ranks, over rows where both values are known."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    pairs = _pair_counts(both, x, y)
    rx = average_ranks(both, x, blocks).select(F.col("_value").alias("_vx"), F.col("_rank").alias("_rx"))
    ry = average_ranks(both, y, blocks).select(F.col("_value").alias("_vy"), F.col("_rank").alias("_ry"))
    middle = (both.agg(F.count(F.lit(1))).scalar() + 1) / 2
    ranked = pairs.join(rx, F.col("_x") == F.col("_vx")).join(ry, F.col("_y") == F.col("_vy"))
    dx, dy, w = F.col("_rx") - middle, F.col("_ry") - middle, F.col("_w")
    sums = F.sum(w * dx * dy), F.sqrt(F.sum(w * dx * dx)), F.sqrt(F.sum(w * dy * dy))
    return ranked.agg(F.try_divide(sums[0], sums[1] * sums[2]).alias("corr"))


def _crossing(order: np.ndarray, weights: np.ndarray) -> int:
    """The weight of all pairs that ``order``, which holds the numbers below its length once each, has the wrong way round.

    Two numbers differ first at exactly one bit. Bit by bit, among numbers that agree above it, each one with the bit unset
    meets all earlier ones that have it set.
    """
    if int(weights.sum()) >= 1 << 31:  # products beyond 64 bits
        weights = weights.astype(object)
    found, zero = 0, weights[:1] * 0
    for bit in reversed(range(max(len(order) - 1, 0).bit_length())):
        is_set = (order >> bit) & 1 == 1
        sums = np.concatenate((zero, np.cumsum(np.where(is_set, weights, 0))))
        head = order >> (bit + 1)
        start = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
        earlier = sums[:-1] - np.repeat(sums[start], np.diff(np.append(start, len(order))))
        found += int(np.where(is_set, 0, earlier * weights).sum())
        turn = np.argsort(order >> bit, kind="stable")
        order, weights = order[turn], weights[turn]
    return found


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """The place of every row in the order of the keys, the first key first."""
    out = np.empty(len(keys[0]), np.int64)
    out[np.lexsort(keys[::-1])] = np.arange(len(out))
    return out


def _crossing_inside(part: pd.DataFrame) -> pd.DataFrame:
    """Discordant pairs among the rows of a block by ``x``."""
    part = part.sort_values(["_x", "_y"])
    found = _crossing(_ranks(part["_y"].to_numpy(), part["_x"].to_numpy()), part["_w"].to_numpy())
    return pd.DataFrame({"pairs": [Decimal(found)]})


def _crossing_between(part: pd.DataFrame) -> pd.DataFrame:
    """Discordant pairs among the rows of a block by ``y`` that stand in different blocks by ``x``."""
    part = part.sort_values(["_x", "_y"])
    x, y, w, at = (part[c].to_numpy() for c in ("_x", "_y", "_w", "_bx"))
    found = _crossing(_ranks(y, x), w) - _crossing(_ranks(at, y, x), w)
    return pd.DataFrame({"pairs": [Decimal(found)]})


def kendall(df: DataFrame, x: str, y: str, blocks: int | None = None) -> DataFrame:
    """Kendall's tau-b, exact, without forming pairs of rows.

    Equal pairs are counted first. In the order of (x, y) two of them are discordant if they stand the other way round in
    the order of (y, x). Both orders are cut into blocks. Pairs of rows that differ in both blocks are counted from the
    rows in each pair of blocks, pairs within a block by ``x`` and the others within a block by ``y`` inside the block.
    """
    pairs = cut_lineage(_pair_counts(df, x, y))
    blocks = blocks or blocks_for(pairs, PAIRS_PER_BLOCK)
    by_x = range_blocks(pairs, ["_x", "_y"], blocks)
    by_y = range_blocks(by_x.select("_x", "_y", "_w", F.col(BLOCK).alias("_bx")), ["_y", "_x"], blocks)
    big = "decimal(38,0)"
    inside = by_x.groupBy(BLOCK).applyInPandas(_crossing_inside, f"pairs {big}")
    between = by_y.groupBy(BLOCK).applyInPandas(_crossing_between, f"pairs {big}")
    cells = by_y.groupBy("_bx", F.col(BLOCK).alias("_by")).agg(F.sum("_w").alias("_n"))
    numbers = F.sequence(F.lit(0), F.lit(blocks - 1))
    grid = df.sparkSession.range(blocks).select(F.col("id").cast("int").alias("_bx"), F.explode(numbers).alias("_by"))
    before = Window.partitionBy("_by").orderBy("_bx").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("_bx").orderBy(F.desc("_by")).rowsBetween(Window.unboundedPreceding, -1)
    full = grid.join(cells, ["_bx", "_by"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)).cast("decimal(19,0)"))
    met = full.withColumn("_s", F.sum("_n").over(before)).withColumn("_s", F.sum("_s").over(above).cast("decimal(19,0)"))
    apart = met.agg(F.coalesce(F.sum(F.col("_n") * F.col("_s")), F.lit(0)).cast(big).alias("pairs"))
    top = F.expr("cast(_w as decimal(19,0))")

    def ties(keys: Sequence[str]) -> Column:
        sums = pairs.groupBy(*keys).agg(F.sum(top).cast("decimal(19,0)").alias("t")) if keys else pairs.select(top.alias("t"))
        return sums.agg(F.sum(F.expr("t * (t - 1)")).cast("double") / 2).scalar()

    total = pairs.agg(F.sum("_w").cast("double")).scalar()
    n0 = total * (total - 1) / 2
    n1, n2, n3 = ties(["_x"]), ties(["_y"]), ties([])
    out = inside.unionByName(between).unionByName(apart).agg(F.sum("pairs").cast("double").alias("discordant"))
    tau = F.try_divide(n0 - n1 - n2 + n3 - 2 * F.col("discordant"), F.sqrt((n0 - n1) * (n0 - n2)))
    return out.select(total.cast("long").alias("n"), "discordant", tau.alias("tau"))
