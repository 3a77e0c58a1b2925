"""Exponentially weighted means, exact for series of any length.

With ``r = 1 - alpha`` a weight ``r ** age`` falls below 1e-18 after a block of ``B`` rows. Inside a
block the sums of ``x * r ** -j`` stay in range; the two blocks before add theirs, scaled by
``r ** B`` each. The mean is taken where a value is known, where its own weight is 1, and carried
over unknown rows, which is what an adjusted mean with ageing over gaps gives. Spans share blocks as
long as the shortest of them stays in range, so that one sort serves all of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from salesline.operators.ordering import Series, carry, over_series, range_blocks, running_sum
from salesline.operators.windows import WINDOWS


def _rate(span: int) -> float:
    return 1 - 2 / (span + 1)


def block_rows(span: int) -> int:
    """Rows after which a weight no longer counts."""
    return int(math.log(1e-18) / math.log(_rate(span)))


def _range_rows(span: int) -> int:
    """Rows after which the inverse weight would leave the range of a double."""
    return int(math.log(1e-280) / math.log(_rate(span)))


def span_groups(spans: Sequence[int]) -> list[list[int]]:
    """Spans that can share blocks."""
    groups: list[list[int]] = []
    for s in sorted(spans):
        if groups and block_rows(s) <= _range_rows(groups[-1][0]):
            groups[-1].append(s)
        else:
            groups.append([s])
    return groups


def _known_means(rows: DataFrame, spans: Sequence[int], w: WindowSpec, keys: Sequence[str]) -> DataFrame:
    """Add ``_m_<span>``, the mean at rows where ``_x`` is known; ``_et`` numbers the rows of a series."""
    size, x = block_rows(max(spans)), F.col("_x")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_eb").orderBy("_et").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_eb", F.floor(F.col("_et") / size).cast("long"))
    age = F.col("_et") - F.col("_eb") * size
    names = [f"{p}{s}_" for s in spans for p in ("_n", "_d")]
    terms = {}
    for s in spans:
        up = F.pow(F.lit(_rate(s)), -age)
        terms[f"_n{s}_t"] = F.coalesce(x * up, F.lit(0.0))
        terms[f"_d{s}_t"] = F.when(x.isNotNull(), up).otherwise(0.0)
    rows = rows.withColumns(terms)
    rows = rows.withColumns({f"{n}0": F.sum(f"{n}t").over(inside) for n in names}).drop(*terms)
    last_row = age == size - 1
    for k in (1, 2):
        before = {
            f"{n}{k}": F.coalesce(F.last(F.when(last_row, F.col(f"{n}{k - 1}")), ignorenulls=True).over(earlier), F.lit(0.0))
            for n in names
        }
        rows = rows.withColumns(before)

    def total(name: str, s: int) -> Column:
        return sum((F.col(f"{name}{k}") * F.pow(F.lit(_rate(s)), age + k * size) for k in range(3)), F.lit(0.0))

    means = {f"_m_{s}": F.when(x.isNotNull(), total(f"_n{s}_", s) / total(f"_d{s}_", s)) for s in spans}
    return rows.withColumns(means).drop("_eb", *[f"{n}{k}" for n in names for k in range(3)])


def add_ewma(
    df: DataFrame,
    value: str = "value",
    spans: Sequence[int] = WINDOWS,
    series: Series = Series(),
    min_count: int | None = None,
) -> DataFrame:
    """``ewma_<span>`` of the rows before each row; needs ``max(span // 2, 3)`` known values."""
    need = {s: min_count or max(s // 2, 3) for s in spans}
    if not series.daily:
        return _add_long_ewma(df, value, spans, series, need)
    w = series.window()
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumns(
        {"_et": (F.row_number().over(w) - 1).cast("long"), "_x": F.lag(F.col(value).cast("double"), 1).over(w)}
    )
    for group in span_groups(spans):
        rows = _known_means(rows, group, w, series.parts())
    rows = rows.withColumns(
        {
            f"ewma_{s}": F.when(
                (F.count("_x").over(so_far) >= need[s]) & series.key_present(),
                F.last(f"_m_{s}", ignorenulls=True).over(so_far),
            )
            for s in spans
        }
    )
    return rows.drop("_et", "_x", *[f"_m_{s}" for s in spans])


def _add_long_ewma(
    df: DataFrame, value: str, spans: Sequence[int], series: Series, need: dict[int, int]
) -> DataFrame:
    """Blocks of rows with a reach of two weight blocks; gaps and counts carried over all blocks."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = rows.withColumns(
            {"_et": (F.row_number().over(w) - 1).cast("long"), "_x": F.lag(F.col(value).cast("double"), 1).over(w)}
        )
        for group in span_groups(spans):
            rows = _known_means(rows, group, w, [*series.keys, "b"])
        return rows.drop("_et")

    means = over_series(df, series, 2 * block_rows(max(spans)) + 2, add)
    blocks = range_blocks(means, [*series.keys, *series.order], series.blocks)
    counted = running_sum(blocks, {"_known": F.col("_x").isNotNull().cast("long")}, series.keys)
    filled = carry(counted, [f"_m_{s}" for s in spans], series.keys)
    out = {
        f"ewma_{s}": F.when((F.col("_known") >= need[s]) & series.key_present(), F.col(f"_c__m_{s}")) for s in spans
    }
    return filled.withColumns(out).select(*df.columns, *out)


def add_store_ewma(df: DataFrame, value: str = "value", date: str = "date") -> DataFrame:
    """Weekly mean over a store's rows in product order, for tables whose windows lack 7.

    A store holds many series, so its rows are not bounded by the calendar.
    """
    series = Series(("store_id",), ("product_id", date), daily=False)
    return add_ewma(df, value, (7,), series, min_count=3)
