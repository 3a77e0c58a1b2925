"""Lag, rolling and derived features of a series. They count rows, not calendar days."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from salesline.operators.ordering import Series, over_series, range_blocks, running_sum

# All rows in order, in blocks.
WHOLE = Series((), daily=False)

# The feature settings shared by training and forecasting.
LAGS = (1, 2, 3, 7, 14, 21, 28)
WINDOWS = (7, 14, 28)

# Names of features whose first number says how far back they reach.
FAMILIES = (
    "lag", "roll_mean", "roll_std", "roll_min", "roll_max", "roll_range", "roll_cv", "ewma", "lag_diff", "lag_ratio",
)


def min_rows(window: int) -> int:
    """Known values a frame needs before it gives a result."""
    if window < 3:
        raise ValueError("a window must hold at least 3 rows")
    return max(window // 2, 3)


def add_lags(
    df: DataFrame, value: str = "value", lags: Sequence[int] = LAGS, series: Series = Series()
) -> DataFrame:
    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns(
            {f"lag_{k}": F.when(series.key_present(), F.lag(value, k).over(w)) for k in lags}
        )

    return over_series(df, series, max(lags), add)


def rolling_statistics(size: int, count: Column, mean: Column, std: Column, low: Column, high: Column) -> dict:
    """The rolling features of one size from aggregates over its values, of a window or of an array."""
    enough = count >= min_rows(size)
    return {
        f"roll_mean_{size}": F.when(enough, mean),
        f"roll_std_{size}": F.coalesce(F.when(enough, std), F.lit(0.0)),
        f"roll_min_{size}": F.when(enough, low),
        f"roll_max_{size}": F.when(enough, high),
    }


def rolling_columns(value: str, windows: Sequence[int], w: WindowSpec, present: Column, shift: int = 1) -> dict:
    """Statistics of the rows ending ``shift`` rows back."""
    out: dict[str, Column] = {}
    for size in windows:
        frame = w.rowsBetween(-(size + shift - 1), -shift)
        count, *found = (f(value).over(frame) for f in (F.count, F.avg, F.stddev_samp, F.min, F.max))
        out |= rolling_statistics(size, F.when(present, count), *found)
    return out


def array_rolling_columns(known: dict[int, Column]) -> dict:
    """The same statistics of arrays that hold the known values of the last rows, an array for each size."""
    out: dict[str, Column] = {}
    for size, values in known.items():
        n = F.size(values)
        mean = F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), n)
        spread = F.transform(F.array(mean), lambda m: F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)))
        std = F.sqrt(F.try_divide(F.get(spread, F.lit(0)), n - 1))
        out |= rolling_statistics(size, n, mean, std, F.array_min(values), F.array_max(values))
    return out


def add_rolling(
    df: DataFrame, value: str = "value", windows: Sequence[int] = WINDOWS, series: Series = Series(), shift: int = 1
) -> DataFrame:
    """``shift`` is 1 by default; a direct forecast ``h`` steps ahead uses ``h``."""
    for size in windows:
        min_rows(size)

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns(rolling_columns(value, windows, w, series.key_present(), shift))

    return over_series(df, series, max(windows) + shift, add)


def add_lag_interactions(df: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Differences, ratios, variation and range of lags and rolling statistics, where present."""
    have, out = set(df.columns), {}

    def both(a: str, b: str) -> bool:
        return {a, b} <= have

    for a, b in ((1, 7), (7, 14), (1, 14)):
        if both(f"lag_{a}", f"lag_{b}"):
            out[f"lag_diff_{a}_{b}"] = F.col(f"lag_{a}") - F.col(f"lag_{b}")
    if both("lag_1", "lag_7"):
        out["lag_ratio_1_7"] = F.try_divide("lag_1", "lag_7")
    for w in windows:
        if both(f"roll_mean_{w}", f"roll_std_{w}"):
            cv = F.coalesce(F.try_divide(f"roll_std_{w}", f"roll_mean_{w}"), F.lit(0.0))
            out[f"roll_cv_{w}"] = F.least(F.greatest(cv, F.lit(-10.0)), F.lit(10.0))
        if both(f"roll_min_{w}", f"roll_max_{w}"):
            out[f"roll_range_{w}"] = F.col(f"roll_max_{w}") - F.col(f"roll_min_{w}")
    return df.withColumns(out) if out else df


def add_lag_ratios(df: DataFrame) -> DataFrame:
    if not {"lag_7", "lag_14"} <= set(df.columns):
        return df
    base = F.when(F.col("lag_14") != 0, F.col("lag_14")) + F.lit(1e-9)
    return df.withColumns(
        {"ratio_lag7_lag14": F.try_divide(F.col("lag_7"), base), "diff_lag7_lag14": F.col("lag_7") - F.col("lag_14")}
    )


def add_crosses(df: DataFrame) -> DataFrame:
    have, out = set(df.columns), {}
    if {"store_id", "dayofweek"} <= have:
        out["store_dayofweek"] = F.concat_ws("_", F.col("store_id"), F.col("dayofweek").cast("string"))
    if {"store_id", "month"} <= have:
        out["month_store"] = F.concat_ws("_", F.col("month").cast("string"), F.col("store_id"))
    return df.withColumns(out) if out else df


def add_diff(df: DataFrame, value: str = "value", series: Series = WHOLE, name: str = "diff") -> DataFrame:
    return over_series(
        df, series, 1, lambda rows, w: rows.withColumn(name, F.col(value) - F.lag(value, 1).over(w))
    )


def add_moving_average(
    df: DataFrame, value: str = "value", size: int = 7, series: Series = WHOLE, name: str | None = None
) -> DataFrame:
    """Mean of the current and the previous rows, from the first row on."""
    return over_series(
        df,
        series,
        size,
        lambda rows, w: rows.withColumn(name or f"ma_{size}", F.avg(value).over(w.rowsBetween(-(size - 1), 0))),
    )


def add_cumulative_sum(
    df: DataFrame, value: str = "value", series: Series = WHOLE, name: str = "cumulative"
) -> DataFrame:
    if series.daily:
        frame = series.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.sum(value).over(frame))
    rows = range_blocks(df, [*series.keys, *series.order], series.blocks)
    return running_sum(rows, {name: value}, series.keys).drop("_blk", "_pos")


def drop_short_lags(df: DataFrame, horizon: int) -> DataFrame:
    """Drop ready-made lag and window columns that reach back less than the horizon."""

    def reach(column: str) -> int | None:
        for f in sorted(FAMILIES, key=len, reverse=True):
            if column.startswith(f + "_"):
                number = re.match(r"\d+", column[len(f) + 1 :])
                return int(number[0]) if number else None
        return None

    return df.drop(*[c for c in df.columns if (reach(c) or horizon) < horizon])


def drop_warm_up(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)
