"""Cleaning of sales rows: order, gaps, outliers, quantities and inconsistent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesline.functions.parsing import scrub
from salesline.operators.ordering import carry, range_blocks
from salesline.operators.quantiles import quantiles_of, value_counts
from salesline.session import cut_lineage, join_small

# Fixed value: the largest believable quantity of one row.
QUANTITY_CAP = 10_000


def harmonize_dates(df: DataFrame, date: str = "date", layout: str | None = None) -> DataFrame:
    """Dates as timestamps without zone; what cannot be read becomes null. Rows keep no order:
    later steps order by date inside their windows, unknown dates last."""
    kind = dict(df.dtypes)[date]
    if kind == "string":
        parsed = F.try_to_timestamp(date, F.lit(layout)) if layout else F.try_to_timestamp(date)
    else:
        parsed = F.col(date)
    if kind == "date":
        return df
    zone_free = F.to_utc_timestamp(parsed, F.current_timezone()) if kind == "timestamp" else parsed
    return df.withColumn(date, zone_free.cast("timestamp_ntz"))


def date_order(date: str = "date", tie: str = "rid") -> list[Column]:
    return [F.col(date).asc_nulls_last(), F.col(tie).asc()]


def fill_missing(
    df: DataFrame,
    cols: Sequence[str],
    strategy: str = "ffill",
    order: Sequence[str | Column] = ("date", "rid"),
    keys: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Fill unknown numbers. ``keys`` limits the fill to a series; without keys it runs over all rows."""
    if strategy == "zero":
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in cols})
    if strategy == "mean":
        if keys:
            means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
            joined = join_small(df, means, keys)
            return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in cols}).drop(
                *[f"_m_{c}" for c in cols]
            )
        return df.withColumns({c: F.coalesce(F.col(c), df.agg(F.avg(c)).scalar()) for c in cols})
    if strategy not in ("ffill", "bfill"):
        raise ValueError(f"unknown fill strategy: {strategy}")
    return fill_in_order(df, cols if strategy == "ffill" else (), cols if strategy == "bfill" else (), (), order, keys, blocks)


def fill_in_order(
    df: DataFrame,
    forward: Sequence[str],
    backward: Sequence[str],
    both: Sequence[str],
    order: Sequence[str | Column] = ("date", "rid"),
    keys: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Fill columns forward, backward, or forward and what is left at the start backward: one sort for all of them."""
    rows = range_blocks(df, [*keys, *order], blocks)
    ahead, back = [*forward, *both], [*backward, *both]
    if ahead:
        rows = carry(rows, ahead, keys, forward=True)
    if back:
        rows = carry(rows, back, keys, forward=False, prefix="_d_")
    found = {c: F.col(f"_c_{c}") for c in forward} | {c: F.col(f"_d_{c}") for c in backward}
    found |= {c: F.coalesce(F.col(f"_c_{c}"), F.col(f"_d_{c}")) for c in both}
    return rows.withColumns(found).select(*df.columns)


def fill_other_columns(
    df: DataFrame,
    cols: Sequence[str],
    order: Sequence[str | Column] = ("date", "rid"),
    keys: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Fill forward, then what is left at the start backward."""
    return fill_in_order(df, (), (), cols, order, keys, blocks)


def outlier_flag(
    df: DataFrame, value: str = "value", threshold: float = 3.0, keys: Sequence[str] = (), name: str = "is_outlier"
) -> DataFrame:
    """True where the value is more than ``threshold`` sample deviations from the mean. The rows are stored, as both the
    statistics and the flags need them."""
    df = cut_lineage(df)
    stats = [F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std")]
    if keys:
        rows = join_small(df, df.groupBy(*keys).agg(*stats), keys)
    else:
        one = df.agg(*stats).select(F.struct("*")).scalar()
        rows = df.withColumns({"_mean": one["_mean"], "_std": one["_std"]})
    z = F.abs((F.col(value) - F.col("_mean")) / F.when(F.col("_std") > 0, F.col("_std")))
    return rows.withColumn(name, F.coalesce(z > threshold, F.lit(False))).drop("_mean", "_std")


def remove_outliers(
    df: DataFrame, value: str = "value", threshold: float | None = 3.0, keys: Sequence[str] = ()
) -> DataFrame:
    """Drop outliers; a threshold of 0 or None keeps everything."""
    if not threshold or threshold <= 0:
        return df
    return outlier_flag(df, value, threshold, keys, "_out").where(~F.col("_out")).drop("_out")


def cap_quantity(
    df: DataFrame,
    quantity: str = "quantity",
    product: str = "product_id",
    cap: float = QUANTITY_CAP,
    by_product: bool = True,
    blocks: int | None = None,
) -> DataFrame:
    """Replace impossible quantities by the product's median of believable ones, unknown ones by the
    overall median. ``by_product=False`` uses the overall median for both."""
    counts = cut_lineage(value_counts(df.where(F.col(quantity) <= cap), quantity, [product] if by_product else []))
    overall = quantiles_of(counts, {"median": 0.5}, (), blocks).select("median").scalar()
    if not by_product:
        return df.withColumn(quantity, F.when(F.col(quantity) <= cap, F.col(quantity)).otherwise(overall))
    medians = quantiles_of(counts, {"_median": 0.5}, (product,), blocks)
    joined = join_small(df, medians.where(F.col(product).isNotNull()), [product])
    fixed = (
        F.when(F.col(quantity) <= cap, F.col(quantity))
        .when(F.col(quantity) > cap, F.coalesce(F.col("_median"), overall))
        .otherwise(overall)
    )
    return joined.withColumn(quantity, fixed).select(*df.columns)


def consistent_value(
    df: DataFrame, value: str = "value", price: str = "price", quantity: str = "quantity"
) -> DataFrame:
    """Use price times quantity where the value is unknown, zero, or over a hundred times that."""
    expected = F.col(price) * F.col(quantity)
    wrong = F.col(value).isNull() | (F.col(value) == 0) | (F.col(value) > expected * 100)
    return df.withColumn(value, F.when(wrong, expected).otherwise(F.col(value)))


def clean(
    df: DataFrame,
    value: str = "value",
    date: str = "date",
    tie: str = "rid",
    strategy: str = "ffill",
    threshold: float | None = 3.0,
    keys: Sequence[str] = ("store_id", "product_id"),
    by_product: bool = True,
    fill_others: Sequence[str] | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """The whole chain. ``keys=()`` fills over all rows in date order, as one table.

    ``fill_others`` names the columns filled in both directions: by default all but the value and those that order the
    rows and name the series.
    """
    rows = harmonize_dates(df, date)
    if dict(rows.dtypes)[value] == "string":
        rows = rows.withColumn(value, scrub(F.col(value).try_cast("double")))
    order = date_order(date, tie)
    if fill_others is None:
        fill_others = [c for c in rows.columns if c not in (value, date, tie, *keys)]
    if strategy in ("ffill", "bfill"):  # in one sort with the others
        forward, backward = ([value], []) if strategy == "ffill" else ([], [value])
        rows = fill_in_order(rows, forward, backward, fill_others, order, keys, blocks)
    else:
        rows = fill_missing(rows, [value], strategy, order, keys, blocks)
        rows = fill_in_order(rows, (), (), fill_others, order, keys, blocks) if fill_others else rows
    # Filling shuffles all rows; what follows passes over them several times.
    rows = remove_outliers(rows, value, threshold) if threshold and threshold > 0 else cut_lineage(rows)
    if "quantity" in rows.columns:
        rows = cap_quantity(rows, by_product=by_product and "product_id" in rows.columns, blocks=blocks)
        if "price" in rows.columns:
            rows = consistent_value(rows, value)
    return rows


def clean_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, dropped rows and unknown cells before and after, one row per stage."""

    def side(df: DataFrame, stage: str) -> DataFrame:
        nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
        return df.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"))

    total = before.agg(F.count(F.lit(1))).scalar()
    return side(before, "before").unionByName(side(after, "after")).withColumn("dropped", total - F.col("rows"))
