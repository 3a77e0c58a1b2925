"""Preparation of training sets: targets, time-based splits, folds and simple baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesline.functions.parsing import promo_flag
from salesline.operators.ordering import Series, row_index
from salesline.session import join_small

# Share of the training rows kept for validation, and the clip before the inverse log.
VALIDATION_SHARE = 0.15
LOG_CLIP = 20.0
MIN_SERIES_ROWS = 30


def drop_unknown_target(df: DataFrame, target: str = "value") -> DataFrame:
    return df.dropna(subset=[target])


def add_promo_flag(df: DataFrame, col: str = "on_promo") -> DataFrame:
    return df.withColumn(col, promo_flag(F.col(col)))


def with_series_id(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("series_id", F.concat_ws("_", *keys) if keys else F.lit("all"))


def cutoff_date(df: DataFrame, horizon: int, date: str = "date") -> DataFrame:
    """One row: the first date of the test part, the ``horizon``-th last distinct date.

    The distinct days, times cut off, are bounded by the calendar, so ranking them in one task is safe.
    """
    days = df.select(F.to_date(date).alias(date)).where(F.col(date).isNotNull()).distinct()
    ranked = days.select(
        F.col(date),
        F.row_number().over(Window.orderBy(F.col(date).desc())).alias("back"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("n"),
    )
    steps = F.when(F.lit(horizon) >= F.col("n"), F.greatest(F.lit(1), F.floor(F.col("n") / 5))).otherwise(horizon)
    return ranked.where(F.col("back") == steps).select(F.col(date).alias("cutoff"))


def split_by_time(df: DataFrame, horizon: int, date: str = "date", name: str = "split") -> DataFrame:
    """``train`` before the cutoff, ``test`` from it on."""
    cutoff = cutoff_date(df, horizon, date).scalar()
    return df.withColumn(name, F.when(F.col(date) >= cutoff, "test").when(F.col(date) < cutoff, "train"))


def validation_flag(
    train: DataFrame,
    horizon: int,
    by: str = "date",
    order: Sequence[str] = ("store_id", "product_id", "date"),
    date: str = "date",
    share: float = VALIDATION_SHARE,
    blocks: int | None = None,
) -> DataFrame:
    """Mark the tail used for early stopping: the last dates, or (``by="row"``) the last rows in ``order``."""
    if by == "date":
        days = train.select(F.to_date(date).alias(date)).distinct()
        ranked = days.select(
            F.col(date),
            F.row_number().over(Window.orderBy(F.col(date).desc())).alias("back"),
            F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("n"),
        )
        size = F.greatest(F.floor(F.col("n") * share), F.lit(horizon))
        first = ranked.where(F.col("back") <= size).agg(F.min(date)).scalar()
        return train.withColumn("is_validation", F.col(date) >= first)
    if by != "row":
        raise ValueError("by must be 'date' or 'row'")
    total = train.agg(F.count(F.lit(1))).scalar()
    size = F.greatest(F.floor(total * share), F.lit(horizon))
    rows = row_index(train, order, name="_i", blocks=blocks)
    return rows.withColumn("is_validation", F.col("_i") >= total - size).drop("_i")


def expanding_folds(
    df: DataFrame,
    by: str = "date",
    order: Sequence[str] = ("store_id", "product_id", "date"),
    date: str = "date",
    folds: int | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Every row once per fold it belongs to, as ``(fold, role)`` with role train or validation.

    Without ``folds`` the number is ``min(5, max(2, rows // 100))``. ``by="date"`` cuts at dates,
    ``by="row"`` at row positions in ``order``.
    """
    rows_total = df.agg(F.count(F.lit(1))).scalar()
    k = F.lit(folds) if folds else F.least(F.lit(5), F.greatest(F.lit(2), F.floor(rows_total / 100)))
    k = k.cast("int")
    if by == "row":
        rows = row_index(df, order, name="_i", blocks=blocks).withColumn("_n", rows_total)
    elif by == "date":
        days = df.select(F.to_date(date).alias("_day")).distinct()
        ranked = days.select(
            "_day",
            (F.row_number().over(Window.orderBy("_day")) - 1).cast("long").alias("_i"),
            F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("_n"),
        )
        rows = df.join(ranked, F.to_date(date) == F.col("_day")).drop("_day")
    else:
        raise ValueError("by must be 'date' or 'row'")
    rows = rows.withColumn("_k", k).withColumn("fold", F.explode(F.sequence(F.lit(1), F.col("_k"))))
    size = F.floor(F.col("_n") / (F.col("_k") + 1))
    start = F.col("_n") - (F.col("_k") - F.col("fold") + 1) * size
    role = F.when(F.col("_i") < start, "train").when(F.col("_i") < start + size, "validation")
    return rows.withColumn("role", role).where("role is not null").drop("_i", "_n", "_k")


def log_shift(df: DataFrame, target: str = "value") -> Column:
    """What to add so that the smallest target becomes 1; nothing if all are positive."""
    low = F.min(target)
    return df.agg(F.when(low <= 0, 1 - low).otherwise(F.lit(0.0)).alias("shift")).scalar()


def log_target(df: DataFrame, target: str = "value", name: str = "log_value") -> DataFrame:
    shift = log_shift(df, target)
    return df.withColumn("log_shift", shift).withColumn(name, F.log1p(F.col(target) + F.col("log_shift")))


def inverse_log(col: Column, shift: Column) -> Column:
    return F.expm1(F.least(col, F.lit(LOG_CLIP))) - shift


def series_sizes(df: DataFrame, keys: Sequence[str], min_rows: int = MIN_SERIES_ROWS) -> DataFrame:
    """How many series there are and how long they are."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("series"),
        F.min("n").alias("min_rows"),
        F.avg("n").alias("mean_rows"),
        F.max("n").alias("max_rows"),
        F.stddev_samp("n").alias("std_rows"),
        F.count_if(F.col("n") >= min_rows).alias("long_enough"),
    )


def mean_fallback(
    test: DataFrame, train: DataFrame, keys: Sequence[str], target: str = "value", name: str = "yhat"
) -> DataFrame:
    """Forecast of series without a model: their mean, else the mean of all; never below 0."""
    means = train.groupBy(*keys).agg(F.avg(target).alias("_m"))
    whole = train.agg(F.avg(target)).scalar()
    joined = join_small(test, means, keys)
    return joined.withColumn(name, F.greatest(F.lit(0.0), F.coalesce(F.col("_m"), whole))).drop("_m")


def mean_regressor(test: DataFrame, train: DataFrame, target: str = "value", name: str = "yhat") -> DataFrame:
    return test.withColumn(name, train.agg(F.avg(target)).scalar())


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected columns in their order; missing ones are 0, unknown cells stay unknown."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else F.lit(0).alias(c) for c in expected])


def tail_rows(df: DataFrame, series: Series = Series(), rows: int = 90) -> DataFrame:
    """The last rows of each series."""
    w = Window.partitionBy(*series.keys).orderBy(*[F.col(c).desc() for c in series.order])
    return df.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= rows).drop("_back")
