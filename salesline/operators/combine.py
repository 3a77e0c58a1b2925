"""Bring history and forecasts together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesline.functions.parsing import day_first_date, scrub
from salesline.operators.profile import NUMERIC

# Labels of rows known from history only, from the forecast only, from both.
HISTORY, FORECAST, OVERLAP = "Historique", "Prevision", "Overlap"
ANOMALY_PCT = 50.0

FORECAST_POINT = "array<struct<ds:string,yhat:string,y:string,yhat_lower:string,yhat_upper:string>>"


def combine(history: DataFrame, forecast: DataFrame, keys: Sequence[str] = (), date: str = "ds") -> DataFrame:
    """All days of either side; columns of the absent side are null."""
    return history.join(forecast, [*keys, date], "full_outer")


def source_label(y: Column, yhat: Column) -> Column:
    return (
        F.when(y.isNotNull() & yhat.isNull(), HISTORY).when(y.isNull() & yhat.isNotNull(), FORECAST).otherwise(OVERLAP)
    )


def attach_bounds(forecast: DataFrame, bounds: DataFrame, keys: Sequence[str] = (), date: str = "ds") -> DataFrame:
    """Add lower and upper bounds where the bounds table has them."""
    cols = [c for c in ("yhat_lower", "yhat_upper") if c in bounds.columns]
    return forecast.join(bounds.select(*keys, date, *cols), [*keys, date], "left")


def overlap_deviation(history: DataFrame, forecast: DataFrame, keys: Sequence[str] = (), date: str = "ds") -> DataFrame:
    """Days known on both sides with the absolute and the relative deviation."""
    gap = F.col("y") - F.col("yhat")
    return history.join(forecast, [*keys, date]).withColumns(
        {
            "deviation": F.bround(F.abs(gap), 2),
            "deviation_pct": F.bround(F.try_divide(gap, F.col("y")) * 100, 2),
        }
    )


def error_table(combined: DataFrame) -> DataFrame:
    """Observed minus forecast, absolute, and in percent of the observed value."""
    error = F.col("y") - F.col("yhat")
    return combined.where("y is not null and yhat is not null").withColumns(
        {"error": error, "abs_error": F.abs(error), "pct_error": F.abs(F.try_divide(error, F.col("y"))) * 100}
    )


def error_summary(combined: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    rows = error_table(combined)
    squares = F.sum(F.col("error") * F.col("error"))
    return rows.groupBy(*keys).agg(
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("pct_error").alias("mape"),
        (1 - F.try_divide(squares, F.var_pop("y") * F.count(F.lit(1)))).alias("r2"),
    )


def outside_bounds(combined: DataFrame) -> DataFrame:
    """Observed values above the upper or below the lower bound."""
    return combined.where((F.col("y") > F.col("yhat_upper")) | (F.col("y") < F.col("yhat_lower"))).dropna(
        subset=["y", "yhat", "yhat_lower", "yhat_upper"]
    )


def deviating(
    combined: DataFrame, order: Sequence[str], threshold: float = ANOMALY_PCT, rows: int | None = None
) -> DataFrame:
    """Days off by more than the threshold in percent; all of them, or the first ``rows``."""
    off = error_table(combined).where(F.col("pct_error") > threshold)
    return off.orderBy(*order).limit(rows) if rows else off


def explode_forecast(df: DataFrame, col: str = "forecast") -> DataFrame:
    """One row per point of a JSON forecast column."""
    points = F.from_json(F.col(col), FORECAST_POINT)
    return df.withColumn("_p", F.explode(points)).select(*[c for c in df.columns if c != col], "_p.*")


def normalize_forecast(df: DataFrame) -> DataFrame:
    """Accept ``y`` for ``yhat``, read numbers and dates from text."""
    if "yhat" not in df.columns and "y" in df.columns:
        df = df.withColumnRenamed("y", "yhat")
    types, out = dict(df.dtypes), {}
    for c in ("yhat", "yhat_lower", "yhat_upper"):
        if types.get(c) == "string":
            out[c] = scrub(F.col(c).try_cast("double"))
    if types.get("ds") == "string":
        out["ds"] = day_first_date(F.col("ds"))
    return df.withColumns(out) if out else df


def to_daily(
    df: DataFrame,
    keys: Sequence[str] = (),
    date: str = "date",
    tie: str = "rid",
    averages: Sequence[str] = (),
) -> DataFrame:
    """One row per day: numbers are summed (or averaged, if named), other columns keep their first
    known value in the order of ``tie``. Rows without a date are left out."""
    aggs = []
    for c, t in df.dtypes:
        if c in (*keys, date, tie):
            continue
        if t.split("(")[0] in NUMERIC:
            aggs.append((F.avg if c in averages else F.sum)(c).alias(c))
        else:
            aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(tie))).alias(c))
    days = df.where(F.col(date).isNotNull()).withColumn(date, F.to_date(date))
    return days.groupBy(*keys, date).agg(*aggs)


def append_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second, allowMissingColumns=True)


def series_info(df: DataFrame, id_col: str, date: str = "date") -> DataFrame:
    """The id if there is exactly one, rows and distinct days."""
    ids = F.count_distinct(F.col(id_col))
    return df.agg(
        F.when(ids == 1, F.min(F.col(id_col).cast("string"))).alias("series_id"),
        F.count(F.lit(1)).alias("original_rows"),
        F.count_distinct(F.to_date(date)).alias("unique_dates"),
    ).withColumn("aggregated_rows", F.col("unique_dates"))
