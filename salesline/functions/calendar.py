"""Calendar features of a date column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_columns(date: Column) -> dict[str, Column]:
    weekday = F.weekday(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.day(date),
        "dayofweek": weekday,
        "is_weekend": F.when(weekday >= 5, 1).otherwise(0),
        "quarter": F.quarter(date),
        "week_of_year": F.weekofyear(date),
        "dayofyear": F.dayofyear(date),
        "day_of_month": F.day(date),
        "is_month_start": F.when(F.day(date) == 1, 1).otherwise(0),
        "is_month_end": F.when(F.to_date(date) == F.last_day(date), 1).otherwise(0),
    }


def _circle(name: str, x: Column, period: float, turns: int = 1, suffix: str = "") -> dict[str, Column]:
    angle = x * F.lit(2 * math.pi * turns) / F.lit(float(period))
    return {f"{name}_sin{suffix}": F.sin(angle), f"{name}_cos{suffix}": F.cos(angle)}


def cyclic_columns(date: Column) -> dict[str, Column]:
    out: dict[str, Column] = {}
    out |= _circle("month", F.month(date), 12)
    out |= _circle("dow", F.weekday(date), 7)
    out |= _circle("day_of_year", F.dayofyear(date), 365.25)
    out |= _circle("week", F.weekofyear(date), 52)
    return out


def fourier_columns(date: Column, harmonics: int = 2) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for k in range(1, harmonics + 1):
        out |= _circle("fourier_yearly", F.dayofyear(date), 365.25, k, f"_{k}")
    return out


def add_time_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    date = F.col(date_col)
    return df.withColumns({**calendar_columns(date), **cyclic_columns(date), **fourier_columns(date)})


def add_holiday_flag(df: DataFrame, holidays: DataFrame, date_col: str = "date") -> DataFrame:
    """``is_holiday`` from a table of holiday dates."""
    # Distinct days: the calendar bounds the table.
    days = holidays.select(F.to_date(date_col).alias("_day")).where("_day is not null").distinct()
    joined = df.join(F.broadcast(days), F.to_date(date_col) == F.col("_day"), "left")
    return joined.withColumn("is_holiday", F.col("_day").isNotNull().cast("int")).drop("_day")
