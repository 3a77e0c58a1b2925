"""Reports: trends, shares, calendar bins, seasonal profiles, forecast figures, search and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday names, Monday first, and the labels of rising and other forecasts.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
RISING, OTHER = "hausse", "baisse"


def trend_line(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line and its fit."""
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def category_counts(df: DataFrame, col: str) -> DataFrame:
    total = df.agg(F.count(col)).scalar()
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / total).orderBy(F.col("n").desc(), col)


def group_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.sum(value).alias("total"), F.avg(value).alias("mean"), F.count(value).alias("n"))
        .orderBy(F.col("total").desc(), key)
    )


def bin_end(date: Column, every: str) -> Column:
    """The day a calendar bin is named after: the day, the week's Sunday, or the last day of the month."""
    if every == "D":
        return F.to_date(date)
    if every == "W":
        return F.date_add(F.to_date(F.date_trunc("week", date)), 6)
    if every == "M":
        return F.last_day(date)
    raise ValueError("every must be D, W or M")


def _bins(df: DataFrame, every: str, date: str) -> DataFrame:
    """All bins from the first to the last date; bounded by the calendar."""
    span = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    if every == "M":
        first, last = F.trunc("a", "month"), F.trunc("b", "month")
        months = span.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("m"))
        return months.select(F.last_day("m").alias("bin"))
    step = F.expr("interval 7 days" if every == "W" else "interval 1 day")
    return span.select(F.explode(F.sequence(bin_end(F.col("a"), every), bin_end(F.col("b"), every), step)).alias("bin"))


def resample(df: DataFrame, every: str, value: str = "value", date: str = "date") -> DataFrame:
    """Sum, mean and count per calendar bin; empty bins have sum 0, no mean and count 0."""
    x = F.col(value)
    found = df.groupBy(bin_end(F.col(date), every).alias("bin")).agg(
        F.sum(x).alias("total"), F.avg(x).alias("mean"), F.count(x).alias("n")
    )
    return (
        _bins(df, every, date)
        .join(found, "bin", "left")
        .select("bin", F.coalesce("total", F.lit(0.0)).alias("total"), "mean", F.coalesce("n", F.lit(0)).alias("n"))
    )


def resample_means(df: DataFrame, every: str, cols: Sequence[str], date: str = "date") -> DataFrame:
    found = df.groupBy(bin_end(F.col(date), every).alias("bin")).agg(*[F.avg(c).alias(c) for c in cols])
    return _bins(df, every, date).join(found, "bin", "left")


def weekday_profile(df: DataFrame, value: str = "value", date: str = "date") -> DataFrame:
    """Mean per weekday, all seven of them, Monday first."""
    means = df.groupBy(F.weekday(date).alias("_d")).agg(F.avg(value).alias("mean"))
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("dow"))
    joined = days.join(means, F.col("dow") == F.col("_d"), "left")
    return joined.select("dow", F.element_at(names, F.col("dow") + 1).alias("weekday"), "mean").orderBy("dow")


def month_profile(df: DataFrame, value: str = "value", date: str = "date") -> DataFrame:
    return df.groupBy(F.month(date).alias("month")).agg(F.avg(value).alias("mean")).orderBy("month")


def row_counts(df: DataFrame, by: str, date: str = "date") -> DataFrame:
    part = {"weekday": F.weekday, "month": F.month}[by]
    return df.groupBy(part(date).alias(by)).agg(F.count(F.lit(1)).alias("n")).orderBy(by)


def activity(df: DataFrame, value: str = "value", date: str = "date") -> DataFrame:
    """Sum per weekday and week of the year, every cell present; years fall together."""
    sums = df.groupBy(F.weekday(date).alias("_d"), F.weekofyear(date).alias("_w")).agg(F.sum(value).alias("_s"))
    cells = df.sparkSession.range(7 * 53).select(
        F.expr("cast(id div 53 as int)").alias("dow"), F.expr("cast(id % 53 + 1 as int)").alias("week")
    )
    joined = cells.join(sums, (F.col("dow") == F.col("_d")) & (F.col("week") == F.col("_w")), "left")
    return joined.select("dow", "week", F.coalesce("_s", F.lit(0.0)).alias("total"))


def activity_matrix(cells: DataFrame) -> DataFrame:
    """The activity as one row per weekday and one column per week."""
    return cells.groupBy("dow").pivot("week", list(range(1, 54))).agg(F.max("total")).fillna(0.0).orderBy("dow")


def forecast_figures(forecast: DataFrame, history: DataFrame, keys: Sequence[str], value: str = "value", date: str = "date"):
    """Per series: points, mean, extremes, change of the mean against the last observed value."""
    ahead = forecast.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("yhat").alias("mean"),
        F.min("yhat").alias("min"),
        F.max("yhat").alias("max"),
    )
    known = history.where(F.col(value).isNotNull())
    last = known.groupBy(*keys).agg(F.max_by(value, date).alias("last_value"))
    joined = ahead.join(last, list(keys), "left")
    change = F.when(F.col("last_value") != 0, (F.col("mean") - F.col("last_value")) / F.col("last_value") * 100)
    joined = joined.withColumn("change_pct", F.coalesce(change, F.lit(0.0)))
    return joined.withColumn("trend", F.when(F.col("change_pct") > 0, RISING).otherwise(OTHER))


def weekly_breakdown(forecast: DataFrame, keys: Sequence[str], more_than: int = 7) -> DataFrame:
    """Sum, mean and days per week, for series with more points than ``more_than``."""
    long = forecast.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than).drop("_n")
    kept = forecast.join(long, list(keys), "left_semi")
    return kept.groupBy(*keys, bin_end(F.col("ds"), "W").alias("week")).agg(
        F.sum("yhat").alias("total"), F.avg("yhat").alias("mean"), F.count(F.lit(1)).alias("days")
    )


def search_rows(df: DataFrame, term: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows in which any column contains the term, whatever the case."""
    hits = [F.contains(F.lower(F.col(c).cast("string")), F.lit(term.lower())) for c in (cols or df.columns)]
    any_hit = F.lit(False)
    for h in hits:
        any_hit = any_hit | F.coalesce(h, F.lit(False))
    return df.where(any_hit)


def sample_rows(df: DataFrame, key: str, rows: int = 500, seed: int = 42) -> DataFrame:
    """A repeatable sample: the rows with the smallest hash of their key."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(rows)


def incomplete_rows(df: DataFrame, original: Sequence[str] = ()) -> DataFrame:
    """How many rows have an unknown cell, and how many columns are new."""
    gap = F.lit(False)
    for c in df.columns:
        gap = gap | F.col(c).isNull()
    new = [c for c in df.columns if c not in set(original)]
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(gap).alias("incomplete"), F.lit(len(new)).alias("new_columns")
    )


def date_span(df: DataFrame, keys: Sequence[str] = (), value: str = "value", date: str = "date") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
        F.datediff(F.max(date), F.min(date)).alias("days"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
    )


def in_range(df: DataFrame, first: str | None = None, last: str | None = None, date: str = "date", **equal: str) -> DataFrame:
    """Rows of a date range and of the named groups."""
    if first:
        df = df.where(F.col(date) >= F.lit(first).cast("date"))
    if last:
        df = df.where(F.col(date) <= F.lit(last).cast("date"))
    for c, v in equal.items():
        df = df.where(F.col(c).cast("string") == v)
    return df
