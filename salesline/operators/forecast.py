"""Forecasts for many series in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesline.functions.calendar import add_time_features
from salesline.operators.features import Encoders, encoded
from salesline.operators.windows import (
    LAGS, WINDOWS, add_crosses, add_lag_interactions, add_lag_ratios, array_rolling_columns, min_rows,
)
from salesline.session import cut_lineage

# Blend of the weekday factor, and history the factors need.
SEASONAL_STRENGTH = 0.7
SEASONAL_MIN_ROWS = 14


def check_horizon(horizon: int, most: int | None = None) -> None:
    """Refuse a horizon below 1, or above a limit if one is given."""
    if horizon < 1 or most is not None and horizon > most:
        raise ValueError(f"the horizon must be at least 1{'' if most is None else f' and at most {most}'}")


def future_dates(last: DataFrame, horizon: int, last_col: str = "last_date", name: str = "ds") -> DataFrame:
    """``horizon`` rows per row: the days after the last date."""
    check_horizon(horizon)
    days = F.sequence(F.date_add(last_col, 1), F.date_add(last_col, horizon))
    return last.withColumn(name, F.explode(days))


def last_values(df: DataFrame, keys: Sequence[str], value: str = "value", date: str = "date", base: str = "row") -> DataFrame:
    """Last known value of each series, and the date to count from: of the last row, or
    (``base="value"``) of the last known value."""
    known = F.when(F.col(value).isNotNull(), F.col(date))
    return df.groupBy(*keys).agg(
        F.max_by(value, known).alias("last_value"),
        F.max(known if base == "value" else F.col(date)).alias("last_date"),
    )


def naive_forecast(
    df: DataFrame, keys: Sequence[str], horizon: int, value: str = "value", date: str = "date", base: str = "row"
) -> DataFrame:
    """Repeat the last known value; series without one give no rows."""
    last = last_values(df, keys, value, date, base).where("last_value is not null")
    return future_dates(last, horizon).select(*keys, "ds", F.col("last_value").alias("yhat"))


def weekly_factors(df: DataFrame, keys: Sequence[str], value: str = "value", date: str = "date") -> DataFrame:
    """Mean of each weekday over the mean of the series; weekdays never seen get 1.

    Only series with two weeks of known values and a mean other than 0 have factors.
    """
    known = df.where(F.col(value).isNotNull())
    by_day = known.groupBy(*keys, F.weekday(date).alias("dow")).agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    # At most seven rows per series from here on.
    per_series = by_day.groupBy(*keys).agg(
        F.sum("_s").alias("_sum"),
        F.sum("_n").alias("_rows"),
        F.map_from_entries(F.collect_list(F.struct("dow", (F.col("_s") / F.col("_n")).alias("m")))).alias("_means"),
    )
    usable = per_series.where((F.col("_rows") >= SEASONAL_MIN_ROWS) & (F.col("_sum") != 0))
    mean = F.col("_sum") / F.col("_rows")
    return usable.select(*keys, "_means", mean.alias("_mean"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("dow")).select(
        *keys, "dow", F.coalesce(F.try_element_at("_means", F.col("dow")) / F.col("_mean"), F.lit(1.0)).alias("factor")
    )


def blend(yhat: Column, factor: Column, strength: float = 0.5) -> Column:
    """Move the forecast towards the weekday level; without a factor it stays as it is."""
    return yhat * (1 + F.lit(float(strength)) * (F.coalesce(factor, F.lit(1.0)) - 1))


def add_seasonality(
    forecast: DataFrame,
    factors: DataFrame,
    keys: Sequence[str],
    strength: float = 0.5,
    date: str = "ds",
    yhat: str = "yhat",
) -> DataFrame:
    dim = factors.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("dow").alias("_dow"), "factor")
    cond = F.weekday(date) == F.col("_dow")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_k_{k}"))
    joined = forecast.join(dim, cond, "left").withColumn(yhat, blend(F.col(yhat), F.col("factor"), strength))
    return joined.select(*forecast.columns)


@dataclass(frozen=True)
class PostProcessing:
    """How a raw score becomes a forecast."""

    log1p: bool = False
    bias: float = 0.0
    bias_in_log: bool = False
    floor: float = 0.0
    shift: float = 0.0
    strength: float = SEASONAL_STRENGTH

    def original(self, raw: Column) -> Column:
        """The score in the original scale, before the bias if that is meant in this scale."""
        if not self.log1p:
            return raw
        return F.expm1(raw + self.bias if self.bias_in_log else raw) - self.shift

    def corrected(self, raw: Column) -> Column:
        return self.original(raw) if self.log1p and self.bias_in_log else self.original(raw) + self.bias

    def bounded(self, yhat: Column) -> Column:
        return F.greatest(yhat, F.lit(float(self.lowest)))

    @property
    def lowest(self) -> float:
        return self.floor if self.floor > 0 else 0.0

    def seasonal(self, yhat: Column, factor: Column) -> Column:
        return F.greatest(blend(yhat, factor, self.strength), F.lit(0.0))


def usable_score(raw: Column, last_value: Column, lags: Sequence[Column] = ()) -> Column:
    """The score, or the last value if it is not finite or half of the lags are unknown."""
    finite = raw.isNotNull() & ~F.isnan(raw) & (F.abs(raw) != float("inf"))
    if lags:
        unknown = sum((c.isNull().cast("int") for c in lags), F.lit(0))
        finite = finite & (unknown < len(lags) // 2)
    return F.when(finite, raw).otherwise(last_value)


def history_warning(
    df: DataFrame, keys: Sequence[str], lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Which series have less history than the longest lag and window need."""
    need = max(lags) + max(windows)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(need).alias("needed"),
        (F.count(F.lit(1)) < need).alias("short_history"),
    )


def regularize(df: DataFrame, keys: Sequence[str], value: str = "value", date: str = "date") -> DataFrame:
    """One row per day from first to last: the mean of the day, gaps filled on a straight line."""
    daily = df.groupBy(*keys, F.to_date(date).alias(date)).agg(F.avg(value).alias(value))
    # One row per day, so the calendar bounds each series.
    span = daily.groupBy(*keys).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    spine = span.select(*keys, F.explode(F.sequence("_a", "_b")).alias(date))
    rows = spine.join(daily, [*keys, date], "left")
    w = Window.partitionBy(*([F.col(k) for k in keys] or [F.lit(0)])).orderBy(date)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.col(date))
    rows = rows.withColumns(
        {
            "_v0": F.last(value, ignorenulls=True).over(back),
            "_d0": F.last(known, ignorenulls=True).over(back),
            "_v1": F.first(value, ignorenulls=True).over(ahead),
            "_d1": F.first(known, ignorenulls=True).over(ahead),
        }
    )
    part = F.try_divide(F.datediff(date, "_d0"), F.datediff("_d1", "_d0"))
    line = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * part
    return rows.select(*keys, date, F.coalesce(F.col(value), line, F.col("_v0")).alias(value))


# --------------------------------------------------------------------------------- recursive forecast


def series_state(
    df: DataFrame,
    keys: Sequence[str],
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    value: str = "value",
    date: str = "date",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per series: the last values it needs (newest first), running weighted sums, row count,
    last date, last known value, and the last value of the carried columns.

    The input has one row per day and series.
    """
    keep = max(*lags, *windows)
    newest = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    rows = df.withColumn("_age", F.row_number().over(newest) - 1)
    x = F.col(value).cast("double")
    sums = []
    for s in windows:
        weight = F.pow(F.lit(1 - 2 / (s + 1)), F.col("_age"))
        sums += [
            F.coalesce(F.sum(x * weight), F.lit(0.0)).alias(f"_num_{s}"),
            F.coalesce(F.sum(F.when(x.isNotNull(), weight)), F.lit(0.0)).alias(f"_den_{s}"),
        ]
    recent = F.collect_list(F.when(F.col("_age") < keep, F.struct("_age", x.alias("x"))))
    return rows.groupBy(*keys).agg(
        F.transform(F.array_sort(recent), lambda p: p.x).alias("_tail"),
        F.count(value).alias("_known"),
        F.to_date(F.max(date)).alias("_last_date"),
        F.max_by(x, F.when(x.isNotNull(), F.col(date))).alias("_last_value"),
        *sums,
        *[F.max_by(c, date).alias(c) for c in carry],
    )


STEP = "ds: date, step: int, yhat: double, raw_model: double, pred_orig: double, corrected: double, before_seasonality: double, dow: int"


@dataclass(frozen=True)
class StateFeatures:
    """The features of the next day, or (``observed_row``) of the last observed one, from a state row.

    Names and rules are those of the training table: the calendar, the combinations of lags and windows, the crosses and
    the encodings come from the functions that build it, the rolling statistics from the same rules over an array.
    """

    lags: Sequence[int]
    windows: Sequence[int]
    keys: Sequence[str] = ()
    encoders: Encoders | None = None
    observed_row: bool = False

    def add(self, state: DataFrame) -> DataFrame:
        tail, known, day = F.col("_tail"), F.col("_known"), F.date_add("_last_date", 1)
        newest = F.get(tail, F.lit(0))
        if self.observed_row:
            known, day = known - newest.isNotNull().cast("long"), F.col("_last_date")
            tail = F.slice(tail, F.lit(2), F.greatest(F.size(tail) - 1, F.lit(0)))
        recent = {f"_recent_{s}": F.filter(F.slice(tail, 1, s), lambda v: v.isNotNull()) for s in self.windows}
        out = state.withColumns({"date": day, "on_promo": F.lit(0), "_before": tail, "_seen": known, **recent})
        found = {f"lag_{k}": F.get(F.col("_before"), F.lit(k - 1)) for k in self.lags}
        found |= array_rolling_columns({s: F.col(f"_recent_{s}") for s in self.windows})
        for s in self.windows:
            num, den = F.col(f"_num_{s}"), F.col(f"_den_{s}")
            if self.observed_row:
                rate = 1 - 2 / (s + 1)
                num = (num - F.coalesce(newest, F.lit(0.0))) / rate
                den = (den - newest.isNotNull().cast("double")) / rate
            found[f"ewma_{s}"] = F.when((F.col("_seen") >= min_rows(s)) & (den > 0), num / den)
        out = add_time_features(out.withColumns(found), "date")
        out = add_crosses(add_lag_ratios(add_lag_interactions(out, self.windows)))
        if self.encoders is None:
            return out
        texts = [k for k in self.keys if k in self.encoders.means]
        return encoded(out, self.encoders, texts, [c for c in self.encoders.labels if c in out.columns])


def recursive_forecast(
    df: DataFrame,
    keys: Sequence[str],
    horizon: int,
    model,
    features: Sequence[str],
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    post: PostProcessing = PostProcessing(),
    carry: Sequence[str] = (),
    encoders: Encoders | None = None,
    seasonal: bool = True,
    observed_row: bool = False,
    errors: bool = False,
    prediction: str = "yhat",
) -> DataFrame:
    """Forecast day by day, each step using the forecasts before it; all series advance together.

    Spark reduces every series to one state row. A step derives the features of the day from the state, lets ``model``
    score them with its own ``transform``, corrects the score and puts it into the state; nothing is shuffled, and the
    state is stored after each step. A feature that the state cannot give raises an error; unknown cells are scored as 0.
    ``carry`` names columns whose last value is a feature; ``on_promo`` is always 0. ``encoders`` of a feature table give
    codes and target means as in training. ``observed_row=True`` scores the features of the last observed day instead of
    those of the day to forecast.

    Each step comes with its stages: the raw score, the score in the original scale (for a log target), the corrected
    score, the forecast before seasonality and the weekday (for series with weekly factors). Stages are null where half of
    the lags were unknown, so that no score counted. Series without a known value give no rows, or, with ``errors``, one
    row each that tells why.
    """
    check_horizon(horizon)
    spark = df.sparkSession
    names = [f"_key_{i}" for i in range(len(keys))]
    state = series_state(df, keys, (*lags, max(*lags, *windows) + 1), windows, carry=carry)
    if seasonal:
        by_day = F.array(*[F.max(F.when(F.col("dow") == d, F.col("factor"))) for d in range(7)])
        factors = weekly_factors(df, keys).groupBy(*keys).agg(by_day.alias("_factors"))
        state = state.join(factors, list(keys), "left")
    else:
        state = state.withColumn("_factors", F.lit(None).cast("array<double>"))
    state = state.withColumns({n: F.col(k) for n, k in zip(names, keys)} | {"_steps": F.array().cast(f"array<struct<{STEP}>>")})
    state = cut_lineage(state.repartition(spark.sparkContext.defaultParallelism, *keys))
    ready = state.where("_last_value is not null")
    maker = StateFeatures(lags, windows, keys, encoders, observed_row)
    for step in range(1, horizon + 1):
        ready = _advance(ready, maker, model, features, windows, post, prediction, step)
        if step < horizon:  # features name the state many times over, so that plans of several steps would explode
            ready = cut_lineage(ready)
    steps = ready.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], F.explode("_steps").alias("s")).select(*keys, "s.*")
    if not errors:
        return steps
    failed = state.where("_last_value is null").select(*keys, F.lit("no_values").alias("error"))
    return steps.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


def _advance(state: DataFrame, maker: StateFeatures, model, features: Sequence[str], windows: Sequence[int], post: PostProcessing, prediction: str, step: int) -> DataFrame:
    """The state one day later, with what the day was forecast."""
    kept = [c for c in state.columns if c not in maker.keys]  # the keys may have become codes
    rows = maker.add(state)
    lost = sorted(set(features) - set(rows.columns))
    if lost:
        raise ValueError(f"the state has no features {lost}")
    cells = [c for c in rows.columns if c.startswith("lag_")]
    unknown = sum((F.col(c).isNull().cast("int") for c in cells), F.lit(0))
    inputs = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in features]
    names = {c: f"_keep_{c}" if c in features else c for c in kept}
    enough = (unknown < len(cells) // 2).alias("_enough")
    scored = model.transform(rows.select(*[F.col(c).alias(n) for c, n in names.items()], enough, *inputs))
    raw = F.when(F.col("_enough"), F.col(prediction).cast("double"))
    out = scored.select(*[F.col(n).alias(c) for c, n in names.items()], raw.alias("_raw"))
    out = out.withColumns({"_orig": post.original(F.col("_raw")), "_corrected": post.corrected(F.col("_raw")), "_ds": F.date_add("_last_date", 1)})
    out = out.withColumn("_flat", post.bounded(usable_score(F.col("_corrected"), F.col("_last_value"))))
    factor = F.get(F.col("_factors"), F.weekday("_ds"))
    out = out.withColumn("_yhat", F.when(factor.isNull(), F.col("_flat")).otherwise(post.seasonal(F.col("_flat"), factor)))
    stages = [F.col("_ds").alias("ds"), F.lit(step).alias("step"), F.round("_yhat", 2).alias("yhat"), F.round("_raw", 6).alias("raw_model")]
    stages += [(F.round("_orig", 6) if post.log1p else F.lit(None).cast("double")).alias("pred_orig"), F.round("_corrected", 6).alias("corrected")]
    stages += [F.when(factor.isNotNull(), F.round("_flat", 2)).alias("before_seasonality"), F.when(factor.isNotNull(), F.weekday("_ds")).alias("dow")]
    keep = max(*maker.lags, *maker.windows) + 1
    later = {
        "_tail": F.slice(F.concat(F.array("_yhat"), "_tail"), 1, keep),
        "_known": F.col("_known") + 1,
        "_last_date": F.col("_ds"),
        "_steps": F.concat("_steps", F.array(F.struct(*stages))),
    }
    for s in windows:
        rate = 1 - 2 / (s + 1)
        later |= {f"_num_{s}": F.col(f"_num_{s}") * rate + F.col("_yhat"), f"_den_{s}": F.col(f"_den_{s}") * rate + 1}
    keys = [F.col(f"_key_{i}").alias(k) for i, k in enumerate(maker.keys)]
    return out.withColumns(later).select(*keys, *kept)


def forecast_errors(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Series that cannot be forecast, with the reason; all others still get their forecast."""
    return (
        df.groupBy(*keys)
        .agg(F.count(value).alias("_known"))
        .where("_known = 0")
        .select(*keys, F.lit("no_values").alias("error"))
    )
