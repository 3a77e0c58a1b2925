"""Calendar, lag, rolling and exponentially weighted features (E, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesline.functions.calendar import (
    add_holiday_flag, add_time_features, calendar_columns, cyclic_columns, fourier_columns,
)
from salesline.operators import ewma, windows
from salesline.operators.ordering import Series
from salesline.plans.views import DAILY_SQL, LINE_SQL, TOTAL_SQL, sales_daily, sales_line, sales_total_daily, table
from salesline.registry import query, rounded

KEY = ["store_id", "product_id", "date"]
W_SQL = "WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date)"
PI2 = "6.283185307179586"


def _lags_sql(lags) -> str:
    return ", ".join(f"lag(value, {k}) OVER w AS lag_{k}" for k in lags)


def rolling_sql(sizes, names=("mean", "std", "min", "max"), digits: int | None = None) -> str:
    """Rolling columns, each over its own frame."""
    fn = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    out = []
    for s in sizes:
        frame = f"(PARTITION BY store_id, product_id ORDER BY date ROWS BETWEEN {s} PRECEDING AND 1 PRECEDING)"
        for n in names:
            e = f"CASE WHEN count(value) OVER {frame} >= {max(s // 2, 3)} THEN {fn[n]}(value) OVER {frame} END"
            e = f"coalesce({e}, 0)" if n == "std" else e
            e = f"round({e}, {digits})" if digits is not None else e
            out.append(f"{e} AS roll_{n}_{s}")
    return ", ".join(out)


@query(
    "entry_features",
    f"WITH {DAILY_SQL} SELECT store_id, product_id, date, value, lag(value, 1) OVER w AS lag_1, "
    f"lag(value, 7) OVER w AS lag_7, {rolling_sql([7], ('mean',), 6)}, {rolling_sql([7], ('std',), 3)} FROM sales_daily {W_SQL}",
)
def entry_features(spark, sf):
    df = windows.add_rolling(windows.add_lags(sales_daily(spark, sf), lags=(1, 7)), windows=(7,))
    return rounded(
        df.select(*KEY, "value", "lag_1", "lag_7", "roll_mean_7", "roll_std_7"), {"roll_mean_7": 6, "roll_std_7": 3}
    )


@query(
    "e1_e4_calendar",
    f"""WITH {LINE_SQL} SELECT rid, year(date) AS year, month(date) AS month, day(date) AS day,
    isodow(date) - 1 AS dayofweek, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    quarter(date) AS quarter, week(date) AS week_of_year, dayofyear(date) AS dayofyear, day(date) AS day_of_month,
    CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start,
    CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end FROM sales_line""",
)
def calendar(spark, sf):
    return sales_line(spark, sf).select("rid", *[c.alias(n) for n, c in calendar_columns(F.col("date")).items()])


@query(
    "e5_cyclic",
    f"""WITH {LINE_SQL} SELECT rid,
    round(sin(month(date) * {PI2} / 12), 9) AS month_sin, round(cos(month(date) * {PI2} / 12), 9) AS month_cos,
    round(sin((isodow(date) - 1) * {PI2} / 7), 9) AS dow_sin, round(cos((isodow(date) - 1) * {PI2} / 7), 9) AS dow_cos,
    round(sin(dayofyear(date) * {PI2} / 365.25), 9) AS day_of_year_sin,
    round(cos(dayofyear(date) * {PI2} / 365.25), 9) AS day_of_year_cos,
    round(sin(week(date) * {PI2} / 52), 9) AS week_sin, round(cos(week(date) * {PI2} / 52), 9) AS week_cos
    FROM sales_line""",
)
def cyclic(spark, sf):
    cols = cyclic_columns(F.col("date"))
    return sales_line(spark, sf).select("rid", *[(F.round(c, 9) + 0.0).alias(n) for n, c in cols.items()])


@query(
    "e6_fourier",
    f"WITH {LINE_SQL} SELECT rid, "
    + ", ".join(
        f"round({f}(dayofyear(date) * {float(PI2) * k!r} / 365.25), 9) AS fourier_yearly_{f}_{k}"
        for k in (1, 2)
        for f in ("sin", "cos")
    )
    + " FROM sales_line",
)
def fourier(spark, sf):
    cols = fourier_columns(F.col("date"))
    return sales_line(spark, sf).select("rid", *[F.round(c, 9).alias(n) for n, c in cols.items()])


@query(
    "e7_holiday_flag",
    f"""WITH {LINE_SQL} SELECT rid, date, CASE WHEN date IN (SELECT cast(o_orderdate AS date) FROM orders
    WHERE day(o_orderdate) = 1) THEN 1 ELSE 0 END AS is_holiday FROM sales_line""",
)
def holiday(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).where(F.day("date") == 1)
    return add_holiday_flag(sales_line(spark, sf), days).select("rid", "date", "is_holiday")


@query("f1_lags", f"WITH {DAILY_SQL} SELECT store_id, product_id, date, {_lags_sql(windows.LAGS)} FROM sales_daily {W_SQL}")
def lags(spark, sf):
    return windows.add_lags(sales_daily(spark, sf)).select(*KEY, *[f"lag_{k}" for k in windows.LAGS])


@query(
    "f1_lags_null_keys",
    f"""WITH {DAILY_SQL}, keyed AS (SELECT CASE WHEN store_id = 'S003' THEN NULL ELSE store_id END AS store_id,
    product_id, date, value, store_id AS shop FROM sales_daily)
    SELECT store_id, shop, product_id, date,
    CASE WHEN store_id IS NOT NULL THEN lag(value, 1) OVER (PARTITION BY store_id, product_id ORDER BY date, shop) END
    AS lag_1 FROM keyed""",
)
def lags_null_keys(spark, sf):
    keyed = sales_daily(spark, sf).withColumn("shop", F.col("store_id"))
    keyed = keyed.withColumn("store_id", F.when(F.col("shop") != "S003", F.col("shop")))
    out = windows.add_lags(keyed, lags=(1,), series=Series(order=("date", "shop"), daily=False))
    return out.select("store_id", "shop", "product_id", "date", "lag_1")


@query(
    "f2_ungrouped_lag",
    f"WITH {LINE_SQL} SELECT rid, date, lag(value, 1) OVER w AS lag_1, lag(value, 7) OVER w AS lag_7 "
    "FROM sales_line WINDOW w AS (ORDER BY date, rid)",
)
def ungrouped_lag(spark, sf):
    rows = sales_line(spark, sf).select("rid", "date", "value")
    out = windows.add_lags(rows, lags=(1, 7), series=Series((), ("date", "rid"), daily=False))
    return out.select("rid", "date", "lag_1", "lag_7")


for _name, _stat, _digits in (("f3_roll_mean", "mean", 6), ("f4_roll_std", "std", 3)):

    def _rolling(spark, sf, stat=_stat, digits=_digits):
        cols = [f"roll_{stat}_{w}" for w in windows.WINDOWS]
        return rounded(windows.add_rolling(sales_daily(spark, sf)).select(*KEY, *cols), dict.fromkeys(cols, digits))

    query(
        _name,
        f"WITH {DAILY_SQL} SELECT store_id, product_id, date, {rolling_sql(windows.WINDOWS, (_stat,), _digits)} FROM sales_daily",
    )(_rolling)


@query(
    "f5_roll_min_max",
    f"WITH {DAILY_SQL} SELECT store_id, product_id, date, {rolling_sql(windows.WINDOWS, ('min', 'max'))} FROM sales_daily",
)
def roll_min_max(spark, sf):
    cols = [f"roll_{s}_{w}" for w in windows.WINDOWS for s in ("min", "max")]
    return windows.add_rolling(sales_daily(spark, sf)).select(*KEY, *cols)


@query(
    "f5_roll_lines",
    f"""WITH {LINE_SQL} SELECT rid, CASE WHEN count(value) OVER w >= 3 THEN round(avg(value) OVER w, 6) END AS roll_mean_7,
    CASE WHEN count(value) OVER w >= 3 THEN max(value) OVER w END AS roll_max_7 FROM sales_line
    WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date, rid ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
)
def roll_lines(spark, sf):
    """Rolling features over all sold lines, whose series have no bound."""
    rows = sales_line(spark, sf).select("rid", *KEY, "value")
    out = windows.add_rolling(rows, windows=(7,), series=Series(order=("date", "rid"), daily=False))
    return rounded(out.select("rid", "roll_mean_7", "roll_max_7"), {"roll_mean_7": 6})


def ewma_sql(span: int, source: str = "sales_daily", keys: str = "store_id, product_id", order: str = "date") -> str:
    """Weights written out as powers, each row joined with its predecessors in reach."""
    rate, need = 1 - 2 / (span + 1), max(span // 2, 3)
    reach = ewma.block_rows(span) * 2
    key, ord_ = ([k.strip() for k in x.split(",")] for x in (keys, order))
    cols = ", ".join(f"a.{c}" for c in key + ord_)
    on = " AND ".join(f"a.{k} = b.{k}" for k in key)
    return f"""numbered_{span} AS (SELECT {keys}, {order}, value, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS t
      FROM {source}),
    ewma_{span} AS (SELECT {cols},
      CASE WHEN a.t - 1 >= {need} THEN sum(b.value * pow({rate!r}, a.t - b.t)) / sum(pow({rate!r}, a.t - b.t)) END AS ewma_{span}
      FROM numbered_{span} a LEFT JOIN numbered_{span} b ON {on} AND b.t < a.t AND b.t >= a.t - {reach}
      GROUP BY {cols}, a.t)"""


@query(
    "f7_ewma",
    f"WITH {DAILY_SQL}, {ewma_sql(7)}, {ewma_sql(14)}, {ewma_sql(28)} SELECT store_id, product_id, date, "
    "round(ewma_7, 3) AS ewma_7, round(ewma_14, 3) AS ewma_14, round(ewma_28, 3) AS ewma_28 FROM ewma_7 "
    "JOIN ewma_14 USING (store_id, product_id, date) JOIN ewma_28 USING (store_id, product_id, date)",
)
def ewma_features(spark, sf):
    cols = [f"ewma_{s}" for s in windows.WINDOWS]
    return rounded(ewma.add_ewma(sales_daily(spark, sf)).select(*KEY, *cols), dict.fromkeys(cols, 3))


@query(
    "f8_f11_interactions",
    f"""WITH {DAILY_SQL}, f AS (SELECT store_id, product_id, date, value, {_lags_sql((1, 7, 14))},
    {rolling_sql(windows.WINDOWS)} FROM sales_daily {W_SQL})
    SELECT store_id, product_id, date, round(lag_1 - lag_7, 2) AS lag_diff_1_7, round(lag_7 - lag_14, 2) AS lag_diff_7_14,
    round(lag_1 - lag_14, 2) AS lag_diff_1_14, round(lag_1 / nullif(lag_7, 0), 6) AS lag_ratio_1_7, """
    + ", ".join(
        f"round(least(greatest(coalesce(roll_std_{w} / nullif(roll_mean_{w}, 0), 0), -10), 10), 6) AS roll_cv_{w}, "
        f"round(roll_max_{w} - roll_min_{w}, 2) AS roll_range_{w}"
        for w in windows.WINDOWS
    )
    + " FROM f",
)
def interactions(spark, sf):
    df = windows.add_rolling(windows.add_lags(sales_daily(spark, sf), lags=(1, 7, 14)))
    digits = {"lag_diff_1_7": 2, "lag_diff_7_14": 2, "lag_diff_1_14": 2, "lag_ratio_1_7": 6}
    digits |= {f"roll_cv_{w}": 6 for w in windows.WINDOWS} | {f"roll_range_{w}": 2 for w in windows.WINDOWS}
    return rounded(windows.add_lag_interactions(df).select(*KEY, *digits), digits)


@query(
    "f12_lag_ratios",
    f"""WITH {DAILY_SQL}, f AS (SELECT store_id, product_id, date, {_lags_sql((7, 14))} FROM sales_daily {W_SQL})
    SELECT store_id, product_id, date, round(lag_7 / (nullif(lag_14, 0) + 1e-9), 6) AS ratio_lag7_lag14,
    round(lag_7 - lag_14, 2) AS diff_lag7_lag14 FROM f""",
)
def lag_ratios(spark, sf):
    df = windows.add_lag_ratios(windows.add_lags(sales_daily(spark, sf), lags=(7, 14)))
    return rounded(df.select(*KEY, "ratio_lag7_lag14", "diff_lag7_lag14"), {"ratio_lag7_lag14": 6, "diff_lag7_lag14": 2})


@query(
    "f13_store_ewma",
    f"WITH {DAILY_SQL}, {ewma_sql(7, 'sales_daily', 'store_id', 'product_id, date')} "
    "SELECT store_id, product_id, date, round(ewma_7, 3) AS ewma_7 FROM ewma_7",
)
def store_ewma(spark, sf):
    df = sales_daily(spark, sf).select(*KEY, "value")
    return rounded(ewma.add_store_ewma(df).select(*KEY, "ewma_7"), {"ewma_7": 3})


@query(
    "f14_crosses",
    f"""WITH {LINE_SQL} SELECT rid, store_id || '_' || (isodow(date) - 1) AS store_dayofweek,
    month(date) || '_' || store_id AS month_store FROM sales_line""",
)
def crosses(spark, sf):
    return windows.add_crosses(add_time_features(sales_line(spark, sf))).select("rid", "store_dayofweek", "month_store")


@query(
    "f15_daily_diff",
    f"WITH {TOTAL_SQL} SELECT date, round(value - lag(value) OVER (ORDER BY date), 2) AS diff FROM sales_total_daily",
)
def daily_diff(spark, sf):
    out = windows.add_diff(sales_total_daily(spark, sf), series=Series(()))
    return rounded(out.select("date", "diff"), {"diff": 2})


@query(
    "f16_moving_average",
    f"""WITH {TOTAL_SQL} SELECT date, round(avg(value) OVER (ORDER BY date ROWS 6 PRECEDING), 6) AS ma_7,
    round(avg(value) OVER (ORDER BY date ROWS 29 PRECEDING), 6) AS ma_30 FROM sales_total_daily""",
)
def moving_average(spark, sf):
    out = windows.add_moving_average(windows.add_moving_average(sales_total_daily(spark, sf)), size=30)
    return rounded(out.select("date", "ma_7", "ma_30"), {"ma_7": 6, "ma_30": 6})


@query(
    "f17_cumulative_sum",
    f"WITH {LINE_SQL} SELECT rid, date, sum(cents) OVER (ORDER BY date, rid)::bigint AS cumulative FROM sales_line",
)
def cumulative_sum(spark, sf):
    rows = sales_line(spark, sf).select("rid", "date", "cents")
    return windows.add_cumulative_sum(rows, "cents", Series((), ("date", "rid"), daily=False)).drop("cents")
