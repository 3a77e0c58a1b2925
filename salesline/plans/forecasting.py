"""Forecasts (I)."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from salesline.operators import features, forecast, windows
from salesline.plans.datasets import PAIRS_SQL, forecast_pairs
from salesline.plans.features import KEY
from salesline.plans.views import DAILY_SQL, DIRTY_SQL, EVENTS_SQL, dirty_sales, events_daily, sales_daily, table
from salesline.registry import query, rounded

SERIES = ["store_id", "product_id"]

# Daily sales of which some days are unknown, among them the last day of some series.
GAPPY_SQL = DAILY_SQL + """,
gappy AS (SELECT store_id, product_id, date, CASE WHEN (cents + row_number() OVER (PARTITION BY store_id, product_id
  ORDER BY date DESC)) % 3 <> 0 THEN value END AS value FROM sales_daily)"""


def gappy(spark, sf):
    from pyspark.sql import Window

    newest = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("date").desc()))
    value = F.when((F.col("cents") + newest) % 3 != 0, F.col("value"))
    return sales_daily(spark, sf).select(*KEY, value.alias("value"))


def _naive_sql(base: str) -> str:
    return f"""WITH {GAPPY_SQL}, l AS (SELECT store_id, product_id, arg_max(value, date) FILTER (value IS NOT NULL) AS yhat,
      {base} AS base FROM gappy GROUP BY store_id, product_id)
    SELECT store_id, product_id, cast(base + to_days(i::int) AS date) AS ds, yhat FROM l, range(1, 15) r(i) WHERE yhat IS NOT NULL"""


@query("i1_naive_from_last_row", _naive_sql("max(date)"))
def naive_row(spark, sf):
    return forecast.naive_forecast(gappy(spark, sf), SERIES, 14)


@query("i1_naive_from_last_value", _naive_sql("max(date) FILTER (value IS NOT NULL)"))
def naive_value(spark, sf):
    return forecast.naive_forecast(gappy(spark, sf), SERIES, 14, base="value")


def factors_sql(source: str = "gappy") -> str:
    return f"""overall AS (SELECT store_id, product_id, sum(value) / count(*) AS m FROM {source} WHERE value IS NOT NULL
      GROUP BY ALL HAVING count(*) >= 14 AND sum(value) <> 0),
    dows AS (SELECT store_id, product_id, isodow(date) - 1 AS dow, sum(value) / count(*) AS dm FROM {source}
      WHERE value IS NOT NULL GROUP BY ALL),
    factors AS (SELECT o.store_id, o.product_id, r.i::int AS dow, coalesce(dm / m, 1.0) AS factor FROM overall o
      CROSS JOIN range(7) r(i) LEFT JOIN dows d ON d.store_id = o.store_id AND d.product_id = o.product_id AND d.dow = r.i)"""


@query(
    "i2_weekly_factors",
    f"WITH {GAPPY_SQL}, {factors_sql()} SELECT store_id, product_id, dow, round(factor, 9) AS factor FROM factors",
)
def weekly_factors(spark, sf):
    return rounded(forecast.weekly_factors(gappy(spark, sf), SERIES), {"factor": 9})


@query(
    "i2_weekly_factors_short",
    f"""WITH {EVENTS_SQL}, o AS (SELECT user_id, sum(value) / count(*) AS m FROM events_daily GROUP BY ALL
      HAVING count(*) >= 14 AND sum(value) <> 0),
    d AS (SELECT user_id, isodow(date) - 1 AS dow, sum(value) / count(*) AS dm FROM events_daily GROUP BY ALL)
    SELECT o.user_id, r.i::int AS dow, round(coalesce(dm / m, 1.0), 9) AS factor FROM o CROSS JOIN range(7) r(i)
    LEFT JOIN d ON d.user_id = o.user_id AND d.dow = r.i""",
)
def weekly_factors_short(spark, sf):
    return rounded(forecast.weekly_factors(events_daily(spark, sf), ["user_id"]), {"factor": 9})


@query(
    "i3_seasonal_blend",
    f"""WITH {PAIRS_SQL}, {factors_sql('sales_daily')} SELECT p.store_id, p.product_id, p.date,
    round(yhat * (1 + 0.7::double * (factor - 1)), 4) AS yhat FROM forecast_pairs p LEFT JOIN factors f
    ON f.store_id = p.store_id AND f.product_id = p.product_id AND f.dow = isodow(p.date) - 1""",
)
def seasonal_blend(spark, sf):
    factors = forecast.weekly_factors(sales_daily(spark, sf), SERIES)
    rows = forecast_pairs(spark, sf).select(*KEY, "yhat")
    out = forecast.add_seasonality(rows, factors, SERIES, strength=0.7, date="date")
    return rounded(out, {"yhat": 4})


def fixed_model(formula: str) -> SQLTransformer:
    """A model that scores features by a formula, with the transform of a fitted one."""
    return SQLTransformer(statement=f"SELECT *, {formula} AS yhat FROM __THIS__")


WEIGHTED = ["lag_7", "roll_mean_7", "ewma_14"]
WEIGHTED_FORMULA = "lag_7 * 0.5D + roll_mean_7 * 0.3D + ewma_14 * 0.2D"


def recursion_sql(raw: str, horizon: int, source: str = "sales_daily", bias: float = 0.0, more: str = "", joins: str = "") -> str:
    """Forecasts ``r`` day by day: ``raw`` is the score of a state ``s``, whose tail holds the newest value first."""
    return f"""{factors_sql(source)},
    weekly AS (SELECT store_id, product_id, list(factor ORDER BY dow) AS f FROM factors GROUP BY ALL),
    aged AS (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) - 1 AS age FROM {source}),
    start AS (SELECT store_id, product_id, list(value ORDER BY age) FILTER (age < 29) AS tail, max(date) AS last,
      sum(value * (1 - 2 / 15::double) ** age) AS num, sum((1 - 2 / 15::double) ** age) AS den{more} FROM aged
      GROUP BY store_id, product_id HAVING count(value) > 0),
    s0 AS (SELECT start.*, f FROM start LEFT JOIN weekly USING (store_id, product_id)),
    r AS (
      SELECT *, 0 AS step, 0::double AS raw, 0::double AS flat, 0::double AS yhat, last AS ds FROM s0
      UNION ALL
      SELECT * REPLACE ([yhat] || tail[1:28] AS tail, ds AS last, num * (1 - 2 / 15::double) + yhat AS num, den * (1 - 2 / 15::double) + 1 AS den)
      FROM (SELECT * REPLACE (greatest(flat * (1 + 0.7::double * (f[isodow(ds)] - 1)), 0) AS yhat)
        FROM (SELECT * REPLACE (greatest(raw + ({bias}), 0) AS flat)
          FROM (SELECT s.* REPLACE (s.step + 1 AS step, cast(s.last + INTERVAL 1 DAY AS date) AS ds, {raw} AS raw) FROM r s {joins}
            WHERE s.step < {horizon}))))"""


WEIGHTED_SQL = "s.tail[7] * 0.5::double + list_avg(s.tail[1:7]) * 0.3::double + s.num / s.den * 0.2::double"
STEPS_SQL = "SELECT store_id, product_id, ds, step::int AS step, round(yhat, 2) AS yhat"


@query("i4_recursive_forecast", f"WITH RECURSIVE {DAILY_SQL}, {recursion_sql(WEIGHTED_SQL, 7)} {STEPS_SQL} FROM r WHERE step > 0")
def recursive(spark, sf):
    out = forecast.recursive_forecast(sales_daily(spark, sf), SERIES, 7, fixed_model(WEIGHTED_FORMULA), WEIGHTED)
    return out.select(*SERIES, "ds", "step", "yhat")


@query(
    "i4_recursive_last_lag",
    f"""WITH {DAILY_SQL}, {factors_sql('sales_daily')}, r AS (SELECT *, row_number() OVER (PARTITION BY store_id, product_id
      ORDER BY date DESC) AS back, max(date) OVER (PARTITION BY store_id, product_id) AS last FROM sales_daily)
    SELECT r.store_id, r.product_id, cast(last + to_days((8 - back)::int) AS date) AS ds, (8 - back)::int AS step,
    round(value * (1 + 0.7::double * (factor - 1)), 2) AS yhat FROM r JOIN factors f ON f.store_id = r.store_id
    AND f.product_id = r.product_id AND f.dow = isodow(last + to_days((8 - back)::int)) - 1 WHERE back <= 7""",
)
def recursive_last_lag(spark, sf):
    """With the value seven rows back as the score, a week ahead follows from the data alone."""
    out = forecast.recursive_forecast(sales_daily(spark, sf), SERIES, 7, fixed_model("lag_7"), ["lag_7"])
    return out.select(*SERIES, "ds", "step", "yhat")


OBSERVED_SQL = """s.tail[8] * 0.5::double + list_avg(s.tail[2:8]) * 0.3::double
    + ((s.num - s.tail[1]) / (1 - 2 / 15::double)) / ((s.den - 1) / (1 - 2 / 15::double)) * 0.2::double"""


@query("i4_recursive_observed_row", f"WITH RECURSIVE {DAILY_SQL}, {recursion_sql(OBSERVED_SQL, 3)} {STEPS_SQL} FROM r WHERE step > 0")
def recursive_observed(spark, sf):
    model = fixed_model(WEIGHTED_FORMULA)
    out = forecast.recursive_forecast(sales_daily(spark, sf), SERIES, 3, model, WEIGHTED, observed_row=True)
    return out.select(*SERIES, "ds", "step", "yhat")


LOG_POST = forecast.PostProcessing(log1p=True, bias=-0.05, bias_in_log=True, shift=1.0)
PLAIN_POST = forecast.PostProcessing(bias=-2500.0, floor=100.0)


@query(
    "i5_post_processing",
    f"""WITH {PAIRS_SQL}, s AS (SELECT store_id, product_id, date, yhat, ln(yhat + 2) AS raw FROM forecast_pairs
      WHERE yhat IS NOT NULL)
    SELECT store_id, product_id, date, round(greatest(exp(raw - 0.05) - 1 - 1, 0), 4) AS from_log,
    round(greatest(yhat - 2500, 100), 2) AS from_plain FROM s""",
)
def post_processing(spark, sf):
    rows = forecast_pairs(spark, sf).where("yhat is not null").withColumn("raw", F.log1p(F.col("yhat") + 1))
    out = rows.select(
        *KEY,
        LOG_POST.bounded(LOG_POST.corrected(F.col("raw"))).alias("from_log"),
        PLAIN_POST.bounded(PLAIN_POST.corrected(F.col("yhat"))).alias("from_plain"),
    )
    return rounded(out, {"from_log": 4, "from_plain": 2})


@query(
    "i6_fallback",
    f"""WITH {DAILY_SQL}, f AS (SELECT store_id, product_id, date, value, lag(value, 1) OVER w AS l1, lag(value, 7) OVER w AS l7,
      lag(value, 14) OVER w AS l14, lag(value, 28) OVER w AS l28 FROM sales_daily
      WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date))
    SELECT store_id, product_id, date, CASE WHEN l14 IS NOT NULL AND (l1 IS NULL)::int + (l7 IS NULL)::int
      + (l14 IS NULL)::int + (l28 IS NULL)::int < 2 THEN l14 ELSE value END AS yhat FROM f""",
)
def fallback(spark, sf):
    rows = windows.add_lags(sales_daily(spark, sf), lags=(1, 7, 14, 28))
    lags = [F.col(f"lag_{k}") for k in (1, 7, 14, 28)]
    return rows.select(*KEY, forecast.usable_score(F.col("lag_14"), F.col("value"), lags).alias("yhat"))


@query(
    "i7_short_history",
    f"""WITH {EVENTS_SQL} SELECT user_id, count(*) AS rows, 56 AS needed, count(*) < 56 AS short_history FROM events_daily
    GROUP BY user_id""",
)
def short_history(spark, sf):
    return forecast.history_warning(events_daily(spark, sf), ["user_id"])


@query(
    "i8_diagnostics",
    f"""WITH RECURSIVE {DAILY_SQL}, {recursion_sql(WEIGHTED_SQL, 2, bias=-150.0)} {STEPS_SQL}, round(round(raw, 6), 4) AS raw_model,
    NULL::double AS pred_orig, round(round(raw - 150, 6), 4) AS corrected, round(flat, 2) AS before_seasonality, (isodow(ds) - 1)::int AS dow
    FROM r WHERE step > 0""",
)
def diagnostics(spark, sf):
    """Each step with the raw score and every stage of the corrections."""
    post = forecast.PostProcessing(bias=-150.0)
    out = forecast.recursive_forecast(sales_daily(spark, sf), SERIES, 2, fixed_model(WEIGHTED_FORMULA), WEIGHTED, post=post)
    return rounded(out, {"raw_model": 4, "corrected": 4})


BATCH_FEATURES = ["lag_7", "store_id", "product_id", "store_id_target_enc", "product_id_target_enc", "price", "store_dayofweek", "month_store", "on_promo"]
BATCH_FORMULA = """lag_7 * 0.5D + store_id * 3 + product_id * 2 + store_id_target_enc * 0.2D + product_id_target_enc * 0.1D + price * 0.01D
    + store_dayofweek + month_store * 0.5D + on_promo * 1000"""


def _means_sql(col: str) -> str:
    return f"""{col}_enc AS (SELECT {col}, (sum(value) + 10 * (SELECT avg(value) FROM part)) / (count(value) + 10) AS enc FROM part GROUP BY ALL
      HAVING count(value) > 0)"""


def _codes_sql(name: str, expression: str) -> str:
    return f"{name} AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS code FROM (SELECT DISTINCT {expression} AS x FROM part))"


@query(
    "i9_model_batch",
    f"""WITH RECURSIVE {DAILY_SQL}, part AS (SELECT store_id, product_id, date, CASE WHEN store_id <> 'S004' THEN value END AS value, price FROM sales_daily),
    {_means_sql('store_id')}, {_means_sql('product_id')}, {_codes_sql('shops', 'store_id')}, {_codes_sql('items', 'product_id')},
    {_codes_sql('shop_days', "store_id || '_' || (isodow(date) - 1)")}, {_codes_sql('shop_months', "month(date) || '_' || store_id")},
    {recursion_sql("""s.tail[7] * 0.5::double + shops.code * 3 + items.code * 2 + coalesce(a.enc, (SELECT avg(value) FROM part)) * 0.2::double
      + b.enc * 0.1::double + s.price * 0.01::double + coalesce(shop_days.code, -1) + coalesce(shop_months.code, -1) * 0.5::double""", 3, 'part',
      more=", arg_max(price, date) AS price", joins="""JOIN shops ON shops.x = s.store_id JOIN items ON items.x = s.product_id
      LEFT JOIN store_id_enc a ON a.store_id = s.store_id LEFT JOIN product_id_enc b ON b.product_id = s.product_id
      LEFT JOIN shop_days ON shop_days.x = s.store_id || '_' || (isodow(s.last + INTERVAL 1 DAY) - 1)
      LEFT JOIN shop_months ON shop_months.x = month(s.last + INTERVAL 1 DAY) || '_' || s.store_id""")}
    {STEPS_SQL}, NULL AS error FROM r WHERE step > 0 UNION ALL
    SELECT store_id, product_id, NULL, NULL, NULL, 'no_values' FROM part GROUP BY ALL HAVING count(value) = 0""",
)
def model_batch(spark, sf):
    """Forecasts of all series, with codes, target means, crosses and price in the loop, and the series that have none."""
    value = F.when(F.col("store_id") != "S004", F.col("value"))
    rows = sales_daily(spark, sf).select(*KEY, value.alias("value"), "price")
    _, encoders = features.build_features(rows)
    out = forecast.recursive_forecast(
        rows, SERIES, 3, fixed_model(BATCH_FORMULA), BATCH_FEATURES, carry=("price",), encoders=encoders, errors=True
    )
    return out.select(*SERIES, "ds", "step", "yhat", "error")


@query(
    "i9_forecast_errors",
    f"""WITH {DIRTY_SQL}, t AS (SELECT store_id, product_id, CASE WHEN store_id <> 'S004' THEN value END AS value FROM dirty_sales)
    SELECT store_id, product_id, 'no_values' AS error FROM t GROUP BY ALL HAVING count(value) = 0""",
)
def forecast_errors(spark, sf):
    rows = dirty_sales(spark, sf).withColumn("value", F.when(F.col("store_id") != "S004", F.col("value")))
    return forecast.forecast_errors(rows, SERIES)


@query(
    "i9_batch_forecast",
    f"""WITH {EVENTS_SQL}, l AS (SELECT user_id, arg_max(value, date) AS yhat, max(date) AS base FROM events_daily GROUP BY user_id)
    SELECT user_id, cast(base + to_days(i::int) AS date) AS ds, yhat FROM l, range(1, 31) r(i)""",
)
def batch_forecast(spark, sf):
    """One job for all users, whatever their number."""
    return forecast.naive_forecast(events_daily(spark, sf), ["user_id"], 30)


@query(
    "i10_regularized",
    """WITH d AS (SELECT user_id, cast(ts AS date) AS date, avg(value) AS value FROM events WHERE value IS NOT NULL GROUP BY ALL),
    s AS (SELECT user_id, cast(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date) AS date FROM d GROUP BY user_id),
    j AS (SELECT s.user_id, s.date, value,
      last_value(value IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN value IS NOT NULL THEN s.date END IGNORE NULLS) OVER b AS d0,
      first_value(value IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN value IS NOT NULL THEN s.date END IGNORE NULLS) OVER f AS d1
      FROM s LEFT JOIN d ON d.user_id = s.user_id AND d.date = s.date
      WINDOW b AS (PARTITION BY s.user_id ORDER BY s.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        f AS (PARTITION BY s.user_id ORDER BY s.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT user_id, date, round(coalesce(value, v0 + (v1 - v0) * ((date - d0)::double / nullif(d1 - d0, 0)), v0), 7) AS value FROM j""",
)
def regularized(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.col("ts").alias("date"), "value")
    return rounded(forecast.regularize(rows, ["user_id"]), {"value": 7})


@query(
    "i11_future_dates",
    f"""WITH {EVENTS_SQL}, l AS (SELECT user_id, max(date) AS last_date FROM events_daily GROUP BY user_id)
    SELECT user_id, last_date, cast(last_date + to_days(i::int) AS date) AS ds FROM l, range(1, 29) r(i)""",
)
def future_dates(spark, sf):
    last = events_daily(spark, sf).groupBy("user_id").agg(F.max("date").alias("last_date"))
    return forecast.future_dates(last, 28)
