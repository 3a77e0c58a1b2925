"""Profiles, reports, combinations and request rules (K, L, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesline.operators import combine, dataset, profile, report, requests
from salesline.operators.ordering import Series
from salesline.plans.datasets import METRIC_DIGITS, PAIRS_SQL, forecast_pairs
from salesline.plans.features import KEY
from salesline.plans.forecasting import SERIES
from salesline.plans.views import (
    DIRTY_SQL, LINE_SQL, TEXT_SQL, TOTAL_SQL, dirty_sales, dirty_text, sales_line, sales_total_daily, table,
)
from salesline.registry import query, rounded

PROFILE_COLS = ["shop", "sold_on", "amount", "qty", "price", "product_id"]


@query(
    "k1_column_profile",
    f"WITH {TEXT_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column, 'string' AS type, count({c}) AS known, count(*) - count({c}) AS unknown,
        round((count(*) - count({c})) / count(*) * 100, 1) AS unknown_pct, count(DISTINCT {c}) AS distinct, min({c}) AS example
        FROM dirty_text"""
        for c in PROFILE_COLS
    ),
)
def column_profile(spark, sf):
    return profile.column_profile(dirty_text(spark, sf), PROFILE_COLS)


STATS = {"mean": 4, "std": 4, "min": 3, "q1": 3, "median": 3, "q3": 3, "max": 3, "skew": 6, "kurtosis": 6}


def stats_sql(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS column, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    round(min({c}), 3) AS min, round(quantile_cont({c}, 0.25), 3) AS q1, round(quantile_cont({c}, 0.5), 3) AS median,
    round(quantile_cont({c}, 0.75), 3) AS q3, round(max({c}), 3) AS max, round(skewness({c}), 6) AS skew,
    round(kurtosis({c}), 6) AS kurtosis FROM {source}"""


@query("k2_descriptive_stats", f"WITH {DIRTY_SQL} {stats_sql('value', 'dirty_sales')}")
def descriptive(spark, sf):
    return rounded(profile.describe(dirty_sales(spark, sf), ["value"]), STATS)


@query(
    "k3_describe",
    f"WITH {DIRTY_SQL} " + " UNION ALL ".join(stats_sql(c, "dirty_sales") for c in ("value", "quantity", "price")),
)
def describe(spark, sf):
    return rounded(profile.describe(dirty_sales(spark, sf), ["value", "quantity", "price"]), STATS)


@query(
    "k4_missing_summary",
    f"""WITH {DIRTY_SQL}, r AS (SELECT avg((value IS NULL)::int) AS v, avg((quantity IS NULL)::int) AS q,
    avg((price IS NULL)::int) AS p FROM dirty_sales)
    SELECT 'value' AS column, round(v * 100, 7) AS unknown_pct FROM r UNION ALL SELECT 'quantity', round(q * 100, 7) FROM r
    UNION ALL SELECT 'price', round(p * 100, 7) FROM r UNION ALL SELECT '(all)', round((v + q + p) / 7 * 100, 7) FROM r""",
)
def missing(spark, sf):
    return rounded(profile.missing_summary(dirty_sales(spark, sf)), {"unknown_pct": 7})


Z_COUNT = "(SELECT count(*) FROM dirty_sales WHERE abs({0} - (SELECT avg({0}) FROM dirty_sales)) / (SELECT stddev_samp({0}) FROM dirty_sales) > 3)"


@query(
    "k5_outlier_counts",
    f"""WITH {DIRTY_SQL}, c AS (SELECT {Z_COUNT.format('value')} AS v, {Z_COUNT.format('quantity')} AS q, {Z_COUNT.format('price')} AS p)
    SELECT 'value' AS column, v AS outliers FROM c UNION ALL SELECT 'quantity', q FROM c UNION ALL SELECT 'price', p FROM c
    UNION ALL SELECT '(all)', v + q + p FROM c""",
)
def outlier_counts(spark, sf):
    return profile.outlier_counts(dirty_sales(spark, sf), ["value", "quantity", "price"])


@query(
    "k6_histogram",
    f"""WITH {LINE_SQL}, s AS (SELECT min(value) AS lo, max(value) AS hi FROM sales_line),
    b AS (SELECT least(floor((value - lo) / ((hi - lo) / 40)), 39)::int AS bin, count(*) AS n FROM sales_line, s GROUP BY 1)
    SELECT r.i::int AS bin, round(lo + (hi - lo) / 40 * r.i, 4) AS low, round(lo + (hi - lo) / 40 * (r.i + 1), 4) AS high,
    coalesce(n, 0) AS n FROM s CROSS JOIN range(40) r(i) LEFT JOIN b ON b.bin = r.i""",
)
def histogram(spark, sf):
    return rounded(profile.histogram(sales_line(spark, sf), "value"), {"low": 4, "high": 4})


QUARTILES_SQL = """min({0}) AS min, quantile_cont({0}, 0.25) AS q1, quantile_cont({0}, 0.5) AS median,
  quantile_cont({0}, 0.75) AS q3, max({0}) AS max"""


@query(
    "k7_box_numbers",
    f"WITH {LINE_SQL} SELECT store_id, {QUARTILES_SQL.format('cents::double')} FROM sales_line GROUP BY store_id",
)
def box_numbers(spark, sf):
    return profile.box_numbers(sales_line(spark, sf), "cents", ["store_id"])


@query(
    "k8_melt",
    f"""WITH {LINE_SQL} SELECT rid, 'value' AS variable, value FROM sales_line UNION ALL SELECT rid, 'quantity', quantity FROM sales_line
    UNION ALL SELECT rid, 'price', price FROM sales_line""",
)
def melt(spark, sf):
    return profile.melt(sales_line(spark, sf), ["value", "quantity", "price"], ["rid"])


CORR_COLS = ["value", "quantity", "price", "on_promo"]


@query(
    "k9_pearson_matrix",
    f"WITH {LINE_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS left, '{b}' AS right, round(corr({a}, {b}), 8) AS corr FROM sales_line" for a in CORR_COLS for b in CORR_COLS
    ),
)
def pearson(spark, sf):
    return rounded(profile.pearson_matrix(sales_line(spark, sf), CORR_COLS), {"corr": 8})


@query(
    "k10_spearman",
    f"""WITH {DIRTY_SQL}, t AS (SELECT value, quantity FROM dirty_sales WHERE value IS NOT NULL AND quantity IS NOT NULL),
    r AS (SELECT rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS a,
      rank() OVER (ORDER BY quantity) + (count(*) OVER (PARTITION BY quantity) - 1) / 2 AS b FROM t)
    SELECT round(corr(a, b), 9) AS corr FROM r""",
)
def spearman(spark, sf):
    return rounded(profile.spearman(dirty_sales(spark, sf), "value", "quantity"), {"corr": 9})


@query(
    "k11_kendall",
    """WITH p AS (SELECT l_quantity AS x, l_discount AS y, count(*)::hugeint AS w FROM lineitem GROUP BY ALL),
    pairs AS (SELECT sum(CASE WHEN (a.x < b.x AND a.y > b.y) THEN a.w * b.w END)::double AS dis,
      sum(CASE WHEN (a.x < b.x AND a.y < b.y) THEN a.w * b.w END)::double AS con FROM p a, p b),
    t AS (SELECT sum(w)::double AS n, (SELECT sum(t * (t - 1) / 2) FROM (SELECT sum(w)::double AS t FROM p GROUP BY x)) AS n1,
      (SELECT sum(t * (t - 1) / 2) FROM (SELECT sum(w)::double AS t FROM p GROUP BY y)) AS n2 FROM p)
    SELECT n::bigint AS n, dis AS discordant, round((con - dis) / sqrt((n * (n - 1) / 2 - n1) * (n * (n - 1) / 2 - n2)), 12) AS tau
    FROM pairs, t""",
)
def kendall(spark, sf):
    return rounded(profile.kendall(table(spark, sf, "lineitem"), "l_quantity", "l_discount"), {"tau": 12})


@query("k11_kendall_sales")
def kendall_sales(spark, sf):
    """Value against price of every sold line: nearly all values distinct."""
    return profile.kendall(sales_line(spark, sf), "value", "price")


@query(
    "k12_top_correlations",
    f"WITH {LINE_SQL}, c AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, value) AS corr FROM sales_line" for c in ("quantity", "price", "on_promo"))
    + ") SELECT feature, round(corr, 8) AS corr FROM c ORDER BY abs(corr) DESC LIMIT 2",
)
def top_correlations(spark, sf):
    out = profile.top_correlations(sales_line(spark, sf), "value", ["quantity", "price", "on_promo"], top=2)
    return rounded(out, {"corr": 8})


@query(
    "k13_trend_line",
    f"""WITH {LINE_SQL} SELECT store_id, round(regr_slope(value, quantity), 5) AS slope,
    round(regr_intercept(value, quantity), 4) AS intercept, round(regr_r2(value, quantity), 8) AS r2, count(*) AS n
    FROM sales_line GROUP BY store_id""",
)
def trend_line(spark, sf):
    out = report.trend_line(sales_line(spark, sf), "quantity", "value", ["store_id"])
    return rounded(out, {"slope": 5, "intercept": 4, "r2": 8})


@query(
    "k14_category_counts",
    f"""WITH {LINE_SQL} SELECT category, count(*) AS n, round(count(*) / (SELECT count(*) FROM sales_line), 9) AS share
    FROM sales_line GROUP BY category""",
)
def category_counts(spark, sf):
    return rounded(report.category_counts(sales_line(spark, sf), "category"), {"share": 9})


@query(
    "k15_group_totals",
    f"""WITH {LINE_SQL} SELECT store_id, sum(cents)::bigint AS total, sum(cents)::bigint / count(*) AS mean, count(*) AS n
    FROM sales_line GROUP BY store_id""",
)
def group_totals(spark, sf):
    return report.group_totals(sales_line(spark, sf), "store_id", "cents")


BIN_SQL = {
    "D": ("date", "generate_series(min(date), max(date), INTERVAL 1 DAY)"),
    "W": (
        "cast(date_trunc('week', date) + INTERVAL 6 DAY AS date)",
        "generate_series(date_trunc('week', min(date)) + INTERVAL 6 DAY, date_trunc('week', max(date)) + INTERVAL 6 DAY, INTERVAL 7 DAY)",
    ),
    "M": (
        "last_day(date)",
        "list_transform(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH), lambda d: last_day(d))",
    ),
}

for _every, (_bin, _spine) in BIN_SQL.items():

    def _resample(spark, sf, every=_every):
        rows = sales_line(spark, sf)
        return report.resample(rows, every, "quantity")

    query(
        f"k16_resample_{_every.lower()}",
        f"""WITH {LINE_SQL}, t AS (SELECT * FROM sales_line),
        b AS (SELECT cast(unnest({_spine}) AS date) AS bin FROM t),
        g AS (SELECT {_bin} AS bin, sum(quantity) AS s, avg(quantity) AS mean, count(quantity) AS n FROM t GROUP BY 1)
        SELECT b.bin, coalesce(s, 0) AS total, mean, coalesce(n, 0) AS n FROM b LEFT JOIN g ON g.bin = b.bin""",
    )(_resample)


@query(
    "k17_resample_means",
    f"""WITH {TOTAL_SQL}, b AS (SELECT cast(unnest({BIN_SQL['M'][1]}) AS date) AS bin FROM sales_total_daily),
    g AS (SELECT last_day(date) AS bin, avg(value) AS value, avg(quantity) AS quantity FROM sales_total_daily GROUP BY 1)
    SELECT b.bin, round(value, 6) AS value, round(quantity, 7) AS quantity FROM b LEFT JOIN g ON g.bin = b.bin""",
)
def resample_means(spark, sf):
    out = report.resample_means(sales_total_daily(spark, sf), "M", ["value", "quantity"])
    return rounded(out, {"value": 6, "quantity": 7})


@query(
    "k18_weekday_profile",
    f"""WITH {LINE_SQL}, g AS (SELECT isodow(date) - 1 AS d, sum(cents)::double / count(*) AS mean FROM sales_line GROUP BY 1)
    SELECT r.i::int AS dow, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][r.i + 1] AS weekday, mean
    FROM range(7) r(i) LEFT JOIN g ON d = r.i""",
)
def weekday_profile(spark, sf):
    return report.weekday_profile(sales_line(spark, sf), "cents")


@query(
    "k18_month_profile",
    f"WITH {LINE_SQL} SELECT month(date)::int AS month, sum(cents)::double / count(*) AS mean FROM sales_line GROUP BY 1",
)
def month_profile(spark, sf):
    return report.month_profile(sales_line(spark, sf), "cents")


@query(
    "k19_row_counts",
    f"""WITH {LINE_SQL} SELECT 'weekday' AS part, (isodow(date) - 1)::int AS place, count(*) AS n FROM sales_line GROUP BY ALL
    UNION ALL SELECT 'month', month(date)::int, count(*) FROM sales_line GROUP BY ALL""",
)
def row_counts(spark, sf):
    rows = sales_line(spark, sf)
    parts = [report.row_counts(rows, p).select(F.lit(p).alias("part"), F.col(p).alias("place"), "n") for p in ("weekday", "month")]
    return parts[0].unionByName(parts[1])


@query(
    "k20_activity",
    f"""WITH {LINE_SQL}, g AS (SELECT isodow(date) - 1 AS d, week(date) AS w, sum(quantity) AS s FROM sales_line GROUP BY ALL)
    SELECT a.i::int AS dow, b.i::int AS week, coalesce(s, 0) AS total FROM range(7) a(i) CROSS JOIN range(1, 54) b(i)
    LEFT JOIN g ON d = a.i AND w = b.i""",
)
def activity(spark, sf):
    return report.activity(sales_line(spark, sf), "quantity")


AHEAD_SQL = PAIRS_SQL + """,
ahead AS (SELECT * FROM (SELECT store_id, product_id, date AS ds, yhat, row_number() OVER (PARTITION BY store_id, product_id
  ORDER BY date DESC) AS back FROM forecast_pairs) WHERE back <= 14 AND yhat IS NOT NULL),
past AS (SELECT store_id, product_id, date, value FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id
  ORDER BY date DESC) AS back FROM sales_daily) WHERE back > 14)"""


def ahead_and_past(spark, sf):
    """The last 14 days of each series as forecast, the days before as history."""
    pairs = forecast_pairs(spark, sf)
    last = dataset.tail_rows(pairs, rows=14)
    past = pairs.join(last.select(*KEY), KEY, "left_anti").select(*KEY, "value")
    return last.where("yhat is not null").select(*SERIES, F.col("date").alias("ds"), "yhat"), past


@query(
    "k21_forecast_figures",
    f"""WITH {AHEAD_SQL}, a AS (SELECT store_id, product_id, count(*) AS n, avg(yhat) AS mean, min(yhat) AS min, max(yhat) AS max
      FROM ahead GROUP BY ALL), l AS (SELECT store_id, product_id, arg_max(value, date) AS last_value FROM past GROUP BY ALL),
    j AS (SELECT a.*, last_value, coalesce((mean - last_value) / nullif(last_value, 0) * 100, 0) AS change_pct FROM a
      LEFT JOIN l USING (store_id, product_id))
    SELECT store_id, product_id, n, round(mean, 5) AS mean, min, max, last_value, round(change_pct, 6) AS change_pct,
    CASE WHEN change_pct > 0 THEN 'hausse' ELSE 'baisse' END AS trend FROM j""",
)
def forecast_figures(spark, sf):
    ahead, past = ahead_and_past(spark, sf)
    return rounded(report.forecast_figures(ahead, past, SERIES), {"mean": 5, "change_pct": 6})


@query(
    "k22_weekly_breakdown",
    f"""WITH {AHEAD_SQL} SELECT store_id, product_id, cast(date_trunc('week', ds) + INTERVAL 6 DAY AS date) AS week,
    round(sum(yhat), 2) AS total, round(avg(yhat), 4) AS mean, count(*) AS days FROM ahead
    WHERE (store_id, product_id) IN (SELECT (store_id, product_id) FROM ahead GROUP BY store_id, product_id HAVING count(*) > 7)
    GROUP BY ALL""",
)
def weekly_breakdown(spark, sf):
    ahead, _ = ahead_and_past(spark, sf)
    return rounded(report.weekly_breakdown(ahead, SERIES), {"total": 2, "mean": 4})


@query(
    "k23_search_rows",
    "SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'license') OR contains(lower(source), 'license')",
)
def search_rows(spark, sf):
    rows = table(spark, sf, "documents")
    return report.search_rows(rows, "License", ["text", "source"]).select("doc_id", "lang", "source")


@query(
    "k24_row_sample",
    f"WITH {LINE_SQL} SELECT rid, value FROM sales_line ORDER BY md5(rid::varchar || ':42'), rid LIMIT 500",
)
def row_sample(spark, sf):
    return report.sample_rows(sales_line(spark, sf).select("rid", "value"), "rid")


@query(
    "k26_incomplete_rows",
    f"""WITH {DIRTY_SQL} SELECT count(*) AS rows, count(*) FILTER (value IS NULL OR quantity IS NULL OR price IS NULL) AS incomplete,
    2 AS new_columns FROM dirty_sales""",
)
def incomplete_rows(spark, sf):
    return report.incomplete_rows(dirty_sales(spark, sf), ["rid", "store_id", "product_id", "date", "value"])


@query(
    "k27_date_span",
    f"""WITH {LINE_SQL} SELECT store_id, min(date) AS first_day, max(date) AS last_day, max(date) - min(date) AS days,
    min(cents) AS min, max(cents) AS max, sum(cents)::double / count(*) AS mean FROM sales_line GROUP BY store_id""",
)
def date_span(spark, sf):
    return report.date_span(sales_line(spark, sf), ["store_id"], "cents").withColumn("days", F.col("days").cast("bigint"))


@query(
    "k28_filters",
    f"""WITH {LINE_SQL} SELECT rid, date, value FROM sales_line WHERE date BETWEEN DATE '1996-03-01' AND DATE '1997-08-31'
    AND store_id = 'S005'""",
)
def filters(spark, sf):
    return report.in_range(sales_line(spark, sf), "1996-03-01", "1997-08-31", store_id="S005").select("rid", "date", "value")


# -------------------------------------------------------------------------------------- combinations

SIDES_SQL = PAIRS_SQL + """,
history AS (SELECT store_id, product_id, date AS ds, value AS y FROM forecast_pairs WHERE cents % 5 <> 0),
forecasts AS (SELECT store_id, product_id, date AS ds, yhat, yhat_lower, yhat_upper FROM forecast_pairs
  WHERE yhat IS NOT NULL AND cents % 7 <> 0),
both_sides AS (SELECT * FROM history FULL JOIN forecasts USING (store_id, product_id, ds))"""
DS_KEY = [*SERIES, "ds"]


def sides(spark, sf):
    pairs = forecast_pairs(spark, sf).withColumnRenamed("date", "ds")
    history = pairs.where("cents % 5 <> 0").select(*DS_KEY, F.col("value").alias("y"))
    ahead = pairs.where("yhat is not null and cents % 7 <> 0").select(*DS_KEY, "yhat", "yhat_lower", "yhat_upper")
    return history, ahead


def both_sides(spark, sf):
    return combine.combine(*sides(spark, sf), SERIES)


@query("l1_full_outer", f"WITH {SIDES_SQL} SELECT store_id, product_id, ds, y, yhat FROM both_sides")
def full_outer(spark, sf):
    return both_sides(spark, sf).select(*DS_KEY, "y", "yhat")


@query(
    "l2_source_labels",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, ds, CASE WHEN y IS NOT NULL AND yhat IS NULL THEN 'Historique'
    WHEN y IS NULL AND yhat IS NOT NULL THEN 'Prevision' ELSE 'Overlap' END AS source FROM both_sides""",
)
def source_labels(spark, sf):
    return both_sides(spark, sf).select(*DS_KEY, combine.source_label(F.col("y"), F.col("yhat")).alias("source"))


@query(
    "l3_attach_bounds",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, ds, y, round(yhat_lower, 2) AS yhat_lower, round(yhat_upper, 2) AS yhat_upper
    FROM history LEFT JOIN forecasts USING (store_id, product_id, ds)""",
)
def attach_bounds(spark, sf):
    out = combine.attach_bounds(*sides(spark, sf), SERIES)
    return rounded(out, {"yhat_lower": 2, "yhat_upper": 2})


@query(
    "l4_overlap_deviation",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, ds, round(abs(y - yhat), 2) AS deviation,
    round((y - yhat) / nullif(y, 0) * 100, 2) AS deviation_pct FROM history JOIN forecasts USING (store_id, product_id, ds)""",
)
def overlap_deviation(spark, sf):
    return combine.overlap_deviation(*sides(spark, sf), SERIES).select(*DS_KEY, "deviation", "deviation_pct")


@query(
    "l5_error_table",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, ds, round(y - yhat, 2) AS error, round(abs(y - yhat), 2) AS abs_error,
    round(abs((y - yhat) / nullif(y, 0)) * 100, 5) AS pct_error FROM both_sides WHERE y IS NOT NULL AND yhat IS NOT NULL""",
)
def error_table(spark, sf):
    out = combine.error_table(both_sides(spark, sf)).select(*DS_KEY, "error", "abs_error", "pct_error")
    return rounded(out, {"error": 2, "abs_error": 2, "pct_error": 5})


@query(
    "l5_error_summary",
    f"""WITH {SIDES_SQL}, e AS (SELECT * FROM both_sides WHERE y IS NOT NULL AND yhat IS NOT NULL)
    SELECT round(avg(abs(y - yhat)), 5) AS mae, round(sqrt(avg((y - yhat) ^ 2)), 5) AS rmse,
    round(avg(abs((y - yhat) / nullif(y, 0)) * 100), 5) AS mape,
    round(1 - sum((y - yhat) ^ 2) / (var_pop(y) * count(*)), 8) AS r2 FROM e""",
)
def error_summary(spark, sf):
    return rounded(combine.error_summary(both_sides(spark, sf)), {c: METRIC_DIGITS[c] for c in ("mae", "rmse", "mape", "r2")})


@query(
    "l6_outside_bounds",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, ds, y, yhat FROM both_sides WHERE y > yhat_upper OR y < yhat_lower""",
)
def outside_bounds(spark, sf):
    return combine.outside_bounds(both_sides(spark, sf)).select(*DS_KEY, "y", "yhat")


@query(
    "l7_deviating_days",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, ds, y, yhat, round(abs((y - yhat) / nullif(y, 0)) * 100, 4) AS pct_error
    FROM both_sides WHERE abs((y - yhat) / nullif(y, 0)) * 100 > 50""",
)
def deviating_days(spark, sf):
    out = combine.deviating(both_sides(spark, sf), ["ds", *SERIES]).select(*DS_KEY, "y", "yhat", "pct_error")
    return rounded(out, {"pct_error": 4})


@query(
    "l8_l14_forecast_files",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, f.ds, round(yhat, 2) AS yhat FROM forecasts f
    UNION ALL SELECT store_id, product_id, cast(f.ds + INTERVAL 1 DAY AS date), NULL FROM forecasts f""",
)
def forecast_files(spark, sf):
    """Forecasts written as JSON points, read back and typed."""
    _, ahead = sides(spark, sf)
    points = F.array(
        F.struct(F.col("ds").cast("string").alias("ds"), F.round("yhat", 2).cast("string").alias("yhat")),
        F.struct(F.date_format(F.date_add("ds", 1), "dd/MM/yyyy").alias("ds"), F.lit("n/a").alias("yhat")),
    )
    files = ahead.select(*SERIES, F.to_json(points).alias("forecast"))
    return combine.normalize_forecast(combine.explode_forecast(files)).select(*DS_KEY, "yhat")


@query(
    "l9_daily_rows",
    f"""WITH {LINE_SQL} SELECT store_id, date, sum(cents)::bigint AS cents, sum(quantity) AS quantity, sum(on_promo)::bigint AS on_promo,
    arg_min(category, rid) AS category FROM sales_line GROUP BY store_id, date""",
)
def daily_rows(spark, sf):
    rows = sales_line(spark, sf).select("rid", "store_id", "date", "cents", "quantity", "on_promo", "category")
    return combine.to_daily(rows, ["store_id"])


@query(
    "l10_collapse_dates",
    "SELECT user_id, cast(ts AS date) AS date, sum(cast(floor(value * 100 + 0.5) AS bigint))::bigint AS value FROM events GROUP BY ALL",
)
def collapse_dates(spark, sf):
    cents = F.floor(F.col("value") * 100 + 0.5).cast("bigint").alias("value")
    rows = table(spark, sf, "events").select("user_id", F.col("ts").alias("date"), cents, F.col("event_id").alias("rid"))
    return combine.to_daily(rows, ["user_id"])


@query(
    "l11_append_rows",
    f"""WITH {SIDES_SQL} SELECT store_id, product_id, ds, y, NULL::double AS yhat FROM history
    UNION ALL SELECT store_id, product_id, ds, NULL, yhat FROM forecasts""",
)
def append_rows(spark, sf):
    history, ahead = sides(spark, sf)
    return combine.append_rows(history, ahead.select(*DS_KEY, "yhat"))


@query(
    "l12_series_info",
    f"""WITH {LINE_SQL} SELECT CASE WHEN count(DISTINCT store_id) = 1 THEN min(store_id) END AS series_id,
    count(*) AS original_rows, count(DISTINCT date) AS unique_dates, count(DISTINCT date) AS aggregated_rows FROM sales_line""",
)
def series_info(spark, sf):
    return combine.series_info(sales_line(spark, sf), "store_id")


@query(
    "l13_last_points",
    f"""WITH {LINE_SQL} SELECT rid, store_id, date, value FROM (SELECT *, row_number() OVER (PARTITION BY store_id
    ORDER BY date DESC, rid DESC) AS back FROM sales_line) WHERE back <= 90""",
)
def last_points(spark, sf):
    out = dataset.tail_rows(sales_line(spark, sf), Series(("store_id",), ("date", "rid"), daily=False))
    return out.select("rid", "store_id", "date", "value")


# ------------------------------------------------------------------------------------------ requests

POINTS_SQL = """points AS (SELECT user_id AS id, event_id AS pos, cast(ts AS date) AS date,
  CASE WHEN user_id % 10 = 3 OR event_id % 11 = 0 THEN NULL ELSE value END AS value FROM events)"""


def points(spark, sf):
    empty = (F.col("user_id") % 10 == 3) | (F.col("event_id") % 11 == 0)
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("pos"),
        F.to_date("ts").alias("date"),
        F.when(~empty, F.col("value")).alias("value"),
    )


@query(
    "m1_last_point_per_date",
    f"""WITH {POINTS_SQL} SELECT id, date, pos, value FROM (SELECT *, row_number() OVER (PARTITION BY id, date ORDER BY pos DESC)
    AS r FROM points) WHERE r = 1""",
)
def last_point(spark, sf):
    return requests.keep_last_points(points(spark, sf))


@query(
    "m2_request_status",
    f"""WITH {POINTS_SQL} SELECT id, count(*) AS points, count(value) AS known, CASE WHEN count(*) = 0 THEN '{requests.NO_POINTS}'
    WHEN count(*) > 70 THEN '{requests.TOO_MANY}' WHEN count(value) = 0 THEN '{requests.NO_VALUES}' ELSE 'ok' END AS status
    FROM points GROUP BY id""",
)
def request_status(spark, sf):
    return requests.request_status(points(spark, sf), max_points=70)


@query(
    "m2_valid_points",
    f"""WITH {POINTS_SQL} SELECT id, date, pos, value FROM (SELECT *, row_number() OVER (PARTITION BY id, date ORDER BY pos DESC) AS r
    FROM points WHERE id IN (SELECT id FROM points GROUP BY id HAVING count(value) > 0)) WHERE r = 1""",
)
def valid_points(spark, sf):
    return requests.valid_points(points(spark, sf))


@query(
    "m3_extras",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::varchar AS value_key FROM events""",
)
def extras(spark, sf):
    props = F.regexp_replace("props", r"\}$", ', "value": 1}')
    rows = requests.split_extras(table(spark, sf, "events").withColumn("props", props), "props")
    return rows.select("event_id", F.col("extras")["k"].alias("k"), F.col("extras")["value"].alias("value_key"))


@query(
    "m3_request_payloads",
    """SELECT event_id::varchar AS id, 0 AS pos, cast(ts AS date)::timestamp AS date, value, event_type AS channel FROM events""",
)
def request_payloads(spark, sf):
    """Events written as request payloads and read back."""
    point = F.create_map(
        F.lit("date"), F.to_date("ts").cast("string"), F.lit("value"), F.col("value").cast("string"),
        F.lit("channel"), F.col("event_type"),
    )
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.array(point).alias("series")))
    parsed = table(spark, sf, "events").select(F.from_json(body, requests.REQUEST_SCHEMA).alias("r")).select("r.*")
    rows = requests.explode_requests(parsed)
    return rows.select("id", "pos", "date", "value", F.col("extras")["channel"].alias("channel"))
