"""Encodings, training sets and error metrics (G, H, J)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.operators import dataset, encode, metrics, windows
from salesline.plans.features import KEY
from salesline.plans.views import DAILY_SQL, DIRTY_SQL, LINE_SQL, dirty_sales, sales_daily, sales_line
from salesline.registry import query, rounded

# --------------------------------------------------------------------------------------- encodings

CODES_SQL = "(SELECT {0} AS c, row_number() OVER (ORDER BY {0}) - 1 AS code FROM (SELECT DISTINCT {0} FROM {1} WHERE {0} IS NOT NULL))"


@query(
    "g1_label_codes",
    f"""WITH {LINE_SQL}, t AS (SELECT rid, CASE WHEN rid % 7 <> 0 THEN category END AS category, store_id FROM sales_line)
    SELECT rid, coalesce(a.code, -1)::int AS category, coalesce(b.code, -1)::int AS store_id FROM t
    LEFT JOIN {CODES_SQL.format('category', 't')} a ON a.c = t.category
    LEFT JOIN {CODES_SQL.format('store_id', 't')} b ON b.c = t.store_id""",
)
def label_codes(spark, sf):
    rows = sales_line(spark, sf).select("rid", F.when(F.col("rid") % 7 != 0, F.col("category")).alias("category"), "store_id")
    return encode.encode_categorical(rows, ["category", "store_id"])[0]


@query(
    "g2_apply_labels",
    f"""WITH {LINE_SQL}, early AS (SELECT * FROM sales_line WHERE date < DATE '1996-01-01' AND category <> 'Brand#13')
    SELECT rid, coalesce(code, -1)::int AS category FROM sales_line
    LEFT JOIN {CODES_SQL.format('category', 'early')} ON c = category""",
)
def apply_labels(spark, sf):
    rows = sales_line(spark, sf).select("rid", "category", "date")
    early = rows.where("date < DATE '1996-01-01' AND category <> 'Brand#13'")
    return encode.apply_labels(rows, "category", encode.fit_labels(early, "category")).select("rid", "category")


SMOOTH_SQL = """means AS (SELECT {0} AS c, (count(value) * avg(value) + 10 * (SELECT avg(value) FROM {1})) / (count(value) + 10)
  AS e FROM {1} GROUP BY {0})"""


@query(
    "g3_target_encoding",
    f"""WITH {DIRTY_SQL}, {SMOOTH_SQL.format('store_id', 'dirty_sales')}
    SELECT rid, round(coalesce(e, (SELECT avg(value) FROM dirty_sales)), 5) AS store_id_target_enc
    FROM dirty_sales LEFT JOIN means ON c = store_id""",
)
def target_encoding(spark, sf):
    rows = dirty_sales(spark, sf).select("rid", "store_id", "value")
    out, _ = encode.add_target_encoding(rows, ["store_id"])
    return rounded(out.select("rid", "store_id_target_enc"), {"store_id_target_enc": 5})


@query(
    "g3_past_target_encoding",
    f"""WITH {LINE_SQL}, p AS (SELECT rid, (sum(cents) OVER a)::double AS s, count(cents) OVER a AS n, (sum(cents) OVER c)::double AS cs,
      count(cents) OVER c AS cn FROM sales_line WINDOW a AS (ORDER BY date, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      c AS (PARTITION BY category ORDER BY date, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT rid, (coalesce(cs, 0) + 10 * (s / nullif(n, 0))) / (cn + 10) AS category_target_enc FROM p""",
)
def past_target_encoding(spark, sf):
    rows = sales_line(spark, sf).select("rid", "date", "category", F.col("cents").cast("double").alias("value"))
    return encode.add_past_target_encoding(rows, "category", ["date", "rid"]).select("rid", "category_target_enc")


@query(
    "g4_apply_target_means",
    f"""WITH {LINE_SQL}, early AS (SELECT * FROM sales_line WHERE date < DATE '1996-01-01' AND category <> 'Brand#13'),
    {SMOOTH_SQL.format('category', 'early')}
    SELECT rid, round(coalesce(e, (SELECT avg(value) FROM early)), 5) AS category_target_enc
    FROM sales_line LEFT JOIN means ON c = category""",
)
def apply_target_means(spark, sf):
    rows = sales_line(spark, sf).select("rid", "category", "date", "value")
    early = rows.where("date < DATE '1996-01-01' AND category <> 'Brand#13'")
    out = encode.apply_target_means(rows, "category", encode.fit_target_means(early, "category"))
    return rounded(out.select("rid", "category_target_enc"), {"category_target_enc": 5})


# ------------------------------------------------------------------------------------ training sets


@query("h1_drop_unknown_target", f"WITH {DIRTY_SQL} SELECT rid, value FROM dirty_sales WHERE value IS NOT NULL")
def drop_unknown(spark, sf):
    return dataset.drop_unknown_target(dirty_sales(spark, sf).select("rid", "value"))


@query(
    "h2_promo_flag",
    f"""WITH {LINE_SQL}, t AS (SELECT rid, CASE rid % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN '1' WHEN 3 THEN '0'
    WHEN 4 THEN 'maybe' END AS on_promo FROM sales_line)
    SELECT rid, CASE WHEN lower(on_promo) IN ('true', '1') THEN 1 ELSE 0 END AS on_promo FROM t""",
)
def promo(spark, sf):
    words = F.element_at(F.array(*[F.lit(w) for w in ("True", "False", "1", "0", "maybe", None)]), (F.col("rid") % 6 + 1).cast("int"))
    return dataset.add_promo_flag(sales_line(spark, sf).select("rid", words.alias("on_promo")))


def split_sql(horizon: int, source: str = "sales_daily") -> str:
    return f"""days AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS back, count(*) OVER () AS n
      FROM (SELECT DISTINCT date FROM {source})),
    cut AS (SELECT date AS cutoff FROM days WHERE back = CASE WHEN {horizon} >= n THEN greatest(1, n // 5) ELSE {horizon} END),
    parts AS (SELECT *, CASE WHEN date >= (SELECT cutoff FROM cut) THEN 'test' ELSE 'train' END AS split FROM {source})"""


@query("h3_time_split", f"WITH {DAILY_SQL}, {split_sql(14)} SELECT store_id, product_id, date, split FROM parts")
def time_split(spark, sf):
    return dataset.split_by_time(sales_daily(spark, sf), 14).select(*KEY, "split")


@query("h3_time_split_long_horizon", f"WITH {DAILY_SQL}, {split_sql(9999)} SELECT store_id, product_id, date, split FROM parts")
def time_split_long(spark, sf):
    return dataset.split_by_time(sales_daily(spark, sf), 9999).select(*KEY, "split")


@query(
    "h4_validation_by_date",
    f"""WITH {DAILY_SQL}, days AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS back, count(*) OVER () AS n
    FROM (SELECT DISTINCT date FROM sales_daily))
    SELECT store_id, product_id, date, date >= (SELECT min(date) FROM days WHERE back <= greatest(floor(n * 0.15), 14))
    AS is_validation FROM sales_daily""",
)
def validation_by_date(spark, sf):
    return dataset.validation_flag(sales_daily(spark, sf), 14).select(*KEY, "is_validation")


@query(
    "h4_validation_by_row",
    f"""WITH {DAILY_SQL}, r AS (SELECT store_id, product_id, date,
    row_number() OVER (ORDER BY store_id, product_id, date) - 1 AS i, count(*) OVER () AS n FROM sales_daily)
    SELECT store_id, product_id, date, i >= n - greatest(floor(n * 0.15), 14) AS is_validation FROM r""",
)
def validation_by_row(spark, sf):
    return dataset.validation_flag(sales_daily(spark, sf).select(*KEY), 14, by="row").select(*KEY, "is_validation")


FOLDS_SQL = """, f AS (SELECT *, unnest(range(1, k + 1)) AS fold FROM (SELECT *,
    least(5, greatest(2, (SELECT count(*) FROM sales_daily) // 100)) AS k FROM r)),
  s AS (SELECT *, n - (k - fold + 1) * (n // (k + 1)) AS start, n // (k + 1) AS size FROM f),
  roles AS (SELECT *, CASE WHEN i < start THEN 'train' WHEN i < start + size THEN 'validation' END AS role FROM s)
  SELECT fold::int AS fold, role, count(*) AS n, min(date) AS first_day, max(date) AS last_day, sum(cents)::bigint AS cents
  FROM roles WHERE role IS NOT NULL GROUP BY ALL"""


def _folds(spark, sf, by):
    rows = dataset.expanding_folds(sales_daily(spark, sf).select(*KEY, "cents"), by=by)
    return rows.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.sum("cents").alias("cents"),
    )


query(
    "h5_folds_by_date",
    f"""WITH {DAILY_SQL}, d AS (SELECT date AS dd, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
    FROM (SELECT DISTINCT date FROM sales_daily)), r AS (SELECT * FROM sales_daily JOIN d ON dd = date){FOLDS_SQL}""",
)(lambda spark, sf: _folds(spark, sf, "date"))
query(
    "h5_folds_by_row",
    f"""WITH {DAILY_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY store_id, product_id, date) - 1 AS i,
    count(*) OVER () AS n FROM sales_daily){FOLDS_SQL}""",
)(lambda spark, sf: _folds(spark, sf, "row"))


@query(
    "h6_log_target",
    f"""WITH {DIRTY_SQL}, m AS (SELECT CASE WHEN min(value) <= 0 THEN 1 - min(value) ELSE 0 END AS s FROM dirty_sales)
    SELECT rid, round(s, 2) AS log_shift, round(ln(value + s + 1), 9) AS log_value,
    round(exp(least(ln(value + s + 1), 20)) - 1 - s, 2) AS back FROM dirty_sales, m""",
)
def log_target(spark, sf):
    rows = dataset.log_target(dirty_sales(spark, sf).select("rid", "value"))
    rows = rows.withColumn("back", dataset.inverse_log(F.col("log_value"), F.col("log_shift"))).drop("value")
    return rounded(rows, {"log_shift": 2, "log_value": 9, "back": 2})


@query(
    "h10_series_sizes",
    f"""WITH {DAILY_SQL}, s AS (SELECT count(*) AS n FROM sales_daily GROUP BY store_id, product_id)
    SELECT count(*) AS series, min(n) AS min_rows, round(avg(n), 6) AS mean_rows, max(n) AS max_rows,
    round(stddev_samp(n), 6) AS std_rows, count(*) FILTER (n >= 30) AS long_enough FROM s""",
)
def series_sizes(spark, sf):
    out = dataset.series_sizes(sales_daily(spark, sf), ["store_id", "product_id"])
    return rounded(out, {"mean_rows": 6, "std_rows": 6})


@query(
    "h10_series_id",
    f"""WITH {DAILY_SQL} SELECT store_id || '_' || product_id AS series_id, count(*) AS n FROM sales_daily GROUP BY 1""",
)
def series_id(spark, sf):
    return dataset.with_series_id(sales_daily(spark, sf), ["store_id", "product_id"]).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "h11_mean_fallback",
    f"""WITH {DAILY_SQL}, {split_sql(14)}, tr AS (SELECT * FROM parts WHERE split = 'train' AND store_id <> 'S001'),
    m AS (SELECT store_id, product_id, sum(cents)::double / 100 / count(*) AS m FROM tr GROUP BY ALL)
    SELECT p.store_id, p.product_id, date, round(greatest(0, coalesce(m, (SELECT avg(value) FROM tr))), 5) AS yhat
    FROM parts p LEFT JOIN m USING (store_id, product_id) WHERE split = 'test'""",
)
def mean_fallback(spark, sf):
    parts = dataset.split_by_time(sales_daily(spark, sf), 14)
    train, test = parts.where("split = 'train' AND store_id <> 'S001'"), parts.where("split = 'test'")
    out = dataset.mean_fallback(test, train, ["store_id", "product_id"]).select(*KEY, "yhat")
    return rounded(out, {"yhat": 5})


@query(
    "h12_mean_regressor",
    f"""WITH {DAILY_SQL}, {split_sql(14)} SELECT store_id, product_id, date,
    round((SELECT avg(value) FROM parts WHERE split = 'train'), 5) AS yhat FROM parts WHERE split = 'test'""",
)
def mean_regressor(spark, sf):
    parts = dataset.split_by_time(sales_daily(spark, sf), 14)
    out = dataset.mean_regressor(parts.where("split = 'test'"), parts.where("split = 'train'"))
    return rounded(out.select(*KEY, "yhat"), {"yhat": 5})


@query(
    "h14_align_features",
    f"""WITH {DAILY_SQL} SELECT store_id, product_id, date, on_promo, 0 AS holiday_rank, value, 0 AS lag_99 FROM sales_daily""",
)
def align_features(spark, sf):
    return dataset.align_features(sales_daily(spark, sf), ["on_promo", "holiday_rank", "value", "lag_99"], KEY)


# ------------------------------------------------------------------------------------------ metrics

PAIRS_SQL = DAILY_SQL + """,
forecast_pairs AS MATERIALIZED (SELECT *, roll_raw - 2 * std_raw AS yhat_lower, roll_raw + 2 * std_raw AS yhat_upper, roll_raw AS yhat
  FROM (SELECT store_id, product_id, date, value, cents, lag(value, 7) OVER (PARTITION BY store_id, product_id ORDER BY date) AS roll_raw,
    coalesce(CASE WHEN count(value) OVER w >= 14 THEN stddev_samp(value) OVER w END, 0) AS std_raw FROM sales_daily
    WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)))"""


def forecast_pairs(spark, sf) -> DataFrame:
    """Observed values with a simple forecast: the value seven rows back, give or take two deviations."""
    df = windows.add_rolling(windows.add_lags(sales_daily(spark, sf), lags=(7,)), windows=(28,))
    yhat, spread = F.col("lag_7"), 2 * F.col("roll_std_28")
    return df.select(
        *KEY,
        "value",
        "cents",
        yhat.alias("yhat"),
        (yhat - spread).alias("yhat_lower"),
        (yhat + spread).alias("yhat_upper"),
    )


METRICS_SQL = """count(*) AS n, avg(abs({f} - {y})) AS mae, sqrt(avg(({f} - {y}) ^ 2)) AS rmse,
  1 - sum(({f} - {y}) ^ 2) / nullif(var_pop({y}) * count(*), 0) AS r2, avg({f} - {y}) AS bias,
  avg(CASE WHEN abs({y}) > 1 THEN abs(({f} - {y}) / {y}) END) * 100 AS mape,
  avg(abs({f} - {y}) / CASE WHEN abs({y}) + abs({f}) > 0 THEN (abs({y}) + abs({f})) / 2 ELSE 1 END) * 100 AS smape"""
METRIC_DIGITS = {"mae": 5, "rmse": 5, "r2": 8, "bias": 5, "mape": 5, "smape": 6}


def round_sql(cols: dict[str, int]) -> str:
    return ", ".join(f"round({c}, {d}) AS {c}" for c, d in cols.items())


def metrics_sql(source: str, keys: str = "", f: str = "yhat", y: str = "value") -> str:
    head = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return f"SELECT {head}{METRICS_SQL.format(f=f, y=y)} FROM {source} WHERE {f} IS NOT NULL AND {y} IS NOT NULL{group}"


@query(
    "j1_j3_error_metrics",
    f"WITH {PAIRS_SQL}, m AS ({metrics_sql('forecast_pairs')}) SELECT n, {round_sql(METRIC_DIGITS)} FROM m",
)
def error_metrics(spark, sf):
    return rounded(metrics.error_metrics(forecast_pairs(spark, sf)), METRIC_DIGITS)


@query(
    "j4_bias_corrected",
    f"""WITH {PAIRS_SQL}, b AS (SELECT value, greatest(yhat - (SELECT avg(yhat - value) FROM forecast_pairs), 0) AS yhat
    FROM forecast_pairs WHERE yhat IS NOT NULL), m AS ({metrics_sql('b')}) SELECT n, {round_sql(METRIC_DIGITS)} FROM m""",
)
def bias_corrected(spark, sf):
    return rounded(metrics.error_metrics(metrics.bias_corrected(forecast_pairs(spark, sf))), METRIC_DIGITS)


@query(
    "j5_overfit_ratio",
    f"""WITH {PAIRS_SQL}, {split_sql(14, 'forecast_pairs')}, m AS ({metrics_sql('parts', 'split')})
    SELECT round((SELECT rmse FROM m WHERE split = 'test') / (SELECT rmse FROM m WHERE split = 'train'), 8) AS overfit_ratio""",
)
def overfit(spark, sf):
    parts = dataset.split_by_time(forecast_pairs(spark, sf), 14)
    return rounded(metrics.overfit_ratio(metrics.error_metrics(parts, keys=["split"])), {"overfit_ratio": 8})


@query(
    "j6_fold_summary",
    f"""WITH {PAIRS_SQL}, d AS (SELECT date AS dd, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
      FROM (SELECT DISTINCT date FROM forecast_pairs)),
    f AS (SELECT *, unnest(range(1, 6)) AS fold FROM forecast_pairs JOIN d ON dd = date),
    v AS (SELECT * FROM f WHERE i >= n - (6 - fold) * (n // 6) AND i < n - (5 - fold) * (n // 6)),
    m AS ({metrics_sql('v', 'fold')})
    SELECT round(avg(mae), 5) AS cv_mae_mean, round(stddev_pop(mae), 5) AS cv_mae_std, round(avg(r2), 8) AS cv_r2_mean,
    round(stddev_pop(r2), 8) AS cv_r2_std FROM m""",
)
def fold_summary(spark, sf):
    rows = dataset.expanding_folds(forecast_pairs(spark, sf), folds=5).where("role = 'validation'")
    out = metrics.fold_summary(metrics.error_metrics(rows, keys=["fold"]))
    return rounded(out, {"cv_mae_mean": 5, "cv_mae_std": 5, "cv_r2_mean": 8, "cv_r2_std": 8})


@query(
    "j7_series_mae",
    f"""WITH {PAIRS_SQL} SELECT store_id, product_id, count(*) AS n, avg(abs(round(yhat * 100) - cents)) AS mae
    FROM forecast_pairs WHERE yhat IS NOT NULL GROUP BY store_id, product_id""",
)
def series_mae(spark, sf):
    cents = forecast_pairs(spark, sf).withColumn("yhat", F.round(F.col("yhat") * 100))
    out = metrics.error_metrics(cents, y="cents", keys=["store_id", "product_id"])
    return out.select("store_id", "product_id", "n", "mae")


# Simple forecasts that stand in for models, per store: value one row back, seven rows back, series mean.
MODELS_SQL = DAILY_SQL + f""",
guesses AS (SELECT store_id, value, lag(value, 1) OVER w AS lag_1, lag(value, 7) OVER w AS lag_7,
  sum(value) OVER (PARTITION BY store_id, product_id) / count(*) OVER (PARTITION BY store_id, product_id) AS series_mean
  FROM (SELECT store_id, product_id, date, cents::double AS value FROM sales_daily)
  WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date)),
long_guesses AS (SELECT store_id, 'lag_1' AS guess, value, lag_1 AS yhat FROM guesses UNION ALL
  SELECT store_id, 'lag_7', value, lag_7 FROM guesses UNION ALL SELECT store_id, 'series_mean', value, series_mean FROM guesses),
model_metrics AS (SELECT guess || '_' || store_id AS model, n, mae, rmse, r2, bias, mape, smape
  FROM ({metrics_sql('long_guesses', 'guess, store_id')}))"""


def model_metrics(spark, sf) -> DataFrame:
    """One row per simple model: each kind of guess for each store, in cents."""
    cents = sales_daily(spark, sf).select(*KEY, F.col("cents").cast("double").alias("value"))
    df = windows.add_lags(cents, lags=(1, 7))
    means = df.groupBy("store_id", "product_id").agg((F.sum("value") / F.count("value")).alias("series_mean"))
    df = df.join(means, ["store_id", "product_id"])
    guesses = df.unpivot(["store_id", "value"], ["lag_1", "lag_7", "series_mean"], "guess", "yhat")
    out = metrics.error_metrics(guesses, keys=["guess", "store_id"])
    return out.withColumn("model", F.concat_ws("_", "guess", "store_id")).drop("guess", "store_id")


VERDICT_SQL = "CASE WHEN r2 IS NULL THEN 'No R2 available' " + " ".join(
    f"WHEN r2 >= {low} THEN '{text}'" for low, text in metrics.VERDICTS
) + f" ELSE '{metrics.WORST_VERDICT}' END"


def score_sql(source: str) -> str:
    def share(order: str) -> str:
        return f"CASE WHEN count(*) OVER () = 1 THEN 1.0 ELSE (count(*) OVER () - row_number() OVER (ORDER BY {order}, model))::double / (count(*) OVER () - 1) END"

    return f"""SELECT *, round(({share('mae ASC NULLS LAST')} * 0.4::double + {share('rmse ASC NULLS LAST')} * 0.4::double
      + {share('r2 DESC NULLS LAST')} * 0.2::double) * 100, 2) AS score, {VERDICT_SQL} AS verdict FROM {source}"""


@query(
    "j10_j11_model_scores",
    f"WITH {MODELS_SQL}, s AS ({score_sql('model_metrics')}) SELECT model, round(mae, 4) AS mae, score, verdict FROM s",
)
def model_scores(spark, sf):
    out = metrics.score_models(model_metrics(spark, sf)).select("model", "mae", "score", "verdict")
    return rounded(out, {"mae": 4})


ENTRIES_SQL = MODELS_SQL + """,
entries AS (SELECT model || '_lgbm.json' AS file, 'MAE_test_corrected' AS path, mae * 0.9 AS number FROM model_metrics
  UNION ALL SELECT model || '_lgbm.json', 'MAE_test', mae FROM model_metrics
  UNION ALL SELECT model || '_lgbm.json', 'RMSE_test', rmse FROM model_metrics
  UNION ALL SELECT model || '_lgbm.json', 'R2_test', r2 FROM model_metrics
  UNION ALL SELECT model || '_lgbm.json', 'test.mae', 0 FROM model_metrics
  UNION ALL SELECT model || '_prophet.json', 'metrics.test.mae', mae FROM model_metrics
  UNION ALL SELECT model || '_prophet.json', 'metrics.test.rmse', rmse FROM model_metrics
  UNION ALL SELECT model || '_prophet.json', 'metrics.test.r2', r2 FROM model_metrics
  UNION ALL SELECT model || '_prophet.json', 'seed', 42 FROM model_metrics)"""


def metric_entries(spark, sf) -> DataFrame:
    """The metrics as entries of files with different layouts."""
    m = model_metrics(spark, sf)

    def entry(suffix, path, number):
        return F.struct(F.lit(suffix).alias("suffix"), F.lit(path).alias("path"), number.cast("double").alias("number"))

    rows = m.select(
        "model",
        F.inline(
            F.array(
                entry("_lgbm.json", "MAE_test_corrected", F.col("mae") * 0.9),
                entry("_lgbm.json", "MAE_test", F.col("mae")),
                entry("_lgbm.json", "RMSE_test", F.col("rmse")),
                entry("_lgbm.json", "R2_test", F.col("r2")),
                entry("_lgbm.json", "test.mae", F.lit(0)),
                entry("_prophet.json", "metrics.test.mae", F.col("mae")),
                entry("_prophet.json", "metrics.test.rmse", F.col("rmse")),
                entry("_prophet.json", "metrics.test.r2", F.col("r2")),
                entry("_prophet.json", "seed", F.lit(42)),
            )
        ),
    )
    return rows.select(F.concat("model", "suffix").alias("model"), "path", "number")


@query(
    "j8_normalized_metrics",
    f"""WITH {ENTRIES_SQL} SELECT file AS model, upper(replace(replace(replace(replace(path, '_test_corrected', ''), '_test', ''),
      'metrics.test.', ''), 'test.', '')) AS metric, round(number, 4) AS number FROM entries
    WHERE path NOT IN ('seed', 'test.mae') AND path <> 'MAE_test'""",
)
def normalized_metrics(spark, sf):
    return rounded(metrics.normalize_metrics(metric_entries(spark, sf)), {"number": 4})


@query(
    "j9_backend_labels",
    f"""WITH {ENTRIES_SQL} SELECT DISTINCT file AS model, CASE WHEN file LIKE '%lgbm%' THEN 'LightGBM' ELSE 'Prophet' END AS backend
    FROM entries""",
)
def backend_labels(spark, sf):
    files = metric_entries(spark, sf).select("model").distinct()
    return files.withColumn("backend", metrics.backend_label(F.col("model")))


@query(
    "j12_model_summary",
    f"""WITH {ENTRIES_SQL}, wide AS (SELECT file AS model,
      max(number) FILTER (path IN ('MAE_test_corrected', 'metrics.test.mae')) AS mae,
      max(number) FILTER (path IN ('RMSE_test', 'metrics.test.rmse')) AS rmse,
      max(number) FILTER (path IN ('R2_test', 'metrics.test.r2')) AS r2 FROM entries GROUP BY file),
    s AS ({score_sql('wide')}) SELECT model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 8) AS r2, score, verdict FROM s""",
)
def model_summary(spark, sf):
    out = metrics.summarize_models(metrics.normalize_metrics(metric_entries(spark, sf)))
    return rounded(out, {"mae": 4, "rmse": 4, "r2": 8})


@query(
    "j13_browse_metrics",
    f"""WITH {ENTRIES_SQL} SELECT file AS model, path, round(number, 4) AS number FROM entries WHERE file LIKE '%prophet%'""",
)
def browse_metrics(spark, sf):
    rows = metric_entries(spark, sf).where(metrics.backend_label(F.col("model")) == "Prophet")
    return rounded(rows, {"number": 4})
