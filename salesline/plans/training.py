"""Full feature tables, models and their forecasts (F18 to F20, H7 to H16, I4 with a model)."""

from __future__ import annotations

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from salesline.operators import dataset, features, forecast, training, windows
from salesline.plans.features import KEY, W_SQL, _lags_sql, ewma_sql, rolling_sql
from salesline.plans.forecasting import SERIES
from salesline.plans.sources import scratch
from salesline.plans.views import DAILY_SQL, sales_daily
from salesline.registry import query, rounded
from salesline.session import checkpoint_dir, cut_lineage
from salesline.sources.files import fingerprint

MODEL_FEATURES = [
    *[f"lag_{k}" for k in windows.LAGS], *[f"roll_{s}_{w}" for w in windows.WINDOWS for s in ("mean", "std")],
    *[f"ewma_{w}" for w in windows.WINDOWS], "dayofweek", "month", "day_of_year_sin", "day_of_year_cos",
]

FULL_SQL = DAILY_SQL + f""", {ewma_sql(7)}, f AS (SELECT store_id, product_id, date, value, on_promo,
  {_lags_sql((1, 7, 28))}, {rolling_sql([7], ('mean', 'max'), 6)} FROM sales_daily {W_SQL}),
means AS (SELECT store_id, (count(*) * avg(value) + 10 * (SELECT avg(value) FROM sales_daily)) / (count(*) + 10) AS enc
  FROM sales_daily GROUP BY store_id),
codes AS (SELECT store_id, row_number() OVER (ORDER BY store_id) - 1 AS code FROM (SELECT DISTINCT store_id FROM sales_daily)),
products AS (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS pcode FROM (SELECT DISTINCT product_id FROM sales_daily))"""


@query(
    "f18_full_features",
    f"""WITH {FULL_SQL} SELECT code::int AS store_id, pcode::int AS product_id, date, lag_1, lag_7, lag_28,
    roll_mean_7, roll_max_7, round(ewma_7, 3) AS ewma_7, (isodow(date) - 1)::int AS dayofweek, quarter(date)::int AS quarter,
    round(lag_1 - lag_7, 2) AS lag_diff_1_7, round(enc, 5) AS store_id_target_enc FROM f JOIN ewma_7 USING (store_id, product_id, date)
    JOIN means USING (store_id) JOIN codes USING (store_id) JOIN products USING (product_id)""",
)
def full_features(spark, sf):
    out, _ = features.build_features(sales_daily(spark, sf).drop("cents"))
    digits = {"roll_mean_7": 6, "ewma_7": 3, "lag_diff_1_7": 2, "store_id_target_enc": 5}
    return rounded(
        out.select(*KEY, "lag_1", "lag_7", "lag_28", "roll_max_7", "dayofweek", "quarter", *digits), digits
    )


@query(
    "f19_drop_short_lags",
    f"""WITH {DAILY_SQL} SELECT store_id, product_id, date, {_lags_sql((14, 21, 28))} FROM sales_daily {W_SQL}""",
)
def drop_short_lags(spark, sf):
    return windows.drop_short_lags(windows.add_lags(sales_daily(spark, sf).select(*KEY, "value")), 14).drop("value")


@query(
    "f20_drop_warm_up",
    f"""WITH {DAILY_SQL}, f AS (SELECT store_id, product_id, date, {_lags_sql((1, 28))} FROM sales_daily {W_SQL})
    SELECT * FROM f WHERE lag_28 IS NOT NULL""",
)
def drop_warm_up(spark, sf):
    rows = windows.add_lags(sales_daily(spark, sf), lags=(1, 28)).select(*KEY, "lag_1", "lag_28")
    return windows.drop_warm_up(rows)


def model_rows(spark, sf):
    """Training and test rows with known features, stored once for the many passes of a fit."""
    table = features.numeric_features(sales_daily(spark, sf))
    rows = features.training_rows(table, MODEL_FEATURES).select(*KEY, "value", "price", "on_promo", "is_weekend", *MODEL_FEATURES)
    rows = dataset.split_by_time(cut_lineage(rows), 28)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def fit_trees(train, names=MODEL_FEATURES):
    """Boosted trees of full size; the last days of ``train`` stop them early."""
    flagged = cut_lineage(dataset.validation_flag(train, 28))
    return training.fit(flagged, names, training.boosted_trees(**training.FULL_TREES), "is_validation", patience=training.PATIENCE)


@query("h7_boosted_trees")
def boosted_trees(spark, sf):
    """Forecast of the test days by boosted trees that stop early on the validation days."""
    train, test = model_rows(spark, sf)
    return training.predict(fit_trees(train), test).select(*KEY, "value", "yhat")


@query("h8_parameter_search")
def parameter_search(spark, sf):
    """The whole search; one that was interrupted goes on from the ledger of the same rows in the shared folder."""
    train, _ = model_rows(spark, sf)
    folded = cut_lineage(dataset.expanding_folds(train))
    rows = fingerprint(folded).select(F.md5(F.to_json(F.struct("*")))).first()[0]
    trials = training.search(
        folded, MODEL_FEATURES, training.random_params(training.TRIALS), patience=training.PATIENCE, ledger=f"{checkpoint_dir(spark)}/search/{rows}"
    )
    names = ("maxDepth", "stepSize")
    more = ("maxIter", "subsamplingRate", "minInstancesPerNode")
    rows = [(i + 1, *(t.params[n] for n in names), t.rmse, t.std, *(t.params[n] for n in more)) for i, t in enumerate(trials)]
    schema = "place int, max_depth int, step_size double, rmse double, std double, max_iter int, subsampling_rate double, min_instances int"
    return spark.createDataFrame(rows, schema)


@query("h9_seasonal_regression")
def seasonal_regression(spark, sf):
    train, test = model_rows(spark, sf)
    models = training.fit_seasonal(train, SERIES)
    return training.predict_seasonal(models, test, SERIES, train=train).select(*KEY, "value", "yhat", "status")


TREND_SQL = DAILY_SQL + """, t AS (SELECT store_id, product_id, date, ln(1 + greatest(value, 0)) AS y, (date - DATE '1970-01-01')::double AS day
      FROM sales_daily WHERE value IS NOT NULL),
    g AS (SELECT store_id, product_id, count(*) AS n, min(day) AS origin, greatest(max(day) - min(day), 1) AS span FROM t GROUP BY ALL HAVING count(*) >= 30),
    s AS (SELECT t.store_id, t.product_id, any_value(n) AS n, sum((day - origin) / span) AS sx, sum(((day - origin) / span) ** 2) + 1 AS sxx,
      sum(y) AS sy, sum(y * (day - origin) / span) AS sxy FROM t JOIN g USING (store_id, product_id) GROUP BY ALL)"""


@query(
    "h9_trend_regression",
    f"""WITH {TREND_SQL} SELECT store_id, product_id, n::int AS rows, round((sxx * sy - sx * sxy) / (n * sxx - sx * sx), 6) AS level,
    round((n * sxy - sx * sy) / (n * sxx - sx * sx), 6) AS slope, 'trained' AS status FROM s""",
)
def trend_regression(spark, sf):
    """The regression without waves and regressors, whose coefficients have a closed form."""
    models = training.fit_seasonal(sales_daily(spark, sf), SERIES, regressors=(), waves=())
    terms = {"level": F.get("coefficients", F.lit(0)), "slope": F.get("coefficients", F.lit(1))}
    return rounded(models.withColumns(terms).select(*SERIES, "rows", *terms, "status"), {"level": 6, "slope": 6})


@query("h13_feature_importance")
def feature_importance(spark, sf):
    train, _ = model_rows(spark, sf)
    return training.importance(fit_trees(train), MODEL_FEATURES)


@query("h15_all_backends")
def all_backends(spark, sf):
    train, test = model_rows(spark, sf)
    backends = {
        "boosted_trees": lambda target: training.boosted_trees(target, **training.FULL_TREES),
        "forest": training.BACKENDS["forest"],
        "linear": training.BACKENDS["linear"],
        "broken": lambda target: training.boosted_trees("no_such_column"),
    }
    flagged = cut_lineage(dataset.validation_flag(train, 28))
    found = training.train_all(flagged, test, MODEL_FEATURES, backends=backends, validation="is_validation", patience=training.PATIENCE)
    return found.report(spark)


BUNDLE_FEATURES = [*MODEL_FEATURES, *SERIES, "store_id_target_enc", "product_id_target_enc", "store_dayofweek", "month_store", "price"]


def stored_bundle(spark, daily, make):
    """A model trained on the feature table with codes and target means, written with all it needs and read back."""
    table, encoders = features.build_features(daily)
    rows = features.training_rows(table, BUNDLE_FEATURES).select(*SERIES, "date", "value", *[c for c in BUNDLE_FEATURES if c not in SERIES])
    train = dataset.split_by_time(cut_lineage(rows), 28).where("split = 'train'")
    path = scratch(spark)
    training.Bundle(make(train), BUNDLE_FEATURES, encoders).save(path)
    return training.Bundle.load(spark, path)


@query("h16_recomputed_bias")
def recomputed_bias(spark, sf):
    """The bias of a stored linear model, on features built again from the series."""
    daily = cut_lineage(sales_daily(spark, sf))
    bundle = stored_bundle(spark, daily, lambda train: training.fit(train, BUNDLE_FEATURES, training.BACKENDS["linear"]("value")))
    return training.recompute_bias(bundle, daily, 28)[1]


# The longest lag leaves out the first 28 days of a series; windows need fewer.
CHECKED_SQL = f"""WITH {DAILY_SQL}, known AS (SELECT date FROM (SELECT date, row_number() OVER (PARTITION BY store_id, product_id ORDER BY date) AS n
      FROM sales_daily) WHERE n > 28)
    SELECT count(*) AS n, true AS unbiased FROM known WHERE date >= (SELECT min(date) FROM (SELECT DISTINCT date FROM known ORDER BY date DESC LIMIT 28))"""


@query("h16_corrected_model", CHECKED_SQL)
def corrected_model(spark, sf):
    """A stored forest whose bias is recomputed, and whose corrected scores of the same rows are unbiased."""
    forest = RandomForestRegressor(labelCol="value", featuresCol="features", predictionCol="yhat", numTrees=10, maxDepth=5, seed=42)
    daily = cut_lineage(sales_daily(spark, sf))
    bundle = stored_bundle(spark, daily, lambda train: training.fit(train, BUNDLE_FEATURES, forest))
    corrected, _ = training.recompute_bias(bundle, daily, 28)
    scored = training.predict(corrected.model, cut_lineage(features.training_rows(corrected.table(daily), BUNDLE_FEATURES)))
    scored = scored.withColumn("yhat", corrected.post.corrected(F.col("yhat")))
    held = dataset.split_by_time(scored, 28).where("split = 'test'")
    return held.agg(F.count(F.lit(1)).alias("n"), (F.abs(F.avg(F.col("yhat") - F.col("value"))) < 1e-6).alias("unbiased"))


@query("i4_recursive_trees")
def recursive_trees(spark, sf):
    """Boosted trees of a stored bundle, forecasting all series a week ahead."""
    daily = cut_lineage(sales_daily(spark, sf))
    bundle = stored_bundle(spark, daily, lambda train: fit_trees(train, BUNDLE_FEATURES))
    return bundle.forecast(daily, 7, seasonal=True)


@query(
    "g6_split_codes",
    f"""WITH {DAILY_SQL}, s AS (SELECT *, product_id || '-' || (CASE WHEN date < DATE '1998-01-01' THEN store_id
      ELSE 'S' || (cents % 40) END) AS mark FROM sales_daily),
    codes AS (SELECT mark, row_number() OVER (ORDER BY mark) - 1 AS code, count(*) OVER () AS n FROM
      (SELECT DISTINCT mark FROM s WHERE date < DATE '1998-01-01'))
    SELECT store_id, product_id, date, coalesce(code, (SELECT max(n) FROM codes))::double AS mark_code
    FROM s LEFT JOIN codes USING (mark)""",
)
def split_codes(spark, sf):
    """Codes learned on the training rows only and used on all; new texts share one extra code."""
    from salesline.operators.encode import fit_string_codes

    old = F.col("date") < F.lit("1998-01-01").cast("date")
    shop = F.when(old, F.col("store_id")).otherwise(F.concat(F.lit("S"), (F.col("cents") % 40).cast("string")))
    rows = sales_daily(spark, sf).withColumn("mark", F.concat_ws("-", "product_id", shop))
    model = fit_string_codes(rows.where(old), ["mark"])
    return model.transform(rows).select(*KEY, "mark_code")


@query(
    "g5_stored_encoders",
    f"""WITH {DAILY_SQL} SELECT store_id, (row_number() OVER (ORDER BY store_id) - 1)::int AS code
    FROM (SELECT DISTINCT store_id FROM sales_daily)""",
)
def stored_encoders(spark, sf):
    from salesline.operators import encode

    path = scratch(spark)
    encode.save_encoders({"store_id": encode.fit_labels(sales_daily(spark, sf), "store_id")}, path, "label")
    return encode.load_encoder(spark, path, "label", "store_id")


@query(
    "g5_stored_means",
    f"""WITH {DAILY_SQL}, g AS (SELECT avg(value) AS m FROM sales_daily) SELECT product_id,
    round((sum(value) + 10 * (SELECT m FROM g)) / (count(value) + 10), 5) AS encoded, round((SELECT m FROM g), 5) AS global_mean
    FROM sales_daily GROUP BY product_id""",
)
def stored_means(spark, sf):
    """Smoothed target means written with the encoders and read back."""
    from salesline.operators import encode

    path = scratch(spark)
    encode.save_encoders({"product_id": encode.fit_target_means(sales_daily(spark, sf), "product_id")}, path, "target")
    return rounded(encode.load_encoder(spark, path, "target", "product_id"), {"encoded": 5, "global_mean": 5})
