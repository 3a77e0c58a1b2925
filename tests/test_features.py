"""Cleaning, features and encodings on small frames, compared with pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesline.functions.calendar import add_time_features
from salesline.operators import clean, dataset, encode, features, metrics, windows
from salesline.operators.ordering import Series


@pytest.fixture(scope="module")
def train(spark):
    values = [1.0, 2.0, None, 4.0, 100.0, 6.0, 7.0, None, 9.0, 10.0]
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(10)]
    return spark.createDataFrame(
        [(i, d, v, "ab"[i % 2]) for i, (d, v) in enumerate(zip(days, values))],
        "rid int, date date, value double, category string",
    )


@pytest.fixture(scope="module")
def sales(spark):
    """Three series of different length, one constant, one of a single row, with unknown values."""
    rng = np.random.default_rng(11)
    frames = []
    for store, product, n in (("S1", "A", 120), ("S1", "B", 60), ("S2", "A", 1)):
        value = rng.gamma(3, 40, n).round(2)
        value[rng.random(n) < 0.1] = np.nan
        if product == "B":
            value[:] = 50.0
        frames.append(
            pd.DataFrame(
                {
                    "store_id": store, "product_id": product, "date": pd.date_range("2024-01-01", periods=n).date,
                    "value": value, "on_promo": rng.integers(0, 2, n), "price": rng.normal(10, 1, n),
                }
            )
        )
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    return pdf, df


def test_mean_fill_and_outlier(train):
    out = clean.clean(train, strategy="mean", threshold=2.0, keys=()).toPandas()
    assert out["value"].notna().all() and not (out["value"] == 100).any()


def test_outlier_edge_cases(spark):
    schema = "rid int, value double"
    for rows in ([(1, 5.0)], [(1, 5.0), (2, 5.0)], [(1, None), (2, None)]):
        assert clean.remove_outliers(spark.createDataFrame(rows, schema)).count() == len(rows)
    assert clean.remove_outliers(spark.createDataFrame([(1, 5.0)], schema), threshold=0).count() == 1


def test_features_without_groups(train):
    filled = clean.clean(train, threshold=None, keys=())
    out, _ = features.build_features(filled, lags=[1, 2], sizes=[3])
    assert {"lag_1", "lag_2", "roll_mean_3", "dayofweek", "is_weekend"} <= set(out.columns)
    assert out.count() == 10


def test_codes_are_integers(train):
    out, encoders = encode.encode_categorical(train, ["category"])
    assert dict(out.dtypes)["category"] == "int"
    assert {r["category"]: r["code"] for r in encoders["category"].collect()} == {"a": 0, "b": 1}
    unseen = train.withColumn("category", F.lit("z"))
    assert {r[0] for r in encode.encode_categorical(unseen, ["category"], encoders)[0].select("category").collect()} == {-1}


def test_target_means_edge_cases(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 8.0)], "c string, value double")
    out, _ = encode.add_target_encoding(df, ["c"])
    got = {r["c"]: r["c_target_enc"] for r in out.collect()}
    assert got["a"] == pytest.approx((2 * 2 + 10 * 4) / 12)
    assert got["b"] == got[None] == pytest.approx(4)


def test_rolling_matches_pandas(sales):
    pdf, df = sales
    out = windows.add_rolling(windows.add_lags(df)).toPandas().sort_values(["store_id", "product_id", "date"])
    grouped = pdf.groupby(["store_id", "product_id"])["value"]
    for k in windows.LAGS:
        np.testing.assert_allclose(out[f"lag_{k}"].astype(float), grouped.shift(k))
    for w in windows.WINDOWS:
        for stat in ("mean", "std", "min", "max"):
            want = grouped.transform(
                lambda x, w=w, s=stat: getattr(x.shift(1).rolling(w, min_periods=max(w // 2, 3)), s)()
            )
            want = want.fillna(0) if stat == "std" else want
            np.testing.assert_allclose(out[f"roll_{stat}_{w}"].astype(float), want, rtol=1e-9, atol=1e-6)


def test_features_use_the_past_only(sales):
    _, df = sales
    day = "2024-02-15"
    changed = df.withColumn("value", F.when(F.col("date") >= day, F.lit(1e6)).otherwise(F.col("value")))
    columns = [c for c in features.numeric_features(df).columns if c.startswith(("lag", "roll", "ewma"))]
    keep = ["store_id", "product_id", "date", *columns]
    before, after = (
        features.numeric_features(d).where(F.col("date") <= day).select(keep).toPandas().sort_values(keep[:3])
        for d in (df, changed)
    )
    pd.testing.assert_frame_equal(before.reset_index(drop=True), after.reset_index(drop=True))


def test_stored_encoders_are_reused(sales, tmp_path, spark):
    _, df = sales
    _, encoders = features.build_features(df)
    one = df.where("store_id = 'S2'")
    out, _ = features.build_features(one, encoders=encoders)
    assert out.first()["store_id"] == 1
    encode.save_encoders(encoders.means, str(tmp_path), "target")
    loaded = encode.load_encoder(spark, str(tmp_path), "target", "store_id")
    assert sorted(loaded.collect()) == sorted(encoders.means["store_id"].select(loaded.columns).collect())


def test_null_dates_give_null_parts(spark):
    out = add_time_features(spark.createDataFrame([(None,)], "date date")).first()
    assert out["week_of_year"] is None and out["month_sin"] is None


def test_duplicate_dates_with_tie_breaker(spark):
    rows = [("a", dt.date(2024, 1, 1), i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, date date, rid int, value double")
    series = Series(("k",), ("date", "rid"), daily=False)
    got = windows.add_lags(df, lags=(1,), series=series).orderBy("rid").toPandas()["lag_1"].tolist()
    assert got[1:] == [0.0, 1.0, 2.0, 3.0]


def test_split_and_folds(sales):
    _, df = sales
    split = dataset.split_by_time(df, 14).toPandas()
    assert split[split["split"] == "test"]["date"].min() == dt.date(2024, 4, 16)
    assert dataset.split_by_time(df, 500).where("split = 'test'").select("date").distinct().count() == 120 // 5
    folds = dataset.expanding_folds(df, by="row", folds=3, blocks=3).toPandas()
    n = len(split)
    size = n // 4
    for k in (1, 2, 3):
        part = folds[folds["fold"] == k]
        assert (part["role"] == "train").sum() == n - (4 - k) * size
        assert (part["role"] == "validation").sum() == size


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.5, 1.0), (None, 3.0)], "value double, yhat double")
    row = metrics.error_metrics(df).first()
    assert row["n"] == 2 and row["mape"] is None
    assert row["smape"] == pytest.approx((0 + 0.5 / 0.75) / 2 * 100)
    one = spark.createDataFrame([("m", 1.0, 1.0, None)], "model string, mae double, rmse double, r2 double")
    scored = metrics.score_models(one).first()
    assert scored["score"] == 100.0 and scored["verdict"] == metrics.NO_VERDICT
    flat = spark.createDataFrame([("test", 2.0), ("train", 0.0)], "split string, rmse double")
    assert metrics.overfit_ratio(flat).first()[0] == float("inf")
