"""Forecasts against a plain pandas calculation, and models against their own predictions."""

import datetime as dt
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from salesline.operators import features, forecast, training

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ["store_id"]
LAGS, SIZES = (1, 7), (7,)


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(5)
    frames = []
    for store, n in (("S1", 90), ("S2", 40), ("S3", 5)):
        day = pd.date_range("2024-03-01", periods=n)
        value = (100 + 20 * np.sin(day.dayofweek.to_numpy()) + rng.normal(0, 5, n)).round(2)
        value[rng.random(n) < 0.08] = np.nan
        frames.append(pd.DataFrame({"store_id": store, "date": day, "value": value}))
    frames.append(pd.DataFrame({"store_id": "S4", "date": pd.date_range("2024-03-01", periods=3), "value": np.nan}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf.assign(date=pdf["date"].dt.date))
    return pdf, df.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


NAMES = ["lag_1", "roll_mean_7", "ewma_7", "dayofweek", "roll_std_7"]
FORMULA = "0.4D * lag_1 + 0.3D * roll_mean_7 + 0.3D * ewma_7 + dayofweek - 0.1D * roll_std_7"


def model():
    return SQLTransformer(statement=f"SELECT *, {FORMULA} AS yhat FROM __THIS__")


def score(t):
    return (0.4 * t["lag_1"] + 0.3 * t["roll_mean_7"] + 0.3 * t["ewma_7"] + t["dayofweek"] - 0.1 * t["roll_std_7"]).to_numpy()


def by_hand(pdf, horizon, observed_row):
    """The same forecast, recomputing every feature from the whole history at each step."""
    out = []
    for store, g in pdf.groupby("store_id"):
        known = g["value"].dropna()
        if known.empty:
            continue
        factors = {}
        if len(known) >= 14:
            by_day = known.groupby(g.loc[known.index, "date"].dt.dayofweek).mean() / known.mean()
            factors = {d: by_day.get(d, 1.0) for d in range(7)}
        x, day = list(g["value"]), g["date"].iloc[-1]
        for step in range(1, horizon + 1):
            past = pd.Series(x[:-1] if observed_row else x)
            when = day if observed_row else day + pd.Timedelta(days=1)
            roll = past.rolling(7, min_periods=3)
            f = {
                "lag_1": past.iloc[-1], "lag_7": past.iloc[-7] if len(past) >= 7 else np.nan,
                "roll_mean_7": roll.mean().iloc[-1], "roll_std_7": np.nan_to_num(roll.std().iloc[-1]),
                "ewma_7": past.ewm(span=7, min_periods=3).mean().iloc[-1], "dayofweek": when.dayofweek,
            }
            cells = [f["lag_1"], f["lag_7"], f["lag_1"] - f["lag_7"], f["lag_1"] / f["lag_7"]]
            raw = score(pd.DataFrame([{k: np.nan_to_num(v) for k, v in f.items()}]))[0]
            enough = sum(np.isnan(c) for c in cells) < len(cells) // 2
            yhat = max(raw if enough else known.iloc[-1], 0.0)
            day += pd.Timedelta(days=1)
            if factors:
                yhat = max(yhat * (1 + 0.7 * (factors[day.dayofweek] - 1)), 0.0)
            out.append((store, step, day.date(), round(yhat, 2)))
            x.append(yhat)
    return pd.DataFrame(out, columns=["store_id", "step", "ds", "yhat"])


@pytest.mark.parametrize("observed_row", [False, True])
def test_recursive_forecast(history, observed_row):
    pdf, df = history
    got = forecast.recursive_forecast(df, KEYS, 10, model(), NAMES, LAGS, SIZES, observed_row=observed_row)
    got = got.toPandas().sort_values(["store_id", "step"]).reset_index(drop=True)
    want = by_hand(pdf, 10, observed_row)
    assert got["ds"].tolist() == want["ds"].tolist()
    np.testing.assert_allclose(got["yhat"], want["yhat"], atol=0.011)


def test_horizon_limits(history):
    with pytest.raises(ValueError):
        forecast.naive_forecast(history[1], KEYS, 0)
    with pytest.raises(ValueError):
        forecast.check_horizon(366, most=365)


def test_post_processing_stages(history):
    _, df = history
    post = forecast.PostProcessing(bias=-1e6, floor=3.0, strength=0.0)
    rows = forecast.recursive_forecast(df, KEYS, 2, model(), NAMES, LAGS, SIZES, post=post, errors=True).toPandas()
    assert rows[rows["store_id"] == "S4"][["ds", "error"]].values.tolist() == [[None, "no_values"]]
    rows = rows[rows["error"].isna()]
    few = rows[rows["store_id"] == "S3"]  # too few lags: no score counts, so no stage is shown
    assert few[["raw_model", "corrected", "before_seasonality", "dow"]].isna().all().all() and few["yhat"].notna().all()
    scored = rows[(rows["store_id"] != "S3") & (rows["step"] == 2)]
    assert len(scored) == 2
    assert (scored["before_seasonality"] == 3.0).all()
    np.testing.assert_allclose(scored["corrected"], scored["raw_model"] - 1e6, rtol=1e-9)
    raw = df.sparkSession.createDataFrame([(0.5,), (800.0,)], "raw double")
    got = [r[0] for r in raw.select(forecast.PostProcessing(log1p=True, bias=2.0).corrected(F.col("raw"))).collect()]
    assert got[0] == pytest.approx(np.expm1(0.5) + 2) and np.isinf(got[1])
    with pytest.raises(ValueError, match="price"):
        forecast.recursive_forecast(df, KEYS, 1, model(), [*NAMES, "price"], LAGS, SIZES)


def test_state_features_are_those_of_the_table(history):
    """The features of the next day equal those that the training table has for a row of that day."""
    _, df = history
    df = df.withColumn("product_id", F.lit("A"))
    keys = ["store_id", "product_id"]
    table, encoders = features.build_features(df, lags=LAGS, sizes=SIZES)
    state = forecast.series_state(df, keys, (*LAGS, 8), SIZES)
    made = forecast.StateFeatures(LAGS, SIZES, keys, encoders).add(state)
    ahead = df.groupBy(*keys).agg(F.date_add(F.max("date"), 1).alias("date")).withColumn("value", F.lit(None).cast("double"))
    longer, _ = features.build_features(df.unionByName(ahead), lags=LAGS, sizes=SIZES, encoders=encoders)
    last = longer.where("value is null").join(ahead.select("date", F.col("store_id").alias("_s")), "date")
    names = [c for c in table.columns if c != "value"]
    assert set(names) <= set(made.columns)
    got = made.select(*names).toPandas().set_index("store_id").sort_index()
    codes = {r.code: r.store_id for r in encoders.labels["store_id"].collect()}
    want = last.select("_s", *names).toPandas()
    want = want[want["store_id"].map(codes) == want["_s"]].drop(columns="_s").set_index("store_id").sort_index()
    pd.testing.assert_frame_equal(got, want[got.columns], check_dtype=False, rtol=1e-9)


def test_single_request(spark):
    rows = [("test_store", dt.date(2025, 1, d), v) for d, v in ((1, 10.0), (2, 12.0), (3, 11.0))]
    df = spark.createDataFrame(rows, "id string, date date, value double")
    out = forecast.naive_forecast(df, ["id"], 3).orderBy("ds").collect()
    assert [r["yhat"] for r in out] == [11.0] * 3
    assert [r["ds"].day for r in out] == [4, 5, 6]


@pytest.fixture(scope="module")
def model_data(spark):
    rng = np.random.default_rng(1)
    frames = []
    for s in range(4):
        day = pd.date_range("2023-01-01", periods=150)
        value = 50 + 10 * s + 15 * (day.dayofweek >= 5) + rng.normal(0, 3, len(day))
        frames.append(pd.DataFrame({"store_id": f"S{s}", "product_id": "A", "date": day.date, "value": value}))
    pdf = pd.concat(frames).assign(price=2.0, on_promo=0)
    df = spark.createDataFrame(pdf)
    names = ["lag_1", "lag_7", "roll_mean_7", "ewma_7", "dayofweek", "is_weekend"]
    rows = features.training_rows(features.numeric_features(df, lags=(1, 7), sizes=(7,)), names)
    return df, rows.cache(), names


@pytest.mark.parametrize("backend", ["boosted_trees", "linear"])
def test_bundle(model_data, tmp_path, spark, backend):
    df, _, names = model_data
    names = [*names, "store_id", "store_id_target_enc", "store_dayofweek", "price"]
    table, encoders = features.build_features(df, lags=(1, 7), sizes=(7,))
    rows = features.training_rows(table, names)
    estimator = training.boosted_trees(maxIter=10, maxDepth=3) if backend == "boosted_trees" else training.BACKENDS[backend]("value")
    made = training.Bundle(training.fit(rows, names, estimator), names, encoders, lags=(1, 7), windows=(7,))
    error = training.metrics.error_metrics(training.predict(made.model, rows)).first()
    assert error["r2"] > 0.8
    made.save(str(tmp_path / "model"))
    loaded = training.Bundle.load(spark, str(tmp_path / "model"))
    a, b = (m.predict(df).orderBy("store_id", "date").select("yhat").toPandas() for m in (made, loaded))
    pd.testing.assert_frame_equal(a, b)
    ahead = loaded.forecast(df, 3, seasonal=False).toPandas()
    assert len(ahead) == 12 and (ahead["yhat"] >= 0).all() and ahead["error"].isna().all()
    # the first step is the model's own score of a row of that day
    last = df.groupBy("store_id", "product_id").agg(F.date_add(F.max("date"), 1).alias("date"), F.max("price").alias("price"))
    longer = df.unionByName(last.withColumns({"value": F.lit(0.0), "on_promo": F.lit(0)}), allowMissingColumns=True)
    scored = loaded.predict(longer).where(F.col("date") == last.agg(F.max("date")).scalar()).toPandas()
    np.testing.assert_allclose(sorted(scored["yhat"]), sorted(ahead[ahead["step"] == 1]["yhat"]), atol=0.006)
    corrected, found = training.recompute_bias(loaded, df, 14)
    found = found.first()
    assert found["bias"] == -found["bias_correction"] == -corrected.post.bias
    if backend == "boosted_trees":
        top = training.importance(loaded.model, names, top=3).collect()
        assert len(top) == 3 and top[0]["importance"] >= top[2]["importance"]


def test_one_failing_backend_does_not_stop_the_rest(model_data):
    _, rows, names = model_data
    backends = {"linear": training.BACKENDS["linear"], "broken": lambda _: training.boosted_trees("missing")}
    out = training.train_all(rows, rows, names, backends=backends)
    assert set(out.models) == {"linear"} and set(out.errors) == {"broken"}
    assert out.metrics.count() == 2


def test_search_orders_trials(model_data, tmp_path, monkeypatch):
    from salesline.operators import dataset

    _, rows, names = model_data
    folded = dataset.expanding_folds(rows, folds=2)
    chosen = [{"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0}, {"maxIter": 5, "maxDepth": 3, "subsamplingRate": 1.0}]
    fits = []
    monkeypatch.setattr(training, "boosted_trees", lambda *a, _made=training.boosted_trees, **k: fits.append(k) or _made(*a, **k))
    ledger = str(tmp_path / "ledger")
    trials = training.search(folded, names, chosen[:1], ledger=ledger, patience=2)
    assert len(fits) == 2
    trials = training.search(folded, names, chosen, ledger=ledger, patience=2)  # goes on: two fits are done already
    assert len(fits) == 4 and fits[2:] == [chosen[1]] * 2
    assert trials[0].params == chosen[1] and trials[0].rmse <= trials[1].rmse
    for t in trials:
        errors = []
        for k in (0, 1) if folded.where("fold = 0").count() else (1, 2):
            part = folded.where(F.col("fold") == k).withColumn("v", F.col("role") == "validation")
            model = training.fit(part, names, training.boosted_trees(**t.params), "v", patience=2)
            errors.append(training.metrics.error_metrics(training.predict(model, part.where("v")).withColumn("yhat", F.greatest("yhat", F.lit(0.0)))).first()["rmse"])
        assert t.rmse == pytest.approx(np.mean(errors), rel=1e-9)


def test_seasonal_regression(spark):
    day = pd.date_range("2022-01-01", periods=400)
    value = np.exp(3 + 0.3 * np.sin(2 * np.pi * day.dayofyear / 365.25) + 0.2 * (day.dayofweek >= 5)) - 1
    pdf = pd.DataFrame({"store_id": "S1", "date": day.date, "value": value})
    short = pd.DataFrame({"store_id": "S2", "date": day.date[:10], "value": 1.0})
    both = pd.concat([pdf, short]).assign(price=1.0, on_promo=0, is_weekend=0)
    df = spark.createDataFrame(both)
    models = training.fit_seasonal(df, KEYS)
    fitted = models.where("store_id = 'S1'").first()
    t = (pdf["date"] - pdf["date"].min()).map(lambda d: d.days).to_numpy() + (pdf["date"].min() - dt.date(1970, 1, 1)).days
    x = [np.ones(len(t)), (t - t.min()) / (t.max() - t.min())]
    for period, terms in training.WAVES:
        x += [f(2 * np.pi * k * t / period) for k in range(1, terms + 1) for f in (np.sin, np.cos)]
    x = np.column_stack([*x, np.zeros((len(t), 3))])
    beta = np.linalg.solve(x.T @ x + np.diag([0.0] + [1.0] * (x.shape[1] - 1)), x.T @ np.log1p(value))
    np.testing.assert_allclose(fitted["coefficients"], beta, atol=1e-6)
    assert {r["store_id"]: r["status"] for r in models.collect()} == {"S1": "trained", "S2": "skipped"}
    scored = training.predict_seasonal(models, df, KEYS).toPandas()
    good = scored[scored["store_id"] == "S1"]
    assert np.abs(good["yhat"] / good["value"] - 1).mean() < 0.03
    assert scored[scored["store_id"] == "S2"]["yhat"].isna().all()


def test_patient_boosting(spark):
    assert training.early_stop([5, 4, 4.5, 3, 3.5, 3.2, 1], 2) == (4, True)
    assert training.early_stop([5, 4, 4.5, 3, 3.5], 2) == (4, False)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = 3 * x[:, 0] + rng.normal(0, 0.1, 400)
    rows = [(float(a), float(b), float(v), i >= 300) for i, ((a, b), v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, value double, is_validation boolean").cache()
    trees = training.boosted_trees(maxIter=40, maxDepth=2, stepSize=0.1)
    model = training.fit(df, ["a", "b"], trees, "is_validation", patience=3)
    # from ten trees on, where a fit without patience and eight trees are still far off
    assert model.stages[-1].getNumTrees > 12
    noise = df.withColumn("value", F.rand(3))
    assert training.fit(noise, ["a", "b"], trees, "is_validation", patience=3).stages[-1].getNumTrees < 37


def test_patient_boosting_fits_few_trees_once(spark, monkeypatch, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import GBTRegressor

    rows = [(float(i % 20), float(i % 7), float(i % 20) * (1 if i < 200 else -1), i >= 200) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, value double, is_validation boolean").coalesce(1).cache()
    sizes = []
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, d, _fit=GBTRegressor._fit: sizes.append(self.getMaxIter()) or _fit(self, d))
    trees = training.boosted_trees(maxIter=200, maxDepth=2, stepSize=0.1, subsamplingRate=0.7)
    worse = training.fit(df, ["a", "b"], trees, "is_validation", patience=10)  # every tree raises the error on these rows
    assert worse.stages[-1].getNumTrees == 1 and sizes == [13]
    known = training.assembler(["a", "b"]).transform(df.where("not is_validation"))
    whole, refit = (trees.copy({trees.maxIter: n}).fit(known) for n in (9, 4))
    cut = training.first_trees(whole, 4)
    assert cut.getNumTrees == 4 and cut.treeWeights == refit.treeWeights and cut.getMaxIter() == 4
    assert cut.featureImportances == refit.featureImportances and cut.numFeatures == 2
    expected = [r["yhat"] for r in refit.transform(known).collect()]
    assert [r["yhat"] for r in cut.transform(known).collect()] == expected
    PipelineModel(stages=[cut]).write().save(str(tmp_path / "cut"))
    assert [r["yhat"] for r in PipelineModel.load(str(tmp_path / "cut")).transform(known).collect()] == expected


def test_patient_boosting_grows_no_more_than_needed(monkeypatch):
    from types import SimpleNamespace as Fake

    def sizes(best, most=1000):
        seen, errors = [], [abs(i - best + 1) for i in range(most)]
        model = lambda n: Fake(evaluateEachIteration=lambda *_: errors[:n])
        estimator = Fake(maxIter="n", getMaxIter=lambda: most, copy=lambda p: seen.append(p["n"]) or Fake(fit=lambda _: model(p["n"])))
        assert training.boost_patiently(None, None, estimator, 50) in (best, None)
        return seen

    monkeypatch.setattr(training, "first_trees", lambda model, trees: trees)
    assert sizes(1) == sizes(11) == [61] and sizes(30) == [61, 91] and sizes(45) == [61, 106]
    assert sizes(60) == [61, 122] and sizes(400) == [61, 122, 244, 488]


def test_search_deals_few_rows_to_one_task(model_data, monkeypatch):
    from salesline.operators import dataset

    _, rows, names = model_data
    folded = dataset.expanding_folds(rows, folds=2).repartition(8)
    trials = [{"maxIter": n, "maxDepth": n, "subsamplingRate": 1.0} for n in (1, 2)]
    seen = []

    def watched(known, held, estimator, patience, _boost=training.boost_patiently):
        seen.append((estimator.getMaxDepth() * known.count(), known.rdd.getNumPartitions()))
        return _boost(known, held, estimator, patience)

    monkeypatch.setattr(training, "boost_patiently", watched)
    few = training.search(folded, names, trials, patience=2, parallel=1)
    assert len(seen) == 4 and {tasks for _, tasks in seen} == {1}
    assert [work for work, _ in seen] == sorted((work for work, _ in seen), reverse=True)  # the longest fits begin
    monkeypatch.setattr(training, "FIT_ROWS", 1)
    many = training.search(folded, names, trials, patience=2)
    assert len(seen) == 8 and min(tasks for _, tasks in seen[4:]) > 1
    assert [t.params for t in few] == [t.params for t in many]
    assert [t.rmse for t in few] == pytest.approx([t.rmse for t in many], rel=1e-9)


@pytest.fixture(scope="module")
def noisy(spark):
    """Training and validation rows: a column of many values, one of few, one of no use."""
    rng = np.random.default_rng(11)
    a, b, c = rng.normal(size=900), rng.integers(0, 9, 900), rng.random(900)
    y = 1e4 + 30 * a + 7 * (b % 3) + rng.normal(0, 9, 900)
    rows = [(float(u), float(v), float(w), float(x), i >= 600) for i, (u, v, w, x) in enumerate(zip(a, b, c, y))]
    df = training.assembler(["a", "b", "c"]).transform(spark.createDataFrame(rows, "a double, b double, c double, value double, held boolean"))
    return df.where("not held").coalesce(1).cache(), df.where("held").coalesce(1).cache()


@pytest.mark.parametrize("settings", [{"maxDepth": 1}, {"maxDepth": 4, "minInstancesPerNode": 20}, {"maxDepth": 7, "maxBins": 300, "minInfoGain": 2.0}])
def test_trees_of_one_task_are_those_of_spark(noisy, tmp_path, settings):
    from salesline.operators import boosting

    known, held = noisy
    estimator = training.boosted_trees(maxIter=8, subsamplingRate=1.0, **settings)
    want, got = estimator.fit(known), boosting.InTask(estimator).fit(known)
    assert [t.numNodes for t in got.trees] == [t.numNodes for t in want.trees]
    assert got.treeWeights == want.treeWeights and got.numFeatures == 3 and got.extractParamMap() == want.extractParamMap()
    for rows in (known, held):
        a, b = ([r["yhat"] for r in m.transform(rows).collect()] for m in (got, want))
        assert a == pytest.approx(b, rel=1e-9)
    np.testing.assert_allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), rtol=1e-6, atol=1e-9)
    got.write().save(str(tmp_path / "model"))
    assert type(got).load(str(tmp_path / "model")).toDebugString == got.toDebugString


def test_one_task_stops_and_draws_as_spark(noisy):
    from salesline.operators import boosting

    known, held = noisy
    trees = training.boosted_trees(maxIter=60, maxDepth=3, stepSize=0.1, subsamplingRate=1.0)
    want, got = (training.boost_patiently(known, held, e, 5) for e in (trees, boosting.InTask(trees)))
    assert 1 < got.getNumTrees == want.getNumTrees < 60
    half = trees.copy({trees.subsamplingRate: 0.5, trees.maxIter: 20})
    want, got, again = (e.fit(known) for e in (half, boosting.InTask(half), boosting.InTask(half)))
    assert again.toDebugString.split("\n")[1:] == got.toDebugString.split("\n")[1:]
    error = [training.metrics.error_metrics(m.transform(known)).first()["rmse"] for m in (want, got)]
    assert error[1] != error[0] and error[1] == pytest.approx(error[0], rel=0.05)


def test_one_task_takes_only_what_it_knows(noisy, monkeypatch):
    from pyspark.ml.feature import StringIndexer

    from salesline.operators import boosting

    known, _ = noisy
    trees = training.boosted_trees(maxIter=2)
    assert isinstance(boosting.in_task(trees, known, 2700), boosting.InTask)
    assert boosting.in_task(trees, known, boosting.TASK_CELLS + 1) is trees
    absolute = trees.copy({trees.lossType: "absolute"})
    assert boosting.in_task(absolute, known, 2700) is absolute
    codes = StringIndexer(inputCol="b", outputCol="code").fit(known).transform(known).drop("features")
    assert boosting.in_task(trees, training.assembler(["code"]).transform(codes), 900) is trees
    with pytest.raises(Exception, match="no rows to learn from"):
        boosting.InTask(trees).fit(known.limit(0))
    lost = known.sparkSession.createDataFrame([(float("nan"), 1.0), (2.0, 3.0)], "a double, value double")
    with pytest.raises(Exception, match="no numbers"):  # as Spark
        boosting.InTask(trees).fit(training.assembler(["a"]).transform(lost))
    assert boosting.InTask(trees.copy({trees.subsamplingRate: 0.01})).fit(known.limit(3)).getNumTrees == 2  # bags may be empty


def test_search_fits_in_one_task(model_data, monkeypatch):
    from pyspark.ml.regression import GBTRegressor

    from salesline.operators import boosting, dataset

    _, rows, names = model_data
    folded = dataset.expanding_folds(rows, folds=2)
    trials = [{"maxIter": 30, "maxDepth": n, "stepSize": 0.3, "subsamplingRate": 1.0, "minInstancesPerNode": 20} for n in (1, 3)]
    fits = []
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, d, _fit=GBTRegressor._fit: fits.append(self) or _fit(self, d))
    one = training.search(folded, names, trials, patience=2)
    assert not fits
    monkeypatch.setattr(boosting, "TASK_CELLS", 0)
    many = training.search(folded, names, trials, patience=2)  # folds too large for a task are Spark's
    assert len(fits) >= 4
    assert [t.params for t in one] == [t.params for t in many]
    assert [t.rmse for t in one] == pytest.approx([t.rmse for t in many], rel=1e-9)


def test_training_queries_are_of_full_size(spark, monkeypatch):
    from salesline.plans import training as plans

    seen = []
    monkeypatch.setattr(plans, "model_rows", lambda spark, sf: (spark.range(600).selectExpr("date_add(date'2020-01-01', int(id)) date"),) * 2)
    monkeypatch.setattr(training, "fit", lambda train, features, estimator, validation=None, tolerance=0.01, patience=None: seen.append(
        (estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getStepSize(), validation, patience)))
    monkeypatch.setattr(training, "importance", lambda model, features: None)
    plans.feature_importance(spark, "")
    assert seen == [(1000, 6, 0.05, "is_validation", 50)]
    called = {}
    monkeypatch.setattr(training, "search", lambda folded, features, trials, patience=None, ledger=None: called.update(
        folds=folded.select("fold").distinct().count(), trials=len(list(trials)), patience=patience) or [])
    plans.parameter_search(spark, "")
    assert called == {"folds": 5, "trials": 50, "patience": 50} and min(training.SEARCH_SPACE["maxIter"]) >= 500


def counted(df):
    """The rows of ``df``, and a count of how often one is read."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def mark(row):
        seen.add(1)
        return row

    return df.sparkSession.createDataFrame(df.rdd.map(mark), df.schema), seen


def test_bias_reads_the_series_once(model_data):
    df, _, names = model_data
    table, encoders = features.build_features(df, lags=(1, 7), sizes=(7,))
    model = training.fit(features.training_rows(table, names), names, training.BACKENDS["linear"]("value"))
    rows, seen = counted(df)
    _, found = training.recompute_bias(training.Bundle(model, names, encoders, lags=(1, 7), windows=(7,)), rows, 14)
    assert found.count() == 1
    assert seen.value == df.count()


def test_bias_query_reads_the_lines_once(spark, monkeypatch):
    from salesline.plans import training as plans

    daily = plans.sales_daily(spark, "/root/testdata/sf0.001")
    rows, seen = counted(daily)
    monkeypatch.setattr(plans, "sales_daily", lambda *_: rows)
    assert plans.recomputed_bias(spark, "").count() == 1
    assert seen.value == daily.count()
