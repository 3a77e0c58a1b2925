"""Fit, search, score and explain models."""

from __future__ import annotations

import json
import random
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesline.operators import boosting, dataset, encode, forecast, metrics
from salesline.operators.features import Encoders, build_features, training_rows
from salesline.operators.windows import LAGS, WINDOWS
from salesline.session import checkpoint_dir, cut_lineage

# Regularisation and harmonics of the seasonal regression.
RIDGE = 1.0
YEARLY_TERMS, WEEKLY_TERMS, MONTHLY_TERMS = 10, 3, 5
MONTH_DAYS = 30.5
Waves = Sequence[tuple[float, int]]
WAVES: Waves = ((365.25, YEARLY_TERMS), (7.0, WEEKLY_TERMS), (MONTH_DAYS, MONTHLY_TERMS))

SEARCH_SPACE: dict[str, Sequence] = {
    "maxDepth": tuple(range(4, 13)),
    "stepSize": (0.005, 0.01, 0.02, 0.05, 0.1),
    "maxIter": (500, 1000, 1500, 2000),
    "subsamplingRate": (0.6, 0.7, 0.8, 0.9, 1.0),
    "minInstancesPerNode": (10, 20, 50, 100),
}

# The sizes of a real fit; boosting ends after PATIENCE trees that do not lower the error on the validation rows.
FULL_TREES = {"maxIter": 1000, "maxDepth": 6, "stepSize": 0.05}
PATIENCE = 50
TRIALS = 50


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def boosted_trees(target: str = "value", **params) -> GBTRegressor:
    defaults = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, "minInstancesPerNode": 5, "seed": 42}
    return GBTRegressor(labelCol=target, featuresCol="features", predictionCol="yhat", **{**defaults, **params})


def fit(
    train: DataFrame,
    features: Sequence[str],
    estimator,
    validation: str | None = None,
    tolerance: float = 0.01,
    patience: int | None = None,
) -> PipelineModel:
    """Fit an estimator on the feature columns; a boolean ``validation`` column stops boosting early.

    Boosting stops at the first tree that lowers the error by less than ``tolerance``, or, with ``patience``, after so
    many trees that do not lower it; the trees up to the smallest error are kept.
    """
    if validation and patience and isinstance(estimator, GBTRegressor):
        return _fit_patiently(train, features, estimator, validation, patience)
    if validation and isinstance(estimator, GBTRegressor):
        estimator = estimator.copy({estimator.validationIndicatorCol: validation, estimator.validationTol: tolerance})
    return Pipeline(stages=[assembler(features), estimator]).fit(train)


def early_stop(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The number of trees with the smallest error before ``patience`` trees in a row lower it no more, and whether
    there were so many."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def _fit_patiently(train: DataFrame, features: Sequence[str], estimator: GBTRegressor, validation: str, patience: int) -> PipelineModel:
    stage = assembler(features)
    known, held = (stage.transform(train.where(c)) for c in (~F.col(validation), F.col(validation)))
    return PipelineModel(stages=[stage, boost_patiently(known, held, estimator, patience)])


def boost_patiently(known: DataFrame, held: DataFrame, estimator: GBTRegressor | boosting.InTask, patience: int) -> GBTRegressionModel:
    """A fit in one task counts errors as it grows. Spark's own early stop has no patience: fits of a growing number of
    trees, which begin alike, are compared by their errors after each tree. Each has few trees more than the fewest that
    can end a fit after the smallest error so far, but half as many again as the last at least, and twice as many if the
    error still falls."""
    if isinstance(estimator, boosting.InTask):
        return estimator.fit(known, held, patience)
    most, slack = estimator.getMaxIter(), patience // 5
    trees = min(most, patience + slack + 1)
    while True:
        model = estimator.copy({estimator.maxIter: trees}).fit(known)
        best, stopped = early_stop(model.evaluateEachIteration(held, "squared"), patience)
        if stopped or trees == most:
            return model if best == trees else first_trees(model, best)
        trees = min(most, 2 * trees if trees - best <= slack else max(best + patience + slack + 1, trees * 3 // 2))


def first_trees(model: GBTRegressionModel, trees: int) -> GBTRegressionModel:
    """The model of the first ``trees`` trees, which a fit of so many trees would give again."""
    context = SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml.regression
    kept = context._gateway.new_array(ml.DecisionTreeRegressionModel, trees)
    weights = context._gateway.new_array(context._jvm.double, trees)
    for i, tree in enumerate(model.trees[:trees]):
        kept[i], weights[i] = tree._java_obj, model.treeWeights[i]
    return model._copyValues(GBTRegressionModel(ml.GBTRegressionModel(model.uid, kept, weights, model.numFeatures)), {model.maxIter: trees})


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def importance(model: PipelineModel, features: Sequence[str], top: int | None = None) -> DataFrame:
    """The features a tree model uses most."""
    spark = SparkSession.getActiveSession()
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(features, map(float, weights)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


def random_params(trials: int, space: dict[str, Sequence] | None = None, seed: int = 42) -> list[dict]:
    rng = random.Random(seed)
    return [{k: rng.choice(list(v)) for k, v in sorted((space or SEARCH_SPACE).items())} for _ in range(trials)]


@dataclass(frozen=True)
class Trial:
    params: dict
    rmse: float
    std: float


LEDGER = "params string, fold int, rmse double"
# Training rows of a fit for each of its tasks: every level of every tree is a job, so that small tasks cost more than their rows.
FIT_ROWS = 100_000


def search(
    folded: DataFrame,
    features: Sequence[str],
    trials: Iterable[dict],
    target: str = "value",
    from_target: Callable[[DataFrame], DataFrame] | None = None,
    patience: int | None = None,
    ledger: str | None = None,
    parallel: int | None = None,
) -> list[Trial]:
    """Mean RMSE over the expanding folds for each set of parameters, best first.

    ``folded`` has ``fold`` and ``role`` columns. With ``patience`` the validation rows of a fold stop its boosting, as
    in ``fit``. ``from_target`` turns ``yhat`` back to the original scale, with the observed value in ``value``.

    The feature vectors are assembled and stored once, in a folder for each fold. ``parallel`` fits run side by side, as many
    as there are cores by default, each in one task (``boosting.in_task``) or, if the fold is too large, in a task for
    ``FIT_ROWS`` rows; those that may take longest begin first. Every finished pair of parameters and fold is a file of the
    ``ledger`` (a folder), from which an interrupted search goes on.
    """
    spark, trials = folded.sparkSession, list(trials)
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    assembler(features).transform(folded).drop(*[c for c in features if c != target]).write.partitionBy("fold").parquet(path)
    stored = spark.read.parquet(path)
    sizes = F.count_if(F.col("role") == "train").alias("rows"), F.count(F.lit(1)).alias("all")
    counts = stored.groupBy("fold").agg(*sizes).orderBy("fold").collect()  # a row for each fold
    folds, cells = {r["fold"]: r["rows"] for r in counts}, {r["fold"]: r["all"] * len(features) for r in counts}
    ledger = ledger or f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    spark.createDataFrame([], LEDGER).write.mode("overwrite").json(f"{ledger}/start")
    found = spark.read.schema(LEDGER).option("recursiveFileLookup", True).json(ledger).collect()  # a row for each fit
    done = {(r["params"], r["fold"]): r["rmse"] for r in found}

    def run(named: str, params: dict, fold: int) -> None:
        part = stored.where(F.col("fold") == fold)
        known, held = part.where("role = 'train'").coalesce(-(-folds[fold] // FIT_ROWS) or 1), part.where("role = 'validation'")
        estimator = boosting.in_task(boosted_trees(target, **params), known, cells[fold])
        model = boost_patiently(known, held, estimator, patience) if patience else estimator.fit(known)
        scored = model.transform(held).drop("features")
        scored = from_target(scored) if from_target else scored
        scored = scored.withColumn("yhat", F.greatest("yhat", F.lit(0.0)))
        done[named, fold] = error = metrics.error_metrics(scored).first()["rmse"]
        spark.createDataFrame([(named, fold, error)], LEDGER).coalesce(1).write.mode("overwrite").json(f"{ledger}/{zlib.crc32(named.encode())}-{fold}")

    names = [json.dumps(p, sort_keys=True) for p in trials]
    left = {(n, k): p for n, p in zip(names, trials, strict=True) for k in folds if (n, k) not in done}
    longest = sorted(left, key=lambda f: -folds[f[1]] * left[f].get("maxDepth", 5) / left[f].get("stepSize", 0.1))
    with ThreadPoolExecutor(parallel or spark.sparkContext.defaultParallelism) as pool:
        for task in [pool.submit(inheritable_thread_target(spark)(run), n, left[n, k], k) for n, k in longest]:
            task.result()
    errors = [[done[n, k] for k in folds] for n in names]
    return sorted((Trial(p, float(np.mean(e)), float(np.std(e))) for p, e in zip(trials, errors, strict=True)), key=lambda t: t.rmse)


# --------------------------------------------------------------------------- seasonal regression


def _design(day: Column, origin: Column, span: Column, waves: Waves, regressors: Sequence[Column]) -> Column:
    """Constant, trend, sines and cosines of every wave, and the regressors, as one array."""
    cols = [F.lit(1.0), (day - origin) / span]
    for period, terms in waves:
        for k in range(1, terms + 1):
            angle = day * (2 * np.pi * k / period)
            cols += [F.sin(angle), F.cos(angle)]
    return F.array(*cols, *regressors)


def _centered(regressors: Sequence[str]) -> list[Column]:
    """Regressors less their mean in the series; an unknown one counts as the mean."""
    out = []
    for i, r in enumerate(regressors):
        center = F.get("centers", F.lit(i))
        out.append(F.coalesce(_number(r) - center, F.lit(0.0)))
    return out


def _number(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x)


def _solved(grams: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The coefficients from the sums of z * z' with z = (x, y), a matrix row by row for each series."""
    for batch in grams:
        out = []
        for flat in batch:
            if flat is None:
                out.append(None)
                continue
            size = int(np.sqrt(len(flat)))
            sums = np.asarray(flat, float).reshape(size, size)
            penalty = RIDGE * np.eye(size - 1)
            penalty[0, 0] = 0.0
            try:
                out.append(np.linalg.solve(sums[:-1, :-1] + penalty, sums[:-1, -1]).tolist())
            except np.linalg.LinAlgError:
                out.append(None)
        yield pd.Series(out, dtype=object)


def fit_seasonal(
    train: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    date: str = "date",
    regressors: Sequence[str] = ("price", "on_promo", "is_weekend"),
    multiplicative: bool = True,
    min_rows: int = dataset.MIN_SERIES_ROWS,
    waves: Waves = WAVES,
) -> DataFrame:
    """One row per series: the coefficients, or why there are none.

    A ridge regression from its normal equations: every row gives the products of its terms, which are added up per
    series before and after the shuffle, so that no task holds a series, and solved from one matrix per series. With
    ``multiplicative`` the regression is on the log of the value.
    """
    day = F.datediff(date, F.lit("1970-01-01").cast("date")).cast("double")
    target = _number(value)
    rows = train.select(*keys, *regressors, target.alias("_y"), day.alias("_day"))
    known = F.col("_y").isNotNull()
    heads = rows.groupBy(*keys).agg(
        F.count("_y").cast("int").alias("rows"),
        F.min(F.when(known, F.col("_day"))).alias("origin"),
        F.greatest(F.max(F.when(known, F.col("_day"))) - F.min(F.when(known, F.col("_day"))), F.lit(1.0)).alias("span"),
        F.array(*[F.coalesce(F.avg(F.when(known, _number(r))), F.lit(0.0)) for r in regressors]).cast("array<double>").alias("centers"),
    )
    heads = cut_lineage(heads)
    enough = heads.where(F.col("rows") >= min_rows)
    y = F.log1p(F.greatest("_y", F.lit(0.0))) if multiplicative else F.col("_y")
    joined = rows.where(known).join(enough, list(keys))
    z = joined.select(*keys, F.concat(_design(F.col("_day"), F.col("origin"), F.col("span"), waves, _centered(regressors)), F.array(y)).alias("z"))
    products = F.flatten(F.transform("z", lambda a: F.transform("z", lambda b: a * b)))
    grams = z.select(*keys, array_to_vector(products).alias("p")).groupBy(*keys).agg(vector_to_array(Summarizer.sum(F.col("p"))).alias("gram"))
    solve = F.pandas_udf(_solved, "array<double>")
    solved = grams.select(*keys, solve("gram").alias("coefficients"))
    state = F.when(F.col("rows") < min_rows, "skipped").when(F.col("coefficients").isNull(), "failed: singular matrix").otherwise("trained")
    return heads.join(solved, list(keys), "left").select(*keys, "rows", "origin", "span", "centers", "coefficients", state.alias("status"))


def predict_seasonal(
    models: DataFrame,
    df: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    regressors: Sequence[str] = ("price", "on_promo", "is_weekend"),
    multiplicative: bool = True,
    name: str = "yhat",
    train: DataFrame | None = None,
    value: str = "value",
    waves: Waves = WAVES,
) -> DataFrame:
    """Forecast of every row whose series has a model, never below 0, and the status of the series.

    With ``train`` the other rows get the mean of their series, or that of all rows; without it they stay null.
    """
    known = ["origin", "span", "centers", "coefficients"]
    trained = models.select(*keys, "status", *[F.when(F.col("status") == "trained", F.col(c)).alias(c) for c in known])
    day = F.datediff(date, F.lit("1970-01-01").cast("date")).cast("double")
    joined = df.join(trained, list(keys), "left").withColumn("_day", day)
    joined = joined.withColumn("_x", _design(F.col("_day"), F.col("origin"), F.col("span"), waves, _centered(regressors)))
    dot = F.aggregate(F.zip_with("_x", "coefficients", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    yhat = F.expm1(F.least(dot, F.lit(dataset.LOG_CLIP))) if multiplicative else dot
    out = joined.withColumn(name, F.when(F.col("coefficients").isNotNull(), F.greatest(yhat, F.lit(0.0))))
    out = out.withColumn("status", F.coalesce("status", F.lit("unseen"))).drop(*known, "_day", "_x")
    if train is None:
        return out
    filled = dataset.mean_fallback(out, train, keys, value, "_mean")
    return filled.withColumn(name, F.coalesce(name, "_mean")).drop("_mean")


# ------------------------------------------------------------------------------------- training


@dataclass
class Outcome:
    """What training the back-ends gave: their models, test metrics, and errors of those that failed."""

    models: dict[str, PipelineModel] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    metrics: DataFrame | None = None

    def report(self, spark: SparkSession) -> DataFrame:
        """The metrics with a column ``error``, and a row for every back-end that failed."""
        failed = spark.createDataFrame(sorted(self.errors.items()), "model string, error string")
        if self.metrics is None:
            return failed
        return self.metrics.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


BACKENDS: dict[str, Callable[[str], object]] = {
    "boosted_trees": lambda target: boosted_trees(target),
    "forest": lambda target: RandomForestRegressor(
        labelCol=target, featuresCol="features", predictionCol="yhat", numTrees=20, maxDepth=6, seed=42
    ),
    "linear": lambda target: LinearRegression(
        labelCol=target, featuresCol="features", predictionCol="yhat", regParam=0.1, solver="normal"
    ),
}


def train_all(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    target: str = "value",
    backends: dict[str, Callable[[str], object]] | None = None,
    validation: str | None = None,
    patience: int | None = None,
) -> Outcome:
    """Train every back-end; one that fails does not stop the others. ``validation`` and ``patience`` are those of
    ``fit``."""
    out = Outcome()
    for name, make in (backends or BACKENDS).items():
        try:
            model = fit(train, features, make(target), validation, patience=patience)
            out.models[name] = model
            parts = [
                metrics.error_metrics(predict(model, rows), target).withColumn("split", F.lit(split))
                for rows, split in ((train, "train"), (test, "test"))
            ]
            scored = parts[0].unionByName(parts[1]).withColumn("model", F.lit(name))
            out.metrics = scored if out.metrics is None else out.metrics.unionByName(scored)
        except Exception as e:  # one back-end must not stop the others
            out.errors[name] = f"{type(e).__name__}: {e}"[:200]
    return out


# ------------------------------------------------------------------------------- stored models


@dataclass(frozen=True)
class Bundle:
    """A model with all that its features are made of: encoders, lags, windows, keys, and the corrections of its score."""

    model: PipelineModel
    features: Sequence[str]
    encoders: Encoders
    keys: Sequence[str] = ("store_id", "product_id")
    lags: Sequence[int] = LAGS
    windows: Sequence[int] = WINDOWS
    carry: Sequence[str] = ("price",)
    post: forecast.PostProcessing = forecast.PostProcessing()

    def table(self, df: DataFrame) -> DataFrame:
        """The feature table of raw series, built with the stored encoders."""
        return build_features(df, lags=self.lags, sizes=self.windows, keys=self.keys, categories=list(self.encoders.labels), encoders=self.encoders)[0]

    def predict(self, df: DataFrame) -> DataFrame:
        """The corrected forecast of every row whose features are known."""
        scored = predict(self.model, training_rows(self.table(df), self.features))
        return scored.withColumn("yhat", self.post.bounded(self.post.corrected(F.col("yhat"))))

    def forecast(self, df: DataFrame, horizon: int, **options) -> DataFrame:
        """All series day by day, as ``recursive_forecast`` does, with the errors of series that have no values."""
        more = {"errors": True, **options}
        return forecast.recursive_forecast(
            df, self.keys, horizon, self.model, self.features, self.lags, self.windows, self.post, self.carry, self.encoders, **more
        )

    def save(self, path: str) -> None:
        """Write model, encoder tables and settings below ``path``; what stands there is replaced."""
        spark = SparkSession.getActiveSession()
        self.model.write().overwrite().save(f"{path}/model")
        encode.save_encoders(self.encoders.labels, f"{path}/encoders", "label")
        encode.save_encoders(self.encoders.means, f"{path}/encoders", "target")
        names = ("features", "keys", "lags", "windows", "carry")
        settings = {n: list(getattr(self, n)) for n in names} | {"post": asdict(self.post)}
        settings |= {"labels": list(self.encoders.labels), "means": list(self.encoders.means)}
        spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        settings = json.loads(spark.read.text(f"{path}/settings").first()[0])
        labels = {c: encode.load_encoder(spark, f"{path}/encoders", "label", c) for c in settings.pop("labels")}
        means = {c: encode.load_encoder(spark, f"{path}/encoders", "target", c) for c in settings.pop("means")}
        post = forecast.PostProcessing(**settings.pop("post"))
        return cls(PipelineModel.load(f"{path}/model"), encoders=Encoders(labels, means), post=post, **settings)


def recompute_bias(bundle: Bundle, df: DataFrame, horizon: int, target: str = "value") -> tuple[Bundle, DataFrame]:
    """The bundle with its bias recomputed on the last dates of raw series, and the figures it comes from.

    The features are built again from the series, in one pass that stores them; the correction is minus the mean error of
    the uncorrected scores.
    """
    rows = cut_lineage(training_rows(bundle.table(df), bundle.features))
    held = dataset.split_by_time(rows, horizon).where("split = 'test'")
    scored = predict(bundle.model, held).withColumn("yhat", replace(bundle.post, bias=0.0).original(F.col("yhat")))
    found = metrics.error_metrics(scored, target).select("n", "bias", (-F.col("bias")).alias("bias_correction"))
    found = cut_lineage(found)
    bias = found.first()["bias_correction"]
    return replace(bundle, post=replace(bundle.post, bias=float(bias), bias_in_log=False)), found
