"""Error metrics and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesline.operators.ordering import range_blocks, running_sum
from salesline.session import cut_lineage, join_small

# Score weights, and the lowest R2 of each verdict.
WEIGHTS = {"mae": 0.4, "rmse": 0.4, "r2": 0.2}
VERDICTS = (
    (0.85, "Excellent model -- strong predictive power."),
    (0.7, "Good model -- explains significant variance."),
    (0.5, "Moderate model -- useful but improvable."),
    (0.3, "Weak model -- limited signal."),
    (0.0, "Poor model -- barely better than mean."),
)
WORST_VERDICT = "Model worse than mean -- not useful."
NO_VERDICT = "No R2 available"

# Words in a file name that tell the back-end, tried in this order.
BACKENDS = (("LightGBM", ("lgbm", "lgb", "lightgbm")), ("XGBoost", ("xgb", "xg", "xgboost")), ("Prophet", ("prophet",)))


def error_metrics(df: DataFrame, y: str = "value", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    """n, MAE, RMSE, R2, bias, MAPE over ``|y| > 1`` and sMAPE in one pass, per key if given."""
    known = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    a, f = F.col(y), F.col(yhat)
    error = f - a
    middle = (F.abs(a) + F.abs(f)) / 2
    sse, sst = F.sum(error * error), F.var_pop(a) * F.count(F.lit(1))
    return known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.try_subtract(F.lit(1.0), F.try_divide(sse, sst)).alias("r2"),
        F.avg(error).alias("bias"),
        (F.avg(F.when(F.abs(a) > 1, F.abs(error / a))) * 100).alias("mape"),
        (F.avg(F.abs(error) / F.when(middle > 0, middle).otherwise(1.0)) * 100).alias("smape"),
    )


def bias_corrected(
    df: DataFrame, y: str = "value", yhat: str = "yhat", keys: Sequence[str] = (), clip: bool = True
) -> DataFrame:
    """Take the mean error off the forecast, by default never going below 0."""
    known = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    bias = F.avg(F.col(yhat) - F.col(y)).alias("_bias")
    if keys:
        rows = join_small(known, known.groupBy(*keys).agg(bias), keys)
    else:
        rows = known.withColumn("_bias", known.agg(bias).scalar())
    better = F.col(yhat) - F.col("_bias")
    return rows.withColumn(yhat, F.greatest(better, F.lit(0.0)) if clip else better).drop("_bias")


def overfit_ratio(metrics: DataFrame, split: str = "split", keys: Sequence[str] = ()) -> DataFrame:
    """RMSE on test over RMSE on train; infinite if the latter is 0."""
    pick = {s: F.max(F.when(F.col(split) == s, F.col("rmse"))) for s in ("test", "train")}
    ratio = F.when(pick["train"] > 0, F.try_divide(pick["test"], pick["train"])).otherwise(F.lit(float("inf")))
    return metrics.groupBy(*keys).agg(ratio.alias("overfit_ratio"))


def fold_summary(metrics: DataFrame, cols: Sequence[str] = ("mae", "r2"), keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over the folds."""
    return metrics.groupBy(*keys).agg(
        *[f(c).alias(f"cv_{c}_{n}") for c in cols for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )


def verdict(r2: Column) -> Column:
    out = F.when(r2.isNull() | F.isnan(r2), NO_VERDICT)
    for low, text in VERDICTS:
        out = out.when(r2 >= low, text)
    return out.otherwise(WORST_VERDICT)


def score_models(models: DataFrame, name: str = "model") -> DataFrame:
    """Score 0 to 100 from the ranks in MAE, RMSE and R2; a missing metric ranks last, ties go by name.

    The values of all metrics are sorted once, in ranges, and their places are running counts over the ranges.
    """
    stored = cut_lineage(models.withColumn("_id", F.monotonically_increasing_id()))
    values = [F.struct(F.lit(m).alias("metric"), (-F.col(m) if m == "r2" else F.col(m)).alias("value")) for m in WEIGHTS]
    cells = stored.select("_id", F.col(name).alias("_name"), F.explode(F.array(*values)).alias("c")).select("_id", "_name", "c.*")
    order = ["metric", F.col("value").isNull(), F.col("value"), F.col("_name"), F.col("_id")]
    placed = running_sum(range_blocks(cells, order), {"_place": F.lit(1).cast("long")}, ["metric"], totals=True)
    n = F.col("_place_total")
    share = F.when(n == 1, 1.0).otherwise((n - F.col("_place")) / (n - 1))
    parts = placed.groupBy("_id").agg(*[F.max(F.when(F.col("metric") == m, share)).alias(f"_{m}") for m in WEIGHTS])
    total = sum((F.col(f"_{m}") * w for m, w in WEIGHTS.items()), F.lit(0.0))
    scored = stored.join(parts, "_id").withColumn("score", F.round(total * 100, 2)).withColumn("verdict", verdict(F.col("r2")))
    return scored.drop("_id", *[f"_{m}" for m in WEIGHTS])


def backend_label(file_name: Column) -> Column:
    """The back-end a metrics file belongs to, from words in its name; else the bare name."""
    low, out = F.lower(file_name), None
    for label, words in BACKENDS:
        hit = low.rlike("|".join(words))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.regexp_replace(file_name, r"\.[^.]*$", ""))


def normalize_metrics(entries: DataFrame, model: str = "model") -> DataFrame:
    """One row per model and metric from ``(model, path, number)``.

    A path is the key in the metrics file, nested keys joined by dots. A corrected test metric comes
    before a plain one; sections named ``test`` or ``metrics.test`` count only if neither exists.
    """
    low = F.lower("path")
    base = (
        F.when(low.endswith("_test_corrected"), F.regexp_replace(low, "_test_corrected$", ""))
        .when(low.endswith("_test"), F.regexp_replace(low, "_test$", ""))
        .when(low.startswith("test."), F.substring_index(low, ".", -1))
        .when(low.startswith("metrics.test."), F.substring_index(low, ".", -1))
    )
    flat = ~F.contains(low, F.lit("."))
    rank = (
        F.when(flat & low.endswith("_test_corrected"), 1)
        .when(flat & low.endswith("_test"), 2)
        .when(low.startswith("test."), 3)
        .when(low.startswith("metrics.test."), 4)
    )
    ranked = entries.select(model, F.upper(base).alias("metric"), rank.alias("_rank"), "number").where("_rank is not null")
    best = F.min("_rank").over(Window.partitionBy(model))
    section = ranked.withColumn("_best", best).where(
        (F.col("_rank") <= 2) | ((F.col("_best") > 2) & (F.col("_rank") == F.col("_best")))
    )
    return section.groupBy(model, "metric").agg(F.min_by("number", "_rank").alias("number"))


def summarize_models(normalized: DataFrame, model: str = "model") -> DataFrame:
    """Wide table of the test metrics with score and verdict."""
    wide = normalized.groupBy(model).agg(
        *[F.max(F.when(F.col("metric") == m.upper(), F.col("number"))).alias(m) for m in ("mae", "rmse", "r2")]
    )
    return score_models(wide, model)
