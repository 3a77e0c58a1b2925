"""Category encodings kept as dimension tables, so that they can be stored and applied again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.operators.ordering import range_blocks, row_index, running_sum
from salesline.session import cut_lineage


def fit_labels(df: DataFrame, col: str, blocks: int | None = None) -> DataFrame:
    """``(<col>, code)``: codes from 0 in sorted order of the categories."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = row_index(distinct, [col], name="code", blocks=blocks)
    return cut_lineage(codes.withColumn("code", F.col("code").cast("int")))


def apply_labels(df: DataFrame, col: str, labels: DataFrame, name: str | None = None) -> DataFrame:
    """Categories without a code, and unknown ones, get -1."""
    dim = labels.select(F.col(col).alias("_cat"), F.col("code").alias("_code"))
    coded = df.join(dim, F.col(col) == F.col("_cat"), "left").withColumn(
        name or col, F.coalesce(F.col("_code"), F.lit(-1))
    )
    return coded.drop("_cat", "_code")


def fit_all_labels(df: DataFrame, cols: Sequence[str], blocks: int | None = None) -> dict[str, DataFrame]:
    """The label tables of several columns, from one pass."""
    names = [f"c{i}" for i in range(len(cols))]
    texts = df.select(*[F.col(c).cast("string").alias(n) for c, n in zip(cols, names)])
    long = texts.unpivot([], names, "_name", "_cat").where("_cat is not null").distinct()
    codes = row_index(long, ["_cat"], ["_name"], "code", blocks).withColumn("code", F.col("code").cast("int"))
    codes = cut_lineage(codes)
    return {c: codes.where(F.col("_name") == n).select(F.col("_cat").alias(c), "code") for c, n in zip(cols, names)}


def encode_categorical(
    df: DataFrame, cols: Sequence[str], encoders: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace text categories by codes; learns the encoders that are not given."""
    known = dict(encoders or {})
    cols = [c for c in cols if c in df.columns]
    new = [c for c in cols if c not in known]
    if new:
        known |= fit_all_labels(df, new)
    for c in cols:
        df = apply_labels(df, c, known[c])
    return df, known


def category_sums(df: DataFrame, cols: Sequence[str], target: str = "value") -> DataFrame:
    """Sum and count of the target for each combination of categories: all that encoders need."""
    return df.groupBy(*cols).agg(F.sum(target).alias("_sum"), F.count(target).alias("_n"))


def means_from_sums(sums: DataFrame, col: str, smoothing: float = 10.0) -> DataFrame:
    """``(<col>, encoded, global_mean)``; a null category row carries the global mean alone."""
    whole = sums.agg(F.sum("_sum") / F.sum("_n")).scalar()
    stats = sums.groupBy(col).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")).withColumn("_g", whole)
    smooth = (F.coalesce("_sum", F.lit(0.0)) + smoothing * F.col("_g")) / (F.col("_n") + smoothing)
    known = F.col(col).isNotNull() & (F.col("_n") > 0)
    return stats.select(col, F.when(known, smooth).alias("encoded"), F.col("_g").alias("global_mean"))


def fit_target_means(df: DataFrame, col: str, target: str = "value", smoothing: float = 10.0) -> DataFrame:
    return means_from_sums(cut_lineage(category_sums(df, [col], target)), col, smoothing)


def apply_target_means(
    df: DataFrame, col: str, encoder: DataFrame | None, target: str = "value", name: str | None = None
) -> DataFrame:
    """Unknown categories get the stored global mean; without an encoder all rows get the current one."""
    name = name or f"{col}_target_enc"
    if encoder is None:
        return df.withColumn(name, df.agg(F.avg(target)).scalar())
    whole = encoder.agg(F.max("global_mean")).scalar()
    dim = encoder.select(F.col(col).alias("_cat"), F.col("encoded").alias("_enc"))
    joined = df.join(dim, F.col(col) == F.col("_cat"), "left")
    return joined.withColumn(name, F.coalesce(F.col("_enc"), whole)).drop("_cat", "_enc")


def add_target_encoding(
    df: DataFrame, cols: Sequence[str], target: str = "value", smoothing: float = 10.0
) -> tuple[DataFrame, dict[str, DataFrame]]:
    encoders = {}
    for c in cols:
        if c in df.columns:
            encoders[c] = fit_target_means(df, c, target, smoothing)
            df = apply_target_means(df, c, encoders[c], target)
    return df, encoders


def add_past_target_encoding(
    df: DataFrame,
    col: str,
    order: Sequence[str],
    target: str = "value",
    smoothing: float = 10.0,
    blocks: int | None = None,
) -> DataFrame:
    """Target encoding from earlier rows only; the first row of a category has the prior mean of all
    earlier rows, or null if there are none."""
    y, known = F.coalesce(F.col(target), F.lit(0.0)), F.col(target).isNotNull().cast("long")
    rows = running_sum(range_blocks(df, order, blocks), {"_as": y, "_an": known})
    rows = rows.select(*df.columns, "_as", "_an")
    rows = running_sum(range_blocks(rows, [F.col(col), *order], blocks), {"_cs": y, "_cn": known}, [col])
    past_sum, past_n = F.col("_cs") - y, F.col("_cn") - known
    prior = F.try_divide(F.col("_as") - y, F.col("_an") - known)
    encoded = F.when(F.col(col).isNotNull(), (past_sum + smoothing * prior) / (past_n + smoothing)).otherwise(prior)
    return rows.withColumn(f"{col}_target_enc", encoded).select(*df.columns, f"{col}_target_enc")


def save_encoders(encoders: dict[str, DataFrame], folder: str, kind: str) -> None:
    """One JSON table per column under ``folder/kind=<kind>/column=<column>``."""
    for c, table in encoders.items():
        out = table.withColumnRenamed(c, "category").withColumn("category", F.col("category").cast("string"))
        out.write.mode("overwrite").json(f"{folder}/kind={kind}/column={c}")


def load_encoder(spark, folder: str, kind: str, col: str) -> DataFrame:
    schema = "category string, code int" if kind == "label" else "category string, encoded double, global_mean double"
    return spark.read.schema(schema).json(f"{folder}/kind={kind}/column={col}").withColumnRenamed("category", col)


@dataclass(frozen=True)
class StringCodes:
    """Label tables of text columns; codes every split alike."""

    tables: dict[str, DataFrame]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``<col>_code``; texts that the training rows lack, and nulls, get the number of known ones."""
        for c, table in self.tables.items():
            unseen = table.agg(F.count(F.lit(1))).scalar()
            coded = apply_labels(df, c, table, f"{c}_code")
            code = F.col(f"{c}_code")
            df = coded.withColumn(f"{c}_code", F.when(code < 0, unseen).otherwise(code).cast("double"))
        return df


def fit_string_codes(train: DataFrame, cols: Sequence[str]) -> StringCodes:
    """Codes in alphabetic order, fitted on the training rows once; the labels stay tables."""
    return StringCodes(fit_all_labels(train, cols))
