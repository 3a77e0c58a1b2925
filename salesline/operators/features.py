"""The whole feature table: calendar, lags, rolling and weighted means, ratios, crosses, encodings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.functions.calendar import add_time_features
from salesline.operators import encode, windows
from salesline.operators.conform import feature_names
from salesline.operators.ewma import add_ewma, add_store_ewma
from salesline.operators.ordering import Series
from salesline.session import cut_lineage

# Columns that never are features of a model.
NOT_FEATURES = ("value", "date", "id", "category", "revenue", "unit_price", "email", "quantity")
GROUP_COLUMNS = ("store_id", "product_id")


@dataclass
class Encoders:
    """Learned dimension tables, to be used again on other rows."""

    labels: dict[str, DataFrame] = field(default_factory=dict)
    means: dict[str, DataFrame] = field(default_factory=dict)


def numeric_features(
    df: DataFrame,
    value: str = "value",
    date: str = "date",
    lags: Sequence[int] = windows.LAGS,
    sizes: Sequence[int] = windows.WINDOWS,
    keys: Sequence[str] | None = None,
    horizon: int = 1,
    shift: int = 1,
) -> DataFrame:
    """All features that need no encoder. One row per day and series, so all windows share one shuffle."""
    df = feature_names(df)
    keys = [c for c in GROUP_COLUMNS if c in df.columns] if keys is None else list(keys)
    series = Series(tuple(keys), (date,))
    out = add_time_features(df, date)
    out = windows.add_lags(out, value, lags, series)
    out = windows.add_rolling(out, value, sizes, series, shift)
    out = add_ewma(out, value, sizes, series)
    out = windows.add_lag_ratios(windows.add_lag_interactions(out, sizes))
    if horizon <= 7 and "ewma_7" not in out.columns and {"store_id", "product_id"} <= set(out.columns):
        out = add_store_ewma(out, value, date)
    return windows.add_crosses(out)


def build_features(
    df: DataFrame,
    value: str = "value",
    date: str = "date",
    lags: Sequence[int] = windows.LAGS,
    sizes: Sequence[int] = windows.WINDOWS,
    keys: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    encoders: Encoders | None = None,
    horizon: int = 1,
) -> tuple[DataFrame, Encoders]:
    """Features with the encoders they were built with. Given encoders are applied as they are.

    New encoders are learned from one grouped pass over the input. The input, one row per day and series, is stored for
    that pass and the features.
    """
    if encoders is None:
        df = cut_lineage(df)
    out = numeric_features(df, value, date, lags, sizes, keys, horizon)
    keys = [c for c in GROUP_COLUMNS if c in out.columns] if keys is None else list(keys)
    types = dict(out.dtypes)
    texts = [c for c in keys if types[c] == "string"]
    if categories is None:
        categories = [c for c, t in out.dtypes if t == "string"]
    known = encoders
    if known is None:
        base = windows.add_crosses(add_time_features(feature_names(df), date))
        sums = cut_lineage(encode.category_sums(base, sorted({*texts, *categories}), value))
        known = Encoders(
            encode.fit_all_labels(sums, categories) if categories else {},
            {c: encode.means_from_sums(sums, c) for c in texts},
        )
    missing = [c for c in categories if c in out.columns and c not in known.labels]
    if missing:
        known = Encoders(known.labels | encode.fit_all_labels(out, missing), known.means)
    return encoded(out, known, texts, categories, value), known


def encoded(df: DataFrame, encoders: Encoders, texts: Sequence[str], categories: Sequence[str], value: str = "value") -> DataFrame:
    """Target means of the text keys, and all categories as codes."""
    for c in texts:
        df = encode.apply_target_means(df, c, encoders.means.get(c), value)
    return encode.encode_categorical(df, categories, encoders.labels)[0]


def feature_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    return [c for c, t in df.dtypes if c not in exclude and t in numbers]


def training_rows(df: DataFrame, features: Sequence[str], value: str = "value") -> DataFrame:
    """Rows past the warm-up: the target and all features are known."""
    return windows.drop_warm_up(df.where(F.col(value).isNotNull()), features)
