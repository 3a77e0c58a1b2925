"""Exact order statistics without holding a group in one task.

Values are first counted, then ordered in blocks; running counts tell which value holds a position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.operators.ordering import range_blocks, running_sum


def value_counts(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys, F.col(value).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column per named probability."""
    return quantiles_of(value_counts(df, value, keys), probabilities, keys, blocks)


def quantiles_of(
    counted: DataFrame, probabilities: dict[str, float], keys: Sequence[str] = (), blocks: int | None = None
) -> DataFrame:
    """Quantiles from ``value_counts``, which may be counted by more than the keys."""
    if set(counted.columns) != {*keys, "_value", "_n"}:
        counted = counted.groupBy(*keys, "_value").agg(F.sum("_n").alias("_n"))
    counts = range_blocks(counted, [*keys, "_value"], blocks)
    rows = running_sum(counts, {"_end": "_n"}, keys, totals=True)
    first, last = F.col("_end") - F.col("_n"), F.col("_end") - 1

    def at(position):
        return F.max(F.when((first <= position) & (position <= last), F.col("_value")))

    picks = []
    for name, p in probabilities.items():
        where = (F.col("_end_total") - 1) * F.lit(float(p))
        picks += [at(F.floor(where)).alias(f"_lo_{name}"), at(F.ceil(where)).alias(f"_hi_{name}")]
        picks.append(F.max(where - F.floor(where)).alias(f"_f_{name}"))
    found = rows.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n)
            for n in probabilities
        ],
    )
