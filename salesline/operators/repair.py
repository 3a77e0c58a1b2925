"""Repair of conformed rows: dates, values and ids, with a report of what was changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesline.functions.parsing import first_digits, repaired_date
from salesline.operators.ordering import row_index
from salesline.session import cut_lineage

# The default validation rules.
MIN_VALUE = 0
MISSING_LIMITS = {"id": 0.01, "date": 0.05, "value": 0.05}


def recompute_value(value: Column, quantity: Column, price: Column) -> Column:
    return F.coalesce(value, quantity * price)


def repair_value(value: Column) -> Column:
    """Unknown becomes 0, negative becomes positive."""
    return F.abs(F.coalesce(value, F.lit(0.0)))


def repair_dates(df: DataFrame, text: str, date: str = "date") -> DataFrame:
    return df.withColumn(date, repaired_date(F.col(date), F.col(text)))


def fill_ids(
    df: DataFrame, order: Sequence[str], id_col: str = "id", fallback: str | None = None, blocks: int | None = None
) -> DataFrame:
    """Integer ids: the digits of the id, else of the fallback column, else the next free numbers in row order."""
    source = F.coalesce(F.col(id_col).cast("string"), F.col(fallback)) if fallback else F.col(id_col)
    rows = cut_lineage(df.withColumn(id_col, first_digits(source)))  # three passes follow
    known, unknown = rows.where(F.col(id_col).isNotNull()), rows.where(F.col(id_col).isNull())
    top = known.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).scalar()
    numbered = row_index(unknown, order, name="_i", blocks=blocks).withColumn(id_col, top + 1 + F.col("_i"))
    return known.unionByName(numbered.select(*known.columns))


def repair_report(before: DataFrame, after_date: Column, id_col: str = "id", value: str = "value", date: str = "date"):
    """One row: rows seen, dates and values fixed, ids that were unknown."""
    return before.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col(date).isNull() & after_date.isNotNull()).alias("date_fixed"),
        F.count_if(F.col(value).isNull() | (F.col(value) < 0)).alias("value_fixed"),
        F.count_if(F.col(id_col).isNull()).alias("id_filled"),
    )


def repair_sample(
    df: DataFrame, order: Sequence[str], rows: int = 5, repaired: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The first rows after repair, for the report. ``repaired`` repairs rows one by one, by columns it leaves in order:
    then only the first ones have to be repaired. They are stored, as Spark would else move the repair below the order."""
    first = df.orderBy(*order).limit(rows)
    return repaired(cut_lineage(first)).orderBy(*order) if repaired else first


def validate(
    df: DataFrame,
    min_value: float | None = MIN_VALUE,
    max_value: float | None = None,
    missing: dict[str, float] | None = None,
    value: str = "value",
) -> DataFrame:
    """One row per rule: what was observed, the limit, and whether it holds. One pass over the data."""
    missing = MISSING_LIMITS if missing is None else missing
    rules = []
    if min_value is not None:
        rules.append(("min", value, F.min(value).cast("double"), float(min_value), "ge"))
    if max_value is not None:
        rules.append(("max", value, F.max(value).cast("double"), float(max_value), "le"))
    for c, limit in missing.items():
        if c in df.columns:
            rules.append(("missing", c, F.avg(F.col(c).isNull().cast("int")), float(limit), "le"))
    row = df.agg(*[obs.alias(f"o{i}") for i, (_, _, obs, _, _) in enumerate(rules)])
    entries = []
    for i, (rule, c, _, limit, kind) in enumerate(rules):
        seen = F.col(f"o{i}")
        ok = seen >= limit if kind == "ge" else seen <= limit
        entries.append(
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(c).alias("column"),
                seen.alias("observed"),
                F.lit(limit).alias("threshold"),
                F.coalesce(ok, F.lit(True)).alias("ok"),
            )
        )
    return row.select(F.inline(F.array(*entries)))


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no usable rows")
    return df
