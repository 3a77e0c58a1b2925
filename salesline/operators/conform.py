"""Find which columns of a file hold the id, the date and the value, and bring them into shape.

Evidence about the contents is gathered from all rows in one pass. Every column gets points for every target, from its
name and its contents, in a table of a row per column and target; targets are assigned in one ordered pass over it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesline.functions.parsing import (
    clean_number, day_first_date, first_digits, normalized_name, numbers, parsed_timestamp,
)
from salesline.operators.profile import numeric_columns

# The target columns and the names they go by.
TARGETS = ("id", "date", "value")
ALIASES = {
    "id": (
        "id", "product_id", "item_id", "sku", "store", "store_id", "reference", "identifiant", "code_article",
    ),
    "date": (
        "date", "sale_date", "sale-date", "timestamp", "order_date", "created_at", "jour", "date_commande",
        "date_vente", "sale_date", "datetime", "date_achat", "POSTING_DATE",
    ),
    "value": (
        "qty", "quantity", "value", "sales", "amount", "price", "total", "ventes", "montant", "quantite",
        "qty_vendue", "total_vente", "qty_sold",
    ),
}

# Bonus points, the shares that earn them, and the share a fallback date needs.
DATE_BONUS, DATE_SHARE = 35, 0.7
NUMBER_BONUS, NUMBER_SHARE = 30, 0.8
UNIQUE_BONUS = 25
FALLBACK_DATE_SHARE = 0.4

# Bare names tried when a target is still missing.
FALLBACK_NAMES = {
    "date": ("saledate", "date", "timestamp", "datetime"),
    "id": ("store", "storeid", "id", "sku", "productid", "itemid"),
    "value": ("qty", "quantity", "value", "sales", "amount", "revenue"),
}

# Names of quantity and price columns from which a value can be computed.
QUANTITY_NAMES = ("qty", "quantity", "quantite", "quantitees", "qte")
PRICE_NAMES = ("price", "unitprice", "prix", "montant")

# Names reports look for first.
DATE_NAMES = (
    "date", "Date", "ds", "timestamp", "datetime", "time", "sale_date", "saledate", "order_date", "created_at",
)
VALUE_NAMES = ("quantity", "qty", "value", "y", "sales", "amount", "revenue", "unit_price")

# Columns renamed before features are built, if the new name is free.
FEATURE_NAMES = {"id": "store_id", "product": "product_id", "unit_price": "price"}


def plain_name(name: str) -> str:
    """``normalized_name`` for a single header."""
    s = re.sub(r"[\s\-_]+", "_", name.lower().strip())
    return re.sub(r"[^a-z0-9_]", "", s).strip("_")


def bare_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


def edit_likeness(names: Column, aliases: Sequence[str]) -> Column:
    """Likeness of headers to the nearest alias by edit distance, 0 to 100."""
    plain = F.array(*[F.lit(plain_name(a)) for a in aliases])

    def nearest(n: Column) -> Column:
        return F.array_max(F.transform(plain, lambda a: 100 * (1 - F.levenshtein(n, a) / F.greatest(F.length(n), F.length(a)))))

    return F.get(F.transform(F.array(normalized_name(names)), nearest), F.lit(0))


def _as_text(df: DataFrame, c: str) -> Column:
    return F.col(f"`{c}`").cast("string")


def column_evidence(df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """One row per column: share of known cells that are dates or numbers, distinct values per row.

    One pass makes a narrow stream of cells. Equal cells of a column are counted together first, so that each different
    text is parsed once and the distinct values are those that are left; ``approximate`` parses every cell where it is read
    and takes a sketch instead, so that nothing but a row for each column is shuffled.
    """
    cols = list(cols or df.columns)
    text, times = F.col("_text"), F.col("_times")
    cells = df.select(F.posexplode(F.array(*[_as_text(df, c) for c in cols])).alias("_p", "_text"))
    if approximate:
        cells, distinct = cells.withColumn("_times", F.lit(1)), F.approx_count_distinct(text)
    else:
        cells, distinct = cells.groupBy("_p", "_text").agg(F.count(F.lit(1)).alias("_times")), F.count(text)

    def cells_with(found: Column) -> Column:
        return F.sum(F.when(found.isNotNull(), times).otherwise(0))

    shares = cells.groupBy("_p").agg(
        F.sum(times).alias("rows"),
        cells_with(text).alias("known"),
        cells_with(parsed_timestamp(text)).alias("_dates"),
        cells_with(clean_number(text)).alias("_numbers"),
        distinct.alias("_u"),
    )

    def share(part: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col("known")), F.lit(0.0))

    return shares.select(
        F.get(F.array(*[F.lit(c) for c in cols]), F.col("_p")).alias("column"),
        "known",
        share("_dates").alias("date_share"),
        share("_numbers").alias("number_share"),
        (F.col("_u") / F.col("rows")).alias("distinct_share"),
    )


@dataclass(frozen=True)
class Evidence:
    column: str
    known: int
    date_share: float
    number_share: float
    distinct_share: float


def gather(df: DataFrame, approximate: bool = False) -> list[Evidence]:
    found = {r["column"]: Evidence(**r.asDict()) for r in column_evidence(df, approximate=approximate).collect()}
    return [found.get(c, Evidence(c, 0, 0.0, 0.0, 0.0)) for c in df.columns]


def evidence_table(spark: SparkSession, evidence: Sequence[Evidence]) -> DataFrame:
    rows = [(i, e.column, e.known, e.date_share, e.number_share, e.distinct_share) for i, e in enumerate(evidence)]
    schema = "position int, column string, known long, date_share double, number_share double, distinct_share double"
    return spark.createDataFrame(rows, schema)


def score_table(
    evidence: DataFrame,
    targets: Sequence[str] = TARGETS,
    aliases: dict[str, Sequence[str]] = ALIASES,
    numbers_always: bool = False,
) -> DataFrame:
    """One row per column and target: turn (of the target), target, position, column, points for the name and for the
    contents, and their sum. ``numbers_always`` gives every column the number bonus."""
    enough = F.lit(True) if numbers_always else F.col("number_share") >= NUMBER_SHARE
    contents = {
        "id": F.floor(F.col("distinct_share") * UNIQUE_BONUS),
        "date": F.when(F.col("date_share") >= DATE_SHARE, DATE_BONUS).otherwise(0),
        "value": F.when(enough, NUMBER_BONUS).otherwise(0),
    }
    cells = [
        F.struct(
            F.lit(i).alias("turn"),
            F.lit(t).alias("target"),
            edit_likeness(F.col("column"), aliases.get(t, [t])).alias("name_points"),
            contents.get(t, F.lit(0)).cast("double").alias("content_points"),
        )
        for i, t in enumerate(targets)
    ]
    rows = evidence.select("position", "column", F.explode(F.array(*cells)).alias("c")).select("c.*", "position", "column")
    return rows.withColumn("score", F.col("name_points") + F.col("content_points"))


def assign(ranked: DataFrame, order: Sequence[str | Column], mapping: dict[str, str] | None = None) -> dict[str, str]:
    """Go once through (target, column) rows in the given order; a row counts if neither is taken yet."""
    out = dict(mapping or {})
    for r in ranked.orderBy(*order).select("target", "column").collect():
        if r.target not in out and r.column not in out.values():
            out[r.target] = r.column
    return out


def best_mapping(
    spark: SparkSession,
    evidence: Sequence[Evidence],
    targets: Sequence[str] = TARGETS,
    aliases: dict[str, Sequence[str]] = ALIASES,
    numbers_always: bool = False,
) -> dict[str, str]:
    """Targets in turn take the column of most points, the first of equals, that no other target has."""
    scores = score_table(evidence_table(spark, evidence), targets, aliases, numbers_always)
    return assign(scores, ["turn", F.desc("score"), "position"])


def fallback_table(evidence: DataFrame) -> DataFrame:
    """Rows (target, column) with the round, rule and place in which a missing target may take a column.

    Round 0 has, for each target in turn, bare names equal to a usual one (rule 0, in the order of the usual names),
    then bare names that contain one (1), then for dates the columns with most dates (2). Round 1 lets ids and then
    values take any column.
    """
    bare = F.regexp_replace(F.lower("column"), "[^a-z0-9]", "")
    dated = (F.col("date_share") >= FALLBACK_DATE_SHARE) & (F.col("known") > 0)
    cells = []
    for turn, (target, names) in enumerate(FALLBACK_NAMES.items()):
        usual = F.array(*[F.lit(n) for n in names])
        rules = [
            (F.array_contains(usual, bare), 0, F.array_position(usual, bare).cast("double")),
            (F.exists(usual, lambda n: F.contains(bare, n)), 1, F.lit(0.0)),
        ]
        if target == "date":
            rules.append((dated, 2, -F.col("date_share")))
        cells += [F.when(holds, _cell(0, turn, rule, place, target)) for holds, rule, place in rules]
    cells += [_cell(1, turn, 3, F.lit(0.0), target) for turn, target in enumerate(("id", "value"))]
    rows = evidence.select("position", "column", F.explode(F.array(*cells)).alias("c")).where("c is not null")
    return rows.select("c.*", "position", "column")


def _cell(round_: int, turn: int, rule: int, place: Column, target: str) -> Column:
    return F.struct(
        F.lit(round_).alias("round"), F.lit(turn).alias("turn"), F.lit(rule).alias("rule"), place.alias("place"), F.lit(target).alias("target")
    )


def fallback_mapping(
    spark: SparkSession, evidence: Sequence[Evidence], mapping: dict[str, str] | None = None
) -> dict[str, str]:
    """Fill in missing targets by the rules of ``fallback_table``; no column is taken twice."""
    ranked = fallback_table(evidence_table(spark, evidence))
    return assign(ranked, ["round", "turn", "rule", "place", "position"], mapping)


def require_targets(mapping: dict[str, str], targets: Sequence[str] = TARGETS) -> None:
    missing = sorted(set(targets) - set(mapping))
    if missing:
        raise ValueError(f"no column found for: {', '.join(missing)}")


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def apply_mapping(df: DataFrame, mapping: dict[str, str], extra_prefix: str = "", value: Column | None = None) -> DataFrame:
    """The typed targets, then all other columns under their own or a prefixed name. ``value`` is that target, if it is
    parsed already."""
    typed = {"id": first_digits, "date": day_first_date, "value": clean_number if value is None else lambda _: value}
    cols = [typed.get(t, lambda c: c)(F.col(f"`{c}`")).alias(t) for t, c in mapping.items()]
    taken = set(mapping.values())
    for c in df.columns:
        if c not in taken:
            name = f"{extra_prefix}{c}"
            cols.append(F.col(f"`{c}`").alias(f"extra_{c}" if name in mapping else name))
    return df.select(*cols)


def find_value_parts(columns: Sequence[str]) -> tuple[str, str] | None:
    """The quantity and price columns, if both are there."""
    quantity = [c for c in columns if bare_name(c) in QUANTITY_NAMES]
    price = [c for c in columns if bare_name(c) in PRICE_NAMES]
    return (quantity[0], price[0]) if quantity and price else None


def conform(
    df: DataFrame,
    mapping: dict[str, str] | None = None,
    extra_prefix: str = "",
    approximate: bool = False,
    recompute: bool = True,
) -> tuple[DataFrame, dict[str, str]]:
    """Detect (or take) the mapping, apply it, and compute unknown values from quantity and price."""
    if mapping is None or set(TARGETS) - set(mapping):
        evidence = gather(df, approximate)
        mapping = best_mapping(df.sparkSession, evidence) if mapping is None else mapping
        mapping = fallback_mapping(df.sparkSession, evidence, mapping)
    require_targets(mapping)
    parts = find_value_parts(df.columns) if recompute else None
    found = [F.get("_numbers", F.lit(i)) for i in range(3)]
    rows = df.withColumn("_numbers", numbers([_as_text(df, mapping["value"])], [_as_text(df, p) for p in parts or ()]))
    value = F.coalesce(found[0], found[1] * found[2]) if parts else found[0]
    return apply_mapping(rows, mapping, extra_prefix, value).drop(f"{extra_prefix}_numbers"), mapping


def detect_report_columns(
    df: DataFrame,
    date_names: Sequence[str] = DATE_NAMES,
    value_names: Sequence[str] = VALUE_NAMES,
    min_date_share: float = 0.0,
) -> tuple[str | None, str | None]:
    """The date and value columns of a report: by name, else by contents."""
    date = next((c for c in date_names if c in df.columns), None)
    value = next((c for c in value_names if c in df.columns), None)
    if date is None or value is None:
        evidence = gather(df)
        dated = [e for e in evidence if e.date_share * e.known > 0 and e.date_share > min_date_share]
        if date is None and dated:
            date = max(dated, key=lambda e: e.date_share * e.known).column
        numeric = [e for e in evidence if e.column in numeric_columns(df)]
        if value is None and numeric:
            value = max(numeric, key=lambda e: e.known).column
    return date, value


def feature_names(df: DataFrame) -> DataFrame:
    renames = {a: b for a, b in FEATURE_NAMES.items() if a in df.columns and b not in df.columns}
    return df.withColumnsRenamed(renames) if renames else df
