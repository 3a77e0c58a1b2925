"""Parsing, repair, validation and cleaning (C, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesline.functions import parsing
from salesline.operators import clean, repair
from salesline.plans.views import DIRTY_SQL, TEXT_SQL, dirty_sales, dirty_text, sales_line, table
from salesline.registry import query, rounded

# ------------------------------------------------------------------------------------------- parsing

NUMBER_SQL = "try_cast(CASE WHEN {0} IN ('nan','NaN','None','-','') THEN NULL ELSE {0} END AS double)"


def number_sql(c: str) -> str:
    return NUMBER_SQL.format(f"replace(regexp_replace({c}, '[ €$]', '', 'g'), ',', '.')")


DAY_SQL = r"(?:(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})|(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})|(\d{4})(\d{2})(\d{2}))"
TIME_SQL = r"(?:[T ]+(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6})\d*)?)?)?\s*(?:Z|z|UTC|([+-])(\d{2}):?(\d{2})?)?\s*"


def uncaptured(pattern: str) -> str:
    return pattern.replace("(?:", "(").replace("(", "(?:")


def layouts_sql(c: str) -> str:
    """The timestamp a text states: its parts put together again in one layout."""
    g = {i: f"regexp_extract({c}, '^\\s*{DAY_SQL}{uncaptured(TIME_SQL)}$', {i})" for i in range(1, 10)}
    h = {i: f"regexp_extract({c}, '^\\s*{uncaptured(DAY_SQL)}{TIME_SQL}$', {i})" for i in range(1, 8)}
    swap = f"try_cast({g[5]} AS int) > 12"
    month = f"{g[2]} || {g[8]} || CASE WHEN {swap} THEN {g[4]} ELSE {g[5]} END"
    day = f"{g[3]} || {g[9]} || CASE WHEN {swap} THEN {g[5]} ELSE {g[4]} END"
    two = lambda x: f"lpad({x}, 2, '0')"
    text = f"{g[1]} || {g[6]} || {g[7]} || '-' || {two(month)} || '-' || {two(day)} || ' ' || {two(h[1])} || ':' || {two(h[2])} || ':' || {two(h[3])}"
    minutes = f"60 * coalesce(try_cast({h[6]} AS int), 0) + coalesce(try_cast({h[7]} AS int), 0)"
    offset = f"CASE WHEN {h[5]} = '-' THEN -1 ELSE 1 END * ({minutes})"
    stated = f"regexp_full_match({c}, '\\s*{DAY_SQL}{TIME_SQL}')"
    return f"CASE WHEN {stated} THEN try_strptime({text}, '%Y-%m-%d %H:%M:%S') + to_microseconds(rpad({h[4]}, 6, '0')::bigint) - to_minutes({offset}) END"


SWAP_SQL = """CASE WHEN regexp_full_match(sold_on, '\\d+[-/]\\d+[-/]\\d+')
  AND try_cast(regexp_split_to_array(sold_on, '[-/]')[2] AS int) > 12
  AND try_cast(regexp_split_to_array(sold_on, '[-/]')[3] AS int) <= 12
  AND length(regexp_split_to_array(sold_on, '[-/]')[2]) <= 2
  THEN try_strptime(
    lpad(CASE WHEN length(regexp_split_to_array(sold_on, '[-/]')[1]) = 2
      THEN CASE WHEN try_cast(regexp_split_to_array(sold_on, '[-/]')[1] AS int) <= 50 THEN '20' ELSE '19' END
        || regexp_split_to_array(sold_on, '[-/]')[1]
      ELSE regexp_split_to_array(sold_on, '[-/]')[1] END, 4, '0')
    || '-' || lpad(regexp_split_to_array(sold_on, '[-/]')[3], 2, '0')
    || '-' || lpad(regexp_split_to_array(sold_on, '[-/]')[2], 2, '0'), '%Y-%m-%d') END"""


@query("c1_clean_numbers", f"WITH {TEXT_SQL} SELECT rid, {number_sql('amount')} AS value FROM dirty_text")
def clean_numbers(spark, sf):
    return dirty_text(spark, sf).select("rid", parsing.clean_number(F.col("amount")).alias("value"))


@query(
    "c2_first_digits",
    f"""WITH {TEXT_SQL} SELECT rid, try_cast(nullif(regexp_extract(shop, '(\\d+)', 1), '') AS bigint) AS id,
    try_cast(nullif(regexp_extract(product_id, '(\\d+)', 1), '') AS bigint) AS product FROM dirty_text""",
)
def first_digits(spark, sf):
    return dirty_text(spark, sf).select(
        "rid",
        parsing.first_digits(F.col("shop")).alias("id"),
        parsing.first_digits(F.col("product_id")).alias("product"),
    )


@query(
    "c3_day_first_dates",
    f"WITH {TEXT_SQL} SELECT rid, cast({layouts_sql('sold_on')} AS date) AS date FROM dirty_text",
)
def day_first(spark, sf):
    return dirty_text(spark, sf).select("rid", parsing.day_first_date(F.col("sold_on")).alias("date"))


@query(
    "c4_request_dates",
    f"""WITH {TEXT_SQL}, asked AS (SELECT rid, CASE WHEN rid % 5 = 0 THEN epoch(date)::bigint::varchar
      WHEN rid % 5 = 1 THEN m || '/' || d || '/' || y ELSE sold_on END AS txt
      FROM dirty_text JOIN (SELECT rid, date, y, m, d FROM cents_text) USING (rid))
    SELECT rid, CASE WHEN regexp_full_match(txt, '[0-9]+') AND length(txt) <> 8 THEN make_timestamp(txt::bigint * 1000000) ELSE
      {layouts_sql('txt')} END AS parsed_at FROM asked""",
)
def request_dates(spark, sf):
    true_date = sales_line(spark, sf).select("rid", "date")
    asked = dirty_text(spark, sf).join(true_date, "rid")
    at = (
        F.when(F.col("rid") % 5 == 0, (F.unix_date("date").cast("bigint") * 86_400).cast("string"))
        .when(F.col("rid") % 5 == 1, F.date_format("date", "MM/dd/yyyy"))
        .otherwise(F.col("sold_on"))
    )
    return asked.select("rid", parsing.request_timestamp(at).alias("parsed_at"))


REPAIRED_SQL = f"coalesce({layouts_sql('sold_on')}, {SWAP_SQL})"


@query(
    "c5_date_repair",
    f"WITH {TEXT_SQL} SELECT rid, cast({REPAIRED_SQL} AS date) AS date FROM dirty_text",
)
def date_repair(spark, sf):
    rows = dirty_text(spark, sf).withColumn("date", parsing.day_first_date(F.col("sold_on")))
    return repair.repair_dates(rows, "sold_on").select("rid", "date")


PLAIN_SQL = "try_cast(replace({0}, ',', '.') AS double)"


@query(
    "c6_value_recompute",
    f"""WITH {TEXT_SQL} SELECT rid, round(coalesce({number_sql('amount')},
    {PLAIN_SQL.format('qty')} * {PLAIN_SQL.format('price')}), 2) AS value FROM dirty_text""",
)
def value_recompute(spark, sf):
    value = repair.recompute_value(
        parsing.clean_number(F.col("amount")), parsing.plain_number(F.col("qty")), parsing.plain_number(F.col("price"))
    )
    return dirty_text(spark, sf).select("rid", F.round(value, 2).alias("value"))


@query(
    "c7_value_repair",
    f"""WITH {DIRTY_SQL} SELECT store_id, count(*) AS n, count(*) FILTER (value IS NULL OR value < 0) AS value_fixed,
    round(sum(abs(coalesce(value, 0))), 2) AS total FROM dirty_sales GROUP BY store_id""",
)
def value_repair(spark, sf):
    bad = F.col("value").isNull() | (F.col("value") < 0)
    rows = dirty_sales(spark, sf).withColumn("fixed", repair.repair_value(F.col("value")))
    return rows.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(bad).alias("value_fixed"),
        F.round(F.sum("fixed"), 2).alias("total"),
    )


@query(
    "c8_fill_ids",
    f"""WITH {TEXT_SQL}, ids AS (SELECT rid,
      try_cast(nullif(regexp_extract(coalesce(shop, product_id), '(\\d+)', 1), '') AS bigint) AS id FROM dirty_text)
    SELECT rid, coalesce(id, (SELECT max(id) FROM ids) + row_number() OVER (PARTITION BY id IS NULL ORDER BY rid)) AS id
    FROM ids""",
)
def fill_ids(spark, sf):
    rows = dirty_text(spark, sf).select("rid", F.col("shop").alias("id"), "product_id")
    return repair.fill_ids(rows, ["rid"], fallback="product_id").select("rid", "id")


CONFORMED_SQL = f"""conformed AS (SELECT rid, try_cast(nullif(regexp_extract(shop, '(\\d+)', 1), '') AS bigint) AS id,
  {layouts_sql('sold_on')} AS date, {REPAIRED_SQL} AS fixed, {number_sql('amount')} AS value, sold_on FROM dirty_text)"""


def conformed(spark, sf):
    return conformed_rows(dirty_text(spark, sf))


def conformed_rows(rows):
    return rows.select(
        "rid",
        parsing.first_digits(F.col("shop")).alias("id"),
        parsing.day_first_date(F.col("sold_on")).alias("date"),
        parsing.clean_number(F.col("amount")).alias("value"),
        "sold_on",
    )


@query(
    "c9_repair_report",
    f"""WITH {TEXT_SQL}, {CONFORMED_SQL} SELECT count(*) AS rows_before,
    count(*) FILTER (date IS NULL AND fixed IS NOT NULL) AS date_fixed,
    count(*) FILTER (value IS NULL OR value < 0) AS value_fixed, count(*) FILTER (id IS NULL) AS id_filled
    FROM conformed""",
)
def repair_report(spark, sf):
    rows = conformed(spark, sf)
    return repair.repair_report(rows, parsing.repaired_date(F.col("date"), F.col("sold_on")))


@query(
    "c9_repair_sample",
    f"""WITH {TEXT_SQL}, {CONFORMED_SQL} SELECT rid, id, cast(fixed AS date) AS date, abs(coalesce(value, 0)) AS value
    FROM conformed ORDER BY rid LIMIT 5""",
)
def repair_sample(spark, sf):
    def repaired(rows):
        fixed = repair.repair_dates(conformed_rows(rows), "sold_on")
        return fixed.withColumn("value", repair.repair_value(F.col("value"))).select("rid", "id", "date", "value")

    return repair.repair_sample(dirty_text(spark, sf), ["rid"], repaired=repaired)


RULES_SQL = """SELECT 'min' AS rule, 'value' AS column, min(value) AS observed, 0.0::double AS threshold,
    coalesce(min(value) >= 0, true) AS ok FROM {0}
  UNION ALL SELECT 'missing', 'id', round(avg((id IS NULL)::int), 9), 0.01, avg((id IS NULL)::int) <= 0.01 FROM {0}
  UNION ALL SELECT 'missing', 'date', round(avg((date IS NULL)::int), 9), 0.05, avg((date IS NULL)::int) <= 0.05 FROM {0}
  UNION ALL SELECT 'missing', 'value', round(avg((value IS NULL)::int), 9), 0.05, avg((value IS NULL)::int) <= 0.05 FROM {0}"""


@query(
    "c10_validation",
    f"""WITH {TEXT_SQL}, {CONFORMED_SQL}, repaired AS (SELECT id, fixed AS date, abs(coalesce(value, 0)) AS value
    FROM conformed) SELECT 'before' AS stage, * FROM ({RULES_SQL.format('conformed')})
    UNION ALL SELECT 'after', * FROM ({RULES_SQL.format('repaired')})""",
)
def validation(spark, sf):
    rows = conformed(spark, sf)
    fixed = repair.repair_dates(rows, "sold_on").withColumn("value", repair.repair_value(F.col("value")))
    before = repair.validate(rows).withColumn("stage", F.lit("before"))
    return rounded(before.unionByName(repair.validate(fixed).withColumn("stage", F.lit("after"))), {"observed": 9})


# ------------------------------------------------------------------------------------------ cleaning


@query(
    "d1_harmonize_dates",
    f"""WITH {TEXT_SQL}, t AS (SELECT rid, sold_on FROM dirty_text)
    SELECT rid, CASE WHEN regexp_full_match(sold_on, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime(sold_on, '%Y-%m-%d')
    END AS date FROM t""",
)
def harmonize(spark, sf):
    rows = dirty_text(spark, sf).select("rid", F.col("sold_on").alias("date"))
    return clean.harmonize_dates(rows, layout="yyyy-MM-dd")


@query(
    "d1_utc_timestamps",
    "SELECT event_id, ts AS date FROM events",
)
def utc_timestamps(spark, sf):
    """Event times with a zone, taken back to plain UTC."""
    rows = table(spark, sf, "events").select("event_id", F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z"))).alias("date"))
    return clean.harmonize_dates(rows)


def _fill_sql(fn: str, direction: str, keys: str = "") -> str:
    frame = {
        "ffill": "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW",
        "bfill": "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING",
    }[direction]
    part = f"PARTITION BY {keys} " if keys else ""
    return f"{fn}(value IGNORE NULLS) OVER ({part}ORDER BY date, rid {frame})"


for _strategy, _expr in (
    ("ffill", _fill_sql("last_value", "ffill")),
    ("bfill", _fill_sql("first_value", "bfill")),
    ("mean", "round(coalesce(value, (SELECT avg(value) FROM dirty_sales)), 4)"),
    ("zero", "coalesce(value, 0)"),
):

    def _fill(spark, sf, strategy=_strategy):
        rows = dirty_sales(spark, sf).select("rid", "date", "value")
        out = clean.fill_missing(rows, ["value"], strategy).select("rid", "value")
        return rounded(out, {"value": 4}) if strategy == "mean" else out

    query(f"d2_fill_{_strategy}_all_rows", f"WITH {DIRTY_SQL} SELECT rid, {_expr} AS value FROM dirty_sales")(_fill)

for _strategy, _expr in (
    ("ffill", _fill_sql("last_value", "ffill", "store_id, product_id")),
    ("bfill", _fill_sql("first_value", "bfill", "store_id, product_id")),
    ("mean", "coalesce(value, avg(value) OVER (PARTITION BY store_id, product_id))"),
):

    def _fill_series(spark, sf, strategy=_strategy):
        cents = F.round(F.col("value") * 100).alias("value")
        rows = dirty_sales(spark, sf).select("rid", "store_id", "product_id", "date", cents)
        keys = ("store_id", "product_id")
        return clean.fill_missing(rows, ["value"], strategy, keys=keys).select("rid", "value")

    query(
        f"d2_fill_{_strategy}_series",
        f"""WITH {DIRTY_SQL}, t AS (SELECT rid, store_id, product_id, date, round(value * 100) AS value FROM dirty_sales)
        SELECT rid, {_expr} AS value FROM t""",
    )(_fill_series)


@query(
    "d3_fill_others",
    f"""WITH {DIRTY_SQL}, t AS (SELECT rid, date, price, CASE WHEN rid % 3 = 0 THEN product_id END AS product_id
      FROM dirty_sales)
    SELECT rid, coalesce(last_value(price IGNORE NULLS) OVER f, first_value(price IGNORE NULLS) OVER b) AS price,
      coalesce(last_value(product_id IGNORE NULLS) OVER f, first_value(product_id IGNORE NULLS) OVER b) AS product_id
    FROM t WINDOW f AS (ORDER BY date, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      b AS (ORDER BY date, rid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def fill_others(spark, sf):
    rows = dirty_sales(spark, sf).select(
        "rid", "date", "price", F.when(F.col("rid") % 3 == 0, F.col("product_id")).alias("product_id")
    )
    return clean.fill_other_columns(rows, ["price", "product_id"]).drop("date")


Z_SQL = "abs((value - avg(value) OVER {0}) / nullif(stddev_samp(value) OVER {0}, 0)) > {1}"


@query(
    "d4_zscore_outliers",
    f"WITH {DIRTY_SQL} SELECT rid, value, coalesce({Z_SQL.format('()', 2.0)}, false) AS is_outlier FROM dirty_sales",
)
def zscore(spark, sf):
    return clean.outlier_flag(dirty_sales(spark, sf).select("rid", "value"), threshold=2.0)


@query(
    "d4_remove_outliers_series",
    f"""WITH {DIRTY_SQL}, z AS (SELECT rid, value,
    coalesce({Z_SQL.format('(PARTITION BY store_id, product_id)', 2.0)}, false) AS o FROM dirty_sales)
    SELECT rid, value FROM z WHERE NOT o""",
)
def remove_outliers(spark, sf):
    rows = dirty_sales(spark, sf).select("rid", "store_id", "product_id", "value")
    return clean.remove_outliers(rows, threshold=2.0, keys=("store_id", "product_id")).select("rid", "value")


MEDIAN_SQL = """medians AS (SELECT product_id, quantile_cont(quantity, 0.5) AS med FROM {0} WHERE quantity <= 10000
  GROUP BY product_id), overall AS (SELECT quantile_cont(quantity, 0.5) AS med FROM {0} WHERE quantity <= 10000)"""
CAP_SQL = """CASE WHEN quantity <= 10000 THEN quantity WHEN quantity > 10000
  THEN coalesce((SELECT med FROM medians m WHERE m.product_id = s.product_id), (SELECT med FROM overall))
  ELSE (SELECT med FROM overall) END"""


@query(
    "d5_d6_quantity_cap",
    f"WITH {DIRTY_SQL}, {MEDIAN_SQL.format('dirty_sales')} SELECT rid, {CAP_SQL} AS quantity FROM dirty_sales s",
)
def quantity_cap(spark, sf):
    return clean.cap_quantity(dirty_sales(spark, sf)).select("rid", "quantity")


@query(
    "d5_quantity_cap_overall",
    f"""WITH {DIRTY_SQL}, {MEDIAN_SQL.format('dirty_sales')} SELECT rid,
    CASE WHEN quantity <= 10000 THEN quantity ELSE (SELECT med FROM overall) END AS quantity FROM dirty_sales s""",
)
def quantity_cap_overall(spark, sf):
    return clean.cap_quantity(dirty_sales(spark, sf), by_product=False).select("rid", "quantity")


@query(
    "d7_consistent_value",
    f"""WITH {DIRTY_SQL} SELECT rid, round(CASE WHEN value IS NULL OR value = 0 OR value > price * quantity * 100
    THEN price * quantity ELSE value END, 2) AS value FROM dirty_sales""",
)
def consistent_value(spark, sf):
    return rounded(clean.consistent_value(dirty_sales(spark, sf)).select("rid", "value"), {"value": 2})


def _chain_sql(fill: str, cap: str, keys: str = "") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    others = ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER f, first_value({c} IGNORE NULLS) OVER b) AS {c}" for c in ("quantity", "price"))
    return f"""WITH {DIRTY_SQL}, filled AS (SELECT rid, store_id, product_id, {others}, {fill} AS value FROM dirty_sales
      WINDOW f AS ({part}ORDER BY date, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        b AS ({part}ORDER BY date, rid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    kept AS (SELECT * FROM (SELECT *, coalesce({Z_SQL.format('()', 3.0)}, false) AS o FROM filled) WHERE NOT o),
    {MEDIAN_SQL.format('kept')}, capped AS (SELECT rid, price, value, {cap} AS quantity FROM kept s)
    SELECT rid, quantity, round(CASE WHEN value IS NULL OR value = 0 OR value > price * quantity * 100
    THEN price * quantity ELSE value END, 2) AS value FROM capped"""


@query("d8_clean_chain", _chain_sql(_fill_sql("last_value", "ffill", "store_id, product_id"), CAP_SQL, "store_id, product_id"))
def clean_chain(spark, sf):
    return rounded(clean.clean(dirty_sales(spark, sf)).select("rid", "quantity", "value"), {"value": 2})


@query(
    "d8_clean_chain_one_table",
    _chain_sql(
        _fill_sql("last_value", "ffill"),
        "CASE WHEN quantity <= 10000 THEN quantity ELSE (SELECT med FROM overall) END",
    ),
)
def clean_chain_one_table(spark, sf):
    out = clean.clean(dirty_sales(spark, sf), keys=(), by_product=False)
    return rounded(out.select("rid", "quantity", "value"), {"value": 2})


@query(
    "d9_clean_report",
    f"""WITH {DIRTY_SQL}, kept AS (SELECT * FROM (SELECT *, coalesce({Z_SQL.format('()', 3.0)}, false) AS o
      FROM dirty_sales) WHERE NOT o), s AS (
    SELECT 'before' AS stage, count(*) AS rows, sum((value IS NULL)::int + (quantity IS NULL)::int + (price IS NULL)::int
      + (store_id IS NULL)::int + (product_id IS NULL)::int + (date IS NULL)::int)::bigint AS nulls FROM dirty_sales
    UNION ALL SELECT 'after', count(*), sum((value IS NULL)::int + (quantity IS NULL)::int + (price IS NULL)::int)::bigint
      FROM kept)
    SELECT *, (SELECT rows FROM s WHERE stage = 'before') - rows AS dropped FROM s""",
)
def clean_report(spark, sf):
    before = dirty_sales(spark, sf)
    return clean.clean_report(before, clean.remove_outliers(before))
