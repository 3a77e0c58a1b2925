"""The views most queries start from, as DataFrames and as the same SQL.

Money is kept in whole cents until it has been summed, so sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RID = "(((l_orderkey * 20001 + l_partkey) * 1001 + l_suppkey) * 10 + l_linenumber) * 100 + cast(l_quantity as bigint)"

# ---------------------------------------------------------------------------------------------- SQL

LINE_SQL = f"""
sales_line AS (
  SELECT {RID} AS rid,
    'S' || lpad(cast(s_nationkey AS varchar), 3, '0') AS store_id, p_type AS product_id, p_brand AS category,
    cast(l_shipdate AS date) AS date, l_quantity AS quantity,
    floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS price,
    CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS on_promo,
    cast(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) AS bigint) AS cents,
    floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) / 100 AS value,
    l_suppkey, l_partkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""

DAILY_SQL = LINE_SQL + """,
sales_daily AS (
  SELECT store_id, product_id, date, sum(cents)::bigint / 100 AS value, sum(quantity) AS quantity,
    cast(sum(cast(floor(price * 100 + 0.5) AS bigint)) AS double) / count(*) / 100 AS price,
    max(on_promo) AS on_promo, sum(cents)::bigint AS cents
  FROM sales_line GROUP BY store_id, product_id, date)"""

TOTAL_SQL = DAILY_SQL + """,
sales_total_daily AS (
  SELECT date, sum(cents)::bigint / 100 AS value, sum(quantity) AS quantity, sum(cents)::bigint AS cents
  FROM sales_daily GROUP BY date)"""

DIRTY_SQL = LINE_SQL + """,
dirty_sales AS (
  SELECT rid, store_id, product_id, date,
    CASE WHEN rid % 41 = 0 THEN NULL WHEN rid % 53 = 0 THEN -value WHEN rid % 59 = 0 THEN 0.0 ELSE value END AS value,
    CASE WHEN rid % 97 = 0 THEN quantity * 1000 WHEN rid % 71 = 0 THEN NULL ELSE quantity END AS quantity,
    CASE WHEN rid % 61 = 0 THEN NULL ELSE price END AS price
  FROM sales_line)"""

TEXT_SQL = LINE_SQL + """,
cents_text AS (
  SELECT *, (cents // 100)::varchar || '.' || lpad((cents % 100)::varchar, 2, '0') AS amount,
    year(date)::varchar AS y, lpad(month(date)::varchar, 2, '0') AS m, lpad(day(date)::varchar, 2, '0') AS d
  FROM sales_line),
dirty_text AS (
  SELECT rid,
    CASE WHEN rid % 13 = 0 THEN NULL WHEN rid % 17 = 0 THEN 'unknown' ELSE 'store_' || l_suppkey END AS shop,
    CASE WHEN rid % 29 = 0 THEN 'not a date' WHEN rid % 37 = 0 THEN ltrim(d, '0') || '/' || ltrim(m, '0') || '/' || y
      WHEN rid % 41 = 0 THEN y || '-' || m || '-' || d || 'T03:04:05Z' WHEN rid % 43 = 0 THEN y || '-' || m || '-' || d || ' 01:30:00.250+02:00'
      WHEN rid % 47 = 0 THEN y || '-' || ltrim(m, '0') || '-' || d || ' 10:00' WHEN rid % 53 = 0 THEN y || m || d WHEN rid % 31 = 0 THEN substr(y, 3, 2) || '/' || d || '/' || m
      WHEN rid % 3 = 0 THEN y || '-' || m || '-' || d WHEN rid % 3 = 1 THEN d || '/' || m || '/' || y
      ELSE y || '-' || d || '-' || m END AS sold_on,
    CASE rid % 7 WHEN 0 THEN '€ ' || amount WHEN 1 THEN replace(amount, '.', ',') WHEN 2 THEN amount || ' $'
      WHEN 3 THEN CASE WHEN rid % 2 = 0 THEN '-' ELSE 'None' END WHEN 4 THEN '1,' || amount ELSE amount END AS amount,
    CASE WHEN rid % 19 = 0 THEN NULL ELSE cast(quantity AS bigint)::varchar END AS qty,
    CASE WHEN rid % 23 = 0 THEN 'n/a' ELSE replace((cast(floor(price * 100 + 0.5) AS bigint) // 100)::varchar
      || '.' || lpad((cast(floor(price * 100 + 0.5) AS bigint) % 100)::varchar, 2, '0'), '.', ',') END AS price,
    CASE WHEN rid % 13 = 0 AND rid % 2 = 0 THEN NULL ELSE 'P' || l_partkey END AS product_id,
    on_promo
  FROM cents_text)"""


# --------------------------------------------------------------------------------------- DataFrames


def sales_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sold line, with the store, product and day it belongs to."""
    line = table(spark, sf_dir, "lineitem")
    shop = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    item = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    cents = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100 + 0.5)
    return (
        line.join(shop, line.l_suppkey == shop.s_suppkey)
        .join(item, line.l_partkey == item.p_partkey)
        .select(
            F.expr(RID).alias("rid"),
            F.concat(F.lit("S"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0")).alias("store_id"),
            F.col("p_type").alias("product_id"),
            F.col("p_brand").alias("category"),
            F.to_date("l_shipdate").alias("date"),
            F.col("l_quantity").alias("quantity"),
            (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5).cast("double") / 100).alias("price"),
            F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("on_promo"),
            cents.cast("bigint").alias("cents"),
            (cents.cast("double") / 100).alias("value"),
            "l_suppkey",
            "l_partkey",
        )
    )


def sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per store, product and day."""
    price_cents = F.sum(F.floor(F.col("price") * 100 + 0.5).cast("bigint")).cast("double")
    return (
        sales_line(spark, sf_dir)
        .groupBy("store_id", "product_id", "date")
        .agg(
            (F.sum("cents").cast("double") / 100).alias("value"),
            F.sum("quantity").alias("quantity"),
            (price_cents / F.count(F.lit(1)) / 100).alias("price"),
            F.max("on_promo").alias("on_promo"),
            F.sum("cents").alias("cents"),
        )
    )


def sales_total_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day."""
    return (
        sales_line(spark, sf_dir)
        .groupBy("date")
        .agg(
            (F.sum("cents").cast("double") / 100).alias("value"),
            F.sum("quantity").alias("quantity"),
            F.sum("cents").alias("cents"),
        )
    )


def _every(n: int):
    return F.col("rid") % n == 0


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold lines with defects at fixed row ids: unknown, negative and zero values, wild quantities."""
    value, quantity = F.col("value"), F.col("quantity")
    return sales_line(spark, sf_dir).select(
        "rid",
        "store_id",
        "product_id",
        "date",
        F.when(~_every(41), F.when(_every(53), -value).when(_every(59), 0.0).otherwise(value)).alias("value"),
        F.when(_every(97), quantity * 1000).when(~_every(71), quantity).alias("quantity"),
        F.when(~_every(61), F.col("price")).alias("price"),
    )


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sold lines as a careless export would write them: all text, mixed layouts."""

    def money(cents):
        whole = F.floor(cents / 100).cast("bigint").cast("string")
        return F.concat(whole, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))

    line = sales_line(spark, sf_dir)
    iso = F.col("date").cast("string")
    y, m, d = (F.substring(iso, at, n) for at, n in ((1, 4), (6, 2), (9, 2)))
    amount, turn = money(F.col("cents")), F.col("rid") % 7
    price = money(F.floor(F.col("price") * 100 + 0.5).cast("bigint"))
    return line.select(
        "rid",
        F.when(_every(13), None)
        .when(_every(17), "unknown")
        .otherwise(F.concat(F.lit("store_"), F.col("l_suppkey").cast("string")))
        .alias("shop"),
        F.when(_every(29), "not a date")
        .when(_every(37), F.concat_ws("/", F.ltrim(d, F.lit("0")), F.ltrim(m, F.lit("0")), y))
        .when(_every(41), F.concat(iso, F.lit("T03:04:05Z")))
        .when(_every(43), F.concat(iso, F.lit(" 01:30:00.250+02:00")))
        .when(_every(47), F.concat(F.concat_ws("-", y, F.ltrim(m, F.lit("0")), d), F.lit(" 10:00")))
        .when(_every(53), F.concat(y, m, d))
        .when(_every(31), F.concat(F.substring(y, 3, 2), F.lit("/"), d, F.lit("/"), m))
        .when(_every(3), iso)
        .when(F.col("rid") % 3 == 1, F.concat_ws("/", d, m, y))
        .otherwise(F.concat_ws("-", y, d, m))
        .alias("sold_on"),
        F.when(turn == 0, F.concat(F.lit("€ "), amount))
        .when(turn == 1, F.replace(amount, F.lit("."), F.lit(",")))
        .when(turn == 2, F.concat(amount, F.lit(" $")))
        .when(turn == 3, F.when(_every(2), "-").otherwise("None"))
        .when(turn == 4, F.concat(F.lit("1,"), amount))
        .otherwise(amount)
        .alias("amount"),
        F.when(~_every(19), F.col("quantity").cast("bigint").cast("string")).alias("qty"),
        F.when(_every(23), "n/a").otherwise(F.replace(price, F.lit("."), F.lit(","))).alias("price"),
        F.when(~(_every(13) & _every(2)), F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("product_id"),
        "on_promo",
    )


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short series with gaps: the event value of each user and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("date"))
        .agg((F.sum(F.floor(F.col("value") * 100 + 0.5).cast("bigint")).cast("double") / 100).alias("value"))
    )


EVENTS_SQL = """
events_daily AS (
  SELECT user_id, cast(ts AS date) AS date,
    sum(cast(floor(value * 100 + 0.5) AS bigint))::bigint / 100 AS value
  FROM events GROUP BY user_id, cast(ts AS date))"""
