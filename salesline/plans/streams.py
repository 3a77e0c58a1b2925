"""Streaming runs of the ingest and the daily report, read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesline.plans.cleaning import REPAIRED_SQL, number_sql
from salesline.plans.sources import scratch, text_rows
from salesline.plans.views import TEXT_SQL, table
from salesline.registry import query
from salesline.streaming import ingest


@query(
    "x1_stream_ingest",
    f"""WITH {TEXT_SQL} SELECT rid::varchar AS rid, try_cast(nullif(regexp_extract(shop, '(\\d+)', 1), '') AS bigint) AS id,
    cast({REPAIRED_SQL} AS date) AS date, abs(coalesce({number_sql('amount')}, 0)) AS value FROM dirty_text""",
)
def stream_ingest(spark, sf):
    """Files that arrive in two goes, each taken once."""
    path = scratch(spark)
    rows = text_rows(spark, sf).select("rid", "shop", "sold_on", "amount")
    apply = ingest.conform_batch({"id": "shop", "date": "sold_on", "value": "amount"})
    for part in (0, 1):
        go = rows.where(F.col("rid").cast("bigint") % 2 == part)
        go.write.mode("append").option("header", True).csv(f"{path}/in")
        run = ingest.ingest_new_files(spark, f"{path}/in", rows.columns, f"{path}/out", f"{path}/state", apply)
        run.awaitTermination()
    return spark.read.parquet(f"{path}/out").drop("batch")


@query(
    "x1_stream_daily",
    """SELECT cast(ts AS date) AS date, sum(cast(floor(value * 100 + 0.5) AS bigint))::bigint AS total, count(*) AS n
    FROM events GROUP BY 1""",
)
def stream_daily(spark, sf):
    path = scratch(spark)
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    cents = F.floor(F.col("value") * 100 + 0.5).cast("bigint").alias("value")
    rows = stream.select(F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z"))).alias("ts"), cents)
    ingest.keep_daily_totals(rows, f"{path}/daily", f"{path}/state").awaitTermination()
    return ingest.latest_totals(spark, f"{path}/daily")
