"""The folder ingest and the daily report as streams: each run takes what is new and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesline.operators import conform, repair


def conform_batch(mapping: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """Conform and repair the rows of a batch with a known mapping."""

    def apply(raw: DataFrame) -> DataFrame:
        rows, _ = conform.conform(raw.withColumn("_date_text", F.col(f"`{mapping['date']}`")), mapping)
        rows = repair.repair_dates(rows, "_date_text").drop("_date_text")
        return rows.withColumn("value", repair.repair_value(F.col("value")))

    return apply


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    target: str,
    state: str,
    transform: Callable[[DataFrame], DataFrame],
    sep: str = ",",
    pattern: str = "*.csv",
) -> StreamingQuery:
    """Append the transformed rows of files not seen before; ``state`` remembers which were.

    A batch that is run again after a failure replaces its own folder, so no row appears twice.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    stream = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .csv(folder)
    )

    def store(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", state).trigger(availableNow=True).start()
    )


def daily_totals(stream: DataFrame, value: str = "value", ts: str = "ts", late: str = "2 days") -> DataFrame:
    """Sum and count per UTC day. In append and update mode rows later than ``late`` are left out of days already
    closed; complete mode keeps every day open and every row."""
    return (
        stream.withWatermark(ts, late)
        .groupBy(F.window(ts, "1 day").alias("_w"))
        .agg(F.sum(value).alias("total"), F.count(value).alias("n"))
        .select(F.to_date(F.to_utc_timestamp("_w.start", F.current_timezone())).alias("date"), "total", "n")
    )


def store_version(target: str) -> Callable[[DataFrame, int], None]:
    """Writes the days that a batch changed as a version of its own; a batch that is run again replaces its version."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return store


def keep_daily_totals(stream: DataFrame, target: str, state: str, value: str = "value", ts: str = "ts", late: str = "2 days") -> StreamingQuery:
    """Keep the totals of each day as versions under ``target``: a batch adds only the days it changed, with its number.

    Days older than ``late`` are closed and leave the state, so that it holds a few days however long the stream runs.
    """
    daily = daily_totals(stream, value, ts, late)
    return (
        daily.writeStream.outputMode("update")
        .foreachBatch(store_version(target))
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def latest_totals(spark: SparkSession, target: str) -> DataFrame:
    """The newest version of each day."""
    versions = spark.read.parquet(target)
    newest = F.max_by(F.struct("total", "n"), "batch").alias("v")
    return versions.groupBy("date").agg(newest).select("date", "v.*")
