"""JSON requests and metrics files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesline.operators.requests import REQUEST_SCHEMA


def read_requests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Requests ``{id, series: [...]}``, or batches ``{requests: [...]}`` of them."""
    schema = f"{REQUEST_SCHEMA}, requests array<struct<id:string,series:array<map<string,string>>>>"
    raw = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    single = raw.where("requests is null").select("id", "series")
    batch = raw.where("requests is not null").select(F.explode("requests").alias("r")).select("r.id", "r.series")
    return single.unionByName(batch)


def metric_entries(texts: DataFrame) -> DataFrame:
    """``(model, path, number)`` from ``(model, value)``, where value is a metrics file's JSON text.

    Sections ``test`` and ``metrics.test`` are opened; their keys join the path with dots.
    """
    text_map = "map<string,string>"
    top = texts.select("model", F.explode(F.from_json("value", text_map)).alias("path", "text"))
    section = F.from_json(F.when(F.col("path") == "test", F.col("text")), text_map)
    inner = F.from_json(F.from_json(F.when(F.col("path") == "metrics", F.col("text")), text_map)["test"], text_map)
    nested = [
        top.select("model", F.explode(m).alias("k", "text")).select("model", F.concat(F.lit(p), "k").alias("path"), "text")
        for m, p in ((section, "test."), (inner, "metrics.test."))
    ]
    entries = top.unionByName(nested[0]).unionByName(nested[1])
    return entries.select("model", "path", F.col("text").try_cast("double").alias("number")).where("number is not null")


def metrics_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``(model, value, modified)``: one row per metrics file, summaries of earlier evaluations left out.

    A file is known by its name, or by that of its folder if it is ``model=<name>``.
    """
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    read = files.text(folder).select(
        F.coalesce(F.url_decode(F.nullif(F.regexp_extract("_metadata.file_path", "/model=([^/]+)/", 1), F.lit(""))), F.col("_metadata.file_name")).alias("model"),
        "value",
        F.col("_metadata.file_modification_time").alias("modified")
    )
    return read.where(~F.lower("model").startswith("eval_summary"))


def newest_metrics(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    """All metrics files, or the newest ``files`` of them, newest first."""
    ordered = metrics_texts(spark, folder).orderBy(F.col("modified").desc(), "model")
    return ordered.limit(files) if files else ordered
