"""Session helpers: a tuned session and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "salesline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; extra settings override the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",  # recording the caller of every column takes longer than planning
        "spark.scheduler.mode": "FAIR",  # fits of a search run side by side
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, which has a single
    machine, falls back to a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared folder, so that later plans start from its rows.

    Later passes read only the columns they need, and nothing is lost with an executor.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_into_buckets(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Store ``df`` in the shared folder, its files bucketed by a column, so that later groups and windows over that
    column read them without a shuffle. The catalog's entry lives only until the files are named in the plan."""
    spark, name = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", f"{checkpoint_dir(spark)}/tables/{name}").format("parquet").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def join_small(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join a grouped table, computed once. Its size is then known, so that the planner sends it to all tasks if
    it is small and else shuffles, splitting hot keys."""
    return df.join(cut_lineage(table), list(keys), "left")
