"""Files and column matching (A, B). File queries write what they read to the shared folder first."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salesline.operators import conform, metrics, requests
from salesline.plans.cleaning import PLAIN_SQL, layouts_sql, number_sql
from salesline.plans.datasets import MODELS_SQL, model_metrics, score_sql
from salesline.plans.features import KEY
from salesline.plans.views import (
    DAILY_SQL, DIRTY_SQL, LINE_SQL, TEXT_SQL, dirty_sales, dirty_text, sales_daily, sales_line, table,
)
from salesline.registry import query, rounded
from salesline.session import checkpoint_dir
from salesline.sources import files, json_files

TEXT_COLS = ["rid", "shop", "sold_on", "amount", "qty", "price", "product_id"]


def scratch(spark) -> str:
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def text_rows(spark, sf):
    return dirty_text(spark, sf).select(F.col("rid").cast("string").alias("rid"), *TEXT_COLS[1:])


@query("a1_a2_csv_scan", f"WITH {TEXT_SQL} SELECT rid::varchar AS rid, shop, sold_on, amount, qty, price, product_id FROM dirty_text")
def csv_scan(spark, sf):
    """Rows written with semicolons, the delimiter found again from the file."""
    path = scratch(spark)
    text_rows(spark, sf).write.option("header", True).option("sep", ";").csv(path)
    return files.read_csv(spark, path).rows.drop("source_file")


@query(
    "a2_csv_bad_rows",
    f"WITH {TEXT_SQL} SELECT rid % 101 = 0 AS rejected, count(*) AS n FROM dirty_text GROUP BY 1",
)
def csv_bad_rows(spark, sf):
    """Lines with too many fields are set apart, short ones are kept."""
    path = scratch(spark)
    line = (
        F.when(F.col("rid") % 101 == 0, F.concat_ws(",", "rid", F.lit("a"), F.lit(""), F.lit("c")))
        .when(F.col("rid") % 103 == 0, F.col("rid").cast("string"))
        .otherwise(F.concat_ws(",", "rid", F.lit("x")))
    )
    rows = dirty_text(spark, sf).select(F.col("rid"), line.alias("line"))
    rows.select(F.split("line", ",")[0].alias("rid"), F.regexp_replace("line", "^[^,]*,?", "").alias("rest")).write.option(
        "header", True
    ).option("quote", "").csv(path)
    read = files.read_csv(spark, path, sep=",", quoted=False)
    parts = [d.select(F.lit(flag).alias("rejected")) for d, flag in ((read.rows, False), (read.rejected, True))]
    return parts[0].unionByName(parts[1]).groupBy("rejected").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a3_folder_scan",
    f"""WITH {TEXT_SQL} SELECT 2 AS columns, count(*) AS n FROM dirty_text WHERE rid % 2 = 0
    UNION ALL SELECT 3, count(*) FROM dirty_text WHERE rid % 2 = 1""",
)
def folder_scan(spark, sf):
    """Files of two layouts in one folder."""
    path = scratch(spark)
    rows = text_rows(spark, sf)
    rows.where("cast(rid as bigint) % 2 = 0").select("rid", "shop").write.option("header", True).csv(path)
    rows.where("cast(rid as bigint) % 2 = 1").select("rid", "shop", "qty").write.mode("append").option("header", True).csv(path)
    reads = files.read_folder(spark, path)
    counts = [r.rows.agg(F.lit(len(r.columns)).alias("columns"), F.count("source_file").alias("n")) for r in reads]
    return counts[0].unionByName(counts[1])


@query("a4_stage_read", f"WITH {DAILY_SQL} SELECT store_id, product_id, date, value FROM sales_daily")
def stage_read(spark, sf):
    """Sales stored by store, all read back."""
    path = scratch(spark)
    files.write_stage(sales_daily(spark, sf).select(*KEY, "value"), path, "sales", "clean", ["store_id"])
    return files.read_stage(spark, path, "sales", "clean")


@query("a4_stage_files", f"WITH {DAILY_SQL} SELECT store_id, product_id, date, value FROM sales_daily WHERE store_id = 'S007'")
def stage_files(spark, sf):
    """Sales stored by store, one store read back: only its files are opened."""
    path = scratch(spark)
    files.write_stage(sales_daily(spark, sf).select(*KEY, "value"), path, "sales", "clean", ["store_id"])
    return files.read_stage(spark, path, "sales", "clean").where("store_id = 'S007'")


@query(
    "a5_encoded_csv",
    f"WITH {TEXT_SQL} SELECT rid::varchar AS rid, 'é ' || shop AS shop FROM dirty_text",
)
def encoded_csv(spark, sf):
    """A bar-separated file in another encoding."""
    path = scratch(spark)
    rows = text_rows(spark, sf).select("rid", F.concat(F.lit("é "), "shop").alias("shop"))
    rows.write.option("header", True).option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    return files.read_csv(spark, path, sep="|", encoding="ISO-8859-1").rows.drop("source_file")


@query("a6_request_files", "SELECT event_id::varchar AS id, 0 AS pos, cast(ts AS date)::timestamp AS date, value FROM events")
def request_files(spark, sf):
    path = scratch(spark)
    point = F.struct(F.to_date("ts").cast("string").alias("date"), F.col("value"))
    rows = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"), F.array(point).alias("series"))
    rows.write.json(path)
    return requests.explode_requests(json_files.read_requests(spark, path)).drop("extras")


@query(
    "a7_metrics_files",
    f"""WITH {MODELS_SQL}, s AS ({score_sql('model_metrics')}) SELECT model, round(mae, 4) AS mae, round(rmse, 4) AS rmse,
    round(r2, 8) AS r2, score, verdict, model AS backend FROM s""",
)
def metrics_files(spark, sf):
    """Metrics of the simple models written as JSON files, read back, scored and labelled."""
    path = scratch(spark)
    body = F.struct(F.col("mae").alias("MAE_test"), F.col("rmse").alias("RMSE_test"), F.col("r2").alias("R2_test"))
    model_metrics(spark, sf).select("model", body.alias("b")).select("model", "b.*").repartition("model").write.partitionBy("model").json(path)
    entries = json_files.metric_entries(json_files.newest_metrics(spark, path))
    out = metrics.summarize_models(metrics.normalize_metrics(entries))
    return rounded(out.withColumn("backend", metrics.backend_label(F.col("model"))), {"mae": 4, "rmse": 4, "r2": 8})


@query(
    "a8_forecast_log",
    f"""WITH {DAILY_SQL} SELECT store_id || '_' || product_id AS id, 7 AS horizon, count(*) AS n_input, 7 AS n_forecast,
      6 AS days, 'naive' AS method FROM sales_daily GROUP BY store_id, product_id""",
)
def forecast_log(spark, sf):
    from salesline.operators.forecast import naive_forecast

    path = scratch(spark)
    keys = ["store_id", "product_id"]
    daily = sales_daily(spark, sf)
    files.append_forecast_log(naive_forecast(daily, keys, 7), path, "naive", keys, 7, daily)
    return spark.read.parquet(path).drop("logged_at")


LANE_SQL = "('0x' || substr(md5(k), {0}, 15))::bigint"


@query(
    "a9_fingerprint",
    f"""WITH {DIRTY_SQL}, t AS (SELECT coalesce('V' || (date::varchar), 'N') || chr(31) || coalesce('V' || (product_id::varchar), 'N')
      || chr(31) || coalesce('V' || (qty::varchar), 'N') || chr(31) || coalesce('V' || (rid::varchar), 'N') AS k
      FROM (SELECT date, product_id, quantity::bigint AS qty, rid FROM dirty_sales)),
    l AS (SELECT {LANE_SQL.format(1)} AS a, {LANE_SQL.format(17)} AS b FROM t)
    SELECT count(*) AS rows, bit_xor(a) AS xor_a, bit_xor(b) AS xor_b, sum(a)::varchar AS sum_a, sum(b)::varchar AS sum_b FROM l""",
)
def table_fingerprint(spark, sf):
    rows = dirty_sales(spark, sf).select("rid", F.col("quantity").cast("bigint").alias("qty"), "product_id", "date")
    return files.fingerprint(rows)


@query("a10_duplicate_files", f"WITH {LINE_SQL} SELECT 2 AS files, count(*) + 1 AS lines FROM sales_line GROUP BY store_id")
def duplicate_files(spark, sf):
    """One file per store, written to two folders: copies are found by their contents, whatever their names."""
    path = scratch(spark)
    rows = sales_line(spark, sf).select("rid", "store_id").repartition("store_id").sortWithinPartitions("store_id", "rid")
    for folder in ("one", "two"):
        rows.write.partitionBy("store_id").option("header", True).csv(f"{path}/{folder}")
    return files.duplicate_files(spark, path).select("files", "lines")


@query(
    "a11_ingest_record",
    f"""WITH {TEXT_SQL} SELECT 'dirty_text' AS source, count(*) AS rows, 'success' AS validation_status FROM dirty_text""",
)
def ingest_record(spark, sf):
    raw = text_rows(spark, sf)
    out, mapping = conform.conform(raw, {"id": "shop", "date": "sold_on", "value": "amount"})
    return files.ingest_record(raw, out, "dirty_text", mapping).select("source", "rows", "validation_status")


@query(
    "a12_archive",
    f"""WITH {DAILY_SQL} SELECT '2024-01-0' || i AS run_ts, count(*) AS n FROM sales_daily, range(1, 3) r(i) GROUP BY 1""",
)
def archived(spark, sf):
    path = scratch(spark)
    for day in ("2024-01-01", "2024-01-02"):
        files.archive(sales_daily(spark, sf), path, "features", day)
    rows = spark.read.parquet(f"{path}/features").withColumn("run_ts", F.col("run_ts").cast("string"))
    return rows.groupBy("run_ts").agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------------------- column matching

NORMALIZED_SQL = "trim(regexp_replace(regexp_replace(lower(trim({0})), '[\\s\\-_]+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_')"
HEADERS_SQL = "headers AS (SELECT p_partkey, '  ' || p_name || ' - ' || p_brand || '_(' || p_type || ')' AS name FROM part)"


def headers(spark, sf):
    name = F.concat(F.lit("  "), "p_name", F.lit(" - "), "p_brand", F.lit("_("), "p_type", F.lit(")"))
    return table(spark, sf, "part").select("p_partkey", name.alias("name"))


@query(
    "b1_normalized_names",
    f"WITH {HEADERS_SQL} SELECT p_partkey, {NORMALIZED_SQL.format('name')} AS name FROM headers",
)
def normalized_names(spark, sf):
    return headers(spark, sf).select("p_partkey", conform.normalized_name(F.col("name")).alias("name"))


def _likeness_sql(target: str) -> str:
    n = NORMALIZED_SQL.format("name")
    each = ", ".join(
        f"100 * (1 - levenshtein({n}, '{a}') / greatest(length({n}), {len(a)})::double)"
        for a in map(conform.plain_name, conform.ALIASES[target])
    )
    return f"round(greatest({each}), 9) AS {target}_score"


@query(
    "b2_name_likeness",
    f"WITH {HEADERS_SQL} SELECT p_partkey, {', '.join(_likeness_sql(t) for t in conform.TARGETS)} FROM headers",
)
def name_likeness(spark, sf):
    scores = {t: conform.edit_likeness(F.col("name"), conform.ALIASES[t]) for t in conform.TARGETS}
    out = headers(spark, sf).select("p_partkey", *[c.alias(f"{t}_score") for t, c in scores.items()])
    return rounded(out, {f"{t}_score": 9 for t in conform.TARGETS})


@query("b2_name_scores", f"WITH {HEADERS_SQL} SELECT p_partkey, {_likeness_sql('id')} FROM headers")
def name_scores(spark, sf):
    """The name points the mapping uses, for a whole table of names."""
    score = conform.edit_likeness(F.col("name"), conform.ALIASES["id"])
    return rounded(headers(spark, sf).select("p_partkey", score.alias("id_score")), {"id_score": 9})


EVIDENCE_COLS = ["shop", "sold_on", "amount", "qty", "price"]


@query(
    "b3_b5_column_evidence",
    f"WITH {TEXT_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count({c}) AS known,
        round(avg(CASE WHEN {c} IS NOT NULL THEN (({layouts_sql(c)}) IS NOT NULL)::int END), 9) AS date_share,
        round(avg(CASE WHEN {c} IS NOT NULL THEN (({number_sql(c)}) IS NOT NULL)::int END), 9) AS number_share,
        round(count(DISTINCT {c}) / count(*), 9) AS distinct_share FROM dirty_text"""
        for c in EVIDENCE_COLS
    ),
)
def column_evidence(spark, sf):
    out = conform.column_evidence(dirty_text(spark, sf), EVIDENCE_COLS)
    return rounded(out, {"date_share": 9, "number_share": 9, "distinct_share": 9})


@query("b6_column_mapping", "SELECT * FROM (VALUES ('id', 'product_id'), ('date', 'sold_on'), ('value', 'qty')) t(target, \"column\")")
def column_mapping(spark, sf):
    """The column each target takes, out of all columns."""
    mapping = conform.best_mapping(spark, conform.gather(text_rows(spark, sf)))
    return spark.createDataFrame(list(mapping.items()), "target string, column string")


@query("b9_fallback_mapping", "SELECT * FROM (VALUES ('id', 'product_id'), ('date', 'sold_on'), ('value', 'qty')) t(target, \"column\")")
def fallback_mapping(spark, sf):
    """Targets found without name points, from bare names and contents alone."""
    found = conform.fallback_mapping(spark, conform.gather(text_rows(spark, sf)))
    return spark.createDataFrame(list(found.items()), "target string, column string")


CONFORM_SQL = f"""try_cast(nullif(regexp_extract(shop, '(\\d+)', 1), '') AS bigint) AS id,
  cast({layouts_sql('sold_on')} AS date) AS date,
  round(coalesce({number_sql('amount')}, {PLAIN_SQL.format('qty')} * {PLAIN_SQL.format('price')}), 2) AS value"""


@query(
    "b7_b11_conform",
    f"""WITH {TEXT_SQL} SELECT {CONFORM_SQL}, rid::varchar AS extra_rid, qty AS extra_qty, price AS extra_price,
    product_id AS extra_product_id FROM dirty_text""",
)
def conformed(spark, sf):
    mapping = {"id": "shop", "date": "sold_on", "value": "amount"}
    out, _ = conform.conform(text_rows(spark, sf), mapping, extra_prefix="extra_")
    return rounded(out, {"value": 2})


@query("b12_report_columns", "SELECT 'o_orderdate' AS date_column, 'o_orderkey' AS value_column")
def report_columns(spark, sf):
    """Date and value columns of the order table, which has neither usual name."""
    found = conform.detect_report_columns(table(spark, sf, "orders"))
    return spark.createDataFrame([found], "date_column string, value_column string")


@query(
    "b13_feature_names",
    f"WITH {LINE_SQL} SELECT rid, store_id, product_id, price FROM sales_line",
)
def feature_names(spark, sf):
    rows = sales_line(spark, sf).select(
        "rid", F.col("store_id").alias("id"), F.col("product_id").alias("product"), F.col("price").alias("unit_price")
    )
    return conform.feature_names(rows)
