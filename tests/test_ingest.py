"""Files, column matching, repair and request rules on small inputs."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from salesline.functions import parsing
from salesline.operators import combine, conform, metrics, profile, report, repair, requests
from salesline.sources import files, json_files


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, want",
    [("1 234,5 €", 1234.5), ("$12", 12.0), ("-", None), ("None", None), ("1,234.56", None), ("NaN", None), ("-3,5", -3.5)],
)
def test_numbers(spark, text, want):
    assert one(spark, text, parsing.clean_number) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-13-05", dt.date(2024, 5, 13)),
        ("24/31/01", dt.date(2024, 1, 31)),
        ("75-20-03", dt.date(1975, 3, 20)),
        ("05/03/2024", dt.date(2024, 3, 5)),
        ("2024-31-31", None),
        ("soon", None),
    ],
)
def test_date_repair(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").withColumn("date", parsing.day_first_date(F.col("t")))
    assert repair.repair_dates(df, "t").first()["date"] == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("86400", dt.datetime(1970, 1, 2)),
        ("2025-01-02T03:04:05", dt.datetime(2025, 1, 2, 3, 4, 5)),
        ("31/12/2024", dt.datetime(2024, 12, 31)),
        ("12/31/2024", dt.datetime(2024, 12, 31)),
        ("2024/12/31", dt.datetime(2024, 12, 31)),
        ("31-12-2024", dt.datetime(2024, 12, 31)),
        ("", None),
    ],
)
def test_request_dates(spark, text, want):
    assert one(spark, text, parsing.request_timestamp) == want


def test_name_normalisation():
    assert conform.plain_name("  Sale - Date (UTC)__") == "sale_date_utc"


def test_mapping_finds_the_columns(spark):
    rows = [(f"store_{i}", f"2024-01-{i % 28 + 1:02d}", f"{i},50", "x") for i in range(60)]
    df = spark.createDataFrame(rows, "`Store ID` string, `Order-Date` string, Montant string, note string")
    out, mapping = conform.conform(df, extra_prefix="extra_")
    assert mapping == {"id": "Store ID", "date": "Order-Date", "value": "Montant"}
    assert out.columns == ["id", "date", "value", "extra_note"]
    assert out.where("id is null or date is null or value is null").count() == 0


def test_value_from_quantity_and_price(spark):
    df = spark.createDataFrame([("1", "2024-01-01", None, "2", "3,5")], "id string, date string, total string, qty string, price string")
    out, _ = conform.conform(df, {"id": "id", "date": "date", "value": "total"})
    assert out.first()["value"] == 7.0


def test_fallback_and_missing_targets(spark):
    def seen(*names, dates=0.0):
        return [conform.Evidence(n, 10, dates if i == 0 else 0.0, 0.0, 0.5) for i, n in enumerate(names)]

    assert conform.fallback_mapping(spark, seen("x", "SaleDate", "Qty")) == {"date": "SaleDate", "value": "Qty", "id": "x"}
    assert conform.fallback_mapping(spark, seen("when", "b", "c", dates=0.5)) == {"date": "when", "id": "b", "value": "c"}
    with pytest.raises(ValueError, match="date"):
        conform.require_targets(conform.fallback_mapping(spark, seen("a", "b")))
    with pytest.raises(ValueError):
        conform.require_columns(type("T", (), {"columns": ["a"]}), ["a", "b"])


def test_report_columns(spark):
    df = spark.createDataFrame([("x", "2024-01-01", 1, None), ("y", "2024-01-02", 2, 3)], "a string, b string, n int, m int")
    assert conform.detect_report_columns(df) == ("b", "n")


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_delimiters_and_bad_rows(spark, tmp_path):
    for i, sep in enumerate(files.DELIMITERS):
        text = "\n".join(sep.join(r) for r in [("a", "b", "c"), ("1", '"x, y"', "2"), ("3", "z", "4")])
        assert files.detect_delimiter(spark, write(tmp_path / f"d{i}.csv", text)) == sep
    path = write(tmp_path / "bad.csv", "a,b\n1,2\n3\n4,5,6\n")
    read = files.read_csv(spark, path)
    assert [tuple(r)[:2] for r in read.rows.orderBy("a").collect()] == [("1", "2"), ("3", None)]
    assert [r["line"] for r in read.rejected.collect()] == ["4,5,6"]
    with pytest.raises(ValueError):
        repair.require_rows(read.rows.where("a = 'none'"))


def test_stray_quotes_and_encoding(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a;b\n1;5" pipe\n2;"\n')
    assert files.read_csv(spark, path, quoted=False).rows.count() == 2
    path = write(tmp_path / "l.csv", "a|b\né|1\n", "latin-1")
    assert files.read_csv(spark, path, sep="|", encoding="ISO-8859-1").rows.first()["a"] == "é"


def test_folder_with_different_headers(spark, tmp_path):
    write(tmp_path / "one.csv", "a,b\n1,2\n")
    write(tmp_path / "two.csv", "a;b;c\n1;2;3\n4;5;6\n")
    write(tmp_path / "three.csv", "a,b\n1,2\n")
    write(tmp_path / "note.txt", "not a table")
    reads = {r.columns: r.rows.toPandas() for r in files.read_folder(spark, str(tmp_path))}
    assert sorted(reads[("a", "b")]["source_file"]) == ["one.csv", "three.csv"]
    assert len(reads[("a", "b", "c")]) == 2
    found = files.duplicate_files(spark, str(tmp_path)).collect()
    assert [(r["files"], r["first_file"].rsplit("/", 1)[1]) for r in found] == [(2, "one.csv")]


def test_headers_need_no_sort_of_lines(spark, tmp_path, capsys):
    write(tmp_path / "a.csv", "id,v\n" + "0,1\n" * 50)
    write(tmp_path / "b.csv", "aa,v\n0,1\n")
    heads = files.file_headers(spark, str(tmp_path))
    assert sorted(r["header"] for r in heads.collect()) == ["aa,v", "id,v"]
    heads.explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_only_sampled_rows_are_repaired(spark):
    df = spark.createDataFrame([(i, f"2024-{13 + i % 5}-05") for i in range(40)], "rid long, t string")
    seen = []

    def repaired(rows):
        seen.append(rows.count())
        return repair.repair_dates(rows.withColumn("date", parsing.day_first_date(F.col("t"))), "t").select("rid", "date")

    got = repair.repair_sample(df.orderBy(F.desc("rid")), ["rid"], 3, repaired)
    assert seen == [3] and [(r["rid"], r["date"]) for r in got.collect()] == [(i, dt.date(2024, 5, 13 + i)) for i in range(3)]


def test_profile_repeats_no_row_for_a_column(spark, capsys):
    df = spark.createDataFrame([("a", 1.5, (None, "x")), ("a", 0.0, ("x", None)), (None, -0.0, None)], "t string, x double, s struct<a:string,b:string>")
    found = profile.column_profile(df)
    assert [(r["column"], r["known"], r["unknown"], r["distinct"]) for r in found.collect()] == [("t", 2, 1, 1), ("x", 3, 0, 2), ("s", 2, 1, 2)]
    assert [r["distinct"] for r in profile.column_profile(df.where("false")).collect()] == [0, 0, 0]
    profile.column_profile(df, ["t", "x"]).explain()
    assert "Expand" not in capsys.readouterr().out


def test_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(None, 2), ("x", 1)], "s string, i int")
    c = spark.createDataFrame([(1, "x"), (2, "")], "i int, s string")
    assert files.fingerprint(a).first() == files.fingerprint(b).first() != files.fingerprint(c).first()


def test_requests(spark, tmp_path):
    bodies = [
        {"id": "a", "series": [{"date": "2025-01-02", "value": 1}, {"date": "2025-01-01", "value": 5, "price": 9.5},
                               {"date": "02/01/2025", "value": 2, "extras": {"k": "v"}, "marketing": 3}]},
        {"id": "b", "series": []},
        {"id": "c", "series": [{"date": "2025-01-01", "value": None}]},
        {"requests": [{"id": "d", "series": [{"date": "2025-01-01", "value": 7}]}]},
    ]
    path = write(tmp_path / "r.json", "\n".join(json.dumps(b) for b in bodies))
    points = requests.explode_requests(json_files.read_requests(spark, path))
    status = {r["id"]: r["status"] for r in requests.request_status(points).collect()}
    assert status == {"a": "ok", "b": requests.NO_POINTS, "c": requests.NO_VALUES, "d": "ok"}
    kept = requests.valid_points(points).orderBy("id", "date").collect()
    assert [(r["id"], r["date"].day, r["value"]) for r in kept] == [("a", 1, 5.0), ("a", 2, 2.0), ("d", 1, 7.0)]
    assert kept[1]["extras"] == {"k": "v", "marketing": "3"}
    too_many = requests.request_status(points, max_points=2).where("id = 'a'").first()
    assert too_many["status"] == requests.TOO_MANY


def test_metrics_files(spark, tmp_path):
    write(tmp_path / "xgb_metrics.json", json.dumps({"MAE_test": 3, "MAE_test_corrected": 2, "RMSE_test": 4, "R2_test": 0.9}))
    write(tmp_path / "prophet_1.json", json.dumps({"metrics": {"test": {"mae": 5, "rmse": 6, "r2": 0.4}}, "name": "p"}))
    write(tmp_path / "eval_summary_1.json", json.dumps({"MAE_test": 0}))
    texts = json_files.metrics_texts(spark, str(tmp_path))
    assert json_files.newest_metrics(spark, str(tmp_path), 1).count() == 1
    out = metrics.summarize_models(metrics.normalize_metrics(json_files.metric_entries(texts)))
    got = {r["backend"]: (r["mae"], r["score"]) for r in out.withColumn("backend", metrics.backend_label(F.col("model"))).collect()}
    assert got == {"XGBoost": (2.0, 100.0), "Prophet": (5.0, 0.0)}


def test_forecast_normalisation(spark):
    df = spark.createDataFrame([("02/01/2025", "1.5"), ("2025-01-03", "n/a")], "ds string, y string")
    out = combine.normalize_forecast(df).orderBy("ds").collect()
    assert [(r["ds"], r["yhat"]) for r in out] == [(dt.date(2025, 1, 2), 1.5), (dt.date(2025, 1, 3), None)]


def test_series_info_and_activity(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.0), ("a", dt.date(2024, 1, 1), 3.0)], "id string, date date, value double")
    info = combine.series_info(df, "id").first()
    assert info["series_id"] == "a" and info["unique_dates"] == 1 and info["original_rows"] == 2
    matrix = report.activity_matrix(report.activity(df)).collect()
    assert len(matrix) == 7 and len(matrix[0]) == 54 and matrix[0]["1"] == 5.0


def test_csv_records(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "x.csv").write_text('a,b\n1,2\n4,5,,6\n7\n"x,y",3\n8,9,\n')
    read = files.read_csv(spark, str(folder), sep=",")
    assert sorted(r.line for r in read.rejected.collect()) == ["4,5,,6", "8,9,"] and read.rejected.count() == 2
    assert sorted((r.a, r.b) for r in read.rows.fillna("-").collect()) == [("1", "2"), ("7", "-"), ("x,y", "3")]
    (folder / "x.csv").write_text('a,b\n"two\nlines",1\n')
    assert files.read_csv(spark, str(folder), sep=",", multi_line=True).rows.first()["a"] == "two\nlines"
    (folder / "x.csv").write_text('a,b\n1,x "y\n2,"z\n3,"w"\n')
    assert files.read_csv(spark, str(folder), sep=",", quoted=None).rows.count() == 3


def test_daily_totals_are_versions(spark, tmp_path):
    from salesline.streaming import ingest

    def go(rows):
        frame = spark.createDataFrame(rows, "ts string, value long").select(F.col("ts").cast("timestamp").alias("ts"), "value")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("ts timestamp, value long").parquet(str(tmp_path / "in"))
        ingest.keep_daily_totals(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return {str(r.date): (r.total, r.n) for r in ingest.latest_totals(spark, str(tmp_path / "out")).collect()}

    assert go([("2024-01-01 10:00:00", 1), ("2024-01-09 10:00:00", 2)]) == {"2024-01-01": (1, 1), "2024-01-09": (2, 1)}
    # a day still open grows, a new one comes, a closed one takes no more rows
    want = {"2024-01-01": (1, 1), "2024-01-09": (7, 2), "2024-01-10": (4, 1)}
    assert go([("2024-01-01 11:00:00", 100), ("2024-01-09 11:00:00", 5), ("2024-01-10 01:00:00", 4)]) == want
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("batch=*"))
    again = spark.read.parquet(str(tmp_path / "out" / f"batch={last}")).collect()
    ingest.store_version(str(tmp_path / "out"))(spark.createDataFrame(again, "date date, total long, n long") if again else spark.createDataFrame([], "date date, total long, n long"), last)
    assert {str(r.date): (r.total, r.n) for r in ingest.latest_totals(spark, str(tmp_path / "out")).collect()} == want


def test_copies_and_unreadable_files(spark, tmp_path):
    contents = {"one/x.csv": "h\n1\n2\n", "two/x.csv": "h\n1\n2\n", "two/y.csv": "h\n2\n1\n"}
    for name, text in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    found = {(r.files, r.lines, r.first_file.rsplit("/", 1)[1]) for r in files.duplicate_files(spark, str(tmp_path)).collect()}
    assert found == {(2, 3, "x.csv")}
    (tmp_path / "bad.csv.gz").write_bytes(b"\x1f\x8b\x08\x00broken")
    assert [r.source_file.rsplit("/", 1)[1] for r in files.unreadable_files(spark, str(tmp_path)).collect()] == ["bad.csv.gz"]


@pytest.mark.parametrize(
    "text, want",
    [("5/3/2024", "2024-03-05 00:00:00"), ("2024-1-5", "2024-01-05 00:00:00"), ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
     ("2024-01-02 10:00", "2024-01-02 10:00:00"), ("2024-01-02T01:30:00.25+02:00", "2024-01-01 23:30:00.25"), ("20240105", "2024-01-05 00:00:00"),
     ("05/13/2024", "2024-05-13 00:00:00"), ("2024-02-30", None), ("13/13/2024", None), ("x", None), ("", None), (None, None), ("1704067200", "2024-01-01 00:00:00")],
)
def test_request_dates_in_tables(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(parsing.request_timestamp(F.col("t")).cast("string").alias("d")).first()["d"]
    assert got == want


def test_conform_is_compiled(spark, capsys):
    """The JVM compiles no method of more than 8,000 bytes: whatever makes the texts must not be fused with all parsers."""
    from salesline.plans.sources import conformed

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        conformed(spark, "/root/testdata/sf0.001").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_conform_numbers(spark):
    rows = [("1", "2024-01-02", "3,5 €", "2", "4"), ("2", "2024-01-02", "-", "2", "4,5"), ("3", "2024-01-02", None, "n/a", "1")]
    df = spark.createDataFrame(rows, "id string, date string, total string, qty string, price string")
    mapping = {"id": "id", "date": "date", "value": "total"}
    for prefix in ("", "extra_"):
        out, _ = conform.conform(df, mapping, extra_prefix=prefix)
        assert out.columns == ["id", "date", "value", f"{prefix}qty", f"{prefix}price"]
        assert [r["value"] for r in out.orderBy("id").collect()] == [3.5, 9.0, None]
    plain, _ = conform.conform(df, mapping, recompute=False)
    assert [r["value"] for r in plain.orderBy("id").collect()] == [3.5, None, None]


def test_evidence_reads_once(spark):
    """The rows are read in one pass, and each different text is parsed once."""
    from salesline.plans.sources import text_rows

    plan = conform.column_evidence(text_rows(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") and len(re.findall(r"Relation \[[^\]]*l_shipdate", plan)) == 1


@pytest.mark.parametrize("approximate", [False, True])
def test_evidence_counts(spark, approximate):
    rows = [("2024-01-02", "1", None), ("2024-01-02", "x", None), ("soon", "2", None), (None, "2", None)]
    out = conform.column_evidence(spark.createDataFrame(rows, "a string, b string, c string"), approximate=approximate)
    found = {r["column"]: tuple(r)[1:] for r in out.collect()}
    assert found["a"] == (3, pytest.approx(2 / 3), 0.0, 0.5)
    assert found["b"] == (4, 0.0, 0.75, 0.75)
    assert found["c"] == (0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize(
    "text, want",
    [
        ("1/2/2024", dt.datetime(2024, 2, 1)),
        ("20240102", dt.datetime(2024, 1, 2)),
        (" \t2024-1-2", dt.datetime(2024, 1, 2)),
        ("\n\x0b1/2/2024 ", dt.datetime(2024, 2, 1)),
        ("2024-01-02 03:04+01:00", dt.datetime(2024, 1, 2, 2, 4)),
        ("1/2/202", None),
        ("store 2024-01-02", None),
        ("\x012024-01-02", None),
        ("", None),
    ],
)
def test_stamps_at_the_edge(spark, text, want):
    assert one(spark, text, parsing.parsed_timestamp) == want
