"""Delimited files, stages, checksums and logs."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

# Delimiters looked for.
DELIMITERS = (",", ";", "\t", "|")

BAD_RECORD = "_bad_record"


def _outside_quotes(line: Column) -> Column:
    return F.regexp_replace(line, '"[^"]*"', "")


def _fields(line: Column, sep: str) -> Column:
    bare = _outside_quotes(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def detect_delimiter(spark: SparkSession, path: str, default: str = ",") -> str:
    """The delimiter that splits most lines into the same number of fields, from the counts of all lines."""
    lines = spark.read.text(path).where("length(value) > 0")
    fields = F.array(*[F.struct(F.lit(i).alias("i"), _fields(F.col("value"), d).alias("n")) for i, d in enumerate(DELIMITERS)])
    counts = lines.select(F.explode(fields).alias("f")).groupBy("f.i", "f.n").agg(F.count(F.lit(1)).alias("lines"))
    usual = counts.groupBy("i").agg(F.max_by(F.struct("n", "lines"), F.struct("lines", "n")).alias("u"), F.sum("lines").alias("total"))
    best, best_key = default, (0.0, 0)
    for r in usual.orderBy("i").collect():
        key = (r.u.lines / r.total, r.u.n)
        if r.u.n >= 2 and key > best_key:
            best, best_key = DELIMITERS[r.i], key
    return best


@dataclass(frozen=True)
class CsvRead:
    """Well-formed rows and the raw text of rows with too many fields."""

    rows: DataFrame
    rejected: DataFrame
    sep: str
    columns: tuple[str, ...]


def _header(spark: SparkSession, path: str, sep: str, encoding: str, quoted: bool) -> list[str]:
    reader = spark.read.option("sep", sep).option("header", True).option("encoding", encoding)
    if not quoted:
        reader = reader.option("quote", "").option("escape", "\\")
    return reader.option("enforceSchema", True).csv(path).columns


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str = "UTF-8",
    quoted: bool | None = True,
    multi_line: bool = False,
) -> CsvRead:
    """Read text columns named by the header; rows with too many fields are set apart, short ones
    are filled with nulls. Use ``quoted=False`` for files with stray quotes, or None to take whichever way sets fewer
    rows apart; ``multi_line=True`` allows line breaks within quotes."""
    if quoted is None:
        ways = [read_csv(spark, path, sep, encoding, q, multi_line) for q in (True, False)]
        bad = [w.rejected.count() for w in ways]
        return ways[0] if bad[0] <= bad[1] else ways[1]
    if sep is None:
        sep = detect_delimiter(spark, path)
    columns = _header(spark, path, sep, encoding, quoted)
    if len(columns) <= 1:
        for other in (";", "\t", "|", ","):
            found = _header(spark, path, other, encoding, quoted)
            if len(found) > 1:
                sep, columns = other, found
                break
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("multiLine", multi_line)
    if not quoted:
        reader = reader.option("quote", "").option("escape", "\\")
    return _split_rows(reader, path, sep, columns, quoted)


def _split_rows(reader: DataFrameReader, path: str | list[str], sep: str, columns: Sequence[str], quoted: bool = True) -> CsvRead:
    """Records that do not have as many fields as the header keep their text; those with more are set apart."""
    fields = [f"`{c}` string" for c in [*columns, BAD_RECORD]]
    reader = reader.option("header", True).option("columnNameOfCorruptRecord", BAD_RECORD).option("columnPruning", False)
    rows = reader.schema(", ".join(fields)).csv(path)
    source = F.col("_metadata.file_name").alias("source_file")
    line = F.col(BAD_RECORD)
    bare = line if quoted else F.regexp_replace(line, r"\\.", "")
    n = _fields(bare, sep) if quoted else F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    first = F.col(f"`{columns[0]}`")
    read = first.isNull() | (F.length(first) >= 0)  # always true; the text of a record can't be asked for alone
    over = F.coalesce(n > len(columns), F.lit(False)) & read
    return CsvRead(
        rows.where(~over).select(*[F.col(f"`{c}`") for c in columns], source),
        rows.where(over).select(line.alias("line"), source),
        sep,
        tuple(columns),
    )


def file_headers(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``(source_file, header)``: the first line of every file, from the first split of each.

    The set beside the line, of one value, makes Spark keep a line for each file in a hash map; without it, it would sort
    all lines of a split.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    first = lines.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("source_file"), "value", F.monotonically_increasing_id().alias("_i")
    )
    found = first.groupBy("source_file").agg(F.min_by("value", "_i").alias("header"), F.collect_set(F.lit(True)).alias("_any"))
    return found.where(F.size("_any") > 0).drop("_any")


def read_folder(spark: SparkSession, folder: str, pattern: str = "*.csv", sep: str | None = None) -> list[CsvRead]:
    """All files of a folder, one read per distinct header; rows carry ``source_file``."""
    by_header: dict[str, list[str]] = {}
    for r in file_headers(spark, folder, pattern).orderBy("source_file").toLocalIterator():
        by_header.setdefault(r["header"], []).append(r["source_file"])
    out = []
    for header, files in sorted(by_header.items()):
        first = sep or max(DELIMITERS, key=header.count)
        columns = [n.strip() for n in next(csv.reader([header], delimiter=first))]
        out.append(_split_rows(spark.read.option("sep", first), files, first, columns))
    return out


def unreadable_files(spark: SparkSession, folder: str, pattern: str = "*.csv*") -> DataFrame:
    """``(source_file, error)`` of the files that can't be read to their end as UTF-8 text.

    Reads stop with an error at such files; this tells which they are, so that they can be left out knowingly.
    """

    def probe(batches):
        import codecs

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    store, name = fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", path))
                    decoder = codecs.getincrementaldecoder("utf-8")()
                    with store.open_input_stream(name) as stream:
                        while part := stream.read(1 << 20):
                            decoder.decode(part)
                    decoder.decode(b"", True)
                except (OSError, ValueError) as e:
                    found.append((path, f"{type(e).__name__}: {e}"))
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["source_file", "error"])

    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return listed.select("path").mapInArrow(probe, "source_file string, error string")


def write_stage(
    df: DataFrame, folder: str, name: str, stage: str, partition_by: Sequence[str] = (), kind: str = "parquet"
) -> str:
    """Overwrite ``<folder>/<name>_<stage>``; Parquet between stages, CSV for export."""
    path = f"{folder}/{name}_{stage}"
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)
    return path


def read_stage(spark: SparkSession, folder: str, name: str, stage: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}_{stage}")


def archive(df: DataFrame, folder: str, name: str, run_ts: str) -> str:
    """Keep this run's rows beside earlier ones, found by their ``run_ts``."""
    path = f"{folder}/{name}"
    df.withColumn("run_ts", F.lit(run_ts)).write.mode("append").partitionBy("run_ts").parquet(path)
    return path


def append_forecast_log(
    forecasts: DataFrame, folder: str, method: str, keys: Sequence[str], horizon: int, history: DataFrame
) -> None:
    """One record per series forecast."""
    forecast_records(forecasts, method, keys, horizon, history).write.mode("append").parquet(folder)


def forecast_records(forecasts: DataFrame, method: str, keys: Sequence[str], horizon: int, history: DataFrame) -> DataFrame:
    """Per series the horizon asked for, the rows known before, the rows forecast and the days they span."""
    name = F.concat_ws("_", *keys).alias("id")
    known = history.groupBy(name).agg(F.count(F.lit(1)).alias("n_input"))
    ahead = forecasts.groupBy(name).agg(
        F.count(F.lit(1)).alias("n_forecast"), F.datediff(F.max("ds"), F.min("ds")).alias("days")
    )
    return ahead.join(known, "id", "left").select(
        "id", F.lit(horizon).alias("horizon"), "n_input", "n_forecast", "days", F.lit(method).alias("method"),
        F.current_timestamp().alias("logged_at"),
    )


def _lanes(digest: Column) -> list[Column]:
    """Two 60-bit numbers of a digest."""
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint").alias(n) for at, n in ((1, "a"), (17, "b"))]


def _lane_sums() -> list[Column]:
    """Combined lanes: the same for the same rows in any order."""
    out = [F.count(F.lit(1)).alias("rows")]
    out += [F.coalesce(F.bit_xor(n), F.lit(0).cast("bigint")).alias(f"xor_{n}") for n in "ab"]
    out += [F.coalesce(F.sum(F.col(n).cast("decimal(20,0)")).cast("string"), F.lit("0")).alias(f"sum_{n}") for n in "ab"]
    return out


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that is the same for the same rows in any order and any column order."""
    cells = [F.coalesce(F.concat(F.lit("V"), F.col(f"`{c}`").cast("string")), F.lit("N")) for c in sorted(df.columns)]
    return df.select(*_lanes(F.md5(F.concat_ws("\x1f", *cells)))).agg(*_lane_sums())


def duplicate_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Groups of files with the same lines in the same order: checksum, how many, the first path, their lines.

    Only files of a size that occurs twice are read. Every block of a file is digested where it is read, line by
    line, and the digests of a file are put together in the order of its blocks. Readers pass over empty files.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    sizes = listed.select("path", F.col("length").alias("size"))
    twice = sizes.join(sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "size").select("path", "size")
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(folder).select(place.alias("p"), "value")

    def digest(batches):
        import hashlib

        import pyarrow as pa

        block, sha, n = None, None, 0
        schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("digest", pa.string()), ("lines", pa.int64())])

        def row():
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*block, sha.hexdigest(), n), schema.types)], schema=schema)

        for batch in batches:
            places, values = batch.column("p"), batch.column("value")
            for path, at, line in zip(places.field("path").to_pylist(), places.field("at").to_pylist(), values.to_pylist()):
                if (path, at) != block:
                    if block is not None:
                        yield row()
                    block, sha, n = (path, at), hashlib.sha256(), 0
                sha.update(line.encode() + b"\n")
                n += 1
        if block is not None:
            yield row()

    blocks = lines.mapInArrow(digest, "path string, at long, digest string, lines long")
    read = blocks.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("parts"), F.sum("lines").alias("lines"))
    body = F.concat_ws("-", F.col("size").cast("string"), F.concat_ws("-", F.coalesce(F.col("parts.digest"), F.array())))
    named = twice.join(read, "path", "left").select("path", F.sha2(body, 256).alias("checksum"), F.coalesce("lines", F.lit(0)).alias("lines"))
    found = named.groupBy("checksum", "lines").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first_file"))
    return found.where("files > 1")


def ingest_record(raw: DataFrame, conformed: DataFrame, source: str, mapping: dict[str, str]) -> DataFrame:
    """One row about an ingested table: where from, what it looked like, what became of it."""
    before, after = (
        fingerprint(d).select(F.concat_ws("-", "rows", "xor_a", "xor_b", "sum_a", "sum_b").alias(n))
        for d, n in ((raw, "checksum_raw"), (conformed, "checksum_conformed"))
    )
    return conformed.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(source).alias("source"),
        before.scalar().alias("checksum_raw"),
        after.scalar().alias("checksum_conformed"),
        "rows",
        F.array(*[F.lit(c) for c in raw.columns]).alias("columns_original"),
        F.lit(json.dumps(mapping, sort_keys=True)).alias("mapping_used"),
        F.current_timestamp().alias("ingested_at"),
        F.lit("success").alias("validation_status"),
    )
