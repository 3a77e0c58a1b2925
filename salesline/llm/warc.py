"""WARC archives of pages and a two-level capture index.

Archives are written by Spark as plain WARC/1.1 records. The index holds one line per record, sorted by the
URL with its host reversed, cut into compressed blocks; a sparse directory keeps the first and last key of
each block. A lookup searches the directory, unpacks the one or few blocks that may hold a key, searches
their lines, and then reads only the byte range of each record it found.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesline.llm.common import bitmap, pieces
from salesline.session import checkpoint_dir, cut_lineage

LEAST_REVISIT = 100
LINES = 1000
DIRECTORY_ROWS = 500_000
RECORDS_PER_FILE = 5000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def reversed_host_key(url: str | None) -> str:
    """``http://a.b.com:81/x?y`` becomes ``com,b,a:81)/x?y``; what is no URL is its own key, null is empty."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        return url
    if not host:
        return url
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail


def with_types(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html (no null), digest, record_type and refers_to of every page.

    Of pages with equal payloads of at least ``least`` bytes those with the smallest page_id are responses,
    the others revisit it. A page without an id can be a response only if no copy has an id.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    long_rows = rows.where(F.octet_length("html") >= least).select("page_id", "url", F.sha2(F.col("html").cast("binary"), 256).alias("digest"))
    ids = long_rows.groupBy("digest", "page_id").agg(F.min("url").alias("url"), F.count(F.lit(1)).alias("n"))
    first = ids.groupBy("digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("at"), F.sum("n").alias("n"))
    first = cut_lineage(first.where("n > 1 and at is not null").select("digest", F.col("at.page_id").alias("_first"), F.col("at.url").alias("_url")))
    key = F.conv(F.substring("digest", 1, 6), 16, 10).cast("long")
    marked = _with_digest(rows, bitmap(first.select(key.alias("k")), "k"))
    names = ["page_id", "url", "html", "digest"]
    copies = marked.where("maybe_copied").select(*names).join(first, "digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")) & (F.octet_length("html") >= least)
    copies = copies.select(
        *names,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
        F.when(revisit, F.col("_url")).alias("refers_url"),
    )
    alone = marked.where("not maybe_copied").select(
        *names, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url")
    )
    return alone.unionByName(copies)


def _with_digest(rows: DataFrame, copied: np.ndarray) -> DataFrame:
    """Add the payload's digest and whether a bitmap of copied digests has it: the others need no join."""
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(copied))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value).astype(bool)
        for whole in batches:
            for batch in pieces(whole, "html"):
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in batch.column("html").to_pylist()]
                maybe = known[[int(d[:6], 16) for d in digests]]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests), pa.array(maybe)], [*batch.schema.names, "digest", "maybe_copied"])

    return rows.mapInArrow(work, "page_id long, url string, html string, digest string, maybe_copied boolean")


def _header(name: str, value) -> F.Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]", " "), F.lit(EOL))).otherwise("")


def write_archives(typed: DataFrame, path: str) -> None:
    """One record per row of ``with_types``, in files of bounded numbers of records. A revisit has no payload."""
    is_response = F.col("record_type") == "response"
    payload = F.when(is_response, F.col("html")).otherwise("")
    page = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit(f"WARC/1.1{EOL}WARC-Type: "),
        F.col("record_type"),
        F.lit(EOL),
        _header("WARC-Record-ID", page(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}{EOL}"),
        _header("WARC-Target-URI", F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(EOL)),
        _header("WARC-Refers-To", page(F.col("refers_to"))),
        _header("WARC-Refers-To-Target-URI", F.col("refers_url")),
        F.when(is_response, "").otherwise(f"WARC-Profile: {PROFILE}{EOL}"),
        F.lit(f"Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(EOL + EOL),
        payload,
        F.lit(EOL),
    )
    typed.select(record.alias("value")).write.option("lineSep", EOL).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and payload of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(EOL)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}: {lines[0][:80]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} does not end with its payload")
        yield at, stop + 4 - at, headers, data[start:stop]
        at = stop + 4


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


RECORD = "page_id long, url string, surt string, file string, offset long, length long, record_type string, refers_to long, refers_surt string, payload_bytes long, payload_digest string, stated_digest string"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record found in the archives of a folder, without payloads; see ``RECORD``."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int64() if x.split()[1] == "long" else pa.string() for x in RECORD.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows = []
                for offset, length, h, payload in parse_records(content.as_py()):
                    url = h.get("WARC-Target-URI")
                    rows.append((
                        _page(h.get("WARC-Record-ID")), url, reversed_host_key(url), file.as_py(), offset, length, h["WARC-Type"],
                        _page(h.get("WARC-Refers-To")), reversed_host_key(h.get("WARC-Refers-To-Target-URI")), len(payload),
                        hashlib.sha256(payload).hexdigest(), h["WARC-Payload-Digest"].removeprefix("sha256:"),
                    ))
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(work, RECORD)


def build_index(records: DataFrame, path: str, lines: int = LINES) -> None:
    """Sort the records by key and store them as compressed blocks of ``lines`` lines.

    Ties are ordered by page and place, so that one key may fill any number of blocks.
    """
    order = ["surt", "page_id", "file", "offset"]
    rows = records.select(*order, "length").repartitionByRange(*order).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[list] = []

        def packed():
            text = "\n".join(json.dumps(x) for x in block).encode()
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([block[0][0]]), pa.array([block[-1][0]]), pa.array([len(block)], pa.int64()), pa.array([zlib.compress(text)], pa.binary())],
                ["block", "first_key", "last_key", "n", "data"],
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*order, "length")), strict=True):
                block.append(list(row))
                if len(block) == lines:
                    yield packed()
                    block.clear()
        if block:
            yield packed()

    rows.mapInArrow(work, "block string, first_key string, last_key string, n long, data binary").write.parquet(path)


def _key(x: str) -> bytes:
    return x.encode()  # Spark orders strings by their bytes


def lookup(spark: SparkSession, index: str, wanted: DataFrame, directory_rows: int = DIRECTORY_ROWS) -> DataFrame:
    """The index lines of the keys in the column ``surt`` of ``wanted``: surt, page_id, file, offset, length.

    The directory, one row per block, is taken in sorted parts of at most ``directory_rows`` rows, which every
    task can hold. Keys that the index does not have give no row.
    """
    blocks = spark.read.parquet(index)
    directory = blocks.select("block", "first_key", "last_key").orderBy("first_key", "last_key", "block")
    keys = wanted.select("surt").distinct()
    found = None
    part: list = []

    def search(rows: list) -> DataFrame:
        firsts, lasts, names = ([r[i] for r in rows] for i in ("first_key", "last_key", "block"))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = [_key(x) for x in firsts], [_key(x) for x in lasts]
            for batch in batches:
                out = []
                for key in batch.column("surt").to_pylist():
                    k = _key(key)
                    for i in range(bisect.bisect_left(high, k), bisect.bisect_right(low, k)):
                        out.append((names[i], key))
                columns = list(zip(*out, strict=True)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string())], ["block", "surt"])

        return keys.mapInArrow(work, "block string, surt string")

    for row in directory.toLocalIterator():
        part.append(row)
        if len(part) == directory_rows:
            found = search(part) if found is None else found.unionByName(search(part))
            part = []
    if part:
        found = search(part) if found is None else found.unionByName(search(part))
    if found is None:
        return spark.createDataFrame([], "surt string, page_id long, file string, offset long, length long")
    asked = found.groupBy("block").agg(F.collect_set("surt").alias("keys"))  # the keys of one block: it bounds them
    hits = asked.join(blocks.select("block", "data"), "block")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wanted_keys, data in zip(batch.column("keys").to_pylist(), batch.column("data").to_pylist(), strict=True):
                rows = [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]
                order = [_key(r[0]) for r in rows]
                out = []
                for key in wanted_keys:
                    k = _key(key)
                    out += rows[bisect.bisect_left(order, k) : bisect.bisect_right(order, k)]
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["surt", "page_id", "file", "offset", "length"])

    return hits.select("keys", "data").mapInArrow(unpack, "surt string, page_id long, file string, offset long, length long")


def range_read(places: DataFrame) -> DataFrame:
    """Read the records at (file, offset, length) and give page_id, record_type, payload_bytes, payload_digest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for file, offset, length in sorted(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)):
                store, path = fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", file))
                with store.open_input_file(path) as f:
                    f.seek(offset)
                    _, _, h, payload = next(parse_records(f.read(length)))
                rows.append((_page(h.get("WARC-Record-ID")), h["WARC-Type"], len(payload), hashlib.sha256(payload).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "record_type", "payload_bytes", "payload_digest"])

    return places.mapInArrow(work, "page_id long, record_type string, payload_bytes long, payload_digest string")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives with an index, and describe every record from them.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to. The payload of a revisit is that of
    the record it refers to, found through the index and read by its byte range. Null html is an empty payload;
    equal rows are written as often as they occur; other columns are ignored; no pages give no rows.
    """
    spark = pages.sparkSession
    base = f"{checkpoint_dir(spark)}/warc/{uuid.uuid4().hex}"
    write_archives(with_types(pages), f"{base}/archives")
    records = cut_lineage(read_archives(spark, f"{base}/archives"))
    build_index(records, f"{base}/index")
    revisits = records.where("record_type = 'revisit'")
    targets = cut_lineage(revisits.groupBy(F.col("refers_to").alias("page_id")).agg(F.min("refers_surt").alias("surt")))
    places = lookup(spark, f"{base}/index", targets).join(targets, ["surt", "page_id"], "left_semi")
    fetched = range_read(places.select("file", "offset", "length")).where("record_type = 'response'")
    fetched = fetched.groupBy(F.col("page_id").alias("refers_to")).agg(F.min(F.struct("payload_bytes", "payload_digest")).alias("_full"))
    whole = revisits.join(fetched, "refers_to", "left").select(
        "page_id", F.col("_full.payload_bytes").alias("payload_bytes"), F.col("_full.payload_digest").alias("payload_digest"), "record_type", "refers_to"
    )
    responses = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return responses.unionByName(whole)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY html)
SELECT page_id, n::bigint AS payload_bytes, sha256(p.html) AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""
