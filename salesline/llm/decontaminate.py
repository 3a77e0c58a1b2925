"""Find and remove benchmark passages in documents.

The normalised word windows of the test items form a hash set that every task holds. The set is sent in
blocks of bounded size (``ITEM_BYTES`` of item text each), so a benchmark of any size takes several passes
instead of one large broadcast. A task hashes every word window of its documents with one array pass, looks
the hashes up, and compares the words of each hit with the item before it counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesline.llm.common import Powers, lower_table, mix, pieces, runs_of, span_hashes, text_bytes, trimmed, without, words_of

WINDOW = 10
ITEM_BYTES = 8 << 20
BITS = 20


def word_bytes() -> np.ndarray:
    """The bytes of words after lower-casing: digits, a-z, and every byte of a character beyond ASCII."""
    letter = np.zeros(256, bool)
    letter[0x30:0x3A] = letter[0x61:0x7B] = letter[0x80:] = True
    return letter


def split_words(text: str | None) -> list[bytes]:
    """The normalised words of one text."""
    data = lower_table()[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = words_of(data, np.array([0, len(data)]), word_bytes())
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k]
    return mix(out)


@dataclass
class Windows:
    """The windows of one length: sorted hashes, and what each hash stands for."""

    length: int
    hashes: np.ndarray
    meaning: dict[int, list[tuple[tuple[bytes, ...], list[str]]]]

    def bitmap(self) -> np.ndarray:
        """Which values the top bits of the hashes take."""
        out = np.zeros(1 << BITS, bool)
        out[self.hashes >> np.uint64(64 - BITS)] = True
        return out


def build_windows(items: list[tuple[str, str]], window: int) -> list[Windows]:
    """Group the windows of items by length. An item with fewer words than ``window`` is one window."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        words = split_words(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            by_length.setdefault(n, {}).setdefault(tuple(words[i : i + n]), set()).add(item)
    out = []
    powers = Powers(BASE)
    for n, found in sorted(by_length.items()):
        meaning: dict[int, list] = {}
        for key, ids in found.items():
            data = np.frombuffer(b" ".join(key), np.uint8)
            ends = np.cumsum([len(w) + 1 for w in key]) - 1
            starts = ends - np.array([len(w) for w in key])
            h = int(window_hashes(span_hashes(data, starts, ends, powers), n)[0])
            meaning.setdefault(h, []).append((key, sorted(ids)))
        hashes = np.array(sorted(meaning), np.uint64)
        out.append(Windows(n, hashes, meaning))
    return out


BASE = 0x5851F42D4C957F2D


def scan(data: np.ndarray, offsets: np.ndarray, groups: list[tuple[Windows, np.ndarray]], powers: Powers):
    """Words of every row and, for rows with verified hits, the hit words and the items.

    Returns starts, ends, first-word indexes, and {row: (hit flags of its words, items)}.
    """
    starts, ends, first = words_of(data, offsets, word_bytes())
    hits: dict[int, tuple[np.ndarray, set[str]]] = {}
    if not len(starts):
        return starts, ends, first, hits
    words = span_hashes(data, starts, ends, powers)
    raw = data.tobytes()
    for g, bitmap in groups:
        h = window_hashes(words, g.length)
        maybe = np.flatnonzero(bitmap[h >> np.uint64(64 - BITS)])
        if not len(maybe):
            continue
        at = np.minimum(np.searchsorted(g.hashes, h[maybe]), len(g.hashes) - 1)
        maybe = maybe[g.hashes[at] == h[maybe]]
        rows = np.searchsorted(first, maybe, side="right") - 1
        for i, row in zip(maybe.tolist(), rows.tolist(), strict=True):
            if i + g.length > first[row + 1]:
                continue  # it would cross the end of the document
            key = tuple(raw[starts[k] : ends[k]] for k in range(i, i + g.length))
            for words_there, items in g.meaning[int(h[i])]:
                if key == words_there:
                    flags, found = hits.setdefault(row, (np.zeros(first[row + 1] - first[row], bool), set()))
                    flags[i - first[row] : i - first[row] + g.length] = True
                    found.update(items)
    return starts, ends, first, hits


PAIRS = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", PAIRS),
        T.StructField("spans", PAIRS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _scan_block(df: DataFrame, text: str, groups: list[Windows], column: str) -> DataFrame:
    """Add a struct column: n_words, runs (start, end word pairs), spans (the same in bytes), items."""
    schema = T.StructType([*df.schema.fields, T.StructField(column, HITS)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, lower, known = Powers(BASE), lower_table(), [(g, g.bitmap()) for g in groups]
        pairs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        kind = pa.struct([("n_words", pa.int64()), ("runs", pairs), ("spans", pairs), ("items", pa.list_(pa.string()))])
        for whole in batches:
            for batch in pieces(whole, text):
                data, offsets = text_bytes(batch.column(text))
                starts, ends, first, hits = scan(lower[data], offsets, known, powers)
                out = []
                for row in range(batch.num_rows):
                    runs: list[dict] = []
                    spans: list[dict] = []
                    items: list[str] = []
                    if row in hits:
                        flags, found = hits[row]
                        for a, b in zip(*map(np.ndarray.tolist, runs_of(flags)), strict=True):
                            runs.append({"a": a, "b": b})
                            where = starts[first[row] + a] - offsets[row], ends[first[row] + b - 1] - offsets[row]
                            spans.append({"a": int(where[0]), "b": int(where[1])})
                        items = sorted(found)
                    out.append({"n_words": int(first[row + 1] - first[row]), "runs": runs, "spans": spans, "items": items})
                columns = [*batch.columns, pa.array(out, kind)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, column])

    return df.mapInArrow(trimmed(work), schema)


def item_blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about ``limit`` bytes of text; the driver holds one partition at a time."""
    block: list[tuple[str, str]] = []
    size = 0
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null and i is not null")
    for row in rows.toLocalIterator():
        block.append((row.i, row.t))
        size += len(row.t.encode())
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """``documents`` with one more column ``hits`` (see ``HITS``): verified occurrences of item windows.

    A null text has no words; a null or wordless item has no windows; repeated items and rows are all
    reported. Items with equal windows are all named. An empty benchmark hits nothing. A column ``hits`` is replaced.
    """
    documents = without(documents, ["hits"])
    names = [f"`{c}`" for c in documents.columns]
    out, column = documents, "_hits0"
    blocks = 0
    for block in item_blocks(benchmark, item, item_text, item_bytes):
        column = f"_hits{blocks}"
        out = _scan_block(out, text, build_windows(block, window), column)
        blocks += 1
    if not blocks:
        out, blocks = _scan_block(out, text, [], column), 1
    found = [F.col(f"_hits{i}") for i in range(blocks)]
    if blocks == 1:
        return out.select(*names, found[0].alias("hits"))
    return out.select(
        *names,
        F.struct(
            found[0]["n_words"].alias("n_words"),
            merged_runs(F.flatten(F.array(*[f["runs"] for f in found]))).alias("runs"),
            merged_runs(F.flatten(F.array(*[f["spans"] for f in found]))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.array(*[f["items"] for f in found])))).alias("items"),
        ).alias("hits"),
    )


def merged_runs(pairs):
    """Unite (a, b) pairs that overlap or touch."""
    empty = F.array().cast(PAIRS)

    def add(done, p):
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["a"].alias("a"), F.greatest(last["b"], p["b"]).alias("b"))
        joined = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))
        return F.when((F.size(done) > 0) & (last["b"] >= p["a"]), joined).otherwise(F.concat(done, F.array(p)))

    return F.aggregate(F.array_sort(pairs), empty, add)


def remove_spans(documents: DataFrame, text: str = "text", hits: str = "hits") -> DataFrame:
    """Cut the hit spans out of the texts; a null text stays null.

    Store ``documents`` before: else every task has a Python worker for the search and one for the cuts at once.
    """
    schema = documents.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, text)):
            found = batch.column(hits).to_pylist()
            if not any(h and h["spans"] for h in found):
                yield batch
                continue
            out = []
            for t, h in zip(batch.column(text).to_pylist(), found, strict=True):
                if t is not None and h and h["spans"]:
                    raw, last, kept = t.encode(), 0, []
                    for span in h["spans"]:
                        kept.append(raw[last : span["a"]])
                        last = span["b"]
                    t = b"".join([*kept, raw[last:]]).decode()
                out.append(t)
            i = batch.schema.get_field_index(text)
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))

    return documents.mapInArrow(trimmed(work), schema)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of the documents with hits."""
    hits = F.col("hits")
    n_hit = F.aggregate(hits["runs"], F.lit(0).cast("long"), lambda n, p: n + p["b"] - p["a"])
    return found.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), items AS (
  SELECT item_id::varchar AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), wins AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM wins),
places AS (
  SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM docs, lengths, unnest(range(1, len(w) - n + 2)) t(i)
), hits AS (SELECT rid, p.n, i, item FROM places p JOIN wins ON p.n = wins.n AND p.win = wins.win),
words AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)
"""
