"""Periodic runs of words: tiles per period octave, boundary Z-functions, fragments stitched by document and period.

A run is a stretch of words with smallest period q, repeated at least three times and ``LEAST`` words long, that neither
neighbour extends. In terms of equal words q apart it is an interval of at least 2 q places i with w[i] = w[i + q].

Periods go by octaves [u, 2u); an octave's boundaries stand s = max(u, 8) words apart, so that every interval above holds
at least two of them. The tile of a boundary b reaches from b - s to b + 2u + 2s. It can only matter if the s words at b
stand again q words later for some period q of the octave, which hashes of s words decide for all tiles of many documents
at once. Such tiles are solved by themselves: the Z-function of the words after b gives, for each q, how far words q apart
stay equal after b and whether the first q words are a power of a shorter block (then a smaller period owns the stretch);
the Z-function of the reversed words before b + q gives how far they are equal before b. Words are compared by exact
numbers, so hashes never decide what is equal.

Neighbouring tiles overlap, so the fragments of one run touch. They are merged within a task, then shuffled by text and
period and stitched. Texts of more than ``LONG`` bytes are first exploded into rows of overlapping tiles, dealt to all
tasks: one row for all small octaves of ``TILE`` words, and rows of 2u words and their surroundings for each larger octave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesline.llm.common import U64, mix, pieces, text_bytes, text_key, trimmed, without, words_of
from salesline.session import cut_lineage

LEAST, TIMES = 24, 3
FIRST = 8  # the first octave holds the periods below it
LONG, TILE = 1 << 16, 8192
CHUNK = 1 << 20  # compared places at a time
WORD = np.ones(256, bool)
WORD[[0x20, 9, 10, 11, 12, 13]] = False
FRAGMENT = pa.schema([("key", pa.binary()), ("period", pa.int32()), ("a", pa.int32()), ("b", pa.int32())])
TILES = pa.schema([("key", pa.binary()), ("part", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("base", pa.int32()),
                   ("first", pa.int32()), ("last", pa.int32()), ("words", pa.binary())])
RUNS = "array<struct<start: long, length: long, period: long>>"


def octaves(n: int, low: int = 1, high: int = 1 << 30) -> Iterator[tuple[int, int, int]]:
    """(u, 2u, s) of the octaves between two periods whose runs fit in ``n`` words; the first is (1, 8, 8)."""
    u, end = 1, FIRST
    while n >= max(LEAST, TIMES * u):
        if low <= u < high:
            yield u, end, max(u, FIRST)
        u, end = end, 2 * end


def word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of all rows, equal for equal words only, and the index of each row's first word."""
    starts, ends, first = words_of(data, offsets, WORD)
    if not len(starts):
        return np.zeros(0, np.int32), first
    at = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[WORD[data]])])
    return words.dictionary_encode().indices.to_numpy(), first


def z_function(x: list[int]) -> list[int]:
    """For each place, the length of the longest common prefix of ``x`` and its rest from there."""
    n, left, right = len(x), 0, 0
    z = [0] * n
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve_tile(words: np.ndarray, start: int, end: int, b: int, step: int, periods: list[int]) -> list[tuple[int, int, int]]:
    """(q, a, c) for those of the periods q for which the words a .. c - 1 equal those q later, around boundary b.

    ``words`` from ``start`` to ``end`` are known; the interval is cut ``step`` before b and 2 ``step`` after it, or later.
    """
    few, most = periods[0], periods[-1]
    after = z_function(words[b : min(end, b + most + 2 * step)].tolist())
    before = words[max(start, b - step) : b][::-1].tolist()
    back = z_function([*before, -1, *words[max(start, b + few - step) : b + most][::-1].tolist()])
    found, p = [], 1
    for q in periods:
        while p + after[p] < q:  # p becomes the smallest period of the first q words
            p += 1
        if (p == q or q % p) and after[q] >= step:
            found.append((q, b - back[len(before) + 1 + most - q], b + after[q]))
    return found


def fragments(words: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray, low: int = 1, high: int = 1 << 30):
    """Merged intervals (piece, period, a, b) of equal words of all octaves between ``low`` and ``high``.

    Piece i spans the words start[i] .. end[i] - 1, and its boundaries lie in first[i] .. last[i] - 1, from first[i] on.
    """
    found: list[tuple[int, int, int, int]] = []
    level, names = 1, mix(words.astype(U64) + U64(1))
    for u, stop, step in octaves(int((end - start).max(initial=0)), low, high):
        while level < step:  # the hash of twice as many words
            later = np.concatenate((names[level:], np.zeros(min(level, len(names)), U64)))
            names, level = names * (mix(np.full(1, level, U64)) | U64(1)) + later, 2 * level
        bounds = np.minimum(last, end - u - step + 1)
        count = np.maximum(0, -(-(bounds - first) // step))
        count[end - start < max(LEAST, TIMES * u)] = 0
        piece = np.repeat(np.arange(len(start)), count)
        if not len(piece):
            continue
        b = first[piece] + step * (np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count))
        width = stop - u
        shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate((names, np.zeros(stop, U64))), width)
        each = max(1, CHUNK // width)
        for c in range(0, len(b), each):
            at, mine = b[c : c + each], piece[c : c + each]
            i, j = np.nonzero(shifted[at + u] == names[at][:, None])
            fits = at[i] + j + u + step <= end[mine[i]]
            i, j = i[fits], j[fits]
            cuts = [*np.flatnonzero(np.diff(i, prepend=-1)).tolist(), len(i)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                t, n = int(at[i[lo]]), int(mine[i[lo]])
                periods = (j[lo:hi] + u).tolist()
                found += [(n, *f) for f in solve_tile(words, int(start[n]), int(end[n]), t, step, periods)]
    return merged(np.array(found, np.int64).reshape(-1, 4))


def merged(found: np.ndarray) -> np.ndarray:
    """Touching intervals (piece, period, a, b) of one piece and period made one."""
    if not len(found):
        return found
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    key = np.cumsum(np.concatenate(([0], np.any(np.diff(found[:, :2], axis=0) != 0, axis=1))))
    span = int(found[:, 3].max()) + 2
    reach = np.maximum.accumulate(found[:, 3] + key * span)
    new = np.concatenate(([True], found[1:, 2] + key[1:] * span > reach[:-1]))
    ends = np.concatenate((np.flatnonzero(new)[1:], [len(found)])) - 1
    out = found[new].copy()
    out[:, 3] = reach[ends] - key[new] * span
    return out


def _batch(keys: list[bytes], found: np.ndarray, shift: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([keys[i] for i in found[:, 0].tolist()], pa.binary()), pa.array(found[:, 1].astype(np.int32))]
    columns += [pa.array((found[:, c] + shift[found[:, 0]]).astype(np.int32)) for c in (2, 3)]
    return pa.RecordBatch.from_arrays(columns, schema=FRAGMENT)


def _solve_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of whole texts, whose tiles are cut and solved where the text is."""
    for whole in batches:
        for batch in pieces(whole):
            words, at = word_numbers(*text_bytes(batch.column("text")))
            found = fragments(words, at[:-1], at[1:], at[:-1], at[1:])
            if len(found):
                yield _batch(batch.column("key").to_pylist(), found, -at[:-1])


def tiles_of(n: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(low, high, base, end, first, last) of the tiles that together hold all octaves of a text of ``n`` words."""
    small = max(FIRST, TILE // 8)
    for u, _, step in octaves(n):
        if u == 1 or u > small:
            low, high, context, core = (1, small + 1, small, TILE) if u == 1 else (u, u + 1, step, 2 * u)
            for first in range(0, n, core):
                last = min(n, first + core)
                yield low, high, max(0, first - context), min(n, last + 4 * context), first, last


def _explode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping tiles of long texts, a row for each."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            words, _ = word_numbers(*text_bytes(row.column("text")))
            words, key = np.ascontiguousarray(words, np.int32), row.column("key")[0].as_py()
            for part, (low, high, base, end, first, last) in enumerate(tiles_of(len(words))):
                values = (key, part, low, high, base, first, last, words[base:end].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, TILES, strict=True)], schema=TILES)


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = np.frombuffer(row["words"], np.int32)
            base, one = row["base"], np.zeros(1, np.int64)
            found = fragments(words, one, one + len(words), one + row["first"] - base, one + row["last"] - base, row["low"], row["high"])
            if len(found):
                yield _batch([row["key"]], found, one + base)


def find_runs(texts: DataFrame) -> DataFrame:
    """key, runs: the runs of every text of ``texts`` (key binary, text string) that has any, by start, then period.

    Rows with one key have one text. The fragments of a text number fewer than its words.
    """
    schema = "key binary, period int, a int, b int"
    known = texts.where("key is not null and text is not null")
    short = known.where(F.octet_length("text") <= LONG).mapInArrow(trimmed(_solve_texts), schema)
    types = "key binary, part int, low int, high int, base int, first int, last int, words binary"
    tiles = known.where(F.octet_length("text") > LONG).mapInArrow(trimmed(_explode_texts), types)
    long = tiles.repartition("key", "part").mapInArrow(trimmed(_solve_tiles), schema)
    found = short.unionByName(long).dropDuplicates()
    order = Window.partitionBy("key", "period").orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.when(reach.isNull() | (F.col("a") > reach), 1).otherwise(0))
    numbered = marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("key", "period", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    length = F.col("b") - F.col("a") + F.col("period")
    runs = whole.where(length >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    run = F.struct(*[c.cast("long").alias(n) for n, c in (("start", F.col("a")), ("period", F.col("period")), ("length", length))])
    by_key = runs.groupBy("key").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    return by_key.select("key", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])).cast(RUNS).alias("runs"))


def collapse_runs(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the word runs of their text, and the text without the repetitions.

    Added are ``runs`` (array of start, length, period in words, by start, then period; empty for none) and ``collapsed``,
    all words joined by one space but for those that a run holds after its first period. Null texts have no runs and an
    empty collapsed text, as have texts without words. Rows are kept one by one, also repeated ones and those without an
    id; texts of any length are taken whole; an empty table gives none. Columns of the added names are replaced.
    """
    documents = without(documents, ["runs", "collapsed", "_key"])
    column = F.col(f"`{text}`")
    keyed = documents.withColumn("_key", F.unhex(F.sha2(F.encode(column, "UTF-8"), 256)))
    runs = cut_lineage(find_runs(keyed.select(F.col("_key").alias("key"), column.alias("text"))))
    joined = keyed.join(runs.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")
    joined = joined.withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, found in zip(batch.column(text).to_pylist(), batch.column("runs").to_pylist(), strict=True):
                words = (t or "").encode().split()  # on the white space of ASCII
                if found:
                    kept = np.ones(len(words), bool)
                    for r in found:
                        kept[r["start"] + r["period"] : r["start"] + r["length"]] = False
                    words = [words[i] for i in np.flatnonzero(kept).tolist()]
                out.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "collapsed"])

    return joined.mapInArrow(trimmed(work), T.StructType([*joined.schema.fields, T.StructField("collapsed", T.StringType())]))


def digest(found: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The number of runs of every document, its run of greatest exponent, and digests of its runs and collapsed text."""
    rank = F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("n")))
    best = F.when(F.size("runs") > 0, F.array_max(rank))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n")))
    start, length, period = -best["s"], best["n"], -best["p"]
    return found.select(
        F.col(doc).alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents of which about a tenth, chosen by id, end in a repeated passage from some word on."""
    h, words = text_key(doc), F.col("_words")
    g, n = F.floor(h / 10).cast("long"), F.size("_words")
    a = F.when(n > 0, g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    chosen = F.when(h % 10 == 0, F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != ""))
    return documents.withColumn("_words", chosen).withColumn(text, F.when(n > 0, planted).otherwise(F.col(text))).drop("_words")
