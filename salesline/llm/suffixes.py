"""Removal of long byte strings that also start earlier in the corpus.

Every string of ``LENGTH`` bytes has an anchor: its leftmost K-byte gram of smallest hash. Strings that start next to
each other and share the anchor share one context, the bytes they cover together; equal strings have equal grams as
anchors, wherever they stand. So a text becomes a short sequence of contexts.

1. Each task sorts the suffixes of its context sequences with the linear grouping construction: suffixes are grouped
   by their Lyndon prefixes in descending order with previous-smaller pointers, and each group's order then follows
   from suffixes already placed, without renaming. Equal contexts stand together in this order; all but the first of
   them are repeats. One of each is sent on by its anchor's hash, and what is not the first of all tasks repeats, too.
2. Where contexts with the same anchor differ, a repeat may begin or end inside of them. Only these contexts are sent
   with their bytes, and their strings are compared one by one. Anchors with very many different contexts send
   string hashes instead, dealt out by themselves.
3. The repeated stretches are joined to their texts and cut out.

Nothing is sampled or capped, and strings are judged on the input. Contexts and strings are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesline.llm.common import U64, Powers, bit_table, bit_test, bitmap, mix, pieces, text_bytes, without, trimmed
from salesline.session import cut_lineage

LENGTH, GRAM = 100, 24
HOT = 4096
CHUNK = 1 << 19
FLUSH = 120_000
BITS = 27
BASE = 0x3C79AC492BA7B653


def suffix_order(symbols: list[int]) -> list[int]:
    """The start positions of the suffixes of a sequence of numbers from 0 on, in ascending order.

    0 ends a text, also the last one; zeros are ordered by position and never looked past. Groups of suffixes that
    share a Lyndon prefix are taken from the largest down. The nearest smaller position before a member, found along
    pointers that skip what is done, has its Lyndon prefix extended by the member's; those extended by equally many
    members make a new group just above their old one. At the end the suffix that follows a member's Lyndon prefix
    is smaller than the member, so groups taken upwards order their members by places already given.
    """
    n, top = len(symbols), max(symbols, default=0)
    members: list[set[int]] = [set() for _ in range(top + 1)]
    for i, s in enumerate(symbols):
        members[s].add(i)
    below, above = list(range(-1, top)), list(range(1, top + 2))
    above[top] = -1
    size = [1] * (top + 1)  # length of the group's Lyndon prefix
    group_of, before, done = list(symbols), list(range(-1, n - 1)), bytearray(n)
    g = top
    while g > 0:
        for i in members[g]:
            done[i] = 1
        children: dict[int, int] = {}
        for i in members[g]:
            j = before[i]
            while j >= 0 and done[j]:
                j = before[j]
            before[i] = j
            if j >= 0 and symbols[j]:
                children[j] = children.get(j, 0) + 1
        split: dict[tuple[int, int], list[int]] = {}
        for j, k in children.items():
            split.setdefault((group_of[j], -k), []).append(j)
        for old, k in sorted(split):  # more repeats of the prefix are larger, so they are put above first
            moved, new, up = split[old, k], len(members), above[old]
            members[old].difference_update(moved)
            members.append(set(moved))
            size.append(size[old] - k * size[g])
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
            for j in moved:
                group_of[j] = new
        g = below[g]
    place, out = [0] * (n + 1), []
    while g >= 0:
        own = members[g]
        if own:
            length = size[g]
            if g == 0:
                row = sorted(own)
            else:  # first those followed by a smaller group, then those followed by the former, and so on
                row = [i for i in own if i + length not in own]
                row.sort(key=lambda i: place[i + length])
            while row:
                for i in row:
                    place[i] = len(out)
                    out.append(i)
                row = [i - length for i in row if i - length in own] if g else []
        g = above[g]
    return out


def chunks(batch: pa.RecordBatch, doc: str, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of texts: bytes, offsets of the pieces, their documents, and where each starts in its text.

    Texts longer than ``CHUNK`` are cut with an overlap of ``LENGTH - 1`` bytes, so every string lies in one piece.
    """
    for part in pieces(batch, text, CHUNK):
        data, offsets = text_bytes(part.column(text))
        docs = part.column(doc).to_numpy(zero_copy_only=False).astype(np.int64)
        if part.num_rows > 1 or len(data) <= 2 * CHUNK:
            yield data, offsets, docs, np.zeros(part.num_rows, np.int64)
            continue
        for a in range(0, len(data) - LENGTH + 1, CHUNK):
            piece = data[a : a + CHUNK + LENGTH - 1]
            yield piece, np.array([0, len(piece)]), docs, np.array([a])


class Cutter:
    """Cuts pieces into contexts."""

    def __init__(self):
        self.powers = Powers(BASE)

    def sums(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = self.powers.get(len(data) + 1)
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
        return sums, down

    def strings(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The hashes of the strings of ``LENGTH`` bytes at ``starts``."""
        sums, down = self.sums(data)
        return mix((sums[starts + LENGTH] - sums[starts]) * down[starts])

    def contexts(self, data: np.ndarray, offsets: np.ndarray):
        """Anchor hash (spread anew, as least hashes are small), context hash, piece, first and last string start of
        every context, in text order."""
        none = np.zeros(0, np.int64)
        if len(data) < LENGTH:
            return none.astype(U64), none.astype(U64), none, none, none
        sums, down = self.sums(data)
        n, span = len(data) - GRAM + 1, LENGTH - GRAM + 1
        low = mix((sums[GRAM:] - sums[:n]) * down[:n])
        at, width = np.arange(n, dtype=np.int32), 1
        while width * 2 <= span:  # the leftmost least gram of every ``width`` neighbours
            right = low[width:] < low[:-width]
            low, at = np.where(right, low[width:], low[:-width]), np.where(right, at[width:], at[:-width])
            width *= 2
        if width < span:
            d = span - width
            right = low[d:] < low[:-d]
            low, at = np.where(right, low[d:], low[:-d]), np.where(right, at[d:], at[:-d])
        size = np.diff(offsets)
        piece = np.repeat(np.arange(len(size)), np.maximum(0, size - LENGTH + 1))
        rank = np.arange(len(piece)) - np.repeat(np.cumsum(np.maximum(0, size - LENGTH + 1)) - np.maximum(0, size - LENGTH + 1), np.maximum(0, size - LENGTH + 1))
        start = offsets[piece] + rank  # all strings that lie within a piece
        if not len(start):
            return none.astype(U64), none.astype(U64), none, none, none
        anchor = at[start]
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        lo, hi = start[first], start[last]
        context = mix((sums[hi + LENGTH] - sums[lo]) * down[lo] + (hi - lo).astype(U64) * U64(0x9E3779B97F4A7C15) + (anchor[first] - lo).astype(U64))
        return mix(low[start[first]] + U64(1)), context, piece[first], lo, hi


def later_copies(keys: tuple[np.ndarray, ...], doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of keys, document and place, and for each whether the row before has the same keys."""
    order = np.lexsort((at, doc, *reversed(keys)))
    same = np.ones(max(0, len(order) - 1), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    return order, np.concatenate((np.zeros(min(1, len(order)), bool), same))


def joined_stretches(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite the stretches [a, b) of each document that overlap or touch."""
    if not len(doc):
        return doc, a, b
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    fresh = np.concatenate(([True], doc[1:] != doc[:-1]))
    number = np.cumsum(fresh) - 1
    shift = number * (int(b.max()) + 2)  # documents one after the other, so that one running maximum serves
    reach = np.maximum.accumulate(b + shift)
    new = np.concatenate(([True], (a + shift)[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], a[first], reach[last] - shift[first]


FOUND = "kind int, doc long, a long, b long"
STRETCH, MIXED, CROWDED = 0, 1, 2


def _found(kind: int, doc, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), kind, np.int32)), pa.array(doc), pa.array(a), pa.array(b)], ["kind", "doc", "a", "b"])


def _send(key: np.ndarray, parts: int, columns: list[np.ndarray], kind: int) -> pa.RecordBatch:
    """Rows packed by the range of their key: one row per part with every column as bytes."""
    part = (((key >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(parts + 1))
    at = np.flatnonzero(np.diff(edge))
    cut = [order[edge[p] : edge[p + 1]] for p in at]
    packed = [pa.array([c[x].tobytes() for x in cut], pa.binary()) for c in columns]
    names = ["part", "kind", *(f"c{i}" for i in range(len(columns)))]
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), kind, np.int64)), *packed], names)


def repeated_contexts(rows: DataFrame, parts: int) -> DataFrame:
    """Step 1 (``FOUND``): stretches whose whole context stands earlier, and anchors that have several contexts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held, size = Cutter(), [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            anchor, context, doc, lo, hi, text = (np.concatenate(x) for x in zip(*held, strict=True))
            # the contexts of every text as numbers; those met once, like the end of a text, close a run with a zero
            _, number, count = np.unique(context, return_inverse=True, return_counts=True)
            again_here = count > 1
            number = np.where(again_here[number], np.cumsum(again_here)[number], 0)
            close = np.flatnonzero(np.concatenate((text[1:] != text[:-1], [True]))) + 1
            owner = np.insert(np.arange(len(number)), close, -1)
            row = owner[suffix_order(np.insert(number, close, 0).tolist())]
            row = row[(row >= 0) & (number[row] > 0)]
            group = np.concatenate((np.zeros(min(1, len(row)), np.int64), np.cumsum(number[row][1:] != number[row][:-1])))  # equal ones are neighbours
            by_place = np.lexsort((lo[row], doc[row], group))
            row, group = row[by_place], group[by_place]
            again = np.concatenate((np.zeros(min(1, len(row)), bool), group[1:] == group[:-1]))
            d, a, b = joined_stretches(doc[row[again]], lo[row[again]], hi[row[again]] + LENGTH)
            place = np.zeros(len(d), np.int64)
            if len(d):  # known here already: passed through, dealt out by document
                yield _send(mix(d.view(U64)), parts, [d, a, b, place, place], STRETCH)
            one = np.concatenate((np.flatnonzero(number == 0), row[~again]))
            yield _send(anchor[one], parts, [anchor[one], context[one], doc[one], lo[one], hi[one]], MIXED)

        seen = 0
        for batch in batches:
            for data, offsets, docs, shift in chunks(batch, "doc", "text"):
                anchor, context, piece, lo, hi = cutter.contexts(data, offsets)
                base = offsets[piece] - shift[piece]
                held.append((anchor, context, docs[piece], lo - base, hi - base, piece + seen))
                seen += len(docs)
                size += len(anchor)
                if size >= FLUSH:
                    yield from sent()
                    held, size = [], 0
        if size:
            yield from sent()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, kind, *raw in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                columns = [np.frombuffer(x, np.int64) for x in raw]
                if kind == STRETCH:
                    yield _found(STRETCH, *columns[:3])
                else:
                    held.setdefault(part, []).append(columns)
        for part in held.values():
            anchor, context, doc, lo, hi = (np.concatenate(x) for x in zip(*part, strict=True))
            order, again = later_copies((anchor.view(U64), context.view(U64)), doc, lo)
            r = order[again]
            yield _found(STRETCH, *joined_stretches(doc[r], lo[r], hi[r] + LENGTH))
            kept = anchor[order[~again]]  # sorted, once for every different context
            value, n = np.unique(kept, return_counts=True)
            for kind, rows in ((MIXED, value[n > 1]), (CROWDED, value[n > HOT])):
                yield _found(kind, rows, np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64))

    packed = rows.mapInArrow(trimmed(split), "part long, kind long, " + ", ".join(f"c{i} binary" for i in range(5)))
    return packed.repartition(parts, "part").mapInArrow(trimmed(merge), FOUND)


def repeated_strings(rows: DataFrame, parts: int, mixed: np.ndarray, crowded: np.ndarray) -> DataFrame:
    """Step 2 (doc, a, b): stretches of strings that stand earlier, in contexts of the anchors given by bit tables."""
    shared = rows.sparkSession.sparkContext.broadcast((mixed, crowded))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several, many = shared.value
        cutter, seen = Cutter(), set()
        for batch in batches:
            for data, offsets, docs, shift in chunks(batch, "doc", "text"):
                anchor, context, piece, lo, hi = cutter.contexts(data, offsets)
                key = anchor & U64((1 << BITS) - 1)
                at = np.flatnonzero(bit_test(several, key))
                crowd = bit_test(many, key[at])
                base = offsets[piece] - shift[piece]
                r = at[crowd]
                if len(r):
                    count = hi[r] - lo[r] + 1
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    start = np.repeat(lo[r], count) + step
                    h = cutter.strings(data, start)
                    yield _send(h, parts, [h, np.repeat(docs[piece[r]], count), start - np.repeat(base[r], count), h], CROWDED)
                r = at[~crowd]
                if len(r):
                    part = (((anchor[r] >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)
                    order = np.argsort(part, kind="stable")
                    r, part = r[order], part[order]
                    edge = np.searchsorted(part, np.arange(parts + 1))
                    used = np.flatnonzero(np.diff(edge))
                    out = [[], [], [], []]
                    for p in used:
                        x = r[edge[p] : edge[p + 1]]
                        out[0].append((hi[x] - lo[x] + LENGTH).tobytes())
                        out[1].append(docs[piece[x]].tobytes())
                        out[2].append((lo[x] - base[x]).tobytes())
                        out[3].append(b"".join([data[a : b + LENGTH].tobytes() for a, b in zip(lo[x].tolist(), hi[x].tolist(), strict=True)]))
                    names = ["part", "kind", "c0", "c1", "c2", "c3"]
                    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.full(len(used), MIXED)), *(pa.array(c, pa.binary()) for c in out)], names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held = Cutter(), {}
        for batch in batches:
            for part, kind, c0, c1, c2, c3 in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                doc, at = np.frombuffer(c1, np.int64), np.frombuffer(c2, np.int64)
                if kind == MIXED:
                    length, data = np.frombuffer(c0, np.int64), np.frombuffer(c3, np.uint8)
                    count = length - LENGTH + 1
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    h = cutter.strings(data, np.repeat(np.cumsum(length) - length, count) + step)
                    doc, at = np.repeat(doc, count), np.repeat(at, count) + step
                else:
                    h = np.frombuffer(c0, U64)
                held.setdefault(part, []).append((h, doc, at))
        for rows in held.values():
            h, doc, at = (np.concatenate(x) for x in zip(*rows, strict=True))
            order, again = later_copies((h,), doc, at)
            r = order[again]
            d, a, b = joined_stretches(doc[r], at[r], at[r] + LENGTH)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(b)], ["doc", "a", "b"])

    packed = rows.mapInArrow(trimmed(split), "part long, kind long, c0 binary, c1 binary, c2 binary, c3 binary")
    return packed.repartition(parts, "part").mapInArrow(trimmed(compare), "doc long, a long, b long")


def numbered(documents: DataFrame, doc: str, text: str) -> DataFrame:
    """All rows with a unique whole number ``_doc`` in the order that decides which string is earlier.

    That is the id itself if ids are whole numbers without null or repetition. Else rows are numbered in the order of
    id (null last) and text, equal rows among themselves in any order, by sorted blocks.
    """
    whole = isinstance(documents.schema[doc].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if whole:
        odd = documents.groupBy(F.col(doc).cast("long").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d is null or n > 1")
        if not odd.take(1):
            return documents.withColumn("_doc", F.col(doc).cast("long"))
    order = [F.col(doc).isNull(), F.col(doc), F.coalesce(F.col(text), F.lit(""))]
    ordered = documents.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(ordered.withColumn("_doc", F.monotonically_increasing_id()))


def find_repeats(rows: DataFrame) -> DataFrame:
    """Stretches (doc, a, b) of bytes covered by repeated strings, for rows with a number ``doc`` and ``text``."""
    spark = rows.sparkSession
    rows = rows.select("doc", "text")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = cut_lineage(repeated_contexts(rows, parts))
    key = F.col("doc").bitwiseAND((1 << BITS) - 1).alias("k")
    mixed = bit_table(first.where(F.col("kind") == MIXED).select(key), "k", BITS)
    crowded = bit_table(first.where(F.col("kind") == CROWDED).select(key), "k", BITS)
    rest = repeated_strings(rows, parts, mixed, crowded)
    return first.where(F.col("kind") == STRETCH).select("doc", "a", "b").unionByName(rest)


def cut_repeats(documents: DataFrame, doc: str = "doc_id", text: str = "text", replace: bool = False) -> DataFrame:
    """``documents`` with kept (binary, the bytes that stay), n_bytes, n_removed and n_spans.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in a row of smaller id, or before
    it in the same text. Null text is empty; texts shorter than ``LENGTH`` stay; rows of equal or null id are
    ordered as ``numbered`` says. Stretches that touch count as one span. Columns of
    the added names are replaced. With ``replace`` the text becomes what is left of it (bytes that are no whole
    character are dropped; an uncut text stays as it is) in the same pass, so that no task has more than one Python worker.
    """
    new = [T.StructField("kept", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))]
    documents = without(documents, [*(f.name for f in new), "_doc", "_hit", "_spans"])
    rows = numbered(documents, doc, text)
    found = cut_lineage(find_repeats(rows.select(F.col("_doc").alias("doc"), F.col(text).alias("text"))))
    touched = bitmap(found.select(F.pmod("doc", F.lit(1 << 24)).alias("k")), "k")
    spans = found.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("_spans"))  # bounded by the text's length
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(touched))
    fields = documents.schema.fields
    names = [f.name for f in fields]

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            hit = known[batch.column("_doc").to_numpy(zero_copy_only=False).astype(np.int64) % (1 << 24)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], [*batch.schema.names, "_hit"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, texts = [], []
            for t, pairs in zip(batch.column(text).to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                raw, last, kept, spans_cut = (t or "").encode(), 0, [], 0
                for a, b in sorted((p["a"], p["b"]) for p in pairs or ()):
                    if a > last or not spans_cut:
                        spans_cut += 1
                        kept.append(raw[last:a])
                    last = max(last, b)
                body = b"".join([*kept, raw[last:]])
                out.append((body, len(raw), len(raw) - len(body), spans_cut))
                texts.append(body.decode("utf-8", "ignore") if len(body) < len(raw) else t)
            if replace:
                i = batch.schema.get_field_index(text)
                batch = batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))
            body = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = [batch.column(n) for n in names] + [pa.array(c, k) for c, k in zip(body, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *(f.name for f in new)])

    quoted = [f"`{n}`" for n in names]
    flagged = rows.select(*quoted, "_doc").mapInArrow(trimmed(flag), T.StructType([*fields, T.StructField("_doc", T.LongType()), T.StructField("_hit", T.BooleanType())]))
    # merged, as a broadcast would leave flagging and cutting in one task, with a Python worker each
    hit = flagged.where("_hit").drop("_hit").join(spans.withColumnRenamed("doc", "_doc").hint("merge"), "_doc", "left")
    body, nothing = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(0).cast("long")
    whole = [F.encode(body, "UTF-8").alias("kept"), F.octet_length(body).cast("long").alias("n_bytes"), nothing.alias("n_removed"), nothing.alias("n_spans")]
    rest = flagged.where("not _hit").select(*quoted, *whole)
    return rest.unionByName(hit.select(*quoted, "_spans").mapInArrow(trimmed(cut), T.StructType([*fields, *new])))


def digest(cut: DataFrame, doc: str = "doc_id") -> DataFrame:
    return cut.select(F.col(doc).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
