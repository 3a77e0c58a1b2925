"""Language identification with bit-sliced Bloom filters of character n-grams.

All languages share one Bloom filter array. Each position holds a mask with one bit per language, so the AND of
an n-gram's positions gives every language that contains it in one lookup. A text is decided by counting, for
each language, the n-grams whose mask has its bit, less the matches that the filter's false positives explain.

An n-gram belongs to a language if it makes up at least ``MIN_SHARE`` of the language's n-grams and at least
``KEEP`` of its highest share among all languages: shares do not depend on how much text was read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesline.llm.common import U64, mix, pieces, text_key, without, trimmed

GRAM = 4
BITS = 22
HASHES = 3
MIN_SHARE = 2e-6
KEEP = 0.2
FIT_ROWS = 20_000
LEAST_ROWS = 100
UNKNOWN = "und"
SEED = 0x2545F4914F6CDD1D


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 where there is no letter."""
    low = text.lower()
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(letter_table()[np.minimum(codes, LAST)], codes, 0).astype(np.uint32)


LAST = 0x3FFFF
_TABLE: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters; everything past the last assigned plane of letters is none."""
    if not _TABLE:
        out = np.fromiter((chr(c).isalpha() for c in range(LAST + 1)), bool, LAST + 1)
        out[LAST] = False
        _TABLE.append(out)
    return _TABLE[0]


def gram_hashes(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of every text, the text of each, and whether each text has a letter.

    Words are runs of letters with a blank on either side; n-grams lie within a word and its blanks. A word of
    fewer than ``n - 2`` letters gives one n-gram, padded with blanks.
    """
    parts, sizes = [], []
    for t in texts:
        codes = letters_of(t or "")
        parts.append(codes)
        parts.append(np.zeros(n, np.uint32))
        sizes.append(len(codes) + n)
    codes = np.concatenate([np.zeros(1, np.uint32), *parts])
    row = np.repeat(np.arange(len(texts)), sizes)  # of the code after each start
    letter = codes != 0
    count = len(codes) - n
    full = np.ones(count, bool)
    h = np.zeros(count, U64)
    for k in range(n):
        h = h * U64(SEED) + codes[k : count + k].astype(U64)
        if 0 < k < n - 1:
            full &= letter[k : count + k]
    starts = ~letter[:count] & letter[1 : count + 1]
    short = np.flatnonzero(starts & ~full)
    if len(short):  # blank out what follows the end of the word
        grams = np.stack([codes[short + k] for k in range(n)])
        alive = np.ones(len(short), bool)
        sh = np.zeros(len(short), U64)
        for k in range(n):
            if k:
                alive &= grams[k] != 0
            sh = sh * U64(SEED) + np.where(alive, grams[k], 0).astype(U64)
        h[short] = sh
    good = np.flatnonzero(full | starts)
    has = np.zeros(len(texts), bool)
    has[row[np.flatnonzero(letter[1:])]] = True
    return mix(h[good]), row[good], has


def positions(h: np.ndarray, bits: int, k: int) -> np.ndarray:
    """Position number ``k`` of each hash in an array of ``2 ** bits``."""
    return (mix(h + U64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> U64(64 - bits)).astype(np.int64)


@dataclass
class LanguageFilters:
    """The array of masks (one narrow word, or several of 64 bits, per position), and each language's false positive rate."""

    languages: list[str]
    gram: int
    bits: int
    hashes: int
    masks: np.ndarray
    false_rate: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, its corrected share of all languages' matches, and its share of all n-grams."""
        h, row, has = gram_hashes(texts, self.gram)
        total = np.bincount(row, minlength=len(texts)).astype(float)
        counts = np.zeros((len(texts), len(self.languages)))
        if self.languages:
            words = self.masks.shape[1]
            for w in range(words):
                found = self.masks[positions(h, self.bits, 0), w]
                for k in range(1, self.hashes):
                    found = found & self.masks[positions(h, self.bits, k), w]
                for i in range(min(64, len(self.languages) - 64 * w)):
                    counts[:, 64 * w + i] = np.bincount(row[(found >> found.dtype.type(i)) & found.dtype.type(1) > 0], minlength=len(texts))
        true = np.maximum(0, counts - total[:, None] * self.false_rate) / (1 - self.false_rate)
        best = true.argmax(axis=1) if self.languages else np.zeros(len(texts), int)
        top = true[np.arange(len(texts)), best] if self.languages else np.zeros(len(texts))
        share = np.divide(top, true.sum(axis=1), out=np.zeros(len(texts)), where=true.sum(axis=1) > 0)
        cover = np.minimum(1, np.divide(top, total, out=np.zeros(len(texts)), where=total > 0))
        names = [self.languages[b] if ok and self.languages else UNKNOWN for b, ok in zip(best.tolist(), has.tolist(), strict=True)]
        return names, share, np.where(has, cover, 0.0)


def quota(counts: list[int], rows: int) -> float:
    """How many rows a language gives at most, so that all together give ``rows``; never under ``LEAST_ROWS``."""
    left = rows
    for i, n in enumerate(sorted(counts)):
        share = left / (len(counts) - i)
        if n > share:
            return max(LEAST_ROWS, share)
        left -= n
    return float("inf")


def sample_languages(rows: DataFrame, want: int) -> DataFrame:
    """About ``want`` of the rows, drawn for each ``lang`` by itself by the hash ``_draw``: no language goes missing."""
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = quota(list(counts.values()), want)
    limit = {name: int((1 << 30) * most / n) for name, n in counts.items() if n > most}
    if not limit:
        return rows
    limits = F.create_map(*[F.lit(x) for pair in sorted(limit.items()) for x in pair])
    return rows.where(F.pmod(F.col("_draw"), F.lit(1 << 30)) < F.coalesce(F.try_element_at(limits, F.col("lang")), F.lit(1 << 30)))


def sample_rows(df: DataFrame, have: int, want: int) -> DataFrame:
    """The rows whose hash ``_draw`` falls into a share of ``want / have``: all of them if there are no more."""
    return df if have <= want else df.where(F.pmod(F.col("_draw"), F.lit(1 << 30)) < int((1 << 30) * want / have))


def fit_languages(
    labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = FIT_ROWS, gram: int = GRAM, bits: int = BITS, hashes: int = HASHES
) -> LanguageFilters:
    """Learn the filters from a bounded sample of labelled rows, about ``rows`` of them, drawn by hash.

    Languages with few rows give all of theirs, the others equally many, ``LEAST_ROWS`` at least. Rows without text or language are left out. The n-grams are counted where the rows lie; the driver gets only
    those that pass ``MIN_SHARE``, of which a language has at most ``1 / MIN_SHARE``.
    """
    draw = F.xxhash64(*[c for c in labelled.columns if c not in (text, lang)], F.col(text))
    sample = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), draw.alias("_draw"))
    sample = sample_languages(sample.where("text is not null and lang is not null"), rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 18):
                names = np.array(batch.column("lang").to_pylist(), object)
                h, row, _ = gram_hashes(batch.column("text").to_pylist(), gram)
                for name in sorted(set(names)):
                    value, n = np.unique(h[(names == name)[row]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(value), pa.string()), pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))],
                        ["lang", "h", "n"],
                    )

    grams = sample.select("text", "lang").mapInArrow(trimmed(count), "lang string, h long, n long").groupBy("lang", "h").agg(F.sum("n").alias("n"))
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = grams.join(F.broadcast(totals), "lang").where(F.col("n") >= MIN_SHARE * F.col("total"))
    pdf = kept.select("lang", "h", (F.col("n") / F.col("total")).alias("share")).toPandas()
    languages = sorted(set(pdf["lang"]))
    width = max(1, -(-len(languages) // 64))
    narrow = next((t for t in (np.uint8, np.uint16, np.uint32) if len(languages) <= 8 * np.dtype(t).itemsize), np.uint64)
    masks = np.zeros((1 << bits, width), narrow)
    best = pdf.groupby("h")["share"].transform("max")
    pdf = pdf[pdf["share"] >= KEEP * best]
    false_rate = np.zeros(len(languages))
    for i, name in enumerate(languages):
        h = pdf.loc[pdf["lang"] == name, "h"].to_numpy(np.int64).view(U64)
        bit = narrow(1 << (i % 64))
        for k in range(hashes):
            masks[positions(h, bits, k), i // 64] |= bit
        false_rate[i] = (((masks[:, i // 64] & bit) != 0).mean()) ** hashes
    return LanguageFilters(languages, gram, bits, hashes, masks, false_rate)


def identify(documents: DataFrame, model: LanguageFilters, text: str = "text") -> DataFrame:
    """``documents`` with lang_pred, lang_score (share among languages) and lang_cover (share of n-grams).

    Null and letterless texts are ``und`` with score 0; texts whose n-grams no filter knows get the first
    language with score 0; columns of the added names are replaced; equal counts go to the first language by name. Without any labelled row all
    texts are ``und``.
    """
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_cover", T.DoubleType())]
    documents = without(documents, [f.name for f in new])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for whole in batches:
            for batch in pieces(whole, text, 1 << 18):
                names, score, cover = filters.score(batch.column(text).to_pylist())
                known = np.array([x != UNKNOWN for x in names], bool)
                columns = [*batch.columns, pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(cover)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "lang_score", "lang_cover"])

    return documents.mapInArrow(trimmed(work), T.StructType([*documents.schema.fields, *new]))


def held_out(name: str = "doc_id"):
    return F.coalesce(text_key(name) % 4 == 2, F.lit(False))


def learned_rows(documents: DataFrame) -> DataFrame:
    """The rows that languages may be learned from."""
    return documents.where(~held_out())
