"""Toxicity of texts whose spelling may be disguised.

A noisy channel is assumed between what was meant and what is read: letters become look-alike digits and signs,
are repeated, or are set apart by blanks and dots. Suspicious spans are decoded with the Viterbi algorithm over
the lattice of what each character may stand for, under a character trigram model of the whole corpus. The
restored text is then scored with words and word beginnings learned from labelled rows.

Three passes: count trigrams in all documents; learn the terms from a bounded sample of labelled rows
(``FIT_ROWS`` on average); restore and score every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesline.llm.common import pieces, text_key, without
from salesline.llm.langid import sample_rows
from salesline.session import cut_lineage

FIT_ROWS = 20_000
LEAST_DOCS, LEAST_NEW, LEAST_SHARE, LEAST_PRECISION, PRIOR = 8, 2, 0.02, 0.75, 3
CLEAN_COST = 3  # toxic texts that a term must bring for every clean text it is in
PREFIXES = (4, 5, 6)
SYMBOLS = 64
THRESHOLD = 0.7
# What a sign may stand for, and what each step of the channel costs (natural logarithms).
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
COST_SIGN, COST_KEEP, COST_GAP, COST_KEEP_GAP = 0.7, 8.0, 0.3, 2.0
COST_PAIR, COST_REPEAT = 3.0, 0.7  # dropping one of two equal characters; one of more

SIGNS = re.escape("".join(LOOKALIKES))
LETTER = r"[^\W\d_]"
SPAN = re.compile(
    rf"(?<![^\s.,;:()\"'])(?:[^\W_]|[{SIGNS}])(?:[ .\-_*](?:[^\W_]|[{SIGNS}])){{2,}}(?![^\s.,;:()\"'!?])"  # set apart
    rf"|[^\W_{SIGNS}]*(?:{LETTER}[{SIGNS}]+(?={LETTER})|(?<!\S)[{SIGNS}]+(?={LETTER})|({LETTER})\1\1)(?:[^\W_]|[{SIGNS}](?=[^\W_{SIGNS}]|[{SIGNS}]*{LETTER}))*"
    rf"|{LETTER}{{2,}}[013457](?![^\W_])"
)
GAPS = frozenset(" .-_*")
TOKEN = re.compile(rf"{LETTER}+")


def symbol(c: str) -> int:
    """0 for what is no letter, 1-26 for a-z, else one of the 37 classes of other letters."""
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % 37 if c.isalpha() else 0


_SYMBOLS: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    if not _SYMBOLS:
        _SYMBOLS.append(np.fromiter((symbol(chr(c)) for c in range(0x30000)), np.int64, 0x30000))
    return _SYMBOLS[0]


def trigram_counts(texts: list[str]) -> np.ndarray:
    """How often each symbol triple occurs; a text has a blank on either side."""
    codes = np.frombuffer("\n".join(["", *texts, ""]).lower().encode("utf-32-le"), np.uint32)
    s = symbol_table()[np.minimum(codes, 0x2FFFF)]
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)


def corpus_trigrams(documents: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts of all whole texts, summed where they lie; the driver gets at most SYMBOLS ** 3 numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for whole in batches:
            for batch in pieces(whole, text, 2 << 20):
                total += trigram_counts([t or "" for t in batch.column(text).to_pylist()])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["k", "n"])

    counts = documents.select(text).mapInArrow(work, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**3, np.int64)
    out[counts.column("k").to_numpy()] = counts.column("n").to_numpy()
    return out


class CharModel:
    """Costs (negative logarithms) of a symbol after two others, interpolated with shorter histories."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
        self.costs = (-np.log(p3)).tolist()

    def decode(self, read: str) -> str:
        """The likeliest text behind ``read`` (lower case), by Viterbi over its character lattice.

        A state is the last two symbols and the character read last; repeats of that character may be dropped.
        """
        costs = self.costs
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        before = ""
        sizes = [len(list(g)) for _, g in groupby(read)]
        of = [n for n in sizes for _ in range(n)]
        for c, run in zip(read, of, strict=True):
            options: list[tuple[str, float]] = []
            if c in LOOKALIKES:
                options = [(x, COST_SIGN) for x in LOOKALIKES[c]] + [(c, COST_KEEP)]
            elif c in GAPS:
                options = [("", COST_GAP), (c, COST_KEEP_GAP)]
            else:
                options = [(c, 0.0)]
            if c == before and c not in GAPS:
                options.append(("", COST_PAIR if run == 2 else COST_REPEAT))
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (cost, path) in best.items():
                row = costs[a][b]
                for out, extra in options:
                    if out:
                        s = symbol(out)
                        state, total, way = (b, s), cost + extra + row[s], (path, out)
                    else:
                        state, total, way = (a, b), cost + extra, path
                    old = after.get(state)
                    if old is None or total < old[0]:
                        after[state] = (total, way)
            best, before = after, c
        cost, path = min(((c + costs[a][b][0], p) for (a, b), (c, p) in best.items()), key=lambda x: x[0])
        out = []
        while path:
            path, c = path
            out.append(c)
        return "".join(reversed(out))


class Restorer:
    """Restores texts; spans met before are remembered."""

    def __init__(self, model: CharModel, remember: int = 100_000):
        self.model, self.known, self.remember = model, {}, remember

    def _one(self, match: re.Match) -> str:
        span = match.group(0)
        out = self.known.get(span)
        if out is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            out = self.known[span] = self.model.decode(span)
        return out

    def restore(self, texts: list[str | None]) -> list[str]:
        """The lower-cased texts with every suspicious span replaced by what it stands for.

        Arrays of character classes find where such a span may be; only the stretches around these places, from
        blank to blank, are searched with the pattern.
        """
        low = [(t or "").lower() for t in texts]
        joined = "\n".join(["", *low, ""])
        starts, ends = suspicious(joined)
        offsets = np.cumsum([1, *(len(t) + 1 for t in low)])
        row = np.searchsorted(offsets, starts + 1, side="right") - 1
        pieces_of: dict[int, list] = {}
        for r, a, b in zip(row.tolist(), starts.tolist(), ends.tolist(), strict=True):
            pieces_of.setdefault(r, []).append((a, b))
        for r, spans in pieces_of.items():
            at, last, out = int(offsets[r]), 0, []
            for a, b in spans:
                a, b = max(0, a - at), min(len(low[r]), b - at)
                out += [low[r][last:a], SPAN.sub(self._one, low[r][a:b])]
                last = b
            low[r] = "".join([*out, low[r][last:]])
        return low


_CLASSES: list[np.ndarray] = []
WORD_BIT, LETTER_BIT, SIGN_BIT, DIGIT_BIT, SPACE_BIT, GAP_BIT = 1, 2, 4, 8, 16, 32


def character_classes() -> np.ndarray:
    if not _CLASSES:
        out = np.zeros(0x30000, np.uint8)
        for i in range(0x30000):
            c = chr(i)
            out[i] = (
                WORD_BIT * (c.isalnum() or c in LOOKALIKES)
                + LETTER_BIT * (c.isalpha())
                + SIGN_BIT * (c in LOOKALIKES)
                + DIGIT_BIT * (c in "013457")
                + SPACE_BIT * c.isspace()
                + GAP_BIT * (c in GAPS)
            )
        _CLASSES.append(out)
    return _CLASSES[0]


def suspicious(joined: str) -> tuple[np.ndarray, np.ndarray]:
    """Stretches, without overlap, of a text framed by line breaks that may hold a disguised word.

    A stretch ends at white space that does not stand between two single characters.
    """
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    k = character_classes()[np.minimum(codes, 0x2FFFF)]
    word, letter, sign = (k & WORD_BIT) > 0, (k & LETTER_BIT) > 0, (k & SIGN_BIT) > 0
    mark = np.zeros(len(codes), bool)
    mark[:-1] = sign[:-1] & letter[1:]
    mark[1:] |= ((k[1:] & DIGIT_BIT) > 0) & letter[:-1]
    same = letter[1:] & (codes[1:] == codes[:-1])
    mark[2:] |= same[1:] & same[:-1]
    single = np.zeros(len(codes), bool)
    single[1:-1] = word[1:-1] & ~word[:-2] & ~word[2:]
    last = single.copy()  # the last one may have a ! behind it
    last[1:-1] |= word[1:-1] & ~word[:-2] & (codes[2:] == ord("!"))
    gap = (k & GAP_BIT) > 0
    chain = np.zeros(len(codes), bool)  # a gap between two single characters
    chain[1:-1] = gap[1:-1] & single[:-2] & last[2:]
    mark[2:] |= chain[2:] & chain[:-2]
    at = np.flatnonzero(mark)
    bounds = np.flatnonzero(((k & SPACE_BIT) > 0) & ~chain)
    if not len(at):
        return at, at
    right = np.searchsorted(bounds, at)
    right = np.unique(right[(right > 0) & (right < len(bounds))])
    return bounds[right - 1], bounds[right]


def terms_of(restored: str) -> set[str]:
    """The words of a text, and their beginnings marked with ``*``."""
    words = set(TOKEN.findall(restored))
    return words.union(*({w[:n] + "*" for w in words if len(w) >= n} for n in PREFIXES))


@dataclass
class ToxicTerms:
    """The learned terms with the share of toxic texts among those that hold them, and the share without any."""

    weights: dict[str, float]
    rest: float

    def __post_init__(self):
        self.words = {t for t in self.weights if not t.endswith("*")}
        self.starts = {n: {t[:-1] for t in self.weights if t.endswith("*") and len(t) == n + 1} for n in PREFIXES}

    def score(self, restored: str) -> tuple[float, list[str]]:
        """One minus the chance that none of the terms found, nor anything else, makes the text toxic."""
        words = set(TOKEN.findall(restored))
        found = list(words & self.words)
        for n, starts in self.starts.items():
            if starts:
                found += [x + "*" for x in {w[:n] for w in words} & starts]
        return 1 - (1 - self.rest) * math.prod(1 - self.weights[t] for t in found), sorted(found)


def held_out(name: str = "doc_id"):
    return F.coalesce(text_key(name) % 3 == 1, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """text and toxic of ``rows`` labelled documents outside the held-out fold, on average; stored.

    Only ids and labels of the sample are broadcast, so its size bounds the broadcast.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = sample_rows(known.withColumn("_draw", F.xxhash64("doc_id")), labels.count(), rows).drop("_draw")
    return cut_lineage(documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic"))


def learn_terms(sample: DataFrame, model: CharModel) -> ToxicTerms:
    """Choose terms greedily: of those precise enough, the one that brings most toxic texts without a term so far, less
    a cost for the clean texts it is in; then a second term for as many texts as possible.

    Equal texts count once. Candidates are terms of at least ``LEAST_DOCS`` toxic texts; their counts are taken
    where the sample lies, and the driver gets only candidates and, for each toxic text, the candidates it holds.
    """
    unique = sample.where("text is not null").groupBy("text").agg(F.max("toxic").alias("toxic"))
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for whole in batches:
            for batch in pieces(whole, "text", 2 << 20):
                found = [sorted(terms_of(t)) for t in restorer.restore(batch.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column("toxic")], ["terms", "toxic"])

    held = cut_lineage(unique.mapInArrow(terms, "terms array<string>, toxic int"))
    sizes = dict(held.groupBy("toxic").count().collect())
    positives, negatives = sizes.get(1, 0), sizes.get(0, 0)
    if not positives:
        return ToxicTerms({}, 0.0 if negatives else 0.5)

    def counted(rows: DataFrame, among: set[str] | None) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: Counter = Counter()
            for batch in batches:
                for found in batch.column("terms").to_pylist():
                    total.update(found if among is None else among.intersection(found))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["t", "n"])

        return rows.select("terms").mapInArrow(count, "t string, n long").groupBy("t").agg(F.sum("n").alias("n"))

    toxic = dict(counted(held.where("toxic = 1"), None).where(F.col("n") >= LEAST_DOCS).collect())
    clean = dict(counted(held.where("toxic = 0"), set(toxic)).collect())
    base = positives / max(1, positives + negatives)
    weight = {t: (n + PRIOR * base) / (n + clean.get(t, 0) + PRIOR) for t, n in toxic.items()}
    precise = {t for t, w in weight.items() if w >= LEAST_PRECISION}
    texts = [precise.intersection(r.terms) for r in held.where("toxic = 1").select("terms").toLocalIterator()]
    chosen: list[str] = []
    for round_ in (1, 2):  # every text by one term, then as many as possible by another, in case one is missing elsewhere
        stems = [t.rstrip("*") for t in chosen]
        other = {t for t in precise if not any(t.startswith(s) or s.startswith(t.rstrip("*")) for s in stems)}
        open_texts = [x & other for x in texts]
        new_least = LEAST_NEW if round_ == 1 else max(LEAST_NEW, LEAST_SHARE * positives)
        left = Counter(t for x in open_texts for t in x)
        while left:
            top = max(left, key=lambda t: (left[t] - CLEAN_COST * clean.get(t, 0), weight[t], not t.endswith("*"), len(t), t))
            if left[top] < new_least or left[top] <= CLEAN_COST * clean.get(top, 0):
                break
            chosen.append(top)
            for x in [x for x in open_texts if top in x]:
                left.subtract(x)
            open_texts = [x for x in open_texts if top not in x]
            left = Counter({t: n for t, n in left.items() if n > 0})
        if round_ == 1:
            uncovered = (len(open_texts) + 0.5) / (len(open_texts) + negatives + 1)
    weights = {t: weight[t] for t in chosen}
    for t in chosen:  # a restored word may have lost one of two equal letters
        if not t.endswith("*"):
            weights.setdefault(re.sub(r"(.)\1+", r"\1", t), weight[t])
    return ToxicTerms(weights, min(uncovered, base))


def score_toxicity(documents: DataFrame, model: CharModel, terms: ToxicTerms, text: str = "text", keep_restored: bool = False) -> DataFrame:
    """``documents`` with toxicity (0 to 1), toxic_terms (the terms found), and if asked the restored text.

    Null and empty texts hold no term and get the score of texts without any. Equal texts get equal scores. Columns
    of the added names are replaced.
    """
    new = [T.StructField("toxicity", T.DoubleType()), T.StructField("toxic_terms", T.ArrayType(T.StringType()))]
    if keep_restored:
        new.append(T.StructField("restored", T.StringType()))
    documents = without(documents, [f.name for f in new])
    shared = documents.sparkSession.sparkContext.broadcast((model, terms))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars, learned = shared.value
        restorer = Restorer(chars)
        for whole in batches:
            for batch in pieces(whole, text):
                restored = restorer.restore(batch.column(text).to_pylist())
                scores = [learned.score(t) for t in restored]
                columns = [*batch.columns, pa.array([s for s, _ in scores], pa.float64()), pa.array([f for _, f in scores], pa.list_(pa.string()))]
                if keep_restored:
                    columns.append(pa.array(restored, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *(f.name for f in new)])

    return documents.mapInArrow(work, T.StructType([*documents.schema.fields, *new]))


def fit(documents: DataFrame, labels: DataFrame) -> tuple[CharModel, ToxicTerms]:
    """The character model of all documents and the terms of a sample of labelled ones."""
    model = CharModel(corpus_trigrams(documents))
    return model, learn_terms(labelled_sample(documents, labels), model)
