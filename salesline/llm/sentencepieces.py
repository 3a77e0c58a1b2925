"""Merge-type SentencePiece encoding and decoding.

A text is normalised as the vocabulary says (identity, blanks as U+2581, one such mark in front) and cut
wherever no piece of the vocabulary has the two characters side by side, so that no merge can cross. Within such a unit
the agenda of adjacent symbol pairs is worked off by score: the best pair, the leftmost among equals, is merged, and its
two neighbouring pairs enter the agenda. The agendas of all units of an Arrow batch that were not met before advance
together, one merge each per step; that of a unit of more than ``QUEUED`` symbols is a priority queue over linked symbols,
so that a run that nothing divides takes n log n steps. Characters outside the vocabulary become byte pieces. Each Arrow batch is checked against the sentencepiece
library: all units that are new in it, and one whole text.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salesline.llm.common import pieces, without, trimmed

MARK = "▁"
CACHE = 150_000
NONE = np.int64(1) << 60
QUEUED = 64
BLANK, UNKNOWN, OTHER, CLASSES = 256, 257, 258, 259


class Vocabulary:
    """The pieces of a model file, and the table of pairs that merge."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only merge-type vocabularies without text rewriting are supported")
        if not model.trainer_spec.byte_fallback:
            raise ValueError("the vocabulary needs byte pieces")
        self.library = SentencePieceProcessor(model_file=path)
        self.end = self.library.eos_id()
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.pieces = [p.piece for p in model.pieces]
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.id_bytes = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i, p in enumerate(model.pieces) if p.type in (2, 3)}
        self.last_byte = max(*self.silent, *self.id_bytes)
        # symbols: pieces by their id, then the characters that only occur inside of pieces
        self.symbol = dict(normal)
        for p in normal:
            for c in p:
                self.symbol.setdefault(c, len(self.pieces) + len(self.symbol))
        self.char_of = {i: c for c, i in self.symbol.items()}
        self.width = max(self.symbol.values()) + 1
        ranks = {s: r for r, s in enumerate(sorted({-p.score for p in model.pieces if p.type == 1}))}
        self.rank_of = np.full(self.width, NONE)
        keys, merged = [], []
        for p, i in normal.items():
            self.rank_of[i] = ranks[-model.pieces[i].score]
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    merged.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        self.pairs = dict(zip(self.keys.tolist(), self.merged.tolist(), strict=True))
        self.ranks = self.rank_of.tolist()
        self.symbol_of = np.full(0x110001, -1, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.digits = [str(i) for i in range(len(self.pieces))]
        # the class of every character: itself below 256, the mark, unknown, or some other one of the vocabulary
        self.class_of = np.full(0x110001, UNKNOWN, np.int16)
        for c in {c for p in normal for c in p}:
            self.class_of[ord(c)] = BLANK if c == MARK else ord(c) if ord(c) < 256 else OTHER
        # whether two neighbours may be in one unit: some piece has them side by side (assumed of other characters)
        self.joint = np.zeros((CLASSES, CLASSES), bool)
        for p in normal:
            c = self.class_of[[ord(x) for x in p]]
            self.joint[c[:-1], c[1:]] = True
        self.joint[OTHER] = self.joint[:, OTHER] = True
        self.joint[UNKNOWN] = self.joint[:, UNKNOWN] = False
        self.joint[UNKNOWN, UNKNOWN] = True

    def units(self, text: str) -> list[str]:
        """The text, marked, cut wherever no piece has the two characters side by side."""
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        classes = self.class_of[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        cuts = (np.flatnonzero(~self.joint[classes[:-1], classes[1:]]) + 1).tolist()
        return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def pair_ids(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def rank(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.rank_of[ids], NONE)

    def agenda(self, units: list[str]) -> list[list[int]]:
        """The piece ids of every unit (none is empty) after all merges."""
        done: list[list[int]] = [[] for _ in units]
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        unit = np.repeat(np.arange(len(units)), np.fromiter(map(len, units), np.int64, len(units)))
        sym = self.symbol_of[np.minimum(codes, len(self.symbol_of) - 1)].astype(np.int64)
        foreign = np.zeros(len(units), bool)
        foreign[unit[sym < 0]] = True
        for i in np.flatnonzero(foreign).tolist():  # characters that no piece holds: they never merge
            done[i] = [x for c in units[i] for x in self.as_bytes(c)]
        size = np.fromiter(map(len, units), np.int64, len(units))
        queued = ~foreign & (size > QUEUED)
        ends = np.cumsum(size)
        for i in np.flatnonzero(queued).tolist():
            done[i] = self.queue(sym[ends[i] - size[i] : ends[i]])
        plain = ~(foreign | queued)[unit]
        unit, sym = unit[plain], sym[plain]
        same = unit[1:] == unit[:-1]
        pair = np.full(len(sym), -1, np.int64)
        if len(sym):
            pair[:-1][same] = self.pair_ids(sym[:-1][same], sym[1:][same])
        score = self.rank(pair)
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
            sizes = np.diff(np.append(first, len(sym)))
            best = np.minimum.reduceat(score, first)
            over = best >= NONE
            if over.any():
                flat, begin, size = sym.tolist(), first[over].tolist(), sizes[over].tolist()
                for i, f, n in zip(unit[first[over]].tolist(), begin, size, strict=True):
                    done[i] = flat[f : f + n]
            at_best = np.flatnonzero((score == np.repeat(best, sizes)) & (score < NONE))
            if not len(at_best):
                break
            where = at_best[np.concatenate(([True], unit[at_best[1:]] != unit[at_best[:-1]]))]
            sym[where] = pair[where]  # one merge in each unit, the leftmost of the best
            stay = np.repeat(~over, sizes)
            stay[where + 1] = False
            changed = np.zeros(len(sym), bool)
            changed[where] = True
            changed[where[where > 0] - 1] = True
            sym, unit, pair, score, changed = sym[stay], unit[stay], pair[stay], score[stay], changed[stay]
            touched = np.flatnonzero(changed)
            after = np.minimum(touched + 1, len(sym) - 1)
            joined = (unit[touched] == unit[after]) & (touched < len(sym) - 1)
            pair[touched] = np.where(joined, self.pair_ids(sym[touched], sym[after]), -1)
            score[touched] = self.rank(pair[touched])
        return [self.final(s) if max(s) >= len(self.pieces) else s for s in done]

    def queue(self, symbols: np.ndarray) -> list[int]:
        """The symbols after all merges, from a queue of pairs by score and place; pairs that merges broke up are passed over."""
        from heapq import heapify, heappop, heappush

        n, sym = len(symbols), symbols.tolist()
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pair = self.pair_ids(symbols[:-1], symbols[1:])
        at = np.flatnonzero(pair >= 0)
        agenda = list(zip(self.rank(pair[at]).tolist(), at.tolist(), symbols[at].tolist(), symbols[at + 1].tolist(), pair[at].tolist(), strict=True))
        heapify(agenda)
        while agenda:
            _, i, a, b, merged = heappop(agenda)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = merged, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    found = self.pairs.get(sym[k] * self.width + sym[after[k]])
                    if found is not None:
                        heappush(agenda, (self.ranks[found], k, sym[k], sym[after[k]], found))
        return [s for s in sym if s >= 0]

    def as_bytes(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8")]

    def final(self, symbols: list[int]) -> list[int]:
        """Piece ids; a character that is no piece of its own becomes its bytes."""
        return [x for s in symbols for x in ([s] if s < len(self.pieces) else self.as_bytes(self.char_of[s]))]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, byte runs read as UTF-8, marks as blanks, the first one dropped."""
        return self.text_of(ids).removeprefix(" ")

    def text_of(self, ids: list[int]) -> str:
        if min(ids, default=0) > self.last_byte:
            return "".join([self.pieces[i] for i in ids]).replace(MARK, " ")
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.id_bytes:
                raw.append(self.id_bytes[i])
                continue
            out.append(raw.decode("utf-8", "replace"))
            raw.clear()
            if i not in self.silent:
                out.append(self.pieces[i])
        return "".join([*out, raw.decode("utf-8", "replace")]).replace(MARK, " ")


    def compare(self, units: list[str], found: list[list[int]]) -> None:
        """Raise if the library cuts any unit differently.

        The library puts a mark in front of a text; a line break behind it, which no piece holds, keeps it away
        from the unit.
        """
        lead = self.library.encode("\n")
        theirs = self.library.encode(["\n" + u for u in units], num_threads=1)
        for u, mine, want in zip(units, found, theirs, strict=True):
            if lead + mine != want:
                raise ValueError(f"ids of {u!r} differ from the library's: {mine} and {want[len(lead):]}")


class Encoder:
    """Encodes batches; units met before are remembered, up to ``CACHE`` of them."""

    def __init__(self, path: str, check: bool = True):
        self.vocabulary, self.check = Vocabulary(path), check
        self.known: dict[str, tuple[str, int, str]] = {}

    def batch(self, texts: list[str]) -> list[list[tuple[str, int, str]]]:
        """For every text its units as (ids joined by blanks, number of ids, decoded text)."""
        if len(self.known) > CACHE:
            self.known.clear()
        cut = [self.vocabulary.units(t) for t in texts]
        fresh = list({u for us in cut for u in us if u not in self.known})
        found = self.vocabulary.agenda(fresh) if fresh else []
        if self.check:
            self.vocabulary.compare(fresh, found)
        digits = self.vocabulary.digits
        for u, ids in zip(fresh, found, strict=True):
            self.known[u] = (" ".join([digits[i] for i in ids]), len(ids), self.vocabulary.text_of(ids))
        return [[self.known[u] for u in us] for us in cut]


def encode_decode(documents: DataFrame, model_path: str, text: str = "text", check: bool = True) -> DataFrame:
    """``documents`` with ids (array of int, the end id last), and decoded.

    Null is as empty: the end id alone, decoded to an empty text. Columns of the added names are replaced. With ``check`` the ids of all units, as they are
    first met, and of one whole text of each Arrow batch are compared with the library's; a difference is an error. ``model_path`` must be readable on executors.
    """
    new = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    kind = [pa.list_(pa.int32()), pa.string()]

    def rows(texts: list[str], ids: list[str], decoded: list[str]):
        return [[[int(x) for x in i.split(" ")] for i in ids], decoded]

    return _run(documents, model_path, text, check, new, kind, rows)


def encode_digests(documents: DataFrame, model_path: str, text: str = "text", check: bool = True) -> DataFrame:
    """As ``encode_decode``, but with n_tokens, ids_sha256 and decoded_sha256 instead of ids and texts."""
    from hashlib import sha256

    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    kind = [pa.int64(), pa.string(), pa.string()]

    def rows(texts: list[str], ids: list[str], decoded: list[str]):
        hexes = [sha256(i.encode()).hexdigest() for i in ids]
        return [[i.count(" ") + 1 for i in ids], hexes, [sha256(d.encode()).hexdigest() for d in decoded]]

    return _run(documents, model_path, text, check, new, kind, rows)


def _run(documents, model_path, text, check, new, kind, rows) -> DataFrame:
    documents = without(documents, [f.name for f in new])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path, check)
        library, end = encoder.vocabulary.library, encoder.vocabulary.end
        for whole in batches:
            for batch in pieces(whole, text):
                texts = [t or "" for t in batch.column(text).to_pylist()]
                found = encoder.batch(texts)
                ids = [" ".join([*(u[0] for u in us), str(end)]) for us in found]
                decoded = ["".join([u[2] for u in us]).removeprefix(" ") for us in found]
                if check:  # every unit was compared when it was first met; one whole text of each batch as well
                    one = max(range(len(texts)), key=lambda i: min(len(texts[i]), 5000))
                    theirs = library.encode(texts[one], add_eos=True)
                    if ids[one] != " ".join(map(str, theirs)) or decoded[one] != library.decode(theirs):
                        raise ValueError(f"ids or decoded text differ from the library's: {texts[one][:200]!r}")
                columns = [*batch.columns, *(pa.array(c, k) for c, k in zip(rows(texts, ids, decoded), kind, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *(f.name for f in new)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the remembered units hold no cycles, and walking them costs more than encoding
        try:
            yield from encoded(batches)
        finally:
            gc.enable()  # later tasks use the same worker

    return documents.mapInArrow(trimmed(work), T.StructType([*documents.schema.fields, *new]))
