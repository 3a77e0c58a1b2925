"""Exact join of texts by the Jaccard similarity of their word n-grams, and its connected groups.

Two sets of sizes l <= s whose similarity is at least t differ in at most H = (l + s)(1 - t)/(1 + t) elements. Sizes
are cut into bands. For the band of the smaller set, the universe of n-gram hashes is cut into somewhat more than H + 1
segments. By the pigeonhole principle two similar sets hold the same subset in at least one of any H + 1 segments. A few
designated segments also index their one-deletion neighbourhoods: looking for agreement up to one element there counts
as one segment more. So every set looks with only as many subsets and neighbourhoods as it needs, and leaves the
costliest out. The cost is the smallest frequency among the n-grams of a subset, an upper bound of how many sets can
share it, from a sketch over all documents; empty and one-element subsets cost most. What is left out is still indexed
for others.

Equal sets are merged first. Sets that share a subset form a bucket. Within it not all pairs are made: every member is
compared with one centre, the components of the verified links are found, and only members that are then still in
different components are compared with each other. So no link that would join two components is lost.

N-grams and sets are known by 64-bit hashes.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.llm.common import BITMAP, U64, Powers, bitmap, lower_table, mix, pieces, span_hashes, text_bytes, words_of, trimmed
from salesline.llm.components import connected_components
from salesline.llm.decontaminate import window_hashes
from salesline.session import cut_lineage

NGRAM, PERCENT = 4, 85
RATIO = 1.4
SPARE = 4  # one segment more than needed for so many
DESIGNATED = 32  # one segment in so many, and one more, has its one-deletion neighbourhood indexed
SKETCH = 1 << 18
FLUSH = 1 << 19
BASE = 0x2127599BF4325C37
ACTIVE, DELETION = 1, 2
EMPTY_COST, SINGLE_COST = np.int64(1) << 60, np.int64(1) << 59


def word_bytes() -> np.ndarray:
    """Every byte but the blanks 0x20 and 0x09 to 0x0D."""
    out = np.ones(256, bool)
    out[0x20] = False
    out[0x09:0x0E] = False
    return out


class Shingler:
    """Sets of n-gram hashes of the texts of an Arrow column."""

    def __init__(self, ngram: int):
        self.ngram, self.powers, self.lower, self.letter = ngram, Powers(BASE), lower_table(), word_bytes()

    def sets(self, column: pa.Array) -> list[np.ndarray]:
        """For every text its distinct n-grams, sorted; a text of fewer words is one n-gram, one without is empty."""
        data, offsets = text_bytes(column)
        data = self.lower[data]
        starts, ends, first = words_of(data, offsets, self.letter)
        words = span_hashes(data, starts, ends, self.powers) if len(starts) else np.zeros(0, U64)
        grams = window_hashes(words, self.ngram)
        out = []
        for i in range(len(offsets) - 1):
            a, b = first[i], first[i + 1]
            if b - a >= self.ngram:
                out.append(np.unique(grams[a : b - self.ngram + 1]))
            elif b > a:
                out.append(window_hashes(words[a:b], int(b - a)) + U64(b - a))
            else:
                out.append(np.zeros(0, U64))
        return out


def set_id(grams: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    total = mix(grams * U64(0x9FB21C651E98DF25) + U64(1)).sum(dtype=U64) + U64(len(grams))
    return int(mix(np.array([total]))[0].view(np.int64))


class Bands:
    """Size bands, and the segments of each band's pigeonhole."""

    def __init__(self, percent: int):
        self.percent, self.bounds = percent, [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(int(self.bounds[-1] * RATIO) + 1)
            if self.bounds[-1] * percent <= (self.bounds[-2] - 1) * 100:
                raise ValueError("similar sets must lie in the same or the next band")

    def segments(self, band: int) -> tuple[int, int, int]:
        """Segments, designated segments, and the sum of gains a set needs, for pairs whose smaller set is in ``band``."""
        small = self.bounds[band + 1] - 1
        large = small * 100 // self.percent
        differ = (small + large) * (100 - self.percent) // (100 + self.percent)
        if not differ:
            return 1, 1, 1
        m = differ + 1 + -(-(differ + 1) // SPARE)
        return m, 1 + m // DESIGNATED, differ + 1

    def of(self, n: int) -> list[int]:
        """The bands a set of ``n`` elements takes part in: its own, and the one below if a similar set may be there."""
        own = bisect.bisect_right(self.bounds, n) - 1
        return [own] + ([own - 1] if own and (self.bounds[own] - 1) * 100 >= n * self.percent else [])


def signatures(grams: np.ndarray, bands: Bands, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subset hashes of a sorted set in all its bands, with flags: ACTIVE (it looks for others), DELETION."""
    found, flags = [], []
    spread = mix(grams + U64(0x632BE59BD9B4E019))
    for band in bands.of(len(grams)):
        m, designated, need = bands.segments(band)
        if m == 1:
            continue  # only equal sets are similar, and these are one set
        segment = ((grams >> U64(32)) * U64(m)) >> U64(32)  # follows the order of the hashes
        edge = np.searchsorted(segment, np.arange(m + 1, dtype=U64))
        size = np.diff(edge)
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(spread)))
        base = mix(np.arange(m, dtype=U64) + U64((band + 1) << 32))
        total = sums[edge[1:]] - sums[edge[:-1]] + base
        cost = np.full(m, EMPTY_COST)
        some = np.flatnonzero(size)
        cost[some] = np.minimum.reduceat(sketch[(grams & U64(SKETCH - 1)).astype(np.int64)], edge[some])
        cost[size == 1] += SINGLE_COST
        # what each segment may add: its subset, and, if designated, its neighbourhood, which costs what is left
        # without its rarest n-gram; the costliest are left out as long as enough remain
        inside = np.arange(edge[designated])
        owner = segment[inside].astype(np.int64)
        near = np.full(designated, EMPTY_COST)
        for i in np.flatnonzero(size[:designated] > 1).tolist():
            near[i] = np.partition(sketch[(grams[edge[i] : edge[i + 1]] & U64(SKETCH - 1)).astype(np.int64)], 1)[1]
        kept = np.ones(designated + m, bool)
        kept[np.argsort(-np.concatenate((np.maximum(near, cost[:designated]), cost)), kind="stable")[: m + designated - need]] = False
        found += [mix(total), mix(total[owner] - spread[inside])]
        flags += [np.where(kept[designated:], ACTIVE, 0), DELETION + np.where(kept[owner], ACTIVE, 0)]
    if not found:
        return np.zeros(0, U64), np.zeros(0, np.uint8)
    return np.concatenate(found), np.concatenate(flags).astype(np.uint8)


def stars(sig: np.ndarray, sid: np.ndarray, flag: np.ndarray):
    """Tie every member of a bucket to its centre, the smallest active plain set or else the smallest set.

    Returns the rows of centres, and the pairs (row of the centre, row of a member) of buckets with several rows.
    """
    rank = np.where(flag == ACTIVE, 0, 1)
    order = np.lexsort((sid, rank, sig))
    new = np.concatenate(([True], sig[order][1:] != sig[order][:-1]))
    centre = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    member = ~new & (sid[order] != sid[centre])
    return order[new], centre[member], order[member]


CANDIDATE = "sig long, a long, fa int, b long, fb int"


def _candidate_batch(sig, sid, flag, centre, member) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(sig[centre].view(np.int64)), pa.array(sid[centre]), pa.array(flag[centre].astype(np.int32)), pa.array(sid[member]),
            pa.array(flag[member].astype(np.int32)),
        ],
        ["sig", "a", "fa", "b", "fb"],
    )


SHORT = (1 << 40) - 1


def _pack(cuts: list[np.ndarray], sig: np.ndarray, sid: np.ndarray, flag: np.ndarray, width: int) -> list[pa.Array]:
    """The rows of each cut as bytes: ``width`` bytes of each signature, a number in the list of sets with the flags,
    the list. Five bytes do for rows of one part; buckets that they confuse are told apart by comparing sets."""
    out: tuple[list, list, list] = ([], [], [])
    for c in cuts:
        sets, number = np.unique(sid[c], return_inverse=True)
        out[0].append(sig[c].view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
        out[1].append((number.astype(np.uint32) * np.uint32(4) + flag[c]).tobytes())
        out[2].append(sets.tobytes())
    return [pa.array(x, pa.binary()) for x in out]


def _unpack(sig: bytes, row: bytes, sid: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    number = np.frombuffer(row, np.uint32)
    wide = np.zeros((len(number), 8), np.uint8)
    if len(number):
        width = len(sig) // len(number)
        wide[:, :width] = np.frombuffer(sig, np.uint8).reshape(-1, width)
    return wide.view(U64).ravel(), np.frombuffer(sid, np.int64)[number >> np.uint32(2)], (number & np.uint32(3)).astype(np.uint8)


def gram_sketch(documents: DataFrame, text: str, ngram: int) -> np.ndarray:
    """How many documents have an n-gram of each of ``SKETCH`` hash classes; sums of one array per task."""
    size = 4096

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(ngram), np.zeros(SKETCH, np.int64)
        for whole in batches:
            for batch in pieces(whole, text):
                found = shingler.sets(batch.column(text))
                if found:
                    total += np.bincount((np.concatenate(found) & U64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        parts = np.arange(SKETCH // size)
        yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array([total[p * size : (p + 1) * size].tobytes() for p in parts], pa.binary())], ["p", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, n in zip(batch.column("p").to_pylist(), batch.column("n").to_pylist(), strict=True):
                sums[p] = sums.get(p, 0) + np.frombuffer(n, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["p", "n"])

    rows = documents.select(text).mapInArrow(trimmed(work), "p long, n binary").repartition("p").mapInArrow(trimmed(add), "p long, n binary").collect()
    out = np.zeros(SKETCH, np.int64)
    for r in rows:
        out[r.p * size : (r.p + 1) * size] = np.frombuffer(bytes(r.n), np.int64)
    return out


def candidates(documents: DataFrame, text: str, ngram: int, bands: Bands, sketch: np.ndarray) -> DataFrame:
    """Members of all buckets tied to centres (``CANDIDATE``): (bucket, centre, its flags, member, its flags).

    A task ties the members it has itself and sends one centre per bucket on, so a bucket that holds a third of
    all rows sends as many rows as there are tasks. What is sent is packed by hash range.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(sketch)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shingler, seen = shared.value, Shingler(ngram), set()
        sigs, sids, flags, held = [], [], [], 0
        names = ["part", "own", "sig", "row", "sid"]

        def packed() -> Iterator[pa.RecordBatch]:
            sig, flag, sid = np.concatenate(sigs), np.concatenate(flags), np.concatenate(sids)
            lead, centre, member = stars(sig, sid, flag)
            part = (((sig[lead] >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            lead, edge = lead[order], np.searchsorted(part[order], np.arange(parts + 1))
            at = np.flatnonzero(np.diff(edge))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array([False] * len(at)), *_pack([lead[edge[p] : edge[p + 1]] for p in at], sig, sid, flag, 5)], names
            )
            for i in range(0, len(member), 1 << 16):  # pairs this task has tied itself: passed on as they are
                c, x = centre[i : i + (1 << 16)], member[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(sid[x[0]]) % parts]), pa.array([True]), *_pack([np.concatenate((c, x))], sig, sid, flag, 8)], names
                )

        for whole in batches:
            for batch in pieces(whole, text):
                for grams in shingler.sets(batch.column(text)):
                    if not len(grams):
                        continue
                    sid = set_id(grams)
                    if sid in seen:
                        continue
                    seen.add(sid)
                    sig, flag = signatures(grams, bands, counts)
                    sigs.append(sig)
                    flags.append(flag)
                    sids.append(np.full(len(sig), sid, np.int64))
                    held += len(sig)
                if held >= FLUSH:
                    yield from packed()
                    sigs, sids, flags, held = [], [], [], 0
        if held:
            yield from packed()

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        for batch in batches:
            for part, own, *raw in zip(*(batch.column(c).to_pylist() for c in ("part", "own", "sig", "row", "sid")), strict=True):
                sig, sid, flag = _unpack(*raw)
                bucket = ((sig >> U64(32)) * U64(parts)) >> U64(32) if own else U64(part)
                sig = (sig & U64(SHORT)) + (bucket << U64(40))  # a bucket's number, whichever way it came
                if own:
                    half = len(sig) // 2
                    yield _candidate_batch(sig, sid, flag, np.arange(half), np.arange(half, 2 * half))
                else:
                    waiting.setdefault(part, []).append((sig, sid, flag))
        for rows in waiting.values():
            sig, sid, flag = (np.concatenate(x) for x in zip(*rows, strict=True))
            _, centre, member = stars(sig, sid, flag)
            if len(member):
                yield _candidate_batch(sig, sid, flag, centre, member)

    sent = documents.select(text).mapInArrow(trimmed(split), "part long, own boolean, sig binary, row binary, sid binary")
    return sent.repartition(parts, "part").mapInArrow(trimmed(tie), CANDIDATE)


def parity_sketch(grams: np.ndarray) -> bytes:
    """One bit per class of n-grams: whether the set has an odd number of them.

    Two sets differ in at least as many n-grams as their sketches differ in bits. The number of classes is a power
    of two of at least four times the size, so that sketches of different sizes can be folded onto each other.
    """
    bits = 1 << max(8, int(4 * len(grams) - 1).bit_length())
    odd = np.bincount((grams & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketch_distance(x: bytes, y: bytes) -> int:
    """In how many bits two sketches differ, the longer folded to the length of the other."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    n = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, n), axis=0) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def digests(documents: DataFrame, doc: str, text: str, ngram: int, wanted: np.ndarray) -> DataFrame:
    """doc_id, sid (null for empty sets), n_shingles, and the parity sketch where a bitmap of set ids has the set.

    Of equal sets in one task only the first carries a sketch.
    """
    rows = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shingler, seen = np.unpackbits(shared.value).astype(bool), Shingler(ngram), set()
        for whole in batches:
            for batch in pieces(whole):
                sets = shingler.sets(batch.column("text"))
                sids = [set_id(g) if len(g) else None for g in sets]
                carry = [s is not None and bool(known[s % BITMAP]) and not (s in seen or seen.add(s)) for s in sids]
                sketches = [parity_sketch(g) if c else None for c, g in zip(carry, sets, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sids, pa.int64()), pa.array([len(g) for g in sets], pa.int64()), pa.array(sketches, pa.binary())],
                    ["doc_id", "sid", "n_shingles", "sketch"],
                )

    return rows.mapInArrow(trimmed(work), f"doc_id {kind}, sid long, n_shingles long, sketch binary")


def near_pairs(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) that sizes and sketches do not prove to be too different."""
    left, right = (sizes.select(F.col("sid").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    names = pairs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, sa, sb = (batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb"))
            near = [
                sketch_distance(x, y) * (100 + percent) <= (m + n) * (100 - percent) for m, n, x, y in zip(na, nb, sa, sb, strict=True)
            ]
            yield batch.select([*names, "na", "nb"]).filter(pa.array(near, pa.bool_()))

    return both.select(*names, "na", "nb", "sa", "sb").mapInArrow(trimmed(work), ", ".join(f"{c} long" for c in [*names, "na", "nb"]))


def sets_of(documents: DataFrame, text: str, ngram: int, wanted: np.ndarray) -> DataFrame:
    """sid and grams of the sets that a bitmap of set ids has, each once."""
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shingler, seen = np.unpackbits(shared.value).astype(bool), Shingler(ngram), set()
        for whole in batches:
            for batch in pieces(whole, text):
                out = []
                for grams in shingler.sets(batch.column(text)):
                    if len(grams) and (s := set_id(grams)) not in seen and known[s % BITMAP]:
                        seen.add(s)
                        out.append((s, grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int64()), pa.array([g for _, g in out], pa.list_(pa.int64()))], ["sid", "grams"])

    rows = documents.select(text).mapInArrow(trimmed(work), "sid long, grams array<long>")
    return rows.groupBy("sid").agg(F.first("grams").alias("grams"))


def verified(pairs: DataFrame, documents: DataFrame, text: str, ngram: int, percent: int) -> DataFrame:
    """The pairs (a, b) out of ``near_pairs`` whose sets are similar, found by intersecting them; stored."""
    ids = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid")))
    sets = sets_of(documents, text, ngram, bitmap(ids.select(F.pmod("sid", F.lit(BITMAP)).alias("k")), "k"))
    near = pairs.select("a", "b", "na", "nb").join(sets.select(F.col("sid").alias("b"), F.col("grams").alias("gb")), "b")
    near = near.join(sets.select(F.col("sid").alias("a"), F.col("grams").alias("ga")), "a")
    common = F.size(F.array_intersect("ga", "gb"))
    return cut_lineage(near.where(common * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b"))


def similar_groups(documents: DataFrame, doc: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest doc_id that links of similarity lead to.

    Documents without words (null, empty, blank) have no shingles and are their own component; a null doc_id is
    never the smallest unless the component has no other. Repeated rows are equal documents and so linked.

    Members are first compared with the centre they share most subsets with, then, if still apart, with their
    other centres, and at last with each other.
    """
    bands = Bands(percent)
    tied = cut_lineage(candidates(documents, text, ngram, bands, gram_sketch(documents, text, ngram)))
    members = tied.select(F.col("a").alias("sid")).unionByName(tied.select(F.col("b").alias("sid")))
    wanted = bitmap(members.select(F.pmod("sid", F.lit(BITMAP)).alias("k")), "k")
    docs = cut_lineage(digests(documents, doc, text, ngram, wanted))
    sizes = docs.where("sketch is not null").groupBy("sid").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    sizes = cut_lineage(sizes)
    looks = ((F.col("fa").bitwiseAND(ACTIVE) + F.col("fb").bitwiseAND(ACTIVE)) > 0) & (F.col("fa").bitwiseAND(F.col("fb")).bitwiseAND(DELETION) == 0)
    pairs = tied.where(looks).groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
    near = cut_lineage(near_pairs(pairs, sizes, percent))
    best = near.groupBy("b").agg(F.max_by(F.struct("a", "na", "nb"), F.struct("times", "a")).alias("x"))
    links = verified(best.select("x.a", "b", "x.na", "x.nb"), documents, text, ngram, percent)
    roots = cut_lineage(connected_components(links))
    done = cut_lineage(best.select("x.a", "b"))
    for step in (lambda: near.join(done, ["a", "b"], "left_anti"), lambda: across_components(tied, roots, sizes, percent)):
        more = cut_lineage(apart(step(), roots))
        if more.take(1):
            links = links.unionByName(verified(more, documents, text, ngram, percent))
            roots = cut_lineage(connected_components(links))
    named = docs.select("doc_id", "n_shingles", "sid").join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left")
    named = named.withColumn("root", F.coalesce("root", "sid"))
    least = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    out = named.join(least.select("root", "least"), "root", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with the roots ra and rb of their components."""
    for c in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")), c, "left").withColumn(f"r{c}", F.coalesce(f"r{c}", c))
    return pairs


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    return with_roots(pairs, roots).where("ra <> rb").drop("ra", "rb")


def across_components(tied: DataFrame, roots: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) of members of one bucket in different components that may be similar.

    Only buckets whose members are in several components count. Buckets with the same smallest centre hold much the
    same members, so they are taken together: each member once, in blocks of about ``BLOCK``. Every two blocks are
    compared in one go by sizes and sketches; only pairs that these do not rule out become rows.
    """
    rooted = with_roots(tied, roots)
    looks = F.max(F.col("fa").bitwiseOR(F.col("fb")).bitwiseAND(ACTIVE)).alias("looks")
    mixed = rooted.groupBy("sig").agg(F.min("a").alias("family"), F.max(F.col("ra") != F.col("rb")).alias("mixed"), looks)
    left = rooted.join(mixed.where("mixed and looks > 0").select("sig", "family"), "sig")
    member = left.select("family", F.col("b").alias("sid"), F.col("rb").alias("r"))
    member = cut_lineage(member.unionByName(left.select("family", F.col("a").alias("sid"), F.col("ra").alias("r"))).distinct())
    blocks = member.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = member.join(blocks, "family").join(sizes, "sid")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sid", "r", "n_shingles", "sketch"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("family", "i", "j")])
            edge = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                now = tuple(keys[:, a].tolist())
                if now != key and held:
                    yield from _near_in_block(held, key, percent)
                    held = []
                key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield from _near_in_block(held, key, percent)

    ordered = rows.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    return ordered.mapInArrow(trimmed(compare), "a long, b long, na long, nb long").distinct()


BLOCK = 1024


def _near_in_block(parts: list[pa.RecordBatch], key: tuple, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of one block, or between two blocks, that sizes and sketches allow."""
    rows = pa.Table.from_batches(parts)
    if rows.num_rows < 2:
        return
    own, sid, root, n = (rows.column(c).to_numpy() for c in ("own", "sid", "r", "n_shingles"))
    if (root == root[0]).all():
        return
    raw = [np.frombuffer(x, np.uint8) for x in rows.column("sketch").to_pylist()]
    width = min(map(len, raw))
    bits = np.stack([np.bitwise_xor.reduce(x.reshape(-1, width), axis=0) for x in raw]).view(np.uint64)
    found = []
    for x in range(rows.num_rows - 1):
        y = np.arange(x + 1, rows.num_rows)
        y = y[root[y] != root[x]]
        if key[1] != key[2]:
            y = y[own[y] != own[x]]
        y = y[np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * percent]
        distance = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
        y = y[distance * (100 + percent) <= (n[y] + n[x]) * (100 - percent)]
        found += [(x, z) for z in y.tolist()]
    if found:
        x, y = np.array(found).T
        x, y = np.where(sid[x] < sid[y], x, y), np.where(sid[x] < sid[y], y, x)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (sid[x], sid[y], n[x], n[y])], ["a", "b", "na", "nb"])


SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sh AS (
  SELECT DISTINCT rid, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 2, 2))) t(i) WHERE len(w) > 0
), sizes AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
common AS (SELECT x.rid AS a, y.rid AS b, count(*) AS n FROM sh x JOIN sh y ON x.s = y.s AND x.rid <> y.rid GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON a = p.rid JOIN sizes q ON b = q.rid WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)
), reach(a, b) AS (SELECT rid, rid FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n), 0)::bigint AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN docs d ON reach.a = d.rid JOIN docs o ON reach.b = o.rid LEFT JOIN sizes ON sizes.rid = d.rid GROUP BY d.rid, d.doc_id
"""
