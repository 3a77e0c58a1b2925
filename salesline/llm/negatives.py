"""Hard negatives by exact threshold joins: a falling threshold, an index that omits what suffix norms cover.

An anchor's positives are its most similar rows of the same label; its hard negatives are the most similar rows of other
labels whose score lies in a window below a positive's score. Both are found by threshold joins: all rows with a score
of at least t. Passes start high, and only anchors with windows that are not full take part in the next, lower one; the
last pass starts at the windows' own lower ends, so that the result is exact.

In a pass every block of rows is an inverted index over segments of dimensions, those of most energy first. A row is
posted under its leading segments only: the rest is omitted once its norm times an anchor's norm is below every anchor's
threshold. Partial scores are gathered segment by segment, and a row leaves as soon as its partial score and the product
of the norms that remain on both sides cannot reach the anchor's threshold, which also rises to the worst of the rows
that fill its windows already. What is left is scored exactly.

Anchors are sent to the tasks in blocks of ``ANCHOR_BLOCK`` rows; each block's rows are stored before the next begins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesline.llm.common import trimmed
from salesline.session import checkpoint_dir, cut_lineage

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
LEVELS = (0.6, 0.35, 0.15)  # thresholds of positives, as shares of the largest possible score
DEPTHS = (0.1, 0.4, 1.0)  # thresholds of negatives, as depths of their windows
SEGMENT, ROWS, CHUNK, ANCHOR_BLOCK = 8, 4096, 256, 8192
FAR = 1 << 62
EXACT = 1 << 53
ROW_SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = pa.schema([("q", pa.int32()), ("w", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def labelled(vectors: DataFrame, vec: str, embedding: str, label: str) -> DataFrame:
    """id, label and floor(SCALE * x) of the rows that take part."""
    x = F.transform(F.col(embedding), lambda v: v.cast("double"))
    rows = vectors.select(F.col(vec).cast("long").alias("id"), F.col(label).cast("long").alias("label"), x.alias("x"))
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    known = rows.where("id is not null and label is not null and size(x) > 0").where(usable)
    return known.select("id", "label", F.transform("x", lambda v: F.floor(v * SCALE).cast("long")).alias("x"))


def matrix_of(table: pa.Table | pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and components of the rows with ``dim`` components."""
    lists = table.column("x")
    good = np.flatnonzero(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False) == dim)
    kept = table.take(pa.array(good))
    lists = kept.column("x")
    flat = (lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists).flatten()
    x = flat.to_numpy(zero_copy_only=False).reshape(len(good), dim)
    return kept.column("id").to_numpy(zero_copy_only=False), kept.column("label").to_numpy(zero_copy_only=False), x


class Asked:
    """Anchors of one length, and the windows of scores that each wants filled with its ``k`` best rows."""

    def __init__(self, number, ids, labels, x, low, high, k):
        self.number, self.ids, self.labels, self.x, self.low, self.high, self.k = number, ids, labels, x, low, high, k
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.best = [[[] for _ in row] for row in low.tolist()]
        self.need = np.where(low <= high, low, FAR).min(axis=1).astype(np.float64)

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """Rows for anchor i: every window keeps its k best, ties to the smaller id, and the anchor needs no less."""
        need = FAR
        for w, (low, high) in enumerate(zip(self.low[i].tolist(), self.high[i].tolist(), strict=True)):
            if low > high:
                continue
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            if len(inside):
                first = inside[np.lexsort((ids[inside], -scores[inside]))[: self.k]]
                rows = zip((-scores[first]).tolist(), ids[first].tolist(), strict=True)
                self.best[i][w][:] = sorted([*self.best[i][w], *rows])[: self.k]
            full = len(self.best[i][w]) == self.k
            need = min(need, max(low, -self.best[i][w][-1][0]) if full else low)
        self.need[i] = need


class SuffixIndex:
    """One block of rows, posted under leading segments of dimensions.

    The suffix of a row whose norm is below ``floor`` is omitted: with any anchor, it adds less than ``floor`` times
    the anchor's norm.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, floor: float):
        dim = rows.shape[1]
        self.dims = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        x = rows[:, self.dims].astype(np.float64)
        self.starts = list(range(0, dim, SEGMENT))
        self.tails = tail_norms(x, self.starts)
        posted = (self.tails[:, :-1] >= floor).sum(axis=1) if floor > 0 else np.full(len(ids), len(self.starts))
        order = np.argsort(-posted, kind="stable")  # the rows of each posting segment are the first ones
        order = order[: int((posted > 0).sum())]
        self.ids, self.x, self.tails, self.posted, self.at = ids[order], x[order], self.tails[order], posted[order], order

    def candidates(self, q: np.ndarray, allowed: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, row of the index) that may reach the anchor's need, of those allowed."""
        q = q[:, self.dims]
        tails = tail_norms(q, self.starts)
        rows = np.flatnonzero(allowed.any(axis=0))
        may, gathered = allowed[:, rows], np.zeros((len(q), len(rows)))
        for s, start in enumerate(self.starts):
            touched = int(np.searchsorted(-self.posted[rows], -s, side="left"))  # rows posted under this segment
            if not touched:
                break
            segment = slice(start, start + SEGMENT)
            gathered[:, :touched] += q[:, segment] @ self.x[rows[:touched], segment].T
            rest = tails[:, s + 1][:, None] * self.tails[rows[:touched], s + 1][None, :]
            may[:, :touched] &= gathered[:, :touched] + rest >= need[:, None]
            kept = may.any(axis=0)
            if kept.sum() < 0.75 * len(kept):
                rows, may, gathered = rows[kept], may[:, kept], gathered[:, kept]
        i, j = np.nonzero(may)
        return i, rows[j]


def tail_norms(x: np.ndarray, starts: list[int]) -> np.ndarray:
    """Norm of each row from each start on, and 0 for none; a little too large rather than too small."""
    squares = np.add.reduceat(x * x, starts, axis=1) if len(starts) else np.zeros((len(x), 0))
    sums = np.concatenate((squares[:, ::-1].cumsum(axis=1)[:, ::-1], np.zeros((len(x), 1))), axis=1)
    return np.sqrt(sums) * (1 + 1e-9)


def join_block(asked: Asked, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, same: bool) -> None:
    """Give the anchors the rows of one block that reach what they need, of their own label or of others."""
    groups = np.unique(labels).tolist() if same else [None]
    for group in groups:
        mine = np.flatnonzero(asked.labels == group) if same else np.arange(len(asked.ids))
        held = labels == group if same else slice(None)
        if not len(mine):
            continue
        norms = np.maximum(asked.norm[mine], 1e-300)
        index = SuffixIndex(ids[held], rows[held], float((asked.need[mine] / norms).min()))
        block, marks = rows[held][index.at], labels[held][index.at]
        for c in range(0, len(mine), CHUNK):
            at = mine[c : c + CHUNK]
            allowed = asked.ids[at][:, None] != index.ids[None, :]
            if not same:
                allowed &= asked.labels[at][:, None] != marks[None, :]
            i, j = index.candidates(asked.x[at], allowed, asked.need[at])
            if not len(i):
                continue
            scores = np.empty(len(i), np.int64)
            for s in range(0, len(i), 1 << 16):
                part = slice(s, s + (1 << 16))
                scores[part] = np.einsum("ij,ij->i", asked.x[at][i[part]], block[j[part]].astype(np.float64)).astype(np.int64)
            ends = np.searchsorted(i, np.arange(len(at) + 1))
            for n in np.flatnonzero(np.diff(ends)).tolist():
                found = slice(ends[n], ends[n + 1])
                asked.add(int(at[n]), index.ids[j[found]], scores[found])


def _pass(shared, same: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {dim: Asked(*parts) for dim, parts in shared.value.items()}
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                for dim, wanted in asked.items():
                    ids, labels, rows = matrix_of(batch, dim)
                    if not len(ids):
                        continue
                    if float(np.abs(rows).max(initial=0)) * float(np.abs(wanted.x).max(initial=0)) * dim >= EXACT:
                        raise ValueError("components are too large for exact scores")
                    join_block(wanted, ids, labels, rows, same)
        out = [
            (n, w, row, -s)
            for wanted in asked.values()
            for n, windows in zip(wanted.number.tolist(), wanted.best, strict=True)
            for w, best in enumerate(windows)
            for s, row in best
        ]
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND, strict=True)], schema=FOUND)

    return trimmed(work)


def threshold_pass(candidates: DataFrame, anchors: pa.Table, pending: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> list:
    """(anchor, window, id, score) of the ``k`` best rows within each window of the pending anchors, best first."""
    spark = candidates.sparkSession
    lengths = pa.compute.list_value_length(anchors.column("x")).to_numpy()
    sent = {}
    for dim in np.unique(lengths[pending]).tolist():
        at = pending[lengths[pending] == dim]
        ids, labels, x = matrix_of(anchors.take(pa.array(at)), dim)
        sent[dim] = (at, ids, labels, x.astype(np.float64), low[at], high[at], k)
    shared = spark.sparkContext.broadcast(sent)
    found = candidates.mapInArrow(_pass(shared, same), "q int, w int, id long, score long")
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), "id")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).orderBy("q", "w", "n").toArrow()
    shared.destroy()
    return list(zip(*(best.column(c).to_pylist() for c in ("q", "w", "id", "score")), strict=True))


def best_same_label(candidates: DataFrame, anchors: pa.Table, norms: np.ndarray, largest: float, k: int) -> list[list[tuple[int, int]]]:
    """(id, score) of the ``k`` best rows of every anchor's label; thresholds fall until all have k, or all was read."""
    best: list[list] = [[] for _ in norms]
    pending = np.arange(len(norms))
    for level in (*LEVELS, None):
        if not len(pending):
            break
        low = np.full((len(norms), 1), -FAR) if level is None else np.ceil(level * norms * largest).astype(np.int64)[:, None]
        for q in pending.tolist():
            best[q] = []
        for q, _, row, score in threshold_pass(candidates, anchors, pending, low, np.full_like(low, FAR), k, True):
            best[q].append((row, score))
        pending = pending[[len(best[q]) < k for q in pending.tolist()]]
    return best


def best_in_windows(candidates: DataFrame, anchors: pa.Table, low: np.ndarray, high: np.ndarray, k: int) -> dict[tuple[int, int], list]:
    """(id, score) of the ``k`` best rows of other labels in every window of every anchor (none if low > high)."""
    best: dict[tuple[int, int], list] = {}
    open_ = low <= high
    for depth in DEPTHS:
        pending = np.flatnonzero(open_.any(axis=1))
        if not len(pending):
            break
        start = low if depth >= 1 else np.maximum(low, high - ((high - low) * depth).astype(np.int64))
        start = np.where(open_, start, 1)
        end = np.where(open_, high, 0)
        found: dict[tuple[int, int], list] = {}
        for q, w, row, score in threshold_pass(candidates, anchors, pending, start, end, k, False):
            found.setdefault((q, w), []).append((row, score))
        best |= found
        for q, w in np.argwhere(open_).tolist():
            if len(found.get((q, w), ())) == k or start[q, w] <= low[q, w]:
                open_[q, w] = False
    return best


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    vec: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """For every anchor and each of its positives, the best rows of other labels that score ``low`` to ``high`` percent
    of the positive's score: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Positives are the ``positives`` rows of the anchor's label and of another id with the highest integer inner product;
    ties go to the smaller id, fewer rows give fewer. A negative score of a positive leaves an empty window. Rows without
    id, label or components, and those with a null or non-finite component, take no part; vectors of another length than the
    anchor's have no inner product with it. Repeated rows are candidates
    each, repeated anchors count once. An empty table gives no rows; other columns are not used.
    """
    spark = vectors.sparkSession
    candidates = cut_lineage(labelled(vectors, vec, embedding, label))
    asked = cut_lineage(labelled(anchors, vec, embedding, label).distinct())
    squares = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    largest = float(candidates.agg(F.max(F.sqrt(squares))).first()[0] or 0.0)
    blocks = max(1, -(-asked.count() // anchor_block))
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    spark.createDataFrame([], ROW_SCHEMA).write.parquet(path)
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("id", "label", "x"), F.lit(blocks)) == b).orderBy("id", "label", "x").toArrow()
        if not block.num_rows:
            continue
        norms = np.array([np.linalg.norm(np.array(x, np.float64)) for x in block.column("x").to_pylist()])
        best = best_same_label(candidates, block, norms, largest, positives)
        windows = np.ones((len(best), positives), np.int64), np.zeros((len(best), positives), np.int64)
        for q, rows in enumerate(best):
            for w, (_, score) in enumerate(rows):
                windows[0][q, w], windows[1][q, w] = -(-low * score // 100), high * score // 100
        found = best_in_windows(candidates, block, *windows, negatives)
        ids = block.column("id").to_pylist()
        rows = [
            (ids[q], best[q][w][0], rank, row, best[q][w][1], score)
            for (q, w), kept in found.items()
            for rank, (row, score) in enumerate(kept, 1)
        ]
        if rows:
            spark.createDataFrame(rows, ROW_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(ROW_SCHEMA).parquet(path)


SQL = """
WITH v AS (
  SELECT vec_id AS id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::bigint AS label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.id AS anchor, c.id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.x, c.x), lambda p: p[1] * p[2]))::bigint AS score
  FROM v a JOIN v c ON a.id % 50 = 0 AND a.id <> c.id AND len(a.x) = len(c.x)
), positives AS (
  SELECT anchor, id, score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
)
SELECT p.anchor AS anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id)::int AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
