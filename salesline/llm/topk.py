"""Exact top-k inner product search with an impact-ordered index, score at a time.

Every block of candidate rows is an inverted index: a posting is (dimension, row) with the row's component as its
impact. Impacts are quantised by dropping ``SHIFT`` low bits, and postings of equal quantised size form a segment.
Segments are taken for all queries of a block in descending order of that size. After each one, a row's score is at
most what it has gathered plus what the segments left could add; a row that cannot reach the k-th best score proven so
far is out. When the rows still in are few, or no segment is left, they are rescored exactly. Nothing is dropped without
this proof, so the result is exact.

Queries are sent to the tasks in blocks of bounded size (``QUERY_BLOCK`` rows); more queries take more passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256
SHIFT = 4
LEVELS = 3
ROWS, QUERY_BLOCK, QUERY_CHUNK = 4096, 16_384, 512
FEW = 0.02
EXACT = 1 << 53


def quantised(vectors: DataFrame, vec: str, embedding: str) -> DataFrame:
    """id and floor(SCALE * x) of the rows that take part: no null or non-finite component, id present."""
    x = F.transform(F.col(embedding), lambda v: v.cast("double"))
    rows = vectors.select(F.col(vec).cast("long").alias("id"), x.alias("x")).where("id is not null and x is not null")
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.where(usable).select("id", F.transform("x", lambda v: F.floor(v * SCALE).cast("long")).alias("x"))


def matrix_of(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components of the rows with ``dim`` components."""
    lists = batch.column("x")
    good = np.flatnonzero(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False) == dim)
    kept = lists.take(pa.array(good))
    flat = kept.flatten().to_numpy(zero_copy_only=False)
    return batch.column("id").to_numpy(zero_copy_only=False)[good], flat.reshape(len(good), dim)


class ImpactIndex:
    """The segments of one block of rows, largest quantised impact first."""

    def __init__(self, rows: np.ndarray, shift: int, levels: int):
        self.rows = rows
        size = np.abs(rows) >> shift
        top = int(size.max(initial=0)) + 1
        # bounds of the segments: the quantised sizes of [low, high) make one
        edges = sorted({0, *(int(top * i / levels) for i in range(levels + 1)), top}, reverse=True)
        self.segments = []
        for high, low in zip(edges[:-1], edges[1:], strict=True):
            inside = (size >= low) & (size < high)
            self.segments.append((np.where(inside, rows, 0).astype(np.float64), float((low << shift) - 1 if low else 0)))


def best_of(index: ImpactIndex, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """(query, its k best rows of the block as (-score, id)) for queries with rows that may be among their k best.

    ``floor`` holds the k-th best exact score that each query has from earlier blocks.
    """
    n, m = len(ids), len(queries)
    q = queries.astype(np.float64)
    weight = np.abs(q).sum(axis=1)
    alive = np.ones((m, n), bool)
    alive[own[:, None] == ids[None, :]] = False
    score = np.zeros((m, n))
    need = floor.copy()
    for segment, left in index.segments:
        score += q @ segment.T
        rest = (weight * left)[:, None]  # a component not met yet is at most ``left`` in size
        if n > k:  # the k-th largest sure score of the block is a proven floor
            sure = np.where(alive, score - rest, -np.inf)
            need = np.maximum(need, np.partition(sure, n - k, axis=1)[:, n - k])
        alive &= score + rest >= need[:, None]
        if alive.mean() <= FEW:
            break
    found = []
    for i in np.flatnonzero(alive.any(axis=1)).tolist():
        at = np.flatnonzero(alive[i])
        exact = index.rows[at] @ queries[i]
        best = np.lexsort((ids[at], -exact))[:k]
        found.append((i, list(zip((-exact[best]).tolist(), ids[at[best]].tolist(), strict=True))))
    return found


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, vec: str = "vec_id", embedding: str = "embedding", query_block: int = QUERY_BLOCK
) -> DataFrame:
    """The ``k`` rows of largest integer inner product for every query row: query_id, rank, vec_id, score.

    Candidates are all rows with another id than the query's; ties go to the smaller id; fewer candidates give
    fewer rows. Vectors that are null or hold a null or non-finite component take no part, rows of another
    length than the query have no inner product with it, and repeated rows are candidates each. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    candidates, asked = quantised(vectors, vec, embedding), quantised(queries, vec, embedding)
    asked = asked.distinct()
    blocks = max(1, -(-asked.count() // query_block))
    found = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id", "x"), F.lit(blocks)) == b).toArrow() if blocks > 1 else asked.toArrow()
        if not rows.num_rows:
            continue
        part = candidates.mapInArrow(_search(spark.sparkContext.broadcast(rows), k), "query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search(shared, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        lengths = pa.compute.list_value_length(table.column("x")).to_numpy()
        by_dim = {}
        for dim in sorted(set(lengths.tolist())):
            if dim:
                ids, x = matrix_of(table.filter(pa.array(lengths == dim)).combine_chunks().to_batches()[0], dim)
                by_dim[dim] = (ids, x, {i: [] for i in range(len(ids))}, np.full(len(ids), -np.inf))
        zero = set(table.filter(pa.array(lengths == 0)).column("id").to_pylist())
        nothing: dict[int, list] = {q: [] for q in zero}
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                for dim, (qid, q, kept, floor) in by_dim.items():
                    ids, rows = matrix_of(batch, dim)
                    if not len(ids):
                        continue
                    largest = float(np.abs(rows).max()) * float(np.abs(q).max()) * dim
                    if largest >= EXACT:
                        raise ValueError("components are too large for exact scores")
                    index = ImpactIndex(rows, SHIFT, LEVELS)
                    for c in range(0, len(qid), QUERY_CHUNK):
                        chunk = slice(c, c + QUERY_CHUNK)
                        for i, rows_found in best_of(index, ids, q[chunk], qid[chunk], floor[chunk], k):
                            best = sorted([*kept[c + i], *rows_found])[:k]
                            kept[c + i] = best
                            if len(best) == k:
                                floor[c + i] = -best[-1][0]
                if nothing:
                    size = pa.compute.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
                    empty = batch.column("id").to_numpy(zero_copy_only=False)[size == 0]
                    for query in nothing:
                        nothing[query] = sorted([*nothing[query], *((0, int(i)) for i in empty if i != query)])[:k]
        out = [(int(qid[i]), v, int(-s)) for qid, _, kept, _ in by_dim.values() for i, best in kept.items() for s, v in best]
        out += [(query, v, 0) for query, best in nothing.items() for _, v in best]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return work


SQL = """
WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.id AS query_id, c.id AS vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint AS score
  FROM v q JOIN v c ON q.id % 50 = 0 AND q.id <> c.id AND len(q.x) = len(c.x)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::int AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
