"""Exact top-k by inner product with a pivot table.

Inner products become distances: with M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x. Every vector's distances to a fixed number of pivots are computed once; for a query,
max over pivots |d(q, p) - d(x, p)| bounds its distance to x from below, hence the product from above. Candidates are
evaluated in the order of that bound until it rules out all that follow.

Queries and candidates are dealt into blocks of bounded size; each pair of blocks is a task of its own, and a window keeps
the best of a query's partial lists (k rows per block). Nothing is broadcast but the pivots.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no part; shorter vectors count as filled
up with zeros; a row is no candidate of its own vec_id; a repeated query row is one query, repeated candidates stay apart;
ties go to the smaller vec_id; an empty table gives no rows; further columns take no part.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

PIVOTS, SAMPLE = 16, 512
CANDIDATES, QUERIES = 16_384, 1024


def quantized(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and v: floor(scale * x) of every component, for the rows that take part."""
    e = F.col("embedding")
    sound = e.isNotNull() & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(sound & F.col("vec_id").isNotNull())
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(scale * x.cast("double"))).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths(), np.int64)
    out = np.zeros((len(column), dim), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(column.flatten(), np.int64)
    return out


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """n rows of the sample, each the farthest from those before."""
    if not len(sample):
        return sample
    x = sample.astype(float)
    chosen = [int(np.argmax((x**2).sum(1)))]
    far = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)):
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(x: np.ndarray, lifted: np.ndarray, pivots: np.ndarray, pivot_lift: np.ndarray) -> np.ndarray:
    """Of (x, lifted) to every (pivot, pivot_lift)."""
    a, b = x.astype(float), pivots.astype(float)
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T + (lifted[:, None] - pivot_lift[None]) ** 2
    return np.sqrt(np.maximum(squares, 0))


def best(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, pivots: np.ndarray, top: int, k: int) -> tuple[list, int]:
    """[(query, ids, scores)] of each query's k best among x, and how many products were computed. top: the largest |x|^2."""
    norms = (x.astype(float) ** 2).sum(1)
    lift = np.sqrt(np.maximum(top - norms, 0))
    pivot_lift = np.sqrt(np.maximum(top - (pivots.astype(float) ** 2).sum(1), 0))
    to_x = _distances(x, lift, pivots, pivot_lift).T.astype(np.float32)
    to_q = _distances(queries, np.zeros(len(queries)), pivots, pivot_lift)
    biggest = max(1.0, float(np.abs(x).max(initial=0)) * float(np.abs(queries).max(initial=0)) * x.shape[1])
    kind = np.float32 if biggest < 2**24 else np.float64 if biggest < 2**53 else np.int64
    rows, asked = x.astype(kind), queries.astype(kind)
    out, evaluated = [], 0
    for q in range(len(queries)):
        bound = np.zeros(len(x), np.float32)
        for p in range(len(pivots)):
            np.maximum(bound, np.abs(to_x[p] - np.float32(to_q[q, p])), out=bound)
        size = float((queries[q].astype(float) ** 2).sum()) + top
        order = np.argsort(bound)
        # products rounded up, with room for the errors of 32-bit distances
        room = 1e-5 * size + 1
        limits = (size - np.maximum(bound[order].astype(float) - 1e-5 * np.sqrt(size), 0) ** 2) / 2 + room
        found_ids, found = np.zeros(0, np.int64), np.zeros(0, kind)
        lo, step = 0, 512
        while lo < len(order):
            if len(found) >= k and limits[lo] < found[-1]:
                break
            part = order[lo : lo + step]
            evaluated += len(part)
            scores, names = rows[part] @ asked[q], ids[part]
            if len(found) >= k:
                keep = scores >= found[-1]
                scores, names = scores[keep], names[keep]
            keep = names != query_ids[q]
            found, found_ids = np.concatenate([found, scores[keep]]), np.concatenate([found_ids, names[keep]])
            first = np.lexsort((found_ids, -found))[:k]
            found, found_ids = found[first], found_ids[first]
            lo, step = lo + step, step * 2
        out.append((int(query_ids[q]), found_ids, found.astype(np.int64)))
    return out, evaluated


def _pair(queries: pa.Table, candidates: pa.Table, pivots: np.ndarray, top: int, k: int) -> pa.Table:
    dim = pivots.shape[1]
    got, _ = best(_matrix(queries["v"], dim), np.asarray(queries["vec_id"]), _matrix(candidates["v"], dim), np.asarray(candidates["vec_id"]), pivots, top, k) if len(queries) and len(candidates) else ([], 0)
    return pa.table({
        "query_id": pa.array(np.concatenate([np.full(len(i), q) for q, i, _ in got] or [np.zeros(0)]).astype(np.int64)),
        "vec_id": pa.array(np.concatenate([i for _, i, _ in got] or [np.zeros(0, np.int64)])),
        "score": pa.array(np.concatenate([s for _, _, s in got] or [np.zeros(0, np.int64)])),
    })


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, pivots: int = PIVOTS) -> DataFrame:
    """vectors (vec_id, v) to query_id, rank, vec_id, score: each query row's k largest products with all other rows."""
    vectors = stored(vectors)
    asked = vectors.filter(is_query).dropDuplicates(["vec_id", "v"])
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, dim, top = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm)).first()
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()  # at most SAMPLE rows
    table = np.zeros((len(sample), dim or 0), np.int64)
    for i, r in enumerate(sample):
        table[i, : len(r["v"])] = r["v"]
    blocks, parts = max(1, -(-n // CANDIDATES)), max(1, -(-asked.count() // QUERIES))
    deal = lambda rows, own, n_own, other, n_other: rows.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n_own))).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
    left = deal(asked, "part", parts, "block", blocks).select(F.col("part").cast("int"), F.col("block").cast("int"), "vec_id", "v")
    right = deal(vectors, "block", blocks, "part", parts).select(F.col("part").cast("int"), F.col("block").cast("int"), "vec_id", "v")
    found = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(
        partial(_pair, pivots=spread_pivots(table, pivots), top=int(top or 0), k=k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
