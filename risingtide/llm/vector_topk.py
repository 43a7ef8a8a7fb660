"""Exact top-k inner-product search with multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... equal segments; each segment keeps its mean
and standard deviation.  For a query q and a vector v, Cauchy-Schwarz on every
segment s of length n_s gives

    <q, v>  <=  sum_s n_s * (mean_q * mean_v + dev_q * dev_v),

the inner-product form of the lower bound on a distance: with
|q - v|^2 = |q|^2 + |v|^2 - 2<q, v>, a larger bound on one is a smaller one on
the other.  Bounds are tried coarse to fine; a pair is dropped once its bound
falls below the query's k-th best exact score so far, and the exact integer
inner product is computed for the survivors, so the result is exact.

Queries meet candidates block by block: query blocks x candidate blocks, both
of bounded size, each pair of blocks one task; the partial results of a query
are merged by a ranking.  Equal vectors of a block are searched once and keep
their k + 1 smallest ids (more can't enter a result that excludes one id).

Integer vectors travel as doubles, which hold every component exactly.  As
long as no product of two of a block's vectors can reach 2**53, scores are
sums of doubles and exact; wider vectors, which no real embedding comes near,
are scored one by one in Python's unbounded integers.

Defined results: a vector that is null, or holds a null or non-finite
component, takes no part; nor does a row without an id.  Rows that repeat id
and vector count once.  Vectors are compared with those of their own length.
A score that no long holds is given as the nearest long, and such scores tie.
Ties go to the smaller id.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import sys
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risingtide.llm.common import stored

SCALE = 256
#: Rows of a block; a task holds one block of each side.
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16_384
#: Query rows whose bounds are held at once.
QUERY_STEP = 128


def integer_vectors(table: DataFrame) -> DataFrame:
    """vec_id long, v array<double> of integers: the different rows that take
    part."""
    e = F.col("embedding")
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    most = F.lit(sys.float_info.max)

    def scaled(x):  # beyond 2**52 a double is an integer, and a long may not hold it
        y = F.greatest(-most, F.least(most, x.cast("double") * SCALE))
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    return (table.select(F.col("vec_id").cast("long").alias("vec_id"), e)
            .filter(F.col("vec_id").isNotNull() & e.isNotNull() & good)
            .select("vec_id", F.transform(e, scaled).alias("v")).distinct())


def segment_bounds(dim: int) -> list[np.ndarray]:
    """Start positions of the segments at each resolution, coarse to fine,
    down to segments of about two components."""
    counts = [max(1, dim // 2)]
    while counts[-1] > 1:
        counts.append(max(1, counts[-1] // 4))
    return [np.unique(np.arange(parts) * dim // parts) for parts in reversed(counts)]


def segment_statistics(m: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(n) * mean and sqrt(n) * deviation of every row's segments."""
    sizes = np.diff(np.append(starts, m.shape[1])).astype(np.float64)
    x = m.astype(np.float64)
    mean = np.add.reduceat(x, starts, axis=1) / sizes
    var = np.add.reduceat(x * x, starts, axis=1) / sizes - mean * mean
    return mean * np.sqrt(sizes), np.sqrt(np.maximum(var, 0)) * np.sqrt(sizes)


def is_wide(m: np.ndarray) -> np.ndarray:
    """Rows with a component so large that sums of products may pass 2**53."""
    return np.abs(m).max(axis=1, initial=0) >= np.sqrt(2.0**53 / max(1, m.shape[1]))


def search_wide(q_ids, q, c_ids, c, k: int) -> pd.DataFrame:
    """``search_block`` for any components, by unbounded integers."""
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    numbers = [([int(x) for x in v], int(i)) for v, i in zip(c.tolist(), c_ids, strict=True)]
    found = []
    for own, v in zip(q_ids.tolist(), q.tolist(), strict=True):
        v = [int(x) for x in v]
        best = heapq.nsmallest(k, {(-min(max(sum(map(mul, v, w)), low), high), i) for w, i in numbers if i != own})
        found += [(own, i, -s) for s, i in best]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def search(q_ids, q, c_ids, c, k: int) -> pd.DataFrame:
    """At least the top k of the rows of ``c`` for each row of ``q``."""
    wide_q, wide_c = is_wide(q), is_wide(c)
    parts = [search_block(q_ids[~wide_q], q[~wide_q], c_ids[~wide_c], c[~wide_c], k)]
    if wide_q.any():
        parts.append(search_wide(q_ids[wide_q], q[wide_q], c_ids, c, k))
    if wide_c.any():
        parts.append(search_wide(q_ids[~wide_q], q[~wide_q], c_ids[wide_c], c[wide_c], k))
    return pd.concat([p for p in parts if len(p)] or parts[:1])


def search_block(q_ids, q, c_ids, c, k: int) -> pd.DataFrame:
    """Exact top k of the rows of ``c`` for each row of ``q``, none wide."""
    if not len(q) or not len(c):
        return pd.DataFrame({x: pd.Series(dtype="int64") for x in ("query_id", "vec_id", "score")})
    order = np.lexsort((c_ids, *c.T[::-1]))  # equal vectors side by side, ids ascending
    c, c_ids = c[order], c_ids[order]
    fresh = np.ones(len(c), bool)
    fresh[1:] = (c[1:] != c[:-1]).any(axis=1) if c.shape[1] else False
    firsts = np.flatnonzero(fresh)
    ends = np.append(firsts[1:], len(c))
    vectors = c[firsts]
    levels = segment_bounds(c.shape[1]) if c.shape[1] else []
    c_stats = [np.hstack(segment_statistics(vectors, s)) for s in levels]
    q_stats = [np.hstack(segment_statistics(q, s)) for s in levels]
    found = []
    few = min(k + 1, len(vectors))  # the query's own vector may be among them

    def score(qi, vi):
        return np.einsum("ij,ij->i", q[qi], vectors[vi]).astype(np.int64)

    for at in range(0, len(q), QUERY_STEP):
        rows = np.arange(at, min(at + QUERY_STEP, len(q)))
        if levels:
            bound = q_stats[0][rows] @ c_stats[0].T
            best = np.argpartition(-bound, few - 1, axis=1)[:, :few]
            kth = np.full(len(rows), np.iinfo(np.int64).min)
            if few > k:
                kth = score(np.repeat(rows, few), best.ravel()).reshape(len(rows), few).min(axis=1)
            slack = 1 + 1e-9 * np.abs(bound).max(initial=0)
            alive = bound >= (kth - slack)[:, None]
            for fine_q, fine_c in zip(q_stats[1:], c_stats[1:], strict=True):
                left = np.flatnonzero(alive.any(axis=0))  # vectors that some query still wants
                bound = fine_q[rows] @ fine_c[left].T
                if few > k:  # the best by the finer bound lift the k-th exact score
                    best = np.argpartition(-bound, min(few, len(left)) - 1, axis=1)[:, :few]
                    if len(left) >= few:
                        exact = score(np.repeat(rows, few), left[best].ravel()).reshape(len(rows), few).min(axis=1)
                        kth = np.maximum(kth, exact)
                alive[:, left] &= bound >= (kth - slack)[:, None]
        else:
            alive, kth = np.ones((len(rows), len(vectors)), bool), np.full(len(rows), np.iinfo(np.int64).min)
        # Exact products of the survivors, in one matrix product over the
        # vectors that any query of the step still wants.
        left = np.flatnonzero(alive.any(axis=0))
        alive = alive[:, left]
        exact = q[rows] @ vectors[left].T
        if few > k and len(left) > k:
            own = np.where(alive, exact, -(2.0**53))
            kth = np.maximum(kth, -np.partition(-own, k, axis=1)[:, k].astype(np.int64))
        qi, vi = np.nonzero(alive & (exact >= kth[:, None]))
        scores = exact[qi, vi].astype(np.int64)
        vi = left[vi]
        order = np.lexsort((-scores, qi))
        qi, vi, scores = qi[order], vi[order], scores[order]
        cut = np.searchsorted(qi, np.arange(len(rows) + 1))
        for j, row in enumerate(rows):
            pairs, vs, got = set(), vi[cut[j]:cut[j + 1]], scores[cut[j]:cut[j + 1]]
            for v, s in zip(vs, got, strict=True):
                if len(pairs) >= k and s < low:
                    break
                ids = np.unique(c_ids[firsts[v]:ends[v]])[:k + 1]
                pairs.update((int(s), -int(i)) for i in ids if i != q_ids[row])
                low = s  # scores come in falling order
            found += [(q_ids[row], -i, s) for s, i in sorted(pairs, reverse=True)[:k]]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def topk(table: DataFrame, k: int, every: int, query_block: int = QUERY_BLOCK,
         candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by
    ``every``, the ``k`` other rows of highest inner product."""
    vectors = stored(integer_vectors(table), "vectors")
    is_query = F.col("vec_id") % every == 0
    n, nq = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    qb, cb = max(1, -(-nq // query_block)), max(1, -(-n // candidate_block))
    # By id and vector: rows that share an id are dealt out too.
    by_row = lambda blocks: F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    queries = (vectors.filter(is_query).withColumn("qb", by_row(qb))
               .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cb - 1)))))
    candidates = (vectors.withColumn("cb", by_row(cb))
                  .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))))
    key = ["qb", "cb", F.size("v").alias("dim")]

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        dense = lambda t: np.array(t["v"].tolist(), dtype=np.float64).reshape(len(t), -1)
        return search(left["vec_id"].to_numpy(), dense(left), right["vec_id"].to_numpy(), dense(right), k)

    parts = (queries.groupBy(*key).cogroup(candidates.groupBy(*key))
             .applyInPandas(block, "query_id long, vec_id long, score long").distinct())
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (parts.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
