"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets a global row number 0..N-1 that depends on the rows alone, not
on how they are dealt over tasks.  A keyed permutation of [0, N) turns the
number into a position; position mod n_shards is the shard and position div
n_shards the slot, so both can be computed from the row number and back
without looking at any other row.  Shard sizes differ by one row at most.

Defined results: a null text counts as empty; a null doc_id is numbered like
any other value; rows that agree in doc_id, size and checksum are copies of
each other and take consecutive row numbers (which copy takes which makes no
difference); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risingtide.llm.common import stored, texts

ROUNDS = 8
#: Hash buckets that number their rows independently; the driver sees one
#: count for each of them, whatever the number of rows.
NUMBER_BUCKETS = 1024
#: Copies of one row are numbered in runs of so many.
COPY_RUN = 65_536


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class FeistelShuffle:
    """A keyed permutation of 0..n-1.

    Numbers are split as left * side + right with side = ceil(sqrt(n)); each
    round adds a keyed hash of one half to the other, mod side.  The network
    permutes [0, side**2); a result outside [0, n) is put through it again
    until it falls inside (cycle walking), which happens for less than
    2 / side of the numbers.
    """

    def __init__(self, n: int, seed: int = 0):
        self.n, self.side = n, np.uint64(max(1, math.isqrt(max(0, n - 1)) + 1))
        with np.errstate(over="ignore"):
            steps = (np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                     + np.uint64(seed & (2**64 - 1)))
            self.keys = _mix(steps)

    def _through(self, x: np.ndarray) -> np.ndarray:
        left, right = x // self.side, x % self.side
        for k in self.keys:
            left, right = right, (left + _mix(right ^ k) % self.side) % self.side
        return left * self.side + right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x // self.side, x % self.side
        for k in self.keys[::-1]:
            left, right = (right + self.side - _mix(left ^ k) % self.side) % self.side, left
        return left * self.side + right

    def _walk(self, step, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = step(np.asarray(x, dtype=np.int64).astype(np.uint64))
            n = np.uint64(self.n)
            while (outside := np.flatnonzero(out >= n)).size:
                out[outside] = step(out[outside])
        return out.astype(np.int64)

    def position(self, row: np.ndarray) -> np.ndarray:
        return self._walk(self._through, row)

    def row(self, position: np.ndarray) -> np.ndarray:
        return self._walk(self._back, position)


def locate(n_rows: int, n_shards: int, row, seed: int = 0):
    """(shard, slot) of global row numbers, without reading any table."""
    p = FeistelShuffle(n_rows, seed).position(np.atleast_1d(row))
    return p % n_shards, p // n_shards


def row_at(n_rows: int, n_shards: int, shard, slot, seed: int = 0):
    """The global row number that lies in (shard, slot)."""
    p = np.atleast_1d(slot).astype(np.int64) * n_shards + np.atleast_1d(shard)
    return FeistelShuffle(n_rows, seed).row(p)


def numbered(rows: DataFrame, buckets: int = NUMBER_BUCKETS) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` (global, from 0), and their count.

    A row's bucket is a hash of its whole content; inside a bucket rows are
    ranked by their content.  Copies are counted before the shuffle, so a row
    that makes up a third of the table is one row of its bucket.
    """
    cols = rows.columns
    kept = stored(rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
                  .withColumn("_b", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")),
                  "row-counts")
    sizes = {r["_b"]: r["n"] for r in kept.groupBy("_b").agg(F.sum("_n").alias("n")).collect()}
    starts, total = [], 0
    for b in sorted(sizes):
        starts.append((b, total))
        total += sizes[b]
    spark = rows.sparkSession
    offsets = F.broadcast(spark.createDataFrame(starts, "_b int, _start long"))
    before = (Window.partitionBy("_b").orderBy(*[F.col(c).asc_nulls_first() for c in cols])
              .rowsBetween(Window.unboundedPreceding, -1))
    first = (kept.join(offsets, "_b")
             .withColumn("_first", F.col("_start") + F.coalesce(F.sum("_n").over(before), F.lit(0))))
    runs = first.withColumn("_run", F.explode(F.expr(f"sequence(0L, _n - 1, {COPY_RUN}L)")))
    out = runs.select(*cols, F.explode(F.expr(
        f"sequence(_first + _run, _first + least(_run + {COPY_RUN}L, _n) - 1)")).alias("row_number"))
    return out, total


def shard(docs: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of every row."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = texts(docs).select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"))
    rows, total = numbered(rows)

    @F.pandas_udf("long")
    def position(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shuffle = FeistelShuffle(total, seed)
        for part in parts:
            yield pd.Series(shuffle.position(part.to_numpy()))

    at = rows.withColumn("_p", position("row_number"))
    return at.select("doc_id", "size", "text_crc32", "row_number",
                     F.pmod("_p", F.lit(n_shards)).cast("int").alias("shard"),
                     F.expr(f"_p div {n_shards}").alias("slot"))
