"""Near-duplicate vectors by a pivot-permutation index.

Vectors link when their labels are equal and their cosine is at least
``threshold``.  The index works in these steps:

1. Equal vectors of a label are one point with a count, so copies cost
   nothing further.
2. Reference points.  The points whose digests are lowest are the pivots, but
   none that links to an earlier one: PIVOTS_PER_ROOT times the square root of
   the number of points, at most MAX_PIVOTS and MAX_NUMBERS, a bounded sample.
3. Description.  A point is described by its NEAREST pivots in order of
   nearness; the other pivots are not kept.
4. Inverted pivot lists.  A point is posted to the lists of its described
   pivots but the last SHARED - 1 by number: two points that share SHARED
   pivots meet in the list of the first one they share.  The lists are those
   of a label; a long list is joined in pairs of chunks.
5. Shared-pivot counts.  Within a list, descriptions are merged pivot by pivot,
   and points that share at least SHARED are candidates.
6. Verification in double precision.  A pair is counted only in the list of
   the first pivot it shares, so no pair leaves its task: a list gives each
   point its number of links there and one of the points it is connected to.

Links are summed by point, and connections are contracted to components.

The index is approximate by its nature: a link is found if its two points
share SHARED of their NEAREST pivots.  A test measures that against all pairs,
just above the threshold; the README has the figures.  No link below the
threshold is given.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component links with nothing, nor does one without a label, and is
its own component; vectors of different lengths don't link; a null vec_id takes
part and counts as larger than all others, and a component of such ids alone
is null; rows that repeat an id are vectors of their own.  Vectors of a length
that few points have may find fewer pivots than they need, and then meet in
one list.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risingtide.llm.common import stored, stored_broadcast, stored_with
from risingtide.llm.jaccard_join import components

THRESHOLD = 0.93
#: Pivots: so many times the square root of the points, and at most so many.
PIVOTS_PER_ROOT, MAX_PIVOTS = 2, 32_768
#: Components of all pivots, at most.
MAX_NUMBERS = 4_000_000
#: Points looked at for each pivot wanted.
SPARE = 2
#: Pivots that describe a point, and how many of them two points must share.
NEAREST, SHARED = 8, 2
#: Points of a list that a task holds on each side.
CHUNK = 2048
_ROWS = 256  # rows whose counts and cosines are held at once


def scaled(v: np.ndarray) -> np.ndarray:
    """The vector times a power of two that brings its largest component near
    one: the cosine is the same, and no square overflows or vanishes."""
    return np.ldexp(v, -np.frexp(np.abs(v).max())[1])


def numbers(raw: bytes, dim: int) -> np.ndarray:
    """The doubles of a vector of single or double precision."""
    return np.frombuffer(raw, "<f4" if len(raw) == 4 * dim else "<f8").astype(np.float64)


POINT = "vec_id {id}, k1 long, k2 long, dim int, label {label}, v binary"


def _points(table: DataFrame) -> DataFrame:
    """vec_id, k1, k2, dim, label, v of every row: the digest of label and
    vector, and the vector as it is, in single or double precision, null for
    vectors that take no part."""
    single = "float>" in table.schema["embedding"].dataType.simpleString()
    fields = [table.schema[c].dataType.simpleString() for c in ("vec_id", "label")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, dims, vectors = [], [], []
            for label, e in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                v = None
                if label is not None and e.is_valid and not e.values.null_count:
                    v = np.asarray(e.values, dtype=np.float64)
                    if not len(v) or not np.isfinite(v).all() or not v.any():
                        v = None
                if v is None:
                    keys.append((None, None))
                    dims.append(None)
                    vectors.append(None)
                    continue
                raw = v.astype("<f4" if single else "<f8").tobytes()
                keys.append(np.frombuffer(xxhash.xxh3_128_digest(f"{label}:".encode() + raw), "<i8").tolist())
                dims.append(len(v))
                vectors.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array(dims, pa.int32()), batch.column(1), pa.array(vectors, pa.binary())],
                names=["vec_id", "k1", "k2", "dim", "label", "v"])

    return table.select("vec_id", "label", "embedding").mapInArrow(run, POINT.format(id=fields[0], label=fields[1]))


def apart(units: np.ndarray, threshold: float, count: int) -> np.ndarray:
    """The first ``count`` rows that do not link to an earlier one taken."""
    taken: list[int] = []
    free = np.ones(len(units), bool)
    for i in range(len(units)):
        if free[i]:
            taken.append(i)
            if len(taken) == count:
                break
            free[i + 1:] &= units[i + 1:] @ units[i] < threshold
    return units[taken]


def pivots_of(points: DataFrame, count: int, threshold: float) -> dict[int, np.ndarray]:
    """dim -> unit vectors of points whose digests are lowest, ``count`` at
    most of each.  A point that links to an earlier pivot is none: members of a
    large group would otherwise each see other pivots of the group as nearest
    and share few."""
    got = points.select("dim", "k1", "k2", "v").orderBy(F.xxhash64("k1", "k2"), "k1", "k2").limit(SPARE * count).collect()
    out: dict[int, list] = {}
    for r in got:
        v = scaled(numbers(r["v"], r["dim"]))
        out.setdefault(r["dim"], []).append(v / np.linalg.norm(v))
    return {d: apart(np.array(vs), threshold, count) for d, vs in out.items()}


def describe(unit: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of the ``nearest`` pivots of each row, in order of
    nearness, ties by number."""
    near = unit @ pivots.T
    k = min(nearest, near.shape[1])
    if k < near.shape[1]:
        first = np.sort(np.argpartition(-near, k - 1, axis=1)[:, :k], axis=1)
    else:
        first = np.broadcast_to(np.arange(k), near.shape)
    order = np.argsort(-np.take_along_axis(near, first, axis=1), axis=1, kind="stable")
    return np.take_along_axis(first, order, axis=1)


def _described(points: DataFrame, pivots, nearest: int) -> DataFrame:
    """``points`` (k1, k2, dim, label, copies, v) with ``near``."""
    names = ["k1", "k2", "dim", "label", "copies", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pivots.value
        for batch in batches:
            raw, dims = batch.column(5).to_pylist(), np.array(batch.column(2).to_pylist(), np.int64)
            near: list = [[]] * len(raw)
            for dim in set(dims.tolist()) & set(own):
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), 4096):
                    some = rows[at:at + 4096]
                    v = np.array([scaled(numbers(raw[i], dim)) for i in some])
                    v /= np.linalg.norm(v, axis=1, keepdims=True)
                    for i, d in zip(some, describe(v, own[dim], nearest).tolist(), strict=True):
                        near[i] = d
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=[*names, "near"])

    kinds = ", ".join(f"{c} {points.schema[c].dataType.simpleString()}" for c in names)
    return points.select(*names).mapInArrow(run, kinds + ", near array<int>")


def shared_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many pivots each row of ``a`` shares with each row of ``b``: the
    lists of the pivots that occur on both sides are merged one by one."""
    out = np.zeros((len(a), len(b)), np.uint8)
    (pa_, ra), (pb, rb) = (_inverted(m) for m in (a, b))
    both, at_a, at_b = np.intersect1d(pa_, pb, assume_unique=True, return_indices=True)
    for i, j in zip(at_a, at_b, strict=True):
        out[np.ix_(ra[i], rb[j])] += 1
    return out


def _inverted(near: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    pivots, starts = np.unique(flat[order], return_index=True)
    return pivots, np.split(order // max(1, near.shape[1]), starts[1:])


def list_links(own: np.ndarray, a: tuple, b: tuple, same: bool, shared: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of a, row of b) of the links of two chunks (unit vectors,
    descriptions) of the list of pivot ``own`` that belong to this list;
    ``same``: the chunks are one, and each pair comes once."""
    (va, na, da), (vb, nb, db) = a, b
    rows, cols = [], []
    for at in range(0, len(va), _ROWS):
        counts = shared_counts(da[at:at + _ROWS], db)
        wanted = counts >= shared
        if same:
            wanted &= np.arange(len(vb)) > np.arange(at, at + len(counts))[:, None]
        if not wanted.any():
            continue
        some = np.flatnonzero(wanted.any(axis=1))
        cos = (va[at + some] @ vb.T) / (na[at + some, None] * nb)
        i, j = np.nonzero(wanted[some] & (cos >= threshold))
        i = some[i] + at
        for part in range(0, len(i), 50_000):  # the first pivot that the pair shares must be this list's
            pi, pj = i[part:part + 50_000], j[part:part + 50_000]
            alike = (da[pi][:, :, None] == db[pj][:, None, :]).any(axis=2)
            first = np.where(alike, da[pi], np.iinfo(np.int32).max).min(axis=1, initial=np.iinfo(np.int32).max)
            mine = (first == own) if own >= 0 else np.ones(len(pi), bool)
            rows.append(pi[mine])
            cols.append(pj[mine])
    none = np.zeros(0, np.int64)
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (none, none)


def least_connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n points the least one that the links (i, j) lead to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


LINK = "k1 long, k2 long, links long, r1 long, r2 long"


def _in_lists(described: DataFrame, shared: int, chunk: int, threshold: float) -> DataFrame:
    """k1, k2, links, r1, r2: of each point with links in a list, how many
    vectors they lead to, and a point it is connected with."""
    posted = F.when(F.size("near") <= shared, F.when(F.size("near") == 0, F.array(F.lit(-1))).otherwise(F.array(F.array_min("near")))
                    ).otherwise(F.slice(F.array_sort("near"), F.lit(1), F.size("near") - shared + 1))
    rows = described.withColumn("pivot", F.explode(posted))
    sizes = described.select("dim", "label", F.explode(posted).alias("pivot")).groupBy("dim", "label", "pivot").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "dim", "label", "pivot", F.expr(f"cast(ceil(n / {chunk}) as int)").alias("chunks"))
    rows = (rows.join(stored_broadcast(sizes, "lists"), ["dim", "label", "pivot"])
            .withColumn("chunk", F.pmod(F.xxhash64("k1", "k2"), "chunks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("dim", "label", "pivot", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                    "chunk", "k1", "k2", "copies", "near", "v"))
    key = ["dim", "label", "pivot", "lo", "hi"]

    def solve(own: list[tuple]) -> tuple:
        pivot, lo, hi = own[0][2:5]
        v = np.array([scaled(numbers(r[10], r[0])) for r in own])
        norm = np.linalg.norm(v, axis=1)
        near = np.array([r[9] for r in own], np.int32).reshape(len(own), -1)
        need = min(shared, near.shape[1])
        copies = np.array([r[8] for r in own], np.int64)
        chunk_of = np.array([r[5] for r in own])
        left = np.flatnonzero(chunk_of == lo)
        right = left if lo == hi else np.flatnonzero(chunk_of == hi)
        i, j = list_links(pivot, (v[left], norm[left], near[left]), (v[right], norm[right], near[right]), lo == hi, need, threshold)
        i, j = left[i], right[j]
        links = np.zeros(len(own), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = least_connected(len(own), i, j)
        some = np.flatnonzero(links)
        k = np.array([r[6:8] for r in own], np.int64)
        return k[some, 0], k[some, 1], links[some], k[root[some], 0], k[root[some], 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = lambda cols: pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in cols], names=["k1", "k2", "links", "r1", "r2"])
        at, own = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:5] != at:
                    if len(own) > 1:
                        yield make(solve(own))
                    at, own = row[:5], []
                own.append(row)  # two chunks at most
        if len(own) > 1:
            yield make(solve(own))

    return rows.repartition(*key).sortWithinPartitions(*key, "k1", "k2").mapInArrow(run, LINK)


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST, shared: int = SHARED,
                    per_root: float = PIVOTS_PER_ROOT, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = table.sparkSession
    rows = stored(_points(table), "vectors")
    points, seen = stored_with(rows.filter("v is not null").groupBy("k1", "k2").agg(
        F.first("dim").alias("dim"), F.first("label").alias("label"), F.count(F.lit(1)).alias("copies"),
        F.first("v").alias("v"), F.min("vec_id").alias("least")), "points", F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim"))
    count = min(MAX_PIVOTS, MAX_NUMBERS // (seen["dim"] or 1), int(np.ceil(per_root * np.sqrt(seen["n"]))))
    pivots = spark.sparkContext.broadcast(pivots_of(points, max(1, count), threshold) if seen["n"] else {})  # SPARE * MAX_NUMBERS numbers at most
    described = stored(_described(points, pivots, nearest), "described")
    found = stored(_in_lists(described, shared, chunk, threshold), "links")
    links = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    node = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    roots = components(found.select(node("k1", "k2").alias("u"), node("r1", "r2").alias("v")))
    rooted = points.select("k1", "k2", "copies", "least").join(links, ["k1", "k2"], "left").join(
        roots.select(F.col("node.a").alias("k1"), F.col("node.b").alias("k2"), "root"), ["k1", "k2"], "left")
    rooted = stored(rooted.select("k1", "k2", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                  F.coalesce("root", node("k1", "k2")).alias("root")).filter("n_links > 0"), "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_point = stored_broadcast(rooted.join(ids, "root").select("k1", "k2", "n_links", "component_id", F.lit(True).alias("linked")),
                                "linked-points")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (rows.select("vec_id", "k1", "k2").join(by_point, ["k1", "k2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))
