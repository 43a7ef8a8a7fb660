"""Exact Jaccard self-join of documents by metric-space regions.

The Jaccard distance of two shingle sets is a metric, and documents link when
it is at most RADIUS = 1/4.  Equal sets are one point.  The join runs in these
steps; every one is exact.

1. Pivots and regions.  Documents at distance 1 from a pivot say nothing
   about each other, so a pivot must be near.  Sorted from rare to common, the
   first quarter of the shingles of two linked documents share one (of the
   smaller document it is in the first seventh).  The documents that share
   such a shingle, cut where sizes jump by more than a link allows, form a
   region around the first of them, its pivot; a document lies in the regions
   of all its pivots, so linked documents share a region.  Rare to common is
   by a fixed-size count sketch of all shingles, which keeps passages that
   many documents share from making regions; any order, even a bad one, gives
   the same links.
2. Distance to the pivot.  Counts of shingles per hash range embed the sets
   so that distances only shrink; a bound from them settles most pairs, the
   others are compared in full.  Large regions are dealt over several tasks,
   each with a copy of the pivot.  Within RADIUS a document links to the
   pivot; links among such documents add nothing to a component and are never
   enumerated.
3. Windows.  What lies outside the pivot's ball is joined on, with those of
   the ball that the triangle inequality lets come near: |d(x, p) - d(y, p)|
   must not exceed RADIUS.
4. Recursion.  Such a rest takes pivots of its own, documents that no earlier
   pivot may link to, and compares them with all that the windows and the
   embedding leave; what is in one component already needs no comparison.
   Documents that were no pivots are joined with each other after that.  A
   rest that is too large for a task is joined in pairs of chunks.

Links between sets are contracted to components, star by star.

Words are runs without ASCII blanks, A-Z lower-cased.  Shingles are told apart
by 64-bit hashes and sets by 128-bit digests.

Defined results: a document without words (or text) has an empty set and
links with nothing; one with fewer words than a shingle has the sequence of
all its words as its only shingle.  Repeated rows and equal texts are one
group.  A null doc_id takes part and counts as larger than all others; a
group with null ids alone has a null component.  An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risingtide.llm.common import as_row, from_row, stored, stored_broadcast, stored_with, texts

WORDS = 5
#: Linked at an intersection of at least NUM / DEN of the union.
NUM, DEN = 75, 100
RADIUS = 1 - NUM / DEN
SKETCH = 1 << 20
#: Sets whose shingles a task remembers not to emit again.
SEEN = 100_000
#: Documents of a region that one task compares with the pivot.
REGION_PART = 4000
#: Documents, and shingles of documents, of a rest that are joined in one task, their embeddings in memory.
CHUNK, CHUNK_SHINGLES = 10_000, 8_000_000
#: Shingles per count of the embedding, about.
PER_COUNT = 1
_ROUGH = 1e-9  # windows are widened by more than any rounding


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, ascending."""
    words = (text or "").encode().lower().split()  # bytes: ASCII only, both
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        k = min(WORDS, len(h))
        out = np.full(len(h) - k + 1, np.uint64(k))
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i]
        out = _mix(out)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128-bit digest of a set, as two signed longs."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(s), "<i8").tolist())


def common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def linked(inter: int, na: int, nb: int) -> bool:
    return DEN * inter >= NUM * (na + nb - inter) and inter > 0


def embedding(s: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles in equal ranges of hashes, 255 for more."""
    bits = min(20, max(6, int(np.ceil(np.log2(max(1, len(s) / PER_COUNT))))))
    return np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def _counts(raw: bytes) -> np.ndarray:
    c = np.frombuffer(raw, np.uint8).astype(np.int64)
    c[c == 255] = 1 << 40  # no bound
    return c


def most_common(a: np.ndarray, b: np.ndarray) -> int:
    """No two sets of these embeddings have a larger intersection."""
    if len(a) < len(b):
        b = b.reshape(len(a), -1).sum(axis=1)
    elif len(b) < len(a):
        a = a.reshape(len(b), -1).sum(axis=1)
    return int(np.minimum(a, b).sum())


def least_distance(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> float:
    top = min(most_common(a, b), na, nb)
    return 1 - top / (na + nb - top)


SETS = "doc_id long, n_shingles long, k1 long, k2 long, counts binary, part int"
_PARTS = 64


def _sets(docs: DataFrame) -> DataFrame:
    """Rows of documents (part null), the first of a set in its task with the
    set's embedding as counts, and of each task its share of the count sketch
    (part 0 to 63)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(SKETCH, np.int64), set()
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()),
                            ("k2", pa.int64()), ("counts", pa.binary()), ("part", pa.int32())])
        for batch in batches:
            rows, embedded, fresh = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                key = set_key(s)
                rows.append((len(s), *key))
                new = len(s) > 0 and key not in seen
                embedded.append(embedding(s).tobytes() if new else None)
                if new:
                    if len(seen) < SEEN:
                        seen.add(key)
                    fresh.append(s)
            if fresh:
                counts += np.bincount((np.concatenate(fresh) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            n = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in n.T], pa.array(embedded, pa.binary()), pa.nulls(len(n), pa.int32())],
                schema=schema)
        if seen:
            for i, part in enumerate(np.split(counts, _PARTS)):
                yield pa.RecordBatch.from_pylist([{"part": i, "counts": part.tobytes()}], schema)

    return texts(docs).mapInArrow(run, SETS)


def _sketch(rows: DataFrame) -> np.ndarray:
    """The summed sketch.  Parts are added up where they lie; the driver gets
    SKETCH numbers whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
        for part, c in total.items():
            yield pa.RecordBatch.from_pylist([{"part": part, "counts": c.tobytes()}],
                                             pa.schema([("part", pa.int32()), ("counts", pa.binary())]))

    parts = rows.filter("part is not null").select("part", "counts")
    within = parts.mapInArrow(add, "part int, counts binary")  # of a task, before the shuffle
    out = np.zeros((_PARTS, SKETCH // _PARTS), np.int64)
    for r in within.repartition(_PARTS, "part").mapInArrow(add, "part int, counts binary").collect():
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(out.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def first_shingles(s: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, whether the set may be the smaller of a link by them): the
    rarest shingles, one of which linked sets have in common."""
    n = len(s) - -(-NUM * len(s) // DEN) + 1
    as_smaller = len(s) - -(-2 * NUM * len(s) // (NUM + DEN)) + 1
    rare = counts[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
    # By (count, hash): s is ascending, so a stable order gives it.
    return s[np.argsort(rare, kind="stable")[:n]], np.arange(n) < as_smaller


def open_regions(a: np.ndarray, m: np.ndarray, x: np.ndarray, carry: tuple) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(pivots, kept, carry) of rows sorted by shingle, size and key.

    ``m`` is twice the size, plus 1 for a document that can only be the larger
    one.  A region ends where the shingle does, or where the last document
    that can be the smaller one is too small for the next.  ``carry`` is the
    shingle, that document's size and the pivot of the rows before.
    """
    n, small = m >> 1, (m & 1) == 0
    rows = np.arange(len(a))
    run = np.maximum.accumulate(np.where(np.concatenate(([True], a[1:] != a[:-1])), rows, 0))
    before = np.maximum.accumulate(np.where(small, rows, -1))
    before = np.concatenate(([-1], before[:-1]))
    has = before >= run
    size = np.where(has, n[before], 0)
    going_on = (run == 0) & ~has & (a == carry[0])  # rows of the run that was open
    size = np.where(going_on, carry[1], size)
    joins = (size > 0) & (DEN * size >= NUM * n)
    opens = small & ~joins
    at = np.maximum.accumulate(np.where(opens, rows, -1))
    pivot = np.where(at >= run, x[at], carry[2])
    kept = opens | joins
    last = np.flatnonzero(small & (a == a[-1]))
    if len(last):
        carry = (a[-1], n[last[-1]], pivot[last[-1]])
    elif a[-1] != carry[0]:
        carry = (a[-1], 0, 0)
    return pivot, kept, carry


def _regions(docs: DataFrame, counts) -> DataFrame:
    """(p, x): distinct pairs of a pivot's key and a document's, x != p."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = counts.value, set()
        for batch in batches:
            shingle, size, key_of = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                key = set_key(s)[0]
                if len(s) and key not in seen:
                    if len(seen) < SEEN:
                        seen.add(key)
                    first, small = first_shingles(s, own)
                    shingle.append(first)
                    size.append(2 * len(s) + ~small)
                    key_of.append(np.full(len(first), key))
            if key_of:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(shingle).view(np.int64)), pa.array(np.concatenate(size).astype(np.int32)),
                     pa.array(np.concatenate(key_of))], names=["a", "m", "x"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = (None, 0, 0)
        for batch in batches:
            a, m, x = (batch.column(i).to_numpy() for i in range(3))
            if not len(a):
                continue
            pivot, kept, carry = open_regions(a, m.astype(np.int64), x, carry)
            kept &= pivot != x
            both = np.unique(np.stack([pivot[kept], x[kept]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["p", "x"])

    rows = texts(docs).mapInArrow(emit, "a long, m int, x long")
    return rows.repartition("a").sortWithinPartitions("a", "m", "x").mapInArrow(pair, "p long, x long").distinct()


def _dealt(pairs: DataFrame, center: list[str], member: list[str]) -> DataFrame:
    """``pairs`` and a row for each part's center itself, with part."""
    sizes = pairs.groupBy(*center).agg(F.expr(f"cast(ceil(count(1) / {REGION_PART}) as int)").alias("parts"))
    members = pairs.select(*center, *member).join(sizes, center).select(
        *center, *member, F.pmod(F.xxhash64(*member), F.col("parts")).cast("int").alias("part"), F.lit(True).alias("other"))
    centers = sizes.select(*center, *[F.col(c).alias(m) for c, m in zip(center, member, strict=False)],
                           F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("other"))
    return members.unionByName(centers)


def _bounded(regions: DataFrame, embedded: DataFrame) -> DataFrame:
    """p1, p2, k1, k2, n, low of each document of a region but its pivot:
    the least distance that the embedding leaves."""
    rows = (_dealt(regions, ["p"], ["x"]).join(embedded.withColumnRenamed("k1", "x"), "x")
            .select("p", "part", "other", F.col("x").alias("k1"), "k2", "n", "counts"))

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = center = None
        for batch in batches:
            out = []
            for p, part, _, k1, k2, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p, part) != region:
                    region, center = (p, part), (k1, k2, n, _counts(raw))
                    continue
                if (k1, k2) != center[:2]:
                    out.append((*center[:2], k1, k2, n, least_distance(_counts(raw), center[3], n, center[2])))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.float64())],
                                             names=["p1", "p2", "k1", "k2", "n", "low"])

    # A pivot sorts before the others of its part.
    return stored(rows.repartition("p", "part").sortWithinPartitions("p", "part", "other", "k1", "k2")
                  .mapInArrow(star, "p1 long, p2 long, k1 long, k2 long, n long, low double"), "bounded")


def _points(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """k1, k2, n, text of each wanted set, from one of its documents."""
    reps = (sets.join(wanted, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.min("doc_id").alias("d"))
            .select(F.col("d"), F.col("k1").alias("want1"), F.col("k2").alias("want2")))
    rows = (texts(docs).join(stored_broadcast(reps, "reps"), F.col("doc_id").eqNullSafe(F.col("d")))
            .select("want1", "want2", "text"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:  # an id may stand for several texts, and a row may be repeated
            keep, n = [], []
            for i, (a, b, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                s = shingles(text)
                if (a, b) not in seen and set_key(s) == (a, b):
                    if len(seen) < SEEN:
                        seen.add((a, b))
                    keep.append(i)
                    n.append(len(s))
            t = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(n, pa.int64()), t.column(2)],
                                             names=["k1", "k2", "n", "text"])

    return stored(rows.mapInArrow(check, "k1 long, k2 long, n long, text string"), "points")


def _compared(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """p1, p2, k1, k2, d, near of pairs of sets, compared in full.  The pairs
    of one (p1, p2) are a star: its text travels once for each part."""
    pairs = stored(pairs.distinct(), "pairs")
    wanted = stored_broadcast(pairs.select("k1", "k2").union(pairs.select("p1", "p2")).distinct(), "wanted")
    points = _points(docs, sets, wanted)
    rows = _dealt(pairs, ["p1", "p2"], ["k1", "k2"]).join(points, ["k1", "k2"]).select(
        "p1", "p2", "part", "other", "k1", "k2", "n", "text")

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = center = None
        for batch in batches:
            out = []
            for p1, p2, part, _, k1, k2, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p1, p2, part) != region:
                    region, center = (p1, p2, part), shingles(text)
                if (k1, k2) != (p1, p2):
                    inter = common(shingles(text), center)
                    out.append((p1, p2, k1, k2, 1 - inter / (n + len(center) - inter), linked(inter, n, len(center))))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["p1", "p2", "k1", "k2", "d", "near"])

    out = (rows.repartition("p1", "p2", "part").sortWithinPartitions("p1", "p2", "part", "other", "k1", "k2")
           .mapInArrow(star, "p1 long, p2 long, k1 long, k2 long, d double, near boolean"))
    return stored(out.distinct(), "compared")


def _edges(compared: DataFrame) -> DataFrame:
    return compared.filter("near").select(F.struct(F.col("k1").alias("a"), F.col("k2").alias("b")).alias("u"),
                                          F.struct(F.col("p1").alias("a"), F.col("p2").alias("b")).alias("v"))


def _rests(members: DataFrame, compared: DataFrame) -> DataFrame:
    """What the pivots' balls leave: p1, p2, k1, k2, n, d, exact, near, chunks."""
    known = members.join(compared, ["p1", "p2", "k1", "k2"], "left").select(
        "p1", "p2", "k1", "k2", "n", F.coalesce("d", "low").alias("d"), F.col("d").isNotNull().alias("exact"),
        F.coalesce("near", F.lit(False)).alias("near"))
    known = stored(known, "known")
    outside = known.filter("not near").groupBy("p1", "p2").agg(F.min("d").alias("first_out"))
    window = ~F.col("near") | (F.col("d") >= F.col("first_out") - RADIUS - _ROUGH)
    rest = stored(known.join(outside, ["p1", "p2"]).filter(window).drop("first_out"), "rest")
    several = (rest.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")).filter("size > 1")
               .select("p1", "p2", F.expr(f"cast(ceil(greatest(size / {CHUNK}, shingles / {CHUNK_SHINGLES})) as int)")
                       .alias("chunks")))
    return stored(rest.join(several, ["p1", "p2"]), "rests")


class Embedded:
    """Embeddings of the documents of a rest, a matrix for each length."""

    def __init__(self, raw: list[bytes], n: np.ndarray):
        self.raw, self.n = raw, n
        self.length = np.array([len(r) for r in raw])
        self.rows = {k: np.flatnonzero(self.length == k) for k in set(self.length.tolist())}
        self.matrix = {k: np.frombuffer(b"".join(raw[i] for i in rows), np.uint8).reshape(len(rows), k)
                       for k, rows in self.rows.items()}
        self.full = np.array([b"\xff" in r for r in raw])

    def may_link(self, q: int, can: np.ndarray) -> np.ndarray:
        """Of the documents in ``can``, those whose embedding leaves a link
        with q possible.  Sizes within a link's ratio give lengths that are
        equal or twice each other."""
        k, found = int(self.length[q]), []
        own = np.frombuffer(self.raw[q], np.uint8)
        for other in (k // 2, k, 2 * k):
            if other not in self.rows:
                continue
            mask = can[self.rows[other]]
            if not mask.any():
                continue
            rows, m, c = self.rows[other][mask], self.matrix[other][mask], own
            if other > k:
                m = m.reshape(len(m), k, 2).sum(axis=2, dtype=np.uint16)
            elif other < k:
                c = c.reshape(other, 2).sum(axis=1, dtype=np.uint16)
            top = np.minimum(m, c).sum(axis=1, dtype=np.int64)
            least = np.minimum(self.n[rows], self.n[q])
            top = np.where(self.full[rows] & self.full[q], least, np.minimum(top, least))
            d = 1 - top / (self.n[rows] + self.n[q] - top)
            found.append(rows[d <= RADIUS + _ROUGH])
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def rest_pairs(near: np.ndarray, chunk: np.ndarray, root: np.ndarray, d: np.ndarray, exact: np.ndarray,
               n: np.ndarray, raw: list[bytes], cross: bool, last: bool) -> tuple[list[int], list[tuple[int, int]]]:
    """(pivots, pairs): documents of a rest to be compared in full.

    The documents outside the ball are taken in turn.  One that may link to an
    earlier pivot waits, unless this is the ``last`` level; any other is a
    pivot and is paired with all later ones and those of the ball's window
    that it may link to.  In ``cross`` only different chunks are paired.
    """
    embedded = Embedded(raw, n)
    waits, todo = np.zeros(len(n), bool), np.ones(len(n), bool)
    pivots, pairs = [], []
    for q in np.flatnonzero(~near):
        if waits[q] and not last:
            continue
        todo[q] = False
        pivots.append(int(q))
        can = todo & (root != root[q])
        if cross:
            can &= chunk != chunk[q]
        can &= DEN * np.minimum(n, n[q]) >= NUM * np.maximum(n, n[q])
        can &= ~(exact & (d[q] - d > RADIUS + _ROUGH))
        if exact[q]:
            can &= ~(d - d[q] > RADIUS + _ROUGH)
        for x in embedded.may_link(q, can):
            pairs.append((int(q), int(x)))
            waits[x] = True
    return pivots, pairs


def _in_rests(rests: DataFrame, roots: DataFrame, embedded: DataFrame, done: DataFrame | None, last: bool) -> DataFrame:
    """r1, r2, i, j (the rest and its chunks), p1, p2 (a pivot), k1, k2 (a
    document it may link to, or null).  Rests whose documents all have one
    root are done."""
    own = F.struct(F.col("k1").alias("a"), F.col("k2").alias("b"))
    root = F.coalesce("root", own)
    rooted = (rests.join(roots.select(F.col("node.a").alias("k1"), F.col("node.b").alias("k2"), "root"), ["k1", "k2"], "left")
              .withColumn("root", F.xxhash64(root["a"], root["b"])))
    open_rests = rooted.groupBy("p1", "p2").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b")
    rows = (rooted.join(open_rests, ["p1", "p2"], "left_semi").withColumn("chunk", F.pmod(F.xxhash64("k1", "k2"), F.col("chunks")).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(F.col("p1").alias("r1"), F.col("p2").alias("r2"), F.least("chunk", "o").alias("i"),
                    F.greatest("chunk", "o").alias("j"), "chunk", "k1", "k2", "n", "d", "exact", "near", "root"))
    if done is not None:
        rows = rows.join(done.select("r1", "r2", "i", "j", F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct(),
                         ["r1", "r2", "i", "j", "k1", "k2"], "left_anti")
    rows = rows.join(embedded.select("k1", "k2", "counts"), ["k1", "k2"]).select(
        "r1", "r2", "i", "j", "chunk", "k1", "k2", "n", "d", "exact", "near", "root", "counts")
    names = ["r1", "r2", "i", "j", "p1", "p2", "k1", "k2"]
    schema = pa.schema([(c, pa.int32() if c in "ij" else pa.int64()) for c in names])

    def solve(own: list[tuple]) -> list[tuple]:
        col = lambda c, kind: np.array([r[c] for r in own], kind)
        pivots, pairs = rest_pairs(col(10, bool), col(4, np.int64), col(11, np.int64), col(8, float), col(9, bool),
                                   col(7, np.int64), [r[12] for r in own], own[0][2] != own[0][3], last)
        found = [(*own[0][:4], *own[q][5:7], *own[x][5:7]) for q, x in pairs]
        return found + [(*own[0][:4], *own[q][5:7], None, None) for q in set(pivots) - {q for q, _ in pairs}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = lambda found: pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in found], schema.field(i).type) for i in range(8)], schema=schema)
        key, own = None, []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:4] != key:
                    if own:
                        out += solve(own)
                    key, own = row[:4], []
                own.append(row)  # a pair of chunks at most
            yield make(out)
        if own:
            yield make(solve(own))

    return stored(rows.repartition("r1", "r2", "i", "j").sortWithinPartitions("r1", "r2", "i", "j", "k1", "k2")
                  .mapInArrow(run, ", ".join(f"{c} {'int' if c in 'ij' else 'long'}" for c in names)), "rest-pairs")


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) of the nodes that have an edge, from (u, v) rows; the root
    is the least node of a component.  Large stars hang a node's larger
    neighbours on its least one, small stars its smaller ones, until nothing
    changes.  After a given number of ``rounds`` nodes of one root are
    connected, but a component may still have several."""
    h = F.xxhash64("u", "v")
    mark = [F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h % 1_000_003).alias("s")]
    e, before = stored_with(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                            .distinct(), "edges", *mark)
    while before["n"]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # (v, m) for the larger neighbours v of each u, and (u, m) for u itself.
        large = stored(both.join(least, "u").select(F.greatest("u", "v").alias("u"), F.col("m").alias("v"))
                       .filter("u != v").distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                               F.col("m").alias("v")).distinct())
        e, now = stored_with(small, "small-stars", *mark)
        rounds = rounds and rounds - 1
        if now == before or rounds == 0:
            break
        before = now
    roots = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
                             .join(roots, "node", "left_anti"))


#: Rounds of contraction between two levels of a join.
ROUNDS = 2


def graph_of(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of the sets that link with another one."""
    counts = docs.sparkSession.sparkContext.broadcast(_sketch(sets))  # SKETCH numbers
    rows = sets.filter("part is null")
    embedded = stored(rows.filter("counts is not null").groupBy("k1", "k2")
                      .agg(F.max("n_shingles").alias("n"), F.max("counts").alias("counts")), "embedded")
    members = _bounded(stored(_regions(docs, counts), "regions"), embedded)
    compared = _compared(docs, rows, members.filter(F.col("low") <= RADIUS + _ROUGH).select("p1", "p2", "k1", "k2"))
    edges, rests, done = _edges(compared), _rests(members, compared), None
    for last in (False, True):
        found = _in_rests(rests, stored(components(edges, ROUNDS), "roots"), embedded, done, last)
        pairs = found.filter("k1 is not null").select("p1", "p2", "k1", "k2")
        if not pairs.take(1):
            break
        edges, done = edges.unionByName(_edges(_compared(docs, rows, pairs))), found
    return components(edges)


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, k1, k2, root, component_id of every row; the root
    names a row's component, which ids that stand for several texts may not."""
    sets = stored(_sets(docs), "sets")
    own = sets.filter("part is null").select("doc_id", "n_shingles", "k1", "k2")
    graph = graph_of(docs, sets)
    least = own.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("d"))
    rooted = least.join(graph.select(F.col("node.a").alias("k1"), F.col("node.b").alias("k2"), "root"), ["k1", "k2"], "left") \
        .select("k1", "k2", "d", F.coalesce("root", F.struct(F.col("k1").alias("a"), F.col("k2").alias("b"))).alias("root"))
    rooted = stored(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("d").alias("component_id"))
    by_set = rooted.join(ids, "root").select("k1", "k2", "root", "component_id")
    return (own.join(by_set, ["k1", "k2"], "left")
            .select("doc_id", "n_shingles", "k1", "k2", "root",
                    F.when(F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def join(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of linked documents, that of the smallest doc_id,
    and every document without words; with their own columns.

    Only the keys of what goes are joined to the texts.  Of rows that repeat
    the first's id and set, the one whose JSON text is least stays.
    """
    own = stored(groups(docs).filter("n_shingles > 0"), "groups")
    name = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "k1", "k2")
    first = own.groupBy("root").agg(F.min(name).alias("f")).select("root", "f.doc_id", "f.k1", "f.k2")
    rows = own.groupBy("root", "doc_id", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    marked = stored_broadcast(rows.alias("r").join(first.alias("f"), "root").select(
        F.col("r.doc_id").alias("id"), F.col("r.k1").alias("a"), F.col("r.k2").alias("b"),
        (F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.k1") == F.col("f.k1"))
         & (F.col("r.k2") == F.col("f.k2"))).alias("first"), "n").filter("not first or n > 1").drop("n"), "marked")
    rows = as_row(docs)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_of = batch.column(0).field("text").cast(pa.string()).to_pylist()
            keys = np.array([set_key(shingles(t)) for t in texts_of], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                                             names=["row", "k1", "k2"])

    long = F.lit(0).cast("long")
    keyed = rows.mapInArrow(key, rows.select("row", long.alias("k1"), long.alias("k2")).schema)
    same = (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("id"))
    joined = stored(keyed.join(marked, same, "left").filter("first is null or first"), "kept")
    repeats = joined.filter("first").groupBy("id", "k1", "k2").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return from_row(joined.filter("first is null").select("row").unionByName(repeats.select("row")))
