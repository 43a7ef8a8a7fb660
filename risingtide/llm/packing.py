"""Packing documents into fixed sequences: cutting stock by column generation.

A document's ids, closed by an end id, are cut into pieces of CAPACITY ids and
a remainder, and pieces are counted by length.  That histogram, at most
CAPACITY numbers whatever the corpus, is the demand of a cutting-stock
problem: a pattern says how many pieces of each length fill one sequence, and
a linear program over patterns minimises the number of sequences.  Patterns
come from column generation: the duals of the present program price the
lengths, a knapsack dynamic program finds the pattern worth most, and it
enters the simplex basis as long as it is worth more than the sequence it
costs.  Counts of the patterns that fill a sequence to SLACK are rounded down, what is
left over is taken up by further such patterns as far as they fit, and the
last pieces are laid end to end and cut at sequence borders; their last
sequence is cut into powers of two, which need no padding.

Pieces of a length are ranked; a piece's rank says, by arithmetic alone, which
pattern, which sequence and which place are its own.  Ranks are counted in
buckets with running totals between them, so a length that a third of all
pieces share is not ranked by one task.

Defined results: a null or empty text is its end id alone; pieces that agree
in all they hold are interchangeable; documents with equal ids are packed
each on their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risingtide.llm.byte_bpe import crc, document_ids
from risingtide.llm.common import stored, texts
from risingtide.session import broadcast_hint, data_size

CAPACITY = 1024
#: Column generation ends when the program is within GAP of its lower bound.
GAP, MAX_COLUMNS = 0.002, 400
#: Padding a pattern may leave; pieces of emptier patterns are laid end to end.
SLACK = 8
#: Pieces that one bucket ranks, about.
BUCKET_PIECES = 100_000


def best_pattern(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of greatest value within capacity.
    ``values`` and ``lengths`` are those worth something, lengths ascending."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    reach = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], pick[c] = best[c - 1], -1
        if n := reach[c]:
            worth = values[:n] + best[c - lengths[:n]]
            k = int(worth.argmax())
            if worth[k] > best[c] + 1e-12:
                best[c], pick[c] = worth[k], k
    counts, c = np.zeros(len(lengths)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= lengths[pick[c]]
    return float(best[capacity]), counts


def first_columns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A basis to start from: the longest length left, filled up with the
    longest that fit, used until one of its lengths runs out.  Later patterns
    lack that length, so the patterns form a triangular, regular matrix."""
    left, patterns, amounts = demand.astype(np.float64), [], []
    alive = list(range(len(lengths)))
    while alive:
        own, column, space = lengths[alive], np.zeros(len(lengths)), capacity
        at = len(alive)
        while (at := min(at, int(np.searchsorted(own, space, side="right"))) - 1) >= 0 and space:
            i = alive[at]
            n = max(1, min(space // own[at], int(left[i])))
            column[i], space = n, space - n * own[at]
        held = np.flatnonzero(column)
        ratios = left[held] / column[held]
        out = held[ratios.argmin()]
        patterns.append(column)
        amounts.append(ratios.min())
        left = np.maximum(left - ratios.min() * column, 0)
        alive.remove(out)
    return np.array(patterns).T, np.array(amounts)


def column_generation(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, amounts): columns over ``lengths`` and how often each is
    used, in fractions, so that pieces of every length are all placed."""
    basis, x = first_columns(lengths, demand, capacity)
    inverse = np.linalg.inv(basis)
    for _ in range(MAX_COLUMNS):
        duals = inverse.sum(axis=0)
        useful = np.flatnonzero(duals > 1e-12)
        value, part = best_pattern(duals[useful], lengths[useful], capacity)
        total = x.sum()
        least = max(total / max(value, 1.0), (lengths * demand).sum() / capacity)
        if value <= 1 + 1e-9 or total <= (1 + GAP) * least:
            break
        column = np.zeros(len(lengths))
        column[useful] = part
        step = inverse @ column
        able = np.flatnonzero(step > 1e-11)
        ratios = x[able] / step[able]
        out = able[ratios.argmin()]
        theta = ratios.min()
        x = x - theta * step
        x[out] = theta
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        basis[:, out] = column
    return basis, np.maximum(x, 0)


@dataclass
class Plan:
    """Where ranks of each length go.  ``entries``: (length, first rank, ranks
    end, pieces of it per sequence, first sequence, offset of its first piece),
    by length and rank.  ``rest``: length -> (first rank left over, its place
    in the run of left-over ids); ``rest_ids`` their number, ``rest_sequence``
    their first sequence."""

    entries: np.ndarray
    rest: dict[int, tuple[int, int]]
    rest_ids: int
    rest_sequence: int

    def cuts(self, capacity: int = CAPACITY) -> np.ndarray:
        """Starts of the sequences in the run of left-over ids, and its end."""
        whole, last = divmod(self.rest_ids, capacity)
        at = [i * capacity for i in range(whole + 1)]
        for bit in range(last.bit_length() - 1, -1, -1):
            if last >> bit & 1:
                at.append(at[-1] + (1 << bit))
        return np.array(at, dtype=np.int64)


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    entries, rest, sequence, left = [], {}, 0, {}
    if histogram.get(capacity):
        entries.append((capacity, 0, histogram[capacity], 1, 0, 0))
        sequence = histogram[capacity]
    lengths = np.array(sorted(n for n, k in histogram.items() if k and n != capacity), dtype=np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], dtype=np.int64)
    if len(lengths):
        basis, x = column_generation(lengths, demand.astype(np.float64), capacity)
        patterns = np.rint(basis).astype(np.int64)
        full = lengths @ patterns >= capacity - SLACK
        times = np.where(full, np.floor(x + 1e-9), 0).astype(np.int64)
        remaining = demand - patterns @ times
        while (over := np.flatnonzero(remaining < 0)).size:  # rounding noise of large amounts
            times[np.flatnonzero((patterns[over[0]] > 0) & (times > 0))[0]] -= 1
            remaining = demand - patterns @ times
        for j in np.argsort(-(x - times), kind="stable"):
            held = patterns[:, j] > 0
            if full[j]:
                more = int((remaining[held] // patterns[held, j]).min())
                times[j] += more
                remaining -= more * patterns[:, j]
        used = np.zeros(len(lengths), dtype=np.int64)
        for j in np.flatnonzero(times):
            offset = 0
            for i in np.flatnonzero(patterns[:, j]):
                per, n = int(patterns[i, j]), int(lengths[i])
                entries.append((n, used[i], used[i] + per * times[j], per, sequence, offset))
                used[i] += per * times[j]
                offset += per * n
            sequence += int(times[j])
        at = 0
        for i in np.argsort(-lengths, kind="stable"):
            rest[int(lengths[i])] = (int(used[i]), at)
            at += int(remaining[i]) * int(lengths[i])
        left = at
    return Plan(np.array(sorted(entries), dtype=np.int64).reshape(-1, 6), rest, int(left or 0), sequence)


def cut_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """Pieces of every document: doc_id, doc_crc (of all its ids), start,
    length, ids_crc32, doc_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, parts = [], []
            for i, ids in enumerate(document_ids(model_file, batch.column(1).to_pylist())):
                whole = crc(ids)
                for at in range(0, len(ids), CAPACITY):
                    piece = ids[at:at + CAPACITY]
                    owner.append(i)
                    parts.append((whole, at, len(piece), crc(piece), len(ids)))
            numbers = np.array(parts, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c) for c in numbers.T]],
                names=["doc_id", "doc_crc", "start", "length", "ids_crc32", "doc_tokens"])

    return texts(docs).mapInArrow(
        run, "doc_id long, doc_crc long, start long, length long, ids_crc32 long, doc_tokens long")


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """``pieces`` with ``rank``, from 0, among those of their length."""
    rows = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "doc_crc", "start"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(F.col("length").alias("_l"), F.col("_b").alias("_c"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy("length", "_b").orderBy("doc_id", "doc_crc", "start")
    return (rows.withColumn("_r", F.row_number().over(own) - 1)
            .join(firsts, (F.col("length") == F.col("_l")) & (F.col("_b") == F.col("_c")))
            .withColumn("rank", F.col("_first") + F.col("_r")).select(*pieces.columns, "rank"))


OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def placed(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Ranked pieces with sequence_id and offset; for a left-over piece the
    sequence is null and the offset its place in the run of left-over ids."""
    e = plan.entries
    base = 1 << 40
    keys = e[:, 0] * base + e[:, 1]
    lengths = np.array(sorted(plan.rest), dtype=np.int64)
    firsts = np.array([plan.rest[n] for n in lengths.tolist()], dtype=np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length * base + rank, side="right") - 1
            got = (at >= 0) & (len(keys) > 0)
            at = np.maximum(at, 0)
            row = e[at] if len(e) else np.zeros((len(at), 6), np.int64)
            got &= (row[:, 0] == length) & (rank < row[:, 2])
            nth = rank - row[:, 1]
            per = np.maximum(row[:, 3], 1)
            sequence, offset = row[:, 4] + nth // per, row[:, 5] + nth % per * length
            if not got.all():
                k = np.searchsorted(lengths, length[~got])
                offset[~got] = firsts[k, 1] + (rank[~got] - firsts[k, 0]) * length[~got]
            cols = [batch.column(c) for c in OUT[:5]]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(sequence, mask=~got), pa.array(offset), batch.column("doc_crc")], names=[*OUT, "doc_crc"])

    return pieces.mapInArrow(run, ", ".join(f"{c} long" for c in [*OUT, "doc_crc"]))


def recut(docs: DataFrame, left: DataFrame, plan: Plan, model_file: str) -> DataFrame:
    """The left-over pieces cut at the borders of their sequences.  Only
    their documents are read into ids again."""
    cuts, first = plan.cuts(), plan.rest_sequence
    n, size = data_size(left)
    wanted = left.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(
        F.struct("doc_crc", "doc_tokens", "start", "length", "offset")).alias("parts"))
    rows = (texts(docs).join(broadcast_hint(wanted, n, size), F.col("doc_id").eqNullSafe(F.col("_doc")))
            .select("doc_id", "text", "parts").dropDuplicates(["doc_id", "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, out = [], []
            wanted = batch.column(2).to_pylist()
            for i, ids in enumerate(document_ids(model_file, batch.column(1).to_pylist())):
                whole = crc(ids)
                for part in wanted[i]:
                    if (part["doc_crc"], part["doc_tokens"]) != (whole, len(ids)):
                        continue  # of another text with this id
                    lo, hi = part["offset"], part["offset"] + part["length"]
                    inside = cuts[np.searchsorted(cuts, lo, side="right"):np.searchsorted(cuts, hi, side="left")]
                    borders = [lo, *inside.tolist(), hi]
                    for a, b in zip(borders, borders[1:], strict=False):
                        k = int(np.searchsorted(cuts, a, side="right")) - 1
                        start = part["start"] + a - lo
                        owner.append(i)
                        out.append((start, b - a, crc(ids[start:start + b - a]), len(ids), first + k, a - int(cuts[k])))
            numbers = np.array(out, dtype=np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c) for c in numbers.T]], names=OUT)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in OUT))


def pack(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of
    every piece."""
    pieces = stored(cut_documents(docs, model_file), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # CAPACITY rows at most
    plan = make_plan(histogram)
    buckets = max(8, sum(histogram.values()) // BUCKET_PIECES)
    at = stored(placed(ranked(pieces, buckets), plan), "placed")
    left = at.filter(F.col("sequence_id").isNull())
    return at.filter(F.col("sequence_id").isNotNull()).select(*OUT).unionByName(recut(docs, left, plan, model_file))
