"""Conversation structure repair by secondary-sorted streaming.

Conversations are repartitioned by their id and sorted by turn; each task then
reads its rows as a stream of Arrow batches and carries the state of a dynamic
program from row to row and from batch to batch.  The program finds the
cheapest edits that make the roles read ``(s?(ua)+)?`` (nothing, or an optional
system row and then user and assistant in turn): a row is kept (0), given the
other role (3) or deleted (4), and rows without text may be inserted (3).  Rows
with a fault count as follows: blank ones and repeats of an earlier row must be
deleted, and a truncated row that stays adds 3.  Of edits that cost the same
those win whose initials (D, I, K, R) come first in ASCII.

The state is, for each of the grammar's four states, the least cost and the
rank of the best initials so far; after a row's own edit no two of them are
prefixes of each other, so ranks suffice and no initials are carried.  Costs
relative to the least are bounded, so there are few different steps and each
is worked out once.  A row leaves four bytes of backpointers.

A conversation of up to ``buffer`` characters and rows is finished in the
stream.  A larger one spills blocks of that size (backpointers, and the rows
they belong to) as rows of a table in the shared folder; a second pass reads
the backpointers backwards, a third replays the edits forwards.  So memory is
bounded for conversations of any length.  Equal rows of a turn are counted
before the shuffle, and a row of many copies travels once; repeats of earlier
turns are found by an aggregate over a digest, not in the stream.

Defined results: a null role or text is one space, so such a text is blank;
rows without a conversation id are one conversation; null turns come first and
count in no gap; rows of one turn are ordered by role and text.  An empty
table gives no rows; other columns are ignored.  Very long texts pass through
the stream one Arrow batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risingtide.llm.common import stored, stored_broadcast

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Characters, and rows, of a conversation that a task holds.
BUFFER, BUFFER_ROWS = 4_000_000, 20_000

OK, BLANK, DUPLICATE, CUT = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: The state after an inserted or reroled row: user, but assistant after user.
_NEXT = (USER, USER, ASSISTANT, USER)
_LETTERS = "DKR"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, with faults made by a checksum of
    the row's id and turn; a dropped row stays with no copies."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
                                (F.crc32(name.cast("binary")) % 20).alias("h"))
    h, none = F.col("h"), F.lit(None)
    text = F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn",
                       F.when(h == 0, none).when(h == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(h == 0, none).otherwise(text).alias("text"),
                       F.when(h == 0, F.lit(0)).when(h == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


def _same_id(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def with_faults(rows: DataFrame) -> DataFrame:
    """Different rows of a turn with their copies and ``fault``, that of the
    first copy; rows without copies only name their conversation."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    once = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
                  .withColumn("own", F.when(F.col("copies") == 0, OK).when(F.length(trimmed) == 0, BLANK)
                              .when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), OK).otherwise(CUT))
                  .withColumn("digest", F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"))), "rows")
    repeated = (once.filter((F.col("copies") > 0) & (F.col("own") != BLANK)).groupBy("conv_id", "digest")
                .agg(F.count(F.lit(1)).alias("turns"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("null"))
                .filter("turns > 1").select(F.col("conv_id").alias("r_id"), F.col("digest").alias("r_digest"),
                                            F.when(~F.col("null"), F.col("least")).alias("first"), F.lit(True).alias("again")))
    joined = once.join(stored_broadcast(repeated, "repeated"),
                       _same_id("conv_id", "r_id") & (F.col("digest") == F.col("r_digest")) & (F.col("own") != BLANK), "left")
    later = F.col("again") & ~F.col("turn").eqNullSafe(F.col("first"))
    fault = F.when((F.col("copies") > 0) & F.coalesce(later, F.lit(False)), DUPLICATE).otherwise(F.col("own"))
    return joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


# ------------------------------------------------------- the dynamic program

#: Per state (cost, rank) or None; costs count from the least.
FIRST = ((0, 0), None, None, None)


@lru_cache(maxsize=None)  # few, since costs relative to the least are bounded
def step(config: tuple, initial: int, fault: int) -> tuple[tuple, int, bytes]:
    """(config after a row, what the least cost grew by, backpointers)."""
    best: list = [None] * 4
    for state, known in enumerate(config):
        if known is None:
            continue
        cost, rank = known
        at = state
        for inserts in range(3):
            edits = [(at, DELETE, 0)]
            if fault in (OK, CUT):
                stays = TRUNCATED if fault == CUT else 0
                if initial == SYSTEM and at == START or initial == _NEXT[at]:
                    edits.append((initial, stays, 1))
                edits.append((_NEXT[at], stays + REROLE, 2))
            for to, price, op in edits:
                found = (cost + inserts * INSERT + price, rank, "I" * inserts + _LETTERS[op], state, inserts, op)
                if best[to] is None or found < best[to]:
                    best[to] = found
            at = _NEXT[at]
    least = min(b[0] for b in best if b)
    order = sorted((b[1:3], to) for to, b in enumerate(best) if b)
    rank_of = {to: i for i, (_, to) in enumerate(order)}
    return (tuple(b and (b[0] - least, rank_of[to]) for to, b in enumerate(best)), least,
            bytes(b[3] | b[4] << 2 | b[5] << 4 if b else 255 for b in best))


def finish(config: tuple) -> tuple[int, int, int]:
    """(cost beyond the least, state of the last row, inserts after it)."""
    ends = [(START, 0), (ASSISTANT, 0), (USER, 1), (SYSTEM, 2)]
    cost, _, state, inserts = min((config[s][0] + n * INSERT, config[s][1], s, n) for s, n in ends if config[s])
    return cost, state, inserts


def backwards(pointers: bytes, state: int) -> tuple[bytes, int]:
    """(inserts and edit of every row, state before the first)."""
    edits = bytearray(len(pointers) // 4)
    for i in range(len(edits) - 1, -1, -1):
        b = pointers[4 * i + state]
        edits[i] = b >> 2
        state = b & 3
    return bytes(edits), state


class Replay:
    """The edits' initials and the repaired rows' digest, block by block."""

    def __init__(self):
        self.state, self.audit, self.sha, self.fresh = START, [], hashlib.sha256(), True

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.fresh else chr(10)}{role}:{text}".encode())
        self.fresh = False

    def insert(self, count: int) -> None:
        for _ in range(count):
            self.audit.append("I")
            self.state = _NEXT[self.state]
            self.line("user" if self.state == USER else "assistant", "")

    def rows(self, edits: bytes, roles: list[str], texts: list[str], copies: list[int]) -> None:
        at = 0
        for role, text, n in zip(roles, texts, copies, strict=True):
            for edit in edits[at:at + n]:
                self.insert(edit & 3)
                op = edit >> 2
                self.audit.append(_LETTERS[op])
                if op == 1:
                    self.state = _INITIALS[role[0]]
                    self.line(role, text)
                elif op == 2:
                    self.state = _NEXT[self.state]
                    self.line("user" if self.state == USER else "assistant", text)
            at += n

    def result(self) -> tuple[str, str]:
        return "".join(self.audit), self.sha.hexdigest()


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class Conversation:
    """One conversation's stream."""

    def __init__(self, conv_id):
        self.id, self.blocks = conv_id, 0
        self.config, self.cost = FIRST, 0
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.faults = [0] * 4
        self.before = None
        self._clear()

    def _clear(self) -> None:
        self.pointers, self.roles, self.texts, self.copies, self.size = bytearray(), [], [], [], 0

    def full(self, buffer: int, rows: int) -> bool:
        return self.size > buffer or len(self.pointers) > 4 * rows

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: int) -> None:
        if turn is not None and (self.last is None or turn != self.last):
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        self.illegal += self.before is not None and self.before + role[:1] not in ("su", "ua", "au")
        self.illegal -= 1  # again() counts this row with its copies
        self.before = role[:1]
        self.faults[fault] += 1
        self.faults[BLANK if fault == BLANK else DUPLICATE] -= 1
        self.again(role, copies, fault, text)

    def again(self, role: str, copies: int, fault: int, text: str = "") -> None:
        """Copies of the row before, which are repeats of it; with ``text``,
        the row itself and its copies."""
        self.illegal += copies
        self.faults[BLANK if fault == BLANK else DUPLICATE] += copies
        fault = fault if text or fault == BLANK else DUPLICATE
        initial = _INITIALS.get(role[:1], 4)
        for _ in range(copies):
            self.config, grown, pointers = step(self.config, initial, fault)
            self.cost += grown
            self.pointers += pointers
            fault = BLANK if fault == BLANK else DUPLICATE
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.size += len(text) + len(role)

    def block(self) -> dict:
        out = {"conv_id": self.id, "block": self.blocks, "pointers": bytes(self.pointers), "roles": self.roles,
               "texts": self.texts, "copies": self.copies}
        self.blocks += 1
        self._clear()
        return out

    def end(self) -> Iterator[dict]:
        beyond, state, inserts = finish(self.config)
        spilled = self.blocks > 0
        row = {"conv_id": self.id, "gaps": self.last - self.first + 1 - self.turns if self.turns else 0,
               "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT],
               "illegal": self.illegal, "cost": self.cost + beyond}
        if spilled:
            yield self.block()
            row |= {"state": state, "inserts": inserts}
        else:
            replay = Replay()
            replay.rows(backwards(self.pointers, state)[0], self.roles, self.texts, self.copies)
            replay.insert(inserts)
            row["audit"], row["repaired_sha256"] = replay.result()
        yield row


RESULT = [(c, "long", pa.int64()) for c in COUNTS] + [("audit", "string", pa.string()), ("repaired_sha256", "string", pa.string())]
BLOCK = [("state", "int", pa.int32()), ("inserts", "int", pa.int32()), ("block", "int", pa.int32()),
         ("pointers", "binary", pa.binary()), ("roles", "array<string>", pa.list_(pa.string())),
         ("texts", "array<string>", pa.list_(pa.string())), ("copies", "array<long>", pa.list_(pa.int64()))]


def _ddl(rows: DataFrame, *fields) -> str:
    return ", ".join([f"conv_id {rows.schema['conv_id'].dataType.simpleString()}", *[f"{n} {t}" for n, t, _ in fields]])


def _batch(rows: list[dict], id_type: pa.DataType, fields: list) -> pa.RecordBatch:
    schema = pa.schema([("conv_id", id_type), *[(n, t) for n, _, t in fields]])
    return pa.RecordBatch.from_pylist(rows, schema)


def _streamed(rows: DataFrame, buffer: int, buffer_rows: int) -> DataFrame:
    """Result rows, and blocks of the conversations that are too large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kind = None, None
        for batch in batches:
            out, kind = [], batch.schema.field(0).type
            for conv, turn, role, text, copies, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None or conv != own.id:
                    if own is not None:
                        out += own.end()
                    own = Conversation(conv)
                for at in range(0, copies, buffer_rows):  # many copies in parts; only the first may stay
                    n = min(copies - at, buffer_rows)
                    if at:
                        own.again(role, n, fault)
                    else:
                        own.add(turn, role, text, n, fault)
                    if own.full(buffer, buffer_rows):
                        yield _batch([*out, own.block()], kind, RESULT + BLOCK)
                        out = []
            yield _batch(out, kind, RESULT + BLOCK)
        if own is not None:
            yield _batch(list(own.end()), kind, RESULT + BLOCK)

    order = ["conv_id", "turn", "role", "text"]
    return (rows.select(*order, "copies", "fault").repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(run, _ddl(rows, *RESULT, *BLOCK)))


def _resolved(spilled: DataFrame) -> DataFrame:
    """conv_id, block, edits, tail: the backpointers of large conversations,
    followed from their last block to the first; ``tail``, the inserts at the
    end, is that of the last block alone."""
    fields = [("block", "int", pa.int32()), ("edits", "binary", pa.binary()), ("tail", "int", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = tail = None
        for batch in batches:
            out = []
            for conv, end, inserts, block, pointers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block is None:  # the result row, before the last block
                    state, tail = end, inserts
                    continue
                edits, state = backwards(pointers, state)
                out.append({"conv_id": conv, "block": block, "edits": edits, "tail": tail})
                tail = None
            yield _batch(out, batch.schema.field(0).type, fields)

    rows = spilled.select("conv_id", "state", "inserts", "block", "pointers")
    return (rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.desc_nulls_first("block"))
            .mapInArrow(run, _ddl(spilled, *fields)))


def _replayed(spilled: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256 of large conversations."""
    edits = _resolved(spilled).select(F.col("conv_id").alias("e_id"), F.col("block").alias("e_block"), "edits", "tail")
    rows = (spilled.filter("block is not null")
            .join(edits, _same_id("conv_id", "e_id") & (F.col("block") == F.col("e_block")))
            .select("conv_id", "block", "edits", "tail", "roles", "texts", "copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = None
        for batch in batches:
            out = []
            for conv, block, edits, tail, roles, texts, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block == 0:
                    replay = Replay()
                replay.rows(edits, roles, texts, copies)
                if tail is not None:
                    replay.insert(tail)
                    audit, digest = replay.result()
                    out.append({"conv_id": conv, "audit": audit, "repaired_sha256": digest})
            yield _batch(out, batch.schema.field(0).type, RESULT[-2:])

    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "block")
            .mapInArrow(run, _ddl(spilled, *RESULT[-2:])))


def repair(rows: DataFrame, buffer: int = BUFFER, buffer_rows: int = BUFFER_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of every conversation of ``rows`` (conv_id, turn, role,
    text, copies)."""
    found = stored(_streamed(with_faults(rows), buffer, buffer_rows), "conversations")
    results = found.filter("block is null").select("conv_id", *COUNTS, "audit", "repaired_sha256")
    spilled = found.filter("block is not null or state is not null")
    if not spilled.take(1):
        return results
    large = _replayed(spilled).select(F.col("conv_id").alias("l_id"), F.col("audit").alias("l_audit"),
                                      F.col("repaired_sha256").alias("l_sha"))
    return results.join(large, _same_id("conv_id", "l_id"), "left").select(
        "conv_id", *COUNTS, F.coalesce("audit", "l_audit").alias("audit"),
        F.coalesce("repaired_sha256", "l_sha").alias("repaired_sha256"))
