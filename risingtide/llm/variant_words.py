"""Spelling variants by a variable-length gram index.

Words are counted over all texts; two words are near if one code point
inserted, deleted or replaced turns one into the other.  Near words are found
by an index of grams of variable length:

1. Gram dictionary.  A gram of at least Q_MIN code points that occurs more
   than PRUNE times among the words is frequent and is extended by the next
   code point; a rarer one is not.  So a list of the index is short, or its
   gram has full length.  Only the frequent grams are kept, with their counts:
   at most DICTIONARY of each length, whatever the vocabulary, because the
   threshold rises with the number of gram positions.
2. Decomposition.  From every position of a word runs one gram, extended
   while it is frequent, up to half the word (of the shorter word, in a pair)
   and Q_MAX.  Where a gram ends follows from its own code points, so an edit
   changes only the grams that cover it.  (A gram inside a longer one is kept:
   dropping it would let an edit change grams that it does not touch.)
3. Affected-gram bound.  For each word, the most grams that one edit can
   affect, over all places of the edit.  Of a word with bound A, any A + 1
   grams hold one that the edit leaves alone, and with all words ordering
   grams alike, rare ones first, two near words share a gram among their
   first A + 1.  Only these lists are merged.
4. Lists.  A gram that an edit leaves alone lies to one side of it, and all
   of the word beyond the gram on that side is alike too.  A list is therefore
   divided by that part of the word, and by length.  Within a list words are
   near if they are alike but for one code point of the part that the edit may
   touch, found by what remains when one is left out, so a list costs its
   length and not its square.  A list of more than LIST_PART words is dealt
   out by these remainders.
5. Verification of each pair, code point by code point.

Words are maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF), A-Z
lower-cased; ``damage_every`` deletes a code point of some, as a test of the
operator.  Every text is read whole and every word takes part.

Defined results: null, empty and blank texts give no words; a null doc_id
stands for an empty text in the damage's checksum; repeated rows count again;
of near words that occur equally often the smallest in code-point order is the
form.  Very long words have as many grams as code points; the parts of them
that an edit may touch are halved until they are short.  An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risingtide.llm.common import stored, stored_broadcast, stored_with, texts

MIN_LENGTH, MIN_COUNT = 6, 5
#: A form occurs so many times as often as the word at least.
FORM_RATIO = 5
Q_MIN, Q_MAX = 2, 6
#: Grams that occur no more often than this are not extended.
PRUNE = 100
#: Frequent grams of one length that are kept, at most.
DICTIONARY = 100_000
#: Words of a list that one task merges.
LIST_PART = 20_000
#: Touched parts of at most so many code points are compared by remainders.
SHORT = 64
#: Words or grams that a task counts before it hands them on.
COUNTED = 200_000

# Lower-cased UTF-8: a byte C3 starts U+00C0 to U+00FF and nothing else.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def text_words(doc_id: int | None, text: str | None, damage_every: int) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of a text, some of them damaged."""
    if not text:
        return
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.encode().lower())).items():
        h = zlib.crc32(run, head)
        if damage_every and h % damage_every == 0:
            word = run.decode()
            at = h % len(word)
            run = (word[:at] + word[at + 1:]).encode()
        yield run, n


def _counted(rows: Iterator[Iterator[tuple]], schema: pa.Schema, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Sums of (key, number) pairs, handed on whenever ``limit`` keys are held."""
    counts, limit = Counter(), limit or COUNTED
    make = lambda: pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(
        (counts.keys(), counts.values()), schema, strict=True)], schema=schema)
    for pairs in rows:
        for key, n in pairs:
            counts[key] += n
        if len(counts) >= limit:
            yield make()
            counts.clear()
    if counts:
        yield make()


def vocabulary(docs: DataFrame, damage_every: int, min_length: int, min_count: int) -> DataFrame:
    """word, n: the words of all texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A run shorter than this in bytes is too short, damaged or not.
        each = (((w, n) for w, n in text_words(i, t, damage_every) if len(w) >= min_length)
                for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        yield from _counted(each, schema)

    return (texts(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter((F.col("n") >= min_count) & (F.char_length("word") >= min_length)))


def frequent_grams(words: DataFrame, positions: int, prune: int = PRUNE, dictionary: int = DICTIONARY) -> dict[str, int]:
    """gram -> occurrences of the grams that are extended.  The driver gets
    ``dictionary`` grams of each length at most: more can't occur more often
    than the threshold."""
    most = max(prune, positions // dictionary)
    schema = pa.schema([("gram", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (((w[p:p + q], 1) for q in range(Q_MIN, Q_MAX) for p in range(len(w) - q + 1))
                for b in batches for w in b.column(0).to_pylist())
        yield from _counted(each, schema)

    grams = (words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
             .filter(F.col("n") > most))
    return {r["gram"]: r["n"] for r in grams.collect()}


def decompose(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of the gram at every position."""
    out, size = [], len(word)
    for p in range(size - Q_MIN + 1):
        e, top = p + Q_MIN, min(size, p + longest)
        while e < top and word[p:e] in frequent:
            e += 1
        out.append((p, e))
    return out


SAME, SHORTER, LONGER = 0, 1, 2


def affected(grams: list[tuple[int, int]], size: int, role: int) -> int:
    """The most grams that one edit of a word in this role can affect: a
    code point replaced or left out lies in them, an insertion parts them or
    lengthens those at the word's end."""
    steps = [0] * (size + 2)
    for p, e in grams:
        if role == SHORTER:
            steps[p + 1] += 1
            steps[e] -= 1
        else:
            steps[p] += 1
            steps[e] -= 1
    most = here = 0
    for s in steps:
        here += s
        most = max(most, here)
    return max(most, sum(e == size for _, e in grams)) if role == SHORTER else most


def merged_lists(word: str, frequent: dict[str, int]) -> Iterator[tuple[int, int, int, int]]:
    """(list, role, lo, hi): the lists of the word that are merged.  In a list
    an edit may touch word[lo:hi] alone."""
    size = len(word)
    cache: dict[int, list[tuple[int, int]]] = {}
    for role in (SAME, SHORTER, LONGER):
        band = size - (role == LONGER)  # the shorter word's length
        longest = max(Q_MIN, min(Q_MAX, band // 2))
        grams = cache.get(longest)
        if grams is None:
            grams = cache[longest] = decompose(word, longest, frequent)
        ordered = sorted((frequent.get(word[p:e], 0), word[p:e], p, e) for p, e in grams)
        first = ordered[:affected(grams, size, role) + 1]
        # Equal grams stand and fall together.
        first += [g for g in ordered[len(first):] if g[1] == first[-1][1]]
        kind = "=" if role == SAME else "~"
        for end in {e for *_, e in first if e < size}:
            yield _list(f"{kind}<{band}:{word[:end]}"), role, end, size
        for start in {p for *_, p, _ in first if p or role == SHORTER}:
            yield _list(f"{kind}>{band}:{word[start:]}"), role, 0, start


def _list(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode()) - (1 << 63)


def near(a: str, b: str) -> bool:
    """Whether one insertion, deletion or replacement turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def remainders(word: str, role: int, lo: int, hi: int) -> Iterator[tuple[int, str]]:
    """What remains of the touched part when one code point is left out: two
    near words have such a remainder in common."""
    part = word[lo:hi]
    if role == SHORTER:
        yield -1, part
    else:
        for i in range(len(part)):
            yield (i if role == SAME else -1), part[:i] + part[i + 1:]


def halves(word: str, role: int, lo: int, hi: int) -> Iterator[tuple[str, int, int]]:
    """(what an edit leaves alone, lo, hi): an edit touches one half of a part
    and leaves the other, of which all words of a list have the same length."""
    size = hi - lo - (role == LONGER)
    first = size // 2
    yield "<" + word[lo:lo + first], lo + first, hi
    yield ">" + word[hi - size + first:hi], lo, hi - size + first


def list_pairs(rows: list[tuple]) -> Iterator[tuple]:
    """(a, n_a, b, n_b), a < b, of the near words of one list's rows
    (word, n, role, lo, hi).  Long parts, of which the remainders would be as
    many as they are long, are halved first."""
    found, todo = set(), [rows]
    while todo:
        own, by_rest = todo.pop(), defaultdict(list)
        if max(hi - lo for *_, lo, hi in own) > SHORT:
            for word, n, role, lo, hi in own:
                for kept, *part in halves(word, role, lo, hi):
                    by_rest[kept].append((word, n, role, *part))
            todo += [same for same in by_rest.values() if len(same) > 1]
            continue
        for row in own:
            for key in set(remainders(row[0], *row[2:])):
                by_rest[key].append(row)
        for same in by_rest.values():
            # Alike but for one code point at one place, or one that may be
            # anywhere beside the word without it: as many words as the
            # alphabet and the places allow.
            shorter = [r for r in same if r[2] == SHORTER]
            others = [r for r in same if r[2] != SHORTER]
            pairs = ((x, y) for x in shorter for y in others) if shorter else (
                (x, y) for i, x in enumerate(others) for y in others[:i] if x[2] == SAME)
            for x, y in pairs:
                x, y = (x, y) if x[0] < y[0] else (y, x)
                if (x[0], y[0]) not in found and near(x[0], y[0]):
                    found.add((x[0], y[0]))
                    yield x[0], x[1], y[0], y[1]


ROW = "list long, word string, n long, role int, lo int, hi int"


def near_pairs(words: DataFrame, frequent: dict[str, int], list_part: int = LIST_PART) -> DataFrame:
    """a, n_a, b, n_b: the pairs of near words, a < b, each once."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)  # Q_MAX - Q_MIN times DICTIONARY grams at most
    schema = pa.schema([("list", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("role", pa.int32()),
                        ("lo", pa.int32()), ("hi", pa.int32())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                out = [(k, w, n, *place) for w, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                       for k, *place in merged_lists(w, own)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[5] - row[4] > SHORT:
                    out = [(_list(f"{row[0]}:{kept}"), *row[1:4], *part) for kept, *part in halves(row[1], *row[3:])]
                else:
                    out = [(_list(f"{row[0]}:{i}:{rest}"), *row[1:]) for i, rest in set(remainders(row[1], *row[3:]))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)],
                                                     schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = pa.schema([("a", pa.string()), ("n_a", pa.int64()), ("b", pa.string()), ("n_b", pa.int64())])
        make = lambda out: pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], f.type) for i, f in enumerate(out_schema)], schema=out_schema)
        key, own = None, []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != key:
                    if len(own) > 1:
                        out += list_pairs(own)
                    key, own = row[0], []
                own.append(row[1:])
            yield make(out)
        if len(own) > 1:
            yield make(list(list_pairs(own)))

    lists = stored(words.select("word", "n").mapInArrow(emit, ROW), "lists")
    long = stored_broadcast(lists.groupBy("list").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > list_part)
                            .select("list"), "long-lists")
    short = lists.join(long, "list", "left_anti")
    dealt = lists.join(long, "list", "left_semi").select(*schema.names).mapInArrow(deal, ROW)
    return (short.select(*schema.names).unionByName(dealt).repartition("list").sortWithinPartitions("list")
            .mapInArrow(merge, "a string, n_a long, b string, n_b long").distinct())


def variants(docs: DataFrame, damage_every: int = 0, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             ratio: int = FORM_RATIO, prune: int = PRUNE, list_part: int = LIST_PART) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word: its near words, the
    most frequent of them if that is ``ratio`` times as frequent, and where
    the forms lead."""
    words, seen = stored_with(vocabulary(docs, damage_every, min_length, min_count), "words",
                              F.sum(F.char_length("word")).alias("positions"))
    pairs = stored(near_pairs(words, frequent_grams(words, seen["positions"] or 0, prune), list_part), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("w"))).alias("best"))
    joined = words.join(best, "word", "left")
    is_form = F.coalesce(-F.col("best.m") >= ratio * F.col("n"), F.lit(False))
    judged = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.w")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "judged")
    # Forms are ``ratio`` times as frequent at every step, so chains are short
    # and the roots double their reach in each round.
    roots = judged.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots, moved = stored_with(roots.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots",
            F.count(F.when(F.col("moved"), 1)).alias("n"))
        roots = roots.drop("moved")
        if not moved["n"]:
            break
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                     "form_n")
