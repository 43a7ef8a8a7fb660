"""Quality rules with adaptive thresholds, in DataFrame expressions only.

Five measures of a document, in thousandths and all integers: symbols per
word, repeated lines per line, words in repeated 5-word windows per word,
characters per word and distinct words per word.  For each language and
source a mergeable quantile sketch of each measure is kept: counts per
logarithmic bin with 2**SUB bins for each doubling, so any quantile is known
to a relative error of 2**-SUB, and the sketches of all sources merge into
that of a language, and those of all languages into one, by adding counts.

A document is rejected when it fails the base rules or a measure lies outside
the fences of its group.  A fence stands at the median plus or minus the
largest of: a share of the way to the tail (the 99th or 1st percentile), a
multiple of the interquartile range, and a least distance.  Where a group has
junk, the tail reaches into it and the share decides; where it has none, the
interquartile range keeps fences off an ordinary spread, and the least
distance those of measures that are 0 nearly everywhere.  So fences follow the
group, and no share of every group is cut off.

A group of fewer than MIN_GROUP documents, which would be its own median, takes
its language's fences, and a language of fewer those of all documents.

Documents join the fences of their group on language and source.  The fences
are one row per group; below a measured size they are broadcast, beyond it
the join is a shuffle in which AQE splits hot groups.

Defined results: a null text has no words, lines or symbols and fails the
base rules.  Texts without words add nothing to a sketch.  Null languages and
sources form groups of their own.  Equal rows are judged alike.  An empty
table gives no rows.  Columns other than doc_id, text, lang and source are
ignored by ``judge`` and passed on by ``keep``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risingtide.llm.common import as_row, from_row, stored, stored_broadcast

WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Bins of a doubling: 2**SUB.
SUB = 4
#: Documents below which a group's own quantiles say too little.
MIN_GROUP = 30


class Fence(NamedTuple):
    """Least distance from the median in thousandths, percent of the way to
    the upper and to the lower tail (no fence without), and multiples of the
    interquartile range."""

    least: int
    upper: int | None
    lower: int | None
    ranges: int


MEASURES = {"symbols": Fence(25, 10, None, 0), "dup_lines": Fence(250, 100, None, 0), "repeats": Fence(200, 25, None, 0),
            "chars": Fence(300, 75, 150, 6), "distinct": Fence(100, None, 75, 3)}
#: The percentiles that fences are made of.
PERCENTILES = (1, 25, 50, 75, 99)
#: Fixed by the contract: what separates words, and what counts as a symbol.
WORD_GAPS = r"[\x20\x09-\x0D]+"
NOT_A_GAP = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAPS), lambda w: w != "")


def _window_hashes(words: Column) -> Column:
    n = F.size(words)
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))),
                                           lambda i: F.xxhash64(F.slice(words, i, WINDOW)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _bound(value: Column, use) -> Column:
    """use(value), with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 5-word window found twice or more.  Windows are
    compared as words, not as hashes; called only where hashes repeat."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1),
                          lambda i: F.struct(F.slice(words, i, WINDOW).alias("w"), i.alias("i")))

    def starts(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["w"] == x["w"], F.lit(False))
        return F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])

    covered = F.aggregate(
        F.array_sort(_bound(F.array_sort(windows), starts)),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"),
                              i.alias("last")))
    return covered["n"]


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` and n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_distinct (each under a ``_q_`` name)."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.rlike(x, F.lit(NOT_A_GAP)))
    base = (docs.withColumn("_q_words", words_of(F.col("text").cast("string")))
            .withColumn("_q_lines", lines)
            .withColumn("_q_n_symbols", (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long")))
    hashes = _window_hashes(F.col("_q_words"))
    repeats = _bound(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return (base
            .withColumn("_q_n_words", F.size("_q_words").cast("long"))
            .withColumn("_q_word_chars", F.length(F.array_join("_q_words", "")).cast("long"))
            .withColumn("_q_n_lines", F.size("_q_lines").cast("long"))
            .withColumn("_q_n_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"))
            .withColumn("_q_n_distinct", F.size(F.array_distinct("_q_words")).cast("long"))
            .withColumn("_q_n_repeat_words", F.when(repeats, _repeat_words(F.col("_q_words")))
                        .otherwise(F.lit(0)).cast("long"))
            .drop("_q_words", "_q_lines"))


def _thousandths() -> dict[str, Column]:
    n = F.col("_q_n_words")
    part = lambda a, b: F.when(b > 0, F.floor(a * 1000 / b)).cast("long")
    return {"symbols": part(F.col("_q_n_symbols"), n), "dup_lines": part(F.col("_q_n_dup_lines"), F.col("_q_n_lines")),
            "repeats": part(F.col("_q_n_repeat_words"), n), "chars": part(F.col("_q_word_chars"), n),
            "distinct": part(F.col("_q_n_distinct"), n)}


def bin_of(x: Column) -> Column:
    """Bin of a non-negative integer: exact below 2**SUB, then 2**SUB bins
    for each doubling.  Integer arithmetic, so no rounding decides."""
    bits = F.length(F.bin(x))
    shift = F.greatest(bits - (SUB + 1), F.lit(0))
    return (shift * 2**SUB + F.floor(x / F.pow(F.lit(2.0), shift))).cast("int")


def bin_floor(b: Column) -> Column:
    """The least integer of a bin."""
    shift = F.greatest(F.floor(b / 2**SUB) - 1, F.lit(0))
    return ((b - shift * 2**SUB) * F.pow(F.lit(2.0), shift)).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bin, n: the merged sketches.  Counts are added
    up before the shuffle; a group has at most a few hundred bins."""
    values = F.array(*[F.struct(F.lit(k).alias("measure"), bin_of(F.col(f"_m_{k}")).alias("bin")) for k in MEASURES])
    return (measured.filter(F.col("_q_n_words") > 0).select("lang", "source", F.explode(values).alias("v"))
            .groupBy("lang", "source", "v.measure", "v.bin").agg(F.count(F.lit(1)).alias("n")))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """by..., n, and a lower and an upper fence for each measure that has it,
    of the sketches merged by the columns ``by``."""
    merged = sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    at = (merged.withColumn("seen", F.sum("n").over(group.orderBy("bin")))
          .withColumn("total", F.sum("n").over(group)))
    q = at.groupBy(*by, "measure").agg(F.max("total").alias("total"), *[
        F.min(F.when(F.col("seen") * 100 >= F.col("total") * k, F.col("bin"))).alias(f"b{k}") for k in PERCENTILES])
    # A percentile lies between its bin's least and greatest integer.
    q = q.withColumns({f"q{k}": bin_floor(F.col(f"b{k}")) for k in PERCENTILES}
                      | {f"t{k}": bin_floor(F.col(f"b{k}") + 1) - 1 for k in PERCENTILES})
    aggs = [F.max("total").alias("n")]
    for k, rule in MEASURES.items():
        common = [F.lit(rule.least).cast("long"), rule.ranges * (F.col("t75") - F.col("q25"))]
        own = F.col("measure") == k
        if rule.upper is not None:
            reach = F.greatest(F.expr(f"(t99 - t50) * {rule.upper} div 100"), *common)
            aggs.append(F.max(F.when(own, F.col("t50") + reach)).alias(f"hi_{k}"))
        if rule.lower is not None:
            reach = F.greatest(F.expr(f"(q50 - q1) * {rule.lower} div 100"), *common)
            aggs.append(F.max(F.when(own, F.col("q50") - reach)).alias(f"lo_{k}"))
    return q.groupBy(*by).agg(*aggs)


LIMITS = [f"{side}_{k}" for k, rule in MEASURES.items() for side, has in (("hi", rule.upper), ("lo", rule.lower)) if has is not None]


def limits_of(sketch: DataFrame) -> DataFrame:
    """lang, source, and the fences that hold for the group.  The driver takes
    the fences of all documents, one row."""
    every = fences(sketch, []).first()
    wide = {c: F.lit(every[c] if every else None).cast("long") for c in LIMITS}
    by_lang = fences(sketch, ["lang"])
    enough = F.col("n") >= MIN_GROUP
    by_lang = by_lang.select(F.col("lang").alias("of_lang"), *[F.when(enough, F.col(c)).otherwise(wide[c]).alias(f"wide_{c}") for c in LIMITS])
    own = fences(sketch, ["lang", "source"]).join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")))
    return own.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                      *[F.when(enough, F.col(c)).otherwise(F.col(f"wide_{c}")).alias(f"_{c}") for c in LIMITS])


def _verdicts(measured: DataFrame) -> DataFrame:
    """``measured`` joined with its groups' fences, and _base_failed, _kept."""
    limits = stored_broadcast(limits_of(stored(sketches(measured), "sketches")), "fences")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    failed = ((F.col("_q_n_words") < MIN_WORDS)
              | (100 * F.col("_q_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_q_n_words")))
    inside = F.lit(True)
    for c in LIMITS:
        side, k = c.split("_", 1)
        value = F.col(f"_m_{k}")
        inside = inside & (value <= F.col(f"_{c}") if side == "hi" else value >= F.col(f"_{c}"))
    return (measured.join(limits, same, "left").withColumn("_base_failed", failed)
            .withColumn("_kept", ~failed & F.coalesce(inside, F.lit(True))))


def _measured(docs: DataFrame) -> DataFrame:
    m = with_measures(docs)
    return m.withColumns({f"_m_{k}": v for k, v in _thousandths().items()})


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    out = _verdicts(stored(_measured(rows).drop("text"), "measures"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in counts],
                      F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    rows = as_row(docs, "text", "lang", "source")
    return from_row(_verdicts(stored(_measured(rows).drop("text"), "measured")).filter("_kept"))
