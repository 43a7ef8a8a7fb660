"""Exact length histogram of encoded documents.

Documents are counted by group and encoded length; the counts are added up
before the shuffle, so its size follows the number of distinct lengths and
not that of documents.  Suffix sums over a group's lengths then answer, for
every context limit L: how many documents and tokens are longer than L, the
tokens that remain when each document is cut at L, and any quantile.

Suffix sums are taken in two levels, spans of SPAN lengths and the lengths
within a span, so no task sees more than a span or one row per span.

Defined results: a null text is an empty one and has length 0; null groups
are a group; equal rows each count; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risingtide.llm.byte_bpe import count_ids
from risingtide.llm.common import stored

SPAN = 4096


def encoded_lengths(docs: DataFrame, by: list[str], model_file: str) -> DataFrame:
    rows = docs.select(F.col("text").cast("string").alias("text"), *by)
    schema = rows.select(F.lit(0).cast("long").alias("n_tokens"), *by).schema
    return rows.mapInArrow(lambda batches: count_ids(batches, model_file, 0), schema)


def histogram(lengths: DataFrame, by: list[str]) -> DataFrame:
    """by..., n_tokens, n_docs, and with the sums over the group's documents
    of at least this length docs_from, tokens_from; below it docs_below,
    tokens_below; truncated_total = tokens kept at this context limit."""
    counts = stored(lengths.groupBy(*by, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
                    .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
                    .withColumn("_span", F.expr(f"n_tokens div {SPAN}")), "lengths")
    spans = counts.groupBy(*by, "_span").agg(F.sum("n_docs").alias("_sd"), F.sum("tokens").alias("_st"))
    later = Window.partitionBy(*by).orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    spans = (spans.withColumn("_ld", zero(F.sum("_sd").over(later))).withColumn("_lt", zero(F.sum("_st").over(later)))
             .withColumn("_ad", F.sum("_sd").over(whole)).withColumn("_at", F.sum("_st").over(whole))
             .select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_span").alias("_s"), "_ld", "_lt", "_ad", "_at"))
    same = F.col("_span") == F.col("_s")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    within = Window.partitionBy(*by, "_span").orderBy(F.desc("n_tokens"))
    return (counts.join(spans, same)
            .withColumn("docs_from", F.sum("n_docs").over(within) + F.col("_ld"))
            .withColumn("tokens_from", F.sum("tokens").over(within) + F.col("_lt"))
            .withColumn("docs_below", F.col("_ad") - F.col("docs_from"))
            .withColumn("tokens_below", F.col("_at") - F.col("tokens_from"))
            .withColumn("truncated_total", F.col("tokens_below") + F.col("n_tokens") * F.col("docs_from"))
            .select(*by, "n_tokens", "n_docs", "docs_from", "tokens_from", "docs_below", "tokens_below",
                    "truncated_total"))


def _next_longer(hist: DataFrame, by: list[str], limits: list[int]) -> DataFrame:
    """For each limit and group, the shortest length of at least the limit,
    found by a sort of both lists together."""
    marks = hist.select(*by).distinct().withColumn("limit", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])))
    rows = (hist.withColumn("limit", F.lit(None).cast("long"))
            .unionByName(marks.withColumn("n_tokens", F.col("limit")), allowMissingColumns=True))
    ahead = (Window.partitionBy(*by).orderBy("n_tokens", F.col("limit").isNull())
             .rowsBetween(1, Window.unboundedFollowing))
    found = [F.first(F.when(F.col("limit").isNull(), F.struct("docs_from", "tokens_from", "docs_below", "tokens_below")),
                     ignorenulls=True).over(ahead).alias("_next"),
             F.sum("n_docs").over(Window.partitionBy(*by)).alias("_docs"),
             F.sum(F.col("n_docs") * F.when(F.col("limit").isNull(), F.col("n_tokens")))
             .over(Window.partitionBy(*by)).alias("_tokens")]
    return rows.select(*by, "limit", *found).filter(F.col("limit").isNotNull())


def at_limits(hist: DataFrame, by: list[str], limits: list[int]) -> DataFrame:
    """by..., limit, docs_longer_or_equal, truncated_total for each given
    context limit (a short list of the caller's), from the suffix sums alone."""
    out = _next_longer(hist, by, limits)
    return out.select(
        *by, "limit", F.coalesce(F.col("_next.docs_from"), F.lit(0).cast("long")).alias("docs_longer_or_equal"),
        F.when(F.col("_next").isNull(), F.col("_tokens"))
        .otherwise(F.col("_next.tokens_below") + F.col("limit") * F.col("_next.docs_from")).alias("truncated_total"))


def quantile(hist: DataFrame, by: list[str], q: float) -> DataFrame:
    """by..., n_tokens: the least length that a share ``q`` of the group's
    documents does not exceed."""
    docs: Column = F.col("docs_below") + F.col("docs_from")
    return (hist.filter(F.col("docs_below") + F.col("n_docs") >= F.lit(q) * docs)
            .groupBy(*by).agg(F.min("n_tokens").alias("n_tokens")))


def answers(hist: DataFrame, by: list[str], limits: list[int], shares: list[float]) -> DataFrame:
    """The histogram (kind ``length``) with the answers it gives as rows of
    the same columns: for each context limit (kind ``limit``, the limit as
    n_tokens) and each share of the documents (kind ``quantile``)."""
    null = F.lit(None).cast("long")
    cols = ["n_docs", "docs_from", "tokens_from", "docs_below", "tokens_below", "truncated_total"]
    out = hist.select(*by, F.lit("length").alias("kind"), F.lit(None).cast("double").alias("share"), "n_tokens", *cols)
    at = at_limits(hist, by, limits).select(
        *by, F.lit("limit").alias("kind"), F.lit(None).cast("double").alias("share"), F.col("limit").alias("n_tokens"), null.alias("n_docs"),
        F.col("docs_longer_or_equal").alias("docs_from"), null.alias("tokens_from"), null.alias("docs_below"), null.alias("tokens_below"),
        "truncated_total")
    out = out.unionByName(at)
    for q in shares:
        out = out.unionByName(quantile(hist, by, q).select(
            *by, F.lit("quantile").alias("kind"), F.lit(q).alias("share"), "n_tokens", *[null.alias(c) for c in cols]))
    return out
