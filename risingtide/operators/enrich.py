"""Joining the screen with fundamentals, sectors and news (JN3-JN6, A3, A5,
N1, P4) into one report row per stock.

Plan shape: every input is first reduced to one row per key (symbol or
sector) -- the news to at most ``k`` articles per symbol, aggregated
per symbol before any join -- so the joins never fan out and no wide
``dropDuplicates`` over the final rows is needed: the join of distinct
inputs on their keys is already distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risingtide.operators.sectors import FACT_COLUMNS, sector_join
from risingtide.params import MISSING_TEXT, NEWS_SEPARATOR

SCREEN_VALUES = ["last_price", "last_percent", "start_end_percent"]
REPORT_COLUMNS = ["symbol", "news_source", "news_data", "core_focus", *FACT_COLUMNS,
                  "company_overview", "marketCap", "last_price", "last_percent",
                  "start_end_percent"]


def fill_missing_text(df: DataFrame, value: str = MISSING_TEXT) -> DataFrame:
    """NULL strings -> ``value``.  Only string columns: numbers stay
    typed and NULL (the reference's fill turned them into text, H4)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(value, subset=cols) if cols else df


def news_per_symbol(news_top: DataFrame, sep: str = NEWS_SEPARATOR) -> DataFrame:
    """A3 + P4: ``(symbol, news_data, news_source)`` with the articles of a
    symbol joined by ``sep``.

    Both strings list the same (title, url) pairs in the same order --
    newest first -- so position i of one matches position i of the other;
    repeated pairs are kept once (the reference's ``drop_duplicates``), a
    missing title or url reads ``no data``.  At most ``k`` articles reach a
    symbol (top-k upstream), so the per-symbol list is bounded, and the
    input is already partitioned by symbol, so this adds no Exchange.
    """
    pair = lambda x: F.struct(
        F.coalesce(x["news_data"], F.lit(MISSING_TEXT)).alias("d"),
        F.coalesce(x["news_source"], F.lit(MISSING_TEXT)).alias("s"))
    pairs = F.array_distinct(F.transform(
        F.array_sort(F.collect_list(F.struct("news_rank", "article_id", "news_data",
                                             "news_source"))), pair))
    return (news_top.groupBy("symbol").agg(pairs.alias("_pairs"))
            .select("symbol",
                    F.array_join(F.transform("_pairs", lambda p: p["d"]), sep).alias("news_data"),
                    F.array_join(F.transform("_pairs", lambda p: p["s"]), sep).alias("news_source")))


def enriched_rows(sectors: DataFrame, facts: DataFrame, overview: DataFrame,
                  screened_per_symbol: DataFrame | None = None) -> DataFrame:
    """JN2 + JN4 + JN5 + A5: one row per (symbol, future sector) with the
    sector facts, the company overview and the screen values.  ``overview``
    and ``screened_per_symbol`` must have one row per symbol (the survivor
    table guarantees it).  When both come from one per-symbol table (the
    survivors), pass it as ``overview`` alone: one join instead of two."""
    sec = sectors.select("symbol", "core_focus").distinct()
    per_symbol = overview.select("symbol", "company_overview", "marketCap",
                                 *([] if screened_per_symbol is not None else SCREEN_VALUES))
    rows = sector_join(sec, facts.distinct()).join(per_symbol, "symbol")
    return rows if screened_per_symbol is None else rows.join(screened_per_symbol, "symbol")


def news_left_join(rows: DataFrame, news_top: DataFrame) -> DataFrame:
    """JN3 + N1: every row with each of its articles (1:n, at most k), or a
    single ``no data`` row when the symbol has none."""
    return fill_missing_text(
        rows.join(news_top.select("symbol", "news_rank", "news_data", "news_source"),
                  "symbol", "left"))


def alert_rows(rows: DataFrame, news_top: DataFrame) -> DataFrame:
    """JN6: enriched rows with the per-symbol news strings, one row per
    stock and sector, in the reference's column set."""
    return fill_missing_text(rows.join(news_per_symbol(news_top), "symbol", "left")
                             ).select(*REPORT_COLUMNS)
