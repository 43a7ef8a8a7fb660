"""Logical tables bound to the driver's parquet tables.

The screen needs market tables (bars, listings, fundamentals, news, sector
labels).  These functions express each one as a projection of the driver
tables, always as lazy DataFrames that read only the columns they use:

=============  ==============================================================
prices         ``events``: symbol=user_id, date=day of ts, close=last value
listings       ``customer``: NYSE = c_nationkey < 15, NASDAQ = c_nationkey >= 10
fundamentals   ``customer``: company_overview=c_name, cap=c_acctbal
sectors        ``customer``: core_focus=c_mktsegment
news           ``pages``: symbol=page_id div 6, published=2024-01-15 + 3*(page_id % 6)
=============  ==============================================================
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risingtide.params import ScreenParams
from risingtide.sources import bars as _bars
from risingtide.sources import listings as _listings

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed binding values (the oracle SQL uses the same ones).
NYSE_MAX_NATION = 15        # NYSE lists c_nationkey < 15
NASDAQ_MIN_NATION = 10      # NASDAQ lists c_nationkey >= 10
ARTICLES_PER_PAGE_GROUP = 6  # pages per symbol
NEWS_EPOCH = _dt.date(2024, 1, 15)
NEWS_STEP_DAYS = 3
TITLE_PATTERN = r"<title>([^<]*)</title>"


# Declared schemas of the tables the bindings read.  Reading with a schema
# skips footer inference (a Spark job per read) and fails loudly on a type
# change instead of silently re-typing a column; columns a query does not
# select are pruned from the scan as usual.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")


def prices(spark: SparkSession, sf_dir: str, params: ScreenParams) -> DataFrame:
    """Daily bars of the trailing window (S2 over the tick table)."""
    t = _bars.ticks_in_window(ticks(spark, sf_dir), params.start_date, params.end_date)
    return _bars.daily_bars(t)


def exchange_listing(spark: SparkSession, sf_dir: str, exchange: str) -> DataFrame:
    """The symbols one exchange lists, as ``(symbol)``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    if exchange == "NYSE":
        c = c.where(F.col("c_nationkey") < NYSE_MAX_NATION)
    elif exchange == "NASDAQ":
        c = c.where(F.col("c_nationkey") >= NASDAQ_MIN_NATION)
    else:
        raise ValueError(f"unknown exchange {exchange!r}")
    return c.select(F.col("c_custkey").alias("symbol"))


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-1: NYSE then NASDAQ, duplicates kept (UNION ALL)."""
    return _listings.universe(exchange_listing(spark, sf_dir, "NYSE"),
                              exchange_listing(spark, sf_dir, "NASDAQ"))


def fundamentals_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(symbol, description, market_cap)`` before defaults and rounding."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("symbol"),
        F.col("c_name").alias("description"),
        F.col("c_acctbal").alias("market_cap"))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(symbol, core_focus)``: the label a classifier would give."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("symbol"), F.col("c_mktsegment").alias("core_focus"))


def news(spark: SparkSession, sf_dir: str, symbols: DataFrame | None = None) -> DataFrame:
    """``(symbol, article_id, published, title, article_url)``.

    A page with no ``<title>`` gives a NULL title (the provider omitting the
    key, H10).  ``symbols`` keeps only the pages of those symbols, and the
    semi-join is placed before the title is cut out of the html, so the
    regex runs on the looked-up symbols' pages only (Catalyst does not move
    a semi-join below that projection by itself).
    """
    p = table(spark, sf_dir, "pages").select(
        F.floor(F.col("page_id") / ARTICLES_PER_PAGE_GROUP).cast("bigint").alias("symbol"),
        "page_id", "url", "html")
    if symbols is not None:
        p = p.join(symbols.select("symbol"), "symbol", "left_semi")
    return p.select(
        "symbol",
        F.col("page_id").alias("article_id"),
        F.date_add(F.lit(NEWS_EPOCH),
                   (F.col("page_id") % ARTICLES_PER_PAGE_GROUP * NEWS_STEP_DAYS).cast("int")
                   ).alias("published"),
        F.nullif(F.regexp_extract("html", TITLE_PATTERN, 1), F.lit("")).alias("title"),
        F.col("url").alias("article_url"))


def news_source(spark: SparkSession, sf_dir: str):
    """The news table as a function of the symbol set (see
    ``lookups.news_top``)."""
    return lambda symbols=None: news(spark, sf_dir, symbols)


# Stand-in for the model's sector description: fixed text per segment and a
# fixed flag rule (every segment but HOUSEHOLD is "future potential").
NOT_FUTURE_SEGMENT = "HOUSEHOLD"


def sector_facts(shared: DataFrame) -> DataFrame:
    """``(core_focus, core_focus_overview, is_core_focus_future_potential,
    core_focus_future_potential_overview)`` for the given sectors."""
    seg = F.lower(F.col("core_focus"))
    return shared.select(
        "core_focus",
        F.concat(F.lit("Companies selling mainly to the "), seg, F.lit(" segment")
                 ).alias("core_focus_overview"),
        (F.col("core_focus") != F.lit(NOT_FUTURE_SEGMENT)).alias("is_core_focus_future_potential"),
        F.concat(F.lit("Demand in the "), seg, F.lit(" segment keeps growing")
                 ).alias("core_focus_future_potential_overview"))
