"""Fundamentals and news lookups (S5, S6, J2, F4, K1, P5, JN7).

The reference called a web service per surviving symbol.  Here the
survivor set is a DataFrame and each lookup is a join against the whole
fundamentals / news table: only survivors are looked up (a left-semi join
that AQE broadcasts when the survivor side is measured small) and the news
range predicate and per-symbol limit run before anything is shuffled.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risingtide.functions.numeric import round_half_even_long
from risingtide.params import ScreenParams
from risingtide.session import BROADCAST_MAX_KEYS, checked_broadcast


def json_with_default(json_col: Column, path: str, default, dtype: str) -> Column:
    """A field of a JSON document, or ``default`` when the document or
    the field is missing (``get_json_object`` gives NULL for both) or holds
    a value of another type (``try_cast``: NULL instead of an error)."""
    return F.coalesce(F.get_json_object(json_col, path).try_cast(dtype),
                      F.lit(default).cast(dtype))


def fundamentals_from_json(raw: DataFrame, json_col: str = "body", key: str = "symbol",
                           description_path: str = "$.results.description",
                           cap_path: str = "$.results.market_cap") -> DataFrame:
    """S5 on raw provider replies: the description defaults to ``""`` and
    the market cap to 0 when the reply or the field is missing; the cap is
    rounded half-even."""
    j = F.col(json_col)
    return raw.select(
        key,
        json_with_default(j, description_path, "", "string").alias("company_overview"),
        round_half_even_long(json_with_default(j, cap_path, 0, "double")).alias("marketCap"))


NEWS_REPLY_SCHEMA = ("struct<results: array<struct<title: string, article_url: string, "
                     "published_utc: string>>>")


def news_from_json(raw: DataFrame, json_col: str = "body", key: str = "symbol") -> DataFrame:
    """S6 + P5 on raw provider replies: one row per article of
    ``results``, ``(symbol, article_id, published, title, article_url)``.
    A missing ``title`` or ``article_url`` key reads NULL (it becomes
    ``no data`` in the report), a reply that does not parse gives no rows.
    ``article_id`` is the article's position in the reply, so equal
    publication dates keep the provider's order in the top-k."""
    parsed = raw.select(F.col(key).alias("symbol"),
                        F.from_json(F.col(json_col), NEWS_REPLY_SCHEMA).alias("_r"))
    items = parsed.select("symbol", F.posexplode("_r.results").alias("article_id", "_a"))
    return items.select(
        "symbol", F.col("article_id").cast("bigint").alias("article_id"),
        F.to_date(F.try_to_timestamp(F.col("_a.published_utc"))).alias("published"),
        F.col("_a.title").alias("title"), F.col("_a.article_url").alias("article_url"))


def fundamentals_table(raw: DataFrame) -> DataFrame:
    """S5 on a typed table ``(symbol, description, market_cap)``."""
    return raw.select(
        "symbol",
        F.coalesce(F.col("description"), F.lit("")).alias("company_overview"),
        round_half_even_long(F.coalesce(F.col("market_cap"), F.lit(0.0))).alias("marketCap"))


def cap_filter(fundamentals: DataFrame, params: ScreenParams) -> DataFrame:
    """strictly above the threshold; a missing cap is 0 and drops out."""
    return fundamentals.where(F.coalesce(F.col("marketCap"), F.lit(0)) > F.lit(params.min_market_cap))


def fundamentals_lookup(fundamentals: DataFrame, symbols: DataFrame,
                        params: ScreenParams) -> DataFrame:
    """JN7 + S5 + F4: fundamentals of the given symbols whose cap passes.
    The symbol set is materialised and broadcast after a row-count check."""
    keys = checked_broadcast(symbols.select("symbol").distinct(), BROADCAST_MAX_KEYS)
    return cap_filter(fundamentals.join(keys, "symbol", "left_semi"), params)


def news_in_window(news: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    return news.where(F.col("published").between(F.lit(start), F.lit(end)))


def news_top(news, params: ScreenParams, symbols: DataFrame | None = None) -> DataFrame:
    """S6 + K1 + P5: the newest ``news_per_symbol`` articles per symbol with
    ``start <= published <= end``; ties broken by article id.

    ``news`` is the news table, or a function of the symbol set (``None``
    for all) that restricts its own scan; the latter lets a source whose
    columns are costly to derive (a title cut out of a whole page) do that
    work only for the looked-up symbols.

    ``row_number() <= k`` over a per-symbol window lets Catalyst insert a
    WindowGroupLimit, which keeps only k rows per symbol on the map side,
    so even a symbol with a huge number of articles ships at most k rows
    per map task through the shuffle.
    """
    if callable(news):
        n = news(symbols)
    else:
        n = news if symbols is None else news.join(symbols.select("symbol"), "symbol", "left_semi")
    n = news_in_window(n, params.start_date, params.end_date)
    w = Window.partitionBy("symbol").orderBy(F.col("published").desc(), F.col("article_id"))
    return (n.withColumn("news_rank", F.row_number().over(w))
            .where(F.col("news_rank") <= params.news_per_symbol)
            .select("symbol", "article_id", "published", "news_rank",
                    F.col("title").alias("news_data"),
                    F.col("article_url").alias("news_source")))
