"""Archived provider replies as a source.

A provider answers per symbol with a JSON list of bars.  The replies are kept
as JSON lines ``{"symbol": ..., "body": "..."}`` in folders by the month their
bars lie in and by a bucket of the symbol.  A read names a date range and,
if it wants, the symbols: both prune folders before a file is opened, as the
reference's requests named a symbol, ``from`` and ``to``.  It is Spark's own
file source, so the archive may lie in any store that Spark reads, files are
split over tasks, and nothing is listed or parsed on the driver but the folder
names.

A reply that is no list of bars becomes a reject, and a bar without a date or
a usable close is one too (the reference dropped both silently); the others
are bars.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from risingtide.functions.numeric import nan_to_null
from risingtide.session import checked_broadcast
from risingtide.sources.bars import BAR_REPLY_SCHEMA, price_window_scan

#: Symbol buckets of a month, a fixed part of the layout.
BUCKETS = 16


def symbol_bucket(symbol: Column) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(BUCKETS)).cast("int")


def archive(replies: DataFrame, path: str) -> None:
    """Adds replies ``(symbol, month, body)``, month as ``2024-01``."""
    (replies.withColumn("bucket", symbol_bucket(F.col("symbol")))
     .repartition("month", "bucket")
     .write.mode("append").partitionBy("month", "bucket").json(path))


def months_between(start: _dt.date, end: _dt.date) -> list[str]:
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{m // 12}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


def scan(spark: SparkSession, path: str, start: _dt.date, end: _dt.date, symbols: DataFrame | None = None,
         symbol_type: str = "bigint") -> DataFrame:
    """``(symbol, body, month, bucket)`` of the folders that can hold bars of
    the range and the symbols.  Of the symbols the driver takes the numbers of
    their buckets, ``BUCKETS`` at most; the symbols themselves are a semi-join
    where the replies are read."""
    rows = (spark.read.schema(f"symbol {symbol_type}, body string, month string, bucket int").json(path)
            .where(F.col("month").isin(months_between(start, end))))
    if symbols is None:
        return rows
    wanted = checked_broadcast(symbols.select("symbol").distinct())
    buckets = [r["b"] for r in wanted.select(symbol_bucket(F.col("symbol")).alias("b")).distinct().collect()]
    return rows.where(F.col("bucket").isin(buckets)).join(wanted, "symbol", "left_semi")


def bars_and_rejects(spark: SparkSession, path: str, start: _dt.date, end: _dt.date, symbols: DataFrame | None = None,
                     symbol_type: str = "bigint") -> tuple[DataFrame, DataFrame]:
    """``(symbol, date, close)`` of the range, and the rejects ``(symbol,
    month, reason, record)``: replies that are no list of bars, and bars whose
    date can't be read."""
    parsed = (scan(spark, path, start, end, symbols, symbol_type)
              .withColumn("_bars", F.from_json("body", BAR_REPLY_SCHEMA)))
    # ``from_json`` gives a list with an empty bar for some broken texts.
    good = F.col("_bars").isNotNull() & F.ltrim("body").startswith("[") & F.rtrim("body").endswith("]")
    each = (parsed.where(good).select("symbol", "month", F.explode("_bars").alias("_b"))
            .select("symbol", "month", F.try_to_date(F.col("_b.date")).alias("date"),
                    nan_to_null(F.col("_b.close")).alias("close"), F.to_json("_b").alias("record")))
    rejects = (parsed.where(~F.coalesce(good, F.lit(False)))
               .select("symbol", "month", F.lit("no list of bars").alias("reason"), F.col("body").alias("record"))
               .unionByName(each.where(F.col("date").isNull())
                            .select("symbol", "month", F.lit("no date").alias("reason"), "record")))
    return price_window_scan(each.select("symbol", "date", "close"), start, end), rejects
