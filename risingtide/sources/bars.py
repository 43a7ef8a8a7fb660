"""Daily bar sources (S2, S3, U-2) and the tick -> daily bar roll-up.

A bar table is ``(symbol, date, close, ...)``.  The reference fetched one
symbol at a time with the date range pushed to the provider; here a single
scan reads every symbol, the range predicate reaches the parquet reader
(``PushedFilters``) or prunes ``date`` partitions, and the symbol universe
becomes a left-semi join -- a data-parallel fan-out instead of one request
per symbol.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risingtide.functions.numeric import nan_to_null
from risingtide.session import BROADCAST_MAX_KEYS, checked_broadcast

BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.LongType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("close", T.DoubleType(), True),
])


def _ts_literal(dtype: T.DataType, value: _dt.datetime) -> Column:
    """A timestamp literal of the column's own type, so the comparison is
    not wrapped in a cast and stays pushable to the scan."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)


def ticks_in_window(ticks: DataFrame, start: _dt.date, end: _dt.date,
                    ts_col: str = "ts") -> DataFrame:
    """Rows whose timestamp falls on a day in ``[start, end]`` (inclusive).

    Written as a half-open timestamp range so parquet min/max statistics and
    row-group skipping apply.
    """
    lo = _dt.datetime.combine(start, _dt.time())
    hi = _dt.datetime.combine(end + _dt.timedelta(days=1), _dt.time())
    dtype = ticks.schema[ts_col].dataType
    return ticks.where((F.col(ts_col) >= _ts_literal(dtype, lo))
                       & (F.col(ts_col) < _ts_literal(dtype, hi)))


TICK_ORDER_TYPE = "decimal(38,0)"
_LONGS = 2**64


def tick_order(ts: Column, tie: Column, price: Column) -> Column:
    """One number that orders ticks by time, then by ``tie`` (a bigint):
    microseconds times 2**64 plus the tie, as a decimal.  NULL without a
    price, so such a tick is never a bar's last one.

    A decimal lives in an aggregate's buffer in place, so ``max_by`` over it
    is a hash aggregate on both sides of the shuffle; a struct key would
    make Spark sort all raw ticks first.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)")
    key = micros * F.lit(str(_LONGS)).cast("decimal(20,0)") + tie.cast("decimal(20,0)")
    return F.when(price.isNotNull(), key.cast(TICK_ORDER_TYPE))


def with_tick_order(ticks: DataFrame, ts_col: str = "ts", price_col: str = "value",
                    id_col: str = "event_id") -> DataFrame:
    """``ticks`` with ``tick_order``: ties in time go to the largest id, in a
    table without ids to a hash of the price.  Either way the pick does not
    depend on row order, and a recomputed task gives the same bar."""
    tie = F.coalesce(F.col(id_col), F.lit(0)) if id_col in ticks.columns else F.xxhash64(price_col)
    return ticks.withColumn("tick_order", tick_order(F.col(ts_col), tie, F.col(price_col)))


def daily_bars(ticks: DataFrame, symbol_col: str = "user_id", ts_col: str = "ts",
               price_col: str = "value", id_col: str = "event_id",
               count: bool = False) -> DataFrame:
    """Roll ticks up to one bar per (symbol, day): the close is the price of
    the day's last tick (see ``with_tick_order``); with ``count`` also the
    number of ticks.

    ``max_by`` is a partial hash aggregate, so a hot symbol is reduced
    map-side to one row per (symbol, day, map task) before the shuffle.
    """
    extra = [F.count(F.lit(1)).alias("n_ticks")] if count else []
    return (with_tick_order(ticks.where(F.col(symbol_col).isNotNull()), ts_col, price_col, id_col)
            .groupBy(F.col(symbol_col).alias("symbol"),
                     F.col(ts_col).cast("date").alias("date"))
            .agg(nan_to_null(F.max_by(F.col(price_col), F.col("tick_order"))).alias("close"), *extra))


def partial_daily_bars(ordered: DataFrame, symbol_col: str = "user_id", ts_col: str = "ts",
                       price_col: str = "value") -> DataFrame:
    """``(symbol, date, close, tick_order)`` of ticks that have their order:
    bars that a store can merge with those of other ticks."""
    return (ordered.groupBy(F.col(symbol_col).alias("symbol"), F.col(ts_col).cast("date").alias("date"))
            .agg(nan_to_null(F.max_by(price_col, "tick_order")).alias("close"), F.max("tick_order").alias("tick_order")))


BAR_REPLY_SCHEMA = "array<struct<date: string, close: double>>"


def bars_from_json(raw: DataFrame, json_col: str = "body", key: str = "symbol") -> DataFrame:
    """S2 + S4 + P3 on raw provider replies (one JSON list of daily bars
    per symbol): ``(symbol, date, close)``.  A reply that does not parse
    gives no rows (the reference dropped it and went on), a date string
    that does not parse gives a NULL date, a NaN close a NULL close."""
    parsed = raw.select(F.col(key).alias("symbol"),
                        F.from_json(F.col(json_col), BAR_REPLY_SCHEMA).alias("_b"))
    return (parsed.select("symbol", F.explode("_b").alias("_x"))
            .select("symbol", F.try_to_date(F.col("_x.date")).alias("date"),
                    nan_to_null(F.col("_x.close")).alias("close")))


def price_window_scan(bars: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Bars of every symbol with ``start <= date <= end``."""
    return bars.where(F.col("date").between(F.lit(start), F.lit(end)))


def price_scan_for_universe(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """S3: bars of the listed symbols only.

    A left-semi join keeps each bar once even when a symbol is listed on two
    exchanges (the reference fetched it twice, H8).  The distinct symbol
    list is materialised and broadcast after a row-count check, so the bars
    are filtered where they are read; above the bound it is a shuffle join.
    """
    keys = checked_broadcast(universe.select("symbol").distinct(), BROADCAST_MAX_KEYS)
    return bars.join(keys, "symbol", "left_semi")


def bars_union(frames: list[DataFrame]) -> DataFrame:
    """U-2: concatenate per-source bar frames, aligning columns by name and
    filling a column a frame lacks with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parse_bar_dates(raw: DataFrame, col: str = "date") -> DataFrame:
    """String -> date.  ``try_to_date`` gives NULL for a malformed value
    instead of failing the job under ANSI mode."""
    return raw.withColumn(col, F.try_to_date(F.col(col)))
