"""A bar store laid out for the screen.

Bars lie in one table, partitioned by month and bucketed by symbol.  A read of
a date range prunes months, and because all bars of a symbol are in files of
one bucket number, the window functions of the screen need no Exchange: each
task reads one bucket of the months it wants.  Ticks are rolled up and
shuffled once, when they are merged; every later screen of any window reads
them where they lie.

A merge rewrites the months it touches and no others.  It keeps for each
(symbol, date) the bar with the later tick, so a repeated merge changes
nothing, and what it writes is bucketed the same way.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risingtide.session import materialize
from risingtide.sources.bars import TICK_ORDER_TYPE
from risingtide.sources.replies import months_between

STORE_SCHEMA = f"symbol bigint, date date, close double, tick_order {TICK_ORDER_TYPE}, month string"
#: Buckets of a store unless its maker says otherwise: tasks of a screen.
BUCKETS = 64


def create(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """An empty store, registered as table ``name`` with its files below
    ``path``; nothing happens if the table exists."""
    if spark.catalog.tableExists(name):
        return
    (spark.createDataFrame([], STORE_SCHEMA).write.format("parquet").option("path", path)
     .partitionBy("month").bucketBy(buckets, "symbol").sortBy("symbol", "date").saveAsTable(name))


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Num Buckets").collect()
    return int(rows[0]["data_type"])


def merge(partial: DataFrame, name: str) -> None:
    """Merges partial bars ``(symbol, date, close, tick_order)``.  The merged
    months are checkpointed before they replace files they were read from."""
    spark = partial.sparkSession
    new = materialize(partial.select("symbol", "date", "close", "tick_order", F.date_format("date", "yyyy-MM").alias("month"))
                      .where("month is not null"))
    months = [r["month"] for r in new.select("month").distinct().collect()]  # of one merge's ticks
    if not months:
        return
    rows = new.unionByName(spark.table(name).where(F.col("month").isin(months)))
    merged = (rows.groupBy("symbol", "date", "month")
              .agg(F.max_by("close", "tick_order").alias("close"), F.max("tick_order").alias("tick_order"))
              .select("symbol", "date", "close", "tick_order", "month"))
    held = materialize(merged)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:  # one file per bucket and month
        held.repartition(_buckets(spark, name), "symbol").write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def bars(spark: SparkSession, name: str, start: _dt.date, end: _dt.date) -> DataFrame:
    """``(symbol, date, close)`` of the range, in buckets of the symbol."""
    return (spark.table(name).where(F.col("month").isin(months_between(start, end)))
            .where(F.col("date").between(F.lit(start), F.lit(end))).select("symbol", "date", "close"))
