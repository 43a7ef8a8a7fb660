"""Incremental runs with Structured Streaming (SS1, SS2).

The reference re-ran the whole job once a day over a trailing window.  With
ticks arriving as files, the same screen runs incrementally around a bar
store partitioned by ``date``, one bar per (symbol, date):

* ``stream_daily_bars`` (SS2) rolls ticks up to daily bars with an
  event-time tumbling window and a watermark; in update mode each trigger
  emits the bars it changed and ``foreachBatch`` merges them into the store.
* ``incremental_screen`` (SS1) merges each micro-batch's partial bars into
  the store and notes the symbols it touched; a screen of the same window
  then re-screens those symbols only and takes the others' rows from the
  last one.  (The window functions of the screen are not allowed on a
  streaming frame, so the screen runs on the store.)

A merge reads the store's partitions of the dates in the batch, keeps for
each (symbol, date) the bar with the latest tick (``tick_order``) and
overwrites only those partitions (dynamic partition overwrite) with as many
files as their rows need, so the store never needs compaction.  The merged frame
is checkpointed (``spark.checkpoint.dir``) before it replaces files it was
read from; with ``session.START_CONF`` these checkpoints are deleted when no
plan needs them.  Merging the same ticks again changes nothing.

The stream has no upper bound in time: a tick of a day after the run's
``end_date`` goes to the store and waits for the run that reads that day,
because the stream's checkpoint marks its file as consumed.  Ticks before the
trailing window are ignored (late rule).  The window is cut where the store
is read.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risingtide.functions.numeric import nan_to_null
from risingtide.operators import momentum
from risingtide.params import ScreenParams
from risingtide.session import checked_broadcast, checkpoint_dir, materialize_measured
from risingtide.sources.bars import TICK_ORDER_TYPE, with_tick_order
from risingtide.sources.driver import TABLE_SCHEMAS

TICK_SCHEMA = TABLE_SCHEMAS["events"]
PARTIAL_SCHEMA = f"symbol bigint, date date, close double, tick_order {TICK_ORDER_TYPE}"
BAR_STORE_SCHEMA = f"symbol bigint, close double, tick_order {TICK_ORDER_TYPE}, date date"
TOUCHED_SCHEMA = "symbol bigint, batch_id bigint"
SCREEN_SCHEMA = ("symbol bigint, last_price double, last_percent double, start_end_percent double, "
                 "window string, run bigint")
#: Bars of a file, about: a merge writes a date into as many files as its
#: rows need.
BARS_PER_FILE = 2_000_000


def tick_stream(spark: SparkSession, folder: str, file_glob: str = "*.parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of tick parquet files; ``ts`` cast to ``timestamp``
    (watermarks reject ``timestamp_ntz``)."""
    r = spark.readStream.schema(TICK_SCHEMA).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return (r.parquet(folder)
            .select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value"))


def _not_late(ticks: DataFrame, params: ScreenParams) -> DataFrame:
    lo = _dt.datetime.combine(params.start_date, _dt.time())
    return with_tick_order(ticks.where((F.col("ts") >= F.lit(lo)) & F.col("user_id").isNotNull()))


def _last_bar() -> list:
    return [nan_to_null(F.max_by("value", "tick_order")).alias("close"), F.max("tick_order").alias("tick_order")]


# ----------------------------------------------------------------- store

def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _stored_dates(spark: SparkSession, store_path: str, dates: list[_dt.date]) -> list[_dt.date]:
    """Those of ``dates`` the store has a partition for: one lookup each.  A
    failure to look, or later to read, is raised; only a folder that is not
    there means that there is nothing to merge with."""
    return [d for d in dates if _exists(spark, f"{store_path.rstrip('/')}/date={d.isoformat()}")]


def merge_into_store(batch: DataFrame, store_path: str) -> None:
    """Merge partial bars ``(symbol, date, close, tick_order)`` into the store.

    Only the date partitions the batch touches are read and rewritten.
    Their dates are collected first -- the distinct days of one micro-batch
    -- so the read of the store is pruned to those partitions statically.
    The batch is persisted for the two passes over it (dates, merge).
    """
    spark = batch.sparkSession
    checkpoint_dir(spark)
    batch = batch.persist()
    try:
        dates = [r["date"] for r in batch.select("date").distinct().collect()]
        if not dates:
            return
        stored = _stored_dates(spark, store_path, dates)
        rows = batch
        if stored:
            rows = batch.unionByName(spark.read.schema(BAR_STORE_SCHEMA).parquet(store_path)
                                     .where(F.col("date").isin(stored)))
        merged = (rows.groupBy("symbol", "date")
                  .agg(F.max_by("close", "tick_order").alias("close"), F.max("tick_order").alias("tick_order"))
                  .select("symbol", "close", "tick_order", "date"))
        merged, n, _ = materialize_measured(merged, [])
        files = max(1, -(-n // (len(dates) * BARS_PER_FILE)))
        # A number of partitions keeps AQE from joining a large date's parts.
        parts = [len(dates) * files] if files > 1 else []
        (merged.repartition(*parts, "date", F.pmod(F.xxhash64("symbol"), F.lit(files)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date").parquet(store_path))
    finally:
        batch.unpersist()


def store_bars(spark: SparkSession, store_path: str, params: ScreenParams) -> DataFrame:
    """``(symbol, date, close)`` of the trailing window from the bar store;
    the date range prunes the store's ``date`` partitions."""
    return (spark.read.schema(BAR_STORE_SCHEMA).parquet(store_path)
            .where(F.col("date").between(F.lit(params.start_date), F.lit(params.end_date)))
            .select("symbol", "date", "close"))


# ----------------------------------------------------------------- SS2

def stream_daily_bars(spark: SparkSession, folder: str, store_path: str, params: ScreenParams,
                      checkpoint: str, watermark: str = "1 day",
                      file_glob: str = "*.parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Roll all available ticks up into the bar store and return the window's
    bars.  The watermark bounds the state: a day's state is dropped once the
    day ends before the watermark (latest tick time of earlier micro-batches
    minus ``watermark``).  Spark may still aggregate a tick that arrives later
    than that into a fresh state; the merge compares bars by their last tick,
    so such a partial bar never replaces a later close."""
    ticks = _not_late(tick_stream(spark, folder, file_glob, max_files_per_trigger), params)
    bars = (ticks.withWatermark("ts", watermark)
            .groupBy(F.window("ts", "1 day").alias("w"), F.col("user_id").alias("symbol"))
            .agg(*_last_bar())
            .select("symbol", F.to_date(F.col("w.start")).alias("date"), "close", "tick_order"))
    _create(spark, store_path)
    q = (bars.writeStream.outputMode("update")
         .foreachBatch(lambda batch, _: merge_into_store(batch, store_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return store_bars(spark, store_path, params)


def _create(spark: SparkSession, store_path: str) -> None:
    """An empty store, if there is none: a stream without ticks leaves one."""
    (spark.createDataFrame([], BAR_STORE_SCHEMA).write.mode("append")
     .partitionBy("date").parquet(store_path))


# ----------------------------------------------------------------- SS1

def incremental_screen(spark: SparkSession, folder: str, store_path: str, params: ScreenParams,
                       checkpoint: str, file_glob: str = "*.parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Feed all available tick files through the bar store, then screen the
    trailing window.  ``max_files_per_trigger`` bounds a micro-batch, so a
    backlog is worked off in several."""
    ticks = _not_late(tick_stream(spark, folder, file_glob, max_files_per_trigger), params)
    _create(spark, store_path)
    touched_path = f"{store_path.rstrip('/')}-touched"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        partial = (batch.groupBy(F.col("user_id").alias("symbol"), F.to_date("ts").alias("date"))
                   .agg(*_last_bar()).select("symbol", "date", "close", "tick_order").persist())
        try:
            merge_into_store(partial, store_path)
            (partial.select("symbol").distinct().withColumn("batch_id", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(touched_path))
        finally:
            partial.unpersist()

    q = (ticks.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return screen_touched(spark, store_path, params)


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def screen_touched(spark: SparkSession, store_path: str, params: ScreenParams) -> DataFrame:
    """The screen of the trailing window: the rows of the last screen of the
    same window and thresholds for symbols without new ticks, and the screen
    of the touched symbols' bars.  A window that has not been screened yet is
    screened whole.  The result is kept for the next run."""
    base = store_path.rstrip("/")
    window = "_".join(str(x) for x in (params.start_date, params.end_date, params.up_day_percent, params.min_up_days,
                                       params.min_period_gain, params.fill))
    seen = set(_partitions(spark, f"{base}-touched"))  # batches since the kept screen
    touched = _read_or_empty(spark, f"{base}-touched", TOUCHED_SCHEMA)
    kept = _read_or_empty(spark, f"{base}-screens", SCREEN_SCHEMA).where(F.col("window") == window)
    run = kept.agg(F.max("run")).first()[0]  # a marker row without a symbol holds it
    if run is None:
        run = 0
        fresh = screen_store(spark, store_path, params)
    else:
        new = checked_broadcast(touched.select("symbol").distinct())
        bars = store_bars(spark, store_path, params)
        again = momentum.momentum_screen(bars.join(new, "symbol", "left_semi"), params)
        old = kept.where((F.col("run") == run) & F.col("symbol").isNotNull())
        fresh = old.join(new, "symbol", "left_anti").select(*momentum.SCREEN_COLUMNS).unionByName(again)
    marker = spark.createDataFrame([(None, None, None, None)],
                                   "symbol bigint, last_price double, last_percent double, start_end_percent double")
    checkpoint_dir(spark)
    result = fresh.checkpoint(eager=True)
    (result.unionByName(marker).withColumns({"window": F.lit(window), "run": F.lit(run + 1).cast("bigint")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("window", "run").parquet(f"{base}-screens"))
    # One screen is kept, and the batches it has not seen.  In this order a
    # run that stops half-way leaves too much, never a screen without the
    # batches that changed since.
    _delete(spark, f"{base}-screens", lambda name: name != f"window={window}")
    _delete(spark, f"{base}-screens/window={window}", lambda name: name != f"run={run + 1}")
    _delete(spark, f"{base}-touched", seen.__contains__)
    return result


def _partitions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the partition folders of ``folder``."""
    if not _exists(spark, folder):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [x.getPath().getName() for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return [n for n in names if "=" in n]


def _delete(spark: SparkSession, folder: str, unwanted: Callable[[str], bool]) -> None:
    """Removes the partitions of ``folder`` with unwanted names."""
    for name in filter(unwanted, _partitions(spark, folder)):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def screen_store(spark: SparkSession, store_path: str, params: ScreenParams) -> DataFrame:
    return momentum.momentum_screen(store_bars(spark, store_path, params), params)
