"""The incremental screen with its bars in state (SS1).

``daily.incremental_screen`` keeps bars in a store of files and reads the
touched symbols back from it.  Here the last bars of every symbol are state of
the stream: a trigger updates the bars of the symbols it has ticks of and
hands on those symbols' bars, and the screen of the batch runs on them, by the
same operators.  No store of bars is read or rewritten.

The state of a symbol holds for each day the close and the last tick's order.
A tick older than a day's last one changes nothing, so late files and replays
are harmless.  An event-time timer per symbol drops the days that have left the
trailing window behind the watermark, so state is bounded by ``window_days`` +
the watermark's delay per symbol, and a symbol without ticks ends up without
state.

Every call on the state is a message between the Python worker and the JVM, and
so is every frame or batch of rows handed over.  A symbol's days are therefore
one value (``LastBarRows``): a trigger reads it, writes it if a close changed
and hands the bars on as one row, whatever the number of ticks and days.

Ticks are reduced to partial bars inside each map task (``mapInPandas``)
before they are shuffled to their symbol's state, so a hot symbol sends a few
rows per task, not its ticks.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from risingtide.operators import momentum
from risingtide.params import ScreenParams
from risingtide.session import checked_broadcast, checkpoint_dir
from risingtide.streaming.daily import _delete, _exists, _partitions, tick_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTIAL = "symbol bigint, ts timestamp, day date, micros bigint, tie bigint, close double"
DAYS = "days array<int>, micros array<bigint>, ties array<bigint>, closes array<double>"
HELD = "symbol bigint, days array<int>, closes array<double>"
RESULT = ("symbol bigint, last_price double, last_percent double, start_end_percent double, batch bigint")


def partial_bars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last tick of every (symbol, day) of an Arrow batch."""
    for pdf in frames:
        pdf = pdf[pdf["close"].notna()]
        last = pdf.sort_values(["micros", "tie"], kind="stable").drop_duplicates(["symbol", "day"], keep="last")
        yield last[["symbol", "ts", "day", "micros", "tie", "close"]]


class LastBars(StatefulProcessor):
    """State of a symbol: day -> (micros, tie, close) of its last tick; for
    ``transformWithStateInPandas``, an entry of a map state per day."""

    def __init__(self, window_days: int):
        self.window_days = window_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day int", "micros bigint, tie bigint, close double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {k[0]: v for k, v in self.days.iterator()}
        old = set(held)
        changed = _take(held, ((_number(day), int(micros), int(tie), float(close)) for pdf in rows for day, micros, tie, close
                               in zip(pdf["day"], pdf["micros"], pdf["tie"], pdf["close"], strict=True)))
        for day in changed:
            self.days.updateValue((day,), held[day])
            if day not in old:
                self.handle.registerTimer(self._expiry(day))
        if changed:
            yield pd.DataFrame({"symbol": [key[0]] * len(held), "date": [_EPOCH + _dt.timedelta(days=d) for d in held],
                                "close": [v[2] for v in held.values()]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for (day,) in [k for k in self.days.keys() if self._expiry(k[0]) <= expiredTimerInfo.getExpiryTimeInMs()]:
            self.days.removeKey((day,))
        return iter([])

    def _expiry(self, day: int) -> int:
        return _millis(day + self.window_days + 1)

    def close(self) -> None:
        pass


class LastBarRows(LastBars):
    """The same for ``transformWithState``: a symbol's days are one value, its
    bars one row, and its timer that of its earliest day.  Spark refuses to
    start it on a checkpoint of the other."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getValueState("days", DAYS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._held()
        first = min(held, default=None)
        if _take(held, ((r["day"], r["micros"], r["tie"], r["close"]) for r in rows)):
            self._keep(held, first)
            yield Row(symbol=key[0], days=list(held), closes=[v[2] for v in held.values()])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        self._keep({d: v for d, v in self._held().items() if self._expiry(d) > now})
        return iter([])

    def _held(self) -> dict[int, tuple[int, int, float]]:
        value = self.days.get()
        return {} if value is None else {d: v for d, *v in zip(*value, strict=True)}

    def _keep(self, held: dict, timed: int | None = None) -> None:
        """``timed``: the earliest day before, which has its timer."""
        if not held:
            return self.days.clear()
        self.days.update((list(held), *map(list, zip(*held.values(), strict=True))))
        if min(held) != timed:
            self.handle.registerTimer(self._expiry(min(held)))


def _take(held: dict, ticks: Iterator[tuple]) -> list[int]:
    """Puts the ticks ``(day, micros, tie, close)`` that are newer than their
    day's last one into ``held``; the days that changed."""
    changed = {}
    for day, micros, tie, close in ticks:
        last = held.get(day)
        if last is None or (micros, tie) > (last[0], last[1]):
            held[day] = (micros, tie, close)
            changed[day] = True
    return list(changed)


_EPOCH = _dt.date(1970, 1, 1)


def _number(day) -> int:
    return (pd.Timestamp(day).date() - _EPOCH).days


def _millis(day: int) -> int:
    return day * 86_400_000


def stateful_screen(spark: SparkSession, folder: str, result_path: str, params: ScreenParams, checkpoint: str,
                    watermark: str = "2 days", max_files_per_trigger: int | None = None) -> DataFrame:
    """Feeds all available tick files through the state and returns the screen
    of ``params``' window as it stands.  Each trigger writes the screen rows of
    the symbols it touched, or a row without values for a symbol that the
    screen no longer keeps; the newest batch of a symbol counts.  A batch that
    is repeated after a failure replaces its own rows."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    checkpoint_dir(spark)
    lo = _dt.datetime.combine(params.start_date, _dt.time())
    ticks = (tick_stream(spark, folder, max_files_per_trigger=max_files_per_trigger)
             .where((F.col("ts") >= F.lit(lo)) & F.col("user_id").isNotNull())
             .select(F.col("user_id").alias("symbol"), "ts", F.to_date("ts").alias("day"), F.unix_micros("ts").alias("micros"),
                     F.coalesce("event_id", F.lit(0)).cast("bigint").alias("tie"), F.col("value").alias("close"))
             .mapInPandas(partial_bars, PARTIAL).withColumn("day", F.unix_date("day")))
    held = (ticks.withWatermark("ts", watermark).groupBy("symbol")
            .transformWithState(LastBarRows(params.window_days), HELD, "Update", "EventTime")
            .select("symbol", F.explode(F.arrays_zip("days", "closes")).alias("bar"))
            .select("symbol", F.date_from_unix_date("bar.days").alias("date"), F.col("bar.closes").alias("close")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        bars = batch.checkpoint(eager=True)
        window = bars.where(F.col("date").between(F.lit(params.start_date), F.lit(params.end_date)))
        screened = momentum.momentum_screen(window, params)
        touched = bars.select("symbol").distinct()
        empty = touched.join(screened.select("symbol").distinct(), "symbol", "left_anti").select(
            "symbol", *[F.lit(None).cast("double").alias(c) for c in momentum.SCREEN_COLUMNS[1:]])
        (screened.unionByName(empty).withColumn("batch", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(result_path))

    try:
        q = (held.writeStream.outputMode("update").foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    compact(spark, result_path)
    return current_screen(spark, result_path)


def _newest(spark: SparkSession, result_path: str) -> DataFrame:
    rows = spark.read.schema(RESULT).parquet(result_path)
    newest = checked_broadcast(rows.groupBy("symbol").agg(F.max("batch").alias("newest")))
    return rows.join(newest, "symbol").where(F.col("batch") == F.col("newest")).drop("newest")


def compact(spark: SparkSession, result_path: str) -> None:
    """Brings every symbol's newest rows into the last batch's folder and
    removes the others, so the result follows the symbols and not the number of
    triggers.  Stopped half-way it leaves rows that newer ones outrank."""
    batches = sorted(int(n.split("=")[1]) for n in _partitions(spark, result_path))
    if len(batches) < 2:
        return
    last = batches[-1]
    kept = _newest(spark, result_path).where("last_price is not null").checkpoint(eager=True)
    (kept.withColumn("batch", F.lit(last).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(result_path))
    _delete(spark, result_path, lambda name: name != f"batch={last}")


def current_screen(spark: SparkSession, result_path: str) -> DataFrame:
    """The screen rows of every symbol's newest batch."""
    if not _exists(spark, result_path):
        return spark.createDataFrame([], RESULT).select(*momentum.SCREEN_COLUMNS)
    return _newest(spark, result_path).where(F.col("last_price").isNotNull()).select(*momentum.SCREEN_COLUMNS)
