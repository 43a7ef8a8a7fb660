"""Further market signals (X1-X3): volume spikes, relative strength and
volatility.

X1 and X3 look back over a fixed number of bars of a symbol's whole history.
A plain window would sort a symbol's history in one task.  Here bars are
numbered without that: ranks within calendar chunks plus the counts of earlier
chunks, a small table.  The numbered bars are cut into blocks of equal length,
each with a halo of the rows its first frames look back on, so every window
partition holds ``block`` + ``halo`` rows whatever the history's length, and
the result is the same as over the uncut history.

X2 compares a symbol with the mean of the universe in the same trailing
window.  The mean is one partial aggregate per window; it is joined back by the
window's end, a size-checked broadcast, so no task sees a window whole.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from risingtide.functions.numeric import percent_change, period_gain
from risingtide.operators.momentum import clean_bars
from risingtide.params import ScreenParams
from risingtide.session import checked_broadcast, materialize

#: Bars that a volume is compared with, and returns of a volatility.
SPIKE_BARS, VOLATILITY_RETURNS = 20, 20
#: A volume this many times the average is a spike.
SPIKE_RATIO = 2.0
#: Days of a chunk in which bars are ranked, and rows of a block.
CHUNK_DAYS, BLOCK_ROWS = 256, 4096
#: Gains enter the universe mean in millionths of a percent, so that the sum
#: does not depend on the order of addition; larger ones take no part.
GAIN_UNITS, GAIN_LIMIT = 1_000_000, 1e12


def numbered(bars: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """``bars`` with ``_n``, the place of a bar in its symbol's history from
    0, by (date, close).  NULL dates come first."""
    chunk = F.coalesce(F.floor(F.unix_date("date") / chunk_days), F.lit(-(2**31))).cast("bigint")
    rows = bars.withColumn("_chunk", chunk)
    earlier = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy("symbol", "_chunk").agg(F.count(F.lit(1)).alias("_size"))
              .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size"))
    rank = F.row_number().over(Window.partitionBy("symbol", "_chunk").orderBy("date", "close"))
    return (rows.withColumn("_rank", rank).join(before, ["symbol", "_chunk"])
            .withColumn("_n", F.col("_before") + F.col("_rank") - 1).drop("_chunk", "_rank", "_before"))


def sliding(bars: DataFrame, halo: int, compute: Callable[[DataFrame, WindowSpec], DataFrame],
            block_rows: int = BLOCK_ROWS, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """``compute(rows, window)`` over every symbol's history, where the frames
    it puts on ``window`` reach back ``halo`` rows at most."""
    if block_rows < halo:
        raise ValueError("a block must hold its neighbour's halo")
    n, block = F.col("_n"), F.floor(F.col("_n") / block_rows).cast("bigint")
    place = lambda b, lent: F.struct(b.alias("block"), F.lit(lent).alias("lent"))
    places = F.when(n % block_rows >= block_rows - halo, F.array(place(block, False), place(block + 1, True))).otherwise(
        F.array(place(block, False)))
    rows = (numbered(bars, chunk_days).withColumn("_place", F.explode(places))
            .withColumns({"_block": F.col("_place.block"), "_lent": F.col("_place.lent")}).drop("_place"))
    out = compute(rows, Window.partitionBy("symbol", "_block").orderBy("_n"))
    return out.where(~F.col("_lent")).drop("_n", "_block", "_lent")


def volume_spike(bars: DataFrame, look_back: int = SPIKE_BARS, ratio: float = SPIKE_RATIO, **cut) -> DataFrame:
    """``(symbol, date, n_ticks, avg_ticks, volume_ratio, is_spike)`` of
    every bar: its ticks against the average of the ``look_back`` bars
    before it, or of as many as there are.  NULL on a symbol's first bar, and
    the ratio where the average is 0."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("avg_ticks", F.avg("n_ticks").over(w.rowsBetween(-look_back, -1)))

    rows = sliding(clean_bars(bars).select("symbol", "date", "close", "n_ticks"), look_back, compute, **cut)
    times = F.when(F.col("avg_ticks") > 0, F.col("n_ticks") / F.col("avg_ticks"))
    return (rows.withColumn("volume_ratio", times).withColumn("is_spike", F.coalesce(F.col("volume_ratio") >= ratio, F.lit(False)))
            .select("symbol", "date", "n_ticks", "avg_ticks", "volume_ratio", "is_spike"))


def volatility(bars: DataFrame, returns: int = VOLATILITY_RETURNS, **cut) -> DataFrame:
    """``(symbol, date, percent, n_returns, volatility)``: the sample
    deviation of the last ``returns`` daily percent changes, the bar's own
    included.  Changes that are NULL or infinite take no part; fewer than two
    give NULL.  Two passes over the frame's values in their order, first the
    mean, so that large changes don't cancel and a re-run gives the same
    digits."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        changed = (rows.withColumn("_prev", F.lag("close").over(w))
                   .withColumn("percent", percent_change(F.col("close"), F.col("_prev"))).drop("_prev"))
        usable = F.when(F.abs("percent") != float("inf"), F.col("percent"))
        return changed.withColumn("_frame", F.collect_list(usable).over(w.rowsBetween(1 - returns, 0)))

    rows = sliding(clean_bars(bars).select("symbol", "date", "close"), returns, compute, **cut)
    zero = F.lit(0.0)
    mean = F.aggregate("_frame", zero, lambda a, x: a + x) / F.col("n_returns")
    squares = F.aggregate("_frame", zero, lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean")))
    return (rows.withColumn("n_returns", F.size("_frame"))
            .withColumn("_mean", F.when(F.col("n_returns") > 1, mean))
            .withColumn("volatility", F.when(F.col("n_returns") > 1, F.sqrt(squares / (F.col("n_returns") - 1))))
            .select("symbol", "date", "percent", "n_returns", "volatility"))


def window_gains(bars: DataFrame, params: ScreenParams, step_days: int, windows: int) -> DataFrame:
    """``(window_end, symbol, start_end_percent)``: W2 in each of ``windows``
    trailing windows, which end ``step_days`` apart, the last on
    ``params.end_date``.  A bar takes part in each window that its date lies
    in; which those are is arithmetic, not a join."""
    days = F.date_diff(F.lit(params.end_date), F.col("date"))
    first = F.greatest(F.ceil((days - params.window_days) / step_days), F.lit(0))
    last = F.least(F.floor(days / step_days), F.lit(windows - 1))
    in_windows = (clean_bars(bars).where(F.col("date").between(
        F.lit(params.start_date - _dt.timedelta(days=step_days * (windows - 1))), F.lit(params.end_date)))
        .withColumns({"_first": first, "_last": last}).where("_first <= _last")
        .select("symbol", "date", "close", F.explode(F.sequence("_first", "_last")).alias("_window")))
    ends = F.date_sub(F.lit(params.end_date), (F.col("_window") * step_days).cast("int"))
    return (in_windows.groupBy("_window", "symbol")
            .agg(F.min_by("close", "date").alias("_open"), F.max_by("close", "date").alias("_close"))
            .select(ends.alias("window_end"), "symbol", period_gain(F.col("_open"), F.col("_close")).alias("start_end_percent")))


def relative_strength(bars: DataFrame, params: ScreenParams, step_days: int = 5, windows: int = 4) -> DataFrame:
    """``(window_end, symbol, start_end_percent, universe_mean,
    relative_strength)``: a symbol's gain in a trailing window less the mean
    gain of all symbols in it.  Bars are one per symbol and day.  A gain that
    is NULL, infinite or beyond ``GAIN_LIMIT`` takes no part in the mean; a
    window without any has no mean."""
    gains = materialize(window_gains(bars, params, step_days, windows))
    usable = F.abs("start_end_percent") < GAIN_LIMIT
    units = F.when(usable, F.floor(F.col("start_end_percent") * GAIN_UNITS)).cast("decimal(20,0)")
    mean = F.sum(units).cast("double") / F.count(units) / GAIN_UNITS
    means = checked_broadcast(gains.groupBy("window_end").agg(F.when(F.count(units) > 0, mean).alias("universe_mean")))
    return (gains.join(means, "window_end")
            .withColumn("relative_strength", F.col("start_end_percent") - F.col("universe_mean"))
            .select("window_end", "symbol", "start_end_percent", "universe_mean", "relative_strength"))
