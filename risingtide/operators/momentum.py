"""Per-symbol window math and the repetitive-upside screen (W1-W4, F1-F3,
F8, A1, A9, JN1, P1).

Every window here uses the same specification -- partition by ``symbol``,
order by ``date`` -- so Catalyst plans one hash Exchange on ``symbol`` and one
Sort for all of them; the derived columns are stacked Window nodes over the
same sorted partitions.  A symbol has at most one bar per day of the
trailing window, so a window partition holds a handful of rows no matter
how large the table grows: there is no hot key inside the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risingtide.functions.numeric import percent_change, period_gain
from risingtide.params import ScreenParams

SCREEN_COLUMNS = ["symbol", "last_price", "last_percent", "start_end_percent"]


def _ordered():
    # ``close`` only breaks ties of a repeated (symbol, date) -- a bar table
    # read from two sources -- so a recomputed task sees the same order
    # (H15); bars from ``daily_bars`` are unique per day and unaffected
    return Window.partitionBy("symbol").orderBy("date", "close")


def _whole():
    # The default frame of last() with ORDER BY stops at the current row, so
    # the whole partition is spelled out.
    return _ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def clean_bars(bars: DataFrame, params: ScreenParams | None = None) -> DataFrame:
    """Drop NULL symbols (pandas' groupby drops them, H6) and optionally
    forward-fill missing closes (H3)."""
    out = bars.where(F.col("symbol").isNotNull())
    if params is not None and params.fill == "ffill":
        out = out.withColumn(
            "close", F.last("close", ignorenulls=True).over(
                _ordered().rowsBetween(Window.unboundedPreceding, 0)))
    return out


def with_percent(bars: DataFrame) -> DataFrame:
    """Day-over-day percent change; NULL on a symbol's first bar.  The
    previous close is a column of its own: written into the formula, which
    uses it three times, the plan would hold three ``lag`` functions."""
    return (bars.withColumn("_prev", F.lag("close").over(_ordered()))
            .withColumn("percent", percent_change(F.col("close"), F.col("_prev"))).drop("_prev"))


def with_period_stats(bars_pct: DataFrame) -> DataFrame:
    """W2-W4 on every row of a symbol: whole-window gain, last close, last
    percent.  ``first``/``last`` keep NULLs like ``iloc[0]``/``iloc[-1]``.
    The window values are columns before the arithmetic uses them, so each
    is computed once."""
    w = _whole()
    return (bars_pct.withColumns({"_first": F.first("close").over(w),
                                  "last_price": F.last("close").over(w),
                                  "last_percent": F.last("percent").over(w)})
            .withColumn("start_end_percent", period_gain(F.col("_first"), F.col("last_price"))).drop("_first"))


def scored_bars(bars: DataFrame, params: ScreenParams | None = None) -> DataFrame:
    return with_period_stats(with_percent(clean_bars(bars, params)))


def up_days(bars: DataFrame, params: ScreenParams) -> DataFrame:
    """bars whose percent change is strictly above the threshold."""
    return with_percent(clean_bars(bars, params)).where(
        F.col("percent") > F.lit(params.up_day_percent))


def upside_counts(bars: DataFrame, params: ScreenParams) -> DataFrame:
    """A1 + F2: up-days per symbol, symbols with at least ``min_up_days``.

    ``count`` is a partial aggregate (map-side combine), and the input is
    already hash-partitioned on ``symbol`` by the window, so the group-by
    needs no second Exchange.
    """
    return (up_days(bars, params).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("up_days"))
            .where(F.col("up_days") >= params.min_up_days))


def repetitive_up_days(bars: DataFrame, params: ScreenParams) -> DataFrame:
    """JN1: the up-day rows of symbols with enough up-days.

    The reference filters a second time with ``isin(valid_symbols)``; here
    the per-symbol count is one more window aggregate over the same
    partition, so no join and no extra shuffle is needed.
    """
    p = F.lit(params.up_day_percent)
    return (with_percent(clean_bars(bars, params))
            .withColumn("up_days", F.count_if(F.col("percent") > p).over(_whole()))
            .where((F.col("percent") > p) & (F.col("up_days") >= params.min_up_days))
            .select("symbol", "date", "close", "percent", "up_days"))


def momentum_screen(bars: DataFrame, params: ScreenParams) -> DataFrame:
    """The repetitive-upside screen: one row per up-day of every symbol with
    at least ``min_up_days`` up-days and a whole-window gain above
    ``min_period_gain`` (P1 projection: symbol, last_price, last_percent,
    start_end_percent).

    Rows repeat per up-day, exactly as the reference returns them.
    """
    p = F.lit(params.up_day_percent)
    scored = scored_bars(bars, params).withColumn(
        "up_days", F.count_if(F.col("percent") > p).over(_whole()))
    return (scored
            .where((F.col("percent") > p)
                   & (F.col("up_days") >= params.min_up_days)
                   & (F.col("start_end_percent") > F.lit(params.min_period_gain)))
            .select(*SCREEN_COLUMNS))


def screened_symbols(screened: DataFrame) -> DataFrame:
    """One row per screened symbol.  The four screen columns are constant per
    symbol; the input is hash-partitioned on ``symbol`` already, which
    satisfies the distinct's clustering, so this adds no Exchange."""
    return screened.dropDuplicates(SCREEN_COLUMNS)


def latest_day_screen(bars: DataFrame, params: ScreenParams) -> DataFrame:
    """F8 + A9: every bar of the symbols whose latest bar is an up-day (the
    variant the reference keeps commented out; its fixtures come from it).

    The latest bar's percent is ``last(percent)`` over the whole partition,
    i.e. arg-max by date without a self-join.
    """
    scored = scored_bars(bars, params)
    return (scored.where(F.col("last_percent") > F.lit(params.up_day_percent))
            .select("symbol", "date", "close", "percent", *SCREEN_COLUMNS[1:]))
