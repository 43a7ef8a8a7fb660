import datetime as dt
import math

from risingtide.operators import momentum
from risingtide.params import ScreenParams
from risingtide.sources import bars as bars_src

P = ScreenParams(end_date=dt.date(2024, 1, 10), window_days=10)
D = [dt.date(2024, 1, d) for d in range(1, 11)]


def frame(spark, rows):
    return spark.createDataFrame(rows, bars_src.BAR_SCHEMA)


def series(sym, closes):
    return [(sym, D[i], c) for i, c in enumerate(closes)]


def by_symbol(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["symbol"], []).append(r)
    return out


def test_percent_change_first_row_null_and_zero_rules(spark):
    rows = series(1, [10.0, 11.0, 0.0, 5.0, 0.0, 0.0, -3.0]) + series(2, [4.0])
    got = {(r.symbol, r.date): r.percent for r in momentum.with_percent(frame(spark, rows)).collect()}
    assert got[(1, D[0])] is None                      # first bar
    assert math.isclose(got[(1, D[1])], (11.0 / 10.0 - 1) * 100)
    assert got[(1, D[2])] == -100.0
    assert got[(1, D[3])] == float("inf")               # x / 0, x > 0
    assert got[(1, D[5])] is None                       # 0 / 0
    assert got[(1, D[6])] == float("-inf")              # x / 0, x < 0
    assert got[(2, D[0])] is None                       # one bar only


def test_null_close_and_ffill(spark):
    rows = series(1, [10.0, None, 12.0])
    plain = {r.date: r.percent for r in momentum.with_percent(frame(spark, rows)).collect()}
    assert plain[D[1]] is None and plain[D[2]] is None
    filled = momentum.with_percent(momentum.clean_bars(frame(spark, rows), P.with_(fill="ffill")))
    got = {r.date: r.percent for r in filled.collect()}
    assert got[D[1]] == 0.0
    assert math.isclose(got[D[2]], 20.0)


def test_null_symbol_dropped(spark):
    rows = series(None, [1.0, 2.0, 4.0, 8.0, 16.0]) + series(7, [1.0, 2.0, 4.0, 8.0])
    out = momentum.momentum_screen(frame(spark, rows), P).collect()
    assert {r.symbol for r in out} == {7}


def test_screen_thresholds(spark):
    # exactly 3 up-days (> 5 %), gain 33.1 % -> kept, one row per up-day
    a = series(1, [100.0, 110.0, 121.0, 133.1])
    # only 2 up-days; a 4 % day does not count
    b = series(2, [100.0, 104.0, 114.4, 125.84, 125.84])
    # gain exactly 20 % is not > 20
    c = series(3, [100.0, 106.0, 112.36, 120.0, 100.0, 120.0])
    # 3 up-days but the window ends lower
    d = series(4, [100.0, 110.0, 50.0, 60.0, 70.0, 40.0])
    got = by_symbol(momentum.momentum_screen(frame(spark, a + b + c + d), P))
    assert set(got) == {1}
    assert len(got[1]) == 3
    r = got[1][0]
    assert r.last_price == 133.1
    assert math.isclose(r.start_end_percent, (133.1 - 100.0) / 100.0 * 100)
    assert math.isclose(r.last_percent, (133.1 / 121.0 - 1) * 100)


def test_counts_and_latest_day(spark):
    a = series(1, [100.0, 110.0, 121.0, 133.1])
    b = series(2, [100.0, 110.0, 100.0])
    df = frame(spark, a + b)
    counts = {r.symbol: r.up_days for r in momentum.upside_counts(df, P).collect()}
    assert counts == {1: 3}
    latest = by_symbol(momentum.latest_day_screen(df, P))
    assert set(latest) == {1} and len(latest[1]) == 4


def test_screen_plan_has_one_window_exchange(spark):
    rows = series(1, [100.0, 110.0, 121.0, 133.1])
    plan = momentum.momentum_screen(frame(spark, rows), P)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_tick_rollup_and_pushdown(spark):
    ticks = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 5, 9), 10.0), (1, dt.datetime(2024, 1, 5, 16), 11.0),
         (1, dt.datetime(2024, 1, 6, 9), 12.0), (2, dt.datetime(2023, 12, 1, 9), 1.0)],
        "user_id bigint, ts timestamp_ntz, value double")
    got = {(r.symbol, r.date): r.close for r in bars_src.daily_bars(
        bars_src.ticks_in_window(ticks, P.start_date, P.end_date)).collect()}
    assert got == {(1, dt.date(2024, 1, 5)): 11.0, (1, dt.date(2024, 1, 6)): 12.0}


def test_nan_close_is_null(spark):
    ticks = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 5, 9), float("nan")), (1, dt.datetime(2024, 1, 6, 9), 2.0),
         (1, dt.datetime(2024, 1, 7, 9), 3.0)],
        "user_id bigint, ts timestamp_ntz, value double")
    bars = bars_src.daily_bars(ticks)
    got = {r.date: (r.close, r.percent) for r in momentum.with_percent(bars).collect()}
    assert got[dt.date(2024, 1, 5)] == (None, None)
    assert got[dt.date(2024, 1, 6)][1] is None          # NaN never counts as an up-day
    assert math.isclose(got[dt.date(2024, 1, 7)][1], 50.0)


def test_rounding_rules(spark):
    from pyspark.sql import functions as F

    from risingtide.functions.numeric import round_half_even_long
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (1000.4999,)], "x double")
    got = [r.v for r in df.select(round_half_even_long(F.col("x")).alias("v")).collect()]
    assert got == [0, 2, 2, -2, 1000]


def test_percent_exactly_at_threshold_is_not_an_up_day(spark):
    rows = series(1, [100.0, 105.0, 110.25, 115.7625, 121.550625])  # +5 % each day
    pct = [r.percent for r in momentum.with_percent(frame(spark, rows)).orderBy("date").collect()]
    assert pct[0] is None
    assert all(math.isclose(p, 5.0) for p in pct[1:])
    n_up = sum(1 for p in pct[1:] if p > 5.0)           # float noise decides, as in pandas
    ups = momentum.up_days(frame(spark, rows), P).count()
    assert ups == n_up


def test_symbol_on_both_listings_keeps_its_bars_once(spark):
    bars = frame(spark, series(1, [1.0, 2.0]) + series(2, [3.0]))
    universe = spark.createDataFrame([(1,), (1,), (3,)], "symbol bigint")  # NYSE and NASDAQ
    got = sorted((r.symbol, r.date) for r in bars_src.price_scan_for_universe(bars, universe).collect())
    assert got == [(1, D[0]), (1, D[1])]


def test_repeated_bar_is_ordered_deterministically(spark):
    # the same day twice (two sources): the duplicate gives a 0 % change,
    # as concatenated duplicates did in the reference, whatever the row order
    rows = series(1, [10.0, 12.0]) + [(1, D[1], 12.0)] + [(1, D[2], 11.0), (1, D[2], 13.0)]
    for order in (rows, list(reversed(rows))):
        got = [(r.date, r.close, r.percent) for r in
               momentum.with_percent(frame(spark, order)).orderBy("date", "close").collect()]
        assert got[0][2] is None and got[2][2] == 0.0
        assert math.isclose(got[1][2], (12.0 / 10.0 - 1) * 100)
        assert math.isclose(got[3][2], (11.0 / 12.0 - 1) * 100)
        assert math.isclose(got[4][2], (13.0 / 11.0 - 1) * 100)


def test_ticks_at_the_same_time_pick_the_same_close(spark):
    at = dt.datetime(2024, 1, 5, 16)
    rows = [(4, 1, dt.datetime(2024, 1, 5, 9), 10.0), (-3, 1, at, 11.0), (7, 1, at, 10.5), (2, 1, at, 10.8),
            (9, 1, at, None)]
    without_id = set()
    for order in (rows, list(reversed(rows)), rows[1:] + rows[:1]):
        ticks = spark.createDataFrame(order, "event_id bigint, user_id bigint, ts timestamp_ntz, value double")
        # spread over partitions so the partial aggregates see the tie split up
        got = bars_src.daily_bars(ticks.repartition(3)).collect()
        assert [(r.symbol, r.close) for r in got] == [(1, 10.5)]  # the largest id that has a price
        without_id |= {r.close for r in bars_src.daily_bars(ticks.drop("event_id").repartition(3)).collect()}
    assert len(without_id) == 1 and without_id <= {11.0, 10.5, 10.8}


def test_tick_order_at_the_ends_of_its_range(spark):
    """Late years, early years and the largest ids keep their order."""
    big = 2**63 - 1
    rows = [(dt.datetime(1900, 1, 1), big), (dt.datetime(1970, 1, 1), -big), (dt.datetime(1970, 1, 1), big),
            (dt.datetime(1970, 1, 1, 0, 0, 0, 1), -big), (dt.datetime(9999, 12, 31), -big), (dt.datetime(9999, 12, 31), big)]
    df = spark.createDataFrame([(t, i, 1.0) for t, i in rows], "ts timestamp_ntz, event_id bigint, value double")
    keys = [r.tick_order for r in bars_src.with_tick_order(df).collect()]
    assert None not in keys and keys == sorted(set(keys))


def test_tick_rollup_is_a_hash_aggregate(spark):
    """No sort of raw ticks, in the roll-up or in a merge of bars."""
    from conftest import SF_SMALL
    from risingtide.sources import driver
    from risingtide.streaming import daily

    plans = [driver.prices(spark, SF_SMALL, P), bars_src.daily_bars(driver.ticks(spark, SF_SMALL), count=True)]
    ticks = bars_src.with_tick_order(driver.ticks(spark, SF_SMALL))
    plans.append(ticks.groupBy("user_id").agg(*daily._last_bar()))
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan and "Sort [" not in plan


def test_window_functions_are_computed_once(spark):
    plan = momentum.momentum_screen(frame(spark, series(1, [1.0, 2.0])), P)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lag(") == 1 and plan.count("first(close") <= 2 and plan.count("last(") <= 4


def test_bars_from_json_drop_bad_replies(spark):
    raw = spark.createDataFrame([
        ("OKLO", '[{"date": "2024-01-02", "close": 10.0, "volume": 5}, {"date": "2024-01-03", "close": 11.5}]'),
        ("SMR", "<html>rate limited</html>"),
        ("NNE", '[{"date": "bad", "close": 3.0}]')], "symbol string, body string")
    got = sorted((r.symbol, r.date, r.close) for r in bars_src.bars_from_json(raw).collect())
    assert got == [("NNE", None, 3.0), ("OKLO", dt.date(2024, 1, 2), 10.0),
                   ("OKLO", dt.date(2024, 1, 3), 11.5)]
