"""Reply archive (S2-S4), HTML document (S8), bucketed bar store and the
screen from stream state (SS1)."""

import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from risingtide.operators import momentum, report
from risingtide.params import DRIVER_PARAMS as P
from risingtide.plans import catalog
from risingtide.sources import bars, driver, replies, sinks, store
from risingtide.streaming import stateful

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 30)


def files_of(folder, end=".parquet"):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(end)}


def files_read(spark, df):
    """Files that the scan of archived replies has opened."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        query = df.select("*")._jdf.queryExecution()
        query.toRdd().count()
        leaves = query.executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        scans = [x for x in scans if "FileScan json" in x.simpleString(1000)]
        return sum(x.metrics().apply("numFiles").value() for x in scans)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# ---------------------------------------------------------------- reply archive

def body(*days):
    return json.dumps([{"date": d, "close": float(i + 1), "volume": 3} for i, d in enumerate(days)])


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("replies") / "archive")
    rows = [(s, f"2023-{m:02d}", body(f"2023-{m:02d}-05", f"2023-{m:02d}-20")) for s in range(40) for m in range(1, 13)]
    rows += [(100, "2023-06", "<html>busy</html>"), (101, "2023-06", None), (102, "2023-06", "{}"), (103, "2023-06", "[1, 2"),
             (104, "2023-06", body("2023-06-05", "soon")), (105, "2023-06", "[]"), (106, "2023-06", '[{"close": 2.0}]'),
             (107, "2023-06", '[{"date": "2023-06-09", "close": "NaN"}]')]
    replies.archive(spark.createDataFrame(rows, "symbol long, month string, body string"), path)
    return path


def test_archive_reads_range_and_symbols_only(spark, archive):
    """Folders of other months and of buckets without a wanted symbol are not
    opened (counted), and the bars are those of the range and the symbols."""
    few = spark.createDataFrame([(3,), (17,), (3,)], "symbol long")
    start, end = dt.date(2023, 5, 6), dt.date(2023, 7, 19)
    all_files = files_read(spark, spark.read.schema("symbol long, body string, month string, bucket int").json(archive))
    months = files_read(spark, replies.scan(spark, archive, start, end))
    both = files_read(spark, replies.scan(spark, archive, start, end, few))
    in_month = len([f for f in files_of(archive, ".json") if any(f"month=2023-{m}" in f for m in ("05", "06", "07"))])
    assert all_files == len(files_of(archive, ".json")) and months == in_month < all_files
    assert 0 < both <= 2 * 3 < months
    good, rejects = replies.bars_and_rejects(spark, archive, start, end, few)
    assert {(r["symbol"], str(r["date"])) for r in good.collect()} == {
        (s, f"2023-{d}") for s in (3, 17) for d in ("05-20", "06-05", "06-20", "07-05")}
    assert rejects.count() == 0


def test_archive_rejects(spark, archive):
    good, rejects = replies.bars_and_rejects(spark, archive, dt.date(2023, 6, 1), dt.date(2023, 6, 30))
    got = {r["symbol"]: r["reason"] for r in rejects.collect()}
    assert got == {100: "no list of bars", 101: "no list of bars", 102: "no list of bars", 103: "no list of bars",
                   104: "no date", 106: "no date"}
    rows = {(r["symbol"], r["date"]): r["close"] for r in good.collect() if r["symbol"] >= 100}
    assert rows == {(104, dt.date(2023, 6, 5)): 1.0, (107, dt.date(2023, 6, 9)): None}


def test_archive_of_nobody(spark, archive):
    none = spark.createDataFrame([], "symbol long")
    good, rejects = replies.bars_and_rejects(spark, archive, dt.date(2023, 1, 1), dt.date(2023, 12, 31), none)
    assert good.count() == 0 and rejects.count() == 0
    assert replies.months_between(dt.date(2023, 11, 30), dt.date(2024, 2, 1)) == ["2023-11", "2023-12", "2024-01", "2024-02"]


# ---------------------------------------------------------------- HTML document

@pytest.fixture(scope="module")
def document(spark):
    rows = [(s, f"Sector {s % 7} & co", "about", True, "grows", f"Company {s}\r", 10**9 + s, 1.5, 6.0, 21.0, "t***u", "a***b") for s in range(300)]
    cols = ("symbol long, core_focus string, core_focus_overview string, is_core_focus_future_potential boolean, "
            "core_focus_future_potential_overview string, company_overview string, marketCap long, last_price double, "
            "last_percent double, start_end_percent double, news_data string, news_source string")
    return report.html_document(report.report_document(spark.createDataFrame(rows, cols).repartition(6), DAY)).cache()


def bytes_of(spark, path):
    return b"".join(open(p.removeprefix("file:"), "rb").read() for p in sinks.document_parts(spark, path, DAY))


def test_document_bytes_in_manifest_order(spark, document, tmp_path):
    path = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = sinks.write_document(document, path, DAY)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = sorted(document.collect(), key=lambda r: (r["block"], r["core_focus"] is not None, r["core_focus"] or "", r["part"],
                                                    r["symbol"] is not None, r["symbol"] or 0))
    want = "".join(r["html"] + "\n" for r in rows).encode()
    assert len(manifest["parts"]) > 1 and manifest["bytes"] == len(want)
    assert bytes_of(spark, path) == want
    text = want.decode()
    assert text.startswith("<!DOCTYPE html>") and text.rstrip().endswith("</html>") and text.count("<li>Sector") == 7
    assert sorted(r["html"] for r in sinks.read_document(spark, path, DAY).collect()) == sorted(r["html"] for r in rows)


def test_document_attempts(spark, document, tmp_path):
    """A failed attempt leaves the old document; a new one replaces it and
    takes away what a lost driver left."""
    path, day = str(tmp_path), tmp_path / f"run_date={DAY.isoformat()}"
    assert sinks.document_parts(spark, path, DAY) == [] and sinks.read_document(spark, path, DAY).count() == 0
    sinks.write_document(document, path, DAY)
    before = bytes_of(spark, path)
    broken = document.withColumn("html", F.when(F.col("symbol") == 150, F.raise_error(F.lit("no template"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="no template"):
        sinks.write_document(broken, path, DAY)
    assert bytes_of(spark, path) == before
    assert len([x for x in os.listdir(day) if x.startswith("attempt-")]) == 1
    (day / "attempt-lost").mkdir()
    (day / "attempt-lost" / "part-0").write_text("half")
    sinks.write_document(document.where("symbol is null or symbol < 9"), path, DAY)
    assert 0 < len(bytes_of(spark, path)) < len(before)
    names = {x for x in os.listdir(day) if not x.startswith(".")}
    assert len(names) == 2 and sinks.MANIFEST in names
    part = sinks.document_parts(spark, path, DAY)[0].removeprefix("file:")
    with open(part, "ab") as f:
        f.write(b"more")
    with pytest.raises(ValueError, match="manifest"):
        sinks.document_parts(spark, path, DAY)
    sinks.write_document(document.limit(0), path, DAY)
    assert bytes_of(spark, path) == b""


# ---------------------------------------------------------------- bucketed store

def partial(spark, rows):
    return spark.createDataFrame(rows, "symbol long, date date, close double, tick_order long").withColumn(
        "tick_order", F.col("tick_order").cast(bars.TICK_ORDER_TYPE))


def test_store_merges_and_keeps_its_buckets(spark, tmp_path):
    name, path = "bars_merge_test", str(tmp_path / "bars")
    store.create(spark, name, path, buckets=4)
    store.create(spark, name, path, buckets=4)
    d = lambda m, i: dt.date(2024, m, i)
    store.merge(partial(spark, [(s, d(1, i), float(i), 10) for s in range(20) for i in range(1, 9)] + [(1, None, 1.0, 1)]), name)
    january = files_of(f"{path}/month=2024-01")
    store.merge(partial(spark, [(s, d(2, 1), 2.0, 5) for s in range(20)]), name)
    assert files_of(f"{path}/month=2024-01") == january  # only the months of the ticks are rewritten
    later = partial(spark, [(3, d(1, 4), 99.0, 11), (4, d(1, 4), 98.0, 9), (50, d(1, 4), 1.0, 1)])
    for _ in range(2):
        store.merge(later, name)
    got = {(r["symbol"], r["date"]): r["close"] for r in store.bars(spark, name, d(1, 1), d(2, 28)).collect()}
    assert len(got) == 20 * 9 + 1
    assert (got[3, d(1, 4)], got[4, d(1, 4)], got[50, d(1, 4)]) == (99.0, 4.0, 1.0)
    assert store.bars(spark, name, d(1, 7), d(1, 8)).count() == 40
    store.merge(later.limit(0), name)
    for month in ("2024-01", "2024-02"):
        per_bucket = [f.split("_")[-1].split(".")[0] for f in files_of(f"{path}/month={month}")]
        assert per_bucket and len(per_bucket) == len(set(per_bucket)) <= 4
    screen = momentum.momentum_screen(store.bars(spark, name, d(1, 1), d(2, 28)), P)
    plan = screen._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "PartitionFilters: [month" in plan
    spark.sql(f"DROP TABLE {name}")


def test_screen_on_the_store_equals_the_screen_of_ticks(spark):
    want = sorted(map(tuple, catalog.QUERIES["momentum_screen"](spark, SF).collect()))
    assert sorted(map(tuple, catalog.QUERIES["screen_from_store"](spark, SF).collect())) == want


# ---------------------------------------------------------------- screen from state

def screen_rows(df):
    return sorted(map(tuple, df.collect()))


def test_stateful_screen_with_late_files_and_restarts(spark, tmp_path):
    """Files that come late, twice and in small batches, over three starts of
    the stream: the batch screen of all ticks."""
    ev = driver.table(spark, SF, "events")
    base, folder = str(tmp_path), str(tmp_path / "ticks")
    run = lambda: screen_rows(stateful.stateful_screen(
        spark, folder, f"{base}/screens", P, f"{base}/chk", watermark="40 days", max_files_per_trigger=2))
    ev.where("event_id % 3 = 0").repartition(3).write.mode("append").parquet(folder)
    first = run()
    assert first == screen_rows(momentum.momentum_screen(
        bars.daily_bars(bars.ticks_in_window(driver.ticks(spark, SF).where("event_id % 3 = 0"), P.start_date, P.end_date)), P))
    ev.where("event_id % 3 = 1").coalesce(1).write.mode("append").parquet(folder)
    ev.where("event_id % 3 < 1").coalesce(1).write.mode("append").parquet(folder)  # a second time
    run()
    ev.where("event_id % 3 = 2").coalesce(1).write.mode("append").parquet(folder)
    want = screen_rows(catalog.QUERIES["momentum_screen"](spark, SF))
    assert want and run() == want
    assert run() == want  # nothing new
    assert len([x for x in os.listdir(f"{base}/screens") if x.startswith("batch=")]) == 1  # whatever the triggers were
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


class Days(dict):
    """The parts of a map state that the processor uses."""

    containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.get, dict.__setitem__, dict.__delitem__
    iterator = dict.items


class Handle:
    def __init__(self):
        self.days, self.timers = Days(), []

    def getMapState(self, *_):
        return self.days

    def registerTimer(self, at):
        self.timers.append(at)


def test_state_keeps_last_ticks_and_drops_old_days():
    handle, processor = Handle(), stateful.LastBars(window_days=10)
    processor.init(handle)

    def feed(*rows):
        out = list(processor.handleInputRows((7,), iter([pd.DataFrame(rows, columns=["day", "micros", "tie", "close"])]), None))
        return {str(d): c for pdf in out for d, c in zip(pdf["date"], pdf["close"], strict=True)}

    a, b = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert feed((a, 5, 1, 1.0), (a, 5, 2, 2.0), (a, 4, 9, 3.0)) == {"2024-01-01": 2.0}
    assert feed((a, 5, 2, 8.0), (a, 1, 1, 9.0)) == {}  # a replay and a late tick change nothing
    assert feed((b, 9, 0, 4.0)) == {"2024-01-01": 2.0, "2024-01-02": 4.0}
    assert len(handle.timers) == 2

    class Expired:
        def getExpiryTimeInMs(self):
            return handle.timers[0]

    assert list(processor.handleExpiredTimer((7,), None, Expired())) == []
    assert [k[0] for k in handle.days] == [(b - dt.date(1970, 1, 1)).days]


def test_ticks_are_reduced_before_the_shuffle():
    ts = pd.Timestamp("2024-01-01")
    rows = pd.DataFrame([(1, ts, ts.date(), m, t, c) for m, t, c in [(1, 1, 1.0), (2, 1, 2.0), (2, 3, 3.0), (9, 9, None)]],
                        columns=["symbol", "ts", "day", "micros", "tie", "close"])
    out = pd.concat(stateful.partial_bars(iter([rows])))
    assert out[["micros", "tie", "close"]].values.tolist() == [[2, 3, 3.0]]


class Value:
    """The parts of a value state that the processor uses; the calls are kept."""

    def __init__(self):
        self.held, self.calls = None, []

    def get(self):
        self.calls.append("get")
        return self.held

    def update(self, value):
        self.calls.append("update")
        self.held = value

    def clear(self):
        self.calls.append("clear")
        self.held = None


class ValueHandle:
    def __init__(self):
        self.value, self.timers = Value(), []

    def getValueState(self, *_):
        return self.value

    def registerTimer(self, at):
        self.timers.append(at)


def test_a_symbol_costs_as_many_state_calls_whatever_its_days_and_ticks():
    handle, processor = ValueHandle(), stateful.LastBarRows(window_days=10)
    processor.init(handle)

    def feed(*rows):
        handle.value.calls.clear()
        handle.timers.clear()
        out = list(processor.handleInputRows((7,), iter([dict(zip(("day", "micros", "tie", "close"), r, strict=True)) for r in rows]), None))
        return [dict(zip(r["days"], r["closes"], strict=True)) for r in out], handle.value.calls, handle.timers

    ticks = [(day, day * 100 + m, t, day + m / 10 + t / 100) for day in range(50, 59) for m in range(5) for t in (2, 1)]
    bars = {day: day + 4 / 10 + 2 / 100 for day in range(50, 59)}
    timer = (50 + 11) * 86_400_000
    assert feed(*ticks) == ([bars], ["get", "update"], [timer])
    assert feed(*ticks) == ([], ["get"], [])  # a replay
    assert feed((51, 5104, 3, 1.0), (60, 1, 1, 2.0)) == ([bars | {51: 1.0, 60: 2.0}], ["get", "update"], [])
    assert feed((49, 4900, 1, 3.0)) == ([bars | {51: 1.0, 60: 2.0, 49: 3.0}], ["get", "update"], [timer - 86_400_000])

    class At:
        def __init__(self, ms):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: ms

    handle.timers.clear()
    assert list(processor.handleExpiredTimer((7,), At(timer), At(timer - 86_400_000))) == []
    assert sorted(handle.value.held[0]) == [*range(51, 59), 60] and handle.timers == [timer + 86_400_000]
    processor.handleExpiredTimer((7,), At(0), At((60 + 11) * 86_400_000))
    assert handle.value.held is None
