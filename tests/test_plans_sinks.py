"""Plan-shape assertions and the sinks."""

import datetime as dt

import pytest

from conftest import SF_SMALL
from risingtide.params import DRIVER_PARAMS as P
from risingtide.plans import catalog, job
from risingtide.sources import driver, sinks
from risingtide.streaming import daily


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_scan_pushes_filters_and_prunes(spark):
    plan = driver.prices(spark, SF_SMALL, P)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-20T00:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_alert_report_scans_bars_once(spark):
    # the survivor table is materialised before the report plan is built,
    # so the report plan itself does not touch the tick table
    plan = executed(catalog.QUERIES["alert_report"](spark, SF_SMALL))
    assert "events.parquet" not in plan
    # the survivors' sector rows are materialised too: read once, not per branch
    assert "customer.parquet" not in plan
    assert "SortMergeJoin" not in plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "WindowGroupLimit" in plan


def test_report_write_and_status(spark, tmp_path):
    rows = catalog.QUERIES["report_html"](spark, SF_SMALL)
    path = str(tmp_path / "report")
    sinks.write_report(rows, path, dt.date(2024, 1, 30))
    sinks.write_report(rows, path, dt.date(2024, 1, 30))  # re-run replaces the day
    back = sinks.read_report(spark, path)
    assert back.count() == rows.count()
    ok = sinks.run_status(spark, rows, dt.date(2024, 1, 30)).first()
    assert ok.status == "ok" and ok.n_rows == rows.count()
    bad = sinks.run_status(spark, rows.limit(0), dt.date(2024, 1, 30)).first()
    assert bad.status == "error"


def test_no_survivor_gives_empty_report(spark):
    from risingtide.plans import alert
    from risingtide.sources import lookups

    strict = P.with_(min_period_gain=1e9)
    out = alert.alert_report(driver.prices(spark, SF_SMALL, strict),
                             lookups.fundamentals_table(driver.fundamentals_raw(spark, SF_SMALL)),
                             driver.sectors(spark, SF_SMALL), driver.news(spark, SF_SMALL),
                             driver.sector_facts, strict)
    assert out.count() == 0


def test_report_sink_keeps_other_days(spark, tmp_path):
    rows = catalog.QUERIES["report_html"](spark, SF_SMALL)
    path = str(tmp_path / "report")
    sinks.write_report(rows, path, dt.date(2024, 1, 29))
    sinks.write_report(rows, path, dt.date(2024, 1, 30))
    sinks.write_report(rows, path, dt.date(2024, 1, 30))
    back = sinks.read_report(spark, path)
    assert back.count() == 2 * rows.count()


def ticks_file(spark, tmp_path, folder, name, rows):
    """A parquet file of ticks (event_id, ts, user_id, value) in ``folder``."""
    from risingtide.streaming import daily

    folder.mkdir(exist_ok=True)
    part = tmp_path / f"src-{name}"
    spark.createDataFrame([(i, t, u, "tick", v, "{}") for i, t, u, v in rows], daily.TICK_SCHEMA).coalesce(1).write.parquet(str(part))
    (folder / f"{name}.parquet").write_bytes(next(part.glob("part-*.parquet")).read_bytes())


def at(day, hour):
    return dt.datetime(2024, 1, day, hour)


def test_incremental_store_is_idempotent(spark, tmp_path):
    from risingtide.streaming import daily

    store = str(tmp_path / "store")
    run = lambda chk: daily.incremental_screen(spark, SF_SMALL, store, P, str(tmp_path / chk),
                                               file_glob="events.parquet")
    a = sorted(tuple(r) for r in run("c1").collect())
    # a second run over the same files (fresh stream checkpoint) merges the
    # same ticks again; the store and the screen do not change
    assert sorted(tuple(r) for r in run("c2").collect()) == a
    batch = catalog.QUERIES["momentum_screen"](spark, SF_SMALL)
    assert sorted(tuple(r) for r in batch.collect()) == a


def test_ticks_after_the_end_date_wait_in_the_store(spark, tmp_path):
    """A file with ticks of the 29th and the 30th, run for the 29th and then
    for the 30th: both streams hold the 30th's bar."""
    from risingtide.streaming import daily

    ticks_file(spark, tmp_path, tmp_path / "t", "a", [(1, at(29, 10), 1, 10.0), (2, at(30, 10), 1, 11.0)])
    first, second = P.with_(end_date=dt.date(2024, 1, 29)), P.with_(end_date=dt.date(2024, 1, 30))
    for name in ("bars", "screen"):
        store, chk = str(tmp_path / name), str(tmp_path / f"chk-{name}")
        for params, days in ((first, [29]), (second, [29, 30])):
            if name == "bars":
                daily.stream_daily_bars(spark, str(tmp_path / "t"), store, params, chk)
            else:
                daily.incremental_screen(spark, str(tmp_path / "t"), store, params, chk)
            assert sorted(r.date.day for r in daily.store_bars(spark, store, params).collect()) == days


def test_only_touched_symbols_are_screened_again(spark, tmp_path):
    from risingtide.operators import momentum
    from risingtide.streaming import daily

    up = [(21, 10.0), (22, 11.0), (23, 12.1), (24, 13.4)]
    ticks_file(spark, tmp_path, tmp_path / "t", "a", [(i * 10 + u, at(d, 9), u, v) for u in (1, 2, 3) for i, (d, v) in enumerate(up)])
    args = (spark, str(tmp_path / "t"), str(tmp_path / "s"), P, str(tmp_path / "c"))
    a = daily.incremental_screen(*args, max_files_per_trigger=1)
    assert sorted(r.symbol for r in a.collect()) == [1] * 3 + [2] * 3 + [3] * 3
    assert daily.incremental_screen(*args).count() == 9  # nothing new
    # symbol 2 falls back, symbol 4 is new, symbol 1 gets an earlier tick of a day
    ticks_file(spark, tmp_path, tmp_path / "t", "b",
               [(900 + i, at(d, 15), 2, 10.0) for i, (d, _) in enumerate(up)] + [(950, at(21, 8), 1, 99.0)]
               + [(960 + i, at(d, 9), 4, v) for i, (d, v) in enumerate(up)])
    screened = []
    original = momentum.momentum_screen
    try:
        momentum.momentum_screen = lambda bars, params: screened.append(
            {r.symbol for r in bars.select("symbol").distinct().collect()}) or original(bars, params)
        b = daily.incremental_screen(*args)
    finally:
        momentum.momentum_screen = original
    assert screened == [{1, 2, 4}]
    assert sorted(r.symbol for r in b.collect()) == [1] * 3 + [3] * 3 + [4] * 3
    whole = original(daily.store_bars(spark, str(tmp_path / "s"), P), P)
    assert sorted(tuple(r) for r in b.collect()) == sorted(tuple(r) for r in whole.collect())
    # what the kept screen has seen is not kept any longer
    assert not list((tmp_path / "s-touched").glob("batch_id=*"))
    assert len(list((tmp_path / "s-screens").glob("window=*/run=*"))) == 1
    # another window is screened whole, and so is the first one after that
    later = P.with_(end_date=dt.date(2024, 1, 31))
    assert daily.screen_touched(spark, str(tmp_path / "s"), later).count() == 9
    assert len(list((tmp_path / "s-screens").glob("window=*"))) == 1
    assert daily.incremental_screen(*args).count() == 9


def test_a_store_that_cannot_be_read_is_an_error(spark, tmp_path):
    from risingtide.streaming import daily

    day = tmp_path / "s" / "date=2024-01-20"
    day.mkdir(parents=True)
    (day / "part-0.parquet").write_bytes(b"not parquet")
    batch = spark.createDataFrame([(1, dt.date(2024, 1, 20), 1.0, 5)], "symbol bigint, date date, close double, o int") \
        .selectExpr("symbol", "date", "close", "cast(o as decimal(38,0)) AS tick_order")
    try:
        daily.merge_into_store(batch, str(tmp_path / "s"))
    except Exception:
        assert (day / "part-0.parquet").read_bytes() == b"not parquet"  # and nothing is overwritten
    else:
        raise AssertionError("a damaged store was overwritten")


def test_declared_driver_schemas_match_the_files(spark):
    from pyspark.sql.types import StructType

    for name, ddl in driver.TABLE_SCHEMAS.items():
        inferred = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        declared = StructType.fromDDL(ddl)
        assert [(f.name, f.dataType) for f in declared] == \
               [(f.name, f.dataType) for f in inferred], name


def test_news_title_is_cut_after_the_survivor_semi_join(spark):
    # in the tree string a parent comes before its children: the title
    # regex sits above the semi-join, which sits above the pages scan
    lines = executed(catalog.QUERIES["alert_report"](spark, SF_SMALL)).splitlines()
    rx = next(i for i, l in enumerate(lines) if "regexp_extract(html" in l)
    scan = next(i for i, l in enumerate(lines) if "pages.parquet" in l)
    assert any("LeftSemi" in l for l in lines[rx:scan])


def test_broadcast_only_within_rows_and_bytes(spark):
    from risingtide.session import broadcast_if_small, data_size

    df = spark.createDataFrame([(1, "ab"), (2, None), (None, "xyz")], "k bigint, s string")
    assert data_size(df) == (3, 8 + 2 + 8 + 3)

    def hinted(x):
        return "broadcast" in x._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(broadcast_if_small(df))
    assert not hinted(broadcast_if_small(df, max_rows=2))
    assert not hinted(broadcast_if_small(df, max_bytes=20))


def test_merge_into_store_touches_only_batch_dates(spark, tmp_path):
    from risingtide.streaming import daily

    store = str(tmp_path / "store")
    d1, d2, d3 = dt.date(2024, 1, 20), dt.date(2024, 1, 21), dt.date(2024, 1, 22)

    def merge(rows):
        daily.merge_into_store(spark.createDataFrame(rows, "symbol bigint, date date, close double, o bigint").selectExpr(
            "symbol", "date", "close", "cast(o as decimal(38,0)) AS tick_order"), store)

    merge([(1, d1, 10.0, 110), (1, d2, 11.0, 210), (2, d2, 5.0, 212)])
    untouched = {p.name: p.read_bytes() for p in (tmp_path / "store" / "date=2024-01-20").glob("*.parquet")}
    second = [(1, d2, 12.0, 215), (2, d2, 4.0, 209), (1, d3, 13.0, 310)]  # a later tick, an older one, a new day
    merge(second)
    merge(second)  # a batch replayed after a failure
    merge([])
    got = sorted((r.symbol, r.date, r.close) for r in spark.read.schema(daily.BAR_STORE_SCHEMA).parquet(store).collect())
    assert got == [(1, d1, 10.0), (1, d2, 12.0), (1, d3, 13.0), (2, d2, 5.0)]
    assert untouched == {p.name: p.read_bytes() for p in (tmp_path / "store" / "date=2024-01-20").glob("*.parquet")}
    assert len(list((tmp_path / "store" / "date=2024-01-21").glob("*.parquet"))) == 1


def test_cluster_conf_keeps_submitted_values(spark):
    from risingtide.session import CLUSTER_CONF, apply_cluster_conf

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        apply_cluster_conf(spark)
        # the test session was built with its own shuffle partitions: kept
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") in (
            CLUSTER_CONF["spark.sql.files.maxPartitionBytes"], str(256 * 1024 * 1024) + "b")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        for k in CLUSTER_CONF:
            if k not in ("spark.sql.shuffle.partitions",) and not spark.sparkContext.getConf().contains(k):
                spark.conf.unset(k)


def test_no_query_plans_pairs_or_row_at_a_time_python(spark):
    for name, fn in catalog.QUERIES.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, (name, bad)


def test_daily_job_from_the_bar_store_equals_the_tick_run(spark, tmp_path):
    from risingtide.plans import job
    from risingtide.streaming import daily

    store = str(tmp_path / "store")
    daily.incremental_screen(spark, SF_SMALL, store, P, str(tmp_path / "chk"), file_glob="events.parquet")
    a = job.run_daily(spark, SF_SMALL, str(tmp_path / "from_ticks"), P).first()
    b = job.run_daily(spark, SF_SMALL, str(tmp_path / "from_store"), P, bar_store=store).first()
    assert a.status == b.status == "ok" and a.n_rows == b.n_rows > 0
    ra = sinks.read_report(spark, str(tmp_path / "from_ticks" / "report"), document=True)
    rb = sinks.read_report(spark, str(tmp_path / "from_store" / "report"), document=True)
    assert sorted(tuple(r) for r in ra.collect()) == sorted(tuple(r) for r in rb.collect())
    plan = daily.store_bars(spark, store, P)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_measured_materialize_and_survivor_keys(spark):
    from risingtide.plans import alert
    from risingtide.session import data_size, materialize_measured
    from risingtide.sources import lookups

    df = spark.createDataFrame([(1, "ab"), (2, None), (None, "xyz")], "k bigint, s string")
    m, n, size = materialize_measured(df)
    assert (n, size) == data_size(df) == (3, 21)
    assert materialize_measured(df, cols=["k"])[1:] == (3, 16)
    surv, kept = alert.survivor_keys(driver.prices(spark, SF_SMALL, P),
                                     lookups.fundamentals_table(driver.fundamentals_raw(spark, SF_SMALL)), P)
    assert "broadcast" in kept._jdf.queryExecution().analyzed().toString().lower()
    assert kept.count() == surv.count() > 0


def test_tick_stream_late_tick_never_replaces_a_later_close(spark, tmp_path):
    from risingtide.streaming import daily

    batches = [
        [(1, at(25, 10), 1, 10.0), (2, at(25, 11), 2, 5.0), (3, at(21, 15), 3, 7.0)],
        [(4, at(29, 10), 1, 12.0)],                     # moves the watermark past day 21
        [(5, at(21, 9), 3, 1.0), (6, at(21, 10), 2, 4.0)],  # late: earlier than 15:00; first tick of its bar
    ]
    for i, rows in enumerate(batches):
        ticks_file(spark, tmp_path, tmp_path / "flat", f"ticks-{i}", rows)
    bars = daily.stream_daily_bars(spark, str(tmp_path / "flat"), str(tmp_path / "bars"), P, str(tmp_path / "chk"),
                                   file_glob="ticks-*.parquet", max_files_per_trigger=1)
    got = {(r.symbol, r.date): r.close for r in bars.collect()}
    # Spark may or may not aggregate a tick behind the watermark; either way
    # the earlier late tick never replaces the 15:00 close of its day
    late = got.pop((2, dt.date(2024, 1, 21)), None)
    assert late in (None, 4.0)
    assert got == {(1, dt.date(2024, 1, 25)): 10.0, (2, dt.date(2024, 1, 25)): 5.0,
                   (3, dt.date(2024, 1, 21)): 7.0, (1, dt.date(2024, 1, 29)): 12.0}


def test_error_runs_replace_the_days_report_and_status(spark, tmp_path):
    import pytest

    from risingtide.plans import job

    out = str(tmp_path / "out")
    good = job.run_daily(spark, SF_SMALL, out, P).first()
    assert good.status == "ok" and sinks.read_report(spark, f"{out}/report", document=True).count() > 0
    strict = P.with_(min_period_gain=1e9)  # the same day without a survivor
    assert job.run_daily(spark, SF_SMALL, out, strict).first().message == "no stock passed the screen"
    assert not list((tmp_path / "out" / "report").glob("run_date=*"))
    job.run_daily(spark, SF_SMALL, out, P)
    job.run_daily(spark, SF_SMALL, out, P)  # a retried run
    assert [r.status for r in sinks.read_status(spark, f"{out}/status").collect()] == ["ok"]

    def fails(trace):
        raise OSError("disk gone\nmore")

    with pytest.raises(OSError):
        job.run_flow(spark, out, P, fails)
    assert [(r.status, r.message) for r in sinks.read_status(spark, f"{out}/status").collect()] == [
        ("error", "OSError: disk gone")]
    assert not list((tmp_path / "out" / "report").glob("run_date=*"))


def test_model_rejects_are_written_and_counted(spark, tmp_path):
    import pytest

    from risingtide.operators import inference
    from risingtide.plans import alert, job
    from risingtide.sources import lookups

    fund = lookups.fundamentals_table(driver.fundamentals_raw(spark, SF_SMALL))

    def run(out, predict):
        return job.run_flow(spark, str(tmp_path / out), P, lambda trace: alert.alert_report_inferred(
            driver.prices(spark, SF_SMALL, P), fund, driver.news(spark, SF_SMALL), P, trace=trace, max_records=1,
            classify_predict=predict, descriptions=driver.table(spark, SF_SMALL, "documents").selectExpr(
                "doc_id AS symbol", "'growing growing' AS description")))

    def refuses(records):
        return "I cannot help with that"

    with pytest.raises(alert.ModelReplyError):
        run("all", refuses)
    status = sinks.read_status(spark, str(tmp_path / "all" / "status")).first()
    assert status.status == "error" and "no reply of the model" in status.message

    def sometimes(records):
        return refuses(records) if records[0]["symbol"] % 2 else inference.keyword_sector_predict(records)

    status = run("some", sometimes).first()
    rejects = sinks.read_rejects(spark, str(tmp_path / "some" / "rejects")).collect()
    survivors = [r.symbol for r in alert.survivors(driver.prices(spark, SF_SMALL, P), fund, P).collect()]
    odd = sum(s % 2 for s in survivors)
    assert odd > 0 and len(rejects) == odd and all(r.step == "classify" and r.n_lost == 1 for r in rejects)
    assert f"{odd} replies rejected, {odd} records lost" in status.message or status.status == "error"


def test_package_reaches_workers_from_another_folder(tmp_path):
    import os
    import subprocess
    import sys
    import textwrap

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {root!r})
        import __spark_entry__ as E
        from risingtide.session import local_session
        spark = local_session(cpus=2, shuffle_partitions=2)
        print("ROWS", E.queries()["classify_batches"](spark, {SF_SMALL!r}).count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200" in done.stdout, done.stderr[-2000:]


def test_attempts_of_a_flow(spark):
    """The first attempt with rows counts; the last one's rows or error stand;
    an error that another attempt can't mend is raised at once."""
    some, none = spark.range(3), spark.range(0)

    def flow(*answers):
        left = iter(answers)

        def one(trace):
            answer = next(left)
            if isinstance(answer, Exception):
                raise answer
            return answer
        return one

    def number(*answers, attempts=5):
        rows, _, attempt = job.attempted(flow(*answers), attempts)
        return rows.count(), attempt

    assert number(some) == (3, 1)
    assert number(ValueError("a"), none, some, ValueError("b")) == (3, 3)
    assert number(none, none, attempts=2) == (0, 2)
    with pytest.raises(ValueError, match="last"):
        number(none, ValueError("last"), attempts=2)
    with pytest.raises(KeyError):
        number(KeyError("config"), some)


def test_store_files_follow_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(daily, "BARS_PER_FILE", 25)
    rows = spark.range(200).selectExpr("id as symbol", "date'2024-01-05' as date", "1.0d as close", "cast(id as decimal(38,0)) as tick_order")
    for _ in range(2):
        daily.merge_into_store(rows, str(tmp_path / "store"))
    files = list((tmp_path / "store" / "date=2024-01-05").glob("*.parquet"))
    assert 1 < len(files) <= 8
    assert spark.read.parquet(str(tmp_path / "store")).count() == 200
