"""The daily job: screen, enrich, write the report, record the status.

Equivalent of the reference's scheduled entry point, with its attempts: a
flow that raises or ends without rows is run again, up to ``JOB_ATTEMPTS``
times, and only the last failure is reported.  Inside an attempt Spark re-runs
failed tasks; the writes replace the run date's partitions, so neither
duplicates output.

    python -m risingtide.plans.job --tables /path/to/tables --out /shared/reports \
        --end-date 2024-01-30 [--bar-store /shared/bars]
"""

from __future__ import annotations

import argparse
import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risingtide.operators import report
from risingtide.params import DRIVER_PARAMS, ScreenParams
from risingtide.plans import alert
from risingtide.session import START_CONF, apply_cluster_conf, apply_sql_conf, materialize, ship_package
from risingtide.sources import driver, lookups, sinks


# Fixed value: how often the reference tried a day's run.
JOB_ATTEMPTS = 5
#: What another attempt may mend: a step's own error, a failing model call.
RETRIED = (ValueError, PythonException)


def attempted(flow: Callable[[alert.Trace], DataFrame], attempts: int) -> tuple[DataFrame, alert.Trace, int]:
    """The materialised rows of the first attempt that gives any, its trace
    and its number.  The last attempt's rows count even if there are none, and
    its error is raised; errors of another kind are raised at once."""
    for attempt in range(1, attempts + 1):
        trace = alert.Trace()
        try:
            rows = materialize(flow(trace))
        except RETRIED:
            if attempt == attempts:
                raise
            continue
        if attempt == attempts or rows.take(1):
            return rows, trace, attempt
    raise ValueError("a flow needs one attempt at least")


def run_flow(spark: SparkSession, out: str, params: ScreenParams,
             flow: Callable[[alert.Trace], DataFrame], attempts: int = 1) -> DataFrame:
    """Run ``flow`` (a report as a function of its trace), up to ``attempts``
    times, and leave, for the run date, the report, the rejected model replies and then one status row,
    which is returned.

    A report without rows is an error that names the guard; an exception is
    recorded with its type and message and raised again.  In both cases an
    earlier report of the same date is removed, so what stands in the folder
    is always what the status says.
    """
    out, day = out.rstrip("/"), params.end_date
    try:
        rows, trace, attempt = attempted(flow, attempts)
        note = f", attempt {attempt}" if attempt > 1 else ""
        if trace.rejects:
            parts = [r.select(F.lit(step).alias("step"), "batch_key", "n_records", "reply", "n_lost", "reason")
                     for step, r in trace.rejects]
            both = materialize(reduce(DataFrame.unionByName, parts))
            n = both.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_lost"), F.lit(0))).first()
            sinks.write_rejects(both, f"{out}/rejects", day)
            note += f", {n[0]} replies rejected, {n[1]} records lost" if n[0] else ""
        if rows.take(1):
            sinks.write_report(report.report_document(rows, day), f"{out}/report", day)
        else:
            sinks.clear_report(spark, f"{out}/report", day)
        status = sinks.run_status(spark, rows, day, "" if rows.take(1) else trace.empty_reason(), note)
        sinks.write_status(status, f"{out}/status")
        return status
    except Exception as e:
        sinks.clear_report(spark, f"{out}/report", day)
        message = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500]
        sinks.write_status(sinks.status_row(spark, day, "error", message), f"{out}/status")
        raise


def run_daily(spark: SparkSession, tables: str, out: str, params: ScreenParams,
              bar_store: str | None = None, attempts: int = 1) -> DataFrame:
    """Run one day and return its status row.  With ``bar_store`` (the
    date-partitioned bars the incremental stream maintains) the window's
    bars are read from it -- a few rows per symbol and day, partition-pruned
    -- instead of being rolled up again from the ticks."""
    from risingtide.streaming import daily

    apply_sql_conf(spark)

    def flow(trace: alert.Trace) -> DataFrame:
        prices = (daily.store_bars(spark, bar_store, params) if bar_store
                  else driver.prices(spark, tables, params))
        return alert.alert_report(
            prices, lookups.fundamentals_table(driver.fundamentals_raw(spark, tables)),
            driver.sectors(spark, tables), driver.news_source(spark, tables), driver.sector_facts, params, trace)

    return run_flow(spark, out, params, flow, attempts)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--tables", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--end-date", default=DRIVER_PARAMS.end_date.isoformat())
    ap.add_argument("--bar-store", default=None,
                    help="bar store kept by the incremental stream; default: roll up the ticks")
    ap.add_argument("--attempts", type=int, default=JOB_ATTEMPTS)
    a = ap.parse_args(argv)
    # the job runs without the web UI (no port is opened for it)
    spark = (SparkSession.builder.appName("risingtide-daily").config(map=START_CONF)
             .config("spark.ui.enabled", "false").getOrCreate())
    apply_cluster_conf(spark)
    ship_package(spark)
    params = DRIVER_PARAMS.with_(end_date=_dt.date.fromisoformat(a.end_date))
    run_daily(spark, a.tables, a.out, params, a.bar_store, a.attempts).show(truncate=False)


if __name__ == "__main__":
    main()
