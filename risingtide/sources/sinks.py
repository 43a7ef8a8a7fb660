"""Report sink (S8) and run status.

The reference mailed one HTML document, or a plain-text error after the
last failed attempt.  Here the report fragments are written as a
``run_date``-partitioned dataset in a shared folder, sorted by
``(core_focus, part, symbol)`` with a range-partitioned sort so the files,
read in name order, are the document.  A run also leaves one status row for
its date, written after the report, and the model replies it rejected.
Writes use dynamic partition overwrite, so re-running a day (or a retried
job after a lost executor) replaces that day's output instead of adding
to it; a run that ends in an error removes the day's earlier report.

``write_document`` writes the report as one HTML document in ordered part
files.  An attempt writes into a folder of its own; only a manifest, put in
place by one rename, makes its parts the document and names them in order.
So a reader sees the old document or the new one, a failed attempt leaves
nothing that is read, and no task holds more than its range of rows.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS_SCHEMA = "run_date string, status string, message string, n_rows bigint"


def write_report(fragments: DataFrame, path: str, run_date: _dt.date, fmt: str = "json") -> None:
    order = [c for c in ("block", "core_focus", "part", "symbol") if c in fragments.columns]
    (fragments.withColumn("run_date", F.lit(run_date.isoformat()))
     .orderBy(*order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").format(fmt).save(path))


def read_report(spark: SparkSession, path: str, fmt: str = "json",
                symbol_type: str = "bigint", document: bool = False) -> DataFrame:
    """The written fragments; ``document`` for the output of
    ``report.report_document`` (with its ``block`` column)."""
    schema = ("block int, " if document else "") + \
        f"core_focus string, part int, symbol {symbol_type}, html string, run_date string"
    return spark.read.schema(schema).format(fmt).load(path)


MANIFEST = "manifest.json"
DOCUMENT_ORDER = ["block", "core_focus", "part", "symbol"]


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the store that Spark would write to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _day_folder(path: str, run_date: _dt.date) -> str:
    return f"{path.rstrip('/')}/run_date={run_date.isoformat()}"


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in place by one rename."""
    fs, target = _fs(spark, path)
    _, fresh = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)


def write_document(document: DataFrame, path: str, run_date: _dt.date) -> dict:
    """Writes ``html`` of the document's rows, one line each, in order; gives
    the manifest.  The range-partitioned sort makes part files whose names,
    sorted, are the document's order.  An attempt that fails is removed; one
    whose driver was lost is removed by the next write of the day."""
    spark = document.sparkSession
    day, attempt = _day_folder(path, run_date), f"attempt-{uuid.uuid4().hex}"
    fs, folder = _fs(spark, f"{day}/{attempt}")
    try:
        document.orderBy(*DOCUMENT_ORDER).select("html").write.option("lineSep", "\n").text(f"{day}/{attempt}")
        parts = sorted(({"name": f"{attempt}/{x.getPath().getName()}", "bytes": x.getLen()} for x in fs.listStatus(folder)
                        if x.getPath().getName().startswith("part-") and x.getLen()), key=lambda x: x["name"])
        manifest = {"run_date": run_date.isoformat(), "parts": parts, "bytes": sum(x["bytes"] for x in parts)}
        _put(spark, f"{day}/{MANIFEST}", json.dumps(manifest))
    except BaseException:
        fs.delete(folder, True)
        raise
    for x in fs.listStatus(folder.getParent()):
        if x.getPath().getName() not in (attempt, MANIFEST):
            fs.delete(x.getPath(), True)
    return manifest


def document_parts(spark: SparkSession, path: str, run_date: _dt.date) -> list[str]:
    """The paths of a document's part files in their order; none if there is
    no document of the day.  A part of another size than the manifest says is
    an error."""
    day = _day_folder(path, run_date)
    fs, manifest = _fs(spark, f"{day}/{MANIFEST}")
    if not fs.exists(manifest):
        return []
    parts = json.loads("".join(r["value"] for r in spark.read.text(f"{day}/{MANIFEST}").collect()))["parts"]
    for x in parts:
        size = fs.getFileStatus(_fs(spark, f"{day}/{x['name']}")[1]).getLen()
        if size != x["bytes"]:
            raise ValueError(f"{x['name']} has {size} bytes, the manifest says {x['bytes']}")
    return [f"{day}/{x['name']}" for x in parts]


def read_document(spark: SparkSession, path: str, run_date: _dt.date) -> DataFrame:
    """``(html)``: the lines of the document of a day."""
    parts = document_parts(spark, path, run_date)
    if not parts:
        return spark.createDataFrame([], "html string")
    return spark.read.option("lineSep", "\n").text(parts).withColumnRenamed("value", "html")


def clear_report(spark: SparkSession, path: str, run_date: _dt.date) -> None:
    """Removes the output of one run date, if there is any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/run_date={run_date.isoformat()}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def status_row(spark: SparkSession, run_date: _dt.date, status: str, message: str, n_rows: int = 0) -> DataFrame:
    return spark.createDataFrame([(run_date.isoformat(), status, message, n_rows)], STATUS_SCHEMA)


def run_status(spark: SparkSession, report: DataFrame, run_date: _dt.date,
               empty_reason: str = "no relevant sectors", note: str = "") -> DataFrame:
    """S9 + F9: one status row.  An empty report is an error that says which
    guard left nothing (the reference raised for each).  One count: the
    report is the materialised per-stock table, so this reads its stored
    rows once."""
    n = report.count()
    if n == 0:
        return status_row(spark, run_date, "error", empty_reason)
    return status_row(spark, run_date, "ok", "report written" + note, n)


def write_status(status: DataFrame, path: str) -> None:
    """One row per run date: a run replaces the status of its own day only."""
    (status.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").format("json").save(path))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATUS_SCHEMA).format("json").load(path)


REJECT_SCHEMA = "step string, batch_key string, n_records int, reply string, n_lost int, reason string, run_date string"


def write_rejects(rejects: DataFrame, path: str, run_date: _dt.date) -> None:
    """Model replies that gave less than they were asked, by run date."""
    (rejects.withColumn("run_date", F.lit(run_date.isoformat()))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").format("json").save(path))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REJECT_SCHEMA).format("json").load(path)
