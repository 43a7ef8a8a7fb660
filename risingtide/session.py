"""Session helpers.

Library code never creates a session; it takes the caller's.  ``local_session``
is for tests and the bench only.  ``checkpoint_dir`` reads the shared folder
the cluster names in ``spark.checkpoint.dir`` and only sets one when the
session has none (tests, local runs).
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on; harmless to apply to a caller's session.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting point for the target cluster (~100 TB of ticks, 1000 executors).
# The largest shuffle is the partial tick -> daily bar aggregate; at 256 MB per
# partition it needs on the order of 16k partitions, and AQE coalesces the
# later, much smaller stages (bars in the window, survivors, reports) down
# to the advisory size.  Input splits of 256 MB keep scan tasks in the low
# hundreds of thousands.  Set spark.checkpoint.dir to a shared folder.
CLUSTER_CONF = {
    **SQL_CONF,
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}

# Read when the session starts: set it at submission.  Checkpoints that no
# plan refers to any more are then deleted, so neither ``materialize`` nor a
# stream's merges grow the shared folder for ever.
START_CONF = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def apply_cluster_conf(spark: SparkSession) -> None:
    """``CLUSTER_CONF`` for every key the submitter did not set (a value
    given to spark-submit or the session builder wins)."""
    given = spark.sparkContext.getConf()
    for k, v in CLUSTER_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "risingtide") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in (SQL_CONF | START_CONF).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system path).
    Only when it is unset -- local tests -- a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...): "
                           "a machine-local folder does not survive a lost executor")
    local = tempfile.mkdtemp(prefix="risingtide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def materialize(df):
    """Cut lineage of a small, reused intermediate result: a reliable
    checkpoint written to the shared ``spark.checkpoint.dir``.  Downstream
    plans read it instead of recomputing the upstream scan, and a lost
    executor does not force a recomputation either."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> str:
    """Send this package to the executors' Python workers, so that a job
    started from any folder finds it there (``--py-files`` with the same zip
    does it at submission).  Done once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        base = os.path.join(tempfile.mkdtemp(prefix="risingtide-ship-"), "risingtide-package")
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        _SHIPPED[sc.applicationId] = shutil.make_archive(base, "zip", root, "risingtide")
        sc.addPyFile(_SHIPPED[sc.applicationId])
    return _SHIPPED[sc.applicationId]


_SHIPPED: dict[str, str] = {}


# A key-only side up to this many rows is broadcast (8-byte keys: ~16 MB).
BROADCAST_MAX_KEYS = 2_000_000
# ... and never more than this many bytes of data, whatever the row count.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def size_columns(df, cols=None):
    """Row count and bytes of data of ``df`` (or of its ``cols``) as two
    aggregate expressions: string and binary values count their byte
    length, fixed-width values their width, nested values their JSON text,
    NULLs nothing."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    fixed = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4,
             T.FloatType: 4, T.DateType: 4, T.LongType: 8, T.DoubleType: 8,
             T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}
    widths = [F.lit(0)]
    for f in df.schema.fields:
        if cols is not None and f.name not in cols:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = F.octet_length(c)
        elif type(f.dataType) in fixed:
            width = F.when(c.isNotNull(), F.lit(fixed[type(f.dataType)]))
        else:  # nested values: their JSON text as a stand-in
            width = F.octet_length(F.to_json(F.struct(c)))
        widths.append(F.coalesce(width, F.lit(0)))
    row_bytes = widths[0]
    for w in widths[1:]:
        row_bytes = row_bytes + w
    return (F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0)).alias("b"))


def data_size(df):
    """``(rows, bytes)`` of ``df`` in one aggregate job (see
    ``size_columns``).  Meant for materialised tables, where the job is a
    read of the stored rows."""
    r = df.agg(*size_columns(df)).first()
    return r["n"], r["b"]


def materialize_measured(df, cols=None):
    """``materialize(df)`` plus its ``(rows, bytes)`` -- of ``cols`` only,
    if given -- observed while the checkpoint is written, so measuring
    costs no job of its own."""
    from pyspark.sql import Observation

    obs = Observation()
    out = materialize(df.observe(obs, *size_columns(df, cols)))
    r = obs.get
    return out, r["n"], r["b"] or 0


def broadcast_hint(df, rows: int, size: int, max_rows: int = None,
                   max_bytes: int = None):
    """``broadcast(df)`` when the measured ``rows``/``size`` are within the
    bounds, else ``df`` unchanged (a shuffle join)."""
    from pyspark.sql import functions as F

    max_rows = BROADCAST_MAX_KEYS if max_rows is None else max_rows
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def broadcast_if_small(keys, max_rows: int = BROADCAST_MAX_KEYS,
                       max_bytes: int = BROADCAST_MAX_BYTES):
    """Broadcast hint for ``keys`` only after measuring it: at most
    ``max_rows`` rows and ``max_bytes`` bytes of data.

    Meant for materialised (checkpointed) tables, where the measurement
    just reads the stored rows.  Above either bound the frame is returned
    as is and Spark plans a shuffle join (AQE may still switch at run
    time, from measured shuffle sizes).
    """
    n, size = data_size(keys)
    return broadcast_hint(keys, n, size, max_rows, max_bytes)


# A materialised per-group table (key + a few numbers) up to this many rows
# is broadcast.
BROADCAST_MAX_GROUPS = 1_000_000


def checked_broadcast(df, max_rows: int = BROADCAST_MAX_GROUPS):
    """Materialise a small derived table (e.g. per-group counts) and
    broadcast it when its row count is within ``max_rows`` and its data
    within ``BROADCAST_MAX_BYTES``.

    Joining such a table back to a large one on a group key would otherwise
    be planned as a shuffle join, which sends every row of a hot group to
    one task; the broadcast keeps the large side where it is.
    """
    m, n, size = materialize_measured(df)
    return broadcast_hint(m, n, size, max_rows)
