"""Helpers shared by the operators: shared scratch tables and table reads."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from risingtide.session import size_columns, broadcast_hint, checkpoint_dir

_CLEANED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder; it is
    removed when the driver's Python ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if root not in _CLEANED:
        _CLEANED.add(root)
        atexit.register(_remove, spark, root)
    return root


def _remove(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has been stopped
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back:
    lineage is cut, a lost executor costs no recomputation, and later reads
    prune columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, name: str, *aggs) -> tuple[DataFrame, dict]:
    """``stored(df)`` and the named aggregates of its rows, observed while
    they are written."""
    seen = Observation()
    out = stored(df.observe(seen, *aggs), name)
    return out, seen.get


def stored_broadcast(df: DataFrame, name: str) -> DataFrame:
    """``stored(df)``, with a broadcast hint if its rows and bytes, measured
    while they are written, are within the session's bounds."""
    n, size = size_columns(df)
    out, seen = stored_with(df, name, n, size)
    return broadcast_hint(out, seen["n"], seen["b"] or 0)


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """Bound the records of an Arrow batch: a batch of whole texts must fit
    in a worker's memory whatever their length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of a documents table; all other columns,
    whatever their names, are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def as_row(docs: DataFrame, *cols: str) -> DataFrame:
    """All columns of ``docs``, whatever their names and types, in the one
    column ``row``, beside a copy of ``cols``: an operator's own columns then
    can't meet them."""
    name = lambda c: F.col("`" + c.replace("`", "``") + "`")
    return docs.select(F.struct(*[name(c) for c in docs.columns]).alias("row"), *[F.col(c) for c in cols])


def from_row(rows: DataFrame) -> DataFrame:
    """The columns that ``as_row`` has put away."""
    return rows.select("row.*")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file: $TOKENIZER_DIR/name if that is set,
    else where the ``public_tokenizers`` module has it."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


class BoundedCache(dict):
    """word -> value, filled by ``make`` on a miss.  Holds at most ``limit``
    words of at most ``longest`` characters or bytes, so its bytes are bounded
    too; after as many misses beyond that it starts anew, so it follows the
    text it is fed.  Longer words, as in scripts without blanks, seldom come
    again and are made each time."""

    def __init__(self, make, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.spare = make, limit, longest, limit

    def __missing__(self, word):
        value = self.make(word)
        if not isinstance(word, int) and len(word) > self.longest:
            return value
        if len(self) < self.limit:
            self[word] = value
        else:
            self.spare -= 1
            if self.spare <= 0:
                self.clear()
                self.spare = self.limit
        return value
