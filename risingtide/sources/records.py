"""Drop-on-error reads.

The reference dropped a provider reply it could not parse and went on.
Spark's PERMISSIVE JSON parsing does the same per record: a malformed
record keeps its raw text in ``_corrupt_record`` and the good ones parse;
the split gives the good rows and a reject table to keep for inspection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parsed(raw: DataFrame, body_col: str, schema: T.StructType) -> tuple[DataFrame, Column]:
    """``raw`` with the parsed record as ``_parsed``, and whether it is bad."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    parsed = raw.withColumn("_parsed", F.from_json(
        F.col(body_col), with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    return parsed, F.col("_parsed").isNull() | F.col("_parsed._corrupt_record").isNotNull()


def split_bad_records(raw: DataFrame, body_col: str, schema: T.StructType
                      ) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of JSON text in ``body_col`` parsed with ``schema``."""
    parsed, bad = _parsed(raw, body_col, schema)
    keep = [c for c in raw.columns if c != body_col]
    good = parsed.where(~bad).select(*keep, *[F.col(f"_parsed.{f.name}") for f in schema.fields])
    rejects = parsed.where(bad).select(*keep, F.col(body_col).alias("raw_record"))
    return good, rejects


def tag_bad_records(raw: DataFrame, body_col: str, schema: T.StructType) -> DataFrame:
    """One pass that marks every record ``ok`` or ``rejected``."""
    parsed, bad = _parsed(raw, body_col, schema)
    keep = [c for c in raw.columns if c != body_col]
    return parsed.select(*keep, F.when(bad, F.lit("rejected")).otherwise(F.lit("ok")).alias("status"))
