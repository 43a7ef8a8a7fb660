"""Localisation of report values.

The reference had a model translate every value of every row.  Values that
come from a closed vocabulary -- sector labels, the "no data" filler -- are
translated here with a dictionary: a small literal dictionary becomes a
``map`` literal inside the projection (no join at all); a dictionary held
in a table is joined per column and AQE broadcasts it when measured small.
Free text can go through ``inference.apply_per_group`` with a translator.
Keys stay untouched, so grouping happens on stable values before display.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risingtide.functions.text import literal_pattern
from risingtide.params import NEWS_SEPARATOR
from risingtide.session import checked_broadcast

# Our dictionary (English -> Hebrew), fixed values.
HEBREW = {
    "AUTOMOBILE": "רכב",
    "BUILDING": "בנייה",
    "FURNITURE": "ריהוט",
    "HOUSEHOLD": "משק בית",
    "MACHINERY": "מכונות",
    "no data": "אין נתונים",
}


def localize_with_map(df: DataFrame, cols: dict[str, str], dictionary: dict[str, str],
                      sep: str = NEWS_SEPARATOR) -> DataFrame:
    """``cols`` maps a source column to its localised output column.  A value
    of several pieces joined by ``sep`` is translated piece by piece; pieces
    without a translation are kept as they are."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(dictionary.items()))])
    pieces = lambda c: F.split(c, literal_pattern(sep))
    out = df
    for src, dst in cols.items():
        own = F.transform(pieces(F.col(src)), lambda x: F.coalesce(F.element_at(m, x), x))
        out = out.withColumn(dst, F.array_join(own, sep))
    return out


def localize_with_table(df: DataFrame, cols: dict[str, str], dictionary: DataFrame) -> DataFrame:
    """Whole values with a dictionary table ``(source_text, target_text)``.
    The dictionary is measured and broadcast within the bounds, so a value
    that most rows share does not send them all to one task."""
    d = checked_broadcast(dictionary.select(F.col("source_text").alias("_s"), F.col("target_text").alias("_t")))
    out = df
    for src, dst in cols.items():
        out = (out.join(d, F.col(src) == F.col("_s"), "left")
               .withColumn(dst, F.coalesce(F.col("_t"), F.col(src))).drop("_s", "_t"))
    return out
