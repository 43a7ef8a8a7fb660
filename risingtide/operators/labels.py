"""Label clean-up after inference.

The reference asked the model to give "the exact same label" to very
similar business areas; batched inference cannot promise that, so labels
are canonicalised afterwards: labels with the same key (case, outer blanks,
blanks around hyphens and runs of blanks ignored) map to one canonical
spelling -- the most frequent one, ties to the smallest.  This is two
group-bys with partial aggregation; no pairwise comparison of labels.

``fuzzy_label_map`` also brings together labels whose keys are one edit
apart, directly or over other labels (``Semiconductor``, ``Semiconductors``).
Labels meet by what remains of a key when one character is left out, never
pair by pair:

* two keys with the same remainder at the same place differ in one character.
  All that share it hang on the smallest of them, found by a partial ``min``,
  so a remainder of m keys gives m links and no pairs;
* a key that is another one's remainder differs by one insertion.

Each link is verified by ``levenshtein``; the links' components are the
groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risingtide.functions.text import label_key, word_count
from risingtide.operators.graph import components
from risingtide.session import checked_broadcast, materialize

MAX_LABEL_WORDS = 3  # "core focus in at most 3 words"
#: Keys of fewer characters are only merged when equal: among short words one
#: edit often gives another word.
FUZZY_MIN_LENGTH = 12


def canonical_label_map(labels: DataFrame, col: str = "core_focus") -> DataFrame:
    """``(label, canonical_label, label_count)``: one row per distinct raw
    label.

    Counts per label are a partial aggregate (a frequent label is combined
    map-side); the canonical spelling is then a window over the key, whose
    partitions hold only the spellings of one key -- a handful of rows.
    """
    per_label = (labels.where(F.col(col).isNotNull())
                 .groupBy(F.col(col).alias("label"))
                 .agg(F.count(F.lit(1)).alias("label_count")))
    w = Window.partitionBy(label_key(F.col("label")))
    best = F.min_by(F.col("label"), F.struct((-F.col("label_count")).alias("c"),
                                             F.col("label").alias("l")))
    return per_label.select("label", best.over(w).alias("canonical_label"), "label_count")


def key_links(keys: DataFrame, min_length: int = FUZZY_MIN_LENGTH) -> DataFrame:
    """``(u, v)``: links among the distinct values of ``key`` such that two
    values one edit apart are connected, and connected ones are one edit
    apart from link to link.  Values of at least ``min_length`` characters."""
    long = keys.select("key").where(F.char_length("key") >= min_length)
    size = F.char_length("key")
    rest = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(
        i.alias("at"), F.concat(F.substring("key", F.lit(1), i - 1), F.substring("key", i + 1, size)).alias("rest")))
    rests = materialize(long.select("key", F.explode(rest).alias("r")).select("key", "r.at", "r.rest"))
    least = rests.groupBy("at", "rest").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    replaced = rests.join(least, ["at", "rest"]).where("key != least").select(F.col("key").alias("u"), F.col("least").alias("v"))
    inserted = (rests.where(F.char_length("rest") >= min_length).select("key", "rest").distinct()
                .join(long.select(F.col("key").alias("v")), F.col("rest") == F.col("v")).select(F.col("key").alias("u"), "v"))
    return replaced.unionByName(inserted).where(F.levenshtein("u", "v", 1) == 1).distinct()


def fuzzy_label_map(labels: DataFrame, col: str = "core_focus", min_length: int = FUZZY_MIN_LENGTH) -> DataFrame:
    """``(label, canonical_label, label_count)``: like ``canonical_label_map``
    with keys that links of one edit connect taken as one: the most frequent
    label of all of them, ties to the smallest.

    A component may be large, so its best label is a partial aggregate joined
    back by a size-checked broadcast, not a window over it.
    """
    per_label = materialize(labels.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("label"))
                            .agg(F.count(F.lit(1)).alias("label_count")).withColumn("key", label_key(F.col("label"))))
    roots = components(key_links(per_label.select("key").distinct(), min_length))
    grouped = materialize(per_label.join(roots.withColumnRenamed("node", "key"), "key", "left")
                          .select("label", "label_count", F.coalesce("root", "key").alias("root")))
    best = F.min_by(F.col("label"), F.struct((-F.col("label_count")).alias("c"), F.col("label").alias("l")))
    names = checked_broadcast(grouped.groupBy("root").agg(best.alias("canonical_label")))
    return grouped.join(names, "root").select("label", "canonical_label", "label_count")


def canonicalize(df: DataFrame, col: str = "core_focus", fuzzy: bool = False) -> DataFrame:
    """Replace ``col`` by its canonical spelling; ``fuzzy`` also merges labels
    one edit apart.  The label map (one row per distinct label) is broadcast
    after a size check, so the rows of a very frequent label are not shuffled
    to one task.  ``df`` is read twice (the map and the join): pass a
    materialised frame when it is costly to compute, e.g. model output."""
    label_map = fuzzy_label_map if fuzzy else canonical_label_map
    m = checked_broadcast(label_map(df, col)
                          .select(F.col("label").alias(col), "canonical_label"))
    return (df.join(m, col, "left")
            .withColumn(col, F.coalesce(F.col("canonical_label"), F.col(col)))
            .drop("canonical_label"))


def label_quality(df: DataFrame, col: str, max_words: int = MAX_LABEL_WORDS) -> DataFrame:
    """Word count of ``col`` and whether it is within ``max_words``."""
    return (df.withColumn("n_words", word_count(F.col(col)))
            .withColumn("within_limit", F.col("n_words") <= max_words))
