"""Training-corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from risingtide.llm import jaccard_join, nb_svm, packing, quality_rules
from risingtide.llm.common import arrow_rows, stored, table, tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    arrow_rows(spark, 500)
    return nb_svm.keep(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules reject go."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    arrow_rows(spark, 500)
    return jaccard_join.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents, packed into sequences."""
    arrow_rows(spark, 500)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", rules),
          ("jaccard_join", near_duplicates), ("packing", pack)]

#: The classifier can't be expressed in SQL; the stages are tested against
#: brute force one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
