"""Registered queries of this subpackage: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from risingtide.llm import (
    conversation_repair,
    gru_toxicity,
    jaccard_join,
    nb_svm,
    packing,
    pivot_permutation,
    quality_rules,
    sharding,
    sp_prefix,
    token_histogram,
    variant_words,
    vector_topk,
    warc_zip,
)
from risingtide.llm.common import arrow_rows, table, tokenizer_file

QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents"))


@register
def op3_sharding(spark, sf):
    from pyspark.sql import functions as F

    return sharding.shard(table(spark, sf, "documents"), 24, seed=20240601).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register
def op6_warc(spark, sf):
    arrow_rows(spark, 500)
    return warc_zip.round_trip(spark, table(spark, sf, "pages"))


@register
def op9_topk_search(spark, sf):
    return vector_topk.topk(table(spark, sf, "embeddings"), k=5, every=50)


@register
def op4_token_counts(spark, sf):
    arrow_rows(spark, 500)
    lengths = token_histogram.encoded_lengths(table(spark, sf, "documents"), ["lang"],
                                              tokenizer_file("byte_bpe_50k.json"))
    return token_histogram.answers(token_histogram.histogram(lengths, ["lang"]), ["lang"],
                                   limits=[128, 512, 1024, 2048, 4096, 8192], shares=[0.5, 0.9, 0.99])


@register
def op8_packing(spark, sf):
    arrow_rows(spark, 500)
    return packing.pack(table(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.json"))


@register
def op10_sentencepiece(spark, sf):
    arrow_rows(spark, 500)
    return sp_prefix.digests(sp_prefix.encode_decode(table(spark, sf, "documents"),
                                                     tokenizer_file("piece_bpe_32k.model")))


@register
def op2_jaccard_join(spark, sf):
    arrow_rows(spark, 500)
    return jaccard_join.join(table(spark, sf, "documents"))


@register
def op5_quality_classifier(spark, sf):
    arrow_rows(spark, 500)
    return nb_svm.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register
def op7_toxicity(spark, sf):
    arrow_rows(spark, 500)
    return gru_toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register
def op11_spelling_variants(spark, sf):
    arrow_rows(spark, 500)
    return variant_words.variants(table(spark, sf, "documents"), damage_every=199)


@register
def op12_conversation_repair(spark, sf):
    arrow_rows(spark, 500)
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf, "conversations")))


@register
def op13_embedding_dedup(spark, sf):
    return pivot_permutation.near_duplicates(table(spark, sf, "embeddings"))
