"""The operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import newsignal
from newsignal.llm import common
from newsignal.llm.alignment import linked_documents
from newsignal.llm.exact_dedup import exact_duplicates
from newsignal.llm.host_rules import judge
from newsignal.llm.html_extract import main_text
from newsignal.llm.jaccard_join import THREE_90, jaccard_groups
from newsignal.llm.line_dedup import counts_name, drop_common_lines
from newsignal.llm.mixing import mix
from newsignal.llm.oracles import ORACLES  # noqa: F401
from newsignal.llm.packing import pack_documents
from newsignal.llm.phrase_dedup import drop_repeated_phrases
from newsignal.llm.phrases import collocations
from newsignal.llm.quality_model import quality_scores
from newsignal.llm.ring import Ring, bounded_ring_shards
from newsignal.llm.suffix_dedup import drop_repeated_bytes

SHARDS = 24
VOCABULARY = "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"

# Where workers cannot import this package, its functions travel with the tasks.
ROOT = str(Path(newsignal.__file__).resolve().parents[1])
if ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    cloudpickle.register_pickle_by_value(newsignal)


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.table(spark, sf_dir, "documents")


def op1_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = bounded_ring_shards(documents(spark, sf_dir), Ring(SHARDS))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard",
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).drop("row_hash")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(documents(spark, sf_dir), THREE_90).drop("row_hash")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(common.table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_bytes(documents(spark, sf_dir)).withColumn(
        "kept_sha256", F.sha2("body", 256)
    ).drop("body")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counts = counts_name(docs)
    return drop_common_lines(docs, min_docs=10).select(
        "doc_id", f"{counts}.n_lines", f"{counts}.n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocabulary())


def op10_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_phrases(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op11_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = map(vocabulary, ALIGNED)
    return linked_documents(documents(spark, sf_dir), a, b).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
        "n_overlap_links", "n_group_links",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_ring_shards, op2_exact_dedup, op3_mix_sources, op4_jaccard_join, op5_main_text,
        op6_suffix_dedup, op7_host_rules, op8_line_dedup, op9_pack, op10_phrase_dedup,
        op11_quality_scores, op12_phrases, op13_token_alignment,
    )
}

