"""From raw documents to packed sequences: rules, line and near dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsignal.llm import common
from newsignal.llm.host_rules import judge
from newsignal.llm.jaccard_join import FIVE_80, jaccard_groups
from newsignal.llm.line_dedup import counts_name, drop_common_lines
from newsignal.llm.mixing import mix
from newsignal.llm.packing import pack_documents
from newsignal.llm.queries import vocabulary

# Share of the tokens that mixing keeps, however many odd cells there are.
KEPT_SHARE = 0.66


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return common.keep_rows(docs, judge(docs).filter("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more share; n_chars follows the new text."""
    out = drop_common_lines(docs).drop(counts_name(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: one with the group's smallest doc_id.

    Rows get numbers of their own, so rows that share a doc_id go or stay each by its text, and
    one of equal rows stays.  Rows without a doc_id, and documents that line dedup left
    without a word, have nothing to be copies of and stay.
    """
    number = common.fresh(docs, "row_number")
    numbered = docs.withColumn(number, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id()))
    rows = common.written(numbered, "near-rows", "zstd")
    own = rows.select(F.col("doc_id").alias("own_id"), F.col(number).alias("doc_id"), "text")
    groups = common.written(
        jaccard_groups(own, FIVE_80).filter("component_id is not null and n_shingles > 0").select("doc_id", "component_id"),
        "near-groups",
    )
    named = groups.join(own.select("doc_id", "own_id"), "doc_id")
    first = named.groupBy("component_id").agg(F.min(F.struct("own_id", "doc_id"))["doc_id"].alias("first"))
    gone = groups.join(first, "component_id").filter("doc_id <> first").select(F.col("doc_id").alias("gone"))
    return rows.join(gone, rows[number] == gone["gone"], "left_anti").drop(number)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of KEPT_SHARE of the tokens, which match the target shares as far as there are enough."""
    return common.keep_rows(docs, mix(docs, kept_share=KEPT_SHARE).filter("kept"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 4096 tokens."""
    return pack_documents(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
    ("mix sources", mix_sources), ("packing", packing),
]
# Near dedup needs components, packing a tokenizer: see tests/llm for brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
