"""Exact deduplication by progressive refinement (operator 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common

PREFIX_BYTES = 256


def shared(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that more than one row has; counts are combined before the shuffle."""
    often = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)
    return common.written(often, "shared")


def refine(docs: DataFrame, prefix_bytes: int = PREFIX_BYTES) -> DataFrame:
    """Documents with the full hash of those that length and prefix hash cannot tell apart.

    Rows group by byte length, rows of groups with more than one member by the hash of
    their first bytes, and only the texts of groups that still have more than one member
    are hashed in full: ``full_hash`` is null for all others, which are unique.  Null and
    empty texts are equal.  Returns doc_id, text, n_bytes, prefix_hash, full_hash.
    """
    rows = docs.select(
        "doc_id", common.text_of().alias("text"),
        F.octet_length(common.text_of()).alias("n_bytes"),
    ).withColumn("prefix_hash", F.xxhash64(F.substring(F.col("text").cast("binary"), 1, prefix_bytes)))
    facts = rows.select("n_bytes", "prefix_hash")
    lengths = shared(facts.select("n_bytes"), ["n_bytes"])
    alike = shared(facts.join(lengths, "n_bytes", "left_semi"), ["n_bytes", "prefix_hash"])
    marked = rows.join(alike.withColumn("alike", F.lit(True)), ["n_bytes", "prefix_hash"], "left")
    return marked.select(
        "doc_id", "text", "n_bytes", "prefix_hash",
        F.when(F.col("alike"), F.sha2("text", 256)).alias("full_hash"),
    )


def exact_duplicates(docs: DataFrame, prefix_bytes: int = PREFIX_BYTES) -> DataFrame:
    """One row per document with the document that stays of its group of equal texts.

    The largest doc_id of a group stays.  Rows that share text and doc_id are one
    document, so all of them are kept; a null doc_id stays only where a group has no
    other.  Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    refined = refine(docs, prefix_bytes)
    hashed = common.written(
        refined.select(
            "doc_id", "n_bytes", "full_hash",
            F.coalesce("full_hash", F.sha2("text", 256)).alias("text_sha256"),
        ),
        "exact-dedup",
    )
    unique = hashed.filter("full_hash is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    rest = hashed.filter("full_hash is not null")
    # Written, so that the join has plain exchanges on both sides and Spark can split the
    # rows of a very large group.
    groups = common.written(
        rest.groupBy("n_bytes", "full_hash").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        ),
        "exact-groups",
    )
    return rest.join(groups, ["n_bytes", "full_hash"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    ).unionByName(unique)
