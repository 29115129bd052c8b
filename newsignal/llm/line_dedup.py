"""Removal of lines that many documents share (operator 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsignal.llm import common


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay, so ``lower`` serves only where there are none."""
    other = F.translate(text, common.UPPER, common.UPPER.lower())
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(other)


def hashed(key: Column) -> Column:
    return F.when(F.length(key) > 0, F.struct(F.xxhash64(key).alias("x"), F.hash(key).alias("m")))


def line_keys(text: Column) -> Column:
    """Hashes of the lines without white space at their ends and with A-Z in lower case.

    96 bits, so that two keys of a corpus do not meet by chance.  Null for an empty key.
    Trimming, lower case and hashing are transforms of their own: what one lambda uses
    several times Spark computes as often.
    """
    trimmed = F.transform(lines_of(text), lambda line: F.btrim(line, F.lit(common.SPACE_CHARS)))
    return F.transform(F.transform(trimmed, lower_ascii), hashed)


def common_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """Keys of lines that stand in at least ``min_docs`` documents.

    Counting distinct doc_ids takes each key once a document and shuffles by key and
    document first, so a line that a third of all documents hold is no hot key.
    """
    return (
        rows.select(F.struct("doc_id").alias("doc"), F.explode(line_keys(F.col("text"))).alias("key"))
        .filter("key is not null")
        .groupBy("key").agg(F.count_distinct("doc").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )


def drop_common_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``docs`` with the lines dropped whose key stands in ``min_docs`` documents or more.

    Keeps all columns but replaces ``text`` (null counts as one empty line), and adds a
    struct of n_lines and n_dropped; its name is returned by ``counts_name``.  Lines
    without a visible character always stay.  Rows that share a doc_id count as one
    document.  Only hashes and positions are shuffled by line; each text is shuffled once,
    by its document.
    """
    rows = common.keyed(docs)
    # Written, so that the join has plain exchanges and Spark can split a line's many rows.
    found = common.written(common_lines(rows, min_docs), "common-lines")
    placed = rows.select(
        "doc_id", "row_hash", F.posexplode(line_keys(F.col("text"))).alias("pos", "key"),
    ).filter("key is not null")
    drops = (
        placed.join(found, "key", "left_semi")
        .groupBy("doc_id", "row_hash").agg(F.collect_set("pos").alias("drop"))
        .select(F.col("doc_id").alias("drop_id"), F.col("row_hash").alias("drop_hash"), "drop")
    )
    counts, row = counts_name(docs), common.fresh(docs, "row_hash")
    out = docs.withColumn("text", common.text_of()).withColumn(row, common.text_key())
    same = out["doc_id"].eqNullSafe(drops["drop_id"]) & (out[row] == drops["drop_hash"])
    lines, gone = common.fresh(out, "lines"), common.fresh(out, "gone")
    joined = out.join(drops, same, "left").select(
        *[out[c] for c in docs.columns], lines_of(out["text"]).alias(lines),
        F.coalesce(drops["drop"], F.array().cast("array<int>")).alias(gone),
    )
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)),
        lambda i: F.get(F.col(lines), i),
    )
    done = joined.withColumn(
        counts,
        F.struct(
            F.size(lines).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped")
        ),
    )
    text = F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    return done.withColumn("text", text).drop(lines, gone)


def counts_name(docs: DataFrame) -> str:
    return common.fresh(docs, "line_counts")
