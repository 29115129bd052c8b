"""Quality rules with verdicts per host (operator 7).  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsignal.llm import common

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
MAX_SYMBOL_PERCENT = 30
MAX_DUP_LINE_PERCENT = 30
RULES = ["short", "repeated", "symbols", "dup_lines"]
PRIOR_RANGE = (1.0, 1e6)


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeated_words(words: Column, hashes: Column, ordered: Column) -> Column:
    """Words in windows that a text holds twice or more, from its window hashes.

    ``ordered`` holds (hash, place) in order, or null where no hash occurs twice.  Equal
    neighbours give the places of repeated windows; each adds the words that the next one
    does not cover.
    """
    n = F.size(ordered)
    pairs = F.zip_with(
        F.slice(ordered, F.lit(1), n - 1), F.slice(ordered, F.lit(2), n - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    return F.array_sort(F.array_distinct(F.flatten(F.array_compact(pairs))))


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, row_hash, host and the counts of each document; a null text has none.

    Texts are read whole.  All work is per row, without a shuffle.
    """
    text = F.col("text")
    rows = docs.select(
        "doc_id", common.text_key().alias("row_hash"), F.col(host).alias("host"),
        common.text_of().alias("text"),
    )
    rows = rows.withColumn(
        "words", F.filter(F.split(text, common.SPACES, -1), lambda w: w != "")
    ).withColumn("n", F.size("words"))
    hashes = F.transform(
        F.sequence(F.lit(1), F.col("n") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(F.col("words"), i, F.lit(WINDOW))),
    )
    wordy = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(common.SPACE_CHARS)) != "")
    rows = rows.select(
        "doc_id", "row_hash", "host", F.col("n").cast("long").alias("n_words"),
        F.length(without(text, common.SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        wordy.alias("wordy"), F.when(F.col("n") > WINDOW, hashes).alias("hashes"),
    )
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn(
        "ordered",
        F.when(
            twice,
            F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).withColumn("places", repeated_words(F.col("words"), F.col("hashes"), F.col("ordered")))
    m = F.size("places")
    steps = F.zip_with(
        F.slice("places", F.lit(1), m - 1), F.slice("places", F.lit(2), m - 1),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(steps, F.lit(WINDOW), lambda s, x: s + x)
    return rows.select(
        "doc_id", "row_hash", "host", "n_words", "word_chars", "n_symbols",
        F.size("wordy").cast("long").alias("n_wordy_lines"),
        (F.size("wordy") - F.size(F.array_distinct("wordy"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def rule_failures() -> dict[str, Column]:
    """Which rule a measured document fails."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeated": 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_wordy_lines"),
    }


def host_verdicts(measured: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """host, its number of documents, its shrunk failure rate per rule, and the verdict.

    The prior of each rule is a beta distribution with the mean and variance of the rates
    of all hosts; a host's rate is the mean of its posterior, so a host of few documents
    stays near the corpus.  A host goes when any shrunk rate is above ``max_rate``.
    A null host is a host of its own.  Only the moments, eight numbers, pass the driver.
    """
    fails = rule_failures()
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.count_if(fails[r]).alias(f"{r}_fails") for r in RULES],
    )
    rate = {r: F.col(f"{r}_fails") / F.col("n_docs") for r in RULES}
    moments = hosts.agg(
        *[F.avg(rate[r]).alias(f"{r}_mean") for r in RULES],
        *[F.var_pop(rate[r]).alias(f"{r}_var") for r in RULES],
    )
    known = moments.first()
    low, high = PRIOR_RANGE
    shrunk = []
    for r in RULES:
        mean, var = known[f"{r}_mean"] or 0.0, known[f"{r}_var"] or 0.0
        weight = min(max(mean * (1 - mean) / var - 1, low), high) if var > 0 else high
        shrunk.append(
            ((F.col(f"{r}_fails") + weight * mean) / (F.col("n_docs") + weight)).alias(f"{r}_rate")
        )
    out = hosts.select("host", "n_docs", *shrunk)
    return out.withColumn(
        "host_kept", F.greatest(*[F.col(f"{r}_rate") for r in RULES]) <= max_rate
    )


def judge(docs: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """Measures of each document with base_failed and kept.

    The base rules are the word count and the share of repeated words.  A document that
    passes them stays unless its host is rejected.
    """
    measured = common.written(measures(docs, host), "host-rules")
    verdicts = host_verdicts(measured, max_rate).select(F.col("host").alias("h"), "host_kept")
    fails = rule_failures()
    judged = measured.join(verdicts, measured["host"].eqNullSafe(verdicts["h"]), "left")
    return judged.withColumn("base_failed", fails["short"] | fails["repeated"]).withColumn(
        "kept", ~F.col("base_failed") & F.col("host_kept")
    )
