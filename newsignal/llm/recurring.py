"""Runs of units (bytes or words) that recur: the search that operators 6 and 10 share.

Every window of ``span`` units selects one sample point by its content (see ``hashing``).
Equal windows select equal grams, so a window can only recur where its gram does.  The
windows that select one sample point cover its *context*; sample points with equal
contexts have equal windows.  Only contexts whose gram also stands in another context have
to be compared unit by unit, and of those only one text each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsignal.llm import common, hashing


@dataclass(frozen=True)
class Windows:
    unit: str  # "byte" or "word"
    span: int
    gram: int


BYTES_200 = Windows("byte", 200, 40)
WORDS_20 = Windows("word", 20, 6)


def units(batch: pa.RecordBatch, kind: Windows):
    """Raw bytes, words (or None), unit values on demand, first and last unit of each text."""
    raw, offsets = hashing.column_bytes(batch.column("text"))
    if kind.unit == "byte":
        return raw, None, lambda a, b: hashing.BYTE_VALUES[raw[a:b]], offsets[:-1], offsets[1:]
    words = hashing.Words(raw, offsets)
    values = words.hashes()
    return raw, words, lambda a, b: values[a:b], words.first, words.behind


def sample_points(docs: DataFrame, kind: Windows) -> DataFrame:
    """Sample points of ``keyed`` documents.

    Returns gram, context (hashes), doc_id, row_hash, first (first window), windows (their
    number).  Each window of each text belongs to exactly one of them.
    """
    schema = "gram long, context long, doc_id long, row_hash binary, first long, windows int"

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                ids, rows = batch.column("doc_id"), batch.column("row_hash")
                _, _, values, starts, ends = units(batch, kind)
                for d, e, a, b in hashing.batched(starts, ends, kind.span):
                    found = hashing.anchors(
                        values(a, b), np.maximum(starts[d:e], a) - a, np.minimum(ends[d:e], b) - a,
                        kind.span, kind.gram,
                    )
                    if found is None:
                        continue
                    owner, _, first, last, gram, context = found
                    at = pa.array(owner + d)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)),
                            ids.take(at), rows.take(at),
                            pa.array(first + a - starts[owner + d]),
                            pa.array((last - first + 1).astype(np.int32)),
                        ],
                        names=["gram", "context", "doc_id", "row_hash", "first", "windows"],
                    )

    return docs.select("doc_id", "row_hash", "text").mapInArrow(points, schema)


def recurring_points(docs: DataFrame, kind: Windows) -> DataFrame:
    """Sample points whose gram occurs more than once in the corpus, written once.

    Counts are combined before the shuffle.  They are written before the join, which has
    plain exchanges on both sides then, so Spark splits a gram that very many texts hold.
    """
    points = common.written(sample_points(docs, kind), "points")
    often = points.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    often = common.written(often, "grams")
    return common.written(points.join(often, "gram", "left_semi"), "recurring")


def contexts(points: DataFrame) -> DataFrame:
    """Distinct contexts: gram, context, n (occurrences), place (the earliest), contested.

    The place orders by doc_id (null first), row_hash and position.  ``contested`` says
    that the gram stands in other contexts too.
    """
    distinct = points.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("doc_id", "row_hash", "first", "windows")).alias("place"),
    )
    distinct = common.written(distinct, "contexts")
    several = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("n_contexts")).filter("n_contexts > 1")
    several = common.written(several, "contested")
    return distinct.join(several, "gram", "left").select(
        "gram", "context", "n", "place", F.coalesce("n_contexts", F.lit(1)).alias("n_contexts")
    )


def context_texts(found: DataFrame, docs: DataFrame, kind: Windows) -> DataFrame:
    """Adds the bytes of each context, cut from the document of its earliest place.

    Words are joined by one space.  Each document is shuffled once, whatever the number
    of its contexts.
    """
    wanted = found.groupBy(
        F.col("place.doc_id").alias("want_id"), F.col("place.row_hash").alias("want_hash")
    ).agg(F.collect_list(F.struct("gram", "context", "n_contexts", "place")).alias("wanted"))
    same = docs["doc_id"].eqNullSafe(wanted["want_id"]) & (docs["row_hash"] == wanted["want_hash"])
    rows = docs.join(wanted, same).select("text", "wanted")
    schema = (
        "gram long, context long, n_contexts long, doc_id long, row_hash binary, first long, "
        "windows int, body binary"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                raw, words, _, starts, _ = units(batch, kind)
                out = []
                for i, wanted in enumerate(batch.column("wanted").to_pylist()):
                    for w in wanted:
                        place = w["place"]
                        a = starts[i] + place["first"]
                        b = a + place["windows"] - 1 + kind.span
                        if words is None:
                            body = raw[a:b].tobytes()
                        else:
                            body = b" ".join(raw[words.start[j] : words.end[j]].tobytes() for j in range(a, b))
                        out.append(
                            (w["gram"], w["context"], w["n_contexts"], place["doc_id"],
                             place["row_hash"], place["first"], place["windows"], body)
                        )
                types = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.int32(), pa.binary()]
                names = ["gram", "context", "n_contexts", "doc_id", "row_hash", "first", "windows", "body"]
                columns = list(zip(*out)) or [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return rows.mapInArrow(cut, schema)


def with_removed(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents with the list of unit ranges [a, b) to remove, in order, null where none.

    ``spans`` has doc_id, row_hash, a, b; ranges may overlap.
    """
    lists = spans.groupBy(
        F.col("doc_id").alias("span_id"), F.col("row_hash").alias("span_hash")
    ).agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"))
    same = docs["doc_id"].eqNullSafe(lists["span_id"]) & (docs["row_hash"] == lists["span_hash"])
    return docs.join(lists, same, "left").select(docs["doc_id"], docs["text"], "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Disjoint ranges from ordered ones; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for s in spans or []:
        if out and s["a"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["b"]))
        else:
            out.append((s["a"], s["b"]))
    return out


def sharded(texts: DataFrame, kind: Windows, shard_units: int, hot: int) -> DataFrame:
    """Context texts dealt into shards of about ``shard_units`` units, by their gram.

    Equal windows meet in one shard.  Grams with more than ``hot`` contexts are left to
    ``split_windows``.  Adds shard and together, the gram, whose rows must meet.
    """
    few = texts.filter(F.col("n_contexts") <= hot)
    total = few.agg(F.sum(F.col("windows") + F.lit(kind.span))).first()[0] or 0
    shards = F.lit(max(1, -(-total // shard_units)))
    return few.select(
        F.col("gram").alias("together"), "gram", "context", "doc_id", "row_hash", "first", "windows", "body",
    ).withColumn("shard", F.pmod(F.xxhash64("together"), shards))


def split_windows(texts: DataFrame, kind: Windows, hot: int) -> DataFrame:
    """The windows of grams with more than ``hot`` contexts, one by one, written once.

    Returns gram, context, shift (the place of the window in its context), place (doc_id,
    row_hash, first) and key, a 128-bit hash that stands for the window.  Such windows are
    compared by aggregates, so no task has to hold all copies of one.
    """
    each = texts.filter(F.col("n_contexts") > hot).withColumn(
        "shift", F.explode(F.sequence(F.lit(0), F.col("windows") - 1))
    )
    if kind.unit == "byte":
        body = F.substring("body", F.col("shift") + 1, F.lit(kind.span))
    else:
        words = F.split(F.col("body").cast("string"), " ")
        body = F.array_join(F.slice(words, F.col("shift") + 1, F.lit(kind.span)), " ").cast("binary")
    return common.written(each.select(
        "gram", "context", "shift",
        F.struct("doc_id", "row_hash", (F.col("first") + F.col("shift")).alias("first")).alias("place"),
        F.unhex(F.md5(body)).alias("key"),
    ), "split-windows")


def one_window() -> Column:
    """The range of a split window, as a row of FOUND has it."""
    return F.array(F.struct(F.col("shift").alias("a"), (F.col("shift") + 1).alias("b"))).alias("found")


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as ranges [a, b)."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


FOUND = "gram long, context long, found array<struct<a:int,b:int>>"


def per_context(found: DataFrame) -> DataFrame:
    """Window ranges of each context, also of those whose windows were dealt one by one."""
    parts = found.groupBy("gram", "context").agg(F.flatten(F.collect_set("found")).alias("found"))
    return common.written(parts, "found")
