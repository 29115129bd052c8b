"""Substring deduplication with automata of recurring phrases (operator 10)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common, hashing, recurring

SHARD_WORDS = 300_000
HOT_CONTEXTS = 4096


def later_windows(rows: pd.DataFrame, span: int) -> list[list[tuple[int, int]]]:
    """For each row of a shard, ranges of its windows that stand at an earlier place too.

    Phrases of ``span`` words that the shard holds more than once are confirmed word by
    word, compiled into one Aho-Corasick automaton over word numbers, and every row is
    streamed through it to find all their places.
    """
    import ahocorasick

    numbers: dict[bytes, int] = {}
    bodies = [
        tuple(numbers.setdefault(w, len(numbers)) for w in body.split(b" ")) for body in rows["body"]
    ]
    seen = Counter(b[i : i + span] for b in bodies for i in range(len(b) - span + 1))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for i, (phrase, n) in enumerate(seen.items()):
        if n > 1:
            automaton.add_word(phrase, i)
    if not len(automaton):
        return [[] for _ in bodies]
    automaton.make_automaton()
    # A null doc_id comes before all others, as in Spark's order.
    places = [
        ((0, 0) if pd.isna(d) else (1, int(d)), bytes(h), int(f))
        for d, h, f in zip(rows["doc_id"], rows["row_hash"], rows["first"])
    ]
    hits = [[(end - span + 1, phrase) for end, phrase in automaton.iter(b)] for b in bodies]
    earliest: dict[int, tuple] = {}
    for (doc, row, first), found in zip(places, hits):
        for start, phrase in found:
            place = (doc, row, first + start)
            if phrase not in earliest or place < earliest[phrase]:
                earliest[phrase] = place
    out = []
    for (doc, row, first), found, body in zip(places, hits, bodies):
        flags = np.zeros(len(body) - span + 1, bool)
        for start, phrase in found:
            flags[start] = earliest[phrase] != (doc, row, first + start)
        out.append(recurring.ranges(flags))
    return out


def later_splits(each: DataFrame) -> DataFrame:
    """Rows of FOUND for split windows that stand at an earlier place too.

    The earliest place of a window is found on the map side first and written before the
    join, which Spark splits where very many contexts hold one window.
    """
    ends = each.groupBy("key").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    ends = common.written(ends.filter("least < most").select("key", "least"), "earliest")
    return each.join(ends, "key").filter("least < place").select("gram", "context", recurring.one_window())


def repeated_phrases(
    rows: DataFrame, kind: recurring.Windows = recurring.WORDS_20,
    shard_words: int = SHARD_WORDS, hot: int = HOT_CONTEXTS,
) -> DataFrame:
    """Word ranges [a, b) of ``keyed`` documents covered by a window that starts earlier too.

    Earlier means a smaller doc_id (null first), or the same document and an earlier word;
    rows that share doc_id and text are one document.  Returns doc_id, row_hash, a, b.
    """
    points = recurring.recurring_points(rows, kind)
    known = recurring.contexts(points)
    texts = common.written(
        recurring.context_texts(known.filter("n_contexts > 1"), rows, kind), "context-texts"
    )
    dealt = recurring.sharded(texts, kind, shard_words, hot)

    def shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["context", "gram"])
        found = [[{"a": a, "b": b} for a, b in r] for r in later_windows(part, kind.span)]
        out = part[["gram", "context"]].assign(found=found)
        return out[out["found"].map(len) > 0]

    in_shards = dealt.groupBy("shard").applyInPandas(shard, recurring.FOUND)
    split = later_splits(recurring.split_windows(texts, kind, hot))
    later = recurring.per_context(in_shards.unionByName(split))
    known = common.written(
        known.select("gram", "context", "place").join(later, ["gram", "context"], "left"), "verdicts"
    )
    placed = points.join(known, ["gram", "context"])
    own = (
        F.col("doc_id").eqNullSafe(F.col("place.doc_id"))
        & (F.col("row_hash") == F.col("place.row_hash")) & (F.col("first") == F.col("place.first"))
    )
    every = F.array(F.struct(F.lit(0).alias("a"), F.col("windows").alias("b")))
    return placed.select(
        "doc_id", "row_hash", "first", F.explode(F.when(own, F.col("found")).otherwise(every)).alias("r")
    ).select(
        "doc_id", "row_hash", (F.col("first") + F.col("r.a")).alias("a"),
        (F.col("first") + F.col("r.b") + F.lit(kind.span - 1)).alias("b"),
    )


def drop_repeated_phrases(
    docs: DataFrame, kind: recurring.Windows = recurring.WORDS_20,
    shard_words: int = SHARD_WORDS, hot: int = HOT_CONTEXTS,
) -> DataFrame:
    """Documents without the words of repeated phrases: doc_id, text, n_words, n_removed.

    The words that stay are joined by one space.  A null text has no words.
    """
    rows = common.keyed(docs)
    marked = recurring.with_removed(rows, repeated_phrases(rows, kind, shard_words, hot))
    schema = "doc_id long, text string, n_words long, n_removed long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                raw, offsets = hashing.column_bytes(batch.column("text"))
                words = hashing.Words(raw, offsets)
                texts, counts, removed = [], [], []
                for i, spans in enumerate(batch.column("spans").to_pylist()):
                    first, behind = int(words.first[i]), int(words.behind[i])
                    keep = np.ones(behind - first, bool)
                    for a, b in recurring.merged(spans):
                        keep[a:b] = False
                    left = raw[offsets[i] : offsets[i + 1]].tobytes().split() if keep.all() else [
                        raw[words.start[first + j] : words.end[first + j]].tobytes() for j in np.flatnonzero(keep)
                    ]
                    texts.append(b" ".join(left).decode())
                    counts.append(len(keep))
                    removed.append(int((~keep).sum()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string()),
                        pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                    ],
                    names=["doc_id", "text", "n_words", "n_removed"],
                )

    return marked.mapInArrow(cut, schema)


