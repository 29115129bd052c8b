"""Removal of repeated byte strings by difference-cover suffix sorting (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common, hashing, recurring

SHARD_BYTES = 1_000_000
HOT_CONTEXTS = 4096
NAME_BITS = 21  # three names fit into one 64-bit sort key
MOST = (1 << NAME_BITS) - 1


def pack(*parts: np.ndarray) -> np.ndarray:
    key = parts[0]
    for part in parts[1:]:
        key = (key << NAME_BITS) | part
    return key


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of numbers from 1 to MOST, shorter than MOST.

    The sample is the difference cover {1, 2} modulo 3.  Its suffixes are named by their
    sorted triples; while names repeat, the sequence of names is sorted the same way.
    The other suffixes are sorted by their first number and the rank behind it, and both
    orders are merged.
    """
    n = len(text)
    if n >= MOST or n and text.max() > MOST:
        raise ValueError(f"{n} numbers do not fit into keys of {NAME_BITS} bits")
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    ones = np.arange(1, n + (n % 3 == 1), 3)  # one more, so that names of both halves stay apart
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triples = pack(padded[sample], padded[sample + 1], padded[sample + 2])
    order = np.argsort(triples, kind="stable")
    ordered = triples[order]
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    if names.max() < len(sample):
        order = suffix_array(names)
    sampled = sample[order]
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = np.arange(1, len(sampled) + 1)
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(pack(padded[rest], rank[rest + 1]), kind="stable")]
    sampled = sampled[sampled < n]
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(
        pack(padded[one], rank[one + 1]), pack(padded[rest], rank[rest + 1])
    ) + np.searchsorted(
        pack(padded[two], padded[two + 1], rank[two + 2]),
        pack(padded[rest], padded[rest + 1], rank[rest + 2]),
    )
    out = np.empty(n, np.int64)
    at = before + np.arange(len(rest))
    out[at] = rest
    others = np.ones(n, bool)
    others[at] = False
    out[others] = sampled
    return out


def same_prefix(raw: np.ndarray, a: np.ndarray, b: np.ndarray, span: int) -> np.ndarray:
    """Whether the ``span`` (8 or more) bytes at a and b are equal, eight at a time."""
    eights = np.ndarray((len(raw) - 7,), np.uint64, raw.tobytes(), 0, (1,))
    alike = np.arange(len(a))
    for j in [*range(0, span - 7, 8), span - 8]:
        alike = alike[eights[a[alike] + j] == eights[b[alike] + j]]
    out = np.zeros(len(a), bool)
    out[alike] = True
    return out


def repeated_windows(bodies: list[bytes], windows: list[int], span: int) -> list[np.ndarray]:
    """For each body, which of its first ``windows`` windows stand elsewhere in the bodies too.

    Bodies are joined with a separator of their own each, so no match crosses them.
    """
    sizes = np.array([len(b) + 1 for b in bodies])
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(b + b"\0" for b in bodies), np.uint8)
    text = raw.astype(np.int64) + 1
    text[starts + sizes - 1] = 257 + np.arange(len(bodies))
    inside = np.zeros(len(raw) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + np.array(windows), -1)
    inside = np.cumsum(inside)[:-1] > 0
    order = suffix_array(text)
    order = order[inside[order]]
    alike = same_prefix(raw, order[:-1], order[1:], span)
    found = np.zeros(len(raw), bool)
    found[order[:-1][alike]] = True
    found[order[1:][alike]] = True
    return [found[s : s + w] for s, w in zip(starts, windows)]


def by_gram(part: pd.DataFrame, most: int) -> Iterator[pd.DataFrame]:
    """Parts of a shard with at most ``most`` bytes; equal windows stay in one part.

    A gram's contexts stay together.
    """
    part = part.sort_values("together", kind="stable")
    sizes = part["body"].map(len).to_numpy() + 1
    groups = part["together"].to_numpy()
    last = np.append(groups[1:] != groups[:-1], True)
    begin = total = since = 0
    for i in range(len(part)):
        since += sizes[i]
        if last[i]:
            if total and total + since > most:
                yield part.iloc[begin:start]
                begin, total = start, 0
            total += since
            since, start = 0, i + 1
    if begin < len(part):
        yield part.iloc[begin:]


def repeated_splits(each: DataFrame) -> DataFrame:
    """Rows of FOUND for split windows that stand in several contexts.

    Equal windows have equal shifts in their contexts, so a context holds a window once.
    Each window is one row after the map side; what recurs is written before the join,
    which Spark splits where very many contexts hold one window.
    """
    several = each.groupBy("key").agg(F.min("context").alias("low"), F.max("context").alias("high"))
    several = common.written(several.filter("low < high").select("key"), "several")
    return each.join(several, "key", "left_semi").select("gram", "context", recurring.one_window())


def repeated_bytes(
    rows: DataFrame, kind: recurring.Windows = recurring.BYTES_200,
    shard_bytes: int = SHARD_BYTES, hot: int = HOT_CONTEXTS,
) -> DataFrame:
    """Byte ranges [a, b) of ``keyed`` documents covered by a string that stands elsewhere too.

    Returns doc_id, row_hash, a, b; ranges may overlap.
    """
    points = recurring.recurring_points(rows, kind)
    known = recurring.contexts(points)
    texts = common.written(
        recurring.context_texts(known.filter("n_contexts > 1"), rows, kind), "context-texts"
    )
    dealt = recurring.sharded(texts, kind, shard_bytes, hot)

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part in by_gram(rows.drop_duplicates(["context", "gram"]), MOST // 2):
            flags = repeated_windows(part["body"].tolist(), part["windows"].tolist(), kind.span)
            found = [[{"a": a, "b": b} for a, b in recurring.ranges(f)] for f in flags]
            part = part[["gram", "context"]].assign(found=found)
            out.append(part[part["found"].map(len) > 0])
        return pd.concat(out)

    in_shards = dealt.groupBy("shard").applyInPandas(shard, recurring.FOUND)
    split = repeated_splits(recurring.split_windows(texts, kind, hot))
    partly = recurring.per_context(in_shards.unionByName(split))
    known = common.written(
        known.select("gram", "context", "n").join(partly, ["gram", "context"], "left"), "verdicts"
    )
    placed = points.join(known, ["gram", "context"])
    every = F.array(F.struct(F.lit(0).alias("a"), F.col("windows").alias("b")))
    return placed.select(
        "doc_id", "row_hash", "first",
        F.explode(F.when(F.col("n") > 1, every).otherwise(F.col("found"))).alias("r"),
    ).select(
        "doc_id", "row_hash", (F.col("first") + F.col("r.a")).alias("a"),
        (F.col("first") + F.col("r.b") + F.lit(kind.span - 1)).alias("b"),
    )


def drop_repeated_bytes(
    docs: DataFrame, kind: recurring.Windows = recurring.BYTES_200,
    shard_bytes: int = SHARD_BYTES, hot: int = HOT_CONTEXTS,
) -> DataFrame:
    """Documents without repeated bytes: doc_id, body (binary), n_bytes, n_removed, n_spans.

    Strings are judged on the input; a null text counts as empty.  What stays may cut a
    character, so it is binary.  Rows that share doc_id and text are places of their own.
    """
    rows = common.keyed(docs)
    marked = recurring.with_removed(rows, repeated_bytes(rows, kind, shard_bytes, hot))
    schema = "doc_id long, body binary, n_bytes long, n_removed long, n_spans long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                raw, offsets = hashing.column_bytes(batch.column("text"))
                bodies, sizes, removed, spans = [], [], [], []
                for i, found in enumerate(batch.column("spans").to_pylist()):
                    text = raw[offsets[i] : offsets[i + 1]].tobytes()
                    gone = recurring.merged(found)
                    borders = [0, *[x for ab in gone for x in ab], len(text)]
                    bodies.append(b"".join(text[a:b] for a, b in zip(borders[::2], borders[1::2])))
                    sizes.append(len(text))
                    removed.append(len(text) - len(bodies[-1]))
                    spans.append(len(gone))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()), pa.array(bodies, pa.binary()),
                        *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)],
                    ],
                    names=["doc_id", "body", "n_bytes", "n_removed", "n_spans"],
                )

    return marked.mapInArrow(cut, schema)
