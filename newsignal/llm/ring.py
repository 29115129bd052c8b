"""Sharding on a consistent-hash ring with bounded loads (operator 1)."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from newsignal.llm import common
from newsignal.sources.tables import local_table

PIECE = T.ArrayType(
    T.StructType(
        [
            T.StructField("upto", T.LongType()), T.StructField("shard", T.IntegerType()),
            T.StructField("slot", T.LongType()),
        ]
    )
)


@dataclass(frozen=True)
class Ring:
    """``points`` virtual nodes per shard on a ring of 64-bit places.

    Arc ``a`` holds the places up to and including virtual node ``a``; what lies behind
    the last one belongs to the first.
    """

    shards: int
    points: int = 128

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in clockwise order and the shard of each."""
        def place(shard: int, point: int) -> int:
            digest = hashlib.blake2b(f"{shard}/{point}".encode(), digest_size=8).digest()
            return int.from_bytes(digest, "big", signed=True)

        known = sorted((place(s, p), s) for s in range(self.shards) for p in range(self.points))
        return np.array([x[0] for x in known], np.int64), np.array([x[1] for x in known])

    def capacities(self, total: int, slack: float) -> list[int]:
        """Most keys of each shard.  Without slack they add up to the total, one apart."""
        if slack > 0:
            return [int(np.ceil((1 + slack) * total / self.shards))] * self.shards
        return [total // self.shards + (s < total % self.shards) for s in range(self.shards)]

    def place(self, counts: dict[int, int], slack: float) -> list[tuple[int, list[tuple[int, int, int]]]]:
        """For each arc, which of its keys (in order of their hash) go to which shard.

        Each shard first takes the keys of its own arcs, clockwise, until it is full.
        Keys that are left go on clockwise to the next shard with room.  Returns
        (arc, [(up to this rank, shard, first slot)]).  Works on one count per arc only.
        """
        _, owner = self.nodes()
        room = self.capacities(sum(counts.values()), slack)
        used = [0] * self.shards
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        left: list[tuple[int, int]] = []

        def give(arc: int, shard: int, rank: int, n: int) -> int:
            taken = min(n, room[shard])
            if taken:
                pieces.setdefault(arc, []).append((rank + taken, shard, used[shard] - rank))
                room[shard] -= taken
                used[shard] += taken
            return taken

        for arc in sorted(counts):
            taken = give(arc, int(owner[arc]), 0, counts[arc])
            if taken < counts[arc]:
                left.append((arc, taken))
        for arc, rank in left:
            step = arc
            while rank < counts[arc]:
                step = (step + 1) % len(owner)
                rank += give(arc, int(owner[step]), rank, counts[arc] - rank)
        return sorted(pieces.items())


def bounded_ring_shards(docs: DataFrame, ring: Ring, slack: float = 0.0) -> DataFrame:
    """Documents with home shard, shard and slot.

    The hash of doc_id picks the arc.  Only one count per arc (``shards * points`` rows at
    most) passes the driver.  Without slack shard counts are at most one apart; with
    slack no shard holds more than 1 + slack times the mean.  A key moves off its home
    shard only when that is full.  Null text counts as empty, a null doc_id is a key like
    any other.  Returns doc_id, size, text_crc32, home_shard, shard, slot.
    """
    nodes, owner = ring.nodes()

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(nodes, place.to_numpy()) % len(nodes), dtype="int32")

    keys = common.written(
        docs.select(
            "doc_id", (F.octet_length(common.text_of()) + 8).cast("long").alias("size"),
            F.crc32(common.text_of().cast("binary")).alias("text_crc32"),
            F.xxhash64("doc_id").alias("place"),
        ).withColumn("arc", arc_of("place")),
        "ring",
    )
    counts = {r["arc"]: r["count"] for r in keys.groupBy("arc").count().collect()}
    schema = T.StructType(
        [
            T.StructField("arc", T.IntegerType()), T.StructField("home_shard", T.IntegerType()),
            T.StructField("pieces", PIECE),
        ]
    )
    rows = [
        (arc, int(owner[arc]), [dict(zip(("upto", "shard", "slot"), p)) for p in pieces])
        for arc, pieces in ring.place(counts, slack)
    ]
    arcs = local_table(docs.sparkSession, rows, schema)
    order = Window.partitionBy("arc").orderBy("place", "doc_id", "size", "text_crc32")
    ranked = keys.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    placed = ranked.join(arcs, "arc").withColumn(
        "piece", F.element_at(F.filter("pieces", lambda p: F.col("rank") < p["upto"]), 1)
    )
    return placed.select(
        "doc_id", "size", "text_crc32", "home_shard", F.col("piece.shard").alias("shard"),
        (F.col("piece.slot") + F.col("rank")).alias("slot"),
    )
