"""Similarity join on word shingles with a token-group matrix (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common, hashing
from newsignal.llm.components import components

TASK_TOKENS = 400_000
GROUP_DOCS = 128
GROUP_TOKENS = 100_000
U64 = np.uint64
SKETCH = 64
SALTS = np.random.RandomState(30_011).randint(1, 2**63 - 1, SKETCH, dtype=np.int64).astype(U64)


@dataclass(frozen=True)
class Similar:
    """Sets of ``words``-word shingles that share at least ``percent`` % of their union."""

    words: int
    percent: int

    def differing(self, size: int) -> int:
        """Most tokens that two linked sets of at most ``size`` tokens do not share."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def classes(self, most: int) -> list[int]:
        """Largest size of each size class; linked sets lie in one class or in neighbours."""
        out = [0]
        while out[-1] < most:
            out.append(max(out[-1] + 1, out[-1] * 100 // self.percent + 1))
        return out


THREE_90 = Similar(3, 90)
FIVE_80 = Similar(5, 80)


def shingle_sets(batch: pa.RecordBatch, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the whole text where it has fewer words."""
    raw, offsets = hashing.column_bytes(batch.column("text"))
    found = hashing.Words(raw, offsets, lower=True)
    values = found.hashes()
    out = []
    for first, behind in zip(found.first.tolist(), found.behind.tolist()):
        n = behind - first
        if not n:
            out.append(np.zeros(0, U64))
        elif n < words:
            out.append(hashing.Runs(values[first:behind]).hash(np.array([0]), np.array([n])))
        else:
            out.append(np.unique(hashing.Runs(values[first:behind]).grams(words)))
    return out


def signatures(tokens: np.ndarray, similar: Similar, limits: list[int]) -> np.ndarray:
    """Hashes of which two linked, different sets have at least one in common.

    For its own size class and the next one, a set is dealt by token hash into one part
    more than linked sets can differ in tokens, so one part of both is equal.  Empty parts
    count only for sets that have some; a class whose linked sets are equal has none.
    """
    own = int(np.searchsorted(limits, len(tokens)))
    out = []
    for label in (own, own + 1):
        parts = similar.differing(limits[label]) + 1
        if parts == 1:
            continue
        part = (hashing.mix(tokens ^ U64(0x5BF0)) % U64(parts)).astype(np.int64)
        spread = hashing.mix(tokens)
        sums = np.zeros(parts, U64)
        np.add.at(sums, part, spread)
        sizes = np.bincount(part, minlength=parts)
        name = U64(label << 40) + np.arange(parts, dtype=U64)
        out.append(hashing.mix(sums + hashing.mix(name * U64(hashing.STEP) + sizes.astype(U64))))
    return np.concatenate(out) if out else np.zeros(0, U64)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """One byte for each of SKETCH minima under different hashes.

    Two sets agree in a byte with at least the chance of their similarity.
    """
    least = np.concatenate(
        [hashing.mix(tokens[None, :] ^ SALTS[i : i + 16, None]).min(axis=1) for i in range(0, SKETCH, 16)]
    )
    return (least & U64(255)).astype(np.uint8)


def described(docs: DataFrame, similar: Similar) -> DataFrame:
    """doc_id, row_hash, n_shingles, x and y (128-bit hash of the set) and sketch (null for no shingle)."""
    schema = "doc_id long, row_hash binary, n_shingles long, x long, y long, sketch binary"

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                n, x, y, sketches = [], [], [], []
                for tokens in shingle_sets(batch, similar.words):
                    n.append(len(tokens))
                    x.append(hashing.mix(tokens).sum(dtype=U64))
                    y.append(hashing.mix(tokens ^ U64(0xA5A5)).sum(dtype=U64))
                    sketches.append(sketch(tokens).tobytes() if len(tokens) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()), batch.column("row_hash"), pa.array(n, pa.int64()),
                        *[pa.array(np.array(c, U64).view(np.int64)) for c in (x, y)],
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "row_hash", "n_shingles", "x", "y", "sketch"],
                )

    return docs.select("doc_id", "row_hash", "text").mapInArrow(describe, schema)


def marks(texts: DataFrame, similar: Similar) -> DataFrame:
    """(mark, node): the signatures of each node's set."""
    limits = similar.classes(1 << 40)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                found = [
                    signatures(t, similar, limits) if len(t) else np.zeros(0, U64)
                    for t in shingle_sets(batch, similar.words)
                ]
                at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), batch.column("node").take(at)],
                    names=["mark", "node"],
                )

    return texts.select("node", "text").mapInArrow(mark, "mark long, node long")


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by mark, cut so that each mark lies in one table."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        found = table.column("mark").to_numpy()
        border = int(np.searchsorted(found, found[-1])) if len(found) else 0
        if border:
            yield table.slice(0, border)
        rest = table.slice(border)
    if rest is not None and len(rest):
        yield rest


def shared_marks(rows: DataFrame) -> DataFrame:
    """Rows (mark, node) of marks that more than one row has."""
    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches):
            found = table.column("mark").to_numpy()
            same = found[1:] == found[:-1]
            keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            yield from table.filter(pa.array(keep)).to_batches()

    dealt = rows.repartition("mark").sortWithinPartitions("mark")
    return dealt.mapInArrow(several, "mark long, node long")


class Forest:
    """Union-find over the rows of a task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def tied(nodes: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that connect what all pairs connect that can be linked.

    A pair can be linked if its sizes allow it and enough bytes of its sketches agree.  Of
    linked pairs at 80 %, fewer than 40 % of the bytes agree with a chance below 1e-10.
    """
    forest, out, least = Forest(len(nodes)), [], SKETCH * (percent - 40) / 100
    order = np.argsort(sizes, kind="stable")
    nodes, sizes, sketches = nodes[order], sizes[order], sketches[order]
    for i in range(len(nodes) - 1):
        end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
        alike = (sketches[i + 1 : end] == sketches[i]).sum(axis=1) >= least
        for j in np.flatnonzero(alike) + i + 1:
            if forest.join(i, int(j)):
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def families(shared: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """(node, family): sets that plausible pairs connect.  Linked sets are in one family.

    ``shared`` has the rows of marks with several nodes, ``sets`` n_shingles and sketch of
    each node.  The nodes of a mark are compared by size and sketch, so that a passage which
    unlike documents share does not tie them together.
    """
    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches):
            found, nodes, sizes = (table.column(c).to_numpy() for c in ("mark", "node", "n_shingles"))
            data = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
            borders = [0, *(np.flatnonzero(found[1:] != found[:-1]) + 1).tolist(), len(found)]
            out = []
            for a, b in zip(borders, borders[1:]):
                out += tied(nodes[a:b], sizes[a:b], data[a:b], similar.percent)
            out = sorted(set(out))
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    rows = shared.join(sets.select("node", "n_shingles", "sketch"), "node").select("mark", "node", "n_shingles", "sketch")
    dealt = rows.repartition("mark").sortWithinPartitions("mark")
    reached = components(dealt.mapInArrow(tie, "a long, b long")).withColumnRenamed("component", "family")
    return reached.unionByName(reached.select(F.col("family").alias("node"), "family").distinct())


def matrix(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1: which of the columns (sorted tokens) each set holds."""
    out = np.zeros((len(sets), len(columns)), np.float32)
    for i, tokens in enumerate(sets):
        at = np.searchsorted(columns, tokens)
        at[at == len(columns)] = 0
        out[i, at[columns[at] == tokens]] = 1
    return out


def cut_groups(rows: np.ndarray, sizes: np.ndarray, group_docs: int) -> Iterator[np.ndarray]:
    """Neighbouring rows, at most ``group_docs`` and GROUP_TOKENS together (or one row)."""
    begin = tokens = 0
    for i, n in enumerate(sizes[rows].tolist()):
        if i > begin and (i - begin == group_docs or tokens + n > GROUP_TOKENS):
            yield rows[begin:i]
            begin, tokens = i, 0
        tokens += n
    if begin < len(rows):
        yield rows[begin:]


def links(
    sets: list[np.ndarray], copies: np.ndarray, similar: Similar, left: np.ndarray, group_docs: int,
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect what all linked pairs connect, and how many copies each set is linked with.

    ``left`` marks sets to compare with the unmarked ones only; unmarked ones are compared
    with each other only where no set is marked.  Sets are grouped by size, then by least
    token.  The matrix of tokens by groups says which tokens any member holds; a group is
    opened for a query set only if its sizes can match and the query shares enough tokens
    with the group's union.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.lexsort(([int(s[0]) for s in sets], sizes, left))
    cross = bool(left.any())
    groups = []
    for side in (False, True):
        rows = order[left[order] == side]
        groups += [(side, g) for g in cut_groups(rows, sizes, group_docs)]
    unions = [np.unique(np.concatenate([sets[i] for i in rows])) for _, rows in groups]
    forest, out, t = Forest(len(sets)), [], similar.percent
    linked_copies = np.zeros(len(sets), np.int64)
    for g, (side, rows) in enumerate(groups):
        if cross and side:
            continue
        held = matrix([sets[i] for i in rows], unions[g])
        for h in range(g, len(groups)):
            other, queries = groups[h]
            if cross and not other:
                continue
            # 100 |a & b| >= t |a | b| needs |a & b| >= t/100 of the larger of both.
            queries = queries[
                (100 * sizes[queries] >= t * sizes[rows].min()) & (100 * sizes[rows].max() >= t * sizes[queries])
            ]
            if not len(queries):
                continue
            asked = held if g == h and len(queries) == len(rows) else matrix([sets[i] for i in queries], unions[g])
            opened = 100 * asked.sum(axis=1) >= t * sizes[queries]
            if not opened.any():
                continue
            queries, asked = queries[opened], asked[opened]
            shared = asked @ held.T
            union = sizes[queries][:, None] + sizes[rows][None, :] - shared
            linked = (100 * shared >= t * union) & (queries[:, None] != rows[None, :])
            # Within a group both sides of a link are queries.
            linked_copies[queries] += (linked * copies[rows]).sum(axis=1)
            if g != h:
                linked_copies[rows] += (linked * copies[queries][:, None]).sum(axis=0)
            for q, r in zip(*np.nonzero(linked)):
                a, b = int(queries[q]), int(rows[r])
                if forest.join(a, b):
                    out.append((a, b))
    return out, linked_copies


def linked_sets(members: DataFrame, texts: DataFrame, similar: Similar, task_tokens: int, group_docs: int) -> DataFrame:
    """Edges (a, b, 0) between nodes of one family that connect all linked pairs, and numbers of links.

    A row (a, a, n) adds n to the links of each copy of node a; it counts copies of other nodes.
    ``members`` has node, n_shingles, copies, family, ``texts`` node and text.  Families of up to ``task_tokens`` tokens share tasks.
    A larger one is dealt into parts, and each pair of parts is a task, so a task's size
    is bounded however large a family gets.
    """
    totals = members.groupBy("family").agg(
        F.sum("n_shingles").alias("tokens"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    pools = F.lit(max(1, -(-total // task_tokens)))
    parts = F.ceil(F.col("tokens") / F.lit(task_tokens)).cast("int")
    dealt = members.join(totals.withColumn("parts", parts), "family").withColumn(
        "part", F.pmod(F.hash("node"), F.col("parts"))
    )
    names = ["node", "copies", "family", "parts", "part"]
    schema = "node long, copies long, family long, parts int, part int, tokens array<long>"

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                sets = [s.view(np.int64) for s in shingle_sets(batch, similar.words)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in names], pa.array(sets, pa.list_(pa.int64()))],
                    names=[*names, "tokens"],
                )

    sets = texts.join(dealt, "node").select(*names, "text").mapInArrow(tokens, schema)
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.struct(F.least(F.col("part"), o).alias("p"), F.greatest(F.col("part"), o).alias("q")),
    )
    tasks = sets.withColumn("meet", F.explode(meets)).withColumn(
        "task",
        F.when(F.col("parts") == 1, F.pmod(F.xxhash64("family"), pools))
        .otherwise(F.xxhash64("family", "meet.p", "meet.q")),
    ).select("task", "family", "meet.p", "meet.q", "part", "node", "copies", "tokens")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, p, q), own in rows.groupby(["family", "p", "q"], sort=False):
            nodes = own["node"].tolist()
            sets = [np.sort(np.asarray(t, np.int64).view(U64)) for t in own["tokens"]]
            left = (own["part"] == p).to_numpy() if p != q else np.zeros(len(own), bool)
            edges, counts = links(sets, own["copies"].to_numpy(), similar, left, group_docs)
            out += [(nodes[a], nodes[b], 0) for a, b in edges]
            out += [(node, node, n) for node, n in zip(nodes, counts.tolist()) if n]
        return pd.DataFrame(out, columns=["a", "b", "n"], dtype="int64")

    return tasks.groupBy("task").applyInPandas(compare, "a long, b long, n long")


def jaccard_groups(
    docs: DataFrame, similar: Similar = FIVE_80, task_tokens: int = TASK_TOKENS,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row per document: doc_id, row_hash (see ``common.text_key``), n_shingles, component_id, n_links.

    Documents link when their shingle sets are similar enough; component_id is the
    smallest doc_id that links can reach, n_links the number of other rows that the row is
    linked with, copies included.  Equal sets become one node, of which one text goes on;
    sets that might link share a family, and families are compared in full; a link between
    different sets is missed with a chance below 1e-10, that of two similar sets with unlike
    sketches.  A document without words is alone.  Rows that share a doc_id are in one
    component, whatever their texts.  A null doc_id takes no part and has a null
    component_id and no links.
    """
    rows = common.keyed(docs)
    sets = common.written(described(rows, similar), "sets")
    usable = sets.filter("doc_id is not null and n_shingles > 0")
    first = F.min(F.struct("doc_id", "row_hash"))
    classes = usable.groupBy("x", "y").agg(
        first["doc_id"].alias("doc_id"), first["row_hash"].alias("row_hash"), F.count(F.lit(1)).alias("copies"),
        F.max("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"),
    )
    classes = common.written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # Repeated rows are one text.
    texts = rows.withColumn("doc_id", F.col("doc_id").cast("long")).join(
        classes.select("doc_id", "row_hash", "node"), ["doc_id", "row_hash"]
    ).groupBy("doc_id", "row_hash").agg(F.first("node").alias("node"), F.first("text").alias("text"))
    texts = common.written(texts.select("node", "text"), "texts", "zstd")
    shared = common.written(shared_marks(marks(texts, similar)), "marks")
    members = families(shared, classes, similar).join(classes.select("node", "n_shingles", "copies"), "node")
    found = common.written(linked_sets(members, texts, similar, task_tokens, group_docs), "links")

    # Rows that share a doc_id tie their sets together.
    own = usable.select("doc_id", "x", "y").join(classes.select("x", "y", "node"), ["x", "y"]).select("doc_id", "node")
    least = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    same_id = own.join(common.written(least, "shared-ids"), "doc_id").select("a", F.col("node").alias("b"))
    reached = components(found.select("a", "b").unionByName(same_id))
    placed = common.written(
        classes.join(reached, "node", "left").select(
            "x", "y", "node", "doc_id", "copies", F.coalesce("component", "node").alias("component")
        ),
        "placed",
    )
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = placed.join(smallest, "component").join(counts, "node", "left").select(
        "x", "y", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
    )
    keep = sets.select("doc_id", "row_hash", "n_shingles", "x", "y")
    linked = keep.filter("doc_id is not null and n_shingles > 0").join(common.written(named, "named"), ["x", "y"])
    alone = keep.filter("doc_id is null or n_shingles = 0").withColumns(
        {"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")}
    )
    columns = ["doc_id", "row_hash", "n_shingles", "component_id", "n_links"]
    return linked.select(*columns).unionByName(alone.select(*columns))
