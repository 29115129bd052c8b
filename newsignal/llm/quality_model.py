"""Quality scores by naive Bayes support vectors (operator 11).

Texts become sets of n-gram indicators.  Each indicator is scaled by the log ratio of its
counts in good and bad texts, and a linear hinge-loss model over the scaled indicators is
fitted by dual coordinate descent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from newsignal.llm import common, hashing

BUCKETS = 1 << 18
SAMPLE = 8192  # labelled rows that the hinge-loss model is fitted on, at most
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 60
TOLERANCE = 1e-2
FOLDS, HELD_OUT = 3, 1  # fixed values of the contract
CALIBRATED = 5  # one of so many sample rows sets the scale of the scores
CACHED_WORDS = 100_000
SLICE = 2 << 20  # bytes of text whose n-grams are held at once
SHAPES = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)
RUN = re.compile(rb"(.)\1+", re.DOTALL)
SAME = hashing.U64(0xA0761D6478BD642F)


def shape(word: bytes) -> bytes:
    """The word with letters, capitals and digits as a, A and 0, and runs of one sign as sign and +."""
    return RUN.sub(rb"\1+", word.translate(SHAPES))


class WordHashes(dict):
    """Hashes of the lower-case word and of its shape, for the words a task has met."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = out = (
            xxhash.xxh3_64_intdigest(word.lower(), 1), xxhash.xxh3_64_intdigest(shape(word), 2)
        )
        return out


def indicators(batch: pa.RecordBatch, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each n-gram that a text holds, once each, in order.

    Words in lower case, and runs of one to three word shapes; a word equal to the one
    before it has a shape of its own.
    """
    raw, offsets = hashing.column_bytes(batch.column("text"))
    words = hashing.Words(raw, offsets)
    codes, different = hashing.distinct(raw, words.start, words.end)
    pairs = np.array([known[w] for w in different], np.uint64).reshape(-1, 2)
    owner = np.repeat(np.arange(len(batch)), words.behind - words.first)
    plain, shapes = pairs[codes, 0], pairs[codes, 1].copy()
    if len(codes):
        again = np.append(False, (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1]))
        shapes[again] ^= SAME
    grams, owners = [plain], [owner]
    run = np.zeros(len(shapes), np.uint64)
    for n in range(1, 4):
        size = max(len(shapes) - n + 1, 0)
        run = hashing.mix(run[:size] * hashing.U64(hashing.STEP) + shapes[len(shapes) - size :])
        inside = owner[:size] == owner[len(owner) - size :]
        grams.append(run[inside])
        owners.append(owner[:size][inside])
    keys = np.concatenate(owners) * BUCKETS + (hashing.mix(np.concatenate(grams)) % hashing.U64(BUCKETS)).astype(np.int64)
    keys = np.unique(keys)
    return keys // BUCKETS, keys % BUCKETS


def with_indicators(docs: DataFrame) -> DataFrame:
    """doc_id and the sorted buckets of each text; null and empty texts have none."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for whole in batches:
            for batch in common.slices(whole, limit=SLICE):
                rows, buckets = indicators(batch, known)
                offsets = np.searchsorted(rows, np.arange(len(batch) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(buckets.astype(np.int32))),
                    ],
                    names=["doc_id", "buckets"],
                )

    return docs.select("doc_id", "text").mapInArrow(build, "doc_id long, buckets array<int>")


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; a null id has no label at all."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Indicators of the labelled rows outside the held-out fold, with good (boolean), written once.

    Of several labels of one doc_id the worst counts; other values than 0 and 1 are none.
    Rows and labels meet in a sort-merge join, which Spark splits where one doc_id holds
    very many rows.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").alias("label_id")
    ).agg((F.min("quality") == 1).alias("good"))
    wanted = with_indicators(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    joined = wanted.join(known.hint("merge"), wanted["doc_id"] == known["label_id"])
    return common.written(joined.select("doc_id", "buckets", "good"), "training")


def class_counts(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class that hold each indicator, over all training rows: [2, BUCKETS] and [2]."""
    each = train.select("good", F.explode("buckets").alias("bucket"))
    counts = each.groupBy("good", "bucket").agg(F.count(F.lit(1)).alias("n")).toArrow()
    out = np.zeros((2, BUCKETS), np.int64)
    out[counts.column("good").to_numpy().astype(int), counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    sizes = np.zeros(2, np.int64)
    for r in train.groupBy("good").count().collect():
        sizes[int(r["good"])] = r["count"]
    return out, sizes


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each indicator in good texts over that in bad ones."""
    shares = counts + SMOOTHING
    shares = shares / shares.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0]).astype(np.float32)


@dataclass(frozen=True)
class Sparse:
    """Rows of scaled indicators, each of length one, with a constant 1 at index BUCKETS."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def margins(self, weights: np.ndarray) -> np.ndarray:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        return np.bincount(rows, weights=self.values * weights[self.columns], minlength=len(self.starts) - 1)


def scaled(buckets: pa.ListArray, ratios: np.ndarray) -> Sparse:
    columns = buckets.flatten().to_numpy().astype(np.int64)
    offsets = buckets.offsets.to_numpy() - buckets.offsets[0].as_py()
    n = len(offsets) - 1
    values = ratios[columns].astype(np.float64)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    lengths = np.sqrt(np.bincount(rows, weights=values * values, minlength=n))
    values /= np.maximum(lengths[rows], 1e-12)
    at = offsets[1:]  # the constant closes each row
    return Sparse(offsets + np.arange(n + 1), np.insert(columns, at, BUCKETS), np.insert(values, at, 1.0))


def dual_coordinate_descent(
    x: Sparse, signs: np.ndarray, cost: float = COST, rounds: int = ROUNDS, tolerance: float = TOLERANCE,
) -> np.ndarray:
    """Weights of the linear model with hinge loss and L2 penalty.

    One dual variable after the other, in a new order each round, moves to its best value
    between 0 and ``cost``, and the weights follow.  Ends when no projected gradient of a
    round is larger than ``tolerance``.
    """
    weights, alphas = np.zeros(BUCKETS + 1), np.zeros(len(signs))
    parts = [slice(a, b) for a, b in zip(x.starts[:-1], x.starts[1:])]
    rows = [(x.columns[p], x.values[p]) for p in parts]
    squares = [float(v @ v) for _, v in rows]
    order, random = np.arange(len(signs)), np.random.RandomState(11)
    for _ in range(rounds):
        random.shuffle(order)
        worst = 0.0
        for i in order:
            columns, values = rows[i]
            gradient = signs[i] * (weights[columns] @ values) - 1
            old = alphas[i]
            step = min(gradient, 0.0) if old == 0 else max(gradient, 0.0) if old == cost else gradient
            worst = max(worst, abs(step))
            if step:
                alphas[i] = min(max(old - gradient / squares[i], 0.0), cost)
                weights[columns] += (alphas[i] - old) * signs[i] * values
        if worst < tolerance:
            break
    return weights


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def calibration(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the logistic curve from margins to shares of good rows."""
    n_good, n_bad = good.sum(), (~good).sum()
    # Targets a little inside 0 and 1, so that separable rows have a finite slope.
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    slope, offset = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(slope * margins + offset)
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((p - target) * margins).sum() + 1e-3 * slope, (p - target).sum()])
        curve = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 4.0 / max(abs(step).max(), 1e-12))
        slope, offset = slope - step[0], offset - step[1]
        if abs(step).max() < 1e-9:
            break
    return (float(slope), float(offset)) if slope > 0 else (1e-6, float(np.log((n_good + 1) / (n_bad + 1))))


@dataclass(frozen=True)
class Model:
    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def scores(self, buckets: pa.ListArray) -> np.ndarray:
        return sigmoid(self.slope * scaled(buckets, self.ratios).margins(self.weights) + self.offset)


def fit(train: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of ``training_rows``.

    Ratios come from all rows.  The hinge-loss model is fitted on at most ``sample`` rows, those of
    least hash, in one task; one in CALIBRATED of them only sets the scale of the scores.
    Where a class is missing, all scores are the smoothed share of good rows.
    """
    counts, sizes = class_counts(train)
    ratios = log_ratios(counts)
    prior = float(np.log((sizes[1] + 1) / (sizes[0] + 1)))
    constant = Model(ratios, np.zeros(BUCKETS + 1), 1.0, prior)
    if not sizes.all():
        return constant
    order = F.xxhash64("doc_id", "buckets")
    chosen = train.select("good", "buckets", order.alias("draw")).orderBy("draw").limit(sample)

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("draw").combine_chunks()
        good = table.column("good").to_numpy(zero_copy_only=False).astype(bool)
        x = scaled(pa.concat_arrays(table.column("buckets").chunks), ratios)
        calibrates = np.arange(len(good)) % CALIBRATED == 0
        fits = ~calibrates
        if not (good[fits].any() and (~good[fits]).any() and good[calibrates].any() and (~good[calibrates]).any()):
            calibrates = fits = np.ones(len(good), bool)
        if not (good.any() and (~good).any()):
            weights, slope, offset = constant.weights, 1.0, prior
        else:
            weights = dual_coordinate_descent(rows_of(x, fits), np.where(good[fits], 1.0, -1.0))
            slope, offset = calibration(rows_of(x, calibrates).margins(weights), good[calibrates])
        used = np.flatnonzero(weights)
        return pa.table({
            "at": pa.array([*used.tolist(), -1, -2], pa.int32()),
            "value": pa.array([*weights[used].tolist(), slope, offset], pa.float64()),
        })

    found = chosen.groupBy(F.lit(0).alias("one")).applyInArrow(solve, "at int, value double").toArrow()
    weights = np.zeros(BUCKETS + 3)
    weights[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return Model(ratios, weights[: BUCKETS + 1], float(weights[-1]), float(weights[-2]))


def rows_of(x: Sparse, chosen: np.ndarray) -> Sparse:
    sizes = np.diff(x.starts)
    inside = np.repeat(chosen, sizes)
    return Sparse(np.append(0, np.cumsum(sizes[chosen])), x.columns[inside], x.values[inside])


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher for likelier good texts) and predicted of each row.

    A score depends on the text alone.  Null and empty texts have no indicators and get
    the score of the constant.  Equal rows get equal scores; a null doc_id is never
    learned from.  Model tables have BUCKETS entries, whatever the corpus.
    """
    model = fit(training_rows(docs, labels), sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("buckets"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    scored = with_indicators(docs).mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
