"""Mixing to target weights by iterative proportional fitting (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsignal.llm import common

ROUNDS = 6
POWER = 0.9
SEED = 17
DIMS = ["source", "lang", "topic"]


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(common.WORD)).cast("long")


def topic(tokens: Column, text: Column) -> Column:
    """A coarse topic from the form of a text: marked up, brief, long or plain prose."""
    marks = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return (
        F.when(2 * marks > tokens, "marked").when(tokens < 100, "brief")
        .when(tokens >= 1000, "long").otherwise("prose")
    )


def weighed(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, n_tokens and the three dimensions; null values count as empty."""
    rows = docs.select(
        "doc_id", common.text_key().alias("row_hash"), common.text_of().alias("text"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("source", "lang")],
    ).withColumn("n_tokens", n_tokens(F.col("text")))
    return rows.withColumn("topic", topic(F.col("n_tokens"), F.col("text"))).drop("text")


def tempered(cells: DataFrame, dim: str, power: float = POWER) -> DataFrame:
    """Target shares of a dimension: its token shares, flattened by the power."""
    mass = cells.groupBy(dim).agg(F.pow(F.sum("n_tokens"), F.lit(power)).alias("mass"))
    total = mass.agg(F.sum("mass")).first()[0] or 1.0
    return mass.select(dim, (F.col("mass") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with a column ``weight`` that matches the target shares of every dimension.

    ``cells`` has the dimensions and n_tokens (above 0); each target has its dimension and
    a share.  A round scales the weights to one dimension after the other.  Targets of
    values without a cell are ignored.  The weights add up to 1 along the last dimension.
    """
    for dim, target in targets.items():
        cells = cells.join(target.withColumnRenamed("share", f"{dim}_share"), dim)
    weight: Column = F.col("n_tokens").cast("double")
    out = cells.withColumn("weight", weight)
    for _ in range(rounds):
        for dim in targets:
            own = F.sum("weight").over(Window.partitionBy(dim))
            out = out.withColumn("weight", F.col("weight") * F.col(f"{dim}_share") / own)
    return out.drop(*[f"{dim}_share" for dim in targets])


def capped(factor: float = 1.0) -> Column:
    return F.least(F.lit(1.0), F.col("rate") * F.lit(factor))


def filling(rated: DataFrame, budget: float) -> float:
    """The factor of the rates with which the cells' tokens, each at most whole, reach the budget.

    Each step holds the cells that are whole and spreads what they leave over the others, so
    factors only rise and the steps end when no further cell gets whole.
    """
    rated = rated.select("n_tokens", "rate")
    factor = budget / (rated.agg(F.sum(F.col("n_tokens") * F.col("rate"))).first()[0] or 1.0)
    before = 0
    while True:
        over = F.col("rate") * F.lit(factor) >= 1
        n_whole, whole, free = rated.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, F.col("n_tokens"))),
            F.sum(F.when(~over, F.col("n_tokens") * F.col("rate"))),
        ).first()
        if n_whole == before or not free:
            return factor
        before, factor = n_whole, (budget - whole) / free


def rake_within(
    cells: DataFrame, targets: dict[str, DataFrame], budget: float, rounds: int = ROUNDS
) -> DataFrame:
    """Cells with a column ``probability``, at most 1, so that ``budget`` tokens are expected.

    As ``rake``, but a cell gives no more tokens than it has: a round counts a cell's rate up
    to 1, so the others make up for what a scarce cell lacks.  A last factor meets the
    budget, or keeps everything where there are fewer tokens.  Targets that cells are too
    scarce for are missed; ``residuals`` says by how much.
    """
    for dim, target in targets.items():
        cells = cells.join(target.withColumnRenamed("share", f"{dim}_share"), dim)
    total = cells.agg(F.sum("n_tokens")).first()[0] or 1
    out = cells.withColumn("rate", F.lit(budget / total))
    for _ in range(rounds):
        for dim in targets:
            own = F.sum(F.col("n_tokens") * capped()).over(Window.partitionBy(dim))
            wanted = F.col(f"{dim}_share") * F.lit(float(budget))
            out = out.withColumn("rate", F.when(own > 0, F.col("rate") * wanted / own).otherwise(F.lit(0.0)))
    out = common.written(out.drop(*[f"{dim}_share" for dim in targets]), "mix-raked")
    return out.withColumn("probability", F.round(capped(filling(out, budget)), 9)).drop("rate")


def residuals(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """dim, value, target_share and the kept_share of the expected tokens of ``rake_within``."""
    mass = F.col("n_tokens") * F.col("probability")
    total = cells.agg(F.sum(mass)).first()[0] or 1.0
    parts = [
        cells.groupBy(dim).agg((F.sum(mass) / F.lit(total)).alias("kept_share"))
        .join(target, dim, "full")
        .select(
            F.lit(dim).alias("dim"), F.col(dim).alias("value"), F.col("share").alias("target_share"),
            F.coalesce("kept_share", F.lit(0.0)).alias("kept_share"),
        )
        for dim, target in targets.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def unit_hash(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the md5 of the key: the same on every engine and run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
    power: float = POWER, seed: int = SEED, kept_share: float | None = None,
) -> DataFrame:
    """Samples documents so that their tokens match target shares of source, language and topic.

    Token counts per cell are raked to the targets (by default each dimension's own shares,
    flattened).  With ``kept_share`` that share of all tokens is expected to stay: see
    ``rake_within``.  Without it a document's probability is its cell's raked weight per
    token, scaled so that the scarcest cell is kept whole, so that one cell sets the kept
    share of all.  The hash of doc_id decides; with ``kept_share`` rows without a doc_id are
    drawn one by one, by their text.  Documents without a word cost nothing and stay.  Returns doc_id, row_hash, the dimensions, n_tokens, probability and kept.
    """
    rows = common.written(weighed(docs), "mix-rows")
    counted = rows.groupBy(*DIMS).agg(F.sum("n_tokens").alias("n_tokens"))
    cells = common.written(counted.filter("n_tokens > 0"), "mix-cells")
    targets = targets or {dim: tempered(cells, dim, power) for dim in DIMS}
    if kept_share is None:
        raked = rake(cells, targets, rounds)
        rates = common.written(
            raked.select(*DIMS, (F.col("weight") / F.col("n_tokens")).alias("rate")), "mix-rates"
        )
        top = rates.agg(F.max("rate")).first()[0] or 1.0
        scaled = rates.select(*DIMS, F.round(F.col("rate") / F.lit(top), 9).alias("probability"))
    else:
        budget = kept_share * (cells.agg(F.sum("n_tokens")).first()[0] or 0)
        scaled = rake_within(cells, targets, budget, rounds).select(*DIMS, "probability")
    out = rows.join(scaled, DIMS, "left").withColumn(
        "probability",
        F.when(F.col("n_tokens") == 0, 1.0).otherwise(F.coalesce("probability", F.lit(0.0))),
    )
    key = F.col("doc_id").cast("string")
    if kept_share is not None:
        key = F.coalesce(key, F.hex("row_hash"))
    return out.withColumn("kept", unit_hash(key, seed) < F.col("probability"))
