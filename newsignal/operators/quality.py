"""Data-quality checks as a DataFrame of (check, ok, detail)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Rule:
    """A named measure over the table and the bounds it must keep.

    With ``keys`` the measure is taken over one row per key, which has its number of
    rows as ``n``: distinct values are counted by grouping, not by copying every row.
    """

    check: str
    measure: Column
    at_least: float | None = None
    at_most: float | None = None
    keys: tuple[str, ...] = ()


def min_rows(n: int = 1) -> Rule:
    return Rule("row_count", F.count(F.lit(1)), at_least=n)


def min_dates(column: str, n: int) -> Rule:
    return Rule(f"distinct_{column}", F.count(column), at_least=n, keys=(column,))


def max_nulls(column: str, share: float = 0.0) -> Rule:
    rate = F.count_if(F.col(column).isNull()) / F.greatest(F.count(F.lit(1)), F.lit(1))
    return Rule(f"null_share_{column}", rate, at_most=share)


def unique_key(*columns: str) -> Rule:
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return Rule("duplicates_" + "_".join(columns), extra, at_most=0, keys=columns)


def expectations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Tests each rule: (check, ok, detail).

    Plain measures are taken in one aggregate over the table, those with keys in one for
    each set of keys; a key that very many rows hold is counted before the shuffle.
    """
    parts = []
    for keys in dict.fromkeys(r.keys for r in rules):
        rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if keys else df
        parts.append(_tested(rows, [r for r in rules if r.keys == keys]))
    return reduce(DataFrame.unionByName, parts)


def _tested(df: DataFrame, rules: list[Rule]) -> DataFrame:
    names = [f"m{i}" for i in range(len(rules))]
    measured = df.agg(
        *[r.measure.cast("double").alias(n) for r, n in zip(rules, names)]
    )

    def row(rule: Rule, name: str) -> Column:
        ok = F.lit(True)
        if rule.at_least is not None:
            ok = ok & (F.col(name) >= F.lit(float(rule.at_least)))
        if rule.at_most is not None:
            ok = ok & (F.col(name) <= F.lit(float(rule.at_most)))
        return F.struct(
            F.lit(rule.check).alias("check"),
            F.coalesce(ok, F.lit(False)).alias("ok"),
            F.col(name).alias("detail"),
        )

    rows = F.array(*[row(r, n) for r, n in zip(rules, names)])
    return measured.select(F.explode(rows).alias("r")).select("r.*")


@dataclass(frozen=True)
class Expected:
    """What a store must hold after a run, beyond what always holds.

    ``min_rows`` of each of its tables, ``min_days`` of raw articles, and measures of the
    run's days that keep ``least_share`` of the mean of the ``trailing`` recorded days before
    them, once there are ``at_least`` of those.
    """

    min_rows: int | None = None
    min_days: int | None = None
    trailing: int | None = None
    least_share: float = 0.6
    at_least: int = 5


def day_metrics(df: DataFrame, table: str, by: str) -> DataFrame:
    """(table, metric, date, value): the rows of each date."""
    counts = df.groupBy(F.col(by).cast("string").alias("date")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return counts.select(F.lit(table).alias("table"), F.lit("rows").alias("metric"), "date", "value")


def with_quiet_days(metrics: DataFrame, names: list[tuple[str, str]], dates: list[str]) -> DataFrame:
    """``metrics`` with 0 for the given (table, metric) and dates that have none."""
    spark = metrics.sparkSession
    every = spark.createDataFrame([(*n, d) for n in names for d in dates], "table string, metric string, date string")
    keys = ["table", "metric", "date"]
    return every.join(metrics, keys, "left").select(*keys, F.coalesce("value", F.lit(0.0)).alias("value"))


def against_trailing(metrics: DataFrame, dates: list[str], expected: Expected) -> DataFrame:
    """(table, metric, date, value, mean, ok) of the given dates against the recorded days before each.

    A day with fewer than ``at_least`` days before it is fine.  The window of a measure holds
    one row per day.
    """
    before = Window.partitionBy("table", "metric").orderBy("date").rowsBetween(-(expected.trailing or 0), -1)
    judged = metrics.withColumns({"mean": F.avg("value").over(before), "_n": F.count("value").over(before)})
    short = (F.col("_n") >= expected.at_least) & (F.col("value") < expected.least_share * F.col("mean"))
    return judged.filter(F.col("date").isin(dates)).select(
        "table", "metric", "date", "value", "mean", (~F.coalesce(short, F.lit(False))).alias("ok")
    )
