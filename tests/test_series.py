"""Aggregates, prices, correlation and reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsignal.operators import aggregate, correlate, prices, quality, report

SCORED = (
    "event_date string, ticker string, company_name string, industry string, "
    "sentiment_label string, sentiment_score double, title string"
)


def mention(label, score=0.0, **more):
    row = dict(event_date="2026-01-01", ticker="A", company_name="Aa", industry="I")
    return {**row, "sentiment_label": label, "sentiment_score": score, **more}


@pytest.mark.parametrize(
    "positive, negative, neutral, shares, majority",
    [
        (1, 6, 3, "neutral", "negative"), (1, 1, 1, "neutral", "positive"),
        (2, 1, 1, "positive", "positive"), (1, 2, 1, "negative", "negative"),
        (2, 2, 0, "positive", "positive"), (0, 0, 1, "neutral", "neutral"),
        (2, 1, 2, "positive", "positive"), (0, 3, 0, "negative", "negative"),
    ],
)
def test_day_labels(frame, positive, negative, neutral, shares, majority):
    labels = ["positive"] * positive + ["negative"] * negative + ["neutral"] * neutral
    rows = frame(SCORED, *[mention(x) for x in labels])
    assert aggregate.daily_sentiment(rows).first()["sentiment_label"] == shares
    out = aggregate.daily_sentiment(rows, label_rule="majority").first()
    assert out["sentiment_label"] == majority
    assert out["mention_count"] == len(labels)
    with pytest.raises(ValueError):
        aggregate.daily_sentiment(rows, label_rule="other")


def test_mart_headlines_and_null_keys(frame):
    rows = frame(
        SCORED,
        *[mention("positive", 0.1, title=t) for t in ("d", "b", "a", "c")],
        mention("negative", -0.2, ticker="B", company_name="Bb", title="only"),
        mention("negative", -0.2, ticker=None, title="x"),
    )
    mart = {r["ticker"]: r for r in aggregate.sentiment_mart(rows, ["title"]).collect()}
    assert set(mart) == {"A", "B"}
    assert mart["A"]["sample_headlines"] == ["a", "b", "c"]
    assert mart["B"]["sample_headlines"] == ["only"]
    daily = aggregate.daily_mean(rows)
    assert daily.count() == 2 and "sentiment_label" not in daily.columns
    plan = aggregate.sample_headlines(rows, ["title"])._jdf.queryExecution().toString()
    assert "row_number(), 3, Partial" in plan


def test_macro_context(frame):
    days = frame("event_date string, ticker string", dict(event_date="1", ticker="A"),
                 dict(event_date="2", ticker="A"))
    macro = frame("event_date string, topic string, sentiment_score double",
                  dict(event_date="1", topic="oil / gas", sentiment_score=0.1),
                  dict(event_date="1", topic="oil / gas", sentiment_score=0.4))
    rows = aggregate.macro_context(days, macro, ["oil / gas", "rates"]).orderBy("event_date").collect()
    assert rows[0]["oil / gas_articles"] == 2 and rows[0]["oil / gas_score"] == 0.25
    assert rows[1]["oil / gas_articles"] == 0 and rows[1]["rates_score"] is None


CLOSES = "ticker string, event_date string, close double"


def series(ticker, *values, start="2026-01-01"):
    days = pd.date_range(start, periods=len(values)).strftime("%Y-%m-%d")
    return [dict(ticker=ticker, event_date=d, close=v) for d, v in zip(days, values)]


def test_price_change(frame):
    rows = frame(CLOSES, *series("A", None, 100.0, None, 110.0, 99.0), *series("B", 5.0),
                 *series("Z", 1.0, 0.0, 2.0))
    out = prices.price_change(rows).orderBy("ticker", "event_date").collect()
    got = [(r["ticker"], r["event_date"][-2:], r["price_change_pct"]) for r in out]
    assert got == [
        ("A", "02", 0.0), ("A", "04", 10.0), ("A", "05", -10.0), ("B", "01", 0.0),
        ("Z", "01", 0.0), ("Z", "02", -100.0), ("Z", "03", 0.0),
    ]


def test_price_change_against_pandas(frame):
    rng = np.random.default_rng(7)
    values = [None if rng.random() < 0.2 else float(v) for v in rng.uniform(50, 60, 80)]
    out = prices.price_change(frame(CLOSES, *series("A", *values))).orderBy("event_date").collect()
    s = pd.Series(values, dtype=float).ffill()
    want = (s.pct_change(fill_method=None) * 100).round(4).fillna(0.0)
    want = want[pd.Series(values, dtype=float).notna()]
    assert [r["price_change_pct"] for r in out] == pytest.approx(list(want), abs=1e-9)


def test_backfill_uses_days_before_start(frame):
    rows = frame(CLOSES, *series("A", 100.0, 110.0, 121.0, 133.1),
                 dict(ticker="B", event_date="2025-12-20", close=1.0),
                 dict(ticker="B", event_date="2026-01-03", close=2.0))
    out = prices.price_backfill(rows, "2026-01-02", "2026-01-03").orderBy("ticker", "event_date")
    got = [(r["ticker"], r["event_date"], r["price_change_pct"]) for r in out.collect()]
    assert got == [("A", "2026-01-02", 10.0), ("A", "2026-01-03", 10.0), ("B", "2026-01-03", 0.0)]


def test_one_close_per_day(frame):
    rows = frame(CLOSES, *series("A", 3.0), *series("A", 2.0), *series("A", None))
    assert [r["close"] for r in prices.one_close_per_day(rows, ["close"]).collect()] == [2.0]


DAILY = "ticker string, event_date string, sentiment_score double, price_change_pct double"


def test_rolling_corr_against_pandas(frame):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for ticker, n in (("A", 1), ("B", 2), ("C", 60)):
        days = pd.date_range("2026-01-01", periods=n).strftime("%Y-%m-%d")
        x, y = rng.uniform(-1, 1, n).round(4), rng.normal(0, 3, n).round(4)
        y[5::11] = np.nan
        rows += [
            dict(ticker=ticker, event_date=d, sentiment_score=float(a),
                 price_change_pct=None if np.isnan(b) else float(b))
            for d, a, b in zip(days, x, y)
        ]
        r = pd.Series(x).rolling(7, min_periods=2).corr(pd.Series(y)).round(4).fillna(0.0)
        want.update({(ticker, d): v for d, v in zip(days, r)})
    out = correlate.rolling_corr(frame(DAILY, *rows)).collect()
    got = {(r["ticker"], r["event_date"]): r["correlation_7d"] for r in out}
    assert got == pytest.approx(want, abs=1e-9)


def test_constant_series_correlate_to_zero(frame):
    rows = [
        dict(ticker="A", event_date=f"2026-01-{d:02d}", sentiment_score=0.1,
             price_change_pct=float(d) * 1e7)
        for d in range(1, 10)
    ]
    rows += [
        dict(ticker="B", event_date=f"2026-01-{d:02d}", sentiment_score=d / 10,
             price_change_pct=1234567890.1234)
        for d in range(1, 10)
    ]
    out = correlate.rolling_corr(frame(DAILY, *rows)).collect()
    assert {r["correlation_7d"] for r in out} == {0.0}


def test_missing_prices_and_summary(frame):
    daily = frame("ticker string, event_date string", dict(ticker="A", event_date="1"),
                  dict(ticker="B", event_date="1"), dict(ticker="C", event_date="1"))
    priced = frame("ticker string, event_date string, close_price double, price_change_pct double",
                   dict(ticker="A", event_date="1"), dict(ticker="B", event_date="2"))
    missing = correlate.missing_prices(daily, priced).collect()
    assert sorted(r["ticker"] for r in missing) == ["B", "C"]
    assert correlate.sentiment_price_join(daily, priced).count() == 1
    corr = frame("ticker string, company_name string, correlation_7d double",
                 *[dict(ticker=t, company_name=t, correlation_7d=v)
                   for t, v in (("A", 0.3), ("A", 0.1), ("B", -0.5), ("C", 0.1))])
    rows = correlate.corr_summary(corr).collect()
    assert [(r["ticker"], r["mean_corr"], r["direction"]) for r in rows] == [
        ("A", 0.2, "positive"), ("C", 0.1, "near-zero"), ("B", -0.5, "negative"),
    ]


MART = (
    "company_name string, industry string, event_date string, sentiment_label string, "
    "sentiment_score double, mention_count long, pct_positive double, pct_negative double"
)


@pytest.fixture
def mart(frame):
    def row(name, industry, day, label, score, n):
        return dict(company_name=name, industry=industry, event_date=f"2026-01-0{day}",
                    sentiment_label=label, sentiment_score=score, mention_count=n,
                    pct_positive=0.3333, pct_negative=0.5)

    return frame(
        MART, row("A", "X", 1, "positive", 0.5, 4), row("A", "X", 2, "negative", None, 6),
        row("B", "Y", 1, "positive", 0.25, 1), row("C", None, 3, "neutral", 0.1, 2),
        row(None, "X", 3, "positive", 0.9, 100),
    )


def test_latest(mart):
    rows = {r["company_name"]: r for r in report.latest_per_entity(mart).collect()}
    assert set(rows) == {"A", "B", "C"}
    assert (rows["A"]["event_date"], rows["A"]["sentiment_score"]) == ("2026-01-02", None)
    mixed = report.latest_per_entity(mart, null_skipping=True).collect()
    a = {r["company_name"]: r for r in mixed}["A"]
    assert (a["event_date"], a["sentiment_score"]) == ("2026-01-02", 0.5)


def test_kpis_facets_rankings(mart):
    k = report.kpis(mart).first()
    assert (k["companies"], k["positive"], k["negative"], k["total_mentions"]) == (3, 1, 1, 113)
    assert k["avg_score"] == pytest.approx(0.175)
    picked = report.kpis(mart, industries=["X"], end="2026-01-01").first()
    assert (picked["companies"], picked["total_mentions"]) == (1, 4)
    assert [tuple(r) for r in report.facets(mart).collect()] == [
        ("first_date", "2026-01-01"), ("industry", "X"), ("industry", "Y"),
        ("last_date", "2026-01-03"),
    ]
    ranked = report.rankings(mart).collect()
    assert [r["company_name"] for r in ranked] == ["B", "C", "A"]
    assert ranked[0]["pct_positive"] == 33.3
    trend = report.entity_trend(mart, company="A").collect()
    assert [r["is_latest"] for r in trend] == [False, True]
    assert report.entity_detail(mart, "A").first()["event_date"] == "2026-01-02"


def test_name_fix(spark, frame):
    from newsignal.plans.companies import company_table

    rows = frame("company_name string, industry string", dict(company_name="NVDA", industry="Unknown"),
                 dict(company_name="Apple Inc.", industry="Technology"))
    out = report.name_fix(rows, company_table(spark)).collect()
    assert {tuple(r) for r in out} == {
        ("NVIDIA Corporation", "Technology"), ("Apple Inc.", "Technology"),
    }


def test_expectations(frame):
    rows = frame("k string, d string", dict(k="a", d="1"), dict(k="a", d="2"), dict(k=None, d="2"))
    checks = [
        quality.min_rows(3), quality.min_rows(4), quality.min_dates("d", 2),
        quality.max_nulls("k", 0.5), quality.max_nulls("k"), quality.unique_key("k", "d"),
        quality.unique_key("d"),
    ]
    tested = quality.expectations(rows, checks)
    got = sorted((r["check"], r["ok"], r["detail"]) for r in tested.collect())
    assert got == sorted([
        ("row_count", True, 3), ("row_count", False, 3), ("distinct_d", True, 2),
        ("null_share_k", True, 1 / 3), ("null_share_k", False, 1 / 3), ("duplicates_k_d", True, 0),
        ("duplicates_d", False, 1),
    ])
    assert "Expand" not in tested._jdf.queryExecution().optimizedPlan().toString()
    empty = quality.expectations(rows.filter("false"), [quality.min_rows(), quality.max_nulls("k"), quality.unique_key("k")])
    assert {r["check"]: r["ok"] for r in empty.collect()} == {
        "row_count": False, "null_share_k": True, "duplicates_k": True,
    }


def test_facets_prune_partitions(spark, mart, tmp_path):
    from newsignal.sources import sinks

    path = str(tmp_path / "mart")
    sinks.write_partitions(mart, path)
    picked = report.apply_facets(spark.read.parquet(path), start="2026-01-02", end="2026-01-02")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert picked.count() == 1
    assert picked.filter(F.col("mention_count") == 6).count() == 1
