from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsignal.operators import scoring

TEXT = "dedup_key string, title string, description string"


@pytest.fixture
def articles(frame):
    return scoring.with_scoring_text(
        frame(
            TEXT,
            dict(dedup_key="1", title="Profits rise", description="and RISE again"),
            dict(dedup_key="2", title="A loss, a Loss", description="losses!"),
            dict(dedup_key="3", title="Nothing", description=None),
            dict(dedup_key="4", title="profit and loss"),
            dict(dedup_key="5", title=None),
        )
    )


def test_words_and_model_agree(articles):
    by_words = scoring.score_by_words(articles).orderBy("dedup_key").collect()
    by_model = (
        scoring.score_with_model(articles, scoring.word_scorer(), batch_size=2)
        .orderBy("dedup_key").collect()
    )
    labels = [r["sentiment_label"] for r in by_words]
    assert labels == ["positive", "negative", "neutral", "positive", "neutral"]
    for a, b in zip(by_words, by_model):
        assert a["sentiment_label"] == b["sentiment_label"]
        assert a["sentiment_score"] == b["sentiment_score"]
        for p in scoring.PROBABILITIES:
            assert a[p] == pytest.approx(b[p], abs=1e-12)
    third = by_words[2]
    assert sum(third[p] for p in scoring.PROBABILITIES) == pytest.approx(1.0)


def test_model_is_loaded_once_per_task(spark):
    def factory():
        loaded = {"n": 0}

        def score(texts):
            loaded["n"] += 1
            return np.array([[loaded["n"], len(texts), 0.0] for _ in texts])

        return score

    rows = spark.range(10, numPartitions=1).select(F.col("id").cast("string").alias("text"))
    out = scoring.score_with_model(rows, factory, batch_size=4).collect()
    assert [r["prob_negative"] for r in out] == [4.0] * 8 + [2.0] * 2
    assert [r["prob_positive"] for r in out] == [1.0] * 4 + [2.0] * 4 + [3.0] * 2


def test_model_is_loaded_once_per_worker(spark):
    def factory():
        import random

        mark = random.SystemRandom().random()
        return lambda texts: np.array([[mark, 0.0, 0.0] for _ in texts])

    rows = spark.range(60, numPartitions=20).select(F.col("id").cast("string").alias("text"))
    loads = scoring.score_with_model(rows, factory).select("prob_positive").distinct().count()
    assert loads <= spark.sparkContext.defaultParallelism


def test_pending_and_attach(frame, articles):
    scores = scoring.score_by_words(articles.filter("dedup_key < '3'")).withColumn(
        "model_version", F.lit("m1")
    )
    pending = scoring.pending_articles(articles, scores, "m1").collect()
    assert sorted(r["dedup_key"] for r in pending) == ["3", "4", "5"]
    assert scoring.pending_articles(articles, scores, "m2").count() == 5
    mentions = frame(
        "dedup_key string, ticker string", dict(dedup_key="1", ticker="A"),
        dict(dedup_key="1", ticker="B"), dict(dedup_key="9", ticker="A"),
    )
    joined = scoring.attach_scores(mentions, scores, "m1").collect()
    assert {r["ticker"] for r in joined} == {"A", "B"}
