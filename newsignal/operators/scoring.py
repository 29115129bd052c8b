"""Sentiment scoring: a word-list scorer in column expressions, or any model in Python.

A scorer factory is called once per Python worker task and returns a function from a
list of texts to an N x 3 array of positive, negative and neutral probabilities.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from newsignal.functions import numeric, text
from newsignal.operators.clean import first_per_key, not_stored

Scorer = Callable[[Sequence[str]], np.ndarray]
PROBABILITIES = ["prob_positive", "prob_negative", "prob_neutral"]

POSITIVE_WORDS = [
    "beat", "beats", "gain", "gains", "growth", "improve", "improved", "profit", "profits",
    "rally", "record", "rise", "rises", "rose", "strong", "surge", "surged", "upgrade", "win",
]
NEGATIVE_WORDS = [
    "cut", "cuts", "decline", "declines", "downgrade", "drop", "drops", "fall", "falls", "fell",
    "fraud", "lawsuit", "layoffs", "loss", "losses", "miss", "misses", "recall", "slump", "weak",
]


def with_scoring_text(articles: DataFrame) -> DataFrame:
    return articles.withColumn("text", text.scoring_text(F.col("title"), F.col("description")))


def label_and_score(df: DataFrame) -> DataFrame:
    """Dominant label and positive minus negative, from the three probabilities."""
    return df.withColumn(
        "sentiment_label", numeric.argmax_label(*[F.col(p) for p in PROBABILITIES])
    ).withColumn(
        "sentiment_score", numeric.half_even(F.col("prob_positive") - F.col("prob_negative"))
    )


def score_by_words(
    df: DataFrame,
    positive: Sequence[str] = tuple(POSITIVE_WORDS),
    negative: Sequence[str] = tuple(NEGATIVE_WORDS),
    neutral_logit: float = 1.0,
    text_col: str = "text",
) -> DataFrame:
    """Counts list words over the whole text; softmax of the two counts and a constant."""

    def occurrences(words: Sequence[str]) -> Column:
        hits = F.filter("_tokens", lambda t: t.isin(*[w.lower() for w in words]))
        return F.size(hits).cast("double")

    counted = (
        df.withColumn("_tokens", text.tokens(F.lower(text_col)))
        .withColumn("_pos", occurrences(positive))
        .withColumn("_neg", occurrences(negative))
    )
    probs = numeric.softmax([F.col("_pos"), F.col("_neg"), F.lit(float(neutral_logit))])
    return label_and_score(
        counted.withColumns(dict(zip(PROBABILITIES, probs))).drop("_tokens", "_pos", "_neg")
    )


def word_scorer(
    positive: Sequence[str] = tuple(POSITIVE_WORDS),
    negative: Sequence[str] = tuple(NEGATIVE_WORDS),
    neutral_logit: float = 1.0,
) -> Callable[[], Scorer]:
    """The word-list scorer as a Python model, to try the model path without one."""

    pattern = text.TOKEN  # a plain value, so workers need not import this package

    def factory() -> Scorer:
        import regex

        token = regex.compile(pattern)
        pos, neg = {w.lower() for w in positive}, {w.lower() for w in negative}

        def score(texts: Sequence[str]) -> np.ndarray:
            logits = np.empty((len(texts), 3))
            for i, body in enumerate(texts):
                found = token.findall(body.lower())
                logits[i] = (
                    sum(t in pos for t in found), sum(t in neg for t in found), neutral_logit
                )
            parts = np.exp(logits - logits.max(axis=1, keepdims=True))
            return parts / parts.sum(axis=1, keepdims=True)

        return score

    return factory


def score_with_model(
    df: DataFrame, factory: Callable[[], Scorer], batch_size: int = 16, text_col: str = "text"
) -> DataFrame:
    """Scores every row with a Python model.

    Only the text crosses to Python; the other columns wait in the JVM.  The model is
    loaded once per Python worker, which serves many tasks, and gets ``batch_size`` texts
    at a time.
    """
    name = f"newsignal-model-{uuid.uuid4().hex}"

    @F.pandas_udf(", ".join(f"{p} double" for p in PROBABILITIES))
    def probabilities(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import sys
        import types

        # A worker forgets what a task defines, but not what stands among its modules.
        models = sys.modules.setdefault("newsignal_models", types.ModuleType("newsignal_models"))
        if not hasattr(models, name):
            setattr(models, name, factory())
        score = getattr(models, name)
        for texts in batches:
            parts = [
                score(texts.iloc[i : i + batch_size].tolist())
                for i in range(0, len(texts), batch_size)
            ]
            rows = np.concatenate(parts) if parts else np.empty((0, 3))
            yield pd.DataFrame(rows, columns=PROBABILITIES)

    scored = df.withColumn("_p", probabilities(F.col(text_col)))
    return label_and_score(
        scored.withColumns({p: F.col("_p")[p] for p in PROBABILITIES}).drop("_p")
    )


@dataclass(frozen=True)
class TokenModel:
    """A model over tokens: ``encode`` gives those of a text, ``score`` takes windows of them.

    ``score`` returns an N x 3 array; its cost is that of N times the longest window.
    """

    encode: Callable[[str], Sequence]
    score: Callable[[list[Sequence]], np.ndarray]


def token_batches(lengths: Sequence[int], budget: int) -> list[list[int]]:
    """Indices in batches whose size times their longest length is at most ``budget``.

    Windows of like length share a batch, so little of it is padding.  A window above the
    budget is a batch of its own.
    """
    batches: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if batches and (len(batches[-1]) + 1) * max(lengths[batches[-1][0]], 1) <= budget:
            batches[-1].append(i)
        else:
            batches.append([i])
    return batches


def _score_apart(score: Callable, windows: list[Sequence]) -> list[np.ndarray | str]:
    """A row of probabilities for each window, or the error that it alone causes."""
    try:
        rows = np.asarray(score(windows), float)
        if rows.shape != (len(windows), 3):
            raise ValueError(f"the model gave {rows.shape} for {len(windows)} windows")
        return list(rows)
    except Exception as e:
        if len(windows) == 1:
            return [f"{type(e).__name__}: {e}"[:500]]
        half = len(windows) // 2
        return _score_apart(score, windows[:half]) + _score_apart(score, windows[half:])


def score_texts(model: TokenModel, texts: Sequence[str | None], max_tokens: int, batch_tokens: int) -> pd.DataFrame:
    """Probabilities, n_tokens and score_error of each text, in order."""
    tokens, errors = [], []
    for text_ in texts:
        try:
            tokens.append(model.encode(text_ or ""))
            errors.append(None)
        except Exception as e:
            tokens.append([])
            errors.append(f"{type(e).__name__}: {e}"[:500])
    windows, owner = [], []
    for i, own in enumerate(tokens):
        if errors[i] is None:
            for start in range(0, max(len(own), 1), max_tokens):
                windows.append(own[start : start + max_tokens])
                owner.append(i)
    sums, weights = np.zeros((len(texts), 3)), np.zeros(len(texts))
    for batch in token_batches([len(w) for w in windows], batch_tokens):
        for k, row in zip(batch, _score_apart(model.score, [windows[k] for k in batch])):
            if isinstance(row, str):
                errors[owner[k]] = row
            else:
                weight = max(len(windows[k]), 1)
                sums[owner[k]] += weight * row
                weights[owner[k]] += weight
    good = np.array([e is None for e in errors], bool)
    rows = np.where(good[:, None], sums / np.maximum(weights, 1)[:, None], np.nan)
    return pd.DataFrame(rows, columns=PROBABILITIES).assign(n_tokens=[len(t) for t in tokens], score_error=errors)


def score_in_budget(
    df: DataFrame, factory: Callable[[], TokenModel], max_tokens: int = 512, batch_tokens: int = 8192,
    text_col: str = "text",
) -> DataFrame:
    """Scores whole texts with a model that has a token limit, in batches of bounded size.

    A text above ``max_tokens`` is cut into windows of that many tokens, whose
    probabilities are averaged by their tokens.  A batch holds at most ``batch_tokens``
    tokens, padding included, so long texts come few at a time and short ones many.  A text
    on which the model fails has null scores and the failure in ``score_error``; the rest
    of its batch is scored.  Adds ``n_tokens``.  The model is loaded once per task.
    """
    types = ", ".join(f"{p} double" for p in PROBABILITIES)

    @F.pandas_udf(f"{types}, n_tokens int, score_error string")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for texts in batches:
            yield score_texts(model, texts.tolist(), max_tokens, batch_tokens)

    scored = df.withColumn("_p", scores(F.col(text_col)))
    columns = {c: F.col("_p")[c] for c in [*PROBABILITIES, "n_tokens", "score_error"]}
    labelled = label_and_score(scored.withColumns(columns).drop("_p"))
    failed = F.col("score_error").isNotNull()
    return labelled.withColumns({
        c: F.when(~failed, F.col(c)) for c in ("sentiment_label", "sentiment_score")
    })


def share_model(
    positive: Sequence[str], negative: Sequence[str], refused: Sequence[str] = (),
) -> Callable[[], TokenModel]:
    """Shares of list words among the tokens as a token model; fails on windows with a refused word."""
    pattern = text.TOKEN

    def factory() -> TokenModel:
        import regex

        token = regex.compile(pattern)
        pos, neg, no = set(positive), set(negative), set(refused)

        def score(windows: list[Sequence]) -> np.ndarray:
            rows = np.empty((len(windows), 3))
            for i, window in enumerate(windows):
                if not no.isdisjoint(window):
                    raise ValueError("refused word")
                n = max(len(window), 1)
                p, q = sum(t in pos for t in window) / n, sum(t in neg for t in window) / n
                rows[i] = p, q, 1 - p - q
            return rows

        return TokenModel(lambda body: token.findall(body.lower()), score)

    return factory


def _scores_of(scores: DataFrame, model_version: str, dates: list[str] | None) -> DataFrame:
    of_model = scores.filter(F.col("model_version") == model_version)
    return of_model if dates is None else of_model.filter(F.col("date").cast("string").isin(dates))


def pending_articles(
    articles: DataFrame, scores: DataFrame, model_version: str, key: str = "dedup_key",
    dates: list[str] | None = None,
) -> DataFrame:
    """Articles that this model version has not scored yet.

    ``dates`` are the dates of the articles, where they are known: scores of other dates
    are then not read.
    """
    return not_stored(articles, _scores_of(scores, model_version, dates), [key])


def attach_scores(
    mentions: DataFrame, scores: DataFrame, model_version: str, key: str = "dedup_key",
    dates: list[str] | None = None,
) -> DataFrame:
    """Joins one score per article back to its mentions; copies of a score count once."""
    columns = ["sentiment_label", "sentiment_score", *PROBABILITIES]
    wanted = _scores_of(scores, model_version, dates).select(key, *columns)
    return mentions.join(first_per_key(wanted, [key], columns), key)


def label_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))
