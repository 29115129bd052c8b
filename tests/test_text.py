from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from newsignal.functions import numeric, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(v):
    return F.lit(v).cast("string")


def key(url, title="T", source="S", published="P"):
    basis = url.strip().lower() if url and url.strip() else f"{title or ''}{source or ''}{published or ''}".lower()
    return hashlib.sha256(basis.encode()).hexdigest()


@pytest.mark.parametrize(
    "args",
    [
        ("http://A.example/X",), ("  http://a.example/x\t\n",), ("\xa0http://a.example/x　",),
        (None,), ("",), ("   ",), (None, None, "S", "P"), (None, None, None, None),
        (None, "Été", "S", None),
    ],
)
def test_dedup_key(spark, args):
    full = list(args) + ["T", "S", "P"][len(args) - 1:] if len(args) < 4 else list(args)
    assert one(spark, text.dedup_key(*[lit(a) for a in full])) == key(*full)


def test_whitespace_is_what_python_strips():
    import sys

    stripped = [c for c in map(chr, range(sys.maxunicode + 1)) if not c.strip()]
    assert sorted(text.WHITESPACE) == sorted(stripped)


@pytest.mark.parametrize(
    "title, description, expected",
    [
        ("A", "b", "A b"), (" A ", None, "A"), (None, " b\n", "b"), ("", "", ""),
        ("  ", None, "  "), (None, None, "no text"), (None, " ", "no text"),
    ],
)
def test_scoring_text(spark, title, description, expected):
    assert one(spark, text.scoring_text(lit(title), lit(description))) == expected


@pytest.mark.parametrize(
    "needle, body, found",
    [
        ("apple inc.", "buy apple inc. now", True), ("apple inc.", "apple inc.x", False),
        ("visa", "l'été-visa", True), ("visa", "évisa", False), ("visa", "visa_", False),
        ("at&t", "(at&t)", True), ("a.b", "axb", False), ("3m", "3m", True), ("3m", "13m", False),
        (r"c\d", r"x c\d y", True), ("a b", "a  b", False), ("visa", "visavisa visa", True),
    ],
)
def test_boundaries(spark, needle, body, found):
    assert one(spark, F.rlike(lit(body), F.lit(text.bounded_pattern(needle)))) is found
    assert one(spark, F.rlike(lit(body), text.bounded_pattern_of(lit(needle)))) is found


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("['a', 'b']", ["a", "b"]), ("['it\\'s', '']", ["it's"]), ('["x"]', ["x"]),
        ("plain text", ["plain text"]), ("", []), ("  ", []), (None, []), ("[]", []),
    ],
)
def test_parse_headlines(spark, raw, expected):
    assert one(spark, text.parse_headlines(lit(raw))) == expected


def test_path_date(spark):
    path = "file:/raw/2026-06-20/news_2026-06-20.json"
    assert one(spark, text.path_date(lit(path), "/news_")) == "2026-06-20"
    assert one(spark, text.path_date(lit("file:/raw/manifest_2026-06-20.json"), "/news_")) is None


def test_rounding(spark):
    assert one(spark, numeric.half_even(F.lit(0.12345))) == 0.1234
    assert one(spark, numeric.half_up(F.lit(0.12345))) == 0.1235
    assert str(one(spark, numeric.half_even(F.lit(-0.00001)))) == "0.0"
    assert one(spark, numeric.percent(F.lit(0.3333))) == 33.3


def test_means_do_not_depend_on_order(spark):
    rows = [(0.0123,), (0.0124,), (-0.5,), (0.5,), (0.1,), (-0.1,)]
    forward = spark.createDataFrame(rows, "v double")
    back = spark.createDataFrame(rows[::-1], "v double")
    for mean in (numeric.mean_half_up, numeric.mean_half_even):
        assert forward.agg(mean(F.col("v"))).first() == back.agg(mean(F.col("v"))).first()
    two = spark.createDataFrame(rows[:2], "v double")
    assert two.agg(numeric.mean_half_up(F.col("v"))).first()[0] == 0.0124
    assert two.agg(numeric.mean_half_even(F.col("v"))).first()[0] == 0.0124


@pytest.mark.parametrize(
    "p, label",
    [
        ((0.4, 0.4, 0.2), "positive"), ((0.2, 0.4, 0.4), "negative"), ((0.4, 0.2, 0.4), "positive"),
        ((0.1, 0.2, 0.7), "neutral"), ((1 / 3, 1 / 3, 1 / 3), "positive"),
    ],
)
def test_argmax_ties(spark, p, label):
    assert one(spark, numeric.argmax_label(*[F.lit(x) for x in p])) == label


def test_softmax_of_large_logits(spark):
    parts = numeric.softmax([F.lit(2000.0), F.lit(1.0), F.lit(2000.0)])
    assert [one(spark, p) for p in parts] == [0.5, 0.0, 0.5]
