from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 3) -> list[tuple[int, str | None]]:
    """A small corpus with copies, near copies, shared lines and passages, and odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(400)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    line = "Shared line " + " ".join(words(6))
    passage = " ".join(words(70))
    texts: list[str | None] = [None, "", " \t\n", "One", "one two", "ONE two", "İstanbul Σας ﬁne <|endoftext|> 𝒳"]
    for i in range(60):
        lines = [" ".join(words(rng.randint(3, 30))) for _ in range(rng.randint(1, 6))]
        if i % 4 == 0:
            lines.insert(rng.randrange(len(lines) + 1), f"  {line}\t" if i % 8 else line.upper())
        if i % 5 == 0:
            lines.append(passage)
        texts.append("\n".join(lines))
    for i in range(30):  # exact copies, and copies with a few words changed
        base = texts[7 + i % 20].split(" ")
        for _ in range(i % 3):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        texts.append(" ".join(base))
    texts.append(" ".join(words(3000)))
    texts.append("x" * 5000)
    texts.append("\n".join(["again and again"] * 40))
    texts.append("### $$$ " * 30)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.fixture(scope="session")
def pairs():
    return corpus()


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from (doc_id, text) pairs, with the columns of the test table."""

    def make(rows, extra: dict | None = None):
        full = [(d, t, "en" if (d or 0) % 3 else "de", f"s{(d or 0) % 4}", len(t or "")) for d, t in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        for name, value in (extra or {}).items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make


@pytest.fixture(scope="session")
def docs(documents, pairs):
    return documents(pairs).cache()
