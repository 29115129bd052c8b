"""Quality scores, phrase collocations and token alignment against plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsignal.llm import alignment, phrases, quality_model as quality
from newsignal.llm.queries import ALIGNED, QUERIES, vocabulary

from . import brute

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
A, B = map(vocabulary, ALIGNED)


# --- operator 12 ---------------------------------------------------------------------


def plain_phrases(rows, least, top, most_words=3, percent=50):
    """rows: (lang, text)."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", brute.lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for m in range(1, most_words + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in frequent.items():
            longer = [
                b for q, b in frequent.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if any(100 * b >= percent * a for b in longer):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, l, r) in enumerate(sorted(best)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_phrases(docs, pairs):
    found = docs.select("lang", "text").collect()
    plain = plain_phrases([tuple(r) for r in found], 4, 2000)
    assert len(plain) > 50
    assert rows_of(phrases.collocations(docs, min_count=4)) == plain


def test_longer_phrases_cut_top_and_small_filter(documents):
    text = "a b c d e. a b c d, a b c x; b c d e\n" * 5 + "q q q q q q"
    df = documents([(1, text), (2, text), (None, "a b c d")])
    rows = [tuple(r) for r in df.select("lang", "text").collect()]
    for top in (3, 100):
        out = phrases.collocations(df, min_count=2, max_words=4, top=top, filter_bits=64, hot_share=3)
        assert rows_of(out) == plain_phrases(rows, 2, top, 4)


def test_hot_prefixes_are_cut_into_parts(documents):
    df = documents([(i, " ".join(f"the w{i * j % 50}" for j in range(60))) for i in range(40)])
    rows = [tuple(r) for r in df.select("lang", "text").collect()]
    assert rows_of(phrases.collocations(df, hot_share=16)) == plain_phrases(rows, 10, 2000)
    hot = phrases.spread(np.array([phrases.word_key("en", b"the", 0)])).view(np.int64)
    stripes = phrases.merged_stripes(df.filter("lang = 'en'"), 0, 1, 1, None, hot)
    the = stripes.filter(F.col("w1") == phrases.word_key("en", b"the", 0))
    assert the.select("part").distinct().count() > 10
    total = sum(t.split().count("the") for _, t in [(r[0], r[1]) for r in rows if r[0] == "en"])
    assert the.agg(F.sum("total")).first()[0] == total


def test_phrase_cases(documents, docs):
    """Null text and language, empty tables, repeated rows, other columns, words of odd signs."""
    odd = "\x1c\x85 é é   ß!ẞ"
    df = documents([(1, None), (1, ""), (None, odd * 12), (None, odd * 12), (3, ".;:" * 10)], {"key": 1, "w1": 2, "n": 3})
    df = df.withColumn("lang", F.when(F.col("doc_id") == 3, "en"))
    rows = [tuple(r) for r in df.select("lang", "text").collect()]
    assert rows_of(phrases.collocations(df)) == plain_phrases(rows, 10, 2000)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(documents([(1, "a b")])).count() == 0


def test_scores_beyond_64_bits(spark):
    cases = [(3_000_000_000_000, 3_000_000_000_001, 4_000_000_000_007), (10**15, 10**15, 10**15), (10, 10**9, 10**12)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    out = df.select("a", "l", "r", phrases.exact_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert {(r["a"], r["s"]) for r in out} == {(a, 10**6 * a * a // (l * r)) for a, l, r in cases}


def test_key_collisions_take_another_seed(documents, monkeypatch):
    real = phrases.word_key
    monkeypatch.setattr(phrases, "word_key", lambda lang, word, seed: 7 if seed == 0 else real(lang, word, seed))
    df = documents([(i, "alpha beta gamma") for i in range(20)])
    rows = [tuple(r) for r in df.select("lang", "text").collect()]
    assert phrases.collides(phrases.vocabulary(df, 0)) and not phrases.collides(phrases.vocabulary(df, 1))
    assert rows_of(phrases.collocations(df)) == plain_phrases(rows, 10, 2000)


# --- operator 13 ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies(A, B)


def plain_alignment(v, text):
    """(n_a, n_b, groups as text, links) of one text, without cutting it."""
    if not text:
        return 0, 0, "", []
    want = (" " + text).encode()
    a, b = v.a.encode(" " + text, add_special_tokens=False).ids, v.b.encode(text)
    if b"".join(v.a_bytes[i] for i in a) != want or b"".join(v.b_bytes[i] for i in b) != want:
        return 0, 0, "", []
    a_ends = np.cumsum([len(v.a_bytes[i]) for i in a]).tolist()
    b_ends = np.cumsum([len(v.b_bytes[i]) for i in b]).tolist()
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        i2, j2 = a_ends.index(end) + 1, b_ends.index(end) + 1
        groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
        links.append((a[i2 - 1], b[j2 - 1]))
        i, j = i2, j2
    return len(a), len(b), ";".join(groups), links


def plain_links(v, rows):
    each = [(d, *plain_alignment(v, t)) for d, t in rows]
    counts = Counter(x for r in each for x in r[4])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            -1 if d is None else d, n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if n_a else "",
        )
        for d, n_a, n_b, groups, links in each
    )


LINKED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def linked(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in LINKED) for r in df.collect())


ODD = [
    "", None, " ", "  ", "a ", " a  b\n\n c \n", "a\t b", "a\t  b", "a\x1c b\x1cc", "x▁y", "▁", "don't  we'll\n's",
    "İstanbul Σας ﬁne <|endoftext|> 𝒳 <s> </s> <unk> <0x41>", "日本語のテキスト です。\n中文", "  a  　b", "\n", "\n\n",
    "12345 678\n9", "🙂🙂 👨‍👩‍👧", "é ́x", "\x00 \x00a", "x" * 3000, "\r\n a\r\n\tb", "a   b \n", "u&&& x*** | y.", "\u0085 y",
]


def test_alignment(documents, docs, pairs, vocabularies):
    assert vocabularies.separable
    assert linked(alignment.linked_documents(docs, A, B)) == plain_links(vocabularies, pairs)
    rows = list(enumerate(ODD)) + [(None, "a b"), (None, None), (3, "again"), (3, "again")]
    df = documents(rows, {"pair": 1, "n_a": 2, "pairs": 3})
    assert linked(alignment.linked_documents(df, A, B)) == plain_links(vocabularies, rows)
    assert alignment.linked_documents(docs.limit(0), A, B).count() == 0


def test_segments_of_random_texts(vocabularies, monkeypatch):
    import random

    rng = random.Random(5)
    signs = [" ", "\n", "\t", "a", "bé", "'s", "X", "1", "!!", ".", ",", "　", "<s>", "\x1c", "\r", "日", "|", "×a", '"', "("]
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 14))) for _ in range(3000)]
    monkeypatch.setattr(alignment, "CACHED_SEGMENTS", 500)  # a cache that is emptied again and again
    segments = alignment.Segments(vocabularies)
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        counts, digests, offsets, codes, numbers = segments.align(part)
        for k, text in enumerate(part):
            n_a, n_b, groups, links = plain_alignment(vocabularies, text)
            own = slice(offsets[k], offsets[k + 1])
            found = Counter({divmod(p, 32000): n for p, n in zip(codes[own].tolist(), numbers[own].tolist())})
            assert (*counts[k, :3], digests[k]) == (
                n_a, n_b, len(links), hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
            ), repr(text)
            assert found == Counter(links)


def test_products():
    rng = np.random.RandomState(2)
    dense = rng.rand(2, 30, 40) < 0.2
    a, b = (
        alignment.Csr(np.append(0, np.cumsum(m.sum(axis=1))), np.nonzero(m)[1], 40) for m in dense
    )
    for limit in (1, 50, 10**6):
        out = np.zeros((30, 30), int)
        for rows, columns, values in alignment.row_products(a, b.transposed(), limit):
            out[rows, columns] = values
        assert (out == dense[0].astype(int) @ dense[1].T.astype(int)).all()


def test_links_of_tokens():
    a, b = np.array([2, 3, 7, 9]), np.array([3, 5, 9])
    overlaps = [tuple(map(int, x)) for block in alignment.overlap_links(a, b) for x in zip(*block)]
    assert overlaps == [(0, 0, 2), (1, 0, 1), (2, 1, 2), (2, 2, 2), (3, 2, 2)]
    borders = np.array([3, 9])
    shared = [(int(x), int(y)) for block in alignment.group_links(a, b, borders) for x, y, _ in zip(*block)]
    assert shared == [(0, 0), (1, 0), (2, 1), (2, 2), (3, 1), (3, 2)]
    assert alignment.group_link_counts(a, b, borders).tolist() == [1, 1, 2, 2]


def test_pair_bound_holds_for_every_link(docs, vocabularies):
    aligned = alignment.aligned_documents(docs, A, B)
    pairs = alignment.pair_counts(aligned, len(vocabularies.b_bytes)).collect()
    for r in pairs:
        x, y = vocabularies.a_bytes[r["a_id"]], vocabularies.b_bytes[r["b_id"]]
        assert x.endswith(y) or y.endswith(x)
    assert len(pairs) <= vocabularies.pair_bound() < 10**6


@needs_data
def test_alignment_query(spark, vocabularies):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert linked(QUERIES["op13_token_alignment"](spark, SF)) == plain_links(vocabularies, docs)


# --- operator 11 ---------------------------------------------------------------------


def plain_indicators(text):
    words = brute.WORD.findall(text or "")
    shapes = [quality.shape(w.encode()) for w in words]
    marked = [(s, i > 0 and words[i] == words[i - 1]) for i, s in enumerate(shapes)]
    grams = {tuple(marked[i : i + n]) for n in (1, 2, 3) for i in range(len(marked) - n + 1)}
    return grams | {w.encode().lower() for w in words}


def test_indicators_are_the_same_for_equal_sets_of_grams(pairs):
    texts = [t for _, t in pairs] + ["A b", "A  b\n", "", None, "b A"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    rows, buckets = quality.indicators(batch, quality.WordHashes())
    found = [frozenset(buckets[rows == i].tolist()) for i in range(len(texts))]
    for text, own in zip(texts, found):
        n = len(plain_indicators(text))
        assert n * 0.97 - 1 <= len(own) <= n  # some of them share a bucket
    assert found[-5] == found[-4] != found[-1] and not found[-3] and not found[-2]


def test_coordinate_descent_finds_the_best_model():
    """Against plain subgradient steps on the same loss."""
    rng = np.random.RandomState(3)
    n, d = 80, 12
    dense = (rng.rand(n, d) < 0.4) * rng.randn(n, d)
    signs = np.where(dense @ rng.randn(d) + 0.5 * rng.randn(n) > 0, 1.0, -1.0)
    rows, columns = np.nonzero(dense)
    x = quality.Sparse(np.append(0, np.cumsum((dense != 0).sum(axis=1))), columns, dense[rows, columns])

    def loss(w):
        return 0.5 * w @ w + np.maximum(0, 1 - signs * (dense @ w)).sum()

    w = quality.dual_coordinate_descent(x, signs, rounds=2000, tolerance=1e-8)
    other = np.zeros(d)
    for t in range(1, 30_000):
        active = signs * (dense @ other) < 1
        other -= (other - (signs[active, None] * dense[active]).sum(axis=0)) / (50 + t)
    assert not w[d:].any() and loss(w[:d]) <= loss(other) + 1e-3


def quality_rows(n=240):
    rng = np.random.RandomState(4)
    words = ["".join(rng.choice(list("aeioubcd"), rng.randint(2, 7))) for _ in range(60)]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(words, rng.randint(5, 40)))
        out.append((i, text.upper().replace(" ", "!! ") if i % 4 == 0 else text))
    return out


def test_scores_generalise_and_leave_the_held_out_fold_alone(spark, documents):
    rows = quality_rows()
    truth = {d: int(d % 4 != 0) for d, _ in rows}
    labels = spark.createDataFrame([(d, q, 0) for d, q in truth.items()], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.quality_scores(documents(rows), labels).collect()}
    held = {d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1}
    assert {d for d, r in out.items() if r["held_out"]} == held
    assert all(out[d]["predicted"] == truth[d] for d in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.values())
    # Other labels in the held-out fold, and other languages and sources, change nothing.
    turned = spark.createDataFrame(
        [(d, 1 - q if d in held else q, 1) for d, q in truth.items()], "doc_id long, quality int, toxic int"
    )
    moved = documents(rows).withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    again = {r["doc_id"]: r["score"] for r in quality.quality_scores(moved, turned).collect()}
    assert again == {d: r["score"] for d, r in out.items()}


def test_quality_cases(spark, documents, docs):
    """Null and empty texts, null and repeated ids, odd labels, other columns, empty tables, one class."""
    rows = quality_rows(80) + [(None, "abc"), (None, None), (200, ""), (200, None), (1, "again"), (300, "x" * 100_000)]
    labels = spark.createDataFrame(
        [(d, d % 4 and 1) for d in range(80)] + [(None, 1), (200, None), (300, 5), (7, 0)], "doc_id long, quality int"
    )
    df = documents(rows, {"good": 1, "buckets": 2, "label_id": 3, "quality": 0, "draw": 1})
    out = quality.quality_scores(df, labels).collect()
    assert len(out) == len(rows) and not any(r["held_out"] for r in out if r["doc_id"] is None)
    empty = {r["score"] for r in out if r["doc_id"] == 200}
    assert len(empty) == 1 and all(r["score"] is not None for r in out)
    none = quality.quality_scores(df, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    one = quality.quality_scores(df, labels.filter("quality = 1")).collect()
    assert len({r["score"] for r in one}) == 1 and one[0]["score"] > 0.9
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_the_sample_bounds_the_fit_and_not_the_ratios(spark, documents):
    rows = quality_rows()
    labels = spark.createDataFrame([(d, int(d % 4 != 0)) for d, _ in rows], "doc_id long, quality int")
    train = quality.training_rows(documents(rows), labels)
    small, full = quality.fit(train, 40), quality.fit(train)
    assert (small.ratios == full.ratios).all() and (small.weights != full.weights).any()


@needs_data
def test_quality_query_on_held_out_labels(spark):
    sf = SF.replace("0.001", "0.01")
    out = {r["doc_id"]: r for r in QUERIES["op11_quality_scores"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(r["quality"], out[r["doc_id"]]["score"]) for r in labels if out[r["doc_id"]]["held_out"]]
    good, bad = ([s for q, s in held if q == k] for k in (1, 0))
    assert len(bad) > 10 and np.mean([g > b for g in good for b in bad]) > 0.98
