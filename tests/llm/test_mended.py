"""Rows without ids, colliding hashes, wrappers of pages, a plain walk on the ring."""

from __future__ import annotations

import bisect
import os
import time
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsignal.llm import common
from newsignal.llm.html_extract import main_text, read_page
from newsignal.llm.jaccard_join import FIVE_80, THREE_90, jaccard_groups
from newsignal.llm.line_dedup import common_lines, counts_name, drop_common_lines
from newsignal.llm.mixing import mix
from newsignal.llm.packing import pack_documents
from newsignal.llm.phrase_dedup import drop_repeated_phrases
from newsignal.llm.queries import vocabulary
from newsignal.llm.ring import Ring, bounded_ring_shards
from newsignal.llm.suffix_dedup import drop_repeated_bytes

from . import brute

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def colliding(spark):
    """Two texts with one 32-bit hash, of 40 words and 250 bytes at least."""
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("word"), F.col("id") * 41 + i)), " ")
    texts = spark.range(300_000).select(words.alias("text"))
    twice = texts.groupBy(F.hash("text").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("a"), F.max("text").alias("b"))
    row = twice.filter("n = 2").orderBy("h").first()
    assert row["a"] != row["b"]
    return row["a"], row["b"]


def test_rows_with_one_id_and_one_short_hash_stay_apart(documents, colliding):
    a, b = colliding
    shared = "a line that many documents hold"
    rows = [(None, a + "\n" + shared), (None, b), (7, a), (7, b)] + [(100 + i, shared) for i in range(10)]
    df = documents(rows)
    name = counts_name(df)
    out = drop_common_lines(df)
    got = sorted((r["text"], r[name]["n_dropped"]) for r in out.collect() if r["doc_id"] is None or r["doc_id"] < 100)
    assert got == sorted([(a, 1), (b, 0), (a, 0), (b, 0)])
    phrases = drop_repeated_phrases(documents([(None, a), (None, b), (0, a), (0, b + " " + b)]))
    left = sorted((str(r["doc_id"]), r["n_removed"]) for r in phrases.collect())
    assert left == [("0", 40), ("0", 80), ("None", 0), ("None", 0)]
    gone = drop_repeated_bytes(documents([(None, a), (None, b), (0, a), (5, "x" * 300)])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in gone) == sorted(
        [("None", len(a)), ("None", 0), ("0", len(a)), ("5", 300)]
    )


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_words_whose_polynomials_agree_stay_apart(documents):
    one = thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    df = documents([(1, one), (2, other)])
    assert {r["component_id"] for r in jaccard_groups(df, THREE_90).collect()} == {1, 2}
    assert {r["component_id"] for r in jaccard_groups(df, FIVE_80).collect()} == {1, 2}
    tail = " ".join(f"t{i}" for i in range(19))
    df = documents([(1, f"{one} {tail}"), (2, f"{other} {tail}")])
    assert [r["n_removed"] for r in drop_repeated_phrases(df).collect()] == [0, 0]


# ---- Pages ----------------------------------------------------------------------------


ARTICLE = "<article><h1>Title</h1><p>Body of the page</p></article>"


@pytest.mark.parametrize("wrap", [
    '<div class="layout has-sidebar">{}</div>', '<div class="no-sidebar">{}</div>', '<div class="page-with-header">{}</div>',
    '<div class="share-page">{}</div>', '<section class="social-sciences">{}</section>', "<form id=f action=/x>{}</form>",
    '<div class="wrap modal-open"><main>{}</main></div>',
])
def test_wrappers_of_an_article_hide_nothing(wrap):
    blocks, _, _ = read_page(f"<html><body><nav>Menu</nav>{wrap.format(ARTICLE)}<footer>F</footer></body></html>")
    assert blocks == ["Title", "Body of the page"]


def test_names_inside_an_article():
    inside = (
        '<p class="promotion-news">A</p><div id="ad-hoc">B</div><div class="ad-slot">C</div><div class="siteFooter">D</div>'
        '<div class="post comment-list"><p>E</p></div><div class="socialShare">F</div><p id="cookie3">G</p>'
    )
    assert read_page(f"<article>{inside}</article>")[0] == ["A", "B"]
    comments = '<div id="comments"><article><p>A reader wrote this and much more of it</p></article></div>'
    assert read_page(f"<div><p>Text</p></div>{comments}")[0] == ["Text"]


def test_quotes_in_tags():
    assert read_page("<p title='it's'>Hello</p>")[0] == ["Hello"]
    assert read_page('<p><a href="x>link</a> more</p>')[0] == ["link more"]
    assert read_page('<p data-x="a>b" class=>One</p><p =x "y">Two</p>')[0] == ["One", "Two"]
    assert read_page("a < b and c<d")[0] == ["a < b and c<d"]


def test_deep_and_broken_pages_take_linear_time():
    start = time.perf_counter()
    assert read_page("<div>" * 50_000 + "deep" + "</div>" * 50_000)[0] == ["deep"]
    for source in ("<a " * 300_000, "<a 'x" * 100_000, "<p>" * 100_000, "<!-- " * 100_000, "<b>" * 50_000 + "x"):
        read_page(source)
    assert time.perf_counter() - start < 20


def pages_of(spark, bodies):
    rows = [(i, f"http://big.example/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    return {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES)).collect()}


def test_a_title_that_a_few_pages_of_a_large_host_share_stays(spark):
    bodies = [
        f"<article><h1>{'Weekly market review' if i < 5 else f'Title {i}'}</h1><p>Story number {i} of this host</p></article>"
        for i in range(400)
    ]
    got = pages_of(spark, bodies)
    assert all(got[i] == f"Weekly market review\nStory number {i} of this host" for i in range(5))


def test_equal_blocks_of_a_page_go_together(spark):
    again = "<p>Read more</p>"
    bodies = [f"<article>{again}<p>Story number {i} of this host</p>{again if i == 3 else ''}<p>End {i}</p></article>" for i in range(100)]
    bodies[3] = f"<article>{again}<p>Story number 3 of this host</p>{again}<p>End 3</p></article>"
    got = pages_of(spark, bodies)
    assert got[4] == "Story number 4 of this host\nEnd 4"
    assert got[3].count("Read more") in (0, 2)


def test_equal_pages_and_no_pages(spark):
    row = (1, "http://a.example/1", f"<body>{ARTICLE}</body>")
    df = spark.createDataFrame([row] * 12 + [(None, None, None), (1, None, "<p>x")], PAGES)
    for name in ("key", "host", "blocks", "gone_id", "text", "n_chars"):
        df = df.withColumn(name, F.lit(1))
    out = sorted((str(r["page_id"]), r["text"]) for r in main_text(df).collect())
    assert out == sorted([("1", "Title\nBody of the page")] * 12 + [("None", ""), ("1", "x")])
    assert main_text(df.limit(0)).count() == 0


# ---- The ring ---------------------------------------------------------------------------


def clockwise(ring, places, slack):
    """Shard of each key: its own node's, or the next one's clockwise with room, keys in order."""
    nodes, owner = ring.nodes()
    nodes = nodes.tolist()
    room = ring.capacities(len(places), slack)
    arcs = [bisect.bisect_left(nodes, p) % len(nodes) for p in places]
    shard: list[int | None] = [None] * len(places)
    order = sorted(range(len(places)), key=lambda i: (arcs[i], places[i]))
    for i in order:
        own = owner[arcs[i]]
        if room[own]:
            shard[i] = int(own)
            room[own] -= 1
    for i in order:
        step = arcs[i]
        while shard[i] is None:
            step = (step + 1) % len(nodes)
            if room[owner[step]]:
                shard[i] = int(owner[step])
                room[owner[step]] -= 1
    return shard, [int(owner[a]) for a in arcs]


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_ring_equals_a_plain_clockwise_walk(documents, slack):
    ring = Ring(6, 8)
    df = documents([(i, f"t{i}") for i in range(500)])
    places = {r["doc_id"]: r["p"] for r in df.select("doc_id", F.xxhash64("doc_id").alias("p")).collect()}
    ids = sorted(places)
    shards, homes = clockwise(ring, [places[i] for i in ids], slack)
    out = {r["doc_id"]: r for r in bounded_ring_shards(df, ring, slack).collect()}
    assert [out[i]["home_shard"] for i in ids] == homes
    assert [out[i]["shard"] for i in ids] == shards


def test_ring_growth_under_the_law_of_the_query_moves_little(documents):
    df = documents([(i, None) for i in range(3000)])
    before, after = (
        {r["doc_id"]: r["shard"] for r in bounded_ring_shards(df, Ring(n)).collect()} for n in (24, 25)
    )
    moved = sum(before[i] != after[i] for i in before)
    # At least a 25th must move; without overflow it would be all, with it at most a quarter.
    assert 3000 / 25 <= moved <= 3000 / 4


# ---- Rows without ids, and stages of the pipeline ----------------------------------------


def test_rows_without_id_are_drawn_one_by_one(documents):
    df = documents([(None, f"one two three {i}") for i in range(400)])
    kept = mix(df, kept_share=0.5).filter("kept").count()
    assert 140 < kept < 260


def test_rows_without_id_fill_no_pool_of_their_own(documents):
    out = pack_documents(documents([(None, f"w{i}") for i in range(2000)] + [(None, "")] * 500), vocabulary(), pool=250)
    pools = Counter(r["sequence_id"] >> 32 for r in out.collect())
    assert len(pools) == 10 and max(pools.values()) < 400
    assert sum(pools.values()) == 2500


NEAR = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 3


def test_near_dedup_drops_rows_and_not_ids(spark, documents):
    rows = [(1, NEAR + "a"), (5, NEAR + "b"), (5, "a text of its own with an id that a copy has"), (None, NEAR + "a"), (6, ""), (6, None), (1, NEAR + "a"), (8, "alone"), (8, "alone")]
    out = corpus_pipeline.near_dedup(spark, documents(rows, {"row_hash": 3, "component_id": 1}), "")
    kept = sorted((str(r["doc_id"]), str(r["text"])[-8:]) for r in out.collect())
    assert kept == sorted([("1", (NEAR + "a")[-8:]), ("5", "copy has"), ("None", (NEAR + "a")[-8:]), ("6", ""), ("6", "None"), ("8", "alone")])


ODD = [(None, None), (None, ""), (1, "word " * 50), (1, "word " * 50), (2, None), (2, "other words of one id " * 5), (3, "#$% " * 40)] + [
    (10 + i, f"alpha beta gamma delta {i} epsilon zeta eta theta iota kappa lambda\nshared line of all") for i in range(14)
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_handle_odd_rows(spark, documents, rows):
    clash = {"row_hash": 1, "kept": "k", "n_tokens": 2, "line_counts": 3, "component_id": 4, "piece": 5, "probability": 0}
    docs = documents(rows, clash)
    columns, n = docs.columns, len(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
        assert docs.columns == columns and docs.count() <= n, name
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert sum(r["piece"] == 0 for r in packed) == n
    if rows:
        assert n > 3


def test_long_texts(spark, documents):
    """A text of some megabytes passes the line and phrase operators whole."""
    long = "\n".join(f"line {i} of a long text with number {i * 7919 % 1_000_003}" for i in range(60_000))
    df = documents([(1, long), (2, long[: 1 << 20])])
    out = drop_common_lines(df, min_docs=2).collect()
    seen = defaultdict(set)
    for d, t in ((1, long), (2, long[: 1 << 20])):
        for line in t.split("\n"):
            seen[brute.line_key(line)].add(d)
    want = [x for x in long.split("\n") if len(seen[brute.line_key(x)]) < 2]
    assert next(r["text"] for r in out if r["doc_id"] == 1) == "\n".join(want)
    left = {r["doc_id"]: r["n_words"] - r["n_removed"] for r in drop_repeated_phrases(df).collect()}
    assert left[1] == len(long.split()) and left[2] <= 1


def test_written_steps_leave_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [d.getPath() for d in manager.localDirs()]

    def shuffles():
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(common.SHUFFLE_CLEANUP, None)
    rows = common.written(spark.range(2000).repartition(3, "id"), "rows")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    assert rows.count() == 2000 and spark.conf.get(common.SHUFFLE_CLEANUP, None) == setting


def test_near_dedup_keeps_texts_compressed(spark, docs):
    shared = os.path.join(spark.conf.get("spark.checkpoint.dir"), "newsignal")

    def kept():
        return {d for d in os.listdir(shared) if d.startswith(("near-rows-", "texts-"))} if os.path.isdir(shared) else set()

    before = kept()
    corpus_pipeline.near_dedup(spark, docs, "")
    made = [os.path.join(shared, d) for d in kept() - before]
    files = [os.path.join(d, f) for d in made for f in os.listdir(d) if f.endswith(".parquet")]
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert len(made) == 2 and files
    assert {m.row_group(i).column(0).compression for m in groups for i in range(m.num_row_groups)} == {"ZSTD"}


def test_line_keys_are_computed_once_a_line(documents):
    plans = [
        df._jdf.queryExecution().executedPlan().toString()
        for df in (common_lines(common.keyed(documents([(1, "One\ntwo")])), 1), drop_common_lines(documents([(1, "One\ntwo")])))
    ]
    assert [(p.count("translate("), p.count("trim(")) for p in plans] == [(1, 1), (1, 1)]
    assert "array_distinct" not in plans[0]  # compares each line with all others of its text


def test_lines_differ_by_letters_beyond_ascii(documents):
    """Only A-Z and the six white space characters count as equal, beside any other letters."""
    same = [("Plain LINE", "\x0b\tpLAIN line\r "), ("É Été X", " É Été x\x0c"), ("ΣΑΣ A", "ΣΑΣ a")]
    apart = [("é", "É"), ("k", "K"), ("i̇", "İ"), ("σς", "ΣΣ"), ("x", "x\xa0"), ("y", "\x1cy"), ("ß", "ss")]
    for a, b in same:
        assert brute.line_key(a) == brute.line_key(b)
        assert [r["text"] for r in drop_common_lines(documents([(1, a), (2, b)]), 2).collect()] == ["", ""]
    data = [(i, "\n".join(pair[i] for pair in apart)) for i in range(2)]
    assert sorted(r["text"] for r in drop_common_lines(documents(data), 2).collect()) == sorted(t for _, t in data)
    # A line that one document repeats counts once; white space alone is no key.
    repeated = [(1, "same\nSAME \nsame\n \n"), (2, " \n\nother")]
    out = drop_common_lines(documents(repeated), 2).collect()
    assert sorted(r["text"] for r in out) == sorted(t for _, t in repeated)
