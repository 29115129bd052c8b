"""Cleaning, coverage and tagging."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from newsignal import schemas
from newsignal.operators import clean, coverage, tagging
from newsignal.plans.companies import COMPANIES, MACRO_TOPICS, company_table, query_table

ARTICLE = ", ".join(f"{c} string" for c in schemas.ARTICLE.names)
HIT = ARTICLE + ", query_rank int, position int"


def test_clean_keeps_titled_first_copy(frame):
    rows = frame(
        ARTICLE,
        dict(date="2026-01-02", title="B", url="http://x/1"),
        dict(date="2026-01-01", title=None, url="HTTP://X/1 "),
        dict(date="2026-01-03", title="C", url=" http://X/1"),
        dict(date="2026-01-01", title="N1", url=None, source="s"),
        dict(date="2026-01-01", title="N2", url=None, source="s"),
        dict(date="2026-01-01", title="n1", url="", source="S"),
    )
    kept = {r["title"] for r in clean.clean_articles(rows).collect()}
    assert "B" in kept and "C" not in kept and "N2" in kept
    assert len(kept & {"N1", "n1"}) == 1 and len(kept) == 3
    per_day = clean.clean_articles(rows, scope="day").collect()
    assert {r["title"] for r in per_day} >= {"B", "C", "N2"}
    with pytest.raises(ValueError):
        clean.clean_articles(rows, scope="week")


def test_dedup_drops_copies_before_the_shuffle(frame):
    plan = clean.clean_articles(frame(ARTICLE, dict(title="a")))._jdf.queryExecution().toString()
    partial, exchange = plan.rfind("Partial"), plan.rfind("Exchange hashpartitioning")
    assert 0 < exchange < partial


def test_not_stored(frame):
    batch = frame("k string, v int", dict(k="a", v=1), dict(k="b", v=2), dict(k="c", v=3))
    stored = frame("k string", dict(k="b"), dict(k="b"), dict(k="z"))
    left = clean.not_stored(batch, stored, ["k"]).collect()
    assert sorted(r["k"] for r in left) == ["a", "c"]


def hit(rank, ticker, title, url, **more):
    return dict(
        date="2026-01-01", ticker=ticker, company=more.pop("company", ticker.lower()),
        article_type=more.pop("kind", "company"), title=title, url=url, query_rank=rank,
        position=more.pop("position", 0), **more,
    )


@pytest.fixture
def hits(frame):
    return frame(
        HIT,
        hit(0, "V", "Travel news", "u1", company="Visa"),          # "v" inside a word
        hit(1, "AXP", "American Express gains", "u2", company="American Express"),
        hit(0, "V", "American Express gains", "u2", company="Visa"),
        hit(1, "AXP", "Nothing here", "u3", company="American Express", description="axp up"),
        hit(2, "KO", None, "u4", company="Coca-Cola"),
        hit(9, "MACRO", "Rates rise", "u5", company="rates", kind="macro"),
        hit(9, "MACRO", "American Express gains", "U2 ", company="rates", kind="macro"),
    )


def test_relevance_modes(hits):
    loose = coverage.relevant_hits(hits).select("ticker", "url").collect()
    assert {("V", "u1"), ("AXP", "u2"), ("AXP", "u3")} <= {tuple(r) for r in loose}
    strict = coverage.relevant_hits(hits, "token").select("ticker", "url").collect()
    assert ("V", "u1") not in {tuple(r) for r in strict}
    assert ("KO", "u4") not in {tuple(r) for r in loose}
    assert ("MACRO", "u5") in {tuple(r) for r in strict}


def test_first_query_wins_and_macro_comes_last(hits):
    kept = coverage.first_wins(hits).select("ticker", "url").collect()
    assert {tuple(r) for r in kept} == {("V", "u1"), ("AXP", "u2"), ("AXP", "u3"), ("MACRO", "u5")}


def test_funnel(hits):
    rows = {r["name"]: r for r in coverage.ingest_funnel(hits).collect()}
    counts = {n: (r["fetched"], r["relevant"], r["kept"]) for n, r in rows.items()}
    assert counts == {"V": (2, 1, 1), "AXP": (2, 2, 2), "KO": (1, 0, 0), "rates": (2, 2, 1)}


def test_manifest_lists_zeros(spark, hits):
    queries = query_table(company_table(spark), MACRO_TOPICS)
    kept = coverage.first_wins(hits)
    manifest = coverage.coverage_manifest(kept, queries, "2026-01-01", "2026-01-02")
    assert manifest.count() == 2 * (len(COMPANIES) + len(MACRO_TOPICS))
    zero = coverage.zero_coverage(manifest).filter("date = '2026-01-01'").collect()
    assert len(zero) == len(COMPANIES) - 2
    first, second = sorted(coverage.manifest_documents(manifest).collect())
    assert first["companies"]["AXP"] == 2 and first["companies"]["KO"] == 0
    ranked = [t for t, *_ in COMPANIES if t not in ("V", "AXP")]
    assert first["zero_coverage"] == ranked and len(second["zero_coverage"]) == len(COMPANIES)
    runs = coverage.run_rows(coverage.manifest_documents(manifest)).orderBy("run_date").collect()
    assert [r["articles_processed"] for r in runs] == [3, 0]


TEXTS = {
    "full name with dot": ("Apple Inc. rises", {"AAPL"}),
    "any case": ("apple and MICROSOFT", {"AAPL", "MSFT"}),
    "safe symbol": ("long AAPL, short $MSFT", {"AAPL", "MSFT"}),
    "symbol in lower case": ("aapl", set()),
    "unsafe symbol": ("V and HD and CAT", set()),
    "inside a word": ("pineapple applesauce xAAPL AAPLs", set()),
    "accented neighbour": ("éapple appleé", set()),
    "underscore": ("_apple_", set()),
    "punctuation in the name": ("McDonald's (Johnson & Johnson)", {"MCD", "JNJ"}),
    "hyphen": ("the Coca-Cola company; coca cola", {"KO"}),
    "longer name": ("The Goldman Sachs Group Inc.", {"GS"}),
    "nothing": ("no company at all", set()),
    "missing": (None, set()),
}


@pytest.mark.parametrize("way", ["expression", "anchor"])
def test_matching(spark, frame, way):
    rows = frame(
        "dedup_key string, title string, description string",
        *[dict(dedup_key=k, title=t) for k, (t, _) in TEXTS.items()],
        dict(dedup_key="description", title="x", description="about Boeing"),
        dict(dedup_key="across", title="American", description="Express"),
    )
    entities = company_table(spark)
    if way == "expression":
        matched = tagging.match_by_expression(rows, entities.collect())
    else:
        matched = tagging.match_by_anchor(rows, entities)
    got = {r["dedup_key"]: set(r["text_matches"]) for r in matched.collect()}
    want = {k: tags for k, (_, tags) in TEXTS.items()}
    assert got == {**want, "description": {"BA"}, "across": {"AXP"}}


def test_both_ways_agree_on_awkward_names(spark, frame):
    entities = spark.createDataFrame(
        [("A", "International Group of A", "&", "X", True, 0),
         ("B", "International Group of B", "", "X", True, 1),
         ("C", "International", None, "X", False, 2), ("D.1", "a-b.c", "D (new)", "X", True, 3),
         ("E", None, None, "X", True, 4)],
        schemas.ENTITY,
    )
    rows = frame(
        "dedup_key string, title string, description string",
        dict(dedup_key="1", title="INTERNATIONAL group of a & b"),
        dict(dedup_key="2", title="A-B.C, D.1 and d (NEW)!", description="E"),
        dict(dedup_key="3", title="d.1 e &", description=""),
        dict(dedup_key="4", title="International Group of B"),
    )
    # The symbols A and B count in "A-B.C", between a hyphen and a dot.
    want = {"1": {"A", "C"}, "2": {"D.1", "E", "A", "B"}, "3": set(), "4": {"B", "C"}}
    for matched in (
        tagging.match_by_expression(rows, entities.collect()),
        tagging.match_by_anchor(rows, entities),
    ):
        assert {r["dedup_key"]: set(r["text_matches"]) for r in matched.collect()} == want


def test_matching_goes_one_way_for_every_dictionary_size(spark, frame):
    rows = frame("dedup_key string, title string, description string",
                 dict(dedup_key="a", title="Visa and name 4321 with Boeing"))
    small = company_table(spark)
    more = spark.range(5000).select(
        F.concat(F.lit("T"), "id").alias("ticker"), F.concat(F.lit("name "), "id").alias("full_name"),
        F.lit(None).cast("string").alias("short_name"), F.lit("X").alias("industry"),
        F.lit(False).alias("symbol_is_safe"), F.lit(0).alias("query_rank"),
    )
    plans = []
    for entities, want in ((small, ["BA", "V"]), (small.unionByName(more), ["BA", "T4321", "V"])):
        matched = tagging.match_entities(rows, entities)
        assert matched.first()["text_matches"] == want
        plan = matched._jdf.queryExecution().optimizedPlan().toString()
        plans.append(re.findall(r"Join \w+|Generate|Aggregate|Window", plan))
    assert plans[0] == plans[1]


def test_a_blank_url_is_none(frame):
    rows = frame("url string, title string, source string, publishedAt string",
                 *[dict(url=u, title=t) for u, t in (("  ", "a"), ("", "b"), (None, "c"), ("\u00a0", "d"))])
    assert clean.with_dedup_key(rows).select("dedup_key").distinct().count() == 4


def test_winner_does_not_depend_on_the_order_of_rows(spark, frame):
    schema = ", ".join(f"{c} string" for c in schemas.ARTICLE.names)
    same = dict(date="2026-01-01", url="u", title="t", source="s", ticker="MACRO", article_type="macro")
    copies = [dict(same, company=c, content=x) for c in ("oil", "rates") for x in (None, "x", "y")]
    winners = {
        tuple(clean.clean_articles(frame(schema, *order)).first())
        for order in (copies, copies[::-1], copies[3:] + copies[:3])
    }
    assert len(winners) == 1 and "oil" in winners.pop()


def test_tags_of_query_and_text(spark, frame):
    rows = frame(
        "dedup_key string, ticker string, article_type string, title string, description string",
        dict(dedup_key="1", ticker="AAPL", article_type="company", title="Microsoft"),
        dict(dedup_key="2", ticker="MACRO", article_type="macro", title="Apple"),
        dict(dedup_key="3", ticker="MACRO", article_type="company", title="-"),
        dict(dedup_key="4", ticker="NEW", article_type="company", title="-"),
        dict(dedup_key="5", ticker=None, article_type="company", title="-"),
        dict(dedup_key="6", ticker="", article_type=None, title=None),
    )
    entities = company_table(spark)
    tagged = tagging.combine_tags(tagging.match_entities(rows, entities))
    out = tagging.explode_mentions(tagged, entities).collect()
    got = {(r["dedup_key"], r["ticker"], r["company_name"], r["industry"]) for r in out}
    assert got == {
        ("1", "AAPL", "Apple Inc.", "Technology"),
        ("1", "MSFT", "Microsoft Corporation", "Technology"),
        ("2", "AAPL", "Apple Inc.", "Technology"),
        ("4", "NEW", "NEW", "Unknown"),
    }
    none = tagging.unmatched_articles(tagged).collect()
    assert sorted(r["dedup_key"] for r in none) == ["3", "5", "6"]


def test_matching_stays_out_of_python(spark, frame):
    rows = frame("dedup_key string, title string, description string", dict(dedup_key="a", title="V"))
    matched = tagging.match_by_expression(rows, company_table(spark).collect())
    found = matched.filter(F.size("text_matches") > 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert plan.count("Contains(_lower") == plan.count("RLIKE(_lower") > 0
    enriched = tagging.enrich(matched.withColumn("ticker", F.col("title")), company_table(spark))
    assert "BroadcastHashJoin" in enriched._jdf.queryExecution().executedPlan().toString()
