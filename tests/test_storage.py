"""Files, tables, streams and whole runs."""

from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from newsignal import schemas
from newsignal.operators import clean, prices, report, scoring
from newsignal.plans.companies import MACRO_TOPICS, company_table, query_table
from newsignal.plans.daily import Inputs, daily_frames, full_days, ingest as ingest_day, run_day
from newsignal.session import scratch_dir
from newsignal.sources import articles, sinks, tables
from newsignal.streaming import daily, dedup, ingest, refresh

ARTICLE = ", ".join(f"{c} string" for c in schemas.ARTICLE.names)


def article(day, url, title, ticker="AAPL", **more):
    base = dict.fromkeys(schemas.ARTICLE.names)
    return {**base, "date": day, "ticker": ticker, "company": ticker, "article_type": "company",
            "publishedAt": f"{day}T08:00:00Z", "source": "s", "title": title, "url": url, **more}


def write_day(folder, day, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"news_{day}.json").write_text(json.dumps(rows, indent=2, ensure_ascii=False))
    (folder / f"manifest_{day}.json").write_text(json.dumps({"date": day}))


def test_json_arrays_and_broken_files(spark, tmp_path):
    write_day(tmp_path / "2026-01-01", "2026-01-01", [article("2026-01-01", "u1", "Été"),
                                                     article("2026-01-01", None, None)])
    write_day(tmp_path / "2026-01-02", "2026-01-02", [])
    (tmp_path / "2026-01-02" / "news_bad.json").write_text("{ not json")
    rows = articles.read_articles(spark, str(tmp_path)).collect()
    good = [r for r in rows if r["_corrupt_record"] is None]
    assert len(good) == 2 and len(rows) == 3
    assert {r["title"] for r in good} == {"Été", None}


def test_payload(spark):
    rows = [((("Paper",), "t", "d", "c", "u", "p"))]
    flat = articles.normalize_payload(
        spark.createDataFrame(rows, schemas.PAYLOAD), F.lit("2026-01-01"), F.lit("AAPL"),
        F.lit("Apple"), F.lit("company"),
    )
    assert flat.columns == schemas.ARTICLE.names and flat.first()["source"] == "Paper"


def test_landing(spark, tmp_path):
    first, second = tmp_path / "a", tmp_path / "b"
    for day in ("2026-01-01", "2026-01-02"):
        write_day(first, day, [article(day, "u" + day, "first")])
    for day in ("2026-01-02", "2026-01-03"):
        write_day(second, day, [article(day, "u" + day, "second")])
    files = articles.landing_files(spark, [str(first), str(second)])
    loaded = spark.createDataFrame([("2026-01-01",)], "date string")
    todo = articles.new_landing_files(files, loaded)
    rows = articles.read_landed(spark, todo).select("date", "title").collect()
    assert sorted(map(tuple, rows)) == [("2026-01-02", "first"), ("2026-01-03", "second")]
    everything = articles.new_landing_files(files, files.select("date"))
    assert articles.read_landed(spark, everything).count() == 0


def test_append_new_is_idempotent(frame, spark, tmp_path):
    path = str(tmp_path / "clean")

    def run(day, *urls, known=True):
        rows = frame(ARTICLE, *[article(day, u, f"{day} {u}") for u in urls])
        sinks.append_new(clean.clean_articles(rows), path, dates=[day] if known else None)

    def stored():
        rows = tables.read_partitioned(spark, path, "date").select("date", "url").collect()
        return sorted(map(tuple, rows))

    run("2026-01-01", "a", "b")
    run("2026-01-02", "b", "c", known=False)
    expected = [("2026-01-01", "a"), ("2026-01-01", "b"), ("2026-01-02", "c")]
    assert stored() == expected
    run("2026-01-02", "b", "c")
    run("2026-01-01", "a", "b", known=False)
    assert stored() == expected


def test_dates_outside_the_run_stay(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    two = frame("event_date string, v int", dict(event_date="2026-01-01", v=1),
                dict(event_date="2026-01-02", v=1))
    sinks.write_partitions(two, path)
    sinks.write_partitions(two.filter("event_date = '2026-01-02'").withColumn("v", F.lit(2)), path)
    rows = tables.read_partitioned(spark, path).orderBy("event_date").collect()
    assert [r["v"] for r in rows] == [1, 2]
    dated = tables.with_path_date(tables.read_parquet(spark, path))
    assert dated.filter("event_date = '2026-01-02'").first()["v"] == 2
    sinks.replace_dataset(two, path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 1]


def rows_scanned(df):
    """Rows that came out of the scan of a plan with a single one, after it ran."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.size() == 1
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, tmp_path):
    """Rows come shuffled; a company is one row group of ORC (10,000 rows), an unknown one none."""
    n = 60_000
    mart = spark.range(n).selectExpr(
        f"lpad(id * 7919 % {n}, 6, '0') AS ticker", f"concat('N', lpad(id * 7919 % {n}, 6, '0')) AS company_name",
        "'I' AS industry", "id / 7 AS sentiment_score", "'neutral' AS sentiment_label", "1 AS mention_count",
        "0.5 AS pct_positive", "0.5 AS pct_negative", "array('a') AS sample_headlines", "'2026-01-01' AS event_date",
    )
    tables.create_marts(spark, "nsskip", str(tmp_path / "db"))
    sinks.overwrite_mart(mart, "nsskip", "company_sentiment")
    stored = tables.read_mart(spark, "nsskip", "company_sentiment")
    assert stored.count() == n
    assert rows_scanned(stored.select("company_name")) == n
    mart.write.orc(str(tmp_path / "plain"))
    plain = spark.read.orc(str(tmp_path / "plain"))
    for column, value in (("company_name", "N030001"), ("ticker", "030001")):
        assert 0 < rows_scanned(stored.filter(F.col(column) == value)) <= 10_000
    assert stored.filter("company_name = 'N030001'").count() == 1
    assert rows_scanned(plain.filter("company_name = 'N030001'")) > 10_000
    # Within the range of names, so only a Bloom filter can tell.
    assert rows_scanned(stored.filter("company_name = 'N030001x'")) == 0
    assert rows_scanned(plain.filter("company_name = 'N030001x'")) > 0


def test_statistics_of_marts(frame, spark, tmp_path):
    tables.create_marts(spark, "nsstats", str(tmp_path / "db"))
    rows = frame("event_date string, ticker string, close_price double, price_change_pct double, industry string",
                 *[dict(event_date=f"2026-01-0{i % 3 + 1}", ticker=f"T{i % 5}") for i in range(30)])
    sinks.overwrite_mart(rows, "nsstats", "price_data")
    tables.collect_statistics(spark, "nsstats")
    found = {r["info_name"]: r["info_value"] for r in spark.sql("DESCRIBE EXTENDED nsstats.price_data ticker").collect()}
    assert (found["distinct_count"], found["num_nulls"]) == ("5", "0")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    plan = spark.table("nsstats.price_data")._jdf.queryExecution().optimizedPlan()
    assert plan.stats().rowCount().get() == 30
    spark.conf.unset("spark.sql.cbo.enabled")


def test_marts(frame, spark, tmp_path):
    tables.create_marts(spark, "nsmart", str(tmp_path / "db"))
    tables.create_marts(spark, "nsmart")
    assert "USING ORC" in tables.mart_ddl("d", "price_data")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    shuffled = frame("event_date string, price_change_pct double, close_price double, ticker string, "
                     "industry string, extra int",
                     dict(event_date="2026-01-01", price_change_pct=1.5, close_price=2.5, ticker="A"),
                     dict(event_date="2026-01-02", price_change_pct=1.5, close_price=2.5, ticker="A"))
    sinks.overwrite_mart(shuffled, "nsmart", "price_data")
    later = shuffled.filter("event_date = '2026-01-02'").withColumn("ticker", F.lit("B"))
    sinks.overwrite_mart(later, "nsmart", "price_data")
    rows = tables.read_mart(spark, "nsmart", "price_data").orderBy("event_date").collect()
    assert [(r["ticker"], r["close_price"]) for r in rows] == [("A", 2.5), ("B", 2.5)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    sinks.log_run(spark, "nsmart", "2026-01-01", articles_processed=3, errors="it's",
                  zero_coverage_tickers=["A"])
    logged = tables.read_mart(spark, "nsmart", "pipeline_runs").first()
    assert (logged["errors"], logged["zero_coverage_tickers"]) == ("it's", ["A"])


def test_columns_by_name(frame):
    rows = frame("b int, a string", dict(a="1", b=2))
    union = tables.union_all([rows, frame("a string", dict(a="2"))]).orderBy("a").collect()
    assert [r["b"] for r in union] == [2, None]


def test_full_days():
    assert full_days(dt.date(2026, 3, 2), 3) == ["2026-02-27", "2026-02-28", "2026-03-01"]


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


EVENT = (
    "event_id long, ticker string, published_ts timestamp, event_date date, "
    "sentiment_label string, sentiment_score double"
)


def events(spark, *rows):
    sql = [
        f"({i}L, '{t}', timestamp '{ts}', date '{ts[:10]}', '{label}', {score}D)"
        for i, t, ts, label, score in rows
    ]
    return spark.sql(
        f"SELECT * FROM VALUES {', '.join(sql)} AS e(event_id, ticker, published_ts, event_date, "
        "sentiment_label, sentiment_score)"
    )


def stream(spark, path, schema):
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def test_article_stream_reads_each_file_once(spark, tmp_path):
    raw = tmp_path / "raw"
    out, bad, state = (str(tmp_path / x) for x in ("out", "bad", "state"))
    for n, day in enumerate(("2026-01-01", "2026-01-02"), 1):
        write_day(raw / day, day, [article(day, f"{day}{i}", "t") for i in range(2)])
        (raw / day / f"news_{day}_bad.json").write_text("[{ broken")
        for _ in range(2):
            rows = ingest.article_stream(spark, str(raw))
            for query in ingest.store_articles(rows, out, bad, state):
                query.awaitTermination()
        assert spark.read.parquet(out).count() == 2 * n
        broken = tables.read_partitioned(spark, bad, "date").collect()
        assert sorted((r["date"], r["text"]) for r in broken) == [
            (d, "[{ broken") for d in ("2026-01-01", "2026-01-02")[:n]
        ]


@pytest.mark.parametrize("spread", [None, "event_id"])
def test_stream_dedup_and_late_rows(spark, tmp_path, spread):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [
        [(1, "A", "2026-01-10 00:00:00", "neutral", 0.0)] * 3,
        [(1, "A", "2026-01-10 01:00:00", "neutral", 0.0), (2, "A", "2026-01-20 00:00:00", "neutral", 0.0)],
        [(3, "A", "2026-01-01 00:00:00", "neutral", 0.0)],  # behind the watermark
    ]
    schema = events(spark, *batches[0]).schema
    column = F.col(spread) if spread else None
    for rows in batches:
        events(spark, *rows).coalesce(1).write.mode("append").parquet(path)
        kept = dedup.dedup_stream(stream(spark, path, schema), "event_id", "published_ts", "2 days", column)
        ingest.store_stream(kept, out, state, by=None).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_stream_daily_updates_and_refresh(spark, tmp_path):
    path, out, mart = (str(tmp_path / n) for n in ("in", "out", "mart"))
    batches = [
        [(1, "A", "2026-01-01 10:00:00", "positive", 0.5), (2, "B", "2026-01-01 11:00:00", "negative", -0.5)],
        [(3, "A", "2026-01-02 10:00:00", "neutral", 0.0)],
        [(4, "A", "2026-01-01 12:00:00", "negative", -0.1), (1, "A", "2026-01-01 10:00:00", "positive", 0.5)],
    ]
    schema = events(spark, *batches[0]).schema

    def aggregate(rows):
        return rows.groupBy("event_date", "ticker").agg(F.count(F.lit(1)).alias("n"))

    for rows in batches:
        events(spark, *rows).coalesce(1).write.mode("append").parquet(path)
        totals = daily.daily_stream(stream(spark, path, schema))
        daily.store_updates(totals, out, str(tmp_path / "s1")).awaitTermination()
        refresh.refresh_stream(
            stream(spark, path, schema), str(tmp_path / "store"), mart, str(tmp_path / "s2"),
            aggregate, "event_id", ["published_ts"],
        ).awaitTermination()
    state = daily.current_state(spark, out)
    for folder in (tmp_path / "out", tmp_path / "store", tmp_path / "mart"):
        assert max(len(list(x.glob("*.parquet"))) for x in folder.glob("event_date=*")) <= 2
    got = {(str(r["event_date"]), r["ticker"]): r["mention_count"] for r in state.collect()}
    assert got == {("2026-01-01", "A"): 3, ("2026-01-01", "B"): 1, ("2026-01-02", "A"): 1}
    fresh = {(str(r["event_date"]), r["ticker"]): r["n"] for r in spark.read.parquet(mart).collect()}
    assert fresh == {("2026-01-01", "A"): 2, ("2026-01-01", "B"): 1, ("2026-01-02", "A"): 1}


@pytest.fixture
def inputs(spark, frame):
    rows, days = [], [f"2026-01-0{d}" for d in range(1, 7)]
    for i, day in enumerate(days):
        word = "profit" if i % 2 else "loss"
        rows += [article(day, f"http://x/{day}", f"Apple {word}", company="Apple"),
                 article(day, f"HTTP://X/{day} ", f"Apple {word}", company="Apple"),
                 article(day, f"http://y/{day}", "Microsoft gains", ticker="MSFT", company="Microsoft"),
                 article(day, "http://same", "Visa everywhere", ticker="V", company="Visa"),
                 article(day, f"http://m/{day}", "Oil", ticker="MACRO", company="Oil / Energy",
                         article_type="macro")]
    closes = [dict(ticker=t, event_date=day, close=100.0 + i * i * (1 if t == "AAPL" else -1))
              for t in ("AAPL", "MSFT") for i, day in enumerate(days)]
    entities = company_table(spark)
    return days, Inputs(frame(ARTICLE, *rows), frame(
        "ticker string, event_date string, close double", *closes), entities,
        query_table(entities, MACRO_TOPICS))


def test_lazy_frames(inputs):
    _, data = inputs
    frames = daily_frames(data)
    assert frames["company_sentiment"].count() == 13  # two companies daily, one once
    assert [r["ticker"] for r in frames["missing_prices"].collect()] == ["V"]
    assert frames["corr_summary"].count() == 2


def test_run_day_equals_the_lazy_plan_and_can_be_repeated(spark, inputs, tmp_path):
    days, data = inputs
    tables.create_marts(spark, "nsrun", str(tmp_path / "db"))
    store = str(tmp_path / "store")

    def marts():
        return {
            t: sorted(map(str, tables.read_mart(spark, "nsrun", t).collect()))
            for t in ("company_sentiment", "price_data", "sentiment_price_correlation")
        }

    run_day(spark, data, store, "nsrun", days[:3])
    run_day(spark, data, store, "nsrun", days[3:])
    once = marts()
    run_day(spark, data, store, "nsrun", days[3:])
    assert marts() == once
    run_day(spark, data, store, "nsrun", days[:3])
    assert marts() == once
    lazy = daily_frames(data)
    for table, schema in (("company_sentiment", schemas.COMPANY_SENTIMENT),
                          ("sentiment_price_correlation", schemas.SENTIMENT_PRICE_CORRELATION)):
        want = sorted(map(str, schemas.align_to(lazy[table], schema).collect()))
        assert once[table] == want
    runs = tables.read_mart(spark, "nsrun", "pipeline_runs").collect()
    assert len(runs) == 12 and {r["articles_processed"] for r in runs} == {4}  # the copy is not kept
    assert sorted((r["run_date"], r["attempt"]) for r in runs) == [(d, a) for d in days for a in (1, 2)]


def test_run_day_replaces_what_went(spark, inputs, tmp_path):
    days, data = inputs
    tables.create_marts(spark, "nsgone", str(tmp_path / "db"))
    store = str(tmp_path / "store")

    def mart(name):
        return tables.read_mart(spark, "nsgone", name)

    quiet = Inputs(data.articles.filter("false"), data.closes, data.entities, data.queries)
    run_day(spark, quiet, store, "nsgone", days[:1])
    assert mart("company_sentiment").count() == 0 and mart("pipeline_runs").first()["articles_processed"] == 0
    rows = run_day(spark, data, store, "nsgone", days[1:4])
    assert rows["clean"] == 10 and rows["company_sentiment"] == mart("company_sentiment").count() == 7
    run_day(spark, quiet, store, "nsgone", days[2:3])
    left = {r["event_date"] for r in mart("company_sentiment").collect()}
    assert left == {days[1], days[3]}
    assert days[2] not in {r["event_date"] for r in mart("sentiment_price_correlation").collect()}
    assert spark.read.parquet(f"{store}/mentions").filter(F.col("event_date") == days[2]).count() == 0

    def failing(texts):
        raise RuntimeError("no model")

    with pytest.raises(RuntimeError):
        run_day(spark, data, store, "nsgone", days[4:5], score=failing)
    failed = mart("pipeline_runs").filter("status = 'failed'").collect()
    assert [(r["run_date"], r["attempt"], r["errors"]) for r in failed] == [(days[4], 1, "RuntimeError: no model")]


def test_restated_close_renews_the_next_day(spark, inputs, tmp_path):
    days, data = inputs
    tables.create_marts(spark, "nsprice", str(tmp_path / "db"))
    store = str(tmp_path / "store")

    def run(dates, closes):
        run_day(spark, Inputs(data.articles, closes, data.entities, data.queries), store, "nsprice", dates)

    def changes(ticker):
        rows = tables.read_mart(spark, "nsprice", "price_data").filter(F.col("ticker") == ticker)
        return {r["event_date"]: round(r["price_change_pct"], 2) for r in rows.collect()}

    sparse = data.closes.filter((F.col("ticker") == "MSFT") | F.col("event_date").isin(days[0], days[1], days[5]))
    run(days, sparse)
    restated = sparse.withColumn(
        "close", F.when((F.col("ticker") == "AAPL") & (F.col("event_date") == days[1]), 50.0).otherwise(F.col("close"))
    )
    before = changes("MSFT")
    run(days[1:2], restated)
    assert changes("AAPL") == {days[0]: 0.0, days[1]: -50.0, days[5]: 150.0}
    assert changes("MSFT") == before


def test_first_change_looks_back_as_far_as_needed(frame):
    closes = frame("ticker string, event_date string, close double",
                   dict(ticker="A", event_date="2026-01-01", close=10.0),
                   dict(ticker="A", event_date="2026-02-01", close=11.0),
                   dict(ticker="A", event_date="2026-03-01", close=22.0),
                   dict(ticker="A", event_date="2026-04-01", close=11.0))
    got = prices.changes_around(closes, "2026-02-01", "2026-02-03").collect()
    assert {r["event_date"]: r["price_change_pct"] for r in got} == {"2026-02-01": 10.0, "2026-03-01": 100.0}


def test_a_run_reads_only_its_day_folders(spark, inputs, tmp_path):
    days, data = inputs
    raw = str(tmp_path / "raw")
    sinks.write_day_files(data.articles, raw)
    sinks.write_day_files(data.articles.filter(F.col("date") == days[0]).limit(1), raw)
    everything = articles.read_day_files(spark, raw)
    assert everything.filter(F.col("date") == days[0]).count() == 1 and everything.count() == 26
    one = articles.read_day_files(spark, raw, days[1:2])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*date", plan) and plan.count("FileScan") == 1
    (tmp_path / "raw" / f"date={days[1]}" / "part-broken.json").write_text('{"title": \n')
    store = str(tmp_path / "store")
    rows = articles.read_day_files(spark, raw, days[1:3])
    ingest_day(spark, Inputs(rows, data.closes, data.entities, data.queries), store, days[1:3])
    bad = spark.read.parquet(f"{store}/quarantine").collect()
    assert [(r["date"], r["text"]) for r in bad] == [(days[1], '{"title": ')]
    assert tables.read_dates(spark, f"{store}/articles", days[1:3]).count() == 8


def test_scores_stay_one_per_key(frame, spark, tmp_path):
    path = str(tmp_path / "scores")
    rows = frame("dedup_key string, date string, sentiment_label string, model_version string",
                 *[dict(dedup_key=k, date=d, sentiment_label="x", model_version="m")
                   for k, d in (("a", "2026-01-01"), ("a", "2026-01-01"), ("b", "2026-01-02"))])
    for batch in (rows, rows.filter("dedup_key = 'a'"), rows):
        sinks.append_scores(batch, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    known = stored.withColumn("date", F.col("date").cast("string"))
    todo = scoring.pending_articles(rows, known, "m", dates=["2026-01-01"])
    assert [r["dedup_key"] for r in todo.collect()] == ["b"]
    plan = todo._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_marts_with_two_tickers_a_company(frame):
    schema = ("ticker string, company_name string, industry string, event_date string, sentiment_label string, "
              "sentiment_score double, mention_count int, pct_positive double, pct_negative double")
    rows = [dict(ticker=t, company_name="Both", industry="X", event_date="2026-01-01", sentiment_label=s,
                 sentiment_score=v, mention_count=1, pct_positive=0.5, pct_negative=0.5)
            for t, s, v in (("A", "positive", 0.5), ("B", "negative", -0.5))]
    for query in (report.rankings, report.kpis, lambda m: report.entity_detail(m, "Both"),
                  lambda m: report.latest_per_entity(m, null_skipping=True)):
        one, other = (query(frame(schema, *order)).collect() for order in (rows, rows[::-1]))
        assert one == other
