"""State between runs: carried snapshots, published commits, key tables, ordered streams, budgets."""

from __future__ import annotations

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsignal.operators import aggregate, clean, correlate, prices, quality, report, scoring
from newsignal.plans import carried
from newsignal.sources import arrays, files, keys, sinks, tables
from newsignal.sources.snapshots import Conflict, Snapshots
from newsignal.streaming.first_wins import first_wins_stream, rocksdb
from newsignal.streaming.ingest import store_stream

DAYS = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(12)]
DAILY = "ticker string, event_date string, sentiment_score double, mention_count long"
CLOSES = "ticker string, event_date string, close double"


def daily_rows(seed: int):
    rng = random.Random(seed)
    return [
        (t, day, round(rng.uniform(-1, 1), 4), rng.randint(1, 9))
        for t in ("A", "B", "C") for day in DAYS if rng.random() < 0.8 and not (t == "C" and "04" < day[-2:] < "08")
    ]


def close_rows(seed: int):
    rng = random.Random(seed)
    return [(t, day, rng.choice([None, 0.0, round(rng.uniform(1, 99), 2), round(rng.uniform(1, 99), 2)]))
            for t in ("A", "B", "C") for day in DAYS if rng.random() < 0.9]


def key_set(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# Runs in order, with a hole that is filled later, and days that are run again.
ORDER = [DAYS[:4], DAYS[4:5], DAYS[9:], DAYS[5:9], DAYS[10:11], DAYS[2:3]]


def test_carried_correlation_equals_the_whole_window(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    wrong, right = spark.createDataFrame(daily_rows(1), DAILY), spark.createDataFrame(daily_rows(2), DAILY)
    price_rows = prices.price_change(spark.createDataFrame(close_rows(3), CLOSES))
    sinks.replace_dates(price_rows, f"{store}/prices", DAYS, "event_date")
    seen: set[str] = set()
    for dates in ORDER:
        last_time = not any(set(dates) & set(later) for later in ORDER[ORDER.index(dates) + 1 :])
        carried.forget_from(spark, f"{store}/carried/tail", min(dates))
        sinks.replace_dates(right if last_time else wrong, f"{store}/daily", dates, "event_date")
        seen |= set(dates)
        renewed = carried.run_correlation(spark, store, dates)
        sinks.replace_dates(renewed, out, sorted(d for d in seen if d >= min(dates)), "event_date")
    # Days that were first wrong and then run again are right; so all of them are, if each is.
    columns = ["ticker", "event_date", "correlation_7d"]
    stored = tables.read_partitioned(spark, f"{store}/daily")
    full = correlate.rolling_corr(correlate.sentiment_price_join(stored, price_rows))
    assert key_set(tables.read_partitioned(spark, out), *columns) == key_set(full, *columns)
    assert full.filter("correlation_7d <> 0").count() > 10


def test_carried_closes_give_the_changes_of_the_whole_series(spark, tmp_path):
    store = str(tmp_path)
    first, second = (
        prices.one_close_per_day(spark.createDataFrame(close_rows(s), CLOSES), ["close"]) for s in (4, 5)
    )
    early = spark.createDataFrame([("A", "2023-12-20", 7.0), ("D", "2023-12-01", 3.0), ("B", DAYS[3], 1.0)], CLOSES)
    for dates in ORDER:
        again = ORDER.index(dates) > 3
        fresh = (second if again else first).filter(F.col("event_date").isin(dates))
        carried.run_closes(spark, fresh, store, dates, early)
    stored = tables.read_partitioned(spark, f"{store}/closes")
    whole = prices.price_change(stored.unionByName(early.filter(F.col("event_date") < DAYS[0])))
    columns = ["ticker", "event_date", "close_price", "price_change_pct"]
    want = key_set(whole.filter(F.col("event_date") >= DAYS[0]), *columns)
    assert key_set(tables.read_partitioned(spark, f"{store}/prices"), *columns) == want


def test_a_run_in_order_reads_its_dates_and_the_snapshot_only(spark, tmp_path):
    store = str(tmp_path)
    daily = spark.createDataFrame(daily_rows(1), DAILY)
    closes = prices.one_close_per_day(spark.createDataFrame(close_rows(3), CLOSES), ["close"])

    def run(dates):
        sinks.replace_dates(daily, f"{store}/daily", dates, "event_date")
        carried.run_closes(spark, closes.filter(F.col("event_date").isin(dates)), store, dates)
        return carried.run_correlation(spark, store, dates)

    run(DAYS[:8])
    run(DAYS[8:9])
    for file in tmp_path.glob("*/event_date=*/*.parquet"):  # whoever reads an old day fails
        file.write_bytes(b"not parquet")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert run(DAYS[9:10]).filter(F.col("event_date") == DAYS[9]).count() > 0
    tail = spark.read.parquet(f"{store}/carried/tail/as_of={DAYS[9]}")
    assert tail.groupBy("ticker").count().filter("count > 6").isEmpty()
    with pytest.raises(Exception, match="Parquet|parquet"):
        run(DAYS[7:8])  # a restated day has to


def test_a_broken_run_leaves_no_snapshot_of_what_it_replaced(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = spark.createDataFrame([("A", 1.0)], "ticker string, close double")
    for day in DAYS[:4]:
        carried.keep(rows, state, day)
    carried.forget_from(spark, state, DAYS[2])
    assert files.partitions(spark, state, "as_of") == DAYS[:2]
    assert carried.snapshot_before(spark, state, DAYS[9])[0] == DAYS[1]
    assert carried.snapshot_before(spark, state, DAYS[0]) == ("", None)


# ---- Published commits ------------------------------------------------------------------


@pytest.fixture
def marts(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "marts"))


def rows(spark, value, days):
    return spark.createDataFrame([(f"k{i}", value, d) for d in days for i in range(2)], "key string, n long, event_date string")


def values(df):
    return {(r["event_date"], r["n"]) for r in df.collect()}


def test_readers_see_commits_whole(spark, marts):
    days = DAYS[:3]
    assert marts.commit() == (0, {})
    first = marts.publish({"a": (rows(spark, 1, days), days), "b": (rows(spark, 1, days), days)})
    bound = marts.read("a", first)
    staged = marts.stage("a", rows(spark, 2, days), days)  # a writer that dies after its first table
    assert values(marts.read("a")) == {(d, 1) for d in days}
    with pytest.raises(Exception, match="killed"):
        broken = rows(spark, 2, days).withColumn("n", F.when(F.col("event_date") == days[2], F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("n")))
        marts.publish({"a": (rows(spark, 2, days), days), "b": (broken, days)})
    assert marts.versions() == [first] and values(marts.read("b")) == {(d, 1) for d in days}
    second = marts.add({"a": staged}, first)
    assert values(marts.read("a")) == {(d, 2) for d in days} and values(marts.read("b")) == {(d, 1) for d in days}
    assert values(bound) == {(d, 1) for d in days}
    assert values(marts.read("a", dates=days[:1])) == {(days[0], 2)} and second == first + 1


def test_dates_without_rows_are_published_as_empty(spark, marts):
    marts.publish({"a": (rows(spark, 1, DAYS[:2]), DAYS[:2])})
    marts.publish({"a": (rows(spark, 2, DAYS[:1]), DAYS[:2])})
    assert values(marts.read("a")) == {(DAYS[0], 2)}
    marts.publish({"a": (rows(spark, 2, []), DAYS[:1])})
    assert marts.read("a").count() == 0 and marts.read("a").columns == ["key", "n", "event_date"]
    with pytest.raises(ValueError):
        marts.read("other")


def test_writers_of_other_dates_both_commit_and_of_one_date_one(spark, marts):
    one, other, late = (marts.stage("a", rows(spark, v, d), d) for v, d in ((1, DAYS[:1]), (2, DAYS[1:2]), (3, DAYS[:1])))
    marts.add({"a": one}, 0)
    marts.add({"a": other}, 0)
    with pytest.raises(Conflict):
        marts.add({"a": late}, 0)
    assert values(marts.read("a")) == {(DAYS[0], 1), (DAYS[1], 2)}


def test_vacuum_removes_what_no_kept_commit_names(spark, marts):
    marts.publish({"a": (rows(spark, 1, DAYS[:2]), DAYS[:2])})
    marts.publish({"a": (rows(spark, 2, DAYS[:1]), DAYS[:1])})
    orphan = marts.stage("a", rows(spark, 3, DAYS[:1]), DAYS[:1])
    assert marts.vacuum() == []  # all of it is young
    assert len(marts.vacuum(grace=0.0)) == 2 and marts.versions() == [2]
    assert orphan["dates"][DAYS[0]] not in files.partitions(spark, f"{marts.root}/data/a", "write")
    assert values(marts.read("a")) == {(DAYS[0], 2), (DAYS[1], 1)}


def test_a_file_is_written_once(spark, tmp_path):
    path = f"{tmp_path}/x/1.json"
    assert files.write_new(spark, path, "first") and not files.write_new(spark, path, "second")
    assert files.read_text(spark, path) == "first" and files.names(spark, f"{tmp_path}/x")[-1] == "1.json"
    assert [n for n in files.names(spark, f"{tmp_path}/x") if not n.endswith(".crc")] == ["1.json"]


# ---- Keys ---------------------------------------------------------------------------------


@pytest.fixture
def database(spark, tmp_path):
    tables.create_marts(spark, "state_tests", str(tmp_path / "db"))
    yield "state_tests"
    spark.sql("DROP DATABASE state_tests CASCADE")


def batch_of(spark, *pairs):
    return spark.createDataFrame(list(pairs), "dedup_key string, date string")


def test_keys_of_other_dates_are_seen(spark, database):
    name = keys.create_keys(spark, database, buckets=3)
    keys.replace_keys(batch_of(spark, ("a", DAYS[0]), ("b", DAYS[1])), name, DAYS[:2])
    fresh = keys.unseen(batch_of(spark, ("a", DAYS[2]), ("c", DAYS[2])), name, DAYS[2:3])
    assert key_set(fresh, "dedup_key") == [("c",)]
    again = keys.unseen(batch_of(spark, ("a", DAYS[0]), ("b", DAYS[0])), name, DAYS[:1])
    assert key_set(again, "dedup_key") == [("a",)]
    keys.replace_keys(batch_of(spark, ("z", DAYS[0])), name, DAYS[:2])  # the second date is empty now
    assert key_set(spark.table(name), "dedup_key", "date") == [("z", DAYS[0])]


def test_history_is_not_shuffled(spark, database):
    name = keys.create_keys(spark, database, buckets=6)
    keys.replace_keys(batch_of(spark, *[(f"k{i}", DAYS[i % 3]) for i in range(300)]), name, DAYS[:3])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = batch_of(spark, *[(f"k{i}", DAYS[4]) for i in range(290, 310)])
        fresh = keys.unseen(batch, name, DAYS[4:5])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert fresh.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "hashpartitioning(dedup_key" in plan.split("FileScan")[0] and "Bucketed: true" in plan
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [NOT (date" in plan


# ---- First wins in a stream ---------------------------------------------------------------


def test_the_order_decides_and_not_the_arrival(spark, tmp_path):
    rng = random.Random(6)
    schema = "day timestamp, key string, rank int, name string"
    data = [
        (dt.datetime(2024, 1, d), f"k{rng.randint(0, 12)}", rng.choice([None, 1, 2, 3]), f"n{i}")
        for i in range(240) for d in (1 + i % 4,)
    ]
    last = (dt.datetime(2024, 2, 1), "closing", 0, "n")
    for part in range(6):
        own = [r for i, r in enumerate(data) if i % 6 == part and r[0].day <= 2 + part // 3 * 2]
        if part == 5:
            own += [last]
        late = [r for i, r in enumerate(data) if i % 6 == part and r[0].day > 2 + part // 3 * 2]
        spark.createDataFrame(own + (late if part >= 3 else []), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    given = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    with rocksdb(spark):
        out = first_wins_stream(stream, ["day", "key"], ["rank", "name"], "day")
        store_stream(out, str(tmp_path / "out"), str(tmp_path / "state"), by=None).awaitTermination()
    want = clean.first_per_key(given.filter("key <> 'closing'"), ["day", "key"], [F.asc_nulls_last("rank"), "name"])
    columns = ["day", "key", "rank", "name"]
    assert key_set(spark.read.parquet(str(tmp_path / "out")), *columns) == key_set(want, *columns)


# ---- Token budgets ------------------------------------------------------------------------


def test_batches_keep_their_budget():
    rng = random.Random(7)
    lengths = [rng.choice([0, 1, 5, 40, 64, 900]) for _ in range(300)]
    batches = scoring.token_batches(lengths, 256)
    assert sorted(i for b in batches for i in b) == list(range(300))
    for b in batches:
        assert len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 256
    assert scoring.token_batches([], 10) == []


def test_long_texts_are_scored_whole_and_failures_apart(spark):
    def factory():
        def score(windows):
            if len(windows) * max(map(len, windows)) > 40:
                raise MemoryError("batch above its budget")
            if any("bad" in w for w in windows):
                raise ValueError("bad word")
            return np.array([[w.count("up") / max(len(w), 1), w.count("down") / max(len(w), 1), 0.0] for w in windows])

        return scoring.TokenModel(lambda text: text.split(), score)

    texts = ["up " * 25 + "down " * 10, "up", "a bad one", None, "", "down " * 8, "x " * 11 + "bad"] + ["up down"] * 30
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    out = {r["id"]: r for r in scoring.score_in_budget(df, factory, max_tokens=10, batch_tokens=40).collect()}
    assert out[0]["prob_positive"] == pytest.approx(25 / 35) and out[0]["n_tokens"] == 35
    assert [out[i]["score_error"] for i in (2, 6)] == ["ValueError: bad word"] * 2
    assert all(out[2][c] is None for c in ("prob_positive", "sentiment_label", "sentiment_score"))
    assert all(out[i]["score_error"] is None for i in out if i not in (2, 6))
    assert out[5]["sentiment_label"] == "negative" and out[3]["n_tokens"] == 0


# ---- Sketches, history of metrics, status -------------------------------------------------


def test_sketches_merge_over_days_and_industries(spark):
    data = [(f"c{i}", "xy"[i % 2], DAYS[i % 5], 1) for i in range(4000)] + [("c0", "x", DAYS[3], 1), (None, "x", DAYS[0], 1)]
    mart = spark.createDataFrame(data, "company_name string, industry string, event_date string, mention_count int")
    sketches = aggregate.company_sketches(mart)
    for pick, exact in (({}, 4000), ({"industries": ["x"]}, 2000), ({"end": DAYS[1], "industries": ["y"]}, 800)):
        row = report.sketched_companies(report.apply_facets(sketches, **pick)).first()
        assert abs(row["estimated"] - exact) <= 3 * aggregate.SKETCH_ERROR * exact
    assert report.sketched_companies(sketches.limit(0)).first()["estimated"] == 0


def test_days_that_fall_behind_are_flagged(spark):
    metrics = [("clean", "rows", d, float(v)) for d, v in zip(DAYS, [10, 10, 12, 8, 10, 9, 4, 0, 11])]
    df = spark.createDataFrame(metrics, "table string, metric string, date string, value double")
    out = quality.against_trailing(df, DAYS[3:9], quality.Expected(trailing=5, at_least=4)).orderBy("date").collect()
    assert [r["ok"] for r in out] == [True, True, True, False, False, True]
    assert out[3]["mean"] == pytest.approx(9.8)
    quiet = quality.with_quiet_days(df.limit(0), [("clean", "rows")], DAYS[:2]).collect()
    assert [(r["date"], r["value"]) for r in sorted(quiet)] == [(DAYS[0], 0.0), (DAYS[1], 0.0)]


def test_the_last_attempt_is_the_status_of_a_date(spark):
    log = [(DAYS[0], "failed", 0, 1), (DAYS[0], "success", 5, 2), (DAYS[1], "success", 5, 1), (DAYS[1], "failed", 0, 2), (DAYS[2], "success", 1, 1)]
    runs = spark.createDataFrame([(*r[:3], "", r[3]) for r in log], "run_date string, status string, articles_processed int, errors string, attempt int")
    out = [(r["run_date"], r["status"]) for r in report.latest_runs(runs, 2).collect()]
    assert out == [(DAYS[2], "success"), (DAYS[1], "failed")]
    assert report.latest_runs(runs).collect()[-1]["status"] == "success"


# ---- Array files --------------------------------------------------------------------------


def array_text(records, broken, indent):
    lines = json.dumps(records, indent=indent, ensure_ascii=False).split("\n")
    if broken:
        at = next(i for i in range(len(lines) // 2, len(lines)) if lines[i].startswith(" " * indent + "{"))
        lines[at:at] = [" " * indent + '{ "title": not json,', " " * indent + "}, oh"]
    return "\n".join(lines)


@pytest.mark.parametrize("size", [900, 1 << 20])
def test_array_files_are_cut_at_records(spark, tmp_path, size):
    rng = random.Random(8)
    records = [
        {"title": f"t{i} " + "{[\\n]} " * rng.randint(0, 6), "url": rng.choice([None, "http://x/é"]), "date": "2024-01-01",
         "extra": {"a": [{"b": i}, {}], "c": "}"}, "content": "x" * rng.choice([0, 3, 900])}
        for i in range(40)
    ]
    for name, text in (("a", array_text(records, True, 2)), ("b", json.dumps(records)), ("c", "[]"), ("d", ""), ("e", "[\n" + ",\n".join(map(json.dumps, records)) + "\n]")):
        (tmp_path / f"news_{name}.json").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        rows = arrays.read_array_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name in "abe":
        own = [r for r in rows if r["_file"].endswith(f"news_{name}.json")]
        good = [(r["title"], r["url"], r["content"]) for r in own if r["_corrupt_record"] is None]
        assert sorted(good, key=str) == sorted([(r["title"], r["url"], r["content"]) for r in records], key=str), name
        assert [r["_corrupt_record"].split() for r in own if r["_corrupt_record"] is not None] == (
            [["{", '"title":', "not", "json,", "},", "oh"]] if name == "a" else []
        )
    assert not [r for r in rows if r["_file"][-6] in "cd"]


def test_small_blocks_share_tasks_and_borders_are_scanned_once(spark, tmp_path):
    records = [{"title": f"t{i}", "content": "x" * (i % 7 * 300)} for i in range(200)]
    for name in "ab":
        (tmp_path / f"news_{name}.json").write_text(array_text(records, False, 2))
    context, key = spark.sparkContext, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700")
    context.setJobGroup("small-blocks", "")
    try:
        rows = arrays.read_array_files(spark, str(tmp_path))
        found = sorted((r["_file"][-6], r["title"], r["content"]) for r in rows.collect())
    finally:
        spark.conf.set(key, before)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found == sorted((name, r["title"], r["content"]) for name in "ab" for r in records)
    told = context.statusTracker()
    stages = {s for job in told.getJobIdsForGroup("small-blocks") for s in told.getJobInfo(job).stageIds}
    assert 1 < max(told.getStageInfo(s).numTasks for s in stages) <= 20
    final = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan text") == 2
