"""Queries whose largest task, and whose shuffled and written bytes, keep to their input."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsignal.plans import catalog_runs, catalog_state, driver_tables as d
from newsignal.plans.catalog import QUERIES
from newsignal.sources.snapshots import Snapshots
from newsignal.streaming import ingest


@pytest.fixture(scope="module")
def tables_dir(spark, tmp_path_factory):
    """Documents, some twice and one without an id, and events of a month."""
    base = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, f"thtion {i % 40} title\nEriner thanea by-nc rates {i % 7}", "de" if i % 4 else "en", "web") for i in range(200)]
    docs += [docs[3], (None, "attion\nwithout an id", "en", "web")]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(docs, schema).write.parquet(f"{base}/documents.parquet")
    events = [(i, i % 20, f"2024-01-{1 + i % 30:02d} 10:00:00", "view", float(i % 9)) for i in range(300)]
    spark.createDataFrame(events, "event_id long, user_id long, ts string, event_type string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp")
    ).write.parquet(f"{base}/events.parquet")
    return base


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_streamed_day_files_keep_the_date_of_their_folder(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        folder = tmp_path / "raw" / f"date={day}"
        folder.mkdir(parents=True)
        lines = [json.dumps({"title": f"{day} {i}"}) for i in range(50)] + ["{ not json"]
        (folder / "part-0.json").write_text("\n".join(lines))
    raw, good, bad = (str(tmp_path / name) for name in ("raw", "good", "bad"))
    stream = ingest.article_stream(spark, raw, "part-*", multi_line=False)
    for running in ingest.store_articles(stream, good, bad, str(tmp_path / "state"), files=3, tasks=8):
        running.awaitTermination()
    found = spark.read.parquet(good).groupBy(F.col("date").cast("string")).count()
    assert rows_of(found) == ["Row(date='2024-01-01', count=50)", "Row(date='2024-01-02', count=50)"]
    assert all(1 < len(list(p.glob("*.parquet"))) <= 3 for p in Path(good).glob("date=*"))
    assert spark.read.parquet(bad).count() == 2


def test_tasks_and_files_of_a_stream_follow_its_input(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_text("x" * 1000)
    assert ingest.worth(spark, str(tmp_path)) == {"files": 1, "tasks": 1}
    monkeypatch.setattr(ingest, "FILE_BYTES", 10)
    monkeypatch.setattr(ingest, "TASK_BYTES", 100)
    assert ingest.worth(spark, str(tmp_path)) == {"files": 4, "tasks": 11}


def test_hits_are_multiplied_behind_the_shuffle_and_written_compressed(spark, tables_dir):
    raw = Path(catalog_runs.raw_day_files(spark, tables_dir))
    assert list(raw.glob("date=*/*.json.gz")) and not list(raw.glob("date=*/*.json"))
    plan = d.hits(spark, tables_dir, by_date=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Rebalance")
    assert rows_of(d.hits(spark, tables_dir, by_date=True)) == rows_of(d.hits(spark, tables_dir))


def test_first_wins_hits_lie_in_as_many_files_as_they_are_worth(spark, tables_dir, monkeypatch):
    dealt, write = [], catalog_state.ingest.worth
    monkeypatch.setattr(catalog_state, "HITS_BYTES", 1000)
    monkeypatch.setattr(
        catalog_state.ingest, "worth", lambda spark, path: dealt.append(len(list(Path(path).glob("*.parquet")))) or write(spark, path)
    )
    found = QUERIES["stream_first_wins"](spark, tables_dir)
    assert rows_of(found) == rows_of(QUERIES["first_wins"](spark, tables_dir).select(*found.columns))
    assert dealt[0] > 10


def test_arrays_are_dealt_over_files(spark, tables_dir, monkeypatch):
    monkeypatch.setattr(catalog_state, "ARRAY_BYTES", 2000)
    seen, read = [], catalog_state.arrays.read_array_files
    monkeypatch.setattr(catalog_state.arrays, "read_array_files", lambda spark, path, pattern: seen.append(path) or read(spark, path, pattern))
    found = QUERIES["array_file_split"](spark, tables_dir)
    texts = [p.read_text() for p in Path(seen[0]).glob("*.txt")]
    assert len(texts) > 2 and all(t.rstrip().endswith("]") for t in texts)
    assert found.filter("not broken").count() == 202 and found.filter("broken").count() == 4


def test_publications_read_stored_marts(spark, monkeypatch):
    sources, publish = set(), Snapshots.publish

    def spied(self, frames, *rest):
        sources.update(f for df, _ in frames.values() for f in df.inputFiles())
        return publish(self, frames, *rest)

    monkeypatch.setattr(Snapshots, "publish", spied)
    QUERIES["publish_atomic"](spark, "/root/testdata/sf0.001")
    assert sources and not [f for f in sources if "/root/testdata" in f]


def test_runs_of_a_month_read_stored_inputs(spark, tables_dir, monkeypatch):
    sources = []
    monkeypatch.setattr(
        catalog_runs, "run_day",
        lambda spark, inputs, *rest, **more: sources.append({*inputs.articles.inputFiles(), *inputs.closes.inputFiles()}),
    )
    catalog_runs.rerun_month(spark, tables_dir)
    catalog_runs._runs.clear()
    assert len(sources) == 9 and not [f for files in sources for f in files if tables_dir in f]
