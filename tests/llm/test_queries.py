"""The registered queries: SQL twins, plain versions, plans and the pipeline."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsignal.llm.queries import ORACLES, QUERIES

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.collect(), df.columns) == table(cursor.fetchall(), columns)


def test_ring_query(spark):
    out = QUERIES["op1_ring_shards"](spark, SF).toPandas()
    sizes = out.groupby("shard").size()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 1 and set(out["law"]) == {"rows"}


def test_pack_query(spark, duck):
    from tokenizers import Tokenizer

    from newsignal.llm.queries import vocabulary

    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    out = QUERIES["op9_pack"](spark, SF).toPandas()
    got = sorted(out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
    assert got == sorted(brute.pieces(docs, Tokenizer.from_file(vocabulary()), 4096))
    assert out["sequence_id"].nunique() <= 1.05 * out["length"].sum() / 4096 + 1


def test_main_text_query(spark, duck):
    """The pages hold one article each, so a few patterns cut it out."""
    import html
    import re

    out = {r["page_id"]: r["text"] for r in QUERIES["op5_main_text"](spark, SF).collect()}
    for page_id, source in duck.execute("SELECT page_id, html FROM pages").fetchall():
        body = source.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)>", body)
        text = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert out[page_id] == "\n".join(t for t in text if t), page_id


def test_rules_stay_native(spark):
    from newsignal.llm.host_rules import measures

    df = measures(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_line_dedup_shuffles_each_text_once(spark):
    from newsignal.llm.line_dedup import drop_common_lines

    df = drop_common_lines(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def plain_pipeline(docs):
    """The documents that reach packing, before mixing: (doc_id, text)."""
    rows = [(d, t) for d, t in docs if not brute.measures(t)[-1]]
    rows = [(r[0], r[4]) for r in brute.drop_lines(rows, 10)]
    return [(d, t) for (d, t), (_, _, c, _) in zip(rows, brute.similar(rows, 5, 80)) if c == d]


def test_pipeline(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outs = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        outs.append(docs)
    assert all(o.columns == columns for o in outs[:-1])
    raw = duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    want = plain_pipeline(raw)
    assert sorted(map(tuple, outs[2].select("doc_id", "text").collect())) == sorted(want)
    mixed = {r["doc_id"] for r in outs[3].select("doc_id").collect()}
    assert mixed < {d for d, _ in want} and len(mixed) > len(want) / 4
    assert {r["doc_id"] for r in outs[4].collect()} == mixed
    lengths = outs[4].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert lengths.agg(F.max("n")).first()[0] <= 4096


def test_run_writes_every_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]
