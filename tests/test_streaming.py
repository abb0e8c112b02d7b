import os
import shutil

import pytest
from pyspark.sql import functions as F

from newsloom.operators import corpus
from newsloom.plans.queries import QUERIES
from newsloom.streaming import events as S


@pytest.fixture
def folder(spark, sf, tmp_path):
    (tmp_path / "in").mkdir()
    shutil.copy(f"{sf}/events.parquet", tmp_path / "in" / "e.parquet")
    return str(tmp_path / "in")


@pytest.fixture
def events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


@pytest.mark.parametrize("form", [S.tumbling, S.sliding])
def test_closed_windows_are_the_batch_ones(form, spark, folder, events):
    got = {tuple(r) for r in S.run_to_end(form(S.read_events(spark, folder, events.schema)), form.__name__).collect()}
    want = {tuple(r) for r in form(events).collect()}
    assert got and got <= want
    assert want - got == {w for w in want if w[0] >= min(x[0] for x in want - got)}  # only the last ones are open


def test_sessions(spark, folder, events):
    got = {tuple(r) for r in S.run_to_end(S.sessions(S.read_events(spark, folder, events.schema)), "sess").collect()}
    assert got and got <= {tuple(r) for r in S.sessions(events).collect()}


@pytest.mark.parametrize("name, form", [("stream_tumbling_counts", S.tumbling), ("stream_sliding_counts", S.sliding), ("stream_sessions", S.sessions)])
def test_queries_count_every_event(name, form, spark, sf, events, tmp_path):
    """Open windows too, and rows of a later file that are older than those of the one before."""
    for k, rows in enumerate(["ts >= '2024-01-03'", "ts < '2024-01-03'"]):
        days = events.withColumn("ts", F.timestamp_add("DAY", F.col("event_id") % 6, F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")))
        days.where(rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    got = QUERIES[name](spark, str(tmp_path)).collect()
    want = form(spark.read.parquet(str(tmp_path / "events.parquet"))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == len(set(map(tuple, got)))
    assert sum(r["n"] for r in got) == events.count() * (2 if name == "stream_sliding_counts" else 1)


def test_dedup(spark, folder, events):
    got = S.run_to_end(S.deduplicated(S.read_events(spark, folder, events.schema), "user_id", late="60 days"), "dedup")
    assert got.count() == events.select("user_id").distinct().count()


def test_upsert_of_batches(spark, tmp_path):
    schema = "seq long, LINK string, TITLE string, SOURCE string"
    rows = [[(1, "http://a", "A", "s"), (2, "", "B", "s")], [(1, "http://A", "A2", "s"), (2, "http://c", "C", "s")]]
    for k, r in enumerate(rows):
        spark.createDataFrame(r, schema).coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
    (tmp_path / "all").mkdir()
    for k in range(2):
        part = next((tmp_path / f"in{k}").glob("part-*"))
        shutil.copy(part, tmp_path / "all" / f"{k}.parquet")
        os.utime(tmp_path / "all" / f"{k}.parquet", (1000 + k, 1000 + k))  # files come in the order of their times
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "all"))
    merge = lambda old, new: corpus.upsert(old, new, corpus.link_or_title_key()).drop("_gen")
    S.upsert_each_batch(stream, str(tmp_path / "out"), merge, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "v1"))
    assert sorted(r["TITLE"] for r in got.collect()) == ["A", "B", "C"]
    assert got.where(F.col("TITLE") == "A2").count() == 0
