"""Tables in parts, and trends kept batch by batch, against the batch forms."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from newsloom.operators import trends
from newsloom.streaming import events as S
from newsloom.streaming import parts as P
from newsloom.streaming import trends as T

KEYED = "k string, v long, gone boolean"


def files(spark, tmp_path, batches, schema):
    """A stream of one file a batch."""
    (tmp_path / "in").mkdir(exist_ok=True)
    for k, rows in enumerate(batches):
        if not (tmp_path / "in" / f"{k}.parquet").exists():
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "one"))
            shutil.copy(next((tmp_path / "one").glob("part-*")), tmp_path / "in" / f"{k}.parquet")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def last_wins(old, new):
    """Rows of the batch replace older ones of their key; those marked gone delete theirs."""
    return old.join(new.select("k"), "k", "left_anti").unionByName(new.where("not gone"))


def run(spark, tmp_path, batches, parts=4):
    for n in range(1, len(batches) + 1):  # one batch a run, so that their order is that of the list
        S.upsert_parts(files(spark, tmp_path, batches[:n], KEYED), str(tmp_path / "out"), last_wins, F.col("k"), str(tmp_path / "cp"), parts).awaitTermination()
    return {r["k"]: r["v"] for r in S.read_parts(spark, str(tmp_path / "out"), len(batches) - 1, KEYED).collect()}


def test_deletes_are_kept(spark, tmp_path):
    assert run(spark, tmp_path, [[("a", 1, False), ("b", 2, False), ("c", 3, False)], [("a", 0, True)], [("b", 9, False), ("zz", 0, True)]], parts=16) == {"b": 9, "c": 3}


def test_all_gone_and_back(spark, tmp_path):
    assert run(spark, tmp_path, [[("a", 1, False)], [("a", 0, True)], [("a", 5, False)]]) == {"a": 5}


def test_old_parts_are_removed(spark, tmp_path):
    run(spark, tmp_path, [[(f"{k}", b, False) for k in range(40)] for b in range(4)], parts=3)
    left = sorted(p.name for p in (tmp_path / "out" / "parts").glob("*/v*"))
    assert set(left) == {"v2", "v3"} and sorted(p.name for p in (tmp_path / "out" / "versions").iterdir()) == ["2", "3"]


def test_a_rename_that_fails_is_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "a").mkdir()
    real = P._path

    class Refuses:
        def __init__(self, system):
            self.system = system

        def __getattr__(self, name):
            return (lambda *_: False) if name == "rename" else getattr(self.system, name)

    monkeypatch.setattr(P, "_path", lambda spark, path: (Refuses(real(spark, path)[0]), real(spark, path)[1]))
    with pytest.raises(OSError, match="could not be renamed"):
        P.move(spark, str(tmp_path / "a"), str(tmp_path / "b"))


ARTICLES = "RISK_ID int, TOPIC_ID int, month string, SENTIMENT string, SENTIMENT_COMPOUND double"


def articles(rng, n, months):
    return [(rng.choice([1, 2, 3, None]), rng.choice([-1, *range(12)]), rng.choice(months), rng.choice(["Negative", "Positive", None]), rng.choice([None, round(rng.uniform(-1, 1), 4)])) for _ in range(n)]


def same(got, want):
    assert got.columns == want.columns or set(got.columns) == set(want.columns)
    order = sorted(got.columns)
    assert sorted(map(str, got.select(order).collect())) == sorted(map(str, want.select(order).collect()))


def test_trends_of_batches_are_those_of_everything(spark, tmp_path):
    """Late articles, months seen for the first time at either end, topics that come later, a batch of nothing."""
    rng = random.Random(5)
    months = [f"2024-{m:02}" for m in range(1, 13)]
    batches = [articles(rng, 300, months[3:8]), articles(rng, 5, months[3:8]), articles(rng, 200, months[5:11]), [(1, -1, "2024-05", "Negative", 0.1), (1, 3, None, "Negative", 0.1)], articles(rng, 60, months)]
    path, seen, again = str(tmp_path / "t"), [], []
    for n, rows in enumerate(batches):
        seen += rows
        again.append(T.add_batch(spark, path, n, spark.createDataFrame(rows, ARTICLES), count=8))
        whole = spark.createDataFrame(seen, ARTICLES)
        for got, want in zip(T.read_trends(spark, path, n), trends.build_trends(whole), strict=True):
            kinds = dict(want.dtypes)
            same(got.select(*[F.col(c).cast(kinds[c]).alias(c) for c in got.columns]), want)
    # Only what a batch touches is made anew, unless a month is new.
    assert len(again[1]) <= 5 < len(again[0]) and again[3] == [] and len(again[4]) == len(again[0])
    assert T.last_version(spark, path) == 4


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    rng = random.Random(6)
    first, second = (spark.createDataFrame(articles(rng, 80, ["2024-01", "2024-02"]), ARTICLES) for _ in range(2))
    path = str(tmp_path / "t")
    for n, rows in ((0, first), (1, second), (1, second)):
        T.add_batch(spark, path, n, rows, count=4)
    same(T.read_trends(spark, path, 1)[0].select("TOPIC_ID", "month", "volume"), trends.topic_months(first.unionByName(second)).select("TOPIC_ID", "month", "volume"))
    with pytest.raises(FileNotFoundError, match="version before"):
        T.add_batch(spark, path, 5, first, count=4)


def test_trends_of_a_stream(spark, tmp_path):
    rng = random.Random(7)
    batches = [articles(rng, 50, ["2024-01", "2024-02", "2024-03"]) for _ in range(3)]
    T.keep_trends(files(spark, tmp_path, batches, ARTICLES), str(tmp_path / "t"), str(tmp_path / "cp"), count=4).awaitTermination()
    whole = spark.createDataFrame([r for b in batches for r in b], ARTICLES)
    n = T.last_version(spark, str(tmp_path / "t"))
    same(T.read_trends(spark, str(tmp_path / "t"), n)[0].select("TOPIC_ID", "month", "intensity"), trends.topic_months(whole).select("TOPIC_ID", "month", "intensity"))
