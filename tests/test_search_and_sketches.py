"""Substring search by index, distinct counts by sketches, embeddings by corpus statistics."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import report, search, sketches
from newsloom.sources import embeddings as E
from newsloom.sources.cache import read_cache

CARDS = "TOPIC_ID int, TITLE string, KEYWORDS string"


@pytest.fixture(scope="module")
def cards(spark):
    rng = random.Random(1)
    words = ["fraud", "Freight", "rate", "crate", "überfall", "data", "100%", "a_b", "ran", "somware"]
    rows = [(k, " ".join(rng.choices(words, k=4)), None if k % 11 == 0 else "".join(rng.choices(words, k=2))) for k in range(-1, 120)]
    return spark.createDataFrame([*rows, (500, None, None), (501, "", "")], CARDS)


@pytest.mark.parametrize("query", ["fraud", "RATE", "ate", "überf", "topic 5", "topic 500", "no such words", "a", "", " % ", "a_b", "ransom", "fraud fraud", "somwareran"])
def test_search_equals_the_scan(spark, cards, tmp_path_factory, query):
    path = str(tmp_path_factory.getbasetemp() / "index")
    if not (tmp_path_factory.getbasetemp() / "index").exists():
        search.write_index(cards, path, ["TITLE", "KEYWORDS"])
    got = sorted(r["TOPIC_ID"] for r in search.find_cards(cards, path, query).collect())
    assert got == sorted(r["TOPIC_ID"] for r in report.search(cards, query, ["TITLE", "KEYWORDS"]).collect())


def test_search_reads_its_own_postings_only(spark, cards, tmp_path):
    search.write_index(cards, str(tmp_path), ["TITLE", "KEYWORDS"])
    plan = search.find(spark, str(tmp_path), "überfall data")._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[[^\]]*In\(gram, ?\[([^\]]*)", plan)
    assert pushed and set(pushed[1].split(",")) <= set(search.query_grams("überfall data")) and len(pushed[1].split(",")) == search.RAREST


def test_sketches_merge(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 3), f"2024-{rng.randint(1, 6):02}", rng.choice([None, rng.randint(0, 900), rng.randint(0, 90)])) for _ in range(9000)]
    df = spark.createDataFrame(rows, "TOPIC_ID int, month string, DUP_GROUP long")
    parts = [sketches.monthly(df.where(F.pmod(F.xxhash64("DUP_GROUP", "month"), F.lit(3)) == k)) for k in range(3)]
    stored = sketches.merged(sketches.merged(parts[0], parts[1]), parts[2])
    for got, want in (
        (sketches.distinct_counts(stored, "TOPIC_ID"), df.groupBy("TOPIC_ID")),
        (sketches.distinct_counts(stored, "month"), df.groupBy("month")),
        (sketches.distinct_counts(stored, "TOPIC_ID", first="2024-02", last="2024-03"), df.where("month between '2024-02' and '2024-03'").groupBy("TOPIC_ID")),
    ):
        exact = {r[0]: r["n"] for r in want.agg(F.count_distinct("DUP_GROUP").alias("n")).collect()}
        about = {r[0]: r["n"] for r in got.collect()}
        assert set(about) == set(exact) and all(abs(about[k] - n) <= max(1, sketches.error() * n) for k, n in exact.items())
    whole, dealt = (dict(map(tuple, sketches.distinct_counts(x, "TOPIC_ID").collect())) for x in (sketches.monthly(df), stored))
    assert all(abs(whole[k] - dealt[k]) <= sketches.error() * whole[k] for k in whole)


TEXTS = [("a", "Rates rise, rates fall"), ("b", "rates and fraud"), ("c", "fraud! Fraud? FRAUD 42"), ("d", ""), ("e", None), ("f", "rates")]


def test_statistics_are_kept_and_versioned(spark, tmp_path):
    stats, cache = str(tmp_path / "stats"), str(tmp_path / "cache")
    texts = spark.createDataFrame(TEXTS, "key string, text string")
    assert E.latest(spark, stats) == (0, 0)
    assert E.add_documents(texts.where("key < 'd'"), stats) == 1 and E.add_documents(texts.where("key >= 'd'"), stats) == 2
    assert E.latest(spark, stats) == (2, 6)
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    df = Counter(w for _, t in TEXTS for w in set(words(t)))
    assert {r["word"]: r["df"] for r in E.frequencies(spark, stats, 2).collect()} == df
    got = {(r["key"], r["word"]): r["weight"] for r in E.weights(texts, stats, 2).collect()}
    want = {(k, w): (1 + math.log(n)) * math.log(7 / (1 + df[w])) for k, t in TEXTS for w, n in Counter(words(t)).items()}
    assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-9 for x in want)

    out = {r["key"]: np.array(r["vector"]) for r in E.embedded(texts.select(F.col("key").alias("name"), "text"), stats, cache).withColumn("key", F.col("name")).collect()}
    assert all(len(v) == E.SIZE for v in out.values()) and not out["d"].any() and not out["e"].any()
    assert all(abs(np.linalg.norm(out[k]) - 1) < 1e-5 for k in "abcf")
    held = read_cache(spark, cache, "key string, vector array<float>").count()
    E.embedded(texts.select("text"), stats, cache).collect()
    assert read_cache(spark, cache, "key string, vector array<float>").count() == held  # all known
    E.add_documents(texts.limit(1), stats)
    E.embedded(texts.select("text"), stats, cache).collect()
    assert read_cache(spark, cache, "key string, vector array<float>").count() > held  # a new version knows nothing yet


def test_projection_keeps_cosines(spark):
    rng = random.Random(5)
    rows = [(f"k{k}", f"w{rng.randint(0, 60)}", rng.uniform(0.5, 3)) for k in range(12) for _ in range(20)]
    df = spark.createDataFrame(rows, "key string, word string, weight double").groupBy("key", "word").agg(F.sum("weight").alias("weight"))
    full = {}
    for r in df.collect():
        full.setdefault(r["key"], {})[r["word"]] = r["weight"]
    made = {r["key"]: np.array(r["vector"], float) for r in E.projected(df, 512).collect()}
    cosine = lambda a, b: sum(v * b.get(w, 0) for w, v in a.items()) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    assert all(abs(made[a] @ made[b] - cosine(full[a], full[b])) < 0.2 for a in full for b in full)


def test_search_packs_postings(spark, tmp_path, monkeypatch):
    # Characters beyond 16 bits are one letter, cards of one id are searched together, a list is closed when it is full.
    monkeypatch.setattr(search, "PACKED", 30)
    cards = spark.createDataFrame([(1, "a😀b fraud", None), (1, "rate", ""), (2, "😀bc", "fraud rate"), (3, "", "ab"), (4, None, "fraud")], CARDS).repartition(1)
    search.write_index(cards, str(tmp_path), ["TITLE", "KEYWORDS"])
    lists = spark.read.parquet(f"{tmp_path}/postings")
    assert lists.count() < lists.select(F.explode("cards")).count()
    for query, want in (("a😀b", [1]), ("😀bc", [2]), ("fraud", [1, 2, 4]), ("rate", [1, 2]), ("topic 3", [3])):
        assert sorted(r["TOPIC_ID"] for r in search.find(spark, str(tmp_path), query).collect()) == want
