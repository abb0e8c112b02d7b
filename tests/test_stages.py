import math

import pytest
from pyspark.sql import functions as F

from newsloom.functions.sentiment import Lexicon
from newsloom.plans.queries import QUERIES
from newsloom.schemas import ARTICLE
from newsloom.sources.stages import read_articles, read_files, write_stage


def test_csv_articles(spark, tmp_path):
    (tmp_path / "a.csv").write_text('risk_id,TITLE,SENTIMENT_COMPOUND,extra\n3,"A, ""b""\nc",0.5,x\nx,D,,y\n')
    rows = read_articles(spark, str(tmp_path / "a.csv")).orderBy("TITLE").collect()
    assert [(r["RISK_ID"], r["TITLE"], r["SENTIMENT_COMPOUND"], r["extra"], r["LINK"]) for r in rows] == [(3, 'A, "b"\nc', 0.5, "x", None), (None, "D", None, "y", None)]


def test_stage_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01", [1, 2]), (2, "2024-02", [])], "RISK_ID int, month string, RISK_IDS array<int>")
    write_stage(df, str(tmp_path / "p"), by_month="month")
    assert (tmp_path / "p" / "month=2024-01").exists()
    plan = spark.read.parquet(str(tmp_path / "p")).where("month = '2024-01'")
    assert plan.count() == 1 and "PartitionFilters: [isnotnull(month" in plan._jdf.queryExecution().executedPlan().toString()
    write_stage(df, str(tmp_path / "c"), csv=True)
    assert sorted(r["RISK_IDS"] or "" for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()) == ["", "1, 2"]
    write_stage(read_articles(spark, str(tmp_path / "p")), str(tmp_path / "q"))
    assert read_articles(spark, str(tmp_path / "q")).columns[:13] == ARTICLE.fieldNames()


def test_csv_stage_keeps_quotes_breaks_and_edges(spark, tmp_path):
    rows = [(1, 'He said "no", twice', 'a\nb "c"\\d'), (2, 'ends with "', " x,\"y\",z\t"), (3, "it's", "\\")]
    write_stage(spark.createDataFrame(rows, "RISK_ID int, TITLE string, SUMMARY string"), str(tmp_path / "s.csv"), csv=True)
    got = read_articles(spark, str(tmp_path / "s.csv")).select("RISK_ID", "TITLE", "SUMMARY").collect()
    assert sorted(map(tuple, got)) == rows


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"text of a")
    (tmp_path / "b.pdf").write_bytes(b"\xff")
    (tmp_path / "c.txt").write_bytes(b"no")
    got = {r["name"]: r["text"] for r in read_files(spark, str(tmp_path), lambda b: b.decode(), "*.pdf").collect()}
    assert got == {"a.pdf": "text of a", "b.pdf": ""}


def test_lexicon_query(spark, sf):
    known = Lexicon()
    stems = ("great growth in ", "no fraud at ", "very BAD losses of ", "plain ")
    want = {r["p_partkey"]: round(known.compound(stems[r["p_size"] % 4] + r["p_name"]), 4) for r in spark.read.parquet(f"{sf}/part.parquet").collect()}
    assert {r["p_partkey"]: r["compound"] for r in QUERIES["lexicon_sentiment"](spark, sf).collect()} == want


def test_embeddings_and_clusters(spark, sf):
    sums = QUERIES["hashed_embeddings"](spark, sf).groupBy("item_id").agg(F.sum(F.col("v") * F.col("v")).alias("s")).collect()
    assert all(math.isclose(r["s"], 1, abs_tol=0.01) for r in sums)
    one, two = ({tuple(r) for r in QUERIES["topic_clusters"](spark, sf).collect()} for _ in range(2))
    assert one == two and {t for _, t in one} <= set(range(-1, 8))


def test_entities_query(spark, sf):
    row = QUERIES["entity_enrichment"](spark, sf).first()
    assert "Exchange Act of 1934" in row["entities"].split("|") and "acme bank" in row["keywords"]


@pytest.mark.parametrize("name", ["topic_clusters", "hashed_embeddings", "action_split", "factor_split", "distinct_keywords"])
def test_queries_without_sql_have_rows(name, spark, sf):
    assert QUERIES[name](spark, sf).limit(1).count() == 1
