import json

from pyspark.sql import functions as F

from newsloom.cli import main
from newsloom.sources import taxonomy

DIGEST = "Markets\n" + "\n".join(
    f"Reuters, March {d}, 2024\n{title} number {d}\nBy A Clerk\n{text} " + "It went on for a long while with many words in it. " * 4 + "\nRead article online\n"
    for d, (title, text) in enumerate([("Bank fraud probe", "A bank fraud scheme was found."), ("Cyber attack hits broker", "A ransomware attack stopped trading."), ("Rates rise again", "Growth was great and strong.")] * 5, 1)
)


def test_stages_from_digest_to_payload(spark, tmp_path):
    t = str(tmp_path)
    (tmp_path / "d.txt").write_text(DIGEST)
    codes = [(1, 1, "bank fraud"), (1, 2, "fraud scheme"), (2, 1, "cyber attack"), (2, 2, "ransomware")]
    (tmp_path / "tax.csv").write_text("ID,TERM,ENCODED\n" + "\n".join(f"{r},{n},{taxonomy.encode_text(x)}" for r, n, x in codes))
    main(["ingest", "--raw", "--input", f"{t}/d.txt", "--out", f"{t}/corpus"], spark)
    rows = spark.read.parquet(f"{t}/corpus")
    assert rows.count() == 15 and sorted(r["GOOGLE_INDEX"] for r in rows.collect()) == list(range(15))
    main(["ingest", "--raw", "--input", f"{t}/d.txt", "--corpus", f"{t}/corpus", "--out", f"{t}/corpus2"], spark)
    assert spark.read.parquet(f"{t}/corpus2").count() == 15

    spark.read.parquet(f"{t}/corpus").withColumn("RISK_ID", (F.col("GOOGLE_INDEX") % 2 + 1).cast("int")).write.parquet(f"{t}/articles")
    main(["topics", "--input", f"{t}/articles", "--work", f"{t}/work", "--out", f"{t}/topics", "--nr-topics", "3", "--taxonomy", f"{t}/tax.csv", "--cut", "2"], spark)
    placed, summary = spark.read.parquet(f"{t}/topics/articles"), spark.read.parquet(f"{t}/topics/summary")
    assert placed.count() == 15 and summary.agg(F.sum("ARTICLE_COUNT")).first()[0] == 15
    titles = [r["TOPIC_TITLE"] for r in summary.collect()]
    assert len(set(titles)) == len(titles) and all(r["TOPIC_DESCRIPTION"].startswith("Coverage of ") and "Linked to " in r["TOPIC_DESCRIPTION"] for r in summary.collect())

    main(["trends", "--input", f"{t}/topics/articles", "--out", f"{t}/trends"], spark)
    assert spark.read.parquet(f"{t}/trends/months").agg(F.sum("volume")).first()[0] == 15
    main(["gaps", "--input", f"{t}/topics/articles", "--taxonomy", f"{t}/tax.csv", "--out", f"{t}/gaps", "--min-quality", "0"], spark)
    assert spark.read.parquet(f"{t}/gaps").count() == summary.count()
    main(["discover", "--input", f"{t}/topics/articles", "--taxonomy", f"{t}/tax.csv", f"{t}/tax.csv", "--source", "EMAIL", "--out", f"{t}/found", "--min-quality", "0"], spark)
    assert {r["tier"] for r in spark.read.parquet(f"{t}/found").collect()} <= {"meaningful", "benign"}
    main(["status", "--input", f"{t}/trends/by_risk", "--out", f"{t}/status"], spark)
    assert {r["status"] for r in spark.read.parquet(f"{t}/status").collect()} == {"Quiet"}
    main(["payload", "--input", f"{t}/topics/articles", "--summary", f"{t}/topics/summary", "--out", f"{t}/payload"], spark)
    cards = [json.loads(r["json"].replace("<\\/", "</")) for r in spark.read.parquet(f"{t}/payload").collect()]
    assert sum(len(c["articles"]) for c in cards) == 15


def test_too_few_stories_are_outliers(spark, tmp_path):
    from newsloom.plans.flows import cluster

    df = spark.createDataFrame([("A story", "text", "2024-01-01", "http://a"), ("A story", "text", "2024-01-01", "http://b")], "TITLE string, SUMMARY string, PUBLISHED_DATE string, LINK string")
    from newsloom.schemas import with_defaults

    articles, summary = cluster(with_defaults(df), str(tmp_path), 3)
    assert {r["TOPIC_ID"] for r in articles.collect()} == {-1} and summary.first()["TOPIC_TITLE"] == "Outlier / Unclustered"


def test_topics_by_density(spark, tmp_path):
    """No number of topics is given: the themes come out by themselves."""
    import random

    from newsloom.plans.flows import cluster
    from newsloom.schemas import with_defaults

    rng = random.Random(3)
    themes = [[f"{stem}{x}" for x in "abcdefghijkl"] for stem in ("bank", "cyber", "rates", "fund")]
    rows = [(f"{k} " + " ".join(rng.sample(themes[k % 4], 9)), " ".join(rng.sample(themes[k % 4], 9)), "2024-01-01", f"http://{k}") for k in range(80)]
    df = spark.createDataFrame(rows, "TITLE string, SUMMARY string, PUBLISHED_DATE string, LINK string")
    articles, summary = cluster(with_defaults(df), str(tmp_path))
    topic = {r["LINK"]: r["TOPIC_ID"] for r in articles.collect()}
    themes_of = [{topic[f"http://{k}"] for k in range(t, 80, 4)} - {-1} for t in range(4)]
    assert all(themes_of) and not any(a & b for i, a in enumerate(themes_of) for b in themes_of[:i])
    assert summary.agg(F.sum("ARTICLE_COUNT")).first()[0] == 80
