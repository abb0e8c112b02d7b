"""Trends kept up to date batch by batch, late articles included.

What is stored of the articles are cells: for each risk, topic and month the number of articles, of negative
ones, and the exact sum of their tone. Cells add up, so a batch is summed by itself and added to the cells it
touches; articles are never read again. Cells and results are dealt into parts by topic. A batch recomputes the
results of the parts it touches, from their cells; only a month never seen before makes all series longer, and
then all parts are recomputed, from cells too. Shares of coverage depend on all topics of a month: the totals
of the months are a table of their own, and the share is taken when the results are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import trends
from newsloom.streaming.parts import Parts, read_version

CELLS = "RISK_ID int, TOPIC_ID int, month string, volume long, neg_articles long, tone decimal(28,8)"
MONTHS = "TOPIC_ID int, month string, volume long, neg_articles long, neg_share double, avg_compound double, severity double, intensity double"
TOPICS = "TOPIC_ID int, PEAK_MONTH string, PEAK_INTENSITY double, MEAN_INTENSITY double, TREND_SLOPE double, MOMENTUM double, TOTAL_ARTICLES long, IS_BENIGN boolean, RISK_IDS array<int>"
RISKS = "RISK_ID int, TOPIC_ID int, month string, volume long, intensity double, peak_intensity double, momentum double"
TOTALS = "month string, total long"
KEY = "TOPIC_ID"


def cells(articles: DataFrame) -> DataFrame:
    """The articles' sums for each risk, topic and month; a null risk has its own."""
    df = trends.signal(articles)
    return df.groupBy("RISK_ID", "TOPIC_ID", "month").agg(F.count("*").alias("volume"), F.sum(F.coalesce("_neg", F.lit(0))).cast("long").alias("neg_articles"), F.sum("_compound").cast("decimal(28,8)").alias("tone"))


def added(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.unionByName(b).groupBy("RISK_ID", "TOPIC_ID", "month")
    return both.agg(F.sum("volume").alias("volume"), F.sum("neg_articles").alias("neg_articles"), F.sum("tone").cast("decimal(28,8)").alias("tone"))


def _series(part: DataFrame, keys: list[str]) -> DataFrame:
    sums = part.groupBy(*keys, "month").agg(F.sum("volume").alias("volume"), F.sum("neg_articles").alias("neg_articles"), F.sum("tone").alias("_sum"))
    return trends.weighed(sums)


def _typed(df: DataFrame, schema: str) -> DataFrame:
    return df.select(*[F.col(c.split()[0]).cast(c.split(None, 1)[1]).alias(c.split()[0]) for c in schema.split(", ")])


def results(part: DataFrame, months: DataFrame, risk_months: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """The results of the topics of some cells; months: the calendar of all topics, and of all that have a risk."""
    by_topic, by_risk = _series(part, ["TOPIC_ID"]), _series(part.where("RISK_ID is not null"), ["RISK_ID", "TOPIC_ID"])
    month_rows = by_topic.select("TOPIC_ID", "month", "volume", "neg_articles", F.round("_share", 4).alias("neg_share"), F.round("_mean", 4).alias("avg_compound"), "severity", "intensity")
    risks = part.groupBy("TOPIC_ID").agg(F.array_sort(F.collect_set("RISK_ID")).alias("RISK_IDS"))
    topics = trends.topic_stats(by_topic, trends.with_length(trends.calendar(months))).join(risks, "TOPIC_ID")
    pairs = trends.pair_stats(by_risk, trends.with_length(trends.calendar(risk_months)))
    return {"months": (_typed(month_rows, MONTHS), MONTHS), "topics": (_typed(topics, TOPICS), TOPICS), "risks": (_typed(pairs, RISKS), RISKS)}


def add_batch(spark: SparkSession, path: str, number: int, articles: DataFrame, count: int = 64) -> list[int]:
    """Add the articles of batch `number` to the trends at `path`; returns the parts whose results were made anew."""
    parts, key = Parts(spark, path, number, count), F.col(KEY)
    fresh = cells(articles).persist()
    try:
        touched = parts.touched(fresh, key)
        parts.write("cells", added(parts.read("cells", CELLS, touched), fresh), key, touched)
        old = parts.read("totals", TOTALS)
        counted = fresh.groupBy("month").agg(F.sum("volume").alias("total"), F.sum(F.when(F.col("RISK_ID").isNotNull(), F.col("volume"))).alias("with_risk"))
        totals = old.unionByName(counted.select("month", "total")).groupBy("month").agg(F.sum("total").alias("total"))
        risk_totals = parts.read("risk_totals", TOTALS).unionByName(counted.where("with_risk is not null").select("month", F.col("with_risk").alias("total"))).groupBy("month").agg(F.sum("total").alias("total"))
        # A row a month: one part each.
        lengths = [parts.read(t, TOTALS).count() for t in ("totals", "risk_totals")]
        for name, rows in (("totals", totals), ("risk_totals", risk_totals)):
            parts.write(name, rows, F.lit(0), [parts.spark.range(1).select(parts.place(F.lit(0))).first()[0]])
        months, risk_months = (parts.read(t, TOTALS, new=True) for t in ("totals", "risk_totals"))
        longer = lengths != [months.count(), risk_months.count()]
        again = sorted(p for n, p in parts.now if n == "cells") if longer else touched
        known = parts.read("cells", CELLS, again, new=True)
        for name, (rows, _) in results(known, months, risk_months).items():
            parts.write(name, rows, key, sorted(set(again) | set(touched)))
        parts.commit()
        return again
    finally:
        fresh.unpersist()


def read_trends(spark: SparkSession, path: str, number: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(topic months, topics, risk and topic months) after batch `number`, as build_trends() gives them."""
    months, topics, risks = (read_version(spark, path, number, n, s) for n, s in (("months", MONTHS), ("topics", TOPICS), ("risks", RISKS)))
    totals = read_version(spark, path, number, "totals", TOTALS)
    shared = months.join(F.broadcast(totals), "month").withColumn("share_of_coverage", F.round(F.col("volume") / F.col("total"), 5))
    return shared.select("TOPIC_ID", "month", "volume", "neg_articles", "neg_share", "avg_compound", "share_of_coverage", "severity", "intensity"), topics, risks


def keep_trends(stream: DataFrame, path: str, checkpoint: str, count: int = 64):
    """Add every micro-batch of a stream of articles; returns the query. The trends after batch n are read_trends(spark, path, n)."""
    each = lambda batch, number: add_batch(batch.sparkSession, path, number, batch, count)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_version(spark: SparkSession, path: str) -> int:
    """The number of the last batch that was finished; -1 without any."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return max((int(s.getPath().getName()) for s in system.listStatus(at)), default=-1) if system.exists(at) else -1
