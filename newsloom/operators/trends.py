"""Monthly signal intensity, its slope and momentum, by topic and by risk.

Articles need TOPIC_ID, PUBLISHED_DATE (or a `month` column), SENTIMENT, SENTIMENT_COMPOUND and,
for the breakdown, RISK_ID. Sentiment is summed as decimals and divided last, so results do not
depend on the order of the rows. The calendar of observed months is the only side that is
broadcast; it has one row a month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import month as month_of

OUTLIER = -1
BENIGN_NEGATIVE_SHARE = 0.08
BENIGN_PEAK_VOLUME = 5


def severity(negative_share: Column, mean_compound: Column) -> Column:
    """Weight of the tone, 1 or more."""
    return F.lit(1.0) + negative_share + F.greatest(F.lit(0.0), -mean_compound)


def signal(articles: DataFrame) -> DataFrame:
    """Dated rows of real topics, with month, negative flag and compound."""
    df = articles
    if "month" not in df.columns:
        df = df.withColumn("month", month_of(F.col("PUBLISHED_DATE").try_cast("timestamp")))
    return df.where(F.col("month").isNotNull() & (F.col("TOPIC_ID") != OUTLIER)).withColumns(
        {
            "_neg": (F.col("SENTIMENT") == "Negative").cast("int"),
            "_compound": F.coalesce(F.col("SENTIMENT_COMPOUND").cast("decimal(18,8)"), F.lit(0).cast("decimal(18,8)")),
        }
    )


def _volumes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Volume, tone and intensity for each key and month; one shuffle, partial sums before it."""
    sums = df.groupBy(*keys, "month").agg(F.count("*").alias("volume"), F.sum(F.coalesce("_neg", F.lit(0))).alias("neg_articles"), F.sum("_compound").alias("_sum"))
    return weighed(sums)


def weighed(sums: DataFrame) -> DataFrame:
    """Tone, severity and intensity of sums: volume, neg_articles, _sum (of the compounds)."""
    share, mean = F.col("neg_articles") / F.col("volume"), F.col("_sum").cast("double") / F.col("volume")
    return sums.withColumns({"_share": share, "_mean": mean}).withColumn("severity", severity(F.col("_share"), F.col("_mean"))).withColumn("intensity", F.round(F.col("volume") * F.col("severity"), 2))


def topic_months(articles: DataFrame) -> DataFrame:
    """One row for each topic and month."""
    v = _volumes(signal(articles), ["TOPIC_ID"])
    total = F.sum("volume").over(Window.partitionBy("month"))
    return v.select(
        "TOPIC_ID",
        "month",
        "volume",
        "neg_articles",
        F.round("_share", 4).alias("neg_share"),
        F.round("_mean", 4).alias("avg_compound"),
        F.round(F.col("volume") / total, 5).alias("share_of_coverage"),
        "severity",
        "intensity",
    )


def dense(series: DataFrame, keys: list[str], months: DataFrame, value: str) -> DataFrame:
    """Every key on every month of the calendar, 0 where it had none, with the month's index from 0."""
    spine = series.select(*keys).distinct().crossJoin(F.broadcast(months))
    return spine.join(series.select(*keys, "month", value), [*keys, "month"], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def calendar(series: DataFrame) -> DataFrame:
    """Observed months with their index: one row a month."""
    months = series.select("month").where("month IS NOT NULL").distinct()
    return months.select("month", (F.row_number().over(Window.orderBy("month")) - 1).alias("idx"))


def exact_mean(x: Column) -> Column:
    """Mean of amounts of a few decimals, summed as decimals, so that no order of rows shows in it."""
    return F.sum(x.cast("decimal(18,4)")).cast("double") / F.count(x)


def _mean_between(value: str, rank: Column, lo: int, hi: int) -> Column:
    return exact_mean(F.when(rank.between(lo, hi), F.col(value)))


def momentum(value: str, idx: Column, n: Column) -> tuple[Column, Column]:
    """(mean of the last 3, mean of the 3 before): of 4 or 5 points all but the last 3; 0 with 3 or less."""
    rank = n - idx
    recent = _mean_between(value, rank, 1, 3)
    prior = F.coalesce(F.when(F.first(n) >= 6, _mean_between(value, rank, 4, 6)).otherwise(exact_mean(F.when(rank > 3, F.col(value)))), F.lit(0.0))
    return recent, prior


def _series_stats(full: DataFrame, keys: list[str]) -> DataFrame:
    recent, prior = momentum("intensity", F.col("idx"), F.col("n_months"))
    return full.groupBy(*keys).agg(
        F.max_by("month", F.struct("intensity", -F.col("idx"))).alias("PEAK_MONTH"),
        F.round(F.max("intensity"), 2).alias("PEAK_INTENSITY"),
        F.round(exact_mean(F.col("intensity")), 2).alias("MEAN_INTENSITY"),
        F.round(F.coalesce(F.regr_slope("intensity", "idx"), F.lit(0.0)), 3).alias("TREND_SLOPE"),
        F.round(recent - prior, 2).alias("MOMENTUM"),
    )


def with_length(months: DataFrame) -> DataFrame:
    return months.withColumn("n_months", F.count("*").over(Window.partitionBy()))


def trend_topics(articles: DataFrame) -> DataFrame:
    """One row for each topic: totals, peak, slope, momentum, benign flag, risks."""
    df = signal(articles)
    series = _volumes(df, ["TOPIC_ID"])
    out = topic_stats(series, with_length(calendar(series)))
    if "RISK_ID" in df.columns:
        out = out.join(df.groupBy("TOPIC_ID").agg(F.array_sort(F.collect_set("RISK_ID")).alias("RISK_IDS")), "TOPIC_ID")
    return out


def topic_stats(series: DataFrame, months: DataFrame) -> DataFrame:
    """Totals, peak, slope, momentum and benign flag of each topic's series on the calendar `months`."""
    full = dense(series, ["TOPIC_ID"], months, "intensity")
    totals = series.groupBy("TOPIC_ID").agg(F.sum("volume").alias("TOTAL_ARTICLES"), benign().alias("IS_BENIGN"))
    return _series_stats(full, ["TOPIC_ID"]).join(totals, "TOPIC_ID")


def pair_stats(series: DataFrame, months: DataFrame) -> DataFrame:
    """The rows of each risk's and topic's series, with the pair's peak and momentum on the calendar `months`."""
    keys = ["RISK_ID", "TOPIC_ID"]
    series = series.select(*keys, "month", "volume", "intensity")
    stats = _series_stats(dense(series, keys, months, "intensity"), keys)
    return series.join(stats.select(*keys, F.col("PEAK_INTENSITY").alias("peak_intensity"), F.col("MOMENTUM").alias("momentum")), keys, "left")


def benign() -> Column:
    """Hardly ever negative and never more than a few articles a month; an aggregate over months."""
    share = F.sum("neg_articles") / F.greatest(F.lit(1), F.sum("volume"))
    return (share < BENIGN_NEGATIVE_SHARE) & (F.max("volume") < BENIGN_PEAK_VOLUME)


def drop_benign(frame: DataFrame, topics: DataFrame) -> DataFrame:
    return frame.join(topics.where(~F.col("IS_BENIGN")).select("TOPIC_ID"), "TOPIC_ID", "left_semi")


def risk_topic_months(articles: DataFrame) -> DataFrame:
    """Intensity of each risk's own articles by topic and month, with the pair's peak and momentum."""
    df = signal(articles).where("RISK_ID IS NOT NULL")
    keys = ["RISK_ID", "TOPIC_ID"]
    series = _volumes(df, keys)
    return pair_stats(series, with_length(calendar(series)))


def rising(topics: DataFrame, n: int = 10) -> DataFrame:
    """Topics of highest momentum that are not benign."""
    return topics.where(~F.col("IS_BENIGN")).orderBy(F.desc("MOMENTUM"), "TOPIC_ID").limit(n)


def build_trends(articles: DataFrame, leave_benign_out: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(topic months, topics, risk and topic months)."""
    months, topics, risks = topic_months(articles), trend_topics(articles), risk_topic_months(articles)
    if leave_benign_out:
        months, risks = drop_benign(months, topics), drop_benign(risks, topics)
        topics = topics.where(~F.col("IS_BENIGN"))
    return months, topics, risks
