"""Building the corpus: upserts, links already seen, lanes, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.quality import quality_score
from newsloom.functions.text import blank_to_null, sentiment_label
from newsloom.schemas import ARTICLE, with_defaults
from newsloom.sources.stages import scratch


def link_or_title_key() -> Column:
    """The link; without one, title and source. Empty and null links are alike."""
    lower = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    return F.coalesce(F.lower(blank_to_null("LINK")), F.concat_ws("|", lower("TITLE"), lower("SOURCE")))


def title_date_key() -> Column:
    return F.concat_ws("|", F.lower(F.trim(F.coalesce(F.col("TITLE"), F.lit("")))), F.coalesce(F.col("PUBLISHED_DATE").cast("string"), F.lit("")))


def first_of(df: DataFrame, key: Column | str, *order) -> DataFrame:
    """One row of each key, the first in the given order."""
    k = F.col(key) if isinstance(key, str) else key
    best = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    return df.withColumn("_key", k).withColumn("_rank", best).where("_rank = 1").drop("_key", "_rank")


def upsert(old: DataFrame, new: DataFrame, key: Column, seq: str = "seq") -> DataFrame:
    """Old rows, then new ones; the first of each key stays. Rows are ordered by generation and `seq`."""
    both = old.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)), allowMissingColumns=True)
    return first_of(both, key, "_gen", seq)


def renumbered(df: DataFrame, *order, column="GOOGLE_INDEX") -> DataFrame:
    """Numbers 0, 1, … in the given order, without one task for all rows: each range's share is counted first.

    The rows are written with their range, as ranges drawn twice need not be the same.
    """
    path = scratch(df.sparkSession, "ranges")
    df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    ranged = df.sparkSession.read.schema(df.withColumn("_part", F.lit(0)).schema).parquet(path)
    ranged = ranged.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranged.join(F.broadcast(before.select("_part", "_before")), "_part").withColumn(column, (F.col("_before") + F.col("_in") - 1).cast("bigint")).drop("_part", "_in", "_before")


def newest_first(df: DataFrame, date="PUBLISHED_DATE", *ties) -> DataFrame:
    """In descending order of the date as text; undated rows last."""
    return df.orderBy(F.desc_nulls_last(date), *ties)


def hit_rate(df: DataFrame, key: str, text="SUMMARY", least=200) -> DataFrame:
    """Of each key the rows and the share whose text was extracted, that is, is long enough."""
    enough = F.length(F.coalesce(F.col(text), F.lit(""))) >= least
    return df.groupBy(key).agg(F.round(F.avg(enough.cast("int")), 4).alias("hit_rate"), F.count("*").alias("n"))


def unseen(new: DataFrame, old: DataFrame, seq: str = "seq") -> DataFrame:
    """New rows whose link the corpus lacks, each link once; rows without a link go by title and source."""
    known = old.select(link_or_title_key().alias("_link"))
    fresh = new.withColumn("_link", link_or_title_key()).join(known, "_link", "left_anti")
    return first_of(fresh, "_link", seq).drop("_link")


def recent(df: DataFrame, days: int, date="PUBLISHED_DATE") -> DataFrame:
    """The last `days` days before the newest date in the data, inclusive; undated rows go. Without any date, all rows."""
    ts = F.col(date).try_cast("timestamp")
    newest = df.agg(F.max(ts).alias("_newest"))
    return df.crossJoin(F.broadcast(newest)).where(F.col("_newest").isNull() | (ts >= F.col("_newest") - F.make_dt_interval(F.lit(days)))).drop("_newest")


def lane(df: DataFrame, tag: str) -> DataFrame:
    """Rows of one fetch lane; all of them for "all"."""
    return df if tag == "all" else df.where(F.col("SEARCH_TERM_ID") == tag)


def not_older(df: DataFrame, cutoff: str, date="PUBLISHED_DATE") -> DataFrame:
    """By comparison of ISO strings; undated rows stay."""
    return df.where(F.col(date).isNull() | (F.col(date) == "") | (F.col(date) >= cutoff))


def thick(df: DataFrame, text="SUMMARY", least=150) -> DataFrame:
    return df.where(F.length(F.coalesce(F.col(text), F.lit(""))) >= least)


def backfilled(articles: DataFrame, texts: DataFrame, least=200, cap=4000) -> DataFrame:
    """Summaries replaced by fetched texts that are long enough. texts: LINK, text."""
    named = texts.select("LINK", F.col("text").alias("_text"))
    better = F.when(F.length("_text") >= least, F.substring("_text", 1, cap))
    return articles.join(named, "LINK", "left").withColumn("SUMMARY", F.coalesce(better, F.col("SUMMARY"))).drop("_text")


def backfill_targets(df: DataFrame, least=200, limit: int | None = None, seq="seq") -> DataFrame:
    """Rows with a link whose summary is thin; the first `limit` of them if given."""
    thin = df.where(F.col("LINK").startswith("http") & (F.length(F.coalesce(F.col("SUMMARY"), F.lit(""))) < least))
    return thin.orderBy(seq).limit(limit) if limit else thin


def normalise(items: DataFrame, tag: str | Column, prefix: str, compound: Column, cap=4000) -> DataFrame:
    """Items of a lane (title, text, source, date, link, category) as article rows."""
    rows = items.select(
        F.lit(-1).alias("RISK_ID"),
        (tag if isinstance(tag, Column) else F.lit(tag)).alias("SEARCH_TERM_ID"),
        F.col("title").alias("TITLE"),
        F.col("link").alias("LINK"),
        F.col("date").cast("string").alias("PUBLISHED_DATE"),
        F.substring("text", 1, cap).alias("SUMMARY"),
        F.lit("").alias("KEYWORDS"),
        compound.alias("SENTIMENT_COMPOUND"),
        F.col("source").alias("SOURCE"),
        F.concat(F.lit(prefix), F.coalesce(blank_to_null("category"), F.lit("general"))).alias("CATEGORY"),
    )
    rows = rows.withColumn("SENTIMENT", sentiment_label("SENTIMENT_COMPOUND")).withColumn("QUALITY_SCORE", quality_score())
    return with_defaults(rows, ARTICLE)


def link_samples(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n links, each once, in an order drawn by a hash of link and seed."""
    return df.select("LINK").where(F.col("LINK").isNotNull()).distinct().orderBy(F.xxhash64(F.lit(seed), "LINK"), "LINK").limit(n)


def fetch_tallies(df: DataFrame, least=150, cutoff: str | None = None) -> DataFrame:
    """How many rows are kept, thin or old, in one row."""
    old = (F.col("PUBLISHED_DATE") < cutoff) if cutoff else F.lit(False)
    thin = F.length(F.coalesce(F.col("SUMMARY"), F.lit(""))) < least
    return df.agg(F.count_if(~thin & ~F.coalesce(old, F.lit(False))).alias("kept"), F.count_if(thin).alias("thin"), F.count_if(old).alias("old"))


