"""The stages end to end: corpus to topics, topics to trends, gaps, status and discovery.

Each flow takes frames and returns frames; cli.py reads and writes them. What a flow uses more than
once is written to its work folder and read again, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.quality import with_quality
from newsloom.functions.vectors import mean_vectors
from newsloom.operators import corpus, density, gaps, neardup, report, status, topics, trends
from newsloom.sources.cache import hashed_embedding
from newsloom.sources.enrich import Tagger, pattern_tagger, with_entities, with_keywords

# Words too common to tell topics apart, fixed values.
STOP = "a about after all also an and any are as at be been but by can could do for from had has have he her his i if in into is it its just like more most my new no not of on one or other our out over said she so some than that the their them then there these they this to up us was we were what when which who will with would you your".split()
Embedder = Callable[[DataFrame, str], DataFrame]
ENOUGH, ENOUGH_TO_DISCOVER = 3, 5


def _kept(df: DataFrame, work: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{work}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{work}/{name}")


def embed(df: DataFrame, text: str) -> DataFrame:
    """The default embedder: hashed words, no model."""
    return hashed_embedding(df, text)


def prepared(articles: DataFrame, embedder: Embedder = embed, tagger: Tagger = pattern_tagger) -> DataFrame:
    """Articles with seq, quality, entities, keywords, document text, vector."""
    df = articles if "seq" in articles.columns else corpus.renumbered(articles, "PUBLISHED_DATE", "LINK", "TITLE", column="seq")
    df = with_quality(df).withColumn("doc", X.document_text())
    df = with_keywords(with_entities(df, "doc", tagger), "doc", STOP)
    return embedder(df, "doc")


def topic_texts(docs: DataFrame, summary: DataFrame, risk_labels: DataFrame | None = None) -> DataFrame:
    """TOPIC_ID, TOPIC_LABEL, TOPIC_TITLE, TOP_KEYWORDS, TOPIC_DESCRIPTION.

    docs: TOPIC_ID, doc of the representatives. Titles are made unique on the driver, over one row a topic.
    """
    spark = docs.sparkSession
    words = topics.class_tfidf(docs, "TOPIC_ID", "doc", STOP, 10)
    listed = words.groupBy("TOPIC_ID").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]).alias("words"))
    listed = summary.select("TOPIC_ID", "ARTICLE_COUNT", "DOMINANT_SENTIMENT", "RISK_IDS").join(listed, "TOPIC_ID", "left")
    listed = listed.withColumn("words", F.coalesce("words", F.array().cast("array<string>"))).withColumn("distinct", X.distinct_keywords("words", 6))
    order = [(r["TOPIC_ID"], r["distinct"]) for r in listed.orderBy(F.desc("ARTICLE_COUNT"), "TOPIC_ID").select("TOPIC_ID", "distinct").collect()]
    titles = spark.createDataFrame(list(topics.unique_titles(order).items()), "TOPIC_ID int, TOPIC_TITLE string")
    example = docs.groupBy("TOPIC_ID").agg(F.min(F.when(F.length(F.element_at(F.split("doc", r"\. "), 1)).between(15, 140), F.element_at(F.split("doc", r"\. "), 1))).alias("example"))
    if risk_labels is not None:
        named = listed.select("TOPIC_ID", F.posexplode_outer("RISK_IDS").alias("pos", "RISK_ID")).join(risk_labels.select("RISK_ID", "label"), "RISK_ID", "left")
        risks = named.groupBy("TOPIC_ID").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("label", F.concat(F.lit("risk "), F.col("RISK_ID").cast("string"))).alias("l")))), lambda s: s["l"]).alias("risks"))
    else:
        risks = listed.select("TOPIC_ID", F.transform("RISK_IDS", lambda r: F.concat(F.lit("risk "), r.cast("string"))).alias("risks"))
    out = listed.join(titles, "TOPIC_ID").join(example, "TOPIC_ID", "left").join(risks, "TOPIC_ID", "left")
    described = topics.description(X.spoken_list(F.slice("distinct", 1, 5)), F.col("DOMINANT_SENTIMENT"), F.col("ARTICLE_COUNT"), F.coalesce("example", F.lit("")), F.filter("risks", lambda r: r.isNotNull()))
    outlier = F.concat(F.lit("Articles that did not fit any coherent topic ("), F.col("ARTICLE_COUNT").cast("string"), F.lit(" unclustered)."))
    return out.select(
        "TOPIC_ID",
        F.when(F.col("TOPIC_ID") == topics.OUTLIER, "Outlier / Unclustered").otherwise(F.coalesce(topics.topic_label("words"), F.concat(F.lit("Topic "), F.col("TOPIC_ID").cast("string")))).alias("TOPIC_LABEL"),
        "TOPIC_TITLE",
        F.array_join(F.slice("words", 1, 8), ", ").alias("TOP_KEYWORDS"),
        F.when(F.col("TOPIC_ID") == topics.OUTLIER, outlier).otherwise(described).alias("TOPIC_DESCRIPTION"),
    )


def cluster(articles: DataFrame, work: str, n_topics: int | None = None, days: int | None = None, risk_labels: DataFrame | None = None, cut: float | None = 0.8, embedder: Embedder = embed, similarity: float = neardup.SIMILARITY, nr_topics: int | None = None, min_topic_size: int | None = None, enough: int = ENOUGH) -> tuple[DataFrame, DataFrame]:
    """(articles with topics, topic summary). Topics are fitted on one representative a story.

    Without n_topics the density of the stories tells how many there are, and which fit none; with it they are
    that many centres, and stories further than `cut` from theirs fit none. nr_topics merges the smallest topics until so many are left; topics of fewer stories than
    min_topic_size (by default what the number of stories asks for, never below 2) are outliers, and
    so is everything with fewer than `enough` stories (5 to discover).
    """
    df = corpus.recent(articles, days) if days else articles
    df = _kept(prepared(df, embedder), work, "prepared")
    stories = df.select("seq", F.col("QUALITY_SCORE").alias("quality"), F.length("doc").alias("length"), "vector", X.block_key("doc").alias("_block"))
    groups = neardup.spread_duplicates(stories, F.col("_block"), similarity)
    df = _kept(df.join(groups, "seq"), work, "grouped")
    reps = df.where("NOT IS_DUPLICATE")
    n = reps.count()
    if n < enough:  # too few stories to cluster: all are outliers
        placed = reps.select("DUP_GROUP", F.lit(topics.OUTLIER).alias("TOPIC_ID"))
    else:
        shape = topics.topic_parameters(n)
        least = shape["min_topic_size"] if min_topic_size is None else max(2, min_topic_size)
        if n_topics is None:
            placed = density.density_topics(reps.select("DUP_GROUP", F.col("seq"), "vector"), least, topics.min_samples(n, least), shape["n_neighbors"])
        else:
            placed = topics.large_enough(topics.cluster(reps.select("DUP_GROUP", "vector"), max(1, min(n_topics, n)), cut=cut), least)
        if nr_topics:
            placed = topics.merged(_kept(placed, work, "fitted"), nr_topics)
        placed = placed.select("DUP_GROUP", "TOPIC_ID")
    out = _kept(topics.propagate(df, placed), work, "placed")
    summary = topics.summary(out)
    texts = _kept(topic_texts(out.where("NOT IS_DUPLICATE").select("TOPIC_ID", "doc"), summary, risk_labels), work, "texts")
    return out.drop("doc", "vector").join(texts.drop("TOP_KEYWORDS"), "TOPIC_ID", "left"), summary.join(texts, "TOPIC_ID", "left")


def with_months(articles: DataFrame) -> DataFrame:
    return articles.withColumn("month", X.month(F.col("PUBLISHED_DATE").try_cast("timestamp")))


def gap_table(articles: DataFrame, terms: DataFrame, min_quality: float = gaps.MIN_QUALITY, embedder: Embedder = embed) -> DataFrame:
    """Ranked gaps of clustered articles against a taxonomy's terms (RISK_ID, term)."""
    df = with_quality(with_months(articles)).withColumn("doc", X.document_text())
    return gaps.build_gaps(embedder(df, "doc"), embedder(terms, "term").select("RISK_ID", "vector"), min_quality)


def discovery_table(articles: DataFrame, taxonomies: DataFrame, min_quality: float = gaps.MIN_QUALITY, embedder: Embedder = embed) -> DataFrame:
    """Ranked themes by novelty against all taxonomies' terms (RISK_ID unique over them, term), with both relevances."""
    spark = articles.sparkSession
    df = embedder(with_quality(with_months(articles)).withColumn("doc", X.document_text()), "doc").where("TOPIC_ID != -1")
    centres = gaps.centroids(df)
    out = gaps.novelty(centres, gaps.risk_vectors(embedder(taxonomies, "term")))
    for phrases, name in ((gaps.DOMAIN_ANCHOR, "RELEVANCE"), (gaps.MISSION_ANCHOR, "MISSION_RELEVANCE")):
        anchor = mean_vectors(embedder(spark.createDataFrame([(p,) for p in phrases], "p string"), "p"), [], "vector")
        out = out.join(gaps.relevance(centres, anchor, name), "TOPIC_ID")
    totals = df.groupBy("TOPIC_ID").agg(F.count_distinct("DUP_GROUP").alias("DISTINCT_STORIES"), F.count("*").alias("TOTAL_ARTICLES"), F.round(F.sum(F.col("QUALITY_SCORE").cast("decimal(18,6)")).cast("double") / F.count("*"), 3).alias("AVG_QUALITY"))
    named = df.groupBy("TOPIC_ID").agg(F.max("TOPIC_TITLE").alias("TOPIC_TITLE"), F.max("TOPIC_DESCRIPTION").alias("TOPIC_DESCRIPTION"))
    out = out.join(gaps.first_seen(df), "TOPIC_ID").join(totals, "TOPIC_ID").join(named, "TOPIC_ID")
    out = out.withColumn("DISCOVERY_SCORE", gaps.discovery_score(F.col("NOVELTY"), F.col("DISTINCT_STORIES"), F.col("AVG_QUALITY"), F.col("IS_NEW")))
    return gaps.candidates(out.where(F.col("AVG_QUALITY") >= min_quality), report.BENIGN_TERMS).orderBy(F.desc("DISCOVERY_SCORE"), "TOPIC_ID")


def status_grid(by_risk: DataFrame, as_of: str | None = None, min_volume: float = status.MIN_VOLUME) -> DataFrame:
    """Tiles: status of each risk with its driver topics and monthly series. by_risk: trends.risk_topic_months()."""
    drivers = status.drivers(by_risk, as_of).groupBy("RISK_ID").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "TOPIC_ID"))), lambda s: s["TOPIC_ID"]).alias("drivers"))
    tiles = status.classify(by_risk, as_of, min_volume).join(status.series_by_risk(by_risk), "RISK_ID").join(drivers, "RISK_ID", "left")
    return status.tiles(tiles)


def report_payload(articles: DataFrame, summary: DataFrame) -> DataFrame:
    """One JSON document a topic: its card and its newest articles."""
    dated = articles.withColumn("ts", F.col("PUBLISHED_DATE").try_cast("timestamp"))
    columns = ["TITLE", "LINK", "PUBLISHED_DATE", "SOURCE", "RISK_ID", "SENTIMENT", "SENTIMENT_COMPOUND"]
    return report.payload(summary, report.nested_articles(report.newest_per_topic(dated), columns))


build_trends = trends.build_trends
