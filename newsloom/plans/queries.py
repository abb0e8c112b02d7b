"""One query for each operator, over the article-shaped views of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions import quality as Q
from newsloom.functions import text as X
from newsloom.functions.sentiment import compound
from newsloom.functions.vectors import mean_vectors, nearest
from newsloom.operators import corpus, density, gaps, neardup, neighbours, report, search, sketches, status, topics, trends
from newsloom.plans.tables import doc_articles, signal_articles, table, vec_terms, vec_topics
from newsloom.sources import digest, documents, embeddings, enrich, fetch, lanes, stages, tagging, taxonomy
from newsloom.sources.cache import encode_cached, hashed_embedding, read_cache
from newsloom.sources.cache import model_places as model_places_of
from newsloom.sources.taxonomy import encode_text
from newsloom.sources.stages import scratch
from newsloom.streaming import events as stream
from newsloom.streaming import trends as kept
from newsloom.streaming import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# Signal intensity and its course.


@query
def topic_month_intensity(spark, sf):
    t = trends.topic_months(signal_articles(spark, sf))
    return t.select(F.col("TOPIC_ID").alias("topic"), "month", "volume", "neg_articles", "neg_share", "avg_compound", "share_of_coverage", F.round("severity", 6).alias("severity"), "intensity")


@query
def topic_share_of_coverage(spark, sf):
    t = trends.topic_months(signal_articles(spark, sf))
    return t.groupBy("month").agg(F.round(F.sum(F.col("share_of_coverage").cast("decimal(18,5)")).cast("double"), 3).alias("share"), F.max("share_of_coverage").alias("top_share"), F.count("*").alias("topics"))


@query
def risk_topic_month_intensity(spark, sf):
    t = trends.risk_topic_months(signal_articles(spark, sf))
    return t.select(F.col("RISK_ID").alias("risk"), F.col("TOPIC_ID").alias("topic"), "month", "volume", "intensity", "peak_intensity", "momentum")


@query
def topic_trend_meta(spark, sf):
    t = trends.trend_topics(signal_articles(spark, sf))
    return t.select(F.col("TOPIC_ID").alias("topic"), "TOTAL_ARTICLES", "PEAK_MONTH", "PEAK_INTENSITY", "MEAN_INTENSITY", "TREND_SLOPE", "MOMENTUM", "IS_BENIGN", F.array_join(F.transform("RISK_IDS", lambda r: r.cast("string")), ", ").alias("RISK_IDS"))


@query
def topic_slope(spark, sf):
    return trends.trend_topics(signal_articles(spark, sf).drop("RISK_ID")).select(F.col("TOPIC_ID").alias("topic"), "TREND_SLOPE")


@query
def topic_momentum(spark, sf):
    return trends.trend_topics(signal_articles(spark, sf).drop("RISK_ID")).select(F.col("TOPIC_ID").alias("topic"), "MOMENTUM")


@query
def topic_benign_flag(spark, sf):
    # A finer grain than topics, so that some groups are thin: the topic and the supplier's last digit.
    a = signal_articles(spark, sf).withColumn("TOPIC_ID", F.when(F.col("TOPIC_ID") == -1, -1).otherwise(F.col("TOPIC_ID") * 10000 + F.regexp_extract("SOURCE", r"(\d+)", 1).cast("int")))
    months = a.where("TOPIC_ID != -1").groupBy("TOPIC_ID", "month").agg(F.count("*").alias("volume"), F.sum((F.col("SENTIMENT") == "Negative").cast("int")).alias("neg_articles"))
    return months.groupBy(F.col("TOPIC_ID").alias("topic")).agg(trends.benign().alias("benign"))


@query
def rising_topics_topk(spark, sf):
    t = trends.rising(trends.trend_topics(signal_articles(spark, sf).drop("RISK_ID")))
    return t.select(F.col("TOPIC_ID").alias("topic"), "MOMENTUM", "PEAK_INTENSITY")


@query
def benign_topics_dropped(spark, sf):
    a = signal_articles(spark, sf).drop("RISK_ID")
    flags = trends.trend_topics(a).withColumn("IS_BENIGN", F.col("MOMENTUM") < 0)
    return trends.drop_benign(trends.topic_months(a), flags).select(F.col("TOPIC_ID").alias("topic"), "month", "volume")


@query
def calendar_spine(spark, sf):
    a = trends.topic_months(signal_articles(spark, sf))
    full = trends.dense(a, ["TOPIC_ID"], trends.with_length(trends.calendar(a)), "intensity")
    return full.select(F.col("TOPIC_ID").alias("topic"), "month", F.col("idx").cast("bigint").alias("idx"), "intensity")


@query
def trend_series_payload(spark, sf):
    a = trends.topic_months(signal_articles(spark, sf))
    full = trends.dense(a, ["TOPIC_ID"], trends.with_length(trends.calendar(a)), "intensity")
    s = report.series_payload(full, ["TOPIC_ID"])
    return s.select(F.col("TOPIC_ID").alias("topic"), F.size("intensity").alias("n"), F.array_join(F.transform("intensity", lambda x: F.round(x * 100).cast("bigint").cast("string")), ",").alias("hundredths"))


# Status.


def _by_risk(spark, sf):
    return trends.risk_topic_months(signal_articles(spark, sf)).select("RISK_ID", "TOPIC_ID", "month", "intensity", "peak_intensity", "momentum")


@query
def risk_month_sum(spark, sf):
    return status.risk_months(_by_risk(spark, sf)).select(F.col("RISK_ID").alias("risk"), "month", "intensity")


AS_OF = "2001-08"


@query
def risk_status(spark, sf):
    s = status.classify(_by_risk(spark, sf), as_of=AS_OF)
    return s.select(F.col("RISK_ID").alias("risk"), "status", "latest", "median", "band_hi", "mom_pct")


@query
def risk_status_counts(spark, sf):
    return status.status_counts(status.classify(_by_risk(spark, sf), as_of=AS_OF))


@query
def risk_status_tiles(spark, sf):
    s = status.classify(_by_risk(spark, sf), as_of=AS_OF)
    place = F.row_number().over(Window.orderBy(status.status_order(), F.desc(F.coalesce("latest", F.lit(0.0))), "RISK_ID"))
    return s.select(place.cast("bigint").alias("place"), F.col("RISK_ID").alias("risk"), "status")


@query
def risk_drivers_topk(spark, sf):
    return status.drivers(_by_risk(spark, sf), as_of=AS_OF).select(F.col("RISK_ID").alias("risk"), F.col("rank").cast("bigint").alias("rank"), F.col("TOPIC_ID").alias("topic"), "intensity")


# The corpus.


@query
def recent_window(spark, sf):
    return corpus.recent(signal_articles(spark, sf), 90, "ts").groupBy(F.col("TOPIC_ID").alias("topic")).agg(F.count("*").alias("n"), F.min("PUBLISHED_DATE").alias("first_day"))


def _halves(spark, sf):
    a = signal_articles(spark, sf).select("seq", "LINK", "TITLE", "SOURCE", "PUBLISHED_DATE")
    linkless = a.withColumn("LINK", F.when(F.col("seq") % 3 == 0, F.lit("")).otherwise(F.col("LINK")))
    return linkless.where("seq % 2 = 0"), linkless.where("seq % 2 = 1")


@query
def corpus_upsert_dedup(spark, sf):
    old, new = _halves(spark, sf)
    return corpus.upsert(old, new, corpus.link_or_title_key()).select("seq", F.col("LINK").alias("link"))


@query
def corpus_upsert_by_title(spark, sf):
    old, new = _halves(spark, sf)
    return corpus.upsert(old, new, corpus.title_date_key()).select("seq", F.col("TITLE").alias("title"))


@query
def renumber_after_dedup(spark, sf):
    old, new = _halves(spark, sf)
    return corpus.renumbered(corpus.upsert(old, new, corpus.link_or_title_key()), "_gen", "seq", column="idx").select("seq", "idx")


@query
def seen_link_anti_join(spark, sf):
    old, new = _halves(spark, sf)
    return corpus.unseen(new.where("LINK != ''"), old).select("seq", F.col("LINK").alias("link"))


@query
def lane_filter_counts(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("event_type", "SEARCH_TERM_ID")
    return report.lane_counts(corpus.lane(e, "all")).unionByName(report.lane_counts(corpus.lane(e, "click"))).select(F.col("SEARCH_TERM_ID").alias("lane"), "n")


@query
def age_cutoff(spark, sf):
    return corpus.not_older(signal_articles(spark, sf), "2000-01-01").groupBy("month").agg(F.count("*").alias("n"))


@query
def fetch_tallies(spark, sf):
    d = doc_articles(spark, sf).withColumn("PUBLISHED_DATE", F.lit("2024-01-01"))
    return corpus.fetch_tallies(d, 400, "2023-01-01")


@query
def backfill_merge(spark, sf):
    d = doc_articles(spark, sf).select("seq", F.concat(F.lit("http://d/"), F.col("seq").cast("string")).alias("LINK"), "SUMMARY")
    texts = d.select("LINK", F.concat(F.lit("x"), "SUMMARY").alias("text")).where("LINK like '%5'")
    return corpus.backfilled(d, texts, 600, 900).select("seq", F.md5(F.col("SUMMARY").cast("binary")).alias("summary"), F.length("SUMMARY").alias("n"))


@query
def backfill_targets(spark, sf):
    d = doc_articles(spark, sf).select("seq", F.concat(F.lit("http://d/"), F.col("seq").cast("string")).alias("LINK"), "SUMMARY")
    return corpus.backfill_targets(d, 500).select("seq")


@query
def corpus_stats(spark, sf):
    return report.corpus_stats(signal_articles(spark, sf))


# Text.


@query
def quality_score(spark, sf):
    return doc_articles(spark, sf).select("seq", F.round(Q.quality_score(), 3).alias("quality"))


@query
def quality_score_titles(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(" market size $"), F.col("p_size").cast("string")).alias("TITLE"), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type")).alias("SUMMARY"), F.element_at(F.array(*map(F.lit, ("fool", "prnewswire", "reuters", "PR.cision.com"))), (F.col("p_size") % 4 + 1).cast("int")).alias("SOURCE"))
    return p.select("p_partkey", F.round(Q.quality_score(), 3).alias("quality"))


@query
def document_text(spark, sf):
    return doc_articles(spark, sf).select("seq", F.md5(X.document_text().cast("binary")).alias("md5"), F.length(X.document_text()).alias("n"))


@query
def block_key_groups(spark, sf):
    return neardup.blocks(table(spark, sf, "documents")).select("block", "n")


@query
def exact_text_dups(spark, sf):
    return neardup.exact_copies(table(spark, sf, "documents"), "text", "doc_id").select("first", "n")


@query
def source_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.source_slug("url").alias("source"))


@query
def page_title_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.page_title("html").alias("title"))


@query
def sentiment_labels(spark, sf):
    a = signal_articles(spark, sf)
    return a.groupBy(X.sentiment_label("SENTIMENT_COMPOUND").alias("label")).agg(F.count("*").alias("n"))


@query
def date_parse_chain(spark, sf):
    o = table(spark, sf, "orders")
    spelled = F.element_at(F.array(F.date_format("o_orderdate", "MMMM d, yyyy"), F.date_format("o_orderdate", "MMM d, yyyy"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("soon")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select("o_orderkey", F.date_format(X.parse_date(spelled), "yyyy-MM-dd").alias("day"))


@query
def page_dates(spark, sf):
    o = table(spark, sf, "orders")
    html = F.concat(F.lit("<p>Posted "), F.date_format("o_orderdate", "MMM d, yyyy"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(' {"datePublished": "'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('T00:00"}'))).otherwise(F.lit("")), F.lit("</p>"))
    return o.select("o_orderkey", F.date_format(X.page_date(html), "yyyy-MM-dd").alias("day"))


@query
def normal_titles(spark, sf):
    p = table(spark, sf, "part")
    t = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, " - The Daily").otherwise(" | Wire"), F.lit("."))
    return p.select("p_partkey", X.normal_title(t).alias("title"))


@query
def title_keywords(spark, sf):
    k = X.title_keywords(doc_articles(spark, sf), "seq", "SUMMARY")
    return k.select("seq", F.array_join("keywords", ",").alias("keywords"))


@query
def distinct_keywords(spark, sf):
    d = doc_articles(spark, sf)
    words = F.split(F.regexp_replace(F.lower("text"), "[^a-z ]", ""), " +")
    return d.select("seq", F.array_join(X.distinct_keywords(words, 5), ",").alias("keywords"))


@query
def keyword_filter(spark, sf):
    words = F.split("text", r"[\s,.]+")
    return doc_articles(spark, sf).select("seq", F.array_join(X.keyword_filter(words), ",").alias("keywords"))


@query
def risk_id_normalise(spark, sf):
    n = table(spark, sf, "nation")
    raw = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.col("n_nationkey").cast("string"), F.lit(".0"))).otherwise(F.col("n_nationkey").cast("string"))
    return n.select("n_name", X.risk_number(raw).alias("risk"))


@query
def date_windows(spark, sf):
    span = table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    w = span.select(F.explode(X.date_windows("a", "b", 45)).alias("w"))
    return w.select(F.date_format("w.window_start", "yyyy-MM-dd").alias("window_start"), F.date_format("w.window_end", "yyyy-MM-dd").alias("window_end"))


@query
def fetch_plan(spark, sf):
    # A nation is a scan: from its first order to its last, its customers' segments are the categories.
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    days = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("scan")).agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    wanted = c.groupBy(F.col("c_nationkey").alias("scan"), F.col("c_mktsegment").alias("category")).agg(F.min("c_custkey").alias("category_no"))
    return fetch.plans(days, wanted, 14, 2, 25).select("scan", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "category", "page")


@query
def phrase_lane(spark, sf):
    d = fetch.phrase_lane(table(spark, sf, "documents").select("doc_id", "text"), ["general public license", "licensed under", "all rights reserved"], "text")
    return d.select("doc_id", F.col("CATEGORY").alias("category"))


@query
def cache_keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.cache_key("m", F.col("text")).alias("key"))


@query
def cache_misses(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha1("text").alias("key"))
    return d.where("doc_id % 2 = 1").select("key").distinct().join(d.where("doc_id % 2 = 0").select("key"), "key", "left_anti")


@query
def full_text_fallback(spark, sf):
    d = doc_articles(spark, sf)
    return d.select("seq", F.md5(X.full_text_or(F.col("SUMMARY"), F.col("TITLE"), 800, 2000).cast("binary")).alias("md5"))


@query
def extraction_hit_rate(spark, sf):
    return corpus.hit_rate(doc_articles(spark, sf), "lang", "SUMMARY", 1000)


@query
def relevance_bands(spark, sf):
    c = gaps.centroids(vec_topics(spark, sf))
    anchor = mean_vectors(vec_topics(spark, sf).where("seq % 4 = 0"), [], "vector")
    return gaps.relevance(c, anchor).select(F.col("TOPIC_ID").alias("topic"), X.relevance_band("RELEVANCE").alias("band"))


@query
def description_cleanup(spark, sf):
    p = table(spark, sf, "part")
    d = F.concat(F.lit("Coverage of "), F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(" articles). Linked to risk -1."))
    return p.select("p_partkey", X.clean_description(d).alias("description"))


@query
def search_highlight(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.highlight(F.col("p_name"), "an").alias("marked"))


@query
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(X.html_text("html").cast("binary")).alias("md5"), F.length(X.html_text("html")).alias("n"))


@query
def best_headlines(spark, sf):
    return topics.best_headlines(doc_articles(spark, sf), "SOURCE", "TITLE", ["qu", "ing"]).withColumnRenamed("SOURCE", "source")


@query
def thin_text_reject(spark, sf):
    return corpus.thick(doc_articles(spark, sf), "SUMMARY", 150).groupBy("lang").agg(F.count("*").alias("n"))


@query
def link_sample(spark, sf):
    # The sampling operator; its size is the feature.
    links = table(spark, sf, "pages").select(F.col("url").alias("LINK"))
    return corpus.link_samples(links, 100, 7).groupBy().agg(F.count("*").alias("n"), F.count_distinct("LINK").alias("links"))


@query
def natural_id_order(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    place = F.row_number().over(Window.partitionBy(F.length("id")).orderBy(*X.natural_order("id")))
    return c.select("id", place.cast("bigint").alias("place"))


@query
def card_orders(spark, sf):
    cards = topics.summary(signal_articles(spark, sf))
    out = None
    for by in report.CARD_ORDERS:
        direction, column = report.CARD_ORDERS[by]
        place = F.row_number().over(Window.orderBy(direction(column), F.desc("ARTICLE_COUNT"), "TOPIC_ID"))
        one = cards.select(F.lit(by).alias("by"), F.col("TOPIC_ID").alias("topic"), place.cast("bigint").alias("place"))
        out = one if out is None else out.unionByName(one)
    return out


# Near duplicates.


@query
def near_dup_groups(spark, sf):
    e = vec_topics(spark, sf).select("seq", F.lit(1.0).alias("quality"), F.lit(1).alias("length"), "vector", "TOPIC_ID")
    return neardup.near_duplicates(e, F.col("TOPIC_ID").cast("string"), 0.3).select("seq", F.col("DUP_GROUP").alias("grp"), F.col("IS_DUPLICATE").alias("duplicate"))


@query
def near_dup_spread(spark, sf):
    # All rows are one block.
    e = vec_topics(spark, sf).select("seq", (F.col("seq") % 3).cast("double").alias("quality"), F.lit(1).alias("length"), "vector")
    return neardup.spread_duplicates(e, F.lit("all"), 0.5).select("seq", F.col("DUP_GROUP").alias("grp"), F.col("IS_DUPLICATE").alias("duplicate"))


@query
def similar_vector_pairs(spark, sf):
    return neighbours.similar_pairs(vec_topics(spark, sf), 0.5).select("a", "b", F.round("cosine", 6).alias("cosine"))


@query
def nearest_vectors(spark, sf):
    return neighbours.nearest_neighbours(vec_topics(spark, sf), 5).select("seq", "other", F.round("distance", 5).alias("distance"))


@query
def near_dup_approximate(spark, sf):
    e = vec_topics(spark, sf).select("seq", F.lit(1.0).alias("quality"), F.lit(1).alias("length"), "vector")
    return neardup.similar_groups(e, F.lit("all"), 0.6).select("seq", F.col("DUP_GROUP").alias("grp"), F.col("IS_DUPLICATE").alias("duplicate"))


@query
def jaccard_containment_pairs(spark, sf):
    d = table(spark, sf, "conversations").select(F.col("conv_id").alias("g"), (F.col("conv_id") * 100 + F.col("turn") * 2 + (F.col("role") == "assistant").cast("int")).alias("seq"), "text")
    return neardup.factor_pairs(d, "g", "text", 0.2, 0.35)


@query
def factor_dedup(spark, sf):
    # A document is a filing, its lines are the factors.
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("filing"), F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    return neardup.dedup_factors(d)


# Vectors: fit, gaps, novelty.


def _vec_articles(spark, sf):
    # Topic 5 has no risk, topic 8 no dated row, of the others every tenth row is undated.
    months = F.format_string("2024-%02d", (F.col("seq") % 9 + 1 + F.when(F.col("TOPIC_ID") == 3, 3).otherwise(0)).cast("int"))
    dated = (F.col("seq") % 10 != 0) & (F.col("TOPIC_ID") != 8)
    return vec_topics(spark, sf).withColumns({"RISK_ID": F.when(F.col("TOPIC_ID") != 5, F.col("RISK_ID")), "month": F.when(dated, months), "DUP_GROUP": F.floor(F.col("seq") / 2), "QUALITY_SCORE": (F.col("seq") % 11) / 10.0})


@query
def vector_centroids(spark, sf):
    c = gaps.centroids(vec_topics(spark, sf))
    return c.select(F.col("TOPIC_ID").alias("topic"), F.posexplode("centroid").alias("pos", "v")).select("topic", "pos", F.round("v", 4).alias("v"))


@query
def cosine_matrix_topk(spark, sf):
    s = gaps.similarities(gaps.centroids(vec_topics(spark, sf)), gaps.risk_vectors(vec_terms(spark, sf)))
    rank = F.row_number().over(Window.partitionBy("TOPIC_ID").orderBy(F.desc("sim"), "RISK_ID"))
    return s.withColumn("rank", rank.cast("bigint")).where("rank <= 3").select(F.col("TOPIC_ID").alias("topic"), "rank", F.col("RISK_ID").alias("risk"), F.round("sim", 4).alias("sim"))


@query
def topic_gap_scores(spark, sf):
    g = gaps.build_gaps(_vec_articles(spark, sf), vec_terms(spark, sf))
    return g.select(F.col("TOPIC_ID").alias("topic"), F.col("BEST_FIT_RISK").alias("best_risk"), "FIT", "GAP_RAW", "FIT_PERCENTILE", "GAP", F.col("BETTER_FIT_RISK").alias("better_risk"), "FIRST_SEEN", "IS_NEW", "PEAK_VOLUME", "TOTAL_ARTICLES", "AVG_QUALITY", "EMERGING_GAP_SCORE")


@query
def topic_gap_quality_having(spark, sf):
    return gaps.build_gaps(_vec_articles(spark, sf), vec_terms(spark, sf), 0.5).select(F.col("TOPIC_ID").alias("topic"), "AVG_QUALITY")


@query
def gap_payload(spark, sf):
    return gaps.gap_payload(gaps.build_gaps(_vec_articles(spark, sf), vec_terms(spark, sf)))


@query
def novelty_scores(spark, sf):
    n = gaps.novelty(gaps.centroids(vec_topics(spark, sf)), gaps.risk_vectors(vec_terms(spark, sf)))
    return n.select(F.col("TOPIC_ID").alias("topic"), F.col("NEAREST_RISK").alias("risk"), F.col("NEAREST_RISK_SIM").alias("sim"), "NOVELTY")


@query
def anchor_relevance(spark, sf):
    anchor = mean_vectors(vec_topics(spark, sf).where("seq % 4 = 0"), [], "vector")
    return gaps.relevance(gaps.centroids(vec_topics(spark, sf)), anchor).select(F.col("TOPIC_ID").alias("topic"), "RELEVANCE")


@query
def discovery_ranking(spark, sf):
    a = _vec_articles(spark, sf)
    n = gaps.novelty(gaps.centroids(a), gaps.risk_vectors(vec_terms(spark, sf))).join(gaps.first_seen(a), "TOPIC_ID")
    s = a.groupBy("TOPIC_ID").agg(F.count_distinct("DUP_GROUP").alias("stories"), F.round(F.sum(F.col("QUALITY_SCORE").cast("decimal(18,6)")).cast("double") / F.count("*"), 3).alias("quality"))
    out = n.join(s, "TOPIC_ID").withColumn("score", gaps.discovery_score(F.col("NOVELTY"), F.col("stories"), F.col("quality"), F.col("IS_NEW")))
    return out.select(F.col("TOPIC_ID").alias("topic"), "stories", "quality", "score")


def _ranked(spark, sf):
    c = gaps.centroids(vec_topics(spark, sf))
    anchor = mean_vectors(vec_topics(spark, sf).where("seq % 4 = 0"), [], "vector")
    names = F.element_at(F.array(*map(F.lit, ("Football Season", "Cyber Fraud", "Box office hits", "Bank runs"))), F.col("TOPIC_ID") % 4 + 1)
    r = gaps.novelty(c, gaps.risk_vectors(vec_terms(spark, sf))).join(gaps.relevance(c, anchor), "TOPIC_ID")
    return r.withColumns({"TOPIC_TITLE": names, "TOPIC_DESCRIPTION": F.lit("")})


@query
def candidate_tiers(spark, sf):
    return gaps.candidates(_ranked(spark, sf), report.BENIGN_TERMS).select(F.col("TOPIC_ID").alias("topic"), "tier", "combined")


@query
def scatter_encoding(spark, sf):
    s = report.scatter(_ranked(spark, sf))
    return s.select(F.col("TOPIC_ID").alias("topic"), "x_max", "y_max", "sweet", "labelled")


@query
def representative_docs(spark, sf):
    return topics.representatives(vec_topics(spark, sf)).select(F.col("TOPIC_ID").alias("topic"), F.col("rank").cast("bigint").alias("rank"), "seq")


@query
def pairwise_cosine(spark, sf):
    # The queries are the vectors whose id is divisible by 20, against all.
    v = vec_topics(spark, sf).select("seq", "vector")
    q = v.where("seq % 20 = 0").select(F.col("seq").alias("q"), F.col("vector").alias("qv"))
    return nearest(v, q, 5)


# Topics.


@query
def distinct_stories(spark, sf):
    return signal_articles(spark, sf).groupBy(F.col("TOPIC_ID").alias("topic")).agg(F.count_distinct("DUP_GROUP").alias("stories"))


@query
def peak_distinct_month(spark, sf):
    return gaps.peak_volume(signal_articles(spark, sf).where("TOPIC_ID != -1")).select(F.col("TOPIC_ID").alias("topic"), F.col("PEAK_VOLUME").alias("peak"))


@query
def dominant_sentiment(spark, sf):
    return topics.dominant(signal_articles(spark, sf)).select(F.col("TOPIC_ID").alias("topic"), F.col("DOMINANT_SENTIMENT").alias("sentiment"))


@query
def topic_risk_lists(spark, sf):
    a = signal_articles(spark, sf).groupBy("TOPIC_ID").agg(F.array_sort(F.collect_set("RISK_ID")).alias("r"))
    return a.select(F.col("TOPIC_ID").alias("topic"), F.array_join(F.transform("r", lambda x: x.cast("string")), ", ").alias("risks"), F.size("r").cast("bigint").alias("n"))


@query
def topic_summary(spark, sf):
    s = topics.summary(signal_articles(spark, sf).withColumn("ENTITIES", F.array("SOURCE")))
    return s.select(F.col("TOPIC_ID").alias("topic"), "ARTICLE_COUNT", "DISTINCT_STORIES", F.col("DISTINCT_RISK_COUNT").cast("bigint").alias("DISTINCT_RISK_COUNT"), "AVG_SENTIMENT_COMPOUND", "AVG_QUALITY", "DOMINANT_SENTIMENT", "TOP_ENTITIES")


@query
def top_entities(spark, sf):
    e = topics.most_common(signal_articles(spark, sf), "TOPIC_ID", "SOURCE", 8)
    return e.select(F.col("TOPIC_ID").alias("topic"), F.col("rank").cast("bigint").alias("rank"), F.col("value").alias("entity"), "n")


@query
def ctfidf_keywords(spark, sf):
    d = table(spark, sf, "documents").select(F.col("source").alias("TOPIC_ID"), "text")
    return topics.class_tfidf(d, "TOPIC_ID", "text", ["the", "of", "and"], 5).select(F.col("TOPIC_ID").alias("topic"), F.col("rank").cast("bigint").alias("rank"), "term", F.round("score", 6).alias("score"))


@query
def first_filled_value(spark, sf):
    d = doc_articles(spark, sf).withColumn("TITLE", F.when(F.col("seq") % 3 == 0, F.lit("  ")).otherwise(F.col("TITLE")))
    return topics.first_filled(d, "SOURCE", "TITLE").select(F.col("SOURCE").alias("source"), F.col("TITLE").alias("title"))


@query
def topic_propagation(spark, sf):
    a = signal_articles(spark, sf).select("seq", "DUP_GROUP")
    reps = a.groupBy("DUP_GROUP").agg(F.min("seq").alias("s")).where("DUP_GROUP % 5 != 0").select("DUP_GROUP", (F.col("s") % 7).cast("int").alias("TOPIC_ID"))
    return topics.propagate(a, reps).groupBy(F.col("TOPIC_ID").alias("topic")).agg(F.count("*").alias("n"))


@query
def topic_text_lookup(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("TOPIC_ID"), F.col("n_name").alias("TOPIC_TITLE"), F.lit("d").alias("TOPIC_DESCRIPTION"))
    a = topics.with_topic_text(signal_articles(spark, sf).select("seq", "TOPIC_ID"), n)
    return a.groupBy(F.col("TOPIC_TITLE").alias("title"), F.col("TOPIC_DESCRIPTION").alias("description")).agg(F.count("*").alias("n"))


@query
def topic_descriptions(spark, sf):
    s = topics.summary(signal_articles(spark, sf)).where("TOPIC_ID != -1")
    words = F.array(F.lit("alpha"), F.lit("beta"), F.concat(F.lit("t"), F.col("TOPIC_ID").cast("string")))
    risks = F.transform("RISK_IDS", lambda r: F.concat(F.lit("risk "), r.cast("string")))
    return s.select(F.col("TOPIC_ID").alias("topic"), topics.description(X.spoken_list(words), F.col("DOMINANT_SENTIMENT"), F.col("ARTICLE_COUNT"), F.lit("A headline"), risks).alias("description"))


@query
def topic_titles(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", X.title_case("p_name").alias("title"))
    return p


@query
def topic_clusters(spark, sf):
    e = vec_topics(spark, sf).select("seq", "vector")
    return topics.cluster(e, 8, cut=0.8).select("seq", "TOPIC_ID")


@query
def density_topics(spark, sf):
    e = vec_topics(spark, sf).select("seq", "vector")
    return density.density_topics(e, 10).select("seq", "TOPIC_ID")


@query
def lexicon_sentiment(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", F.concat(F.element_at(F.array(*map(F.lit, ("great growth in ", "no fraud at ", "very BAD losses of ", "plain "))), F.col("p_size") % 4 + 1), "p_name").alias("t"))
    return d.select("p_partkey", compound(F.col("t")).alias("compound"))


@query
def entity_enrichment(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("The "), F.regexp_replace("s_name", "#", " "), F.lit(" Group sued Acme Bank under the Exchange Act of 1934.")).alias("t"))
    e = enrich.with_keywords(enrich.with_entities(s, "t"), "t", ["the", "under", "of"])
    return e.select("s_suppkey", F.array_join("ENTITIES", "|").alias("entities"), F.array_join("NLP_KEYWORDS", "|").alias("keywords"))


@query
def entity_model(spark, sf):
    # Sentences of customers and their nations; the model learns from every other one and names both in all.
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", F.split("n_name", " ").alias("place"))
    rest = "sued the bank .".split()
    words = F.concat(F.array("c_name", F.lit("of")), "place", F.array(*map(F.lit, rest)))
    tags = F.concat(F.array(F.lit("B-PERSON"), F.lit("O")), F.transform("place", lambda _, i: F.when(i == 0, "B-GPE").otherwise("I-GPE")), F.array_repeat(F.lit("O"), len(rest)))
    rows = rows.select("c_custkey", words.alias("tokens"), tags.alias("tags"), F.array_join(words, " ").alias("t"))
    model = tagging.fit(rows.where("c_custkey % 2 = 0"))
    return enrich.with_entities(rows, "t", tagging.model_tagger(model)).select("c_custkey", F.array_join("ENTITIES", "|").alias("entities"))


@query
def hashed_embeddings(spark, sf):
    d = hashed_embedding(table(spark, sf, "benchmark"), "text", 16)
    return d.select("item_id", F.posexplode("vector").alias("pos", "v")).select("item_id", "pos", F.round("v", 4).alias("v"))


# The report.


@query
def articles_per_topic_topn(spark, sf):
    return report.newest_per_topic(signal_articles(spark, sf)).select(F.col("TOPIC_ID").alias("topic"), F.col("rank").cast("bigint").alias("rank"), "seq")


@query
def best_article_per_story(spark, sf):
    return report.best_per_story(signal_articles(spark, sf)).select(F.col("TOPIC_ID").alias("topic"), F.col("rank").cast("bigint").alias("rank"), "seq")


@query
def risk_articles_balanced(spark, sf):
    a = signal_articles(spark, sf).withColumn("topic", F.concat(F.lit("Topic "), F.col("TOPIC_ID").cast("string")))
    return report.balanced_picks(a).select(F.col("RISK_ID").alias("risk"), F.col("topic_rank").cast("bigint").alias("topic_rank"), "seq")


@query
def stories_by_date(spark, sf):
    s = report.stories_by_date(signal_articles(spark, sf))
    return s.select(F.col("TOPIC_ID").alias("topic"), F.col("rank").cast("bigint").alias("rank"), "seq")


@query
def facet_search(spark, sf):
    cards = topics.summary(signal_articles(spark, sf)).withColumn("TOPIC_LABEL", F.concat(F.lit("Brand "), F.col("TOPIC_ID").cast("string")))
    found = report.facets(report.search(cards, "topic 1", ["TOPIC_LABEL"]), True, None, 3)
    return report.sorted_cards(found, "count").select(F.col("TOPIC_ID").alias("topic"), "ARTICLE_COUNT")


@query
def indexed_search(spark, sf):
    # Every document is a card; three queries, of which one is shorter than a trigram.
    d, path = table(spark, sf, "documents").select(F.col("doc_id").alias("TOPIC_ID"), "text"), scratch(spark, "index")
    search.write_index(d, path, ["text"])
    found = [search.find(spark, path, q).select(F.lit(q).alias("query"), F.col("TOPIC_ID").alias("doc")) for q in ("All rights", "topic 7", "ß")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def estimated_stories(spark, sf):
    # Distinct stories of each topic in all, and in its months of 1995, from monthly sketches of two halves of the articles.
    a = signal_articles(spark, sf)
    stored = sketches.merged(*(sketches.monthly(a.where(F.col("seq") % 2 == k)) for k in (0, 1)))
    exact = a.groupBy("TOPIC_ID").agg(F.count_distinct("DUP_GROUP").alias("stories"), F.count_distinct(F.when(F.col("month").between("1995-01", "1995-12"), F.col("DUP_GROUP"))).alias("of_year"))
    for name, span in (("n", {}), ("n_year", {"first": "1995-01", "last": "1995-12"})):
        exact = exact.join(sketches.distinct_counts(stored, "TOPIC_ID", **span).withColumnRenamed("n", name), "TOPIC_ID", "left")
    near = lambda n, about: F.abs(F.col(n) - F.coalesce(about, F.lit(0))) <= F.greatest(F.lit(1.0), F.col(n) * sketches.error())
    return exact.select(F.col("TOPIC_ID").alias("topic"), "stories", near("stories", "n").alias("near"), "of_year", near("of_year", "n_year").alias("near_of_year"))


@query
def corpus_weights(spark, sf):
    # The statistics see the documents in two additions; the benchmark's words are weighed by them.
    d, path = table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text"), scratch(spark, "statistics")
    for k in (0, 1):
        version = embeddings.add_documents(d.where(F.col("key") % 2 == k), path)
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("key"), "text")
    return embeddings.weights(b, path, version).select(F.col("key").alias("item"), "word", F.round("weight", 6).alias("weight"))


@query
def sentiment_histogram(spark, sf):
    a = signal_articles(spark, sf).withColumn("SENTIMENT", F.when(F.col("SENTIMENT") != "Neutral", F.col("SENTIMENT")))
    return report.sentiment_histogram(a).select(F.col("SENTIMENT").alias("sentiment"), "n")


@query
def topics_per_risk(spark, sf):
    return report.topics_per_risk(signal_articles(spark, sf)).select(F.col("RISK_ID").alias("risk"), "topics")


@query
def top_topics_per_risk(spark, sf):
    t = report.top_topics_per_risk(_by_risk(spark, sf))
    return t.select(F.col("RISK_ID").alias("risk"), F.col("rank").cast("bigint").alias("rank"), F.col("TOPIC_ID").alias("topic"), "peak_intensity", "risk_momentum", "risk_peak")


@query
def topic_payload(spark, sf):
    a = signal_articles(spark, sf)
    cards = topics.summary(a).select("TOPIC_ID", "ARTICLE_COUNT", "DOMINANT_SENTIMENT")
    arts = report.nested_articles(report.newest_per_topic(a, 3, 2), ["seq", "LINK"])
    p = report.payload(cards, arts)
    return p.select(F.col("TOPIC_ID").alias("topic"), F.get_json_object("json", "$.ARTICLE_COUNT").cast("bigint").alias("n"), F.get_json_object("json", "$.articles[0].seq").cast("bigint").alias("newest"), F.size(F.from_json(F.get_json_object("json", "$.articles"), "array<struct<seq:bigint>>")).alias("listed"))


@query
def report_order(spark, sf):
    n = report.preferred_order(table(spark, sf, "nation").select("n_name"), "n_name", ["JAPAN", "CHINA"])
    return n.select("n_name")


@query
def display_counts(spark, sf):
    a = signal_articles(spark, sf).groupBy("RISK_ID").agg(F.count("*").alias("n"))
    return a.select(F.col("RISK_ID").alias("risk"), X.display_count("n").cast("bigint").alias("shown"))


# Sources.


@query
def taxonomy_union(spark, sf):
    n = table(spark, sf, "nation")
    encoded = n.select(F.col("n_regionkey").cast("string").alias("RISK_ID"), F.col("n_nationkey").cast("string").alias("SEARCH_TERM_ID"), encode_terms(F.concat(F.lit(' "'), F.col("n_name"), F.lit('"'))).alias("ENCODED_TERMS"))
    ent = taxonomy.decode_taxonomy(encoded)
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("RISK_ID"), F.lit(0).alias("term_no"), F.col("r_name").alias("term"))
    m = taxonomy.risk_map(taxonomy.both(ent, r))
    return m.select("namespace", F.col("RISK_ID").alias("risk"), "label", F.array_join("terms", "|").alias("terms"))


@F.pandas_udf(T.StringType())
def encode_terms(values):
    return values.map(encode_text)


@query
def asof_carry_forward(spark, sf):
    t = table(spark, sf, "conversations").select("conv_id", (F.col("turn") * 2 + (F.col("role") == "assistant").cast("int")).alias("pos"), "role", F.length("text").alias("n"))
    a = documents.as_of(t, ["conv_id"], "pos", F.when(F.col("role") == "user", F.col("n")), "asked")
    return a.where("role = 'assistant'").select("conv_id", "pos", "n", "asked")


@query
def segment_split(spark, sf):
    t = table(spark, sf, "conversations").withColumn("pos", F.col("turn") * 2 + (F.col("role") == "assistant").cast("int"))
    whole = t.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))), lambda s: F.concat(F.lit("@"), s["role"], F.lit(": "), F.regexp_replace(s["text"], "@", ""))), " ").alias("whole"))
    heads = documents.pieces(whole, "@(user|assistant|system): ", "turn", "whole", ("conv_id",))
    end = F.lead("pos").over(Window.partitionBy("conv_id").orderBy("pos"))
    cut = heads.withColumn("end", end).join(whole, "conv_id")
    return cut.select("conv_id", "pos", F.col("value").alias("role"), (F.coalesce("end", F.length("whole")) - F.col("pos")).alias("n"))


@query
def listing_links(spark, sf):
    p = table(spark, sf, "pages").select(F.col("page_id").alias("doc"), F.concat(F.lit('<time datetime="2024-01-05T00:00">'), F.col("html"), F.lit('<time class=x datetime="2024-02-07"><a href="/last">x</a>')).alias("html"))
    return documents.dated_links(p, r'<a href="(/[^"]*)"').select("doc", "link", "date")


@query
def action_split(spark, sf):
    # A compilation holds the customers of a nation in a range of 600 keys.
    d = table(spark, sf, "customer").withColumn("doc", F.floor(F.col("c_custkey") / 600) * 25 + F.col("c_nationkey"))
    name = F.concat(F.initcap(F.lower(F.regexp_replace("c_name", "[#0-9]+", ""))), F.lit(" Co (CRD #"), F.col("c_custkey").cast("string"), F.lit(", Rome, NY)"))
    line = F.concat(F.when(F.col("c_custkey") % 5 == 0, F.lit("Firms Fined\n")).otherwise(F.lit("")), name, F.lit(" was fined. "), F.repeat(F.lit("It did so again. "), (F.col("c_custkey") % 12).cast("int")))
    whole = d.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("t")))), lambda s: s["t"]), "\n").alias("text"))
    a = documents.split_actions(whole)
    return a.select("doc", "name", F.length("body").alias("n"), "section", documents.action_title(F.col("name"), F.col("body")).alias("title"))


@query
def factor_split(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("filing"), F.regexp_replace("text", "\n", "\n\n").alias("text"))
    return documents.factors(d).select("filing", "seq", F.length("text").alias("n"), documents.factor_title(F.col("text")).alias("title"))


@query
def legal_scrub(spark, sf):
    d = table(spark, sf, "supplier")
    t = F.concat(F.lit("The Commission finds , pursuant to Section 5, that "), F.col("s_name"), F.lit(" owed disgorgement , a civil penalty and cease-and-desist relief ."))
    return d.select("s_suppkey", documents.scrubbed(t).alias("text"))


@query
def digest_stories(spark, sf):
    # A digest holds the orders of a priority in a range of 2000 keys.
    o = table(spark, sf, "orders")
    block = F.concat(F.lit("Reuters, "), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("\nOrder "), F.col("o_orderkey").cast("string"), F.lit("\nBy A Clerk\nA summary.\nMore of it.\nRead article online\nAlso:\nOther "), F.col("o_orderkey").cast("string"), F.lit(" - Barron (Paywalled)\n"))
    whole = o.groupBy("o_orderpriority", F.floor(F.col("o_orderkey") / 2000)).agg(F.concat(F.lit("Markets\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", block.alias("b")))), lambda s: s["b"]), "\n")).alias("text"))
    return digest.parse_digests(whole).select("title", "source", "date", "summary", "byline", "section", "paywalled", "primary")


@query
def structured_rows(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("Headline"), F.when(F.col("c_custkey") % 2 == 0, "yes").otherwise("no").alias("PAYWALLED"), F.lit("2024-05-06").alias("Date"), F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_mktsegment")).alias("title"))
    return digest.structured_stories(c).select("title", "paywalled", "date")


ENDPOINT = "https://api.test/1/news"


@query
def keyword_scan(spark, sf):
    # The answers to a nation's scan: as many articles as its name has letters, three a page; one story turns up under every name.
    terms = table(spark, sf, "nation").select(F.col("n_nationkey").alias("RISK_ID"), F.col("n_name").alias("term"))
    plan = lanes.keyword_plan(terms, ENDPOINT, 3)
    letters = F.length("term")
    page = plan.withColumn("page", F.explode(F.sequence(F.lit(0), F.floor((letters - 1) / 3).cast("int"))))
    link = lambda k: F.when(k == 1, "http://same/").otherwise(F.concat(F.lit("http://"), F.lower("term"), F.lit("/"), k.cast("string")))
    item = lambda k: F.struct(F.concat_ws(" ", "term", k.cast("string")).alias("title"), link(k).alias("link"), F.lit("2024-05-06").alias("pubDate"), F.when(k == 0, "wire").alias("source_id"))
    places = F.sequence(F.col("page") * 3, F.least(F.col("page") * 3 + 2, letters - 1))
    body = F.to_json(F.struct(F.transform(places, item).alias("results"), F.when(F.col("page") * 3 + 3 < letters, (F.col("page") + 1).cast("string")).alias("nextPage")))
    token = F.when(F.col("page") == 0, "").otherwise(F.col("page").cast("string"))
    answers = page.select("url", token.alias("token"), F.when(F.col("term").startswith("A"), 404).otherwise(200).alias("status"), body.alias("body"))
    found = lanes.scan_stored(plan, answers, scratch(spark, "scan"), rows=8, size=3)
    known = terms.where("term = 'BRAZIL'").select(F.concat(F.lit("HTTP://"), "term", F.lit("/0 ")).alias("LINK"))
    return lanes.fresh(found, known, "RISK_ID").select(F.col("RISK_ID").alias("risk"), F.col("GOOGLE_INDEX").alias("place"), F.col("TITLE").alias("title"), F.col("LINK").alias("link"), F.col("SOURCE").alias("source"), "requests")


@query
def latest_scan_plan(spark, sf):
    wanted = table(spark, sf, "region").select(F.lower("r_name").alias("name"))
    return lanes.latest_scans(wanted, ENDPOINT, "name").select("lane", F.col("CATEGORY").alias("category"), "url")


@query
def lexicon_scan_plan(spark, sf):
    wanted = table(spark, sf, "part").select(F.lower("p_type").alias("phrase")).distinct()
    return lanes.phrase_scans(wanted, ENDPOINT).select("lane", F.col("CATEGORY").alias("category"), "url")


@query
def regulator_lane(spark, sf):
    # A nation has a listing page of the SEC and one of the CFTC, each customer of it a release on both.
    n = topics.spread(table(spark, sf, "customer").select(F.col("c_nationkey").alias("doc"), "c_custkey", "c_name"))
    key = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    sec, cftc = F.concat(F.lit("/newsroom/press-releases/2024-"), key), F.concat(F.lit("/PressRoom/PressReleases/"), F.substring(key, 1, 4), F.lit("-"), F.substring(key, 5, 2))
    item = lambda link: F.concat(F.when(F.col("c_custkey") % 3 == 0, F.lit('<time datetime="2024-02-03">')).otherwise(F.lit("")), F.lit('<a href="'), link, F.lit('">x</a>'))
    page = lambda agency, link: n.groupBy("doc").agg(F.lit(agency).alias("agency"), F.lit("press release").alias("category"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", item(link).alias("t")))), lambda s: s["t"]), "\n").alias("html"))
    links = lanes.listed(page("SEC", sec).unionByName(page("CFTC", cftc)))
    body = F.concat(F.lit("<html><head><title>T | SEC.gov</title></head><body><h1>Release of "), F.col("c_name"), F.lit("</h1><p>"), F.repeat(F.lit("word "), (F.col("c_custkey") % 80).cast("int")), F.lit("</p></body></html>"))
    bodies = n.select(F.concat(F.lit("https://www.sec.gov"), sec).alias("url"), body.alias("html")).unionByName(n.select(F.concat(F.lit("https://www.cftc.gov"), cftc).alias("url"), body.alias("html")))
    return lanes.releases(links, bodies, "2024-01-01").select(F.col("link").alias("url"), "source", "date", "title", F.length("text").alias("n"))


@query
def enforcement_bodies(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    long = F.repeat(F.concat(F.lit("The firm "), F.col("s_name"), F.lit(" did so. ")), 30)
    order = F.concat(F.lit("ORDER INSTITUTING PROCEEDINGS I. Caption. III. "), long)
    release = F.concat(F.lit("Litigation Release No. 123 / January 5, 2024 \nSEC Charges Firm With Fraud\n"), long)
    b = s.select("s_suppkey", F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("url"), F.when(F.col("s_suppkey") % 2 == 0, "administrative_proceeding").otherwise("litigation_release").alias("kind"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, order).otherwise(release).alias("text"))
    return lanes.enforcement(b).select("url", "kind", "title", F.md5(F.col("text").cast("binary")).alias("md5"))


@query
def enforcement_listing(spark, sf):
    # Up to 200 customers of a nation are the rows of a listing of each stream, every row twice; every third has a date of its own.
    c = table(spark, sf, "customer").select("c_custkey", "c_name", (F.col("c_nationkey") * 1_000_000 + F.floor(F.col("c_custkey") / 200)).alias("doc"), F.when(F.col("c_custkey") % 2 == 0, "admin").otherwise("litigation").alias("stream"))
    # A row becomes a text of some kilobytes, so a task takes 20,000 of them.
    c = c.repartition(max(spark.sparkContext.defaultParallelism, -(-c.count() // 20_000)), "c_custkey")
    k = F.col("c_custkey").cast("string")
    row = F.concat(F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('<time datetime="2024-03-0'), (F.col("c_custkey") % 9 + 1).cast("string"), F.lit('T10:00">'))).otherwise(F.lit("")), F.lit("<td class='release-view__respondents'><a href='/lit/"), k, F.lit("' hreflang=en>"), F.col("c_name"), F.lit(" <b>and\n others</b></a></td>"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("t")))), lambda s: s["t"]), "")
    pages = c.groupBy("doc", "stream").agg(rows.alias("html")).withColumn("html", F.concat("html", "html"))
    long = F.repeat(F.concat(F.lit("The firm "), F.col("c_name"), F.lit(" did so. ")), 30)
    text = F.concat(F.when(F.col("stream") == "admin", "ORDER INSTITUTING PROCEEDINGS I. Caption. III. ").otherwise("Litigation Release No. 123 / January 5, 2024 \nSEC Charges Firm With Fraud\n"), long)
    bodies = c.select(F.concat(F.lit("https://www.sec.gov/lit/"), k).alias("url"), text.alias("text"))
    return lanes.enforcement_articles(lanes.enforcement_listed(pages), bodies).select("title", F.md5(F.col("text").cast("binary")).alias("md5"), "source", "date", "link", "category")


@query
def action_articles(spark, sf):
    # A monthly file holds up to 200 customers of a nation.
    c = table(spark, sf, "customer").withColumn("doc", F.col("c_nationkey") * 1_000_000 + F.floor(F.col("c_custkey") / 200))
    name = F.concat(F.lit("Firm Co (CRD #"), F.col("c_custkey").cast("string"), F.lit(", Rome, NY)"))
    line = F.concat(F.when(F.col("c_custkey") % 7 == 0, F.lit("Individuals  Barred\n")).otherwise(F.lit("")), name, F.lit(" was fined. "), F.repeat(F.lit("It did so again. "), (F.col("c_custkey") % 12).cast("int")))
    url = F.format_string("/files/2024-%02d/n%d.pdf", (F.col("doc") % 12 + 1).cast("int"), F.col("doc"))
    files = c.groupBy(url.alias("url")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("t")))), lambda s: s["t"]), "\n").alias("text"))
    a = corpus.normalise(lanes.actions(files), "ENFORCEMENT", "enforcement:", F.lit(0.0))
    return a.select("SEARCH_TERM_ID", "TITLE", F.length("SUMMARY").alias("n"), "SOURCE", "PUBLISHED_DATE", "LINK", "CATEGORY")


@query
def monthly_files(spark, sf):
    o = table(spark, sf, "orders")
    by_folder = F.concat(F.lit("/sites/files/"), F.date_format("o_orderdate", "yyyy-MM"), F.lit("/actions.pdf"))
    by_name = F.concat(F.lit("/files/disciplinary-actions-"), F.lower(F.date_format("o_orderdate", "MMMM")), F.lit("-"), F.date_format("o_orderdate", "yyyy"), F.lit(".pdf"))
    files = o.select(F.when(F.col("o_orderkey") % 3 == 0, by_folder).when(F.col("o_orderkey") % 3 == 1, by_name).otherwise(F.lit("/files/other.pdf")).alias("url"))
    return lanes.newest_files(files, 12)


@query
def latest_filings(spark, sf):
    o = table(spark, sf, "orders")
    forms = F.element_at(F.array(*map(F.lit, ("10-K", "10-Q", "10-K/A"))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    f = o.select(F.concat(F.lit("T"), (F.col("o_custkey") % 50).cast("string")).alias("ticker"), forms.alias("form"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderkey").cast("string").alias("link"))
    return lanes.latest_filings(f, [f"T{k}" for k in range(40)], ["10-K", "10-Q"], 2).select("ticker", "form", F.col("rank").cast("bigint").alias("rank"), "date", "link")


@query
def filing_sections(spark, sf):
    p = table(spark, sf, "part")
    t = F.concat(F.lit("Contents Item 1A. Risk Factors 12 Item 2 Properties 20\nItem 1A. Risk Factors\n"), F.repeat(F.concat(F.col("p_name"), F.lit(" may fail. ")), F.col("p_size")), F.when(F.col("p_size") % 2 == 0, F.lit("ITEM 1B. Unresolved")).otherwise(F.lit("")))
    return p.select("p_partkey", F.md5(lanes.risk_section(t).cast("binary")).alias("md5"))


@query
def filing_factors(spark, sf):
    # A part has a filing of three factors, of which the third says the first again.
    p = topics.spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_type"))
    first = F.repeat(F.concat(F.lit("Our caf&eacute; \u2013 "), F.col("p_name"), F.lit(" may fail to meet demand. ")), 8)
    second = F.repeat(F.concat(F.lit("Rules &amp; taxes of "), F.col("p_type"), F.lit(" could rise at any time and hurt. ")), 8)
    whole = F.concat(F.lit("Item 1A. Risk Factors\n\n"), first, F.lit("\n\n"), second, F.lit("\n\n"), first, F.lit("Once more, na\u00efvely.\n\nItem 1B. Unresolved"))
    out = lanes.filing_factors(p.select("p_partkey", whole.alias("text")), "p_partkey")
    return out.select("p_partkey", F.md5(F.col("text").cast("binary")).alias("md5"), "title")


@query
def text_repair(spark, sf):
    p = table(spark, sf, "part")
    # Bytes of "é" and of a dash read as Latin-1; a lone mark that only the table knows; nothing odd.
    odd = F.element_at(F.array(*map(F.lit, ("caf\xc3\xa9 \x93 ", "\xab ", "caf\xc3\xa9 ", "plain "))), F.col("p_size") % 4 + 1)
    return p.select("p_partkey", X.repaired(F.concat(odd, F.col("p_name"))).alias("text"))


@query
def ascii_spelling(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.transliterated(F.concat(F.lit("“Café”\xa0—  naïve… "), F.col("p_name"))).alias("text"))


@query
def corpus_newest_first(spark, sf):
    a = signal_articles(spark, sf).select("seq", "PUBLISHED_DATE").withColumn("PUBLISHED_DATE", F.when(F.col("seq") % 7 != 0, F.col("PUBLISHED_DATE")))
    return corpus.renumbered(a, F.desc_nulls_last("PUBLISHED_DATE"), "seq", column="place").select("seq", "place")


@query
def risk_labels(spark, sf):
    n = table(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("RISK_ID"), F.col("n_name").alias("label"))
    a = topics.labelled(signal_articles(spark, sf).select("RISK_ID"), n, "RISK_ID", "label", "unknown")
    return a.groupBy("label").agg(F.count("*").alias("n"))


@query
def topics_merged(spark, sf):
    a = topics.merged(vec_topics(spark, sf), 4)
    return a.groupBy(F.col("TOPIC_ID").alias("topic")).agg(F.count("*").alias("n"))


@query
def topics_large_enough(spark, sf):
    a = topics.large_enough(signal_articles(spark, sf).select("TOPIC_ID"), 240)
    return a.groupBy(F.col("TOPIC_ID").alias("topic")).agg(F.count("*").alias("n"))


# Stage files, caches, transports and the settings of a run.


@query
def stage_csv(spark, sf):
    # Titles with commas, quotes, breaks and spaces at their ends, through a CSV stage and back.
    odd = F.element_at(F.array(*map(F.lit, (' said "no", twice', "\nnext line", " ", "\\"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("RISK_ID"), F.concat("c_name", odd).alias("TITLE"), F.col("c_acctbal").cast("double").alias("SENTIMENT_COMPOUND"), F.array("c_mktsegment", "c_name").alias("ENTITIES"))
    path = f"{stages.scratch(spark, 'stage')}/articles.csv"
    stages.write_stage(c, path, csv=True)
    a = stages.read_articles(spark, path)
    return a.select(F.col("RISK_ID").alias("risk"), F.md5(F.col("TITLE").cast("binary")).alias("title"), F.col("SENTIMENT_COMPOUND").alias("tone"), F.col("ENTITIES").alias("entities"), F.col("LINK").isNull().alias("no_link"))


@query
def stage_by_month(spark, sf):
    path = stages.scratch(spark, "stage")
    stages.write_stage(signal_articles(spark, sf).select("RISK_ID", "month", "SENTIMENT_COMPOUND"), path, by_month="month")
    a = stages.read_articles(spark, path).where("month >= '1995-01'")
    return a.groupBy("month").agg(F.count("*").alias("n"), F.count_if(F.col("SENTIMENT_COMPOUND") < 0).alias("negative"))


@query
def report_pages(spark, sf):
    p = table(spark, sf, "part")
    size = F.col("p_size").cast("string")
    stats = F.concat(F.lit('{"stats": {"totalArticles": '), size, F.lit(', "topicCount": 7}, "trends": {"months": ["2024-01", "m'), size, F.lit('"]}, "x": "<\\/p>"}'))
    line = F.concat(F.lit("<script>\nconst DATA = "), stats, F.lit(";\nlet a = 1;\n</script>"))
    element = F.concat(F.lit('<script id="d" type="application/json">'), stats, F.lit("</script>"))
    data = F.element_at(F.array(line, element, F.lit("<script>\nconst DATA = {no json;\n</script>"), F.lit("")), (F.col("p_partkey") % 4 + 1).cast("int"))
    html = F.concat(F.lit("<html><head><TITLE> "), F.col("p_name"), F.lit("\n</TITLE></head><body>"), data, F.lit("</body></html>"))
    found = documents.report_pages(p.select("p_partkey", html.alias("html")))
    return found.select("p_partkey", "title", "articles", "topics", F.array_join("months", ",").alias("months"))


def unsteady_transport():
    """Answers on the third request of an address; some addresses are gone, some never answer."""
    asked: dict[str, int] = {}

    def get(url: str) -> tuple[int, bytes]:
        asked[url] = asked.get(url, 0) + 1
        key = int(url.rsplit("/", 1)[1])
        if key % 3 == 0:
            return 404, f"{asked[url]}".encode()
        if key % 3 == 1 and asked[url] == 1:
            raise OSError("reset")
        return (503 if key % 3 == 2 or asked[url] < 3 else 200), f"{asked[url]}".encode()

    return get


@query
def fetch_retries(spark, sf):
    n = table(spark, sf, "nation").select(F.concat(F.lit("http://n/"), F.col("n_nationkey").cast("string")).alias("url"))
    got = fetch.fetched(n.unionAll(n), unsteady_transport(), wait=0.0)
    return got.select("url", "status", F.col("body").cast("string").alias("requests"))


@query
def embedding_cache(spark, sf):
    # The second run encodes only the texts that the first one lacked: keys are met once in the cache.
    d = table(spark, sf, "documents").select("doc_id", "text")
    path = f"{stages.scratch(spark, 'cache')}/vectors"
    encode = lambda texts: hashed_embedding(texts, "text", 4)
    encode_cached(d.where("doc_id % 2 = 0"), encode, path, "m")
    encode_cached(d, encode, path, "m")
    cached = read_cache(spark, path, "key string, vector array<float>")
    return cached.groupBy("key").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size"))


@query
def quality_validity(spark, sf):
    # Scores that are all alike (nulls count as 0) are made anew, others are kept.
    d = doc_articles(spark, sf)
    kept = Q.with_quality(d.withColumn("QUALITY_SCORE", F.when(F.col("seq") % 2 == 0, F.lit("0.25"))))
    anew = Q.with_quality(d.withColumn("QUALITY_SCORE", F.when(F.col("seq") % 2 == 0, F.lit("0"))))
    return kept.select("seq", F.col("QUALITY_SCORE").alias("kept")).join(anew.select("seq", F.round("QUALITY_SCORE", 3).alias("anew")), "seq")


@query
def lane_articles(spark, sf):
    s = table(spark, sf, "supplier")
    category = F.element_at(F.array(*map(F.lit, ("order", " ", "nan"))), (F.col("s_suppkey") % 3 + 1).cast("int"))
    items = s.select(F.col("s_name").alias("title"), F.substring(F.repeat("s_name", 5), F.lit(1), 30 + F.col("s_suppkey").cast("int") % 60).alias("text"), F.lit("SEC").alias("source"), F.lit("2024-02-03").alias("date"), F.concat(F.lit("http://s/"), F.col("s_suppkey").cast("string")).alias("link"), category.alias("category"))
    a = corpus.normalise(items, "ENF", "enforcement:", F.round(F.length("text") / F.lit(100.0) - 0.5, 2), cap=60)
    return a.select("LINK", "RISK_ID", "SEARCH_TERM_ID", "TITLE", "SUMMARY", "CATEGORY", "SENTIMENT", F.round("QUALITY_SCORE", 3).alias("quality"), F.col("GOOGLE_INDEX").isNull().alias("no_place"))


@query
def pdf_punctuation(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.mapped(F.concat(F.lit("ô"), F.col("p_name"), F.lit("ö Õs \x93q\x94 1ñ2 Acme®")), X.PDF_PUNCTUATION).alias("text"))


@query
def clean_values(spark, sf):
    p = table(spark, sf, "part")
    raw = F.element_at(F.array(F.lit("NaN"), F.lit(" "), F.lit("x1"), F.col("p_size").cast("string"), F.lit(None)), (F.col("p_size") % 5 + 1).cast("int"))
    return p.select("p_partkey", X.clean_number(raw).alias("number"), X.clean_string(raw).alias("word"))


@query
def slug_titles(spark, sf):
    p = table(spark, sf, "part")
    end = F.element_at(F.array(*map(F.lit, ("", "/", ".html", ".pdf?x=a-b#c"))), (F.col("p_size") % 4 + 1).cast("int"))
    return p.select("p_partkey", X.slug_title(F.concat(F.lit("https://x/y-z/"), F.when(F.col("p_size") % 5 == 0, "2024-17-").otherwise(""), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("_"), F.col("p_size").cast("string"), end)).alias("title"))


@query
def topic_labels(spark, sf):
    p = table(spark, sf, "part")
    words = F.slice(F.split(F.concat_ws(" ", "p_name", "p_type"), " "), F.lit(1), F.col("p_size") % 6)
    return p.select("p_partkey", topics.topic_label(words).alias("label"))


@query
def run_settings(spark, sf):
    # What a run derives from its options and the size of its corpus: a nation is a corpus of its customers, its key the months.
    n = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).withColumn("days", X.look_back("c_nationkey"))
    out = n.select("c_nationkey", "days", X.windowed_path(F.lit("out/topics.csv"), F.col("days")).alias("file"), X.windowed_path(F.lit("out/topics"), F.col("days")).alias("folder"), topics.topic_shape(F.col("n")).alias("shape"))
    return out.select(F.col("c_nationkey").alias("months"), "days", "file", "folder", "shape.*")


@query
def model_places(spark, sf):
    # Of folders named after nations those with an even length hold a model.
    names = table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    there = names.where(F.length("name") % 2 == 0).select(F.col("name").alias("path")).unionByName(names.where("length(name) % 3 = 0").select(F.concat(F.lit("/cache/"), "name").alias("path")))
    models = names.withColumn("candidates", F.array(F.concat(F.lit("/models/"), "name"), F.concat(F.lit("/cache/"), "name", F.lit("/"))))
    return model_places_of(models, there)


# Streams: the events are read as a stream to their end, results are a table the stream writes.


def _streamed(spark, sf, form, mode):
    # As a pattern the path may be a file or a folder. In complete mode a batch writes all results, so files come many at a time.
    events = stream.read_events(spark, f"{sf}/event[s].parquet", table(spark, sf, "events").schema, 1 if mode == "append" else 1000)
    return stream.to_table(form(events), mode)


@query
def stream_tumbling_counts(spark, sf):
    return _streamed(spark, sf, stream.tumbling, "complete")


@query
def stream_sliding_counts(spark, sf):
    return _streamed(spark, sf, stream.sliding, "complete")


@query
def stream_sessions(spark, sf):
    return _streamed(spark, sf, stream.sessions, "complete")


@query
def stream_closed_days(spark, sf):
    events = stream.read_events(spark, f"{sf}/event[s].parquet", table(spark, sf, "events").schema)
    return windows.run_periods(windows.closed_periods(events, "event_type", "D"))[0]


@query
def incremental_trends(spark, sf):
    # Three batches, the months of the third also in those before it.
    path = scratch(spark, "trends")
    for n, rows in enumerate([F.col("seq") % 5 > 1, F.col("seq") % 5 == 1, F.col("seq") % 5 == 0]):
        kept.add_batch(spark, path, n, signal_articles(spark, sf).where(rows), count=8)
    months, topics_, risks = kept.read_trends(spark, path, 2)
    joined = months.join(topics_.select("TOPIC_ID", "TREND_SLOPE", "MOMENTUM", "TOTAL_ARTICLES"), "TOPIC_ID")
    return joined.select(F.col("TOPIC_ID").alias("topic"), "month", "volume", "share_of_coverage", "intensity", "TREND_SLOPE", "MOMENTUM", "TOTAL_ARTICLES")


@query
def stream_dedup(spark, sf):
    return _streamed(spark, sf, lambda e: stream.deduplicated(e, "user_id").select("user_id"), "append")
