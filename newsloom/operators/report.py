"""Result tables of the report: picks, facets, statistics, payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X

PER_TOPIC, PER_OUTLIER, PER_STORY_LIST = 60, 40, 25
TOPICS_PER_RISK, ARTICLES_PER_RISK_TOPIC = 8, 6

# Words that mark a topic as no candidate, fixed values.
BENIGN_TERMS = [
    "season", "football", "nfl", "game", "week ", "movie", "movies", "series", "film", "film tv", "audiovisual", "basque", "load browser", "javascript", "browser", "network issues", "cleaning", "scorpio", "leo",
    "zodiac", "horoscope", "celebrity", "prime day", "iphone", "trailer", "box office", "streaming", "album", "recipe",
]

# Phrases of risk-shaped stories, fixed values.
RISK_PHRASES = [
    "emerging risk", "systemic risk", "unprecedented", "first-of-its-kind", "novel threat", "unintended consequences", "regulatory loophole", "unregulated", "regulatory gap", "regulators warn", "watchdog warns",
    "SEC warns", "warns of risk", "flagged as a risk", "under scrutiny", "calls for regulation", "growing threat", "mounting concern", "market disruption", "vulnerability exposed", "systemic threat",
]


def newest_per_topic(df: DataFrame, n: int = PER_TOPIC, outliers: int = PER_OUTLIER, ts="ts", seq="seq") -> DataFrame:
    """Each topic's newest articles; fewer of the outliers. Undated ones come last."""
    rank = F.row_number().over(Window.partitionBy("TOPIC_ID").orderBy(F.desc_nulls_last(ts), seq))
    # The plain limit, which is never the smaller one, lets each task cut a topic before it is sorted whole.
    return df.withColumn("rank", rank).where(F.col("rank") <= max(n, outliers)).where(F.col("rank") <= F.when(F.col("TOPIC_ID") == -1, outliers).otherwise(n))


def best_per_story(df: DataFrame, n: int = PER_STORY_LIST, seq="seq") -> DataFrame:
    """The best article of each story (duplicate group), and each topic's n best of those."""
    best = Window.partitionBy("TOPIC_ID", "DUP_GROUP").orderBy(F.desc("QUALITY_SCORE"), seq)
    once = df.where("TOPIC_ID != -1").withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")
    rank = F.row_number().over(Window.partitionBy("TOPIC_ID").orderBy(F.desc("QUALITY_SCORE"), seq))
    return once.withColumn("rank", rank).where(F.col("rank") <= n)


def noise_topic(name: Column) -> Column:
    low = F.lower(F.coalesce(name, F.lit("")))
    return (low == "") | low.contains("outlier") | low.contains("unclustered")


def _spread_picks(frames):
    """Rows sorted by risk, topic rank and recency: a row goes if its story, link or title was picked before in its risk."""
    risk, topic, n = None, None, 0
    groups, links, titles = set(), set(), set()
    for pdf in frames:
        keep = []
        for i, (r, t, group, link, title) in enumerate(zip(pdf["RISK_ID"], pdf["topic_rank"], pdf["DUP_GROUP"], pdf["LINK"], pdf["norm_title"], strict=True)):
            if r != risk:
                risk, topic = r, None
                groups, links, titles = set(), set(), set()
            if t != topic:
                topic, n = t, 0
            if n >= ARTICLES_PER_RISK_TOPIC or link in links or group in groups or (title and title in titles):
                continue
            groups.add(group)
            links.add(link)
            titles.add(title)
            n += 1
            keep.append(i)
        yield pdf.iloc[keep][["RISK_ID", "topic_rank", "seq"]]


def balanced_picks(df: DataFrame, seq="seq", ts="ts") -> DataFrame:
    """Up to 6 newest articles of each of a risk's 8 largest topics, no story, link or title twice.

    Whether a row is picked depends on those picked before it, so a risk is streamed through one
    task, which holds the 48 picks at most. Of rows equal in story, link and title only the newest
    of a topic can ever be picked, so the others are merged into it before.
    """
    rows = df.where(~noise_topic(F.col("topic")))
    sizes = rows.groupBy("RISK_ID", "topic").agg(F.count("*").alias("n"))
    ranked = sizes.withColumn("topic_rank", F.row_number().over(Window.partitionBy("RISK_ID").orderBy(F.desc("n"), "topic"))).where(F.col("topic_rank") <= TOPICS_PER_RISK)
    own = rows.where(F.col("LINK").startswith("http")).withColumn("norm_title", X.normal_title("TITLE"))
    newest = F.struct(F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(1 << 62))).alias("when"), (-F.col(seq)).alias("before"))
    merged = own.groupBy("RISK_ID", "topic", "DUP_GROUP", "LINK", "norm_title").agg(F.max(newest).alias("at"))
    placed = merged.join(ranked.select("RISK_ID", "topic", "topic_rank"), ["RISK_ID", "topic"])
    placed = placed.select("RISK_ID", "topic_rank", "DUP_GROUP", "LINK", "norm_title", (-F.col("at.before")).alias("seq"), "at.when")
    ordered = placed.repartition("RISK_ID").sortWithinPartitions("RISK_ID", "topic_rank", F.desc("when"), "seq")
    return ordered.mapInPandas(_spread_picks, "RISK_ID int, topic_rank int, seq long")


def search(cards: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Cards that hold the query in one of the columns or as "topic <id>", in any case."""
    blob = F.lower(F.concat_ws(" ", *columns, F.concat(F.lit("topic "), F.col("TOPIC_ID").cast("string"))))
    return cards.where(F.contains(blob, F.lit(query.strip().lower())))


def facets(cards: DataFrame, hide_outliers=True, sentiment: str | None = None, risk: int | None = None) -> DataFrame:
    if hide_outliers:
        cards = cards.where("TOPIC_ID != -1")
    if sentiment:
        cards = cards.where(F.col("DOMINANT_SENTIMENT") == sentiment)
    if risk is not None:
        cards = cards.where(F.array_contains("RISK_IDS", risk))
    return cards


CARD_ORDERS = {
    "count": [F.desc, "ARTICLE_COUNT"],
    "risks": [F.desc, "DISTINCT_RISK_COUNT"],
    "positive": [F.desc, "AVG_SENTIMENT_COMPOUND"],
    "negative": [F.asc, "AVG_SENTIMENT_COMPOUND"],
}


def sorted_cards(cards: DataFrame, by: str = "count") -> DataFrame:
    direction, column = CARD_ORDERS[by]
    return cards.orderBy(direction(column), F.desc("ARTICLE_COUNT"), "TOPIC_ID")


def sentiment_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("SENTIMENT", F.lit("Unknown")).alias("SENTIMENT")).agg(F.count("*").alias("n"))


def corpus_stats(df: DataFrame, date="PUBLISHED_DATE") -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_distinct("SOURCE").alias("sources"), F.count_distinct("RISK_ID").alias("risks"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def lane_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("SEARCH_TERM_ID").agg(F.count("*").alias("n"))


def topics_per_risk(df: DataFrame) -> DataFrame:
    return df.where("TOPIC_ID != -1").groupBy("RISK_ID").agg(F.count_distinct("TOPIC_ID").alias("topics"))


def top_topics_per_risk(pairs: DataFrame, n: int = 5) -> DataFrame:
    """Each risk's topics of highest own peak, risks in order of their best momentum (0 or more), then peak."""
    rank = F.row_number().over(Window.partitionBy("RISK_ID").orderBy(F.desc("peak_intensity"), "TOPIC_ID"))
    top = pairs.select("RISK_ID", "TOPIC_ID", "peak_intensity", "momentum").distinct().withColumn("rank", rank).where(F.col("rank") <= n)
    best = top.groupBy("RISK_ID").agg(F.greatest(F.lit(0.0), F.max("momentum")).alias("risk_momentum"), F.greatest(F.lit(0.0), F.max("peak_intensity")).alias("risk_peak"))
    return top.join(best, "RISK_ID").orderBy(F.desc("risk_momentum"), F.desc("risk_peak"), "RISK_ID", "rank")


def nested_articles(df: DataFrame, columns: list[str]) -> DataFrame:
    """TOPIC_ID with its ranked articles as an array of structs, in the order of the rank; bounded by the rank's limit."""
    return df.groupBy("TOPIC_ID").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", *columns))), lambda s: F.struct(*[s[c].alias(c) for c in columns])).alias("articles"))


def payload(cards: DataFrame, articles: DataFrame) -> DataFrame:
    """One JSON document for each card."""
    rows = cards.join(articles, "TOPIC_ID", "left")
    return rows.select("TOPIC_ID", X.json_safe(F.to_json(F.struct(*[F.col(c) for c in rows.columns]))).alias("json"))


def series_payload(full: DataFrame, keys: list[str], value="intensity") -> DataFrame:
    """Dense series of each key as one array in the order of the months."""
    return full.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", value))), lambda s: s[value]).alias(value))


def scatter(ranked: DataFrame, x="NOVELTY", y="RELEVANCE", labels: int = 6) -> DataFrame:
    """Positions for a scatter plot: the share of the largest x and y, the sweet spot above both midpoints, labels of the best."""
    whole = Window.partitionBy()
    best = F.row_number().over(Window.orderBy(F.desc(F.col(x) * F.col(y)), "TOPIC_ID"))
    out = ranked.withColumns({"x_max": F.max(x).over(whole), "y_max": F.max(y).over(whole)})
    return out.withColumns({"sweet": (F.col(x) >= F.col("x_max") / 2) & (F.col(y) >= F.col("y_max") / 2), "labelled": best <= labels})


def stories_by_date(df: DataFrame, date="PUBLISHED_DATE", seq="seq") -> DataFrame:
    """Each topic's articles newest first by their ISO string; blanks last."""
    rank = F.row_number().over(Window.partitionBy("TOPIC_ID").orderBy(F.desc_nulls_last(X.blank_to_null(date)), seq))
    return df.withColumn("rank", rank)


def preferred_order(df: DataFrame, name: str, preferred: list[str]) -> DataFrame:
    """Named ones first in the given order, then the rest by name."""
    place = F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col(name))
    return df.orderBy(F.when(place > 0, place).otherwise(len(preferred) + 1), name)
