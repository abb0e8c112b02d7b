"""How well topics fit a taxonomy, and how new they are.

Centroids, term vectors and anchors are unit vectors. The taxonomy (risks and their terms) is the
bounded side: its size is counted before it is broadcast, and beyond a limit it goes out in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.vectors import against, dot, mean_vectors

CENTROID_SAMPLE = 40
NEW_WINDOW_MONTHS = 3
GAP_BOOST, DISCOVERY_BOOST = 1.5, 1.3
MIN_QUALITY = 0.6
BROADCAST_BYTES = 64_000_000

# Anchor phrases of the two relevance scores, fixed values.
DOMAIN_ANCHOR = [
    "securities regulation", "broker-dealer oversight", "investor protection", "market integrity", "financial fraud", "securities fraud", "market manipulation", "insider trading", "capital markets",
    "brokerage firm compliance", "financial regulation enforcement", "stock market volatility", "investment adviser misconduct", "anti-money laundering", "trading surveillance",
]
MISSION_ANCHOR = [
    "harm to retail investors", "investor losses from firm failure", "investor protection", "market integrity", "fair and orderly markets", "broker-dealer supervision and compliance", "member firm misconduct",
    "failure to supervise registered representatives", "sales practice violations harming customers", "customer funds and securities protection", "systemic risk to the securities market",
    "regulatory oversight of brokerage firms", "new products evading securities regulation", "gaps in regulatory jurisdiction over investor-facing products", "FINRA examination and enforcement effectiveness",
]


def head_per_topic(df: DataFrame, n: int = CENTROID_SAMPLE, seq: str = "seq") -> DataFrame:
    """The first n rows of each topic in input order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy("TOPIC_ID").orderBy(seq))).where(F.col("_rank") <= n).drop("_rank")


def centroids(df: DataFrame, vector="vector", n: int = CENTROID_SAMPLE) -> DataFrame:
    """TOPIC_ID, centroid: unit mean of the topic's first n vectors; outliers left out."""
    return mean_vectors(head_per_topic(df.where("TOPIC_ID != -1"), n), ["TOPIC_ID"], vector)


def risk_vectors(terms: DataFrame) -> DataFrame:
    """RISK_ID, risk_vector of terms: RISK_ID, vector."""
    return mean_vectors(terms, ["RISK_ID"], "vector", "risk_vector")


def similarities(topics: DataFrame, risks: DataFrame) -> DataFrame:
    """TOPIC_ID, RISK_ID, sim of every topic and risk; the taxonomy is the query set, taken in blocks of bounded size."""
    return against(topics, risks, "RISK_ID", "risk_vector", BROADCAST_BYTES).select("TOPIC_ID", "RISK_ID", F.round(dot(F.col("centroid"), F.col("risk_vector")), 6).alias("sim"))


def recent_months(df: DataFrame, n: int = NEW_WINDOW_MONTHS) -> DataFrame:
    """The n last months of the data; undated rows have none."""
    return df.select("month").where("month IS NOT NULL").distinct().orderBy(F.desc("month")).limit(n)


def first_seen(df: DataFrame) -> DataFrame:
    """TOPIC_ID, FIRST_SEEN, IS_NEW."""
    newest = recent_months(df).agg(F.min("month").alias("_from"))
    seen = df.groupBy("TOPIC_ID").agg(F.min("month").alias("FIRST_SEEN"))
    return seen.crossJoin(F.broadcast(newest)).select("TOPIC_ID", "FIRST_SEEN", F.coalesce(F.col("FIRST_SEEN") >= F.col("_from"), F.lit(False)).alias("IS_NEW"))


def peak_volume(df: DataFrame) -> DataFrame:
    """TOPIC_ID, PEAK_VOLUME: most distinct stories in a month; of a topic without any dated row all its rows."""
    months = df.groupBy("TOPIC_ID", "month").agg(F.count_distinct("DUP_GROUP").alias("n"), F.count("*").alias("rows"))
    dated = F.max(F.when(F.col("month").isNotNull(), F.col("n")))
    return months.groupBy("TOPIC_ID").agg(F.coalesce(dated, F.sum("rows")).alias("PEAK_VOLUME"))


def fit(topics: DataFrame, assigned: DataFrame, terms: DataFrame, risks: DataFrame) -> DataFrame:
    """FIT, GAP_RAW, FIT_PERCENTILE, GAP and BETTER_FIT_RISK of each topic.

    assigned: TOPIC_ID, RISK_ID; terms: RISK_ID, vector. A topic with no risk assigned has no gap;
    one whose risks the taxonomy lacks is measured against a similarity of 0.
    """
    best_term = assigned.join(terms, "RISK_ID").join(topics, "TOPIC_ID").select("TOPIC_ID", "RISK_ID", F.round(dot(F.col("centroid"), F.col("vector")), 6).alias("s"))
    best_term = best_term.groupBy("TOPIC_ID").agg(F.max("s").alias("s"), F.max_by("RISK_ID", F.struct("s", -F.col("RISK_ID"))).alias("BEST_FIT_RISK"))
    every = similarities(topics, risks).join(assigned.distinct().withColumn("_own", F.lit(True)), ["TOPIC_ID", "RISK_ID"], "left")
    own_best = F.max(F.when(F.col("_own"), F.col("sim"))).over(Window.partitionBy("TOPIC_ID"))
    ranked = every.withColumn("_best", F.coalesce(own_best, F.lit(0.0)))
    cal = ranked.groupBy("TOPIC_ID").agg(
        F.avg((F.col("sim") <= F.col("_best")).cast("int")).alias("_pct"),
        F.max_by("RISK_ID", F.struct("sim", -F.col("RISK_ID"))).alias("_top"),
        F.max_by(F.coalesce("_own", F.lit(False)), F.struct("sim", -F.col("RISK_ID"))).alias("_top_own"),
    )
    placed = assigned.select("TOPIC_ID").distinct().withColumn("_placed", F.lit(True))
    out = cal.join(best_term, "TOPIC_ID", "left").join(placed, "TOPIC_ID", "left").withColumn("_pct", F.when(F.col("_placed"), F.col("_pct")).otherwise(1.0))
    fitted = F.greatest(F.lit(0.0), F.coalesce("s", F.lit(-1.0)))
    return out.select(
        "TOPIC_ID",
        "BEST_FIT_RISK",
        F.round(fitted, 4).alias("FIT"),
        F.round(1 - fitted, 4).alias("GAP_RAW"),
        F.round("_pct", 4).alias("FIT_PERCENTILE"),
        F.round(1 - F.col("_pct"), 4).alias("GAP"),
        F.when(F.col("_placed") & ~F.col("_top_own"), F.col("_top")).alias("BETTER_FIT_RISK"),
    )


def gap_score(gap: Column, peak: Column, is_new: Column) -> Column:
    return F.round(gap * F.log1p(peak) * F.when(is_new, GAP_BOOST).otherwise(1.0), 4)


def build_gaps(articles: DataFrame, terms: DataFrame, min_quality: float = 0.0) -> DataFrame:
    """articles: TOPIC_ID, RISK_ID, month, DUP_GROUP, QUALITY_SCORE, vector, seq; terms: RISK_ID, vector. Ranked by score."""
    real = articles.where("TOPIC_ID != -1")
    topics = centroids(real)
    assigned = real.select("TOPIC_ID", "RISK_ID").where("RISK_ID IS NOT NULL").distinct()
    totals = real.groupBy("TOPIC_ID").agg(F.count("*").alias("TOTAL_ARTICLES"), F.round(F.sum(F.col("QUALITY_SCORE").cast("decimal(18,6)")).cast("double") / F.count("*"), 3).alias("AVG_QUALITY"))
    out = fit(topics, assigned, terms, risk_vectors(terms)).join(first_seen(real), "TOPIC_ID").join(peak_volume(real), "TOPIC_ID").join(totals, "TOPIC_ID")
    out = out.withColumn("EMERGING_GAP_SCORE", gap_score(F.col("GAP"), F.col("PEAK_VOLUME"), F.col("IS_NEW"))).where(F.col("AVG_QUALITY") >= min_quality)
    return out.orderBy(F.desc("EMERGING_GAP_SCORE"), "TOPIC_ID")


def novelty(topics: DataFrame, risks: DataFrame) -> DataFrame:
    """TOPIC_ID, NEAREST_RISK, NEAREST_RISK_SIM, NOVELTY against all risks of all taxonomies."""
    best = similarities(topics, risks).groupBy("TOPIC_ID").agg(F.max_by("RISK_ID", F.struct("sim", -F.col("RISK_ID"))).alias("NEAREST_RISK"), F.max("sim").alias("_sim"))
    return best.select("TOPIC_ID", "NEAREST_RISK", F.round("_sim", 4).alias("NEAREST_RISK_SIM"), F.round(1 - F.col("_sim"), 4).alias("NOVELTY"))


def relevance(topics: DataFrame, anchor: DataFrame, out="RELEVANCE") -> DataFrame:
    """Cosine of each centroid and the anchor (one row: centroid), 0 or more."""
    one = anchor.select(F.col("centroid").alias("_anchor"))
    return topics.crossJoin(F.broadcast(one)).select("TOPIC_ID", F.round(F.greatest(F.lit(0.0), dot(F.col("centroid"), F.col("_anchor"))), 4).alias(out))


def discovery_score(novelty_: Column, stories: Column, quality: Column, is_new: Column) -> Column:
    return F.round(novelty_ * F.log1p(stories) * quality * F.when(is_new, DISCOVERY_BOOST).otherwise(1.0), 4)


def candidates(ranked: DataFrame, terms: list[str]) -> DataFrame:
    """Topics with `tier` (benign if title or description holds one of the terms) and novelty times relevance."""
    blob = F.lower(F.concat_ws(" ", "TOPIC_TITLE", "TOPIC_DESCRIPTION"))
    hit = F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(blob, t))
    return ranked.withColumns({"tier": F.when(hit, "benign").otherwise("meaningful"), "combined": F.round(F.col("NOVELTY") * F.col("RELEVANCE"), 4)}).orderBy("tier", F.desc("combined"), "TOPIC_ID")


def gap_payload(ranked: DataFrame) -> DataFrame:
    """The gaps as the report shows them: shorter names, three decimals, null-safe."""
    three = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 3)
    return ranked.select(
        F.col("TOPIC_ID").alias("id"),
        F.coalesce(F.col("BEST_FIT_RISK").cast("string"), F.lit("")).alias("bestFitRisk"),
        F.coalesce(F.col("BETTER_FIT_RISK").cast("string"), F.lit("")).alias("betterFitRisk"),
        three("FIT").alias("fit"),
        three("GAP").alias("gap"),
        three("GAP_RAW").alias("gapRaw"),
        three("FIT_PERCENTILE").alias("fitPercentile"),
        "FIRST_SEEN",
        "IS_NEW",
        "PEAK_VOLUME",
        three("AVG_QUALITY").alias("quality"),
        three("EMERGING_GAP_SCORE").alias("score"),
    )
